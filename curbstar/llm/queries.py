"""The registered queries of the numbered operators: each applies its operator to its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from curbstar.llm import (
    decontaminate,
    hnsw,
    lexical,
    licenses,
    line_dedup,
    main_text,
    mixing,
    negatives,
    ngram_join,
    pii,
    quality,
    token_counts,
    warc,
)
from curbstar.llm.common import table


def op1_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.section_tokens(table(spark, sf_dir, "documents"))


def op2_weighted_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mixing.mixed_documents(table(spark, sf_dir, "documents"))
    return mixed.select("doc_id", "size", "source_size", "target", "taken")


def op3_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.span_report(table(spark, sf_dir, "documents"))


def op4_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    hits = decontaminate.matched_documents(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return decontaminate.contamination(hits)


def op5_warc_archive(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.archive_report(table(spark, sf_dir, "pages"))


def op6_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup.line_report(table(spark, sf_dir, "documents"))


def op7_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return main_text.extracted_pages(table(spark, sf_dir, "pages"))


def op8_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.linked_documents(table(spark, sf_dir, "documents"))


def op9_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = quality.judged_documents(table(spark, sf_dir, "documents"))
    return judged.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "posterior"
    )


def op10_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.license_report(table(spark, sf_dir, "documents"))


def op11_nearest_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings")
    return hnsw.search(hnsw.build_index(vectors), vectors.filter("vec_id % 20 = 0"), 20)


def op12_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings")
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return negatives.hard_negatives(vectors.withColumn("label", moved), F.col("vec_id") % 50 == 0)


def op13_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lexical.ranked_documents(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), 10)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_token_counts": op1_token_counts,
    "op2_weighted_mix": op2_weighted_mix,
    "op3_personal_data": op3_personal_data,
    "op4_decontaminate": op4_decontaminate,
    "op5_warc_archive": op5_warc_archive,
    "op6_line_dedup": op6_line_dedup,
    "op7_main_text": op7_main_text,
    "op8_ngram_join": op8_ngram_join,
    "op9_quality_rules": op9_quality_rules,
    "op10_license_scan": op10_license_scan,
    "op11_nearest_neighbours": op11_nearest_neighbours,
    "op12_hard_negatives": op12_hard_negatives,
    "op13_lexical_search": op13_lexical_search,
}
