"""A corpus from raw documents: quality, repeated lines, near copies, benchmark passages, mixture.

Each stage takes (spark, docs, sf_dir), works on all that the one before kept, and returns the
columns of ``documents``; the last returns the mixture. :func:`run` writes each stage's result to
the session's shared folder and reads it again, so a stage is never computed twice. Stages act by
row: rows that share an id, or have none, are documents of their own.

The stages judge by estimates and iterations over the whole corpus, which SQL does not express;
``tests/llm`` compares them with plain Python.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from curbstar.llm import decontaminate, line_dedup, mixing, ngram_join, quality
from curbstar.llm.common import KEY, keyed, table, without
from curbstar.sources.scratch import stored


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality model keeps."""
    rows = keyed(docs)
    return without(rows, quality.judged_documents(rows, KEY).filter("not kept").select("doc_id"))


def line_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without lines that repeat or nearly repeat an earlier one, their length counted anew."""
    return line_dedup.deduplicated_documents(docs).withColumn("n_chars", F.length("text").cast("long"))


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of linked documents the one with the smallest id, the first of those that share it."""
    rows = keyed(docs)
    linked = ngram_join.linked_documents(rows, KEY)
    return without(rows, linked.filter(F.col("doc_id") != F.col("component_id")).select("doc_id"))


def benchmark_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents of which benchmark passages cover less than a twentieth."""
    rows = keyed(docs)
    hits = decontaminate.matched_documents(rows, table(spark, sf_dir, "benchmark"), KEY)
    return without(rows, decontaminate.contamination(hits).filter("contaminated").select("doc_id"))


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """What the mixture takes of each document."""
    return mixing.mixed_documents(docs)


STAGES = [
    ("quality rules", quality_rules),
    ("line dedup", line_dedup_stage),
    ("n-gram Jaccard join", near_copies),
    ("benchmark decontamination", benchmark_passages),
    ("mixing sources to target weights", mixture),
]

ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), "pipeline-" + name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
