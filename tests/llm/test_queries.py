"""The registered numbered queries: against their SQL, and the pipeline stage by stage."""

import brute
import pytest
from comparison import duckdb_rows, duckdb_types, spark_rows, type_kinds

import corpus_pipeline
from curbstar.llm.oracles import SQL
from curbstar.llm.queries import QUERIES
from curbstar.sources.scratch import stored


def test_numbered_queries_are_registered():
    assert sorted(int(name[2:].split("_")[0]) for name in QUERIES) == list(range(1, 14))
    assert set(SQL) <= set(QUERIES)


@pytest.mark.parametrize("name", list(SQL))
def test_query_against_sql(name, spark, sf_dir, duck):
    df = stored(QUERIES[name](spark, sf_dir), "test")
    assert type_kinds(df) == duckdb_types(duck, SQL[name])
    got, want = spark_rows(df), duckdb_rows(duck, SQL[name])
    assert got[0] == want[0]
    assert got[1] == want[1]


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(SQL)))
def test_query_has_rows(name, spark, sf_dir):
    assert QUERIES[name](spark, sf_dir).count() > 0


def test_pipeline_stage_by_stage(spark, sf_dir):
    """Each stage against plain Python on what the one before kept."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    columns = docs.columns
    items = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/benchmark.parquet").select("item_id", "text").collect()]
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        rows = [tuple(r) for r in docs.select("doc_id", "text").collect()]
        docs = stored(stage(spark, docs, sf_dir), "test-stage")
        if k < 4:
            assert docs.columns == columns
            left = {r["doc_id"]: r["text"] for r in docs.collect()}
        if k == 0:
            assert not {q[0] for q in brute.quality(rows) if q[6]} & set(left)
            assert len(left) > 0.6 * len(rows)
        elif k == 1:
            gone = brute.removed_lines(rows)
            texts = {d: "\n".join(x for i, x in enumerate(t.split("\n")) if (d, i) not in gone) for d, t in rows}
            assert left == {d: t for d, t in texts.items() if brute.space_words(t)}
        elif k == 2:
            assert set(left) == {d for d, _, c in brute.linked(rows) if d == c}
        elif k == 3:
            assert set(left) == {c[0] for c in brute.contamination(rows, items) if not c[5]}
        else:
            assert docs.count() == len(rows)
            words = sum(len(brute.space_words(t)) for _, t in rows)  # each source is rounded to a word
            assert abs(docs.agg({"taken": "sum"}).first()[0] - words) <= len({r["source"] for r in docs.collect()})


def test_pipeline_stages_act_by_row(spark, sf_dir):
    """Rows that share an id, or have none, are kept or dropped each by its own text."""
    from pyspark.sql import functions as F

    from curbstar.llm import quality

    given = spark.read.parquet(f"{sf_dir}/documents.parquet")
    shared = F.when(F.col("doc_id") % 3 > 0, F.col("doc_id") % 10)
    docs = stored(given.withColumn("doc_id", shared), "test-shared-ids")
    items = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/benchmark.parquet").select("item_id", "text").collect()]
    rows = [tuple(r) for r in given.select("doc_id", "text").collect()]
    texts = lambda df: sorted(r["text"] or "" for r in df.collect())

    kept = {r["doc_id"] for r in quality.judged_documents(given).filter("kept").collect()}
    assert texts(corpus_pipeline.quality_rules(spark, docs, sf_dir)) == sorted(t or "" for d, t in rows if d in kept)
    assert corpus_pipeline.near_copies(spark, docs, sf_dir).count() == sum(d == c for d, _, c in brute.linked(rows))
    clean = {c[0] for c in brute.contamination(rows, items) if not c[5]}
    assert texts(corpus_pipeline.benchmark_passages(spark, docs, sf_dir)) == sorted(t or "" for d, t in rows if d in clean)
    assert corpus_pipeline.benchmark_passages(spark, docs, sf_dir).columns == docs.columns
