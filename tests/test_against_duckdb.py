"""Every registered query gives the rows and types of its SQL, over whole tables."""

import pytest
from comparison import duckdb_rows, duckdb_types, spark_rows, type_kinds

import __spark_entry__ as entry_points
from workload import catalog, oracles

QUERIES = catalog.QUERIES
STATEMENTS = oracles.all_statements()


def test_every_query_has_a_statement():
    assert set(QUERIES) == set(STATEMENTS)
    assert set(QUERIES) <= set(entry_points.queries())


@pytest.mark.parametrize("name", list(QUERIES))
def test_query(name, spark, sf_dir, duck):
    df = QUERIES[name](spark, sf_dir)
    assert type_kinds(df) == duckdb_types(duck, STATEMENTS[name])
    got, want = spark_rows(df), duckdb_rows(duck, STATEMENTS[name])
    assert got[0] == want[0]
    assert got[1] == want[1]
    assert got[1], "an empty result would prove nothing"


def test_entry_has_rows(spark):
    assert entry_points.entry(spark).count() > 0
