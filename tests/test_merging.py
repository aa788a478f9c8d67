"""Profiles merged from parts, and files that most questions can skip."""

import datetime as dt
import glob
import random

import pyarrow.parquet as pq
from pyspark.sql import functions as F

from curbstar.operators import sketches
from curbstar.sources.clustering import clustered


def test_merged_profiles_are_the_profile_of_all_rows(spark):
    rng = random.Random(7)
    rows = [(i % 5, rng.choice([None, "a", "b", "c", "c", "c"]), rng.randrange(50_000)) for i in range(40_000)]
    df = spark.createDataFrame(rows, "year int, code string, number int").repartition(4)
    parts = sketches.column_sketches(df, ["code", "number"], F.col("year"))
    assert parts.count() == 10
    found = {r["column_name"]: r for r in sketches.merged_profile(parts).collect()}
    whole = {r["column_name"]: r for r in sketches.merged_profile(sketches.column_sketches(df, ["code", "number"], F.lit(0))).collect()}
    for name in ("code", "number"):
        assert found[name][1:5] == whole[name][1:5]
    assert found["code"]["distinct_estimate"] == 3 and found["code"]["value_count"] == sum(r[1] is not None for r in rows)
    exact = len({r[2] for r in rows})
    assert abs(found["number"]["distinct_estimate"] - exact) <= 3 * sketches.RELATIVE_ERROR * exact
    top = {(r["column_name"], r["value"]): r["n"] for r in sketches.merged_frequent_values(parts, 2).collect()}
    counts = {v: sum(r[1] == v for r in rows) for v in "abc"}
    want = sorted(counts, key=lambda v: -counts[v])[:2]
    assert {v: n for (c, v), n in top.items() if c == "code"} == {v: counts[v] for v in want}


def test_merged_profiles_of_empty_and_null_columns(spark):
    df = spark.createDataFrame([(1, None), (2, None)], "year int, code string")
    row = sketches.merged_profile(sketches.column_sketches(df, ["code"], F.col("year"))).first()
    assert row["row_count"] == 2 and row["value_count"] == 0 and row["smallest"] is None and row["distinct_estimate"] == 0
    none = sketches.column_sketches(df.limit(0), ["code"], F.col("year"))
    assert none.count() == 0 and sketches.merged_profile(none).count() == 0 and sketches.merged_frequent_values(none, 2).count() == 0


def test_most_clustered_files_are_skipped(spark, tmp_path):
    rng = random.Random(8)
    start, counties = dt.date(2019, 1, 1), ["BRONX", "KINGS", "NEW YORK", "QUEENS", "RICHMOND", None]
    rows = [(start + dt.timedelta(rng.randrange(730)), rng.choice(counties), i) for i in range(20_000)]
    rows += [(dt.date(2019, 6, 1), "KINGS", -1 - i) for i in range(5_000)]  # one combination with a fifth of all rows
    df = spark.createDataFrame(rows, "day date, county string, n int")
    path = str(tmp_path / "clustered")
    clustered(df, ["day", "county"], 32).write.parquet(path)
    files = sorted(glob.glob(f"{path}/*.parquet"))
    assert sum(pq.read_metadata(f).num_rows for f in files) == len(rows) and len(files) > 20

    def may_hold(file, first, last, county):
        group = pq.read_metadata(file).row_group(0)
        day, place = group.column(0).statistics, group.column(1).statistics
        days = day.min <= last and first <= day.max
        return days and (place is not None and place.has_min_max and place.min <= county <= place.max)

    needed = [f for f in files if may_hold(f, dt.date(2020, 3, 1), dt.date(2020, 3, 31), "QUEENS")]
    assert 0 < len(needed) <= len(files) / 4
    asked = (F.col("day").between("2020-03-01", "2020-03-31")) & (F.col("county") == "QUEENS")
    back = spark.read.parquet(path)
    assert back.filter(asked).count() == df.filter(asked).count() > 0
    plan = back.filter(asked)._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [IsNotNull(day), IsNotNull(county), GreaterThanOrEqual(day" in plan, plan
    holding = back.filter("n < 0").select(F.input_file_name()).distinct().count()
    assert holding > 3, "the frequent combination fills several files"
