"""Operators on hand-made tables, hot keys and nulls included."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from curbstar.operators import checks, keyed, profile
from curbstar.operators.latest import event_order, last_known
from curbstar.operators.lookup import (
    DuplicateLookupKeys,
    Lookup,
    prepare_lookups,
    unmatched,
    unmatched_totals,
)
from curbstar.operators.ranking import rank_by_dimension
from curbstar.plans import star


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def plan(df):
    return df._jdf.queryExecution().toString()


# --- Lookups ------------------------------------------------------------------------------


@pytest.fixture
def colors(spark):
    return spark.createDataFrame(
        [("bl", "Blue"), ("RD", "Red"), ("GY", None), (None, "Nothing")], "code string, color string"
    )


@pytest.fixture
def cars(spark):
    data = [(1, "BL"), (2, "rd"), (3, "xx"), (4, None), (5, "gy")]
    return spark.createDataFrame(data, "id int, vehicle_color string")


@pytest.mark.parametrize("limit", [10**6, 0])
def test_lookup_folds_case_at_any_size(cars, colors, limit):
    ready = prepare_lookups([Lookup("colors", colors, "code")], limit)["colors"]
    assert ready.broadcast is (limit > 0)
    joined = ready.join(cars, F.col("vehicle_color"), {"color": "name"})
    assert rows(joined.select("id", "name")) == [
        (1, "Blue"),
        (2, "Red"),
        (3, None),
        (4, None),
        (5, None),
    ]
    inner = ready.join(cars, F.col("vehicle_color"), {"color": "name"}, "inner")
    assert rows(inner.select("id")) == [(1,), (2,), (5,)]


def test_a_large_lookup_is_not_broadcast_by_hint(cars, colors):
    ready = prepare_lookups([Lookup("colors", colors, "code")], 0)["colors"]
    assert "strategy=broadcast" not in plan(ready.join(cars, F.col("vehicle_color"), {"color": "c"}))


def test_a_hot_code_of_a_large_lookup_is_split_over_tasks(spark):
    cars = spark.range(0, 200000, 1, 8).select(
        "id", F.when(F.col("id") % 3 == 0, "HOT").otherwise(F.concat(F.lit("c"), F.col("id") % 5000)).alias("code")
    )
    names = spark.range(5000).select(F.concat(F.lit("C"), "id").alias("code"), F.col("id").alias("n"))
    names = names.union(spark.createDataFrame([("hot", -1)], "code string, n bigint"))
    ready = prepare_lookups([Lookup("names", names, "code")], 0)["names"]
    forced = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "64k",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "128k",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
    }
    before = {name: spark.conf.get(name, None) for name in forced}
    for name, value in forced.items():
        spark.conf.set(name, value)
    try:
        joined = ready.join(cars, F.col("code"), {"n": "number"}).filter("number IS NOT NULL")
        counted = joined.groupBy("number").count()
        result = {r["number"]: r["count"] for r in counted.collect()}
        assert "skew=true" in plan(counted)
    finally:
        for name, value in before.items():
            spark.conf.unset(name) if value is None else spark.conf.set(name, value)
    assert result[-1] == 66667 and sum(result.values()) == 200000


def test_lookup_size_is_measured(colors):
    ready = prepare_lookups([Lookup("colors", colors, "code")])["colors"]
    assert ready.rows == 3
    assert ready.size_bytes > 3 * 96


def test_an_empty_lookup_is_ready(spark, cars):
    empty = spark.createDataFrame([], "code string, color string")
    ready = prepare_lookups([Lookup("colors", empty, "code")])["colors"]
    joined = ready.join(cars, F.col("vehicle_color"), {"color": "name"})
    assert joined.filter("name IS NOT NULL").count() == 0 and joined.count() == 5


def test_duplicate_codes_are_refused(spark, colors):
    doubled = colors.union(spark.createDataFrame([("BL", "Azure")], colors.schema))
    with pytest.raises(DuplicateLookupKeys, match="colors"):
        prepare_lookups([Lookup("colors", doubled, "code")])
    exact = prepare_lookups([Lookup("colors", doubled, "code", fold_case=False)])
    assert exact["colors"].rows == 4


def test_unmatched_codes_include_null_and_undescribed(cars, colors):
    found = unmatched(cars, {"vehicle_color": (Lookup("colors", colors, "code"), "color")})
    assert rows(found) == [
        ("vehicle_color", "gy", 1),
        ("vehicle_color", "xx", 1),
        ("vehicle_color", None, 1),
    ]
    assert rows(unmatched_totals(found)) == [("vehicle_color", 3, 3)]


# --- Last known values --------------------------------------------------------------------


def day(n):
    return dt.date(2020, 1, n)


def latest_of(spark, data):
    df = spark.createDataFrame(data, "id string, day date, n string, color string, year int")
    return last_known(
        df,
        {"id": F.col("id")},
        event_order(F.col("day"), F.col("n")),
        {"color": F.col("color"), "year": F.col("year")},
    )


def test_each_column_keeps_its_own_latest_value(spark):
    data = [
        ("v", day(1), "1", "Red", 1999),
        ("v", day(3), "2", None, 2001),
        ("v", day(2), "3", "Blue", None),
        ("w", day(1), "4", None, None),
    ]
    assert rows(latest_of(spark, data)) == [("v", "Blue", 2001), ("w", None, None)]


def test_ties_are_broken_and_missing_dates_come_last(spark):
    data = [
        ("v", day(1), "1", "Red", 1),
        ("v", day(1), "2", "Blue", 2),
        ("w", None, "1", "Green", 3),
        ("w", day(9), "2", "Grey", 4),
    ]
    assert rows(latest_of(spark, data)) == [("v", "Blue", 2), ("w", "Green", 3)]


def test_fixed_columns_come_from_one_row(spark):
    df = spark.createDataFrame([("k", "b", 1), ("k", "a", 2)], "id string, x string, y int")
    got = last_known(
        df,
        {"id": F.col("id")},
        F.struct(F.col("y").alias("y")),
        {},
        {"x": F.col("x"), "y": F.col("y")},
    )
    assert rows(got) == [("k", "a", 2)]


def test_a_hot_key_is_reduced_before_the_shuffle(spark):
    hot = spark.range(20000).select(
        F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("k"), "id")).alias("id"),
        F.date_add(F.lit(day(1)), (F.col("id") % 1000).cast("int")).alias("day"),
        F.lpad(F.col("id").cast("string"), 6, "0").alias("n"),
        F.when(F.col("id") < 19000, F.col("id").cast("string")).alias("color"),
        F.col("id").cast("int").alias("year"),
    )
    got = last_known(
        hot,
        {"id": F.col("id")},
        event_order(F.col("day"), F.col("n")),
        {"color": F.col("color"), "year": F.col("year")},
    )
    expected = max((i % 1000, f"{i:06d}") for i in range(0, 19000, 3))
    row = got.filter("id = 'hot'").first()
    assert row["color"] == str(int(expected[1]))
    assert "partial_max_by" in plan(got) and "Window" not in plan(got)


# --- Rows by key --------------------------------------------------------------------------


def test_one_row_per_key_keeps_all_keyless_rows(spark):
    data = [("a", 2, "x"), ("a", 1, "y"), (None, 1, "x"), (None, 2, "x"), (None, 2, "x")]
    df = spark.createDataFrame(data, "id string, n int, t string")
    assert rows(keyed.one_row_per_key(df, "id", ["n", "t"])) == [
        ("a", 1, "y"),
        (None, 1, "x"),
        (None, 2, "x"),
    ]


def test_union_distinct_counts_null_once(spark):
    df = spark.createDataFrame([(1, 2), (2, None), (None, 3)], "a int, b int")
    got = keyed.union_distinct(df, [F.col("a"), F.col("b")], "v")
    assert rows(got) == [(1,), (2,), (3,), (None,)]


def test_repeated_key_rows_treat_null_as_a_value(spark):
    data = [("a", 1), ("a", 2), ("b", 1), (None, 1), (None, 2)]
    df = spark.createDataFrame(data, "k string, v int")
    got = keyed.repeated_key_rows(df, ["k"])
    assert rows(got) == [("a", 1), ("a", 2), (None, 1), (None, 2)]
    assert "Window" not in plan(got)


# --- Profile ------------------------------------------------------------------------------


def test_duplicate_profile_counts_null_as_one_value(spark):
    df = spark.createDataFrame([("a",), ("a",), (None,), (None,), ("b",)], "c string")
    assert rows(profile.duplicate_profile(df, ["c"])) == [("c", 3, 2, True)]


def test_profile_columns(spark):
    df = spark.createDataFrame([(1, None), (2, "x")], "a int, b string")
    assert rows(profile.profile_columns(df)) == [("a", 2, 2, 0, False), ("b", 2, 1, 1, True)]


def test_value_counts_order(spark):
    df = spark.createDataFrame([("b",), ("a",), ("c",), ("c",), (None,)], "c string")
    got = [tuple(r) for r in profile.value_counts(df, ["c"]).collect()]
    assert got == [("c", "c", 2), ("c", "a", 1), ("c", "b", 1)]


def test_distinct_attributes_can_require_columns(spark):
    df = spark.createDataFrame([("a", 1), ("a", 1), (None, 1)], "k string, v int")
    assert rows(profile.distinct_attributes(df, ["k", "v"], ["k"])) == [("a", 1)]


def test_rows_by_null(spark):
    df = spark.createDataFrame([("a", 1), (None, 2)], "k string, v int")
    assert rows(profile.rows_where_null(df, "k")) == [(None, 2)]
    assert rows(profile.rows_where_not_null(df, "k")) == [("a", 1)]


def test_all_match_passes_over_nulls_and_sentinels(spark):
    df = spark.createDataFrame([("20,190,625",), ("0",), (None,)], "d string")
    rule = {"d": (F.col("d"), F.lit("0"), r"^\d{2},\d{3},\d{3}$")}
    assert rows(profile.all_match(df, rule)) == [("d", True, 1)]
    worse = df.union(spark.createDataFrame([("2019",)], "d string"))
    assert rows(profile.all_match(worse, rule)) == [("d", False, 2)]


def test_bad_times_before_and_after_each_repair(spark):
    data = [("0130A", None), ("0049A", None), ("9999A", "0130P"), ("9999A", None), (None, "0049P")]
    df = spark.createDataFrame(data, "a string, b string")
    got = {r["column_name"]: tuple(r)[1:] for r in profile.bad_time_counts(df, {"a": "b"}).collect()}
    assert got == {"a": (4, 3, 1)}


def test_head_is_a_top_k(spark):
    df = spark.range(100).withColumn("v", -F.col("id"))
    got = profile.head(df, [F.asc("v")], 3)
    assert [r["id"] for r in got.collect()] == [99, 98, 97]
    assert "TakeOrderedAndProject" in plan(got)


# --- Checks -------------------------------------------------------------------------------


@pytest.fixture
def plates(spark):
    return spark.createDataFrame([("a",), (None,), ("b",), ("c",)], "plate_id string")


def test_checks_report_and_enforce(plates):
    report = checks.run_checks(
        plates, [checks.has_rows(), checks.min_percentage("plate_id", 75)]
    )
    assert rows(report) == [
        ("has_rows", 4.0, 0.0, True),
        ("plate_id_not_null_percentage", 75.0, 75.0, True),
    ]
    assert len(checks.enforce(report)) == 2
    failing = checks.run_checks(plates, [checks.min_percentage("plate_id", 85)])
    with pytest.raises(checks.DataQualityError, match="plate_id_not_null_percentage"):
        checks.enforce(failing)


def test_an_empty_table_fails_with_a_name_and_no_division_error(plates):
    empty = plates.limit(0)
    report = checks.run_checks(empty, [checks.min_percentage("plate_id", 0)])
    assert rows(report) == [("plate_id_not_null_percentage", None, 0.0, False)]
    with pytest.raises(checks.DataQualityError, match="has_rows"):
        checks.enforce(checks.run_checks(empty, [checks.has_rows()]))


def test_literal_percentage_knows_only_all_or_nothing(plates):
    value = checks.non_null_percentage("plate_id", literal=True)
    assert plates.agg(value).first()[0] == 0
    assert plates.dropna().agg(value).first()[0] == 100


def test_two_checks_may_not_share_a_name(plates):
    with pytest.raises(ValueError, match="share a name"):
        checks.run_checks(plates, [checks.has_rows("x"), checks.has_rows("x")])


def test_a_check_may_bring_its_own_condition(plates):
    odd = checks.Check("even_rows", F.count("*"), lambda value: value % 2 == 0)
    assert checks.run_checks(plates, [odd]).first()["passed"] is True


def test_statement_checks_stop_at_the_first_failure(spark, plates):
    filled = checks.Statement("filled", "SELECT count(*) AS n FROM {plates}", "n > 0")
    share = "SELECT 100.0D * count(plate_id) / count(*) AS share FROM {plates}"
    broken = checks.Statement("broken", "SELECT x", "x")
    tables = {"plates": plates}
    checks.enforce_in_order(spark, [filled, checks.Statement("share", share, "share >= 75")], tables)
    with pytest.raises(checks.DataQualityError, match="strict"):
        strict = checks.Statement("strict", share, "share >= 85")
        checks.enforce_in_order(spark, [filled, strict, broken], tables)


def test_statement_checks_count_any_number_of_records(spark):
    many = "SELECT id FROM range(200000)"
    report = lambda *args: checks.statement_report(spark, checks.Statement("ids", *args)).first()
    assert report(many, "id >= 0", None)["passed"]
    assert not report(many, "id >= 0")["passed"]
    found = report(many, "id < 199998 OR id IS NULL", 200000)
    assert (found["records"], found["unmet"], found["passed"]) == (200000, 2, False)
    assert not report("SELECT id FROM range(0)", "id >= 0", None)["passed"]
    assert not report("SELECT CAST(NULL AS INT) AS n", "n > 0")["passed"]


def test_key_reports(spark):
    fact = spark.createDataFrame([("a",), ("a",), ("z",), (None,)], "vehicle string")
    vehicles = spark.createDataFrame([("a",), ("b",), ("b",), (None,)], "id string")
    keys_found = checks.primary_key_report({"vehicle": vehicles}, {"vehicle": "id"})
    assert rows(keys_found) == [("vehicle", "id", 1, 1, 1)]
    orphans = checks.reference_report(fact, {"vehicle": vehicles}, {"vehicle": ("vehicle", "id")})
    assert rows(orphans) == [("vehicle", "vehicle", 1, 1)]
    nulls = checks.null_key_report({"violation": fact}, {"violation": ["vehicle"]})
    assert rows(nulls) == [("violation", "vehicle", 1)]


# --- Ranking ------------------------------------------------------------------------------


def test_ranking_keeps_rows_without_a_dimension_row(spark):
    fact = spark.createDataFrame([(1,), (1,), (2,), (None,), (9,)], "k int")
    dimension = spark.createDataFrame([(1, "x"), (2, "y")], "id int, name string")
    ranked = rank_by_dimension(fact, "k", dimension, "id", {"name": F.col("name")})
    assert [tuple(r) for r in ranked.collect()] == [(None, 2), ("x", 2), ("y", 1)]
    top = rank_by_dimension(fact, "k", dimension, "id", {"name": F.col("name")}, k=1)
    assert [tuple(r) for r in top.collect()] == [(None, 2)]


def test_star_dimension_code_rows_are_plain_distinct(spark):
    data = [(1, "a", 1.0, 2.0), (1, "a", 1.0, 2.0), (1, "b", 1.0, 2.0)]
    codes = spark.createDataFrame(
        data, "code int, description string, manhattan_amount double, others_amount double"
    )
    assert star.violation_code_dimension(codes).count() == 2
