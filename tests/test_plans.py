"""The datasets: defects seeded by hand, plans that hold at scale, and the whole load."""

import datetime as dt
import re

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from curbstar.functions import times
from curbstar.operators import checks
from curbstar.operators.lookup import prepare_lookups
from curbstar.plans import gates, load, stage, star
from curbstar.sources import schemas as S
from curbstar.sources.scratch import stored
from workload import fixtures, raw_files


@pytest.fixture(scope="module")
def tables(spark, sf_dir):
    return {name: stored(df, name) for name, df in fixtures.full_staging(spark, sf_dir).items()}


@pytest.fixture(scope="module")
def ready(tables):
    return prepare_lookups(stage.lookups(tables))


@pytest.fixture(scope="module")
def stage2(tables, ready):
    return stored(stage.stage2_violation(tables["stage_violation"], ready, 2020), "stage2")


@pytest.fixture(scope="module")
def loaded(stage2, tables):
    made = star.star(stage2, tables["stage_violation_code"])
    return {name: stored(df, name) for name, df in made.items()}


def plan(df):
    """The physical plan before adaptive execution, without the result query."""
    return df._jdf.queryExecution().executedPlan().toString()


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


# --- Plans --------------------------------------------------------------------------------


def test_stage2_joins_seven_lookups_without_shuffling_citations(tables, ready):
    text = plan(stage.stage2_violation(tables["stage_violation"], ready, 2020))
    assert len(re.findall(r"BroadcastHashJoin", text)) == 7
    assert "SortMergeJoin" not in text and "hashpartitioning" not in text


def test_stage2_beyond_the_limit_does_not_broadcast_by_hint(spark, tables, stage2):
    large = prepare_lookups(stage.lookups(tables), broadcast_limit_bytes=0)
    assert not any(lookup.broadcast for lookup in large.values())
    shuffled = stage.stage2_violation(tables["stage_violation"], large, 2020)
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        assert "Broadcast" not in plan(shuffled)
        assert rows(shuffled) == rows(stage2)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)


def test_stage2_reads_only_what_it_needs(tables, ready):
    text = plan(stage.stage2_violation(tables["stage_violation"], ready, 2020))
    assert "violation_location" not in text and "meter_number" not in text
    assert "IsNotNull(plate_id)" in text


def test_generated_methods_stay_within_what_the_jvm_compiles(spark, tables, ready, capsys):
    def largest(df):
        spark.conf.set("spark.sql.adaptive.enabled", "false")
        try:
            df.select("*").explain("codegen")
        finally:
            spark.conf.set("spark.sql.adaptive.enabled", "true")
        return max(map(int, re.findall(r"maxMethodCodeSize:(\d+)", capsys.readouterr().out)))

    made = stage.stage2_violation(tables["stage_violation"], ready, 2020)
    assert largest(made) < 8000
    assert largest(star.violation_fact(made)) < 8000


def test_fact_is_a_projection(stage2):
    assert "Exchange" not in plan(star.violation_fact(stage2))


@pytest.mark.parametrize("make", [star.date_dimension, star.time_dimension])
def test_small_dimensions_scan_once(stage2, make):
    assert plan(make(stage2)).count("FileScan") == 1


def test_vehicles_are_reduced_before_one_shuffle(stage2):
    text = plan(star.vehicle_dimension(stage2))
    assert text.count("Exchange") == 1 and "Window" not in text
    assert "partial_max_by" in text


def test_places_are_merged_by_hash_before_they_get_a_key(stage2):
    text = plan(star.location_dimension(stage2))
    assert text.count("HashAggregate") == 2 and text.count("SortAggregate") == 2
    assert text.rindex("SortAggregate") < text.index("HashAggregate") < text.index("FileScan")
    assert "Window" not in text


# --- Properties of the star ---------------------------------------------------------------


def test_dimension_keys_are_unique(loaded):
    for row in checks.primary_key_report(loaded, S.PRIMARY_KEYS).collect():
        assert row["repeated_keys"] == 0, row
        assert row["null_keys"] == 0 or row["table_name"] == "location"


def test_references_hold_but_for_the_code_that_stands_for_other(loaded):
    report = checks.reference_report(loaded["violation"], loaded, S.REFERENCES)
    orphans = {r["fact_column"]: r["orphan_keys"] for r in report.collect()}
    assert orphans.pop("violation_code") == 1
    assert set(orphans.values()) == {0}


def test_stage2_has_no_more_rows_than_citations(tables, stage2, loaded):
    assert 0 < stage2.count() <= tables["stage_violation"].count()
    assert loaded["violation"].count() == stage2.count()


def test_a_known_value_is_never_reported_unknown(stage2, loaded):
    key = F.md5(F.concat(F.upper("plate_id"), F.upper("registration_state"), F.upper("plate_type")))
    known = stage2.filter("vehicle_make IS NOT NULL").select(key.alias("id")).distinct()
    unknown = loaded["vehicle"].filter("maker = 'Unknown'")
    assert unknown.join(known, "id", "left_semi").count() == 0


@pytest.mark.parametrize("name", list(S.STAR))
def test_order_and_partitioning_do_not_matter(stage2, tables, loaded, name):
    shuffled = stage2.repartition(5, F.rand(7))
    again = star.star(shuffled, tables["stage_violation_code"])[name]
    assert rows(again) == rows(loaded[name])


def test_upper_case_plates_give_the_same_vehicles(stage2, loaded):
    upper = star.vehicle_dimension(stage2.withColumn("plate_id", F.upper("plate_id")))
    assert rows(upper.drop("plate_id")) == rows(loaded["vehicle"].drop("plate_id"))


def test_a_hot_vehicle_does_not_change_the_others(stage2):
    hot = (F.crc32("summons_number") % 3) == 0
    skewed = stage2.withColumn("plate_id", F.when(hot, "HOT").otherwise(F.col("plate_id")))
    skewed = skewed.withColumn("registration_state", F.when(hot, "X").otherwise(F.col("registration_state")))
    skewed = skewed.withColumn("plate_type", F.when(hot, "Y").otherwise(F.col("plate_type")))
    whole = rows(star.vehicle_dimension(skewed))
    parts = rows(star.vehicle_dimension(skewed.filter(hot))) + rows(
        star.vehicle_dimension(skewed.filter(~hot))
    )
    assert whole == sorted(parts, key=repr)


# --- Defects that the derived tables do not seed ------------------------------------------


def stage2_rows(spark, *changes):
    base = {name: None for name in S.STAGE2_VIOLATION.names}
    base |= {
        "plate_id": "A1",
        "registration_state": "New York",
        "plate_type": "Passenger",
        "issue_date": dt.date(2020, 1, 1),
        "street_code1": 1,
        "street_code2": 2,
        "street_code3": 3,
        "street_name": "Main",
        "intersecting_street": "Unknown",
        "violation_county": "Kings",
        "house_number": "5",
        "date_first_observed": dt.date(2020, 1, 1),
    }
    made = [base | {"summons_number": str(i)} | change for i, change in enumerate(changes)]
    data = [tuple(row[name] for name in S.STAGE2_VIOLATION.names) for row in made]
    return spark.createDataFrame(data, S.STAGE2_VIOLATION)


def test_case_variants_are_one_place_and_one_vehicle(spark):
    rows2 = stage2_rows(spark, {"street_name": "main", "plate_id": "a1"}, {})
    assert star.location_dimension(rows2).count() == 1
    assert [r["plate_id"] for r in star.vehicle_dimension(rows2).collect()] == ["A1"]


def test_colliding_keys_are_one_row_and_null_keys_all_stay(spark):
    collide = stage2_rows(
        spark,
        {"street_code1": 1, "street_code2": 23},
        {"street_code1": 12, "street_code2": 3},
        {"street_code2": None},
        {"street_code2": None, "house_number": "6"},
    )
    places = star.location_dimension(collide).collect()
    assert sum(r["id"] is None for r in places) == 2
    (kept,) = [r for r in places if r["id"] is not None]
    assert (kept["street_code1"], kept["street_code2"]) == (1, 23)


def test_vehicles_without_a_key_are_told_apart(spark):
    rows2 = stage2_rows(
        spark,
        {"plate_type": None, "vehicle_make": "FORD"},
        {"plate_type": None, "plate_id": "B2", "vehicle_make": "BMW"},
    )
    assert rows(star.vehicle_dimension(rows2).select("id", "plate_id", "maker")) == [
        (None, "A1", "FORD"),
        (None, "B2", "BMW"),
    ]


def test_a_missing_issue_date_counts_as_the_latest(spark):
    rows2 = stage2_rows(
        spark, {"vehicle_make": "OLD", "issue_date": None}, {"vehicle_make": "NEW"}
    )
    assert star.vehicle_dimension(rows2).first()["maker"] == "OLD"
    assert star.date_dimension(rows2).count() == 1


def test_literal_times_differ_only_in_the_stand_in(spark):
    rows2 = stage2_rows(spark, {"violation_time": "0130"})
    assert rows(star.time_dimension(rows2)) == [(90, 30, 1)]
    assert rows(star.time_dimension(rows2, literal=True)) == [(130, 10, 2), (90, 30, 1)]
    assert star.violation_fact(rows2, literal=True).first()["time_first_observed"] == 130


def test_a_literal_star_uses_literal_times(stage2, tables, loaded):
    literal = star.star(stage2, tables["stage_violation_code"], literal=True)
    for name in ("location", "vehicle", "date"):
        assert rows(literal[name]) == rows(loaded[name])
    extra = literal["time"].join(loaded["time"], "time", "left_anti")
    assert extra.count() > 0
    report = checks.reference_report(literal["violation"], literal, S.REFERENCES)
    times_used = report.filter("dimension = 'time'").collect()
    assert len(times_used) == 2 and all(r["orphan_keys"] == 0 for r in times_used)


def test_gates_fail_on_seeded_defects(spark, tables):
    citations = tables["stage_violation"]
    checks.enforce(gates.raw_gate(citations))
    few_plates = citations.withColumn("plate_id", F.when(F.crc32("summons_number") % 2 == 0, "x"))
    with pytest.raises(checks.DataQualityError, match="plate_id"):
        checks.enforce(gates.raw_gate(few_plates))
    no_date = citations.withColumn(
        "issue_date", F.when(F.crc32("summons_number") % 50 > 0, F.col("issue_date"))
    )
    with pytest.raises(checks.DataQualityError, match="issue_date"):
        checks.enforce(gates.raw_gate(no_date))


def test_load_gates_fail_on_empty_or_repeated(loaded):
    with pytest.raises(checks.DataQualityError, match="vehicle_has_rows"):
        checks.enforce(gates.loaded_gate(loaded | {"vehicle": loaded["vehicle"].limit(0)}))
    checks.enforce(gates.key_gate(loaded))
    doubled = loaded["date"].union(loaded["date"])
    with pytest.raises(checks.DataQualityError, match="date_key_unique"):
        checks.enforce(gates.key_gate(loaded | {"date": doubled}))


@settings(
    max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture]
)
@given(st.lists(st.from_regex(r"[0-9]{3,5}[APXap]?", fullmatch=True), min_size=1, max_size=50))
def test_normalized_times_are_clock_times(spark, raw):
    df = spark.createDataFrame([(t,) for t in raw], "t string")
    made = df.select("t", times.normalize_time(F.col("t")).alias("hhmm")).collect()
    for row in made:
        if row["hhmm"] is not None:
            assert re.fullmatch(r"([01][0-9]|2[0-3])[0-5][0-9]", row["hhmm"]), row
            assert len(row["t"]) == 5
        else:
            assert not re.fullmatch(r"([01][0-9]|2[0-3])[0-5][0-9][APap]", row["t"]), row


# --- The whole load -----------------------------------------------------------------------


def test_load_from_raw_files(spark, sf_dir, tables, loaded, tmp_path):
    root = str(tmp_path / "warehouse")
    files = raw_files.all_files(spark, sf_dir)
    options = load.LoadSettings(2020, load.by_issue_year(), require_unique_keys=True)
    first = load.load_star(spark, files, root, options)
    for name, df in first.tables.items():
        assert rows(df) == rows(loaded[name]), name

    opened = load.open_star(spark, root)
    assert opened.run_id == first.run_id
    assert opened.tables["violation"].count() == first.tables["violation"].count()

    year = opened.tables["violation"].select(F.max(F.year("issue_date"))).first()[0]
    one_year = load.open_star(spark, root, F.col("issue_year") == year).tables["violation"]
    assert 0 < one_year.count() < first.tables["violation"].count()
    assert "PartitionFilters: [isnotnull(issue_year" in one_year._jdf.queryExecution().executedPlan().toString()

    class NoIssueDates:
        def read(self, session, table):
            found = files[table].read(session, table)
            return found.withColumn("issue_date", F.lit(None).cast("date"))

    with pytest.raises(checks.DataQualityError, match="issue_date"):
        load.load_star(spark, files | {"stage_violation": NoIssueDates()}, root, options)
    assert load.open_star(spark, root).run_id == first.run_id


def test_load_needs_a_source_for_every_table(spark, tmp_path):
    with pytest.raises(ValueError, match="stage_violation"):
        load.load_star(spark, {}, str(tmp_path), load.LoadSettings(2020))


def test_vehicles_without_a_key_stay_apart_everywhere(spark):
    columns = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in S.STAGE2_VIOLATION)
    blank = {f.name: None for f in S.STAGE2_VIOLATION}
    cars = [{"plate_id": p, "registration_state": "NY", "vehicle_make": m} for p, m in (("A", "BMW"), ("B", "FIAT"))]
    stage2 = spark.createDataFrame([tuple((blank | car).values()) for car in cars], columns)
    makers = star.last_known_attribute(stage2, "vehicle_make", "maker").collect()
    assert sorted(tuple(r) for r in makers) == [(None, "BMW"), (None, "FIAT")]
    assert star.vehicle_dimension(stage2).count() == 2


def test_reference_report_reads_the_fact_once(spark, tmp_path):
    path = str(tmp_path / "fact")
    spark.sql("SELECT 'a' AS vehicle, 1 AS code").write.parquet(path)
    dimension = spark.sql("SELECT 'a' AS id, 2 AS code")
    report = checks.reference_report(
        spark.read.parquet(path), {"vehicle": dimension}, {"vehicle": ("vehicle", "id"), "code": ("vehicle", "code")}
    )
    plan = report._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("parquet") == 1 and plan.count("LeftAnti") == 1, plan
    assert sorted(tuple(r) for r in report.collect()) == [("code", "vehicle", 1, 1), ("vehicle", "vehicle", 0, 0)]
