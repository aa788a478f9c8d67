"""Tables in buckets: joins and counts by the key without a shuffle."""

import pytest
from pyspark.sql import functions as F

from curbstar.operators import checks
from curbstar.plans import questions
from curbstar.sources import buckets, schemas
from workload import catalog


@pytest.fixture(scope="module")
def pair(spark, sf_dir, tmp_path_factory):
    """Facts of which a third belong to one vehicle, and vehicles without some that facts name."""
    tables, root = catalog._star(spark, sf_dir), str(tmp_path_factory.mktemp("buckets"))
    hot = tables["vehicle"].agg(F.max("id")).first()[0]
    facts = tables["violation"].withColumn("vehicle", F.when(F.crc32("summons_number") % 3 == 0, hot).otherwise(F.col("vehicle")))
    vehicles = tables["vehicle"].filter("id IS NULL OR id NOT LIKE 'a%'")
    stored = {
        "violation": buckets.create_bucketed(facts, f"{root}/violation", schemas.VIOLATION, buckets.Buckets("vehicle", 6)),
        "vehicle": buckets.create_bucketed(vehicles, f"{root}/vehicle", schemas.VEHICLE, buckets.Buckets("id", 6)),
    }
    return {"violation": facts, "vehicle": vehicles}, stored, root


@pytest.fixture
def no_broadcast(spark):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def below_join(df):
    """The lines of the plan from the first join down."""
    lines = df._jdf.queryExecution().executedPlan().toString().split("\n")
    at = next(i for i, line in enumerate(lines) if "Join" in line)
    return "\n".join(lines[at:])


def test_joins_by_the_key_have_no_exchange(spark, pair, no_broadcast):
    plain, stored, _ = pair
    ranked = questions.top_vehicle_types(stored["violation"], stored["vehicle"])
    report = checks.orphan_report(stored["violation"], "vehicle", stored["vehicle"], "id")
    for df in (ranked, report):
        assert "Exchange" not in below_join(df), below_join(df)
    assert "Exchange" in below_join(questions.top_vehicle_types(plain["violation"], plain["vehicle"]))
    assert ranked.collect() == questions.top_vehicle_types(plain["violation"], plain["vehicle"]).collect()
    want = checks.reference_report(plain["violation"], plain, {"vehicle": ("vehicle", "id")}).first()
    assert report.first()["orphan_keys"] == want["orphan_keys"] > 0 and report.first()["orphan_rows"] == want["orphan_rows"]


def test_a_session_opens_them_by_their_record(spark, pair, no_broadcast):
    plain, stored, root = pair
    want = sorted(map(str, plain["vehicle"].collect()))
    buckets.close_bucketed(spark, f"{root}/vehicle")
    again = buckets.open_bucketed(spark, f"{root}/vehicle", schemas.VEHICLE)
    assert sorted(map(str, again.collect())) == want
    assert "Exchange" not in below_join(questions.top_vehicle_types(stored["violation"], again))


def test_a_hot_key_is_written_by_several_tasks(spark, pair):
    _, stored, root = pair
    hot = stored["violation"].groupBy("vehicle").count().orderBy(F.desc("count")).first()["vehicle"]
    of_hot = spark.read.parquet(f"{root}/violation").filter(F.col("vehicle") == hot)
    assert of_hot.select(F.input_file_name()).distinct().count() == buckets.WRITERS
