"""Readers, writers, declared tables and scratch folders."""

import datetime as dt
import os
import re

import pytest
from pyspark.sql import functions as F

from curbstar.sources import readers, schemas, scratch, writers
from curbstar.sources.schemas import conform, schema_differences


def lines(path, *text):
    path.write_text("\n".join(text) + "\n")
    return str(path)


def test_delimited_binds_by_position(spark, tmp_path):
    path = lines(tmp_path / "states.csv", "RECORD TYPE;STATE CODE;DESCRIPTION", "S;NY;New York", "S;NJ;")
    got = readers.read_delimited(spark, path, schemas.STAGE_STATE, sep=";")
    assert [tuple(r) for r in got.collect()] == [("S", "NY", "New York"), ("S", "NJ", None)]
    assert not schema_differences(got, schemas.STAGE_STATE)


def test_quoted_separator_and_bad_number(spark, tmp_path):
    good = lines(tmp_path / "good.csv", "c,d,m,o", '7,"No standing, any time",115,95.5')
    got = readers.read_delimited(spark, good, schemas.STAGE_VIOLATION_CODE)
    assert tuple(got.first()) == (7, "No standing, any time", 115.0, 95.5)
    bad = lines(tmp_path / "bad.csv", "c,d,m,o", "x,No standing,115,95")
    with pytest.raises(Exception, match="MALFORMED|Malformed"):
        readers.read_delimited(spark, bad, schemas.STAGE_VIOLATION_CODE).collect()
    lenient = readers.read_delimited(spark, bad, schemas.STAGE_VIOLATION_CODE, mode="PERMISSIVE")
    assert lenient.first()["code"] is None


@pytest.mark.parametrize("sep", [";", ","])
def test_any_date_tolerates_dates_only(spark, tmp_path, sep):
    names = schemas.STAGE_VIOLATION.names
    record = {name: "" for name in names}
    record |= {"summons_number": "1", "issue_date": "06/25/2019", "vehicle_year": "2001"}
    second = record | {"summons_number": "2", "issue_date": "", "vehicle_expiration_date": "88880088"}
    third = record | {"summons_number": "3", "vehicle_expiration_date": "20200131"}
    path = lines(
        tmp_path / "citations.csv",
        *[sep.join(names)],
        *[sep.join(r[n] for n in names) for r in (record, second, third)],
    )
    got = readers.read_delimited(spark, path, schemas.STAGE_VIOLATION, sep, any_date=True)
    assert not schema_differences(got, schemas.STAGE_VIOLATION)
    dates = {r["summons_number"]: (r["issue_date"], r["vehicle_expiration_date"]) for r in got.collect()}
    day = dt.date(2019, 6, 25)
    assert dates == {"1": (day, None), "2": (None, None), "3": (day, dt.date(2020, 1, 31))}


def test_chosen_columns_prune_the_scan(spark, tmp_path):
    path = lines(tmp_path / "s.csv", "STATE CODE;OTHER;DESCRIPTION", "NY;x;New York")
    got = readers.read_columns(
        spark, path, {"DESCRIPTION": "description", "STATE CODE": "state_code"}, sep=";"
    )
    assert tuple(got.first()) == ("New York", "NY")
    assert "OTHER" not in got._jdf.queryExecution().executedPlan().toString()


RECORD = '{"Body Code": "SEDN", "Body Style Description": "Sedan", "x": 1}'


@pytest.mark.parametrize(
    "layout, text",
    [("lines", [RECORD, RECORD.replace("SEDN", "VAN")]), ("array", ["[", RECORD, "]"])],
)
def test_json_records(spark, tmp_path, layout, text):
    path = lines(tmp_path / "body.json", *text)
    paths = ["$['Body Code']", "$['Body Style Description']"]
    got = readers.read_json_paths(spark, path, paths, schemas.STAGE_VEHICLE_BODY_TYPE, layout)
    assert tuple(got.first()) == ("SEDN", "Sedan")
    assert got.count() == (2 if layout == "lines" else 1)


def test_json_paths_may_nest_and_come_from_a_file(spark, tmp_path):
    path = lines(tmp_path / "c.json", '{"a": {"Code": "K", "b": {"name": "Kings"}}}')
    listed = lines(tmp_path / "paths.json", '{"jsonpaths": ["$[\'a\'][\'Code\']",', '"$.a.b.name"]}')
    paths = readers.read_path_list(spark, listed)
    got = readers.read_json_paths(spark, path, paths, schemas.STAGE_COUNTY)
    assert tuple(got.first()) == ("K", "Kings")


@pytest.mark.parametrize("bad", ["Code", "$", "$..x", "$['a'][0]"])
def test_unsupported_paths_are_refused(bad):
    with pytest.raises(ValueError, match="Unsupported"):
        readers.path_steps(bad)


def test_path_count_must_fit_the_table(spark):
    with pytest.raises(ValueError, match="1 paths for 2 columns"):
        readers.read_json_paths(spark, "unused", ["$.a"], schemas.STAGE_COUNTY)


def counties(spark, *rows):
    return spark.createDataFrame(list(rows), "county string, code string")


def test_loads_bind_by_name(spark, tmp_path):
    path = str(tmp_path / "county")
    writers.replace_table(counties(spark, ("Kings", "K")), path, schemas.STAGE_COUNTY)
    stored = writers.replace_table(counties(spark, ("Queens", "Q")), path, schemas.STAGE_COUNTY)
    assert [tuple(r) for r in stored.collect()] == [("Q", "Queens")]
    more = writers.append_table(counties(spark, ("Bronx", "BX")), path, schemas.STAGE_COUNTY)
    assert more.count() == 2


def test_column_list_leaves_the_rest_null(spark, tmp_path):
    path = str(tmp_path / "county")
    rows = counties(spark, ("Kings", "K"))
    stored = writers.replace_table(rows, path, schemas.STAGE_COUNTY, columns=["county"])
    assert tuple(stored.first()) == (None, "Kings")


def test_a_table_that_differs_is_refused(spark, tmp_path):
    wrong = counties(spark, ("Kings", "K")).withColumn("code", F.lit(1))
    with pytest.raises(ValueError, match="code"):
        writers.replace_table(wrong, str(tmp_path / "x"), schemas.STAGE_COUNTY)
    extra = counties(spark, ("Kings", "K")).withColumn("more", F.lit(1))
    with pytest.raises(ValueError, match="more"):
        conform(extra, schemas.STAGE_COUNTY)


def test_partitioned_load_keeps_one_directory_per_value(spark, tmp_path):
    rows = spark.createDataFrame(
        [(dt.date(2019, 1, d), d, 1, 2019) for d in range(1, 20)]
        + [(dt.date(2020, 1, 1), 1, 1, 2020)],
        schemas.DATE,
    )
    path = str(tmp_path / "date")
    stored = writers.replace_table(
        rows, path, schemas.DATE, partition_by={"of_year": F.year("date")}
    )
    assert stored.count() == 20 and stored.columns == schemas.DATE.names
    assert sorted(p.name for p in (tmp_path / "date").glob("of_year=*")) == [
        "of_year=2019",
        "of_year=2020",
    ]


def test_run_log_names_the_last_run(spark, tmp_path):
    root = str(tmp_path)
    for run in ("one", "two"):
        writers.record_run(spark, root, run)
    assert writers.latest_run(spark, root) == "two"


def test_declared_tables():
    widths = {name: len(schema) for name, schema in schemas.TABLES.items()}
    assert widths["stage_violation"] == 43 and widths["stage2_violation"] == 26
    assert widths["violation"] == 12 and len(schemas.TABLES) == 15


def test_scratch_follows_the_session_setting(spark, tmp_path):
    before = spark.conf.get("spark.checkpoint.dir", None)
    paths = {scratch.scratch_path(spark, "x") for _ in range(2)}
    assert len(paths) == 2
    if before:
        assert all(path.startswith(before) for path in paths)


class _Conf:
    def __init__(self, values):
        self.values = values

    def get(self, name, default=None):
        return self.values.get(name, default)


class _Session:
    def __init__(self, **values):
        self.conf = _Conf({f"spark.{k.replace('_', '.')}": v for k, v in values.items()})


def test_scratch_never_uses_a_local_folder_on_a_cluster():
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        scratch.scratch_path(_Session(master="yarn"), "x")
    shared = scratch.scratch_path(_Session(master="yarn", checkpoint_dir="hdfs://shared/tmp"), "x")
    assert shared.startswith("hdfs://shared/tmp/curbstar/x-")


def test_a_failing_replace_keeps_the_earlier_rows(spark, tmp_path):
    path = str(tmp_path / "dates")
    good = spark.createDataFrame([(dt.date(2019, 6, 14), 14, 6, 2019)], schemas.DATE)
    writers.replace_table(good, path, schemas.DATE)
    bad = good.withColumn("date", F.expr("CASE WHEN year = 2019 THEN raise_error('broken') END").cast("date"))
    with pytest.raises(Exception, match="broken"):
        writers.replace_table(bad, path, schemas.DATE)
    assert writers.read_table(spark, path, schemas.DATE).count() == 1
    again = writers.replace_table(writers.read_table(spark, path, schemas.DATE), path, schemas.DATE)
    assert again.count() == 1, "a table may be replaced from itself"
    assert [p.name for p in tmp_path.iterdir()] == ["dates"]


def test_expired_runs_go_and_the_current_one_stays(spark, tmp_path):
    root = str(tmp_path)
    assert not (tmp_path / "run_log").exists()
    with pytest.raises(ValueError, match="complete"):
        writers.latest_run(spark, root)
    for run in ("one", "two", "three", "loading"):
        spark.range(1).write.parquet(writers.run_table_path(root, run, "date"))
        if run != "loading":
            writers.record_run(spark, root, run)
    assert writers.expire_runs(spark, root, keep=2) == ["one"]
    assert writers.expire_runs(spark, root) == ["two"]
    assert writers.expire_runs(spark, root) == []
    assert sorted(p.name for p in (tmp_path / "runs").iterdir()) == ["loading", "three"]
    with pytest.raises(ValueError, match="current"):
        writers.expire_runs(spark, root, keep=0)


def test_a_directory_column_prunes_folders(spark, tmp_path):
    rows = spark.createDataFrame([(dt.date(y, 1, 1), 1, 1, y) for y in (2019, 2020)], schemas.DATE)
    path = str(tmp_path / "date")
    writers.replace_table(rows, path, schemas.DATE, partition_by={"of_year": F.year("date")})
    one = writers.read_table(spark, path, schemas.DATE, ["of_year"], F.col("of_year") == 2020)
    assert [r["year"] for r in one.collect()] == [2020]
    plan = one._jdf.queryExecution().executedPlan().toString()
    assert re.search(r"PartitionFilters: \[[^\]]*of_year", plan), plan
    with pytest.raises(ValueError, match="directory"):
        writers.read_table(spark, path, schemas.DATE, ["other"])


def test_quotes_separators_and_line_breaks(spark, tmp_path):
    text = 'c,d,m,o\n7,"say ""stop"", now",1,2\n8,"a\\",3,4\n9," x; ""y"" ",5,6\n'
    plain = tmp_path / "plain.csv"
    plain.write_text(text)
    got = readers.read_delimited(spark, str(plain), schemas.STAGE_VIOLATION_CODE).collect()
    assert [r[1] for r in got] == ['say "stop", now', "a\\", ' x; "y" ']
    assert [r[2] for r in got] == [1, 3, 5]
    broken = tmp_path / "broken.csv"
    broken.write_text('c,d,m,o\n7,"two\nlines",1,2\n')
    got = readers.read_delimited(spark, str(broken), schemas.STAGE_VIOLATION_CODE, multiline=True)
    assert [r[1] for r in got.collect()] == ["two\nlines"]
    chosen = readers.read_columns(spark, str(plain), {"d": "text"})
    assert [r["text"] for r in chosen.collect()][0] == 'say "stop", now'


def test_a_cluster_is_refused_a_folder_of_one_machine(spark):
    cluster = _Session(master="yarn", checkpoint_dir="/tmp/x")
    cluster.sparkContext = spark.sparkContext
    with pytest.raises(ValueError, match="one machine"):
        scratch.scratch_path(cluster, "x")
    cluster.conf.values["spark.checkpoint.dir"] = "file:///mnt/shared"
    assert scratch.scratch_path(cluster, "x").startswith("file:///mnt/shared/")


def test_discard_deletes_scratch_tables_alone(spark, tmp_path):
    table = scratch.stored(spark.range(3), "gone")
    own = str(tmp_path / "own")
    spark.range(3).write.parquet(own)
    folder = table.inputFiles()[0].removeprefix("file://").rpartition("/")[0]
    scratch.discard(table, spark.read.parquet(own))
    assert not os.path.exists(folder) and os.path.exists(own)
