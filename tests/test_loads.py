"""Loads of batches, versions, gates measured by the writes, and digests."""

import datetime as dt
import random
import threading

import pytest
from pyspark.sql import functions as F

from curbstar.operators import checks, digest, latest, observe
from curbstar.plans import gates, load
from curbstar.sources import manifest, schemas, scratch, writers
from workload import fixtures



def settings(**options):
    return load.LoadSettings(2020, load.by_issue_year(), **options)


class Given:
    """A source that is a table already; ``before`` runs when a load reads it."""

    def __init__(self, table, before=lambda: None):
        self.table, self.before = table, before

    def read(self, session, name):
        self.before()
        return self.table


@pytest.fixture(scope="module")
def staging(spark, sf_dir):
    return {name: scratch.stored(df, name) for name, df in fixtures.full_staging(spark, sf_dir).items()}


@pytest.fixture(scope="module")
def files(staging):
    return {name: Given(df) for name, df in staging.items()}


def part(files, condition, before=lambda: None):
    return files | {"stage_violation": Given(files["stage_violation"].table.filter(condition), before)}


def digests_of(loaded):
    return sorted(map(tuple, digest.digest_report({n: loaded.tables[n] for n in schemas.STAR}).collect()))


@pytest.fixture(scope="module")
def whole(spark, files, tmp_path_factory):
    root = str(tmp_path_factory.mktemp("whole"))
    return root, load.load_star(spark, files, root, settings())


def test_gates_are_measured_by_the_writes(spark, files, whole, tmp_path, monkeypatch):
    def again(*_):
        raise AssertionError("a gate scanned a stored table")

    with monkeypatch.context() as patch:
        patch.setattr(checks, "run_checks", again)
        loaded = load.load_star(spark, files, str(tmp_path), settings())
    want = [*gates.raw_gate(files["stage_violation"].table).collect(), *gates.loaded_gate(loaded.tables).collect()]
    assert sorted(loaded.report) == sorted(map(tuple, want))
    # A gate that fails stops the load, and the earlier version stays.
    few = files | {"stage_violation": Given(files["stage_violation"].table.withColumn("plate_id", F.lit(None).cast("string")))}
    with pytest.raises(checks.DataQualityError, match="plate_id"):
        load.load_star(spark, few, str(tmp_path), settings())
    assert load.open_star(spark, str(tmp_path)).version == 1


def test_the_written_plan_measures_in_its_one_scan(spark, tmp_path):
    path = str(tmp_path / "rows")
    spark.range(100).write.parquet(path)
    df, rows = observe.checked(spark.read.parquet(path), [checks.has_rows("any"), checks.min_percentage("id", 100)])
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1 and plan.count("CollectMetrics") == 1 and "Exchange" not in plan, plan
    df.write.format("noop").mode("overwrite").save()
    assert rows() == [("any", 100.0, 0.0, True), ("id_not_null_percentage", 100.0, 100.0, True)]


def test_checks_of_an_empty_table_fail(spark):
    df, rows = observe.checked(spark.range(5).filter("id < 0"), [checks.has_rows("any")])
    df.write.format("noop").mode("overwrite").save()
    assert rows() == [("any", 0.0, 0.0, False)]


def test_batches_in_either_order_give_the_star_of_one_load(spark, files, whole, tmp_path):
    early = F.year("issue_date") < 1998
    parts = [part(files, early), part(files, ~early & (F.crc32("summons_number") % 3 == 0)), part(files, ~early & (F.crc32("summons_number") % 3 > 0))]
    root = str(tmp_path)
    for k in (2, 0, 1):
        loaded = load.load_batch(spark, parts[k], root, settings())
    assert digests_of(loaded) == digests_of(whole[1])
    opened = load.open_star(spark, root, verify=True)
    assert opened.version == 3 and load.open_star(spark, root, version=1).version == 1
    assert load.open_star(spark, root, version=1).tables["violation"].count() < opened.tables["violation"].count()
    # Expired runs leave what the newest version took over from them.
    assert writers.expire_runs(spark, root) == []
    assert digests_of(load.open_star(spark, root, verify=True)) == digests_of(whole[1])
    some = load.open_star(spark, root, F.col("issue_year") == 1997).tables["violation"]
    assert 0 < some.count() < whole[1].tables["violation"].filter("year(issue_date) <= 1997").count()


def test_a_batch_after_a_load_without_state(spark, files, whole, tmp_path):
    odd = F.crc32("summons_number") % 2 == 1
    load.load_star(spark, part(files, odd), str(tmp_path), settings())
    loaded = load.load_batch(spark, part(files, ~odd), str(tmp_path), settings(require_unique_keys=True))
    assert digests_of(loaded) == digests_of(whole[1])


def test_racing_loads(spark, files, whole, tmp_path):
    root, odd = str(tmp_path), F.crc32("summons_number") % 2 == 1
    third = F.crc32("summons_number") % 4 == 2
    load.load_batch(spark, part(files, odd), root, settings())

    once = iter([True])

    def faster():
        if next(once, False):
            load.load_batch(spark, part(files, third), root, settings())

    # The batch that finds a newer version is merged into it.
    merged = load.load_batch(spark, part(files, ~odd & ~third, faster), root, settings())
    assert merged.version == 3 and digests_of(merged) == digests_of(whole[1])
    # A whole load that finds one is refused, unless it is told to take its place.
    def other():
        if next(once, False):
            newest = manifest.current(spark, root)
            manifest.commit(spark, root, newest.version, newest.run_id, newest.folders, newest.digests)

    once = iter([True])
    with pytest.raises(manifest.ConflictingLoad):
        load.load_star(spark, part(files, odd, other), root, settings())
    assert load.open_star(spark, root).version == 4
    once = iter([True])
    replacing = load.LoadSettings(2020, replace_newer=True)
    assert load.load_star(spark, part(files, odd, other), root, replacing).version == 6
    assert manifest.versions(spark, root) == [1, 2, 3, 4, 5, 6]


def test_one_of_many_writers_makes_a_version(spark, tmp_path):
    root, made, refused = str(tmp_path / "a" / "b"), [], []

    def attempt(i):
        try:
            made.append(manifest.commit(spark, root, 0, f"run{i}").run_id)
        except manifest.ConflictingLoad:
            refused.append(i)

    threads = [threading.Thread(target=attempt, args=(i,)) for i in range(12)]
    for t in threads:
        t.start()
    for t in threads:
        t.join()
    assert len(made) == 1 and len(refused) == 11
    assert manifest.current(spark, root).run_id == made[0]
    assert [p.name for p in (tmp_path / "a" / "b" / "versions").iterdir() if not p.name.endswith(".crc")] == ["v000000000001.json"]
    with pytest.raises(ValueError, match="no version 7"):
        manifest.at_version(spark, root, 7)


def test_digests_find_what_counts_don_t(spark, whole, tmp_path):
    root, loaded = whole
    date = loaded.tables["date"]
    same = digest.digest_report({"date": date.repartition(7)}).first()
    assert tuple(same)[1:] == tuple(digest.digest_report({"date": date}).first())[1:]
    for changed in (
        date.withColumn("day", F.when(F.col("date") == date.first()["date"], 99).otherwise(F.col("day"))),
        date.withColumns({"day": F.col("month"), "month": F.col("day")}),
        date.withColumn("year", F.lit(None).cast("int")),
    ):
        assert changed.count() == date.count()
        assert tuple(digest.digest_report({"date": changed}).first())[2:] != tuple(same)[2:]
    found = manifest.current(spark, root)
    load.verify_digests({name: loaded.tables[name] for name in schemas.STAR}, found.digests)
    wrong = loaded.tables | {"date": date.withColumns({"day": F.col("month"), "month": F.col("day")})}
    with pytest.raises(load.DifferentContent, match="date"):
        load.verify_digests({name: wrong[name] for name in schemas.STAR}, found.digests)


def test_digests_tell_values_from_their_neighbours(spark):
    rows = [("1:a", None), (None, "1:a"), ("-", "-"), ("", None), ("12", "3"), ("1", "23"), (None, None)]
    found = {tuple(digest.digest_report({"x": spark.createDataFrame([row], "a string, b string")}).first())[2:] for row in rows}
    assert len(found) == len(rows)
    parts = [digest.digest_report({"x": spark.createDataFrame([row], "a string, b string")}).first().asDict() for row in rows]
    together = digest.digest_report({"x": spark.createDataFrame(rows, "a string, b string")}).first()
    assert digest.sum_of(parts) == {name: str(together[name]) for name in digest.NAMES}


def test_merged_states_are_the_state_of_all_rows(spark):
    rng = random.Random(4)
    rows = [
        (rng.choice(["a", "b", "c", None]), rng.choice([None, dt.date(2019, 1, rng.randrange(1, 5))]), f"s{rng.randrange(40)}", rng.choice([None, "x", "y", "z"]), i)
        for i in range(300)
    ]
    df = spark.createDataFrame(rows, "k string, day date, number string, color string, i int")

    def state(some):
        keys = {"k": F.col("k"), "_other": F.when(F.col("k").isNull(), F.struct("number"))}
        order = latest.event_order(F.col("day"), F.col("number"))
        return latest.last_state(some, keys, order, {"color": F.col("color")}, {"number": F.col("number")})

    def shown(some):
        return sorted(map(str, latest.values_of(some, ["k", "_other"], ["color"], ["number"]).collect()))

    parts = [state(df.filter(f"i % 3 = {m}")) for m in range(3)]
    want = shown(state(df))
    for a, b, c in ((0, 1, 2), (2, 1, 0), (1, 0, 2)):
        merged = latest.merged_state(parts[a], parts[b], ["k", "_other"], ["color"], ["number"])
        assert shown(latest.merged_state(merged, parts[c], ["k", "_other"], ["color"], ["number"])) == want
    none = state(df.filter("false"))
    assert shown(latest.merged_state(none, state(df), ["k", "_other"], ["color"], ["number"])) == want
