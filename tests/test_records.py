"""Records that many tasks cut from one file, against readers that take a file whole."""

import json
import random

import pytest

from curbstar.sources import readers, records
from curbstar.sources.schemas import _table

SCHEMA = _table("a s, b s, n i")
FIELDS = ["plain", "", "two\nlines", 'a "quoted" word', "x;y", "\n\n", '"', '";"\n"', "tab\tand \\ slash", "é漢字\n😀", "}", "{[", '\\"', " "]


@pytest.fixture
def small_splits(spark):
    before = spark.conf.get("spark.sql.files.maxPartitionBytes"), spark.conf.get("spark.sql.files.openCostInBytes")

    def use(size):
        spark.conf.set("spark.sql.files.maxPartitionBytes", str(size))
        spark.conf.set("spark.sql.files.openCostInBytes", "1")

    yield use
    spark.conf.set("spark.sql.files.maxPartitionBytes", before[0])
    spark.conf.set("spark.sql.files.openCostInBytes", before[1])


def csv_text(rows, end="\n", last=True):
    quote = lambda f: '"' + f.replace('"', '""') + '"'
    lines = ["a;b;n", *[f"{quote(a)};{quote(b)};{n}" for a, b, n in rows]]
    return end.join(lines) + (end if last else "")


@pytest.mark.parametrize(("size", "end"), [(60, "\n"), (90, "\r\n"), (1000, "\n")])
def test_delimited_records_cross_lines_and_splits(spark, tmp_path, small_splits, size, end):
    rng = random.Random(size)
    rows = [(rng.choice(FIELDS), rng.choice(FIELDS), i) for i in range(50)]
    rows[30] = ("long\n" * 80, "x", 30)  # one record over many splits
    (tmp_path / "one.csv").write_text(csv_text(rows, end), newline="")
    (tmp_path / "two.csv").write_text(csv_text(rows[:3], end, last=False), newline="")
    (tmp_path / "none.csv").write_text("a;b;n\n")
    want = readers.read_delimited(spark, str(tmp_path), SCHEMA, ";", multiline=True)
    expected = sorted(map(str, want.collect()))
    small_splits(size)
    got = readers.read_delimited(spark, str(tmp_path), SCHEMA, ";", multiline="split")
    assert sorted(map(str, got.collect())) == expected
    assert sorted(r["n"] for r in got.collect()) == sorted([r[2] for r in rows] + [0, 1, 2])
    assert spark.read.text(str(tmp_path)).rdd.getNumPartitions() > 2


@pytest.mark.parametrize(("size", "indent"), [(70, None), (90, 1), (5000, None)])
def test_arrays_are_cut_into_records(spark, tmp_path, small_splits, size, indent):
    rng = random.Random(size)
    rows = [{"Code": rng.choice(FIELDS), "More": {"a": rng.choice(FIELDS), "n": [1, {"x": "}"}]}, "n": i} for i in range(30)]
    rows[20]["Code"] = "}{" * 150
    (tmp_path / "one.json").write_text(json.dumps(rows, indent=indent, ensure_ascii=False))
    (tmp_path / "two.json").write_text(" [\n" + json.dumps(rows[0]) + " ] \n")
    (tmp_path / "none.json").write_text("[]")
    small_splits(size)
    got = sorted(json.dumps(json.loads(r["text"]), sort_keys=True) for r in records.array_records(spark, str(tmp_path)).collect())
    assert got == sorted(json.dumps(r, sort_keys=True) for r in [*rows, rows[0]])
    paths = ["$['Code']", "$.More.a", "$.n"]
    read = readers.read_json_paths(spark, str(tmp_path / "one.json"), paths, SCHEMA, "split_array")
    assert sorted((r["a"], r["b"], r["n"]) for r in read.collect()) == sorted((r["Code"], r["More"]["a"], r["n"]) for r in rows)


def test_a_bad_number_stops_a_split_read(spark, tmp_path):
    (tmp_path / "bad.csv").write_text('a;b;n\n"x";"y";1\n"x";"y";one\n')
    with pytest.raises(Exception, match="(?i)malformed|FAILFAST"):
        readers.read_delimited(spark, str(tmp_path), SCHEMA, ";", multiline="split").collect()
