"""The order of day and month, found from the values and from a neighbouring date."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from curbstar.operators.date_order import date_order_report, ordered_formats
from curbstar.sources import readers
from curbstar.sources.schemas import _table


@pytest.mark.parametrize(
    ("texts", "order"),
    [
        (["13/01/2020", "01/02/2020", None, "x"], "day_first"),
        (["01-13-2020", "01-02-2020"], "month_first"),
        (["01/02/2020", "03/03/2020"], "undecided"),
        (["13/01/2020", "01/13/2020"], "undecided"),
        (["13/01/2020", "14/01/2020", "01/13/2020"], "day_first"),
        (["31/02/2020", "20200113", ""], "undecided"),
        ([], "undecided"),
    ],
)
def test_values_decide(spark, texts, order):
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    row = date_order_report(df, {"t": None}).first()
    assert row["column_name"] == "t" and row["date_order"] == order


@pytest.mark.parametrize(("near", "order"), [("2020-02-10", "day_first"), ("2020-01-05", "month_first"), (None, "undecided")])
def test_a_neighbouring_date_decides_where_values_don_t(spark, near, order):
    df = spark.createDataFrame([("01/02/2020", near), ("03/03/2020", near)], "t string, near string")
    row = date_order_report(df, {"t": F.to_date("near")}).first()
    assert row["date_order"] == order and row["day_only"] == row["month_only"] == 0


def test_columns_of_one_file_may_differ(spark, tmp_path):
    (tmp_path / "x.csv").write_text("a;b;n\n13/02/2020;02/13/2020;1\n01/02/2020;01/02/2020;2\n")
    read = lambda **options: readers.read_delimited(spark, str(tmp_path), _table("a d, b d, n i"), ";", any_date=True, **options)
    day = dt.date
    assert sorted(map(tuple, read(date_neighbours={}).collect())) == [(day(2020, 2, 1), day(2020, 1, 2), 2), (day(2020, 2, 13), day(2020, 2, 13), 1)]
    assert sorted(map(str, map(tuple, read().collect()))) == sorted([str((day(2020, 1, 2), day(2020, 1, 2), 2)), str((None, day(2020, 2, 13), 1))])


def test_layouts_change_only_where_both_are_numbers():
    given = ("MM/dd/yyyy", "M/d/yyyy", "yyyyMMdd", "dd-MMM-yyyy", "MM-dd-yyyy")
    assert ordered_formats(given, "month_first") == given
    assert ordered_formats(given, "day_first") == ("dd/MM/yyyy", "d/M/yyyy", "yyyyMMdd", "dd-MMM-yyyy", "dd-MM-yyyy")
