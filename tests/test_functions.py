"""Column functions on hand-made values."""

import datetime as dt
import hashlib

import pytest
from pyspark.sql import functions as F

from curbstar.functions import codes, dates, keys, times

TIMES = {
    "0049A": "0049",
    "0030P": "0030",
    "1200A": "0000",
    "1215P": "1215",
    "1259P": "1259",
    "1300A": "1300",
    "2430A": None,
    "0130p": "1330",
    "0130P": "1330",
    "0130A": "0130",
    "130P": None,
    "0160A": None,
    "0130X": None,
    "01 0A": None,
    "1159p": "2359",
    "2359A": "2359",
    "0100A": "0100",
    "0059P": "0059",
    "1245a": "0045",
    "": None,
    None: None,
}


def test_normalize_time(column):
    got = column(list(TIMES), "t string", times.normalize_time(F.col("t")))
    assert dict(zip(TIMES, got)) == TIMES


def test_minutes_of_day(column):
    got = column(["0000", "0101", "2359", None], "t string", times.minutes_of_day(F.col("t")))
    assert got == [0, 61, 1439, None]


TIME_PAIRS = [("0130", None), (None, "0245"), (None, None), ("1000", "0900")]


def test_each_time_stands_in_for_the_other(column):
    schema = "a string, b string"
    assert column(TIME_PAIRS, schema, times.citation_minutes(F.col("a"), F.col("b"))) == [
        90,
        165,
        None,
        600,
    ]
    observed = times.first_observed_minutes(F.col("a"), F.col("b"))
    assert column(TIME_PAIRS, schema, observed) == [90, 165, None, 540]


def test_literal_stand_in_is_the_number_and_not_minutes(column):
    literal = times.first_observed_minutes(F.col("a"), F.col("b"), literal=True)
    assert column(TIME_PAIRS, "a string, b string", literal) == [130, 165, None, 540]


@pytest.mark.parametrize(
    "text, twelve, twenty_four",
    [
        ("0130A", True, True),
        ("130P", True, True),
        ("0049A", False, True),
        ("1300A", False, True),
        ("2430A", False, False),
        ("0130X", False, False),
        ("0060A", False, False),
        ("AA0130pp", False, True),
    ],
)
def test_clock_parses(column, text, twelve, twenty_four):
    assert column([text], "t string", times.parses_on_12_hour_clock(F.col("t"))) == [twelve]
    assert column([text], "t string", times.parses_on_24_hour_clock(F.col("t"))) == [twenty_four]


def test_comma_date(column):
    raw = ["20,190,625", "0", "20,191,331", "2019", None, "20190625", "20,190,230"]
    day = dt.date(2019, 6, 25)
    got = column(raw, "d string", dates.parse_comma_date(F.col("d")))
    assert got == [day, None, None, None, None, day, None]


def test_first_observed_date_falls_back_to_issue_date(column):
    issued = dt.date(2020, 1, 2)
    rows = [("20,190,625", issued), ("0", issued), ("20,191,331", issued), ("0", None)]
    got = column(
        rows, "d string, i date", dates.first_observed_date(F.col("d"), F.col("i"))
    )
    assert got == [dt.date(2019, 6, 25), issued, issued, None]


def test_any_date(column):
    raw = ["06/25/2019", "20190625", "2019-06-25", "25/06/2019", "88880088", "0", "", None]
    day = dt.date(2019, 6, 25)
    got = column(raw, "d string", dates.parse_any_date(F.col("d")))
    assert got == [day, day, day, None, None, None, None, None]


def test_further_date_layouts(column):
    raw = ["1/8/2019", "06/14/2019 12:00:00 AM", "06-14-2019", "2019/06/14", "14-Jun-2019"]
    raw += ["14-JUN-2019x", "06/14/2019 12:00", "13/13/2019", "2019/6/14"]
    june = dt.date(2019, 6, 14)
    got = column(raw, "d string", dates.parse_any_date(F.col("d")))
    assert got == [dt.date(2019, 1, 8), june, june, june, june, None, None, None, None]


def test_model_year_depends_on_the_given_year_only(column):
    years = [1883, 1884, 2022, 2023, 0, None]
    got = column(years, "y int", codes.valid_model_year(F.col("y"), 2020))
    assert got == [None, 1884, 2022, None, None, None]


def test_precinct(column):
    rows = [(5, 9), (0, 9), (0, 0), (0, None), (None, 9)]
    got = column(rows, "v int, i int", codes.fill_precinct(F.col("v"), F.col("i")))
    assert got == [5, 9, None, None, None]


def test_front_or_opposite(column):
    raw = ["I", "f", "O", "i", "X", "", None]
    got = column(raw, "c string", codes.front_or_opposite(F.col("c")))
    assert got == ["InFront", "InFront", "Opposite", "InFront", None, None, None]
    literal = column(raw, "c string", codes.front_or_opposite(F.col("c"), literal=True))
    assert literal == ["Opposite", "InFront", "Opposite", "Opposite", None, None, None]


def test_map_values_matches_case(column):
    got = column(["I", "i", None], "c string", codes.map_values(F.col("c"), {"I": "InFront"}))
    assert got == ["InFront", None, None]


def _md5(text):
    return hashlib.md5(text.encode()).hexdigest()


def test_keys_fold_case_and_pass_nulls_on(column):
    rows = [("ab", "Ny", "Pas"), ("AB", "NY", "PAS"), (None, "NY", "PAS")]
    key = keys.vehicle_key(F.col("p"), F.col("s"), F.col("t"))
    assert column(rows, "p string, s string, t string", key) == [_md5("ABNYPAS")] * 2 + [None]


def test_a_separator_tells_joined_parts_apart(column):
    rows = [("1", "23"), ("12", "3")]
    parts = [F.col("a"), F.col("b")]
    plain = column(rows, "a string, b string", keys.surrogate_key(parts))
    apart = column(rows, "a string, b string", keys.surrogate_key(parts, sep="|"))
    assert plain == [_md5("123")] * 2
    assert apart == [_md5("1|23"), _md5("12|3")]


def test_location_key_has_a_stand_in_for_the_precinct_only(column):
    names = [
        "street_code1",
        "street_code2",
        "street_code3",
        "street_name",
        "intersecting_street",
        "violation_precinct",
        "violation_county",
        "house_number",
    ]
    schema = "a int, b int, c int, d string, e string, f int, g string, h string"
    rows = [(1, 2, 3, "Main", "Oak", None, "Kings", "5a"), (1, None, 3, "Main", "Oak", 4, "K", "5")]
    key = keys.location_key(dict(zip(names, map(F.col, "abcdefgh"))))
    assert column(rows, schema, key) == [_md5("123MAINOAK-1KINGS5A"), None]
