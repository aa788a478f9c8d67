"""Time of day: repair raw text to ``HHMM`` and count minutes since midnight."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from curbstar.functions import values as V


def has_time_format(raw: Column) -> Column:
    """True when the text is four digits of a valid clock time and A or P, in either case."""
    return raw.rlike("(?i)" + V.RAW_TIME_PATTERN + r"\z")


def normalize_time(raw: Column) -> Column:
    """``HHMM`` on the 24-hour clock, or null when the text has not the raw format.

    A value that cannot be 12-hour notation keeps its digits and its letter is ignored;
    any other value is moved to the 24-hour clock by its letter.
    """
    digits = F.substring(raw, 1, 4)
    number = digits.try_cast("int")
    is_24_hour = (number > V.LAST_12_HOUR_TIME) | (number < V.FIRST_12_HOUR_TIME)
    past_noon = F.when(F.upper(F.substring(raw, 5, 1)) == "P", 1200).otherwise(0)
    # 12:xx is hour zero of its half day.
    on_24_hour_clock = number % 1200 + past_noon
    repaired = F.when(is_24_hour, digits).otherwise(
        F.lpad(on_24_hour_clock.cast("string"), 4, "0")
    )
    return F.when(has_time_format(raw), repaired)


def minutes_of_day(hhmm: Column) -> Column:
    """Minutes since midnight of a normalized ``HHMM`` text."""
    hours = F.substring(hhmm, 1, 2).try_cast("int")
    minutes = F.substring(hhmm, 3, 2).try_cast("int")
    return hours * 60 + minutes


def citation_minutes(violation_time: Column, first_observed: Column) -> Column:
    """Minutes of the citation; the first observation stands in when it is missing."""
    return F.coalesce(minutes_of_day(violation_time), minutes_of_day(first_observed))


def first_observed_minutes(
    violation_time: Column, first_observed: Column, literal: bool = False
) -> Column:
    """Minutes of the first observation; the citation time stands in when it is missing.

    ``literal=True`` keeps the older output, where the stand-in is the ``HHMM`` number and
    not minutes.
    """
    stand_in = (
        violation_time.try_cast("int") if literal else minutes_of_day(violation_time)
    )
    return F.coalesce(minutes_of_day(first_observed), stand_in)


def parses_on_12_hour_clock(raw: Column) -> Column:
    """Whether hour, minute and letter read as a 12-hour time; one-digit parts are allowed."""
    return raw.rlike(r"(?i)^(1[0-2]|0?[1-9])[0-5]?[0-9][AP]$")


def parses_on_24_hour_clock(raw: Column) -> Column:
    """Whether the digits, with the letters at both ends stripped, read as a 24-hour time."""
    stripped = F.btrim(raw, F.lit(V.MERIDIEM_LETTERS))
    return stripped.rlike(r"^(2[0-3]|[0-1]?[0-9])[0-5]?[0-9]$")
