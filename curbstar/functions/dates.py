"""Dates: tolerant parsing of the raw layouts."""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from curbstar.functions import values as V

ANY_DATE_FORMATS = (
    V.ISSUE_DATE_FORMAT,
    V.COMPACT_DATE_FORMAT,
    V.ISO_DATE_FORMAT,
    *V.FURTHER_DATE_FORMATS,
)

# What a run of one pattern letter stands for, by the run.
_SHAPES = {"M": "[0-9]{1,2}", "d": "[0-9]{1,2}", "MMM": "[A-Z][a-z]{2}", "a": "[AP]M"}


def parse_date(text: Column, date_format: str) -> Column:
    """The date in one layout; null when the text does not parse.

    The layout is tested first: a text of another layout would cost an exception per row.
    """
    run = r"([a-zA-Z])\1*"
    shape = re.sub(run, lambda m: _SHAPES.get(m[0], f"[0-9]{{{len(m[0])}}}"), date_format)
    return F.when(text.rlike(rf"^{shape}\z"), F.try_to_date(text, date_format))


def parse_any_date(text: Column, formats: Sequence[str] = ANY_DATE_FORMATS) -> Column:
    """The date in the first layout that parses; any other text is null."""
    return F.coalesce(*[parse_date(text, layout) for layout in formats])


def lost_dates(texts: Mapping[str, Column]) -> dict[str, Column]:
    """Per name, an aggregate that counts texts that are no date in any layout."""
    return {
        name: F.count_if(text.isNotNull() & parse_any_date(text).isNull())
        for name, text in texts.items()
    }


def parse_comma_date(text: Column) -> Column:
    """The date of ``20,190,625``; null for the zero placeholder and impossible dates."""
    digits = F.replace(text, F.lit(","), F.lit(""))
    return F.when(
        digits.rlike(V.EIGHT_DIGITS_PATTERN), F.try_to_date(digits, V.COMPACT_DATE_FORMAT)
    )


def first_observed_date(text: Column, issue_date: Column) -> Column:
    return F.coalesce(parse_comma_date(text), issue_date)
