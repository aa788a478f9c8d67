"""Whether a column writes the day or the month first, told by what its values allow.

A number above 12 can't be a month. Where no value has one, the readings are compared with a
neighbouring date of the same row: the order that lies nearer in more rows counts. Evidence is a few
counts per column from one scan; a column without any, or with as much for either order, is
reported as undecided.
"""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from curbstar.operators.profile import measure

MONTH_FIRST, DAY_FIRST, UNDECIDED = "month_first", "day_first", "undecided"
_NUMBERS = r"^([0-9]{1,2})[/.-]([0-9]{1,2})[/.-]([0-9]{4})(?![0-9])"


def date_order_report(df: DataFrame, columns: Mapping[str, Column | None]) -> DataFrame:
    """Per column: column_name, day_only, month_only, day_nearer, month_nearer, date_order.

    ``columns`` maps a column of texts to a date of the same row that its dates lie close to, or None.
    ``day_only`` counts texts that are a date with the day first only, ``day_nearer`` texts that are one
    in both orders and lie nearer to the other date with the day first.
    """
    return measure(df, "column_name", {name: _evidence(F.col(name), near) for name, near in columns.items()})


def _evidence(text: Column, near: Column | None) -> dict[str, Column]:
    first, second, year = [F.regexp_extract(text, _NUMBERS, i).try_cast("int") for i in (1, 2, 3)]
    day_first = F.try_make_timestamp(year, second, first, F.lit(0), F.lit(0), F.lit(0)).cast("date")
    month_first = F.try_make_timestamp(year, first, second, F.lit(0), F.lit(0), F.lit(0)).cast("date")
    either = day_first.isNotNull() & month_first.isNotNull()
    day_only = F.count_if(day_first.isNotNull() & month_first.isNull())
    month_only = F.count_if(month_first.isNotNull() & day_first.isNull())
    day_nearer = month_nearer = F.count_if(F.lit(False))
    if near is not None:
        from_day, from_month = F.abs(F.datediff(day_first, near)), F.abs(F.datediff(month_first, near))
        day_nearer, month_nearer = F.count_if(either & (from_day < from_month)), F.count_if(either & (from_month < from_day))
    order = (
        F.when(day_only > month_only, DAY_FIRST)
        .when(month_only > day_only, MONTH_FIRST)
        .when(day_only > 0, UNDECIDED)
        .when(day_nearer > month_nearer, DAY_FIRST)
        .when(month_nearer > day_nearer, MONTH_FIRST)
        .otherwise(UNDECIDED)
    )
    return {
        "day_only": day_only,
        "month_only": month_only,
        "day_nearer": day_nearer,
        "month_nearer": month_nearer,
        "date_order": order,
    }


def ordered_formats(formats: Sequence[str], order: str) -> tuple[str, ...]:
    """Date layouts with day and month in the given order where both are numbers before the year."""
    if order != DAY_FIRST:
        return tuple(formats)
    return tuple(re.sub(r"^(M{1,2})([/.-])(d{1,2})\2(?=y)", r"\3\2\1\2", layout) for layout in formats)
