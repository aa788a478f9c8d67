"""Tables whose files hold rows that are near each other in several columns.

Each column is cut into ranges of about as many rows; the numbers of the ranges, their bits
interleaved, give an order in which rows near in all columns lie together. Files are ranges of this
order, so the smallest and largest value that a file keeps of each column exclude it from most
questions about a few values, without folders per value.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, NumericType, StringType

#: Base 2 logarithm of a column's ranges.
BITS = 5
_PLACE = "_place"


def clustered(df: DataFrame, columns: Sequence[str], files: int, bits: int = BITS) -> DataFrame:
    """``df`` in ``files`` partitions of rows near each other in ``columns``, ready to be written.

    Ranges come from one scan of these columns, as approximate percentiles. Rows that agree in all of
    them are spread by the rest of the row, so a frequent combination may fill many files.
    """
    numbers = [_number(df, name) for name in columns]
    shares = F.array(*[F.lit(i / 2**bits) for i in range(1, 2**bits)])
    found = df.agg(*[F.percentile_approx(n, shares, 10_000).alias(f"b{i}") for i, n in enumerate(numbers)]).first()
    ranges = [_range(n, found[f"b{i}"] or []) for i, n in enumerate(numbers)]
    placed = df.withColumn(_PLACE, _interleaved(ranges, bits))
    spread = F.xxhash64(*df.columns)
    return placed.repartitionByRange(files, F.col(_PLACE), spread).sortWithinPartitions(_PLACE, *columns).drop(_PLACE)


def _number(df: DataFrame, name: str) -> Column:
    """A number in the order of the column; of texts, their first bytes."""
    kind = df.schema[name].dataType
    if isinstance(kind, DateType):
        return F.unix_date(name).cast("double")
    if isinstance(kind, NumericType):
        return F.col(name).cast("double")
    if isinstance(kind, StringType):
        first = F.rpad(F.substring(F.hex(F.encode(name, "UTF-8")), 1, 12), 12, "0")
        return F.conv(first, 16, 10).cast("double")
    raise ValueError(f"{name} of type {kind.simpleString()} can't be clustered")


def _range(number: Column, bounds: Sequence[float]) -> Column:
    """How many of the bounds lie below; a null is in the first range."""
    below = [F.when(number > F.lit(bound), 1).otherwise(0) for bound in sorted(set(bounds))]
    return reduce(Column.__add__, below, F.lit(0)).cast("long")


def _interleaved(ranges: Sequence[Column], bits: int) -> Column:
    parts = [
        F.shiftleft(F.shiftright(number, bit).bitwiseAND(1), bit * len(ranges) + i)
        for i, number in enumerate(ranges)
        for bit in range(bits)
    ]
    return reduce(Column.bitwiseOR, parts)
