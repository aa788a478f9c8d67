"""Digests of tables that do not depend on the order of rows: a count and two wide sums of row hashes.

Digests of parts of a table add up to the table's, so a load that adds rows needs not read the others.
"""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from curbstar.operators.observe import observed

NAMES = ("row_count", "sum_a", "sum_b")
#: Hexadecimal digits of a row's hash in each sum.
_DIGITS = 15
_HASH = "_row_hash"


def row_hash(columns: list[str]) -> Column:
    """A hash of all columns in their order. Each value stands with its length, a null as a sign of its own."""
    texts = [F.col(f"`{name}`").cast("string") for name in columns]
    parts = [F.coalesce(F.concat(F.length(t).cast("string"), F.lit(":"), t), F.lit("-")) for t in texts]
    return F.md5(F.concat(*parts))


def _metrics(hashed: Column) -> dict[str, Column]:
    def total(start: int) -> Column:
        number = F.conv(F.substr(hashed, F.lit(start), F.lit(_DIGITS)), 16, 10).cast("decimal(20,0)")
        return F.coalesce(F.sum(number).cast("decimal(38,0)"), F.lit(0)).cast("string")

    return {"row_count": F.count("*"), "sum_a": total(1), "sum_b": total(1 + _DIGITS)}


def digest_report(tables: Mapping[str, DataFrame]) -> DataFrame:
    """One row per table: table_name, row_count, sum_a, sum_b; a scan each."""
    rows = [
        df.select(row_hash(df.columns).alias(_HASH)).agg(
            F.lit(name).alias("table_name"), *[metric.alias(n) for n, metric in _metrics(F.col(_HASH)).items()]
        )
        for name, df in tables.items()
    ]
    return reduce(DataFrame.unionAll, rows)


def digested(df: DataFrame):
    """``df`` that measures its digest while it is written, and a function that gives it afterwards."""
    with_hash, metrics = observed(df.withColumn(_HASH, row_hash(df.columns)), _metrics(F.col(_HASH)))

    def digest() -> dict[str, str] | None:
        found = metrics()
        return found and {name: str(found[name]) for name in NAMES}

    return with_hash.drop(_HASH), digest


def sum_of(digests: list[dict[str, str]]) -> dict[str, str]:
    """The digest of several tables' rows together."""
    return {name: str(sum(int(d[name]) for d in digests)) for name in NAMES}
