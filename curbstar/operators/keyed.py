"""Rows by key: a representative per key, distinct values, repeats, frequencies."""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def one_row_per_key(df: DataFrame, key: str, attributes: Sequence[str]) -> DataFrame:
    """One row per key: its smallest combination of attributes. Keyless rows all stay.

    Rows without a key are told apart by their attributes, so they spread over partitions
    instead of meeting in the one of the null key.
    """
    row = F.struct(*attributes)
    keyless = F.when(F.col(key).isNull(), row).alias("_keyless")
    reduced = df.groupBy(F.col(key), keyless).agg(F.min(row).alias("_row"))
    return reduced.select(key, *[F.col(f"_row.{name}").alias(name) for name in attributes])


def union_distinct(df: DataFrame, columns: Sequence[Column], name: str) -> DataFrame:
    """Distinct values of all the columns together, in one scan; null is a value."""
    return df.select(F.explode(F.array(*columns)).alias(name)).distinct()


def repeated_key_rows(df: DataFrame, key: Sequence[str]) -> DataFrame:
    """All rows whose key occurs more than once; null counts as one value.

    Keys are counted with partial aggregation and joined back, so no key's rows have to
    fit one task.
    """
    counted = df.groupBy(*[F.col(name).alias(f"_{name}") for name in key]).agg(
        F.count("*").alias("_n")
    )
    repeated = counted.filter(F.col("_n") > 1)
    same = reduce(
        Column.__and__, [F.col(name).eqNullSafe(F.col(f"_{name}")) for name in key]
    )
    return df.join(repeated, same, "left_semi")


def code_counts(df: DataFrame, columns: Iterable[str]) -> DataFrame:
    """Rows per value of each column: column_name, code, n. Null is a value of its own.

    One scan; values are counted before the shuffle, so a frequent code moves as one row
    per task.
    """
    columns = list(columns)
    texts = df.select(*[F.col(c).cast("string").alias(c) for c in columns])
    melted = texts.unpivot([], columns, "column_name", "code")
    return melted.groupBy("column_name", "code").agg(F.count("*").alias("n"))
