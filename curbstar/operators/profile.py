"""Column profiling: each report is one scan with partial aggregation."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from curbstar.functions import times
from curbstar.operators.keyed import code_counts


def measure(df: DataFrame, label: str, rows: Mapping[str, Mapping[str, Column]]) -> DataFrame:
    """One aggregate over ``df``, unpivoted: a row per label with its measures as columns.

    The aggregates in ``rows`` must have the same names and types for every label.
    """
    named = {
        f"_{i}_{metric}": column
        for i, metrics in enumerate(rows.values())
        for metric, column in metrics.items()
    }
    totals = df.agg(*[column.alias(name) for name, column in named.items()])
    entries = [
        F.struct(
            F.lit(name).alias(label),
            *[F.col(f"_{i}_{metric}").alias(metric) for metric in metrics],
        )
        for i, (name, metrics) in enumerate(rows.items())
    ]
    return totals.select(F.inline(F.array(*entries)))


def profile_columns(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Rows, nulls, values and any-null of every column."""
    columns = list(columns or df.columns)
    counted = measure(
        df,
        "column_name",
        {c: {"row_count": F.count("*"), "value_count": F.count(F.col(c))} for c in columns},
    )
    nulls = F.col("row_count") - F.col("value_count")
    return counted.select(
        "column_name",
        "row_count",
        "value_count",
        nulls.alias("null_count"),
        (nulls > 0).alias("any_null"),
    )


def sentinel_counts(df: DataFrame, sentinels: Mapping[str, Column]) -> DataFrame:
    """Rows in which a column holds the value that stands for missing."""
    return measure(
        df,
        "column_name",
        {c: {"sentinel_count": F.count_if(F.col(c) == value)} for c, value in sentinels.items()},
    )


def duplicate_profile(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Distinct values and repeats (rows beyond the first of a value) of each column."""
    per_column = code_counts(df, columns).groupBy("column_name").agg(
        F.count("*").alias("distinct_count"), F.sum(F.col("n") - 1).alias("repeat_count")
    )
    return per_column.withColumn("any_duplicate", F.col("repeat_count") > 0)


def value_counts(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Frequency of the values of each column, most frequent first; nulls left out."""
    counted = code_counts(df, columns).withColumnRenamed("code", "value")
    return counted.filter(F.col("value").isNotNull()).orderBy(
        "column_name", F.desc("n"), "value"
    )


def distinct_values(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Distinct values of each column; null is one value."""
    return code_counts(df, columns).select("column_name", F.col("code").alias("value"))


def distinct_attributes(
    df: DataFrame, columns: Sequence[str], required: Sequence[str] = ()
) -> DataFrame:
    """Distinct combinations of the columns, without rows that lack a required one."""
    rows = df.select(*columns)
    if required:
        rows = rows.dropna(subset=list(required))
    return rows.distinct()


def rows_where_null(df: DataFrame, column: str) -> DataFrame:
    return df.filter(F.col(column).isNull())


def rows_where_not_null(df: DataFrame, column: str) -> DataFrame:
    return df.filter(F.col(column).isNotNull())


def agreement(df: DataFrame, pairs: Mapping[str, tuple[Column, Column]]) -> DataFrame:
    """For each pair of columns: rows with a first value, and rows in which both agree."""
    return measure(
        df,
        "pair",
        {
            name: {"value_count": F.count(left), "equal_count": F.count_if(left == right)}
            for name, (left, right) in pairs.items()
        },
    )


def all_match(df: DataFrame, checks: Mapping[str, tuple[Column, Column, str]]) -> DataFrame:
    """Whether every value of a column outside its sentinel matches a pattern.

    Null values are passed over. Without any value the answer is true.
    """
    return measure(
        df,
        "column_name",
        {
            name: {
                "all_match": F.coalesce(
                    F.bool_and(F.when(column != sentinel, column.rlike(pattern))), F.lit(True)
                ),
                "checked_count": F.count_if(column != sentinel),
            }
            for name, (column, sentinel, pattern) in checks.items()
        },
    )


def out_of_range_counts(df: DataFrame, outside: Mapping[str, Column]) -> DataFrame:
    """Rows for which the condition of a column, true when out of range, holds."""
    return measure(
        df,
        "column_name",
        {name: {"out_of_range_count": F.count_if(test)} for name, test in outside.items()},
    )


def unparsed_values(df: DataFrame, parsed: Mapping[str, Column]) -> DataFrame:
    """Values of each text column whose parse is null, with their rows."""
    flagged = df.select(
        *[
            F.when(F.col(c).isNotNull() & result.isNull(), F.col(c)).alias(c)
            for c, result in parsed.items()
        ]
    )
    counted = code_counts(flagged, parsed).withColumnRenamed("code", "bad_value")
    return counted.filter(F.col("bad_value").isNotNull())


def parsed_totals(df: DataFrame, parsed: Mapping[str, Column]) -> DataFrame:
    """Per text column: values that parse, and values that do not."""
    return measure(
        df,
        "column_name",
        {
            c: {
                "parsed_count": F.count(result),
                "unparsed_count": F.count_if(F.col(c).isNotNull() & result.isNull()),
            }
            for c, result in parsed.items()
        },
    )


def bad_time_counts(df: DataFrame, fill_from: Mapping[str, str]) -> DataFrame:
    """Times that stay unreadable: as 12-hour time, after the 24-hour repair, after a fill.

    ``fill_from`` maps a column to the one that stands in for it. Null counts as unreadable.
    """

    def unread(test: Column) -> Column:
        return ~F.coalesce(test, F.lit(False))

    def repaired(name: str) -> Column:
        raw = F.col(name)
        return F.coalesce(times.parses_on_12_hour_clock(raw), F.lit(False)) | F.coalesce(
            times.parses_on_24_hour_clock(raw), F.lit(False)
        )

    return measure(
        df,
        "column_name",
        {
            c: {
                "bad_12_hour": F.count_if(unread(times.parses_on_12_hour_clock(F.col(c)))),
                "bad_after_repair": F.count_if(unread(repaired(c))),
                "bad_after_fill": F.count_if(unread(repaired(c) | repaired(other))),
            }
            for c, other in fill_from.items()
        },
    )


def head(df: DataFrame, order: Sequence[Column], n: int = 5) -> DataFrame:
    """The first ``n`` rows in ``order``, which must be total for a repeatable answer."""
    return df.orderBy(*order).limit(n)
