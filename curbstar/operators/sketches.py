"""Profiles that merge: one small row per part of a table and column, combined over any parts.

A part's row holds exact counts, the smallest and largest value, a sketch of its distinct values and one
of its frequent values. A new year's part is profiled alone; the others are not read again.

Distinct counts have a relative standard error of 1.04 / sqrt(2**PRECISION), 1.6 %. A frequent value's
count is exact while a column has fewer than three quarters of TRACKED values over all parts, and else
may miss up to about rows / (TRACKED / 4).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Base 2 logarithm of the registers of a distinct-count sketch.
PRECISION = 12
RELATIVE_ERROR = 1.04 / 2 ** (PRECISION / 2)
#: Values whose counts a frequent-value sketch keeps.
TRACKED = 4096


def column_sketches(df: DataFrame, columns: Sequence[str], part: Column) -> DataFrame:
    """part, column_name, row_count, value_count, smallest, largest, distinct_sketch, frequent_sketch."""
    texts = df.select(part.cast("string").alias("part"), *[F.col(c).cast("string").alias(c) for c in columns])
    melted = texts.unpivot(["part"], list(columns), "column_name", "value")
    return melted.groupBy("part", "column_name").agg(
        F.count("*").alias("row_count"),
        F.count("value").alias("value_count"),
        F.min("value").alias("smallest"),
        F.max("value").alias("largest"),
        F.hll_sketch_agg("value", F.lit(PRECISION)).alias("distinct_sketch"),
        F.expr(f"approx_top_k_accumulate(value, {TRACKED})").alias("frequent_sketch"),
    )


def merged_profile(sketches: DataFrame) -> DataFrame:
    """column_name, row_count, value_count, smallest, largest, distinct_estimate over all parts."""
    return sketches.groupBy("column_name").agg(
        F.sum("row_count").alias("row_count"),
        F.sum("value_count").alias("value_count"),
        F.min("smallest").alias("smallest"),
        F.max("largest").alias("largest"),
        F.coalesce(F.hll_sketch_estimate(F.hll_union_agg("distinct_sketch")), F.lit(0)).alias("distinct_estimate"),
    )


def merged_frequent_values(sketches: DataFrame, k: int) -> DataFrame:
    """column_name, value, n: the k most frequent values of each column over all parts; more where n ties."""
    combined = sketches.groupBy("column_name").agg(F.expr(f"approx_top_k_combine(frequent_sketch, {TRACKED})").alias("all"))
    items = combined.select("column_name", F.explode(F.expr(f"approx_top_k_estimate(all, {TRACKED})")).alias("x"))
    found = items.select("column_name", F.col("x.item").alias("value"), F.col("x.count").alias("n")).filter("value IS NOT NULL")
    least = found.groupBy("column_name").agg(F.array_sort(F.collect_list(-F.col("n"))).alias("counts"))
    least = least.select("column_name", (-F.get("counts", F.least(F.lit(k), F.size("counts")) - 1)).alias("least"))
    return found.join(least, "column_name").filter(F.col("n") >= F.col("least")).drop("least")
