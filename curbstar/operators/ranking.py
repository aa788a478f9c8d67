"""Rankings of a fact table by attributes of a dimension."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def rank_by_dimension(
    fact: DataFrame,
    reference: str,
    dimension: DataFrame,
    key: str,
    attributes: Mapping[str, Column],
    k: int | None = None,
) -> DataFrame:
    """Fact rows per attributes of a dimension, most first: the attributes and ``n``.

    Fact rows are counted per key before the join, so a key that many rows share is one row
    in it. Rows without a dimension row stay, under null attributes. With ``k`` only the
    first k are kept; ties are broken by the attributes.
    """
    counted = fact.groupBy(F.col(reference).alias("_reference")).agg(F.count("*").alias("_n"))
    described = dimension.select(
        F.col(key).alias("_key"), *[c.alias(name) for name, c in attributes.items()]
    )
    joined = counted.join(described, F.col("_reference") == F.col("_key"), "left")
    ranked = joined.groupBy(*attributes).agg(F.sum("_n").alias("n"))
    ranked = ranked.orderBy(F.desc("n"), *[F.asc_nulls_first(name) for name in attributes])
    return ranked if k is None else ranked.limit(k)
