"""Last known values: per key, the latest value that is not null, column by column."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Stands for a missing date, which sorts after every date.
AFTER_ALL_DATES = 2**31 - 1


def event_order(date: Column, tie_break: Column) -> Column:
    """A total order of events: by date, a missing date last, then by ``tie_break``."""
    day = F.coalesce(F.unix_date(date), F.lit(AFTER_ALL_DATES))
    return F.struct(day.alias("day"), tie_break.alias("tie_break"))


def last_known(
    df: DataFrame,
    keys: Mapping[str, Column],
    order: Column,
    latest: Mapping[str, Column],
    fixed: Mapping[str, Column] | None = None,
) -> DataFrame:
    """One row per key with the latest non-null value of each column in ``latest``.

    ``fixed`` columns come from one row of the key, the smallest of them.

    This is an aggregate and not a window: each task reduces its rows to one per key before
    the shuffle, so a key that holds a large part of the table is never gathered and sorted
    in one task.
    """
    ordered = df.select(
        *[column.alias(name) for name, column in keys.items()],
        *[column.alias(f"_latest_{name}") for name, column in latest.items()],
        *[column.alias(f"_fixed_{name}") for name, column in (fixed or {}).items()],
        order.alias("_order"),
    )
    aggregates = [_latest(name).alias(name) for name in latest]
    if fixed:
        one_row = F.struct(*[F.col(f"_fixed_{name}").alias(name) for name in fixed])
        aggregates.append(F.min(one_row).alias("_fixed"))
    reduced = ordered.groupBy(*keys).agg(*aggregates)
    return reduced.select(
        *keys,
        *[F.col(f"_fixed.{name}").alias(name) for name in (fixed or {})],
        *latest,
    )


def _latest(name: str) -> Column:
    value = F.col(f"_latest_{name}")
    # A null order takes the row out of the maximum.
    return F.max_by(value, F.when(value.isNotNull(), F.col("_order")))


def last_state(
    df: DataFrame,
    keys: Mapping[str, Column],
    order: Column,
    latest: Mapping[str, Column],
    fixed: Mapping[str, Column] | None = None,
) -> DataFrame:
    """Like :func:`last_known`, but each latest column is a struct (order, value), or null.

    Such a state can be stored and merged with that of further rows. Of equal orders the larger
    value counts, so the order of merging doesn't matter.
    """
    ordered = df.select(
        *[column.alias(name) for name, column in keys.items()],
        *[F.when(column.isNotNull(), F.struct(order.alias("order"), column.alias("value"))).alias(name) for name, column in latest.items()],
        F.struct(*[column.alias(name) for name, column in (fixed or {}).items()]).alias("_fixed") if fixed else F.lit(None).alias("_fixed"),
    )
    reduced = ordered.groupBy(*keys).agg(F.min("_fixed").alias("_fixed"), *[F.max(name).alias(name) for name in latest])
    return reduced.select(*keys, *[F.col(f"_fixed.{name}").alias(name) for name in (fixed or {})], *latest)


def merged_state(
    state: DataFrame, further: DataFrame, keys: Sequence[str], latest: Sequence[str], fixed: Sequence[str] = ()
) -> DataFrame:
    """The state of the rows behind both, by one join on the keys; null is a key like others.

    Merging a small state into a large one shuffles each once, whatever number of rows they stand for.
    """
    old, new = state.alias("old"), further.alias("new")
    same = reduce(Column.__and__, [F.col(f"old.{key}").eqNullSafe(F.col(f"new.{key}")) for key in keys])
    here = {side: F.col(f"{side}._here").isNotNull() for side in ("old", "new")}
    joined = old.withColumn("_here", F.lit(1)).alias("old").join(new.withColumn("_here", F.lit(1)).alias("new"), same, "full")

    def one_of(name: str) -> Column:
        return F.when(here["old"], F.col(f"old.{name}")).otherwise(F.col(f"new.{name}"))

    rows = {side: F.when(here[side], F.struct(*[F.col(f"{side}.{name}").alias(name) for name in fixed])) for side in here} if fixed else {}
    smallest = F.least(*rows.values()) if fixed else None
    return joined.select(
        *[one_of(key).alias(key) for key in keys],
        *[smallest[name].alias(name) for name in fixed],
        *[F.greatest(F.col(f"old.{name}"), F.col(f"new.{name}")).alias(name) for name in latest],
    )


def values_of(state: DataFrame, keys: Sequence[str], latest: Sequence[str], fixed: Sequence[str] = ()) -> DataFrame:
    """The last known values that a state holds; the result of :func:`last_known`."""
    return state.select(*keys, *fixed, *[F.col(f"{name}.value").alias(name) for name in latest])
