"""Lookup joins: one large table against code tables whose size is measured first."""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from curbstar.operators.keyed import code_counts

# Largest measured lookup that is sent to every executor.
BROADCAST_LIMIT_BYTES = 64 * 1024 * 1024
# Fixed part of a row held in a hash relation, beside its text.
ROW_OVERHEAD_BYTES = 96


class DuplicateLookupKeys(ValueError):
    """A code occurs more than once in a lookup, so a join would multiply rows."""


@dataclass(frozen=True)
class Lookup:
    """A code table: ``key`` is matched, all other columns may be taken over."""

    name: str
    table: DataFrame
    key: str
    fold_case: bool = True

    def keyed(self) -> DataFrame:
        """The table with its folded key as ``_key``; rows without a key match nothing."""
        rows = self.table.filter(F.col(self.key).isNotNull())
        return rows.withColumn("_key", self.fold(F.col(self.key)))

    def fold(self, code: Column) -> Column:
        return F.upper(code) if self.fold_case else code


@dataclass(frozen=True)
class ReadyLookup:
    """A lookup with unique keys and a decision on how to join it."""

    lookup: Lookup
    rows: int
    size_bytes: int
    broadcast: bool

    def join(
        self,
        df: DataFrame,
        code: Column,
        take: Mapping[str, str],
        how: str = "left",
    ) -> DataFrame:
        """``df`` plus the columns in ``take`` (lookup column → new column).

        A lookup beyond the broadcast limit is left to a shuffle join, where adaptive
        execution splits the partition of a code that many rows share.
        """
        right = self.lookup.keyed().select(
            "_key", *[F.col(column).alias(alias) for column, alias in take.items()]
        )
        if self.broadcast:
            right = F.broadcast(right)
        return df.join(right, self.lookup.fold(code) == F.col("_key"), how).drop("_key")


def prepare_lookups(
    lookups: Iterable[Lookup], broadcast_limit_bytes: int = BROADCAST_LIMIT_BYTES
) -> dict[str, ReadyLookup]:
    """Measure all lookups in one job; raise when a code occurs twice.

    The smallest are broadcast, as far as all of them together stay within the limit.
    """
    lookups = list(lookups)
    measured = {row["name"]: row for row in lookup_sizes(lookups).collect()}
    doubled = [name for name, row in measured.items() if row["rows"] > row["codes"]]
    if doubled:
        raise DuplicateLookupKeys(f"Codes occur more than once in: {', '.join(doubled)}")
    none = {"rows": 0, "bytes": 0}
    sizes = {lookup.name: measured.get(lookup.name, none) for lookup in lookups}
    sent, total = set(), 0
    for name in sorted(sizes, key=lambda name: sizes[name]["bytes"]):
        total += sizes[name]["bytes"]
        if total <= broadcast_limit_bytes:
            sent.add(name)
    return {
        lookup.name: ReadyLookup(
            lookup, sizes[lookup.name]["rows"], sizes[lookup.name]["bytes"], lookup.name in sent
        )
        for lookup in lookups
    }


def lookup_sizes(lookups: Iterable[Lookup]) -> DataFrame:
    """One row per lookup that has rows: name, rows, distinct codes, bytes in memory."""
    codes = reduce(DataFrame.unionAll, [_code_sizes(lookup) for lookup in lookups])
    per_code = codes.groupBy("name", "_key").agg(
        F.count("*").alias("copies"), F.sum("bytes").alias("bytes")
    )
    return per_code.groupBy("name").agg(
        F.sum("copies").alias("rows"), F.count("*").alias("codes"), F.sum("bytes").alias("bytes")
    )


def _code_sizes(lookup: Lookup) -> DataFrame:
    keyed = lookup.keyed()
    text = [F.coalesce(F.octet_length(F.col(c).cast("string")), F.lit(0)) for c in keyed.columns]
    return keyed.select(
        F.lit(lookup.name).alias("name"),
        F.col("_key").cast("string").alias("_key"),
        reduce(Column.__add__, text, F.lit(ROW_OVERHEAD_BYTES)).alias("bytes"),
    )


def unmatched(
    df: DataFrame, lookups: Mapping[str, tuple[Lookup, str]]
) -> DataFrame:
    """Codes without a description, with their rows: column_name, code, n.

    ``lookups`` maps a column to its lookup and description column. Codes are counted
    first, so only distinct codes meet the lookups. A null code is unmatched, and so is a
    code whose description is null.
    """
    catalogue = reduce(
        DataFrame.unionAll,
        [
            lookup.keyed().select(
                F.lit(column).alias("column_name"),
                F.col("_key").cast("string").alias("_key"),
                F.col(description).alias("description"),
            )
            for column, (lookup, description) in lookups.items()
        ],
    ).filter(F.col("description").isNotNull())
    folding = [column for column, (lookup, _) in lookups.items() if lookup.fold_case]
    codes = code_counts(df, lookups).withColumn(
        "_key",
        F.when(F.col("column_name").isin(*folding), F.upper("code")).otherwise(F.col("code"))
        if folding
        else F.col("code"),
    )
    return codes.join(catalogue, ["column_name", "_key"], "left_anti").select(
        "column_name", "code", "n"
    )


def unmatched_totals(unmatched_codes: DataFrame) -> DataFrame:
    """Per column: how many codes and how many rows are unmatched."""
    return unmatched_codes.groupBy("column_name").agg(
        F.count("*").alias("unmatched_codes"), F.sum("n").alias("unmatched_rows")
    )
