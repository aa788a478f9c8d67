"""Quality checks: named aggregates with a pass condition, reported and enforced."""

from __future__ import annotations

import logging
from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F

from curbstar.operators.profile import measure

LOG = logging.getLogger(__name__)
REPORT_SCHEMA = "check_name string, value double, threshold double, passed boolean"


class DataQualityError(ValueError):
    """A check failed."""


@dataclass(frozen=True)
class Check:
    """A measured aggregate and the condition it must meet; a null measure fails."""

    name: str
    value: Column
    passes: Callable[[Column], Column]
    threshold: float | None = None


def has_rows(name: str = "has_rows") -> Check:
    return Check(name, F.count("*"), lambda value: value > 0, 0)


def min_percentage(column: str, minimum: float = 100) -> Check:
    """At least ``minimum`` percent of the column is not null."""
    return Check(
        f"{column}_not_null_percentage",
        non_null_percentage(column),
        lambda value: value >= minimum,
        minimum,
    )


def non_null_percentage(column: str, literal: bool = False) -> Column:
    """Percent of rows with a value; null on an empty table.

    ``literal=True`` keeps the older output, which divides whole numbers first and so knows
    only 0 and 100.
    """
    values, rows = F.count(F.col(column)), F.count("*")
    if literal:
        return F.floor(F.try_divide(values, rows)).cast("bigint") * 100
    return F.try_divide(values.cast("double") * 100, rows)


def run_checks(df: DataFrame, checks: Sequence[Check]) -> DataFrame:
    """All checks of one table in one scan: check_name, value, threshold, passed."""
    rows = {
        check.name: {
            "value": check.value.cast("double"),
            "threshold": F.lit(check.threshold).cast("double"),
            "passed": F.coalesce(check.passes(check.value), F.lit(False)),
        }
        for check in checks
    }
    if len(rows) != len(checks):
        raise ValueError("Two checks share a name")
    return measure(df, "check_name", rows)


def union_reports(reports: Sequence[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, reports)


def enforce(report: DataFrame) -> list[Row]:
    """Bring a report (a row per check) to the driver; raise at the first failed check."""
    rows = report.collect()
    enforce_rows([(r["check_name"], r["value"], r["threshold"], r["passed"]) for r in rows])
    return rows


def enforce_rows(rows: Sequence[tuple]) -> None:
    """Raise at the first failed check of a report that is on the driver."""
    for name, value, threshold, passed in rows:
        if not passed:
            raise DataQualityError(f"Check {name} failed: value {value}, threshold {threshold}")
        LOG.info("Check %s passed: %s", name, value)


@dataclass(frozen=True)
class Statement:
    """A query whose records must all meet a condition.

    ``condition`` is an expression over the columns of the result; null counts as unmet.
    ``records`` is how many there must be, None for any number above zero.
    """

    name: str
    sql: str
    condition: str
    records: int | None = 1


def statement_report(
    spark: SparkSession, statement: Statement, tables: Mapping[str, DataFrame] | None = None
) -> DataFrame:
    """One row: check_name, records, unmet, passed. Records are counted where they are made.

    The query names the given ``tables`` in braces, as in ``SELECT count(*) FROM {violation}``.
    """
    found = spark.sql(statement.sql, **(tables or {})).agg(
        F.count("*").alias("records"),
        F.count_if(~F.coalesce(F.expr(statement.condition), F.lit(False))).alias("unmet"),
    )
    number = F.col("records")
    enough = number > 0 if statement.records is None else number == statement.records
    return found.select(
        F.lit(statement.name).alias("check_name"),
        number,
        "unmet",
        (enough & (F.col("unmet") == 0)).alias("passed"),
    )


def enforce_in_order(
    spark: SparkSession,
    statements: Sequence[Statement],
    tables: Mapping[str, DataFrame] | None = None,
) -> None:
    """Evaluate statements one by one and raise at the first that fails; later ones do not run."""
    for statement in statements:
        result = statement_report(spark, statement, tables).first()
        if not result["passed"]:
            raise DataQualityError(
                f"Check {statement.name} failed: {result['unmet']} of {result['records']} "
                f"records unmet, expected {statement.records or 'some'}: {statement.sql}"
            )
        LOG.info("Check %s passed", statement.name)


def row_counts(tables: Mapping[str, DataFrame]) -> DataFrame:
    """Rows per table: table_name, row_count."""
    return reduce(
        DataFrame.unionAll,
        [
            table.agg(F.lit(name).alias("table_name"), F.count("*").alias("row_count"))
            for name, table in tables.items()
        ],
    )


def primary_key_report(tables: Mapping[str, DataFrame], keys: Mapping[str, str]) -> DataFrame:
    """Per table: keys that occur more than once, the rows beyond the first, null keys.

    The keys of all tables are counted in one shuffle, each table reduced before it.
    """
    spark = next(iter(tables.values())).sparkSession
    every = reduce(
        DataFrame.unionAll,
        [
            tables[name].select(F.lit(name).alias("table_name"), F.col(key).cast("string").alias("_key"))
            for name, key in keys.items()
        ],
    )
    counted = every.groupBy("table_name", "_key").agg(F.count("*").alias("n"))
    present = F.col("_key").isNotNull()
    found = counted.groupBy("table_name").agg(
        F.count_if(present & (F.col("n") > 1)).alias("repeated_keys"),
        F.sum(F.when(present, F.col("n") - 1)).alias("surplus_rows"),
        F.sum(F.when(~present, F.col("n"))).alias("null_keys"),
    )
    named = spark.createDataFrame(list(keys.items()), "table_name string, key_column string")
    numbers = ("repeated_keys", "surplus_rows", "null_keys")
    return named.join(found, "table_name", "left").select(
        "table_name", "key_column", *[F.coalesce(n, F.lit(0)).alias(n) for n in numbers]
    )


def null_key_report(tables: Mapping[str, DataFrame], keys: Mapping[str, Sequence[str]]) -> DataFrame:
    """Rows per table and key column in which the key is null."""
    reports = [
        measure(
            tables[name],
            "key_column",
            {key: {"null_keys": F.count_if(F.col(key).isNull())} for key in columns},
        ).select(F.lit(name).alias("table_name"), "key_column", "null_keys")
        for name, columns in keys.items()
    ]
    return reduce(DataFrame.unionAll, reports)


def reference_report(
    fact: DataFrame,
    dimensions: Mapping[str, DataFrame],
    references: Mapping[str, tuple[str, str]],
) -> DataFrame:
    """Per reference: fact keys that their dimension lacks, and the fact rows with them.

    The fact is read once, and its rows are counted per reference and key before the one join, so
    a frequent key is one row in it.
    """
    spark = fact.sparkSession
    uses = [
        F.struct(F.lit(column).alias("fact_column"), F.col(column).cast("string").alias("_key"))
        for column in references
    ]
    used = fact.select(F.explode(F.array(*uses)).alias("use")).select("use.*")
    used = used.filter(F.col("_key").isNotNull())
    used = used.groupBy("fact_column", "_key").agg(F.count("*").alias("n"))
    known = reduce(
        DataFrame.unionAll,
        [
            dimensions[dimension].select(
                F.lit(column).alias("fact_column"), F.col(key).cast("string").alias("_key")
            )
            for column, (dimension, key) in references.items()
        ],
    )
    orphans = used.join(known, ["fact_column", "_key"], "left_anti")
    found = orphans.groupBy("fact_column").agg(
        F.count("*").alias("orphan_keys"), F.sum("n").alias("orphan_rows")
    )
    named = spark.createDataFrame(
        [(column, dimension) for column, (dimension, _) in references.items()],
        "fact_column string, dimension string",
    )
    return named.join(found, "fact_column", "left").select(
        "fact_column",
        "dimension",
        *[F.coalesce(n, F.lit(0)).alias(n) for n in ("orphan_keys", "orphan_rows")],
    )


def orphan_report(fact: DataFrame, column: str, dimension: DataFrame, key: str) -> DataFrame:
    """One row for one reference: fact_column, orphan_keys, orphan_rows.

    Keys keep their type, so tables in matching buckets are compared without a shuffle.
    """
    used = fact.filter(F.col(column).isNotNull()).groupBy(F.col(column).alias("_used")).agg(F.count("*").alias("n"))
    known = dimension.select(F.col(key).alias("_known"))
    orphans = used.join(known, F.col("_used") == F.col("_known"), "left_anti")
    return orphans.agg(
        F.lit(column).alias("fact_column"),
        F.count("*").alias("orphan_keys"),
        F.coalesce(F.sum("n"), F.lit(0)).alias("orphan_rows"),
    )
