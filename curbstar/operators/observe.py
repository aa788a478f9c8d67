"""Aggregates that are measured while a table is written, without another scan."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from typing import Any

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from curbstar.operators.checks import REPORT_SCHEMA, Check


def observed(df: DataFrame, metrics: Mapping[str, Column]) -> tuple[DataFrame, Callable[[], dict[str, Any] | None]]:
    """``df`` that measures ``metrics`` in the first action on it, and a function that gives them then.

    The function gives None where the action measured nothing, as when the planner knew the result
    to be empty. Put it directly above what is written: a shuffle above it could count a repeated
    task twice.
    """
    observation = Observation()
    out = df.observe(observation, *[metric.alias(name) for name, metric in metrics.items()])
    return out, lambda: observation.get or None


def checked(df: DataFrame, checks: Sequence[Check]) -> tuple[DataFrame, Callable[[], list[tuple] | None]]:
    """``df`` that evaluates checks while it is written, and a function that gives the report's rows."""
    if not checks:
        return df, list
    metrics: dict[str, Column] = {}
    for i, check in enumerate(checks):
        metrics[f"value_{i}"] = check.value.cast("double")
        metrics[f"passed_{i}"] = F.coalesce(check.passes(check.value), F.lit(False))
    out, found = observed(df, metrics)

    def rows() -> list[tuple] | None:
        measured = found()
        if measured is None:
            return None
        return [
            (c.name, measured[f"value_{i}"], None if c.threshold is None else float(c.threshold), measured[f"passed_{i}"])
            for i, c in enumerate(checks)
        ]

    return out, rows


def report_of(spark: SparkSession, rows: Sequence[tuple]) -> DataFrame:
    """Rows of :func:`checked` in the form of ``checks.run_checks``."""
    return spark.createDataFrame(list(rows), REPORT_SCHEMA)
