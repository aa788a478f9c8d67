"""The two gates of a load: raw citations before stage 2, loaded tables after the star."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from curbstar.functions import values as V
from curbstar.operators import checks as C
from curbstar.sources.schemas import PRIMARY_KEYS


def raw_checks() -> list[C.Check]:
    return [
        C.min_percentage("plate_id", V.MIN_PLATE_PERCENTAGE),
        C.min_percentage("issue_date", V.MIN_ISSUE_DATE_PERCENTAGE),
    ]


def raw_gate(violations: DataFrame) -> DataFrame:
    """Report on raw citations: enough plates, and no missing issue date."""
    return C.run_checks(violations, raw_checks())


def loaded_gate(tables: Mapping[str, DataFrame]) -> DataFrame:
    """Report on the six tables of the star: none may be empty."""
    return C.union_reports(
        [C.run_checks(tables[name], [C.has_rows(f"{name}_has_rows")]) for name in PRIMARY_KEYS]
    )


def table_checks(names: Iterable[str]) -> dict[str, list[C.Check]]:
    """The checks of :func:`loaded_gate` by table, to be measured while each is written."""
    return {name: [C.has_rows(f"{name}_has_rows")] for name in names if name in PRIMARY_KEYS}


def key_gate(tables: Mapping[str, DataFrame]) -> DataFrame:
    """Optional report: declared keys are unique."""
    report = C.primary_key_report(tables, PRIMARY_KEYS)
    repeated = F.col("repeated_keys").cast("double")
    return report.select(
        F.concat("table_name", F.lit("_key_unique")).alias("check_name"),
        repeated.alias("value"),
        F.lit(0.0).alias("threshold"),
        (repeated == 0).alias("passed"),
    )
