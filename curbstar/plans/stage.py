"""Stage 2: one clean, denormalised row per citation."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from curbstar.functions import codes, dates, times
from curbstar.operators.lookup import Lookup, ReadyLookup
from curbstar.sources.schemas import STAGE2_VIOLATION, conform


def lookups(staging: Mapping[str, DataFrame]) -> list[Lookup]:
    """The seven code tables of the citations, by staging table name."""
    return [
        Lookup("stage_state", staging["stage_state"], "state_code"),
        Lookup("stage_vehicle_plate_type", staging["stage_vehicle_plate_type"], "code"),
        Lookup(
            "stage_violation_code", staging["stage_violation_code"], "code", fold_case=False
        ),
        Lookup("stage_vehicle_body_type", staging["stage_vehicle_body_type"], "code"),
        Lookup("stage_issuing_agency", staging["stage_issuing_agency"], "code"),
        Lookup("stage_county", staging["stage_county"], "code"),
        Lookup("stage_vehicle_color", staging["stage_vehicle_color"], "code"),
    ]


def with_plate(violations: DataFrame) -> DataFrame:
    """Citations that name a plate."""
    return violations.filter(F.col("plate_id").isNotNull())


def stage2_violation(
    violations: DataFrame,
    ready: Mapping[str, ReadyLookup],
    as_of_year: int,
    literal: bool = False,
) -> DataFrame:
    """Citations with a plate, a known state and a known plate type, cleaned and described.

    The lookups are broadcast when they measure small, so the citations are not shuffled.
    Cleaning is spread between the lookups: in one projection it would make a generated
    method too large for the JVM to compile.

    ``literal=True`` keeps two older outputs: the body type looked up by violation code, and
    code I on the opposite side of the street.
    """
    body_code = F.col("violation_code").cast("string") if literal else F.col("vehicle_body_type")

    rows = with_plate(violations)
    rows = ready["stage_state"].join(
        rows, F.col("registration_state"), {"description": "_state"}, "inner"
    )
    rows = ready["stage_vehicle_plate_type"].join(
        rows, F.col("plate_type"), {"type": "_plate_type"}, "inner"
    )
    rows = _clean_times(rows)
    rows = ready["stage_violation_code"].join(
        rows, F.col("violation_code"), {"code": "_violation_code"}
    )
    rows = ready["stage_vehicle_body_type"].join(rows, body_code, {"type": "_body_type"})
    rows = _clean_dates(rows, as_of_year)
    rows = ready["stage_issuing_agency"].join(
        rows, F.col("issuing_agency"), {"agency": "_agency"}
    )
    rows = ready["stage_county"].join(rows, F.col("violation_county"), {"county": "_county"})
    rows = _clean_place(rows, literal)
    rows = ready["stage_vehicle_color"].join(rows, F.col("vehicle_color"), {"color": "_color"})

    described = {
        "registration_state": F.col("_state"),
        "plate_type": F.col("_plate_type"),
        "violation_code": F.col("_violation_code"),
        "vehicle_body_type": F.col("_body_type"),
        "issuing_agency": F.col("_agency"),
        "violation_county": F.col("_county"),
        "vehicle_color": F.col("_color"),
    }
    columns = [
        described.get(name, F.col(name)).alias(name) for name in STAGE2_VIOLATION.names
    ]
    return conform(rows.select(*columns), STAGE2_VIOLATION)


def _clean_times(rows: DataFrame) -> DataFrame:
    names = ("violation_time", "time_first_observed")
    return rows.withColumns({name: times.normalize_time(F.col(name)) for name in names})


def _clean_dates(rows: DataFrame, as_of_year: int) -> DataFrame:
    return rows.withColumns(
        {
            "date_first_observed": dates.first_observed_date(
                F.col("date_first_observed"), F.col("issue_date")
            ),
            "vehicle_year": codes.valid_model_year(F.col("vehicle_year"), as_of_year),
        }
    )


def _clean_place(rows: DataFrame, literal: bool) -> DataFrame:
    unknown = {
        name: codes.or_unknown(F.col(name))
        for name in ("_county", "house_number", "street_name", "intersecting_street")
    }
    side = "violation_in_front_of_or_opposite"
    return rows.withColumns(
        unknown
        | {
            "violation_precinct": codes.fill_precinct(
                F.col("violation_precinct"), F.col("issuer_precinct")
            ),
            side: codes.front_or_opposite(F.col(side), literal),
        }
    )
