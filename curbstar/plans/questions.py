"""The questions the star answers: when, what and where most citations happen."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from curbstar.operators.ranking import rank_by_dimension


def top_months(fact: DataFrame, date: DataFrame, k: int | None = None) -> DataFrame:
    return rank_by_dimension(fact, "issue_date", date, "date", {"month": F.col("month")}, k)


def top_hours(fact: DataFrame, time: DataFrame, k: int | None = None) -> DataFrame:
    return rank_by_dimension(fact, "violation_time", time, "time", {"hour": F.col("hours")}, k)


def top_vehicle_types(fact: DataFrame, vehicle: DataFrame, k: int | None = None) -> DataFrame:
    return rank_by_dimension(
        fact, "vehicle", vehicle, "id", {"body_type": F.col("body_type")}, k
    )


def top_places(fact: DataFrame, location: DataFrame, k: int | None = None) -> DataFrame:
    """Places by county, precinct and street; the street in upper case, as in its key."""
    place = {
        "county": F.col("county"),
        "precinct": F.col("precinct"),
        "street_name": F.upper("street_name"),
    }
    return rank_by_dimension(fact, "location", location, "id", place, k)
