"""Declared tables. Column names, order and types are fixed values."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql.types import (
    DataType,
    DateType,
    DoubleType,
    IntegerType,
    StringType,
    StructField,
    StructType,
)

_TYPES: dict[str, DataType] = {
    "s": StringType(),
    "i": IntegerType(),
    "f": DoubleType(),
    "d": DateType(),
}


def _table(columns: str) -> StructType:
    pairs = [entry.split() for entry in columns.replace("\n", " ").split(",") if entry.strip()]
    return StructType([StructField(name, _TYPES[kind]) for name, kind in pairs])


# --- Fixed values: staging ----------------------------------------------------------------

STAGE_STATE = _table("record_type s, state_code s, description s")
STAGE_VIOLATION_CODE = _table("code i, description s, manhattan_amount f, others_amount f")
STAGE_VEHICLE_BODY_TYPE = _table("code s, type s")
STAGE_VEHICLE_PLATE_TYPE = _table("code s, type s")
STAGE_VEHICLE_COLOR = _table("code s, color s")
STAGE_COUNTY = _table("code s, county s")
STAGE_ISSUING_AGENCY = _table("code s, agency s")
STAGE_VIOLATION = _table(
    """
    summons_number s, plate_id s, registration_state s, plate_type s, issue_date d,
    violation_code i, vehicle_body_type s, vehicle_make s, issuing_agency s, street_code1 i,
    street_code2 i, street_code3 i, vehicle_expiration_date d, violation_location s,
    violation_precinct i, issuer_precinct i, issuer_code i, issuer_command s, issuer_squad s,
    violation_time s, time_first_observed s, violation_county s,
    violation_in_front_of_or_opposite s, house_number s, street_name s, intersecting_street s,
    date_first_observed s, law_section s, sub_division s, violation_legal_code s,
    days_parking_in_effect s, from_hours_in_effect s, to_hours_in_effect s, vehicle_color s,
    unregistered_vehicle s, vehicle_year i, meter_number s, feet_from_curb i,
    violation_post_code s, violation_description s, no_standing_or_stopping_violation s,
    hydrant_violation s, double_parking_violation s
    """
)

# --- Fixed values: second stage and star --------------------------------------------------

STAGE2_VIOLATION = _table(
    """
    summons_number s, plate_id s, registration_state s, plate_type s, issue_date d,
    violation_code i, vehicle_body_type s, vehicle_make s, issuing_agency s, street_code1 i,
    street_code2 i, street_code3 i, vehicle_expiration_date d, violation_precinct i,
    violation_time s, time_first_observed s, violation_county s,
    violation_in_front_of_or_opposite s, house_number s, street_name s, intersecting_street s,
    date_first_observed d, law_section s, sub_division s, vehicle_color s, vehicle_year i
    """
)
VEHICLE = _table(
    """
    id s, plate_id s, registration_state s, plate_type s, body_type s, maker s,
    expiration_date d, color s, make_year i
    """
)
VIOLATION_CODE = _table("code i, description s, manhattan_amount f, others_amount f")
DATE = _table("date d, day i, month i, year i")
TIME = _table("time i, minutes i, hours i")
LOCATION = _table(
    """
    id s, street_code1 i, street_code2 i, street_code3 i, street_name s,
    intersecting_street s, precinct i, county s, house_number s
    """
)
VIOLATION = _table(
    """
    summons_number s, vehicle s, violation_code i, issue_date d, violation_time i,
    time_first_observed i, date_first_observed d, location s, issuing_agency s,
    in_front_of_or_opposite s, law_section s, sub_division s
    """
)

# Key column of each star table, and the references of the fact table.
PRIMARY_KEYS = {
    "violation_code": "code",
    "date": "date",
    "time": "time",
    "location": "id",
    "vehicle": "id",
    "violation": "summons_number",
}
REFERENCES = {
    "vehicle": ("vehicle", "id"),
    "violation_code": ("violation_code", "code"),
    "issue_date": ("date", "date"),
    "violation_time": ("time", "time"),
    "time_first_observed": ("time", "time"),
    "date_first_observed": ("date", "date"),
    "location": ("location", "id"),
}

# ------------------------------------------------------------------------------------------

STAGING = {
    "stage_state": STAGE_STATE,
    "stage_violation_code": STAGE_VIOLATION_CODE,
    "stage_vehicle_body_type": STAGE_VEHICLE_BODY_TYPE,
    "stage_vehicle_plate_type": STAGE_VEHICLE_PLATE_TYPE,
    "stage_vehicle_color": STAGE_VEHICLE_COLOR,
    "stage_county": STAGE_COUNTY,
    "stage_issuing_agency": STAGE_ISSUING_AGENCY,
    "stage_violation": STAGE_VIOLATION,
}
STAR = {
    "violation_code": VIOLATION_CODE,
    "date": DATE,
    "time": TIME,
    "location": LOCATION,
    "vehicle": VEHICLE,
    "violation": VIOLATION,
}
TABLES = {**STAGING, "stage2_violation": STAGE2_VIOLATION, **STAR}


@dataclass(frozen=True)
class SchemaDifference:
    column: str
    declared: str | None
    found: str | None


def schema_differences(df: DataFrame, declared: StructType) -> list[SchemaDifference]:
    """Columns that are missing, extra, or of another type; nullability is not compared."""
    want = {field.name: field.dataType.simpleString() for field in declared}
    have = {field.name: field.dataType.simpleString() for field in df.schema}
    names = list(want) + [name for name in have if name not in want]
    return [
        SchemaDifference(name, want.get(name), have.get(name))
        for name in names
        if want.get(name) != have.get(name)
    ]


def conform(df: DataFrame, declared: StructType) -> DataFrame:
    """The declared columns in declared order, bound by name; raises on any difference."""
    differences = schema_differences(df, declared)
    if differences:
        raise ValueError(f"Table differs from its declaration: {differences}")
    return df.select(*declared.names)
