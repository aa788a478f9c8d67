"""The star: five dimensions and the fact table, each from stage 2."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from curbstar.functions import codes, keys, times
from curbstar.functions import values as V
from curbstar.operators.keyed import one_row_per_key, union_distinct
from curbstar.operators.latest import event_order, last_known, last_state, merged_state, values_of
from curbstar.sources import schemas as S
from curbstar.sources.schemas import conform

PLACE_COLUMNS = (
    "street_code1",
    "street_code2",
    "street_code3",
    "street_name",
    "intersecting_street",
    "violation_precinct",
    "violation_county",
    "house_number",
)


def violation_code_dimension(violation_codes: DataFrame) -> DataFrame:
    """Distinct rows of the code table."""
    return conform(violation_codes.distinct(), S.VIOLATION_CODE)


def date_dimension(stage2: DataFrame) -> DataFrame:
    """Every issue date and first-observed date with its parts."""
    days = union_distinct(
        stage2, [F.col("issue_date"), F.col("date_first_observed")], "date"
    ).filter(F.col("date").isNotNull())
    parts = days.select(
        "date",
        F.dayofmonth("date").alias("day"),
        F.month("date").alias("month"),
        F.year("date").alias("year"),
    )
    return conform(parts, S.DATE)


def time_dimension(stage2: DataFrame, literal: bool = False) -> DataFrame:
    """Every time of day in the fact table, in minutes, with its parts."""
    of_citation, of_observation = _fact_minutes(literal)
    minutes = union_distinct(stage2, [of_citation, of_observation], "time").filter(
        F.col("time").isNotNull()
    )
    parts = minutes.select(
        "time",
        (F.col("time") % 60).alias("minutes"),
        F.expr("CAST(time DIV 60 AS INT)").alias("hours"),
    )
    return conform(parts, S.TIME)


def location_dimension(stage2: DataFrame) -> DataFrame:
    """One row per place key.

    Equal places are merged by a hash aggregate before any key is computed, so the key step
    sees each place once, however many citations it has.
    """
    places = stage2.select(*PLACE_COLUMNS).distinct()
    keyed = places.select(
        keys.location_key({name: F.col(name) for name in PLACE_COLUMNS}).alias("id"),
        *[F.col(name).alias(_PLACE_NAMES.get(name, name)) for name in PLACE_COLUMNS],
    )
    attributes = [name for name in S.LOCATION.names if name != "id"]
    return conform(one_row_per_key(keyed, "id", attributes), S.LOCATION)


_PLACE_NAMES = {"violation_precinct": "precinct", "violation_county": "county"}


def vehicle_dimension(stage2: DataFrame) -> DataFrame:
    """One row per vehicle with the last known value of what may change.

    Vehicles without a key are told apart by plate, state and plate type.
    """
    rows = last_known(
        stage2,
        keys=_vehicle_keys(),
        order=event_order(F.col("issue_date"), F.col("summons_number")),
        latest=_vehicle_attributes(),
        fixed={name: F.col(name) for name in VEHICLE_IDENTITY},
    )
    return _described_vehicles(rows)


VEHICLE_IDENTITY = ("plate_id", "registration_state", "plate_type")
# Column of the dimension → column of stage 2.
VEHICLE_ATTRIBUTES = {
    "body_type": "vehicle_body_type",
    "maker": "vehicle_make",
    "expiration_date": "vehicle_expiration_date",
    "color": "vehicle_color",
    "make_year": "vehicle_year",
}
VEHICLE_STATE_KEYS = ("id", "_keyless")


def vehicle_state(stage2: DataFrame) -> DataFrame:
    """Per vehicle the last known values with the citation that each comes from; states merge."""
    return last_state(
        stage2,
        keys=_vehicle_keys(),
        order=event_order(F.col("issue_date"), F.col("summons_number")),
        latest=_vehicle_attributes(),
        fixed={name: F.col(name) for name in VEHICLE_IDENTITY},
    )


def merged_vehicle_state(state: DataFrame, further: DataFrame) -> DataFrame:
    """The state after the citations behind ``further``, older or newer than those known."""
    return merged_state(state, further, VEHICLE_STATE_KEYS, list(VEHICLE_ATTRIBUTES), VEHICLE_IDENTITY)


def vehicles_of(state: DataFrame) -> DataFrame:
    """The vehicle dimension that a state stands for; no shuffle."""
    return _described_vehicles(values_of(state, VEHICLE_STATE_KEYS, list(VEHICLE_ATTRIBUTES), VEHICLE_IDENTITY))


def _vehicle_attributes() -> dict[str, Column]:
    return {name: F.col(column) for name, column in VEHICLE_ATTRIBUTES.items()}


def _described_vehicles(rows: DataFrame) -> DataFrame:
    defaults = {c: codes.or_unknown(F.col(c)) for c in ("body_type", "maker", "color")}
    return conform(rows.drop("_keyless").withColumns(defaults), S.VEHICLE)


def merged_dimensions(known: dict[str, DataFrame], further: dict[str, DataFrame]) -> dict[str, DataFrame]:
    """Dates, times and places of both; of places with one key, the smallest combination of attributes."""
    places = known["location"].unionByName(further["location"])
    attributes = [name for name in S.LOCATION.names if name != "id"]
    return {
        "date": known["date"].unionByName(further["date"]).distinct(),
        "time": known["time"].unionByName(further["time"]).distinct(),
        "location": one_row_per_key(places, "id", attributes),
    }


def _vehicle_keys() -> dict[str, Column]:
    """The key, and for vehicles without one what tells them apart."""
    parts = F.struct("plate_id", "registration_state", "plate_type")
    return {"id": _vehicle_id(), "_keyless": F.when(_vehicle_id().isNull(), parts)}


def last_known_attribute(
    stage2: DataFrame, column: str, name: str, default: str | None = None
) -> DataFrame:
    """The last known value of one column per vehicle: id and the value.

    Vehicles without a key are told apart as in the dimension, each a row with a null id.
    """
    rows = last_known(
        stage2,
        keys=_vehicle_keys(),
        order=event_order(F.col("issue_date"), F.col("summons_number")),
        latest={name: F.col(column)},
    ).drop("_keyless")
    if default is None:
        return rows
    return rows.withColumn(name, F.coalesce(F.col(name), F.lit(default)))


def violation_fact(stage2: DataFrame, literal: bool = False) -> DataFrame:
    """One row per citation, referring to the dimensions; a projection without a shuffle."""
    of_citation, of_observation = _fact_minutes(literal)
    computed = {
        "vehicle": _vehicle_id(),
        "violation_code": F.coalesce(F.col("violation_code"), F.lit(V.OTHER_VIOLATION_CODE)),
        "violation_time": of_citation,
        "time_first_observed": of_observation,
        "location": keys.location_key({name: F.col(name) for name in PLACE_COLUMNS}),
        "in_front_of_or_opposite": codes.or_unknown(F.col("violation_in_front_of_or_opposite")),
        "sub_division": codes.or_unknown(F.col("sub_division")),
    }
    columns = [computed.get(name, F.col(name)).alias(name) for name in S.VIOLATION.names]
    return conform(stage2.select(*columns), S.VIOLATION)


def star(
    stage2: DataFrame, violation_codes: DataFrame, literal: bool = False
) -> dict[str, DataFrame]:
    """All six tables by name. Stage 2 is read once per table, so give a stored one."""
    return {
        "violation_code": violation_code_dimension(violation_codes),
        "date": date_dimension(stage2),
        "time": time_dimension(stage2, literal),
        "location": location_dimension(stage2),
        "vehicle": vehicle_dimension(stage2),
        "violation": violation_fact(stage2, literal),
    }


def _vehicle_id() -> Column:
    return keys.vehicle_key(F.col("plate_id"), F.col("registration_state"), F.col("plate_type"))


def _fact_minutes(literal: bool) -> tuple[Column, Column]:
    raw = F.col("violation_time"), F.col("time_first_observed")
    return times.citation_minutes(*raw), times.first_observed_minutes(*raw, literal=literal)
