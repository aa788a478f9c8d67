"""SQL for DuckDB: one statement per query, over the given tables only.

A statement is a body plus the named subqueries it needs. The bodies use row numbers,
windows and set operations where the Spark side uses aggregates and joins, so that the two
sides share the input text and little else.
"""

from __future__ import annotations

from curbstar.functions import values as V
from curbstar.sources.schemas import PRIMARY_KEYS, REFERENCES, STAGE_VIOLATION, STAR
from workload import fixtures

AS_OF_YEAR = 2020
NEWEST_MODEL_YEAR = AS_OF_YEAR + V.MODEL_YEARS_AHEAD

_TIME_PATTERN = V.RAW_TIME_PATTERN


def _clock(raw: str) -> str:
    """24-hour HHMM of a raw time."""
    number = f"TRY_CAST(substr({raw},1,4) AS INT)"
    hour = f"TRY_CAST(substr({raw},1,2) AS INT)"
    return f"""CASE WHEN NOT regexp_matches({raw}, '{_TIME_PATTERN}', 'i') OR {raw} IS NULL THEN NULL
      WHEN {number} NOT BETWEEN {V.FIRST_12_HOUR_TIME} AND {V.LAST_12_HOUR_TIME} THEN substr({raw},1,4)
      ELSE lpad(CAST({hour} % 12 + CASE lower(right({raw},1)) WHEN 'p' THEN 12 ELSE 0 END AS VARCHAR),2,'0')
           || substr({raw},3,2) END"""


def _minutes(hhmm: str) -> str:
    return f"(CAST(left({hhmm},2) AS INT)*60 + CAST(right({hhmm},2) AS INT))"


_OBSERVED = """CASE WHEN regexp_matches(replace(date_first_observed, ',', ''), '^[0-9]{8}$')
    THEN TRY_CAST(regexp_replace(replace(date_first_observed, ',', ''), '^(....)(..)(..)$', '\\1-\\2-\\3') AS DATE)
    END"""


def _side(code: str, front: str) -> str:
    return f"""CASE WHEN upper({code}) IN ({front}) THEN 'InFront'
      WHEN upper({code}) IN ('I','F','O') THEN 'Opposite' END"""


_PRECINCT = """CASE violation_precinct WHEN 0 THEN CASE issuer_precinct WHEN 0 THEN NULL ELSE issuer_precinct END
    ELSE violation_precinct END"""
_YEAR = f"CASE WHEN vehicle_year >= {V.OLDEST_MODEL_YEAR} AND vehicle_year <= {NEWEST_MODEL_YEAR} THEN vehicle_year END"

_VEHICLE_ID = "md5(upper(plate_id) || upper(registration_state) || upper(plate_type))"
_LOCATION_ID = """md5(CAST(street_code1 AS VARCHAR) || CAST(street_code2 AS VARCHAR) || CAST(street_code3 AS VARCHAR)
    || upper(street_name) || upper(intersecting_street) || CAST(ifnull(violation_precinct, -1) AS VARCHAR)
    || upper(violation_county) || upper(house_number))"""


def _stage2(literal: bool) -> str:
    body = "upper(CAST(v.violation_code AS VARCHAR))" if literal else "upper(v.vehicle_body_type)"
    front = "'F'" if literal else "'I','F'"
    return f"""
SELECT v.summons_number, v.plate_id, st.description AS registration_state, pt.type AS plate_type,
  v.issue_date, vc.code AS violation_code, bt.type AS vehicle_body_type, v.vehicle_make,
  ag.agency AS issuing_agency, v.street_code1, v.street_code2, v.street_code3,
  v.vehicle_expiration_date, {_PRECINCT} AS violation_precinct,
  {_clock('v.violation_time')} AS violation_time,
  {_clock('v.time_first_observed')} AS time_first_observed,
  ifnull(co.county, 'Unknown') AS violation_county,
  {_side('v.violation_in_front_of_or_opposite', front)} AS violation_in_front_of_or_opposite,
  ifnull(v.house_number, 'Unknown') AS house_number,
  ifnull(v.street_name, 'Unknown') AS street_name,
  ifnull(v.intersecting_street, 'Unknown') AS intersecting_street,
  ifnull({_OBSERVED}, v.issue_date) AS date_first_observed,
  v.law_section, v.sub_division, cl.color AS vehicle_color, {_YEAR} AS vehicle_year
FROM stage_violation v
JOIN stage_state st ON upper(st.state_code) = upper(v.registration_state)
JOIN stage_vehicle_plate_type pt ON upper(pt.code) = upper(v.plate_type)
LEFT JOIN stage_violation_code vc ON vc.code = v.violation_code
LEFT JOIN stage_vehicle_body_type bt ON upper(bt.code) = {body}
LEFT JOIN stage_issuing_agency ag ON upper(ag.code) = upper(v.issuing_agency)
LEFT JOIN stage_county co ON upper(co.code) = upper(v.violation_county)
LEFT JOIN stage_vehicle_color cl ON upper(cl.code) = upper(v.vehicle_color)
WHERE v.plate_id IS NOT NULL"""


def _last_known(column: str) -> str:
    """Latest non-null value of a stage 2 column per vehicle, as a scalar over ``w``."""
    return f"last_value({column} IGNORE NULLS) OVER w"


# Every named subquery and the ones it reads.
_PARTS: dict[str, tuple[str, tuple[str, ...]]] = {
    name: (fixtures.duckdb_text(text), ()) for name, text in fixtures.SQL.items()
}
_LOOKUPS = tuple(name for name in fixtures.SQL if name != "stage_violation")
_PARTS["raw_dates"] = (fixtures.duckdb_text(fixtures.RAW_DATES), ("stage_violation",))
_PARTS["described"] = (
    """
SELECT v.*, (SELECT a.agency FROM stage_issuing_agency a WHERE upper(a.code) = upper(v.issuing_agency)) AS agency
FROM stage_violation v""",
    ("stage_violation", "stage_issuing_agency"),
)
_PARTS["stage2"] = (_stage2(False), ("stage_violation", *_LOOKUPS))
_PARTS["stage2_literal"] = (_stage2(True), ("stage_violation", *_LOOKUPS))
_PARTS["clock"] = (
    f"""
SELECT summons_number, violation_time AS raw_violation_time, time_first_observed AS raw_first_observed,
  {_clock('violation_time')} AS violation_time, {_clock('time_first_observed')} AS time_first_observed
FROM stage_violation""",
    ("stage_violation",),
)
_PARTS["vehicle"] = (
    f"""
SELECT id, min(plate_id) AS plate_id, min(registration_state) AS registration_state,
  min(plate_type) AS plate_type, ifnull(any_value(body_type),'Unknown') AS body_type,
  ifnull(any_value(maker),'Unknown') AS maker, any_value(expiration_date) AS expiration_date,
  ifnull(any_value(color),'Unknown') AS color, any_value(make_year) AS make_year
FROM (
  SELECT id, plate_id, registration_state, plate_type,
    {_last_known('vehicle_body_type')} AS body_type, {_last_known('vehicle_make')} AS maker,
    {_last_known('vehicle_expiration_date')} AS expiration_date,
    {_last_known('vehicle_color')} AS color, {_last_known('vehicle_year')} AS make_year
  FROM (SELECT *, {_VEHICLE_ID} AS id FROM stage2)
  WINDOW w AS (PARTITION BY id ORDER BY issue_date NULLS LAST, summons_number
               ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING))
GROUP BY id""",
    ("stage2",),
)
_PARTS["location"] = (
    f"""
WITH places AS (SELECT DISTINCT {_LOCATION_ID} AS id, street_code1, street_code2, street_code3,
    street_name, intersecting_street, violation_precinct AS precinct, violation_county AS county,
    house_number FROM stage2),
  ranked AS (SELECT *, row_number() OVER (PARTITION BY id ORDER BY street_code1 NULLS FIRST,
    street_code2 NULLS FIRST, street_code3 NULLS FIRST, street_name NULLS FIRST,
    intersecting_street NULLS FIRST, precinct NULLS FIRST, county NULLS FIRST,
    house_number NULLS FIRST) AS place FROM places)
SELECT * EXCLUDE (place) FROM ranked WHERE place = 1 OR id IS NULL""",
    ("stage2",),
)
_PARTS["violation_code"] = (
    "SELECT code, description, manhattan_amount, others_amount FROM stage_violation_code "
    "GROUP BY ALL",
    ("stage_violation_code",),
)
_PARTS["date"] = (
    """
SELECT d AS date, CAST(day(d) AS INT) AS day, CAST(month(d) AS INT) AS month,
  CAST(year(d) AS INT) AS year
FROM (SELECT issue_date AS d FROM stage2 UNION SELECT date_first_observed FROM stage2)
WHERE d IS NOT NULL""",
    ("stage2",),
)
_VM, _OM = _minutes("violation_time"), _minutes("time_first_observed")


def _times_and_facts(suffix: str, stand_in: str) -> None:
    """The time and fact tables over one form of stage 2."""
    stage2 = f"stage2{suffix}"
    observed = f"coalesce({_OM}, {stand_in})"
    _PARTS[f"time{suffix}"] = (
        f"""
SELECT t AS time, CAST(t % 60 AS INT) AS minutes, CAST(t // 60 AS INT) AS hours
FROM (SELECT coalesce({_VM}, {_OM}) AS t FROM {stage2} UNION SELECT {observed} FROM {stage2})
WHERE t IS NOT NULL""",
        (stage2,),
    )
    _PARTS[f"violation{suffix}"] = (
        f"""
SELECT summons_number, {_VEHICLE_ID} AS vehicle, ifnull(violation_code, 99) AS violation_code,
  issue_date, coalesce({_VM}, {_OM}) AS violation_time, {observed} AS time_first_observed,
  date_first_observed, {_LOCATION_ID} AS location, issuing_agency,
  ifnull(violation_in_front_of_or_opposite, 'Unknown') AS in_front_of_or_opposite, law_section,
  ifnull(sub_division, 'Unknown') AS sub_division
FROM {stage2}""",
        (stage2,),
    )


_times_and_facts("", _VM)
_times_and_facts("_literal", "CAST(violation_time AS INT)")
_STAR = tuple(PRIMARY_KEYS)


def statement(body: str, *needs: str) -> str:
    """``body`` after the named subqueries it needs, each once and in order of use."""
    ordered: list[str] = []

    def add(name: str) -> None:
        for earlier in _PARTS[name][1]:
            add(earlier)
        if name not in ordered:
            ordered.append(name)

    for name in needs:
        add(name)
    parts = ",\n".join(f'"{name}" AS ({_PARTS[name][0].strip()})' for name in ordered)
    return f"WITH {parts}\n{body.strip()}"


def _long(columns: dict[str, str], table: str, label: str = "column_name") -> str:
    """UNION ALL of one aggregate row per label."""
    return "\nUNION ALL ".join(
        f"SELECT '{name}' AS {label}, {measures} FROM {table}" for name, measures in columns.items()
    )


def _values(columns: list[str], table: str) -> str:
    return "\nUNION ALL ".join(
        f"SELECT '{c}' AS column_name, CAST({c} AS VARCHAR) AS value FROM {table}" for c in columns
    )


def _lookup_left(code: str, table: str, key: str, value: str, alias: str, fold=True) -> str:
    wrap = "upper({})" if fold else "{}"
    return statement(
        f"""SELECT v.summons_number, v.{code},
  (SELECT k.{value} FROM {table} k WHERE {wrap.format('k.' + key)} = {wrap.format('v.' + code)}) AS {alias}
FROM stage_violation v""",
        "stage_violation",
        table,
    )


STAGE = "stage_violation"
SV = ("stage_violation",)

VALUE_COLUMNS = [
    "violation_in_front_of_or_opposite",
    "law_section",
    "sub_division",
    "issuing_agency",
    "violation_legal_code",
    "agency",
]
DISTINCT_COLUMNS = [
    "registration_state",
    "plate_type",
    "violation_code",
    "vehicle_body_type",
    "vehicle_make",
    "issuing_agency",
    "street_code1",
    "street_code2",
    "street_code3",
    "violation_precinct",
    "violation_county",
    "violation_in_front_of_or_opposite",
    "house_number",
    "street_name",
    "intersecting_street",
    "date_first_observed",
    "law_section",
    "sub_division",
    "violation_legal_code",
    "days_parking_in_effect",
    "vehicle_color",
    "unregistered_vehicle",
    "meter_number",
    "feet_from_curb",
    "no_standing_or_stopping_violation",
    "hydrant_violation",
    "double_parking_violation",
]
VEHICLE_ATTRIBUTES = [
    "plate_id",
    "registration_state",
    "plate_type",
    "vehicle_body_type",
    "vehicle_make",
    "vehicle_color",
    "vehicle_year",
    "unregistered_vehicle",
]
DUPLICATE_COLUMNS = ["summons_number", "plate_id", "registration_state", "plate_type"]
PROFILE_COLUMNS = STAGE_VIOLATION.names
FREQUENT_COLUMNS = ["plate_type", "violation_code", "issuer_squad", "days_parking_in_effect", "vehicle_color"]
FREQUENT_VALUES = 3
# Column of the citations → (lookup table, key, description, case folded).
CODE_TABLES = {
    "registration_state": ("stage_state", "state_code", "description", True),
    "plate_type": ("stage_vehicle_plate_type", "code", "type", True),
    "violation_code": ("stage_violation_code", "code", "description", False),
    "vehicle_body_type": ("stage_vehicle_body_type", "code", "type", True),
    "issuing_agency": ("stage_issuing_agency", "code", "agency", True),
    "violation_county": ("stage_county", "code", "county", True),
    "vehicle_color": ("stage_vehicle_color", "code", "color", True),
}
TOP_PLACES = 20
MONTH_AND_COUNTY = ("1998-03-01", "ASIA")
HEAD_PRECINCTS = 80


def _unmatched_rows(folded: bool = False) -> str:
    def one(column: str) -> str:
        table, key, _, fold = CODE_TABLES[column]
        fold = fold and folded
        match = f"upper(k.{key}) = upper(v.{column})" if fold else f"k.{key} = v.{column}"
        return f"""SELECT '{column}' AS column_name, CAST({column} AS VARCHAR) AS code
FROM stage_violation v WHERE NOT EXISTS (SELECT 1 FROM {table} k WHERE {match})"""

    return "\nUNION ALL ".join(one(column) for column in CODE_TABLES)


def _last(column: str, name: str, default: str | None = None) -> str:
    value = "v" if default is None else f"ifnull(v, '{default}')"
    return statement(
        f"""SELECT id, {value} AS {name} FROM (
  SELECT id, {column} AS v, row_number() OVER (PARTITION BY id, CASE WHEN id IS NULL THEN (plate_id, registration_state, plate_type) END ORDER BY {column} IS NULL,
    issue_date DESC NULLS FIRST, summons_number DESC) AS place
  FROM (SELECT *, {_VEHICLE_ID} AS id FROM stage2)) WHERE place = 1""",
        "stage2",
    )


def _percentage(column: str) -> str:
    return f"CAST(count({column}) AS DOUBLE) * 100 / count(*)"


def _check(name: str, value: str, threshold: float, test: str, table: str) -> str:
    return f"""SELECT '{name}' AS check_name, CAST({value} AS DOUBLE) AS value,
  CAST({threshold} AS DOUBLE) AS threshold, {value} {test} AS passed FROM {table}"""


_RAW_CHECKS = [
    _check(
        "plate_id_not_null_percentage",
        _percentage("plate_id"),
        V.MIN_PLATE_PERCENTAGE,
        f">= {V.MIN_PLATE_PERCENTAGE}",
        STAGE,
    ),
    _check(
        "issue_date_not_null_percentage",
        _percentage("issue_date"),
        V.MIN_ISSUE_DATE_PERCENTAGE,
        f">= {V.MIN_ISSUE_DATE_PERCENTAGE}",
        STAGE,
    ),
]
_LOADED_CHECKS = [
    _check(f"{name}_has_rows", "count(*)", 0, "> 0", f'"{name}"') for name in _STAR
]


def _all(parts: list[str]) -> str:
    return "\nUNION ALL ".join(parts)


def _reference(column: str, dimension: str, key: str) -> str:
    return f"""SELECT '{column}' AS fact_column, '{dimension}' AS dimension,
  count(DISTINCT f.{column}) AS orphan_keys, count(*) AS orphan_rows
FROM violation f WHERE f.{column} IS NOT NULL
  AND f.{column} NOT IN (SELECT {key} FROM "{dimension}" WHERE {key} IS NOT NULL)"""


def _primary_key(table: str, key: str) -> str:
    return f"""SELECT '{table}' AS table_name, '{key}' AS key_column,
  count(*) FILTER (WHERE k IS NOT NULL AND n > 1) AS repeated_keys,
  CAST(ifnull(sum(n - 1) FILTER (WHERE k IS NOT NULL), 0) AS BIGINT) AS surplus_rows,
  CAST(ifnull(sum(n) FILTER (WHERE k IS NULL), 0) AS BIGINT) AS null_keys
FROM (SELECT {key} AS k, count(*) AS n FROM "{table}" GROUP BY {key})"""


_CLOCK_12 = "ifnull(regexp_matches({c}, '^(1[0-2]|0?[1-9])[0-5]?[0-9][AP]$', 'i'), false)"
_CLOCK_24 = "ifnull(regexp_matches(trim({c}, 'AaPp'), '^(2[0-3]|[0-1]?[0-9])[0-5]?[0-9]$'), false)"


def _bad_time(column: str, other: str) -> str:
    c12, c24 = _CLOCK_12.format(c=column), _CLOCK_24.format(c=column)
    o12, o24 = _CLOCK_12.format(c=other), _CLOCK_24.format(c=other)
    return f"""SELECT '{column}' AS column_name, count(*) FILTER (WHERE NOT {c12}) AS bad_12_hour,
  count(*) FILTER (WHERE NOT ({c12} OR {c24})) AS bad_after_repair,
  count(*) FILTER (WHERE NOT ({c12} OR {c24} OR {o12} OR {o24})) AS bad_after_fill
FROM stage_violation"""


def _strict(text: str, order: str) -> str:
    """Date of a text in one layout, through ISO text; null when impossible."""
    pattern, iso = {
        "mdy": ("^([0-9]{2})/([0-9]{2})/([0-9]{4})$", "\\3-\\1-\\2"),
        "ymd": ("^([0-9]{4})([0-9]{2})([0-9]{2})$", "\\1-\\2-\\3"),
    }[order]
    return f"""CASE WHEN regexp_matches({text}, '{pattern}')
    THEN TRY_CAST(regexp_replace({text}, '{pattern}', '{iso}') AS DATE) END"""


_DATE_TEXTS = {
    "issue_date_text": _strict("issue_date_text", "mdy"),
    "expiration_date_text": _strict("expiration_date_text", "ymd"),
    "date_first_observed": _strict("replace(date_first_observed, ',', '')", "ymd"),
}

_SELECT_STAGE = "SELECT " + ", ".join(PROFILE_COLUMNS) + " FROM stage_violation"


def _rank(fact_key: str, table: str, key: str, attributes: dict[str, str], limit: int = 0) -> str:
    names = ", ".join(attributes)
    chosen = ", ".join(f"{expr} AS {name}" for name, expr in attributes.items())
    text = f"""SELECT {chosen}, count(*) AS n
FROM violation f LEFT JOIN "{table}" d ON f.{fact_key} = d.{key} GROUP BY ALL"""
    order = ", ".join(f"{name} NULLS FIRST" for name in attributes)
    return text + (f" ORDER BY n DESC, {order} LIMIT {limit}" if limit else "")


def _digest(table: str, columns: list[str]) -> str:
    """Count and two sums of row hashes, whatever the order of rows."""
    texts = [f"CAST({c} AS VARCHAR)" for c in columns]
    row = " || ".join(f"coalesce(length({t}) || ':' || {t}, '-')" for t in texts)
    sums = [f"CAST(coalesce(sum(('0x' || substr(h, {start}, 15))::BIGINT), 0) AS VARCHAR)" for start in (1, 16)]
    return f"""SELECT '{table}' AS table_name, count(*) AS row_count, {sums[0]} AS sum_a, {sums[1]} AS sum_b
FROM (SELECT md5({row}) AS h FROM "{table}")"""


def all_statements() -> dict[str, str]:
    sv = SV
    out: dict[str, str] = {}

    # Sources and sinks
    out["src_csv_comma"] = statement("SELECT * FROM stage_violation_code", "stage_violation_code")
    out["src_csv_semicolon"] = statement(
        """SELECT s.state_code, s.description, count(v.summons_number) AS n
FROM stage_state s LEFT JOIN stage_violation v ON upper(s.state_code) = upper(v.registration_state)
GROUP BY ALL""",
        *sv,
        "stage_state",
    )
    out["src_csv_anydate"] = statement(_SELECT_STAGE, *sv)
    out["src_csv_anydate_comma"] = statement(_SELECT_STAGE, *sv)
    json_tables = {
        "stage_vehicle_body_type": "type",
        "stage_vehicle_plate_type": "type",
        "stage_vehicle_color": "color",
        "stage_county": "county",
        "stage_issuing_agency": "agency",
    }
    out["src_json_paths"] = statement(
        _all(
            [
                f"SELECT '{table}' AS table_name, code, {value} AS description FROM {table}"
                for table, value in json_tables.items()
            ]
        ),
        *json_tables,
    )
    broken = "replace(street_name, ' ', chr(10)) AS street_name"
    out["src_csv_multiline"] = statement(f"SELECT * REPLACE ({broken}) FROM ({_SELECT_STAGE})", *sv)
    orders = ("day_first", "month_first")
    out["src_csv_date_order"] = statement(
        _all([f"SELECT '{o}' AS file_order, summons_number, issue_date, vehicle_expiration_date FROM stage_violation" for o in orders]),
        *sv,
    )
    swapped = "make_date(year(issue_date), day(issue_date), month(issue_date))"
    apart = f"abs(date_diff('day', {swapped}, vehicle_expiration_date))"
    true_apart = "abs(date_diff('day', issue_date, vehicle_expiration_date))"
    nearer, farther = (f"count(*) FILTER (WHERE {true_apart} {c} {apart})" for c in "<>")
    out["date_order_evidence"] = statement(
        _all(
            [
                f"""SELECT '{o}' AS file_order, 'issue_date' AS column_name, 0::BIGINT AS day_only, 0::BIGINT AS month_only,
  {a} AS day_nearer, {b} AS month_nearer, '{o}' AS date_order FROM stage_violation WHERE day(issue_date) <= 12
UNION ALL SELECT '{o}', 'vehicle_expiration_date', 0, 0, 0, 0, 'undecided'"""
                for o, a, b in ((orders[0], nearer, farther), (orders[1], farther, nearer))
            ]
        ),
        *sv,
    )
    out["src_json_array"] = statement(
        f"SELECT summons_number, plate_id, violation_code, {broken} FROM stage_violation", *sv
    )
    out["src_json_path_list"] = out["src_json_paths"]
    out["src_csv_usecols"] = statement(
        "SELECT summons_number, plate_id, vehicle_make FROM stage_violation", *sv
    )
    out["sink_stage_refresh"] = statement(_SELECT_STAGE, *sv)
    out["sink_truncate_insert"] = statement("SELECT * FROM stage2", "stage2")
    out["sink_append"] = statement("SELECT * FROM stage2 UNION ALL SELECT * FROM stage2", "stage2")
    out["sink_column_list"] = statement(
        "SELECT CAST(NULL AS VARCHAR) AS id, * EXCLUDE (id) FROM location", "location"
    )
    out["load_star_counts"] = statement(
        _all([f"SELECT '{t}' AS table_name, count(*) AS row_count FROM \"{t}\"" for t in _STAR]),
        *_STAR,
    )

    out["load_observed_gates"] = statement(_all(_RAW_CHECKS + _LOADED_CHECKS), *SV, *_STAR)
    digests = _all([_digest(name, STAR[name].names) for name in _STAR])
    out["load_star_digests"] = statement(digests, *_STAR)
    out["load_batches_vehicle"] = statement("SELECT * FROM vehicle", "vehicle")
    out["load_batches_digests"] = out["load_star_digests"]

    # Predicates and scalars
    out["filter_plate_not_null"] = statement(
        "SELECT summons_number, plate_id FROM stage_violation WHERE NOT (plate_id IS NULL)", *sv
    )
    out["pred_time_format"] = statement(
        f"""SELECT summons_number, regexp_matches(violation_time, '{_TIME_PATTERN}', 'i') AS violation_time_ok,
  regexp_matches(time_first_observed, '{_TIME_PATTERN}', 'i') AS first_observed_ok FROM stage_violation""",
        *sv,
    )
    out["normalize_time"] = statement("SELECT * FROM clock", "clock")
    out["minutes_of_day"] = statement(
        f"""SELECT summons_number, coalesce({_VM}, {_OM}) AS violation_minutes,
  coalesce({_OM}, {_VM}) AS first_observed_minutes FROM clock""",
        "clock",
    )
    out["minutes_of_day_literal"] = statement(
        f"""SELECT summons_number, coalesce({_VM}, {_OM}) AS violation_minutes,
  coalesce({_OM}, CAST(violation_time AS INT)) AS first_observed_minutes FROM clock""",
        "clock",
    )
    out["parse_comma_date"] = statement(
        f"""SELECT summons_number, date_first_observed AS raw_date, {_OBSERVED} AS parsed_date,
  ifnull({_OBSERVED}, issue_date) AS filled_date FROM stage_violation""",
        *sv,
    )
    out["clean_vehicle_year"] = statement(
        f"SELECT summons_number, {_YEAR} AS vehicle_year FROM stage_violation", *sv
    )
    out["fill_precinct"] = statement(
        f"SELECT summons_number, {_PRECINCT} AS violation_precinct FROM stage_violation", *sv
    )
    for key, front in (("map_front_opposite", "'I','F'"), ("map_front_opposite_literal", "'F'")):
        out[key] = statement(
            f"""SELECT summons_number, {_side('violation_in_front_of_or_opposite', front)} AS side
FROM stage_violation""",
            *sv,
        )
    out["coalesce_defaults"] = statement(
        """SELECT summons_number, ifnull(house_number,'Unknown') AS house_number,
  ifnull(street_name,'Unknown') AS street_name,
  ifnull(intersecting_street,'Unknown') AS intersecting_street,
  ifnull(sub_division,'Unknown') AS sub_division,
  CASE WHEN violation_code IN (SELECT code FROM stage_violation_code) THEN violation_code ELSE 99 END AS violation_code
FROM stage_violation""",
        *sv,
        "stage_violation_code",
    )
    out["surrogate_vehicle"] = statement(
        f"SELECT summons_number, {_VEHICLE_ID} AS vehicle FROM stage2", "stage2"
    )
    out["surrogate_location"] = statement(
        f"SELECT summons_number, {_LOCATION_ID} AS location FROM stage2", "stage2"
    )
    out["vehicle_id_concat"] = statement(
        """SELECT summons_number, registration_state || plate_id || vehicle_body_type AS vehicle_id
FROM stage_violation""",
        *sv,
    )
    out["fill_times_both_ways"] = statement(
        """SELECT summons_number, ifnull(violation_time, time_first_observed) AS violation_time,
  ifnull(time_first_observed, violation_time) AS time_first_observed FROM clock""",
        "clock",
    )

    # Joins
    out["lookup_inner_state"] = statement(
        """SELECT v.summons_number, s.description AS state FROM stage_violation v, stage_state s
WHERE upper(v.registration_state) = upper(s.state_code)""",
        *sv,
        "stage_state",
    )
    out["lookup_inner_plate_type"] = statement(
        """SELECT v.summons_number, p.type AS plate_type FROM stage_violation v, stage_vehicle_plate_type p
WHERE upper(v.plate_type) = upper(p.code)""",
        *sv,
        "stage_vehicle_plate_type",
    )
    out["lookup_left_violation_code"] = _lookup_left(
        "violation_code", "stage_violation_code", "code", "description", "description", fold=False
    )
    out["lookup_left_body_type"] = _lookup_left(
        "vehicle_body_type", "stage_vehicle_body_type", "code", "type", "body_type"
    )
    out["lookup_left_body_type_literal"] = statement(
        """SELECT v.summons_number, v.violation_code, (SELECT k.type FROM stage_vehicle_body_type k
  WHERE upper(k.code) = CAST(v.violation_code AS VARCHAR)) AS body_type FROM stage_violation v""",
        *sv,
        "stage_vehicle_body_type",
    )
    out["lookup_left_agency"] = _lookup_left(
        "issuing_agency", "stage_issuing_agency", "code", "agency", "agency"
    )
    out["lookup_left_county"] = statement(
        """SELECT v.summons_number, v.violation_county, ifnull((SELECT k.county FROM stage_county k
  WHERE upper(k.code) = upper(v.violation_county)), 'Unknown') AS county FROM stage_violation v""",
        *sv,
        "stage_county",
    )
    out["lookup_left_color"] = _lookup_left(
        "vehicle_color", "stage_vehicle_color", "code", "color", "color"
    )
    out["map_left_case_sensitive"] = _lookup_left(
        "registration_state", "stage_state", "state_code", "description", "state", fold=False
    )
    out["map_dictionary"] = statement(
        """SELECT summons_number, CASE violation_in_front_of_or_opposite WHEN 'I' THEN 'InFront'
  WHEN 'F' THEN 'InFront' WHEN 'O' THEN 'Opposite' END AS side FROM stage_violation""",
        *sv,
    )
    lookup_tables = [entry[0] for entry in CODE_TABLES.values()]
    out["unmatched_codes"] = statement(
        f"SELECT column_name, code, count(*) AS n FROM ({_unmatched_rows()}) GROUP BY ALL",
        *sv,
        *lookup_tables,
    )
    out["unmatched_codes_folded"] = statement(
        f"SELECT column_name, code, count(*) AS n FROM ({_unmatched_rows(True)}) GROUP BY ALL",
        *sv,
        *lookup_tables,
    )
    out["unmatched_counts"] = statement(
        f"""SELECT column_name, count(DISTINCT code) + max(CASE WHEN code IS NULL THEN 1 ELSE 0 END) AS unmatched_codes,
  count(*) AS unmatched_rows FROM ({_unmatched_rows()}) GROUP BY column_name""",
        *sv,
        *lookup_tables,
    )

    # Datasets
    out["stage2_violation"] = statement("SELECT * FROM stage2", "stage2")
    out["stage2_violation_literal"] = statement("SELECT * FROM stage2_literal", "stage2_literal")
    for table in ("violation_code", "date", "time", "location", "vehicle"):
        out[f"dim_{table}"] = statement(f'SELECT * FROM "{table}"', table)
    out["fact_violation"] = statement("SELECT * FROM violation", "violation")
    out["dim_time_literal"] = statement("SELECT * FROM time_literal", "time_literal")
    out["fact_violation_literal"] = statement("SELECT * FROM violation_literal", "violation_literal")

    # Last known values
    out["last_body_type"] = _last("vehicle_body_type", "body_type", "Unknown")
    out["last_maker"] = _last("vehicle_make", "maker", "Unknown")
    out["last_expiration_date"] = _last("vehicle_expiration_date", "expiration_date")
    out["last_color"] = _last("vehicle_color", "color", "Unknown")
    out["last_make_year"] = _last("vehicle_year", "make_year")

    # Sets and sorts
    out["all_street_codes"] = statement(
        """SELECT street_code1 AS street_code FROM stage_violation
UNION SELECT street_code2 FROM stage_violation UNION SELECT street_code3 FROM stage_violation""",
        *sv,
    )
    out["head_n"] = statement(
        "SELECT summons_number, plate_id, issue_date FROM stage_violation ORDER BY summons_number LIMIT 5",
        *sv,
    )

    # Profile
    out["count_rows"] = statement(
        _all(
            [f"SELECT '{t}' AS table_name, count(*) AS row_count FROM {t}" for t in fixtures.SQL]
        ),
        *fixtures.SQL,
    )
    gated = ("plate_id", "issue_date")
    out["non_null_percentage"] = statement(
        _long({c: f"{_percentage(c)} AS percentage" for c in gated}, STAGE), *sv
    )
    out["non_null_percentage_literal"] = statement(
        _long({c: f"count({c}) // count(*) * 100 AS percentage" for c in gated}, STAGE), *sv
    )
    out["value_counts"] = statement(
        f"""SELECT column_name, value, count(*) AS n FROM ({_values(VALUE_COLUMNS, "described")})
WHERE value IS NOT NULL GROUP BY ALL""",
        "described",
    )
    out["distinct_values"] = statement(
        f"SELECT DISTINCT column_name, value FROM ({_values(DISTINCT_COLUMNS, STAGE)})", *sv
    )
    out["distinct_attributes"] = statement(
        f"SELECT DISTINCT {', '.join(VEHICLE_ATTRIBUTES)} FROM stage_violation", *sv
    )
    out["profile_columns"] = statement(
        _long(
            {
                c: f"""count(*) AS row_count, count({c}) AS value_count,
  count(*) FILTER (WHERE {c} IS NULL) AS null_count, bool_or({c} IS NULL) AS any_null"""
                for c in PROFILE_COLUMNS
            },
            STAGE,
        ),
        *sv,
    )
    out["profile_merged"] = statement(
        _all(
            [
                f"""SELECT '{c}' AS column_name, count(*) AS row_count, count({c}) AS value_count, min(CAST({c} AS VARCHAR)) AS smallest,
  max(CAST({c} AS VARCHAR)) AS largest, count(DISTINCT {c}) AS distinct_count, TRUE AS within_bound FROM stage_violation
HAVING count({c}) > 0"""
                for c in PROFILE_COLUMNS
            ]
        ),
        *sv,
    )
    out["frequent_values_merged"] = statement(
        f"""SELECT column_name, value, n FROM (
  SELECT *, rank() OVER (PARTITION BY column_name ORDER BY n DESC) AS place
  FROM (SELECT column_name, value, count(*) AS n FROM ({_values(FREQUENT_COLUMNS, STAGE)}) WHERE value IS NOT NULL GROUP BY ALL))
WHERE place <= {FREQUENT_VALUES}""",
        *sv,
    )
    out["profile_null_rows"] = statement(
        "SELECT summons_number, vehicle_body_type FROM stage_violation WHERE vehicle_make IS NULL",
        *sv,
    )
    sentinels = {
        "violation_precinct": "violation_precinct = 0",
        "issuer_precinct": "issuer_precinct = 0",
        "date_first_observed": "date_first_observed = '0'",
        "vehicle_year": "vehicle_year = 0",
        "issuer_code": "issuer_code = 0",
        "feet_from_curb": "feet_from_curb = 0",
        "unregistered_vehicle": "unregistered_vehicle = '0'",
    }
    out["profile_sentinel"] = statement(
        _long(
            {c: f"count(*) FILTER (WHERE {t}) AS sentinel_count" for c, t in sentinels.items()},
            STAGE,
        ),
        *sv,
    )
    out["profile_duplicates"] = statement(
        f"""SELECT column_name, count(*) AS distinct_count, CAST(sum(n) - count(*) AS BIGINT) AS repeat_count,
  max(n) > 1 AS any_duplicate
FROM (SELECT column_name, value, count(*) AS n FROM ({_values(DUPLICATE_COLUMNS, STAGE)}) GROUP BY ALL)
GROUP BY column_name""",
        *sv,
    )
    out["profile_out_of_range"] = statement(
        f"""SELECT 'vehicle_year' AS column_name,
  count(*) FILTER (WHERE vehicle_year < {V.OLDEST_MODEL_YEAR} OR vehicle_year > {NEWEST_MODEL_YEAR}) AS out_of_range_count
FROM stage_violation""",
        *sv,
    )
    out["profile_column_agreement"] = statement(
        """SELECT 'location_and_precinct' AS pair, count(violation_location) AS value_count,
  count(*) FILTER (WHERE violation_location = CAST(violation_precinct AS VARCHAR)) AS equal_count FROM stage_violation
UNION ALL SELECT 'precinct_and_issuer', count(violation_precinct),
  count(*) FILTER (WHERE violation_precinct = issuer_precinct) FROM stage_violation""",
        *sv,
    )
    out["profile_regex_all"] = statement(
        f"""SELECT 'date_first_observed' AS column_name,
  count(*) FILTER (WHERE NOT regexp_matches(date_first_observed, '{V.COMMA_DATE_PATTERN}')) = 0 AS all_match,
  count(*) AS checked_count
FROM stage_violation WHERE date_first_observed <> '0'""",
        *sv,
    )
    attributes = ", ".join(VEHICLE_ATTRIBUTES)
    out["conflicting_plates"] = statement(
        f"""SELECT {attributes} FROM (SELECT *, count(*) OVER (PARTITION BY plate_id) AS n
  FROM (SELECT DISTINCT {attributes} FROM stage_violation)) WHERE n > 1""",
        *sv,
    )
    out["conflicting_plate_types"] = statement(
        """SELECT vehicle_id, class_description FROM (
  SELECT *, count(*) OVER (PARTITION BY vehicle_id) AS n FROM (
    SELECT DISTINCT registration_state || plate_id || vehicle_body_type AS vehicle_id, p.type AS class_description
    FROM stage_violation v LEFT JOIN stage_vehicle_plate_type p ON p.code = v.plate_type)
  WHERE vehicle_id IS NOT NULL) WHERE n > 1""",
        *sv,
        "stage_vehicle_plate_type",
    )
    streets = "street_code1, street_code2, street_code3"
    conflicts = f"""SELECT {streets}, violation_precinct, house_number FROM (
  SELECT *, count(*) OVER (PARTITION BY {streets}) AS n
  FROM (SELECT DISTINCT {streets}, violation_precinct, house_number FROM stage_violation)) WHERE n > 1"""
    out["conflicting_precincts"] = statement(conflicts, *sv)
    out["head_conflicting_precincts"] = statement(
        f"""{conflicts} ORDER BY street_code1 DESC NULLS LAST, street_code2 DESC NULLS LAST,
  street_code3 DESC NULLS LAST, violation_precinct NULLS FIRST, house_number NULLS FIRST LIMIT {HEAD_PRECINCTS}""",
        *sv,
    )
    out["bad_dates"] = statement(
        "SELECT column_name, bad_value, count(*) AS n FROM ("
        + _all(
            [
                f"""SELECT '{c}' AS column_name, {c} AS bad_value FROM raw_dates
WHERE {c} IS NOT NULL AND ({parsed}) IS NULL"""
                for c, parsed in _DATE_TEXTS.items()
            ]
        )
        + ") GROUP BY ALL",
        "raw_dates",
    )
    out["bad_date_counts"] = statement(
        _long(
            {
                c: f"""count({parsed}) AS parsed_count,
  count(*) FILTER (WHERE {c} IS NOT NULL AND ({parsed}) IS NULL) AS unparsed_count"""
                for c, parsed in _DATE_TEXTS.items()
            },
            "raw_dates",
        ),
        "raw_dates",
    )
    out["lost_dates"] = statement(
        """SELECT 'issue_date' AS column_name, count(*) FILTER (mixed_date_text IS NOT NULL AND issue_date IS NULL) AS lost FROM raw_dates
UNION ALL SELECT 'vehicle_expiration_date', count(*) FILTER (vehicle_expiration_date IS NULL) FROM raw_dates""",
        "raw_dates",
    )
    out["bad_times"] = statement(
        _all(
            [
                _bad_time("violation_time", "time_first_observed"),
                _bad_time("time_first_observed", "violation_time"),
            ]
        ),
        *sv,
    )

    # Quality
    out["check_stage"] = statement(_all(_RAW_CHECKS), *sv)
    out["check_fact_dimension"] = statement(_all(_LOADED_CHECKS), *_STAR)
    out["quality_report"] = statement(_all(_RAW_CHECKS + _LOADED_CHECKS), *sv, *_STAR)
    out["check_has_rows"] = statement(_check("has_rows", "count(*)", 0, "> 0", STAGE), *sv)
    out["check_min_percentage"] = statement(
        _check(
            "vehicle_make_not_null_percentage", _percentage("vehicle_make"), 95, ">= 95", STAGE
        ),
        *sv,
    )
    judged = [
        ("has_citations", "SELECT count(*) > 0 AS ok FROM stage_violation", "= 1"),
        (
            "makes_filled",
            "SELECT count(vehicle_make) * 100.0 / count(*) >= 95 AS ok FROM stage_violation",
            "= 1",
        ),
        ("every_state_coded", "SELECT length(state_code) = 2 AS ok FROM stage_state", "> 0"),
        ("years_known", "SELECT vehicle_year > 0 AS ok FROM stage_violation", "> 0"),
    ]
    out["check_statements"] = statement(
        _all(
            [
                f"SELECT '{name}' AS check_name, count(*) AS records, "
                "count(*) FILTER (coalesce(ok, false) = false) AS unmet, "
                f"count(*) {wanted} AND count(*) FILTER (coalesce(ok, false) = false) = 0 AS passed "
                f"FROM ({body})"
                for name, body, wanted in judged
            ]
        ),
        *sv,
        "stage_state",
    )
    out["check_primary_keys"] = statement(
        _all([_primary_key(t, k) for t, k in PRIMARY_KEYS.items()]), *_STAR
    )
    out["check_references"] = statement(
        _all([_reference(c, d, k) for c, (d, k) in REFERENCES.items()]), *_STAR
    )
    null_keys = [("vehicle", "id"), ("location", "id"), ("violation", "vehicle"), ("violation", "location")]
    out["check_null_keys"] = statement(
        _all(
            [
                f"""SELECT '{t}' AS table_name, '{k}' AS key_column,
  count(*) FILTER (WHERE {k} IS NULL) AS null_keys FROM {t}"""
                for t, k in null_keys
            ]
        ),
        "vehicle",
        "location",
        "violation",
    )

    # Questions
    out["top_months"] = statement(
        _rank("issue_date", "date", "date", {"month": "d.month"}), "violation", "date"
    )
    out["top_hours"] = statement(
        _rank("violation_time", "time", "time", {"hour": "d.hours"}), "violation", "time"
    )
    out["top_vehicle_types"] = statement(
        _rank("vehicle", "vehicle", "id", {"body_type": "d.body_type"}), "violation", "vehicle"
    )
    out["all_places_ranked"] = statement(
        _rank(
            "location",
            "location",
            "id",
            {"county": "d.county", "precinct": "d.precinct", "street_name": "upper(d.street_name)"},
        ),
        "violation",
        "location",
    )
    out["top_places"] = statement(
        _rank(
            "location",
            "location",
            "id",
            {"county": "d.county", "precinct": "d.precinct", "street_name": "upper(d.street_name)"},
            TOP_PLACES,
        ),
        "violation",
        "location",
    )
    first, county = MONTH_AND_COUNTY
    out["citations_of_month_and_county"] = statement(
        f"""SELECT issue_date, violation_county, count(*) AS n FROM stage2
WHERE date_trunc('month', issue_date) = DATE '{first}' AND violation_county = '{county}' GROUP BY ALL""",
        "stage2",
    )
    out["top_vehicle_types_bucketed"] = out["top_vehicle_types"]
    out["check_vehicle_reference_bucketed"] = statement(
        """SELECT 'vehicle' AS fact_column, count(DISTINCT vehicle) AS orphan_keys, count(vehicle) AS orphan_rows
FROM violation f WHERE vehicle IS NOT NULL AND NOT EXISTS (SELECT 1 FROM vehicle v WHERE v.id = f.vehicle)""",
        "violation",
        "vehicle",
    )
    return out
