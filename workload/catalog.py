"""The queries by name: each takes a session and the folder of the given tables."""

from __future__ import annotations

from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from curbstar.functions import codes, dates, keys, times
from curbstar.functions import values as V
from curbstar.operators import checks, keyed, profile, sketches
from curbstar.operators.date_order import DAY_FIRST, MONTH_FIRST, date_order_report
from curbstar.operators.digest import digest_report
from curbstar.operators.lookup import (
    Lookup,
    ReadyLookup,
    prepare_lookups,
    unmatched,
    unmatched_totals,
)
from curbstar.operators.observe import report_of
from curbstar.plans import gates, questions, stage, star
from curbstar.plans.load import JSON_PATHS, JsonRecords, LoadSettings, by_issue_year, load_batch, load_star, open_star
from curbstar.sources import files
from curbstar.sources import schemas as S
from curbstar.sources.buckets import Buckets, create_bucketed
from curbstar.sources.clustering import clustered
from curbstar.sources.readers import read_columns, read_json_paths
from curbstar.sources.schemas import conform
from curbstar.sources.scratch import scratch_path, stored
from curbstar.sources.writers import append_table, create_table, replace_table
from workload import fixtures, raw_files
from workload.oracles import (
    AS_OF_YEAR,
    CODE_TABLES,
    DISTINCT_COLUMNS,
    DUPLICATE_COLUMNS,
    FREQUENT_COLUMNS,
    FREQUENT_VALUES,
    HEAD_PRECINCTS,
    MONTH_AND_COUNTY,
    PROFILE_COLUMNS,
    TOP_PLACES,
    VALUE_COLUMNS,
    VEHICLE_ATTRIBUTES,
)

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(function: Query) -> Query:
    QUERIES[function.__name__] = function
    return function


# --- Inputs -------------------------------------------------------------------------------


def _citations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fixtures.staging_table(spark, sf_dir, "stage_violation")


_STORED: dict[tuple[SparkSession, str, str], tuple[str, dict]] = {}


def _once(spark: SparkSession, sf_dir: str, purpose: str, make: Callable[[str], dict]) -> dict:
    """What ``make`` stored below a scratch folder, once per session and as long as the folder is there."""
    path, made = _STORED.get((spark, sf_dir, purpose), ("", {}))
    if not path or not files.exists(spark, path):
        path = scratch_path(spark, purpose)
        made = make(path)
        _STORED[spark, sf_dir, purpose] = path, made
    return made


def _lookup_tables(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """The code tables, stored: a lookup is measured before it is joined and so is read twice."""
    names = [entry[0] for entry in CODE_TABLES.values()]

    def make(path: str) -> dict[str, DataFrame]:
        def write(name: str) -> DataFrame:
            df = fixtures.staging_table(spark, sf_dir, name)
            return create_table(conform(df, S.STAGING[name]), f"{path}/{name}", S.STAGING[name])

        with ThreadPoolExecutor(max_workers=len(names)) as pool:
            return dict(zip(names, pool.map(write, names)))

    return _once(spark, sf_dir, "lookups", make)


def _lookup(spark: SparkSession, sf_dir: str, column: str, fold_case: bool = True) -> Lookup:
    table, key, _, folds = CODE_TABLES[column]
    return Lookup(table, _lookup_tables(spark, sf_dir)[table], key, fold_case and folds)


def _ready(spark: SparkSession, sf_dir: str, column: str, fold_case: bool = True) -> ReadyLookup:
    lookup = _lookup(spark, sf_dir, column, fold_case)
    return prepare_lookups([lookup])[lookup.name]


def _stage2(spark: SparkSession, sf_dir: str, literal: bool = False) -> DataFrame:
    """Stage 2 from the citations; they are the only scan besides the stored lookups."""
    ready = prepare_lookups(stage.lookups(_lookup_tables(spark, sf_dir)))
    return stage.stage2_violation(_citations(spark, sf_dir), ready, AS_OF_YEAR, literal)


def star_tables(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """Stage 2 and the star as a whole load stored them, once per session.

    Dimensions, checks and questions read these, as they do after a load.
    """

    def make(root: str) -> dict[str, DataFrame]:
        load_star(spark, raw_files.derived_tables(spark, sf_dir), root, LoadSettings(AS_OF_YEAR))
        return open_star(spark, root).tables

    return _once(spark, sf_dir, "star", make)


def _star(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """The six tables of the stored star."""
    tables = star_tables(spark, sf_dir)
    return {name: tables[name] for name in S.STAR}


def _stored_stage2(spark: SparkSession, sf_dir: str) -> DataFrame:
    return star_tables(spark, sf_dir)["stage2_violation"]


def _from_stage(spark: SparkSession, sf_dir: str, **columns: Column) -> DataFrame:
    rows = _citations(spark, sf_dir)
    return rows.select("summons_number", *[c.alias(name) for name, c in columns.items()])


# --- Sources and sinks --------------------------------------------------------------------


@query
def src_csv_comma(spark, sf_dir):
    table = "stage_violation_code"
    path = raw_files.write_delimited(fixtures.staging_table(spark, sf_dir, table), ",", "codes")
    return raw_files.Delimited(path).read(spark, table)


@query
def src_csv_semicolon(spark, sf_dir):
    """States from their file, with the citations of each."""
    table = "stage_state"
    path = raw_files.write_delimited(fixtures.staging_table(spark, sf_dir, table), ";", "states")
    states = raw_files.Delimited(path, ";").read(spark, table)
    counted = _citations(spark, sf_dir).groupBy(F.upper("registration_state").alias("_state")).count()
    joined = states.join(counted, F.upper("state_code") == F.col("_state"), "left")
    return joined.select(
        "state_code", "description", F.coalesce("count", F.lit(0)).alias("n")
    )


@query
def src_csv_anydate(spark, sf_dir):
    raw = raw_files.citations_file(spark, sf_dir, ";")
    return raw.read(spark, "stage_violation").select(*PROFILE_COLUMNS)


@query
def src_csv_anydate_comma(spark, sf_dir):
    raw = raw_files.citations_file(spark, sf_dir, ",")
    return raw.read(spark, "stage_violation").select(*PROFILE_COLUMNS)


@query
def src_json_paths(spark, sf_dir):
    def read(table: str) -> DataFrame:
        path = raw_files.write_json(fixtures.staging_table(spark, sf_dir, table), table)
        rows = JsonRecords(path, layout="lines").read(spark, table)
        description = S.STAGING[table].names[1]
        return rows.select(
            F.lit(table).alias("table_name"), "code", F.col(description).alias("description")
        )

    return reduce(DataFrame.unionAll, [read(table) for table in JSON_PATHS])


@query
def src_csv_multiline(spark, sf_dir):
    """One file with line breaks in quoted fields, cut into records by many tasks."""
    raw = raw_files.with_line_breaks(fixtures.raw_citations(spark, sf_dir)).coalesce(1)
    path = raw_files.write_delimited(raw, ";", "multiline")
    rows = raw_files.Delimited(path, ";", any_date=True, multiline="split").read(spark, "stage_violation")
    return rows.select(*PROFILE_COLUMNS)


def _in_either_order(spark: SparkSession, sf_dir: str, where: Column | None, use) -> DataFrame:
    """A file with the day first and one with the month first."""
    rows = _citations(spark, sf_dir) if where is None else _citations(spark, sf_dir).filter(where)
    parts = []
    for order in (DAY_FIRST, MONTH_FIRST):
        texts = raw_files.with_date_order(rows.select(*S.STAGE_VIOLATION.names), order)
        path = raw_files.write_delimited(texts, ";", order)
        parts.append(use(path).select(F.lit(order).alias("file_order"), "*"))
    return reduce(DataFrame.unionAll, parts)


@query
def src_csv_date_order(spark, sf_dir):
    """Dates read in the order that each file's own values show."""

    def read(path: str) -> DataFrame:
        raw = raw_files.Delimited(path, ";", any_date=True, date_neighbours={})
        return raw.read(spark, "stage_violation").select("summons_number", "issue_date", "vehicle_expiration_date")

    return _in_either_order(spark, sf_dir, None, read)


@query
def date_order_evidence(spark, sf_dir):
    """What tells the order of dates, where days above 12 are absent: the expiration date nearby."""

    def report(path: str) -> DataFrame:
        texts = read_columns(spark, path, {c: c for c in ("issue_date", "vehicle_expiration_date")}, ";")
        near = dates.parse_date(F.col("vehicle_expiration_date"), V.COMPACT_DATE_FORMAT)
        return date_order_report(texts, {"issue_date": near, "vehicle_expiration_date": None})

    return _in_either_order(spark, sf_dir, F.dayofmonth("issue_date") <= 12, report)


@query
def src_json_array(spark, sf_dir):
    """One large array of records over several lines, cut by many tasks."""
    columns = ["summons_number", "plate_id", "violation_code", "street_name"]
    rows = raw_files.with_line_breaks(_citations(spark, sf_dir)).select(*columns)
    path = raw_files.write_json_array(rows, "citations")
    schema = S.StructType([S.STAGE_VIOLATION[name] for name in columns])
    return read_json_paths(spark, path, [f"$.{name}" for name in columns], schema, "split_array")


@query
def src_json_path_list(spark, sf_dir):
    """The code tables as arrays, by the record paths that a file lists."""

    def read(table: str) -> DataFrame:
        rows = raw_files.with_raw_names(fixtures.staging_table(spark, sf_dir, table), table)
        path = raw_files.write_json_array(rows, table)
        listed = JsonRecords(path, path_list=raw_files.write_path_list(spark, table), layout="split_array")
        names = S.STAGING[table].names
        return listed.read(spark, table).select(
            F.lit(table).alias("table_name"), "code", F.col(names[1]).alias("description")
        )

    return reduce(DataFrame.unionAll, [read(table) for table in JSON_PATHS])


@query
def src_csv_usecols(spark, sf_dir):
    rows = _citations(spark, sf_dir)
    headers = {"summons_number": "Summons Number", "plate_id": "Plate ID", "vehicle_make": "Vehicle Make"}
    path = raw_files.write_delimited(rows.withColumnsRenamed(headers), ";", "citations")
    return read_columns(spark, path, {raw: name for name, raw in headers.items()}, sep=";")


@query
def sink_stage_refresh(spark, sf_dir):
    """Raw file to staging table, twice; the second load replaces the first."""
    raw = raw_files.citations_file(spark, sf_dir, ";")
    target = scratch_path(spark, "stage_violation")
    for _ in range(2):
        rows = raw.read(spark, "stage_violation")
        loaded = replace_table(rows, target, S.STAGE_VIOLATION)
    return loaded.select(*PROFILE_COLUMNS)


@query
def sink_truncate_insert(spark, sf_dir):
    rows, target = _stored_stage2(spark, sf_dir), scratch_path(spark, "replaced")
    replace_table(rows, target, S.STAGE2_VIOLATION)
    return replace_table(rows, target, S.STAGE2_VIOLATION)


@query
def sink_append(spark, sf_dir):
    rows, target = _stored_stage2(spark, sf_dir), scratch_path(spark, "appended")
    append_table(rows, target, S.STAGE2_VIOLATION)
    return append_table(rows, target, S.STAGE2_VIOLATION)


@query
def sink_column_list(spark, sf_dir):
    """Places loaded with a column list that leaves out the key, so the key is null."""
    places = star.location_dimension(_stored_stage2(spark, sf_dir))
    listed = [name for name in S.LOCATION.names if name != "id"]
    return replace_table(places, scratch_path(spark, "location"), S.LOCATION, columns=listed)


@query
def load_star_counts(spark, sf_dir):
    """The whole load from raw files; rows of each stored table of the star."""
    settings = LoadSettings(AS_OF_YEAR, fact_partition=by_issue_year())
    root = scratch_path(spark, "warehouse")
    loaded = load_star(spark, raw_files.all_files(spark, sf_dir), root, settings)
    return checks.row_counts(loaded.tables)


@query
def load_observed_gates(spark, sf_dir):
    """The gates of a whole load, as the writes of its tables measured them."""
    root = scratch_path(spark, "warehouse")
    loaded = load_star(spark, raw_files.all_files(spark, sf_dir), root, LoadSettings(AS_OF_YEAR))
    return report_of(spark, loaded.report)


@query
def load_star_digests(spark, sf_dir):
    """The content of each stored table: opened, read again, and compared with what the load measured."""
    root = scratch_path(spark, "warehouse")
    load_star(spark, raw_files.all_files(spark, sf_dir), root, LoadSettings(AS_OF_YEAR, by_issue_year()))
    tables = open_star(spark, root, verify=True).tables
    return digest_report({name: tables[name] for name in S.STAR})


def _batches(spark: SparkSession, sf_dir: str) -> list[dict]:
    """The raw files with the citations in two parts that overlap in time, the later one first."""
    whole = raw_files.all_files(spark, sf_dir)
    early = F.coalesce(F.year("issue_date") < 1998, F.lit(False)) | (F.crc32("summons_number") % 5 == 0)
    return [whole | {"stage_violation": raw_files.citations_file(spark, sf_dir, ";", part)} for part in (~early, early)]


@query
def load_batches_vehicle(spark, sf_dir):
    """Vehicles after a second batch of older citations was merged into the stored state."""
    root = scratch_path(spark, "warehouse")
    for batch in _batches(spark, sf_dir):
        loaded = load_batch(spark, batch, root, LoadSettings(AS_OF_YEAR))
    return loaded.tables["vehicle"]


@query
def load_batches_digests(spark, sf_dir):
    """The content of the star after two batches; the same as of one load."""
    root = scratch_path(spark, "warehouse")
    for batch in _batches(spark, sf_dir):
        load_batch(spark, batch, root, LoadSettings(AS_OF_YEAR, by_issue_year()))
    tables = open_star(spark, root, verify=True).tables
    return digest_report({name: tables[name] for name in S.STAR})


# --- Predicates and scalars ---------------------------------------------------------------


@query
def filter_plate_not_null(spark, sf_dir):
    return stage.with_plate(_citations(spark, sf_dir)).select("summons_number", "plate_id")


@query
def pred_time_format(spark, sf_dir):
    return _from_stage(
        spark,
        sf_dir,
        violation_time_ok=times.has_time_format(F.col("violation_time")),
        first_observed_ok=times.has_time_format(F.col("time_first_observed")),
    )


def _clock() -> tuple[Column, Column]:
    return (
        times.normalize_time(F.col("violation_time")),
        times.normalize_time(F.col("time_first_observed")),
    )


@query
def normalize_time(spark, sf_dir):
    of_citation, of_observation = _clock()
    return _from_stage(
        spark,
        sf_dir,
        raw_violation_time=F.col("violation_time"),
        raw_first_observed=F.col("time_first_observed"),
        violation_time=of_citation,
        time_first_observed=of_observation,
    )


@query
def minutes_of_day(spark, sf_dir):
    return _from_stage(
        spark,
        sf_dir,
        violation_minutes=times.citation_minutes(*_clock()),
        first_observed_minutes=times.first_observed_minutes(*_clock()),
    )


@query
def minutes_of_day_literal(spark, sf_dir):
    return _from_stage(
        spark,
        sf_dir,
        violation_minutes=times.citation_minutes(*_clock()),
        first_observed_minutes=times.first_observed_minutes(*_clock(), literal=True),
    )


@query
def parse_comma_date(spark, sf_dir):
    text = F.col("date_first_observed")
    return _from_stage(
        spark,
        sf_dir,
        raw_date=text,
        parsed_date=dates.parse_comma_date(text),
        filled_date=dates.first_observed_date(text, F.col("issue_date")),
    )


@query
def clean_vehicle_year(spark, sf_dir):
    return _from_stage(
        spark, sf_dir, vehicle_year=codes.valid_model_year(F.col("vehicle_year"), AS_OF_YEAR)
    )


@query
def fill_precinct(spark, sf_dir):
    precinct = codes.fill_precinct(F.col("violation_precinct"), F.col("issuer_precinct"))
    return _from_stage(spark, sf_dir, violation_precinct=precinct)


_SIDE = "violation_in_front_of_or_opposite"


@query
def map_front_opposite(spark, sf_dir):
    return _from_stage(spark, sf_dir, side=codes.front_or_opposite(F.col(_SIDE)))


@query
def map_front_opposite_literal(spark, sf_dir):
    return _from_stage(spark, sf_dir, side=codes.front_or_opposite(F.col(_SIDE), literal=True))


@query
def coalesce_defaults(spark, sf_dir):
    codes_table = _ready(spark, sf_dir, "violation_code")
    rows = codes_table.join(
        _citations(spark, sf_dir), F.col("violation_code"), {"code": "_code"}
    )
    texts = ["house_number", "street_name", "intersecting_street", "sub_division"]
    return rows.select(
        "summons_number",
        *[codes.or_unknown(F.col(c)).alias(c) for c in texts],
        F.coalesce("_code", F.lit(V.OTHER_VIOLATION_CODE)).alias("violation_code"),
    )


@query
def surrogate_vehicle(spark, sf_dir):
    return star.violation_fact(_stored_stage2(spark, sf_dir)).select("summons_number", "vehicle")


@query
def surrogate_location(spark, sf_dir):
    return star.violation_fact(_stored_stage2(spark, sf_dir)).select("summons_number", "location")


_VEHICLE_PARTS = ("registration_state", "plate_id", "vehicle_body_type")


@query
def vehicle_id_concat(spark, sf_dir):
    parts = [F.col(name) for name in _VEHICLE_PARTS]
    return _from_stage(spark, sf_dir, vehicle_id=keys.concat_parts(parts))


@query
def fill_times_both_ways(spark, sf_dir):
    of_citation, of_observation = _clock()
    return _from_stage(
        spark,
        sf_dir,
        violation_time=F.coalesce(of_citation, of_observation),
        time_first_observed=F.coalesce(of_observation, of_citation),
    )


# --- Joins --------------------------------------------------------------------------------


def _described(spark, sf_dir, column: str, alias: str, how="left", fold_case=True) -> DataFrame:
    description = CODE_TABLES[column][2]
    ready = _ready(spark, sf_dir, column, fold_case)
    return ready.join(_citations(spark, sf_dir), F.col(column), {description: f"_{alias}"}, how)


@query
def lookup_inner_state(spark, sf_dir):
    rows = _described(spark, sf_dir, "registration_state", "state", "inner")
    return rows.select("summons_number", F.col("_state").alias("state"))


@query
def lookup_inner_plate_type(spark, sf_dir):
    rows = _described(spark, sf_dir, "plate_type", "type", "inner")
    return rows.select("summons_number", F.col("_type").alias("plate_type"))


@query
def lookup_left_violation_code(spark, sf_dir):
    rows = _described(spark, sf_dir, "violation_code", "text")
    return rows.select("summons_number", "violation_code", F.col("_text").alias("description"))


@query
def lookup_left_body_type(spark, sf_dir):
    rows = _described(spark, sf_dir, "vehicle_body_type", "type")
    return rows.select("summons_number", "vehicle_body_type", F.col("_type").alias("body_type"))


@query
def lookup_left_body_type_literal(spark, sf_dir):
    ready = _ready(spark, sf_dir, "vehicle_body_type")
    code = F.col("violation_code").cast("string")
    rows = ready.join(_citations(spark, sf_dir), code, {"type": "body_type"})
    return rows.select("summons_number", "violation_code", "body_type")


@query
def lookup_left_agency(spark, sf_dir):
    rows = _described(spark, sf_dir, "issuing_agency", "agency")
    return rows.select("summons_number", "issuing_agency", F.col("_agency").alias("agency"))


@query
def lookup_left_county(spark, sf_dir):
    rows = _described(spark, sf_dir, "violation_county", "county")
    county = codes.or_unknown(F.col("_county")).alias("county")
    return rows.select("summons_number", "violation_county", county)


@query
def lookup_left_color(spark, sf_dir):
    rows = _described(spark, sf_dir, "vehicle_color", "color")
    return rows.select("summons_number", "vehicle_color", F.col("_color").alias("color"))


@query
def map_left_case_sensitive(spark, sf_dir):
    rows = _described(spark, sf_dir, "registration_state", "state", fold_case=False)
    return rows.select("summons_number", "registration_state", F.col("_state").alias("state"))


@query
def map_dictionary(spark, sf_dir):
    side = codes.map_values(F.col(_SIDE), V.FRONT_OR_OPPOSITE)
    return _from_stage(spark, sf_dir, side=side)


def _unmatched(spark, sf_dir, fold_case: bool = False) -> DataFrame:
    lookups = {
        column: (_lookup(spark, sf_dir, column, fold_case), entry[2])
        for column, entry in CODE_TABLES.items()
    }
    return unmatched(_citations(spark, sf_dir), lookups)


@query
def unmatched_codes(spark, sf_dir):
    return _unmatched(spark, sf_dir)


@query
def unmatched_codes_folded(spark, sf_dir):
    """Codes that no lookup holds in any spelling."""
    return _unmatched(spark, sf_dir, fold_case=True)


@query
def unmatched_counts(spark, sf_dir):
    return unmatched_totals(_unmatched(spark, sf_dir))


# --- Datasets -----------------------------------------------------------------------------


@query
def stage2_violation(spark, sf_dir):
    return _stage2(spark, sf_dir)


@query
def stage2_violation_literal(spark, sf_dir):
    return _stage2(spark, sf_dir, literal=True)


@query
def dim_violation_code(spark, sf_dir):
    return star.violation_code_dimension(
        fixtures.staging_table(spark, sf_dir, "stage_violation_code")
    )


@query
def dim_date(spark, sf_dir):
    return star.date_dimension(_stored_stage2(spark, sf_dir))


@query
def dim_time(spark, sf_dir):
    return star.time_dimension(_stored_stage2(spark, sf_dir))


@query
def dim_location(spark, sf_dir):
    return star.location_dimension(_stored_stage2(spark, sf_dir))


@query
def dim_vehicle(spark, sf_dir):
    return star.vehicle_dimension(_stored_stage2(spark, sf_dir))


@query
def fact_violation(spark, sf_dir):
    return star.violation_fact(_stored_stage2(spark, sf_dir))


@query
def dim_time_literal(spark, sf_dir):
    return star.time_dimension(_stage2(spark, sf_dir, literal=True), literal=True)


@query
def fact_violation_literal(spark, sf_dir):
    return star.violation_fact(_stage2(spark, sf_dir, literal=True), literal=True)


# --- Last known values --------------------------------------------------------------------


@query
def last_body_type(spark, sf_dir):
    stage2 = _stored_stage2(spark, sf_dir)
    return star.last_known_attribute(stage2, "vehicle_body_type", "body_type", V.UNKNOWN)


@query
def last_maker(spark, sf_dir):
    return star.last_known_attribute(_stored_stage2(spark, sf_dir), "vehicle_make", "maker", V.UNKNOWN)


@query
def last_expiration_date(spark, sf_dir):
    stage2 = _stored_stage2(spark, sf_dir)
    return star.last_known_attribute(stage2, "vehicle_expiration_date", "expiration_date")


@query
def last_color(spark, sf_dir):
    return star.last_known_attribute(_stored_stage2(spark, sf_dir), "vehicle_color", "color", V.UNKNOWN)


@query
def last_make_year(spark, sf_dir):
    return star.last_known_attribute(_stored_stage2(spark, sf_dir), "vehicle_year", "make_year")


# --- Sets and sorts -----------------------------------------------------------------------

_STREETS = ("street_code1", "street_code2", "street_code3")


@query
def all_street_codes(spark, sf_dir):
    columns = [F.col(name) for name in _STREETS]
    return keyed.union_distinct(_citations(spark, sf_dir), columns, "street_code")


@query
def head_n(spark, sf_dir):
    rows = _citations(spark, sf_dir).select("summons_number", "plate_id", "issue_date")
    return profile.head(rows, [F.asc("summons_number")])


# --- Profile ------------------------------------------------------------------------------


@query
def count_rows(spark, sf_dir):
    return checks.row_counts(fixtures.staging(spark, sf_dir))


def _percentages(spark, sf_dir, literal: bool) -> DataFrame:
    measures = {
        c: {"percentage": checks.non_null_percentage(c, literal)} for c in ("plate_id", "issue_date")
    }
    return profile.measure(_citations(spark, sf_dir), "column_name", measures)


@query
def non_null_percentage(spark, sf_dir):
    return _percentages(spark, sf_dir, literal=False)


@query
def non_null_percentage_literal(spark, sf_dir):
    return _percentages(spark, sf_dir, literal=True)


@query
def value_counts(spark, sf_dir):
    """Frequencies of codes, and of agencies by their description."""
    rows = _described(spark, sf_dir, "issuing_agency", "agency").withColumnRenamed("_agency", "agency")
    return profile.value_counts(rows, VALUE_COLUMNS)


@query
def distinct_values(spark, sf_dir):
    return profile.distinct_values(_citations(spark, sf_dir), DISTINCT_COLUMNS)


@query
def distinct_attributes(spark, sf_dir):
    return profile.distinct_attributes(_citations(spark, sf_dir), VEHICLE_ATTRIBUTES)


@query
def profile_columns(spark, sf_dir):
    return profile.profile_columns(_citations(spark, sf_dir), PROFILE_COLUMNS)


def _sketches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sketches of each issue year, stored as each year's load would."""
    parts = sketches.column_sketches(_citations(spark, sf_dir), PROFILE_COLUMNS, F.year("issue_date"))
    return stored(parts, "sketches")


@query
def profile_merged(spark, sf_dir):
    """The profile of all columns from the years' sketches, and whether its estimates keep their bound."""
    merged = sketches.merged_profile(_sketches(spark, sf_dir))
    exact = profile.distinct_values(_citations(spark, sf_dir), PROFILE_COLUMNS).filter("value IS NOT NULL")
    counted = exact.groupBy("column_name").agg(F.count("*").alias("distinct_count"))
    apart = F.abs(F.col("distinct_estimate") - F.col("distinct_count")) / F.col("distinct_count")
    return merged.join(counted, "column_name").select(
        "column_name",
        "row_count",
        "value_count",
        "smallest",
        "largest",
        "distinct_count",
        (apart <= 3 * sketches.RELATIVE_ERROR).alias("within_bound"),
    )


@query
def frequent_values_merged(spark, sf_dir):
    """The most frequent values of code columns, from the years' sketches."""
    found = sketches.merged_frequent_values(_sketches(spark, sf_dir), FREQUENT_VALUES)
    return found.filter(F.col("column_name").isin(*FREQUENT_COLUMNS))


@query
def profile_null_rows(spark, sf_dir):
    rows = profile.rows_where_null(_citations(spark, sf_dir), "vehicle_make")
    return rows.select("summons_number", "vehicle_body_type")


@query
def profile_sentinel(spark, sf_dir):
    zero = F.lit(V.ZERO_CODE)
    sentinels = {
        "violation_precinct": zero,
        "issuer_precinct": zero,
        "date_first_observed": F.lit(V.ZERO_DATE),
        "vehicle_year": zero,
        "issuer_code": zero,
        "feet_from_curb": zero,
        "unregistered_vehicle": zero.cast("string"),
    }
    return profile.sentinel_counts(_citations(spark, sf_dir), sentinels)


@query
def profile_duplicates(spark, sf_dir):
    return profile.duplicate_profile(_citations(spark, sf_dir), DUPLICATE_COLUMNS)


@query
def profile_out_of_range(spark, sf_dir):
    outside = {"vehicle_year": codes.is_implausible_year(F.col("vehicle_year"), AS_OF_YEAR)}
    return profile.out_of_range_counts(_citations(spark, sf_dir), outside)


@query
def profile_column_agreement(spark, sf_dir):
    precinct = F.col("violation_precinct")
    pairs = {
        "location_and_precinct": (F.col("violation_location"), precinct.cast("string")),
        "precinct_and_issuer": (precinct, F.col("issuer_precinct")),
    }
    return profile.agreement(_citations(spark, sf_dir), pairs)


@query
def profile_regex_all(spark, sf_dir):
    column = F.col("date_first_observed")
    rules = {"date_first_observed": (column, F.lit(V.ZERO_DATE), V.COMMA_DATE_PATTERN)}
    return profile.all_match(_citations(spark, sf_dir), rules)


@query
def conflicting_plates(spark, sf_dir):
    vehicles = profile.distinct_attributes(_citations(spark, sf_dir), VEHICLE_ATTRIBUTES)
    return keyed.repeated_key_rows(vehicles, ["plate_id"]).orderBy(*VEHICLE_ATTRIBUTES)


@query
def conflicting_plate_types(spark, sf_dir):
    rows = _described(spark, sf_dir, "plate_type", "type", fold_case=False)
    named = rows.select(
        keys.concat_parts([F.col(name) for name in _VEHICLE_PARTS]).alias("vehicle_id"),
        F.col("_type").alias("class_description"),
    )
    columns = ["vehicle_id", "class_description"]
    pairs = profile.distinct_attributes(named, columns, required=["vehicle_id"])
    return keyed.repeated_key_rows(pairs, ["vehicle_id"]).orderBy(*columns)


def _precinct_conflicts(spark, sf_dir) -> DataFrame:
    columns = [*_STREETS, "violation_precinct", "house_number"]
    places = profile.distinct_attributes(_citations(spark, sf_dir), columns)
    return keyed.repeated_key_rows(places, _STREETS)


@query
def conflicting_precincts(spark, sf_dir):
    return _precinct_conflicts(spark, sf_dir).orderBy(*_precinct_order())


@query
def head_conflicting_precincts(spark, sf_dir):
    return profile.head(_precinct_conflicts(spark, sf_dir), _precinct_order(), HEAD_PRECINCTS)


def _precinct_order() -> list[Column]:
    return [
        *[F.desc_nulls_last(name) for name in _STREETS],
        F.asc_nulls_first("violation_precinct"),
        F.asc_nulls_first("house_number"),
    ]


def _date_parses() -> dict[str, Column]:
    commas_removed = F.replace("date_first_observed", F.lit(","), F.lit(""))
    return {
        "issue_date_text": dates.parse_date(F.col("issue_date_text"), V.ISSUE_DATE_FORMAT),
        "expiration_date_text": dates.parse_date(
            F.col("expiration_date_text"), V.COMPACT_DATE_FORMAT
        ),
        "date_first_observed": dates.parse_date(commas_removed, V.COMPACT_DATE_FORMAT),
    }


@query
def bad_dates(spark, sf_dir):
    return profile.unparsed_values(fixtures.raw_dates(spark, sf_dir), _date_parses())


@query
def bad_date_counts(spark, sf_dir):
    return profile.parsed_totals(fixtures.raw_dates(spark, sf_dir), _date_parses())


@query
def lost_dates(spark, sf_dir):
    """Texts per date column that a load with detected dates turns into null."""
    texts = {"issue_date": "mixed_date_text", "vehicle_expiration_date": "expiration_date_text"}
    lost = dates.lost_dates({name: F.col(text) for name, text in texts.items()})
    rows = fixtures.raw_dates(spark, sf_dir)
    return profile.measure(rows, "column_name", {c: {"lost": n} for c, n in lost.items()})


@query
def bad_times(spark, sf_dir):
    stand_ins = {
        "violation_time": "time_first_observed",
        "time_first_observed": "violation_time",
    }
    return profile.bad_time_counts(_citations(spark, sf_dir), stand_ins)


# --- Quality ------------------------------------------------------------------------------


@query
def check_stage(spark, sf_dir):
    return gates.raw_gate(_citations(spark, sf_dir))


@query
def check_fact_dimension(spark, sf_dir):
    return gates.loaded_gate(_star(spark, sf_dir))


@query
def quality_report(spark, sf_dir):
    return checks.union_reports([check_stage(spark, sf_dir), check_fact_dimension(spark, sf_dir)])


@query
def check_has_rows(spark, sf_dir):
    return checks.run_checks(_citations(spark, sf_dir), [checks.has_rows()])


@query
def check_min_percentage(spark, sf_dir):
    return checks.run_checks(_citations(spark, sf_dir), [checks.min_percentage("vehicle_make", 95)])


STATEMENTS = (
    checks.Statement("has_citations", "SELECT count(*) AS n FROM {citations}", "n > 0"),
    checks.Statement(
        "makes_filled",
        "SELECT 100.0D * count(vehicle_make) / count(*) AS share FROM {citations}",
        "share >= 95",
    ),
    checks.Statement("every_state_coded", "SELECT state_code FROM {states}", "length(state_code) = 2", None),
    checks.Statement("years_known", "SELECT vehicle_year FROM {citations}", "vehicle_year > 0", None),
)


@query
def check_statements(spark, sf_dir):
    """Statements of one and of many records, each judged where its records are made."""
    tables = {
        "citations": _citations(spark, sf_dir),
        "states": fixtures.staging_table(spark, sf_dir, "stage_state"),
    }
    return checks.union_reports([checks.statement_report(spark, s, tables) for s in STATEMENTS])


@query
def check_primary_keys(spark, sf_dir):
    return checks.primary_key_report(_star(spark, sf_dir), S.PRIMARY_KEYS)


@query
def check_references(spark, sf_dir):
    tables = _star(spark, sf_dir)
    return checks.reference_report(tables["violation"], tables, S.REFERENCES)


@query
def check_null_keys(spark, sf_dir):
    columns = {"vehicle": ["id"], "location": ["id"], "violation": ["vehicle", "location"]}
    return checks.null_key_report(_star(spark, sf_dir), columns)


def _bucketed(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """Facts and vehicles of the stored star in matching buckets of the vehicle key."""

    def make(path: str) -> dict[str, DataFrame]:
        tables, count = _star(spark, sf_dir), int(spark.conf.get("spark.sql.shuffle.partitions"))
        return {
            name: create_bucketed(tables[name], f"{path}/{name}", S.STAR[name], Buckets(key, count))
            for name, key in (("violation", "vehicle"), ("vehicle", "id"))
        }

    return _once(spark, sf_dir, "bucketed", make)


@query
def check_vehicle_reference_bucketed(spark, sf_dir):
    tables = _bucketed(spark, sf_dir)
    return checks.orphan_report(tables["violation"], "vehicle", tables["vehicle"], "id")


# --- Questions ----------------------------------------------------------------------------


@query
def top_months(spark, sf_dir):
    tables = _star(spark, sf_dir)
    return questions.top_months(tables["violation"], tables["date"])


@query
def top_hours(spark, sf_dir):
    tables = _star(spark, sf_dir)
    return questions.top_hours(tables["violation"], tables["time"])


@query
def top_vehicle_types(spark, sf_dir):
    tables = _star(spark, sf_dir)
    return questions.top_vehicle_types(tables["violation"], tables["vehicle"])


@query
def top_vehicle_types_bucketed(spark, sf_dir):
    tables = _bucketed(spark, sf_dir)
    return questions.top_vehicle_types(tables["violation"], tables["vehicle"])


@query
def citations_of_month_and_county(spark, sf_dir):
    """Citations per day and county of one month and county, from files clustered by both."""

    def make(path: str) -> dict[str, DataFrame]:
        count = 4 * int(spark.conf.get("spark.sql.shuffle.partitions"))
        rows = clustered(_stored_stage2(spark, sf_dir), ["issue_date", "violation_county"], count)
        return {"stage2": create_table(rows, f"{path}/stage2", S.STAGE2_VIOLATION)}

    rows = _once(spark, sf_dir, "clustered", make)["stage2"]
    first, county = MONTH_AND_COUNTY
    month = F.col("issue_date").between(F.to_date(F.lit(first)), F.last_day(F.to_date(F.lit(first))))
    found = rows.filter(month & (F.col("violation_county") == county))
    return found.groupBy("issue_date", "violation_county").agg(F.count("*").alias("n"))


@query
def all_places_ranked(spark, sf_dir):
    tables = _star(spark, sf_dir)
    return questions.top_places(tables["violation"], tables["location"])


@query
def top_places(spark, sf_dir):
    tables = _star(spark, sf_dir)
    return questions.top_places(tables["violation"], tables["location"], TOP_PLACES)
