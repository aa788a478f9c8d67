"""The whole load: raw files, staging, gate, stage 2, star, gate, a new version; and loads of further batches."""

from __future__ import annotations

import itertools
import uuid
from collections.abc import Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field, replace
from typing import Literal

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from curbstar.operators import checks
from curbstar.operators.digest import NAMES, digest_report, digested, sum_of
from curbstar.operators.lookup import BROADCAST_LIMIT_BYTES, prepare_lookups
from curbstar.operators.observe import checked
from curbstar.plans import gates, stage, star
from curbstar.sources import manifest
from curbstar.sources.readers import read_delimited, read_json_paths, read_path_list
from curbstar.sources.schemas import STAGING, STAR, TABLES, conform
from curbstar.sources.scratch import discard, stored
from curbstar.sources.writers import create_table, read_table, run_table_path

# --- Fixed values: record fields of the JSON code tables, in column order -----------------
JSON_PATHS = {
    "stage_vehicle_body_type": ["$['Body Code']", "$['Body Style Description']"],
    "stage_vehicle_plate_type": ["$['Class Code']", "$['Class Description']"],
    "stage_vehicle_color": ["$['Color Code']", "$['Color Description']"],
    "stage_county": ["$['County Code']", "$['County']"],
    "stage_issuing_agency": ["$['Code']", "$['Agency']"],
}
# ------------------------------------------------------------------------------------------


@dataclass(frozen=True)
class Delimited:
    """A raw text file with a header line."""

    path: str | list[str]
    sep: str = ","
    any_date: bool = False
    mode: str = "FAILFAST"
    multiline: bool | Literal["split"] = False
    date_neighbours: Mapping[str, Column | None] | None = None

    def read(self, spark: SparkSession, table: str) -> DataFrame:
        return read_delimited(
            spark,
            self.path,
            STAGING[table],
            self.sep,
            self.any_date,
            mode=self.mode,
            multiline=self.multiline,
            date_neighbours=self.date_neighbours,
        )


@dataclass(frozen=True)
class JsonRecords:
    """A raw JSON file, with its record paths or a file that lists them."""

    path: str | list[str]
    paths: Sequence[str] | None = None
    path_list: str | None = None
    layout: Literal["lines", "array", "split_array"] = "array"

    def read(self, spark: SparkSession, table: str) -> DataFrame:
        paths = self.paths or JSON_PATHS[table]
        if self.path_list:
            paths = read_path_list(spark, self.path_list)
        return read_json_paths(spark, self.path, paths, STAGING[table], self.layout)


@dataclass(frozen=True)
class LoadSettings:
    """``as_of_year`` bounds model years, so that a rerun gives the same star.

    ``literal=True`` keeps the older outputs of stage 2 and of the stand-in times. ``keep_state``
    stores the state of vehicles, which later batches update; without it the first batch makes it
    from the stored stage 2. ``replace_newer`` lets a whole load take the place of a version that
    another load made meanwhile, instead of being refused.
    """

    as_of_year: int
    fact_partition: Mapping[str, Column] | None = None
    broadcast_limit_bytes: int = BROADCAST_LIMIT_BYTES
    require_unique_keys: bool = False
    literal: bool = False
    keep_state: bool = False
    replace_newer: bool = False


@dataclass(frozen=True)
class LoadedStar:
    run_id: str
    tables: dict[str, DataFrame] = field(repr=False)
    version: int = 0
    #: Rows of the gates' reports: check_name, value, threshold, passed.
    report: list[tuple] = field(default_factory=list, repr=False)


STATE = "vehicle_state"
#: Tables that a batch adds rows to; the others it writes anew.
GROWING = ("stage2_violation", "violation")


class _Run:
    """The tables that one load writes: each to a folder of its own, gates and digests measured meanwhile."""

    def __init__(self, spark: SparkSession, root: str, settings: LoadSettings):
        self.spark, self.root, self.settings = spark, root, settings
        self.run_id = uuid.uuid4().hex
        self.folders: dict[str, list[str]] = {}
        self.digests: dict[str, dict[str, str]] = {}
        self.report: list[tuple] = []

    def write(self, name: str, df: DataFrame, gate: Sequence[checks.Check] = (), folder: str = "") -> DataFrame:
        """Store a table; its gate is evaluated by the write and enforced after it."""
        path = run_table_path(self.root, self.run_id, folder or name)
        digest = rows = None
        if name in TABLES:
            df = conform(df, TABLES[name])
        if name in STAR:
            df, digest = digested(df)
        df, rows = checked(df, gate)
        if name in TABLES:
            partition = self.settings.fact_partition if name == "violation" else None
            table = create_table(df, path, TABLES[name], partition)
        else:
            df.write.parquet(path)
            table = self.spark.read.schema(df.schema).parquet(path)
        self.folders[name] = [f"runs/{self.run_id}/{folder or name}"]
        if digest:
            self.digests[name] = digest() or digest_report({name: table}).select(*NAMES).first().asDict()
        found = rows()
        report = checks.run_checks(table, gate).collect() if found is None else found
        report = [tuple(row) for row in report]
        self.report += report
        checks.enforce_rows(report)
        return table

    def write_all(self, tables: Mapping[str, DataFrame], gates_of: Mapping[str, list[checks.Check]], folder: str = "{}"):
        """Independent tables side by side, so small ones fill the gaps of large ones."""
        with ThreadPoolExecutor(max_workers=len(tables) or 1) as pool:
            jobs = {
                name: pool.submit(self.write, name, df, gates_of.get(name, ()), folder.format(name)) for name, df in tables.items()
            }
            return {name: job.result() for name, job in jobs.items()}

    def stage2(self, files: Mapping[str, Delimited | JsonRecords]) -> tuple[DataFrame, dict[str, DataFrame]]:
        """Staging and stage 2 of raw files, stored; the citations pass their gate before stage 2."""
        missing = set(STAGING) - set(files)
        if missing:
            raise ValueError(f"No source for: {sorted(missing)}")
        raw = {name: files[name].read(self.spark, name) for name in STAGING}
        staging = self.write_all(raw, {"stage_violation": gates.raw_checks()})
        ready = prepare_lookups(stage.lookups(staging), self.settings.broadcast_limit_bytes)
        settings = self.settings
        cleaned = stage.stage2_violation(staging["stage_violation"], ready, settings.as_of_year, settings.literal)
        return self.write("stage2_violation", cleaned), staging

    def commit(self, based_on: int, folders: Mapping[str, list[str]], digests: Mapping[str, dict[str, str]]) -> LoadedStar:
        made = manifest.commit(self.spark, self.root, based_on, self.run_id, folders, digests)
        opened = open_star(self.spark, self.root, version=made.version)
        return LoadedStar(self.run_id, {name: opened.tables[name] for name in STAR}, made.version, self.report)


def load_star(
    spark: SparkSession,
    files: Mapping[str, Delimited | JsonRecords],
    root: str,
    settings: LoadSettings,
) -> LoadedStar:
    """Load one star from raw files; ``files`` names a source for each staging table.

    Every table goes to a fresh folder of this run, and its gate is measured by the write itself. The
    run becomes a version only after the last gate, so a failed run leaves the earlier star in place;
    so does one that finds another load's version made since it started.
    """
    run = _Run(spark, root, settings)
    base = _newest(spark, root)
    stage2, staging = run.stage2(files)
    made = star.star(stage2, staging["stage_violation_code"], settings.literal)
    if settings.keep_state:
        state = run.write(STATE, star.vehicle_state(stage2))
        made["vehicle"] = star.vehicles_of(state)
    tables = run.write_all(made, gates.table_checks(made))
    if settings.require_unique_keys:
        checks.enforce(gates.key_gate(tables))
    while True:
        try:
            return run.commit(base, run.folders, run.digests)
        except manifest.ConflictingLoad:
            if not settings.replace_newer:
                raise
            base = _newest(spark, root)


def load_batch(
    spark: SparkSession,
    files: Mapping[str, Delimited | JsonRecords],
    root: str,
    settings: LoadSettings,
) -> LoadedStar:
    """Add a batch of citations to the newest version; the first batch is a whole load.

    Facts and stage 2 get a further folder. Vehicles come from the stored state, which one join brings
    up to date, dates, times and places from the known ones and the batch's; no earlier citation is
    read again. Batches may come in any order. When another load makes a version meanwhile, the
    batch is merged into that one; what it read and cleaned stays. Violation codes are the batch's.
    """
    base = manifest.current(spark, root)
    if base is None:
        return load_star(spark, files, root, replace(settings, keep_state=True))
    run = _Run(spark, root, settings)
    stage2, staging = run.stage2(files)
    batch = star.star(stage2, staging["stage_violation_code"], settings.literal)
    del batch["vehicle"]
    further = {name: batch[name] for name in ("date", "time", "location")} | {STATE: star.vehicle_state(stage2)}
    with ThreadPoolExecutor(max_workers=len(further) + 1) as pool:
        facts = pool.submit(run.write, "violation", batch["violation"])
        jobs = {name: pool.submit(stored, df, name) for name, df in further.items()}
        further = {name: job.result() for name, job in jobs.items()}
        facts.result()
    batch_folders, batch_digests = dict(run.folders), dict(run.digests)
    for attempt in itertools.count():
        known = _tables(spark, root, base, None)
        if STATE in base.folders:
            earlier = _state(spark, root, base)
        else:
            earlier = star.vehicle_state(known["stage2_violation"])
        again = "{}" if not attempt else "{}-" + str(attempt)
        merged = run.write(STATE, star.merged_vehicle_state(earlier, further[STATE]), folder=again.format(STATE))
        tables = star.merged_dimensions(known, further)
        tables |= {"vehicle": star.vehicles_of(merged), "violation_code": batch["violation_code"]}
        run.write_all(tables, gates.table_checks(tables), again)
        folders = dict(run.folders) | {name: base.folders[name] + batch_folders[name] for name in GROWING}
        digests = dict(run.digests) | {"violation": sum_of([base.digests["violation"], batch_digests["violation"]])}
        if settings.require_unique_keys:
            made = _tables(spark, root, replace(base, folders=folders), None)
            checks.enforce(gates.key_gate({name: made[name] for name in STAR}))
        try:
            loaded = run.commit(base.version, folders, digests)
        except manifest.ConflictingLoad:
            base = manifest.current(spark, root)
            continue
        discard(*further.values())
        return loaded


def open_star(
    spark: SparkSession, root: str, where: Column | None = None, version: int | None = None, verify: bool = False
) -> LoadedStar:
    """The tables of the newest version under ``root``, or of ``version``.

    ``where`` filters the facts; by a directory column, such as ``issue_year``, it leaves the
    other folders unopened. ``verify`` reads all tables and compares their digests with those that
    the load measured.
    """
    found = manifest.current(spark, root) if version is None else manifest.at_version(spark, root, version)
    if found is None:
        raise ValueError(f"No run under {root} is complete")
    if verify:
        whole = _tables(spark, root, found, None)
        verify_digests({name: whole[name] for name in STAR}, found.digests)
    return LoadedStar(found.run_id, _tables(spark, root, found, where), found.version)


class DifferentContent(ValueError):
    """A stored table is not what its load wrote."""


def verify_digests(tables: Mapping[str, DataFrame], digests: Mapping[str, Mapping[str, str]]) -> None:
    """Raise if a table's rows differ from those that its digest stands for."""
    for row in digest_report(tables).collect():
        name = row["table_name"]
        have = {n: str(row[n]) for n in NAMES}
        want = {n: str(value) for n, value in digests.get(name, {}).items()}
        if have != want:
            raise DifferentContent(f"{name} has the digest {have}, its load measured {want or 'none'}")


def _newest(spark: SparkSession, root: str) -> int:
    found = manifest.versions(spark, root)
    return found[-1] if found else 0


def _paths(root: str, found: manifest.Manifest, name: str) -> list[str]:
    folders = found.folders.get(name) or [f"runs/{found.run_id}/{name}"]
    return [f"{root.rstrip('/')}/{folder}" for folder in folders]


def _tables(spark: SparkSession, root: str, found: manifest.Manifest, where: Column | None) -> dict[str, DataFrame]:
    tables = {name: read_table(spark, _paths(root, found, name), TABLES[name]) for name in ("stage2_violation", *STAR) if name != "violation"}
    facts = _paths(root, found, "violation")
    return tables | {"violation": read_table(spark, facts, TABLES["violation"], where=where)}


def _state(spark: SparkSession, root: str, found: manifest.Manifest) -> DataFrame:
    return spark.read.parquet(*_paths(root, found, STATE))


def by_issue_year() -> dict[str, Column]:
    """Directory column for a fact table split by issue year."""
    return {"issue_year": F.year("issue_date")}
