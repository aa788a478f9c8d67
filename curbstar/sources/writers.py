"""Table loads: full refresh and append, always bound by name, and the versions of whole runs."""

from __future__ import annotations

import uuid
from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from curbstar.sources import files, manifest
from curbstar.sources.schemas import conform

def replace_table(
    df: DataFrame,
    path: str,
    schema: StructType,
    columns: Sequence[str] | None = None,
    partition_by: Mapping[str, Column] | None = None,
) -> DataFrame:
    """Replace the table at ``path`` with ``df`` and return the stored table.

    The rows are written beside the table first and take its place when they are complete, so
    a load that fails leaves the earlier rows readable. ``columns`` loads only these columns and
    leaves the others null. ``partition_by`` names the directory columns and their expressions;
    each task writes its own rows by directory, without a shuffle.
    """
    beside = f"{path.rstrip('/')}.new-{uuid.uuid4().hex}"
    try:
        _load(df, beside, schema, "errorifexists", columns, partition_by)
        _take_place(df.sparkSession, beside, path)
    except BaseException:
        files.delete(df.sparkSession, beside)
        raise
    return read_table(df.sparkSession, path, schema, tuple(partition_by or ()))


def append_table(
    df: DataFrame,
    path: str,
    schema: StructType,
    columns: Sequence[str] | None = None,
    partition_by: Mapping[str, Column] | None = None,
) -> DataFrame:
    """Add the rows of ``df`` to the table at ``path``; arguments as in replace_table."""
    _load(df, path, schema, "append", columns, partition_by)
    return read_table(df.sparkSession, path, schema, tuple(partition_by or ()))


def create_table(
    df: DataFrame, path: str, schema: StructType, partition_by: Mapping[str, Column] | None = None
) -> DataFrame:
    """Write a new table at a path that nothing reads yet; arguments as in replace_table."""
    _load(df, path, schema, "errorifexists", None, partition_by)
    return read_table(df.sparkSession, path, schema, tuple(partition_by or ()))


def read_table(
    spark: SparkSession,
    path: str | list[str],
    schema: StructType,
    directories: Sequence[str] = (),
    where: Column | None = None,
) -> DataFrame:
    """The declared columns of a stored table, by name; of several folders, their rows together.

    ``where`` may use the directory columns named in ``directories``, and then other folders are
    not opened; the columns themselves are left out.
    """
    if not isinstance(path, str):
        # Folders with directory columns can't be opened together.
        parts = [read_table(spark, folder, schema, directories, where) for folder in path]
        return reduce(DataFrame.unionByName, parts)
    stored = spark.read.parquet(path)
    missing = [name for name in directories if name not in stored.columns]
    if missing:
        raise ValueError(f"{path} has no directory columns {missing}")
    if where is not None:
        stored = stored.filter(where)
    return conform(stored.select(*[c for c in stored.columns if c in schema.names]), schema)


def record_run(spark: SparkSession, root: str, run_id: str) -> None:
    """Note that all tables of a run are complete, as the version after the newest.

    Readers go through the versions, so they see a whole run or the one before it, never a
    table that is being replaced.
    """
    newest = manifest.versions(spark, root)
    manifest.commit(spark, root, newest[-1] if newest else 0, run_id)


def latest_run(spark: SparkSession, root: str) -> str:
    """Id of the last complete run under ``root``."""
    newest = manifest.current(spark, root)
    if newest is None:
        raise ValueError(f"No run under {root} is complete")
    return newest.run_id


def expire_runs(spark: SparkSession, root: str, keep: int = 1) -> list[str]:
    """Delete what the last ``keep`` versions don't name of the runs before them; the ids of runs that went.

    At least the current version stays, and with it the folders that it took over from earlier runs.
    Folders of runs without a version are left alone, since they may still be loading.
    """
    if keep < 1:
        raise ValueError("The current run can't be expired")
    found = manifest.versions(spark, root)
    kept = [manifest.at_version(spark, root, v) for v in found[-keep:]]
    needed = {folder for m in kept for folders in m.folders.values() for folder in folders}
    whole = {m.run_id for m in kept}
    gone = []
    for version in found[:-keep]:
        run_id = manifest.at_version(spark, root, version).run_id
        folder = f"runs/{run_id}"
        own = [f"{folder}/{name}" for name in files.names(spark, f"{root.rstrip('/')}/{folder}")]
        expired = [path for path in own if path not in needed]
        if run_id in whole or not expired:
            continue
        if len(expired) == len(own):
            expired = [folder]
            gone.append(run_id)
        for path in expired:
            files.delete(spark, f"{root.rstrip('/')}/{path}")
    return gone


def run_table_path(root: str, run_id: str, table: str) -> str:
    return f"{root.rstrip('/')}/runs/{run_id}/{table}"


def _load(
    df: DataFrame,
    path: str,
    schema: StructType,
    mode: str,
    columns: Sequence[str] | None,
    partition_by: Mapping[str, Column] | None,
) -> None:
    if columns is not None:
        df = df.select(
            *[
                F.col(f.name) if f.name in columns else F.lit(None).cast(f.dataType).alias(f.name)
                for f in schema
            ]
        )
    rows = conform(df, schema)
    if partition_by:
        rows = rows.withColumns(dict(partition_by))
    writer = rows.write.mode(mode)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)


def _take_place(spark: SparkSession, beside: str, path: str) -> None:
    """Move a complete table to ``path``; the one that was there goes last."""
    old = f"{path.rstrip('/')}.old-{uuid.uuid4().hex}"
    target, store = files.located(spark, path)
    former, source = files.located(spark, old)[0], files.located(spark, beside)[0]
    if store.exists(target) and not store.rename(target, former):
        raise OSError(f"{path} can't be moved")
    if not store.rename(source, target):
        store.rename(former, target)
        raise OSError(f"{beside} can't be moved to {path}")
    store.delete(former, True)
