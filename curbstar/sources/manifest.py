"""Versions of a star: one small file each, and only one load can write the next.

A version names the folders of every table, so a load may add a folder to a table and take over the
others. A load writes all its folders first and then tries to put the file of the version after the
one it started from. If another load was faster the file is there already, and the load is refused
or works its changes into the newer version. Readers take the newest file, so they see a whole
version or the one before it.
"""

from __future__ import annotations

import json
from collections.abc import Mapping
from dataclasses import asdict, dataclass, field
from datetime import datetime, timezone

from pyspark.sql import SparkSession

from curbstar.sources import files

_DIGITS = 12


class ConflictingLoad(RuntimeError):
    """Another load made a version since this one started."""


@dataclass(frozen=True)
class Manifest:
    """One version. ``folders`` are per table and relative to the root; ``digests`` per table."""

    version: int
    run_id: str
    folders: dict[str, list[str]] = field(default_factory=dict)
    digests: dict[str, dict[str, str]] = field(default_factory=dict)
    finished_at: str = ""


def current(spark: SparkSession, root: str) -> Manifest | None:
    """The newest version, if there is any."""
    found = versions(spark, root)
    return at_version(spark, root, found[-1]) if found else None


def versions(spark: SparkSession, root: str) -> list[int]:
    return [int(name[1 : 1 + _DIGITS]) for name in files.names(spark, _folder(root)) if name.endswith(".json") and name[0] == "v"]


def at_version(spark: SparkSession, root: str, version: int) -> Manifest:
    path = _path(root, version)
    if not files.exists(spark, path):
        raise ValueError(f"{root} has no version {version}")
    return Manifest(**json.loads(files.read_text(spark, path)))


def commit(
    spark: SparkSession,
    root: str,
    based_on: int,
    run_id: str,
    folders: Mapping[str, list[str]] | None = None,
    digests: Mapping[str, dict[str, str]] | None = None,
) -> Manifest:
    """Make the version after ``based_on`` (0 for the first); raise ConflictingLoad if it is there."""
    finished_at = datetime.now(timezone.utc).isoformat()
    made = Manifest(based_on + 1, run_id, dict(folders or {}), dict(digests or {}), finished_at)
    if not files.put_if_absent(spark, _path(root, made.version), json.dumps(asdict(made), indent=1)):
        raise ConflictingLoad(f"Version {made.version} of {root} was made by another load than {run_id}")
    return made


def _folder(root: str) -> str:
    return f"{root.rstrip('/')}/versions"


def _path(root: str, version: int) -> str:
    return f"{_folder(root)}/v{version:0{_DIGITS}d}.json"
