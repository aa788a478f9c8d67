"""Intermediate tables in the folder that the session shares between executors."""

from __future__ import annotations

import tempfile
import uuid

from py4j.protocol import Py4JError
from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession

_MARK = "/curbstar/"

#: Executors seen to share a folder that a path without a scheme names, by application and path.
_SHARING: dict[tuple[str, str], set[str]] = {}


def scratch_path(spark: SparkSession, purpose: str) -> str:
    """A fresh path under ``spark.checkpoint.dir``, else under the context's checkpoint folder.

    Without either a local session gets a temporary folder; a cluster gets an error, since its
    executors share no local folder. On a cluster a path without a scheme that lies on the local
    file system is tried first: what all executors write there must reach the driver. Else it is
    refused; a mount that is known to be shared is named with ``file://`` and not tried.
    """
    base = spark.conf.get("spark.checkpoint.dir", None) or _context_folder(spark)
    local = spark.conf.get("spark.master", "").startswith("local")
    if not base:
        if not local:
            raise ValueError("Set spark.checkpoint.dir to a folder all executors share")
        base = tempfile.mkdtemp(prefix="curbstar-")
    elif not local and "://" not in base and not base.startswith("file:") and _scheme(spark, base) == "file":
        if not _is_shared(spark, base):
            raise ValueError(f"{base} is a folder of one machine; name a shared mount as file://{base}")
    return f"{base.rstrip('/')}{_MARK}{purpose}-{uuid.uuid4().hex}"


def stored(df: DataFrame, purpose: str) -> DataFrame:
    """``df`` written once as Parquet and read back.

    For a result with several consumers: each reads only its columns, and a lost executor
    costs no recomputation of what lies before.
    """
    path = scratch_path(df.sparkSession, purpose)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def discard(*tables: DataFrame) -> None:
    """Delete scratch tables that nothing reads any more; only folders of :func:`stored` go."""
    for table in tables:
        spark = table.sparkSession
        for folder in {file.rpartition("/")[0] for file in table.inputFiles()}:
            if _MARK in folder:
                _delete(spark, folder)


def _is_shared(spark: SparkSession, base: str) -> bool:
    """Whether all executors write into the driver's own ``base``; tried anew when executors have joined.

    A local session has no executors that could tell.
    """
    context = spark.sparkContext
    if context._jsc.sc().isLocal():
        return False
    seen = _SHARING.setdefault((context.applicationId, base), set())
    while joined := _executors(spark) - seen:
        if not _all_arrive(spark, base):
            return False
        seen |= joined
    return True


def _executors(spark: SparkSession) -> set[str]:
    return {f"{e.host()}:{e.port()}" for e in spark.sparkContext._jsc.sc().statusTracker().getExecutorInfos()}


def _all_arrive(spark: SparkSession, base: str) -> bool:
    """Whether the driver finds a file of each of so many tasks that every executor writes some."""
    path = f"{base.rstrip('/')}{_MARK}shared-{uuid.uuid4().hex}"
    tasks = 4 * spark.sparkContext.defaultParallelism
    try:
        spark.range(0, tasks, 1, tasks).write.parquet(path)
        return len(spark.read.schema("id long").parquet(path).inputFiles()) == tasks
    except (PySparkException, Py4JError):
        return False
    finally:
        _delete(spark, path)


def _delete(spark: SparkSession, folder: str) -> None:
    path = _path(spark, folder)
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def _context_folder(spark: SparkSession) -> str | None:
    context = getattr(spark, "sparkContext", None)
    folder = context and context._jsc.sc().getCheckpointDir()
    return folder.get() if folder and folder.isDefined() else None


def _path(spark: SparkSession, path: str):
    return spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)


def _scheme(spark: SparkSession, path: str) -> str:
    hadoop = spark.sparkContext._jsc.hadoopConfiguration()
    return _path(spark, path).getFileSystem(hadoop).getUri().getScheme()
