"""Tables stored in buckets of a key, so that joins and counts by it need no shuffle.

Two tables with as many buckets of keys of one type meet bucket by bucket. The number and the key are
recorded beside the table, and any session can open it by them.

Rows reach their bucket over several tasks, chosen by the rest of the row, so a key with a large part
of all rows is written by many. Reading, one task takes a bucket: with such a key in a table, join its
counts, as the rankings do, rather than its rows.
"""

from __future__ import annotations

import hashlib
import json
from dataclasses import asdict, dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from curbstar.sources import files
from curbstar.sources.schemas import conform

#: Tasks that write one bucket.
WRITERS = 4


@dataclass(frozen=True)
class Buckets:
    key: str
    count: int


def create_bucketed(df: DataFrame, path: str, schema: StructType, buckets: Buckets, writers: int = WRITERS) -> DataFrame:
    """Write a new table at ``path`` in buckets, record how, and open it."""
    rows = conform(df, schema)
    own = F.pmod(F.hash(buckets.key), F.lit(buckets.count))
    spread = F.pmod(F.xxhash64(*schema.names), F.lit(writers))
    rows = rows.repartition(buckets.count * writers, own, spread)
    name = _name(path)
    rows.write.bucketBy(buckets.count, buckets.key).sortBy(buckets.key).option("path", path).saveAsTable(name)
    files.put_if_absent(df.sparkSession, _record(path), json.dumps(asdict(buckets)))
    return df.sparkSession.table(name)


def open_bucketed(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """The table at ``path``, known to be in the buckets that its record names."""
    buckets = Buckets(**json.loads(files.read_text(spark, _record(path))))
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema)
    spark.sql(
        f"CREATE TABLE IF NOT EXISTS {_name(path)} ({columns}) USING parquet "
        f"CLUSTERED BY (`{buckets.key}`) SORTED BY (`{buckets.key}`) INTO {buckets.count} BUCKETS LOCATION '{path}'"
    )
    return spark.table(_name(path))


def close_bucketed(spark: SparkSession, path: str) -> None:
    """Forget the table's name in this session; its files stay."""
    spark.sql(f"DROP TABLE IF EXISTS {_name(path)}")


def _name(path: str) -> str:
    return f"curbstar_{hashlib.md5(path.encode()).hexdigest()}"


def _record(path: str) -> str:
    return f"{path.rstrip('/')}.buckets.json"
