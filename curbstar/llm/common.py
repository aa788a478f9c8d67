"""Small pieces that several operators share."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from curbstar.sources.scratch import stored

#: White space of the word definition ``[^\x20\x09-\x0D]+``.
SPACES = " \t\n\x0b\f\r"
WORD = "[^\\x20\\x09-\\x0D]+"

#: UTF-8 bytes of text that a task takes apart at a time.
PIECE_BYTES = 2_000_000

#: Bytes of the definition ``[^\x00-\x2F\x3A-\x60\x7B-\x7F]+`` after lower-casing A-Z: digits,
#: small letters and all of UTF-8 beyond ASCII stay, the rest separates.
PLAIN_WORD_BYTES = bytes(
    b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256)
)

#: Column of :func:`keyed`.
KEY = "__curbstar_key"
#: The place of a row without an id, after all ids.
LAST = (1 << 63) - 1

_MULTIPLIER = np.uint64(0x9E3779B97F4A7C15)
_INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` computed once, also where the body uses it in a lambda."""
    return F.transform(F.array(value), body)[0]


def space_words(text: str | None) -> list[bytes]:
    """Words ``[^\x20\x09-\x0D]+``, A-Z in lower case, as UTF-8."""
    return text.encode("utf-8", "surrogatepass").lower().split() if text else []


def plain_words(text: str | None) -> list[bytes]:
    """Words ``[^\x00-\x2F\x3A-\x60\x7B-\x7F]+``, A-Z in lower case, as UTF-8."""
    return text.encode("utf-8", "surrogatepass").translate(PLAIN_WORD_BYTES).split() if text else []


def pieces(batch: pa.RecordBatch, column: str = "text", most_bytes: int = PIECE_BYTES) -> Iterator[pa.RecordBatch]:
    """The rows of a batch in pieces of bounded text, so memory does not depend on how long texts are
    on average; a longer text is a piece of its own."""
    sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_pylist()
    start = total = 0
    for i, size in enumerate(sizes):
        if i > start and total + size > most_bytes:
            yield batch.slice(start, i - start)
            start, total = i, 0
        total += size
    if start < len(sizes):
        yield batch.slice(start)


def mixed(h: np.ndarray) -> np.ndarray:
    """A bijective finish that spreads each input bit over all 64."""
    with np.errstate(over="ignore"):
        h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


class WordRuns:
    """64-bit hashes of runs of words in many texts, computed on one byte buffer.

    Words of a text are joined by one space each, so a run's hash depends on its words alone.
    The hash of bytes ``s..e`` is a difference of prefix sums of ``byte * m**i``, moved back
    by ``m**-s``; all runs of one length cost a few array operations.
    """

    def __init__(self, texts: list[list[bytes]]):
        self.n_words = np.array([len(w) for w in texts], dtype=np.int64)
        buffer = np.frombuffer(b" ".join([b" ".join(w) for w in texts if w]) + b" ", dtype=np.uint8)
        if not self.n_words.sum():
            buffer = buffer[:0]
        self.ends = np.flatnonzero(buffer == 32)
        self.starts = np.concatenate([np.zeros(min(1, self.ends.size), dtype=np.int64), self.ends[:-1] + 1])
        self.first = np.concatenate([[0], np.cumsum(self.n_words)])
        size = buffer.size + 1
        with np.errstate(over="ignore"):
            power = np.full(size, _MULTIPLIER)
            power[0] = 1
            power = np.cumprod(power, dtype=np.uint64)
            self._sums = np.zeros(size, dtype=np.uint64)
            np.cumsum((buffer.astype(np.uint64) + np.uint64(1)) * power[:-1], dtype=np.uint64, out=self._sums[1:])
            del power
            self._back = np.full(size, _INVERSE)
            self._back[0] = 1
            self._back = np.cumprod(self._back, dtype=np.uint64)

    def hashes(self, first_word: np.ndarray, last_word: np.ndarray) -> np.ndarray:
        s, e = self.starts[first_word], self.ends[last_word]
        with np.errstate(over="ignore"):
            return mixed((self._sums[e] - self._sums[s]) * self._back[s])

    def runs(self, k: int) -> tuple[np.ndarray, np.ndarray]:
        """First words (numbered over all texts) and hashes of all runs of ``k`` words within a text."""
        owner_end = np.repeat(self.first[1:], self.n_words)
        at = np.arange(owner_end.size)
        at = at[at + k <= owner_end]
        return at, self.hashes(at, at + k - 1)


def keyed(documents: DataFrame, doc_id: str = "doc_id") -> DataFrame:
    """``documents`` with a key of each row's own in ``KEY``, in the order of ids, rows without an id last.

    Where no two rows share an id it is the key, and nothing is written. Else the rows are numbered
    in that order and stored once, so that every reading sees the same numbers.
    """
    own = documents.withColumn(KEY, F.coalesce(F.col(doc_id).cast("long"), F.lit(LAST)))
    if own.groupBy(KEY).agg(F.count("*").alias("n")).filter("n > 1").isEmpty():
        return own
    parts = int(documents.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rows = own.withColumn("__curbstar_row", F.monotonically_increasing_id())
    rows = rows.repartitionByRange(parts, KEY, "__curbstar_row").sortWithinPartitions(KEY, "__curbstar_row")
    return stored(rows.withColumn(KEY, F.monotonically_increasing_id()).drop("__curbstar_row"), "keyed")


def without(rows: DataFrame, keys: DataFrame) -> DataFrame:
    """The rows of a :func:`keyed` table whose key is not in ``keys``, without their key."""
    bad = keys.select(F.col(keys.columns[0]).alias("__curbstar_bad")).distinct()
    return rows.join(bad, F.col(KEY) == F.col("__curbstar_bad"), "left_anti").drop(KEY)
