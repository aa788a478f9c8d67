"""Records of large text files whose records don't end where lines do, read by many tasks per file.

A file is read in splits. Whether a split starts inside quotes, and how deep inside brackets, follows
from what all splits before it hold, so each is first reduced to its effect: whether it changes the
quoting, and by how much the depth for either start. Running sums of effects per file are the
states at the splits' starts. With them every task cuts its own split into records; what stands
before the first end and after the last one are fragments, of which there are two per split
at most, and only they move to be joined.

The text is read three times: for effects, records and fragments; nothing of it is shuffled or
gathered. The table of splits is sent to all tasks: at 128 MB a split, 10,000 rows stand for a terabyte.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator
from typing import Protocol

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

_EFFECTS = "file string, block long, quotes int, depth_outside long, depth_inside long"
_RECORDS = "file string, block long, place long, text string, opens boolean, closes boolean"
_Rows = Iterator[pa.RecordBatch]


class _Form(Protocol):
    """How a kind of file is cut: between ``separator`` and by a state of quoting and depth."""

    separator: str

    def effect(self, text: str, inside: bool) -> tuple[bool, int]: ...

    def ends(self, inside: bool, depth: int) -> bool: ...


class _Quoted:
    """Delimited text: a line ends a record unless it ends inside quotes."""

    separator = "\n"

    def effect(self, text: str, inside: bool) -> tuple[bool, int]:
        return inside != bool(text.count('"') % 2), 0

    def ends(self, inside: bool, depth: int) -> bool:
        return not inside


class _JsonArray:
    """An array of objects: a closing brace ends a record if it leads back to the array."""

    separator = "}"
    _escaped, _string = re.compile(r"\\.", re.S), re.compile(r'"[^"]*(?:"|$)')

    def effect(self, text: str, inside: bool) -> tuple[bool, int]:
        plain = self._escaped.sub("", text)
        after = inside != bool(plain.count('"') % 2)
        if inside:
            plain = plain.partition('"')[2]
        plain = self._string.sub("", plain)
        depth = plain.count("{") + plain.count("[") - plain.count("]")
        return after, depth - (not after)

    def ends(self, inside: bool, depth: int) -> bool:
        return not inside and depth == 1


def quoted_records(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """Records of delimited files with line breaks inside quotes: file, text, first (of its file)."""
    found = _records(spark, path, _Quoted())
    return found.select("file", F.regexp_replace("text", "\r$", "").alias("text"), "first").filter("text <> ''")


def array_records(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """Objects of files that hold one JSON array each: file, text."""
    found = _records(spark, path, _JsonArray()).filter("closed")
    return found.select("file", F.concat(F.regexp_replace("text", r"^[\s\[,]+", ""), F.lit("}")).alias("text"))


def _records(spark: SparkSession, path: str | list[str], form: _Form) -> DataFrame:
    """file, text, first, closed; pieces between separators are joined by them again."""
    read = spark.read.text(path, lineSep=form.separator)
    pieces = read.select(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"), F.col("value").alias("text"))
    before = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    # A task may take a split's rows in one go only, so a split has one row of effects.
    effects = pieces.mapInArrow(_effects(form), _EFFECTS)
    quoting = effects.withColumn("inside", F.coalesce(F.sum("quotes").over(before), F.lit(0)) % 2 == 1)
    own = F.when(F.col("inside"), F.col("depth_inside")).otherwise(F.col("depth_outside"))
    starts = quoting.withColumn("depth", F.coalesce(F.sum(own).over(before), F.lit(0)))
    stated = pieces.join(F.broadcast(starts.select("file", "block", "inside", "depth")), ["file", "block"])
    whole = stated.mapInArrow(_cut(form, whole=True), _RECORDS)
    parts = stated.mapInArrow(_cut(form, whole=False), _RECORDS)
    # A fragment belongs to the last one before it that opens a record.
    order = Window.partitionBy("file").orderBy("block", "place")
    owned = parts.withColumn("owner", F.sum(F.col("opens").cast("int")).over(order))
    joined = owned.groupBy("file", "owner").agg(
        F.array_sort(F.collect_list(F.struct("block", "place", "text"))).alias("parts"), F.bool_or("closes").alias("closed")
    )
    first = (F.col("block") == 0) & (F.col("place") == 0)
    return whole.select("file", "text", first.alias("first"), F.lit(True).alias("closed")).unionByName(
        joined.select(
            "file",
            F.array_join(F.transform("parts", lambda p: p["text"]), form.separator).alias("text"),
            ((F.col("parts")[0]["block"] == 0) & (F.col("parts")[0]["place"] == 0)).alias("first"),
            "closed",
        )
    )


def _splits(batches: _Rows) -> Iterator[tuple[tuple[str, int], pa.RecordBatch]]:
    """The rows of each split, a slice of a batch at a time, in their order."""
    for batch in batches:
        if batch.num_rows:
            file, block = batch.column("file"), batch.column("block")
            same = pc.and_(pc.equal(file[1:], file[:-1]), pc.equal(block[1:], block[:-1])).to_pylist() if batch.num_rows > 1 else []
            start = 0
            for i, equal in enumerate([*same, False], 1):
                if not equal:
                    yield (file[start].as_py(), block[start].as_py()), batch.slice(start, i - start)
                    start = i


def _effects(form: _Form) -> Callable[[_Rows], _Rows]:
    def effects(batches: _Rows) -> _Rows:
        key, state = None, None
        rows: list[tuple] = []
        for split, part in _splits(batches):
            if split != key:
                if key is not None:
                    rows.append((*key, state[0][0], state[0][1], state[1][1]))
                key, state = split, [[False, 0], [True, 0]]
            for text in part.column("text").to_pylist():
                for own in state:
                    own[0], change = form.effect(text, own[0])
                    own[1] += change
        if key is not None:
            rows.append((*key, state[0][0], state[0][1], state[1][1]))
        names = ["file", "block", "quotes", "depth_outside", "depth_inside"]
        types = [pa.string(), pa.int64(), pa.int32(), pa.int64(), pa.int64()]
        columns = [pa.array([int(r[i]) if i > 1 else r[i] for r in rows], t) for i, t in enumerate(types)]
        yield pa.RecordBatch.from_arrays(columns, names=names)

    return effects


def _cut(form: _Form, whole: bool) -> Callable[[_Rows], _Rows]:
    """The records that lie whole in a split, or the fragments at its ends."""

    def cut(batches: _Rows) -> _Rows:
        key, inside, depth, place, opens, held = None, False, 0, 0, True, []
        out: list[tuple] = []
        for split, part in _splits(batches):
            if split != key:
                if held and not whole:
                    out.append((*key, place, form.separator.join(held), opens, False))
                key, place, held = split, 0, []
                inside, depth = part.column("inside")[0].as_py(), part.column("depth")[0].as_py()
                # Between records the depth is that of the array, or that of the file's start.
                opens = split[1] == 0 or form.ends(inside, depth)
            for text in part.column("text").to_pylist():
                held.append(text)
                inside, change = form.effect(text, inside)
                depth += change
                if form.ends(inside, depth):
                    if opens == whole:
                        out.append((*key, place, form.separator.join(held), opens, True))
                    place, opens, held = place + 1, True, []
            yield _batch(out)
            out = []
        if held and not whole:
            yield _batch([(*key, place, form.separator.join(held), opens, False)])

    return cut


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    names = ["file", "block", "place", "text", "opens", "closes"]
    types = [pa.string(), pa.int64(), pa.int64(), pa.string(), pa.bool_(), pa.bool_()]
    return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], t) for i, t in enumerate(types)], names=names)
