"""Hard negatives by integer scores, found through angles to a few reference directions.

A vector's components become ``floor(scale * x)``; the score of two rows is their inner product.
Every row stores its norm and its angles to the reference directions. For two rows and a direction
the triangle inequality bounds the angle between the rows from both sides; the tightest bounds over
all directions give an interval of cosines and, times the norms, an interval of scores, widened by
more than rounding can amount to. Only pairs whose interval meets the scores still looked for are
scored, in whole numbers.

Rows lie in blocks by label and angle. A block knows the ranges of its angles and norms, so pairs of
an anchor and a block that the bounds exclude are dropped before any row moves. The first pass finds
an anchor's best rows of its own label, the second those of other labels whose score lies in the
window that a positive's score opens.

Rows with a null id, label or vector, an empty vector, or a component that is null or not finite take
no part; nor do rows with an integer norm of 2**31 or more, whose scores might not fit 64 bits, nor
pairs of vectors of different lengths. A row that is repeated whole counts once. Rows that share an id
and differ are rows of their own, but no row is a positive or a negative of its own id. Ties go to
the smaller id. An anchor without positives, and a positive without negatives, have no rows in the
result; an empty table gives an empty result. Further columns are ignored.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from curbstar.sources.scratch import stored

#: Reference directions, and the most rows of which they are chosen.
DIRECTIONS, SAMPLE_ROWS = 8, 2_048
#: Rows of a block and anchors of a chunk; a task takes one of each.
BLOCK_ROWS, CHUNK_ANCHORS = 4_096, 4_096
#: What angles may be off by in radians, and score bounds as a share of the norms.
ANGLE_SLACK, SCORE_SLACK = 1e-6, 1e-9

_ROWS, _ANCHORS = 512, 256
_EXACT = float(1 << 52)
_LIMIT = float(1 << 31)
_LEAST, _MOST = np.iinfo(np.int64).min, np.iinfo(np.int64).max


def hard_negatives(
    vectors: DataFrame,
    anchors: Column,
    positives: int = 5,
    negatives: int = 3,
    low: int = 50,
    high: int = 95,
    scale: int = 256,
    vec_id: str = "vec_id",
    label: str = "label",
    embedding: str = "embedding",
) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score).

    ``anchors`` is a condition on the columns vec_id and label. ``low`` and ``high`` are the bounds of
    a negative's score, in hundredths of the positive's.
    """
    rows, blocks = blocked_rows(vectors, scale, vec_id, label, embedding)
    asked = stored(rows.filter(anchors).drop("block"), "anchors")
    best = positives_of(asked, rows, blocks, positives)
    of_anchor = best.groupBy("row").agg(F.sort_array(F.collect_list(F.struct("place", "other_id", "score"))).alias("best"))
    with_best = asked.join(of_anchor, "row")
    with_best = stored(with_best.withColumns(_windows(low, high)).filter("least_score <= most_score"), "anchors")
    return _negatives_of(with_best, rows, blocks, negatives)


def blocked_rows(
    vectors: DataFrame, scale: int = 256, vec_id: str = "vec_id", label: str = "label", embedding: str = "embedding"
) -> tuple[DataFrame, DataFrame]:
    """The rows that take part, with integers, norm, angles, a number and a block; and the blocks' ranges."""
    vector = F.col(embedding).cast("array<double>")
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    own = vectors.select(
        F.col(vec_id).cast("long").alias("vec_id"), F.col(label).cast("long").alias("label"), F.when(finite, vector).alias("vector")
    )
    own = own.filter("vec_id IS NOT NULL AND label IS NOT NULL AND size(vector) > 0").distinct()
    scaled = F.transform("vector", lambda x: F.floor(x * scale).cast("double"))
    norm = F.sqrt(F.aggregate("integers", F.lit(0.0), lambda total, x: total + x * x))
    whole = own.withColumn("integers", scaled).drop("vector").withColumn("norm", norm).filter(F.col("norm") < _LIMIT)
    whole = stored(whole, "integers")
    directions = _directions(whole)

    def with_angles(batches):
        for batch in batches:
            yield batch.append_column("angles", _angles(batch, directions))

    schema = "vec_id long, label long, integers array<double>, norm double, angles array<double>"
    parts = max(1, math.ceil(whole.count() / BLOCK_ROWS))
    ordered = whole.mapInArrow(with_angles, schema).withColumn("angle", F.col("angles")[0])
    ordered = ordered.repartitionByRange(parts, "label", "angle", "vec_id").sortWithinPartitions("label", "angle", "vec_id")
    # A range becomes blocks by place; the numbers hold because the rows are stored with them.
    rows = stored(ordered.withColumn("row", F.monotonically_increasing_id()).drop("angle"), "rows")
    part, place = F.shiftright("row", 33), F.col("row").bitwiseAND((1 << 33) - 1)
    most = rows.agg(F.max(place)).first()[0] or 0
    rows = rows.withColumn("block", part * (1 + most // BLOCK_ROWS) + F.floor(place / BLOCK_ROWS))
    angle = [F.col("angles")[i] for i in range(DIRECTIONS)]
    blocks = rows.groupBy("block").agg(
        F.array(*[F.min(a) for a in angle]).alias("from_angles"),
        F.array(*[F.max(a) for a in angle]).alias("to_angles"),
        F.min("norm").alias("from_norm"),
        F.max("norm").alias("to_norm"),
        F.min("label").alias("from_label"),
        F.max("label").alias("to_label"),
    )
    return rows, stored(blocks, "blocks")


def positives_of(anchors: DataFrame, rows: DataFrame, blocks: DataFrame, count: int) -> DataFrame:
    """(row, place, other_id, score): the best rows of each anchor's label."""
    pairs = _with_blocks(anchors, blocks).filter("label BETWEEN from_label AND to_label")
    found = _by_block(pairs, rows, lambda block, chunk: _same_label(block, chunk, count), "row long, other_id long, score long")
    best = Window.partitionBy("row").orderBy(F.desc("score"), "other_id")
    return found.withColumn("place", F.row_number().over(best)).filter(F.col("place") <= count)


def _negatives_of(anchors: DataFrame, rows: DataFrame, blocks: DataFrame, count: int) -> DataFrame:
    low_angle, high_angle = _between(F.col("angles"), F.col("from_angles"), F.col("to_angles"))
    bounds = [F.cos(a) * F.col("norm") * F.col(n) for a in (low_angle, high_angle) for n in ("from_norm", "to_norm")]
    slack = F.col("norm") * F.col("to_norm") * SCORE_SLACK + 1
    pairs = _with_blocks(anchors, blocks).filter(
        ((F.col("from_label") != F.col("to_label")) | (F.col("label") != F.col("from_label")))
        & (F.greatest(*bounds) + slack >= F.col("least_score"))
        & (F.least(*bounds) - slack <= F.col("most_score"))
    )
    schema = "row long, anchor_id long, place int, positive_id long, positive_score long, negative_id long, negative_score long"
    found = _by_block(pairs, rows, lambda block, chunk: _other_labels(block, chunk, count), schema)
    best = Window.partitionBy("row", "place").orderBy(F.desc("negative_score"), "negative_id")
    ranked = found.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= count)
    return ranked.select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")


def _windows(low: int, high: int) -> dict[str, Column]:
    """The bounds of each positive's window in whole scores, and the outermost ones."""
    # Divided as decimals: exact, and rounded up and down as the inequalities ask.
    score = lambda x: x["score"].cast("decimal(19,0)")
    lowest = F.transform("best", lambda x: F.ceil(score(x) * low / 100).cast("long"))
    highest = F.transform("best", lambda x: F.floor(score(x) * high / 100).cast("long"))
    open_ = lambda x: x["from"] <= x["to"]
    ranges = F.filter(F.zip_with(lowest, highest, lambda a, b: F.struct(a.alias("from"), b.alias("to"))), open_)
    return {
        "lowest": lowest,
        "highest": highest,
        "least_score": F.array_min(F.transform(ranges, lambda x: x["from"])),
        "most_score": F.array_max(F.transform(ranges, lambda x: x["to"])),
    }


def _with_blocks(anchors: DataFrame, blocks: DataFrame) -> DataFrame:
    """Each anchor with the ranges of each block."""
    every = F.sequence(F.lit(0), F.lit(blocks.agg(F.max("block")).first()[0] or 0)).cast("array<long>")
    return anchors.withColumn("block", F.explode(every)).join(blocks, "block")


def _by_block(pairs: DataFrame, rows: DataFrame, function, schema: str) -> DataFrame:
    """``function`` over each block of rows and each chunk of the anchors that are paired with it."""
    per_block = pairs.groupBy("block").agg(F.ceil(F.count("*") / CHUNK_ANCHORS).cast("int").alias("chunks"))
    per_block = stored(per_block, "chunks")
    most = per_block.agg(F.max("chunks")).first()[0] or 1
    ranges = ["from_angles", "to_angles", "from_norm", "to_norm", "from_label", "to_label"]
    dealt = pairs.drop(*ranges).withColumn("chunk", F.pmod(F.xxhash64("row"), F.lit(most)).cast("int"))
    copies = rows.join(per_block, "block").withColumn("chunk", F.explode(F.sequence(F.lit(0), F.lit(most - 1)))).drop("chunks")
    key = ["block", "chunk"]
    return copies.groupBy(*key).cogroup(dealt.groupBy(*key)).applyInArrow(function, schema)


def _between(own: Column, low: Column, high: Column) -> tuple[Column, Column]:
    """Bounds of the angle between a row and any row with angles from ``low`` to ``high``."""
    least = F.zip_with(F.zip_with(own, high, lambda a, b: a - b), F.zip_with(low, own, lambda a, b: a - b), lambda a, b: F.greatest(a, b))
    turn = 2 * math.pi
    most = F.zip_with(F.zip_with(own, high, lambda a, b: a + b), F.zip_with(own, low, lambda a, b: turn - a - b), lambda a, b: F.least(a, b))
    return (
        F.greatest(F.array_max(least) - ANGLE_SLACK, F.lit(0.0)),
        F.least(F.array_min(most) + ANGLE_SLACK, F.lit(math.pi)),
    )


def _directions(rows: DataFrame) -> np.ndarray:
    """Unit vectors far from each other, chosen of a bounded sample: the rows with the smallest hashes."""
    sample = rows.filter("norm > 0").orderBy(F.xxhash64("vec_id", "integers"), "vec_id").limit(SAMPLE_ROWS)
    kept = [(np.asarray(r["integers"]) / r["norm"]) for r in sample.select("integers", "norm").collect()]
    lengths = [len(v) for v in kept]
    dim = max(set(lengths), key=lambda n: (lengths.count(n), n)) if kept else 1
    points = np.array([v for v in kept if len(v) == dim] or [np.eye(1)[0]])
    chosen, nearest = [0], points @ points[0]
    while len(chosen) < min(DIRECTIONS, len(points)):
        chosen.append(int(np.argmin(np.abs(nearest))))
        nearest = np.maximum(np.abs(nearest), np.abs(points @ points[chosen[-1]]))
    return points[(chosen * DIRECTIONS)[:DIRECTIONS]]


def _angles(batch: pa.RecordBatch, directions: np.ndarray) -> pa.Array:
    """Angles of each row to the directions; vectors of another length measure against their leading part."""
    out = np.full((batch.num_rows, DIRECTIONS), math.pi / 2)
    lengths, norm = _lengths(batch.column("integers")), batch.column("norm").to_numpy()
    values, ends = batch.column("integers").flatten().to_numpy(), np.cumsum(lengths)
    for dim in np.unique(lengths):
        at = np.flatnonzero((lengths == dim) & (norm > 0))
        own = np.zeros((len(directions), dim))
        own[:, : min(dim, directions.shape[1])] = directions[:, :dim]
        size = np.sqrt((own**2).sum(axis=1))
        own = np.where(size[:, None] > 0, own / np.where(size > 0, size, 1)[:, None], np.eye(1, dim))
        vectors = values[(ends[at] - dim)[:, None] + np.arange(dim)]
        out[at] = np.arccos(np.clip(vectors @ own.T / norm[at][:, None], -1, 1))
    return pa.FixedSizeListArray.from_arrays(pa.array(out.ravel()), DIRECTIONS).cast(pa.list_(pa.float64()))


def _lengths(lists) -> np.ndarray:
    return np.asarray(lists.value_lengths().to_numpy(zero_copy_only=False), dtype=np.int64)


class _Side:
    """Rows of one length, as arrays."""

    def __init__(self, table: pa.Table, at: np.ndarray, dim: int):
        table = table.take(at)
        self.row, self.id, self.label = (table[n].to_numpy() for n in ("row", "vec_id", "label"))
        self.norm = table["norm"].to_numpy()
        self.integers = table["integers"].combine_chunks().flatten().to_numpy().reshape(-1, dim)
        self.angles = table["angles"].combine_chunks().flatten().to_numpy().reshape(-1, DIRECTIONS)
        self.table = table


def _sides(block: pa.Table, chunk: pa.Table):
    """Rows and anchors of each length that both hold, in the order of ids."""
    if block.num_rows and chunk.num_rows:
        lengths = [_lengths(t["integers"].combine_chunks()) for t in (block, chunk)]
        for dim in np.intersect1d(*lengths):
            sides = []
            for table, own in zip((block, chunk), lengths):
                at = np.flatnonzero(own == dim)
                sides.append(_Side(table, at[np.argsort(table["vec_id"].to_numpy()[at], kind="stable")], int(dim)))
            yield sides


def _bounds(anchors: _Side, a: slice, rows: _Side, r: slice) -> tuple[np.ndarray, np.ndarray]:
    """Bounds of the scores of anchors and rows, from their angles and norms."""
    least = np.zeros((len(anchors.id[a]), len(rows.id[r])))
    most = np.full(least.shape, math.pi)
    for i in range(DIRECTIONS):
        own, other = anchors.angles[a, i][:, None], rows.angles[r, i][None]
        np.maximum(least, np.abs(own - other), out=least)
        both = own + other
        np.minimum(most, np.minimum(both, 2 * math.pi - both), out=most)
    norms = anchors.norm[a][:, None] * rows.norm[r][None]
    slack = norms * SCORE_SLACK + 1
    low = np.cos(np.minimum(most + ANGLE_SLACK, math.pi)) * norms - slack
    return low, np.cos(np.maximum(least - ANGLE_SLACK, 0)) * norms + slack


def _scores(anchors: _Side, a: slice, rows: _Side, r: slice, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(anchor, row, score) of the wanted pairs, in whole numbers."""
    some_a, some_r = np.flatnonzero(wanted.any(axis=1)), np.flatnonzero(wanted.any(axis=0))
    left, right = anchors.integers[a][some_a], rows.integers[r][some_r]
    if some_a.size and some_r.size and anchors.norm[a].max() * rows.norm[r].max() >= _EXACT:
        product = left.astype(np.int64) @ right.astype(np.int64).T
    else:  # all partial sums are whole numbers that a double holds
        product = (left @ right.T).astype(np.int64)
    x, y = np.nonzero(wanted[np.ix_(some_a, some_r)])
    return some_a[x], some_r[y], product[x, y]


def _firsts(group: np.ndarray, score: np.ndarray, other: np.ndarray, count: int) -> np.ndarray:
    """Places of each group's first ``count`` rows by score and then id."""
    at = np.lexsort((other, -score, group))
    own = group[at]
    return at[np.arange(at.size) - np.searchsorted(own, own) < count]


def _tiles(anchors: _Side, rows: _Side):
    for start in range(0, len(anchors.id), _ANCHORS):
        yield slice(start, min(start + _ANCHORS, len(anchors.id))), [
            slice(r, min(r + _ROWS, len(rows.id))) for r in range(0, len(rows.id), _ROWS)
        ]


def _same_label(block: pa.Table, chunk: pa.Table, count: int) -> pa.Table:
    out = [np.empty((0, 3), np.int64)]
    for rows, anchors in _sides(block, chunk):
        for a, tiles in _tiles(anchors, rows):
            best = np.empty((0, 3), np.int64)  # anchor, other id, score
            worst = np.full(a.stop - a.start, _LEAST)  # what a further row must reach
            for r in tiles:
                wanted = (anchors.label[a][:, None] == rows.label[r][None]) & (anchors.id[a][:, None] != rows.id[r][None])
                if wanted.any():
                    wanted &= _bounds(anchors, a, rows, r)[1] >= worst[:, None]
                if wanted.any():
                    x, y, score = _scores(anchors, a, rows, r, wanted)
                    best = np.vstack([best, np.stack([x, rows.id[r][y], score], axis=1)])
                    best = best[_firsts(best[:, 0], best[:, 2], best[:, 1], count)]
                    full = np.bincount(best[:, 0], minlength=worst.size) == count
                    lowest = np.full(worst.size, _MOST)
                    np.minimum.at(lowest, best[:, 0], best[:, 2])
                    worst = np.where(full, lowest, _LEAST)
            best[:, 0] = anchors.row[a][best[:, 0]]
            out.append(best)
    row, other, score = np.vstack(out).T
    return pa.table({"row": row, "other_id": other, "score": score})


def _other_labels(block: pa.Table, chunk: pa.Table, count: int) -> pa.Table:
    names = ["row", "anchor_id", "place", "positive_id", "positive_score", "negative_id", "negative_score"]
    out = {name: [np.empty(0, np.int64)] for name in names}
    for rows, anchors in _sides(block, chunk):
        lists = {n: anchors.table[n].combine_chunks() for n in ("lowest", "highest", "best")}
        sizes = _lengths(lists["best"])
        width = int(sizes.max(initial=0))
        # Windows in a row per anchor; those that an anchor has not are empty.
        filled = np.arange(width) < sizes[:, None]
        low, high = np.ones((len(sizes), width), np.int64), np.zeros((len(sizes), width), np.int64)
        low[filled], high[filled] = lists["lowest"].flatten().to_numpy(), lists["highest"].flatten().to_numpy()
        place, positive, positive_score = (np.zeros((len(sizes), width), np.int64) for _ in range(3))
        each = lists["best"].flatten()
        for array, name in ((place, "place"), (positive, "other_id"), (positive_score, "score")):
            array[filled] = each.field(name).to_numpy()
        first = np.where(low <= high, low, _MOST).min(axis=1, initial=_MOST)
        last = np.where(low <= high, high, _LEAST).max(axis=1, initial=_LEAST)
        for a, tiles in _tiles(anchors, rows):
            n = a.stop - a.start
            best = np.empty((0, 3), np.int64)  # anchor * width + window, other id, score
            worst = low[a]  # what a further row must reach, per window
            for r in tiles:
                wanted = anchors.label[a][:, None] != rows.label[r][None]
                wanted &= anchors.id[a][:, None] != rows.id[r][None]
                if wanted.any():
                    from_, to = _bounds(anchors, a, rows, r)
                    wanted &= (to >= worst.min(axis=1)[:, None]) & (to >= first[a][:, None]) & (from_ <= last[a][:, None])
                if not wanted.any():
                    continue
                x, y, score = _scores(anchors, a, rows, r, wanted)
                new = [best]
                for j in range(width):
                    fits = (score >= low[a][x, j]) & (score <= high[a][x, j]) & (score >= worst[x, j])
                    new.append(np.stack([x[fits] * width + j, rows.id[r][y[fits]], score[fits]], axis=1))
                best = np.vstack(new)
                best = best[_firsts(best[:, 0], best[:, 2], best[:, 1], count)]
                full = np.bincount(best[:, 0], minlength=n * width) == count
                lowest = np.full(n * width, _MOST)
                np.minimum.at(lowest, best[:, 0], best[:, 2])
                worst = np.where(full.reshape(n, width), lowest.reshape(n, width), low[a])
            x, j = np.divmod(best[:, 0], max(1, width))
            values = (anchors.row[a][x], anchors.id[a][x], place[a][x, j], positive[a][x, j], positive_score[a][x, j])
            for name, value in zip(names, (*values, best[:, 1], best[:, 2])):
                out[name].append(value)
    columns = {name: np.concatenate(parts) for name, parts in out.items()}
    columns["place"] = columns["place"].astype(np.int32)
    return pa.table(columns)
