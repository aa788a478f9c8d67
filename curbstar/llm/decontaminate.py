"""Benchmark decontamination by winnowing.

Of every text the k-gram hashes of words are taken, and of each sliding window of ``w`` k-grams
the smallest is kept as a fingerprint. Equal spans keep equal fingerprints, so a span of
``w + k - 1`` words or more that a document shares with an item shares at least one of them; with
``w + k - 1 = window`` no window of an item is missed. Documents whose fingerprints meet those of
an item extend each hit to the windows around it, which are compared as wholes.

The benchmark is the stated query set. It is taken in blocks of bounded size: each block's
fingerprints and windows are sorted arrays that are sent to the executors, and each block is one
pass over the documents without a shuffle. One block is the usual case; hits of several blocks
are united per document.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from curbstar.llm.common import WordRuns, pieces, plain_words
from curbstar.sources.scratch import stored

#: Words of an item that make a window, and of a k-gram.
WINDOW = 13
GRAM = 5
#: UTF-8 bytes of items in a block, which bounds what is broadcast (about 20 bytes for each).
BLOCK_BYTES = 4_000_000

HITS = "row long, doc_id long, n_words long, runs array<struct<first:long,last:long>>, items array<string>"


@dataclass
class Block:
    """Sorted fingerprints of long items, and for each window length the sorted window hashes with
    the items (as positions in ``ids``) that hold them."""

    ids: list[str | None]
    prints: np.ndarray
    windows: dict[int, tuple[np.ndarray, np.ndarray, np.ndarray]]


def fingerprints(gram_hashes: np.ndarray, width: int) -> np.ndarray:
    """The smallest of each ``width`` neighbouring hashes."""
    if gram_hashes.size < width:
        return gram_hashes[:0]
    return np.lib.stride_tricks.sliding_window_view(gram_hashes, width).min(axis=1)


def build_block(items: list[tuple[object, str | None]], window: int, gram: int) -> Block:
    words = [plain_words(t) for _, t in items]
    runs = WordRuns(words)
    at, grams = runs.runs(gram)
    owner = np.searchsorted(runs.first, at, side="right") - 1
    prints = [np.empty(0, dtype=np.uint64)]
    found: dict[int, list[tuple[np.ndarray, np.ndarray]]] = {}
    for i, own in enumerate(words):
        n = len(own)
        if not n:
            continue
        length = min(n, window)
        starts = runs.first[i] + np.arange(n - length + 1)
        found.setdefault(length, []).append((runs.hashes(starts, starts + length - 1), np.full(starts.size, i)))
        if length == window:
            lo, hi = np.searchsorted(owner, [i, i + 1])
            prints.append(fingerprints(grams[lo:hi], window - gram + 1))
    windows = {}
    for length, parts in found.items():
        pairs = np.unique(np.array([np.concatenate([p[0] for p in parts]), np.concatenate([p[1] for p in parts]).astype(np.uint64)]), axis=1)
        values, first = np.unique(pairs[0], return_index=True)
        windows[length] = (values, np.append(first, pairs.shape[1]), pairs[1].astype(np.int64))
    ids = [None if i is None else str(i) for i, _ in items]
    return Block(ids, np.unique(np.concatenate(prints)), windows)


def _member(sorted_values: np.ndarray, of: np.ndarray) -> np.ndarray:
    """Positions in ``sorted_values``, -1 where absent."""
    if not sorted_values.size:
        return np.full(of.size, -1)
    at = np.minimum(np.searchsorted(sorted_values, of), sorted_values.size - 1)
    return np.where(sorted_values[at] == of, at, -1)


def _hit_windows(runs: WordRuns, block: Block, window: int, gram: int) -> list[tuple[int, np.ndarray, np.ndarray]]:
    """(length, first words, positions of the window hash) of the windows that occur in the block."""
    out = []
    if window in block.windows:
        width = window - gram + 1
        at, grams = runs.runs(gram)
        lows = fingerprints(grams, width)
        # A run of k-grams that crosses a text's end starts no window of the text.
        ends = np.repeat(runs.first[1:], runs.n_words)
        first = at[: lows.size]
        inside = first + window <= ends[first]
        # Windows are looked up only where the fingerprint of their own k-grams is one of an item.
        new = np.ones(lows.size, dtype=bool)
        new[1:] = lows[1:] != lows[:-1]
        meets = (_member(block.prints, lows[new]) >= 0)[np.cumsum(new) - 1] if lows.size else new
        starts = first[inside & meets]
        hit = _member(block.windows[window][0], runs.hashes(starts, starts + window - 1))
        out.append((window, starts[hit >= 0], hit[hit >= 0]))
    for length in block.windows:
        if length < window:
            starts, h = runs.runs(length)
            hit = _member(block.windows[length][0], h)
            out.append((length, starts[hit >= 0], hit[hit >= 0]))
    return out


def _scan(block_sent, window: int, gram: int):
    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block = block_sent.value
        for batch in batches:
            for piece in pieces(batch):
                yield from results(piece, block)

    def results(batch: pa.RecordBatch, block: Block) -> Iterator[pa.RecordBatch]:
        runs = WordRuns([plain_words(t) for t in batch.column("text").to_pylist()])
        cover = np.zeros(int(runs.first[-1]) + 1, dtype=np.int64)
        of_item: dict[int, set[int]] = {}
        for length, starts, hit in _hit_windows(runs, block, window, gram):
            np.add.at(cover, starts, 1)
            np.add.at(cover, starts + length, -1)
            doc = np.searchsorted(runs.first, starts, side="right") - 1
            _, bounds, item = block.windows[length]
            for d, h in np.unique(np.array([doc, hit]), axis=1).T:
                of_item.setdefault(int(d), set()).update(item[bounds[h] : bounds[h + 1]].tolist())
        covered = np.cumsum(cover)[:-1] > 0
        spans, items = [], []
        for d in range(batch.num_rows):
            if d not in of_item:
                spans.append([])
                items.append([])
                continue
            own = np.concatenate([[False], covered[runs.first[d] : runs.first[d + 1]], [False]]).astype(np.int8)
            change = np.diff(own)
            firsts, lasts = np.flatnonzero(change == 1), np.flatnonzero(change == -1) - 1
            spans.append([{"first": int(a), "last": int(b)} for a, b in zip(firsts, lasts, strict=True)])
            items.append(sorted({block.ids[i] for i in of_item[d]} - {None}))
        run = pa.struct([("first", pa.int64()), ("last", pa.int64())])
        yield pa.RecordBatch.from_arrays(
            [batch.column("row"), batch.column("doc_id"), pa.array(runs.n_words), pa.array(spans, pa.list_(run)), pa.array(items, pa.list_(pa.string()))],
            names=["row", "doc_id", "n_words", "runs", "items"],
        )

    return scan


def _blocks(spark: SparkSession, benchmark: DataFrame) -> Iterator[Block]:
    """Items in blocks of about ``BLOCK_BYTES``; at least one block."""
    total = benchmark.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    count = -(-total // BLOCK_BYTES) or 1
    for i in range(count):
        own = benchmark.filter(F.pmod(F.xxhash64("item", "text"), F.lit(count)) == i)
        yield [(r["item"], r["text"]) for r in own.toLocalIterator()]


def matched_documents(
    documents: DataFrame, benchmark: DataFrame, doc_id: str = "doc_id", text: str = "text", item_id: str = "item_id", window: int = WINDOW, gram: int = GRAM
) -> DataFrame:
    """Per row of ``documents``: doc_id, n_words, runs (first and last word of each maximal hit run)
    and items (sorted ids, as strings, of items with occurring windows).

    A null or empty text has no words and no hits. An item without words has no window. A null item
    id marks words but is not listed. Repeated rows give repeated results; other columns are ignored.
    """
    if not 1 <= gram <= window:
        raise ValueError("gram must be between 1 and window")
    spark = documents.sparkSession
    docs = documents.select(
        F.monotonically_increasing_id().alias("row"), F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text")
    )
    items = benchmark.select(F.col(item_id).alias("item"), F.col(text).alias("text"))
    passes = [
        docs.mapInArrow(_scan(spark.sparkContext.broadcast(build_block(block, window, gram)), window, gram), HITS)
        for block in _blocks(spark, items)
    ]
    if len(passes) == 1:
        return passes[0].select("doc_id", "n_words", "runs", "items")
    hits = stored(passes[0], "decontaminate")
    for more in passes[1:]:
        hits = hits.unionByName(stored(more, "decontaminate"))
    hits = hits.groupBy("row").agg(
        F.first("doc_id").alias("doc_id"), F.first("n_words").alias("n_words"),
        F.flatten(F.collect_list("runs")).alias("runs"), F.array_sort(F.array_distinct(F.flatten(F.collect_list("items")))).alias("items"),
    )
    return hits.select("doc_id", "n_words", _united(F.col("runs")).alias("runs"), "items")


def _united(runs):
    """Runs in order, with overlapping and adjacent ones made one."""
    empty = F.expr("cast(array() as array<struct<first:long,last:long>>)")

    def add(done, run):
        last = F.element_at(done, -1)
        wider = F.struct(last["first"].alias("first"), F.greatest(last["last"], run["last"]).alias("last"))
        joins = (F.size(done) > 0) & (F.try_element_at(done, F.lit(-1))["last"] + 1 >= run["first"])
        return F.when(joins, F.concat(F.slice(done, 1, F.size(done) - 1), F.array(wider))).otherwise(F.concat(done, F.array(run)))

    return F.aggregate(F.array_sort(runs), empty, add)


def contamination(hits: DataFrame) -> DataFrame:
    """The digest of :func:`matched_documents`; contaminated if hits cover a twentieth of the words."""
    n_hit = F.aggregate("runs", F.lit(0).cast("long"), lambda n, r: n + r["last"] - r["first"] + 1)
    out = hits.select("doc_id", "n_words", n_hit.alias("n_hit"), F.size("items").cast("long").alias("n_items"), F.sha2(F.array_join("items", ","), 256).alias("items_sha256"))
    return out.withColumn("contaminated", (F.col("n_hit") > 0) & (20 * F.col("n_hit") >= F.col("n_words")))
