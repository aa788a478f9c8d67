"""Ranked search by words: posting lists in blocks of similar documents, skipped by their summaries.

A term's weight falls with the number of documents that hold it. A document's impact for a term grows
with its occurrences and falls with the document's length. The score is the sum of weight times impact
over the terms of an item; all of it is whole numbers but the logarithm of the weight.

Documents are dealt to shards of bounded size by a hash. In a shard each asked term has its posting
list. A long list is cut geometrically: evenly spaced documents of the list are pivots, and every
document joins the pivot whose weighted terms (under a random projection) are most like its own. A
block keeps, per term, the largest impact of its documents, rounded up to a byte. An item's
lists are read from the one that can add most. A block is left out only if its summary's score is
below the k-th best found; reading ends when all lists left together can't reach that. So the results
are those of scoring every document. A short list is one block without a summary, always read.

Items are the stated queries. They are taken in blocks of bounded text; each block is one pass over
the documents and an index of the block's terms. One block is the usual case. Document counts and
lengths cover all documents and all terms.

A null or empty text has no terms: such a document isn't counted, and such an item has no rows.
Repeated rows are documents and items of their own. Equal scores go by document id, rows without an id
last. Long texts are taken apart in pieces. Empty tables give an empty result, and further columns
are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from curbstar.llm.common import PLAIN_WORD_BYTES, pieces, plain_words
from curbstar.sources.scratch import stored

#: UTF-8 bytes of items in a block, which bounds what the driver and a broadcast hold.
BLOCK_BYTES = 4_000_000
#: Documents of a shard, and bytes of its table of impacts by document and term; the smaller counts.
SHARD_DOCUMENTS, SHARD_BYTES = 4_096, 32_000_000
#: Documents of a block, on average, and of the longest list that is read whole.
BLOCK_DOCUMENTS, SHORT_LIST = 64, 256
#: Components of the projection by which documents are compared.
PROJECTION = 48
#: Impacts in a summary are whole multiples of this, rounded up; the largest impact is 10**6.
SUMMARY_UNIT = 4_096
#: Bytes of a text whose words are counted at a time.
SLICE_BYTES = 1_000_000

# --- Fixed values: the measure ---------------------------------------------------------------
WEIGHT = 1_000
IMPACT = 1_000_000_000
OCCURRENCE = 1_000
LENGTH = 8
BASE, SHARE = 100, 90
# ---------------------------------------------------------------------------------------------

FORWARD = "doc_id long, n long, terms array<int>, counts array<int>"
INDEX = (
    "shard int, doc_ids array<long>, offsets array<int>, terms array<int>, impacts array<int>,"
    " block_terms array<int>, block_offsets array<int>, block_docs array<int>, block_summaries array<int>, summaries binary"
)
FOUND = "item int, item_id long, doc_id long, score long"


def ranked_documents(
    documents: DataFrame, items: DataFrame, k: int, doc_id: str = "doc_id", text: str = "text", item_id: str = "item_id"
) -> DataFrame:
    """(item_id, rank, doc_id, score): the ``k`` documents with the highest scores above 0 per item."""
    docs = documents.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    asked = items.select(F.col(item_id).cast("long").alias("item_id"), F.col(text).alias("text"))
    size = asked.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    count = -(-size // BLOCK_BYTES) or 1
    parts = []
    for i in range(count):
        own = asked.filter(F.pmod(F.xxhash64("item_id", "text"), F.lit(count)) == i)
        queries = [(r["item_id"], sorted(set(plain_words(r["text"])))) for r in own.toLocalIterator()]
        vocabulary = sorted({term for _, terms in queries for term in terms})
        dealt, weights = _dealt(docs, vocabulary)
        sent = _sent(dealt.sparkSession, [(q, terms) for q, terms in queries if terms], vocabulary, weights)
        # Asked once, a shard's index lives in its task only.
        parts.append(_ranked(dealt.groupBy("shard").applyInArrow(_indexed_and_found(sent, k), FOUND), k))
    found = parts[0]
    for more in parts[1:]:
        found = found.unionByName(more)
    return found


def build_index(documents: DataFrame, vocabulary: list[bytes]) -> tuple[DataFrame, list[int]]:
    """The index of the documents' terms that are in the vocabulary, a stored row per shard (schema
    ``INDEX``), and the weight of each term. For items that are not known yet, or asked again."""
    dealt, weights = _dealt(documents, vocabulary)
    sent = documents.sparkSession.sparkContext.broadcast(np.array(weights, dtype=np.int64))
    return stored(dealt.groupBy("shard").applyInArrow(lambda own: _shard(own, sent.value), INDEX), "lexical-index"), weights


def _dealt(documents: DataFrame, vocabulary: list[bytes]) -> tuple[DataFrame, list[int]]:
    """Documents that hold terms of the vocabulary, with their shard and length measure; the terms' weights."""
    spark = documents.sparkSession
    numbers = spark.sparkContext.broadcast({term: i for i, term in enumerate(vocabulary)})
    forward = stored(documents.mapInArrow(_counted(numbers), FORWARD), "forward")
    filled = forward.filter("n > 0")
    total = filled.agg(F.count("*").alias("documents"), F.sum("n").alias("terms"), F.count_if(F.size("terms") > 0).alias("held")).first()
    n_documents, n_terms = total["documents"], total["terms"] or 1
    holding = dict.fromkeys(range(len(vocabulary)), 0)
    holding.update(
        (r["term"], r["n"])
        for r in filled.select(F.explode("terms").alias("term")).groupBy("term").agg(F.count("*").alias("n")).collect()
    )
    weights = [math.floor(WEIGHT * math.log((2 * n_documents + 2) / (2 * holding[i] + 1))) for i in range(len(vocabulary))]
    most = max(1, min(SHARD_DOCUMENTS, SHARD_BYTES // max(1, len(vocabulary))))
    shards = max(1, math.ceil(total["held"] / most))
    length = F.lit(BASE - SHARE) + F.expr(f"({SHARE}L * n * {n_documents}L) div {n_terms}L")
    dealt = filled.filter(F.size("terms") > 0).select(
        F.pmod(F.xxhash64("doc_id", "n", "terms", F.monotonically_increasing_id()), F.lit(shards)).cast("int").alias("shard"),
        "doc_id",
        length.alias("length"),
        "terms",
        "counts",
    )
    return dealt, weights


def search(
    index: DataFrame, queries: list[tuple[int | None, list[bytes]]], vocabulary: list[bytes], weights: list[int], k: int
) -> DataFrame:
    """(item_id, rank, doc_id, score) of the ``k`` best documents per query, a bounded list of (item_id, terms)."""
    sent = _sent(index.sparkSession, queries, vocabulary, weights)

    def found_in(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                yield from _found(pa.Table.from_batches([batch.slice(i, 1)]), *sent.value, k).to_batches()

    return _ranked(index.mapInArrow(found_in, FOUND), k)


def _sent(spark: SparkSession, queries: list[tuple[int | None, list[bytes]]], vocabulary: list[bytes], weights: list[int]):
    """The queries by the terms' numbers, and the weights, as a broadcast."""
    numbers = {term: i for i, term in enumerate(vocabulary)}
    asked = [(q, np.array([numbers[t] for t in terms], dtype=np.int64)) for q, terms in queries]
    return spark.sparkContext.broadcast((asked, np.array(weights, dtype=np.int64)))


def _ranked(found: DataFrame, k: int) -> DataFrame:
    best = Window.partitionBy("item").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    ranked = found.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= k)
    return ranked.select("item_id", "rank", "doc_id", "score")


def _indexed_and_found(sent, k: int):
    def indexed_and_found(docs: pa.Table) -> pa.Table:
        return _found(_shard(docs, sent.value[1]), *sent.value, k)

    return indexed_and_found


def _counted(numbers):
    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = numbers.value.get
        for batch in batches:
            for piece in pieces(batch):
                lengths, terms, counts = [], [], []
                for text in piece.column("text").to_pylist():
                    n, own = 0, []
                    for words in _words(text):
                        n += len(words)
                        own.append(np.array([t for t in map(number, words) if t is not None], dtype=np.int32))
                    term, count = np.unique(np.concatenate([np.empty(0, np.int32), *own]), return_counts=True)
                    lengths.append(n)
                    terms.append(term)
                    counts.append(count.astype(np.int32))
                ints = pa.list_(pa.int32())
                arrays = [piece.column("doc_id"), pa.array(lengths, pa.int64()), pa.array(terms, ints), pa.array(counts, ints)]
                yield pa.RecordBatch.from_arrays(arrays, names=["doc_id", "n", "terms", "counts"])

    return counted


def _words(text: str | None) -> Iterator[list[bytes]]:
    """The words of a text, slice by slice; slices end between words."""
    data = text.encode("utf-8", "surrogatepass").translate(PLAIN_WORD_BYTES) if text else b""
    start = 0
    while start < len(data):
        end = data.find(b" ", start + SLICE_BYTES)
        end = len(data) if end < 0 else end
        yield data[start:end].split()
        start = end


def _flat(lists) -> tuple[np.ndarray, np.ndarray]:
    """Offsets and values of lists."""
    lists = lists.combine_chunks()
    sizes = lists.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
    return np.concatenate([[0], np.cumsum(sizes)]), lists.flatten().to_numpy()


def _shard(docs: pa.Table, weight: np.ndarray) -> pa.Table:
    """The index row of the documents of one shard."""
    offsets, terms = _flat(docs["terms"])
    counts = _flat(docs["counts"])[1].astype(np.int64)
    owner = np.repeat(np.arange(docs.num_rows), np.diff(offsets))
    impacts = (IMPACT * counts) // (OCCURRENCE * counts + LENGTH * docs["length"].to_numpy()[owner])
    table = np.zeros((docs.num_rows, weight.size), dtype=np.uint8)
    table[owner, terms] = -(-impacts // SUMMARY_UNIT)
    points = _projected(table, weight)
    by_term = np.argsort(terms, kind="stable")
    starts = np.searchsorted(terms[by_term], np.arange(weight.size + 1))
    block_terms, block_sizes, block_docs, block_summaries, summaries = [], [], [], [], []
    for term in np.flatnonzero((np.diff(starts) > 0) & (weight > 0)):
        own = owner[by_term[starts[term] : starts[term + 1]]]
        if own.size <= SHORT_LIST:
            first, summary = np.array([0]), None
        else:
            pivots = own[np.linspace(0, own.size - 1, -(-own.size // BLOCK_DOCUMENTS)).astype(np.int64)]
            nearest = np.argmax(points[own] @ points[pivots].T, axis=1)
            order = np.argsort(nearest, kind="stable")
            own, nearest = own[order], nearest[order]
            first = np.flatnonzero(np.concatenate([[True], nearest[1:] != nearest[:-1]]))
            summary = [table[members].max(axis=0) for members in np.split(own, first[1:])]
        block_terms += [term] * first.size
        block_sizes += np.diff(np.append(first, own.size)).tolist()
        block_docs.append(own)
        if summary is None:
            block_summaries.append(-1)
        else:
            block_summaries += range(len(summaries), len(summaries) + first.size)
            summaries += summary
    row = {
        "shard": [docs["shard"][0].as_py()],
        "doc_ids": [docs["doc_id"].to_pylist()],
        "offsets": [offsets],
        "terms": [terms],
        "impacts": [impacts],
        "block_terms": [block_terms],
        "block_offsets": [np.concatenate([[0], np.cumsum(block_sizes)]).astype(np.int32)],
        "block_docs": [np.concatenate([np.empty(0, np.int64), *block_docs])],
        "block_summaries": [block_summaries],
        "summaries": [np.array(summaries, dtype=np.uint8).tobytes()],
    }
    return pa.table({name: pa.array(value, _SCHEMA.field(name).type) for name, value in row.items()})


_INTS = pa.list_(pa.int32())
_SCHEMA = pa.schema(
    [("shard", pa.int32()), ("doc_ids", pa.list_(pa.int64()))]
    + [(n, _INTS) for n in ("offsets", "terms", "impacts", "block_terms", "block_offsets", "block_docs", "block_summaries")]
    + [("summaries", pa.binary())]
)


def _projected(table: np.ndarray, weight: np.ndarray) -> np.ndarray:
    """Unit vectors of few components whose products follow those of the weighted impacts."""
    random = np.random.default_rng(0).standard_normal((weight.size, PROJECTION), dtype=np.float32)
    random *= (weight / max(1, weight.max(initial=1))).astype(np.float32)[:, None]
    parts = [table[i : i + 1024].astype(np.float32) @ random for i in range(0, len(table), 1024)]
    points = np.concatenate([np.empty((0, PROJECTION), np.float32), *parts])
    size = np.sqrt((points**2).sum(axis=1, keepdims=True))
    return points / np.where(size > 0, size, 1)


def _found(shard: pa.Table, queries: list[tuple[int | None, np.ndarray]], weights: np.ndarray, k: int) -> pa.Table:
    """Each query's ``k`` best documents of one shard."""
    lists = _Lists(shard, weights)
    rows: list[tuple[int, int | None, int | None, int]] = []
    for i, (item_id, terms) in enumerate(queries):
        rows += [(i, item_id, doc, score) for doc, score in lists.best(terms, k)]
    schema = pa.schema([("item", pa.int32()), ("item_id", pa.int64()), ("doc_id", pa.int64()), ("score", pa.int64())])
    return pa.Table.from_arrays([pa.array([r[j] for r in rows], schema.types[j]) for j in range(4)], schema=schema)


class _Lists:
    """One shard's row, ready to be searched."""

    def __init__(self, shard: pa.Table, weights: np.ndarray):
        row = {name: shard[name].combine_chunks()[0] for name in shard.column_names}
        array = lambda name: row[name].values.to_numpy(zero_copy_only=False).astype(np.int64)
        self.weights = weights
        ids = row["doc_ids"].values
        self.doc_ids = ids.to_pylist()
        # Rows without an id come last among equal scores.
        self.place = np.array([(1 << 63) - 1 if d is None else d for d in self.doc_ids], dtype=np.int64)
        self.offsets, self.terms, self.impacts = array("offsets"), array("terms"), array("impacts")
        self.block_offsets, self.block_docs, self.summary = array("block_offsets"), array("block_docs"), array("block_summaries")
        block_terms = array("block_terms")
        self.blocks = np.searchsorted(block_terms, np.arange(weights.size + 1))
        self.summaries = np.frombuffer(row["summaries"].as_py(), dtype=np.uint8).reshape(-1, max(1, weights.size))
        self.largest = np.zeros(weights.size, dtype=np.int64)
        np.maximum.at(self.largest, self.terms, self.impacts)
        self.asked = np.zeros(weights.size, dtype=np.int64)

    def best(self, terms: np.ndarray, k: int) -> list[tuple[int | None, int]]:
        terms = terms[self.blocks[terms + 1] > self.blocks[terms]]
        if not terms.size:
            return []
        gain = self.weights[terms] * self.largest[terms]
        terms = terms[np.argsort(-gain, kind="stable")]
        left = np.cumsum(np.sort(gain))[::-1]  # what each list and those after it can add
        self.asked[terms] = self.weights[terms]
        seen = np.zeros(len(self.doc_ids), dtype=bool)
        docs, scores = np.empty(0, np.int64), np.empty(0, np.int64)
        reach = 1
        for term, most in zip(terms, left):
            if most < reach:
                break
            blocks = np.arange(self.blocks[term], self.blocks[term + 1])
            if self.summary[blocks[0]] < 0:
                turns = [(blocks, None)]
            else:
                bound = (self.summaries[self.summary[blocks]][:, terms].astype(np.int64) * SUMMARY_UNIT) @ self.weights[terms]
                order = np.argsort(-bound, kind="stable")
                # The most promising block first: what it holds may exclude others.
                turns = [(blocks[order[:1]], bound[order[:1]]), (blocks[order[1:]], bound[order[1:]])]
            for some, bound in turns:
                some = some if bound is None else some[bound >= reach]
                own = [self.block_docs[self.block_offsets[b] : self.block_offsets[b + 1]] for b in some]
                new = np.concatenate([np.empty(0, np.int64), *own])
                new = new[~seen[new]]
                if new.size:
                    seen[new] = True
                    docs, scores = np.concatenate([docs, new]), np.concatenate([scores, self._scores(new)])
                    if docs.size > k:
                        first = np.lexsort((self.place[docs], -scores))[:k]
                        docs, scores = docs[first], scores[first]
                    if docs.size == k:
                        reach = max(1, int(scores.min()))
        self.asked[terms] = 0
        first = np.lexsort((self.place[docs], -scores))
        return [(self.doc_ids[d], int(s)) for d, s in zip(docs[first], scores[first]) if s > 0]

    def _scores(self, docs: np.ndarray) -> np.ndarray:
        sizes = self.offsets[docs + 1] - self.offsets[docs]
        starts = np.cumsum(sizes) - sizes
        at = np.arange(sizes.sum()) - np.repeat(starts - self.offsets[docs], sizes)
        return np.add.reduceat(self.asked[self.terms[at]] * self.impacts[at], starts)
