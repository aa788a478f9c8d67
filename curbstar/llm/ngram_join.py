"""Near-duplicate documents by an exact Jaccard join on word shingles.

A document's set holds its distinct 5-word shingles. Two documents link when
``100 * |intersection| >= 80 * |union|``. The result names each document's component, so copies
are never expanded into pairs.

Filters, all lossless:

1. Every token (shingle hash) is counted over all documents. A token of one document can't be
   shared, so a document with fewer than 80 % of shared tokens links with nothing. Tokens travel
   as packed arrays, not as rows; a batch that holds a token ``MANY`` times sends one marker.
2. Several global token orders, all with unshared tokens first: by rarity, and by two different
   hashes. Linked documents share a token within the prefix under each of the orders. The rarity
   order generates candidates, the prefixes under the other two travel as 64-bit signatures that
   must meet.
3. Length and position bounds on the overlap that is still possible.
4. The exact Jaccard value.

Large groups: each prefix token names a pivot, its member with the fewest unshared tokens.
Members are compared with their pivots first. What that joins needs no more comparisons, and only
members outside their pivot's component are compared with the rest of the token's members.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from curbstar.llm.common import WordRuns, mixed, space_words
from curbstar.llm.components import components
from curbstar.sources.scratch import discard, stored

#: Rarity classes end here: tokens of this many documents or more count as equally frequent.
MANY = 64
#: A packed batch closes at so many words or documents.
BATCH_WORDS = 600_000
BATCH_ROWS = 60_000
TOKEN_BITS = 40

PACKED = "part long, kind int, batch long, a binary, b binary, c binary"
ASSEMBLED = "row long, doc long, n long, shared long, tokens array<long>"


def _shingle_sets(texts: list[str | None], k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct (text number, shingle hash), ordered, and the set size per text."""
    runs = WordRuns([space_words(t) for t in texts])
    at, h = runs.runs(k)
    owner = np.repeat(np.arange(len(texts)), runs.n_words)[at]
    short = np.flatnonzero((runs.n_words > 0) & (runs.n_words < k))
    h = np.concatenate([h, runs.hashes(runs.first[short], runs.first[short + 1] - 1)])
    owner = np.concatenate([owner, short])
    order = np.lexsort((h, owner))
    owner, h = owner[order], h[order]
    new = np.ones(h.size, dtype=bool)
    new[1:] = (owner[1:] != owner[:-1]) | (h[1:] != h[:-1])
    owner, h = owner[new], h[new]
    return owner, h, np.bincount(owner, minlength=len(texts))


def _packed_tokens(h: np.ndarray) -> bytes:
    """The low 40 bits, as a plane of 4 bytes and one of 1."""
    return h.astype(np.uint32).tobytes() + (h >> np.uint64(32)).astype(np.uint8).tobytes()


def _tokens(packed: bytes) -> np.ndarray:
    n = len(packed) // 5
    low = np.frombuffer(packed, dtype=np.uint32, count=n).astype(np.uint64)
    return low | np.frombuffer(packed, dtype=np.uint8, offset=4 * n, count=n).astype(np.uint64) << np.uint64(32)


def _steps(idx: np.ndarray) -> bytes:
    """An ascending array of 16-bit numbers as differences, in two planes that compress well."""
    d = np.diff(idx, prepend=0).astype(np.uint16)
    return (d & 255).astype(np.uint8).tobytes() + (d >> 8).astype(np.uint8).tobytes()


def _unsteps(packed: bytes) -> np.ndarray:
    n = len(packed) // 2
    planes = np.frombuffer(packed, dtype=np.uint8).astype(np.int64)
    return np.cumsum(planes[:n] + (planes[n:] << 8))


def _send(k: int, parts: int):
    """Batches of documents to packed tokens: kind 0 unsettled tokens by part, 1 markers of tokens
    that the batch holds ``MANY`` times, 2 such tokens themselves, for the way back, 3 the documents."""

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows: list[tuple] = []
        words = 0
        for batch in batches:
            for row in zip(*(batch.column(c).to_pylist() for c in ("row", "doc", "text")), strict=True):
                size = len(row[2] or "") // 6
                if rows and (words + size > BATCH_WORDS or len(rows) >= BATCH_ROWS):
                    yield pack(rows)
                    rows, words = [], 0
                rows.append(row)
                words += size
        if rows:
            yield pack(rows)

    def pack(rows: list[tuple]) -> pa.RecordBatch:
        base = rows[0][0]
        owner, h, n = _shingle_sets([r[2] for r in rows], k)
        part = ((h >> np.uint64(48)) % np.uint64(parts)).astype(np.int64)
        low = h & np.uint64((1 << TOKEN_BITS) - 1)
        order = np.lexsort((low, part))
        edge = np.ones(order.size, dtype=bool)
        edge[1:] = (np.diff(part[order]) != 0) | (np.diff(low[order]) != 0)
        count = np.diff(np.append(np.flatnonzero(edge), order.size))
        many_sorted = np.repeat(count >= MANY, count)
        many = np.zeros(order.size, dtype=bool)
        many[order] = many_sorted
        marks = order[edge & many_sorted]
        out = []
        by_part = np.argsort(part, kind="stable")
        bounds = np.searchsorted(part[by_part], np.arange(parts + 1))
        mark_part = np.sort(part[marks])
        mark_low = low[marks][np.argsort(part[marks], kind="stable")]
        mark_bounds = np.searchsorted(mark_part, np.arange(parts + 1))
        for p in range(parts):
            at = by_part[bounds[p] : bounds[p + 1]]
            for kind, own in ((0, at[~many[at]]), (2, at[many[at]])):
                if own.size:
                    out.append((p, kind, base, _packed_tokens(low[own]), _steps(owner[own]), b""))
            if mark_bounds[p] < mark_bounds[p + 1]:
                out.append((p, 1, base, _packed_tokens(mark_low[mark_bounds[p] : mark_bounds[p + 1]]), b"", b""))
        doc = np.array([0 if r[1] is None else r[1] for r in rows], dtype=np.int64)
        null = np.array([r[1] is None for r in rows], dtype=np.uint8)
        out.append((base % parts, 3, base, n.astype(np.int64).tobytes(), doc.tobytes(), null.tobytes()))
        return _arrow(out)

    return send


def _arrow(rows: list[tuple]) -> pa.RecordBatch:
    types = (pa.int64(), pa.int32(), pa.int64(), pa.binary(), pa.binary(), pa.binary())
    columns = list(zip(*rows, strict=True)) or [()] * 6
    return pa.RecordBatch.from_arrays(
        [pa.array(c, type=t) for c, t in zip(columns, types, strict=True)],
        names=["part", "kind", "batch", "a", "b", "c"],
    )


def _count(packed: pa.Table) -> pa.Table:
    """One part of all tokens: count documents per token, send shared ones back to their batch."""
    rows = list(zip(*(packed.column(c).to_pylist() for c in ("part", "kind", "batch", "a", "b", "c")), strict=True))
    out = [r for r in rows if r[1] == 3]
    tokens = {k: [_tokens(r[3]) for r in rows if r[1] == k] for k in (0, 1)}
    mine = np.concatenate([np.empty(0, dtype=np.uint64), *tokens[0]])
    marked = np.unique(np.concatenate([np.empty(0, dtype=np.uint64), *tokens[1]]))
    values, inverse, counts = np.unique(mine, return_inverse=True, return_counts=True)
    if marked.size:
        counts = np.where(np.isin(values, marked), MANY, counts)
    rarity = np.minimum(counts, MANY).astype(np.uint8)[inverse]
    start = 0
    for r, own in zip((r for r in rows if r[1] == 0), tokens[0], strict=True):
        c = rarity[start : start + own.size]
        start += own.size
        if (c > 1).any():
            out.append((r[0], 0, r[2], _packed_tokens(own[c > 1]), _steps(_unsteps(r[4])[c > 1]), c[c > 1].tobytes()))
    out += [(r[0], 0, r[2], r[3], r[4], np.full(len(r[3]) // 5, MANY, np.uint8).tobytes()) for r in rows if r[1] == 2]
    return pa.Table.from_batches([_arrow(out)])


def _assemble(percent: int):
    """One batch of documents: shared tokens by rarity for those that can link at all."""

    def assemble(packed: pa.Table) -> pa.Table:
        rows = list(zip(*(packed.column(c).to_pylist() for c in ("part", "kind", "batch", "a", "b", "c")), strict=True))
        (docs,) = (r for r in rows if r[1] == 3)
        n = np.frombuffer(docs[3], dtype=np.int64)
        doc = pa.array(np.frombuffer(docs[4], dtype=np.int64), mask=np.frombuffer(docs[5], dtype=np.uint8) > 0)
        sent = [r for r in rows if r[1] == 0]
        none = np.empty(0, dtype=np.int64)
        owner = np.concatenate([none, *(_unsteps(r[4]) for r in sent)])
        token = np.concatenate([none, *(_tokens(r[3]).astype(np.int64) | r[0] << TOKEN_BITS for r in sent)])
        rarity = np.concatenate([none, *(np.frombuffer(r[5], dtype=np.uint8) for r in sent)])
        shared = np.bincount(owner, minlength=n.size)
        keep = ((100 * shared >= percent * n) & (n > 0))[owner]
        owner, token, rarity = owner[keep], token[keep], rarity[keep]
        order = np.lexsort((token, rarity, owner))
        sizes = np.bincount(owner, minlength=n.size)
        lists = pa.ListArray.from_arrays(
            pa.array(np.concatenate([[0], np.cumsum(sizes)]), type=pa.int32()), pa.array(token[order])
        )
        return pa.table(
            {"row": docs[2] + np.arange(n.size), "doc": doc, "n": n, "shared": shared, "tokens": lists},
            schema=pa.schema(
                [("row", pa.int64()), ("doc", pa.int64()), ("n", pa.int64()), ("shared", pa.int64()), ("tokens", pa.list_(pa.int64()))]
            ),
        )

    return assemble


def _postings(percent: int):
    """Prefix tokens in the rarity order, with the overlap still possible from there on and the
    signatures of the prefixes under two hash orders."""

    def postings(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            cols = {k: [] for k in ("token", "row", "n", "rest", "loose", "order_b", "order_c")}
            for row, n, tokens in zip(
                batch.column("row").to_pylist(), batch.column("n").to_pylist(), batch.column("tokens"), strict=True
            ):
                tokens = tokens.values.to_numpy(zero_copy_only=False)
                loose = n - tokens.size
                length = n - (percent * n + 99) // 100 + 1 - loose
                if length <= 0:
                    continue
                own = tokens[:length]
                cols["token"].append(own)
                cols["rest"].append(n - loose - np.arange(own.size))
                for c, v in (("row", row), ("n", n), ("loose", loose)):
                    cols[c].append(np.full(own.size, v))
                for c, salt in (("order_b", 0x5851F42D4C957F2D), ("order_c", 0x14057B7EF767814F)):
                    h = mixed(tokens.astype(np.uint64) ^ np.uint64(salt))
                    first = np.partition(h, length - 1)[:length] if length < h.size else h
                    bits = np.bitwise_or.reduce(np.uint64(1) << (mixed(first) & np.uint64(63)))
                    cols[c].append(np.full(own.size, bits).view(np.int64))
            none = np.empty(0, dtype=np.int64)
            yield pa.RecordBatch.from_pydict({k: np.concatenate([none, *v]) for k, v in cols.items()})

    return postings


POSTINGS = "token long, row long, n long, rest long, loose long, order_b long, order_c long"


def _can_link(x: str, y: str, percent: int) -> Column:
    """Length, position and the other orders' prefixes, for postings of one token."""
    c = lambda side, name: F.col(f"{side}.{name}")
    least = percent * (c(x, "n") + c(y, "n"))
    return (
        ((100 + percent) * F.least(c(x, "rest"), c(y, "rest")) >= least)
        & (100 * F.least(c(x, "n"), c(y, "n")) >= percent * F.greatest(c(x, "n"), c(y, "n")))
        & (c(x, "order_b").bitwiseAND(c(y, "order_b")) != 0)
        & (c(x, "order_c").bitwiseAND(c(y, "order_c")) != 0)
    )


def _verified(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) whose sets are similar enough."""
    of = lambda side: sets.select(F.col("row").alias(side), F.col("n").alias(f"n_{side}"), F.col("tokens").alias(f"tokens_{side}"))
    both = F.size(F.array_intersect("tokens_a", "tokens_b"))
    return (
        pairs.join(of("b"), "b")
        .join(of("a"), "a")
        .filter((100 + percent) * both >= percent * (F.col("n_a") + F.col("n_b")))
        .select("a", "b")
    )


def linked_documents(documents: DataFrame, doc_id: str = "doc_id", text: str = "text", k: int = 5, percent: int = 80) -> DataFrame:
    """One row per input row: ``doc_id``, ``n_shingles``, ``component_id``.

    Null and empty texts, and texts of white space, have no shingles and link with nothing. A text
    of fewer than ``k`` words is one shingle. Repeated rows are copies of each other. A null id
    links others but names no component: a component's id is its smallest non-null id, null if it
    has none. Other columns of the input are ignored. An empty table gives an empty result.
    """
    spark = documents.sparkSession
    parts = 4 * int(spark.conf.get("spark.sql.shuffle.partitions"))
    packed = documents.select(
        F.monotonically_increasing_id().alias("row"), F.col(doc_id).cast("long").alias("doc"), F.col(text).alias("text")
    ).mapInArrow(_send(k, parts), PACKED)
    replies = packed.groupBy("part").applyInArrow(_count, PACKED)
    docs = stored(replies.groupBy("batch").applyInArrow(_assemble(percent), ASSEMBLED), "ngram-docs")

    candidates = docs.filter(F.size("tokens") > 0).withColumn(
        "copy", F.when(F.col("shared") == F.col("n"), F.md5(F.array_join(F.transform("tokens", lambda t: F.hex(t)), ","))).otherwise(F.col("row").cast("string"))
    )
    classes = candidates.groupBy("copy").agg(F.min("row").alias("row"))
    members = stored(candidates.select("row", "copy").join(classes.withColumnRenamed("row", "rep"), "copy").select("row", "rep"), "ngram-members")
    sets = stored(candidates.select("row", "n", "tokens").join(members.filter("row = rep").select("row"), "row", "left_semi"), "ngram-sets")

    postings = sets.mapInArrow(_postings(percent), POSTINGS)
    shared_tokens = postings.groupBy("token").agg(
        F.count("*").alias("n_rows"), F.max(F.struct(-F.col("loose"), -F.col("row"))).alias("best")
    ).filter("n_rows > 1").select("token", (-F.col("best.col2")).alias("pivot"))
    postings = stored(postings.join(shared_tokens, "token"), "ngram-postings")
    pivots = postings.filter("row = pivot").drop("pivot")
    first = (
        postings.alias("x").filter("row <> pivot").join(pivots.alias("y"), "token").filter(_can_link("x", "y", percent))
        .select(F.col("x.row").alias("a"), F.col("y.row").alias("b")).distinct()
    )
    edges = stored(_verified(first, sets, percent), "ngram-links")
    joined = components(edges)
    label = lambda row: F.coalesce("component", row)
    named = (
        postings.join(joined.withColumnRenamed("node", "row"), "row", "left").withColumn("component", label("row"))
    )
    majority = named.filter("row = pivot").select("token", F.col("component").alias("pivot_component"))
    with_parts = stored(named.join(majority, "token"), "ngram-named")
    open_tokens = with_parts.filter("component <> pivot_component").select("token").distinct()
    outside = with_parts.filter("component <> pivot_component")
    rest = (
        outside.alias("x").join(with_parts.join(open_tokens, "token", "left_semi").alias("y"), "token")
        .filter(
            (F.col("x.component") != F.col("y.component"))
            & ((F.col("x.row") < F.col("y.row")) | (F.col("y.component") == F.col("y.pivot_component")))
            & (F.col("y.row") != F.col("y.pivot"))
            & _can_link("x", "y", percent)
        )
        .select(F.least("x.row", "y.row").alias("a"), F.greatest("x.row", "y.row").alias("b")).distinct()
    )
    more = _verified(rest, sets, percent)
    links = stored(
        edges.unionByName(more).unionByName(members.filter("row <> rep").select(F.col("row").alias("a"), F.col("rep").alias("b"))), "ngram-all-links"
    )
    joined = components(links)
    named = stored(
        docs.select("row", "doc", "n").join(joined.withColumnRenamed("node", "row"), "row", "left").withColumn("component", label("row")), "ngram-result"
    )
    discard(docs, members, sets, postings, with_parts, edges, links)
    smallest = named.filter(F.col("component").isNotNull()).groupBy("component").agg(F.min("doc").alias("component_id"))
    return named.join(smallest, "component").select(
        F.col("doc").alias("doc_id"), F.col("n").alias("n_shingles"), "component_id"
    )
