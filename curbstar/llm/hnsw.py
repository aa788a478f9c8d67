"""Approximate nearest neighbours by inner product: a small-world graph per shard, shard results merged.

An index holds every vector. Equal vectors are one node with the smallest of their ids; nodes are
dealt to shards of bounded size by a hash. In a shard every node has a level drawn from its hash, and
each level is a graph: a node picks the nearest of its candidates that no picked one is nearer to, and
is linked back. Candidates are the nearest nodes of its own level and of the level above, so that
links lead into a group of near copies and out of it. A shard is one row of flat arrays: vectors, ids
and, per level, offsets into one array of neighbours.

For inner products of vectors of any length, all are scaled by the longest of the shard and get one
further component that brings them to length one; then the nearest by angle is the one with the
largest product. Where lengths differ, a node also links to the nodes with the largest products, for a
query lies apart from all nodes then.

A search goes through all shards: it descends the levels with a narrow beam, follows the links of
level 0 with a wide one, and scores what it found exactly, in double precision, component by component.

Vectors that are null, empty, zero, or hold a null or a value that is not finite take no part, nor do
rows without an id. Vectors of different lengths never meet. A row that is repeated whole counts once;
rows that share an id and differ are candidates of their own, but no row is found for its own id. Ties
go to the smaller id. An empty table gives an empty result. Further columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from curbstar.llm.common import mixed
from curbstar.sources.scratch import stored

#: Nodes of a shard, on average.
SHARD_NODES = 16_384
#: Queries that meet a shard in one task, on average.
CHUNK_QUERIES = 8_192
#: Links that a node picks; it may be linked back by as many again, and by those whose first link it is.
LINKS = 20
#: Nearest nodes of a level among which links are picked, and nearest ones of the level above.
CANDIDATES, CANDIDATES_ABOVE = 72, 16
#: Links to the nodes with the largest products, in shards where the further component exceeds this.
LINKS_OUTWARD, UNEVEN = 20, 0.1
#: Nodes that a search keeps on level 0 and above, and nodes whose links it follows at a time.
BEAM, BEAM_ABOVE, STEP = 128, 16, 6
#: Smallest ids kept of equal vectors; as many results and one can be asked of an index.
IDS = 65

_ROWS, _QUERIES = 512, 256

INDEX = (
    "dim int, shard int, vectors array<double>, id_offsets array<int>, ids array<long>,"
    " link_offsets array<array<int>>, links array<array<int>>"
)


def numbers(embedding: str) -> Column:
    """The components as doubles; null unless there are some, all finite and not all zero."""
    vector = F.col(embedding).cast("array<double>")
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.when(finite & F.exists(vector, lambda x: x != 0), vector)


def build_index(vectors: DataFrame, vec_id: str = "vec_id", embedding: str = "embedding") -> DataFrame:
    """The index of all vectors, a row per shard, as a stored table (schema ``INDEX``)."""
    own = vectors.select(F.col(vec_id).cast("long").alias("id"), numbers(embedding).alias("vector"))
    own = own.filter("id IS NOT NULL AND vector IS NOT NULL").distinct()
    # Ranked within equal vectors before the shuffle, so a group of copies is a few rows per task.
    first = Window.partitionBy("vector").orderBy("id")
    kept = own.withColumn("place", F.row_number().over(first)).filter(F.col("place") <= IDS)
    nodes = stored(kept.groupBy("vector").agg(F.sort_array(F.collect_list("id")).alias("ids")), "index-nodes")
    shards = max(1, math.ceil(nodes.count() / SHARD_NODES))
    dealt = nodes.select(
        F.size("vector").alias("dim"), F.pmod(F.xxhash64("vector"), F.lit(shards)).cast("int").alias("shard"), "vector", "ids"
    )
    return stored(dealt.groupBy("dim", "shard").applyInArrow(_shard, INDEX), "index")


def search(
    index: DataFrame, queries: DataFrame, k: int, query_id: str = "vec_id", embedding: str = "embedding"
) -> DataFrame:
    """(query_id, rank, vec_id, score): the ``k`` nearest found of each query, its own id left out.

    Queries that share an id and differ are answered each.
    """
    if not 0 < k < IDS:
        raise ValueError(f"An index answers 1 to {IDS - 1} neighbours, not {k}")
    asked = queries.select(F.col(query_id).cast("long").alias("query_id"), numbers(embedding).alias("vector"))
    asked = asked.filter("query_id IS NOT NULL AND vector IS NOT NULL").distinct()
    asked = stored(asked.withColumn("query", F.monotonically_increasing_id()), "queries")
    chunks = max(1, math.ceil(asked.count() / CHUNK_QUERIES))
    shards = 1 + (index.agg(F.max("shard")).first()[0] or 0)
    dealt = asked.select(
        F.size("vector").alias("dim"),
        F.explode(F.sequence(F.lit(0), F.lit(shards - 1))).alias("shard"),
        F.pmod(F.xxhash64("query"), F.lit(chunks)).cast("int").alias("chunk"),
        "query",
        "query_id",
        "vector",
    )
    copies = index.withColumn("chunk", F.explode(F.sequence(F.lit(0), F.lit(chunks - 1))))
    key = ["dim", "shard", "chunk"]

    def found(shard: pa.Table, chunk: pa.Table) -> pa.Table:
        return _found(shard, chunk, k)

    rows = copies.groupBy(*key).cogroup(dealt.groupBy(*key)).applyInArrow(
        found, "query long, query_id long, vec_id long, score double"
    )
    best = Window.partitionBy("query").orderBy(F.desc("score"), "vec_id")
    ranked = rows.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")


def _shard(nodes: pa.Table) -> pa.Table:
    """The index row of the nodes of one shard, in the order of their first ids."""
    lists = nodes["ids"].combine_chunks()
    first = lists.values.to_numpy()[lists.offsets.to_numpy()[:-1]]
    nodes = nodes.take(np.argsort(first, kind="stable"))
    lists = nodes["ids"].combine_chunks()
    ids, id_offsets = lists.flatten().to_numpy(), np.concatenate([[0], np.cumsum(lists.value_lengths().to_numpy())])
    dim = nodes["dim"][0].as_py()
    vectors = nodes["vector"].combine_chunks().flatten().to_numpy().reshape(-1, dim)
    points = _points(vectors)
    levels = _levels(ids[id_offsets[:-1]])
    link_offsets, links = [], []
    for level in range(int(levels.max(initial=0)) + 1):
        offsets, targets = _links(points, np.flatnonzero(levels >= level), levels > level)
        link_offsets.append(offsets.tolist())
        links.append(targets.tolist())
    row = {
        "dim": [dim],
        "shard": [nodes["shard"][0].as_py()],
        "vectors": [vectors.ravel()],
        "id_offsets": [id_offsets.astype(np.int32)],
        "ids": [ids],
        "link_offsets": [link_offsets],
        "links": [links],
    }
    return pa.table(row, _SCHEMA)


_SCHEMA = pa.schema(
    [
        ("dim", pa.int32()),
        ("shard", pa.int32()),
        ("vectors", pa.list_(pa.float64())),
        ("id_offsets", pa.list_(pa.int32())),
        ("ids", pa.list_(pa.int64())),
        ("link_offsets", pa.list_(pa.list_(pa.int32()))),
        ("links", pa.list_(pa.list_(pa.int32()))),
    ]
)


def _points(vectors: np.ndarray) -> np.ndarray:
    """Vectors over the longest of them, with one more component that makes each of length one."""
    scaled = vectors / np.abs(vectors).max()
    scaled /= np.sqrt((scaled**2).sum(axis=1).max())
    rest = np.sqrt(np.clip(1 - (scaled**2).sum(axis=1), 0, None))
    return np.hstack([scaled, rest[:, None]]).astype(np.float32)


def _levels(ids: np.ndarray) -> np.ndarray:
    """Levels that one node in ``LINKS`` outgrows, as long as a level has a few nodes."""
    share = ((mixed(ids.astype(np.uint64)) >> np.uint64(11)).astype(np.float64) + 1) / 2.0**53
    levels = np.floor(-np.log(share) / math.log(LINKS)).astype(np.int64)
    while levels.size and (levels >= levels.max()).sum() < BEAM_ABOVE and levels.max() > 0:
        levels = np.minimum(levels, levels.max() - 1)
    return levels


def _links(points: np.ndarray, nodes: np.ndarray, above: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Offsets for all points, and the neighbours of ``nodes`` in the graph of one level."""
    own, high = points[nodes], np.flatnonzero(above[nodes])
    tails, heads, near, order = [], [], [], []
    far_tails, far_heads = [np.empty(0, np.int64)], [np.empty(0, np.int64)]
    uneven = (own[:, -1] > UNEVEN).any()
    for start in range(0, nodes.size, _ROWS):
        block = own[start : start + _ROWS]
        rows = np.arange(len(block))
        product = block @ own.T
        product[rows, rows + start] = -np.inf
        some = [_largest(product, CANDIDATES)]
        if high.size:
            some.append(high[_largest(product[:, high], CANDIDATES_ABOVE)])
        candidates = np.hstack(some)
        value = np.take_along_axis(product, candidates, 1)
        by_value = np.argsort(-value, axis=1, kind="stable")
        candidates, value = np.take_along_axis(candidates, by_value, 1), np.take_along_axis(value, by_value, 1)
        picked = _picked(own[candidates], value)
        row, place = np.nonzero(picked)
        tails.append(nodes[row + start])
        heads.append(nodes[candidates[row, place]])
        near.append(value[row, place])
        order.append(np.cumsum(picked, axis=1)[row, place] - 1)
        if uneven:
            product = block[:, :-1] @ own[:, :-1].T
            product[rows, rows + start] = -np.inf
            outward = _largest(product, LINKS_OUTWARD)
            row, place = np.nonzero(np.take_along_axis(product, outward, 1) > -np.inf)
            far_tails.append(nodes[row + start])
            far_heads.append(nodes[outward[row, place]])
    tail, head, value, place = (np.concatenate(x) for x in (tails, heads, near, order))
    # Both directions; a node keeps its own links, those of nodes that picked it first, and the nearest others.
    a, b = np.concatenate([tail, head]), np.concatenate([head, tail])
    value = np.concatenate([value, value])
    must = np.concatenate([np.ones(tail.size, bool), place == 0])
    at = np.lexsort((-value, ~must, b, a))
    a, b, value, must = a[at], b[at], value[at], must[at]
    once = np.ones(a.size, bool)
    once[1:] = (a[1:] != a[:-1]) | (b[1:] != b[:-1])
    a, b, value, must = a[once], b[once], value[once], must[once]
    at = np.lexsort((-value, ~must, a))
    a, b, must = a[at], b[at], must[at]
    starts = np.searchsorted(a, np.arange(len(points) + 1))
    keep = must | (np.arange(a.size) - starts[a] < 2 * LINKS)
    a, b = np.concatenate([a[keep], *far_tails]), np.concatenate([b[keep], *far_heads])
    a, b = np.unique(np.array([a, b]), axis=1)
    return np.searchsorted(a, np.arange(len(points) + 1)).astype(np.int32), b.astype(np.int32)


def _largest(product: np.ndarray, n: int) -> np.ndarray:
    if product.shape[1] <= n:
        return np.tile(np.arange(product.shape[1]), (len(product), 1))
    return np.argpartition(-product, n - 1, axis=1)[:, :n]


def _picked(candidates: np.ndarray, value: np.ndarray) -> np.ndarray:
    """Which candidates a node links to, nearest first: those that no picked one is nearer to."""
    between = np.matmul(candidates, candidates.transpose(0, 2, 1))
    picked = np.zeros(value.shape, dtype=bool)
    count = np.zeros(len(value), dtype=np.int64)
    for j in range(value.shape[1]):
        nearer = (picked & (between[:, j, :] > value[:, j, None])).any(axis=1)
        fits = (value[:, j] > -np.inf) & (count < LINKS) & ~nearer
        picked[:, j] = fits
        count += fits
    # Places that stay free go to the nearest others, but never to one node twice.
    free = LINKS // 2 - count
    if (free > 0).any():
        same = (np.triu(between > 1 - 1e-6, 1) if between.shape[1] else between).any(axis=1)
        others = ~picked & ~same & (value > -np.inf)
        picked |= others & (np.cumsum(others, axis=1) <= free[:, None])
    return picked


def _found(shard: pa.Table, chunk: pa.Table, k: int) -> pa.Table:
    """The nearest found in one shard for each query of a chunk."""
    out: dict[str, list] = {"query": [], "query_id": [], "vec_id": [], "score": []}
    if shard.num_rows and chunk.num_rows:
        graph = _Graph(shard)
        keys, ids = chunk["query"].to_numpy(), chunk["query_id"].to_numpy()
        vectors = chunk["vector"].combine_chunks().flatten().to_numpy().reshape(-1, graph.dim)
        for start in range(0, len(keys), _QUERIES):
            part = slice(start, start + _QUERIES)
            row, vec_id, score = graph.nearest(vectors[part], ids[part], k)
            out["query"].append(keys[part][row])
            out["query_id"].append(ids[part][row])
            out["vec_id"].append(vec_id)
            out["score"].append(score)
    types = {"query": np.int64, "query_id": np.int64, "vec_id": np.int64, "score": np.float64}
    return pa.table({n: np.concatenate([np.empty(0, types[n]), *parts]) for n, parts in out.items()})


class _Graph:
    """One shard's row, ready to be searched by many queries at a time."""

    def __init__(self, shard: pa.Table):
        row = {name: shard[name].combine_chunks()[0] for name in shard.column_names}
        self.dim = row["dim"].as_py()
        self.vectors = row["vectors"].values.to_numpy().reshape(-1, self.dim)
        self.size = len(self.vectors)
        #: One row more stands for "no node".
        self.points = np.vstack([_points(self.vectors)[:, : self.dim], np.zeros((1, self.dim), np.float32)])
        self.id_offsets, self.ids = row["id_offsets"].values.to_numpy(), row["ids"].values.to_numpy()
        self.offsets, self.links = [], []
        for offsets, links in zip(row["link_offsets"], row["links"]):
            own = offsets.values.to_numpy().astype(np.int64)
            self.offsets.append(np.append(own, own[-1]))
            self.links.append(np.append(links.values.to_numpy(), self.size))

    def nearest(self, vectors: np.ndarray, ids: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(place of the query, id, score) of the ``k`` best found, ids equal to the query's left out."""
        queries = (vectors / np.abs(vectors).max(axis=1, keepdims=True)).astype(np.float32)
        degree = np.diff(self.offsets[-1])[: self.size]
        top = np.flatnonzero(degree) if len(self.offsets) > 1 else np.arange(min(self.size, BEAM_ABOVE))
        value = queries @ self.points[top].T
        at = _largest(value, BEAM_ABOVE)
        nodes, value = top[at], np.take_along_axis(value, at, 1)
        for level in range(len(self.offsets) - 1, -1, -1):
            nodes, value = self._beam(level, queries, nodes, value, BEAM_ABOVE if level else max(BEAM, 3 * k))
        row, place = np.nonzero(nodes < self.size)
        node = nodes[row, place]
        score = np.zeros(node.size)
        for j in range(self.dim):
            score += vectors[row, j] * self.vectors[node, j]
        copies = self.id_offsets[node + 1] - self.id_offsets[node]
        within = np.arange(copies.sum()) - np.repeat(np.cumsum(copies) - copies, copies)
        vec_id = self.ids[np.repeat(self.id_offsets[node], copies) + within]
        row, score = np.repeat(row, copies), np.repeat(score, copies)
        other = vec_id != ids[row]
        row, vec_id, score = row[other], vec_id[other], score[other]
        at = np.lexsort((vec_id, -score, row))
        row, vec_id, score = row[at], vec_id[at], score[at]
        first = np.arange(row.size) - np.searchsorted(row, row) < k
        return row[first], vec_id[first], score[first]

    def _beam(
        self, level: int, queries: np.ndarray, start: np.ndarray, start_value: np.ndarray, width: int
    ) -> tuple[np.ndarray, np.ndarray]:
        """The best ``width`` nodes met per query when the links of the best are followed until none is new."""
        count, none = len(queries), self.size
        offsets, links = self.offsets[level], self.links[level]
        width = max(width, start.shape[1])
        nodes = np.full((count, width), none, dtype=np.int64)
        value = np.full((count, width), -np.inf, dtype=np.float32)
        nodes[:, : start.shape[1]], value[:, : start.shape[1]] = start, start_value
        open_ = nodes < none
        seen = np.zeros((count, none + 1), dtype=bool)
        seen[:, none] = True
        seen[np.arange(count)[:, None], nodes] = True
        active = np.arange(count)
        while True:
            waiting = np.where(open_[active], value[active], -np.inf)
            alive = waiting.max(axis=1) > -np.inf
            active, waiting = active[alive], waiting[alive]
            if not active.size:
                return nodes, value
            pick = _largest(waiting, STEP)
            valid = np.take_along_axis(waiting, pick, 1) > -np.inf
            at = np.where(valid, nodes[active[:, None], pick], none)
            open_[active[:, None], pick] = False
            begin = offsets[at]
            degree = offsets[at + 1] - begin
            reach = np.arange(max(1, int(degree.max())))
            place = np.minimum(begin[..., None] + reach, len(links) - 1)
            new = np.where(reach < degree[..., None], links[place], none).reshape(len(active), -1)
            new = np.where(seen[active[:, None], new], none, new)
            new.sort(axis=1)
            new[:, 1:][new[:, 1:] == new[:, :-1]] = none
            new.sort(axis=1)
            new = new[:, : max(1, int((new < none).sum(axis=1).max()))]
            seen[active[:, None], new] = True
            close = np.matmul(self.points[new], queries[active][:, :, None])[:, :, 0]
            close[new == none] = -np.inf
            all_value = np.hstack([value[active], close])
            best = np.argpartition(-all_value, width - 1, axis=1)[:, :width]
            nodes[active] = np.take_along_axis(np.hstack([nodes[active], new]), best, 1)
            value[active] = np.take_along_axis(all_value, best, 1)
            open_[active] = np.take_along_axis(np.hstack([open_[active], new < none]), best, 1)


def recall(found: DataFrame, exact: DataFrame) -> float:
    """Share of exact (query_id, vec_id) rows that were found."""
    both = exact.join(found, ["query_id", "vec_id"], "left_semi").count()
    return both / max(1, exact.count())


def nearest_exact(vectors: Iterator, queries: Iterator, k: int) -> list[tuple[int, int, int, float]]:
    """The same rows by brute force, for tests and for measuring recall on a fixture."""
    rows = [(i, np.asarray(v, dtype=np.float64)) for i, v in vectors]
    out = []
    for q, a in queries:
        a = np.asarray(a, dtype=np.float64)
        scored = []
        for i, b in rows:
            if i != q and len(a) == len(b):
                total = 0.0
                for x, y in zip(a.tolist(), b.tolist()):
                    total += x * y
                scored.append((-total, i))
        out += [(q, rank, i, -s) for rank, (s, i) in enumerate(sorted(scored)[:k], 1)]
    return out
