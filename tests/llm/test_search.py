"""The three searching operators against brute force, on given tables and on hand-made rows."""

import collections
import math
import random

import brute
import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from curbstar.llm import hnsw, lexical, negatives
from curbstar.sources.scratch import stored

VECTORS = "vec_id long, embedding array<float>, label int, row string, block int, vector string, query int, ids string"


def usable(v):
    return v is not None and len(v) > 0 and all(x is not None and math.isfinite(x) for x in v)


def odd_vectors():
    """Vectors of several lengths, copies, repeated rows, and rows that take no part."""
    rng = np.random.default_rng(5)
    rows = [(i, (rng.standard_normal(12) * rng.choice([0.2, 1, 7])).astype(np.float32).tolist(), i % 4) for i in range(500)]
    rows += [(1000 + i, [1.0] * 12, i % 3) for i in range(150)]  # one vector under many ids
    base = rng.standard_normal(12)
    rows += [(2000 + i, (base + rng.standard_normal(12) * 1e-3).astype(np.float32).tolist(), 1) for i in range(200)]
    rows += [(3000 + i, rng.standard_normal(3).astype(np.float32).tolist(), i % 2) for i in range(40)]
    rows += [rows[0], rows[0], (100, [2.0] * 12, 3), (-20, [0.5] * 12, 0), (-50, [0.25] * 12, None)]
    nan, inf = float("nan"), float("inf")
    bad = [None, [], [0.0] * 12, [None] * 12, [nan] + [1.0] * 11, [inf] + [1.0] * 11, [-inf] * 12]
    rows += [(4000 + 100 * i, v, 1) for i, v in enumerate(bad)] + [(None, [1.0] * 12, 1)]
    return rows


def frame(spark, rows):
    full = [(i, v, label, "x", 1, "y", 2, "z") for i, v, label in rows]
    return spark.createDataFrame(full, VECTORS).repartition(5)


def distinct_rows(rows):
    kept = {(i, tuple(v), label) for i, v, label in rows if i is not None and usable(v)}
    return [(i, list(v), label) for i, v, label in kept]


def check_neighbours(found, rows, every, k):
    """Exact scores, full and ordered lists, own ids left out; the recall against brute force."""
    pairs = [(i, v) for i, v, _ in rows if any(v)]
    unique = list({(i, tuple(v)) for i, v in pairs})
    exact = hnsw.nearest_exact(unique, [(i, v) for i, v in unique if i % every == 0], k)
    want, got = collections.defaultdict(list), collections.defaultdict(list)
    for q, _, i, s in exact:
        want[q].append((i, s))
    for r in found.collect():
        got[r["query_id"]].append((r["rank"], r["vec_id"], r["score"]))
    assert set(got) == set(want)
    vectors = collections.defaultdict(list)
    for i, v in unique:
        vectors[i].append(v)
    hits = 0
    for q, own in got.items():
        assert len(own) == len(want[q])
        if len(vectors[q]) == 1:
            own.sort()
            assert [x[0] for x in own] == list(range(1, len(own) + 1))
            assert [(-s, i) for _, i, s in own] == sorted((-s, i) for _, i, s in own)
        for _, i, s in own:
            sums = set()
            for a in vectors[q]:
                for b in vectors[i]:
                    total = 0.0
                    for x, y in zip(a, b):
                        total += x * y
                    sums.add(total)
            assert i != q and s in sums
        hits += len(collections.Counter(i for _, i, _ in own) & collections.Counter(i for i, _ in want[q]))
    return hits / len(exact)


def test_nearest_of_given_vectors(spark, sf_dir):
    given = spark.read.parquet(f"{sf_dir}/embeddings.parquet")
    index = hnsw.build_index(given)
    found = hnsw.search(index, given.filter("vec_id % 20 = 0"), 20)
    rows = [(r["vec_id"], r["embedding"], r["label"]) for r in given.collect()]
    assert check_neighbours(found, rows, 20, 20) >= 0.9
    assert sum(len(r["ids"]) for r in index.collect()) == len(rows), "every row is in the index"


def test_nearest_of_odd_vectors_in_several_shards(spark, monkeypatch):
    monkeypatch.setattr(hnsw, "SHARD_NODES", 200)
    monkeypatch.setattr(hnsw, "CHUNK_QUERIES", 20)
    rows = odd_vectors()
    df = frame(spark, rows)
    found = hnsw.search(hnsw.build_index(df), df.filter("vec_id % 10 = 0"), 20)
    assert found.columns == ["query_id", "rank", "vec_id", "score"]
    assert check_neighbours(found, distinct_rows(rows), 10, 20) >= 0.9


def test_nearest_of_few_and_none(spark):
    few = frame(spark, [(0, [1.0, 0.0], 1), (20, [0.0, 1.0], 1), (3, [1.0], 1), (40, None, 1)])
    found = hnsw.search(hnsw.build_index(few), few.filter("vec_id % 20 = 0"), 20)
    assert sorted(map(tuple, found.collect())) == [(0, 1, 20, 0.0), (20, 1, 0, 0.0)]
    none = few.filter("vec_id < 0")
    assert hnsw.search(hnsw.build_index(none), none, 20).count() == 0
    with pytest.raises(ValueError):
        hnsw.search(hnsw.build_index(few), few, hnsw.IDS)


def test_recall_of_one_large_shard():
    """Vectors without any structure are the hardest; the search reads a part of them only."""
    rng = np.random.default_rng(1)
    vectors = rng.standard_normal((6000, 48)) * rng.uniform(0.5, 2, (6000, 1))
    ids = np.arange(6000)
    nodes = {"dim": [48] * 6000, "shard": [0] * 6000, "vector": list(vectors), "ids": [[i] for i in ids]}
    types = [pa.int32(), pa.int32(), pa.list_(pa.float64()), pa.list_(pa.int64())]
    table = pa.table({n: pa.array(v, t) for (n, v), t in zip(nodes.items(), types)})
    asked = ids[::30]
    chunk = pa.table({"query": asked, "query_id": asked, "vector": pa.array(list(vectors[asked]), pa.list_(pa.float64()))})
    found = hnsw._found(hnsw._shard(table), chunk, 20).to_pylist()
    product = vectors[asked] @ vectors.T
    product[np.arange(asked.size), asked] = -np.inf
    want = {(int(q), int(i)) for q, row in zip(asked, product) for i in np.argsort(-row)[:20]}
    assert len(want & {(r["query_id"], r["vec_id"]) for r in found}) >= 0.95 * len(want)


def brute_negatives(rows, every, low=50, high=95):
    whole = [(i, label, [math.floor(256 * x) for x in v]) for i, v, label in rows if label is not None]
    whole = [x for x in whole if sum(y * y for y in x[2]) < 1 << 62]
    out = []
    for i, label, a in whole:
        if i % every:
            continue
        scores = [(-sum(x * y for x, y in zip(a, b)), j, own) for j, own, b in whole if j != i and len(a) == len(b)]
        for p, j, _ in sorted(s for s in scores if s[2] == label)[:5]:
            fits = sorted(s for s in scores if s[2] != label and low * -p <= 100 * -s[0] <= high * -p)[:3]
            out += [(i, j, rank, n, -p, -s) for rank, (s, n, _) in enumerate(fits, 1)]
    return out


def test_negatives_of_odd_vectors(spark, monkeypatch):
    monkeypatch.setattr(negatives, "BLOCK_ROWS", 60)
    monkeypatch.setattr(negatives, "CHUNK_ANCHORS", 7)
    rows = odd_vectors()
    for scale in (1.0, 1e5):  # the second beyond what doubles add exactly
        own = [(i, v and [x and x * scale for x in v], label) for i, v, label in rows]
        own = [(i, v and np.array(v, dtype=np.float32).tolist() if v and None not in v else v, label) for i, v, label in own]
        df = frame(spark, own)
        found = [tuple(r) for r in negatives.hard_negatives(df, F.col("vec_id") % 10 == 0).collect()]
        assert sorted(found) == sorted(brute_negatives(distinct_rows(own), 10))


def test_negatives_leave_out_what_has_no_64_bit_score(spark):
    rows = [(0, [1.0, 1.0], 1), (1, [1.0, 0.5], 1), (2, [0.5, 0.5], 2), (3, [1e30, 0.0], 2)]
    df = frame(spark, rows)
    found = [tuple(r) for r in negatives.hard_negatives(df, F.col("vec_id") % 10 == 0).collect()]
    assert found == brute_negatives(rows[:3], 10)
    none = df.filter("vec_id < 0")
    assert negatives.hard_negatives(none, F.col("vec_id") % 10 == 0).count() == 0


def test_score_bounds_hold():
    """Every score lies between its bounds, also of equal, opposite and zero vectors."""
    rng = np.random.default_rng(2)
    vectors = np.floor(rng.standard_normal((80, 9)) * rng.choice([1, 50, 5000], (80, 1)))
    vectors = np.vstack([vectors, vectors[:20], -vectors[:20], np.zeros((2, 9)), vectors[:20] * 3])
    norm = np.sqrt((vectors**2).sum(axis=1))
    directions = vectors[:8] / norm[:8, None]
    batch = pa.record_batch({"integers": pa.array(list(vectors), pa.list_(pa.float64())), "norm": norm})
    ids = np.arange(len(vectors))
    columns = {"row": ids, "vec_id": ids, "label": ids, "norm": norm, "integers": batch.column("integers")}
    side = negatives._Side(pa.table(columns | {"angles": negatives._angles(batch, directions)}), ids, 9)
    low, high = negatives._bounds(side, slice(0, None), side, slice(0, None))
    scores = vectors @ vectors.T
    assert (low <= scores).all() and (scores <= high).all()
    assert (high - low < 2.5 + 1e-3 * norm[:, None] * norm[None]).any(), "near a direction the bounds are tight"


def brute_ranked(docs, items, k):
    words = [(d, collections.Counter(w), len(w)) for d, t in docs for w in [brute.plain_words(t)]]
    counted = [x for x in words if x[2]]
    documents, total = len(counted), sum(x[2] for x in counted)
    holding = collections.Counter(term for _, own, _ in counted for term in own)
    out = []
    for item, text in items:
        scored = []
        for d, own, n in counted:
            m = 10 + (90 * n * documents) // total
            score = 0
            for term in set(brute.plain_words(text)):
                weight = math.floor(1000 * math.log((2 * documents + 2) / (2 * holding[term] + 1)))
                score += weight * ((10**9 * own[term]) // (1000 * own[term] + 8 * m))
            if score > 0:
                scored.append((-score, d is None, d or 0, d))
        out += [(item, rank, d, -s) for rank, (s, _, _, d) in enumerate(sorted(scored)[:k], 1)]
    return out


ODD_TEXTS = [
    (None, "alpha beta gamma"),
    (1, None),
    (2, ""),
    (3, " \n.,;-"),
    (4, "alpha beta gamma"),
    (4, "alpha beta gamma"),
    (5, "ALPHA Beta gAmma Ébène ébène 漢字 x1"),
    (6, "alpha " * 40_000 + "end"),
    (7, "w" * 3_000_000 + " alpha"),
]
SCHEMA = "doc_id long, text string, n long, terms string, score long, item string"


def test_ranked_documents(spark, sf_dir, monkeypatch):
    given = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()]
    items = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/benchmark.parquet").select("item_id", "text").collect()]
    docs = given + ODD_TEXTS
    items = items[:10] + [(500, "alpha gamma alpha"), (501, None), (502, "??"), (None, "beta"), (500, "alpha gamma"), (503, "nowhere999")]
    df = spark.createDataFrame([(d, t, 1, "x", 2, "y") for d, t in docs], SCHEMA).repartition(5)
    asked = spark.createDataFrame(items, "item_id long, text string")
    want = sorted(brute_ranked(docs, items, 10), key=str)
    assert sorted(map(tuple, lexical.ranked_documents(df, asked, 10).collect()), key=str) == want
    # Many shards, and items in several blocks.
    monkeypatch.setattr(lexical, "SHARD_DOCUMENTS", 50)
    monkeypatch.setattr(lexical, "BLOCK_BYTES", 1_000)
    assert sorted(map(tuple, lexical.ranked_documents(df, asked, 10).collect()), key=str) == want


def test_ranked_documents_of_empty_tables(spark):
    docs, items = spark.createDataFrame([], SCHEMA), spark.createDataFrame([], "item_id long, text string")
    one = spark.createDataFrame([(1, "alpha")], "item_id long, text string")
    full = spark.createDataFrame([(1, "alpha", 1, "x", 2, "y")], SCHEMA)
    assert [lexical.ranked_documents(a, b, 10).count() for a, b in ((docs, items), (docs, one), (full, items))] == [0, 0, 0]


def test_blocks_are_skipped_without_loss(monkeypatch):
    """Lists cut into small blocks give the same results, and some blocks are not read."""
    monkeypatch.setattr(lexical, "SHORT_LIST", 10)
    monkeypatch.setattr(lexical, "BLOCK_DOCUMENTS", 8)
    rng = random.Random(3)
    topics = [[f"t{t}w{i}" for i in range(30)] for t in range(6)]
    common = [f"c{i}" for i in range(10)]
    docs = [(i, " ".join(rng.choices(topics[i % 6], k=rng.randrange(5, 40)) + rng.choices(common, k=20))) for i in range(900)]
    items = [(j, " ".join(rng.sample(topics[j % 6], 4) + rng.sample(common, 2))) for j in range(24)]
    vocabulary = sorted({w for _, t in items for w in t.split()})
    counted = [collections.Counter(t.split()) for _, t in docs]
    total = sum(len(t.split()) for _, t in docs)
    rows = {"shard": [], "doc_id": [], "length": [], "terms": [], "counts": []}
    for (d, t), own in zip(docs, counted):
        terms = [i for i, w in enumerate(vocabulary) if own[w]]
        values = (0, d, 10 + 90 * len(t.split()) * len(docs) // total, terms, [own[vocabulary[i]] for i in terms])
        for name, value in zip(rows, values):
            rows[name].append(value)
    weights = [math.floor(1000 * math.log((2 * len(docs) + 2) / (2 * sum(w in own for own in counted) + 1))) for w in vocabulary]
    ints = pa.list_(pa.int32())
    types = [pa.int32(), pa.int64(), pa.int64(), ints, ints]
    shard = lexical._shard(pa.table({n: pa.array(v, t) for (n, v), t in zip(rows.items(), types)}), np.array(weights))
    scored = []
    score = lexical._Lists._scores
    monkeypatch.setattr(lexical._Lists, "_scores", lambda self, docs: scored.append(docs.size) or score(self, docs))
    queries = [(j, np.array([vocabulary.index(w) for w in set(t.split())])) for j, t in items]
    found = lexical._found(shard, queries, np.array(weights), 10).to_pylist()
    want = [(i, d, s) for i, _, d, s in brute_ranked(docs, items, 10)]
    assert sorted((r["item_id"], r["doc_id"], r["score"]) for r in found) == sorted(want)
    assert sum(scored) < 0.5 * sum(any(own[w] for w in t.split()) for _, t in items for own in counted)


def test_index_is_a_table(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    index, weights = lexical.build_index(docs, [b"de", b"the"])
    again = stored(index, "test-index")
    assert again.columns == index.columns and len(weights) == 2
    assert lexical.search(again, [(1, [b"the"])], [b"de", b"the"], weights, 3).count() <= 3
