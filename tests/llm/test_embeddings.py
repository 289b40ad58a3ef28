import numpy as np
import pytest
from pyspark.sql import functions as F

from tourney.llm import graph_search, quantised

SCHEMA = "vec_id long, embedding array<float>, label string, score int, rank int"


def rows_of(vectors, ids=None):
    ids = range(len(vectors)) if ids is None else ids

    def numbers(vector):
        return None if vector is None else [None if x is None else float(x) for x in vector]

    return [
        (None if i is None else int(i), numbers(v), "x", 1, 2)
        for i, v in zip(ids, vectors, strict=True)
    ]


def clusters(seed, count, size=16, spread=0.06):
    rng = np.random.default_rng(seed)
    out = []
    while len(out) < count:
        centre = rng.normal(size=size)
        centre /= np.linalg.norm(centre)
        for _ in range(int(rng.integers(1, 12))):
            out.append((centre + spread * rng.normal(size=size)) * rng.uniform(0.5, 3))
    return np.array(out[:count], np.float32)


ODD = [None, [], [0.0] * 16, [float("nan")] + [1.0] * 15, [float("inf")] + [1.0] * 15,
       [None] + [1.0] * 15, [1.0, 2.0]]


def links_by_brute_force(vectors, ids, cosine):
    units = vectors.astype(np.float64)
    units /= np.linalg.norm(units, axis=1)[:, None]
    near = units @ units.T >= cosine
    root = {i: i for i in ids}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in zip(*np.nonzero(near), strict=True):
        low, high = sorted((find(ids[a]), find(ids[b])))
        root[high] = low
    return {i: (int(n) - 1, find(i)) for i, n in zip(ids, near.sum(axis=1), strict=True)}


@pytest.mark.parametrize("seed", [1, 2])
def test_links_of_brute_force(spark, monkeypatch, seed):
    monkeypatch.setattr(quantised, "MEMBERS", 100)
    monkeypatch.setattr(quantised, "QUERIES", 150)
    vectors = clusters(seed, 500)
    vectors[7] = vectors[300] = vectors[301]
    ids = [1000 - i for i in range(500)]
    rows = rows_of(vectors, ids) + rows_of(ODD, range(2000, 2000 + len(ODD)))
    frame = spark.createDataFrame(rows, SCHEMA).repartition(4)
    found = {r.vec_id: (r.n_links, r.component_id, r.kept) for r in
             quantised.linked_vectors(frame, 0.95).collect()}
    for i, (links, root) in links_by_brute_force(vectors, ids, 0.95).items():
        assert found[i] == (links, root, root == i)
    for i in range(2000, 2000 + len(ODD)):
        assert found[i] == (0, i, True)


def test_links_of_low_rank_vectors(spark, monkeypatch):
    """Differences in few directions point to other lists more often than random ones."""
    monkeypatch.setattr(quantised, "VECTORS_PER_LIST", 50)
    rng = np.random.default_rng(5)
    vectors = (rng.normal(size=(3000, 6)) @ rng.normal(size=(6, 256))).astype(np.float32)
    ids = list(range(3000))
    frame = spark.createDataFrame(rows_of(vectors), SCHEMA).repartition(4)
    found = {r.vec_id: (r.n_links, r.component_id) for r in
             quantised.linked_vectors(frame, 0.95).collect()}
    assert found == links_by_brute_force(vectors, ids, 0.95)


def test_link_tables_of_few_and_repeated_rows(spark):
    same = [1.0, 2.0, 3.0]
    rows = rows_of([same, same, same, [-1.0, 0, 0], same], [5, 5, 3, 9, None])
    found = quantised.linked_vectors(spark.createDataFrame(rows, SCHEMA)).collect()
    assert sorted((r.vec_id or -1, r.n_links, r.component_id or -1, r.kept) for r in found) == [
        (-1, 0, -1, True), (3, 2, 3, True), (5, 2, 3, False), (5, 2, 3, False), (9, 0, 9, True),
    ]
    assert quantised.linked_vectors(spark.createDataFrame([], SCHEMA)).count() == 0


def nearest_by_brute_force(vectors, ids, queries, k):
    scores = vectors.astype(np.float64) @ vectors.astype(np.float64).T
    out = {}
    for q in queries:
        at = ids.index(q)
        order = sorted((-scores[at, j], ids[j]) for j in range(len(ids)) if ids[j] != q)
        out[q] = [(i, -s) for s, i in order[:k]]
    return out


def test_recall_scores_and_order(spark, monkeypatch):
    monkeypatch.setattr(graph_search, "LANE_QUERIES", 40)
    vectors = clusters(3, 2000, size=24, spread=0.2)
    vectors[10:60] = vectors[10]  # equal vectors are one node
    ids = [3 * i for i in range(2000)]
    rows = rows_of(vectors, ids) + rows_of(ODD, range(7000, 7000 + len(ODD)))
    frame = spark.createDataFrame(rows, SCHEMA).repartition(4)
    found = graph_search.nearest(frame, F.col("vec_id") % 20 == 0, k=20, shard_rows=600)
    by_query = {}
    for r in sorted(found.collect(), key=lambda r: (r.query_id, r.rank)):
        by_query.setdefault(r.query_id, []).append(r)
    expected = nearest_by_brute_force(vectors, ids, [i for i in ids if i % 20 == 0], 20)
    assert by_query.keys() == expected.keys()
    hits = 0
    for q, rows in by_query.items():
        assert [r.rank for r in rows] == list(range(1, 21))
        assert [(-r.score, r.vec_id) for r in rows] == sorted((-r.score, r.vec_id) for r in rows)
        exact = vectors[[ids.index(r.vec_id) for r in rows]].astype(float) @ vectors[
            ids.index(q)
        ].astype(float)
        assert np.allclose([r.score for r in rows], exact, rtol=1e-12)
        hits += len({r.vec_id for r in rows} & {i for i, _ in expected[q]})
    assert hits / (20 * len(expected)) > 0.95


def test_all_candidates_if_fewer(spark):
    rows = rows_of([[1.0, 0], [2.0, 0], [2.0, 0], [0.5, 1], [3.0, 3]], [20, 1, 2, 3, None])
    found = graph_search.nearest(spark.createDataFrame(rows, SCHEMA), F.col("vec_id") % 20 == 0)
    assert [(r.query_id, r["rank"], r.vec_id, r.score) for r in found.orderBy("rank").collect()] == [
        (20, 1, 1, 2.0), (20, 2, 2, 2.0), (20, 3, 3, 0.5),
    ]
    empty = graph_search.nearest(spark.createDataFrame([], SCHEMA), F.col("vec_id") % 20 == 0)
    assert empty.count() == 0


def test_pruned_edges_are_diverse():
    points = np.array([[0, 0], [1, 0], [1.1, 0], [0, 1], [-1, 0]], np.float32)
    kept = graph_search.prune(points, np.array([0]), np.array([[1, 2, 3, 4, -1, 1]]))[0]
    assert set(kept[kept >= 0].tolist()) == {1, 3, 4}


def mixed_lengths():
    """Vectors of 16 and of 24 components, ids in turn; one id occurs in both lengths."""
    long, short = clusters(6, 300), clusters(7, 200, size=24)
    short[9] = short[10]
    return (long, [2 * i for i in range(300)]), (short, [2 * i + 1 for i in range(199)] + [0])


def test_links_within_every_length(spark):
    parts = mixed_lengths()
    rows = [row for vectors, ids in parts for row in rows_of(vectors, ids)]
    found = quantised.linked_vectors(spark.createDataFrame(rows, SCHEMA).repartition(4)).collect()
    expected = [
        (i, *pair) for v, ids in parts for i, pair in links_by_brute_force(v, ids, 0.95).items()
    ]
    assert sorted((r.vec_id, r.n_links, r.component_id) for r in found) == sorted(expected)


def test_nearest_within_every_length(spark):
    parts = mixed_lengths()
    rows = [row for vectors, ids in parts for row in rows_of(vectors, ids)]
    frame = spark.createDataFrame(rows, SCHEMA).repartition(4)
    asks = F.col("vec_id").between(1, 40)
    by_query = {}
    for r in graph_search.nearest(frame, asks, k=20).collect():
        by_query.setdefault(r.query_id, set()).add(r.vec_id)
    assert by_query.keys() == set(range(1, 41))
    hits = 0
    for vectors, ids in parts:
        queries = [i for i in ids if 1 <= i <= 40]
        for q, best in nearest_by_brute_force(vectors, ids, queries, 20).items():
            assert len(by_query[q]) == 20 and by_query[q] <= set(ids)
            hits += len(by_query[q] & {i for i, _ in best})
    assert hits / (20 * 40) > 0.95
