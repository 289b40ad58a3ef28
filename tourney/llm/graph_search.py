"""Approximate nearest neighbours on pruned directed graphs, one per shard.

Every vector is a node. Its edges come from a greedy search for it in the graph built so far: of the
nodes seen, robust pruning keeps the nearest, drops those that the kept one brings much closer (by
the factor ``ALPHA``), and goes on, so that a few edges lead in different directions. Queries walk
the graph with a beam; all queries of a block walk together.

Largest inner products become smallest distances by one more component that gives all vectors the
same norm. Scores are inner products of the original vectors in double precision.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Row, Window
from pyspark.sql import functions as F

from tourney.llm.scratch import cleaned, materialise
from tourney.llm.vectors import usable

# Vectors per graph, and queries that search a graph in one task.
SHARD_ROWS = 4_096
LANE_QUERIES = 4_096
DEGREE = 32
ALPHA = 1.2
BUILD_BEAM = 48
SEARCH_BEAM = 160
EXPANDED = 4
BATCH = 256


def walk(
    points: np.ndarray, edges: np.ndarray, queries: np.ndarray, entry: np.ndarray, beam: int
) -> tuple[np.ndarray, np.ndarray]:
    """Nodes nearest to each query and their squared distances, by greedy beam search.

    ``edges`` holds -1 where a node has fewer than the most neighbours. Each step expands the
    nearest nodes of the beam that have not been expanded, for all queries at once, until none is
    left in any beam.
    """
    rows = len(queries)
    norms = (points * points).sum(axis=1)
    offset = (queries * queries).sum(axis=1)[:, None]
    seen = np.zeros((rows, len(points) + 1), bool)
    seen[:, -1] = True  # stands for "no neighbour"

    def distance(which: np.ndarray, nodes: np.ndarray) -> np.ndarray:
        dots = np.einsum("qd,qnd->qn", queries[which], points[nodes])
        return np.where(nodes < 0, np.inf, norms[nodes] - 2 * dots + offset[which])

    width = max(beam, len(entry))
    nodes = np.full((rows, width), -1)
    nodes[:, : len(entry)] = entry
    far = np.full((rows, width), np.inf, np.float32)
    far[:, : len(entry)] = distance(np.arange(rows), nodes[:, : len(entry)])
    seen[:, entry] = True
    done = nodes < 0
    active = np.arange(rows)
    while len(active):
        waiting = np.where(done[active], np.inf, far[active])
        pick = np.argpartition(waiting, min(EXPANDED, width) - 1, axis=1)[:, :EXPANDED]
        open_ = np.isfinite(np.take_along_axis(waiting, pick, axis=1))
        alive = open_.any(axis=1)
        active, pick, open_ = active[alive], pick[alive], open_[alive]
        if not len(active):
            break
        done[active[:, None], pick] = True
        chosen = np.where(open_, nodes[active[:, None], pick], -1)
        found = np.where(chosen[..., None] < 0, -1, edges[chosen]).reshape(len(active), -1)
        found = np.sort(found, axis=1)
        again = np.zeros(found.shape, bool)
        again[:, 1:] = found[:, 1:] == found[:, :-1]
        found[again | seen[active[:, None], found]] = -1
        seen[active[:, None], found] = True
        new = distance(active, found).astype(np.float32)
        all_nodes = np.concatenate((nodes[active], found), axis=1)
        all_far = np.concatenate((far[active], new), axis=1)
        all_done = np.concatenate((done[active], found < 0), axis=1)
        best = np.argpartition(all_far, width - 1, axis=1)[:, :width]
        nodes[active] = np.take_along_axis(all_nodes, best, axis=1)
        far[active] = np.take_along_axis(all_far, best, axis=1)
        done[active] = np.take_along_axis(all_done, best, axis=1)
    return nodes, far


def prune(points: np.ndarray, centre: np.ndarray, candidates: np.ndarray) -> np.ndarray:
    """Diverse neighbours of every node of ``centre`` among its ``candidates`` (-1: none)."""
    candidates = np.sort(candidates, axis=1)
    again = np.zeros(candidates.shape, bool)
    again[:, 1:] = candidates[:, 1:] == candidates[:, :-1]
    valid = (candidates >= 0) & ~again & (candidates != centre[:, None])
    vectors = points[candidates]
    norms = (vectors * vectors).sum(axis=2)
    own = points[centre]
    to_centre = norms - 2 * np.einsum("bd,bnd->bn", own, vectors)
    to_centre += (own * own).sum(axis=1)[:, None]
    between = norms[:, :, None] + norms[:, None, :] - 2 * vectors @ vectors.transpose(0, 2, 1)
    left = np.where(valid, np.maximum(to_centre, 0), np.inf)
    kept = np.full((len(centre), DEGREE), -1)
    rows = np.arange(len(centre))
    for k in range(DEGREE):
        best = left.argmin(axis=1)
        there = np.isfinite(left[rows, best])
        if not there.any():
            break
        kept[there, k] = candidates[rows, best][there]
        covered = ALPHA * ALPHA * between[rows, best] <= left
        left[covered] = np.inf
        left[rows, best] = np.inf
    return kept


def build(points: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Edges of the graph over ``points``, and the nodes where searches start."""
    n = len(points)
    edges = np.full((n, DEGREE), -1)
    rng = np.random.default_rng(n)
    order = rng.permutation(n)
    centre = ((points - points.mean(axis=0)) ** 2).sum(axis=1).argmin()
    order = np.concatenate(([centre], order[order != centre]))
    entry = order[:1]
    inserted, size = 1, 1
    while inserted < n:
        batch = order[inserted : inserted + size]
        near, _ = walk(points, edges, points[batch], entry, BUILD_BEAM)
        # Points of one batch do not meet in the graph yet, so they are candidates as well.
        others = np.tile(batch[rng.permutation(len(batch))[:16]], (len(batch), 1))
        edges[batch] = prune(points, batch, np.concatenate((near, others), axis=1))
        source, target = np.repeat(batch, DEGREE), edges[batch].ravel()
        source, target = source[target >= 0], target[target >= 0]
        by_target = np.argsort(target, kind="stable")
        source, target = source[by_target], target[by_target]
        nodes, first, count = np.unique(target, return_index=True, return_counts=True)
        for start in range(0, len(nodes), BATCH):
            part = slice(start, start + BATCH)
            widest = int(count[part].max())
            added = np.full((len(nodes[part]), widest), -1)
            for row, (a, c) in enumerate(zip(first[part], count[part], strict=True)):
                added[row, :c] = source[a : a + c]
            edges[nodes[part]] = _with_back_edges(points, edges, nodes[part], added)
        inserted += len(batch)
        size = min(BATCH, max(1, inserted // 2))
    # A few spread starts spare long walks.
    return edges, np.unique(np.concatenate((entry, order[: min(n, 16)])))


def _with_back_edges(
    points: np.ndarray, edges: np.ndarray, nodes: np.ndarray, added: np.ndarray
) -> np.ndarray:
    both = np.concatenate((edges[nodes], added), axis=1)
    both = -np.sort(-both, axis=1)
    repeated = np.zeros(both.shape, bool)
    repeated[:, 1:] = (both[:, 1:] == both[:, :-1]) & (both[:, 1:] >= 0)
    both[repeated] = -1
    room = (both >= 0).sum(axis=1) <= DEGREE
    out = np.full((len(nodes), DEGREE), -1)
    packed = -np.sort(-both[room], axis=1)[:, :DEGREE]
    out[room, : packed.shape[1]] = packed
    if (~room).any():
        out[~room] = prune(points, nodes[~room], both[~room])
    return out


def _raised(vectors: np.ndarray, largest: float) -> np.ndarray:
    """Vectors with one more component, all of the norm ``largest`` (squared)."""
    rest = np.maximum(largest - (vectors * vectors).sum(axis=1), 0)
    return np.concatenate((vectors, np.sqrt(rest)[:, None]), axis=1).astype(np.float32)


def _distinct(vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First row of each distinct vector, and for every row the number of its vector."""
    _, first, number = np.unique(vectors, axis=0, return_index=True, return_inverse=True)
    return first, number.ravel()


@cleaned
def nearest(
    rows: DataFrame, is_query: Column, k: int = 20, shard_rows: int = SHARD_ROWS
) -> DataFrame:
    """The ``k`` rows of largest inner product found for every query row.

    ``rows`` has ``vec_id`` and ``embedding``; ``is_query`` marks the queries among them. Every row
    but those with the query's id is a candidate. Columns: ``query_id``, ``rank`` from 1, ``vec_id``
    and ``score``; equal scores by smaller id. Null, empty and zero vectors, those with null or
    non-finite components, and null ids take no part; others meet those of their length. Equal
    vectors are one node of a graph and all found with it. Each length has shards and jobs of its
    own, one after the other.

    Every row is in one shard of about ``shard_rows``, and every block of queries searches every
    shard, so a task holds one graph and one block.
    """
    good = rows.select(F.col("vec_id").cast("bigint").alias("vec_id"), "embedding", is_query.alias("asks"))
    good = good.where(usable("embedding") & F.col("vec_id").isNotNull())
    squared = F.aggregate(
        "embedding", F.lit(0.0), lambda s, x: s + x.cast("double") * x.cast("double")
    )
    good = good.withColumns({"norm": squared, "size": F.size("embedding")})
    good = materialise(good, "vectors")
    lengths = good.groupBy("size").agg(
        F.count(F.lit(1)).alias("rows"),
        F.sum(F.col("asks").cast("int")).alias("queries"),
        F.max("norm").alias("largest"),
    )
    found = good.sparkSession.createDataFrame([], "query_id bigint, vec_id bigint, score double")
    for stats in lengths.where("queries > 0").orderBy("size").collect():
        alike = good.where(F.col("size") == stats["size"])
        found = found.unionByName(_nearest_alike(alike, stats, k, shard_rows))
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return (
        found.withColumn("rank", F.row_number().over(best))
        .where(F.col("rank") <= k)
        .select("query_id", "rank", "vec_id", "score")
    )


def _nearest_alike(good: DataFrame, stats: Row, k: int, shard_rows: int) -> DataFrame:
    """The best of every shard for every query, among vectors of one length."""
    shards = max(1, -(-stats["rows"] // shard_rows))
    lanes = max(1, -(-stats["queries"] // LANE_QUERIES))
    largest = float(stats["largest"])

    kind = good.schema["embedding"].dataType.simpleString()
    shard = F.pmod(F.xxhash64("vec_id"), F.lit(shards)).cast("int")

    def connect(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values("vec_id", kind="stable").reset_index(drop=True)
        vectors = np.stack(group["embedding"].to_numpy()).astype(np.float64)
        first, number = _distinct(vectors)
        edges, entry = build(_raised(vectors[first], largest))
        starts = np.zeros(len(first), bool)
        starts[entry] = True
        lists: list = [None] * len(group)
        flags = np.zeros(len(group), bool)
        for node, row in enumerate(first):
            lists[row] = edges[node][edges[node] >= 0].astype(np.int32)
            flags[row] = starts[node]
        return group.assign(node=number, edges=lists, entry=flags)[
            ["shard", "vec_id", "embedding", "node", "edges", "entry"]
        ]

    graph = (
        good.select(shard.alias("shard"), "vec_id", "embedding")
        .groupBy("shard")
        .applyInPandas(
            connect,
            f"shard int, vec_id bigint, embedding {kind}, node int, edges array<int>, entry boolean",
        )
    )
    graph = materialise(graph, "graph")

    def search(key: tuple, members: pd.DataFrame, asking: pd.DataFrame) -> pd.DataFrame:
        empty = pd.DataFrame({"query_id": [], "vec_id": [], "score": []})
        if members.empty or asking.empty:
            return empty.astype({"query_id": "int64", "vec_id": "int64", "score": "float64"})
        vectors = np.stack(members["embedding"].to_numpy()).astype(np.float64)
        ids, node = members["vec_id"].to_numpy(), members["node"].to_numpy()
        heads = members[members["edges"].notna()].sort_values("node")
        edges = np.full((len(heads), DEGREE), -1)
        for i, found in enumerate(heads["edges"]):
            edges[i, : len(found)] = found
        points = _raised(np.stack(heads["embedding"].to_numpy()).astype(np.float64), largest)
        entry = np.flatnonzero(heads["entry"].to_numpy())
        by_node = np.argsort(node, kind="stable")
        edge = np.searchsorted(node[by_node], np.arange(len(heads) + 1))
        out = []
        for start in range(0, len(asking), BATCH):
            part = asking.iloc[start : start + BATCH]
            q = np.stack(part["embedding"].to_numpy()).astype(np.float64)
            flat = np.concatenate((q, np.zeros((len(q), 1))), axis=1).astype(np.float32)
            nodes, far = walk(points, edges, flat, entry, SEARCH_BEAM)
            for i, own in enumerate(part["vec_id"].to_numpy()):
                ranked = nodes[i][np.argsort(far[i], kind="stable")]
                members_of = [by_node[edge[x] : edge[x + 1]] for x in ranked[ranked >= 0][: 2 * k + 8]]
                near = np.concatenate(members_of)
                near = near[ids[near] != own]
                score = np.einsum("nd,d->n", vectors[near], q[i])
                top = np.lexsort((ids[near], -score))[:k]
                out.append(
                    pd.DataFrame(
                        {"query_id": own, "vec_id": ids[near[top]], "score": score[top]}
                    )
                )
        return pd.concat(out, ignore_index=True)

    lane = F.explode(F.sequence(F.lit(0), F.lit(lanes - 1)))
    members = graph.withColumn("lane", lane)
    asking = (
        good.where("asks")
        .select(
            "vec_id",
            "embedding",
            F.pmod(F.xxhash64("vec_id", F.lit(1)), F.lit(lanes)).cast("int").alias("lane"),
        )
        .withColumn("shard", F.explode(F.sequence(F.lit(0), F.lit(shards - 1))))
    )
    return (
        members.groupBy("shard", "lane")
        .cogroup(asking.groupBy("shard", "lane"))
        .applyInPandas(search, "query_id bigint, vec_id bigint, score double")
    )
