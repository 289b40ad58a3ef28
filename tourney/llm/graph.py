"""Connected components of links too many for one machine."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tourney.llm.scratch import materialise

# Links that a task folds at a time.
HELD = 1 << 20


def local_roots(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Every node of the links with the smallest one it reaches through them."""
    nodes, places = np.unique(np.concatenate((a, b)), return_inverse=True)
    a, b = places[: len(a)], places[len(a) :]
    root = np.arange(len(nodes))
    while True:
        before = root.copy()
        low = np.minimum(root[a], root[b])
        np.minimum.at(root, a, low)
        np.minimum.at(root, b, low)
        root = root[root]
        if (root == before).all():
            return nodes, nodes[root]


def _local_forests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The links of a task, ``HELD`` at a time, as links to the smallest node reached by them."""
    held: list[pa.RecordBatch] = []
    room = HELD

    def forest() -> pa.RecordBatch:
        table = pa.Table.from_batches(held)
        nodes, roots = local_roots(table.column("u").to_numpy(), table.column("v").to_numpy())
        below = nodes != roots
        return pa.RecordBatch.from_arrays(
            [pa.array(nodes[below]), pa.array(roots[below])], ["u", "v"]
        )

    for batch in batches:
        held.append(batch)
        room -= batch.num_rows
        if room <= 0:
            yield forest()
            held, room = [], HELD
    if held:
        yield forest()


def _are_stars(edges: DataFrame) -> bool:
    """Whether every node hangs on one root, and no root hangs on anything."""
    nothing = F.lit(None).cast("bigint")
    ends = edges.select(F.col("u").alias("node"), F.col("v").alias("over")).unionByName(
        edges.select(F.col("v").alias("node"), nothing.alias("over"))
    )
    held = ends.groupBy("node").agg(
        F.min("over").alias("low"),
        F.max("over").alias("high"),
        F.max(F.col("over").isNull()).alias("holds"),
    )
    return held.where("low IS NOT NULL AND (low != high OR holds)").isEmpty()


def components(links: DataFrame, a: str, b: str) -> DataFrame:
    """``node`` and ``root``, the smallest node it reaches, for every node of a link.

    Each task first folds its own links to forests. Then alternating stars: every node hangs its
    larger neighbours on the smallest one it knows, then its smaller ones, until all are stars. Both
    steps take minima that combine before the shuffle and one join, so a node with very many links
    is never gathered in one place. Each round is stored, which also cuts the lineage. Null ends of
    links and loops are ignored.
    """
    edges = links.select(
        F.greatest(a, b).alias("u"), F.least(F.col(a), F.col(b)).alias("v")
    ).where(F.col(a).isNotNull() & F.col(b).isNotNull() & (F.col(a) != F.col(b)))
    edges = materialise(edges.mapInArrow(_local_forests, "u bigint, v bigint"), "links")
    while not _are_stars(edges):
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy(F.col("u").alias("n")).agg(F.min("v").alias("m"))
        least = least.select("n", F.least("n", "m").alias("m"))
        hung = (
            both.where("v > u")
            .join(least, F.col("u") == F.col("n"))
            .select(F.col("v").alias("u"), F.col("m").alias("v"))
        )
        hung = hung.where("u != v").mapInArrow(_local_forests, "u bigint, v bigint")
        hung = materialise(hung, "large-stars")
        least = hung.groupBy(F.col("u").alias("n")).agg(F.min("v").alias("m"))
        rest = hung.join(least, F.col("u") == F.col("n")).where("v != m")
        small = rest.select(F.greatest("v", "m").alias("u"), F.least("v", "m").alias("v"))
        own = least.select(F.col("n").alias("u"), F.col("m").alias("v"))
        edges = small.unionByName(own).mapInArrow(_local_forests, "u bigint, v bigint")
        edges = materialise(edges, "small-stars")
    hanging = edges.select(F.col("u").alias("node"), F.col("v").alias("root"))
    roots = edges.select(F.col("v").alias("node"), F.col("v").alias("root"))
    return hanging.unionByName(roots).distinct()
