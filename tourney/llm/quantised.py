"""Near-duplicate embeddings by product quantisation.

A coarse quantiser sorts the vectors into inverted lists, and the residual of each vector is coded
by subspace. A query probes every list whose cell may hold a linked vector, takes the distances of
the coded vectors by matrix products, and compares exactly only where these allow a link.

Both tests are bounds: a list is skipped only if its cell lies farther than the linking distance, a
vector only if its approximate distance exceeds that by more than its own coding error. So no link
is lost, however the quantisers were fitted; the fit, on a bounded sample, decides the speed alone.
Vectors of two lists meet from one side only, and the link counts for both.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tourney.llm.graph import components, local_roots
from tourney.llm.scratch import cleaned, materialise
from tourney.llm.vectors import k_means, squared_distances, stacked, usable
from tourney.llm.tasks import shipped

# Bound of the sample that the quantisers are fitted on.
TRAINING_VECTORS = 10_000
LISTS_MOST = 1_024
VECTORS_PER_LIST = 200
SUBSPACES = 8
CODES = 256
ROUNDS = 8
# Members and queries that meet in one task.
MEMBERS = 8_192
QUERIES = 32_768
PAIRS_AT_ONCE = 1 << 21
SLACK = 1e-6
# Rounding of a single-precision product of two vectors of length one, for each component.
ROUNDING = 2e-7


@dataclass
class Quantiser:
    centres: np.ndarray
    codebooks: np.ndarray  # subspace, code, component

    def encode(self, units: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """List, codes and coding error of unit vectors."""
        lists = squared_distances(units, self.centres).argmin(axis=1)
        parts = self.split(units - self.centres[lists])
        codes = np.empty((len(units), len(self.codebooks)), np.uint8)
        error = np.zeros(len(units))
        for m, book in enumerate(self.codebooks):
            distance = squared_distances(parts[m], book)
            codes[:, m] = distance.argmin(axis=1)
            error += distance[np.arange(len(units)), codes[:, m]]
        return lists.astype(np.int32), codes, np.sqrt(error)

    def split(self, vectors: np.ndarray) -> list[np.ndarray]:
        return np.split(_padded(vectors, len(self.codebooks)), len(self.codebooks), axis=1)

    def probes(self, units: np.ndarray, lists: np.ndarray, reach: float) -> np.ndarray:
        """Which lists may hold a vector within ``reach``: distance to the edge of their cell."""
        distance = squared_distances(units, self.centres)
        own = distance[np.arange(len(units)), lists][:, None]
        apart = np.sqrt(squared_distances(self.centres, self.centres))[lists]
        return distance - own <= 2 * apart * reach + SLACK

    def asked(self, units: np.ndarray, lists: np.ndarray, reach: float) -> np.ndarray:
        """The lists of ``probes`` but those whose own vectors ask the list of this one."""
        own, other = lists[:, None], np.arange(len(self.centres))[None]
        ours = ((own + other) % 2 == 1) == (own < other)
        return self.probes(units, lists, reach) & (ours | (own == other))

    def decode(self, lists: np.ndarray, codes: np.ndarray) -> np.ndarray:
        """The vectors that lists and codes stand for."""
        coded = np.concatenate([b[codes[:, m]] for m, b in enumerate(self.codebooks)], axis=1)
        return self.centres[lists] + coded[:, : self.centres.shape[1]]


def _padded(vectors: np.ndarray, parts: int) -> np.ndarray:
    rest = -vectors.shape[1] % parts
    return np.pad(vectors, ((0, 0), (0, rest))) if rest else vectors


def fit(units: np.ndarray, total: int) -> Quantiser:
    lists = int(np.clip(total // VECTORS_PER_LIST, 1, min(LISTS_MOST, len(units))))
    centres = k_means(units, lists, ROUNDS, seed=1)
    nearest = squared_distances(units, centres).argmin(axis=1)
    residual = _padded(units - centres[nearest], SUBSPACES)
    books = [
        k_means(part, min(CODES, len(units)), ROUNDS, seed=2)
        for part in np.split(residual, SUBSPACES, axis=1)
    ]
    return Quantiser(centres, np.stack(books))


def _units(vectors: np.ndarray) -> np.ndarray:
    return vectors / np.sqrt((vectors * vectors).sum(axis=1))[:, None]


def _compare(
    quantiser: Quantiser, queries: pd.DataFrame, members: pd.DataFrame, cosine: float
) -> pd.DataFrame:
    """Links of a block of queries with a block of members: counts, and edges to local roots."""
    reach = np.sqrt(2 - 2 * cosine)
    q = np.stack(queries["vector"].to_numpy()).astype(np.float64)
    m = np.stack(members["vector"].to_numpy()).astype(np.float64)
    q_unit, m_unit = _units(q), _units(m)
    q_node, m_node = queries["node"].to_numpy(), members["node"].to_numpy()
    q_list, m_list = queries["list"].to_numpy(), members["list"].to_numpy()
    copies = members["copies"].to_numpy()
    codes = np.frombuffer(b"".join(members["codes"]), np.uint8).reshape(len(members), -1)
    coded = quantiser.decode(m_list, codes)
    limit = (reach + members["error"].to_numpy()) ** 2 + SLACK
    # Squared distance of a unit vector to the coded one within the limit, as a product of both.
    norm = (coded * coded).sum(axis=1)
    least = (1 + norm - limit) / 2 - ROUNDING * q.shape[1] * np.sqrt(np.maximum(norm, 1))
    coded, least, q_single = (x.astype(np.float32) for x in (coded, least - SLACK, q_unit))
    count, m_count = np.zeros(len(q), np.int64), np.zeros(len(m), np.int64)
    q_copies = queries["copies"].to_numpy()
    found_a, found_b = [], []
    probed = quantiser.asked(q_unit, q_list, reach)
    for which in np.unique(m_list).tolist():
        asking, own = np.flatnonzero(probed[:, which]), np.flatnonzero(m_list == which)
        step = max(1, PAIRS_AT_ONCE // len(own))
        for start in range(0, len(asking), step):
            some = asking[start : start + step]
            a, b = np.nonzero(q_single[some] @ coded[own].T >= least[own][None])
            a, b = some[a], own[b]
            for at in range(0, len(a), 1 << 16):
                x, y = a[at : at + (1 << 16)], b[at : at + (1 << 16)]
                exact = np.einsum("ij,ij->i", q_unit[x], m_unit[y])
                linked = (exact >= cosine) & (q_node[x] != m_node[y])
                x, y = x[linked], y[linked]
                np.add.at(count, x, copies[y])
                # A member of another list does not ask the query's list and learns of it here.
                silent = m_list[y] != q_list[x]
                np.add.at(m_count, y[silent], q_copies[x[silent]])
                found_a.append(q_node[x])
                found_b.append(m_node[y])
    a = np.concatenate(found_a) if found_a else np.empty(0, np.int64)
    b = np.concatenate(found_b) if found_b else np.empty(0, np.int64)
    nodes, roots = local_roots(a, b) if len(a) else (a, b)
    hit, heard = np.flatnonzero(count), np.flatnonzero(m_count)
    none = np.zeros(len(nodes), np.int64)
    return pd.DataFrame(
        {
            "node": np.concatenate((q_node[hit], m_node[heard], nodes)),
            "links": np.concatenate((count[hit], m_count[heard], none)),
            "root": np.concatenate((q_node[hit], m_node[heard], roots)),
        }
    )


@cleaned
def linked_vectors(rows: DataFrame, cosine: float = 0.95) -> DataFrame:
    """Per row of ``rows`` (``vec_id``, ``embedding``): ``n_links``, ``component_id``, ``kept``.

    Two vectors are linked if their cosine, in double precision, is at least ``cosine``. ``n_links``
    counts the other rows linked directly, ``component_id`` is the smallest id reachable by links,
    and ``kept`` marks the rows with that id. Null, empty and zero vectors and those with null or
    non-finite components link with nothing, others with those of their length. Equal vectors are
    compared once and counted as often as they occur. A row with a null id takes part in nothing and
    is kept. Each length has quantisers and jobs of its own, one after the other.
    """
    ids = rows.select(F.col("vec_id").cast("bigint").alias("vec_id"), "embedding")
    good = ids.where(usable("embedding") & F.col("vec_id").isNotNull())
    distinct = (
        good.groupBy("embedding")
        .agg(F.min("vec_id").alias("node"), F.count(F.lit(1)).alias("copies"))
    )
    distinct = materialise(distinct, "distinct-vectors")
    distinct = distinct.withColumn("size", F.size("embedding"))
    totals = distinct.groupBy("size").count().orderBy("size").collect()
    of_node = [
        _links_of(distinct.where(F.col("size") == size).drop("size"), total, cosine).withColumn(
            "size", F.lit(size)
        )
        for size, total in totals
    ]
    if not of_node:
        found = ids.withColumns({"n_links": F.lit(0).cast("bigint"), "component_id": "vec_id"})
    else:
        of_node = reduce(DataFrame.unionByName, of_node)
        of_vector = distinct.join(of_node, ["node", "size"], "left").select(
            "embedding",
            (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"),
            F.coalesce("root", "node").alias("component_id"),
        )
        found = ids.join(of_vector, "embedding", "left")
    known = F.col("vec_id").isNotNull()
    return found.select(
        "vec_id",
        F.when(known, F.coalesce("n_links", F.lit(0))).otherwise(0).cast("bigint").alias("n_links"),
        F.when(known, F.coalesce("component_id", "vec_id")).alias("component_id"),
    ).withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(True)))


def _links_of(distinct: DataFrame, total: int, cosine: float) -> DataFrame:
    sample = distinct.orderBy(F.xxhash64("embedding"), "node").limit(TRAINING_VECTORS).toPandas()
    points = np.stack(sample["embedding"].to_numpy()).astype(np.float64)
    quantiser = fit(_units(points), total)
    opened = shipped(distinct.sparkSession, quantiser)

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            lists, codes, error = opened().encode(_units(stacked(batch.column("embedding"))))
            packed = pa.array([c.tobytes() for c in codes], pa.binary())
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("node"),
                    batch.column("copies"),
                    pa.array(lists),
                    packed,
                    pa.array(error),
                    batch.column("embedding"),
                ],
                ["node", "copies", "list", "codes", "error", "vector"],
            )

    kind = distinct.schema["embedding"].dataType.simpleString()
    coded = distinct.mapInArrow(
        encode,
        f"node bigint, copies bigint, list int, codes binary, error double, vector {kind}",
    )
    coded = materialise(coded, "coded-vectors")

    # Lists are packed into blocks of members; one longer than a block is spread over several.
    sizes = {r["list"]: r["count"] for r in coded.groupBy("list").count().collect()}
    blocks, room, block_of = 0, 0, {}
    for which, size in sorted(sizes.items()):
        if size > room:
            blocks, room = blocks + 1, MEMBERS
        spread = -(-size // MEMBERS)
        block_of[which] = (blocks - 1, spread)
        blocks, room = (blocks + spread - 1, 0) if spread > 1 else (blocks, room - size)
    lanes = max(1, -(-total // QUERIES))

    entries = [F.lit(x) for which, place in block_of.items() for x in (which, F.struct(
        F.lit(place[0]).alias("first"), F.lit(place[1]).alias("spread")))]
    place = F.create_map(*entries)[F.col("list")]
    salt = F.pmod(F.xxhash64("node"), place["spread"]).cast("int")
    members = coded.withColumns(
        {
            "block": place["first"] + salt,
            "lane": F.explode(F.sequence(F.lit(0), F.lit(lanes - 1))),
            "asks": F.lit(False),
        }
    )

    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Which blocks of members each query goes to."""
        q, reach = opened(), np.sqrt(2 - 2 * cosine)
        for batch in batches:
            if not batch.num_rows:
                continue
            units = _units(stacked(batch.column("vector")))
            probed = q.asked(units, batch.column("list").to_numpy(), reach)
            wanted = []
            for row in probed:
                goes = set()
                for which in np.flatnonzero(row).tolist():
                    if which in block_of:
                        first, spread = block_of[which]
                        goes.update(range(first, first + spread))
                wanted.append(sorted(goes))
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(wanted, pa.list_(pa.int32()))],
                [*batch.schema.names, "blocks"],
            )

    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in coded.schema)
    queries = coded.mapInArrow(ask, f"{schema}, blocks array<int>")
    queries = queries.withColumns(
        {
            "block": F.explode("blocks"),
            "lane": F.pmod(F.xxhash64("node"), F.lit(lanes)).cast("int"),
            "asks": F.lit(True),
        }
    ).drop("blocks")

    def meet(group: pd.DataFrame) -> pd.DataFrame:
        asks = group["asks"].to_numpy()
        if asks.all() or not asks.any():
            return pd.DataFrame({"node": [], "links": [], "root": []}).astype("int64")
        return _compare(opened(), group[asks], group[~asks], cosine)

    found = members.unionByName(queries).groupBy("block", "lane").applyInPandas(
        meet, "node bigint, links bigint, root bigint"
    )
    found = materialise(found, "vector-links")
    roots = components(found.where("node != root"), "node", "root").withColumnRenamed(
        "node", "_node"
    )
    counts = found.groupBy("node").agg(F.sum("links").alias("links"))
    return counts.join(roots, F.col("node") == F.col("_node"), "left").select(
        "node", "links", F.coalesce("root", "node").alias("root")
    )
