"""Near-duplicate documents by b-bit MinHash.

Every text becomes its set of word shingles and the minima of the set under many hash functions.
Bands of minima pick candidates; the low bits of the minima, packed into words, estimate the
similarity of a candidate pair by counting equal digits, corrected for those equal by chance; the
full sets decide.

Texts with equal sets are one node. Within a bucket of candidates not everybody meets everybody: all
members meet one hub first, and what it links is one component already. Only members that are
still apart meet the others, in blocks whose full sets meet in one task, so a large group of near copies
costs its size times those that are no copies of its hub, pairs are never rows of a table, and no pair
that a bucket suggests is left out that could join two components.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tourney.llm.graph import components
from tourney.llm.scratch import cleaned, materialise
from tourney.llm.shingles import shingle_sets, sliced, slices
from tourney.llm.tasks import giving_back

# 32 bands of 5: a pair of similarity 0.8 is missed by all of them once in 300,000 times.
BANDS, ROWS = 32, 5
HASHES = BANDS * ROWS
BITS = 4
PER_WORD = 64 // BITS
WORDS_PER_SIGNATURE = HASHES // PER_WORD
# Estimates this far below the threshold (six standard deviations) rule a pair out.
MARGIN = 0.2
# Nodes of one group that meet in a task, on either side.
BLOCK = 512

_RANDOM = np.random.default_rng(7)
_FACTOR = _RANDOM.integers(1, 1 << 63, HASHES, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_SHIFT = _RANDOM.integers(0, 1 << 63, HASHES, dtype=np.uint64)
_BAND = _RANDOM.integers(1, 1 << 63, (BANDS, ROWS), dtype=np.uint64) | np.uint64(1)

_SIGNATURES = (
    "doc_id bigint, n_shingles bigint, set_id binary, digits array<bigint>, bands array<bigint>"
)


def minima(sets: list[np.ndarray]) -> np.ndarray:
    """One row of minima per set; sets are not empty."""
    joined = np.concatenate(sets)
    first = np.concatenate(([0], np.cumsum([len(s) for s in sets])[:-1]))
    out = np.empty((len(sets), HASHES), dtype=np.uint64)
    for k in range(HASHES):
        out[:, k] = np.minimum.reduceat(joined * _FACTOR[k] + _SHIFT[k], first)
    return out


def pack(lowest: np.ndarray) -> np.ndarray:
    """Low ``BITS`` bits of all minima, ``PER_WORD`` digits to a 64-bit word."""
    digits = (lowest & np.uint64((1 << BITS) - 1)).reshape(-1, WORDS_PER_SIGNATURE, PER_WORD)
    places = (np.arange(PER_WORD, dtype=np.uint64) * np.uint64(BITS))[None, None, :]
    return np.bitwise_or.reduce(digits << places, axis=2).view(np.int64)


def band_keys(lowest: np.ndarray) -> np.ndarray:
    rows = lowest.reshape(-1, BANDS, ROWS)
    key = (rows * _BAND[None]).sum(axis=2, dtype=np.uint64)
    key = (key ^ (key >> np.uint64(29))) * np.uint64(0x9E3779B97F4A7C15)
    return (key + np.arange(BANDS, dtype=np.uint64)[None]).view(np.int64)


def signatures(docs: DataFrame, words: int) -> DataFrame:
    """Per row: size and digest of its shingle set, packed digits and band keys (null if empty)."""

    @giving_back
    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sliced(batches):
            texts = batch.column("text").to_pylist()
            for part in slices([len(t or "") for t in texts]):
                sets = list(shingle_sets(texts[part], words))
                full = [i for i, s in enumerate(sets) if len(s)]
                digits, bands = [None] * len(sets), [None] * len(sets)
                if full:
                    lowest = minima([sets[i] for i in full])
                    for i, d, b in zip(full, pack(lowest), band_keys(lowest), strict=True):
                        digits[i], bands[i] = d, b
                ids = [_set_digest(s.tobytes()) for s in sets]
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("doc_id").slice(part.start, part.stop - part.start),
                        pa.array([len(s) for s in sets], pa.int64()),
                        pa.array(ids, pa.binary()),
                        pa.array(digits, pa.list_(pa.int64())),
                        pa.array(bands, pa.list_(pa.int64())),
                    ],
                    ["doc_id", "n_shingles", "set_id", "digits", "bands"],
                )

    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")
    return rows.mapInArrow(sign, _SIGNATURES)


def estimated_similarity(a: Column, b: Column) -> Column:
    """Share of equal digits, without those that ``BITS`` random bits have in common."""
    ones = F.lit(int("0x1111111111111111", 16))
    different = F.lit(0)
    for i in range(WORDS_PER_SIGNATURE):
        x = F.element_at(a, i + 1).bitwiseXOR(F.element_at(b, i + 1))
        any_bit = x
        for shift in range(1, BITS):
            any_bit = any_bit.bitwiseOR(F.shiftrightunsigned(x, shift))
        different = different + F.bit_count(any_bit.bitwiseAND(ones))
    chance = 1 / (1 << BITS)
    return (1 - different / HASHES - chance) / (1 - chance)


def _set_digest(packed: bytes) -> bytes:
    return hashlib.blake2b(packed, digest_size=16).digest()


def _sets_of(docs: DataFrame, nodes: DataFrame, words: int) -> DataFrame:
    """``node`` and its packed shingle hashes, read from the document ``first_doc`` of the node.

    Other texts under the id of that document have other nodes.
    """

    @giving_back
    def pick(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sliced(batches):
            texts = batch.column("text").to_pylist()
            for part in slices([len(t or "") for t in texts]):
                sets = [s.tobytes() for s in shingle_sets(texts[part], words)]
                ids = [_set_digest(s) for s in sets]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(ids, pa.binary()), pa.array(sets, pa.binary())], ["set_id", "hashes"]
                )

    rows = docs.select(F.col("doc_id").cast("bigint").alias("first_doc"), "text")
    rows = rows.join(nodes.select("first_doc"), "first_doc", "left_semi")
    sets = rows.mapInArrow(pick, "set_id binary, hashes binary")
    return sets.join(nodes.select("set_id", "node"), "set_id").select("node", "hashes")


def _confirm(pairs: DataFrame, reps: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (node, hub) whose full sets are similar enough."""
    digits = reps.select("node", "digits")
    near = (
        pairs.join(digits, "node")
        .join(digits.select(F.col("node").alias("hub"), F.col("digits").alias("hub_digits")), "hub")
        .where(
            estimated_similarity(F.col("digits"), F.col("hub_digits")) >= percent / 100 - MARGIN
        )
        .select("node", "hub")
    )
    near = materialise(near.distinct(), "near-pairs")
    both = near.join(sets, "node").join(
        sets.select(F.col("node").alias("hub"), F.col("hashes").alias("hub_hashes")), "hub"
    )

    @giving_back
    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            kept = []
            columns = (batch.column("hashes"), batch.column("hub_hashes"))
            for a, b in zip(*columns, strict=True):
                a = np.frombuffer(a.as_buffer(), dtype=np.uint64)
                b = np.frombuffer(b.as_buffer(), dtype=np.uint64)
                # Both are sorted and distinct, so each common hash stands twice in a row.
                merged = np.sort(np.concatenate((a, b)))
                common = int((merged[1:] == merged[:-1]).sum())
                kept.append(100 * common >= percent * (len(a) + len(b) - common))
            yield batch.select(["node", "hub"]).filter(pa.array(kept, pa.bool_()))

    return both.mapInArrow(compare, "node bigint, hub bigint")


def similar_roots(docs: DataFrame, reps: DataFrame, words: int, percent: int) -> DataFrame:
    """``node`` and ``root`` of its component for every node with a confirmed link.

    A node stands for one shingle set, under a number of its own.

    First every member of a bucket meets the bucket's hub, its smallest node. Then members that are
    still apart from the rest meet the members that have the same chief, the smallest of all hubs a
    node has met; copies of one text mostly share one. Last, members that are still apart from their hub
    meet all others of their bucket.
    """
    exploded = reps.select("node", F.explode("bands").alias("bucket"))
    hubs = exploded.groupBy("bucket").agg(
        F.min("node").alias("hub"), F.max("node").alias("largest")
    )
    hubs = hubs.where("hub != largest").select("bucket", "hub")
    members = materialise(exploded.join(hubs, "bucket"), "buckets")
    chiefs = materialise(members.groupBy("node").agg(F.min("hub").alias("chief")), "chiefs")
    named = chiefs.select("node").join(reps.select("node", "first_doc", "set_id"), "node")
    sets = materialise(_sets_of(docs, named, words).dropDuplicates(["node"]), "sets")
    pairs = members.where("node != hub").select("node", "hub").distinct()
    found = materialise(_confirm(pairs, reps, sets, percent), "links")

    roots = materialise(components(found, "node", "hub"), "roots")
    by_chief = _rooted(_rooted(chiefs, roots), roots, "chief", "hub_root")
    by_chief = by_chief.select(F.col("chief").alias("group"), "node", "root", "hub_root")
    more = _linked_in_groups(by_chief, sets, percent)
    roots = _joined(roots, materialise(more, "links"))

    members = members.join(chiefs, "node").where("node != hub")
    by_bucket = _rooted(_rooted(members, roots), roots, "hub", "hub_root")
    by_bucket = materialise(by_bucket.drop("hub"), "members")
    mixed = by_bucket.groupBy("bucket").agg(
        F.min("root").alias("low"),
        F.max("root").alias("high"),
        F.min("chief").alias("first"),
        F.max("chief").alias("last"),
    )
    mixed = mixed.where("low != high AND first != last").select("bucket")
    mixed = materialise(mixed, "mixed-buckets")
    by_bucket = by_bucket.join(mixed, "bucket")
    by_bucket = by_bucket.select(F.col("bucket").alias("group"), "node", "root", "hub_root")
    more = _linked_in_groups(by_bucket, sets, percent)
    return _joined(roots, materialise(more, "links"))


def _joined(roots: DataFrame, more: DataFrame) -> DataFrame:
    """The roots once ``more`` links are added to the components they stand for."""
    if more.isEmpty():
        return roots
    known = roots.select("node", F.col("root").alias("hub"))
    return materialise(components(known.unionByName(more), "node", "hub"), "roots")


def _rooted(nodes: DataFrame, roots: DataFrame, node: str = "node", root: str = "root") -> DataFrame:
    known = roots.select(F.col("node").alias("_node"), F.col("root").alias("_root"))
    joined = nodes.join(known, F.col(node) == F.col("_node"), "left")
    return joined.withColumn(root, F.coalesce("_root", node)).drop("_node", "_root")


def _linked_in_groups(nodes: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Links that join nodes of a group, of which at least one is apart from the group's hub.

    ``nodes`` has ``group``, ``node``, the ``root`` of its component and that of its hub, ``hub_root``.
    A group is compared in blocks of at most ``BLOCK`` by ``BLOCK`` nodes, whose full sets meet in
    one task; what comes back is a forest of each block's links, never its pairs.
    """
    nodes = nodes.withColumn("apart", F.col("root") != F.col("hub_root"))
    sizes = nodes.groupBy(F.col("group").alias("_group")).agg(
        F.ceil(F.count(F.lit(1)) / BLOCK).cast("int").alias("all_blocks"),
        F.ceil(F.count_if("apart") / BLOCK).cast("int").alias("apart_blocks"),
    )
    # Stored, so that the join with a hot group can be split.
    sizes = materialise(sizes.where("apart_blocks > 0"), "group-sizes")
    known = materialise(
        nodes.join(sizes, F.col("group") == F.col("_group")).join(sets, "node"), "groups"
    )
    salt = F.xxhash64("node")
    every = {
        b: F.explode(F.sequence(F.lit(0), F.col(f"{b}_blocks") - 1)) for b in ("all", "apart")
    }
    own = {b: F.pmod(salt, F.col(f"{b}_blocks")).cast("int") for b in ("all", "apart")}
    columns = ("group", "node", "root", "hashes")
    asked = known.withColumn("of", own["all"]).withColumn("by", every["apart"])
    asking = known.where("apart").withColumn("by", own["apart"]).withColumn("of", every["all"])
    rows = asked.select(*columns, "of", "by", F.lit(False).alias("asks")).unionByName(
        asking.select(*columns, "of", "by", F.lit(True).alias("asks"))
    )

    @giving_back
    def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block, name = [], None
        for batch in sliced(batches):
            for row in batch.to_pylist():
                key = (row["group"], row["of"], row["by"])
                if key != name and block:
                    yield _block_links(block, percent)
                    block = []
                name = key
                block.append(row)
        if block:
            yield _block_links(block, percent)

    keys = ("group", "of", "by")
    return (
        rows.repartition(*keys)
        .sortWithinPartitions(*keys)
        .mapInArrow(meet, "node bigint, hub bigint")
    )


def _block_links(block: list[dict], percent: int) -> pa.RecordBatch:
    """A forest of the links between the asking and the asked nodes of a block."""
    asked = [r for r in block if not r["asks"]]
    sets = [np.frombuffer(r["hashes"], np.uint64) for r in asked]
    a: list[int] = []
    b: list[int] = []
    if asked:
        vocabulary, places = np.unique(np.concatenate(sets), return_inverse=True)
        size = np.array([len(s) for s in sets])
        first = np.concatenate(([0], np.cumsum(size)[:-1]))
        nodes = np.array([r["node"] for r in asked])
        roots = np.array([r["root"] for r in asked])
        for row in block:
            if row["asks"]:
                own = np.frombuffer(row["hashes"], np.uint64)
                at = np.minimum(np.searchsorted(vocabulary, own), len(vocabulary) - 1)
                marks = np.zeros(len(vocabulary), np.int32)
                marks[at[vocabulary[at] == own]] = 1
                common = np.add.reduceat(marks[places], first)
                linked = 100 * common >= percent * (len(own) + size - common)
                # One link to each component that is not its own joins them all.
                other = np.flatnonzero(linked & (roots != row["root"]))
                _, one = np.unique(roots[other], return_index=True)
                b += nodes[other[one]].tolist()
                a += [row["node"]] * len(one)
    found, roots = np.array(a, np.int64), np.array(b, np.int64)
    return pa.RecordBatch.from_arrays([pa.array(found), pa.array(roots)], ["node", "hub"])


@cleaned
def near_duplicates(docs: DataFrame, words: int = 5, percent: int = 80) -> DataFrame:
    """Per row of ``docs`` (``doc_id``, ``text``): ``doc_id``, ``n_shingles``, ``component_id`` and
    ``kept``.

    Two texts are linked if ``100 * |A & B| >= percent * |A | B|`` for their shingle sets. Words are
    runs of non-space with A-Z in lower case; a text of fewer words is one shingle, and a null,
    empty or blank text has none, is linked with nothing and is its own component.
    ``component_id`` is the smallest id of the component, and ``kept`` marks the rows with that id,
    so repeated rows are kept or dropped together. Rows that share an id are judged by their own
    texts. A null id stands for no document: its row is kept, with a null component.
    """
    signed = materialise(signatures(docs, words), "signatures")
    known = signed.where("n_shingles > 0 AND doc_id IS NOT NULL")
    reps = known.groupBy("set_id").agg(
        F.min("doc_id").alias("first_doc"),
        F.first("digits").alias("digits"),
        F.first("bands").alias("bands"),
    )
    # Numbers that no two sets share; they stay once stored.
    reps = reps.withColumn("node", F.monotonically_increasing_id())
    reps = materialise(reps, "representatives")
    roots = similar_roots(docs, reps, words, percent)
    linked = reps.select("node", "first_doc").join(roots, "node")
    first = linked.groupBy("root").agg(F.min("first_doc").alias("first_of_root"))
    of_set = reps.select("set_id", "node", "first_doc").join(roots, "node", "left")
    of_set = of_set.join(first, "root", "left")
    of_set = of_set.select("set_id", F.coalesce("first_of_root", "first_doc").alias("component"))
    rows = signed.select("doc_id", "n_shingles", "set_id")
    joined = rows.join(of_set, "set_id", "left")
    component = F.when((F.col("n_shingles") > 0) & F.col("doc_id").isNotNull(), F.col("component"))
    return joined.select(
        "doc_id",
        "n_shingles",
        F.coalesce(component, "doc_id").alias("component_id"),
        F.coalesce(F.coalesce(component, "doc_id") == F.col("doc_id"), F.lit(True)).alias("kept"),
    )


def without_near_duplicates(docs: DataFrame, words: int = 5, percent: int = 80) -> DataFrame:
    """The rows of ``docs`` whose id is kept, one document of each group, columns unchanged.

    Rows that share an id stay or go together; they stay if one of them is kept.
    """
    judged = near_duplicates(docs, words, percent)
    by_id = judged.groupBy(F.col("doc_id").alias("_dropped")).agg(F.bool_or("kept").alias("_kept"))
    dropped = materialise(by_id.where("NOT _kept").select("_dropped"), "dropped-documents")
    return docs.join(dropped, F.col("doc_id") == F.col("_dropped"), "left_anti")
