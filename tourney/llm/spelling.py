"""Groups spelling variants: words that differ by one code point, found by a relational trie frontier.

The vocabulary becomes two tries, of the words read forwards and of their ends read backwards, as one
distributed table of nodes with their edges. A search state is (word, place, node, edits). All states
move down by one code point a level, by joining the table on the node: an unedited state follows its
own word, or spends its edit on replacing or skipping a code point; an edited state only follows. What
has spent its edit and arrives where a word has the same rest becomes a pair of neighbours.

Near the root of a trie almost every edge exists, so a search that starts there carries every word to
every branch. It starts deeper: an edit stands either behind the first ``STEPS`` code points, which
are then a node of the forward trie, or among them, and then all the rest is a node of the backward
trie. Words are cut into pieces of ``STEPS`` code points, each searched for edits of its own, from the
node of all before it to a node that has the same rest behind it. So a word of any length takes
``STEPS`` levels. Edges carry the code point that follows them, and a state only takes edges that
agree with what it needs next.

Nodes are numbered by 64-bit hashes. Two nodes under one number only add candidates; every pair is
compared as text at the end. Replacing by smaller code points and inserting are the same pairs seen
from the other word, so they are mirrored instead of searched.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Callable, Iterator
from operator import itemgetter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tourney.llm.scratch import cleaned, materialise
from tourney.llm.shingles import mix, powers, sliced, slices
from tourney.llm.tasks import giving_back

# Code points of a piece, and so levels of the search.
STEPS = 4
# Distinct words that a task counts before it passes them on.
HELD_WORDS = 200_000

_BASE = 0x9E3779B97F4A7C15
_BACK = pow(_BASE, -1, 1 << 64)
# Added to hashes of beginnings, of ends as nodes, and of ends as rests.
_FORWARD, _BACKWARD, _REST = (np.uint64(n) for n in (0x51ED270B, 0x2545F491, 0x6C62272E))

Rewrite = Callable[[int | None, str], str]

_LETTERS = "A-Za-zÀ-ÿ"
_LOWER = {upper: upper + 32 for upper in range(ord("A"), ord("Z") + 1)}


def word_counts(
    docs: DataFrame,
    least_length: int = 7,
    least_count: int = 2,
    rewrite: Rewrite | None = None,
) -> DataFrame:
    """``word`` and ``n``: the words of whole texts that are long and frequent enough.

    A word is a maximal run of Latin letters with A-Z in lower case. ``rewrite`` may change the words
    of a document, by at most one code point of length. Tasks count before they pass words on, so a
    frequent word is a few rows.
    """
    shortest = least_length if rewrite is None else max(1, least_length - 1)
    runs = re.compile(f"[{_LETTERS}]{{{shortest},}}")

    @giving_back
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: Counter[str] = Counter()

        def counted() -> pa.RecordBatch:
            kept = [(word, n) for word, n in held.items() if len(word) >= least_length]
            words, numbers = zip(*kept, strict=True) if kept else ((), ())
            return pa.RecordBatch.from_arrays(
                [pa.array(words, pa.string()), pa.array(numbers, pa.int64())], ["word", "n"]
            )

        for batch in sliced(batches):
            keys = batch.column("doc_id").to_pylist()
            for key, text in zip(keys, batch.column("text"), strict=True):
                own = Counter(map(itemgetter(0), runs.finditer(text.as_py() or "")))
                for run, n in own.items():
                    word = run.translate(_LOWER)
                    held[word if rewrite is None else rewrite(key, word)] += n
                if len(held) >= HELD_WORDS:
                    yield counted()
                    held.clear()
        yield counted()

    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")
    return (
        rows.mapInArrow(count, "word string, n bigint")
        .groupBy("word")
        .agg(F.sum("n").alias("n"))
        .where(F.col("n") >= least_count)
    )


class _Words:
    """Code points of many words in one row, and hashes of their beginnings and ends."""

    def __init__(self, ids: list[int], words: list[str]) -> None:
        text = "".join(words).encode("utf-32-le", "surrogatepass")
        self.points = np.frombuffer(text, dtype=np.uint32).astype(np.int32)
        self.length = np.fromiter(map(len, words), np.int64, len(words))
        self.end = np.cumsum(self.length)
        self.start = self.end - self.length
        self.ids = np.array(ids, dtype=np.int64)
        n = len(self.points)
        self.owner = np.repeat(np.arange(len(words)), self.length)
        self.place = np.arange(n) - self.start[self.owner]
        self._sums = np.zeros(n + 1, dtype=np.uint64)
        values = (self.points + 1).astype(np.uint64)
        np.cumsum(values * powers(_BASE, n), out=self._sums[1:])
        self._scale = powers(_BACK, n + 1)

    def _hash(self, since: np.ndarray, upto: np.ndarray, kind: np.uint64) -> np.ndarray:
        value = (self._sums[upto] - self._sums[since]) * self._scale[since]
        return mix(value + kind).view(np.int64)

    def beginning(self, at: np.ndarray, owner: np.ndarray) -> np.ndarray:
        """Forward nodes: the words of ``owner`` up to ``at``."""
        return self._hash(self.start[owner], at, _FORWARD)

    def ending(self, at: np.ndarray, owner: np.ndarray) -> np.ndarray:
        """Backward nodes: the words of ``owner`` from ``at`` on."""
        return self._hash(at, self.end[owner], _BACKWARD)

    def rest(self, at: np.ndarray, owner: np.ndarray) -> np.ndarray:
        return self._hash(at, self.end[owner], _REST)

    def point(self, at: np.ndarray, there: np.ndarray) -> np.ndarray:
        """Code points plus one, 0 where there is none."""
        inside = np.clip(at, 0, max(len(self.points) - 1, 0))
        return np.where(there, self.points[inside] + 1, 0).astype(np.int32)


def _edges(words: _Words) -> dict[str, np.ndarray]:
    """(node, point, child, following) of both tries."""
    at, owner = np.arange(len(words.points)), words.owner
    later, early = words.place >= STEPS, words.place < STEPS
    f, b = at[later], at[early]
    fo, bo = owner[later], owner[early]
    columns = {
        "node": (words.beginning(f, fo), words.ending(b + 1, bo)),
        "point": (words.points[f] + 1, words.points[b] + 1),
        "child": (words.beginning(f + 1, fo), words.ending(b, bo)),
        "following": (
            words.point(f + 1, f + 1 < words.end[fo]),
            words.point(b - 1, b > words.start[bo]),
        ),
    }
    joined = {name: np.concatenate(parts) for name, parts in columns.items()}
    child, following = joined["child"], joined["following"]
    order = np.lexsort((following, child))
    child, following = child[order], following[order]
    new = np.ones(len(order), dtype=bool)
    new[1:] = (child[1:] != child[:-1]) | (following[1:] != following[:-1])
    return {name: column[order[new]] for name, column in joined.items()}


def _rests(words: _Words) -> dict[str, np.ndarray]:
    """(node, rest, near_id): where a piece may end, and what of the word comes behind it."""
    at, place = np.arange(len(words.points)), words.place
    inner = (place >= 2 * STEPS - 1) & ((place % STEPS == 0) | (place % STEPS == STEPS - 1))
    every = np.arange(len(words.ids))
    nodes = (
        words.beginning(at[inner], words.owner[inner]),
        words.beginning(words.end, every),
        words.ending(words.start, every),
    )
    rests = (
        words.rest(at[inner], words.owner[inner]),
        words.rest(words.end, every),
        words.rest(words.end, every),
    )
    ids = (words.ids[words.owner[inner]], words.ids, words.ids)
    return {
        "node": np.concatenate(nodes),
        "rest": np.concatenate(rests),
        "near_id": np.concatenate(ids),
    }


def _first_states(words: _Words) -> dict[str, np.ndarray]:
    """One state per piece: its node, its code points and the one behind, and the rest behind it."""
    at = np.arange(len(words.points))
    starts = (words.place >= STEPS) & (words.place % STEPS == 0)
    f, fo = at[starts], words.owner[starts]
    ends = np.minimum(f + STEPS, words.end[fo])
    every = np.arange(len(words.ids))
    span = np.minimum(words.length, STEPS)
    head = words.start + span
    state = {
        "word_id": np.concatenate((words.ids[fo], words.ids)),
        "node": np.concatenate((words.beginning(f, fo), words.ending(head, every))),
        "rest": np.concatenate((words.rest(ends, fo), words.rest(words.end, every))),
        "span": np.concatenate((ends - f, span)).astype(np.int32),
    }
    for k in range(STEPS + 1):
        ahead = words.point(f + k, f + k < words.end[fo])
        behind = words.point(head - 1 - k, k < span)
        state[f"p{k}"] = np.concatenate((ahead, behind))
    return state


_TABLES = {
    "edges": (_edges, "node bigint, point int, child bigint, following int"),
    "rests": (_rests, "node bigint, rest bigint, near_id bigint"),
    "states": (
        _first_states,
        "word_id bigint, node bigint, rest bigint, span int, "
        + ", ".join(f"p{k} int" for k in range(STEPS + 1)),
    ),
}


def _table(words: DataFrame, name: str) -> DataFrame:
    make, schema = _TABLES[name]

    @giving_back
    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, texts = (batch.column(c).to_pylist() for c in ("word_id", "word"))
            for part in slices([len(t) for t in texts], 1 << 18):
                columns = make(_Words(ids[part], texts[part]))
                yield pa.RecordBatch.from_pydict(columns)

    return words.select("word_id", "word").mapInArrow(build, schema)


def _step(states: DataFrame, edges: DataFrame, level: int) -> DataFrame:
    """All states after their next code point, ``p<level>``."""
    here, ahead = F.col(f"p{level}"), F.col(f"p{level + 1}")
    joined = states.join(edges, "node")
    moved = F.transform(
        F.filter(
            "edges",
            lambda e: (e.following == ahead)
            & ((e.point == here) | (~F.col("edited") & (e.point > here))),
        ),
        lambda e: F.struct(
            e.child.alias("to"), (F.col("edited") | (e.point != here)).alias("spent")
        ),
    )
    # Without the code point itself: the node stays, if it can go on from there.
    can_go_on = (ahead == 0) | F.exists("edges", lambda e: e.point == ahead)
    skipped = F.array(F.struct(F.col("node").alias("to"), F.lit(True).alias("spent")))
    options = F.when(~F.col("edited") & can_go_on, F.concat(moved, skipped)).otherwise(moved)
    return joined.select(
        "word_id",
        "rest",
        "span",
        *[f"p{k}" for k in range(level + 1, STEPS + 1)],
        F.inline(options),
    ).withColumnsRenamed({"to": "node", "spent": "edited"})


def near_words(words: DataFrame) -> DataFrame:
    """(word_id, near_id) of all words (word_id, word) that differ by one code point, both ways.

    ``words`` is a stored table of distinct words.
    """
    edges = _table(words, "edges").groupBy("node")
    edges = edges.agg(F.collect_set(F.struct("point", "child", "following")).alias("edges"))
    edges = materialise(edges, "trie")
    states = _table(words, "states").withColumn("edited", F.lit(False))
    arrived = []
    for level in range(STEPS):
        states = materialise(_step(states, edges, level), f"frontier-{level}")
        ended = states.where(F.col("edited") & (F.col("span") == level + 1))
        arrived.append(ended.select("word_id", "node", "rest"))
        states = states.where(F.col("span") > level + 1)
    at_end = arrived[0]
    for more in arrived[1:]:
        at_end = at_end.unionByName(more)
    found = at_end.join(_table(words, "rests"), ["node", "rest"])
    found = found.where(F.col("word_id") != F.col("near_id")).select("word_id", "near_id")
    mirrored = F.array(
        F.struct("word_id", "near_id"),
        F.struct(F.col("near_id").alias("word_id"), F.col("word_id").alias("near_id")),
    )
    return found.select(F.inline(mirrored)).distinct()


def _roots(forms: DataFrame) -> DataFrame:
    """(word, root) of the words that have a form, by following forms, twice as far each round.

    A form is several times as frequent as its word, so no chain is longer than the digits of the
    largest count.
    """
    steps = materialise(forms.select("word", F.col("form").alias("root")), "roots")
    while True:
        ahead = steps.select(F.col("word").alias("root"), F.col("root").alias("next"))
        if steps.join(ahead, "root", "left_semi").isEmpty():
            return steps
        steps = steps.join(ahead, "root", "left").select(
            "word", F.coalesce("next", "root").alias("root")
        )
        steps = materialise(steps, "roots")


@cleaned
def spelling_variants(counts: DataFrame, ratio: int = 10) -> DataFrame:
    """Per row of ``counts`` (distinct words with their n) its form and the root of its group.

    A word's form is the most frequent word that differs from it by one code point, the first in
    code-point order among equals, if it is at least ``ratio`` (2 or more) times as frequent as the
    word; else null. ``root`` is the last word when forms are followed, the word itself if it has
    none. ``n_near`` counts the words that differ by one code point. Null and empty words are left
    out, and so are further columns. An empty table gives an empty one.
    """
    words = counts.where("word != ''").select(
        F.monotonically_increasing_id().alias("word_id"), "word", F.col("n").cast("bigint")
    )
    words = materialise(words, "vocabulary")
    near = words.select(
        F.col("word_id").alias("near_id"),
        F.col("word").alias("near"),
        F.col("n").alias("near_n"),
    )
    pairs = near_words(words).join(near, "near_id").join(words, "word_id")
    pairs = pairs.where(F.levenshtein("word", "near", 1) == 1)
    best = pairs.groupBy("word_id").agg(
        F.count(F.lit(1)).alias("n_near"),
        F.min(F.struct((-F.col("near_n")).alias("order"), "near")).alias("best"),
    )
    best_n = -F.col("best.order")
    found = words.join(best, "word_id", "left").select(
        "word",
        "n",
        F.coalesce("n_near", F.lit(0)).cast("bigint").alias("n_near"),
        F.when(best_n >= ratio * F.col("n"), F.col("best.near")).alias("form"),
        F.when(best_n >= ratio * F.col("n"), best_n).alias("form_n"),
    )
    found = materialise(found, "forms")
    roots = _roots(found.where("form IS NOT NULL"))
    return found.join(roots, "word", "left").select(
        "word",
        "form",
        F.coalesce("root", "word").alias("root"),
        "n",
        "n_near",
        "form_n",
    )


def misspelled(doc_id: int | None, word: str) -> str:
    """The word with one code point deleted in about every 31st case, chosen by document and word.

    A missing id counts as empty text.
    """
    hashed = zlib.crc32(f"{'' if doc_id is None else doc_id}:{word}".encode())
    if hashed % 31:
        return word
    gone = hashed % len(word)
    return word[:gone] + word[gone + 1 :]
