"""Runs of words that repeat with a period, found by recursive frequency splitting.

A run is a stretch of consecutive words with smallest period ``q`` and a length of at least
``max(LEAST_WORDS, 2 * q)`` that no neighbouring word extends. Each of its words therefore stands in
it at least twice. So a word that occurs only once within a segment is in no run there and splits the
segment; the parts are counted anew, until nothing splits any more or a part is too short. Ordinary
text falls apart within a few passes. What survives is scanned lag by lag: a run of period ``q`` has
at least ``max(LEAST_WORDS - q, q)`` words in a row that equal the word ``q`` places on, so it is
enough to look at every fourth part of that many words and to extend what agrees four times in a row.

Documents are independent of each other: no shuffle, and a text of any number of words is held by one
task as numbers. Splitting to stability counts only segments that the pass before has changed.
"""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tourney.llm.shingles import sliced, slices
from tourney.llm.tasks import giving_back

# Shortest run, in words.
LEAST_WORDS = 12
# Places of a lag that must agree in a row before a run is measured.
SAMPLES = 4

Run = tuple[int, int, int]
Rewrite = Callable[[int | None, list[bytes]], list[bytes]]

_RUNS = pa.list_(
    pa.struct([(name, pa.int64()) for name in ("start", "length", "period")])
)
_SCHEMA = (
    "doc_id bigint, n_words bigint, "
    "runs array<struct<start: bigint, length: bigint, period: bigint>>, collapsed string"
)


def segments(words: np.ndarray, document: np.ndarray) -> list[tuple[int, int]]:
    """Stretches (first, end) in which each word occurs twice or more, by recursive splitting.

    ``words`` are the numbers of the words of several documents one after another, and ``document``
    the number of the document of each, in ascending order.
    """
    stable: list[tuple[int, int]] = []
    place, segment = np.arange(len(words)), document
    while len(place):
        length = np.bincount(segment)
        long_enough = length[segment] >= LEAST_WORDS
        place, segment = place[long_enough], segment[long_enough]
        if not len(place):
            break
        key = segment * (int(words.max()) + 1) + words[place]
        _, back, count = np.unique(key, return_inverse=True, return_counts=True)
        rare = count[back] < 2
        splits = np.bincount(segment, weights=rare) > 0
        settled = place[~splits[segment]]
        if len(settled):
            own = segment[~splits[segment]]
            first = np.flatnonzero(np.diff(own, prepend=-1))
            last = np.append(first[1:], len(own)) - 1
            stable += zip(settled[first].tolist(), (settled[last] + 1).tolist(), strict=True)
        unsettled = splits[segment] & ~rare
        new = np.diff(place[unsettled], prepend=-2) > 1
        new |= np.diff(segment[unsettled], prepend=-1) != 0
        place, segment = place[unsettled], np.cumsum(new) - 1
    return stable


def _agreement(words: np.ndarray, at: int, lag: int) -> tuple[int, int]:
    """The longest stretch around ``at`` in which every word equals the one ``lag`` places on."""
    end, step = at, 64
    while end < len(words) - lag:
        upto = min(end + step, len(words) - lag)
        apart = words[end:upto] != words[end + lag : upto + lag]
        other = int(apart.argmax())
        if apart[other]:
            end += other
            break
        end, step = upto, step * 2
    first, step = at, 64
    while first > 0:
        since = max(first - step, 0)
        apart = words[since:first][::-1] != words[since + lag : first + lag][::-1]
        other = int(apart.argmax())
        if apart[other]:
            first -= other
            break
        first, step = since, step * 2
    return first, end


def lag_scan(words: np.ndarray) -> list[Run]:
    """All runs (start, length, period) of a sequence of word numbers."""
    found: list[Run] = []
    long_runs: list[Run] = []
    n = len(words)
    for lag in range(1, n // 2 + 1):
        least = max(LEAST_WORDS - lag, lag)
        if least > n - lag:
            break
        stride = max(1, least // SAMPLES)
        agree = words[: n - lag : stride] == words[lag::stride]
        if len(agree) < SAMPLES:
            continue
        row = agree[: len(agree) - SAMPLES + 1].copy()
        for k in range(1, SAMPLES):
            row &= agree[k : len(agree) - SAMPLES + 1 + k]
        hits = np.flatnonzero(row)
        if not len(hits):
            continue
        hits *= stride
        # A run whose period divides the lag is found again at the lag, over the same words.
        long_runs = [run for run in long_runs if run[1] >= 2 * lag]
        for start, length, period in long_runs:
            if lag % period == 0:
                hits = hits[(hits < start) | (hits >= start + length - lag)]
        i = 0
        while i < len(hits):
            first, end = _agreement(words, int(hits[i]), lag)
            if end - first >= least:
                run = (first, end - first + lag, lag)
                found.append(run)
                long_runs.append(run)
            i = int(np.searchsorted(hits, max(end, int(hits[i]) + 1)))
    return sorted(found, key=lambda run: (run[0], run[2]))


def runs_of(documents: list[list[bytes]]) -> list[list[Run]]:
    """The runs of each document, by start, then period."""
    numbers: dict[bytes, int] = {}
    for words in documents:
        for word in words:
            numbers.setdefault(word, len(numbers))
    ids = np.fromiter(
        (numbers[word] for words in documents for word in words),
        np.int64,
        sum(map(len, documents)),
    )
    lengths = [len(words) for words in documents]
    offset = np.concatenate(([0], np.cumsum(lengths))).astype(np.int64)
    document = np.repeat(np.arange(len(documents)), lengths)
    runs: list[list[Run]] = [[] for _ in documents]
    for first, end in segments(ids, document):
        owner = int(document[first])
        shift = first - int(offset[owner])
        runs[owner] += [(s + shift, n, q) for s, n, q in lag_scan(ids[first:end])]
    return [sorted(own, key=lambda run: (run[0], run[2])) for own in runs]


def collapse(words: list[bytes], runs: list[Run]) -> bytes:
    """The words, of each run only its first period, joined by one space."""
    if runs:
        kept = np.ones(len(words), dtype=bool)
        for start, length, period in runs:
            kept[start + period : start + length] = False
        words = [words[i] for i in np.flatnonzero(kept)]
    return b" ".join(words)


def collapse_runs(docs: DataFrame, rewrite: Rewrite | None = None) -> DataFrame:
    """Per row of ``docs`` (doc_id, text): its number of words, runs, and text without repetitions.

    Words are separated by ASCII white space. ``rewrite`` may change the words of a document before
    they are searched. A null or empty text has no words, no runs and an empty collapsed text;
    repeated rows each give their row, and further columns are left out.
    """

    @giving_back
    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sliced(batches):
            keys = batch.column("doc_id").to_pylist()
            texts = batch.column("text").cast(pa.binary()).to_pylist()
            for part in slices([len(t or b"") for t in texts]):
                documents = [(t or b"").split() for t in texts[part]]
                if rewrite is not None:
                    documents = list(map(rewrite, keys[part], documents))
                runs = runs_of(documents)
                plain = [collapse(*pair) for pair in zip(documents, runs, strict=True)]
                named = [
                    [dict(zip(("start", "length", "period"), run, strict=True)) for run in own]
                    for own in runs
                ]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(keys[part], pa.int64()),
                        pa.array([len(words) for words in documents], pa.int64()),
                        pa.array(named, _RUNS),
                        pa.array(plain, pa.binary()).cast(pa.string()),
                    ],
                    ["doc_id", "n_words", "runs", "collapsed"],
                )

    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")
    return rows.mapInArrow(search, _SCHEMA)


def planted(doc_id: int | None, words: list[bytes]) -> list[bytes]:
    """The words with a repetition planted in about every tenth document, chosen by its id.

    A missing id counts as empty text.
    """
    hashed = zlib.crc32(b"" if doc_id is None else str(doc_id).encode())
    n, g = len(words), hashed // 10
    if hashed % 10 or not n:
        return words
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return words[:a] + [words[a + i % p] for i in range(n - a)]


def run_digests(collapsed: DataFrame) -> DataFrame:
    """Counts, the longest run and digests of the rows of ``collapse_runs``."""
    longest = F.array_max(
        F.transform(
            "runs",
            lambda r: F.struct(
                r.length.alias("length"), (-r.start).alias("start"), (-r.period).alias("period")
            ),
        )
    )
    lines = F.transform(
        "runs", lambda r: F.concat(F.concat_ws(",", r.start, r.length, r.period), F.lit("\n"))
    )
    rows = collapsed.withColumn("longest", longest)
    return rows.select(
        "doc_id",
        F.size("runs").cast("bigint").alias("n_runs"),
        (-F.col("longest.start")).alias("start"),
        F.col("longest.length").alias("length"),
        (-F.col("longest.period")).alias("period"),
        F.expr("1000 * longest.length DIV -longest.period").alias("exponent_milli"),
        F.sha2(F.array_join(lines, ""), 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )
