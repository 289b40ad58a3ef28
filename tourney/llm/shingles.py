"""Hashes of the word shingles of whole texts, computed with numpy over many texts at a time."""

from __future__ import annotations

from collections.abc import Iterable, Iterator, Sequence

import numpy as np
import pyarrow as pa

_SEED = np.random.default_rng(20240229)
# One number per byte; capital letters have that of their small ones.
_BYTE = _SEED.integers(1, 1 << 63, 256, dtype=np.uint64)
_BYTE[ord("A") : ord("Z") + 1] = _BYTE[ord("a") : ord("z") + 1]
_SPACE = np.zeros(256, dtype=bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_BASE = 0x9E3779B97F4A7C15
_BACK = pow(_BASE, -1, 1 << 64)


def mix(x: np.ndarray) -> np.ndarray:
    """Spreads every bit of 64-bit numbers over all others."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def powers(base: int, n: int) -> np.ndarray:
    """``base`` to 0, 1, ... n - 1 modulo 2**64."""
    out = np.full(max(n, 1), base, dtype=np.uint64)
    out[0] = 1
    return np.cumprod(out, dtype=np.uint64)


def word_hashes(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Start of each word and its hash: a polynomial in its bytes, from prefix sums."""
    space = _SPACE[data]
    edge = np.flatnonzero(np.diff(np.concatenate(([True], space, [True])).view(np.int8)))
    start, end = edge[::2], edge[1::2]
    sums = np.zeros(len(data) + 1, dtype=np.uint64)
    np.cumsum(_BYTE[data] * powers(_BASE, len(data)), out=sums[1:])
    hashed = (sums[end] - sums[start]) * powers(_BACK, len(data) + 1)[start]
    return start, mix(hashed + (end - start).astype(np.uint64))


def shingle_sets(texts: Sequence[str | None], words: int) -> Iterator[np.ndarray]:
    """Per text the sorted distinct hashes of its ``words``-word shingles.

    A text of fewer words is one shingle as a whole; without words it has none.
    """
    encoded = [(t or "").encode("utf-8", "surrogatepass") for t in texts]
    ends = np.cumsum([len(e) + 1 for e in encoded])
    data = np.frombuffer(b"\n".join(encoded) + b"\n", dtype=np.uint8)
    start, hashed = word_hashes(data)
    last = np.searchsorted(start, ends)
    size = max(0, len(hashed) - words + 1)
    rolled = np.zeros(size, dtype=np.uint64)
    for k in range(words):
        rolled += hashed[k : k + size] * np.uint64(_BYTE[k] | np.uint64(1))
    rolled = mix(rolled)
    first = 0
    for end in last.tolist():
        if end - first >= words:
            yield np.unique(rolled[first : end - words + 1])
        elif end > first:
            whole = (hashed[first:end] * (_BYTE[: end - first] | np.uint64(1))).sum(keepdims=True)
            yield mix(whole + np.uint64(end - first))
        else:
            yield np.empty(0, dtype=np.uint64)
        first = end


def slices(lengths: Sequence[int], most: int = 1 << 20) -> Iterator[slice]:
    """Runs of texts of about ``most`` characters together."""
    first = held = 0
    for at, length in enumerate(lengths):
        held += length
        if held >= most:
            yield slice(first, at + 1)
            first, held = at + 1, 0
    if first < len(lengths):
        yield slice(first, len(lengths))


def sliced(batches: Iterable[pa.RecordBatch], rows: int = 500) -> Iterator[pa.RecordBatch]:
    """The batches in pieces of at most ``rows``, to hold fewer Python objects at a time."""
    for batch in batches:
        for start in range(0, batch.num_rows, rows):
            yield batch.slice(start, rows)
