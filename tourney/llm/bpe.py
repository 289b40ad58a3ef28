"""Byte-pair encoding and decoding of whole texts.

Each word starts as a doubly linked list of symbols. A priority queue holds the rank of every
adjacent pair that the vocabulary can merge; the lowest rank is merged first, the leftmost among
equal ranks. Entries whose symbols have changed since are stale and skipped when they come up.
Short words look for the lowest rank among all their pairs instead.
Decoding concatenates vocabulary strings.

The vocabulary is read on the driver and broadcast; its file size is checked first.
"""

from __future__ import annotations

import hashlib
import heapq
import json
import os
import re
import sys
import unicodedata
from collections.abc import Iterator

import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tourney.llm.tasks import giving_back, shipped

# A vocabulary file may be broadcast up to this size.
MAX_VOCABULARY_BYTES = 64 << 20
# Words, and pieces between white space, kept with their ids per worker process; beyond that they
# are encoded anew.
CACHED_WORDS = 150_000
CACHED_PIECES = 300_000
CACHED_CHARS = 64
# Bytes of a word up to which looking at all its pairs is cheaper than a queue.
SHORT_WORD = 24
_NO_MERGE = (1 << 62, -1)
# Rows turned into Python objects at a time.
SLICE_ROWS = 200


def byte_symbols() -> list[str]:
    """The printable character that stands for each byte in byte-level vocabularies."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [b for b in range(256) if b not in set(plain)]
    symbols = {b: chr(b) for b in plain} | {b: chr(256 + n) for n, b in enumerate(others)}
    return [symbols[b] for b in range(256)]


# Letters and numbers that Unicode 16 added to version 15.1, and pairs of letters that it
# and version 17 added (first capital, last capital, first small one).
_ADDED_LETTERS = (
    (0x1C89, 0x1C8A), (0xA7CB, 0xA7CD), (0xA7DA, 0xA7DC), (0x105C0, 0x105F3), (0x10D4A, 0x10D65),
    (0x10D6F, 0x10D85), (0x10EC2, 0x10EC4), (0x11380, 0x11389), (0x1138B, 0x1138B),
    (0x1138E, 0x1138E), (0x11390, 0x113B5), (0x113B7, 0x113B7), (0x113D1, 0x113D1),
    (0x113D3, 0x113D3), (0x11BC0, 0x11BE0), (0x13460, 0x143FA), (0x16100, 0x1611D),
    (0x16D40, 0x16D6C), (0x18CFF, 0x18CFF), (0x1E5D0, 0x1E5ED), (0x1E5F0, 0x1E5F0),
)
_ADDED_NUMBERS = (
    (0x10D40, 0x10D49), (0x116D0, 0x116E3), (0x11BF0, 0x11BF9), (0x16130, 0x16139),
    (0x16D70, 0x16D79), (0x1CCF0, 0x1CCF9), (0x1E5F1, 0x1E5FA),
)
_ADDED_CAPITALS = (
    (0x1C89, 0x1C89, 0x1C8A), (0xA7CB, 0xA7CB, 0x264), (0xA7CC, 0xA7CC, 0xA7CD),
    (0xA7CE, 0xA7CE, 0xA7CF), (0xA7D2, 0xA7D2, 0xA7D3), (0xA7D4, 0xA7D4, 0xA7D5),
    (0xA7DA, 0xA7DA, 0xA7DB), (0xA7DC, 0xA7DC, 0x19B), (0x10D50, 0x10D65, 0x10D70),
    (0x16EA0, 0x16EB8, 0x16EBB),
)


def _before_unicode_16() -> bool:
    """Whether this Python is older than the Unicode version of the library."""
    return tuple(map(int, unicodedata.unidata_version.split("."))) < (16,)


def plain_classes(pattern: str) -> str:
    """The pattern with its classes of letters, numbers and white space written out.

    They are those of Unicode 16, as the library has them. The ``regex`` package knows later letters.
    """
    space = regex.compile(r"\s")
    members = {r"\p{L}": [], r"\p{N}": [], r"\s": []}
    for point in range(sys.maxunicode + 1):
        character = chr(point)
        kind = rf"\p{{{unicodedata.category(character)[0]}}}"
        if kind in members:
            members[kind].append(point)
        elif space.match(character):
            members[r"\s"].append(point)
    if _before_unicode_16():
        for kind, added in ((r"\p{L}", _ADDED_LETTERS), (r"\p{N}", _ADDED_NUMBERS)):
            more = {point for first, last in added for point in range(first, last + 1)}
            members[kind] = sorted({*members[kind], *more})
    for kind, points in members.items():
        ranges, first = [], 0
        for i in range(1, len(points) + 1):
            if i == len(points) or points[i] != points[i - 1] + 1:
                ranges.append(f"\\U{points[first]:08x}-\\U{points[i - 1]:08x}")
                first = i
        # Within brackets, the ranges join the others there.
        written = "".join(ranges)
        parts = pattern.split(kind)
        pattern = parts[0]
        for part in parts[1:]:
            inside = pattern.rfind("[") > pattern.rfind("]")
            pattern += (written if inside else f"[{written}]") + part
    return pattern


class Bpe:
    """A vocabulary with its merges, as the JSON file of a word-level byte BPE describes them.

    Supports what such a file may ask for here: special tokens found in the raw text, NFC,
    white space folding, lower case, a word pattern, byte symbols, and an end-of-word suffix.
    """

    def __init__(self, spec: dict) -> None:
        model = spec["model"]
        self.vocab: dict[str, int] = model["vocab"]
        self.suffix: str = model.get("end_of_word_suffix") or ""
        pairs = [tuple(m) if isinstance(m, list) else tuple(m.split(" ")) for m in model["merges"]]
        self.merges: dict[tuple[int, int], tuple[int, int]] = {
            (self.vocab[a], self.vocab[b]): (rank, self.vocab[a + b])
            for rank, (a, b) in enumerate(pairs)
        }
        self.special: dict[str, int] = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.strings: dict[int, str] = {i: s for s, i in self.vocab.items()}
        self.strings |= {i: s for s, i in self.special.items()}
        self.steps = spec["normalizer"]["normalizers"]
        split = spec["pre_tokenizer"]["pretokenizers"][0]
        self.pattern: str = split["pattern"]["Regex"]
        # Characters that only one of str.split() and the white space of the pattern takes for space.
        space = regex.compile(r"\s")
        self.odd_spaces = "".join(
            c for c in map(chr, range(0x3100)) if c.isspace() != bool(space.match(c))
        )
        self.words: dict[str, list[int]] = {}
        self.pieces: dict[str, list[int]] = {}
        self._prepared = False

    def _prepare(self) -> None:
        """Compiled patterns and tables, made in the process that uses them."""
        self._words = re.compile(plain_classes(self.pattern))
        self._cuts = (
            regex.compile("|".join(map(regex.escape, sorted(self.special, key=len, reverse=True))))
            if self.special
            else None
        )
        self._spaces = [
            (regex.compile(step["pattern"]["Regex"]), step["content"])
            for step in self.steps
            if step["type"] == "Replace"
        ]
        symbols = byte_symbols()
        self._byte_ids = [self.vocab.get(s) for s in symbols]
        self._last_ids = [self.vocab.get(s + self.suffix) for s in symbols]
        self._odd = regex.compile(f"[{regex.escape(self.odd_spaces)}]") if self.odd_spaces else None
        self._capitals = {
            first + i: small + i
            for first, last, small in _ADDED_CAPITALS
            for i in range(last - first + 1)
            if _before_unicode_16()
        }
        self._prepared = True

    def normalise(self, text: str) -> str:
        spaces = iter(self._spaces)
        for step in self.steps:
            kind = step["type"]
            if kind == "NFC":
                if not text.isascii():
                    text = unicodedata.normalize("NFC", text)
            elif kind == "Replace":
                pattern, content = next(spaces)
                text = pattern.sub(content, text)
            elif kind == "Lowercase":
                # Lower case goes letter by letter: a capital sigma has one form everywhere.
                text = text.replace("Σ", "σ").lower()
                if self._capitals and not text.isascii():
                    text = text.translate(self._capitals)
            else:
                raise ValueError(f"unknown normalizer {kind}")
        return text

    def merge(self, word: str) -> list[int]:
        """Ids of one word."""
        data = word.encode()
        ids = [self._byte_ids[b] for b in data]
        ids[-1] = self._last_ids[data[-1]]
        return self._merge_short(ids) if len(ids) <= SHORT_WORD else self._merge_queued(ids)

    def _merge_short(self, ids: list[int]) -> list[int]:
        """The same merges, the lowest rank found by a look at all pairs: no queue to keep."""
        merges = self.merges
        found = [merges.get(pair, _NO_MERGE) for pair in zip(ids, ids[1:])]
        ranks = [merge[0] for merge in found]
        while ranks:
            rank = min(ranks)
            if rank == _NO_MERGE[0]:
                break
            at = ranks.index(rank)
            ids[at : at + 2] = (found[at][1],)
            del ranks[at], found[at]
            if at:
                found[at - 1] = merge = merges.get((ids[at - 1], ids[at]), _NO_MERGE)
                ranks[at - 1] = merge[0]
            if at < len(ranks):
                found[at] = merge = merges.get((ids[at], ids[at + 1]), _NO_MERGE)
                ranks[at] = merge[0]
        return ids

    def _merge_queued(self, ids: list[int]) -> list[int]:
        n = len(ids)
        before, after = list(range(-1, n - 1)), [*range(1, n), -1]
        merges, queue = self.merges, []
        for at in range(n - 1):
            found = merges.get((ids[at], ids[at + 1]))
            if found:
                queue.append((found[0], at, ids[at], ids[at + 1], found[1]))
        heapq.heapify(queue)
        gone = -1
        while queue:
            _, at, left, right, merged = heapq.heappop(queue)
            nxt = after[at]
            if ids[at] != left or nxt < 0 or ids[nxt] != right:
                continue  # stale: one of the two symbols has changed
            ids[at], ids[nxt] = merged, gone
            after[at] = after[nxt]
            if after[nxt] >= 0:
                before[after[nxt]] = at
            for first in (before[at], at):
                second = after[first] if first >= 0 else -1
                if second >= 0:
                    found = merges.get((ids[first], ids[second]))
                    if found:
                        entry = (found[0], first, ids[first], ids[second], found[1])
                        heapq.heappush(queue, entry)
        return [i for i in ids if i != gone]

    def _encode_piece(self, text: str) -> list[int]:
        known, out = self.words, []
        for word in self._words.findall(self.normalise(text)):
            ids = known.get(word)
            if ids is None:
                ids = self.merge(word)
                if len(word) <= CACHED_CHARS and len(known) < CACHED_WORDS:
                    known[word] = ids
            out += ids
        return out

    def _encode_plain(self, text: str, out: list[int]) -> None:
        """No word, and no composition of characters, reaches over white space."""
        if self._odd is not None and self._odd.search(text):
            out += self._encode_piece(text)
            return
        known = self.pieces
        for piece in text.split():
            ids = known.get(piece)
            if ids is None:
                ids = self._encode_piece(piece)
                if len(piece) <= CACHED_CHARS and len(known) < CACHED_PIECES:
                    known[piece] = ids
            out += ids

    def encode(self, text: str | None) -> list[int]:
        if not self._prepared:
            self._prepare()
        out: list[int] = []
        text, done = text or "", 0
        if self._cuts is not None:
            for found in self._cuts.finditer(text):
                self._encode_plain(text[done : found.start()], out)
                out.append(self.special[found.group()])
                done = found.end()
        self._encode_plain(text[done:] if done else text, out)
        return out

    def decode(self, ids, between: str = " ") -> str:
        """Vocabulary strings joined by ``between``; files without a decoder ask for a space."""
        return between.join(map(self.strings.__getitem__, ids))


def load_bpe(path: str) -> Bpe:
    if os.path.getsize(path) > MAX_VOCABULARY_BYTES:
        raise ValueError(f"{path} is larger than {MAX_VOCABULARY_BYTES} bytes")
    with open(path, encoding="utf-8") as file:
        return Bpe(json.load(file))


def _slices(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    for start in range(0, batch.num_rows, SLICE_ROWS):
        yield batch.slice(start, SLICE_ROWS)


def encode_documents(
    docs: DataFrame, path: str, text: str = "text", ids: str = "token_ids"
) -> DataFrame:
    """``docs`` with the token ids of each text in the column ``ids``, which replaces one of that
    name. A null or empty text has no tokens."""
    opened = shipped(docs.sparkSession, load_bpe(path))
    plain = docs.drop(ids)
    schema = T.StructType([*plain.schema, T.StructField(ids, T.ArrayType(T.IntegerType()))])

    @giving_back
    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = opened()
        for batch in batches:
            for part in _slices(batch):
                found = [bpe.encode(t) for t in part.column(text).to_pylist()]
                column = pa.array(found, pa.list_(pa.int32()))
                yield pa.RecordBatch.from_arrays(
                    [*part.columns, column], [*part.schema.names, ids]
                )

    return plain.mapInArrow(encode, schema)


def decode_documents(
    docs: DataFrame, path: str, ids: str = "token_ids", text: str = "decoded"
) -> DataFrame:
    """``docs`` with the text of each array of ids in the column ``text``; null for a null array."""
    opened = shipped(docs.sparkSession, load_bpe(path))
    plain = docs.drop(text)
    schema = T.StructType([*plain.schema, T.StructField(text, T.StringType())])

    @giving_back
    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = opened()
        for batch in batches:
            for part in _slices(batch):
                lists = part.column(ids).to_pylist()
                found = [None if x is None else bpe.decode(x) for x in lists]
                yield pa.RecordBatch.from_arrays(
                    [*part.columns, pa.array(found, pa.string())], [*part.schema.names, text]
                )

    return plain.mapInArrow(decode, schema)


def round_trip(docs: DataFrame, path: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Per document: ``n_tokens``, and SHA-256 of its ids and of its decoded text.

    Whole texts are encoded, whatever their length. Null and empty texts have no tokens and the
    digests of the empty string; rows with the same key stay separate rows.
    """
    opened = shipped(docs.sparkSession, load_bpe(path))
    kept = docs.select(F.col(key).alias(key), F.col(text).alias("text"))
    schema = T.StructType(
        [
            kept.schema[key],
            T.StructField("n_tokens", T.LongType()),
            T.StructField("ids_sha256", T.StringType()),
            T.StructField("decoded_sha256", T.StringType()),
        ]
    )

    @giving_back
    def digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = opened()
        for batch in batches:
            for part in _slices(batch):
                rows = []
                for given in part.column("text").to_pylist():
                    ids = bpe.encode(given)
                    listed = " ".join(map(str, ids)).encode()
                    decoded = bpe.decode(ids).encode()
                    rows.append(
                        (
                            len(ids),
                            hashlib.sha256(listed).hexdigest(),
                            hashlib.sha256(decoded).hexdigest(),
                        )
                    )
                columns = list(zip(*rows, strict=True))
                yield pa.RecordBatch.from_arrays(
                    [part.column(key), *map(pa.array, columns)], schema.names
                )

    return kept.mapInArrow(digests, schema)
