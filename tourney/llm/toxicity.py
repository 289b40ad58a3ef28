"""Toxicity of documents by multiple-instance learning.

Only documents are labelled, but what makes one toxic is a sentence. Each sentence gets a
probability ``p`` from a linear model of its words, and a document is toxic unless every sentence is
clean: ``1 - prod(1 - p)`` (noisy-or). Fitting that to the document labels teaches the sentence
model, which then scores all texts and names the offending sentences.

Weights are never negative: a harmless word adds nothing, but it cannot excuse an offensive one in a
long sentence either. Features of a word are itself and its first three to six letters, hashed into
a table of fixed size. The fit uses a bounded sample of the labelled rows; everything else covers
all rows.
"""

from __future__ import annotations

import re
import zlib
from array import array
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tourney.llm.tasks import giving_back, shipped

# Bounds of the sample of labelled documents that the driver fits the model on: rows, and characters
# of all of them together. Texts are taken whole or not at all.
MAX_TRAINING_ROWS = 5_000
MAX_TRAINING_CHARS = 50_000_000
FEATURE_BITS = 18
MIN_TRAINING_DOCUMENTS = 4
PREFIX_CHARS = (3, 4, 5, 6)
EPOCHS = 45
LEARNING_RATE = 0.25
PENALTY = 1e-5
SHRINK = 0.02
THRESHOLD = 0.7
OFFENDING = 0.5
# Words kept with their weight per worker process, and rows turned into Python objects at a time.
CACHED_WORDS = 200_000
SLICE_ROWS = 200

_SENTENCE = r"[^.!?\n]+"
_WORD = r"[^\W_]+"


def word_features(word: str) -> list[int]:
    mask = (1 << FEATURE_BITS) - 1
    parts = {f"{word[:n]}*" for n in PREFIX_CHARS if len(word) >= n} | {word}
    return [zlib.crc32(part.encode("utf-8", "surrogatepass")) & mask for part in sorted(parts)]


@dataclass
class SentenceModel:
    """``weights`` holds the hashed features whose weight is not zero."""

    weights: dict[int, float]
    bias: float
    cache: dict[str, float] = field(default_factory=dict)

    def word_weight(self, word: str) -> float:
        found = self.cache.get(word)
        if found is None:
            get = self.weights.get
            found = sum([get(feature, 0.0) for feature in word_features(word)])
            if len(self.cache) < CACHED_WORDS:
                self.cache[word] = found
        return found

    def sentences(self, text: str) -> tuple[list[tuple[int, int]], np.ndarray]:
        """Spans of the sentences that hold words, and their logits."""
        words_of, weight, known = re.compile(_WORD).findall, self.word_weight, self.cache
        spans, logits = [], []
        for found in re.compile(_SENTENCE).finditer(text):
            words = words_of(found.group().lower())
            if words:
                total = 0.0
                for word in words:
                    w = known.get(word)
                    total += weight(word) if w is None else w
                spans.append(found.span())
                logits.append(total)
        return spans, np.array(logits) + self.bias

    def score(self, text: str | None) -> tuple[float, list[dict]]:
        """Probability of the document, and its sentences that are likelier toxic than not."""
        spans, logits = self.sentences(text or "")
        if not spans:
            return 0.0, []
        doubt = np.logaddexp(0.0, logits)
        probability = -np.expm1(-doubt)
        found = [
            {"start": spans[i][0], "end": spans[i][1], "score": float(probability[i])}
            for i in np.flatnonzero(probability >= OFFENDING)
        ]
        return float(-np.expm1(-doubt.sum())), found


def _occurrences(texts: list[str]) -> tuple[np.ndarray, ...]:
    """Word and sentence of every occurrence, document of every sentence, and the features of each
    word with the word they belong to; numbers in compact arrays, as the driver holds them."""
    vocabulary: dict[str, int] = {}
    words, sentence_of, document_of = array("i"), array("i"), array("i")
    find_words, find_sentences = re.compile(_WORD).findall, re.compile(_SENTENCE).findall
    for document, text in enumerate(texts):
        for sentence in find_sentences(text.lower()):
            found = find_words(sentence)
            if found:
                words.extend([vocabulary.setdefault(w, len(vocabulary)) for w in found])
                sentence_of.extend([len(document_of)] * len(found))
                document_of.append(document)
    feature, owner = array("i"), array("i")
    for number, word in enumerate(vocabulary):
        found = word_features(word)
        feature.extend(found)
        owner.extend([number] * len(found))
    return tuple(
        np.frombuffer(x, np.int32) if x else np.empty(0, np.int32)
        for x in (words, sentence_of, document_of, feature, owner)
    )


def fit(texts: list[str], labels: np.ndarray) -> SentenceModel:
    """Noisy-or likelihood of the document labels, by full-batch Adam steps."""
    size = 1 << FEATURE_BITS
    words, sentence_of, document_of, feature, owner = _occurrences(texts)
    if not len(words) or labels.min() == labels.max():
        return SentenceModel({}, -8.0)
    count = int(owner[-1]) + 1

    # Features seen in few documents tell nothing about others, nor do words without any other.
    pairs = np.unique(words.astype(np.int64) * len(texts) + document_of[sentence_of])
    documents_per_word = np.bincount(pairs // len(texts), minlength=count)
    del pairs
    seen = np.bincount(feature, documents_per_word[owner], minlength=size)
    kept = seen[feature] >= MIN_TRAINING_DOCUMENTS
    feature, owner = feature[kept], owner[kept]
    useful = np.zeros(count, bool)
    useful[owner] = True
    renamed = (np.cumsum(useful) - 1).astype(np.int32)
    kept = useful[words]
    words, sentence_of = renamed[words[kept]], sentence_of[kept]
    owner, count = renamed[owner], int(useful.sum())

    weights, bias = np.zeros(size), -6.0
    slope, curve = np.zeros(size + 1), np.zeros(size + 1)
    y = labels.astype(bool)[document_of]
    for step in range(1, EPOCHS + 1):
        per_word = np.bincount(owner, weights[feature], minlength=count)
        logit = bias + np.bincount(sentence_of, per_word[words], minlength=len(document_of))
        logit = np.clip(logit, -30, 30)
        total = np.bincount(document_of, np.logaddexp(0.0, logit), minlength=len(texts))
        toxic = 1 / (1 + np.exp(-logit))
        push = np.where(y, -toxic / np.expm1(np.clip(total, 1e-6, 500))[document_of], toxic)
        by_word = np.bincount(words, push[sentence_of], minlength=count)
        gradient = np.empty(size + 1)
        gradient[:size] = np.bincount(feature, by_word[owner], minlength=size)
        gradient[:size] = gradient[:size] / len(texts) + PENALTY * weights
        gradient[size] = push.sum() / len(texts)
        slope += 0.1 * (gradient - slope)
        curve += 0.01 * (gradient**2 - curve)
        move = slope / (1 - 0.9**step) / (np.sqrt(curve / (1 - 0.99**step)) + 1e-8)
        weights = np.maximum(weights - LEARNING_RATE * (move[:size] + SHRINK), 0.0)
        bias -= LEARNING_RATE * move[size]
    used = np.flatnonzero(weights)
    return SentenceModel(dict(zip(used.tolist(), weights[used].tolist(), strict=True)), float(bias))


def held_out(key: str | Column = "doc_id") -> Column:
    """True where ``crc32`` of the key as text leaves 1 modulo 3; false for a null key."""
    key = F.col(key) if isinstance(key, str) else key
    return F.coalesce(F.crc32(key.cast("string")) % 3 == 1, F.lit(False))


def train(docs: DataFrame, labels: DataFrame) -> SentenceModel:
    """Fit on at most ``MAX_TRAINING_ROWS`` labelled documents that are not held out.

    The rows are those with the smallest key hashes, so the sample does not depend on how the
    tables are stored. Of these, one that would bring the sample over ``MAX_TRAINING_CHARS`` is left
    out; whole texts are read of the others. Null keys, labels and texts teach nothing; of several labels of one key the
    largest counts. Copies of a document count once per row. Without both labels every document
    scores close to 0.
    """
    usable = labels.where(~held_out("doc_id") & F.col("doc_id").isNotNull())
    usable = usable.where(F.col("toxic").isNotNull())
    chosen = (
        usable.groupBy("doc_id")
        .agg(F.max("toxic").alias("_toxic"))
        .orderBy(F.xxhash64("doc_id"), "doc_id")
        .limit(MAX_TRAINING_ROWS)
        .withColumnRenamed("doc_id", "_labelled")
    )
    rows = (
        docs.select("doc_id", "text")
        .where(F.col("text").isNotNull())
        .join(F.broadcast(chosen), F.col("doc_id") == F.col("_labelled"))
        .withColumn("_digest", F.xxhash64("text"))
    )
    sizes = (
        rows.groupBy("doc_id", "_digest")
        .agg(F.max(F.length("text")).alias("chars"), F.count(F.lit(1)).alias("copies"))
        .orderBy(F.xxhash64("doc_id"), "doc_id", "_digest")
        .limit(MAX_TRAINING_ROWS)
        .collect()
    )
    counts, left, room = {}, MAX_TRAINING_ROWS, MAX_TRAINING_CHARS
    for row in sizes:
        taken = min(row["copies"], left, room // max(1, row["chars"]))
        if taken:
            counts[row["doc_id"], row["_digest"]] = taken
            left, room = left - taken, room - taken * row["chars"]
    if not counts:
        return fit([], np.empty(0, bool))
    spark, keys = docs.sparkSession, rows.select("doc_id", "_digest").schema
    wanted = F.broadcast(spark.createDataFrame(list(counts), keys))
    fetched = (
        rows.join(wanted, ["doc_id", "_digest"], "left_semi")
        .groupBy("doc_id", "_digest")
        .agg(F.first("text").alias("text"), F.first("_toxic").alias("_toxic"))
        .collect()
    )
    found = {(row["doc_id"], row["_digest"]): row for row in fetched}
    sample = [found[key] for key, copies in counts.items() for _ in range(copies)]
    return fit([row["text"] for row in sample], np.array([row["_toxic"] > 0 for row in sample]))


_OFFENDING = pa.list_(
    pa.struct([("start", pa.int32()), ("end", pa.int32()), ("score", pa.float64())])
)


def _scored(
    batches: Iterator[pa.RecordBatch], model: SentenceModel, text: str
) -> Iterator[tuple[pa.RecordBatch, list[tuple[float, list[dict]]]]]:
    for batch in batches:
        for start in range(0, batch.num_rows, SLICE_ROWS):
            part = batch.slice(start, SLICE_ROWS)
            yield part, [model.score(t) for t in part.column(text).to_pylist()]


def score_documents(docs: DataFrame, model: SentenceModel, text: str = "text") -> DataFrame:
    """``docs`` with ``score`` and ``offending`` (character spans), replacing such columns.

    Whole texts are read. Null, empty and wordless texts score 0 and have no offending sentence.
    """
    opened = shipped(docs.sparkSession, model)
    plain = docs.drop("score", "offending")
    spans = "array<struct<start:int,end:int,score:double>>"
    schema = T.StructType(
        [*plain.schema, *T.StructType.fromDDL(f"score double, offending {spans}")]
    )

    @giving_back
    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, found in _scored(batches, opened(), text):
            columns = [pa.array([f[0] for f in found], pa.float64())]
            columns.append(pa.array([f[1] for f in found], _OFFENDING))
            names = [*part.schema.names, "score", "offending"]
            yield pa.RecordBatch.from_arrays([*part.columns, *columns], names)

    return plain.mapInArrow(score, schema)


def toxicity(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Per document: ``doc_id``, ``held_out``, ``score``, ``predicted`` and ``offending``."""
    scored = score_documents(docs.select("doc_id", "text"), train(docs, labels))
    return scored.select(
        "doc_id",
        held_out("doc_id").alias("held_out"),
        "score",
        (F.col("score") >= THRESHOLD).cast("int").alias("predicted"),
        "offending",
    )


def without_toxic(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows of ``docs`` that are not rejected, with their columns unchanged."""
    opened = shipped(docs.sparkSession, train(docs, labels))

    @F.pandas_udf("boolean")
    def clean(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        model = opened()

        @giving_back
        def kept(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
            for texts in batches:
                yield pd.Series([model.score(text)[0] < THRESHOLD for text in texts], dtype=bool)

        yield from kept(batches)

    return docs.where(clean("text"))
