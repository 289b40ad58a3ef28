import random
import zlib

import numpy as np
import pytest

from tourney.llm import toxicity

DOCS = "doc_id long, text string, score int, lang string"
LABELS = "doc_id long, quality int, toxic int"


def corpus(count, seed=1):
    """Sentences of made-up words; toxic documents hold some with a word of a bad stem."""
    rng = random.Random(seed)
    syllables = ["ka", "lo", "mi", "ne", "ru", "ta", "vo", "si"]

    def word():
        return "".join(rng.choice(syllables) for _ in range(rng.randint(1, 4)))

    docs = []
    for i in range(count):
        toxic = rng.random() < 0.2
        sentences = [[word() for _ in range(rng.randint(3, 40))] for _ in range(rng.randint(2, 15))]
        places = []
        if toxic:
            for place in rng.sample(range(len(sentences)), rng.randint(1, 2)):
                bad = rng.choice(["vile", "Grubz" + word(), "grubz" + word()])
                sentences[place][rng.randrange(len(sentences[place]))] = bad
                places.append(place)
        docs.append((i, ". ".join(" ".join(s) for s in sentences) + ".", int(toxic), places))
    return docs


def test_held_out_accuracy_and_offending_sentences(spark):
    docs = corpus(900)
    frame = spark.createDataFrame([(i, t, 7, "x") for i, t, _, _ in docs], DOCS).repartition(3)
    labels = spark.createDataFrame([(i, 0, y) for i, _, y, _ in docs], LABELS)
    found = {r.doc_id: r for r in toxicity.toxicity(frame, labels).collect()}
    assert all(r.held_out == (zlib.crc32(str(i).encode()) % 3 == 1) for i, r in found.items())
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.7) for r in found.values())
    test = [(i, t, y, p) for i, t, y, p in docs if found[i].held_out]
    right = [found[i].predicted == y for i, _, y, _ in test]
    assert np.mean(right) > 0.97
    for i, text, y, places in test:
        if y and found[i].predicted:
            named = [text[s.start : s.end].lower() for s in found[i].offending]
            assert named and all("vile" in s or "grubz" in s for s in named)
            assert len(named) <= len(places)


def test_held_out_labels_teach_nothing(spark):
    docs = corpus(300, seed=2)
    frame = spark.createDataFrame([(i, t, 7, "x") for i, t, _, _ in docs], DOCS)
    hidden = [(i, 0, 1 - y if zlib.crc32(str(i).encode()) % 3 == 1 else y) for i, _, y, _ in docs]
    plain = toxicity.train(frame, spark.createDataFrame([(i, 0, y) for i, _, y, _ in docs], LABELS))
    other = toxicity.train(frame, spark.createDataFrame(hidden, LABELS))
    assert plain.bias == other.bias and plain.weights == other.weights


def test_edge_rows(spark):
    rows = [(1, None), (2, ""), (3, " \n.!? "), (4, "vile"), (4, "vile"), (None, "calm words")]
    frame = spark.createDataFrame([(*r, 7, "x") for r in rows], DOCS)
    labels = spark.createDataFrame(
        [(1, 0, 0), (2, None, 1), (3, 0, None), (None, 0, 1), (4, 0, 1), (4, 0, 0)], LABELS
    )
    found = toxicity.toxicity(frame, labels).collect()
    assert len(found) == len(rows)
    assert all(r.score == 0 and not r.offending for r in found if r.doc_id in (1, 2, 3))
    assert [r.held_out for r in found if r.doc_id is None] == [False]


@pytest.mark.parametrize("labelled", [[], [(1, 0, 0)]])
def test_without_both_labels_nothing_is_toxic(spark, labelled):
    frame = spark.createDataFrame([(1, "some words. more.", 7, "x")], DOCS)
    labels = spark.createDataFrame(labelled, LABELS)
    assert toxicity.without_toxic(frame, labels).columns == frame.columns
    assert toxicity.without_toxic(frame, labels).count() == 1
    assert toxicity.toxicity(frame.limit(0), labels).count() == 0


def late_corpus(count, length):
    """Every third document is toxic, by its last sentence only."""
    return [
        (3 * i, f"calm{i % 5} words here. " * (length // 18) + ("a vile end." if i % 3 else "an end."))
        for i in range(1, count)
    ]


def test_whole_training_texts_are_read(spark):
    docs = late_corpus(24, 210_000)
    frame = spark.createDataFrame([(*d, 7, "x") for d in docs], DOCS)
    labels = spark.createDataFrame([(i, 0, int("vile" in t)) for i, t in docs], LABELS)
    model = toxicity.train(frame, labels)
    assert model.score("a vile end.")[0] > 0.7 > model.score("calm1 words here. an end.")[0]


def test_sample_is_bounded_by_whole_documents(spark, monkeypatch):
    docs = late_corpus(40, 900)
    docs += [(docs[0][0], docs[0][1])] * 3
    seen = []
    monkeypatch.setattr(toxicity, "fit", lambda texts, labels: seen.append((texts, labels)))
    frame = spark.createDataFrame([(*d, 7, "x") for d in docs], DOCS).repartition(3)
    labels = spark.createDataFrame([(i, 0, int("vile" in t)) for i, t in docs], LABELS)
    usable = [t for i, t in docs if zlib.crc32(str(i).encode()) % 3 != 1]
    for chars in (50_000_000, 8_000, 500):
        monkeypatch.setattr(toxicity, "MAX_TRAINING_CHARS", chars)
        toxicity.train(frame, labels)
        texts, toxic = seen.pop()
        assert set(texts) <= set(usable) and sum(map(len, texts)) <= chars
        assert toxic.tolist() == ["vile" in t for t in texts]
        assert (len(texts) == len(usable)) == (chars == 50_000_000)
        assert (chars - sum(map(len, texts)) < 1_000) or chars == 50_000_000
