import random
import re

import numpy as np
import pytest

from tourney.llm import minhash, shingles
from tourney.llm.graph import components

SCHEMA = "doc_id long, text string, kept int, component_id string"
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def shingle_set(text, words):
    found = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOWER))
    if len(found) < words:
        return frozenset([tuple(found)] if found else [])
    return frozenset(tuple(found[i : i + words]) for i in range(len(found) - words + 1))


def brute(rows, words):
    sets = {i: shingle_set(t, words) for i, t in rows}
    root = {i: i for i in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    ids = sorted(sets)
    for n, a in enumerate(ids):
        for b in ids[n + 1 :]:
            both = len(sets[a] & sets[b])
            if both and 100 * both >= 80 * len(sets[a] | sets[b]):
                low, high = sorted((find(a), find(b)))
                root[high] = low
    return {i: (len(sets[i]), find(i), find(i) == i) for i in ids}


def corpus(seed):
    rng = random.Random(seed)
    vocabulary = [f"{a}{b}é" for a in "abcdefgh" for b in "ijklmnop"]
    passage = [rng.choice(vocabulary) for _ in range(60)]
    texts = [None, "", " \t\n\x0b\r ", "one", "One  ONE", "one", "two words", "Two\nwords", "É é"]
    for _ in range(12):
        base = [rng.choice(vocabulary) for _ in range(rng.randint(8, 150))]
        for _ in range(rng.randint(1, 9)):
            copy = list(base)
            for _ in range(rng.randint(0, max(1, len(base) // 25))):
                copy[rng.randrange(len(copy))] = rng.choice(vocabulary)
            texts.append(" ".join(copy) if rng.random() < 0.7 else "  ".join(copy).upper())
    for _ in range(25):  # a shared passage does not make documents similar
        texts.append(" ".join(passage + [rng.choice(vocabulary) for _ in range(25)]))
    texts.append("repeat this " * 30_000)
    rng.shuffle(texts)
    return [(1000 - 3 * i, t) for i, t in enumerate(texts)]


@pytest.mark.parametrize(("seed", "words"), [(1, 4), (2, 5)])
def test_components_of_brute_force(spark, monkeypatch, seed, words):
    monkeypatch.setattr(minhash, "BLOCK", 3)
    rows = corpus(seed)
    frame = spark.createDataFrame([(*r, 1, "x") for r in rows], SCHEMA).repartition(4)
    found = {
        r.doc_id: (r.n_shingles, r.component_id, r.kept)
        for r in minhash.near_duplicates(frame, words=words).collect()
    }
    assert found == brute(rows, words)


def test_chain_of_copies_is_one_component(spark):
    """Neighbours are linked, the ends share little: a hub alone does not see the whole chain."""
    words = [f"w{i}" for i in range(400)]
    rows = [(i, " ".join(words[8 * i : 8 * i + 200])) for i in range(20)]
    found = minhash.near_duplicates(
        spark.createDataFrame([(*r, 1, "x") for r in rows], SCHEMA), words=4
    )
    assert {(r.doc_id, r.component_id) for r in found.collect()} == {
        (i, c) for i, (_, c, _) in brute(rows, 4).items()
    }


def test_repeated_and_null_ids(spark):
    text = " ".join(f"word{i}" for i in range(50))
    rows = [(7, text), (7, text), (3, text + " more"), (None, text), (9, "other text here now")]
    frame = spark.createDataFrame([(*r, 1, "x") for r in rows], SCHEMA)
    found = minhash.near_duplicates(frame).collect()
    assert sorted((r.doc_id or -1, r.component_id or -1, r.kept) for r in found) == [
        (-1, -1, True), (3, 3, True), (7, 3, False), (7, 3, False), (9, 9, True),
    ]
    left = minhash.without_near_duplicates(frame)
    assert left.columns == frame.columns
    assert sorted((r.doc_id or -1) for r in left.collect()) == [-1, 3, 9]


def test_empty_table(spark):
    assert minhash.near_duplicates(spark.createDataFrame([], SCHEMA)).count() == 0


def test_estimate_corrects_for_chance(spark):
    rng = np.random.default_rng(1)
    a = np.unique(rng.integers(1, 1 << 62, 3000, dtype=np.uint64))
    b = np.unique(np.concatenate((a[:1500], rng.integers(1, 1 << 62, 1500, dtype=np.uint64))))
    digits = minhash.pack(minhash.minima([a, b])).tolist()
    frame = spark.createDataFrame([digits], "a array<long>, b array<long>")
    found = frame.select(minhash.estimated_similarity("a", "b")).first()[0]
    assert abs(found - 1 / 3) < 0.15
    assert frame.select(minhash.estimated_similarity("a", "a")).first()[0] == 1.0


def test_shingles_of_many_texts_at_once():
    texts = ["a b c d e", None, "", "A b  c\td e", "a b", "b a", "x" * 100_000 + " y z w v u"]
    sets = [frozenset(s.tolist()) for s in shingles.shingle_sets(texts, 4)]
    assert sets[0] == sets[3] and len(sets[0]) == 2
    assert sets[1] == sets[2] == frozenset()
    assert len(sets[4]) == 1 and sets[4] != sets[5]
    assert [len(s) for s in sets] == [len(shingle_set(t, 4)) for t in texts]


def test_components_on_paths_and_stars(spark):
    rng = random.Random(4)
    edges = [(i, i + 1) for i in range(100, 140)] + [(5, i) for i in range(500, 560)]
    edges += [(rng.randrange(1000, 1200), rng.randrange(1000, 1200)) for _ in range(150)]
    edges += [(None, 3), (4, None), (6, 6)]
    root = {}

    def find(x):
        while root.setdefault(x, x) != x:
            x = root[x]
        return x

    for a, b in edges:
        if a is not None and b is not None and a != b:
            low, high = sorted((find(a), find(b)))
            root[high] = low
    frame = spark.createDataFrame(edges, "a long, b long")
    found = {r.node: r.root for r in components(frame, "a", "b").collect()}
    assert found == {x: find(x) for x in root}


def test_slices_cover_everything_once():
    lengths = [5, 0, 900, 3, 3, 2000]
    cut = list(shingles.slices(lengths, most=1000))
    assert [x for s in cut for x in range(s.start, s.stop)] == list(range(len(lengths)))


def test_two_texts_under_one_id(spark):
    """Each has a near copy of its own."""
    rng = random.Random(8)
    texts = [" ".join(f"w{rng.randrange(10**6)}" for _ in range(200)) for _ in range(4)]
    rows = [(1, texts[0]), (1, texts[1]), (1, texts[2]), (1, texts[3])]
    rows += [(10 + i, f"{text} more") for i, text in enumerate(texts)]
    rows += [(20, "apart from all of them by far")]
    frame = spark.createDataFrame([(*r, 0, "x") for r in rows], SCHEMA).repartition(3)
    found = minhash.near_duplicates(frame, words=5, percent=80).collect()
    got = sorted((r.doc_id, r.component_id, r.kept) for r in found)
    assert got == [(1, 1, True)] * 4 + [(10 + i, 1, False) for i in range(4)] + [(20, 20, True)]


def alike(count):
    """Texts of 400 words that share most of them, with less than 0.8 of their shingles in common."""
    rng = random.Random(4)
    base = [f"w{i}" for i in range(400)]
    rows = []
    for i in range(count):
        words = list(base)
        for _ in range(12):
            words[rng.randrange(400)] = f"own{i}-{rng.random()}"
        rows.append((i, " ".join(words)))
    return rows


def test_a_group_of_texts_alike_below_the_limit_makes_no_rows_of_pairs(spark, monkeypatch):
    """No table has more rows than a text has bands, and those that meet its chief."""
    stored = minhash.materialise
    rows = {}

    def counted(df, name):
        table = stored(df, name)
        rows[name] = rows.get(name, 0) + table.count()
        return table

    monkeypatch.setattr(minhash, "materialise", counted)
    count = 240
    frame = spark.createDataFrame(alike(count), "doc_id long, text string")
    found = minhash.near_duplicates(frame, words=4, percent=80).collect()
    assert {r.doc_id: r.component_id for r in found} == {
        i: component for i, (_, component, _) in brute(alike(count), 4).items()
    }
    assert rows["groups"] > 2 * count
    # All pairs would be 119 rows a text.
    for name, made in rows.items():
        assert made <= (minhash.BANDS + 1) * count, (name, made)
