"""Spelling variants against a comparison of every two words."""

import random
import re
import zlib
from collections import Counter

import pytest

from tourney.llm.spelling import misspelled, spelling_variants, word_counts


def one_apart(a, b):
    if a == b or abs(len(a) - len(b)) > 1:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    short, long = sorted((a, b), key=len)
    return any(long[:i] + long[i + 1 :] == short for i in range(len(long)))


def plain_variants(counts):
    rows = {}
    for word, n in counts.items():
        near = [other for other in counts if one_apart(word, other)]
        best = min(near, key=lambda w: (-counts[w], w), default=None)
        form = best if best is not None and counts[best] >= 10 * n else None
        rows[word] = (form, n, len(near), form and counts[form])
    out = set()
    for word, (form, n, n_near, form_n) in rows.items():
        root = word
        while rows[root][0] is not None:
            root = rows[root][0]
        out.add((word, form, root, n, n_near, form_n))
    return out


def plain_counts(rows):
    counts = Counter()
    for doc_id, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            word = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{doc_id}:{word}".encode())
            if h % 31 == 0:
                word = word[: h % len(word)] + word[h % len(word) + 1 :]
            counts[word] += 1
    return {w: n for w, n in counts.items() if len(w) >= 7 and n >= 2}


def variants(spark, counts):
    table = spark.createDataFrame(list(counts.items()), "word string, n bigint")
    return spelling_variants(table)


@pytest.mark.parametrize("letters, longest", [("ab", 14), ("abcdefgh", 9), ("xyé\U0001f600", 5)])
def test_random_words(spark, letters, longest):
    draw = random.Random(longest)
    words = {"".join(draw.choices(letters, k=draw.randrange(1, longest + 1))) for _ in range(350)}
    counts = {word: int(draw.paretovariate(0.4)) for word in words}
    got = [tuple(row) for row in variants(spark, counts).collect()]
    assert len(got) == len(counts)
    assert set(got) == plain_variants(counts)


def test_every_edit_of_one_word(spark):
    word = "abcdefghijklmnopqrs"
    edits = {word[:i] + word[i + 1 :] for i in range(len(word))}
    edits |= {word[:i] + "z" + word[i:] for i in range(len(word) + 1)}
    edits |= {word[:i] + "z" + word[i + 1 :] for i in range(len(word))}
    counts = {word: 1000} | {edit: 2 for edit in edits}
    got = {row.word: row for row in variants(spark, counts).collect()}
    assert got[word].n_near == len(edits)
    assert all(got[edit].form == word for edit in edits)
    assert {tuple(row) for row in got.values()} == plain_variants(counts)


def test_very_long_words_and_chains(spark):
    long = "".join(random.Random(1).choices("abc", k=5000))
    counts = {long: 900, long[:-1]: 80, long[1:]: 7, long + "d": 9000, long[:2500] + long[2501:]: 3}
    chain = {"aaaaaaaa"[:i] + "b" * (8 - i): 10**i for i in range(9)}
    assert {tuple(r) for r in variants(spark, counts | chain).collect()} == plain_variants(
        counts | chain
    )


def test_texts_of_all_kinds(spark):
    rows = [(1, None), (2, ""), (3, "Straße Étudiante étudiante ETUDIANTE12etudiante")]
    draw = random.Random(3)
    vocabulary = ["".join(draw.choices("abcde", k=draw.randrange(6, 10))) for _ in range(80)]
    rows += [(i, " ".join(draw.choices(vocabulary, k=300))) for i in range(4, 60)]
    rows += rows[5:9]
    docs = spark.createDataFrame([(*r, 1) for r in rows], "doc_id bigint, text string, n int")
    counted = word_counts(docs, rewrite=misspelled)
    want = plain_counts(rows)
    assert {row.word: row.n for row in counted.collect()} == want
    got = spelling_variants(counted).collect()
    assert {tuple(row) for row in got} == plain_variants(want)
    assert spelling_variants(word_counts(docs.limit(0))).count() == 0
    nobody = spark.createDataFrame([(None, "wordword " * 9)], "doc_id bigint, text string")
    assert word_counts(nobody, rewrite=misspelled).count() == 1


def test_test_table_against_plain(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    counted = word_counts(docs, rewrite=misspelled)
    want = plain_counts([(r.doc_id, r.text) for r in docs.collect()])
    assert {row.word: row.n for row in counted.collect()} == want
    few = dict(sorted(want.items(), key=lambda item: zlib.crc32(item[0].encode()))[:1500])
    got = variants(spark, few).collect()
    assert {tuple(row) for row in got} == plain_variants(few)
