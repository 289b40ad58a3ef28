import hashlib

import public_tokenizers
import pytest
from tokenizers import Tokenizer

from tourney.llm import bpe

PATH = public_tokenizers.path("word_bpe_49k.json")

TEXTS = [
    None,
    "",
    "  \n\t ",
    "Don't we'LL stop at 123 4.5!!! ΑΣ ΟΔΟΣ's İstanbul",
    "a<|endoftext|>b <|startoftext|><|endoftext|>",
    "x" * 3000,
    "é ̈ä q\x1cr\x1f s\x85t u﻿v",
    "naïve 漢字かな 한국어 😀👍🏽 ‍ end",
    "the same text",
    "the same text",
    "many words " * 20_000,
]


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


def frame(spark):
    rows = [(i % 10, t, "extra") for i, t in enumerate(TEXTS)]
    return spark.createDataFrame(rows, "doc_id long, text string, decoded string")


def test_same_digests_as_the_library(spark, library):
    def sha(text):
        return hashlib.sha256(text.encode()).hexdigest()

    expected = []
    for i, text in enumerate(TEXTS):
        ids = library.encode(text or "", add_special_tokens=False).ids
        decoded = library.decode(ids, skip_special_tokens=False)
        expected.append((i % 10, len(ids), sha(" ".join(map(str, ids))), sha(decoded)))
    found = [tuple(r) for r in bpe.round_trip(frame(spark), PATH).collect()]
    assert sorted(found) == sorted(expected)


def test_encode_and_decode_columns(spark, library):
    encoded = bpe.encode_documents(frame(spark), PATH)
    assert encoded.columns == ["doc_id", "text", "decoded", "token_ids"]
    for row in bpe.decode_documents(encoded, PATH).collect():
        ids = library.encode(row.text or "", add_special_tokens=False).ids
        assert row.token_ids == ids
        assert row.decoded == library.decode(ids, skip_special_tokens=False)


def test_stale_queue_entries_are_skipped(library):
    own = bpe.load_bpe(PATH)
    for word in ("aaaaaaaa", "abababab", "thethethe", "lowerlowerlowest", "zzzzzzzzzzzzzzz"):
        assert own.encode(word) == library.encode(word, add_special_tokens=False).ids


def test_short_words_need_no_queue(library, monkeypatch):
    ours = bpe.load_bpe(PATH)
    words = ["tests", "aaaaaaa", "naïvely", "x", "b" * bpe.SHORT_WORD]
    queued = bpe.load_bpe(PATH)
    monkeypatch.setattr(bpe, "SHORT_WORD", 0)
    by_queue = [queued.encode(word) for word in words]
    monkeypatch.undo()
    monkeypatch.delattr(bpe.heapq, "heapify")
    assert [ours.encode(word) for word in words] == by_queue
    assert by_queue == [library.encode(word, add_special_tokens=False).ids for word in words]


def test_large_vocabulary_files_are_refused(tmp_path, monkeypatch):
    monkeypatch.setattr(bpe, "MAX_VOCABULARY_BYTES", 10)
    with pytest.raises(ValueError):
        bpe.load_bpe(PATH)


def test_empty_table(spark):
    assert bpe.round_trip(frame(spark).limit(0), PATH).count() == 0


def test_every_code_point(library):
    """Between letters, so that its class and its lower case both show."""
    own = bpe.load_bpe(PATH)
    points = [p for p in range(0x110000) if not 0xD800 <= p <= 0xDFFF]
    differing = []
    for start in range(0, len(points), 20_000):
        texts = [f"a{chr(p)}B" for p in points[start : start + 20_000]]
        for text, found in zip(
            texts, library.encode_batch(texts, add_special_tokens=False), strict=True
        ):
            if own.encode(text) != found.ids:
                differing.append(hex(ord(text[1])))
    assert differing == []
