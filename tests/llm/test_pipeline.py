"""The whole pipeline against a plain reading of its stages."""

import random
import zlib

import public_tokenizers
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from tests.llm.test_minhash import brute as near_duplicates
from tests.llm.test_suffixes import brute as cut_by_brute_force
from tourney.llm import mixing, toxicity


def write_corpus(spark, folder):
    rng = random.Random(11)

    def prose(n):
        return " ".join(
            "".join(rng.choice("abcdefghij") for _ in range(rng.randint(2, 8))) for _ in range(n)
        )

    passage = prose(60)
    texts = []
    for i in range(260):
        text = prose(rng.randint(5, 120))
        if i % 13 == 0:
            text += ". " + passage + ". " + prose(10)
        if i % 7 == 0:
            text += ". you vilemonger " + prose(3)
        texts.append(text)
    texts += [texts[1], texts[1] + " tail", texts[15].replace("a", "A"), "", None]
    toxic = [int(bool(t) and "vilemonger" in t) for t in texts]
    docs = [
        (i, t, ("en", "de")[i % 2], f"s{i % 3}", len(t or "")) for i, t in enumerate(texts)
    ]
    spark.createDataFrame(docs, "doc_id long, text string, lang string, source string, n_chars long") \
        .repartition(4).write.parquet(f"{folder}/documents.parquet")
    labels = [(i, 1, y) for i, y in enumerate(toxic)]
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(
        f"{folder}/labels.parquet"
    )
    return docs, toxic


def test_stages_one_after_the_other(spark, tmp_path):
    folder = str(tmp_path)
    docs, toxic = write_corpus(spark, folder)
    columns = spark.read.parquet(f"{folder}/documents.parquet").columns
    (_, drop_toxic), (_, near), (_, repeats), (_, mixture), (_, encode) = corpus_pipeline.STAGES
    read = spark.read.parquet(f"{folder}/documents.parquet")

    def stored(stage, given, name):
        stage(spark, given, folder).write.parquet(f"{folder}/{name}")
        return spark.read.parquet(f"{folder}/{name}")

    clean = stored(drop_toxic, read, "clean")
    assert clean.columns == columns
    kept = {r.doc_id for r in clean.collect()}
    assert {i for i, y in enumerate(toxic) if not y} == kept

    single = stored(near, clean, "single")
    assert single.columns == columns
    expected = near_duplicates([(i, t) for i, t, *_ in docs if i in kept], 5)
    kept = {i for i, (_, _, first) in expected.items() if first}
    assert {r.doc_id for r in single.collect()} == kept
    assert len(kept) < len(expected)

    cut = stored(repeats, single, "cut")
    assert cut.columns == columns
    order = sorted(kept)
    texts = {i: t for i, t, *_ in docs}
    wanted = cut_by_brute_force([texts[i] for i in order], corpus_pipeline.PASSAGE_BYTES)
    assert sum(removed for _, removed, _, _ in wanted) > 0
    found = {r.doc_id: r for r in cut.withColumn("sha", F.sha2(F.coalesce("text", F.lit("")), 256)).collect()}
    assert [found[i].sha for i in order] == [w[3] for w in wanted]
    assert all(r.n_chars == len(r.text or "") for r in found.values())

    drawn = stored(mixture, cut, "drawn")
    assert drawn.columns == columns
    plain = mixing.mix(cut, token_share=corpus_pipeline.TOKEN_SHARE).where("sampled")
    assert {r.doc_id for r in drawn.collect()} == {r.doc_id for r in plain.collect()}

    encoded = stored(encode, drawn, "encoded").collect()
    library = Tokenizer.from_file(public_tokenizers.path(corpus_pipeline.VOCABULARY))
    for r in encoded:
        assert r.token_ids == library.encode(r.text or "", add_special_tokens=False).ids
        assert r.n_tokens == len(r.token_ids)

    whole = corpus_pipeline.run(spark, folder)
    assert sorted(map(repr, whole.collect())) == sorted(map(repr, encoded))


def test_empty_corpus(spark, tmp_path):
    write_corpus(spark, str(tmp_path / "full"))
    empty = spark.read.parquet(str(tmp_path / "full" / "documents.parquet")).limit(0)
    empty.write.parquet(str(tmp_path / "documents.parquet"))
    labels = spark.read.parquet(str(tmp_path / "full" / "labels.parquet"))
    labels.write.parquet(str(tmp_path / "labels.parquet"))
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0


def test_held_out_rule_is_that_of_the_labels(spark):
    rows = spark.range(50).withColumn("out", toxicity.held_out("id")).collect()
    assert all(r.out == (zlib.crc32(str(r.id).encode()) % 3 == 1) for r in rows)
