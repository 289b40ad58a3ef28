"""The registered queries: each operator with its production settings over its whole table."""

from __future__ import annotations

import uuid
from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tourney.llm import (
    bpe,
    chat,
    graph_search,
    licenses,
    minhash,
    mixing,
    periodic,
    quantised,
    spelling,
    suffixes,
    toxicity,
    url_rules,
    warc,
)
from tourney.session import scratch_dir

Query = Callable[[SparkSession, str], DataFrame]


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    vocabulary = public_tokenizers.path("word_bpe_49k.json")
    return bpe.round_trip(_table(spark, sf_dir, "documents"), vocabulary)


def _mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mixture(_table(spark, sf_dir, "documents"))


def _minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.near_duplicates(_table(spark, sf_dir, "documents"), words=4, percent=80)


def _suffixes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffixes.remove_repeats(_table(spark, sf_dir, "documents"), length=400)


def _quantised(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quantised.linked_vectors(_table(spark, sf_dir, "embeddings"), cosine=0.95)


def _graph_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return graph_search.nearest(
        _table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0, k=20
    )


def _licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.license_summary(_table(spark, sf_dir, "documents"))


def _warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    warc.register(spark)
    path = f"{scratch_dir(spark)}/archive-{uuid.uuid4().hex}"
    records = warc.archive_records(_table(spark, sf_dir, "pages"))
    records.write.format("warc").mode("append").save(path)
    return warc.archived_pages(spark, path)


def _chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    said = "</s>[INST] ok [/INST]"
    extra = [(-7, turn, role, said) for turn, role in enumerate(("user", "assistant"))]
    return chat.read_back(
        chat.format_windows(rows.unionByName(spark.createDataFrame(extra, rows.schema)))
    )


def _toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.toxicity(
        _table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels")
    )


def _url_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    rules = url_rules.rules_table(spark, url_rules.RULES)
    return url_rules.judge_urls(_table(spark, sf_dir, "pages"), rules)


def _spelling(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = _table(spark, sf_dir, "documents")
    counts = spelling.word_counts(documents, rewrite=spelling.misspelled)
    return spelling.spelling_variants(counts, ratio=10)


def _periodic(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = _table(spark, sf_dir, "documents")
    return periodic.run_digests(periodic.collapse_runs(documents, periodic.planted))


def queries() -> dict[str, Query]:
    return {
        "op1_mixing": _mixing,
        "op2_minhash": _minhash,
        "op3_quantised": _quantised,
        "op4_warc": _warc,
        "op5_licenses": _licenses,
        "op6_suffixes": _suffixes,
        "op7_graph_search": _graph_search,
        "op8_toxicity": _toxicity,
        "op9_chat": _chat,
        "op10_bpe": _bpe,
        "op11_url_rules": _url_rules,
        "op12_spelling": _spelling,
        "op13_periodic": _periodic,
    }


def oracle_sql() -> dict[str, str]:
    return {
        "op1_mixing": mixing.ORACLE_SQL,
        "op5_licenses": licenses.ORACLE_SQL,
        "op9_chat": chat.ORACLE_SQL,
        "op11_url_rules": url_rules.ORACLE_SQL,
    }
