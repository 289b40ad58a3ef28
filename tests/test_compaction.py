"""Small batches of bronze joined by run, published by one log entry."""

import uuid
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from tests.rounds import match_rows
from tourney.plans import gold
from tourney.plans.build import build, read_gold, register_silver, tidy
from tourney.plans.silver import silver_rounds
from tourney.schema import BRONZE
from tourney.sources import bronze as store
from tourney.sources import compaction, joined
from tourney.sources.compaction import folder_sizes, join_batches, remove_joined
from tourney.sources.joined import Conflict
from tourney.streaming.ingest import load_batch

RUNS = ("r", "s+t %1:x", "1995", None)


def rows_of(df):
    return sorted(map(repr, df.collect()))


def frame(spark, rows):
    return spark.createDataFrame(rows, BRONZE)


def write_batches(spark, path, batches, runs=RUNS):
    """As many loads at once, a folder for each run and batch."""
    rows = [r for run in runs for r in match_rows(run, "x", "y", ["CD", "DD"] * (batches // 2))]
    batch = F.concat(F.lit("b/"), (F.col("tour") % batches).cast("string"))
    loads = frame(spark, rows).withColumn("batch", batch).repartition(4)
    loads.write.partitionBy("run_id", "batch").mode("append").parquet(path)
    return rows_of(frame(spark, rows))


def data_files(path):
    return [p for p in Path(path).rglob("*.parquet") if p.is_file()]


def test_many_batches_become_few_files_under_a_reader(spark, tmp_path):
    path, runs = str(tmp_path / "bronze"), ("r", None)
    expected = write_batches(spark, path, 200, runs)
    assert len(data_files(path)) == 200 * len(runs)
    assert join_batches(spark, path, hours=1) == 0  # too young
    reader = store.read_bronze(spark, path)
    assert join_batches(spark, path, hours=0) == 200 * len(runs)
    assert rows_of(reader) == rows_of(store.read_bronze(spark, path)) == expected
    assert remove_joined(spark, path, hours=1) == 0  # readers may still need the old folders
    assert rows_of(reader) == expected
    # Folders that have been replaced are pruned, not read and filtered.
    plan = store.read_bronze(spark, path)._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [" in plan and "PartitionFilters: []" not in plan
    kept = {str(p) for p in data_files(path) if "joined-" in str(p)}
    assert len(kept) <= 2 * len(runs)
    spoilt = {p: p.read_bytes() for p in data_files(path) if str(p) not in kept}
    for p in spoilt:
        p.write_bytes(b"spoiled")
        (p.parent / f".{p.name}.crc").unlink(missing_ok=True)
    assert rows_of(store.read_bronze(spark, path)) == expected
    assert remove_joined(spark, path, hours=0) == 200 * len(runs)
    assert len(data_files(path)) <= 2 * len(runs)
    assert rows_of(store.read_bronze(spark, path)) == expected
    assert join_batches(spark, path, hours=0) == 0


def test_joined_again_with_later_batches(spark, tmp_path):
    path = str(tmp_path / "bronze")
    write_batches(spark, path, 4, runs=("r",))
    assert join_batches(spark, path, hours=0) == 4
    late = frame(spark, match_rows("r", "x", "z", ["DD"]))
    store.append_bronze(late, path, "late")
    expected = rows_of(store.read_bronze(spark, path))
    assert join_batches(spark, path, hours=0) == 2
    assert remove_joined(spark, path, hours=0) == 6  # the first joined batch, too
    assert rows_of(store.read_bronze(spark, path)) == expected
    assert len(expected) == 5
    # The log forgets folders that are gone.
    store.append_bronze(frame(spark, match_rows("r", "x", "w", ["DD"])), path, "later")
    assert join_batches(spark, path, hours=0) == 2
    last = joined.last_joins(spark, path)
    assert len(last.replaced) == 2 and len(last.joined) == 2


def test_large_folders_and_single_batches_stay(spark, tmp_path):
    path = str(tmp_path / "bronze")
    write_batches(spark, path, 2, runs=("r",))
    store.append_bronze(frame(spark, match_rows("alone", "x", "y", ["CC"])), path, "one")
    smallest = folder_sizes(spark, path).agg(F.min("bytes")).first()[0]
    assert join_batches(spark, path, hours=0, small_bytes=smallest) == 0
    assert join_batches(spark, path, hours=0) == 2
    assert store.has_batch(spark, path, "one")


def test_a_join_that_fails_changes_nothing(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "bronze")
    expected = write_batches(spark, path, 4)
    joined.publish_joins(spark, path, joined.Joins(1))
    with monkeypatch.context() as patch:
        patch.setattr(joined, "write_new", lambda *_: False)
        with pytest.raises(Conflict):
            join_batches(spark, path, hours=0)
    # Rounds written by it do not count, in the table or in the lasting view.
    assert len(data_files(path)) > 4 * len(RUNS)
    assert rows_of(store.read_bronze(spark, path)) == expected
    spark.sql("CREATE DATABASE IF NOT EXISTS joins")
    register_silver(spark, path, "joins")
    assert spark.table("joins.silver_rounds").count() == len(expected)
    assert remove_joined(spark, path, hours=0) == len(RUNS)
    assert rows_of(store.read_bronze(spark, path)) == expected
    assert join_batches(spark, path, hours=0) == 4 * len(RUNS)
    register_silver(spark, path, "joins")
    found = spark.table("joins.silver_rounds")
    assert rows_of(found.select("run_id", "tour")) == rows_of(
        silver_rounds(store.read_bronze(spark, path)).select("run_id", "tour")
    )
    spark.sql("DROP DATABASE joins CASCADE")


def test_batches_that_may_be_stored_again_stay(spark, tmp_path):
    """A load that failed before its commit finds its batch under its own name afterwards."""
    path, warehouse = str(tmp_path / "bronze"), str(tmp_path / "gold")
    query = str(uuid.uuid4())
    parts = [match_rows("r", "x", who, ["CD", "DC"]) for who in "yzw"]
    for number, part in enumerate(parts[:2]):
        load_batch(frame(spark, part), f"{query}-{number}", path, warehouse, applied={query: number})
    store.append_bronze(frame(spark, parts[2]), path, f"{query}-2")
    before = rows_of(store.read_bronze(spark, path))
    tidy(spark, warehouse, hours=0, bronze=path)
    assert not store.has_batch(spark, path, f"{query}-1")
    assert store.has_batch(spark, path, f"{query}-2")
    assert rows_of(store.read_bronze(spark, path)) == before
    load_batch(frame(spark, parts[2]), f"{query}-2", path, warehouse, applied={query: 2})
    assert rows_of(store.read_bronze(spark, path)) == before
    silver = silver_rounds(store.read_bronze(spark, path))
    for name in ("gold_matchup_matrix", "gold_forgiveness_index"):
        assert rows_of(read_gold(spark, warehouse, name)) == rows_of(getattr(gold, name)(silver))


def test_rounds_delivered_again_after_a_join_are_rejected(spark, tmp_path):
    path, warehouse = str(tmp_path / "bronze"), str(tmp_path / "gold")
    rows = match_rows("r", "x", "y", ["CD", "DC", "CC"])
    store.append_bronze(frame(spark, rows[:2]), path)
    store.append_bronze(frame(spark, rows[2:]), path)
    build(store.read_bronze(spark, path), warehouse, select=("gold",))
    assert join_batches(spark, path, hours=0) == 2
    load_batch(frame(spark, rows[1:]), "again", path, warehouse)
    assert rows_of(store.read_bronze(spark, path)) == rows_of(frame(spark, rows))
    assert store.read_rejects(spark, path).count() == 2


def test_no_table(spark, tmp_path):
    path = str(tmp_path / "none")
    assert join_batches(spark, path, hours=0) == remove_joined(spark, path, hours=0) == 0
    assert compaction.SMALL_BYTES > 0
