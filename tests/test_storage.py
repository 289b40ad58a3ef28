"""Bronze and gold tables on disk, layer selection, and incremental pickup of run files."""

import re
from datetime import datetime, timezone
from pathlib import Path

import pytest

from tests.rounds import FULL_MATCHES, match_rows
from tourney.plans import gold, saved
from tourney.__main__ import main
from tourney.plans.build import (
    build,
    read_gold,
    rebuild_runs,
    register_gold,
    register_silver,
)
from tourney.plans.silver import silver_rounds
from tourney.schema import BRONZE, COLUMN_COMMENTS, GOLD, SILVER
from tourney.session import materialise, scratch_dir, scratch_table
from tourney.sources import bronze as store
from tourney.streaming.ingest import ingest_new_runs


def rows_of(df):
    return sorted(map(repr, df.collect()))


def test_runs_coexist_in_bronze(spark, bronze_of, tmp_path):
    path = str(tmp_path / "bronze")
    first = bronze_of(("1995", "x", "y", ["CD", "DD"]))
    second = bronze_of(("1996", "x", "y", ["CC"]))
    store.append_bronze(first, path)
    store.append_bronze(second, path)
    table = store.read_bronze(spark, path)
    assert [(f.name, f.dataType) for f in table.schema] == [(f.name, f.dataType) for f in BRONZE]
    assert rows_of(table) == rows_of(first.union(second))


def test_run_filter_prunes_folders(spark, bronze_of, tmp_path):
    path = str(tmp_path / "bronze")
    store.append_bronze(bronze_of(("1995", "x", "y", ["CD"]), ("1996", "x", "y", ["CC"])), path)
    one = store.read_bronze(spark, path).where("run_id = '1995'")
    plan = one._jdf.queryExecution().executedPlan().toString()
    assert re.search(r"PartitionFilters: \[.*run_id.*1995", plan)
    assert one.count() == 1


def test_run_files(spark, bronze_of, tmp_path):
    run = store.new_run_id()
    assert re.fullmatch(r"[0-9a-f]{8}", run)
    when = datetime(2025, 3, 4, 5, 6, 7, tzinfo=timezone.utc)
    path = store.write_run(bronze_of(("?", "x", "y", ["CD", "CC"])), str(tmp_path), run, when)
    assert path.endswith(f"tournament_20250304_050607_{run}.parquet")
    loaded = store.read_landing(spark, str(tmp_path))
    assert {r.run_id for r in loaded.collect()} == {run}
    comments = {f.name: f.metadata.get("comment") for f in spark.read.parquet(path).schema}
    assert comments["tour"].startswith("Counts the rounds of a match")


def test_landing_files_are_chosen_by_name(spark, bronze_of, tmp_path):
    days = [datetime(2025, 3, day, tzinfo=timezone.utc) for day in (1, 2, 3)]
    rounds = bronze_of(("?", "x", "y", ["CD", "CC"]))
    paths = [
        store.write_run(rounds, str(tmp_path), run, day)
        for run, day in zip(("aaaa0001", "bbbb0002", "aaaa0001"), days)
    ]

    def found(**limits):
        rows = store.read_landing(spark, str(tmp_path), **limits).collect()
        return sorted({r.run_id for r in rows}), len(rows)

    assert found() == (["aaaa0001", "bbbb0002"], 6)
    # From here on, opening the file in the middle fails.
    for file in Path(paths[1]).glob("*.parquet"):
        file.write_bytes(b"spoiled")
        (file.parent / f".{file.name}.crc").unlink()
    assert found(run_id="aaaa0001") == (["aaaa0001"], 4)
    assert found(until=days[0]) == (["aaaa0001"], 2)
    assert found(since=days[2], until=days[2]) == (["aaaa0001"], 2)
    assert found(run_id="cccc0003") == ([], 0)
    with pytest.raises(Exception, match="spoiled|PARQUET|parquet"):
        found(since=days[1])


def test_build_writes_every_gold_table(spark, bronze_of, tmp_path):
    warehouse = str(tmp_path / "gold")
    bronze = bronze_of(*FULL_MATCHES, ("0042", "x", "x", ["CD", "DD"]))
    silver = silver_rounds(bronze)
    for _ in range(2):  # the second build replaces the first
        build(bronze, warehouse)
        for name in GOLD:
            stored = read_gold(spark, warehouse, name)
            assert rows_of(stored) == rows_of(getattr(gold, name)(silver))
    assert rows_of(spark.table("silver_rounds")) == rows_of(silver)
    summary = read_gold(spark, warehouse, "gold_tournament_summary")
    ranks = [r.ranking for r in saved.in_read_order("gold_tournament_summary", summary).collect()]
    assert ranks == sorted(ranks)


def test_build_by_position(spark, bronze_of, tmp_path):
    path, warehouse = str(tmp_path / "bronze"), str(tmp_path / "gold")
    bronze = bronze_of(*FULL_MATCHES)
    store.append_bronze(bronze, path)
    build(materialise(store.bronze_in_order(spark, path), "b"), warehouse, order="position")
    for name in GOLD:
        expected = getattr(gold, name)(silver_rounds(bronze))
        assert rows_of(read_gold(spark, warehouse, name)) == rows_of(expected)


def test_layer_selection(spark, bronze_of, tmp_path):
    bronze = bronze_of(("r", "x", "y", ["CD"]))
    spark.catalog.dropTempView("silver_rounds")
    build(bronze, str(tmp_path / "a"), select=("silver",))
    assert spark.catalog.tableExists("silver_rounds")
    assert not (tmp_path / "a").exists()
    spark.catalog.dropTempView("silver_rounds")
    build(bronze, str(tmp_path / "b"), select=("gold",))
    assert not spark.catalog.tableExists("silver_rounds")
    assert {p.name for p in (tmp_path / "b").glob("[!_]*")} == set(GOLD)
    with pytest.raises(ValueError):
        build(bronze, str(tmp_path / "c"), select=("copper",))


def test_ingest_reads_each_file_once_and_rebuilds_its_run(spark, bronze_of, tmp_path):
    landing, bronze, warehouse, checkpoint = (
        str(tmp_path / name) for name in ("landing", "bronze", "gold", "checkpoint")
    )

    def pick_up():
        query = ingest_new_runs(spark, landing, bronze, warehouse, checkpoint)
        query.awaitTermination()
        return query.lastProgress

    one = bronze_of(("?", "x", "y", ["CD", "DD", "CC"]))
    two = bronze_of(("?", "x", "z", ["DD", "CD"]))
    store.write_run(one, landing, "run00001")
    pick_up()
    store.write_run(two, landing, "run00002")
    pick_up()
    pick_up()  # nothing new
    folders = [str(p.relative_to(bronze)) for p in Path(bronze).glob("*/*") if p.is_dir()]
    assert all(re.match(r"run_id=run0000[12]/batch=[0-9a-f-]{36}-\d$", f) for f in folders)
    assert sorted(f.rsplit("-", 1)[1] for f in folders) == ["0", "1"]

    # A batch that failed before its commit runs again and replaces what it had stored.
    for commit in (tmp_path / "checkpoint" / "commits").glob("*1*"):
        commit.unlink()
    pick_up()

    rounds = store.read_bronze(spark, bronze)
    assert rounds.count() == 5
    silver = silver_rounds(store.stamp_run(one, "run00001").union(store.stamp_run(two, "run00002")))
    for name in GOLD:
        assert rows_of(read_gold(spark, warehouse, name)) == rows_of(getattr(gold, name)(silver))

    # More rounds of a known run: its gold rows are rebuilt from all of its rounds.
    later = spark.createDataFrame(
        match_rows("?", "x", "z", ["DC"] * 2, tours=[3, 4]), BRONZE
    )
    store.write_run(later, landing, "run00002", datetime(2030, 1, 1, tzinfo=timezone.utc))
    pick_up()
    silver = silver_rounds(store.read_bronze(spark, bronze))
    assert silver.count() == 7
    for name in GOLD:
        assert rows_of(read_gold(spark, warehouse, name)) == rows_of(getattr(gold, name)(silver))


def test_appended_and_ingested_runs_share_a_table(spark, bronze_of, tmp_path):
    landing, bronze, warehouse, checkpoint = (
        str(tmp_path / name) for name in ("landing", "bronze", "gold", "checkpoint")
    )
    store.append_bronze(bronze_of(("a", "x", "y", ["CD", "DD"])), bronze)
    build(store.read_bronze(spark, bronze), warehouse, select=("gold",))
    store.write_run(bronze_of(("?", "x", "y", ["CC"])), landing, "run00001")
    ingest_new_runs(spark, landing, bronze, warehouse, checkpoint).awaitTermination()
    store.append_bronze(bronze_of(("c", "x", "y", ["DD"])), bronze)
    summary = read_gold(spark, warehouse, "gold_tournament_summary")
    assert {r.run_id for r in summary.collect()} == {"a", "run00001"}
    build(store.read_bronze(spark, bronze), warehouse, select=("gold",))
    for name in ("gold_tournament_summary", "gold_matchup_matrix"):
        found = {r.run_id for r in read_gold(spark, warehouse, name).collect()}
        assert found == {"a", "run00001", "c"}


@pytest.mark.parametrize("order", ["tour", "position"])
def test_a_rebuilt_run_leaves_no_stale_rows(spark, bronze_of, tmp_path, order):
    bronze, warehouse = str(tmp_path / "bronze"), str(tmp_path / "gold")
    store.append_bronze(bronze_of(("a b=c", "x", "y", ["CD", "CC"])), bronze, "first")
    store.append_bronze(bronze_of(("k", "x", "y", ["CD", "CC"])), bronze, "second")
    build(store.read_bronze(spark, bronze), warehouse, select=("gold",))
    # The batch comes again with one round only, which no round follows.
    store.append_bronze(bronze_of(("a b=c", "x", "y", ["CD"])), bronze, "first")
    runs = store.runs_of_batch(spark, bronze, "first")
    rebuild_runs(spark, bronze, runs, warehouse, order)
    index = read_gold(spark, warehouse, "gold_forgiveness_index")
    assert {r.run_id for r in index.collect()} == {"k"}
    matrix = read_gold(spark, warehouse, "gold_matchup_matrix")
    assert {r.run_id for r in matrix.collect()} == {"a b=c", "k"}


def test_saved_queries(bronze_of):
    silver = silver_rounds(bronze_of(("a", "x", "y", ["CD", "CC"]), ("b", "y", "x", ["DD"])))
    summary, matrix = gold.gold_tournament_summary(silver), gold.gold_matchup_matrix(silver)
    drift, index = gold.gold_behavioral_drift(silver), gold.gold_forgiveness_index(silver)
    assert [r.ranking for r in saved.final_ranking(summary).collect()] == [1, 1, 1, 2]
    assert [tuple(r) for r in saved.matchup_lookup(matrix, "x").collect()] == [
        ("x", "y", 3, 8, "y")
    ]
    assert {tuple(r) for r in saved.strategy_drift(drift, "y").collect()} == {
        (100, 50.0),
        (100, 0.0),
    }
    assert [r.strategy for r in saved.forgiveness_ranking(index).collect()] == ["x", "y"]
    assert [r.run_id for r in saved.run_comparison(summary).collect()] == ["a", "a", "b", "b"]


def test_scratch_folder_is_the_sessions(spark):
    assert scratch_dir(spark) == spark.conf.get("spark.checkpoint.dir").rstrip("/")


def test_gold_tables_in_the_catalog(spark, bronze_of, tmp_path):
    warehouse = str(tmp_path / "gold")
    build(bronze_of(*FULL_MATCHES, ("0042", "x", "y", ["CD", "DD"])), warehouse)
    register_gold(spark, warehouse)
    ranking = spark.sql(
        "SELECT strategy, total_score, cooperation_rate_pct, ranking "
        "FROM gold_tournament_summary WHERE run_id = 'r' ORDER BY ranking"
    )
    assert [r.strategy for r in ranking.collect()] == ["D", "T", "C"]
    for name in GOLD:
        assert spark.table(name).count() == read_gold(spark, warehouse, name).count()
    facts = spark.sql("DESCRIBE TABLE EXTENDED gold_tournament_summary").collect()
    shown = {r.col_name: (r.data_type, r.comment) for r in facts}
    assert shown["Comment"][0] == "Leaderboard of each run"
    assert shown["ranking"][1].startswith("Place by total score")
    for name in GOLD:
        spark.sql(f"DROP TABLE {name}")


def test_other_tables_of_the_same_name_survive(spark, bronze_of, tmp_path):
    build(bronze_of(("r", "x", "y", ["CD"])), str(tmp_path / "gold"), select=("gold",))
    spark.sql("CREATE DATABASE IF NOT EXISTS mine")
    spark.range(3).write.mode("overwrite").saveAsTable("mine.gold_matchup_matrix")
    with pytest.raises(ValueError):
        register_gold(spark, str(tmp_path / "gold"), "mine")
    assert spark.table("mine.gold_matchup_matrix").count() == 3
    spark.sql("DROP TABLE mine.gold_matchup_matrix")
    for _ in range(2):
        register_gold(spark, str(tmp_path / "gold"), "mine")
    assert spark.table("mine.gold_matchup_matrix").count() == 1
    with pytest.raises(ValueError):
        register_gold(spark, str(tmp_path / "elsewhere"), "mine")
    spark.sql("DROP DATABASE mine CASCADE")


def test_lasting_silver_view(spark, bronze_of, tmp_path):
    path = str(tmp_path / "bronze")
    bronze = bronze_of(*FULL_MATCHES[:1], ("1999", "x", "x", ["CD", "-D", "C-"]))
    store.append_bronze(bronze, path)
    spark.catalog.dropTempView("silver_rounds")
    spark.sql("CREATE DATABASE IF NOT EXISTS lasting")
    register_silver(spark, path, "lasting")
    assert not spark.catalog.getTable("lasting.silver_rounds").isTemporary
    view = spark.table("lasting.silver_rounds")
    assert view.columns == SILVER.names
    assert rows_of(view) == rows_of(silver_rounds(bronze))
    spark.sql("DROP DATABASE lasting CASCADE")


def test_every_column_is_described():
    for schema in (BRONZE, SILVER, *GOLD.values()):
        assert all(COLUMN_COMMENTS[name] for name in schema.names)


def test_rounds_of_named_runs(bronze_of):
    bronze = bronze_of(("a", "x", "y", ["CD"]), ("b", "x", "y", ["CC"]), (None, "x", "y", ["DD"]))
    for wanted in ([("a",)], [("a",), (None,)], [(None,)], []):
        runs = bronze.sparkSession.createDataFrame(wanted, "run_id string")
        got = {r.run_id for r in store.runs_only(bronze, runs).collect()}
        assert got == {run for (run,) in wanted}


def test_scratch_tables_are_removed(spark):
    path = Path(scratch_dir(spark))
    before = {p.name for p in path.iterdir()}
    with scratch_table(spark.range(3).toDF("n"), "short-lived") as table:
        assert table.count() == 3
        assert {p.name for p in path.iterdir()} != before
    assert {p.name for p in path.iterdir()} == before


def test_command_line(spark, bronze_of, tmp_path, capsys):
    path, warehouse = str(tmp_path / "bronze"), str(tmp_path / "gold")
    store.append_bronze(bronze_of(("a", "x", "y", ["CD", "CC"])), path)
    assert main(["run", "--bronze", path, "--warehouse", warehouse, "--select", "gold"]) == 0
    assert not spark.catalog.tableExists("tournament_bronze")
    spark.catalog.dropTempView("silver_rounds")
    assert main(["run", "--bronze", path, "--warehouse", "-", "--select", "silver"]) == 0
    assert spark.table("silver_rounds").count() == 2
    spark.sql("DROP VIEW silver_rounds")
    spark.sql("DROP TABLE tournament_bronze")
    assert main(["test", "--bronze", path, "--run-id-chars", "8"]) == 1
    capsys.readouterr()
    assert read_gold(spark, warehouse, "gold_tournament_summary").count() == 2
    assert main(["test", "--bronze", path]) == 0
    assert "unique_round: 0 of 2" in capsys.readouterr().out
    store.append_bronze(bronze_of(("a", "x", "y", ["CD"])), path)
    assert main(["test", "--bronze", path]) == 1
    assert "unique_round: 1 of 2" in capsys.readouterr().out
    store.write_run(bronze_of(("?", "x", "y", ["CD"])), str(tmp_path / "landing"), "run00001")
    folders = {name: str(tmp_path / name) for name in ("landing", "ingested", "rebuilt", "chk")}
    arguments = ["--landing", folders["landing"], "--bronze", folders["ingested"]]
    arguments += ["--warehouse", folders["rebuilt"], "--checkpoint", folders["chk"]]
    assert main(["ingest", *arguments]) == 0
    assert read_gold(spark, folders["rebuilt"], "gold_matchup_matrix").count() == 1
