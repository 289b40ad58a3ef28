"""Batches merged to stored state, published at once; repeated rounds; versions joined."""

import random
import re
from datetime import datetime, timedelta, timezone
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from tests.rounds import match_rows
from tests.test_plans import plan_of
from tourney.plans import gold
from tourney.plans.build import STORED, build, read_gold, tidy
from tourney.plans.silver import silver_rounds
from tourney.schema import BRONZE, GOLD
from tourney.session import materialise
from tourney.sources import bronze as store
from tourney.sources import versions
from tourney.streaming import ingest
from tourney.streaming.ingest import ingest_new_runs, load_batch

MOVES = ["CC", "CD", "DC", "DD", "-D", "C-"]


def rows_of(df):
    return sorted(map(repr, df.collect()))


def gold_rows(spark, warehouse):
    return {name: rows_of(read_gold(spark, warehouse, name)) for name in GOLD}


def full_rows(spark, bronze):
    silver = silver_rounds(store.read_bronze(spark, bronze))
    return {name: rows_of(getattr(gold, name)(silver)) for name in GOLD}


def frame(spark, rows):
    return spark.createDataFrame(rows, BRONZE)


@pytest.fixture
def folders(tmp_path):
    return {n: str(tmp_path / n) for n in ("landing", "bronze", "gold", "checkpoint")}


@pytest.fixture
def small_blocks(monkeypatch):
    """Blocks of eight rounds, in the tables and in their stored state."""
    for module in (gold, ingest, store):
        monkeypatch.setattr(module, "BLOCK_BITS", 3)
    for function in (gold.answers_in_blocks, gold.answers_per_match):
        defaults = list(function.__defaults__)
        defaults[-1] = 3
        monkeypatch.setattr(function, "__defaults__", tuple(defaults))


def spoil(folder, keep=()):
    """Make every data file below unreadable, but for those with one of ``keep`` in their path."""
    for path in Path(folder).rglob("*.parquet"):
        if path.is_file() and not any(part in str(path) for part in keep):
            path.write_bytes(b"spoiled")
            (path.parent / f".{path.name}.crc").unlink(missing_ok=True)


@pytest.mark.parametrize("seed", range(2))
def test_batches_equal_a_full_build(spark, folders, small_blocks, seed):
    """Rounds of several matches arrive in any order, some blocks in several batches."""
    draw = random.Random(seed)
    rows = []
    for run, a, b in (("r", "x", "y"), ("r", "y", None), ("s", "x", "x"), (None, "x", "y")):
        count = draw.randrange(5, 60)
        tours = sorted(draw.sample(range(-20, 150), count))
        rows += match_rows(run, a, b, draw.choices(MOVES, k=count), tours)
    if seed:
        draw.shuffle(rows)
    size = len(rows) // 3 + 1
    for number in range(3):
        part = frame(spark, rows[number * size : (number + 1) * size])
        load_batch(part, f"b{number}", folders["bronze"], folders["gold"])
    assert gold_rows(spark, folders["gold"]) == full_rows(spark, folders["bronze"])
    assert store.read_bronze(spark, folders["bronze"]).count() == len(rows)
    assert store.read_rejects(spark, folders["bronze"]).isEmpty()


def test_a_batch_reads_its_own_rounds_and_states_only(spark, folders):
    early = match_rows("r", "x", "y", ["CD", "DD", "DC"]) + match_rows("s", "x", "y", ["CC", "DC"])
    late = match_rows("r", "x", "y", ["CC", "DC", "CC"], tours=[4, 5, 6])
    load_batch(frame(spark, early), "first", folders["bronze"], folders["gold"])
    late = [(*row[:8], row[8] + 6, row[9] + 6) for row in late]
    both = frame(spark, early + late)
    expected = {n: rows_of(getattr(gold, n)(silver_rounds(both))) for n in GOLD}
    # The stored rounds, the states of the other run, and all old gold rows cannot be read.
    spoil(folders["bronze"])
    full = {}
    for table in STORED:
        keep = ("run_id=r",) if table.startswith("_state") else ()
        kept = {p: p.read_bytes() for p in Path(folders["gold"], table).rglob("*.parquet") if p.is_file()}
        spoil(Path(folders["gold"], table), keep)
        full |= kept
    load_batch(frame(spark, late), "second", folders["bronze"], folders["gold"])
    for path, data in full.items():
        path.write_bytes(data)
    assert gold_rows(spark, folders["gold"]) == expected


def test_readers_keep_the_old_state_when_a_job_fails(spark, folders, monkeypatch):
    rows = match_rows("r", "x", "y", ["CD", "DD", "DC"])
    load_batch(frame(spark, rows), "first", folders["bronze"], folders["gold"])
    before = gold_rows(spark, folders["gold"])
    reader = read_gold(spark, folders["gold"], "gold_matchup_matrix")
    more = frame(spark, match_rows("r", "x", "z", ["DD"]) + match_rows("t", "x", "y", ["CC"]))

    def broken(scores):
        return scores.withColumn("run_id", F.raise_error(F.lit("lost")).cast("string"))

    with monkeypatch.context() as patch:
        patch.setattr(gold, "spread_index", broken)
        with pytest.raises(Exception, match="lost"):
            load_batch(more, "second", folders["bronze"], folders["gold"], applied={"q": 1})
    assert gold_rows(spark, folders["gold"]) == before
    with monkeypatch.context() as patch:
        patch.setattr(versions, "write_new", lambda *_: False)
        with pytest.raises(versions.Conflict):
            load_batch(more, "second", folders["bronze"], folders["gold"], applied={"q": 1})
    assert gold_rows(spark, folders["gold"]) == before
    # The batch runs again: its rounds are stored once, and count once.
    load_batch(more, "second", folders["bronze"], folders["gold"], applied={"q": 1})
    assert store.read_bronze(spark, folders["bronze"]).count() == 5
    assert gold_rows(spark, folders["gold"]) == full_rows(spark, folders["bronze"])
    assert versions.last_commit(spark, folders["gold"]).applied == {"q": 1}
    assert rows_of(reader) == before["gold_matchup_matrix"]


def test_two_jobs_from_one_commit(spark, folders):
    rows = frame(spark, match_rows("r", "x", "y", ["CD"]))
    load_batch(rows, "first", folders["bronze"], folders["gold"])
    late = versions.Draft(spark, folders["gold"])
    build(store.read_bronze(spark, folders["bronze"]), folders["gold"], select=("gold",))
    with pytest.raises(versions.Conflict):
        late.mark_applied({"q": 0})
    # An unfinished commit file does not count.
    number = versions.last_commit(spark, folders["gold"]).number
    Path(folders["gold"], "_commits", f"{number + 1:012d}.json").write_text('{"manifest"')
    assert versions.last_commit(spark, folders["gold"]).number == number


def test_repeated_and_clashing_rounds_are_rejected(spark, folders):
    rows = match_rows("r", "x", "y", ["CD", "DD", "DC", "CC"])
    load_batch(frame(spark, rows[:3] + rows[1:2] * 2), "a", folders["bronze"], folders["gold"])
    before = gold_rows(spark, folders["gold"])
    other = [(*rows[0][:4], "DEFECT", *rows[0][5:])]
    for _ in range(2):  # the second time as after a restart that lost the commit
        load_batch(frame(spark, rows[:2] * 2 + other), "b", folders["bronze"], folders["gold"])
        assert gold_rows(spark, folders["gold"]) == before
    rejects = store.read_rejects(spark, folders["bronze"])
    found = {(r.batch, r.tour, r.reason, r.copies) for r in rejects.collect()}
    assert found == {
        ("a", 2, "repeated", 2),
        ("b", 1, "repeated", 2),
        ("b", 2, "repeated", 2),
        ("b", 1, "clashing", 1),
    }
    new_clash = [rows[3], (*rows[3][:4], "DEFECT", *rows[3][5:])]
    load_batch(frame(spark, new_clash), "c", folders["bronze"], folders["gold"])
    stored = store.read_bronze(spark, folders["bronze"])
    assert rows_of(stored) == rows_of(frame(spark, rows))
    assert gold_rows(spark, folders["gold"]) == full_rows(spark, folders["bronze"])


def test_a_batch_is_judged_in_one_shuffle(spark):
    rows = match_rows("r", "x", "y", ["CD", "DD", "DC"])
    incoming = materialise(frame(spark, rows), "judged-incoming")
    stored = materialise(frame(spark, rows[:1]), "judged-stored")
    plan = plan_of(ingest._judged(incoming, stored))
    assert plan.count("Exchange hashpartitioning") == 1
    assert not re.search("Join|Aggregate", plan)


def test_ingest_after_a_restart(spark, folders, bronze_of):
    def pick_up():
        arguments = (folders[n] for n in ("landing", "bronze", "gold", "checkpoint"))
        ingest_new_runs(spark, *arguments).awaitTermination()

    when = datetime(2030, 1, 1, tzinfo=timezone.utc)
    rounds = bronze_of(("?", "x", "y", ["CD", "DD", "CC"]))
    for day in range(3):  # the same rounds delivered three times
        store.write_run(rounds, folders["landing"], "run00001", when + timedelta(days=day))
        pick_up()
    # The stream forgets that it has finished its last batch; the tables have not.
    for commit in Path(folders["checkpoint"], "commits").glob("*2*"):
        commit.unlink()
    number = versions.last_commit(spark, folders["gold"]).number
    pick_up()
    assert versions.last_commit(spark, folders["gold"]).number == number
    assert store.read_bronze(spark, folders["bronze"]).count() == 3
    rejects = store.read_rejects(spark, folders["bronze"])
    assert rejects.agg(F.sum("copies")).first()[0] == 6
    assert gold_rows(spark, folders["gold"]) == full_rows(spark, folders["bronze"])


def test_versions_are_joined_under_a_reader(spark, folders):
    rows = [match_rows(f"r{i}", "x", "y", ["CD", "DC", "CC"]) for i in range(3)]
    for number, part in enumerate(rows):
        load_batch(frame(spark, part), f"b{number}", folders["bronze"], folders["gold"])
    before = gold_rows(spark, folders["gold"])
    reader = read_gold(spark, folders["gold"], "gold_matchup_matrix")
    assert tidy(spark, folders["gold"], hours=1) == 0  # readers may still need the old folders
    assert rows_of(reader) == before["gold_matchup_matrix"]
    assert gold_rows(spark, folders["gold"]) == before
    assert tidy(spark, folders["gold"], hours=0) == 4 * len(STORED)
    for table in STORED:
        assert len(list(Path(folders["gold"], table).glob("version=*"))) == 1
    assert gold_rows(spark, folders["gold"]) == before
    # Later batches merge to the joined state.
    late = match_rows("r0", "x", "z", ["DD"]) + match_rows("r9", "x", "y", ["CC"])
    load_batch(frame(spark, late), "late", folders["bronze"], folders["gold"])
    assert gold_rows(spark, folders["gold"]) == full_rows(spark, folders["bronze"])


def test_state_by_position_takes_no_batch(spark, folders):
    rows = match_rows("r", "x", "y", ["CD", "DD", "DC"], tours=[1, 10**12, 10**15])
    for order in ("position", "tour"):
        load_batch(
            frame(spark, rows[:2] if order == "position" else rows[2:]),
            order, folders["bronze"], folders["gold"], order=order,
        )
        assert gold_rows(spark, folders["gold"]) == full_rows(spark, folders["bronze"])
