"""Blocks put in order level by level, and ranks spread over blocks."""

import random
import re

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

import naive
from tests.test_plans import plan_of
from tourney.operators import blocks
from tourney.operators.blocks import levels_above
from tourney.operators.history import over_history
from tourney.operators.ordering import rank_by_blocks, rank_by_window
from tourney.plans import gold, quality
from tourney.plans.silver import silver_rounds
from tourney.schema import BRONZE, MATCH
from tests.rounds import match_rows

MOVES = ["CC", "CD", "DC", "DD", "-D", "C-"]


@pytest.fixture
def few_blocks(monkeypatch):
    """Windows of at most four blocks over order values of twelve bits."""
    monkeypatch.setattr(blocks, "FAN_BITS", 2)
    monkeypatch.setattr(gold, "FAN_BITS", 2)
    monkeypatch.setattr(blocks, "ORDER_BITS", 12)


def rows_of(df, columns=None):
    return sorted(map(repr, df.select(*(columns or df.columns)).collect()))


def rounds_of(spark, seed):
    draw = random.Random(seed)
    rows = []
    for a, b in (("x", "y"), ("x", None), ("y", "x")):
        tours = sorted(draw.sample(range(-700, 2000), 150))
        rows += match_rows("r", a, b, draw.choices(MOVES, k=len(tours)), tours)
    return spark.createDataFrame(rows, BRONZE)


def test_number_of_levels():
    assert [levels_above(bits) for bits in (50, 34, 33, 17, 6)] == [0, 0, 1, 1, 2]
    assert [levels_above(17, bits) for bits in (14, 34, 35, 64)] == [0, 0, 1, 2]


@pytest.mark.parametrize("block_bits", [1, 3, 6])
def test_many_levels_equal_whole_matches(spark, few_blocks, block_bits):
    bronze = rounds_of(spark, block_bits)
    assert levels_above(block_bits) >= 2
    found = over_history(
        bronze,
        moves={"last_a": "choice_a"},
        previous="tour_before",
        before={"won_before": "gain_a"},
        so_far={"won": "gain_a"},
        block_bits=block_bits,
    )
    match = Window.partitionBy(*MATCH).orderBy("tour")
    earlier = match.rowsBetween(Window.unboundedPreceding, -1)
    plain = bronze.select(
        "*",
        F.lag("choice_a").over(match).alias("last_a"),
        F.lag("tour").over(match).alias("tour_before"),
        F.sum("gain_a").over(earlier).alias("won_before"),
        F.sum("gain_a").over(match.rowsBetween(Window.unboundedPreceding, 0)).alias("won"),
    )
    assert rows_of(found, plain.columns) == rows_of(plain)
    silver = silver_rounds(bronze)
    index = gold.gold_forgiveness_index(silver, block_bits=block_bits)
    assert rows_of(index) == rows_of(naive.forgiveness(silver))
    report = quality.dq_report(bronze, block_bits=block_bits)
    assert rows_of(report) == rows_of(quality.dq_report(bronze, block_bits=40))


def test_very_sparse_tours_stay_in_small_windows(spark):
    """200,000 rounds of one match, a million tours apart: one round to a block."""
    count, apart = 200_000, 1_000_000
    rounds = spark.range(count).select(
        F.lit("r").alias("run_id"),
        (F.col("id") * apart).alias("tour"),
        F.lit("x").alias("player_a"),
        F.lit("y").alias("player_b"),
        F.when(F.col("id") % 3 == 0, "DEFECT").otherwise("COOPERATE").alias("choice_a"),
        F.lit("COOPERATE").alias("choice_b"),
        F.lit(1).cast("bigint").alias("gain_a"),
    )
    found = over_history(rounds, moves={"last_a": "choice_a"}, so_far={"won": "gain_a"})
    wrong = found.where(
        (F.col("won") * apart != F.col("tour") + apart)
        | (
            (F.col("tour") > 0)
            & (F.col("last_a") != F.when(F.col("won") % 3 == 2, "DEFECT").otherwise("COOPERATE"))
        )
    )
    assert wrong.isEmpty() and found.count() == count
    index = gold.forgiveness_index(rounds).collect()
    assert [(r.strategy, r.total_betrayals_received) for r in index if r.strategy == "y"] == [
        ("y", (count - 1 + 2) // 3)
    ]
    # Of the tours, 17 bits belong to a block and 17 to a group of blocks.
    groups = rounds.groupBy(F.shiftright("tour", 34)).agg(
        F.countDistinct(F.shiftright("tour", 17)).alias("blocks")
    )
    assert groups.agg(F.max("blocks")).first()[0] <= 1 << 17 < count
    for df in (found, gold.forgiveness_index(rounds)):
        windows = re.findall(r"Window \[[^\n]*\], \[([^\]]*)\], \[([^\]]*)\]", plan_of(df))
        assert windows
        for keys, _ in windows:
            assert "block" in keys or "run_id" in keys


@pytest.mark.parametrize("block_bits", [0, 2, 17])
def test_spread_rank_equals_rank(spark, few_blocks, block_bits):
    draw = random.Random(block_bits)
    scores = [None, 0, -3, 5, 5, 700, 2**40, -(2**40)]
    rows = [(run, i, draw.choice(scores)) for run in ("a", "b", None) for i in range(60)]
    rows += [("a", 100 + i, draw.randrange(900)) for i in range(200)]
    rows += [("c", 0, None)]
    table = spark.createDataFrame(rows, "run_id string, strategy int, score bigint")
    if block_bits != 17:
        table = table.where("abs(score) < 1000 OR score IS NULL")
    found = rank_by_blocks(table, "run_id", "score", "place", block_bits=block_bits)
    assert rows_of(found) == rows_of(rank_by_window(table, "run_id", "score", "place"))


def test_spread_rank_of_rates(spark):
    rows = [("a", i, round(i * 7 % 1000 / 7, 2)) for i in range(500)] + [("a", -1, None)]
    table = spark.createDataFrame(rows, "run_id string, strategy int, rate double")
    found = rank_by_blocks(table, "run_id", "rate", "place", scale=100)
    assert rows_of(found) == rows_of(rank_by_window(table, "run_id", "rate", "place"))


def test_a_run_of_a_million_strategies(spark):
    table = spark.range(1_000_000).select(
        F.lit("r").alias("run_id"),
        F.col("id").alias("strategy"),
        # Half of all share one score; the others have scores of their own.
        F.when(F.col("id") % 2 == 0, F.lit(9)).otherwise(F.col("id") * 37 % 1_000_003).alias("score"),
    )
    found = rank_by_blocks(table, "run_id", "score", "place")
    plan = plan_of(found)
    assert not re.search(r"Window \[[^\n]*\], \[run_id#\d+\], ", plan)
    both = found.join(
        rank_by_window(table, "run_id", "score", "plain").select("strategy", "plain"), "strategy"
    )
    assert both.where("place != plain").isEmpty() and both.count() == 1_000_000
