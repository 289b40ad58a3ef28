"""Gold layer: leaderboard, match matrix, behavioural drift and forgiveness index.

Rounds are read once per table and folded map-side into per-match (or per-bucket) totals holding
both sides; only those small totals are turned into one row per side.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tourney.functions.rounds import (
    COOPERATED,
    DEFECTED,
    UNKNOWN_MOVE,
    flag,
    matchup_id,
    move_code,
    rate_pct,
    winner,
)
from tourney.operators.blocks import FAN_BITS, block_of, levels_above
from tourney.operators.history import BLOCK_BITS
from tourney.operators.ordering import rank_by_blocks, rank_by_window
from tourney.operators.sides import unpivot_sides
from tourney.schema import GOLD, MATCH

# The match key in its one-column form follows from the players, so rounds are grouped without it.
PER_MATCH = MATCH
PER_BUCKET = (*MATCH, "tour_bucket")

_SUMS = (
    "tours",
    "gain_a",
    "gain_b",
    "cooperated_a",
    "cooperated_b",
    "defected_a",
    "defected_b",
    "exploitation_by_a",
    "exploitation_by_b",
)
_FINALS = ("cumul_a", "cumul_b")
TOTAL_COLUMNS = (*_SUMS, *_FINALS)


def totals(silver: DataFrame, keys: tuple[str, ...]) -> DataFrame:
    """Sums and final scores of both sides per ``keys``."""
    return roll_up(silver.withColumn("tours", F.lit(1)), keys)


def roll_up(partial: DataFrame, keys: tuple[str, ...]) -> DataFrame:
    """Combine totals into coarser ones; column names stay the same."""
    rolled = partial.groupBy(*keys).agg(
        *[F.sum(c).alias(c) for c in _SUMS], *[F.max(c).alias(c) for c in _FINALS]
    )
    return rolled.withColumn("matchup_id", matchup_id())


def tournament_summary(match_totals: DataFrame) -> DataFrame:
    ranked = rank_by_window(strategy_scores(match_totals), "run_id", "total_score", "ranking")
    return ranked.select(*GOLD["gold_tournament_summary"].names)


def spread_summary(scores: DataFrame) -> DataFrame:
    """The leaderboard from stored ``strategy_scores``, with no task that ranks a whole run."""
    ranked = rank_by_blocks(scores, "run_id", "total_score", "ranking")
    return ranked.select(*GOLD["gold_tournament_summary"].names)


def spread_index(scores: DataFrame) -> DataFrame:
    """The index from stored ``forgiveness_scores``; its rates have two decimals."""
    ranked = rank_by_blocks(
        scores, "run_id", "forgiveness_index_pct", "forgiveness_rank", scale=100, order_bits=14
    )
    return ranked.select(*GOLD["gold_forgiveness_index"].names)


def strategy_scores(match_totals: DataFrame) -> DataFrame:
    """The leaderboard without ranks."""
    sides = unpivot_sides(
        match_totals,
        ["run_id", "matchup_id", "tours"],
        {
            "strategy": ("player_a", "player_b"),
            "score_as_a": ("cumul_a", F.lit(None).cast("bigint")),
            "score_as_b": (F.lit(None).cast("bigint"), "cumul_b"),
            "cooperations": ("cooperated_a", "cooperated_b"),
            "defections": ("defected_a", "defected_b"),
            "exploitations": ("exploitation_by_a", "exploitation_by_b"),
        },
    )
    # One row per strategy and match, also when a strategy meets itself; the final score counts
    # once per side.
    counts = ("tours", "cooperations", "defections", "exploitations")
    per_matchup = sides.groupBy("run_id", "strategy", "matchup_id").agg(
        F.max("score_as_a").alias("score_as_a"),
        F.max("score_as_b").alias("score_as_b"),
        *[F.sum(c).alias(c) for c in counts],
    )
    as_a, as_b = F.sum("score_as_a"), F.sum("score_as_b")
    return (
        per_matchup.groupBy("run_id", "strategy")
        .agg(
            F.coalesce(as_a + as_b, as_a, as_b).alias("total_score"),
            rate_pct(F.sum("cooperations"), F.sum("tours")).alias("cooperation_rate_pct"),
            F.sum("cooperations").alias("total_cooperations"),
            F.sum("defections").alias("total_defections"),
            F.sum("exploitations").alias("total_exploitations"),
            F.count("matchup_id").alias("nb_matchups"),
        )
    )


def matchup_matrix(match_totals: DataFrame) -> DataFrame:
    return match_totals.select(
        *MATCH,
        "matchup_id",
        F.col("cumul_a").alias("final_score_a"),
        F.col("cumul_b").alias("final_score_b"),
        rate_pct(F.col("cooperated_a"), F.col("tours")).alias("cooperation_rate_a_pct"),
        rate_pct(F.col("cooperated_b"), F.col("tours")).alias("cooperation_rate_b_pct"),
        F.col("exploitation_by_a").alias("exploitations_by_a"),
        F.col("exploitation_by_b").alias("exploitations_by_b"),
        winner("cumul_a", "cumul_b").alias("match_winner"),
    )


def behavioral_drift(bucket_totals: DataFrame) -> DataFrame:
    sides = unpivot_sides(
        bucket_totals,
        ["run_id", "matchup_id", "tour_bucket", "tours"],
        {
            "strategy": ("player_a", "player_b"),
            "opponent": ("player_b", "player_a"),
            "cooperations": ("cooperated_a", "cooperated_b"),
            "total_gain": ("gain_a", "gain_b"),
            "exploitations_done": ("exploitation_by_a", "exploitation_by_b"),
            "exploitations_received": ("exploitation_by_b", "exploitation_by_a"),
        },
    )
    rate = rate_pct(F.col("cooperations"), F.col("tours"))
    return sides.withColumn("cooperation_rate_pct", rate).select(
        *GOLD["gold_behavioral_drift"].names
    )


def _answers(faced: Column, move: Column) -> dict[str, Column]:
    """What a move says about forgiveness, given the opponent move before it."""
    betrayed = faced == DEFECTED
    return {
        "answers": faced > UNKNOWN_MOVE,
        "betrayals": betrayed,
        "forgiven": betrayed & (move == COOPERATED),
    }


_SIDES = (("a", "b"), ("b", "a"))
_COUNTS = [f"{name}_{side}" for name in ("answers", "betrayals", "forgiven") for side in "ab"]

# What is kept of a stretch of rounds: its counts and its ends.
SEGMENT = ("first_order", "last_order", "first_a", "first_b", "last_a", "last_b", *_COUNTS)


def answers_in_blocks(
    rounds: DataFrame, order: str = "tour", block_bits: int = BLOCK_BITS
) -> DataFrame:
    """One segment per match and block: counts of the answers within it, first and last moves.

    Rounds are read and shuffled once. The previous round is the previous recorded one, whatever its
    number, so the pairs of rounds that span two segments are added when they are put together.
    """
    moves = rounds.select(
        *MATCH,
        block_of(order, block_bits).alias("block"),
        F.col(order).cast("bigint").alias("order"),
        move_code("choice_a").alias("move_a"),
        move_code("choice_b").alias("move_b"),
    )
    within = Window.partitionBy(*MATCH, "block").orderBy("order")
    in_block = moves.select(
        *MATCH,
        "block",
        "order",
        "move_a",
        "move_b",
        F.lag("move_a").over(within).alias("before_a"),
        F.lag("move_b").over(within).alias("before_b"),
        F.lead("move_a").over(within).isNull().alias("is_last"),
    )
    return in_block.groupBy(*MATCH, "block").agg(
        F.min("order").alias("first_order"),
        F.max("order").alias("last_order"),
        *[
            F.max(F.when(edge, F.col(f"move_{side}"))).alias(f"{name}_{side}")
            for name, edge in (("first", F.col("before_a").isNull()), ("last", F.col("is_last")))
            for side in "ab"
        ],
        *[
            F.count_if(met).alias(f"{name}_{mine}")
            for mine, theirs in _SIDES
            for name, met in _answers(F.col(f"before_{theirs}"), F.col(f"move_{mine}")).items()
        ],
    )


def joined_segments(segments: DataFrame, keys: Sequence[str], order: str) -> DataFrame:
    """One segment per ``keys`` of those that follow each other in ``order`` without overlap."""
    across = Window.partitionBy(*keys).orderBy(order)
    met = segments.select(
        "*",
        F.lag("last_a").over(across).alias("entered_a"),
        F.lag("last_b").over(across).alias("entered_b"),
        F.lead("last_a").over(across).isNull().alias("is_last"),
    )
    return met.groupBy(*keys).agg(
        F.min("first_order").alias("first_order"),
        F.max("last_order").alias("last_order"),
        *[
            F.max(F.when(F.col("entered_a").isNull(), F.col(f"first_{s}"))).alias(f"first_{s}")
            for s in "ab"
        ],
        *[F.max(F.when(F.col("is_last"), F.col(f"last_{s}"))).alias(f"last_{s}") for s in "ab"],
        *[
            F.sum(F.col(f"{name}_{mine}") + flag(found)).alias(f"{name}_{mine}")
            for mine, theirs in _SIDES
            for name, found in _answers(
                F.col(f"entered_{theirs}"), F.col(f"first_{mine}")
            ).items()
        ],
    )


def answers_per_match(blocks: DataFrame, block_bits: int = BLOCK_BITS) -> DataFrame:
    """The segments of each match put together, a range of blocks at a time."""
    for _ in range(levels_above(block_bits)):
        groups = blocks.withColumn("block_group", F.shiftright("block", FAN_BITS))
        blocks = joined_segments(groups, (*MATCH, "block_group"), "block")
        blocks = blocks.withColumnRenamed("block_group", "block")
    return joined_segments(blocks, MATCH, "block")


def forgiveness_index(
    rounds: DataFrame, order: str = "tour", block_bits: int = BLOCK_BITS
) -> DataFrame:
    """Share of rounds right after an opponent's defection in which the strategy cooperates.

    Rounds whose previous opponent move is unknown do not count, and a strategy with no other rounds
    has no row. Matches are cut into blocks of rounds, so that a long one is not sorted in one task,
    and the blocks are put together level by level.
    """
    blocks = answers_in_blocks(rounds, order, block_bits)
    scores = forgiveness_scores(answers_per_match(blocks, block_bits))
    ranked = rank_by_window(scores, "run_id", "forgiveness_index_pct", "forgiveness_rank")
    return ranked.select(*GOLD["gold_forgiveness_index"].names)


def forgiveness_scores(per_match: DataFrame) -> DataFrame:
    """The index of every strategy without ranks."""
    sides = unpivot_sides(
        per_match,
        ["run_id"],
        {
            "strategy": ("player_a", "player_b"),
            "answers": ("answers_a", "answers_b"),
            "betrayals": ("betrayals_a", "betrayals_b"),
            "forgiven": ("forgiven_a", "forgiven_b"),
        },
    )
    return (
        sides.where(F.col("answers") > 0)
        .groupBy("run_id", "strategy")
        .agg(
            F.sum("betrayals").alias("total_betrayals_received"),
            F.sum("forgiven").alias("total_forgiven"),
            rate_pct(F.sum("forgiven"), F.sum("betrayals")).alias("forgiveness_index_pct"),
        )
    )


def gold_tournament_summary(silver: DataFrame) -> DataFrame:
    return tournament_summary(totals(silver, PER_MATCH))


def gold_matchup_matrix(silver: DataFrame) -> DataFrame:
    return matchup_matrix(totals(silver, PER_MATCH))


def gold_behavioral_drift(silver: DataFrame) -> DataFrame:
    return behavioral_drift(totals(silver, PER_BUCKET))


gold_forgiveness_index = forgiveness_index
