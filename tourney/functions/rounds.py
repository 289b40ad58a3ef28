"""Column expressions over one round."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tourney.schema import COOPERATE, DEFECT, DRAW, PAYOFF, TOURS_PER_BUCKET


def flag(condition: Column) -> Column:
    """1 where the condition holds, 0 where it is false or unknown."""
    return F.when(condition, 1).otherwise(0)


def cooperated(choice: str) -> Column:
    return F.col(choice) == COOPERATE


def defected(choice: str) -> Column:
    return F.col(choice) == DEFECT


# Moves as numbers, so that summaries of rounds stay in hash aggregates.
UNKNOWN_MOVE, OTHER_MOVE, COOPERATED, DEFECTED = 0, 1, 2, 3


def move_code(choice: str) -> Column:
    """0 for a missing move, 2 and 3 for the two moves, 1 for any other text."""
    return (
        F.when(defected(choice), DEFECTED)
        .when(cooperated(choice), COOPERATED)
        .when(F.col(choice).isNotNull(), OTHER_MOVE)
        .otherwise(UNKNOWN_MOVE)
    )


def matchup_id(player_a: str = "player_a", player_b: str = "player_b") -> Column:
    return F.concat(F.col(player_a), F.lit("_vs_"), F.col(player_b))


def tour_bucket(tour: str = "tour") -> Column:
    """Upper edge of the bucket: 1..100 -> 100, 101..200 -> 200."""
    return (F.ceil(F.col(tour) / TOURS_PER_BUCKET) * TOURS_PER_BUCKET).cast("bigint")


def winner(score_a: str, score_b: str) -> Column:
    """Player with the higher score; equal or unknown scores are a draw."""
    a, b = F.col(score_a), F.col(score_b)
    return F.when(a > b, F.col("player_a")).when(b > a, F.col("player_b")).otherwise(DRAW)


def rate_pct(part: Column, whole: Column) -> Column:
    """Percentage with two decimals, divided first; NULL when there is nothing to divide by."""
    return F.round(F.try_divide(part, whole) * 100, 2)


def payoff(mine: Column, theirs: Column) -> Column:
    """Gain of a move pair, NULL for an unknown pair."""
    gain = F.lit(None).cast("bigint")
    for (my_move, their_move), value in PAYOFF.items():
        gain = F.when(
            (mine == my_move) & (theirs == their_move), F.lit(value).cast("bigint")
        ).otherwise(gain)
    return gain
