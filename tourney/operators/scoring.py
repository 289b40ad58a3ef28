"""Gains and running scores of recorded moves."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tourney.functions.rounds import payoff
from tourney.operators.history import BLOCK_BITS, over_history


def add_gains(moves: DataFrame) -> DataFrame:
    """Both gains of each round; an unknown move pair leaves them NULL."""
    a, b = F.col("choice_a"), F.col("choice_b")
    return moves.withColumns({"gain_a": payoff(a, b), "gain_b": payoff(b, a)})


def add_running_scores(
    rounds: DataFrame, order: str = "tour", block_bits: int = BLOCK_BITS
) -> DataFrame:
    """Score of both sides since the match began, this round included."""

    return over_history(
        rounds,
        so_far={"cumul_a": "gain_a", "cumul_b": "gain_b"},
        order=order,
        block_bits=block_bits,
    )


def score_rounds(moves: DataFrame, block_bits: int = BLOCK_BITS) -> DataFrame:
    """Recorded moves with gains and running scores."""
    return add_running_scores(add_gains(moves), block_bits=block_bits)
