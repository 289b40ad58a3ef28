"""Tables for text-playing agents: the prompts they see and the moves read from their replies."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tourney.functions.text import history_context, normalise_choice, prompt
from tourney.operators.history import BLOCK_BITS, over_history
from tourney.operators.sides import unpivot_sides
from tourney.schema import COOPERATE, DEFECT, MATCH


def history_prompts(
    rounds: DataFrame, order: str = "tour", block_bits: int = BLOCK_BITS
) -> DataFrame:
    """Prompt of each side in each round, written from the rounds before it."""

    seen = over_history(
        rounds.select(
            *MATCH, *dict.fromkeys(("tour", order)), "choice_a", "choice_b", "gain_a", "gain_b"
        ),
        moves={"last_a": "choice_a", "last_b": "choice_b"},
        previous="previous",
        before={"score_a": "gain_a", "score_b": "gain_b"},
        order=order,
        block_bits=block_bits,
    ).withColumn("opening", F.col("previous").isNull())
    sides = unpivot_sides(
        seen,
        ["run_id", "player_a", "player_b", "tour", "opening"],
        {
            "strategy": ("player_a", "player_b"),
            "my_last": ("last_a", "last_b"),
            "their_last": ("last_b", "last_a"),
            "score": ("score_a", "score_b"),
        },
    )
    context = history_context(
        F.col("my_last"), F.col("their_last"), F.col("score"), F.col("opening")
    )
    return sides.select(*MATCH, "side", "tour", "strategy", prompt(context).alias("prompt"))


def reply_choices(
    conversations: DataFrame,
    keyword: str = DEFECT,
    otherwise: str = COOPERATE,
    role: str = "assistant",
) -> DataFrame:
    """Move read from each reply of ``role``, searching its whole text."""
    return conversations.where(F.col("role") == role).select(
        "conv_id", "turn", normalise_choice(F.col("text"), keyword, otherwise).alias("choice")
    )
