"""From one row with sides A and B to one row per side."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SIDE_COLUMNS = {
    "strategy": ("player_a", "player_b"),
    "opponent": ("player_b", "player_a"),
    "choice": ("choice_a", "choice_b"),
    "opponent_choice": ("choice_b", "choice_a"),
    "gain": ("gain_a", "gain_b"),
    "cumul": ("cumul_a", "cumul_b"),
    "cooperated": ("cooperated_a", "cooperated_b"),
    "defected": ("defected_a", "defected_b"),
    "exploitation_done": ("exploitation_by_a", "exploitation_by_b"),
    "exploitation_received": ("exploitation_by_b", "exploitation_by_a"),
}


def unpivot_sides(
    df: DataFrame,
    keep: Sequence[str],
    columns: Mapping[str, tuple[str | Column, str | Column]] = SIDE_COLUMNS,
) -> DataFrame:
    """Two rows per input row, marked ``side`` A and B, in one pass over the input.

    ``columns`` maps an output name to its (side A, side B) source. ``side`` tells the two rows of
    a player meeting itself apart. Aggregates run this on their per-match results, not on rounds.
    """

    def row(side: str, index: int) -> Column:
        values = [
            (F.col(pair[index]) if isinstance(pair[index], str) else pair[index]).alias(name)
            for name, pair in columns.items()
        ]
        return F.struct(F.lit(side).alias("side"), *values)

    return df.select(*keep, F.inline(F.array(row("A", 0), row("B", 1))))
