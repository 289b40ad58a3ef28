"""Silver layer: one enriched row per round, no shuffle."""

from __future__ import annotations

from pyspark.sql import DataFrame

from tourney.functions.rounds import cooperated, defected, flag, matchup_id, tour_bucket, winner
from tourney.schema import BRONZE, COOPERATE, DEFECT, DRAW, SILVER, TOURS_PER_BUCKET


def silver_rounds(bronze: DataFrame) -> DataFrame:
    a_cooperates, b_cooperates = cooperated("choice_a"), cooperated("choice_b")
    a_defects, b_defects = defected("choice_a"), defected("choice_b")
    derived = {
        "matchup_id": matchup_id(),
        "cooperated_a": flag(a_cooperates),
        "cooperated_b": flag(b_cooperates),
        "defected_a": flag(a_defects),
        "defected_b": flag(b_defects),
        "mutual_cooperation": flag(a_cooperates & b_cooperates),
        "mutual_defection": flag(a_defects & b_defects),
        "exploitation_by_a": flag(a_defects & b_cooperates),
        "exploitation_by_b": flag(b_defects & a_cooperates),
        "tour_bucket": tour_bucket(),
        "tour_winner": winner("gain_a", "gain_b"),
    }
    return bronze.select(*BRONZE.names, *[c.alias(n) for n, c in derived.items()]).select(
        *SILVER.names
    )


def silver_select(source: str) -> str:
    """The same layer as a SELECT from a table, for views that outlive the session."""

    def flagged(condition: str) -> str:
        return f"CASE WHEN {condition} THEN 1 ELSE 0 END"

    cooperates = {s: f"choice_{s} = '{COOPERATE}'" for s in "ab"}
    defects = {s: f"choice_{s} = '{DEFECT}'" for s in "ab"}
    bucket = f"CAST(ceil(tour / {TOURS_PER_BUCKET}) * {TOURS_PER_BUCKET} AS BIGINT)"
    derived = {
        "matchup_id": "concat(player_a, '_vs_', player_b)",
        "cooperated_a": flagged(cooperates["a"]),
        "cooperated_b": flagged(cooperates["b"]),
        "defected_a": flagged(defects["a"]),
        "defected_b": flagged(defects["b"]),
        "mutual_cooperation": flagged(f"{cooperates['a']} AND {cooperates['b']}"),
        "mutual_defection": flagged(f"{defects['a']} AND {defects['b']}"),
        "exploitation_by_a": flagged(f"{defects['a']} AND {cooperates['b']}"),
        "exploitation_by_b": flagged(f"{defects['b']} AND {cooperates['a']}"),
        "tour_bucket": bucket,
        "tour_winner": "CASE WHEN gain_a > gain_b THEN player_a WHEN gain_b > gain_a THEN player_b "
        f"ELSE '{DRAW}' END",
    }
    columns = [f"{derived[c]} AS {c}" if c in derived else c for c in SILVER.names]
    return f"SELECT {', '.join(columns)} FROM {source}"
