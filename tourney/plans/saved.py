"""Saved queries over gold tables, and the read order of each table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Sort columns of each table and whether they ascend.
READ_ORDER = {
    "gold_tournament_summary": {"ranking": True},
    "gold_matchup_matrix": {"run_id": True, "final_score_a": False},
    "gold_behavioral_drift": {"strategy": True, "matchup_id": True, "tour_bucket": True},
    "gold_forgiveness_index": {"forgiveness_rank": True},
}


def in_read_order(name: str, table: DataFrame) -> DataFrame:
    """Rows of a gold table as its readers expect them; stored tables keep no order."""
    order = READ_ORDER[name]
    return table.orderBy(*order, ascending=list(order.values()))


def final_ranking(summary: DataFrame) -> DataFrame:
    return summary.select("strategy", "total_score", "cooperation_rate_pct", "ranking").orderBy(
        "ranking"
    )


def matchup_lookup(matrix: DataFrame, player_a: str) -> DataFrame:
    return matrix.where(F.col("player_a") == player_a).select(
        "player_a", "player_b", "final_score_a", "final_score_b", "match_winner"
    )


def strategy_drift(drift: DataFrame, strategy: str) -> DataFrame:
    return (
        drift.where(F.col("strategy") == strategy)
        .select("tour_bucket", "cooperation_rate_pct")
        .orderBy("tour_bucket")
    )


def forgiveness_ranking(forgiveness: DataFrame) -> DataFrame:
    return forgiveness.select("strategy", "forgiveness_index_pct", "forgiveness_rank").orderBy(
        "forgiveness_rank"
    )


def run_comparison(summary: DataFrame) -> DataFrame:
    return summary.orderBy("run_id", "ranking").select(
        "run_id", "strategy", "total_score", "cooperation_rate_pct"
    )
