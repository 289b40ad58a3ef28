"""The models written branch by branch: each side its own scan, each match one window partition.

Right on any data, but they read the rounds twice and sort a whole match in one task. The bench
times them against the jobs, and the tests compare both.
"""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

MATCH = ("run_id", "player_a", "player_b")


def rank_in_run(score):
    """One more than the number of strategies of the run that are better; unknown ones come last."""
    known = F.coalesce(F.col(score).cast("double"), F.lit(float("-inf")))
    whole = Window.partitionBy("run_id")
    return F.size(
        F.filter(F.collect_list(known).over(whole), lambda other: other > known)
    ).cast("bigint") + F.lit(1)


def _side(silver, mine, theirs):
    return silver.select(
        "run_id",
        "matchup_id",
        "tour",
        "tour_bucket",
        F.lit(mine.upper()).alias("side"),
        F.col(f"player_{mine}").alias("strategy"),
        F.col(f"player_{theirs}").alias("opponent"),
        F.col(f"choice_{mine}").alias("choice"),
        F.col(f"choice_{theirs}").alias("opponent_choice"),
        F.col(f"gain_{mine}").alias("gain"),
        F.col(f"cumul_{mine}").alias("cumul"),
        F.col(f"cooperated_{mine}").alias("cooperated"),
        F.col(f"defected_{mine}").alias("defected"),
        F.col(f"exploitation_by_{mine}").alias("done"),
        F.col(f"exploitation_by_{theirs}").alias("received"),
    )


def sides(silver):
    return _side(silver, "a", "b").unionByName(_side(silver, "b", "a"))


def summary(silver):
    per_match = (
        sides(silver)
        .groupBy("run_id", "side", "strategy", "matchup_id")
        .agg(
            F.max("cumul").alias("score"),
            F.count(F.lit(1)).alias("tours"),
            F.sum("cooperated").alias("cooperated"),
            F.sum("defected").alias("defected"),
            F.sum("done").alias("done"),
        )
    )
    return (
        per_match.groupBy("run_id", "strategy")
        .agg(
            F.sum("score").alias("total_score"),
            F.round(F.sum("cooperated") / F.sum("tours") * 100, 2).alias("cooperation_rate_pct"),
            F.sum("cooperated").alias("total_cooperations"),
            F.sum("defected").alias("total_defections"),
            F.sum("done").alias("total_exploitations"),
            F.countDistinct("matchup_id").alias("nb_matchups"),
        )
        .withColumn("ranking", rank_in_run("total_score"))
    )


def drift(silver):
    return (
        sides(silver)
        .groupBy("run_id", "side", "strategy", "opponent", "matchup_id", "tour_bucket")
        .agg(
            F.round(F.avg("cooperated") * 100, 2).alias("cooperation_rate_pct"),
            F.sum("gain").alias("total_gain"),
            F.sum("done").alias("exploitations_done"),
            F.sum("received").alias("exploitations_received"),
        )
        .drop("side")
    )


def matrix(silver):
    a, b = F.col("final_score_a"), F.col("final_score_b")
    return (
        silver.groupBy(*MATCH, "matchup_id")
        .agg(
            F.max("cumul_a").alias("final_score_a"),
            F.max("cumul_b").alias("final_score_b"),
            F.round(F.avg("cooperated_a") * 100, 2).alias("cooperation_rate_a_pct"),
            F.round(F.avg("cooperated_b") * 100, 2).alias("cooperation_rate_b_pct"),
            F.sum("exploitation_by_a").alias("exploitations_by_a"),
            F.sum("exploitation_by_b").alias("exploitations_by_b"),
        )
        .withColumn(
            "match_winner",
            F.when(a > b, F.col("player_a")).when(b > a, F.col("player_b")).otherwise("draw"),
        )
    )


def forgiveness(silver):
    window = Window.partitionBy("run_id", "side", "strategy", "opponent").orderBy("tour")
    faced = F.col("faced") == "DEFECT"
    return (
        sides(silver)
        .withColumn("faced", F.lag("opponent_choice").over(window))
        .where(F.col("faced").isNotNull())
        .groupBy("run_id", "strategy")
        .agg(
            F.count_if(faced).alias("total_betrayals_received"),
            F.count_if(faced & (F.col("choice") == "COOPERATE")).alias("total_forgiven"),
        )
        .withColumn(
            "forgiveness_index_pct",
            F.round(
                F.try_divide(F.col("total_forgiven"), F.col("total_betrayals_received")) * 100, 2
            ),
        )
        .withColumn("forgiveness_rank", rank_in_run("forgiveness_index_pct"))
    )


def running_scores(rounds):
    so_far = (
        Window.partitionBy(*MATCH)
        .orderBy("tour")
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    return rounds.withColumns(
        {
            "cumul_a": F.sum("gain_a").over(so_far),
            "cumul_b": F.sum("gain_b").over(so_far),
        }
    )
