"""Table layouts, fixed game values and column descriptions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import types as T

# The two moves, and the gain of (my move, opponent's move).
COOPERATE = "COOPERATE"
DEFECT = "DEFECT"
CHOICES = (COOPERATE, DEFECT)
PAYOFF = {
    (COOPERATE, COOPERATE): 3,
    (COOPERATE, DEFECT): 0,
    (DEFECT, COOPERATE): 5,
    (DEFECT, DEFECT): 1,
}
GAINS = (0, 1, 3, 5)
DRAW = "draw"
TOURS_PER_BUCKET = 100

# A match is every round two players play in one run; rounds are ordered by `tour`.
MATCH = ("run_id", "player_a", "player_b")


def _fields(data_type: T.DataType, *names: str) -> list[T.StructField]:
    return [T.StructField(name, data_type) for name in names]


_text, _whole, _small, _real = T.StringType(), T.LongType(), T.IntegerType(), T.DoubleType()

BRONZE = T.StructType(
    _fields(_text, "run_id")
    + _fields(_whole, "tour")
    + _fields(_text, "player_a", "player_b", "choice_a", "choice_b")
    + _fields(_whole, "gain_a", "gain_b", "cumul_a", "cumul_b")
)

SILVER = T.StructType(
    list(BRONZE)
    + _fields(_text, "matchup_id")
    + _fields(_small, "cooperated_a", "cooperated_b", "defected_a", "defected_b")
    + _fields(_small, "mutual_cooperation", "mutual_defection")
    + _fields(_small, "exploitation_by_a", "exploitation_by_b")
    + _fields(_whole, "tour_bucket")
    + _fields(_text, "tour_winner")
)

GOLD = {
    "gold_tournament_summary": T.StructType(
        _fields(_text, "run_id", "strategy")
        + _fields(_whole, "total_score")
        + _fields(_real, "cooperation_rate_pct")
        + _fields(_whole, "total_cooperations", "total_defections", "total_exploitations")
        + _fields(_whole, "nb_matchups", "ranking")
    ),
    "gold_matchup_matrix": T.StructType(
        _fields(_text, "run_id", "player_a", "player_b", "matchup_id")
        + _fields(_whole, "final_score_a", "final_score_b")
        + _fields(_real, "cooperation_rate_a_pct", "cooperation_rate_b_pct")
        + _fields(_whole, "exploitations_by_a", "exploitations_by_b")
        + _fields(_text, "match_winner")
    ),
    "gold_behavioral_drift": T.StructType(
        _fields(_text, "run_id", "strategy", "opponent", "matchup_id")
        + _fields(_whole, "tour_bucket")
        + _fields(_real, "cooperation_rate_pct")
        + _fields(_whole, "total_gain", "exploitations_done", "exploitations_received")
    ),
    "gold_forgiveness_index": T.StructType(
        _fields(_text, "run_id", "strategy")
        + _fields(_whole, "total_betrayals_received", "total_forgiven")
        + _fields(_real, "forgiveness_index_pct")
        + _fields(_whole, "forgiveness_rank")
    ),
}

TABLE_COMMENTS = {
    "tournament_bronze": "Recorded rounds, one row per round of a match",
    "silver_rounds": "Rounds with move flags, match key, bucket and winner",
    "gold_tournament_summary": "Leaderboard of each run",
    "gold_matchup_matrix": "One row per match with both sides' results",
    "gold_behavioral_drift": "Cooperation of each side of a match per 100 rounds",
    "gold_forgiveness_index": "How often a strategy cooperates right after a betrayal",
}

COLUMN_COMMENTS = {
    "run_id": "Groups the matches that were played together",
    "tour": "Counts the rounds of a match, starting at 1",
    "player_a": "Who plays side A",
    "player_b": "Who plays side B; may be the same strategy as side A",
    "choice_a": "What side A played; NULL if not recorded",
    "choice_b": "What side B played; NULL if not recorded",
    "gain_a": "Points side A won in this round; NULL if a move is missing or unknown",
    "gain_b": "Points side B won in this round; NULL if a move is missing or unknown",
    "cumul_a": "Points of side A up to and with this round",
    "cumul_b": "Points of side B up to and with this round",
    "matchup_id": "Both names joined by _vs_, side A first",
    "cooperated_a": "Whether side A cooperated, 0 if its move is missing",
    "cooperated_b": "Whether side B cooperated, 0 if its move is missing",
    "defected_a": "Whether side A defected, 0 if its move is missing",
    "defected_b": "Whether side B defected, 0 if its move is missing",
    "mutual_cooperation": "Whether both cooperated",
    "mutual_defection": "Whether both defected",
    "exploitation_by_a": "Whether A defected on a cooperating B",
    "exploitation_by_b": "Whether B defected on a cooperating A",
    "tour_bucket": "Last round number of the hundred this round belongs to",
    "tour_winner": "Who won more points in this round; draw if equal or not known",
    "strategy": "The player this row is about",
    "opponent": "Who the strategy played against",
    "total_score": "Final scores of the strategy over all its matches",
    "cooperation_rate_pct": "Share of its rounds in which the strategy cooperated",
    "total_cooperations": "Rounds in which the strategy cooperated",
    "total_defections": "Rounds in which the strategy defected",
    "total_exploitations": "Rounds in which it defected on a cooperating opponent",
    "nb_matchups": "Different match keys the strategy appears in",
    "ranking": "Place by total score in its run; equal scores share the better place",
    "final_score_a": "Points of side A at the end of the match",
    "final_score_b": "Points of side B at the end of the match",
    "cooperation_rate_a_pct": "Share of the match's rounds in which A cooperated",
    "cooperation_rate_b_pct": "Share of the match's rounds in which B cooperated",
    "exploitations_by_a": "Rounds of the match in which A exploited B",
    "exploitations_by_b": "Rounds of the match in which B exploited A",
    "match_winner": "Who has the higher final score; draw if equal or not known",
    "total_gain": "Points the side won within the bucket",
    "exploitations_done": "Rounds of the bucket in which the side exploited the other",
    "exploitations_received": "Rounds of the bucket in which it was exploited",
    "total_betrayals_received": "Rounds that follow a defection of the opponent",
    "total_forgiven": "Those of them in which the strategy cooperated",
    "forgiveness_index_pct": "Forgiven share of the betrayals; NULL if it was never betrayed",
    "forgiveness_rank": "Place by that share in its run, NULL last, ties share a place",
}


def describe(df: DataFrame) -> DataFrame:
    """Attach the known descriptions as column metadata; Spark keeps them in written tables."""
    for name in df.columns:
        if name in COLUMN_COMMENTS:
            df = df.withMetadata(name, {"comment": COLUMN_COMMENTS[name]})
    return df
