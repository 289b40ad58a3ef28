"""Closed-form matches and hand-worked edge cases."""

import pytest

from tests.rounds import FULL_MATCHES, match_rows
from tourney.plans import gold, quality
from tourney.plans.silver import silver_rounds
from tourney.schema import BRONZE, GOLD, SILVER


def keyed(df, *keys):
    return {tuple(row[k] for k in keys): row.asDict() for row in df.collect()}


@pytest.fixture(scope="module")
def full(bronze_of):
    return silver_rounds(bronze_of(*FULL_MATCHES)).cache()


def test_schemas(full):
    def types(schema):
        return [(f.name, f.dataType) for f in schema]

    assert types(full.schema) == types(SILVER)
    for name, schema in GOLD.items():
        assert types(getattr(gold, name)(full).schema) == types(schema)


def test_leaderboard(full):
    rows = [tuple(r)[1:] for r in gold.gold_tournament_summary(full).orderBy("ranking").collect()]
    assert rows == [
        ("D", 12004, 0.0, 0, 4000, 2001, 2, 1),
        ("T", 7999, 50.03, 2001, 1999, 0, 2, 2),
        ("C", 6000, 100.0, 4000, 0, 0, 2, 3),
    ]


def test_matrix(full):
    rows = {tuple(r)[1:3]: tuple(r)[3:] for r in gold.gold_matchup_matrix(full).collect()}
    assert rows == {
        ("T", "D"): ("T_vs_D", 1999, 2004, 0.05, 0.0, 0, 1, "D"),
        ("T", "C"): ("T_vs_C", 6000, 6000, 100.0, 100.0, 0, 0, "draw"),
        ("C", "D"): ("C_vs_D", 0, 10000, 100.0, 0.0, 0, 2000, "D"),
    }


@pytest.mark.parametrize("block_bits", [3, 17])
def test_forgiveness(full, block_bits):
    rows = {tuple(r)[1:] for r in gold.gold_forgiveness_index(full, block_bits=block_bits).collect()}
    assert rows == {
        ("C", 1999, 1999, 100.0, 1),
        ("D", 1998, 0, 0.0, 2),
        ("T", 1999, 0, 0.0, 2),
    }


def test_drift(full):
    rows = keyed(gold.gold_behavioral_drift(full), "matchup_id", "strategy", "tour_bucket")
    assert len(rows) == 3 * 2 * 20
    first = rows["T_vs_D", "T", 100]
    assert (first["cooperation_rate_pct"], first["total_gain"]) == (1.0, 99)
    assert rows["T_vs_D", "D", 100]["total_gain"] == 104
    for bucket in range(200, 2001, 100):
        for strategy in "TD":
            row = rows["T_vs_D", strategy, bucket]
            assert (row["cooperation_rate_pct"], row["total_gain"]) == (0.0, 100)


def test_single_round_ties_and_has_no_index(bronze_of):
    silver = silver_rounds(bronze_of(("r", "X", "Y", ["CC"])))
    board = keyed(gold.gold_tournament_summary(silver), "strategy")
    assert {k[0]: (r["total_score"], r["ranking"]) for k, r in board.items()} == {
        "X": (3, 1),
        "Y": (3, 1),
    }
    assert gold.gold_matchup_matrix(silver).first()["match_winner"] == "draw"
    assert gold.gold_forgiveness_index(silver).count() == 0


def test_self_play_keeps_sides_apart(bronze_of):
    silver = silver_rounds(bronze_of(("r", "X", "X", ["CD", "DD"])))
    assert tuple(gold.gold_tournament_summary(silver).first())[1:] == (
        "X",
        7,
        25.0,
        1,
        3,
        1,
        1,
        1,
    )
    assert gold.gold_matchup_matrix(silver).first()["match_winner"] == "X"
    assert tuple(gold.gold_forgiveness_index(silver).first())[1:] == ("X", 1, 0, 0.0, 1)
    drift = {tuple(r)[5:] for r in gold.gold_behavioral_drift(silver).collect()}
    assert drift == {(50.0, 1, 0, 1), (0.0, 6, 1, 0)}


def test_unknown_index_ranks_last(bronze_of):
    peaceful = ("r", "X", "Y", ["CC", "CC"])
    alone = gold.gold_forgiveness_index(silver_rounds(bronze_of(peaceful))).collect()
    assert {(r.strategy, r.forgiveness_index_pct, r.forgiveness_rank) for r in alone} == {
        ("X", None, 1),
        ("Y", None, 1),
    }
    silver = silver_rounds(bronze_of(peaceful, ("r", "V", "W", ["CD", "CC"])))
    ranks = keyed(gold.gold_forgiveness_index(silver), "strategy")
    assert ranks["V",]["forgiveness_index_pct"] == 100.0
    assert {k[0]: r["forgiveness_rank"] for k, r in ranks.items()} == {
        "V": 1,
        "W": 2,
        "X": 2,
        "Y": 2,
    }


@pytest.mark.parametrize("block_bits", [1, 17])
def test_missing_choice(bronze_of, block_bits):
    silver = silver_rounds(bronze_of(("r", "X", "Y", ["CD", "-D", "CC"])))
    second = silver.where("tour = 2").first()
    assert (second.cooperated_a, second.defected_a, second.tour_winner) == (0, 0, "draw")
    index = keyed(gold.gold_forgiveness_index(silver, block_bits=block_bits), "strategy")
    assert index["X",]["total_betrayals_received"] == 2
    assert index["X",]["total_forgiven"] == 1
    assert index["Y",]["total_betrayals_received"] == 0


def test_bucket_edges(spark, bronze_of):
    rows = match_rows("r", "X", "Y", ["CC"] * 4, tours=[1, 100, 101, 2000])
    silver = silver_rounds(spark.createDataFrame(rows, BRONZE))
    buckets = [r.tour_bucket for r in silver.orderBy("tour").collect()]
    assert buckets == [100, 100, 200, 2000]


def test_run_loaded_twice(bronze_of):
    once = bronze_of(("r", "X", "Y", ["CD", "DD", "CC"]))
    twice = once.union(once)
    before = keyed(gold.gold_tournament_summary(silver_rounds(once)), "strategy")
    after = keyed(gold.gold_tournament_summary(silver_rounds(twice)), "strategy")
    for key, row in before.items():
        assert after[key]["total_score"] == row["total_score"]
        assert after[key]["cooperation_rate_pct"] == row["cooperation_rate_pct"]
        assert after[key]["total_cooperations"] == 2 * row["total_cooperations"]
        assert after[key]["total_exploitations"] == 2 * row["total_exploitations"]
    report = {r.rule: (r.checked, r.violations) for r in quality.dq_report(twice).collect()}
    assert report["unique_round"] == (3, 3)
    assert report["choice_domain"] == (6, 0)


def test_both_orders_are_two_matchups(bronze_of):
    silver = silver_rounds(bronze_of(("r", "A", "B", ["CC"]), ("r", "B", "A", ["CC"])))
    assert {r.matchup_id for r in silver.collect()} == {"A_vs_B", "B_vs_A"}
    assert {r.nb_matchups for r in gold.gold_tournament_summary(silver).collect()} == {2}


def test_names_sharing_a_match_key(bronze_of):
    silver = silver_rounds(
        bronze_of(("r", "x", "y_vs_z", ["CD"]), ("r", "x_vs_y", "z", ["DC", "DC"]))
    )
    assert {r.matchup_id for r in silver.collect()} == {"x_vs_y_vs_z"}
    scores = keyed(gold.gold_tournament_summary(silver), "strategy")
    assert {k[0]: r["total_score"] for k, r in scores.items()} == {
        "x": 0,
        "y_vs_z": 5,
        "x_vs_y": 10,
        "z": 0,
    }
