"""Block-wise windows against plain ones, and the jobs built on them against brute force."""

import re

import numpy as np
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import Window
from pyspark.sql import functions as F

import naive
from tests.rounds import MOVE, conformance_counts, forgiveness_counts, match_rows
from tourney.operators import history
from tourney.operators.history import over_history
from tourney.operators.ordering import place_in_order
from tourney.operators.scoring import add_gains, add_running_scores, score_rounds
from tourney.plans import gold, policies, quality, replies
from tourney.plans.silver import silver_rounds
from tourney.schema import BRONZE, MATCH, PAYOFF
from tourney.session import materialise
from tourney.sources.bronze import append_bronze, bronze_in_order

few = settings(
    max_examples=6,
    deadline=None,
    suppress_health_check=[HealthCheck.function_scoped_fixture, HealthCheck.too_slow],
)
moves = st.lists(st.sampled_from(["CC", "CD", "DC", "DD", "-D", "C-"]), min_size=1, max_size=40)
names = st.sampled_from(["p", "q", None])


@st.composite
def tournaments(draw):
    """Matches of uneven length, with missing moves, unnamed players and gaps in the tours."""
    pairings = draw(st.lists(st.tuples(names, names), min_size=1, max_size=4, unique=True))
    rows = []
    for a, b in pairings:
        played = draw(moves)
        gaps = draw(st.lists(st.integers(1, 9), min_size=len(played), max_size=len(played)))
        tours = [sum(gaps[: i + 1]) for i in range(len(played))]
        rows += match_rows("r", a, b, played, tours)
    return rows


def as_set(df, columns):
    return sorted(map(repr, df.select(*columns).collect()))


@few
@given(rows=tournaments(), block_bits=st.integers(0, 4))
def test_blocks_equal_whole_match(spark, rows, block_bits):
    bronze = spark.createDataFrame(rows, BRONZE)

    blocked = over_history(
        bronze,
        moves={"last_a": "choice_a"},
        previous="last_tour",
        before={"score_before": "gain_b"},
        so_far={"score": "gain_b"},
        block_bits=block_bits,
    )
    whole = Window.partitionBy(*MATCH).orderBy("tour")
    plain = bronze.select(
        "*",
        F.lag("choice_a").over(whole).alias("last_a"),
        F.lag("tour").over(whole).alias("last_tour"),
        F.sum("gain_b").over(whole.rowsBetween(Window.unboundedPreceding, -1)).alias("score_before"),
        F.sum("gain_b").over(whole.rowsBetween(Window.unboundedPreceding, 0)).alias("score"),
    )
    assert blocked.columns == plain.columns
    assert as_set(blocked, plain.columns) == as_set(plain, plain.columns)


def test_columns_that_are_not_there_are_refused(bronze_of):
    with pytest.raises(ValueError, match="gain_c"):
        over_history(bronze_of(("r", "x", "y", ["CD"])), so_far={"sum": "gain_c"})


def test_any_text_is_carried_and_summaries_stay_small(spark):
    """200,000 different texts in one match: 16 rows per block at most come out of the fold."""
    rounds = spark.range(1, 200_001).select(
        F.lit("r").alias("run_id"),
        F.lit("x").alias("player_a"),
        F.lit("y").alias("player_b"),
        F.col("id").alias("tour"),
        F.concat(F.lit("text "), F.col("id")).alias("choice_a"),
        F.when(F.col("id") % 2 == 0, "DEFECT").otherwise("COOPERATE").alias("choice_b"),
    )
    blocked = rounds.withColumn("_block", history.block_of("tour", 12))
    ends = history._block_ends(blocked, "tour", ["choice_a", "choice_b"], [])
    assert ends.count() == len(range(0, 200_001, 1 << 12))
    found = over_history(rounds, moves={"before": "choice_a"}, block_bits=12)
    expected = F.when(F.col("tour") > 1, F.concat(F.lit("text "), F.col("tour") - 1))
    assert found.where(~F.col("before").eqNullSafe(expected)).count() == 0
    plan = ends._jdf.queryExecution().executedPlan().toString()
    folds = re.findall(r"HashAggregate\(keys=\[([^\]]*)\], functions=\[partial_max\(tour", plan)
    assert folds and all("_code_choice_a" in f for f in folds)


def test_sparse_tours_by_position(spark):
    rows = match_rows("r", "x", "y", ["CD", "DD", "CC", "DC"] * 5)
    sparse = [(r[0], r[1] * 1_000_000, *r[2:]) for r in rows]
    frame = spark.createDataFrame(sparse, BRONZE)
    placed = materialise(place_in_order(frame, [*MATCH, "tour"], BRONZE.names), "sparse")
    for job in (policies.policy_conformance, gold.gold_forgiveness_index):
        by_position, by_tour = job(placed, order="position"), job(frame)
        assert as_set(by_position, by_tour.columns) == as_set(by_tour, by_tour.columns)


@few
@given(rows=tournaments(), block_bits=st.integers(0, 4))
def test_models_equal_branch_by_branch_forms(spark, rows, block_bits):
    silver = silver_rounds(spark.createDataFrame(rows, BRONZE)).cache()
    pairs = [
        (gold.gold_tournament_summary(silver), naive.summary(silver)),
        (gold.gold_matchup_matrix(silver), naive.matrix(silver)),
        (gold.gold_behavioral_drift(silver), naive.drift(silver)),
        (gold.gold_forgiveness_index(silver, block_bits=block_bits), naive.forgiveness(silver)),
    ]
    for job, plain in pairs:
        assert as_set(job, job.columns) == as_set(plain, job.columns)
    silver.unpersist()


@few
@given(rows=tournaments(), block_bits=st.integers(0, 4))
def test_counts_equal_walking_through_rounds(spark, rows, block_bits):
    bronze = spark.createDataFrame(rows, BRONZE)
    index = gold.gold_forgiveness_index(silver_rounds(bronze), block_bits=block_bits).collect()
    assert {
        (r.run_id, r.strategy): (r.total_betrayals_received, r.total_forgiven) for r in index
    } == forgiveness_counts(rows)
    audit = policies.policy_conformance(bronze, block_bits=block_bits).collect()
    assert {
        (r.run_id, r.strategy, r.policy): r.conforming for r in audit
    } == conformance_counts(rows)


@pytest.mark.parametrize("block_bits", [2, 17])
def test_one_match_holding_most_rounds(spark, bronze_of, block_bits):
    long_match = ("r", "hot", "cold", ["CD", "DC", "DD", "CC", "CD"] * 400)
    short = [("r", f"s{i}", "cold", ["CD", "DD", "CC"]) for i in range(20)]
    bronze = bronze_of(long_match, *short)
    scored = score_rounds(bronze.drop("gain_a", "gain_b", "cumul_a", "cumul_b"), block_bits)
    assert scored.select(*BRONZE.names).exceptAll(bronze).count() == 0
    assert scored.count() == bronze.count()


def test_gains_of_every_pair(spark):
    rows = [(MOVE[p[0]], MOVE[p[1]]) for p in ("CC", "CD", "DC", "DD", "-C", "D-")]
    scored = add_gains(spark.createDataFrame(rows, "choice_a string, choice_b string"))
    got = {(r.choice_a, r.choice_b): (r.gain_a, r.gain_b) for r in scored.collect()}
    assert got == {(a, b): (PAYOFF.get((a, b)), PAYOFF.get((b, a))) for a, b in rows}


def test_running_scores_equal_plain_window(bronze_of):
    bronze = bronze_of(("r", "x", "y", ["CD", "DC", "DD", "CC"] * 50)).drop("cumul_a", "cumul_b")
    ours, plain = add_running_scores(bronze, block_bits=3), naive.running_scores(bronze)
    assert as_set(ours, plain.columns) == as_set(plain, plain.columns)


def test_positions_follow_the_order_and_are_stable(spark):
    df = spark.range(5000).select(
        F.when(F.col("id") % 3 == 0, "hot").otherwise("cold").alias("k"),
        (F.col("id") * 7919 % 5000).alias("v"),
    )
    placed = materialise(place_in_order(df, ["k", "v"], ["k", "v"]), "positions")
    rows = sorted(placed.collect(), key=lambda r: r.position)
    assert [(r.k, r.v) for r in rows] == sorted((r.k, r.v) for r in df.collect())
    assert len({r.position for r in rows}) == 5000
    assert sorted(placed.collect(), key=lambda r: r.position) == rows


def test_history_prompt_text(bronze_of):
    bronze = bronze_of(("r", "x", "y", ["CD", "DD", "CC"]))
    rows = {(r.side, r.tour): r for r in replies.history_prompts(bronze, block_bits=0).collect()}
    assert len(rows) == 6
    assert "\nC'est le premier tour.\n" in rows["A", 1].prompt
    assert (
        "\nTour précédent : tu as joué COOPERATE, l'adversaire a joué DEFECT. "
        "Ton score cumulé : 0.\n" in rows["A", 2].prompt
    )
    assert "tu as joué DEFECT, l'adversaire a joué DEFECT. Ton score cumulé : 6." in (
        rows["B", 3].prompt
    )
    assert rows["B", 3].strategy == "y"


def test_replies(spark):
    texts = ["DEFECT", "  defect!", "I will Defect now", "COOPERATE", "", None, "x" * 50_000 + "DEFECT"]
    rows = [(i, 1, "assistant", t) for i, t in enumerate(texts)] + [(99, 1, "user", "DEFECT")]
    talks = spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string")
    got = {r.conv_id: r.choice for r in replies.reply_choices(talks).collect()}
    assert got == {i: "DEFECT" if i in (0, 1, 2, 6) else "COOPERATE" for i in range(7)}


def test_keyword_in_any_case(spark):
    talks = spark.createDataFrame(
        [(1, 1, "assistant", "We Que here"), (2, 1, "assistant", "no")],
        "conv_id bigint, turn bigint, role string, text string",
    )
    found = replies.reply_choices(talks, keyword="que", otherwise="-").collect()
    assert [r.choice for r in found] == ["que", "-"]


def test_replay_scores(bronze_of):
    bronze = bronze_of(("r", "x", "y", ["CD", "CC", "CD"]))
    rows = {
        (r.strategy, r.policy): (
            r.scored_rounds, r.recorded_score, r.replayed_score, r.score_change
        )
        for r in policies.counterfactual_replay(bronze, block_bits=1).collect()
    }
    assert rows["x", "always_cooperate"] == (3, 3, 3, 0)
    assert rows["x", "always_defect"] == (3, 3, 7, 4)
    assert rows["x", "tit_for_tat"] == (3, 3, 0 + 5 + 0, 2)
    assert rows["x", "grim_trigger"] == (3, 3, 0 + 5 + 1, 3)
    assert rows["x", "random"][0] == 3
    again = policies.counterfactual_replay(bronze, block_bits=1)
    assert {(r.strategy, r.policy): r.replayed_score for r in again.collect()} == {
        k: v[2] for k, v in rows.items()
    }


def test_a_missing_own_move_counts_for_neither_score(bronze_of):
    bronze = bronze_of(("r", "x", "y", ["CC", "-C", "CC"]))
    rows = {(r.strategy, r.policy): r for r in policies.counterfactual_replay(bronze).collect()}
    found = rows["x", "always_cooperate"]
    assert (found.rounds, found.scored_rounds, found.score_change) == (3, 2, 0)


def test_random_moves_are_independent(spark):
    def moves(side, **key):
        names = {"run_id": "r", "player_a": "x", "player_b": "y"} | key
        tours = spark.range(1, 20_001).withColumnRenamed("id", "tour")
        frame = tours.withColumns({n: F.lit(v) for n, v in names.items()})
        move = (policies.seeded_move(0, side) == "DEFECT").cast("int").alias("move")
        return np.array([r.move for r in frame.orderBy("tour").select(move).collect()])

    first = moves("a")
    assert abs(first.mean() - 0.5) < 0.02
    others = [moves("b"), moves("a", run_id="s"), moves("a", player_b="z")]
    pairs = [(first[k:], first[:-k]) for k in range(1, 9)] + [(first, o) for o in others]
    pairs += [(others[0][k:], first[:-k]) for k in range(1, 4)]
    assert all(abs(np.corrcoef(a, b)[0, 1]) < 0.05 for a, b in pairs)


def test_domains_are_optional_rules(bronze_of):
    bronze = bronze_of(("run00001", "x", "y", ["CC"] * 5), ("r", "x", "y", ["CC"]))
    report = quality.dq_report(bronze, last_tour=3, run_id_chars=8).collect()
    found = {r.rule: r.violations for r in report}
    assert (found["tour_domain"], found["run_id_length"], len(found)) == (2, 1, 9)


def test_quality_report_counts_each_fault(spark):
    good = match_rows("r", "x", "y", ["CD", "CC", "DD", "DC"])
    clean = {r.rule: r.violations for r in quality.dq_report(spark.createDataFrame(good, BRONZE)).collect()}
    assert set(clean.values()) == {0} and len(clean) == 7

    def broken(index, **changes):
        rows = [list(r) for r in good]
        for column, value in changes.items():
            rows[index][BRONZE.names.index(column)] = value
        df = spark.createDataFrame([tuple(r) for r in rows], BRONZE)
        report = quality.dq_report(df, block_bits=1).collect()
        return {r.rule: r.violations for r in report if r.violations}

    assert broken(1, choice_a="MAYBE") == {"choice_domain": 1, "gain_is_payoff": 1}
    assert broken(0, choice_b=None) == {"choice_domain": 1, "gain_is_payoff": 1}
    assert broken(3, gain_a=4) == {
        "gain_domain": 1,
        "gain_is_payoff": 1,
        "cumul_is_running_sum": 1,
    }
    assert broken(2, cumul_b=None) == {"cumul_is_running_sum": 1}
    assert broken(3, tour=7) == {"dense_tours": 1}
    assert broken(3, player_b=None) == {
        "key_not_null": 1,
        "dense_tours": 1,
        "cumul_is_running_sum": 1,
    }


def test_stats_count_distinct_strategies(bronze_of):
    stats = quality.tournament_stats(
        bronze_of(
            ("r", "x", "y", ["CC"] * 3), ("r", "y", "x", ["CC"]), ("r", "x", "x", ["CC"]),
            ("s", "x", "z", ["CC"] * 2),
        )
    )
    assert {r.run_id: (r.rounds, r.matches, r.strategies) for r in stats.collect()} == {
        "r": (5, 3, 2),
        "s": (2, 1, 2),
    }


def test_a_round_with_most_rows_as_copies(spark, tmp_path):
    played = match_rows("r", "x", "y", ["CD", "DD", "CC", "DC", "CD"])
    rows = played[:2] + [played[2]] * 300 + played[3:] + match_rows("r", "x", "z", ["DD", "CC"])
    path = str(tmp_path / "copies")
    append_bronze(spark.createDataFrame(rows, BRONZE).repartition(3), path)
    bronze = materialise(bronze_in_order(spark, path), "copies")
    assert bronze.select("position").distinct().count() == len(rows)

    # Copies of a round are alike, so any order among them gives the counts of this one.
    expected = [(*row[:1], i, *row[2:]) for i, row in enumerate(rows)]
    index = gold.gold_forgiveness_index(bronze, order="position", block_bits=3).collect()
    assert {
        (r.run_id, r.strategy): (r.total_betrayals_received, r.total_forgiven) for r in index
    } == forgiveness_counts(expected)
    audit = policies.policy_conformance(bronze, order="position", block_bits=3).collect()
    assert {(r.run_id, r.strategy, r.policy): r.conforming for r in audit} == conformance_counts(
        expected
    )
    scored = add_running_scores(bronze.drop("cumul_a", "cumul_b"), "position", block_bits=3)
    finals = scored.groupBy("player_b").agg(F.max("cumul_a").alias("a")).collect()
    assert {r.player_b: r.a for r in finals} == {"y": 0 + 1 + 3 * 300 + 5 + 0, "z": 1 + 3}
    prompts = replies.history_prompts(bronze, order="position", block_bits=3)
    assert prompts.count() == 2 * len(rows)
    openings = prompts.where(F.col("prompt").contains("premier tour"))
    assert openings.count() == 4

    report = {r.rule: (r.checked, r.violations) for r in quality.dq_report(bronze).collect()}
    assert report["unique_round"] == (7, 1)
