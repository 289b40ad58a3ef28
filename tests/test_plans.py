"""Shape of the physical plans."""

import re

import pytest

from tests.rounds import match_rows
from tourney.operators.scoring import add_gains
from tourney.plans import gold, policies, quality, replies, saved
from tourney.plans.build import build, read_gold
from tourney.plans.silver import silver_rounds
from tourney.schema import BRONZE
from tourney.session import materialise
from tourney.sources.bronze import append_bronze, read_bronze, runs_only


@pytest.fixture(scope="module")
def bronze(bronze_of):
    return materialise(bronze_of(("r", "x", "y", ["CD", "DD", "CC"] * 10)), "plan-test")


def plan_of(df):
    df.sparkSession.conf.set("spark.sql.maxMetadataStringLength", "2000")
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize(
    "table", ["gold_tournament_summary", "gold_matchup_matrix", "gold_behavioral_drift"]
)
def test_totals_read_rounds_once(bronze, table):
    plan = plan_of(getattr(gold, table)(silver_rounds(bronze)))
    assert plan.count("FileScan parquet") == 1
    # Rounds are folded before anything is shuffled.
    assert "partial_sum" in plan.split("FileScan parquet")[0].rsplit("Exchange", 1)[1]


def test_forgiveness_reads_and_shuffles_rounds_once(bronze):
    plan = plan_of(gold.gold_forgiveness_index(silver_rounds(bronze)))
    assert plan.count("FileScan parquet") == 1
    # From the scan up to the fold per block there is one exchange, on match and block.
    below_fold = plan.split("partial_count")[-1]
    exchanges = re.findall(r"Exchange hashpartitioning\(([^)]*)\)", below_fold)
    assert len(exchanges) == 1 and "block" in exchanges[0]


def test_matrix_reads_only_its_columns(bronze):
    plan = plan_of(gold.gold_matchup_matrix(silver_rounds(bronze)))
    (read,) = re.findall(r"FileScan parquet \[([^\]]*)\]", plan)
    assert "gain" not in read and "tour" not in read


def test_history_jobs_never_sort_a_whole_match_of_rounds(bronze):
    for df in (
        gold.gold_forgiveness_index(silver_rounds(bronze)),
        policies.policy_conformance(bronze),
        replies.history_prompts(bronze),
        quality.dq_report(bronze),
    ):
        plan = plan_of(df)
        for spec in re.findall(r"windowspecdefinition\((run_id[^)]*?player_b#\d+), ([^ ]+)", plan):
            assert "block" in spec[1]


def test_run_filter_reaches_every_read_of_the_history(bronze):
    plan = plan_of(replies.history_prompts(bronze).where("run_id = 'r'"))
    # The third read is for texts that are neither of the two moves.
    assert plan.count("FileScan parquet") == 3
    assert plan.count("EqualTo(run_id,r)") == 3
    assert plan.count("Not(In(choice_a") == 1


def test_gains_need_no_join(bronze):
    plan = plan_of(add_gains(bronze.drop("gain_a", "gain_b")))
    assert "Join" not in plan and "Exchange" not in plan


def test_quality_report_shuffles_rounds_once(bronze):
    plan = plan_of(quality.dq_report(bronze))
    assert plan.count("FileScan parquet") == 2
    # Of the exchanges on match and block, one moves rounds; the others move folded blocks.
    assert plan.count("REPARTITION_BY_COL") == 1
    by_tour = re.findall(r"Exchange hashpartitioning\(([^)]*)\)", plan)
    assert not any("tour" in keys for keys in by_tour)


def test_quality_report_holds_no_table_of_rounds(bronze):
    """What a block inherits is a row of the same shuffle; no aggregate is kept per round."""
    plan = plan_of(quality.dq_report(bronze))
    assert "Join" not in plan
    assert not re.search(r"Aggregate\(keys=\[[^]]*tour#", plan)


def test_quality_report_with_missing_and_negative_numbers(spark):
    rows = match_rows("r", "x", "y", ["CD"] * 7, [-9, -2, -1, 1, 2, 3, 5])
    rows += [rows[3], (*rows[4][:9], 99), ("r", None, *rows[0][2:]), ("r", None, *rows[5][2:])]
    report = quality.dq_report(spark.createDataFrame(rows, BRONZE), block_bits=1)
    assert {r.rule: (r.checked, r.violations) for r in report.collect()} == {
        "choice_domain": (11, 0),
        "gain_domain": (11, 0),
        "gain_is_payoff": (11, 0),
        "key_not_null": (11, 2),
        "cumul_is_running_sum": (8, 7),
        "unique_round": (8, 3),
        "dense_tours": (8, 5),
    }


def test_saved_queries_filter_in_the_scan(spark, bronze, tmp_path):
    build(bronze, str(tmp_path), select=("gold",))
    drift = read_gold(spark, str(tmp_path), "gold_behavioral_drift")
    matrix = read_gold(spark, str(tmp_path), "gold_matchup_matrix")
    assert "EqualTo(strategy,x)" in plan_of(saved.strategy_drift(drift, "x"))
    assert "EqualTo(player_a,x)" in plan_of(saved.matchup_lookup(matrix, "x"))


def test_rebuild_reads_only_the_folders_of_named_runs(spark, bronze_of, tmp_path):
    path = str(tmp_path / "bronze")
    append_bronze(bronze_of(*[(f"run{i}", "x", "y", ["CD"] * 5) for i in range(20)]), path)
    runs = materialise(spark.createDataFrame([("run3",), ("run7",)], "run_id string"), "runs")
    rounds = runs_only(read_bronze(spark, path), runs)
    assert {r.run_id for r in rounds.collect()} == {"run3", "run7"}
    assert "dynamicpruning" in plan_of(rounds)


def test_no_python_and_no_cross_join(bronze):
    silver = silver_rounds(bronze)
    jobs = [getattr(gold, name)(silver) for name in gold_names()]
    jobs += [
        policies.policy_conformance(bronze),
        policies.counterfactual_replay(bronze),
        replies.history_prompts(bronze),
        quality.dq_report(bronze),
        quality.tournament_stats(bronze),
    ]
    for df in jobs:
        plan = plan_of(df)
        for node in ("Python", "Pandas", "CartesianProduct", "BroadcastNestedLoopJoin"):
            assert node not in plan


def gold_names():
    return [name for name in dir(gold) if name.startswith("gold_")]
