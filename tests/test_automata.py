"""Policies as automata against a walk through the rounds."""

import json
import random
import re

import pytest
from pyspark.sql import functions as F

from tests.rounds import match_rows, sides_in_order
from tests.test_plans import plan_of
from tourney.operators import automata, blocks
from tourney.plans import policies
from tourney.plans.policies import (
    OWN_POLICIES,
    PAVLOV,
    Policy,
    own_policy_conformance,
    own_policy_replay,
    policies_from_json,
)
from tourney.schema import BRONZE, COOPERATE, DEFECT, PAYOFF
from tourney.session import materialise

MOVES = ["CC", "CD", "DC", "DD", "-D", "C-"]

# Counts the opponent's defections up to three, then forgives after as many good rounds.
GRADUAL = Policy(
    "gradual",
    (COOPERATE, COOPERATE, DEFECT, DEFECT, DEFECT),
    (
        {"CC": 0, "CD": 1, "DC": 0, "DD": 1},
        {"CC": 0, "CD": 2, "DC": 3, "DD": 2},
        {"CC": 3, "CD": 2, "DC": 3, "DD": 4},
        {"CC": 0, "CD": 4, "DC": 1, "DD": 4},
        {"CC": 2, "CD": 4, "DC": 2, "DD": 4},
    ),
)


def walk(rows, chosen):
    """{(run, strategy, policy): [rounds, conforming, scored, recorded, replayed]} round by round."""
    found = {}
    for run, strategy, played in sides_in_order(rows):
        for policy in chosen:
            audit = replay = 0
            sums = found.setdefault((run, strategy, policy.name), [0] * 5)
            for _, mine, theirs, _ in played:
                sums[0] += 1
                sums[1] += policy.moves[audit] == mine
                if (mine, theirs) in PAYOFF:
                    sums[2] += 1
                    sums[3] += PAYOFF[mine, theirs]
                    sums[4] += PAYOFF[policy.moves[replay], theirs]
                faced = "D" if theirs == DEFECT else "C"
                own = "D" if mine == DEFECT else "C"
                audit = policy.after[audit][own + faced]
                replay = policy.after[replay][policy.moves[replay][0] + faced]
    return found


def rounds_of(seed):
    draw = random.Random(seed)
    rows = []
    for a, b in (("x", "y"), ("y", "x"), ("x", "x"), (None, "y"), ("z", None)):
        count = draw.choice([1, 3, 170, 400])
        tours = sorted(draw.sample(range(-300, 3000), count))
        rows += match_rows("r", a, b, draw.choices(MOVES, k=count), tours)
    return rows


@pytest.mark.parametrize("block_bits", [0, 3, 6, 9])
def test_policies_equal_walking_through_rounds(spark, monkeypatch, block_bits):
    monkeypatch.setattr(automata, "FAN_BITS", 3)
    monkeypatch.setattr(blocks, "ORDER_BITS", 13)
    rows, chosen = rounds_of(block_bits), (*OWN_POLICIES, GRADUAL)
    bronze = spark.createDataFrame(rows, BRONZE)
    want = walk(rows, chosen)
    audit = own_policy_conformance(bronze, chosen, block_bits=block_bits).collect()
    assert {(r.run_id, r.strategy, r.policy): (r.rounds, r.conforming) for r in audit} == {
        key: tuple(sums[:2]) for key, sums in want.items()
    }
    replayed = own_policy_replay(bronze, chosen, block_bits=block_bits).collect()
    assert {
        (r.run_id, r.strategy, r.policy): (
            r.rounds, r.scored_rounds, r.recorded_score or 0, r.replayed_score or 0
        )
        for r in replayed
    } == {key: (sums[0], *sums[2:]) for key, sums in want.items()}


def test_one_long_match_spans_groups_of_blocks(spark):
    count = 40_000
    rounds = spark.range(count).select(
        F.lit("r").alias("run_id"),
        (F.col("id") * 1_000_003).alias("tour"),
        F.lit("x").alias("player_a"),
        F.lit("y").alias("player_b"),
        F.when(F.xxhash64("id") % 3 == 0, DEFECT).otherwise(COOPERATE).alias("choice_a"),
        F.when(F.xxhash64("id", F.lit(1)) % 4 == 0, DEFECT).otherwise(COOPERATE).alias("choice_b"),
    )
    rows = [(r[0], r[1], r[2], r[3], r[4], r[5], None) for r in rounds.collect()]
    want = walk([(*r, None, None, None) for r in rows], (PAVLOV, GRADUAL))
    got = own_policy_replay(rounds, (PAVLOV, GRADUAL)).collect()
    assert {(r.run_id, r.strategy, r.policy): r.replayed_score for r in got} == {
        key: sums[4] for key, sums in want.items()
    }


def test_rounds_are_read_and_shuffled_once(spark):
    rounds = materialise(spark.createDataFrame(rounds_of(1), BRONZE), "automata")
    for df in (own_policy_conformance(rounds), own_policy_replay(rounds)):
        plan = plan_of(df)
        assert plan.count("FileScan parquet") == 1
        assert not re.search(r"Window|Python|Join", plan)
        # The shuffle next to the scan is by match and block.
        assert "player_b" in re.findall(r"Exchange hashpartitioning\(([^)]*)\)", plan)[-1]
        assert "_groupingexpression" in re.findall(r"Exchange hashpartitioning\(([^)]*)\)", plan)[-1]


def test_rounds_travel_as_one_number(spark):
    rounds = materialise(spark.createDataFrame(rounds_of(1), BRONZE), "automata")
    for df in (own_policy_conformance(rounds), own_policy_replay(rounds)):
        # From the scan up to the first shuffle there is no table over the states.
        before_shuffle = plan_of(df).rsplit("Exchange hashpartitioning", 1)[1]
        assert "collect_list(step" in before_shuffle
        assert not re.search("worth|array", before_shuffle)


def test_copies_of_a_round_in_any_file_order(spark):
    rows = match_rows("r", "x", "y", ["CD", "DD", "CC"]) + match_rows("r", "x", "y", ["DC", "CC", "CD"])
    rows += [("r", None, "x", "y", *row[4:]) for row in rows]
    found = [
        sorted(map(repr, own_policy_replay(spark.createDataFrame(given, BRONZE)).collect()))
        for given in (rows, rows[::-1])
    ]
    assert found[0] == found[1]


def test_policies_as_data():
    text = json.dumps([{"name": p.name, "moves": p.moves, "after": p.after} for p in OWN_POLICIES])
    assert policies_from_json(text) == list(OWN_POLICIES)
    with pytest.raises(ValueError):
        Policy("broken", (COOPERATE,), ({"CC": 0, "CD": 1, "DC": 0, "DD": 0},))
    with pytest.raises(ValueError):
        Policy("broken", ("WAIT",), ({"CC": 0, "CD": 0, "DC": 0, "DD": 0},))


def test_names_must_differ(spark):
    bronze = spark.createDataFrame(rounds_of(2), BRONZE)
    with pytest.raises(ValueError):
        own_policy_replay(bronze, (PAVLOV, PAVLOV))


def test_tosses_of_names_with_separators(spark):
    rows = [("r", 1, "a|b", "c"), ("r", 1, "a", "b|c"), ("r", 1, None, "a"), ("r", 1, "a", None)]
    table = spark.createDataFrame(rows, "run_id string, tour bigint, player_a string, player_b string")
    tosses = [policies.seeded_move(seed, "a").alias(f"s{seed}") for seed in range(24)]
    assert len({tuple(row) for row in table.select(*tosses).collect()}) == len(rows)
