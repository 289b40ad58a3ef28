"""What a policy would have played against the recorded opponent moves, and what it would have won.

A policy sees only earlier rounds and the recorded opponent. The fixed ones are column expressions
over the match history. Own policies are finite automata, given as data: ``own_policy_conformance``
and ``own_policy_replay`` fold the rounds of each block to a table over their states.
"""

from __future__ import annotations

import json
from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tourney.functions.rounds import (
    COOPERATED,
    DEFECTED,
    defected,
    flag,
    move_code,
    payoff,
    rate_pct,
)
from tourney.operators import automata
from tourney.operators.automata import Machine, run_machines
from tourney.operators.history import BLOCK_BITS, over_history
from tourney.schema import COOPERATE, DEFECT, MATCH, PAYOFF

HISTORY_POLICIES = ("always_cooperate", "always_defect", "tit_for_tat", "grim_trigger")
REPLAY_POLICIES = (*HISTORY_POLICIES, "random")

SIDES = (("a", "b"), ("b", "a"))


def seeded_move(seed: int, side: str) -> Column:
    """Repeatable coin toss for one side of one round of one match.

    Names go in with their lengths, and missing ones too, so that no two rounds share a toss.
    """
    names = [F.col(c).cast("string") for c in (*MATCH, "tour")]
    told = [F.coalesce(F.concat(F.length(c), F.lit(":"), c), F.lit("-")) for c in names]
    digest = F.md5(F.concat_ws("|", F.lit(str(seed)), *told, F.lit(side)))
    return F.when(F.substring(digest, 1, 1) < "8", COOPERATE).otherwise(DEFECT)


def replay(
    rounds: DataFrame, seed: int = 0, order: str = "tour", block_bits: int = BLOCK_BITS
) -> DataFrame:
    """Rounds with the move of every policy for both sides, ``<policy>_a`` and ``<policy>_b``.

    A match opens with COOPERATE, and a missing last move of the opponent counts as that too.
    """
    moves = rounds.select(
        *MATCH,
        *dict.fromkeys(("tour", order)),
        "choice_a",
        "choice_b",
        flag(defected("choice_a")).alias("defected_a"),
        flag(defected("choice_b")).alias("defected_b"),
    )
    replayed = over_history(
        moves,
        moves={"last_a": "choice_a", "last_b": "choice_b"},
        before={"betrayals_by_a": "defected_a", "betrayals_by_b": "defected_b"},
        order=order,
        block_bits=block_bits,
    )
    columns = {}
    for mine, theirs in SIDES:
        betrayed = F.col(f"betrayals_by_{theirs}") > 0
        columns |= {
            f"tit_for_tat_{mine}": F.coalesce(f"last_{theirs}", F.lit(COOPERATE)),
            f"grim_trigger_{mine}": F.when(betrayed, DEFECT).otherwise(COOPERATE),
            f"always_cooperate_{mine}": F.lit(COOPERATE),
            f"always_defect_{mine}": F.lit(DEFECT),
            f"random_{mine}": seeded_move(seed, mine),
        }
    return replayed.withColumns(columns)


def _per_strategy(
    per_match: DataFrame, policies: Sequence[str], measures: dict[str, str]
) -> DataFrame:
    """One row per match, side and policy; ``measures`` are column names by policy and side."""
    rows = [
        F.struct(
            F.col(f"player_{side}").alias("strategy"),
            F.lit(policy).alias("policy"),
            *[
                F.col(column.format(policy=policy, side=side)).alias(name)
                for name, column in measures.items()
            ],
        )
        for policy in policies
        for side, _ in SIDES
    ]
    return per_match.select("run_id", "rounds", F.inline(F.array(*rows)))


def policy_conformance(
    rounds: DataFrame, order: str = "tour", block_bits: int = BLOCK_BITS
) -> DataFrame:
    """Share of a strategy's recorded moves that equal the policy's move."""
    per_match = (
        replay(rounds, order=order, block_bits=block_bits)
        .groupBy(*MATCH)
        .agg(
            F.count(F.lit(1)).alias("rounds"),
            *[
                F.count_if(F.col(f"{policy}_{side}") == F.col(f"choice_{side}")).alias(
                    f"{policy}_{side}"
                )
                for policy in HISTORY_POLICIES
                for side, _ in SIDES
            ],
        )
    )
    return _conformance(per_match, HISTORY_POLICIES)


def _conformance(per_match: DataFrame, names: Sequence[str]) -> DataFrame:
    return (
        _per_strategy(per_match, names, {"conforming": "{policy}_{side}"})
        .groupBy("run_id", "strategy", "policy")
        .agg(F.sum("rounds").alias("rounds"), F.sum("conforming").alias("conforming"))
        .withColumn("conformance_pct", rate_pct(F.col("conforming"), F.col("rounds")))
    )


def counterfactual_replay(
    rounds: DataFrame, seed: int = 0, order: str = "tour", block_bits: int = BLOCK_BITS
) -> DataFrame:
    """Score of each policy against the recorded opponent moves, next to the recorded score.

    Both scores add up the same rounds, those where both recorded moves are known;
    ``scored_rounds`` counts them and ``rounds`` all.
    """
    known = payoff(F.col("choice_a"), F.col("choice_b")).isNotNull()
    won = {
        f"{player}_{mine}": F.sum(
            F.when(known, payoff(F.col(f"{move}_{mine}"), F.col(f"choice_{theirs}")))
        )
        for player, move in (("recorded", "choice"), *((p, p) for p in REPLAY_POLICIES))
        for mine, theirs in SIDES
    }
    per_match = (
        replay(rounds, seed, order, block_bits)
        .groupBy(*MATCH)
        .agg(
            F.count(F.lit(1)).alias("rounds"),
            F.count_if(known).alias("scored"),
            *[score.alias(name) for name, score in won.items()],
        )
    )
    return _replay_scores(per_match, REPLAY_POLICIES)


def _replay_scores(per_match: DataFrame, names: Sequence[str]) -> DataFrame:
    return (
        _per_strategy(
            per_match,
            names,
            {"scored": "scored", "recorded": "recorded_{side}", "replayed": "{policy}_{side}"},
        )
        .groupBy("run_id", "strategy", "policy")
        .agg(
            F.sum("rounds").alias("rounds"),
            F.sum("scored").alias("scored_rounds"),
            F.sum("recorded").alias("recorded_score"),
            F.sum("replayed").alias("replayed_score"),
        )
        .withColumn("score_change", F.col("replayed_score") - F.col("recorded_score"))
    )


@dataclass(frozen=True)
class Policy:
    """A policy as a finite automaton; it opens in the first state.

    ``moves`` has the move it plays in each state, ``after`` for each state the next one by what was
    played there, its own move first: ``CC``, ``CD``, ``DC``, ``DD``. A missing or unknown move counts
    as ``C``.
    """

    name: str
    moves: tuple[str, ...]
    after: tuple[Mapping[str, int], ...]

    def __post_init__(self) -> None:
        states = range(len(self.moves))
        if not states or len(self.after) != len(states):
            raise ValueError(f"{self.name}: one row of next states for each move")
        if set(self.moves) - {COOPERATE, DEFECT}:
            raise ValueError(f"{self.name}: moves are {COOPERATE} and {DEFECT}")
        for row in self.after:
            if set(row) != set(_PLAYED) or any(to not in states for to in row.values()):
                raise ValueError(f"{self.name}: a next state for each of {_PLAYED}")


_PLAYED = ("CC", "CD", "DC", "DD")

# Keeps its move after a good round, changes it after a bad one.
PAVLOV = Policy(
    "pavlov",
    (COOPERATE, DEFECT),
    ({"CC": 0, "CD": 1, "DC": 1, "DD": 0},) * 2,
)
# Defects once the opponent has defected twice in a row.
TIT_FOR_TWO_TATS = Policy(
    "tit_for_two_tats",
    (COOPERATE, COOPERATE, DEFECT),
    (
        {"CC": 0, "CD": 1, "DC": 0, "DD": 1},
        {"CC": 0, "CD": 2, "DC": 0, "DD": 2},
        {"CC": 0, "CD": 2, "DC": 0, "DD": 2},
    ),
)
OWN_POLICIES = (PAVLOV, TIT_FOR_TWO_TATS)


def policies_from_json(text: str) -> list[Policy]:
    """Policies written as ``[{"name": ..., "moves": [...], "after": [{"CC": 0, ...}, ...]}, ...]``."""
    return [Policy(p["name"], tuple(p["moves"]), tuple(p["after"])) for p in json.loads(text)]


# A letter is the pair of codes of both recorded moves.
_CODES = range(4)
_MOVE_OF = {COOPERATED: COOPERATE, DEFECTED: DEFECT}


def _letter() -> Column:
    return move_code("choice_a") * len(_CODES) + move_code("choice_b")


def _machine(policy: Policy, side: str, replays: bool) -> Machine:
    """The policy on one side. A replay goes on from its own moves, an audit from the recorded ones."""
    after, worth = [], []
    for a in _CODES:
        for b in _CODES:
            mine, theirs = (_MOVE_OF.get(c) for c in ((a, b) if side == "a" else (b, a)))
            recorded = "D" if mine == DEFECT else "C"
            faced = "D" if theirs == DEFECT else "C"
            known = (mine, theirs) in PAYOFF
            nexts, earned = [], []
            for state, move in enumerate(policy.moves):
                own = move[0] if replays else recorded
                nexts.append(policy.after[state][own + faced])
                won = PAYOFF[move, theirs] if known else 0
                earned.append(won if replays else int(move == mine))
            after.append(tuple(nexts))
            worth.append(tuple(earned))
    return Machine(0, tuple(after), tuple(worth))


def _by_match(
    rounds: DataFrame,
    policies: Sequence[Policy],
    replays: bool,
    totals: Mapping[str, Column],
    order: str,
    block_bits: int,
) -> DataFrame:
    """Totals per match, and what every policy has earned on both sides, ``<policy>_<side>``."""
    names = [policy.name for policy in policies]
    if not names or len(set(names)) < len(names):
        raise ValueError(f"policies need names of their own: {names}")
    machines = [_machine(policy, side, replays) for policy in policies for side, _ in SIDES]
    matches = run_machines(rounds, machines, _letter(), totals, order, block_bits)
    columns = [f"{name}_{side}" for name in names for side, _ in SIDES]
    return matches.select(
        *MATCH, *totals, *[F.col("worth")[i].alias(c) for i, c in enumerate(columns)]
    )


def own_policy_conformance(
    rounds: DataFrame,
    policies: Sequence[Policy] = OWN_POLICIES,
    order: str = "tour",
    block_bits: int = automata.BLOCK_BITS,
) -> DataFrame:
    """``policy_conformance`` of policies given as automata, which see all recorded moves."""
    totals = {"rounds": F.lit(1).cast("bigint")}
    per_match = _by_match(rounds, policies, False, totals, order, block_bits)
    names = [policy.name for policy in policies]
    return _conformance(per_match, names)


def own_policy_replay(
    rounds: DataFrame,
    policies: Sequence[Policy] = OWN_POLICIES,
    order: str = "tour",
    block_bits: int = automata.BLOCK_BITS,
) -> DataFrame:
    """``counterfactual_replay`` of policies given as automata, which see their own replayed moves."""
    a, b = F.col("choice_a"), F.col("choice_b")
    totals = {
        "rounds": F.lit(1).cast("bigint"),
        "scored": flag(payoff(a, b).isNotNull()).cast("bigint"),
        "recorded_a": payoff(a, b),
        "recorded_b": payoff(b, a),
    }
    per_match = _by_match(rounds, policies, True, totals, order, block_bits)
    for policy in policies:
        for side, _ in SIDES:
            # Without a scored round there is no score, as there is no recorded one.
            column = f"{policy.name}_{side}"
            scored = F.when(F.col("scored") > 0, F.col(column))
            per_match = per_match.withColumn(column, scored)
    return _replay_scores(per_match, [policy.name for policy in policies])
