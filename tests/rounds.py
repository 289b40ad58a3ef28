"""Hand-made rounds and a row-at-a-time reading of the models to compare with."""

from __future__ import annotations

from collections import defaultdict

from tourney.schema import COOPERATE, DEFECT, PAYOFF

MOVE = {"C": COOPERATE, "D": DEFECT, "-": None}


def match_rows(run, a, b, moves, tours=None):
    """Bronze rows of one match; ``moves`` is a list of two-letter pairs, A's move first."""
    rows, score_a, score_b = [], 0, 0
    for number, pair in zip(tours or range(1, len(moves) + 1), moves):
        move_a, move_b = MOVE[pair[0]], MOVE[pair[1]]
        gain_a, gain_b = PAYOFF.get((move_a, move_b)), PAYOFF.get((move_b, move_a))
        score_a, score_b = score_a + (gain_a or 0), score_b + (gain_b or 0)
        rows.append((run, number, a, b, move_a, move_b, gain_a, gain_b, score_a, score_b))
    return rows


# The three pairings whose 2000 rounds follow from the strategies alone.
FULL_MATCHES = (
    ("r", "T", "D", ["CD"] + ["DD"] * 1999),
    ("r", "T", "C", ["CC"] * 2000),
    ("r", "C", "D", ["CD"] * 2000),
)


def sides_in_order(rows):
    """(run, strategy, [(tour, mine, theirs, my gain)]) of each side of each match."""
    matches = defaultdict(list)
    for row in rows:
        matches[row[0], row[2], row[3]].append(row)
    for (run, a, b), played in matches.items():
        played.sort(key=lambda row: row[1])
        yield run, a, [(r[1], r[4], r[5], r[6]) for r in played]
        yield run, b, [(r[1], r[5], r[4], r[7]) for r in played]


def forgiveness_counts(rows):
    """{(run, strategy): (betrayals, forgiven)} by walking through each side's rounds."""
    counts = {}
    for run, strategy, played in sides_in_order(rows):
        for before, now in zip(played, played[1:]):
            if before[2] is None:
                continue
            betrayals, forgiven = counts.get((run, strategy), (0, 0))
            betrayed = before[2] == DEFECT
            counts[run, strategy] = (
                betrayals + betrayed,
                forgiven + (betrayed and now[1] == COOPERATE),
            )
    return counts


def conformance_counts(rows):
    """{(run, strategy, policy): rounds agreeing with it} by playing each policy round by round."""
    agreeing = defaultdict(int)
    for run, strategy, played in sides_in_order(rows):
        theirs = []
        for _, mine, opponent, _ in played:
            policies = {
                "always_cooperate": COOPERATE,
                "always_defect": DEFECT,
                "tit_for_tat": (theirs[-1] if theirs else None) or COOPERATE,
                "grim_trigger": DEFECT if DEFECT in theirs else COOPERATE,
            }
            for policy, move in policies.items():
                agreeing[run, strategy, policy] += move == mine
            theirs.append(opponent)
    return dict(agreeing)
