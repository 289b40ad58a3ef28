"""The registered queries as DuckDB SQL over the same tables, written independently of the jobs."""

from __future__ import annotations

PAYOFF = """
payoff(mine, theirs, gain) AS (
  VALUES ('COOPERATE', 'COOPERATE', 3::BIGINT), ('COOPERATE', 'DEFECT', 0::BIGINT),
         ('DEFECT', 'COOPERATE', 5::BIGINT), ('DEFECT', 'DEFECT', 1::BIGINT)
)"""

MOVES = """
moves AS (
  SELECT CAST(year(l.l_shipdate) AS VARCHAR) AS run_id,
         ra.r_name AS player_a,
         rb.r_name AS player_b,
         CASE WHEN l.l_returnflag = 'R' THEN 'DEFECT' ELSE 'COOPERATE' END AS choice_a,
         CASE WHEN l.l_discount < 0.035 THEN 'DEFECT' ELSE 'COOPERATE' END AS choice_b,
         row_number() OVER (
           PARTITION BY year(l.l_shipdate), ra.r_name, rb.r_name
           ORDER BY l.l_shipdate, l.l_orderkey, l.l_linenumber, l.l_partkey, l.l_suppkey,
                    l.l_extendedprice) AS tour
  FROM lineitem l
  JOIN orders o ON l.l_orderkey = o.o_orderkey
  JOIN customer c ON o.o_custkey = c.c_custkey
  JOIN nation na ON c.c_nationkey = na.n_nationkey
  JOIN region ra ON na.n_regionkey = ra.r_regionkey
  JOIN supplier s ON l.l_suppkey = s.s_suppkey
  JOIN nation nb ON s.s_nationkey = nb.n_nationkey
  JOIN region rb ON nb.n_regionkey = rb.r_regionkey
)"""

SCORED = """
scored AS (
  SELECT m.*, pa.gain AS gain_a, pb.gain AS gain_b
  FROM moves m
  LEFT JOIN payoff pa ON m.choice_a = pa.mine AND m.choice_b = pa.theirs
  LEFT JOIN payoff pb ON m.choice_b = pb.mine AND m.choice_a = pb.theirs
)"""

BRONZE = """
bronze AS (
  SELECT run_id, tour, player_a, player_b, choice_a, choice_b, gain_a, gain_b,
         CAST(sum(gain_a) OVER m AS BIGINT) AS cumul_a,
         CAST(sum(gain_b) OVER m AS BIGINT) AS cumul_b
  FROM scored
  WINDOW m AS (PARTITION BY run_id, player_a, player_b ORDER BY tour ROWS UNBOUNDED PRECEDING)
)"""

SILVER = """
silver AS (
  SELECT *,
         player_a || '_vs_' || player_b AS matchup_id,
         CAST(coalesce(choice_a = 'COOPERATE', false) AS INTEGER) AS cooperated_a,
         CAST(coalesce(choice_b = 'COOPERATE', false) AS INTEGER) AS cooperated_b,
         CAST(coalesce(choice_a = 'DEFECT', false) AS INTEGER) AS defected_a,
         CAST(coalesce(choice_b = 'DEFECT', false) AS INTEGER) AS defected_b,
         CASE WHEN choice_a = 'COOPERATE' AND choice_b = 'COOPERATE' THEN 1 ELSE 0 END
           AS mutual_cooperation,
         CASE WHEN choice_a = 'DEFECT' AND choice_b = 'DEFECT' THEN 1 ELSE 0 END
           AS mutual_defection,
         CASE WHEN choice_a = 'DEFECT' AND choice_b = 'COOPERATE' THEN 1 ELSE 0 END
           AS exploitation_by_a,
         CASE WHEN choice_b = 'DEFECT' AND choice_a = 'COOPERATE' THEN 1 ELSE 0 END
           AS exploitation_by_b,
         CAST((tour + 99) // 100 * 100 AS BIGINT) AS tour_bucket,
         CASE sign(gain_a - gain_b) WHEN 1 THEN player_a WHEN -1 THEN player_b ELSE 'draw' END
           AS tour_winner
  FROM bronze
)"""

SIDES = """
sides AS (
  SELECT run_id, tour, 'A' AS side, player_a AS strategy, player_b AS opponent, matchup_id,
         tour_bucket, choice_a AS choice, choice_b AS opponent_choice, gain_a AS gain,
         cumul_a AS cumul, cooperated_a AS cooperated, defected_a AS defected,
         exploitation_by_a AS exploitation_done, exploitation_by_b AS exploitation_received
  FROM silver
  UNION ALL
  SELECT run_id, tour, 'B', player_b, player_a, matchup_id,
         tour_bucket, choice_b, choice_a, gain_b,
         cumul_b, cooperated_b, defected_b, exploitation_by_b, exploitation_by_a
  FROM silver
)"""

SUMMARY = """
summary AS (
  SELECT run_id, strategy,
         CAST(sum(final_score) AS BIGINT) AS total_score,
         round(sum(cooperations) / sum(tours) * 100, 2) AS cooperation_rate_pct,
         CAST(sum(cooperations) AS BIGINT) AS total_cooperations,
         CAST(sum(defections) AS BIGINT) AS total_defections,
         CAST(sum(exploitations) AS BIGINT) AS total_exploitations,
         count(DISTINCT matchup_id) AS nb_matchups,
         rank() OVER (PARTITION BY run_id ORDER BY sum(final_score) DESC) AS ranking
  FROM (SELECT run_id, strategy, side, matchup_id, max(cumul) AS final_score, count(*) AS tours,
               sum(cooperated) AS cooperations, sum(defected) AS defections,
               sum(exploitation_done) AS exploitations
        FROM sides GROUP BY ALL)
  GROUP BY run_id, strategy
)"""

MATRIX = """
matrix AS (
  SELECT run_id, player_a, player_b, matchup_id,
         max(cumul_a) AS final_score_a,
         max(cumul_b) AS final_score_b,
         round(avg(cooperated_a) * 100, 2) AS cooperation_rate_a_pct,
         round(avg(cooperated_b) * 100, 2) AS cooperation_rate_b_pct,
         CAST(sum(exploitation_by_a) AS BIGINT) AS exploitations_by_a,
         CAST(sum(exploitation_by_b) AS BIGINT) AS exploitations_by_b,
         CASE WHEN max(cumul_a) = max(cumul_b) THEN 'draw'
              WHEN max(cumul_a) > max(cumul_b) THEN player_a ELSE player_b END AS match_winner
  FROM silver
  GROUP BY run_id, player_a, player_b, matchup_id
)"""

DRIFT = """
drift AS (
  SELECT run_id, strategy, opponent, matchup_id, tour_bucket,
         round(avg(cooperated) * 100, 2) AS cooperation_rate_pct,
         CAST(sum(gain) AS BIGINT) AS total_gain,
         CAST(sum(exploitation_done) AS BIGINT) AS exploitations_done,
         CAST(sum(exploitation_received) AS BIGINT) AS exploitations_received
  FROM sides
  GROUP BY run_id, side, strategy, opponent, matchup_id, tour_bucket
)"""

FORGIVENESS = """
answers AS (
  SELECT run_id, strategy, choice,
         lag(opponent_choice) OVER (
           PARTITION BY run_id, side, strategy, opponent ORDER BY tour) AS faced
  FROM sides
),
forgiveness AS (
  SELECT *, rank() OVER (
           PARTITION BY run_id ORDER BY forgiveness_index_pct DESC NULLS LAST) AS forgiveness_rank
  FROM (SELECT run_id, strategy,
               count(*) FILTER (faced = 'DEFECT') AS total_betrayals_received,
               count(*) FILTER (faced = 'DEFECT' AND choice = 'COOPERATE') AS total_forgiven,
               round(count(*) FILTER (faced = 'DEFECT' AND choice = 'COOPERATE')
                     / nullif(count(*) FILTER (faced = 'DEFECT'), 0) * 100, 2)
                 AS forgiveness_index_pct
        FROM answers WHERE faced IS NOT NULL GROUP BY run_id, strategy)
)"""

# Every side of every round with what each policy would have played there.
REPLAY = """
seen AS (
  SELECT run_id, strategy, opponent, side, tour, choice, opponent_choice,
         lag(opponent_choice) OVER m AS faced,
         count(*) FILTER (opponent_choice = 'DEFECT') OVER (
           m ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS betrayals_before
  FROM sides
  WINDOW m AS (PARTITION BY run_id, side, strategy, opponent ORDER BY tour)
),
replay AS (
  SELECT s.run_id, s.strategy, s.choice, s.opponent_choice, p.policy,
         CASE p.policy
           WHEN 'always_cooperate' THEN 'COOPERATE'
           WHEN 'always_defect' THEN 'DEFECT'
           WHEN 'tit_for_tat' THEN coalesce(s.faced, 'COOPERATE')
           WHEN 'grim_trigger' THEN if(s.betrayals_before > 0, 'DEFECT', 'COOPERATE')
           ELSE if(substr(md5(concat_ws('|', '0',
             coalesce(length(s.run_id) || ':' || s.run_id, '-'),
             coalesce(length(if(s.side = 'A', s.strategy, s.opponent)) || ':'
                      || if(s.side = 'A', s.strategy, s.opponent), '-'),
             coalesce(length(if(s.side = 'A', s.opponent, s.strategy)) || ':'
                      || if(s.side = 'A', s.opponent, s.strategy), '-'),
             coalesce(length(CAST(s.tour AS VARCHAR)) || ':' || s.tour, '-'),
             lower(s.side))), 1, 1) < '8',
                   'COOPERATE', 'DEFECT')
         END AS policy_choice
  FROM seen s
  CROSS JOIN (VALUES ('always_cooperate'), ('always_defect'), ('tit_for_tat'), ('grim_trigger'),
                     ('random')) AS p(policy)
)"""

# Own policies: Pavlov repeats its move after like moves, so a replay of it defects after an odd number
# of defections; tit for two tats defects after two of them in a row.
OWN_POLICIES = """
met AS (
  SELECT *, coalesce(choice = 'DEFECT', false) AS mine, coalesce(opponent_choice = 'DEFECT', false)
    AS theirs
  FROM sides
),
own_replay AS (
  SELECT s.run_id, s.strategy, s.choice, s.opponent_choice, p.policy,
         if(CASE WHEN p.policy = 'tit_for_two_tats' THEN theirs_1 AND theirs_2
                 WHEN p.sees = 'recorded' THEN mine_1 <> theirs_1
                 ELSE betrayals % 2 = 1 END, 'DEFECT', 'COOPERATE') AS policy_choice,
         p.sees
  FROM (SELECT *, lag(theirs, 1, false) OVER m AS theirs_1, lag(theirs, 2, false) OVER m AS theirs_2,
               lag(mine, 1, false) OVER m AS mine_1,
               count(*) FILTER (theirs) OVER (m ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
                 AS betrayals
        FROM met WINDOW m AS (PARTITION BY run_id, side, strategy, opponent ORDER BY tour)) s
  CROSS JOIN (VALUES ('pavlov', 'recorded'), ('tit_for_two_tats', 'recorded'), ('pavlov', 'own'),
                     ('tit_for_two_tats', 'own')) AS p(policy, sees)
)"""

# Faults that follow from the round number; the names of the clean and the faulty rounds are such
# that what follows reads the faulty ones.
FAULTS = """
bronze AS (
  SELECT * REPLACE (CASE WHEN tour % 11 = 3 THEN NULL ELSE choice_a END AS choice_a,
                    CASE WHEN tour % 13 = 5 THEN 'MAYBE' ELSE choice_b END AS choice_b)
  FROM recorded WHERE tour % 17 <> 9
)"""

BROKEN = """
bronze AS (
  SELECT * REPLACE (CASE WHEN tour % 23 = 6 THEN 7 ELSE gain_a END AS gain_a,
                    CASE WHEN tour % 29 = 8 THEN cumul_b + 1 ELSE cumul_b END AS cumul_b,
                    CASE WHEN tour % 31 = 10 THEN NULL ELSE player_b END AS player_b)
  FROM faulty JOIN (VALUES (1), (2)) AS c(copy) ON copy = 1 OR tour % 19 = 4
)"""


def _renamed(part: str, name: str) -> str:
    return part.replace("bronze AS (", f"{name} AS (", 1)


_TO_SCORED = (PAYOFF, MOVES, SCORED)
_TO_BRONZE = (*_TO_SCORED, BRONZE)
_TO_SILVER = (*_TO_BRONZE, SILVER)
_TO_SIDES = (*_TO_SILVER, SIDES)

_TO_FAULTY = (*_TO_SCORED, _renamed(BRONZE, "recorded"), FAULTS)
_FAULTY_SIDES = (*_TO_FAULTY, SILVER, SIDES)
_TO_BROKEN = (*_TO_FAULTY[:-1], _renamed(FAULTS, "faulty"), BROKEN)

def _own(sees: str) -> str:
    return f"replay AS (SELECT * FROM own_replay WHERE sees = '{sees}')"


CONFORMANCE = """
SELECT run_id, strategy, policy, count(*) AS rounds,
       count(*) FILTER (choice = policy_choice) AS conforming,
       round(count(*) FILTER (choice = policy_choice) / count(*) * 100, 2) AS conformance_pct
FROM replay WHERE policy <> 'random'
GROUP BY run_id, strategy, policy"""

COUNTERFACTUAL = """
SELECT r.run_id, r.strategy, r.policy, count(*) AS rounds,
       count(played.gain) AS scored_rounds,
       CAST(sum(played.gain) AS BIGINT) AS recorded_score,
       CAST(sum(replayed.gain) FILTER (played.gain IS NOT NULL) AS BIGINT) AS replayed_score,
       CAST(sum(replayed.gain) FILTER (played.gain IS NOT NULL) - sum(played.gain) AS BIGINT)
         AS score_change
FROM replay r
LEFT JOIN payoff played ON played.mine = r.choice AND played.theirs = r.opponent_choice
LEFT JOIN payoff replayed ON replayed.mine = r.policy_choice
                         AND replayed.theirs = r.opponent_choice
GROUP BY r.run_id, r.strategy, r.policy"""

PROMPTS = """
SELECT run_id, player_a, player_b, side, tour, strategy,
       'Tu joues au dilemme du prisonnier itératif.' || chr(10) ||
       CASE WHEN opening THEN 'C''est le premier tour.'
            ELSE 'Tour précédent : tu as joué ' || coalesce(my_last, 'None')
                 || ', l''adversaire a joué ' || coalesce(their_last, 'None')
                 || '. Ton score cumulé : ' || CAST(coalesce(score, 0) AS VARCHAR) || '.' END
       || chr(10) || 'Réponds UNIQUEMENT par COOPERATE ou DEFECT, rien d''autre.' AS prompt
FROM (
  SELECT run_id, player_a, player_b, 'A' AS side, tour, player_a AS strategy,
         lag(choice_a) OVER m AS my_last, lag(choice_b) OVER m AS their_last,
         lag(tour) OVER m IS NULL AS opening,
         CAST(sum(gain_a) OVER (m ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS BIGINT)
           AS score
  FROM bronze WINDOW m AS (PARTITION BY run_id, player_a, player_b ORDER BY tour)
  UNION ALL
  SELECT run_id, player_a, player_b, 'B', tour, player_b,
         lag(choice_b) OVER m, lag(choice_a) OVER m, lag(tour) OVER m IS NULL,
         CAST(sum(gain_b) OVER (m ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS BIGINT)
  FROM bronze WINDOW m AS (PARTITION BY run_id, player_a, player_b ORDER BY tour)
)"""


def _quality(domains: dict[str, str]) -> str:
    """Row rules count rows, tour rules count round numbers, whose copies are one."""
    known = "('COOPERATE', 'DEFECT')"
    row_rules = {
        "choice_domain": f"choice_a IN {known} AND choice_b IN {known}",
        "gain_domain": "gain_a IN (0, 1, 3, 5) AND gain_b IN (0, 1, 3, 5)",
        "gain_is_payoff": "gain_a = paid_a AND gain_b = paid_b",
        "key_not_null": "run_id IS NOT NULL AND player_a IS NOT NULL AND player_b IS NOT NULL "
        "AND tour IS NOT NULL",
        **domains,
    }
    tour_rules = {
        "cumul_is_running_sum": "known_a = copies AND low_a = run_a AND high_a = run_a "
        "AND known_b = copies AND low_b = run_b AND high_b = run_b",
        "unique_round": "copies = 1",
        "dense_tours": "tour = previous + 1",
    }
    lines = [(n, r, "paid") for n, r in row_rules.items()]
    lines += [(n, r, "walked") for n, r in tour_rules.items()]
    counted = "\nUNION ALL\n".join(
        f"SELECT '{name}' AS rule, count(*) AS checked, "
        f"count(*) - count(*) FILTER ({rule}) AS violations FROM {table}"
        for name, rule, table in lines
    )
    return f""",
paid AS (
  SELECT b.*, pa.gain AS paid_a, pb.gain AS paid_b
  FROM bronze b
  LEFT JOIN payoff pa ON b.choice_a = pa.mine AND b.choice_b = pa.theirs
  LEFT JOIN payoff pb ON b.choice_b = pb.mine AND b.choice_a = pb.theirs
),
per_tour AS (
  SELECT run_id, player_a, player_b, tour, count(*) AS copies,
         sum(gain_a) AS gain_a, sum(gain_b) AS gain_b,
         count(cumul_a) AS known_a, min(cumul_a) AS low_a, max(cumul_a) AS high_a,
         count(cumul_b) AS known_b, min(cumul_b) AS low_b, max(cumul_b) AS high_b
  FROM paid GROUP BY run_id, player_a, player_b, tour
),
walked AS (
  SELECT *, coalesce(sum(gain_a) OVER m, 0) AS run_a, coalesce(sum(gain_b) OVER m, 0) AS run_b,
         lag(tour, 1, 0) OVER m AS previous
  FROM per_tour WINDOW m AS (PARTITION BY run_id, player_a, player_b ORDER BY tour)
)
{counted}"""


def _with(parts: tuple[str, ...], select: str) -> str:
    return "WITH " + ",".join(parts) + "\n" + select.strip()


def oracle_sql() -> dict[str, str]:
    return {
        "bronze_rounds": _with(_TO_BRONZE, "SELECT * FROM bronze"),
        "payoff_scoring": _with(
            _TO_SCORED,
            "SELECT run_id, tour, player_a, player_b, choice_a, choice_b, gain_a, gain_b "
            "FROM scored",
        ),
        "running_score": _with(
            _TO_BRONZE, "SELECT run_id, tour, player_a, player_b, cumul_a, cumul_b FROM bronze"
        ),
        "side_unpivot": _with(_TO_SIDES, "SELECT * FROM sides"),
        "silver_rounds": _with(_TO_SILVER, "SELECT * FROM silver"),
        "gold_tournament_summary": _with(
            (*_TO_SIDES, SUMMARY), "SELECT * FROM summary ORDER BY ranking"
        ),
        "gold_matchup_matrix": _with(
            (*_TO_SILVER, MATRIX), "SELECT * FROM matrix ORDER BY run_id, final_score_a DESC"
        ),
        "gold_behavioral_drift": _with(
            (*_TO_SIDES, DRIFT), "SELECT * FROM drift ORDER BY strategy, matchup_id, tour_bucket"
        ),
        "gold_forgiveness_index": _with(
            (*_TO_SIDES, FORGIVENESS), "SELECT * FROM forgiveness ORDER BY forgiveness_rank"
        ),
        "stored_forgiveness_index": _with(
            (*_TO_SIDES, FORGIVENESS), "SELECT * FROM forgiveness ORDER BY forgiveness_rank"
        ),
        "ingested_tournament_summary": _with((*_TO_SIDES, SUMMARY), "SELECT * FROM summary"),
        "ingested_forgiveness_index": _with(
            (*_TO_SIDES, FORGIVENESS), "SELECT * FROM forgiveness"
        ),
        "ingest_rejects": _with(
            _TO_BRONZE,
            "SELECT run_id, if(tour = 35, 'clashing', 'repeated') AS reason, count(*) AS rounds "
            "FROM bronze WHERE tour BETWEEN 31 AND 40 GROUP BY ALL",
        ),
        "lasting_silver": _with(_TO_SILVER, "SELECT * FROM silver"),
        "q_final_ranking": _with(
            (*_TO_SIDES, SUMMARY),
            "SELECT strategy, total_score, cooperation_rate_pct, ranking "
            "FROM summary ORDER BY ranking",
        ),
        "q_matchup_lookup": _with(
            (*_TO_SILVER, MATRIX),
            "SELECT player_a, player_b, final_score_a, final_score_b, match_winner "
            "FROM matrix WHERE player_a = 'ASIA'",
        ),
        "q_strategy_drift": _with(
            (*_TO_SIDES, DRIFT),
            "SELECT tour_bucket, cooperation_rate_pct "
            "FROM drift WHERE strategy = 'EUROPE' ORDER BY tour_bucket",
        ),
        "q_forgiveness_ranking": _with(
            (*_TO_SIDES, FORGIVENESS),
            "SELECT strategy, forgiveness_index_pct, forgiveness_rank "
            "FROM forgiveness ORDER BY forgiveness_rank",
        ),
        "q_run_comparison": _with(
            (*_TO_SIDES, SUMMARY),
            "SELECT run_id, strategy, total_score, cooperation_rate_pct "
            "FROM summary ORDER BY run_id, ranking",
        ),
        "policy_conformance": _with((*_TO_SIDES, REPLAY), CONFORMANCE),
        "counterfactual_replay": _with((*_TO_SIDES, REPLAY), COUNTERFACTUAL),
        "own_policy_conformance": _with(
            (*_TO_SIDES, OWN_POLICIES, _own("recorded")), CONFORMANCE
        ),
        "own_policy_replay": _with((*_TO_SIDES, OWN_POLICIES, _own("own")), COUNTERFACTUAL),
        "choice_normalizer": """
SELECT conv_id, turn,
       CASE WHEN upper(text) LIKE '%QUE%' THEN 'que' ELSE 'COOPERATE' END AS choice
FROM conversations WHERE role = 'assistant'""".strip(),
        "history_prompt": _with(_TO_BRONZE, PROMPTS),
        "dq_report": "WITH " + ",".join(_TO_BRONZE) + _quality({}),
        "faulty_silver": _with((*_TO_FAULTY, SILVER), "SELECT * FROM silver"),
        "faulty_running_score": _with(
            _TO_FAULTY,
            """
SELECT * REPLACE (CAST(sum(gain_a) OVER m AS BIGINT) AS cumul_a,
                  CAST(sum(gain_b) OVER m AS BIGINT) AS cumul_b)
FROM bronze
WINDOW m AS (PARTITION BY run_id, player_a, player_b ORDER BY tour ROWS UNBOUNDED PRECEDING)""",
        ),
        "faulty_forgiveness": _with((*_FAULTY_SIDES, FORGIVENESS), "SELECT * FROM forgiveness"),
        "faulty_conformance": _with((*_FAULTY_SIDES, REPLAY), CONFORMANCE),
        "faulty_replay": _with((*_FAULTY_SIDES, REPLAY), COUNTERFACTUAL),
        "faulty_own_conformance": _with(
            (*_FAULTY_SIDES, OWN_POLICIES, _own("recorded")), CONFORMANCE
        ),
        "faulty_own_replay": _with((*_FAULTY_SIDES, OWN_POLICIES, _own("own")), COUNTERFACTUAL),
        "faulty_prompts": _with(_TO_FAULTY, PROMPTS),
        "faulty_dq_report": "WITH " + ",".join(_TO_BROKEN) + _quality(
            {
                "tour_domain": "tour BETWEEN 1 AND 400",
                "run_id_length": "length(run_id) = 8",
            }
        ),
        "tournament_stats": _with(
            _TO_BRONZE,
            """
SELECT run_id, count(*) AS rounds, count(DISTINCT (player_a, player_b)) AS matches,
       (SELECT count(DISTINCT name)
        FROM (SELECT run_id AS r, player_a AS name FROM bronze
              UNION ALL SELECT run_id, player_b FROM bronze)
        WHERE r = b.run_id) AS strategies
FROM bronze b GROUP BY run_id""",
        ),
    }
