"""Checks of the bronze table, and its size per run."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tourney.functions.rounds import payoff
from tourney.operators.blocks import BLOCK, block_of, carried
from tourney.operators.history import BLOCK_BITS
from tourney.operators.sides import unpivot_sides
from tourney.schema import CHOICES, GAINS, MATCH

RUN_ID_CHARS = 8

_SCORES = ("cumul_a", "cumul_b")
_INHERITED = "_inherited"


def _fails(condition: Column) -> Column:
    """1 where the condition is false or unknown."""
    return F.when(condition, 0).otherwise(1)


def _row_rules(last_tour: int | None, run_id_chars: int | None) -> dict[str, Column]:
    rules = {
        "choice_domain": F.col("choice_a").isin(*CHOICES) & F.col("choice_b").isin(*CHOICES),
        "gain_domain": F.col("gain_a").isin(*GAINS) & F.col("gain_b").isin(*GAINS),
        "gain_is_payoff": (F.col("gain_a") == payoff(F.col("choice_a"), F.col("choice_b")))
        & (F.col("gain_b") == payoff(F.col("choice_b"), F.col("choice_a"))),
        "key_not_null": F.col("run_id").isNotNull()
        & F.col("player_a").isNotNull()
        & F.col("player_b").isNotNull()
        & F.col("tour").isNotNull(),
    }
    if last_tour is not None:
        rules["tour_domain"] = F.col("tour").between(1, last_tour)
    if run_id_chars is not None:
        rules["run_id_length"] = F.char_length("run_id") == run_id_chars
    return rules


def dq_report(
    bronze: DataFrame,
    block_bits: int = BLOCK_BITS,
    last_tour: int | None = None,
    run_id_chars: int | None = None,
) -> DataFrame:
    """Per rule, how much was checked and how much broke it.

    Rules on single rows count rows, rules on the sequence of a match count round numbers: copies of
    a round are one. ``last_tour`` and ``run_id_chars`` add rules on the stated domains.

    The rounds are shuffled and sorted once, by match and block, and walked through, copies side by
    side; what a block inherits from those before comes from a map-side fold and stands in front of
    it as one more row. Tours should be fairly dense, as for all jobs over the history of a match.
    """
    row_rules = _row_rules(last_tour, run_id_chars)
    # The rules that a row breaks, one bit each.
    bits = {name: 1 << i for i, name in enumerate(row_rules)}
    broken = sum((_fails(rule) * bits[name] for name, rule in row_rules.items()), F.lit(0))
    # A missing round number belongs to no block; such rows stay together, as one round.
    block = F.coalesce(block_of("tour", block_bits), F.lit(-1))
    rounds = bronze.select(
        *MATCH, "tour", "gain_a", "gain_b", *_SCORES, block.alias(BLOCK), broken.alias("broken")
    )
    ends = rounds.groupBy(*MATCH, BLOCK).agg(
        F.max("tour").alias("tour"),
        F.sum("gain_a").alias("gain_a"),
        F.sum("gain_b").alias("gain_b"),
    )
    inherited = carried(ends, MATCH, ["tour"], ["gain_a", "gain_b"], block_bits)
    rows = rounds.withColumn(_INHERITED, F.lit(False)).unionByName(
        inherited.withColumn(_INHERITED, F.lit(True)), allowMissingColumns=True
    )
    rows = rows.repartition(*MATCH, BLOCK)
    walk = Window.partitionBy(*MATCH, BLOCK).orderBy(F.desc(_INHERITED), "tour")
    so_far = walk.rangeBetween(Window.unboundedPreceding, Window.currentRow)
    copies = walk.rangeBetween(Window.currentRow, Window.currentRow)
    last_is_round = F.lag(~F.col(_INHERITED), 1, False).over(walk)
    walked = rows.select(
        "tour",
        "broken",
        _INHERITED,
        (last_is_round & F.lag("tour").over(walk).eqNullSafe(F.col("tour"))).alias("is_copy"),
        F.lag("tour").over(walk).alias("previous"),
        F.max(F.when(F.col(_INHERITED), F.col("tour"))).over(so_far).alias("tour_before"),
        F.count(F.lit(1)).over(copies).alias("copies"),
        *[F.sum(f"gain_{s}").over(so_far).alias(f"run_{s}") for s in "ab"],
        *[F.count(c).over(copies).alias(f"{c}_known") for c in _SCORES],
        *[F.min(c).over(copies).alias(f"{c}_low") for c in _SCORES],
        *[F.max(c).over(copies).alias(f"{c}_high") for c in _SCORES],
    )
    is_row = ~F.col(_INHERITED)
    is_tour = is_row & ~F.col("is_copy")

    running = F.lit(True)
    for score, run in (("cumul_a", "run_a"), ("cumul_b", "run_b")):
        expected = F.coalesce(F.col(run), F.lit(0))
        running &= (
            (F.col(f"{score}_known") == F.col("copies"))
            & (F.col(f"{score}_low") == expected)
            & (F.col(f"{score}_high") == expected)
        )
    previous = F.coalesce("previous", "tour_before", F.lit(0))
    tour_rules = {
        "cumul_is_running_sum": running,
        "unique_round": F.col("copies") == 1,
        "dense_tours": F.col("tour") == previous + 1,
    }
    counts = walked.agg(
        F.count_if(is_row).alias("rows"),
        F.count_if(is_tour).alias("tours"),
        *[F.count_if(F.col("broken").bitwiseAND(bit) != 0).alias(name) for name, bit in bits.items()],
        *[F.count_if(is_tour & (_fails(c) == 1)).alias(name) for name, c in tour_rules.items()],
    )
    lines = [(name, "rows") for name in row_rules] + [(name, "tours") for name in tour_rules]
    return counts.select(
        F.inline(
            F.array(
                *[
                    F.struct(
                        F.lit(name).alias("rule"),
                        F.col(checked).cast("bigint").alias("checked"),
                        F.col(name).cast("bigint").alias("violations"),
                    )
                    for name, checked in lines
                ]
            )
        )
    )


def tournament_stats(bronze: DataFrame) -> DataFrame:
    """Rounds, matches and distinct strategies of each run, from per-match counts."""
    per_match = bronze.groupBy(*MATCH).agg(F.count(F.lit(1)).alias("rounds"))
    sides = unpivot_sides(
        per_match,
        ["run_id"],
        {
            "strategy": ("player_a", "player_b"),
            "rounds": ("rounds", F.lit(0).cast("bigint")),
            "matches": (F.lit(1), F.lit(0)),
        },
    )
    per_strategy = sides.groupBy("run_id", "strategy").agg(
        F.sum("rounds").alias("rounds"), F.sum("matches").alias("matches")
    )
    return per_strategy.groupBy("run_id").agg(
        F.sum("rounds").alias("rounds"),
        F.sum("matches").alias("matches"),
        F.count("strategy").alias("strategies"),
    )
