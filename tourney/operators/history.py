"""Columns that look back over a match and do not need the whole match in one task.

A plain ``Window.partitionBy(*MATCH).orderBy("tour")`` sorts each match in a single task, and one
match may hold a third of all rounds. Here a match is cut into blocks of consecutive rounds. Each
block gets one extra row in front that sums up everything before the block, so the same windows,
evaluated per block, give the values they would give over the whole match. The blocks themselves are
put in order level by level (``blocks``).
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tourney.functions.rounds import COOPERATED, DEFECTED, OTHER_MOVE, move_code
from tourney.operators.blocks import BLOCK, block_of, carried
from tourney.schema import COOPERATE, DEFECT, MATCH

# 2**17 = 131,072 consecutive order values per block: a few MB of rows, and blocks far outnumber
# tasks on large data, so hashing them spreads evenly. The table of blocks is that much smaller
# than the rounds.
BLOCK_BITS = 17

_CARRIED = "_carried"


def over_history(
    rounds: DataFrame,
    *,
    moves: Mapping[str, str] | None = None,
    previous: str | None = None,
    before: Mapping[str, str] | None = None,
    so_far: Mapping[str, str] | None = None,
    order: str = "tour",
    carry_from: DataFrame | None = None,
    block_bits: int = BLOCK_BITS,
    keys: Sequence[str] = MATCH,
    order_bits: int | None = None,
) -> DataFrame:
    """Add columns computed over each match, or other sequence by ``keys``, in ``order``.

    ``moves`` maps an output to the move column whose value in the round before it takes;
    ``previous`` names an output for the order value of the round before; ``before`` and ``so_far``
    map outputs to the number columns they add up over all earlier rounds, without and with the
    round itself (NULL where there is nothing to add).

    ``order`` is a whole number, unique within a match: a block is a range of it. Sparse numbers make
    small blocks, whose summaries are then nearly as many as the rounds; they, and rounds with many
    copies, can be replaced by positions (``place_in_order``). ``rounds`` is read twice, once for
    the block summaries, so it should be a stored table or a narrow view of one; ``carry_from``
    names a cheaper frame holding the same history, when there is one. ``order_bits`` is the size that
    order values are expected to have (``blocks``).
    """
    moves, before, so_far = dict(moves or {}), dict(before or {}), dict(so_far or {})
    last = list(dict.fromkeys(moves.values()))
    total = list(dict.fromkeys([*before.values(), *so_far.values()]))
    missing = {order, *last, *total} - set(rounds.columns)
    if missing:
        raise ValueError(f"rounds lack {sorted(missing)}")
    in_blocks = _with_block(rounds, order, block_bits).withColumn(_CARRIED, F.lit(False))
    source = _with_block(rounds if carry_from is None else carry_from, order, block_bits)
    ends = _block_ends(source, order, last, total, keys)
    before_blocks = carried(ends, keys, [order, *last], total, block_bits, order_bits)
    before_blocks = before_blocks.withColumn(_CARRIED, F.lit(True))
    window = Window.partitionBy(*keys, BLOCK).orderBy(order)
    earlier = window.rowsBetween(Window.unboundedPreceding, -1)
    upto = window.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    added = [F.lag(c).over(window).alias(name) for name, c in moves.items()]
    added += [F.lag(order).over(window).alias(previous)] if previous else []
    added += [F.sum(c).over(earlier).alias(name) for name, c in before.items()]
    added += [F.sum(c).over(upto).alias(name) for name, c in so_far.items()]
    replaced = [c for c in rounds.columns if c not in {**before, **so_far, **moves}]
    return (
        in_blocks.unionByName(before_blocks, allowMissingColumns=True)
        .select(*replaced, *added, _CARRIED)
        .where(~F.col(_CARRIED))
        .drop(_CARRIED)
    )


def _with_block(rounds: DataFrame, order: str, block_bits: int) -> DataFrame:
    return rounds.withColumn(BLOCK, block_of(order, block_bits))


def _block_ends(
    source: DataFrame,
    order: str,
    last: list[str],
    total: list[str],
    keys: Sequence[str] = MATCH,
) -> DataFrame:
    """Per block its last order value, the moves there, and its totals.

    Moves are grouped by code, so rounds fold map-side in hash aggregates to at most 16 rows per
    block whatever texts they hold. The text of a move that is neither of the two known ones is
    fetched from the rounds that have such a move, usually none.
    """
    codes = [f"_code_{c}" for c in last]
    coded = source.withColumns({f"_code_{c}": move_code(c) for c in last})
    folded = coded.groupBy(*keys, BLOCK, *codes).agg(
        F.max(order).alias(order), *[F.sum(c).alias(c) for c in total]
    )
    parts = folded.withColumn("_end", F.struct(order, *codes)).drop(order, *codes)
    if last:
        # Written out so that the scan can skip rounds by it.
        other = F.lit(False)
        for c in last:
            other = other | (F.col(c).isNotNull() & ~F.col(c).isin(COOPERATE, DEFECT))
        texts = (
            source.where(other)
            .groupBy(*keys, BLOCK)
            .agg(F.max_by(F.struct(*last), order).alias("_texts"))
        )
        parts = parts.unionByName(texts, allowMissingColumns=True)
    known = [F.first("_texts", ignorenulls=True).alias("_texts")] if last else []
    ends = parts.groupBy(*keys, BLOCK).agg(
        F.max("_end").alias("_end"), *known, *[F.sum(c).alias(c) for c in total]
    )
    moves = [
        F.when(F.col(f"_end._code_{c}") == COOPERATED, COOPERATE)
        .when(F.col(f"_end._code_{c}") == DEFECTED, DEFECT)
        .when(F.col(f"_end._code_{c}") == OTHER_MOVE, F.col(f"_texts.{c}"))
        .alias(c)
        for c in last
    ]
    return ends.select(*keys, BLOCK, F.col(f"_end.{order}").alias(order), *moves, *total)
