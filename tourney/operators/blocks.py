"""What comes before each block of a sequence, when the blocks of one sequence are many themselves.

A block is a range of order values, ``order >> bits``. Blocks are grouped into ranges of blocks, these
again, and so on until a sequence has few left. Summaries go up the levels and what precedes them comes
down again, as one more row in front of each group. So no window holds more than ``2**FAN_BITS`` rows,
however sparse the order values are.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# 2**17 = 131,072 blocks of one group: a few MB.
FAN_BITS = 17
# Order values are expected to have so many bits; larger ones only make the last window longer.
ORDER_BITS = 51

BLOCK = "_block"
# Level 0 are the blocks; an item of a higher level is a range of items of the level below.
_LEVEL, _ITEM = "_block_level", "_block_item"
_AT, _PLACE = "_block_at", "_block_place"
_KNOWN = "_before_known"


def block_of(order: str, block_bits: int) -> Column:
    """Number of the block a row belongs to; blocks follow each other in ``order``."""
    return F.shiftright(F.col(order).cast("bigint"), block_bits)


def levels_above(block_bits: int, order_bits: int | None = None) -> int:
    """How often blocks are grouped before those left of a sequence fit into one window."""
    left, levels = (ORDER_BITS if order_bits is None else order_bits) - block_bits, 0
    while left > FAN_BITS:
        left, levels = left - FAN_BITS, levels + 1
    return levels


def carried(
    ends: DataFrame,
    keys: Sequence[str],
    last: Sequence[str],
    total: Sequence[str],
    block_bits: int,
    order_bits: int | None = None,
) -> DataFrame:
    """Per block but the first of a sequence: ``last`` of the block before it, ``total`` so far.

    ``ends`` has one row per ``keys`` and ``_block``, with the last values of the block and its totals.
    It is read once: every row adds to its item of each level, and what precedes the items is found
    from the highest level down, each item then standing in front of the items it consists of.
    """
    top = levels_above(block_bits, order_bits)
    levels = F.explode(F.sequence(F.lit(0), F.lit(top)))
    end = F.struct(F.coalesce(BLOCK, F.lit(-(1 << 63))).alias("at"), *last)
    items = (
        ends.select("*", levels.alias(_LEVEL))
        .withColumn(_ITEM, F.expr(f"shiftright({BLOCK}, {_LEVEL} * {FAN_BITS})"))
        .groupBy(*keys, _LEVEL, _ITEM)
        .agg(F.max(end).alias("_end"), *[F.sum(c).alias(c) for c in total])
        .select(
            *keys,
            _LEVEL,
            _ITEM,
            F.lit(False).alias(_KNOWN),
            *[F.col(f"_end.{c}").alias(c) for c in last],
            *total,
            *[F.col(f"_end.{c}").alias(f"_before_{c}") for c in last],
            *[F.col(c).alias(f"_before_{c}") for c in total],
        )
    )
    for level in range(top, -1, -1):
        items = _found_at(items, keys, last, total, level, level == top)
    found = items.where(F.col(_KNOWN) & (F.col(_LEVEL) == 0))
    before = [F.col(f"_before_{c}").alias(c) for c in (*last, *total)]
    return found.select(*keys, F.col(_ITEM).alias(BLOCK), *before)


def _found_at(
    items: DataFrame,
    keys: Sequence[str],
    last: Sequence[str],
    total: Sequence[str],
    level: int,
    is_top: bool,
) -> DataFrame:
    """Fills ``_before_…`` of the items of a level from those of the same item above, and its own.

    Items of other levels stand alone.
    """
    here, above = F.col(_LEVEL) == level, F.col(_LEVEL) == level + 1
    group = F.lit(0).cast("bigint") if is_top else F.shiftright(_ITEM, FAN_BITS)
    placed = items.withColumns(
        {
            _AT: F.when(here | above, F.lit(-1)).otherwise(F.col(_LEVEL)),
            _PLACE: F.when(here, group).otherwise(F.col(_ITEM)),
        }
    )
    in_order = Window.partitionBy(*keys, _AT, _PLACE).orderBy(
        F.desc(_LEVEL), F.asc_nulls_first(_ITEM)
    )
    earlier = in_order.rowsBetween(Window.unboundedPreceding, -1)
    # An item above counts for what precedes it, the others for what they hold.
    known = F.coalesce(F.lag(F.when(above, F.col(_KNOWN)).otherwise(True)).over(in_order), F.lit(False))
    values = {_KNOWN: known}
    for c in last:
        value = F.when(above, F.col(f"_before_{c}")).otherwise(F.col(c))
        values[f"_before_{c}"] = F.lag(value).over(in_order)
    for c in total:
        value = F.when(above & ~F.col(_KNOWN), None)
        value = value.when(above, F.col(f"_before_{c}")).otherwise(F.col(c))
        values[f"_before_{c}"] = F.sum(value).over(earlier)
    return placed.select(
        *keys,
        _LEVEL,
        _ITEM,
        *last,
        *total,
        *[F.when(here, value).otherwise(F.col(name)).alias(name) for name, value in values.items()],
    )
