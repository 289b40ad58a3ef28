"""Positions in a global order, without one task per group."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tourney.operators.history import BLOCK_BITS, over_history

POSITION = "position"

# Where unknown scores stand: after every score.
_NOWHERE = 1 << 62


def place_in_order(df: DataFrame, order: Sequence[str], keep: Sequence[str]) -> DataFrame:
    """The ``keep`` columns with a ``position`` that increases along ``order``.

    The rows are range-partitioned on the whole order, so a group of any size is spread over as
    many tasks as its share of the data. Positions are unique but not consecutive across
    partitions. Range bounds are sampled anew whenever the frame runs, so store the result before
    reading it more than once.
    """
    return (
        df.repartitionByRange(*order)
        .sortWithinPartitions(*order)
        .select(*keep, F.monotonically_increasing_id().alias(POSITION))
    )


def file_row_columns() -> dict[str, Column]:
    """Columns that tell apart the rows of a Parquet table, exact copies included.

    The same on every read of the same files, so a lost task places its rows where they were.
    """
    return {
        "file_hash": F.xxhash64("_metadata.file_path"),
        "file_row": F.col("_metadata.row_index"),
    }


def rank_by_window(rows: DataFrame, group: str, score: str, rank: str) -> DataFrame:
    """Adds the rank with gaps, highest score first and unknown scores last.

    Sorts a whole group in one task.
    """
    highest = Window.partitionBy(group).orderBy(F.desc_nulls_last(score))
    return rows.withColumn(rank, F.rank().over(highest).cast("bigint"))


def rank_by_blocks(
    rows: DataFrame,
    group: str,
    score: str,
    rank: str,
    scale: int = 1,
    block_bits: int = BLOCK_BITS,
    order_bits: int | None = None,
) -> DataFrame:
    """The same ranks without a window over a whole group.

    ``score`` times ``scale`` is a whole number. Equal scores are counted as one row first; these are
    cut into blocks of scores, and every block starts from the number of rows above it. Rows then get
    the rank of their score, so ties stand together whatever their number. ``rows`` is read three
    times: store it first.
    """
    place = F.coalesce(-F.round(F.col(score) * scale).cast("bigint"), F.lit(_NOWHERE))
    placed = rows.withColumn("_place", place)
    tied = placed.groupBy(group, "_place").agg(F.count(F.lit(1)).alias("_tied"))
    above = over_history(
        tied,
        before={"_ahead": "_tied"},
        order="_place",
        block_bits=block_bits,
        keys=(group,),
        order_bits=order_bits,
    )
    above = above.select(F.col(group).alias("_of"), F.col("_place").alias("_at"), "_ahead")
    same = F.col(group).eqNullSafe(F.col("_of")) & (F.col("_place") == F.col("_at"))
    ahead = F.coalesce("_ahead", F.lit(0))
    return placed.join(above, same).select(*rows.columns, (ahead + 1).alias(rank))
