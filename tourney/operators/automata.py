"""Finite automata run over the rounds of every match, without a match in one task.

What a stretch of rounds does to an automaton is a table: for each state before it, the state after it
and what the automaton earns on the way. Tables of neighbouring stretches compose. So rounds are folded
to the tables of small blocks, these to the tables of groups of blocks, and so on up to whole matches,
where the entry of the start state holds the result. Rounds are read and shuffled once, and no task
ever holds more than ``2**block_bits`` rounds or ``2**FAN_BITS`` tables of one match.

Several automata run side by side: their states are numbered through, so one table serves them all.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tourney.operators import blocks
from tourney.operators.blocks import block_of
from tourney.schema import MATCH

# Rounds of a block, and blocks or groups of a group.
BLOCK_BITS = 9
FAN_BITS = 14
# Larger blocks are cut to this size: a place and a letter go into one number.
MOST_BITS = 40


@dataclass(frozen=True)
class Machine:
    """States are 0, 1, ...; ``after`` and ``worth`` have one row per letter, one number per state.

    ``after`` is the next state, ``worth`` what reading the letter in that state earns.
    """

    start: int
    after: tuple[tuple[int, ...], ...]
    worth: tuple[tuple[int, ...], ...]


def _numbers(values: Sequence[int], kind: str) -> Column:
    return F.array(*[F.lit(value).cast(kind) for value in values])


def run_machines(
    rounds: DataFrame,
    machines: Sequence[Machine],
    letter: Column,
    totals: Mapping[str, Column],
    order: str = "tour",
    block_bits: int = BLOCK_BITS,
) -> DataFrame:
    """Per match the ``totals`` of its rounds, and ``worth``: what each machine has earned.

    ``letter`` is the number of the row of ``after`` and ``worth`` that a round stands for, and
    ``totals`` are number columns to add up. ``order`` is unique within a match; missing order values
    come first, as one block.
    """
    sizes = [len(machine.after[0]) for machine in machines]
    first = [sum(sizes[:i]) for i in range(len(sizes))]
    # States are numbered from 1 over all machines, as array positions are.
    after = [
        [f + to + 1 for f, m in zip(first, machines, strict=True) for to in m.after[number]]
        for number in range(len(machines[0].after))
    ]
    worth = [[w for m in machines for w in m.worth[number]] for number in range(len(after))]
    # Rounds travel as numbers, place in the block and letter; letters are numbered in the order of
    # their tables, in which copies of a round are read. 0 is a missing letter.
    rows = list(zip(map(tuple, after), map(tuple, worth), strict=True))
    read = sorted(set(rows))
    number = F.element_at(_numbers([read.index(row) + 1 for row in rows], "int"), letter.cast("int") + 1)
    table = "struct<to:array<int>,worth:array<bigint>>"
    tables = F.array(
        F.lit(None).cast(table),
        *[
            F.struct(_numbers(to, "int").alias("to"), _numbers(w, "bigint").alias("worth"))
            for to, w in read
        ],
    )
    nothing = F.struct(
        _numbers(range(1, sum(sizes) + 1), "int").alias("to"),
        _numbers([0] * sum(sizes), "bigint").alias("worth"),
    )
    bits, left = min(block_bits, MOST_BITS), blocks.ORDER_BITS
    place = F.coalesce(F.col(order).cast("bigint").bitwiseAND((1 << bits) - 1), F.lit(0))
    packed = place * (len(read) + 1) + F.coalesce(number, F.lit(0))
    letters = rounds.select(
        *MATCH,
        F.col(order).cast("bigint").alias("place"),
        packed.alias("step"),
        *[column.alias(name) for name, column in totals.items()],
    )
    of_letter = F.transform(
        "steps", lambda step: F.element_at(tables, (step % (len(read) + 1)).cast("int") + 1)
    )
    steps = _composed(letters, block_of("place", bits), F.col("step"), of_letter, nothing, totals)
    bits, left = FAN_BITS, left - bits
    while bits < left:
        steps = _folded(steps, block_of("place", bits), totals, nothing)
        bits, left = FAN_BITS, left - bits
    steps = _folded(steps, F.lit(0), totals, nothing)
    starts = [f + m.start + 1 for f, m in zip(first, machines, strict=True)]
    earned = F.array(*[F.element_at("worth", start) for start in starts])
    return steps.select(*MATCH, *totals, earned.alias("worth"))


def _folded(steps: DataFrame, group: Column, totals: Mapping[str, Column], nothing: Column):
    """The tables of each group of a match composed in order."""
    step = F.struct("place", "to", "worth")
    return _composed(steps, group, step, F.col("steps"), nothing, totals)


def _composed(
    rows: DataFrame,
    group: Column,
    step: Column,
    tables: Column,
    nothing: Column,
    totals: Mapping[str, Column],
) -> DataFrame:
    """One table per group of a match, of the ``tables`` made from its sorted ``steps``."""

    def then(done: Column, step: Column) -> Column:
        return F.struct(
            F.transform(done["to"], lambda state: F.element_at(step["to"], state)).alias("to"),
            F.zip_with(
                done["worth"],
                done["to"],
                lambda earned, state: earned + F.element_at(step["worth"], state),
            ).alias("worth"),
        )

    grouped = rows.groupBy(*MATCH, group.alias("place_group")).agg(
        F.array_sort(F.collect_list(step)).alias("steps"),
        *[F.sum(name).alias(name) for name in totals],
    )
    done = F.aggregate(tables, nothing, then).alias("done")
    return grouped.select(
        *MATCH, F.col("place_group").alias("place"), done, *totals
    ).select(*MATCH, "place", "done.to", "done.worth", *totals)
