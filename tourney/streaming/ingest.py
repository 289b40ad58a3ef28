"""Picks up new run files: sorts out repeated rounds, stores the others, and brings gold up to date."""

from __future__ import annotations

from contextlib import ExitStack

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tourney.operators.blocks import block_of
from tourney.operators.history import BLOCK_BITS
from tourney.plans.build import ANSWERS, STATE, add_batch, rebuild_runs
from tourney.schema import BRONZE, MATCH
from tourney.session import scratch_table
from tourney.sources.bronze import (
    append_bronze,
    has_batch,
    rounds_in_blocks,
    rounds_of_runs,
    runs_of_batch,
    runs_only,
    write_rejects,
)
from tourney.sources.files import table_exists
from tourney.sources.versions import Draft, last_commit, manifest, read_table

_QUERY_ID = "sql.streaming.queryId"

# A round of a run is one row, whatever files it came in.
ROUND = (*MATCH, "tour")
_SAID = tuple(c for c in BRONZE.names if c not in ROUND)

# Rounds of 2**10 neighbouring numbers are judged in one task.
NEIGHBOUR_BITS = 10

# Reasons for leaving out a round.
REPEATED, CLASHING = "repeated", "clashing"


def ingest_new_runs(
    spark: SparkSession,
    landing: str,
    bronze: str,
    warehouse: str,
    checkpoint: str,
    order: str = "tour",
) -> StreamingQuery:
    """Process every file the checkpoint has not seen, then stop.

    A round that is stored already, or comes more than once, is kept once. What is left out goes to the
    reject table ``<bronze>_rejects`` with its reason: ``repeated`` if it says the same as the round
    kept, ``clashing`` otherwise. Of clashing rounds in one batch the smallest by its columns stays.

    Gold is brought up to date from the batch and the stored state of its runs (``add_batch``), and
    readers see a batch in all tables or in none. A batch that failed on the way runs again, is stored
    in place of its first try, and has its runs rebuilt from their rounds. With ``order="position"``,
    for very sparse round numbers, runs are always rebuilt.

    Rounds that were appended to ``bronze`` otherwise enter gold, and are compared with, once the
    tables are built.
    """

    def load(batch: DataFrame, batch_id: int) -> None:
        session = batch.sparkSession
        query_id = session.sparkContext.getLocalProperty(_QUERY_ID)
        if last_commit(session, warehouse).applied.get(query_id, -1) >= batch_id:
            return
        load_batch(batch, f"{query_id}-{batch_id}", bronze, warehouse, order, {query_id: batch_id})

    return (
        spark.readStream.schema(BRONZE)
        .option("recursiveFileLookup", "true")
        .parquet(landing)
        .writeStream.foreachBatch(load)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def load_batch(
    rounds: DataFrame,
    batch: str,
    bronze: str,
    warehouse: str,
    order: str = "tour",
    applied: dict[str, int] | None = None,
) -> None:
    """Store a batch of rounds under its name and bring gold up to date."""
    spark = rounds.sparkSession
    repeats = has_batch(spark, bronze, batch)
    with ExitStack() as held:
        incoming = held.enter_context(scratch_table(rounds.select(*BRONZE.names), "incoming"))
        stored = _stored_rounds(held, incoming, batch, bronze, warehouse)
        judged = held.enter_context(scratch_table(_judged(incoming, stored), "judged"))
        accepted = judged.where("reason IS NULL")
        append_bronze(accepted, bronze, batch)
        write_rejects(_counted(judged.where("reason IS NOT NULL")), bronze, batch)
        if accepted.isEmpty():
            Draft(spark, warehouse).mark_applied(applied or {})
        elif repeats or order != "tour":
            runs = runs_of_batch(spark, bronze, batch)
            rebuild_runs(spark, bronze, runs, warehouse, order, applied)
        else:
            add_batch(spark, bronze, batch, warehouse, applied)


def _judged(incoming: DataFrame, stored: DataFrame) -> DataFrame:
    """The rows of a batch, each with the reason for leaving it out, null for those to be kept.

    All are shuffled and sorted once, by match and a block of tours, so that neighbours stay together.
    In a round stored rows come first, then the smallest by its columns, which the others are
    compared with.
    """
    rows = incoming.select(*BRONZE.names, F.lit(0).alias("_age")).unionByName(
        stored.select(*BRONZE.names, F.lit(1).alias("_age"))
    )
    block = block_of("tour", NEIGHBOUR_BITS).alias("_block")
    spread = rows.select("*", block).repartition(*MATCH, "_block")
    in_round = Window.partitionBy(*MATCH, "_block", "tour").orderBy(F.desc("_age"), *_SAID)
    said = F.struct(*_SAID)
    judged = spread.select(
        "*",
        F.row_number().over(in_round).alias("_place"),
        said.eqNullSafe(F.first(said).over(in_round)).alias("_same"),
    )
    reason = F.when(F.col("_place") > 1, F.when(F.col("_same"), REPEATED).otherwise(CLASHING))
    return judged.where("_age = 0").select(*BRONZE.names, reason.alias("reason"))


def _counted(rejects: DataFrame) -> DataFrame:
    """Distinct rows that are left out, with their copies."""
    return rejects.groupBy(*BRONZE.names, "reason").agg(F.count(F.lit(1)).alias("copies"))


def _stored_rounds(
    held: ExitStack, incoming: DataFrame, batch: str, bronze: str, warehouse: str
) -> DataFrame:
    """Stored rounds that the batch could repeat: of the blocks that its rounds reach into.

    Which blocks these are is read from the stored segments of its runs; the rounds of runs without
    segments are all compared. Rounds that an earlier try of the batch has stored do not count.
    ``held`` keeps the tables that the result reads.
    """
    spark = incoming.sparkSession
    found = spark.createDataFrame([], BRONZE)
    if not table_exists(spark, bronze):
        return found
    commit = last_commit(spark, warehouse)
    known = manifest(spark, warehouse, commit).where("mergeable").select("run_id")
    runs = held.enter_context(scratch_table(incoming.select("run_id").distinct(), "batch-runs"))
    same = runs["run_id"].eqNullSafe(known["run_id"])
    new = held.enter_context(scratch_table(runs.join(known, same, "left_anti"), "new-runs"))
    if not new.isEmpty():
        found = found.unionByName(rounds_of_runs(spark, bronze, new, without=batch))
    spans = incoming.groupBy(*MATCH, block_of("tour", BLOCK_BITS).alias("block")).agg(
        F.min("tour").alias("low"), F.max("tour").alias("high")
    )
    spans = spans.select(*[F.col(c).alias(f"_{c}") for c in spans.columns])
    segments = runs_only(read_table(spark, warehouse, ANSWERS, STATE[ANSWERS], commit), runs)
    met = F.coalesce(
        (F.col("first_order") <= F.col("_high")) & (F.col("_low") <= F.col("last_order")),
        F.lit(True),
    )
    for c in (*MATCH, "block"):
        met &= F.col(c).eqNullSafe(F.col(f"_{c}"))
    reached = segments.join(spans, met, "left_semi").select(*MATCH, "block").distinct()
    blocks = held.enter_context(scratch_table(reached, "reached-blocks"))
    if not blocks.isEmpty():
        found = found.unionByName(rounds_in_blocks(spark, bronze, blocks, without=batch))
    return found
