"""Stored rounds: one landing folder per run file, one bronze table for all runs."""

from __future__ import annotations

import re
import uuid
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tourney.operators.blocks import block_of
from tourney.operators.history import BLOCK_BITS
from tourney.operators.ordering import file_row_columns, place_in_order
from tourney.schema import BRONZE, MATCH, describe
from tourney.sources.files import remove_table, table_exists
from tourney.sources.joined import BATCH, in_use, last_joins


def new_run_id() -> str:
    """Eight-character run id, drawn once on the driver, never per row."""
    return str(uuid.uuid4())[:8]


def run_file_name(run_id: str, when: datetime | None = None) -> str:
    """``tournament_<UTC stamp>_<run id>.parquet``."""
    return f"tournament_{_stamp(when or datetime.now(timezone.utc))}_{run_id}.parquet"


def _stamp(when: datetime) -> str:
    return when.strftime("%Y%m%d_%H%M%S")


def stamp_run(rounds: DataFrame, run_id: str) -> DataFrame:
    return rounds.withColumn("run_id", F.lit(run_id)).select(*BRONZE.names)


def write_run(rounds: DataFrame, landing: str, run_id: str, when: datetime | None = None) -> str:
    """Write one run as its own Parquet output in the landing folder; returns its path."""
    path = f"{landing.rstrip('/')}/{run_file_name(run_id, when)}"
    describe(stamp_run(rounds, run_id)).write.parquet(path)
    return path


def append_bronze(rounds: DataFrame, path: str, batch: str | None = None) -> None:
    """Add rounds to the bronze table, partitioned by run and batch.

    Every call writes a batch of its own. A caller that may repeat itself after a failure names its
    batch, and the repetition replaces what the first try has stored of it.
    """
    write_by_run(rounds, path, batch or uuid.uuid4().hex)


def write_by_run(rounds: DataFrame, path: str, batch: str) -> None:
    """Write one batch, partitioned by run, rounds of a match next to each other.

    The rebalance hint gives each run's folder files of even size: small runs are not scattered
    over all tasks, and a run holding most of the data is split over many. In match order the
    repeated names take no space, and readers fold a match's rounds before they shuffle.
    """
    (
        describe(rounds.select(*BRONZE.names))
        .hint("rebalance", "run_id")
        .sortWithinPartitions(*MATCH, "tour")
        .withColumn(BATCH, F.lit(batch))
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("run_id", BATCH)
        .parquet(path)
    )


def stored_rounds(spark: SparkSession, path: str) -> DataFrame:
    """All runs with the batch of each round; folders that have been joined are pruned."""
    # The explicit schema keeps run ids such as ``1995`` strings.
    schema = T.StructType([*BRONZE, T.StructField(BATCH, T.StringType())])
    rows, joins = spark.read.schema(schema).parquet(path), last_joins(spark, path)
    return rows.where(in_use(joins)) if joins.number else rows


def read_bronze(spark: SparkSession, path: str) -> DataFrame:
    """All runs of a bronze table."""
    return stored_rounds(spark, path).select(*BRONZE.names)


def read_batch(spark: SparkSession, path: str, batch: str) -> DataFrame:
    """The rounds of one batch; reads its folders only."""
    return stored_rounds(spark, path).where(F.col(BATCH) == batch).select(*BRONZE.names)


def has_batch(spark: SparkSession, path: str, batch: str) -> bool:
    return table_exists(spark, path) and not read_batch(spark, path, batch).isEmpty()


def rounds_of_runs(
    spark: SparkSession, path: str, runs: DataFrame, without: str | None = None
) -> DataFrame:
    """Rounds of the named runs, of all batches but ``without``."""
    rows = stored_rounds(spark, path)
    if without is not None:
        rows = rows.where(F.col(BATCH) != without)
    return runs_only(rows.select(*BRONZE.names), runs)


def rounds_in_blocks(
    spark: SparkSession, path: str, blocks: DataFrame, without: str | None = None
) -> DataFrame:
    """Rounds of stored blocks (match, block of tours), of all batches but ``without``.

    Folders of other runs are pruned.
    """
    wanted = blocks.select(*[F.col(c).alias(f"_{c}") for c in (*MATCH, "block")])
    rounds = rounds_of_runs(spark, path, blocks.select("run_id").distinct(), without)
    same = block_of("tour", BLOCK_BITS).eqNullSafe(F.col("_block"))
    for c in MATCH:
        same &= F.col(c).eqNullSafe(F.col(f"_{c}"))
    return rounds.join(wanted, same, "left_semi")


def _rejects(path: str) -> str:
    return f"{path.rstrip('/')}_rejects"


def write_rejects(rounds: DataFrame, path: str, batch: str) -> None:
    """Store what a batch left out (rounds with ``reason`` and ``copies``), if anything."""
    folder = f"{_rejects(path)}/{BATCH}={batch}"
    if not rounds.isEmpty():
        rounds.write.mode("overwrite").parquet(folder)
    else:
        remove_table(rounds.sparkSession, folder)


def read_rejects(spark: SparkSession, path: str) -> DataFrame:
    """Rounds that were left out of the bronze table at ``path``, by batch."""
    schema = T.StructType(
        [
            *BRONZE,
            T.StructField("reason", T.StringType()),
            T.StructField("copies", T.LongType()),
            T.StructField(BATCH, T.StringType()),
        ]
    )
    if not table_exists(spark, _rejects(path)):
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(_rejects(path))


def runs_of_batch(spark: SparkSession, path: str, batch: str) -> DataFrame:
    """The runs that a batch holds rounds of; reads its folders only."""
    return stored_rounds(spark, path).where(F.col(BATCH) == batch).select("run_id").distinct()


def runs_only(bronze: DataFrame, runs: DataFrame) -> DataFrame:
    """Rounds of the given runs (a stored frame of distinct ``run_id``).

    The comparison on the runs' side lets Spark prune the folders of other runs when it broadcasts
    the list, which it does by size. Rounds without a run id are compared apart, as no join on
    equality finds them.
    """
    listed = runs.select(F.col("run_id").alias("named_run")).where(F.col("named_run") >= "")
    named = bronze.join(listed, F.col("run_id") == F.col("named_run"), "left_semi")
    nameless = runs.where(F.col("run_id").isNull()).select(F.lit(1).alias("nameless"))
    without = bronze.where(F.col("run_id").isNull()).withColumn("wanted", F.lit(1))
    without = without.join(nameless, F.col("wanted") == F.col("nameless"), "left_semi")
    return named.unionByName(without.drop("wanted"))


_RUN_FILE = r"/tournament_([0-9]{8}_[0-9]{6})_([^/]*)\.parquet(?:/|$)"


def read_landing(
    spark: SparkSession,
    landing: str,
    run_id: str | None = None,
    since: datetime | None = None,
    until: datetime | None = None,
) -> DataFrame:
    """Run files of a landing folder, without loading them into the bronze table first.

    Files of other runs, or written before ``since`` or after ``until`` by the stamp in their names,
    are not opened. Files named otherwise are read only without such limits.
    """
    rounds = spark.read.schema(BRONZE).option("recursiveFileLookup", "true").parquet(landing)
    path = F.col("_metadata.file_path")
    stamp = F.regexp_extract(path, _RUN_FILE, 1)
    if run_id is not None:
        # Paths spell other characters their own way; such runs are found by their rows.
        if re.fullmatch(r"[A-Za-z0-9_-]+", run_id):
            rounds = rounds.where(F.regexp_extract(path, _RUN_FILE, 2) == run_id)
        rounds = rounds.where(F.col("run_id") == run_id)
    if since is not None:
        rounds = rounds.where(stamp >= _stamp(since))
    if until is not None:
        rounds = rounds.where((stamp != "") & (stamp <= _stamp(until)))
    return rounds.select(*BRONZE.names)


def bronze_in_order(
    spark: SparkSession, path: str, runs: DataFrame | None = None
) -> DataFrame:
    """Bronze rounds with a ``position`` in match order that copies of a round do not share.

    For tables that hold many copies of a round: store it, then give the jobs over the history of a
    match ``order="position"``, and copies spread over blocks like any other rounds. Where they
    stand among each other follows their place in the files. ``runs`` limits it to some runs.
    """
    by_file = file_row_columns()
    rows = stored_rounds(spark, path).select(*BRONZE.names, *[c.alias(n) for n, c in by_file.items()])
    return place_in_order(
        rows if runs is None else runs_only(rows, runs),
        order=(*MATCH, "tour", *by_file),
        keep=BRONZE.names,
    )
