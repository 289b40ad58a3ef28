"""Builds the silver view and the stored gold tables from bronze."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from itertools import islice

from pyspark import inheritable_thread_target
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tourney.functions.rounds import matchup_id
from tourney.plans import gold
from tourney.plans.silver import silver_rounds, silver_select
from tourney.schema import (
    BRONZE,
    COLUMN_COMMENTS,
    GOLD,
    MATCH,
    SILVER,
    TABLE_COMMENTS,
    describe,
)
from tourney.session import scratch_table
from tourney.sources.bronze import (
    BATCH,
    bronze_in_order,
    read_batch,
    read_bronze,
    rounds_in_blocks,
    runs_of_batch,
    runs_only,
)
from tourney.sources.compaction import join_batches, remove_joined, unused_folders
from tourney.sources.files import partition_folder, path_name
from tourney.sources.joined import last_joins
from tourney.sources.versions import (
    Commit,
    Draft,
    join_versions,
    last_commit,
    manifest,
    read_table,
    remove_unused,
)

LAYERS = ("silver", "gold")


def build(
    bronze: DataFrame, warehouse: str, select: Sequence[str] = LAYERS, order: str = "tour"
) -> None:
    """Rebuild the selected layers: silver as a view, the gold tables in full, published at once.

    ``order`` names the column that orders the rounds of a match, ``position`` for a stored
    ``bronze_in_order``.
    """
    unknown = set(select) - set(LAYERS)
    if unknown:
        raise ValueError(f"unknown layers: {sorted(unknown)}")
    if "silver" in select:
        describe(silver_rounds(bronze)).createOrReplaceTempView("silver_rounds")
    if "gold" in select:
        _publish(bronze, warehouse, order)


def rebuild_runs(
    spark: SparkSession,
    bronze: str,
    runs: DataFrame,
    warehouse: str,
    order: str = "tour",
    applied: Mapping[str, int] | None = None,
) -> None:
    """Rebuild the gold rows of ``runs`` (a frame of ``run_id``) and leave other runs alone.

    ``order="position"`` numbers the rounds of the runs anew first, for runs with many copies of a
    round or very sparse tours. A run that has no rows in a table any more loses those it had.
    """
    with scratch_table(runs.select("run_id").distinct(), "named-runs") as named:
        if order == "position":
            with scratch_table(bronze_in_order(spark, bronze, named), "in-order") as rounds:
                _publish(rounds, warehouse, order, named, applied)
        else:
            rounds = runs_only(read_bronze(spark, bronze), named)
            _publish(rounds, warehouse, order, named, applied)


# What the gold tables are made from, stored per run so that a later batch can be merged to it: the
# totals of each match and hundred rounds, and the forgiveness segment of each match and block.
TOTALS, ANSWERS = "_state/bucket_totals", "_state/block_answers"
_WHOLE = {
    TOTALS: ("tour_bucket", *gold.TOTAL_COLUMNS),
    ANSWERS: ("block", *gold.SEGMENT),
}
STATE = {
    table: T.StructType(
        [T.StructField(name, T.StringType()) for name in MATCH]
        + [T.StructField(name, T.LongType()) for name in columns]
    )
    for table, columns in _WHOLE.items()
}
STORED = {**GOLD, **STATE}


def _publish(
    bronze: DataFrame,
    warehouse: str,
    order: str = "tour",
    named: DataFrame | None = None,
    applied: Mapping[str, int] | None = None,
) -> None:
    """Write the state and the gold tables of the rounds, and switch readers to them at once."""
    draft = Draft(bronze.sparkSession, warehouse)
    totals = gold.totals(silver_rounds(bronze), gold.PER_BUCKET)
    # Positions are drawn anew each time, so segments by position take no later batch.
    _publish_state(
        draft, totals, gold.answers_in_blocks(bronze, order), order == "tour", named, applied
    )


def _publish_state(
    draft: Draft,
    totals: DataFrame,
    answers: DataFrame,
    mergeable: bool,
    named: DataFrame | None,
    applied: Mapping[str, int] | None,
) -> None:
    """Leaderboard, matrix and drift share the stored totals, so the rounds are folded once for the
    three of them."""
    spark = draft.spark
    buckets, blocks = _at_once(
        spark,
        lambda: draft.write(TOTALS, _typed(totals, STATE[TOTALS]), STATE[TOTALS]),
        lambda: draft.write(ANSWERS, _typed(answers, STATE[ANSWERS]), STATE[ANSWERS]),
    )
    matches = gold.roll_up(buckets, gold.PER_MATCH)
    per_bucket = buckets.withColumn("matchup_id", matchup_id())
    index = gold.forgiveness_scores(gold.answers_per_match(blocks))
    matrix, *_ = _at_once(
        spark,
        lambda: _write_gold(draft, "gold_matchup_matrix", gold.matchup_matrix(matches)),
        lambda: _write_gold(draft, "gold_behavioral_drift", gold.behavioral_drift(per_bucket)),
        lambda: _write_ranked(
            draft, "gold_tournament_summary", gold.strategy_scores(matches), gold.spread_summary
        ),
        lambda: _write_ranked(draft, "gold_forgiveness_index", index, gold.spread_index),
    )
    present = matrix.select("run_id", F.lit(mergeable).alias("mergeable"))
    draft.publish(present, named, applied)


def _at_once(spark: SparkSession, *jobs: Callable[[], DataFrame]) -> list[DataFrame]:
    """The results of independent jobs, which share the cluster instead of waiting for each other."""
    with ThreadPoolExecutor(len(jobs)) as pool:
        started = [pool.submit(inheritable_thread_target(spark)(job)) for job in jobs]
        return [job.result() for job in started]


def _write_gold(draft: Draft, name: str, rows: DataFrame) -> DataFrame:
    return draft.write(name, describe(rows), GOLD[name])


def _write_ranked(
    draft: Draft, name: str, scores: DataFrame, ranked: Callable[[DataFrame], DataFrame]
) -> DataFrame:
    with scratch_table(scores, "scores") as stored:
        return _write_gold(draft, name, ranked(stored))


def _typed(rows: DataFrame, schema: T.StructType) -> DataFrame:
    return rows.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in schema])


def add_batch(
    spark: SparkSession,
    bronze: str,
    batch: str,
    warehouse: str,
    applied: Mapping[str, int] | None = None,
) -> None:
    """Bring the gold rows of a stored batch's runs up to date from its own rounds.

    Totals and segments of the batch are merged to the stored state of its runs. The rounds of other
    batches are read only for runs that have no state to merge to, and for blocks that the batch
    puts rounds into the middle of. Runs that the batch does not touch are left alone.

    The batch must not be in the state already, nor repeat rounds that are.
    """
    draft = Draft(spark, warehouse)
    with scratch_table(runs_of_batch(spark, bronze, batch), "batch-runs") as named:
        known = manifest(spark, warehouse, draft.base).where("mergeable").select("run_id")
        same = named["run_id"].eqNullSafe(known["run_id"])
        with (
            scratch_table(named.join(known, same, "left_semi"), "known-runs") as merged,
            scratch_table(named.join(known, same, "left_anti"), "new-runs") as new,
            scratch_table(_new_segments(spark, bronze, batch, merged), "new-segments") as added,
        ):
            old = {
                table: runs_only(read_table(spark, warehouse, table, schema, draft.base), merged)
                for table, schema in STATE.items()
            }
            own = runs_only(read_batch(spark, bronze, batch), merged)
            fresh = runs_only(read_bronze(spark, bronze), new)
            totals = _typed(gold.totals(silver_rounds(own), gold.PER_BUCKET), STATE[TOTALS])
            totals = gold.roll_up(old[TOTALS].unionByName(totals), gold.PER_BUCKET)
            newly = _typed(gold.totals(silver_rounds(fresh), gold.PER_BUCKET), STATE[TOTALS])
            totals = _typed(totals, STATE[TOTALS]).unionByName(newly)
            with scratch_table(_crossed(old[ANSWERS], added), "crossed-blocks") as crossed:
                answers = _merged_segments(old[ANSWERS], added, crossed).unionByName(
                    _typed(gold.answers_in_blocks(fresh), STATE[ANSWERS])
                )
                if not crossed.isEmpty():
                    rounds = rounds_in_blocks(spark, bronze, crossed)
                    again = _typed(gold.answers_in_blocks(rounds), STATE[ANSWERS])
                    answers = answers.unionByName(again)
                _publish_state(draft, totals, answers, True, named, applied)


def _new_segments(
    spark: SparkSession, bronze: str, batch: str, runs: DataFrame
) -> DataFrame:
    own = runs_only(read_batch(spark, bronze, batch), runs)
    return _typed(gold.answers_in_blocks(own), STATE[ANSWERS])


_BLOCK_KEY = (*MATCH, "block")


def _same_block(left: DataFrame, right: DataFrame) -> Column:
    same = [left[c].eqNullSafe(right[c]) for c in _BLOCK_KEY]
    return same[0] & same[1] & same[2] & same[3]


def _crossed(old: DataFrame, added: DataFrame) -> DataFrame:
    """The blocks in which rounds of both stand between each other, or without a number."""
    met = _same_block(old, added) & F.coalesce(
        (old["first_order"] <= added["last_order"]) & (added["first_order"] <= old["last_order"]),
        F.lit(True),
    )
    return old.join(added, met, "left_semi").select(*_BLOCK_KEY)


def _merged_segments(old: DataFrame, added: DataFrame, crossed: DataFrame) -> DataFrame:
    segments = old.unionByName(added)
    segments = segments.join(crossed, _same_block(segments, crossed), "left_anti")
    return gold.joined_segments(segments, _BLOCK_KEY, "first_order")


def read_gold(spark: SparkSession, warehouse: str, name: str) -> DataFrame:
    """A gold table as last published; its read order is applied by readers, not stored."""
    return read_table(spark, warehouse, name, GOLD[name])


def tidy(
    spark: SparkSession, warehouse: str, hours: float = 168, bronze: str | None = None
) -> int:
    """Join the versions of all runs into one and remove those that are no longer in use.

    Readers see one state throughout. Folders younger than ``hours`` stay. With ``bronze``, small
    batches of its runs are joined as well, those that the tables of the warehouse hold.
    """
    removed = 0
    if bronze is not None:
        join_batches(spark, bronze, hours, last_commit(spark, warehouse).applied)
        removed = remove_joined(spark, bronze, hours)
    join_versions(spark, warehouse, STORED)
    return removed + remove_unused(spark, warehouse, STORED, hours)


def register_gold(spark: SparkSession, warehouse: str, database: str | None = None) -> None:
    """Put the stored gold tables, with their descriptions, into ``database`` (or the current one).

    They are external tables of the last commit; register them again to show a later one. Dropping
    one leaves the files. A table of the same name is replaced only if it is external and of the same
    folder.
    """
    commit = last_commit(spark, warehouse)
    for name, schema in GOLD.items():
        _register(spark, warehouse, name, schema, database)
        _add_partitions(spark, warehouse, name, _named(database, name), commit)


# Partitions named in one statement.
_PARTITIONS = 500


def _add_partitions(
    spark: SparkSession, warehouse: str, name: str, table: str, commit: Commit
) -> None:
    listed = manifest(spark, warehouse, commit).select("run_id", "version")
    runs = read_table(spark, warehouse, name, GOLD[name], commit).select("run_id").distinct()
    same = listed["run_id"].eqNullSafe(runs["run_id"])
    rows = listed.join(runs, same, "left_semi").toLocalIterator()
    while chunk := list(islice(rows, _PARTITIONS)):
        places = []
        for row in chunk:
            run = "null" if row.run_id is None else _quoted(row.run_id)
            folder = partition_folder(spark, "run_id", row.run_id)
            location = _quoted(f"{warehouse}/{name}/version={row.version}/{folder}")
            places.append(f"PARTITION (run_id={run}) LOCATION {location}")
        spark.sql(f"ALTER TABLE {table} ADD IF NOT EXISTS {' '.join(places)}")


def register_silver(spark: SparkSession, bronze: str, database: str | None = None) -> None:
    """A lasting view of the silver layer over the stored bronze table.

    It stays in the catalog after the session ends, as far as the catalog itself does. Register it
    again after batches have been added or joined.
    """
    columns = T.StructType([f for f in BRONZE if f.name != "run_id"])
    columns = T.StructType([*columns, BRONZE["run_id"], T.StructField(BATCH, T.StringType())])
    folder, _, table = bronze.rstrip("/").rpartition("/")
    _register(spark, folder, table, columns, database, "tournament_bronze", ("run_id", BATCH))
    spark.catalog.recoverPartitions(_named(database, "tournament_bronze"))
    # Before a first join every folder counts, and there may be none yet.
    rows = iter(())
    if last_joins(spark, bronze).number:
        rows = unused_folders(spark, bronze).toLocalIterator()
    while chunk := list(islice(rows, _PARTITIONS)):
        places = []
        for row in chunk:
            run = _quoted(row.run_id) if row.run_id else "null"
            places.append(f"PARTITION (run_id={run}, {BATCH}={_quoted(row[BATCH])})")
        table = _named(database, "tournament_bronze")
        spark.sql(f"ALTER TABLE {table} DROP IF EXISTS {', '.join(places)}")
    view, source = _named(database, "silver_rounds"), _named(database, "tournament_bronze")
    listed = ", ".join(
        f"{c} COMMENT {_quoted(COLUMN_COMMENTS.get(c, ''))}" for c in SILVER.names
    )
    spark.sql(
        f"CREATE OR REPLACE VIEW {view} ({listed}) "
        f"COMMENT {_quoted(TABLE_COMMENTS['silver_rounds'])} AS {silver_select(source)}"
    )


def _register(
    spark: SparkSession,
    warehouse: str,
    folder: str,
    schema: T.StructType,
    database: str | None,
    name: str | None = None,
    partitions: tuple[str, ...] = ("run_id",),
) -> None:
    name = name or folder
    table, location = _named(database, name), f"{warehouse}/{folder}"
    if spark.catalog.tableExists(table):
        if not _is_external_at(spark, table, location):
            raise ValueError(f"{table} is not an external table of {location}")
        spark.sql(f"DROP TABLE {table}")
    columns = ", ".join(
        f"{field.name} {field.dataType.simpleString()} "
        f"COMMENT {_quoted(COLUMN_COMMENTS.get(field.name, ''))}"
        for field in schema
    )
    spark.sql(
        f"CREATE TABLE {table} ({columns}) USING parquet PARTITIONED BY ({', '.join(partitions)}) "
        f"COMMENT {_quoted(TABLE_COMMENTS[name])} LOCATION {_quoted(location)}"
    )


def _named(database: str | None, name: str) -> str:
    return f"`{database}`.{name}" if database else name


def _is_external_at(spark: SparkSession, table: str, location: str) -> bool:
    facts = {
        r.col_name: r.data_type for r in spark.sql(f"DESCRIBE TABLE EXTENDED {table}").collect()
    }
    same = path_name(spark, facts.get("Location", "")) == path_name(spark, location)
    return facts.get("Type") == "EXTERNAL" and same


def _quoted(text: str) -> str:
    """SQL string literal."""
    escaped = text.replace("\\", "\\\\").replace("'", "\\'")
    return f"'{escaped}'"
