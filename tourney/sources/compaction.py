"""Joins the small batches of each run of the bronze table into files of even size."""

from __future__ import annotations

import re
from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tourney.sources.bronze import stored_rounds, write_by_run
from tourney.sources.files import (
    age_hours,
    file_names,
    partition_folder,
    read_text,
    remove_table,
    table_exists,
)
from tourney.sources.joined import (
    BATCH,
    Folder,
    Joins,
    in_use,
    is_joined,
    is_one_of,
    last_joins,
    log_folder,
    new_joined_batch,
    parse_joins,
    publish_joins,
)

# A folder whose files are smaller on average is joined with others of its run.
SMALL_BYTES = 32 << 20

# Batches of an ingesting query: its id and a number.
_INGESTED = re.compile(r"([0-9a-f]{8}(?:-[0-9a-f]{4}){3}-[0-9a-f]{12})-([0-9]+)")
_NO_RUN = "__HIVE_DEFAULT_PARTITION__"


def _name_in(path: Column, column: str) -> Column:
    """Value of a partition column as a folder name spells it; empty for null."""
    spelled = F.regexp_extract(path, f"/{column}=([^/]*)/", 1)
    value = F.url_decode(F.replace(spelled, F.lit("+"), F.lit("%2B")))
    return F.when(spelled == _NO_RUN, F.lit("")).otherwise(value)


def folder_sizes(spark: SparkSession, path: str) -> DataFrame:
    """Every folder of the table, in use or not: ``run_id`` (empty for null), ``batch``, ``files``,
    ``bytes`` and ``modified``. Files are listed, not opened."""
    listed = (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", "true")
        .option("pathGlobFilter", "*.parquet")
        .load(path)
    )
    return (
        listed.groupBy(
            _name_in(F.col("path"), "run_id").alias("run_id"),
            _name_in(F.col("path"), BATCH).alias(BATCH),
        )
        .agg(
            F.count(F.lit(1)).alias("files"),
            F.sum("length").alias("bytes"),
            F.max("modificationTime").alias("modified"),
        )
        .where(F.col(BATCH) != "")
    )


def unused_folders(spark: SparkSession, path: str) -> DataFrame:
    """Folders (``run_id``, ``batch``) that no longer count, or do not count yet."""
    return folder_sizes(spark, path).where(~in_use(last_joins(spark, path))).select("run_id", BATCH)


def _older(hours: float) -> Column:
    seconds = F.unix_millis(F.current_timestamp()) - F.unix_millis(F.col("modified"))
    return seconds >= hours * 3_600_000


def _to_join(folders: DataFrame, small_bytes: int) -> DataFrame:
    """Of each run with several folders of small files, these folders."""
    small = folders.where(F.col("bytes") < small_bytes * F.col("files"))
    several = small.groupBy("run_id").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    return small.join(several, "run_id", "left_semi")


def _pending(batch: str, applied: Mapping[str, int]) -> bool:
    """Whether an ingesting query may store the batch again."""
    found = _INGESTED.fullmatch(batch)
    return found is not None and int(found[2]) > applied.get(found[1], -1)


def join_batches(
    spark: SparkSession,
    path: str,
    hours: float = 168,
    applied: Mapping[str, int] | None = None,
    small_bytes: int = SMALL_BYTES,
) -> int:
    """Join folders of small files, run by run; returns how many folders were joined.

    Which ones is planned from the sizes of files alone. Readers see the table before or after, with
    the same rounds, and a job that fails changes nothing for them. The old folders stay until
    ``remove_joined``. Folders changed within ``hours`` are left alone, as are those of batches that
    an ingesting query has not finished by ``applied`` (see ``versions.Commit``): a load that repeats
    itself must find its batch under its own name, which a joined batch has lost.
    """
    if not table_exists(spark, path):
        return 0
    before = last_joins(spark, path)
    sizes = folder_sizes(spark, path)
    # As many rows as the table has folders, which the driver lists in any case to read it.
    rows = _to_join(sizes.where(in_use(before) & _older(hours)), small_bytes).collect()
    by_run: dict[str, list[Folder]] = {}
    for row in rows:
        if not _pending(row[BATCH], applied or {}):
            by_run.setdefault(row.run_id, []).append((row[BATCH], row.run_id))
    chosen = {folder for folders in by_run.values() if len(folders) > 1 for folder in folders}
    if not chosen:
        return 0
    if not before.number:
        # From the first entry on, readers tell apart what a join has not finished.
        before = Joins(1)
        publish_joins(spark, path, before)
    batch = new_joined_batch()
    write_by_run(stored_rounds(spark, path).where(is_one_of(chosen)), path, batch)
    known = is_one_of(before.replaced) | F.col(BATCH).isin(sorted(before.joined))
    there = {(row[BATCH], row.run_id) for row in sizes.where(known).collect()}
    joined = frozenset(name for name, _ in there if name in before.joined)
    replaced = frozenset(before.replaced & there | chosen)
    publish_joins(spark, path, Joins(before.number + 1, joined | {batch}, replaced))
    return len(chosen)


def remove_joined(spark: SparkSession, path: str, hours: float = 168) -> int:
    """Remove folders that were joined at least ``hours`` ago, and what failed joins have left; returns
    how many folders went."""
    folder, last = log_folder(path), last_joins(spark, path)
    gone: set[Folder] = set()
    old = [n for n in file_names(spark, folder) if age_hours(spark, f"{folder}/{n}") >= hours]
    for name in sorted(n for n in old if n.endswith(".json")):
        number = int(name.removesuffix(".json"))
        if number == last.number:
            gone |= last.replaced
        elif number < last.number:
            gone |= parse_joins(number, read_text(spark, f"{folder}/{name}")).replaced
            remove_table(spark, f"{folder}/{name}")
    if table_exists(spark, path):
        left = is_joined(F.col(BATCH)) & ~in_use(last) & _older(hours)
        left &= ~is_one_of(last.replaced)
        rows = folder_sizes(spark, path).where(left | is_one_of(gone)).select(BATCH, "run_id")
        gone = {(row[BATCH], row.run_id) for row in rows.collect()}
    for batch, run in gone:
        run_folder = partition_folder(spark, "run_id", run or None)
        remove_table(spark, f"{path.rstrip('/')}/{run_folder}/{partition_folder(spark, BATCH, batch)}")
    return len(gone)
