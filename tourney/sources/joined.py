"""Which folders of the bronze table count, once small batches have been joined.

Joining writes the rounds of many folders ``run_id=…/batch=…`` into folders of one new batch. The last
file of the log ``<bronze>/_joins`` names the joined batches that count and the folders they stand
for; creating it is the step that readers notice. A joined batch that no file names does not count.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterable
from dataclasses import dataclass

from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F

from tourney.sources.files import last_entry, write_new
from tourney.sources.versions import Conflict

# Partition column of the bronze table that tells apart what different loads have added to a run.
BATCH = "batch"
_JOINED = "joined-"
_LOG = "_joins"

# A folder: its batch and its run, whose name is empty for rounds without a run id.
Folder = tuple[str, str]


@dataclass(frozen=True)
class Joins:
    """``joined`` are the joined batches that count, ``replaced`` the folders that no longer do.

    Both are held by the driver, as the file index of the table is: a replaced folder is listed until
    it has been removed.
    """

    number: int = 0
    joined: frozenset[str] = frozenset()
    replaced: frozenset[Folder] = frozenset()


def log_folder(path: str) -> str:
    return f"{path.rstrip('/')}/{_LOG}"


def parse_joins(number: int, text: str) -> Joins:
    if not text:
        return Joins()
    content = json.loads(text)
    replaced = frozenset((batch, run) for batch, run in content["replaced"])
    return Joins(number, frozenset(content["joined"]), replaced)


def last_joins(spark: SparkSession, path: str) -> Joins:
    return parse_joins(*last_entry(spark, log_folder(path)))


def new_joined_batch() -> str:
    return _JOINED + uuid.uuid4().hex


def is_joined(batch: Column) -> Column:
    return batch.startswith(_JOINED)


def folder_key(batch: Column, run: Column) -> Column:
    """One text for a folder, which no other folder shares."""
    return F.concat(F.length(batch).cast("string"), F.lit(":"), batch, F.coalesce(run, F.lit("")))


def is_one_of(folders: Iterable[Folder]) -> Column:
    """Whether a row lies in one of the folders; Spark decides that by folder, before it reads."""
    keys = sorted(f"{len(batch)}:{batch}{run}" for batch, run in folders)
    return folder_key(F.col(BATCH), F.col("run_id")).isin(keys)


def in_use(joins: Joins) -> Column:
    """Whether a row counts."""
    counts = ~is_joined(F.col(BATCH)) | F.col(BATCH).isin(sorted(joins.joined))
    return counts & ~is_one_of(joins.replaced)


def publish_joins(spark: SparkSession, path: str, joins: Joins) -> None:
    """Make ``joins`` what counts, if it follows the last entry."""
    content = {"joined": sorted(joins.joined), "replaced": sorted(joins.replaced)}
    entry = f"{log_folder(path)}/{joins.number:012d}.json"
    if not write_new(spark, entry, json.dumps(content) + "\n"):
        raise Conflict(f"{entry} exists")
