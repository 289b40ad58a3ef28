"""Stored tables of which readers see one state at a time.

Every change writes folders of its own, ``<table>/version=<id>/run_id=…``, beside those in use. Which
version of each run counts stands in a manifest, a small table of one row per run, and the last file
in ``_commits`` names the manifest. Creating that file is the only step that readers notice, and it
switches all tables at once: a job that fails before it leaves everything as it was, and of two jobs
that started from the same commit only one can make the next.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Mapping
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tourney.sources.files import (
    age_hours,
    file_names,
    last_entry,
    remove_table,
    table_exists,
    write_new,
)

_COMMITS, _MANIFESTS = "_commits", "_manifests"
# ``mergeable``: later batches can be merged to the stored states of the run.
_MANIFEST = "run_id string, version string, mergeable boolean"


class Conflict(Exception):
    """Another job has published since this one began."""


@dataclass(frozen=True)
class Commit:
    """``applied`` is the last batch of each ingesting query that the tables contain, and ``only`` the
    version of all runs when they share one."""

    number: int = 0
    manifest: str | None = None
    only: str | None = None
    applied: Mapping[str, int] = field(default_factory=dict)


def last_commit(spark: SparkSession, warehouse: str) -> Commit:
    number, text = last_entry(spark, f"{warehouse}/{_COMMITS}")
    return Commit(number=number, **json.loads(text)) if number else Commit()


def manifest(spark: SparkSession, warehouse: str, commit: Commit) -> DataFrame:
    if commit.manifest is None:
        return spark.createDataFrame([], _MANIFEST)
    path = f"{warehouse}/{_MANIFESTS}/{commit.manifest}"
    return spark.read.schema(_MANIFEST).parquet(path)


def _with_version(schema: T.StructType) -> T.StructType:
    return T.StructType([*schema, T.StructField("version", T.StringType())])


def read_table(
    spark: SparkSession,
    warehouse: str,
    table: str,
    schema: T.StructType,
    commit: Commit | None = None,
) -> DataFrame:
    """The rows of the last commit, or of ``commit``; no rows before the first."""
    commit = last_commit(spark, warehouse) if commit is None else commit
    if commit.manifest is None:
        return spark.createDataFrame([], schema)
    if commit.only is not None:
        stored = spark.read.schema(schema)
        return stored.parquet(f"{warehouse}/{table}/version={commit.only}").select(*schema.names)
    rows = spark.read.schema(_with_version(schema)).parquet(f"{warehouse}/{table}")
    # The comparison lets Spark skip the folders of other versions when it broadcasts the list.
    listed = manifest(spark, warehouse, commit).where("version >= ''")
    listed = listed.select(F.col("run_id").alias("_run"), F.col("version").alias("_version"))
    same = (F.col("version") == F.col("_version")) & F.col("run_id").eqNullSafe(F.col("_run"))
    return rows.join(listed, same, "left_semi").select(*schema.names)


class Draft:
    """A version in the making: tables are written, read back, and published together."""

    def __init__(self, spark: SparkSession, warehouse: str) -> None:
        self.spark, self.warehouse = spark, warehouse
        self.base = last_commit(spark, warehouse)
        self.version = uuid.uuid4().hex

    def _path(self, table: str) -> str:
        return f"{self.warehouse}/{table}/version={self.version}"

    def write(self, table: str, rows: DataFrame, schema: T.StructType) -> DataFrame:
        """Store ``rows`` by run; returns the stored rows."""
        (
            rows.hint("rebalance", "run_id")
            .write.mode("overwrite")
            .partitionBy("run_id")
            .parquet(self._path(table))
        )
        return self.spark.read.schema(schema).parquet(self._path(table)).select(*schema.names)

    def publish(
        self,
        present: DataFrame,
        named: DataFrame | None,
        applied: Mapping[str, int] | None = None,
    ) -> None:
        """Make the written tables those that readers see.

        ``present`` are the runs (``run_id``, ``mergeable``) that have rows in them. ``named`` are the
        runs they replace, all if None; other runs keep their version, and a named run that is not
        present is gone.
        """
        rows = present.select("run_id", F.lit(self.version).alias("version"), "mergeable")
        rows = rows.distinct()
        if named is not None:
            kept = manifest(self.spark, self.warehouse, self.base)
            gone = named.select(F.col("run_id").alias("_gone"))
            same = F.col("run_id").eqNullSafe(F.col("_gone"))
            rows = kept.join(gone, same, "left_anti").unionByName(rows)
        name = uuid.uuid4().hex
        rows.write.parquet(f"{self.warehouse}/{_MANIFESTS}/{name}")
        self._commit(name, self.version if named is None else None, applied)

    def mark_applied(self, applied: Mapping[str, int]) -> None:
        """Record batches that change no table."""
        self._commit(self.base.manifest, self.base.only, applied)

    def _commit(
        self, name: str | None, only: str | None, applied: Mapping[str, int] | None
    ) -> None:
        content = {
            "manifest": name,
            "only": only,
            "applied": {**self.base.applied, **(applied or {})},
        }
        path = f"{self.warehouse}/{_COMMITS}/{self.base.number + 1:012d}.json"
        if not write_new(self.spark, path, json.dumps(content) + "\n"):
            raise Conflict(f"{path} exists")


def remove_unused(
    spark: SparkSession, warehouse: str, tables: Mapping[str, T.StructType], hours: float = 168
) -> int:
    """Remove the versions that the last commit does not use; returns how many folders went.

    Folders younger than ``hours`` stay, for readers of earlier commits and for drafts under way.
    """
    commit = last_commit(spark, warehouse)
    # One version per publishing job since the tables were last joined, not one per run.
    used = {r.version for r in manifest(spark, warehouse, commit).select("version").distinct().collect()}
    removed = 0
    for table in tables:
        for name in file_names(spark, f"{warehouse}/{table}"):
            path = f"{warehouse}/{table}/{name}"
            unused = name.startswith("version=") and name.removeprefix("version=") not in used
            if unused and age_hours(spark, path) >= hours:
                remove_table(spark, path)
                removed += 1
    for name in file_names(spark, f"{warehouse}/{_MANIFESTS}"):
        path = f"{warehouse}/{_MANIFESTS}/{name}"
        if name != commit.manifest and age_hours(spark, path) >= hours:
            remove_table(spark, path)
    for name in file_names(spark, f"{warehouse}/{_COMMITS}"):
        path = f"{warehouse}/{_COMMITS}/{name}"
        older = name.endswith(".json") and int(name.removesuffix(".json")) < commit.number
        if older and age_hours(spark, path) >= hours:
            remove_table(spark, path)
    return removed


def join_versions(spark: SparkSession, warehouse: str, tables: Mapping[str, T.StructType]) -> None:
    """Write the rows of all runs into one version, in files of even size, and publish it."""
    draft = Draft(spark, warehouse)
    listed = manifest(spark, warehouse, draft.base)
    for table, schema in tables.items():
        if table_exists(spark, f"{warehouse}/{table}"):
            draft.write(table, read_table(spark, warehouse, table, schema, draft.base), schema)
    draft.publish(listed, None)
