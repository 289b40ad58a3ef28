"""Where intermediate tables go."""

from __future__ import annotations

import re
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

from tourney.sources.files import remove_table

_CHECKPOINT_DIR = "spark.checkpoint.dir"
_local_scratch: dict[str, str] = {}


def scratch_dir(spark: SparkSession) -> str:
    """Folder for intermediate tables: the shared one the session names.

    Only a local-mode session may go without; it gets a temporary folder of its own.
    """
    configured = spark.conf.get(_CHECKPOINT_DIR, None)
    if configured:
        return configured.rstrip("/")
    context = spark.sparkContext
    if not re.fullmatch(r"local(\[.*\])?", context.master):
        raise ValueError(f"set {_CHECKPOINT_DIR} to a folder every executor can reach")
    app = context.applicationId
    if app not in _local_scratch:
        _local_scratch[app] = tempfile.mkdtemp(prefix="tourney-")
    return _local_scratch[app]


def store(df: DataFrame, name: str) -> str:
    """Write ``df`` as a Parquet table in the scratch folder; returns its path.

    The table stays until the scratch folder is cleaned.
    """
    path = f"{scratch_dir(df.sparkSession)}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return path


def materialise(df: DataFrame, name: str) -> DataFrame:
    """Store ``df`` and read it back.

    Cuts the lineage like a checkpoint does, and later readers still get column pruning,
    filter pushdown and real table sizes.
    """
    return df.sparkSession.read.schema(df.schema).parquet(store(df, name))


@contextmanager
def scratch_table(df: DataFrame, name: str) -> Iterator[DataFrame]:
    """A stored table for the jobs run inside the ``with`` block; removed afterwards."""
    spark = df.sparkSession
    path = store(df, name)
    try:
        yield spark.read.schema(df.schema).parquet(path)
    finally:
        remove_table(spark, path)
