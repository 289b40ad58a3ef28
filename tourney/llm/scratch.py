"""Intermediate tables that go when the operator that made them is done."""

from __future__ import annotations

import functools
from collections.abc import Callable, Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

from tourney.session import store
from tourney.sources.files import remove_table

# Settings while an operator is at work: shuffle files go with the query they belong to, and rows
# that hold whole texts or sets go to Python in small batches.
_SETTINGS = {
    "spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true",
    "spark.sql.execution.arrow.maxRecordsPerBatch": "2000",
}

# Paths of the tables of the operators at work, the innermost last.
_open: list[list[str]] = []


@contextmanager
def workspace(spark: SparkSession) -> Iterator[None]:
    """Tables that ``materialise`` writes inside are removed at the end."""
    before = {name: spark.conf.get(name) for name in _SETTINGS}
    for name, value in _SETTINGS.items():
        spark.conf.set(name, value)
    _open.append([])
    try:
        yield
    finally:
        for name, value in before.items():
            spark.conf.set(name, value)
        for path in _open.pop():
            remove_table(spark, path)


def _stored(df: DataFrame, name: str, level: int) -> DataFrame:
    path = store(df, name)
    if len(_open) >= level:
        _open[-level].append(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def materialise(df: DataFrame, name: str) -> DataFrame:
    """Store ``df`` in the shared folder and read it back, which also cuts the lineage."""
    return _stored(df, name, 1)


def finished(df: DataFrame, name: str) -> DataFrame:
    """A result that outlives the innermost workspace."""
    return _stored(df, name, 2)


def cleaned(operator: Callable[..., DataFrame]) -> Callable[..., DataFrame]:
    """The operator with its result stored and its intermediate tables removed."""

    @functools.wraps(operator)
    def run(first: DataFrame, *args, **kwargs) -> DataFrame:
        with workspace(first.sparkSession):
            return finished(operator(first, *args, **kwargs), operator.__name__)

    return run
