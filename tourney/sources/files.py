"""Facts about stored tables, asked of the file system that holds them."""

from __future__ import annotations

import time

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# A lookup is broadcast up to this many bytes of its table and rows of its own.
BROADCAST_BYTES = 8 << 20
BROADCAST_ROWS = 1_000_000


def _locate(spark: SparkSession, path: str):
    location = spark._jvm.org.apache.hadoop.fs.Path(path)
    return location.getFileSystem(spark._jsc.hadoopConfiguration()), location


def table_bytes(spark: SparkSession, path: str) -> int:
    file_system, location = _locate(spark, path)
    return file_system.getContentSummary(location).getLength()


def table_version(spark: SparkSession, path: str) -> str:
    """Changes when the file or folder at ``path`` is written again."""
    file_system, location = _locate(spark, path)
    modified = file_system.getFileStatus(location).getModificationTime()
    return f"{path}:{table_bytes(spark, path)}:{modified}"


def remove_table(spark: SparkSession, path: str) -> None:
    file_system, location = _locate(spark, path)
    file_system.delete(location, True)


def table_exists(spark: SparkSession, path: str) -> bool:
    file_system, location = _locate(spark, path)
    return file_system.exists(location)


def path_name(spark: SparkSession, path: str) -> str:
    """The path as its file system writes it, to compare two spellings of it."""
    if not path:
        return ""
    file_system, location = _locate(spark, path)
    return file_system.makeQualified(location).toString().rstrip("/")


def mark_done(spark: SparkSession, path: str) -> None:
    file_system, location = _locate(spark, f"{path}/_DONE")
    file_system.create(location, True).close()


def list_folders(spark: SparkSession, path: str) -> list[str]:
    file_system, location = _locate(spark, path)
    if not file_system.exists(location):
        return []
    return [status.getPath().toString() for status in file_system.listStatus(location)]


def file_names(spark: SparkSession, path: str) -> list[str]:
    return [folder.rsplit("/", 1)[-1] for folder in list_folders(spark, path)]


def age_hours(spark: SparkSession, path: str) -> float:
    """Hours since the folder itself was last changed."""
    file_system, location = _locate(spark, path)
    modified = file_system.getFileStatus(location).getModificationTime()
    return (time.time() * 1000 - modified) / 3_600_000


def write_new(spark: SparkSession, path: str, text: str) -> bool:
    """Create a small file; False if there is one already, which stays as it is."""
    file_system, location = _locate(spark, path)
    try:
        stream = file_system.create(location, False)
    except Py4JJavaError as error:
        if file_system.exists(location):
            return False
        raise error
    try:
        stream.write(bytearray(text.encode()))
    finally:
        stream.close()
    return True


def read_text(spark: SparkSession, path: str) -> str:
    """A small file."""
    file_system, location = _locate(spark, path)
    stream = file_system.open(location)
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def last_entry(spark: SparkSession, folder: str) -> tuple[int, str]:
    """Number and text of the last whole file of a log ``<folder>/<number>.json``; 0 without one."""
    for name in sorted(file_names(spark, folder), reverse=True):
        if not name.endswith(".json"):
            continue
        text = read_text(spark, f"{folder}/{name}")
        # A file without its last line is still being written, so the one before it counts.
        if text.endswith("\n"):
            return int(name.removesuffix(".json")), text
    return 0, ""


def partition_folder(spark: SparkSession, column: str, value: str | None) -> str:
    """Name of the folder that holds one value of a partition column."""
    names = spark._jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils
    return names.getPartitionPathString(column, value)


def broadcast_if_small(df: DataFrame, base_path: str) -> DataFrame:
    """Broadcast ``df``, derived from the table at ``base_path``, if both are small.

    Spark's own estimate of a join's size multiplies the sides, so it would shuffle the large side
    for a lookup of a few rows. The rows of ``df`` are only counted when the files are small. Beyond
    either limit there is no hint and Spark joins by shuffle.
    """
    small = table_bytes(df.sparkSession, base_path) <= BROADCAST_BYTES
    if small and df.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS:
        return F.broadcast(df)
    return df
