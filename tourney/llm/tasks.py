"""What functions in tasks need: objects that travel with their code, and memory given back."""

from __future__ import annotations

import ctypes
import functools
import os
from collections.abc import Callable, Iterator
from typing import TypeVar

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import SparkSession

Value = TypeVar("Value")

# A worker process that holds less keeps it for its next task.
KEPT_BYTES = 192 << 20


def shipped(spark: SparkSession, value: Value) -> Callable[[], Value]:
    """A broadcast of ``value`` together with the code of its class, as a function that opens it.

    A plain broadcast names classes by their module, which executors would have to have installed.
    The value is opened once per worker process, so what it keeps in memory serves later tasks too,
    and goes with the broadcast.
    """
    packed = spark.sparkContext.broadcast(cloudpickle.dumps(value))

    def opened() -> Value:
        found = getattr(packed, "opened", None)
        if found is None:
            found = packed.opened = cloudpickle.loads(packed.value)
        return found

    return opened


def giving_back(task: Callable[..., Iterator]) -> Callable[..., Iterator]:
    """The task, with the memory it has used returned to the system when it ends.

    Worker processes live on for later tasks, and their allocators would keep the peak of each.
    """

    @functools.wraps(task)
    def run(batches: Iterator) -> Iterator:
        try:
            yield from task(batches)
        finally:
            if _resident_bytes() > KEPT_BYTES:
                pa.default_memory_pool().release_unused()
                trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
                if trim is not None:
                    trim(0)

    return run


def _resident_bytes() -> int:
    """Memory of this process; unknown counts as much."""
    try:
        with open("/proc/self/statm", encoding="ascii") as file:
            return int(file.read().split()[1]) * os.sysconf("SC_PAGE_SIZE")
    except OSError:
        return KEPT_BYTES + 1
