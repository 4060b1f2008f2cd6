"""Arrow batches of bounded bytes, and memory that Python workers give back."""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import SparkSession

#: Upper bound of one Arrow batch handed to a Python worker.
BATCH_BYTES = 4 << 20


def bound_batches(spark: SparkSession, limit: int = BATCH_BYTES) -> None:
    """Bounds Arrow batches by bytes, so that long texts don't pile up in a worker."""
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(limit))


def release_memory() -> None:
    """Gives what this process has freed back to the system; workers live on for later tasks."""
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (AttributeError, OSError):  # a C library without it
        pass


def tidy(run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """A function for mapInArrow that releases its memory when a task is over."""

    def wrapped(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            yield from run(batches)
        finally:
            release_memory()

    return wrapped
