"""What Python workers hold at a time, and give back when a task ends."""

from __future__ import annotations

import ctypes
import gc
from collections.abc import Iterator
from typing import TypeVar

import pyarrow as pa
from pyspark.sql import SparkSession

#: Bytes of an Arrow batch of texts: a worker holds a few times as much.
BATCH_BYTES = 8 << 20
_SETTING = "spark.sql.execution.arrow.maxBytesPerBatch"
Batch = TypeVar("Batch")


def small_batches(spark: SparkSession) -> None:
    """Bounds the session's Arrow batches; a smaller bound of its own stays."""
    if int(spark.conf.get(_SETTING).rstrip("b")) > BATCH_BYTES:
        spark.conf.set(_SETTING, str(BATCH_BYTES))


def given_back(batches: Iterator[Batch]) -> Iterator[Batch]:
    """The batches of a task; then what the worker's allocators kept goes back to the system.

    A worker outlives its tasks, next to those of later stages.
    """
    try:
        yield from batches
    finally:
        gc.collect()
        pa.default_memory_pool().release_unused()
        trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # of the GNU library
        if trim:
            trim(0)
