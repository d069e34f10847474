"""Helpers shared by the operators: reading tables, cutting lineage, byte windows."""

from __future__ import annotations

import ctypes
import functools
import gc
import sys
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from tillroll.session import fresh_dir

# The characters of [\x20\x09-\x0D].
WHITESPACE = " \t\n\x0b\f\r"

# The non-empty runs outside WHITESPACE are the words of a text.
WORD = r"[^\x20\x09-\x0D]+"

# Bytes of text that one numpy pass looks at; keeps its arrays in cache.
SLICE_BYTES = 1 << 18


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


# Rows of a light table (ids, hashes, counts) that one writing task takes.
ROWS_PER_TASK = 50_000


def settle(df: DataFrame, label: str, rows: int | None = None) -> DataFrame:
    """Write ``df`` to a new folder under ``spark.checkpoint.dir`` and read it back.

    Cuts the lineage: a lost executor costs at most the work after the last
    settled table, and every later reader sees the same rows.  ``rows``: about how
    many light rows there are, for as many tasks and files as they need.
    """
    spark = df.sparkSession
    path = fresh_dir(spark, label)
    if rows is not None:
        df = df.coalesce(max(1, -(-rows // ROWS_PER_TASK)))
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def slices(texts: list[bytes], limit: int = SLICE_BYTES) -> Iterator[tuple[int, int]]:
    """Ranges [lo, hi) of whole texts, each range of about ``limit`` bytes."""
    lo = size = 0
    for i, text in enumerate(texts):
        if size and size + len(text) > limit:
            yield lo, i
            lo, size = i, 0
        size += len(text)
    if lo < len(texts):
        yield lo, len(texts)


def utf8(column) -> list[bytes]:
    """The UTF-8 bytes of an Arrow string column; null counts as empty."""
    return [x or b"" for x in column.cast("binary").to_pylist()]


def windows(data: np.ndarray, n: int, count: int) -> np.ndarray:
    """For positions 0..count-1 of ``data``, its next n <= 8 bytes as one integer."""
    out = np.zeros(count, np.uint64)
    for k in range(n):
        out <<= np.uint64(8)
        out |= data[k : k + count]
    return out


def give_back() -> None:
    """Hand the memory that this Python worker no longer uses back to the machine.

    Workers outlive tasks; without this, each keeps the most that any of its tasks took.
    """
    gc.collect()
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (AttributeError, OSError):  # not every C library has it
        pass


# The module under which an operator keeps something from task to task in a worker.
KEPT = "_tillroll_kept"


def released(run: Callable, keep: bool = False) -> Callable:
    """``run`` for mapInArrow, which gives memory back at a task's end.

    Only tasks with ``keep`` leave in the worker what an operator has stored under
    KEPT; any other task frees it before it starts.
    """

    @functools.wraps(run)
    def task(batches):
        if not keep and sys.modules.pop(KEPT, None):
            give_back()
        try:
            yield from run(batches)
        finally:
            give_back()

    return task
