"""Ledgers: the set of source files a layer has processed.

A ledger is a small Parquet table ``(source_file, processed_at)``; it is only
ever appended to and read as a set.  It is written after the data, so a
crash in between makes the retry redo the file (idempotently, see
``bronze.write_layer``) instead of losing it.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillroll.operators.joins import join_small
from tillroll.sources.tables import read_files
from tillroll.schemas import LEDGER_SCHEMA

# Options that read a ledger: its files lie one folder down.
NESTED = {"recursiveFileLookup": "true"}


def read_ledger(spark: SparkSession, path: str) -> DataFrame:
    """Ledger rows; an absent ledger reads as empty."""
    return read_files(spark, LEDGER_SCHEMA, path, empty_if_missing=True, **NESTED)


def record_names(spark: SparkSession, names: list[str], path: str) -> None:
    """Append a (small, distinct) list of names taken from the metadata, as one file.

    Each has a folder of its own: runs that append at the same time share nothing.
    """
    (
        spark.createDataFrame([(n,) for n in names], "source_file string")
        .coalesce(1)
        .withColumn("processed_at", F.current_timestamp())
        .write.parquet(f"{path}/{uuid.uuid4().hex}")
    )


def unprocessed(candidates: DataFrame, ledger: DataFrame, name_col: str = "source_file") -> DataFrame:
    """Candidates whose name is not in the ledger (left anti join).

    NULL names are never candidates.  The ledger is broadcast only when a
    size check proves it small; otherwise the planner shuffles both sides.
    """
    seen = ledger.select(F.col("source_file").alias(name_col))
    return join_small(candidates.where(F.col(name_col).isNotNull()), seen, name_col, "left_anti")
