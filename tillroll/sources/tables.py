"""Access to the supplied Parquet tables (one file per table)."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession

TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()


_OPENED: dict = {}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """The supplied table ``name``.  The files are read-only, so the opened
    DataFrame (file listing and footer schema) is reused within a session."""
    if name not in TABLES:
        raise KeyError(name)
    key = (id(spark), sf_dir.rstrip("/"), name)
    hit = _OPENED.get(key)
    if hit is None or hit.sparkSession is not spark:
        hit = spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")
        _OPENED[key] = hit
    return hit


def is_missing(err: AnalysisException) -> bool:
    """Whether Spark reports that no file is at the path."""
    return err.getCondition() == "PATH_NOT_FOUND"


def read_files(spark: SparkSession, schema, *paths: str, empty_if_missing: bool = False, **options: str) -> DataFrame:
    """Parquet files under an explicit schema.

    A path without files is a FileNotFoundError, or an empty table if asked for.
    """
    try:
        return spark.read.schema(schema).options(**options).parquet(*paths)
    except AnalysisException as err:
        if not is_missing(err):
            raise
        if empty_if_missing:
            return spark.createDataFrame([], schema)
        raise FileNotFoundError(f"Nothing has been written to {', '.join(paths)} yet") from err
