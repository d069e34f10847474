"""Bronze and silver storage: Parquet partitioned by source file.

Every write replaces exactly the source-file partitions present in the data
(dynamic partition overwrite).  Re-running a file after a crash therefore
replaces its rows instead of adding a second copy, and a write with no rows
changes nothing.
"""

from __future__ import annotations

import re

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillroll.schemas import (
    BRONZE_COLUMNS,
    CORRUPT_COLUMN,
    INGESTED_AT,
    PRICE_TYPE,
    RAW_COLUMNS,
    REVENUE_TYPE,
    SILVER_COLUMNS,
    SILVER_PROCESSED_AT,
    SOURCE_FILE,
)
from tillroll.session import LAYER_CONF, pinned
from tillroll.sources.tables import is_missing, read_files

BRONZE_SCHEMA = T.StructType(
    [T.StructField(c, T.StringType(), True) for c in RAW_COLUMNS + [CORRUPT_COLUMN]]
    + [
        T.StructField(INGESTED_AT, T.TimestampType(), True),
        T.StructField(SOURCE_FILE, T.StringType(), True),
    ]
)

SILVER_SCHEMA = T.StructType(
    [
        T.StructField("InvoiceNo", T.StringType(), True),
        T.StructField("StockCode", T.StringType(), True),
        T.StructField("Description", T.StringType(), True),
        T.StructField("Quantity", T.IntegerType(), True),
        T.StructField("InvoiceTimestamp", T.TimestampType(), True),
        T.StructField("UnitPrice", PRICE_TYPE, True),
        T.StructField("CustomerID", T.StringType(), True),
        T.StructField("Country", T.StringType(), True),
        T.StructField("Revenue", REVENUE_TYPE, True),
        T.StructField(INGESTED_AT, T.TimestampType(), True),
        T.StructField(SILVER_PROCESSED_AT, T.TimestampType(), True),
        T.StructField(SOURCE_FILE, T.StringType(), True),
    ]
)


def to_bronze(landing_rows: DataFrame) -> DataFrame:
    """Landing rows plus the ingestion time, in bronze column order."""
    return landing_rows.withColumn(INGESTED_AT, F.current_timestamp()).select(*BRONZE_COLUMNS)


def write_layer(df: DataFrame, path: str) -> None:
    """Replace the source-file partitions of ``df`` under ``path``.

    Rows that are read source file by source file are written where they were read,
    without a shuffle: every split holds one source file, so no more files are written
    than splits were read, and a file with a large share of the rows has many.
    Rows in any order are best given with a ``rebalance`` hint on the source file.
    """
    with pinned(df.sparkSession, LAYER_CONF):
        (
            df.write.mode("overwrite")
            .option("partitionOverwriteMode", "dynamic")
            .partitionBy(SOURCE_FILE)
            .parquet(path)
        )


def read_bronze(spark: SparkSession, path: str, empty_if_missing: bool = False) -> DataFrame:
    return read_files(spark, BRONZE_SCHEMA, path, empty_if_missing=empty_if_missing).select(*BRONZE_COLUMNS)


def read_silver(spark: SparkSession, path: str, empty_if_missing: bool = False) -> DataFrame:
    return read_files(spark, SILVER_SCHEMA, path, empty_if_missing=empty_if_missing).select(*SILVER_COLUMNS)


# Characters that Hive-style partition folders spell as %XX.
_ESCAPED = re.compile(r"""[\x00-\x1f"#%'*/:=?\\\x7f{\[\]^]""")
# What is left of the characters a glob gives a meaning.
_GLOB = re.compile(r"([,}])")


def partition_path(path: str, name: str) -> str:
    """The partition folder of one source file."""
    return f"{path}/{SOURCE_FILE}={_ESCAPED.sub(lambda m: f'%{ord(m[0]):02X}', name)}"


def partition_glob(path: str, names: list[str]) -> str:
    """One glob that matches the partition folders of the named source files."""
    folders = [_GLOB.sub(r"\\\1", _ESCAPED.sub(lambda m: f"%{ord(m[0]):02X}", n)) for n in names]
    return f"{path}/{SOURCE_FILE}={{{','.join(folders)}}}"


def read_named(spark: SparkSession, path: str, schema, names: list[str]) -> DataFrame:
    """Rows of the named source files; only their partitions are listed and read.

    A name without a partition (a file without rows) adds nothing.
    """
    if not names:
        return spark.createDataFrame([], schema)
    return read_files(spark, schema, partition_glob(path, names), empty_if_missing=True, basePath=path)


def present(spark: SparkSession, path: str, names: list[str]) -> list[str]:
    """Those of the (few) names that have a partition, from the file listing alone."""
    if not names:
        return []
    try:
        files = (
            spark.read.format("binaryFile")
            .option("basePath", path)
            .option("pathGlobFilter", "*.parquet")
            .load(partition_glob(path, names))
        )
    except AnalysisException as err:
        if not is_missing(err):
            raise
        return []
    if SOURCE_FILE not in files.columns:  # folders without a data file
        return []
    return sorted(r[0] for r in files.select(F.col(SOURCE_FILE).cast("string")).distinct().collect())


def partitions(spark: SparkSession, path: str) -> DataFrame:
    """Source-file partitions present under a layer (``source_file``).

    Answered from the file listing alone (``binaryFile`` with the content
    pruned; partition discovery supplies ``_source_file``): the cost grows
    with the number of files, never with the number of rows, and no data
    file is opened.
    """
    files = (
        spark.read.format("binaryFile")
        .option("pathGlobFilter", "*.parquet")
        .load(path)
    )
    if SOURCE_FILE not in files.columns:  # nothing written yet
        return spark.createDataFrame([], "source_file string")
    return files.select(F.col(SOURCE_FILE).cast("string").alias("source_file")).distinct()
