"""Landing zone: discovery and CSV reading of sales files.

A landing entry is named ``sales_YYYY_MM.csv``.  It is either a plain file (as
an external producer drops it) or a folder of part files as Spark's own CSV
writer produces (our monthly split writes ``file=sales_YYYY_MM.csv/part-…``).
Both layouts are matched by one glob and labelled by one rule.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillroll.functions.naming import landing_label, plain_path
from tillroll.schemas import CORRUPT_COLUMN, RAW_COLUMNS, RAW_READ_SCHEMA, SOURCE_FILE
from tillroll.session import OPEN_FILES_CONF, pinned
from tillroll.sources.tables import is_missing

# Partition column our split writes; its folders are landing entries too.
SPLIT_COLUMN = "file"
LANDING_PATTERN = "{sales_*.csv,file=sales_*.csv}"

# CSV dialect of landing files: header line, RFC-4180 quoting ("" inside a
# quoted cell), cell whitespace kept as is.
CSV_READ_OPTIONS = {
    "header": "true",
    "quote": '"',
    "escape": '"',
    "mode": "PERMISSIVE",
    "columnNameOfCorruptRecord": CORRUPT_COLUMN,
    "ignoreLeadingWhiteSpace": "false",
    "ignoreTrailingWhiteSpace": "false",
}
CSV_WRITE_OPTIONS = {
    "header": "true",
    "compression": "gzip",  # part files are small, so none needs to be split again
    "quote": '"',
    "escape": '"',
    "ignoreLeadingWhiteSpace": "false",
    "ignoreTrailingWhiteSpace": "false",
}

# What the ``binaryFile`` source yields; its content is never selected here.
LISTING_SCHEMA = "path STRING, modificationTime TIMESTAMP, length BIGINT, content BINARY"

LISTING_COLUMNS = "source_file STRING, path STRING, length BIGINT, modificationTime TIMESTAMP"


def landing_glob(landing_root: str, pattern: str = LANDING_PATTERN) -> str:
    return f"{landing_root.rstrip('/')}/{pattern}"


def list_files(spark: SparkSession, landing_root: str, pattern: str = LANDING_PATTERN) -> DataFrame:
    """Data files of every landing entry, one row per file (content not read).

    ``binaryFile`` with the ``content`` column pruned only lists the files.
    Returns ``source_file, path, length, modificationTime``.
    """
    try:
        files = spark.read.format("binaryFile").load(landing_glob(landing_root, pattern))
    except AnalysisException as err:
        if not is_missing(err):
            raise
        # No entry matches: fine for an existing (empty) landing folder, an
        # error when the folder itself is missing.
        try:
            spark.read.format("binaryFile").load(landing_root)
        except AnalysisException as root_err:
            if is_missing(root_err):
                raise FileNotFoundError(f"No landing zone at {landing_root}") from root_err
            raise
        return spark.createDataFrame([], LISTING_COLUMNS)
    return files.select(
        landing_label("path").alias("source_file"), "path", "length", "modificationTime"
    )


def list_landing(spark: SparkSession, landing_root: str, pattern: str = LANDING_PATTERN) -> DataFrame:
    """One row per landing entry: ``source_file, files, bytes, modified``."""
    return (
        list_files(spark, landing_root, pattern)
        .groupBy("source_file")
        .agg(
            F.count("*").alias("files"),
            F.sum("length").alias("bytes"),
            F.max("modificationTime").alias("modified"),
        )
    )


def entry_path(landing_root: str, name: str) -> str:
    """Glob that matches the landing entry ``name`` in either layout."""
    plain = "".join(f"\\{c}" if c in "\\{}[]*?,^" else c for c in name)
    return f"{landing_root.rstrip('/')}/{{{plain},{SPLIT_COLUMN}={plain}}}"


def read_csv(spark: SparkSession, paths) -> DataFrame:
    """Raw text rows of landing files, plus ``_corrupt`` and ``_source_file``.

    Columns bind by position under a fixed all-string schema (header text is
    ignored).  Short lines are padded with NULL and long lines cut, both kept
    and flagged in ``_corrupt``.
    """
    df = spark.read.schema(RAW_READ_SCHEMA).options(**CSV_READ_OPTIONS).csv(paths)
    # Worked out for every row: on the path's last two parts only, each step once.
    last_two = df.withColumn("_path", F.substring_index("_metadata.file_path", "/", -2))
    plain = last_two.withColumn("_path", plain_path("_path"))
    return plain.withColumn(SOURCE_FILE, landing_label("_path")).drop("_path")


def write_csv(df: DataFrame, landing_root: str, label_col: str = SOURCE_FILE, replace: bool = False) -> None:
    """Write rows as landing entries, one folder per value of ``label_col``.

    ``replace``: entries that ``df`` has rows for are replaced, others stay;
    otherwise files are added.  ``REBALANCE`` on the label lets AQE split a label
    that holds a large share of the rows over several writer tasks (several part
    files) instead of one.
    """
    out = df.select(*RAW_COLUMNS, F.col(label_col).alias(SPLIT_COLUMN)).hint("rebalance", SPLIT_COLUMN)
    writer = out.write.mode("overwrite" if replace else "append")
    if replace:
        writer = writer.option("partitionOverwriteMode", "dynamic")
    with pinned(df.sparkSession, OPEN_FILES_CONF):
        writer.partitionBy(SPLIT_COLUMN).options(**CSV_WRITE_OPTIONS).csv(landing_root)
