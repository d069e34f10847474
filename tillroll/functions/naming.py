"""File names and labels."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def month_file_name(ts) -> Column:
    """Landing file name of the calendar month of ``ts``: sales_YYYY_MM.csv."""
    ts = F.col(ts) if isinstance(ts, str) else ts
    return F.concat(
        F.lit("sales_"), F.year(ts).cast("string"), F.lit("_"),
        F.lpad(F.month(ts).cast("string"), 2, "0"), F.lit(".csv"),
    )


def base_name(path) -> Column:
    """Last component of a path."""
    path = F.col(path) if isinstance(path, str) else path
    return F.substring_index(path, "/", -1)


def plain_path(uri) -> Column:
    """A percent-encoded file URI (``_metadata.file_path``) as plain text, the way
    file listings spell it.  A plus sign is itself, not a blank.  Without a percent sign
    it is plain already; this is worked out for every row."""
    uri = F.col(uri) if isinstance(uri, str) else uri
    decoded = F.url_decode(F.replace(uri, F.lit("+"), F.lit("%2B")))
    return F.when(uri.contains("%"), decoded).otherwise(uri)


def landing_label(path) -> Column:
    """Name of the landing entry a data file (plain path) belongs to.

    A landing entry is a plain file ``sales_YYYY_MM.csv`` or a folder of part files
    (``sales_YYYY_MM.csv/part-…`` or, as written by Spark, ``file=sales_…csv/part-…``).
    """
    path = F.col(path) if isinstance(path, str) else path
    own, folder = base_name(path), F.substring_index(F.substring_index(path, "/", -2), "/", 1)
    is_entry = own.startswith("sales_") & own.endswith(".csv")
    return F.when(is_entry, own).otherwise(F.substring_index(folder, "=", -1))
