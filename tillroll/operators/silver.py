"""Bronze -> silver: trim, type, validate, add line revenue."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillroll.functions.parsing import (
    canonical_customer_id,
    parse_exact_price,
    parse_invoice_timestamp,
    parse_price,
    parse_quantity,
    revenue,
    trim_spaces,
)
from tillroll.functions.rules import keep_condition, reject_reason
from tillroll.schemas import INGESTED_AT, RAW_COLUMNS, SILVER_COLUMNS, SILVER_PROCESSED_AT, SOURCE_FILE

# The price text as an exact decimal, only while the revenue is worked out.
EXACT_PRICE = "_exact_price"


def typed(bronze: DataFrame) -> DataFrame:
    """All bronze rows with typed columns and Revenue (nothing dropped yet).

    The parsed columns leave through ``inline`` of a one-element array.  A filter on
    them then stays above that step; over a plain projection the optimiser would
    copy every parse into the filter and run it twice per row.  The revenue leaves in
    the same way: its decimals cost more than all the parsing.
    """
    kept = [c for c in bronze.columns if c not in RAW_COLUMNS]
    parsed = F.struct(
        trim_spaces("InvoiceNo").alias("InvoiceNo"),
        trim_spaces("StockCode").alias("StockCode"),
        trim_spaces("Description").alias("Description"),
        parse_quantity("Quantity").alias("Quantity"),
        F.col("InvoiceDate"),
        parse_invoice_timestamp("InvoiceDate").alias("InvoiceTimestamp"),
        parse_price("UnitPrice").alias("UnitPrice"),
        parse_exact_price("UnitPrice").alias(EXACT_PRICE),
        canonical_customer_id("CustomerID").alias("CustomerID"),
        trim_spaces("Country").alias("Country"),
    )
    rows = bronze.select(*kept, F.inline(F.array(parsed)))
    line = F.struct(revenue("Quantity", "UnitPrice", EXACT_PRICE).alias("Revenue"))
    return rows.select("*", F.inline(F.array(line))).drop(EXACT_PRICE)


def with_reject_reason(bronze: DataFrame) -> DataFrame:
    """Typed rows plus ``reject_reason`` (NULL when the row is kept)."""
    return typed(bronze).withColumn("reject_reason", reject_reason())


def published(rows: DataFrame) -> DataFrame:
    """Typed, kept rows in the published column order.

    Audit columns that a caller did not provide are filled in: ``_ingested_at_utc``
    stays NULL, ``_silver_processed_at_utc`` is the query start time.
    """
    extra = {SILVER_PROCESSED_AT: F.current_timestamp()}
    for name, kind in ((INGESTED_AT, "timestamp"), (SOURCE_FILE, "string")):
        if name not in rows.columns:
            extra[name] = F.lit(None).cast(kind)
    return rows.withColumns(extra).select(*SILVER_COLUMNS)


def clean(bronze: DataFrame) -> DataFrame:
    """Silver rows.  Duplicate lines are kept (the source has no row key)."""
    # NULL checks on the raw text are implied by the rules (trim keeps NULL
    # as NULL) and, unlike checks on parsed values, reach the Parquet scan.
    raw_not_null = F.col("InvoiceNo").isNotNull() & F.col("StockCode").isNotNull() & F.col(
        "InvoiceDate"
    ).isNotNull()
    return published(typed(bronze.where(raw_not_null)).filter(keep_condition()))
