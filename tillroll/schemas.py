"""Schemas of every layer and the fixed values the pipeline depends on."""

from __future__ import annotations

from pyspark.sql import types as T

# --- fixed values -----------------------------------------------------------
# Landing / raw columns, in file order.  Columns bind by position; the header
# text of a landing file is ignored.
RAW_COLUMNS = [
    "InvoiceNo",
    "StockCode",
    "Description",
    "Quantity",
    "InvoiceDate",
    "UnitPrice",
    "CustomerID",
    "Country",
]

# Audit columns of bronze and silver.
SOURCE_FILE = "_source_file"
INGESTED_AT = "_ingested_at_utc"
SILVER_PROCESSED_AT = "_silver_processed_at_utc"

# Published gold schemas.
GOLD_DDL = {
    "weekly_revenue": "WeekStartDate DATE, WeeklyRevenue DOUBLE",
    "top_products": "StockCode STRING, Description STRING, TotalRevenue DOUBLE, TotalQuantitySold BIGINT",
    "top_customers": "CustomerID STRING, TotalRevenue DOUBLE",
    "revenue_by_country": "Country STRING, TotalRevenue DOUBLE",
}
# -----------------------------------------------------------------------------

RAW_SCHEMA = T.StructType([T.StructField(c, T.StringType(), True) for c in RAW_COLUMNS])

# CSV reader schema: the raw columns plus a catch-all for malformed lines.
CORRUPT_COLUMN = "_corrupt"
RAW_READ_SCHEMA = T.StructType(
    RAW_SCHEMA.fields + [T.StructField(CORRUPT_COLUMN, T.StringType(), True)]
)

BRONZE_COLUMNS = RAW_COLUMNS + [CORRUPT_COLUMN, INGESTED_AT, SOURCE_FILE]

# Money is exact inside the pipeline and published as DOUBLE in gold.  A price column is
# a DOUBLE; revenue is taken from the price text as a decimal of 20 digits before the
# point and 18 after, and only the product with the quantity is rounded.
PRICE_TYPE = T.DoubleType()
EXACT_PRICE_TYPE = T.DecimalType(38, 18)
REVENUE_TYPE = T.DecimalType(34, 2)

SILVER_COLUMNS = [
    "InvoiceNo",
    "StockCode",
    "Description",
    "Quantity",
    "InvoiceTimestamp",
    "UnitPrice",
    "CustomerID",
    "Country",
    "Revenue",
    SOURCE_FILE,
    INGESTED_AT,
    SILVER_PROCESSED_AT,
]

LEDGER_SCHEMA = T.StructType(
    [
        T.StructField("source_file", T.StringType(), True),
        T.StructField("processed_at", T.TimestampType(), True),
    ]
)

# --- fixed values -----------------------------------------------------------
# Stock codes that are not products (fees, postage, manual adjustments).  They
# stay in silver and in every total except the product ranking.  Exact,
# case-sensitive match.
NON_PRODUCT_STOCK_CODES = (
    "AMAZONFEE",
    "BANK CHARGES",
    "C2",
    "CRUK",
    "D",
    "DCGS0003",
    "DCGS0004",
    "DCGS0055",
    "DCGS0057",
    "DCGS0069",
    "DCGS0070",
    "DCGS0076",
    "DCGSSBOY",
    "DCGSSGIRL",
    "DOT",
    "M",
    "POST",
    "S",
)

# Invoice numbers starting with this letter are cancellations.
CANCELLED_PREFIX = "C"

# InvoiceDate layouts, tried in this order; the first that parses wins.
# None means Spark's default timestamp text form (ISO-8601 variants).
TIMESTAMP_LAYOUTS = (None, "yyyy-MM-dd HH:mm:ss", "M/d/yyyy H:mm")

# Rows kept in each ranking table.
TOP_K = 5
# -----------------------------------------------------------------------------
