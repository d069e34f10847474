"""Hand-made rows for unit tests (FIXTURES.md §2)."""

from __future__ import annotations

from pyspark.sql import functions as F

from tillroll.schemas import CORRUPT_COLUMN, RAW_COLUMNS, RAW_SCHEMA, SOURCE_FILE

BASE = {
    "InvoiceNo": "536365",
    "StockCode": "85123A",
    "Description": "HOLDER",
    "Quantity": "6",
    "InvoiceDate": "2010-12-01 08:26:00",
    "UnitPrice": "2.55",
    "CustomerID": "17850.0",
    "Country": "United Kingdom",
}


def row(**changes):
    r = dict(BASE)
    r.update(changes)
    return tuple(r[c] for c in RAW_COLUMNS)


def bronze_df(spark, rows, source_file="sales_2010_12.csv"):
    from tillroll.operators.bronze import to_bronze

    df = spark.createDataFrame(rows, RAW_SCHEMA)
    df = df.withColumn(CORRUPT_COLUMN, F.lit(None).cast("string")).withColumn(
        SOURCE_FILE, F.lit(source_file)
    )
    return to_bronze(df)
