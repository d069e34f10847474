"""Serving queries over the gold tables (what a dashboard runs).

Stored row order is not a contract, so every serving query sorts again, with the
table's keys after the ranked column.  Tables are bound as DataFrame parameters of
``spark.sql``; no global view is registered.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tillroll.operators.gold import GRAINS, TABLES
from tillroll.schemas import GOLD_DDL

# Published table name of each gold table.
GOLD_TABLE_NAMES = {
    "weekly_revenue": "gold_weekly_revenue",
    "top_products": "gold_top_5_products_by_revenue",
    "top_customers": "gold_top_5_customers_by_revenue",
    "revenue_by_country": "gold_revenue_by_country",
}


def _serving_sql(key: str) -> str:
    columns = [c.split()[0] for c in GOLD_DDL[key].split(", ")]
    keys = ", ".join(f"{k} NULLS LAST" for k in GRAINS[TABLES[key][0]])
    order = keys if key == "weekly_revenue" else f"TotalRevenue DESC, {keys}"
    return f"SELECT {', '.join(columns)} FROM {{{GOLD_TABLE_NAMES[key]}}} ORDER BY {order}"


SERVING_SQL = {key: _serving_sql(key) for key in GOLD_DDL}

# The eight tables of a pipeline.
TABLE_NAMES = [
    "bronze_online_retail",
    "silver_online_retail",
    "bronze_processed_files",
    "silver_processed_files",
    *GOLD_TABLE_NAMES.values(),
]

# Row-count checks over every table (the manual checks run after each increment).
TABLE_COUNTS_SQL = " UNION ALL ".join(
    f"SELECT '{name}' AS table_name, COUNT(*) AS rows FROM {{{name}}}" for name in TABLE_NAMES
)


def serve(spark: SparkSession, which: str, gold: dict[str, DataFrame]) -> DataFrame:
    """Run the serving query ``which`` against gold tables given by key."""
    return spark.sql(SERVING_SQL[which], **{GOLD_TABLE_NAMES[which]: gold[which]})


def table_counts(spark: SparkSession, tables: dict[str, DataFrame]) -> DataFrame:
    """``TABLE_COUNTS_SQL`` over DataFrames keyed by published table name."""
    return spark.sql(TABLE_COUNTS_SQL, **tables)
