"""Sales lines derived from the supplied order tables.

The reference reads a retail data set that is not shipped, so test input is
built from ``lineitem ⋈ orders ⋈ customer ⋈ nation ⋈ part`` (one sales line per
lineitem row).  The source tables are clean; defects are injected by fixed
rules on keys so that every silver rule is exercised.  The DuckDB oracle
applies the same conditions to the base columns (it never parses our text).

All joins are declared and left to the planner: lineitem ⋈ part and
⋈ orders are shuffle joins on their keys at scale (AQE splits skewed keys); the
nation dimension is broadcast only after a size check.  What only depends on the
order is worked out once per order, and the orders are joined last: the lines of an
order then stay together, which every later step compresses better.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tillroll.operators.joins import join_small
from tillroll.schemas import RAW_COLUMNS, SOURCE_FILE
from tillroll.sources.tables import table

# --- fixed values: defect injection rules (keys and moduli) ------------------
NULL_INVOICE_MOD = 211          # l_orderkey % 211 = 0 -> InvoiceNo NULL
PADDED_INVOICE_MOD = 5          # l_orderkey % 5 = 0   -> one space each side
CANCEL_LINE = 1                 # returnflag R, line 1 -> 'C' prefix
NULL_STOCK_SUPPKEY = 3          # l_suppkey = 3        -> StockCode NULL
NON_PRODUCT_MOD = 40            # l_partkey % 40 = 0   -> non-product code
NON_PRODUCT_CODES = ("POST", "M", "DOT")  # chosen by l_partkey % 3
NULL_DESCRIPTION_MOD = 17       # l_partkey % 17 = 0   -> Description NULL
BAD_QUANTITY_MOD = 101          # l_orderkey % 101 = 0 -> Quantity 'n/a'
NEGATIVE_QUANTITY_LINE = 7      # returnflag R, line 7 -> negative Quantity
SLASH_DATE_MOD = 3              # l_orderkey % 3 = 0   -> 'M/d/yyyy H:mm'
BAD_DATE_MOD = 103              # l_orderkey % 103 = 0 -> 'unknown'
ZERO_PRICE_MOD = 89             # l_partkey % 89 = 0   -> '0.00'
NULL_CUSTOMER_MOD = 4           # o_custkey % 4 = 0    -> CustomerID NULL
COUNTRY_PADDING = "  "          # appended to every country name
# -----------------------------------------------------------------------------


BAD_DATE_TEXT = "unknown"
# Whether the rules make a line's InvoiceDate unreadable (see ``flag_bad_dates``).
BAD_DATE = "_bad_date"

# Landing file of the order month (same value as naming.month_file_name).
MONTH_FILE_SQL = (
    "concat('sales_', CAST(year(o_orderdate) AS STRING), '_', "
    "lpad(CAST(month(o_orderdate) AS STRING), 2, '0'), '.csv')"
)


def _order_expressions(bad_dates: bool = True) -> list[str]:
    """SQL expressions of the raw columns, and of the landing file, that an order decides."""
    return [
        f"""CASE WHEN {'true' if bad_dates else 'false'} AND o_orderkey % {BAD_DATE_MOD} = 0 THEN '{BAD_DATE_TEXT}'
                 WHEN o_orderkey % {SLASH_DATE_MOD} = 0 THEN date_format(o_orderdate, 'M/d/yyyy H:mm')
                 ELSE date_format(o_orderdate, 'yyyy-MM-dd HH:mm:ss') END AS InvoiceDate""",
        f"""CASE WHEN o_custkey % {NULL_CUSTOMER_MOD} = 0 THEN CAST(NULL AS STRING)
                 ELSE concat(CAST(o_custkey AS STRING), '.0') END AS CustomerID""",
        f"concat(n_name, '{COUNTRY_PADDING}') AS Country",
        f"{MONTH_FILE_SQL} AS {SOURCE_FILE}",
    ]


def _line_expressions() -> list[str]:
    """SQL expressions of the raw columns that a line decides."""
    codes = ", ".join(f"'{c}'" for c in NON_PRODUCT_CODES)
    n_codes = len(NON_PRODUCT_CODES)
    number = "CASE WHEN cancelled THEN concat('C', CAST(l_orderkey AS STRING)) ELSE CAST(l_orderkey AS STRING) END"
    qty = "CAST(l_quantity AS INT)"
    return [
        f"""CASE WHEN l_orderkey % {NULL_INVOICE_MOD} = 0 THEN CAST(NULL AS STRING)
                 WHEN l_orderkey % {PADDED_INVOICE_MOD} = 0 THEN concat(' ', {number}, ' ')
                 ELSE {number} END AS InvoiceNo""",
        f"""CASE WHEN no_stock THEN CAST(NULL AS STRING)
                 WHEN l_partkey % {NON_PRODUCT_MOD} = 0
                   THEN element_at(array({codes}), CAST(l_partkey % {n_codes} AS INT) + 1)
                 ELSE concat('P', CAST(l_partkey AS STRING)) END AS StockCode""",
        f"""CASE WHEN l_partkey % {NULL_DESCRIPTION_MOD} = 0 THEN CAST(NULL AS STRING)
                 ELSE p_name END AS Description""",
        f"""CASE WHEN l_orderkey % {BAD_QUANTITY_MOD} = 0 THEN 'n/a'
                 WHEN returned THEN CAST(-{qty} AS STRING)
                 ELSE CAST({qty} AS STRING) END AS Quantity""",
        f"""CASE WHEN l_partkey % {ZERO_PRICE_MOD} = 0 THEN '0.00'
                 ELSE CAST(CAST(l_extendedprice AS DECIMAL(18,2)) AS STRING) END AS UnitPrice""",
    ]


def sales_lines(spark: SparkSession, sf_dir: str, bad_dates: bool = True, flag_bad_dates: bool = False) -> DataFrame:
    """Raw landing rows: the 8 text columns plus ``_source_file``.

    ``bad_dates=False`` leaves every InvoiceDate readable: the full sales
    history the monthly split starts from (its date gate refuses otherwise).
    ``flag_bad_dates`` adds ``BAD_DATE``: which dates are unreadable otherwise.
    """
    # Every line is shuffled twice: what a rule asks of its columns goes along, not the columns.
    lineitem = table(spark, sf_dir, "lineitem").selectExpr(
        "l_orderkey", "l_partkey", "l_quantity", "l_extendedprice",
        f"l_suppkey = {NULL_STOCK_SUPPKEY} AS no_stock",
        f"l_returnflag = 'R' AND l_linenumber = {CANCEL_LINE} AS cancelled",
        f"l_returnflag = 'R' AND l_linenumber = {NEGATIVE_QUANTITY_LINE} AS returned",
    )
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
    customer = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    nation = table(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    part = table(spark, sf_dir, "part").select("p_partkey", "p_name")

    customer_country = join_small(
        customer, nation, customer.c_nationkey == nation.n_nationkey, memo_key=("nation", sf_dir)
    ).select("c_custkey", "n_name")
    order_info = orders.join(
        customer_country, orders.o_custkey == customer_country.c_custkey
    ).selectExpr("o_orderkey", *_order_expressions(bad_dates))
    lines = lineitem.join(part, lineitem.l_partkey == part.p_partkey).join(
        order_info, lineitem.l_orderkey == order_info.o_orderkey
    )
    flag = [f"coalesce(l_orderkey % {BAD_DATE_MOD} = 0, false) AS {BAD_DATE}"] if flag_bad_dates else []
    of_order = ["InvoiceDate", "CustomerID", "Country", SOURCE_FILE]
    return lines.selectExpr(*_line_expressions(), *of_order, *flag).select(*RAW_COLUMNS, SOURCE_FILE, *([BAD_DATE] if flag else []))
