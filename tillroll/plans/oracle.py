"""Independent DuckDB SQL for every query key (the correctness oracle).

The oracle never parses our text: it recomputes every typed value and every
rejection from the base columns of the supplied tables, applying the same
defect-injection conditions as ``tillroll.sources.fixture``.
"""

from __future__ import annotations

from tillroll.schemas import NON_PRODUCT_STOCK_CODES

_CODES = ", ".join(f"'{c}'" for c in NON_PRODUCT_STOCK_CODES)

_BASE = """
j AS (
  SELECT l.l_orderkey AS ok, l.l_partkey AS pk, l.l_suppkey AS sk, l.l_linenumber AS ln,
         l.l_quantity AS q, l.l_extendedprice AS ep, l.l_returnflag AS rf,
         o.o_custkey AS ck, o.o_orderdate AS od, p.p_name AS pname, n.n_name AS nname
  FROM lineitem l
  JOIN orders o ON l.l_orderkey = o.o_orderkey
  JOIN customer c ON o.o_custkey = c.c_custkey
  JOIN nation n ON c.c_nationkey = n.n_nationkey
  JOIN part p ON l.l_partkey = p.p_partkey
),
raw AS (
  SELECT
    CASE WHEN ok % 211 = 0 THEN NULL
         ELSE (CASE WHEN ok % 5 = 0 THEN ' ' ELSE '' END)
              || (CASE WHEN rf = 'R' AND ln = 1 THEN 'C' ELSE '' END) || CAST(ok AS VARCHAR)
              || (CASE WHEN ok % 5 = 0 THEN ' ' ELSE '' END) END AS InvoiceNo,
    CASE WHEN sk = 3 THEN NULL
         WHEN pk % 40 = 0 THEN (CASE pk % 3 WHEN 0 THEN 'POST' WHEN 1 THEN 'M' ELSE 'DOT' END)
         ELSE 'P' || CAST(pk AS VARCHAR) END AS StockCode,
    CASE WHEN pk % 17 = 0 THEN NULL ELSE pname END AS Description,
    CASE WHEN ok % 101 = 0 THEN 'n/a'
         WHEN rf = 'R' AND ln = 7 THEN CAST(-CAST(q AS INTEGER) AS VARCHAR)
         ELSE CAST(CAST(q AS INTEGER) AS VARCHAR) END AS Quantity,
    CASE WHEN ok % 103 = 0 THEN 'unknown'
         WHEN ok % 3 = 0 THEN strftime(od, '%-m/%-d/%Y %-H:%M')
         ELSE strftime(od, '%Y-%m-%d %H:%M:%S') END AS InvoiceDate,
    CASE WHEN pk % 89 = 0 THEN '0.00' ELSE CAST(CAST(ep AS DECIMAL(18,2)) AS VARCHAR) END AS UnitPrice,
    CASE WHEN ck % 4 = 0 THEN NULL ELSE CAST(ck AS VARCHAR) || '.0' END AS CustomerID,
    nname || '  ' AS Country,
    'sales_' || strftime(od, '%Y_%m') || '.csv' AS _source_file
  FROM j
),
typed AS (
  SELECT
    CASE WHEN ok % 211 = 0 THEN NULL
         WHEN rf = 'R' AND ln = 1 THEN 'C' || CAST(ok AS VARCHAR)
         ELSE CAST(ok AS VARCHAR) END AS InvoiceNo,
    CASE WHEN sk = 3 THEN NULL
         WHEN pk % 40 = 0 THEN (CASE pk % 3 WHEN 0 THEN 'POST' WHEN 1 THEN 'M' ELSE 'DOT' END)
         ELSE 'P' || CAST(pk AS VARCHAR) END AS StockCode,
    CASE WHEN pk % 17 = 0 THEN NULL ELSE trim(pname) END AS Description,
    CASE WHEN ok % 101 = 0 THEN NULL
         WHEN rf = 'R' AND ln = 7 THEN -CAST(q AS INTEGER)
         ELSE CAST(q AS INTEGER) END AS Quantity,
    CASE WHEN ok % 103 = 0 THEN NULL
         WHEN ok % 3 = 0 THEN date_trunc('minute', od)
         ELSE date_trunc('second', od) END AS InvoiceTimestamp,
    CASE WHEN pk % 89 = 0 THEN CAST(0 AS DECIMAL(18,4))
         ELSE CAST(CAST(ep AS DECIMAL(18,2)) AS DECIMAL(18,4)) END AS UnitPrice,
    CASE WHEN ck % 4 = 0 THEN NULL ELSE CAST(ck AS VARCHAR) END AS CustomerID,
    trim(nname) AS Country,
    'sales_' || strftime(od, '%Y_%m') || '.csv' AS _source_file
  FROM j
),
checked AS (
  SELECT *,
    CASE WHEN InvoiceNo IS NULL THEN 'null_invoice'
         WHEN InvoiceNo LIKE 'C%' THEN 'cancelled'
         WHEN StockCode IS NULL THEN 'null_stock_code'
         WHEN Quantity IS NULL OR Quantity <= 0 THEN 'bad_quantity'
         WHEN UnitPrice IS NULL OR UnitPrice <= 0 THEN 'bad_price'
         WHEN InvoiceTimestamp IS NULL THEN 'bad_date' END AS reject_reason
  FROM typed
),
silver AS (
  SELECT InvoiceNo, StockCode, Description, Quantity, InvoiceTimestamp, UnitPrice, CustomerID,
         Country, ROUND(Quantity * UnitPrice, 2) AS Revenue, _source_file
  FROM checked WHERE reject_reason IS NULL
),
weekly AS (
  SELECT CAST(date_trunc('week', InvoiceTimestamp) AS DATE) AS WeekStartDate,
         CAST(ROUND(SUM(Revenue), 2) AS DOUBLE) AS WeeklyRevenue
  FROM silver GROUP BY 1
),
products AS (
  SELECT StockCode, Description, CAST(ROUND(SUM(Revenue), 2) AS DOUBLE) AS TotalRevenue,
         CAST(SUM(Quantity) AS BIGINT) AS TotalQuantitySold
  FROM silver WHERE StockCode NOT IN (__CODES__) GROUP BY 1, 2
),
customers AS (
  SELECT CustomerID, CAST(ROUND(SUM(Revenue), 2) AS DOUBLE) AS TotalRevenue
  FROM silver WHERE CustomerID IS NOT NULL GROUP BY 1
),
countries AS (
  SELECT Country, CAST(ROUND(SUM(Revenue), 2) AS DOUBLE) AS TotalRevenue
  FROM silver GROUP BY 1
),
top_products AS (
  SELECT * FROM products ORDER BY TotalRevenue DESC, StockCode ASC NULLS LAST,
         Description ASC NULLS LAST LIMIT 5
),
top_customers AS (
  SELECT * FROM customers ORDER BY TotalRevenue DESC, CustomerID ASC NULLS LAST LIMIT 5
),
gold_long AS (
  SELECT 'weekly_revenue' AS gold_table, strftime(WeekStartDate, '%Y-%m-%d') AS key1,
         CAST(NULL AS VARCHAR) AS key2, 'WeeklyRevenue' AS metric, WeeklyRevenue AS value FROM weekly
  UNION ALL
  SELECT 'top_products', StockCode, Description, 'TotalRevenue', TotalRevenue FROM top_products
  UNION ALL
  SELECT 'top_products', StockCode, Description, 'TotalQuantitySold',
         CAST(TotalQuantitySold AS DOUBLE) FROM top_products
  UNION ALL
  SELECT 'top_customers', CustomerID, NULL, 'TotalRevenue', TotalRevenue FROM top_customers
  UNION ALL
  SELECT 'revenue_by_country', Country, NULL, 'TotalRevenue', TotalRevenue FROM countries
),
months AS (
  SELECT DISTINCT _source_file FROM raw
)
""".replace("__CODES__", _CODES)

# First arrival of the incremental scenario: files up to this name.
FIRST_BATCH_LAST_FILE = "sales_1997_12.csv"


def _q(body: str) -> str:
    return "WITH " + _BASE.strip() + "\n" + body.strip()


_SILVER_OUT = """
SELECT InvoiceNo, StockCode, Description, Quantity, InvoiceTimestamp,
       CAST(UnitPrice AS DOUBLE) AS UnitPrice, CustomerID, Country,
       CAST(Revenue AS DOUBLE) AS Revenue, _source_file
FROM silver
"""

_RAW_OUT = """
SELECT InvoiceNo, StockCode, Description, Quantity, InvoiceDate, UnitPrice, CustomerID, Country,
       _source_file
FROM raw
"""

_GOLD_COUNTS = """
SELECT 'weekly_rows' AS metric, CAST(count(*) AS BIGINT) AS value FROM weekly
UNION ALL SELECT 'top_products_rows', CAST(least(5, count(*)) AS BIGINT) FROM products
UNION ALL SELECT 'top_customers_rows', CAST(least(5, count(*)) AS BIGINT) FROM customers
UNION ALL SELECT 'country_rows', CAST(count(*) AS BIGINT) FROM countries
"""

ORACLE_SQL = {
    "weekly_revenue": _q("SELECT * FROM weekly"),
    "product_revenue": _q("SELECT * FROM products"),
    "customer_revenue": _q("SELECT * FROM customers"),
    "revenue_by_country": _q("SELECT * FROM countries"),
    "top_products": _q("SELECT * FROM top_products"),
    "top_customers": _q("SELECT * FROM top_customers"),
    "serve_weekly": _q("SELECT * FROM weekly ORDER BY WeekStartDate"),
    "serve_products": _q("SELECT * FROM top_products ORDER BY TotalRevenue DESC"),
    "serve_customers": _q("SELECT * FROM top_customers ORDER BY TotalRevenue DESC"),
    "serve_country": _q("SELECT * FROM countries ORDER BY TotalRevenue DESC"),
    "silver_typed": _q("""
        SELECT InvoiceNo, StockCode, Description, Quantity, InvoiceTimestamp,
               CAST(UnitPrice AS DOUBLE) AS UnitPrice, CustomerID, Country, _source_file
        FROM typed"""),
    "silver_clean": _q(_SILVER_OUT),
    # Whole cents as integers: nothing is rounded but the product.
    "price_extremes": """
        WITH l AS (
            SELECT *, l_linenumber % 4 AS kind, CAST(CAST(l_quantity AS INTEGER) AS HUGEINT) AS q,
                   CAST(l_partkey AS HUGEINT) AS pk, CAST(l_orderkey AS HUGEINT) AS ok FROM lineitem
        ), c AS (
            SELECT *, CASE kind
                WHEN 0 THEN q * pk * 10000000000000 * 100
                WHEN 1 THEN q * (ok * 1000000000000 + 123456789012) * 100
                WHEN 2 THEN (q * 10000000 * pk * 200 + 10000000000000000) // 20000000000000000
                ELSE q * 10000000 * pk * 100 + (q * 10000000 * ok * 200 + 100000000000) // 200000000000 END AS cents
            FROM l
        )
        SELECT l_orderkey || '-' || l_linenumber AS InvoiceNo,
               CAST(CASE WHEN kind < 2 THEN q ELSE q * 10000000 END AS INTEGER) AS Quantity,
               CASE kind
                   WHEN 0 THEN CAST(pk * 10000000000000 AS DOUBLE)
                   WHEN 1 THEN CAST(ok * 1000000000000 + 123456789012 AS DOUBLE)
                   WHEN 2 THEN CAST(pk AS DOUBLE) / 1e16
                   ELSE CAST(pk * 100000000000 + ok AS DOUBLE) / 1e11 END AS UnitPrice,
               (cents // 100) || '.' || lpad(CAST(cents % 100 AS VARCHAR), 2, '0') AS Revenue
        FROM c WHERE q > 0""",
    "parse_timestamps": _q("""
        SELECT InvoiceTimestamp, CAST(count(*) AS BIGINT) AS rows FROM typed GROUP BY 1"""),
    "reject_reasons": _q("""
        SELECT coalesce(reject_reason, 'kept') AS reason, CAST(count(*) AS BIGINT) AS rows
        FROM checked GROUP BY 1"""),
    "stage_counts": _q("""
        SELECT 'raw_rows' AS metric, CAST(count(*) AS BIGINT) AS value FROM checked
        UNION ALL SELECT 'rejected_rows', CAST(count(reject_reason) AS BIGINT) FROM checked
        UNION ALL SELECT 'silver_rows', CAST(count(*) AS BIGINT) FROM silver
        UNION ALL """ + _GOLD_COUNTS),
    "bronze_ingest": _q(_RAW_OUT),
    "path_basename": _q("SELECT _source_file AS source_file, CAST(count(*) AS BIGINT) AS rows FROM raw GROUP BY 1"),
    "landing_files": _q("SELECT _source_file AS source_file FROM months"),
    "new_files": _q(f"SELECT _source_file AS source_file FROM months WHERE _source_file > '{FIRST_BATCH_LAST_FILE}'"),
    "bronze_source_files": _q("SELECT _source_file AS source_file FROM months ORDER BY 1"),
    "incremental_bronze": _q(_RAW_OUT.replace("FROM raw", f"FROM raw WHERE _source_file > '{FIRST_BATCH_LAST_FILE}'")),
    "ledger_state": _q("""
        SELECT 'bronze' AS layer, _source_file AS source_file FROM months
        UNION ALL SELECT 'silver', _source_file FROM months"""),
    "idempotent_reload": _q("""
        SELECT 'bronze' AS layer, _source_file AS source_file, CAST(count(*) AS BIGINT) AS rows
        FROM raw GROUP BY 2
        UNION ALL
        SELECT 'silver', _source_file, CAST(count(*) AS BIGINT) FROM silver GROUP BY 2"""),
    "monthly_split": _q("SELECT _source_file AS source_file, CAST(count(*) AS BIGINT) AS rows FROM raw GROUP BY 1"),
    "archive_months": _q("""
        SELECT DISTINCT CAST(year(InvoiceTimestamp) AS INTEGER) AS year,
               CAST(month(InvoiceTimestamp) AS INTEGER) AS month
        FROM typed WHERE InvoiceTimestamp IS NOT NULL ORDER BY 1, 2"""),
    "date_quality_gate": _q("""
        SELECT CAST(count(*) AS BIGINT) AS rows,
               CAST(count(*) - count(InvoiceTimestamp) AS BIGINT) AS bad_dates FROM typed"""),
    "gold_all": _q("SELECT * FROM gold_long"),
    "run_increment": _q("SELECT * FROM gold_long"),
    "preview": _q("""
        SELECT 'new_files' AS metric, CAST(count(*) AS BIGINT) AS value FROM months
        UNION ALL SELECT 'bronze_rows', CAST(count(*) AS BIGINT) FROM raw
        UNION ALL SELECT 'silver_rows', CAST(count(*) AS BIGINT) FROM silver
        UNION ALL """ + _GOLD_COUNTS),
    "preview_backlog": _q(f"""
        SELECT 'new_files' AS metric, CAST(count(*) AS BIGINT) AS value FROM months
        WHERE _source_file > '{FIRST_BATCH_LAST_FILE}'
        UNION ALL SELECT 'bronze_rows', CAST(count(*) AS BIGINT) FROM raw
        WHERE _source_file > '{FIRST_BATCH_LAST_FILE}'
        UNION ALL SELECT 'silver_rows', CAST(count(*) AS BIGINT) FROM silver
        UNION ALL """ + _GOLD_COUNTS),
    "increment_edge_cases": _q("""
        , kept AS (
            SELECT * FROM silver WHERE _source_file < (
                SELECT min(_source_file) FROM (SELECT _source_file FROM months ORDER BY 1 DESC LIMIT 2)))
        SELECT 'bronze_files' AS metric, CAST(count(*) AS BIGINT) AS value FROM months
        UNION ALL SELECT 'silver_files', CAST(count(*) AS BIGINT) FROM months
        UNION ALL SELECT 'bronze_rows', CAST(count(*) AS BIGINT) FROM raw
        UNION ALL SELECT 'silver_rows', CAST(count(*) AS BIGINT) FROM kept
        UNION ALL SELECT 'weekly_rows', CAST(count(DISTINCT date_trunc('week', InvoiceTimestamp)) AS BIGINT) FROM kept"""),
    "table_counts": _q("""
        SELECT 'bronze_online_retail' AS table_name, CAST(count(*) AS BIGINT) AS rows FROM raw
        UNION ALL SELECT 'silver_online_retail', CAST(count(*) AS BIGINT) FROM silver
        UNION ALL SELECT 'bronze_processed_files', CAST(count(*) AS BIGINT) FROM months
        UNION ALL SELECT 'silver_processed_files', CAST(count(*) AS BIGINT) FROM months
        UNION ALL SELECT 'gold_weekly_revenue', CAST(count(*) AS BIGINT) FROM weekly
        UNION ALL SELECT 'gold_top_5_products_by_revenue', CAST(count(*) AS BIGINT) FROM top_products
        UNION ALL SELECT 'gold_top_5_customers_by_revenue', CAST(count(*) AS BIGINT) FROM top_customers
        UNION ALL SELECT 'gold_revenue_by_country', CAST(count(*) AS BIGINT) FROM countries"""),
    # The first month has lost the lines of even orders.
    "changed_files": _q("""
        SELECT min(_source_file) AS source_file,
               CAST(count(*) - count(*) FILTER (WHERE TRY_CAST(replace(trim(InvoiceNo), 'C', '') AS BIGINT) % 2 = 0) AS BIGINT) AS landing_rows,
               CAST(count(*) AS BIGINT) AS bronze_rows
        FROM raw WHERE _source_file = (SELECT min(_source_file) FROM months)"""),
    "reload_changed": _q("SELECT * FROM gold_long").replace(
        "FROM checked WHERE reject_reason IS NULL",
        "FROM checked WHERE reject_reason IS NULL AND NOT (CAST(InvoiceNo AS BIGINT) % 2 = 0"
        " AND _source_file = (SELECT min(_source_file) FROM raw))",
    ),
    "stream_bronze": _q(_RAW_OUT),
    "stream_silver": _q(_SILVER_OUT),
    "stream_weekly": _q("SELECT * FROM weekly"),
    # Weeks that ended a day before the last line; revision 1 if a seventh of the orders,
    # which came late, changed a week that the others had closed.
    "stream_closed_weeks": _q("""
        , split AS (
            SELECT *, CAST(date_trunc('week', InvoiceTimestamp) AS DATE) AS week, CAST(InvoiceNo AS BIGINT) % 7 = 0 AS late
            FROM silver
        ), seen AS (
            SELECT max(InvoiceTimestamp) AS all_seen, max(InvoiceTimestamp) FILTER (WHERE NOT late) AS first_seen FROM split
        ), w AS (
            SELECT week, sum(Revenue) AS revenue, sum(Revenue) FILTER (WHERE NOT late) AS first_revenue FROM split GROUP BY week
        )
        SELECT week AS WeekStartDate, CAST(round(revenue, 2) AS DOUBLE) AS WeeklyRevenue,
               CAST(CASE WHEN week + INTERVAL 8 DAY <= first_seen AND revenue <> first_revenue THEN 1 ELSE 0 END AS INTEGER) AS revision
        FROM w, seen WHERE week + INTERVAL 8 DAY <= all_seen"""),
}
