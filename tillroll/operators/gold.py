"""Silver -> gold: revenue by week, product, customer and country.

All tables come from one aggregation, ``totals``: exact decimal sums at the
grains asked for.  One grain is a plain group-by, several are one GROUPING SETS
pass (Expand, map-side partial aggregate, one shuffle), so a hot key (one country
holding a third of the rows) is combined inside each task before the shuffle.
Money is published as DOUBLE rounded to cents.  Rankings use
``orderBy(...).limit(k)``, planned as ``TakeOrderedAndProject``: every task keeps
its own k best rows, no global sort.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillroll.functions.parsing import week_start
from tillroll.schemas import NON_PRODUCT_STOCK_CODES, TOP_K

# Grain -> its key columns.
GRAINS = {
    "weekly": ["WeekStartDate"],
    "product": ["StockCode", "Description"],
    "customer": ["CustomerID"],
    "country": ["Country"],
}
GRAIN_KEYS = [k for keys in GRAINS.values() for k in keys]

# Published table -> (grain, ranked).
TABLES = {
    "weekly_revenue": ("weekly", False),
    "top_products": ("product", True),
    "top_customers": ("customer", True),
    "revenue_by_country": ("country", False),
}


def by_grain(rows: DataFrame, measures: dict[str, Column], grains=tuple(GRAINS), per: tuple[str, ...] = (), whole: bool = False) -> DataFrame:
    """``measures`` of ``rows`` at each grain: ``grain``, GRAIN_KEYS, ``per``, measures.

    Keys of other grains are NULL.  ``per`` adds columns to every grain (e.g. the
    source file); ``whole`` adds a grain ``rows`` over everything.
    """
    base = rows.withColumn("WeekStartDate", week_start("InvoiceTimestamp"))
    sets = {g: GRAINS[g] for g in grains} | ({"rows": []} if whole else {})
    if len(sets) == 1:
        (name, own), = sets.items()
        out = base.groupBy(*own, *per).agg(*[m.alias(k) for k, m in measures.items()]).withColumn("grain", F.lit(name))
        types = {f.name: f.dataType for f in base.schema.fields}
        out = out.withColumns({k: F.lit(None).cast(types[k]) for k in GRAIN_KEYS if k not in own})
    else:
        keys = [*GRAIN_KEYS, *per]
        out = base.groupingSets([[*own, *per] for own in sets.values()], *keys).agg(
            *[m.alias(k) for k, m in measures.items()], F.grouping_id(*keys).alias("gid")
        )
        # Bit i of grouping_id, from the left, is 1 if key i is not in the set.
        mask = {g: sum(1 << (len(keys) - 1 - i) for i, k in enumerate(keys) if k not in (*own, *per)) for g, own in sets.items()}
        grain = reduce(lambda c, g: c.when(F.col("gid") == mask[g], g), sets, F)
        out = out.withColumn("grain", grain)
    return out.select("grain", *GRAIN_KEYS, *per, *measures)


def totals(silver: DataFrame, grains=tuple(GRAINS), per: tuple[str, ...] = ()) -> DataFrame:
    """Revenue and quantity at the gold grains, in one pass over silver."""
    return by_grain(silver, {"revenue": F.sum("Revenue"), "quantity": F.sum("Quantity")}, grains, per)


def merge_totals(partials: DataFrame) -> DataFrame:
    """Add up partial ``totals`` (e.g. one per source file) to whole totals.

    Exact: the sums are decimals and integers, so adding partial sums gives
    the same result as summing the rows once.  NULL keys group together, as
    in the single pass.
    """
    return partials.groupBy("grain", *GRAIN_KEYS).agg(
        F.sum("revenue").alias("revenue"), F.sum("quantity").alias("quantity")
    )


def is_listed(grain: str, non_products=NON_PRODUCT_STOCK_CODES) -> Column:
    """Which keys of a grain its tables list: no fees among products, no unknown customer."""
    if grain == "product":
        return F.coalesce(~F.col("StockCode").isin(list(non_products)), F.lit(False))
    return F.col("CustomerID").isNotNull() if grain == "customer" else F.lit(True)


def full_table(totals_df: DataFrame, grain: str, non_products=NON_PRODUCT_STOCK_CODES) -> DataFrame:
    """Every listed key of a grain with its published totals."""
    money = F.round("revenue", 2).cast("double").alias("WeeklyRevenue" if grain == "weekly" else "TotalRevenue")
    more = [F.col("quantity").cast("bigint").alias("TotalQuantitySold")] if grain == "product" else []
    rows = totals_df.where((F.col("grain") == grain) & is_listed(grain, non_products))
    return rows.select(*GRAINS[grain], money, *more)


def top_k(df: DataFrame, keys: list[str], k: int = TOP_K, by: str = "TotalRevenue") -> DataFrame:
    """k rows with the highest ``by``; ties broken by the keys (NULLs last)."""
    order = [F.desc(by)] + [F.asc_nulls_last(c) for c in keys]
    return df.orderBy(*order).limit(k)


def gold_table(totals_df: DataFrame, name: str, k: int = TOP_K, non_products=NON_PRODUCT_STOCK_CODES) -> DataFrame:
    grain, ranked = TABLES[name]
    rows = full_table(totals_df, grain, non_products)
    return top_k(rows, GRAINS[grain], k) if ranked else rows


def gold_tables(totals_df: DataFrame, k: int = TOP_K, non_products=NON_PRODUCT_STOCK_CODES) -> dict[str, DataFrame]:
    """The four published tables derived from ``totals``."""
    return {name: gold_table(totals_df, name, k, non_products) for name in TABLES}


def _one(silver: DataFrame, grain: str) -> DataFrame:
    return full_table(totals(silver, (grain,)), grain)


def weekly_revenue(silver: DataFrame) -> DataFrame:
    return _one(silver, "weekly")


def product_revenue(silver: DataFrame) -> DataFrame:
    """Every product (one row per StockCode and Description) with its totals."""
    return _one(silver, "product")


def customer_revenue(silver: DataFrame) -> DataFrame:
    """Known customers only; guest sales count everywhere else."""
    return _one(silver, "customer")


def country_revenue(silver: DataFrame) -> DataFrame:
    return _one(silver, "country")


def top_products(silver: DataFrame, k: int = TOP_K) -> DataFrame:
    return gold_table(totals(silver, ("product",)), "top_products", k)


def top_customers(silver: DataFrame, k: int = TOP_K) -> DataFrame:
    return gold_table(totals(silver, ("customer",)), "top_customers", k)


def stage_counts(checked: DataFrame, known_keys: DataFrame | None = None, k: int = TOP_K) -> DataFrame:
    """One row of counts from one pass over ``checked`` (typed rows, ``reject_reason``
    and ``is_new``): rows, new rows, kept rows and the row count of each gold table.

    ``known_keys`` (``grain`` and GRAIN_KEYS) are keys that gold has anyway.
    """
    kept = F.col("reject_reason").isNull()
    here = by_grain(
        checked,
        {"n": F.count(F.lit(1)), "new": F.count_if("is_new"), "kept": F.count_if(kept)},
        whole=True,
    ).where("grain = 'rows' OR kept > 0")
    if known_keys is not None:
        none = {c: F.lit(0).cast("bigint") for c in ("n", "new", "kept")}
        here = here.unionByName(known_keys.select("grain", *GRAIN_KEYS).withColumns(none))
    keys = here.groupBy("grain", *GRAIN_KEYS).agg(*[F.sum(c).alias(c) for c in ("n", "new", "kept")])
    grain = F.col("grain")

    def listed(name: str) -> Column:
        own, ranked = TABLES[name]
        n = F.count_if((grain == own) & is_listed(own))
        return F.least(F.lit(k), n).cast("bigint") if ranked else n

    def of_rows(c: str) -> Column:
        return F.coalesce(F.sum(F.when(grain == "rows", F.col(c))), F.lit(0)).cast("bigint")

    return keys.agg(
        of_rows("n").alias("rows"),
        of_rows("new").alias("new_rows"),
        of_rows("kept").alias("silver_rows"),
        listed("weekly_revenue").alias("weekly_rows"),
        listed("top_products").alias("top_products_rows"),
        listed("top_customers").alias("top_customers_rows"),
        listed("revenue_by_country").alias("country_rows"),
    )


def long_form(tables: dict[str, DataFrame]) -> DataFrame:
    """The published gold tables as one long table (gold_table, key1, key2, metric, value)."""
    parts = []
    for name, (grain, _) in TABLES.items():
        rows, keys = tables[name], GRAINS[grain]
        key = [F.col(k).cast("string") for k in keys] + [F.lit(None).cast("string")]
        for metric in [c for c in rows.columns if c not in keys]:
            parts.append(
                rows.select(
                    F.lit(name).alias("gold_table"),
                    key[0].alias("key1"),
                    key[1].alias("key2"),
                    F.lit(metric).alias("metric"),
                    F.col(metric).cast("double").alias("value"),
                )
            )
    return reduce(DataFrame.unionByName, parts)
