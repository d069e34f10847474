"""Gold aggregates on hand-made rows and invariants on the supplied tables."""

from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from helpers import bronze_df, row
from tillroll.operators import gold, silver
from tillroll.plans.catalog import _silver

SF = "/root/testdata/sf0.001"


def test_week_edges(spark):
    rows = [row(InvoiceDate="2010-12-05 23:59:59"), row(InvoiceDate="2010-12-06 00:00:00")]
    weeks = sorted(r.WeekStartDate for r in gold.weekly_revenue(silver.clean(bronze_df(spark, rows))).collect())
    assert weeks == [dt.date(2010, 11, 29), dt.date(2010, 12, 6)]


def test_non_product_codes_case_sensitive(spark):
    rows = [row(StockCode="POST"), row(StockCode="post"), row()]
    s = silver.clean(bronze_df(spark, rows))
    codes = {r.StockCode for r in gold.product_revenue(s).collect()}
    assert codes == {"post", "85123A"}
    # POST is still in every other total
    assert gold.country_revenue(s).first().TotalRevenue == pytest.approx(3 * 15.30)


def test_one_code_two_descriptions(spark):
    rows = [row(Description="A"), row(Description="B"), row(Description=None)]
    got = gold.product_revenue(silver.clean(bronze_df(spark, rows))).count()
    assert got == 3


def test_guests_left_out_of_customer_ranking_only(spark):
    rows = [row(CustomerID=None), row()]
    s = silver.clean(bronze_df(spark, rows))
    assert gold.customer_revenue(s).count() == 1
    assert gold.country_revenue(s).first().TotalRevenue == pytest.approx(30.60)


def test_top_k_tie_break(spark):
    rows = [row(StockCode=c) for c in ["B", "A", "C", "E", "D", "F"]]
    top = [r.StockCode for r in gold.top_products(silver.clean(bronze_df(spark, rows)), k=3).collect()]
    assert top == ["A", "B", "C"]


def test_one_pass_totals_equal_separate_aggregates(spark):
    s = _silver(spark, SF)
    tables = gold.gold_tables(gold.totals(s))
    pairs = [
        (tables["weekly_revenue"], gold.weekly_revenue(s)),
        (tables["revenue_by_country"], gold.country_revenue(s)),
        (tables["top_products"], gold.top_products(s)),
        (tables["top_customers"], gold.top_customers(s)),
    ]
    for a, b in pairs:
        assert sorted(map(tuple, a.collect())) == sorted(map(tuple, b.collect()))


def test_sum_invariants(spark):
    s = _silver(spark, SF)
    total = s.agg(F.sum("Revenue")).first()[0]
    weekly = gold.weekly_revenue(s).agg(F.sum("WeeklyRevenue")).first()[0]
    country = gold.country_revenue(s).agg(F.sum("TotalRevenue")).first()[0]
    assert weekly == pytest.approx(float(total)) and country == pytest.approx(float(total))


def test_top_k_is_prefix_of_full_ranking(spark):
    s = _silver(spark, SF)
    full = gold.product_revenue(s).orderBy(F.desc("TotalRevenue"), "StockCode", "Description").limit(5)
    assert [tuple(r) for r in gold.top_products(s).collect()] == [tuple(r) for r in full.collect()]


def test_row_order_does_not_change_gold(spark):
    s = _silver(spark, SF)
    shuffled = s.orderBy(F.xxhash64("InvoiceNo", "StockCode", "Quantity"))
    a = sorted(map(tuple, gold.weekly_revenue(s).collect()))
    b = sorted(map(tuple, gold.weekly_revenue(shuffled.repartition(3)).collect()))
    assert a == b
