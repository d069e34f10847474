"""Silver typing and validation, one case per FIXTURES §2 row, ANSI on and off."""

from __future__ import annotations

import datetime as dt
from decimal import Decimal

import pytest

from helpers import bronze_df, row
from tillroll.operators import silver


def one(spark, **changes):
    out = silver.with_reject_reason(bronze_df(spark, [row(**changes)]))
    return out.select(
        "InvoiceNo", "StockCode", "Quantity", "UnitPrice", "CustomerID", "Country",
        "InvoiceTimestamp", "reject_reason",
    ).first()


def test_good_row(spark, ansi):
    r = one(spark)
    assert r.reject_reason is None
    assert r.CustomerID == "17850"
    assert r.InvoiceTimestamp == dt.datetime(2010, 12, 1, 8, 26)
    clean = silver.clean(bronze_df(spark, [row()])).first()
    assert clean.Revenue == Decimal("15.30")


@pytest.mark.parametrize(
    "text, expected",
    [
        ("12/1/2010 8:26", dt.datetime(2010, 12, 1, 8, 26)),
        ("01/04/2011 08:05", dt.datetime(2011, 1, 4, 8, 5)),
        ("2010-12-01", dt.datetime(2010, 12, 1)),
        ("2010-12-01 08:26:00", dt.datetime(2010, 12, 1, 8, 26)),
    ],
)
def test_date_layouts(spark, ansi, text, expected):
    r = one(spark, InvoiceDate=text)
    assert r.reject_reason is None
    assert r.InvoiceTimestamp == expected


@pytest.mark.parametrize("text", ["unknown", "12/1/2010 8:26:30", "12/1/10 8:26", "13/45/2010 8:26", ""])
def test_bad_dates(spark, ansi, text):
    assert one(spark, InvoiceDate=text).reject_reason == "bad_date"


@pytest.mark.parametrize(
    "invoice, reason",
    [("C536379", "cancelled"), (" C536379 ", "cancelled"), ("c536379", None), ("A563185", None),
     (None, "null_invoice")],
)
def test_cancellations(spark, ansi, invoice, reason):
    assert one(spark, InvoiceNo=invoice).reject_reason == reason


def test_blank_and_tab_padding(spark, ansi):
    assert one(spark, InvoiceNo="   ").InvoiceNo == ""
    assert one(spark, InvoiceNo="   ").reject_reason is None
    r = one(spark, StockCode="\t85123A\t")
    assert r.StockCode == "\t85123A\t"  # only spaces are trimmed


def test_null_stock_code(spark, ansi):
    assert one(spark, StockCode=None).reject_reason == "null_stock_code"


@pytest.mark.parametrize("qty", ["0", "-6", "x", "6.5", "99999999999", None])
def test_bad_quantity(spark, ansi, qty):
    assert one(spark, Quantity=qty).reject_reason == "bad_quantity"


def test_padded_quantity(spark, ansi):
    r = one(spark, Quantity=" 6 ")
    assert r.reject_reason is None and r.Quantity == 6


@pytest.mark.parametrize("price", ["0", "-1", "NaN", "1,234.5", "abc", None])
def test_bad_price(spark, ansi, price):
    assert one(spark, UnitPrice=price).reject_reason == "bad_price"


def test_revenue_rounding(spark, ansi):
    rows = [row(UnitPrice="0.001", Quantity="1"), row(Quantity="3", UnitPrice="0.335")]
    got = [r.Revenue for r in silver.clean(bronze_df(spark, rows)).collect()]
    assert sorted(got) == [Decimal("0.00"), Decimal("1.01")]


@pytest.mark.parametrize("cid, expected", [(None, None), ("17850.9", "17850"), ("abc", None), ("17850", "17850")])
def test_customer_id(spark, ansi, cid, expected):
    r = one(spark, CustomerID=cid)
    assert r.reject_reason is None and r.CustomerID == expected


def test_null_country_kept(spark, ansi):
    r = one(spark, Country=None)
    assert r.reject_reason is None and r.Country is None


def test_duplicates_kept(spark, ansi):
    assert silver.clean(bronze_df(spark, [row(), row()])).count() == 2


def test_first_broken_rule_wins(spark, ansi):
    # Cancelled and bad quantity at once: the earlier rule names the row.
    assert one(spark, InvoiceNo="C1", Quantity="-1").reject_reason == "cancelled"
    assert one(spark, StockCode=None, UnitPrice="0").reject_reason == "null_stock_code"


def test_filter_and_report_agree(spark, ansi):
    rows = [row(), row(Quantity="x"), row(InvoiceNo="C1"), row(InvoiceDate="bad"), row(UnitPrice="0")]
    df = bronze_df(spark, rows)
    kept = silver.clean(df).count()
    flagged = silver.with_reject_reason(df).where("reject_reason IS NULL").count()
    assert kept == flagged == 1
