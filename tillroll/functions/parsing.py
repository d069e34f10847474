"""Typing of raw text columns.

Every parser returns NULL for text it cannot read instead of raising, whatever
``spark.sql.ansi.enabled`` says: the ``try_`` forms are used throughout, so a
malformed value becomes a rejected row, never a failed job.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tillroll.schemas import EXACT_PRICE_TYPE, PRICE_TYPE, REVENUE_TYPE, TIMESTAMP_LAYOUTS


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def trim_spaces(c) -> Column:
    """Strip leading and trailing spaces (only spaces; tabs are kept)."""
    return F.trim(_col(c))


def parse_quantity(c) -> Column:
    """Whole-number text to INT; decimals, words and overflow become NULL."""
    return _col(c).try_cast("int")


def parse_price(c) -> Column:
    """Price text to a double; thousands separators, words -> NULL."""
    return _col(c).try_cast(PRICE_TYPE)


def parse_exact_price(c) -> Column:
    """Price text to an exact decimal, its digits beyond the 18th after the point rounded.

    NULL for text that is no number and for prices of 10^20 and more.
    """
    return _col(c).try_cast(EXACT_PRICE_TYPE)


def canonical_customer_id(c) -> Column:
    """'17850.0' -> '17850': read as a number, drop the fraction, back to text."""
    return _col(c).try_cast("double").try_cast("bigint").cast("string")


def _could_match(c: Column, fmt: str) -> Column:
    """Cheap necessary condition for ``fmt`` to parse ``c``.

    A pattern parse that fails costs an exception inside Spark; skipping text
    that cannot match keeps the common path exception-free.  The test only
    rules out text the layout can never accept, so results do not change:
    a layout with '/' needs a '/', a layout without one cannot accept one,
    and every layout here starts with a digit.
    """
    starts_with_digit = (c >= "0") & (c < ":")  # ':' follows '9'; a regular expression costs more
    if "/" in fmt:
        return starts_with_digit & c.contains("/")
    return starts_with_digit & ~c.contains("/")


def parse_invoice_timestamp(c) -> Column:
    """First layout of ``TIMESTAMP_LAYOUTS`` that parses, else NULL."""
    c = _col(c)
    attempts = [
        F.try_to_timestamp(c)
        if fmt is None
        else F.when(_could_match(c, fmt), F.try_to_timestamp(c, F.lit(fmt)))
        for fmt in TIMESTAMP_LAYOUTS
    ]
    return F.coalesce(*attempts)


def revenue(quantity, unit_price, exact_price) -> Column:
    """Line revenue, rounded half-up to cents before any aggregation.

    The whole part of the exact price is multiplied without rounding, the rest is
    rounded after it: the sum is the exact product to the cent.  A price too great to
    be exact is multiplied as a double, as far from its cents as it is.  NULL if the
    revenue has more digits than REVENUE_TYPE: a line to reject, not an error.

    A price of whole cents below 10^10, the common case, needs one product of numbers
    of few digits; the general way costs ten times as much and gives the same there.
    """
    quantity, price, exact = _col(quantity), _col(unit_price), _col(exact_price)
    rest = exact % F.lit(1).cast("decimal(1,0)")
    whole = (exact - rest).cast("decimal(20,0)")
    precise = (quantity * whole + F.round(quantity * rest, 2)).try_cast(REVENUE_TYPE)
    cents = exact.try_cast("decimal(12,2)")
    return (
        F.when(exact.try_cast("decimal(28,18)") == cents, (quantity * cents).try_cast(REVENUE_TYPE))
        .when(exact.isNull(), F.round(quantity * price, 2).try_cast(REVENUE_TYPE))
        .otherwise(precise)
    )


def week_start(ts) -> Column:
    """Monday (00:00, session time zone = UTC) of the week, as DATE."""
    return F.to_date(F.date_trunc("week", _col(ts)))
