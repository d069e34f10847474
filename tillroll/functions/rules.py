"""Silver validity rules, named once and used by both the filter and the
reject report, so the two can never disagree."""

from __future__ import annotations

import sys
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from tillroll.schemas import CANCELLED_PREFIX


# Reasons, in check order (the first broken rule names a rejected row).
RULES = ("null_invoice", "cancelled", "null_stock_code", "bad_quantity", "bad_price", "bad_date", "bad_revenue")


def _rules() -> list[tuple[str, Column]]:
    # (reason when violated, condition a valid row satisfies), in RULES order.
    conds = [
        F.col("InvoiceNo").isNotNull(),
        ~F.col("InvoiceNo").startswith(CANCELLED_PREFIX),
        F.col("StockCode").isNotNull(),
        F.col("Quantity") > 0,
        # Above all numbers there are only infinity and NaN.
        (F.col("UnitPrice") > 0) & (F.col("UnitPrice") <= sys.float_info.max),
        F.col("InvoiceTimestamp").isNotNull(),
        F.col("Revenue").isNotNull(),
    ]
    return list(zip(RULES, conds))


def keep_condition() -> Column:
    """Conjunction of all rules (a NULL outcome drops the row, as in a filter)."""
    return reduce(lambda a, b: a & b, [cond for _, cond in _rules()])


def reject_reason() -> Column:
    """Name of the first rule a row breaks; NULL for a kept row."""
    expr = None
    for name, cond in _rules():
        broken = ~F.coalesce(cond, F.lit(False))
        expr = F.when(broken, F.lit(name)) if expr is None else expr.when(broken, F.lit(name))
    return expr
