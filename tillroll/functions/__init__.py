"""Column-level building blocks (built-in Spark functions only)."""

from tillroll.functions.parsing import (  # noqa: F401
    canonical_customer_id,
    parse_invoice_timestamp,
    parse_price,
    parse_quantity,
    revenue,
    trim_spaces,
    week_start,
)
from tillroll.functions.naming import base_name, landing_label, month_file_name  # noqa: F401
from tillroll.functions.rules import RULES, keep_condition, reject_reason  # noqa: F401
