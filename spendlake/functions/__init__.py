"""Column expressions shared by the operators. All run inside the JVM."""

from spendlake.functions.dates import month_label, month_start, normalize_month, parse_timestamp
from spendlake.functions.money import (
    cents,
    cents_from_exact,
    display_amount,
    exact,
    from_exact,
    in_bounds,
    is_number,
    parse_money,
)
from spendlake.functions.scores import credit_risk_budget, risk_tolerance
from spendlake.functions.text import clean_category, clean_merchant

__all__ = [
    "cents",
    "cents_from_exact",
    "clean_category",
    "clean_merchant",
    "credit_risk_budget",
    "display_amount",
    "exact",
    "from_exact",
    "in_bounds",
    "is_number",
    "month_label",
    "month_start",
    "normalize_month",
    "parse_money",
    "parse_timestamp",
    "risk_tolerance",
]
