"""Text columns: category and merchant names."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from spendlake.schemas import UNKNOWN_CATEGORY


def clean_category(column: Column) -> Column:
    """Upper case without outer spaces; only a missing name is ``UNKNOWN``, a blank one stays blank."""
    return F.coalesce(F.upper(F.trim(column)), F.lit(UNKNOWN_CATEGORY))


def clean_merchant(column: Column) -> Column:
    """Upper case without any outer whitespace, tabs and line ends included."""
    return F.upper(F.regexp_replace(column, r"(?U)^\s+|\s+$", ""))
