"""Money columns: parsing, bounds, exact sums, rounding and display."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from spendlake.schemas import AMOUNT_BOUND, MONEY


def parse_money(column: Column) -> Column:
    """``$-77.00`` -> -77.0; text that is no number becomes null instead of failing the job."""
    return F.replace(column, F.lit("$"), F.lit("")).try_cast("double")


def in_bounds(column: Column, bound: float = AMOUNT_BOUND) -> Column:
    """True strictly between -bound and bound; null and NaN do not pass a filter on it.

    One comparison, so that a filter names the amount once. Spark still repeats the parsing that a
    filter below a projection needs; both are cheap beside reading the row.
    """
    return F.abs(column) < F.lit(float(bound))


def exact(column: Column) -> Column:
    """Money as a decimal of ten places, for sums that must not depend on row order.

    Slower to add than a binary number, but nothing a file holds is rounded away, and a sum that
    outgrows its 28 digits before the point fails instead of wrapping around.
    """
    return column.cast(MONEY)


def from_exact(column: Column) -> Column:
    """Money as double again."""
    return column.cast("double")


def cents_from_exact(column: Column) -> Column:
    """A decimal sum or mean as money rounded half-up to cents."""
    return F.round(column, 2).cast("double")


def cents(column: Column) -> Column:
    """Half-up to two decimals on the decimal value.

    The inner round removes binary noise first, so 12.345 held as 12.344999999999999 still
    gives 12.35.
    """
    return F.round(F.round(column, 8), 2)


def display_amount(column: Column) -> Column:
    """1234.5 -> ``$1,234.50``."""
    return F.concat(F.lit("$"), F.format_number(column, 2))


def is_number(column: Column) -> Column:
    """False for null, NaN and infinities, of any numeric type."""
    return F.coalesce(F.abs(column.cast("double")) < F.lit(float("inf")), F.lit(False))
