"""Timestamps and month keys."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

TIMESTAMP_FORMAT = "yyyy-MM-dd HH:mm:ss"
MONTH_FORMAT = "yyyy-MM"


def parse_timestamp(column: Column) -> Column:
    """Strict ``yyyy-MM-dd HH:mm:ss``; anything else is null."""
    return F.try_to_timestamp(column, F.lit(TIMESTAMP_FORMAT))


def month_start(column: Column, text: bool = True) -> Column:
    """First day of the month of a date or timestamp, or of ``text`` Spark can cast to one.

    Grouping by this 4-byte date and formatting after the aggregation is cheaper than formatting
    every row, and sorts the same way as the text key. A typed column needs no time zone here.
    """
    moment = column.try_cast("timestamp") if text else column
    return F.trunc(moment.cast("date"), "MM")


def month_label(column: Column) -> Column:
    """Month key as ``yyyy-MM`` text."""
    return F.date_format(column, MONTH_FORMAT)


def normalize_month(column: Column) -> Column:
    """Month text in any castable form, re-emitted as ``yyyy-MM``; null when it is no date."""
    return month_label(column.try_cast("timestamp"))
