"""Distinct counts that merge: sketches stored by month and united for any span of months.

An exact distinct count over years has to see every transaction again. A sketch of a month is a few
kilobytes whatever the month holds; spans of months are counted from sketches alone.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from spendlake.functions import month_start

#: Sketches have ``2 ** LG_K`` registers.
LG_K = 12


def relative_error(lg_k: int = LG_K, deviations: float = 3.0) -> float:
    """Bound of the relative error, at three standard deviations unless asked otherwise."""
    return deviations * 1.04 / math.sqrt(2**lg_k)


def monthly_sketches(transactions: DataFrame, *columns: str, lg_k: int = LG_K) -> DataFrame:
    """``month_start``, the number of ``rows``, and a sketch of each column's distinct values per month.

    Nulls are not counted, as in a distinct count. Spark sketches within each input task first, so a
    hot month reaches the shuffle as one row per task.
    """
    is_text = dict(transactions.dtypes)["date"] == "string"
    month = month_start(F.col("date"), text=is_text)
    sketches = [F.hll_sketch_agg(F.col(c).cast("string"), lg_k).alias(f"{c}_sketch") for c in columns]
    return transactions.groupBy(month.alias("month_start")).agg(F.count(F.lit(1)).alias("rows"), *sketches)


def united(sketches: DataFrame, span: Column, *columns: str) -> DataFrame:
    """The sketches of each span of months as one, with the estimated ``distinct_<column>``."""
    merged = sketches.groupBy(span).agg(
        F.sum("rows").alias("rows"), *[F.hll_union_agg(f"{c}_sketch").alias(f"{c}_sketch") for c in columns]
    )
    return merged.withColumns({f"distinct_{c}": F.hll_sketch_estimate(f"{c}_sketch") for c in columns})


def within_error(estimate: Column, exact: Column, lg_k: int = LG_K) -> Column:
    """Whether an estimate lies within the stated bound of the exact count, one being always allowed."""
    return F.abs(estimate - exact) <= F.greatest(exact * relative_error(lg_k), F.lit(1.0))
