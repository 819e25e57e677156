"""Monthly spend per client and the series features built on it.

Everything starts from one roll-up, :func:`client_months`: spend per (client, month). Spark sums
within each input task first, so a client holding a third of all transactions reaches the shuffle
as one row per month and task. After it a client has at most one row per calendar month, which
bounds every per-client window below.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from spendlake.functions import (
    cents_from_exact,
    exact,
    from_exact,
    month_label,
    month_start,
)
from spendlake.schemas import DISCRETIONARY_CATEGORIES

LAGS = ("spend_1_month_ago", "spend_2_months_ago", "spend_3_months_ago")
SERIES_COLUMNS = (
    "client_id",
    "txn_month",
    "current_month_spend",
    *LAGS,
    "avg_spend_last_3_months",
)


def expenses(transactions: DataFrame, expense_is_negative: bool = True) -> DataFrame:
    """Expense rows with their magnitude in ``expense_amount``."""
    is_expense = F.col("amount") < 0 if expense_is_negative else F.col("amount") > 0
    return transactions.filter(is_expense).withColumn("expense_amount", F.abs("amount"))


def tag_discretionary(
    expense_rows: DataFrame, categories: tuple[str, ...] = DISCRETIONARY_CATEGORIES
) -> DataFrame:
    """Adds ``is_discretionary``: the expense amount for a discretionary category, else 0."""
    return expense_rows.withColumn(
        "is_discretionary",
        F.when(F.col("category_name").isin(*categories), F.col("expense_amount")).otherwise(
            F.lit(0.0)
        ),
    )


def client_months(
    transactions: DataFrame,
    categories: tuple[str, ...] = DISCRETIONARY_CATEGORIES,
    expense_is_negative: bool = True,
) -> DataFrame:
    """``(client_id, month_start, spend[, discretionary])``, both sums exact decimals.

    ``discretionary`` is there when the input carries ``category_name``.
    """
    rows = expenses(transactions, expense_is_negative)
    sums = [F.sum(exact(F.col("expense_amount"))).alias("spend")]
    if "category_name" in transactions.columns:
        rows = tag_discretionary(rows, categories)
        sums.append(F.sum(exact(F.col("is_discretionary"))).alias("discretionary"))
    is_text = isinstance(transactions.schema["date"].dataType, StringType)
    month = month_start(F.col("date"), text=is_text)
    return rows.groupBy("client_id", month.alias("month_start")).agg(*sums)


def monthly_spend(months: DataFrame) -> DataFrame:
    """``(client_id, txn_month, current_month_spend)`` from :func:`client_months`."""
    return months.select(
        "client_id",
        month_label(F.col("month_start")).alias("txn_month"),
        from_exact(F.col("spend")).alias("current_month_spend"),
    )


def time_series_features(months: DataFrame, min_history: int = 0) -> DataFrame:
    """Spend of the last three active months and their mean, per client and month.

    Lags count rows, so they skip months without spending. All features share one window and so
    one sort. ``min_history`` drops rows with fewer earlier months than that.
    """
    series = Window.partitionBy("client_id").orderBy("month_start")
    spend = F.col("spend")
    features = months.select(
        "client_id",
        month_label(F.col("month_start")).alias("txn_month"),
        from_exact(spend).alias("current_month_spend"),
        *[
            cents_from_exact(F.lag(spend, n).over(series)).alias(name)
            for n, name in enumerate(LAGS, start=1)
        ],
        cents_from_exact(F.avg(spend).over(series.rowsBetween(-3, -1))).alias(
            "avg_spend_last_3_months"
        ),
        *([F.row_number().over(series).alias("_position")] if min_history > 0 else []),
    )
    if min_history > 0:
        features = features.filter(F.col("_position") > min_history).drop("_position")
    return features.filter(F.col("current_month_spend").isNotNull())


def calendar_features(months: DataFrame, absent_is_zero: bool = False) -> DataFrame:
    """The same features by the calendar: spend one, two and three months before, and their mean.

    Unlike :func:`time_series_features`, whose lags count active months, a month without spending is
    a gap here: null, or 0 with ``absent_is_zero``, which also divides the mean by all three months. All
    four are range frames over the number of the month, in one window and so one sort. The row of
    unreadable dates has no place in the calendar and so no features.
    """
    place = (F.year("month_start") * 12 + F.month("month_start")).alias("_place")
    series = Window.partitionBy("client_id").orderBy("_place")
    spend, dated = F.col("spend"), F.col("_place").isNotNull()

    def before(first: int, last: int, value: Column) -> Column:
        return F.when(dated, value.over(series.rangeBetween(-first, -last)))

    features = {name: before(n, n, F.max(spend)) for n, name in enumerate(LAGS, start=1)}
    mean = before(3, 1, F.sum(spend)) / 3 if absent_is_zero else before(3, 1, F.avg(spend))
    features["avg_spend_last_3_months"] = mean

    def filled(value: Column) -> Column:
        return F.when(dated, F.coalesce(value, F.lit(0))) if absent_is_zero else value

    return (
        months.select("client_id", "month_start", "spend", place)
        .select(
            "client_id",
            month_label(F.col("month_start")).alias("txn_month"),
            from_exact(spend).alias("current_month_spend"),
            *[cents_from_exact(filled(value)).alias(name) for name, value in features.items()],
        )
        .filter(F.col("current_month_spend").isNotNull())
    )


def smoothed_spend(series: DataFrame, column: str = "smoothed_target_spend") -> DataFrame:
    """Adds the mean spend of this and the two months before it, rounded to cents."""
    frame = Window.partitionBy("client_id").orderBy("txn_month").rowsBetween(-2, 0)
    mean = F.avg(exact(F.col("current_month_spend"))).over(frame)
    return series.withColumn(column, cents_from_exact(mean))


def client_net_amount(transactions: DataFrame) -> DataFrame:
    """Sum of all amounts, income and expense, per client."""
    return transactions.groupBy("client_id").agg(
        from_exact(F.sum(exact(F.col("amount")))).alias("net_amount")
    )


def client_spend_totals(months: DataFrame) -> DataFrame:
    """Total and discretionary spend and the number of active months per client.

    Counting the roll-up's months replaces a distinct count over the transactions; like one, it
    does not count the row of unreadable dates.
    """
    return months.groupBy("client_id").agg(*total_columns(months))


def total_columns(months: DataFrame) -> list[Column]:
    """The aggregates of :func:`client_spend_totals`.

    Discretionary spend is null for a roll-up made without categories, which spares callers that
    only budget the join with the category dimension.
    """
    if "discretionary" in months.columns:
        discretionary = from_exact(F.sum("discretionary"))
    else:
        discretionary = F.lit(None).cast("double")
    return [
        from_exact(F.sum("spend")).alias("total_expenses"),
        discretionary.alias("discretionary_spending"),
        F.count("month_start").alias("active_months"),
    ]


def category_spend(transactions: DataFrame, top: int | None = 30) -> DataFrame:
    """Summed expenses per category, largest spend (most negative total) first."""
    totals = (
        transactions.filter("amount < 0")
        .groupBy("category_name")
        .agg(from_exact(F.sum(exact(F.col("amount")))).alias("total_spent"))
        .orderBy("total_spent", "category_name")
    )
    return totals if top is None else totals.limit(top)


def top_rows(df: DataFrame, column: str, n: int, tie_break: str) -> DataFrame:
    """The ``n`` largest rows by ``column``; equal values go by ``tie_break``."""
    return df.orderBy(F.col(column).desc(), tie_break).limit(n)
