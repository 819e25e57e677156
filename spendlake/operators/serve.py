"""Serving tables: what the lookups of one client return, built for every client at once."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from spendlake.functions import (
    cents,
    cents_from_exact,
    display_amount,
    from_exact,
    normalize_month,
)
from spendlake.operators.allocate import allocate
from spendlake.operators.monthly import (
    LAGS,
    SERIES_COLUMNS,
    smoothed_spend,
    total_columns,
)
from spendlake.operators.profile import user_features_from_totals
from spendlake.schemas import ASSETS, Asset

REQUEST_COLUMNS = (
    "client_id",
    "monthly_income",
    "risk_score",
    "investment_horizon",
    "current_month_spend",
    "spend_1_month_ago",
    "spend_2_months_ago",
)


def client_ids(series: DataFrame) -> DataFrame:
    return series.select("client_id").distinct()


def table_counts(series: DataFrame, profiles: DataFrame) -> DataFrame:
    """One row: distinct clients and rows of the series, and rows of the profiles.

    Clients are counted as groups, not by one distinct count, so no task sees all of them.
    """
    per_client = series.groupBy("client_id").agg(F.count(F.lit(1)).alias("months"))
    sizes = per_client.agg(
        F.count("client_id").alias("clients"),
        F.coalesce(F.sum("months"), F.lit(0)).alias("series_rows"),
        F.lit(0).cast("long").alias("profile_rows"),
    ).union(
        profiles.agg(
            F.lit(0).cast("long"), F.lit(0).cast("long"), F.count(F.lit(1))
        )
    )
    return sizes.agg(*[F.sum(c).alias(c) for c in ("clients", "series_rows", "profile_rows")])


def latest_month(series: DataFrame) -> DataFrame:
    """The most recent month of every client; a row of unreadable month counts as the last.

    Spark prunes each input task to one row per client before the shuffle.
    """
    newest_first = Window.partitionBy("client_id").orderBy(F.col("txn_month").desc_nulls_first())
    return (
        series.withColumn("_age", F.row_number().over(newest_first))
        .filter(F.col("_age") == 1)
        .drop("_age")
    )


def one_per_key(rows: DataFrame, key: str) -> DataFrame:
    """One row per key: of several the greatest, column by column, whatever order they come in."""
    whole = F.max(F.struct(*[c for c in rows.columns if c != key])).alias("_row")
    return rows.groupBy(key).agg(whole).select(key, "_row.*").select(*rows.columns)


def latest_profile(profiles: DataFrame) -> DataFrame:
    """One profile row per client, keyed by text; falls back to ``id`` where that is the key."""
    if "client_id" not in profiles.columns:
        profiles = profiles.withColumn("client_id", F.col("id"))
    return one_per_key(profiles.withColumn("client_id", F.col("client_id").cast("string")), "client_id")


def client_snapshots(series: DataFrame, profiles: DataFrame) -> DataFrame:
    """Latest spend with income, risk and horizon, for clients found on both sides."""
    spend = latest_month(series).select(
        F.col("client_id").cast("string").alias("client_id"),
        "current_month_spend",
        "spend_1_month_ago",
        "spend_2_months_ago",
    )
    facts = latest_profile(profiles).select(
        "client_id",
        "monthly_income",
        F.col("risk_tolerance_score").alias("risk_score"),
        "investment_horizon",
    )
    return spend.join(facts, "client_id").select(*REQUEST_COLUMNS)


def series_as_of(asks: DataFrame, series: DataFrame) -> DataFrame:
    """For each ``(client_id, as_of_month)`` the last row of the series up to that month, nulls without one.

    An as-of join without a range join: the months asked for are merged into the client's months and
    look back from there. Repeated asks are merged first, so that a client's window holds at most twice
    the calendar however often the client is asked for; the answer is joined back to all of them.
    Unreadable months on either side answer nothing.
    """
    values = [c for c in series.columns if c != "client_id"]
    dated = series.withColumn("_month", normalize_month(F.col("txn_month"))).filter(F.col("_month").isNotNull())
    wanted = asks.select(
        F.col("client_id").cast("string").alias("_client"), normalize_month(F.col("as_of_month")).alias("_month")
    )
    known = dated.select(
        F.col("client_id").cast("string").alias("_client"), "_month", F.lit(0).alias("_ask"), F.struct(*values).alias("_row")
    )
    merged = known.unionByName(wanted.distinct().withColumn("_ask", F.lit(1)), allowMissingColumns=True)
    past = Window.partitionBy("_client").orderBy("_month", "_ask").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    answers = (
        merged.withColumn("_row", F.last("_row", ignorenulls=True).over(past))
        .filter((F.col("_ask") == 1) & F.col("_month").isNotNull()).select("_client", "_month", "_row")
    )
    keyed = asks.withColumns(
        {"_client": F.col("client_id").cast("string"), "_month": normalize_month(F.col("as_of_month"))}
    )
    return keyed.join(answers, ["_client", "_month"], "left").select(*asks.columns, "_row.*")


def client_snapshots_as_of(asks: DataFrame, series: DataFrame, profiles: DataFrame) -> DataFrame:
    """:func:`client_snapshots` as they stood at a month asked for; clients found on both sides only."""
    spend = series_as_of(asks.select("client_id", "as_of_month"), series).filter(F.col("txn_month").isNotNull())
    facts = latest_profile(profiles).select(
        "client_id", "monthly_income", F.col("risk_tolerance_score").alias("risk_score"), "investment_horizon"
    )
    spend = spend.withColumn("client_id", F.col("client_id").cast("string"))
    return spend.join(facts, "client_id").select("as_of_month", "txn_month", *REQUEST_COLUMNS)


def client_snapshot(series: DataFrame, profiles: DataFrame, client_id: str) -> DataFrame:
    """The snapshot of one client, or no row where either table lacks the client.

    Both tables are filtered first, so the lookup reads only matching row groups.
    """
    key = F.lit(str(client_id))
    profile_key = "client_id" if "client_id" in profiles.columns else "id"
    return client_snapshots(
        series.filter(F.col("client_id").cast("string") == key),
        profiles.filter(F.col(profile_key).cast("string") == key),
    )


def clients_without_profile(series: DataFrame, profiles: DataFrame) -> DataFrame:
    """Clients with a spend history that have no profile."""
    return client_ids(series).join(
        latest_profile(profiles).select("client_id"), "client_id", "left_anti"
    )


def clients_without_history(series: DataFrame, profiles: DataFrame) -> DataFrame:
    """Clients with a profile that have no spend history."""
    return latest_profile(profiles).select("client_id").join(
        client_ids(series), "client_id", "left_anti"
    )


def client_histories(series: DataFrame) -> DataFrame:
    """All months of all clients, months normalized and unreadable ones dropped.

    Columns an older series lacks come out as null.
    """
    lacking = [c for c in SERIES_COLUMNS if c not in series.columns]
    series = series.withColumns({c: F.lit(None).cast("double") for c in lacking})
    return (
        series.withColumn("client_id", F.col("client_id").cast("string"))
        .withColumn("txn_month", normalize_month(F.col("txn_month")))
        .filter(F.col("txn_month").isNotNull())
        .select(*SERIES_COLUMNS)
    )


def client_history(series: DataFrame, client_id: str) -> DataFrame:
    """The months of one client in order. The filter reaches the scan of a stored series."""
    rows = series.filter(F.col("client_id").cast("string") == F.lit(str(client_id)))
    return client_histories(rows).orderBy("txn_month")


def spend_trend(series: DataFrame) -> DataFrame:
    """The smoothed spend of every client over its readable months, for charts."""
    return smoothed_spend(client_histories(series)).select(
        "client_id", "txn_month", "smoothed_target_spend"
    )


def ordered_histories(series: DataFrame) -> DataFrame:
    """The series ordered by client and month, for output."""
    return series.orderBy("client_id", "txn_month")


def snapshots_from_months(users: DataFrame, months: DataFrame) -> DataFrame:
    """All user features plus the latest spend, from one pass over the monthly roll-up.

    The window leaves its rows hashed and sorted by client, and the totals and the latest month
    are grouped by the same key, so beyond the window's own shuffle only the users move. Repeated
    users and unreadable months are settled as in :func:`latest_profile` and :func:`latest_month`.
    """
    series = Window.partitionBy("client_id").orderBy("month_start")
    lags = {
        name: cents_from_exact(F.lag("spend", n).over(series))
        for n, name in enumerate(LAGS[:2], start=1)
    }
    latest = ("current_month_spend", *lags)
    age = F.struct(F.col("month_start").isNull(), "month_start")
    totals = (
        months.withColumn("current_month_spend", from_exact(F.col("spend")))
        .withColumns(lags)
        .groupBy("client_id")
        .agg(
            *total_columns(months),
            *[F.max_by(F.struct(c), age).alias(c) for c in latest],
        )
        .withColumns({c: F.col(f"{c}.{c}") for c in latest})
    )
    return user_features_from_totals(one_per_key(users, "id"), totals, keep=latest)


def rolling_mean_forecast(requests: DataFrame) -> DataFrame:
    """Adds ``prediction``: the mean of the known last three months, the smoothed spend itself."""
    known = F.array_compact(
        F.array("current_month_spend", "spend_1_month_ago", "spend_2_months_ago")
    )
    total = F.aggregate(known, F.lit(0.0), lambda acc, x: acc + x)
    return requests.withColumn("prediction", cents(F.try_divide(total, F.size(known))))


def advisor_plan(
    requests: DataFrame,
    forecast: Callable[[DataFrame], DataFrame] = rolling_mean_forecast,
    assets: tuple[Asset, ...] = ASSETS,
) -> DataFrame:
    """Forecast the spend, take it off the income and allocate the rest, for every request.

    ``forecast`` adds a ``prediction`` column: a fitted model's scorer, or the rolling mean.
    """
    budgeted = forecast(requests).withColumn(
        "_budget", F.col("monthly_income") - F.col("prediction")
    )
    planned = allocate(budgeted, "_budget", "risk_score", "investment_horizon", assets)
    return planned.select(
        "client_id",
        "monthly_income",
        cents(F.col("prediction")).alias("predicted_expense"),
        cents(F.col("_budget")).alias("safe_investable_budget"),
        "status",
        *[a.name for a in assets],
    )


def advisor_response(plan: DataFrame, assets: tuple[Asset, ...] = ASSETS) -> DataFrame:
    """The plan in its nested form: forecast and recommended action per client."""
    return plan.select(
        "client_id",
        F.struct("monthly_income", "predicted_expense", "safe_investable_budget").alias(
            "financial_forecast"
        ),
        F.struct("status", *[a.name for a in assets]).alias("recommended_action"),
    )


def display_plan(plan: DataFrame) -> DataFrame:
    """The plan's headline figures as dollar text."""
    return plan.select(
        "client_id",
        *[
            display_amount(F.col(c)).alias(c)
            for c in ("monthly_income", "predicted_expense", "safe_investable_budget")
        ],
    )
