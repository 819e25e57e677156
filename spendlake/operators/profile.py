"""Per-user features joining demographics with spending."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from spendlake.functions import risk_tolerance
from spendlake.operators.monthly import client_spend_totals
from spendlake.schemas import USER_PORTFOLIO_FEATURES


def spend_profiles(totals: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """Average spend per active month, from :func:`client_spend_totals`."""
    return totals.select(
        "client_id",
        *keep,
        F.try_divide("total_expenses", "active_months").alias("avg_monthly_spend"),
        F.try_divide("discretionary_spending", "active_months").alias("avg_monthly_discretionary"),
    )


def add_financial_features(joined: DataFrame) -> DataFrame:
    """Income, horizon, ratios and risk score. Later ratios use the earlier *rounded* ones."""
    return (
        joined.withColumns(
            {
                "monthly_income": F.col("yearly_income") / 12,
                "investment_horizon": F.col("retirement_age") - F.col("current_age"),
                "credit_utilization_ratio": F.round(
                    F.try_divide("total_debt", "yearly_income"), 4
                ),
            }
        )
        .withColumn(
            "monthly_disposable_income",
            F.round(F.col("monthly_income") - F.col("avg_monthly_spend")),
        )
        .withColumns(
            {
                "savings_rate": F.round(
                    F.try_divide("monthly_disposable_income", "monthly_income"), 4
                ),
                "discretionary_spend_ratio": F.round(
                    F.try_divide("avg_monthly_discretionary", "avg_monthly_spend"), 4
                ),
                "risk_tolerance_score": risk_tolerance(
                    F.col("investment_horizon"),
                    F.col("credit_score"),
                    F.col("credit_utilization_ratio"),
                ),
            }
        )
    )


def user_features_from_totals(
    users: DataFrame, totals: DataFrame, keep: Sequence[str] = ()
) -> DataFrame:
    """User features from totals of one row per client, with any further columns to ``keep``."""
    profiles = spend_profiles(totals, keep)
    joined = users.join(profiles, users["id"] == profiles["client_id"], "inner")
    return add_financial_features(joined).select(*USER_PORTFOLIO_FEATURES.fieldNames(), *keep)


def user_portfolio_features(users: DataFrame, months: DataFrame) -> DataFrame:
    """One row per user with at least one expense; both ``id`` and ``client_id`` are kept.

    The totals come out of their aggregation hashed by client, so the join shuffles only users.
    """
    return user_features_from_totals(users, client_spend_totals(months))
