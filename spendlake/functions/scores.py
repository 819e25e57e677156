"""Rule-based scores."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Score rules.
BASE_SCORE = 5
MIN_SCORE, MAX_SCORE = 1, 10
LONG_HORIZON, LONG_HORIZON_POINTS = 20, 2
SHORT_HORIZON, SHORT_HORIZON_POINTS = 10, -2
GOOD_CREDIT, GOOD_CREDIT_POINTS = 750, 1
HIGH_UTILIZATION, HIGH_UTILIZATION_POINTS = 0.4, -2
DEBT_WEIGHT = 50


def _points(condition: Column, points: int) -> Column:
    """``points`` where the condition holds; false and null both give 0."""
    return F.when(condition, F.lit(points)).otherwise(F.lit(0))


def risk_tolerance(horizon: Column, credit_score: Column, utilization: Column) -> Column:
    """Risk score from 1 to 10. ``utilization`` is the ratio already rounded to four places."""
    score = (
        F.lit(BASE_SCORE)
        + _points(horizon > LONG_HORIZON, LONG_HORIZON_POINTS)
        + _points(horizon < SHORT_HORIZON, SHORT_HORIZON_POINTS)
        + _points(credit_score > GOOD_CREDIT, GOOD_CREDIT_POINTS)
        + _points(utilization > HIGH_UTILIZATION, HIGH_UTILIZATION_POINTS)
    )
    return F.greatest(F.lit(MIN_SCORE), F.least(F.lit(MAX_SCORE), score))


def credit_risk_budget(credit_score: Column, total_debt: Column, yearly_income: Column) -> Column:
    """Risk points a client's card bundle may cost; null when there is no income to divide by."""
    return credit_score - F.try_divide(total_debt, yearly_income) * F.lit(DEBT_WEIGHT)
