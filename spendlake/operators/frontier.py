"""Allocation over a table of assets of any length.

:mod:`spendlake.operators.allocate` unfolds the few assets of the contract into one expression. Here
assets are rows. Spending a whole budget under an average-risk limit is a linear program with two
binding constraints, so a best mix holds at most two assets, neighbours on the upper hull of the
(risk, return) points that a client's horizon allows. The hulls are folds over sorted arrays, one per
minimum horizon; a client finds theirs by its whole years, and on it the two neighbours of the risk score.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from spendlake.functions import cents, is_number
from spendlake.operators.allocate import INFEASIBLE, MISSING_INPUT, NO_BUDGET, OPTIMAL
from spendlake.operators.enrich import fits_broadcast
from spendlake.session import materialize

#: Rates are compared exactly, with this many places.
RATE = "decimal(12,6)"
#: Points that one group folds at once.
FOLDED = 4096
#: Years beyond these make no difference; assets with a longer minimum horizon are an error.
MOST_YEARS = 1000
_NO_MINIMUM = -1

_POINTS = f"array<struct<risk:{RATE},back:{RATE},annual_return:{RATE},asset:string>>"


def upper_hull(points: Column) -> Column:
    """The points on the upper edge by rising risk, from an array of any order.

    Each of ``points`` is ``(risk, back, annual_return, asset)`` with ``back`` the negated return, so
    that sorting puts the better of two equally risky ones first, then the first by name. A point that
    returns no more than a less risky one is skipped; an earlier point stays only while the edge
    bends down at it. The edge is concave, so those that stay are its beginning.
    """

    def add(edge: Column, point: Column) -> Column:
        def bends(p: Column, i: Column) -> Column:
            after = F.get(edge, i + 1)
            rise = (after["annual_return"] - p["annual_return"]) * (point["risk"] - p["risk"])
            return after.isNotNull() & (rise > (point["annual_return"] - p["annual_return"]) * (after["risk"] - p["risk"]))

        stays = F.slice(edge, F.lit(1), F.size(F.filter(edge, bends)) + 1)
        better = F.coalesce(point["annual_return"] > F.get(edge, F.size(edge) - 1)["annual_return"], F.lit(True))
        return F.when(better, F.concat(stays, F.array(point))).otherwise(edge)

    return F.aggregate(F.sort_array(points), F.expr(f"cast(array() AS {_POINTS})"), add)


def _hulls(points: DataFrame, *keys: str) -> DataFrame:
    """``keys, edge`` of the ``point`` rows of each group."""
    return points.groupBy(*keys).agg(F.collect_list("point").alias("points")).select(
        *keys, upper_hull(F.col("points")).alias("edge")
    )


def efficient_edges(assets: DataFrame) -> DataFrame:
    """``years, edge``: for each whole number of years from none to the last minimum horizon what may be held.

    ``assets`` has ``asset, annual_return, risk, min_horizon``; a null horizon means none. Rows without a
    name, return or risk are not offered. A table of more than :data:`FOLDED` rows is first
    reduced to the hulls of hashed parts of that size, since a hull of hulls is the hull of all.
    """
    known = F.col("asset").isNotNull() & is_number(F.col("annual_return")) & is_number(F.col("risk"))
    risk, returns = F.col("risk").cast(RATE), F.col("annual_return").cast(RATE)
    level = F.coalesce(F.ceil("min_horizon").cast("int"), F.lit(_NO_MINIMUM))
    too_long = F.raise_error(F.lit(f"minimum horizon beyond {MOST_YEARS} years")).cast("int")
    level = F.when(level > MOST_YEARS, too_long).when(level < 0, F.lit(_NO_MINIMUM)).otherwise(level)
    point = F.struct(
        risk.alias("risk"), (-returns).cast(RATE).alias("back"), returns.alias("annual_return"), F.col("asset").alias("asset")
    )
    points = assets.filter(known).select(level.alias("level"), point.alias("point"))
    parts = math.ceil(assets.count() / FOLDED)
    if parts > 1:
        points = points.withColumn("part", F.pmod(F.xxhash64("point"), F.lit(parts)))
        points = _hulls(points, "level", "part").select("level", F.explode("edge").alias("point"))
    # at most MOST_YEARS + 2 rows from here on, so that one task may order them
    by_level = _hulls(points, "level")
    before = Window.orderBy("level").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    later = F.coalesce(F.lead("level").over(Window.orderBy("level")) - 1, F.col("level"))
    known = by_level.select("level", later.alias("last"), F.flatten(F.collect_list("edge").over(before)).alias("points"))
    edges = known.select("level", "last", upper_hull(F.col("points")).alias("edge"))
    return edges.select(F.explode(F.sequence("level", "last")).alias("years"), "edge")


def allocate_from(
    clients: DataFrame,
    assets: DataFrame,
    budget: str = "monthly_disposable_income",
    risk: str = "risk_tolerance_score",
    horizon: str = "investment_horizon",
    small: bool | None = None,
) -> DataFrame:
    """Adds ``status`` and ``holdings``, an array of one or two ``(asset, share, amount, annual_return, risk)``.

    The same problem and statuses as :func:`spendlake.operators.allocate.allocate`: a budget of nothing
    or less holds nothing; where no mix is allowed or an input is missing, ``holdings`` is null. The
    edges are broadcast if a check finds them small; else they are joined by years, and AQE splits
    years that many clients share. Tables without assets make every client infeasible.
    """
    edges = materialize(efficient_edges(assets))
    last = edges.agg(F.max("years")).first()[0]
    whole = F.floor(F.col(horizon).cast("double"))
    years = F.greatest(F.least(whole, F.lit(_NO_MINIMUM if last is None else last)), F.lit(_NO_MINIMUM))
    if fits_broadcast(edges.withColumn("edge", F.to_json("edge"))) if small is None else small:
        edges = F.broadcast(edges)
    edges = edges.withColumnsRenamed({"years": "_years", "edge": "_edge"})
    complete = is_number(F.col(budget)) & is_number(F.col(risk)) & is_number(F.col(horizon))
    joined = clients.withColumn("_years", F.when(complete, years.cast("int"))).join(edges, "_years", "left")
    limit = F.col(risk).cast("double")
    below = F.filter("_edge", lambda p: p["risk"].cast("double") <= limit)
    low, high = F.get("_edge", F.size(below) - 1), F.get("_edge", F.size(below))
    joined = joined.withColumns({"_low": F.when(F.size(below) > 0, low), "_high": F.when(F.size(below) > 0, high)})
    status = (
        F.when(is_number(F.col(budget)) & (F.col(budget) <= 0), NO_BUDGET)
        .when(~complete, MISSING_INPUT)
        .when(F.col("_low").isNull(), INFEASIBLE)
        .otherwise(OPTIMAL)
    )
    low_risk, high_risk = F.col("_low.risk").cast("double"), F.col("_high.risk").cast("double")
    share = F.coalesce((limit - low_risk) / (high_risk - low_risk), F.lit(0.0))

    def holding(side: str, part: Column) -> Column:
        return F.struct(
            F.col(f"{side}.asset").alias("asset"),
            part.alias("share"),
            cents(F.col(budget) * part).alias("amount"),
            F.col(f"{side}.annual_return").cast("double").alias("annual_return"),
            F.col(f"{side}.risk").cast("double").alias("risk"),
        )

    both = F.array(holding("_low", 1 - share), holding("_high", share))
    held = F.filter(both, lambda h: h["share"] > 0)
    holdings = F.when(F.col("status") == OPTIMAL, held).when(F.col("status") == NO_BUDGET, F.slice(held, 1, 0))
    return joined.withColumn("status", status).withColumn("holdings", holdings).drop("_years", "_edge", "_low", "_high")


def holding_rows(allocated: DataFrame, key: str = "client_id") -> DataFrame:
    """Long form ``(key, status, asset, amount)``; a client without holdings has one row without asset."""
    return allocated.select(key, "status", F.explode_outer("holdings").alias("h")).select(
        key, "status", F.col("h.asset").alias("asset"), F.col("h.amount").alias("amount")
    )


def add_expected(allocated: DataFrame) -> DataFrame:
    """Expected yearly return and risk of the holdings, as amounts weighted by rate; null without holdings."""

    def weighted(rate: str) -> Column:
        terms = F.transform("holdings", lambda h: h["amount"].cast("decimal(18,2)") * h[rate].cast(RATE))
        total = F.aggregate(terms, F.lit(0).cast("decimal(38,8)"), lambda a, x: (a + x).cast("decimal(38,8)"))
        return F.round(total, 2).cast("double")

    return allocated.withColumns(
        {"expected_annual_return": weighted("annual_return"), "expected_annual_risk": weighted("risk")}
    )
