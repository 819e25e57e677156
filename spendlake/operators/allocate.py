"""Portfolio allocation and card assortment as plain projections.

Both problems ask, for every client, for the best of a few candidates that are the same for all
clients. The candidates are worked out once from the dimension, and each client's choice is one
``CASE`` expression over them: no join, no shuffle, no solver, one pass over the clients.
"""

from __future__ import annotations

from collections.abc import Sequence
from decimal import Decimal
from itertools import combinations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from spendlake.functions import cents, credit_risk_budget, is_number
from spendlake.schemas import (
    ASSETS,
    CARD_PRODUCTS,
    EXCLUSIVE_CARDS,
    MAX_CARDS,
    Asset,
    CardProduct,
)
from spendlake.sources.literals import asset_table

OPTIMAL = "OPTIMAL"
NO_BUDGET = "NO_BUDGET"
INFEASIBLE = "INFEASIBLE"
MISSING_INPUT = "MISSING_INPUT"


def efficient_assets(assets: Sequence[Asset]) -> list[Asset]:
    """The assets on the upper edge of the (risk, return) points, by rising risk.

    Spending a whole budget under an average-risk limit is a linear program with two binding
    constraints, so a best mix holds at most two assets, and those are neighbours on this edge.
    An asset under the edge is beaten by a mix of its neighbours at the same risk. Among equals
    the lower risk wins, then the name.
    """
    edge: list[Asset] = []
    for asset in sorted(assets, key=lambda a: (a.risk, -a.annual_return, a.name)):
        if edge and asset.annual_return <= edge[-1].annual_return:
            continue
        while len(edge) > 1 and _slope(edge[-2], asset) >= _slope(edge[-2], edge[-1]):
            edge.pop()
        edge.append(asset)
    return edge


def _slope(low: Asset, high: Asset) -> float:
    return (high.annual_return - low.annual_return) / (high.risk - low.risk)


def _shares(edge: Sequence[Asset], names: Sequence[str], risk: Column) -> Column:
    """Struct of budget shares by asset name; null where even the safest asset is too risky."""

    def mix(weights: dict[str, Column]) -> Column:
        return F.struct(*[weights.get(n, F.lit(0.0)).alias(n) for n in names])

    choice = F.when(risk >= F.lit(float(edge[-1].risk)), mix({edge[-1].name: F.lit(1.0)}))
    for low, high in reversed(list(zip(edge, edge[1:]))):
        high_share = (risk - F.lit(float(low.risk))) / F.lit(float(high.risk - low.risk))
        choice = choice.when(
            risk >= F.lit(float(low.risk)),
            mix({low.name: F.lit(1.0) - high_share, high.name: high_share}),
        )
    return choice


def _shares_by_horizon(assets: Sequence[Asset], horizon: Column, risk: Column) -> Column:
    """Shares by the assets a client's horizon allows, longest minimum horizon first."""
    names = [a.name for a in assets]

    def shares(allowed: list[Asset]) -> Column:
        edge = efficient_assets(allowed)
        return _shares(edge, names, risk) if edge else F.lit(None)

    choice = shares([a for a in assets if a.min_horizon is None])
    for limit in sorted({a.min_horizon for a in assets if a.min_horizon is not None}):
        allowed = [a for a in assets if a.min_horizon is None or a.min_horizon <= limit]
        choice = F.when(horizon >= limit, shares(allowed)).otherwise(choice)
    return choice


def allocate(
    clients: DataFrame,
    budget: str = "monthly_disposable_income",
    risk: str = "risk_tolerance_score",
    horizon: str = "investment_horizon",
    assets: Sequence[Asset] = ASSETS,
) -> DataFrame:
    """Adds ``status`` and one amount column per asset.

    Maximizes yearly return with the whole budget spent, average risk at most the client's score
    and no asset held for less than its minimum horizon. A budget of nothing or less gives 0 for
    all assets, whatever the other inputs; where no mix is allowed, or an input is missing, NaN or
    infinite, the amounts are null. The expression grows with the assets times their horizons: it
    is meant for the few tens of assets a person may choose from.
    """
    shares = _shares_by_horizon(assets, F.col(horizon), F.col(risk))
    status = (
        F.when(is_number(F.col(budget)) & (F.col(budget) <= 0), NO_BUDGET)
        .when(~(is_number(F.col(budget)) & is_number(F.col(risk)) & is_number(F.col(horizon))), MISSING_INPUT)
        .when(F.col("_shares").isNull(), INFEASIBLE)
        .otherwise(OPTIMAL)
    )
    amounts = {
        a.name: F.when(
            F.col("status") == OPTIMAL, cents(F.col(budget) * F.col(f"_shares.{a.name}"))
        ).when(F.col("status") == NO_BUDGET, F.lit(0.0))
        for a in assets
    }
    return (
        clients.withColumn("_shares", shares)
        .withColumn("status", status)
        .withColumns(amounts)
        .drop("_shares")
    )


def add_return_and_risk(allocated: DataFrame, assets: Sequence[Asset] = ASSETS) -> DataFrame:
    """Expected yearly return and risk of the rounded amounts, summed as decimals."""

    def weighted(weights: dict[str, float]) -> Column:
        terms = [
            F.col(name).cast("decimal(18,2)") * F.lit(Decimal(str(weight)))
            for name, weight in weights.items()
        ]
        return F.round(sum(terms[1:], terms[0]), 2).cast("double")

    return allocated.withColumns(
        {
            "expected_annual_return": weighted({a.name: a.annual_return for a in assets}),
            "expected_annual_risk": weighted({a.name: a.risk for a in assets}),
        }
    )


def portfolio_recommendations(
    features: DataFrame, assets: Sequence[Asset] = ASSETS
) -> DataFrame:
    """One recommendation per user of the portfolio features, inputs included."""
    chosen = features.select(
        "client_id",
        "monthly_disposable_income",
        "risk_tolerance_score",
        "investment_horizon",
    )
    return add_return_and_risk(allocate(chosen, assets=assets), assets)


def allocation_rows(allocated: DataFrame, assets: Sequence[Asset] = ASSETS) -> DataFrame:
    """Long form ``(client_id, asset, amount)``."""
    names = [a.name for a in assets]
    return allocated.unpivot("client_id", names, "asset", "amount")


def positive_allocations(rows: DataFrame) -> DataFrame:
    """Only the assets a client actually holds."""
    return rows.filter(F.col("amount") > 0)


def return_and_risk_of_rows(rows: DataFrame, assets: Sequence[Asset] = ASSETS) -> DataFrame:
    """Return and risk per client from the long form.

    The broadcast side is the given list of assets itself; Spark sums per task first.
    """
    joined = rows.join(F.broadcast(asset_table(rows.sparkSession, assets)), "asset")
    amount = F.col("amount").cast("decimal(18,2)")

    def total(weight: str) -> Column:
        return F.round(F.sum(amount * F.col(weight).cast("decimal(9,4)")), 2).cast("double")

    return joined.groupBy("client_id").agg(
        total("annual_return").alias("expected_annual_return"),
        total("risk").alias("expected_annual_risk"),
    )


def card_bundles(
    products: Sequence[CardProduct] = CARD_PRODUCTS,
    max_cards: int = MAX_CARDS,
    exclusive: Sequence[tuple[str, str]] = EXCLUSIVE_CARDS,
) -> list[tuple[str, int, int]]:
    """All allowed bundles as ``(names, revenue, risk_cost)``, best first.

    Names keep product order and are joined by ``+``; the empty bundle is among them. Equal
    revenue goes by lower risk, then by name.
    """
    banned = [frozenset(pair) for pair in exclusive]
    bundles = [
        ("+".join(p.name for p in chosen), sum(p.revenue for p in chosen), sum(p.risk_cost for p in chosen))
        for size in range(max_cards + 1)
        for chosen in combinations(products, size)
        if not any(pair <= {p.name for p in chosen} for pair in banned)
    ]
    return sorted(bundles, key=lambda b: (-b[1], b[2], b[0]))


def offer_cards(
    users: DataFrame, bundles: Sequence[tuple[str, int, int]] | None = None
) -> DataFrame:
    """Card bundle of highest revenue whose risk cost fits each user's risk budget.

    Adds ``risk_budget, status, bundle, revenue, risk_cost``. The bundles are tried best first,
    so the first affordable one is the answer.
    """
    bundles = card_bundles() if bundles is None else bundles
    first = F.coalesce(
        *[
            F.when(
                is_number(F.col("risk_budget")) & (F.col("risk_budget") >= F.lit(risk_cost)),
                F.struct(
                    F.lit(names).alias("bundle"),
                    F.lit(revenue).alias("revenue"),
                    F.lit(risk_cost).alias("risk_cost"),
                ),
            )
            for names, revenue, risk_cost in bundles
        ]
    )
    budget = credit_risk_budget(F.col("credit_score"), F.col("total_debt"), F.col("yearly_income"))
    status = (
        F.when(~is_number(F.col("risk_budget")), MISSING_INPUT)
        .when(F.col("_offer").isNull(), INFEASIBLE)
        .otherwise(OPTIMAL)
    )
    return (
        users.withColumn("risk_budget", budget)
        .withColumn("_offer", first)
        .withColumn("status", status)
        .select("*", "_offer.bundle", "_offer.revenue", "_offer.risk_cost")
        .drop("_offer")
    )
