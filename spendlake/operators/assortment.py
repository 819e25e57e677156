"""Card bundles from a table of products of any length.

:mod:`spendlake.operators.allocate` lists the bundles of a handful of products. Their number grows with
the products to the power of the bundle's size, so here a dynamic programme keeps only bundles that may
still be best: a fold over the sorted products whose state is an array of bundles. A bundle goes once
another is strictly better, no larger, and bars no product yet to come that the first does not bar.
"""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from spendlake.functions import credit_risk_budget, is_number
from spendlake.operators.allocate import INFEASIBLE, MISSING_INPUT, OPTIMAL
from spendlake.operators.enrich import fits_broadcast

#: Products that one fold takes: an assortment, not a catalogue of goods.
MOST_PRODUCTS = 1000

_BUNDLE = "struct<revenue:long,risk_cost:long,members:array<string>,bars:array<string>>"
_OFFER = "array<struct<bundle:string,revenue:long,risk_cost:long>>"


def _beats(better: Column, other: Column) -> Column:
    """Whether a bundle leaves another without a chance, whatever is added to both."""
    no_worse = (better["revenue"] >= other["revenue"]) & (better["risk_cost"] <= other["risk_cost"])
    strictly = (better["revenue"] > other["revenue"]) | (better["risk_cost"] < other["risk_cost"])
    smaller = F.size(better["members"]) <= F.size(other["members"])
    freer = F.size(F.array_except(better["bars"], other["bars"])) == 0
    return no_worse & strictly & smaller & freer


def best_bundles(products: Column, max_cards: int) -> Column:
    """Bundles that are best for some risk budget, best first, from an array of products in order.

    Products are ``(position, product, revenue, risk_cost, bars)``, ``bars`` being later products that
    may not join. Equal revenue goes by lower risk, then by name; the empty bundle is always among them.
    """

    def add(bundles: Column, product: Column) -> Column:
        def joined(bundle: Column) -> Column:
            # of what is barred only products yet to come matter
            barred = F.array_distinct(F.concat(bundle["bars"], product["bars"]))
            return F.struct(
                (bundle["revenue"] + product["revenue"]).alias("revenue"),
                (bundle["risk_cost"] + product["risk_cost"]).alias("risk_cost"),
                F.concat(bundle["members"], F.array(product["product"])).alias("members"),
                F.array_remove(barred, product["product"]).alias("bars"),
            )

        def passed(bundle: Column) -> Column:
            bars = F.array_remove(bundle["bars"], product["product"]).alias("bars")
            return F.struct(*(bundle[c].alias(c) for c in ("revenue", "risk_cost", "members")), bars)

        room = F.filter(
            bundles,
            lambda b: (F.size(b["members"]) < max_cards) & ~F.array_contains(b["bars"], product["product"]),
        )
        grown = F.concat(F.transform(bundles, passed), F.transform(room, joined))
        # once computed, compared with itself
        return F.transform(
            F.array(grown), lambda all_of: F.filter(all_of, lambda b: ~F.exists(all_of, lambda o: _beats(o, b)))
        )[0]

    none = F.expr(f"array(cast(named_struct('revenue', 0L, 'risk_cost', 0L, 'members', array(), 'bars', array()) AS {_BUNDLE}))")
    found = F.aggregate(products, none, add)
    named = F.transform(
        found,
        lambda b: F.struct(
            (-b["revenue"]).alias("back"), b["risk_cost"].alias("risk_cost"), F.array_join(b["members"], "+").alias("bundle")
        ),
    )
    return F.transform(
        F.sort_array(named),
        lambda b: F.struct(b["bundle"].alias("bundle"), (-b["back"]).alias("revenue"), b["risk_cost"].alias("risk_cost")),
    )


def product_bundles(products: DataFrame, exclusions: DataFrame, max_cards: int) -> list[dict]:
    """The bundles of :func:`best_bundles` as ``bundle, revenue, risk_cost``, for all users alike.

    ``products`` has ``position, product, revenue, risk_cost``, ``exclusions`` pairs ``product, other``
    in any order. Products without a name or number are not offered; of a name given twice the first
    by position counts. More than :data:`MOST_PRODUCTS` are an error.
    """
    numbered = is_number(F.col("revenue")) & is_number(F.col("risk_cost")) & F.col("position").isNotNull()
    offered = products.filter(F.col("product").isNotNull() & numbered).groupBy("product").agg(
        F.min(F.struct("position", *(F.col(c).cast("long").alias(c) for c in ("revenue", "risk_cost")))).alias("p")
    )
    if not fits_broadcast(offered.select("product"), MOST_PRODUCTS):
        raise ValueError(f"more than {MOST_PRODUCTS} products")
    offered = offered.select(F.struct("p.position", "product").alias("place"), "product", "p.revenue", "p.risk_cost")
    pairs = exclusions.select("product", "other").unionByName(exclusions.select(F.col("product").alias("other"), F.col("other").alias("product")))
    places = offered.select(F.col("product").alias("other"), F.col("place").alias("other_place"))
    later = (
        offered.join(pairs, "product").join(places, "other").filter(F.col("other_place") > F.col("place"))
        .groupBy("product").agg(F.sort_array(F.collect_set("other")).alias("bars"))
    )
    rows = offered.join(later, "product", "left").withColumn("bars", F.coalesce("bars", F.expr("cast(array() AS array<string>)")))
    # one row of at most MOST_PRODUCTS products
    whole = rows.agg(F.sort_array(F.collect_list(F.struct("place", "product", "revenue", "risk_cost", "bars"))).alias("products"))
    return [b.asDict() for b in whole.select(best_bundles(F.col("products"), max_cards).alias("b")).first()["b"]]


def offer_bundles(users: DataFrame, bundles: list[dict]) -> DataFrame:
    """Adds ``risk_budget, status, bundle, revenue, risk_cost``: the first bundle that fits each user's risk budget.

    The same statuses as :func:`spendlake.operators.allocate.offer_cards`. The bundles are one constant of the plan.
    """
    listed = F.from_json(F.lit(json.dumps(bundles)), _OFFER)
    budget = credit_risk_budget(F.col("credit_score"), F.col("total_debt"), F.col("yearly_income"))
    fits = F.filter(listed, lambda b: is_number(F.col("risk_budget")) & (b["risk_cost"] <= F.col("risk_budget")))
    status = (
        F.when(~is_number(F.col("risk_budget")), MISSING_INPUT)
        .when(F.col("_offer").isNull(), INFEASIBLE)
        .otherwise(OPTIMAL)
    )
    return (
        users.withColumn("risk_budget", budget)
        .withColumn("_offer", F.get(fits, F.lit(0)))
        .withColumn("status", status)
        .select("*", "_offer.bundle", "_offer.revenue", "_offer.risk_cost")
        .drop("_offer")
    )
