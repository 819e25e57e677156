import random
from itertools import combinations

import pytest

from spendlake.operators import assortment
from spendlake.operators.allocate import card_bundles, offer_cards
from spendlake.operators.assortment import offer_bundles, product_bundles
from spendlake.schemas import CARD_PRODUCTS, EXCLUSIVE_CARDS, MAX_CARDS

PRODUCTS = "position int, product string, revenue long, risk_cost long"
PAIRS = "product string, other string"
USERS = "id string, credit_score int, total_debt double, yearly_income double"


def every_bundle(products, pairs, most):
    banned = {frozenset(p) for p in pairs}
    for size in range(most + 1):
        for chosen in combinations(sorted(products), size):
            names = [p[1] for p in chosen]
            if not any(frozenset(x) in banned for x in combinations(names, 2)):
                yield -sum(p[2] for p in chosen), sum(p[3] for p in chosen), "+".join(names)


def first(bundles, budget):
    return next((b for b in bundles if b["risk_cost"] <= budget), None)


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_best_for_every_budget(spark, seed):
    rng = random.Random(seed)
    products = [(i, f"p{i}", rng.randint(0, 12), rng.randint(0, 9)) for i in range(11)]
    pairs = [tuple(rng.sample([p[1] for p in products], 2)) for _ in range(9)]
    most = rng.choice([2, 3, 4])
    got = product_bundles(spark.createDataFrame(products, PRODUCTS), spark.createDataFrame(pairs, PAIRS), most)
    everything = sorted(every_bundle(products, pairs, most))
    for budget in range(0, 40):
        revenue, risk, name = next(b for b in everything if b[1] <= budget)
        assert first(got, budget) == {"bundle": name, "revenue": -revenue, "risk_cost": risk}, budget
    assert len(got) < len(everything)


def test_equals_the_short_list(spark):
    products = [(i, p.name, p.revenue, p.risk_cost) for i, p in enumerate(CARD_PRODUCTS)]
    bundles = product_bundles(spark.createDataFrame(products, PRODUCTS), spark.createDataFrame(list(EXCLUSIVE_CARDS), PAIRS), MAX_CARDS)
    rng = random.Random(4)
    users = [(str(i), rng.choice([0, 300, 500, 640, 850, None]), float(rng.randint(0, 900)), rng.choice([0.0, 50.0, 9000.0, None])) for i in range(200)]
    users = spark.createDataFrame(users, USERS)
    ours, short = offer_bundles(users, bundles), offer_cards(users, card_bundles())
    assert sorted(map(str, ours.collect())) == sorted(map(str, short.select(ours.columns).collect()))


def test_unusable_products(spark, monkeypatch):
    products = [(1, None, 5, 1), (2, "a", None, 1), (None, "b", 5, 1), (3, "c", 5, 1), (4, "c", 9, 0), (5, "d", 1, 1)]
    pairs = [("c", None), ("zz", "c"), ("d", "d")]
    got = product_bundles(spark.createDataFrame(products, PRODUCTS), spark.createDataFrame(pairs, PAIRS), 2)
    assert got[0] == {"bundle": "c+d", "revenue": 6, "risk_cost": 2}
    none = product_bundles(spark.createDataFrame([], PRODUCTS), spark.createDataFrame([], PAIRS), 2)
    assert none == [{"bundle": "", "revenue": 0, "risk_cost": 0}]
    monkeypatch.setattr(assortment, "MOST_PRODUCTS", 1)
    with pytest.raises(ValueError):
        product_bundles(spark.createDataFrame(products, PRODUCTS), spark.createDataFrame(pairs, PAIRS), 2)
