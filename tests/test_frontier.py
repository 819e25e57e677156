import random

import pytest

from spendlake.operators import frontier
from spendlake.operators.allocate import allocate, efficient_assets
from spendlake.operators.frontier import add_expected, allocate_from, efficient_edges, holding_rows
from spendlake.schemas import ASSETS, Asset
from spendlake.sources.literals import asset_table

ASSET_SCHEMA = "asset string, annual_return double, risk double, min_horizon int"
CLIENTS = "client_id string, budget double, risk double, horizon double"


def table(spark, assets):
    return spark.createDataFrame(assets, ASSET_SCHEMA)


def edges_of(assets, years):
    allowed = [Asset(n, r, k, h) for n, r, k, h in assets if h is None or h <= years]
    return [a.name for a in efficient_assets(allowed)]


def random_assets(n, seed):
    rng = random.Random(seed)
    return [
        (f"a{i:04}", rng.randint(0, 400) / 1000, float(rng.randint(0, 80)) / 8, rng.choice([None, 1, 3, 7, 7, 12]))
        for i in range(n)
    ]


@pytest.mark.parametrize("folded", [4096, 9])
def test_edges_equal_the_short_list(spark, monkeypatch, folded):
    monkeypatch.setattr(frontier, "FOLDED", folded)
    assets = random_assets(200, 1)
    got = {r.years: [p.asset for p in r.edge] for r in efficient_edges(table(spark, assets)).collect()}
    assert sorted(got) == list(range(-1, 13))
    for years, names in got.items():
        assert names == edges_of(assets, years), years


def test_points_on_one_line_and_equal_points(spark):
    assets = [("b", 0.1, 1.0, None), ("a", 0.1, 1.0, None), ("c", 0.2, 2.0, None), ("d", 0.3, 3.0, None), ("e", 0.3, 4.0, None)]
    edge = efficient_edges(table(spark, assets)).first().edge
    assert [p.asset for p in edge] == ["a", "d"]


@pytest.mark.parametrize("small", [True, False, None])
def test_equals_the_expression_over_few_assets(spark, small):
    rng = random.Random(2)
    rows = [
        (str(i), rng.choice([1000.0, 0.01, 0.0, -5.0, None, float("nan")]), rng.choice([0.0, 1.0, 2.5, 4.0, 11.0, None]),
         rng.choice([0.0, 4.0, 4.9, 5.0, 30.0, -3.0, float("inf")]))
        for i in range(400)
    ]
    clients = spark.createDataFrame(rows, CLIENTS)
    short = allocate(clients, "budget", "risk", "horizon").unpivot(
        ["client_id", "status"], [a.name for a in ASSETS], "asset", "amount"
    )
    long = holding_rows(allocate_from(clients, asset_table(spark), "budget", "risk", "horizon", small))
    held = {tuple(r) for r in long.filter("amount > 0").collect()}
    assert held == {tuple(r) for r in short.filter("amount > 0").collect()} and held
    assert {tuple(r) for r in long.select("client_id", "status").collect()} == {
        tuple(r) for r in short.select("client_id", "status").collect()
    }


def test_expected_values(spark):
    clients = spark.createDataFrame([("1", 1000.0, 3.0, 5.0), ("2", 0.0, 3.0, 5.0), ("3", 10.0, 0.0, 5.0)], CLIENTS)
    rows = {r.client_id: r for r in add_expected(allocate_from(clients, asset_table(spark), "budget", "risk", "horizon")).collect()}
    assert rows["1"].expected_annual_return == 48.89 and rows["1"].expected_annual_risk == 2999.98
    assert rows["2"].holdings == [] and rows["2"].expected_annual_return == 0
    assert rows["3"].status == "INFEASIBLE" and rows["3"].expected_annual_return is None


def test_unusable_assets(spark):
    nan = float("nan")
    assets = [(None, 0.9, 0.0, None), ("x", None, 0.0, None), ("y", 0.9, nan, None), ("z", 0.1, 1.0, -4)]
    clients = spark.createDataFrame([("1", 10.0, 5.0, 0.0)], CLIENTS)
    row = allocate_from(clients, table(spark, assets), "budget", "risk", "horizon").first()
    assert [h.asset for h in row.holdings] == ["z"]
    none = allocate_from(clients, table(spark, []), "budget", "risk", "horizon").first()
    assert none.status == "INFEASIBLE" and none.holdings is None
    with pytest.raises(Exception, match="1000 years"):
        allocate_from(clients, table(spark, [("far", 0.1, 1.0, 2000)]), "budget", "risk", "horizon").collect()


def test_large_edges_are_not_broadcast(spark, plan_of):
    clients = spark.createDataFrame([("1", 10.0, 5.0, 0.0)], CLIENTS)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        large = allocate_from(clients, asset_table(spark), "budget", "risk", "horizon", small=False)
        assert "BroadcastHashJoin" not in plan_of(large)
        assert "CartesianProduct" not in plan_of(large) and "NestedLoop" not in plan_of(large)
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
