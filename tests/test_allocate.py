import itertools

import pytest

from spendlake.operators.allocate import (
    add_return_and_risk,
    allocate,
    allocation_rows,
    card_bundles,
    efficient_assets,
    offer_cards,
    positive_allocations,
    return_and_risk_of_rows,
)
from spendlake.schemas import ASSETS, Asset

NAMES = [a.name for a in ASSETS]
ASK = "client_id string, monthly_disposable_income double, risk_tolerance_score double, investment_horizon int"

# Budget 1000: risk -> (Savings, Bonds, ETFs, Crypto, return), long and short horizon.
LONG = {
    1: (1000, 0, 0, 0, 20.0), 2: (888.89, 0, 0, 111.11, 34.44), 3: (777.78, 0, 0, 222.22, 48.89),
    4: (666.67, 0, 0, 333.33, 63.33), 5: (555.56, 0, 0, 444.44, 77.78),
    6: (444.44, 0, 0, 555.56, 92.22), 7: (333.33, 0, 0, 666.67, 106.67),
    8: (222.22, 0, 0, 777.78, 121.11), 9: (111.11, 0, 0, 888.89, 135.56),
    10: (0, 0, 0, 1000, 150.0), 12: (0, 0, 0, 1000, 150.0),
}
SHORT = {
    1: (1000, 0, 0, 0, 20.0), 2: (800, 0, 200, 0, 32.0), 3: (600, 0, 400, 0, 44.0),
    4: (400, 0, 600, 0, 56.0), 5: (200, 0, 800, 0, 68.0),
    **{risk: (0, 0, 1000, 0, 80.0) for risk in (6, 7, 8, 9, 10, 12)},
}


def asks(spark, *rows):
    return spark.createDataFrame([(str(i), *row) for i, row in enumerate(rows)], ASK)


def best_by_enumeration(assets, risk, horizon):
    """Highest return over all single assets and all pairs, as a share per unit of budget."""
    allowed = [a for a in assets if a.min_horizon is None or horizon >= a.min_horizon]
    values = [a.annual_return for a in allowed if a.risk <= risk]
    for low, high in itertools.permutations(allowed, 2):
        if low.risk < risk < high.risk:
            share = (risk - low.risk) / (high.risk - low.risk)
            values.append((1 - share) * low.annual_return + share * high.annual_return)
    return max(values, default=None)


@pytest.mark.parametrize("horizon,expected", [(5, LONG), (30, LONG), (4, SHORT), (-38, SHORT)])
def test_goldens(spark, horizon, expected):
    df = add_return_and_risk(allocate(asks(spark, *[(1000.0, float(r), horizon) for r in expected])))
    rows = sorted(df.collect(), key=lambda r: int(r.client_id))
    for row, (risk, golden) in zip(rows, expected.items()):
        assert (*[row[n] for n in NAMES], row.expected_annual_return) == golden, risk
        assert row.status == "OPTIMAL"


def test_statuses(spark):
    df = allocate(
        asks(
            spark,
            (0.0, 5.0, 10), (-5.0, 0.0, 10), (100.0, 0.0, 10), (100.0, 0.99, 3),
            (None, 5.0, 10), (100.0, None, 10), (100.0, 5.0, None), (-1.0, None, None),
        )
    )
    rows = sorted(df.collect(), key=lambda r: int(r.client_id))
    assert [r.status for r in rows] == [
        "NO_BUDGET", "NO_BUDGET", "INFEASIBLE", "INFEASIBLE",
        "MISSING_INPUT", "MISSING_INPUT", "MISSING_INPUT", "NO_BUDGET",
    ]
    assert [r.Savings for r in rows] == [0.0, 0.0, None, None, None, None, None, 0.0]


def test_properties(spark):
    cases = [(b, r / 2, h) for b in (0.01, 7.0, 12345.67) for r in range(0, 26) for h in (0, 4, 5, 40)]
    for row in add_return_and_risk(allocate(asks(spark, *cases))).collect():
        amounts = [row[n] for n in NAMES]
        if row.risk_tolerance_score < 1:
            assert row.status == "INFEASIBLE"
            continue
        budget = row.monthly_disposable_income
        assert abs(sum(amounts) - budget) <= 0.02
        assert min(amounts) >= 0
        assert sum(x * a.risk for x, a in zip(amounts, ASSETS)) <= budget * row.risk_tolerance_score + 0.2
        assert row.investment_horizon >= 5 or row.Crypto == 0


def test_any_asset_table(spark):
    """Against enumeration, with dominated assets, equal risks and several horizons."""
    assets = [
        Asset("A", 0.01, 1), Asset("B", 0.05, 2), Asset("B2", 0.04, 2), Asset("C", 0.05, 4),
        Asset("D", 0.09, 5, 3), Asset("E", 0.10, 8), Asset("F", 0.30, 9, 10), Asset("G", 0.02, 3),
    ]
    cases = [(1.0e6, r / 4, h) for r in range(0, 45) for h in (0, 3, 9, 10)]
    df = allocate(asks(spark, *cases), assets=assets)
    for row in df.collect():
        want = best_by_enumeration(assets, row.risk_tolerance_score, row.investment_horizon)
        if want is None:
            assert row.status == "INFEASIBLE"
        else:
            got = sum(row[a.name] * a.annual_return for a in assets)
            assert abs(got - want * 1e6) < 0.05


def test_assets_that_all_have_a_horizon(spark):
    df = allocate(asks(spark, (10.0, 5.0, 1), (10.0, 5.0, 2)), assets=[Asset("X", 0.1, 1, 2)])
    assert sorted(r.status for r in df.collect()) == ["INFEASIBLE", "OPTIMAL"]


def test_efficient_assets():
    assert [a.name for a in efficient_assets(ASSETS)] == ["Savings", "Crypto"]
    assert [a.name for a in efficient_assets(ASSETS[:3])] == ["Savings", "ETFs"]


def test_no_join_and_no_shuffle(spark, plan_of):
    plan = plan_of(add_return_and_risk(allocate(asks(spark, (1.0, 1.0, 1)))))
    assert "Join" not in plan and "Exchange" not in plan and "Python" not in plan


def test_long_form(spark):
    df = add_return_and_risk(allocate(asks(spark, (1000.0, 2.0, 4), (-1.0, 2.0, 4))))
    rows = allocation_rows(df)
    assert rows.count() == 8
    held = positive_allocations(rows)
    assert sorted((r.asset, r.amount) for r in held.collect()) == [("ETFs", 200.0), ("Savings", 800.0)]
    total = return_and_risk_of_rows(held).first()
    assert (total.expected_annual_return, total.expected_annual_risk) == (32.0, 2000.0)


def test_bundles():
    bundles = card_bundles()
    assert len(bundles) == 10
    assert bundles[0] == ("Cashback_Rewards+Platinum_Travel", 450, 750)
    assert ("", 0, 0) in bundles
    assert not any("Basic" in b[0] and "Platinum" in b[0] for b in bundles)


def test_offers(spark):
    users = spark.createDataFrame(
        [("1556", 48277.0, 110153.0, 940), ("poor", 1.0, 100.0, 100), ("none", 0.0, 1.0, 900),
         ("edge", 100.0, 0.0, 160), ("zero", 100.0, 0.0, 0)],
        "id string, yearly_income double, total_debt double, credit_score int",
    )
    rows = {r.id: (r.status, r.bundle, r.revenue, r.risk_cost) for r in offer_cards(users).collect()}
    assert rows == {
        "1556": ("OPTIMAL", "Cashback_Rewards+Platinum_Travel", 450, 750),
        "poor": ("INFEASIBLE", None, None, None),
        "none": ("MISSING_INPUT", None, None, None),
        "edge": ("OPTIMAL", "Basic_Debit+Standard_Credit", 120, 160),
        "zero": ("OPTIMAL", "", 0, 0),
    }


@pytest.mark.parametrize("bad", [float("nan"), float("inf"), float("-inf"), None])
@pytest.mark.parametrize("place", [0, 1])
def test_inputs_that_are_no_numbers(spark, bad, place):
    values = [1000.0, 5.0]
    values[place] = bad
    row = allocate(asks(spark, (*values, 10))).first()
    assert row.status == "MISSING_INPUT" and row.Savings is None and row.Crypto is None


def test_horizon_that_is_no_number(spark):
    rows = spark.createDataFrame([(1000.0, 5.0, float("nan")), (1000.0, 5.0, None)], "b double, r double, h double")
    assert {r.status for r in allocate(rows, "b", "r", "h").collect()} == {"MISSING_INPUT"}


def test_no_budget_needs_a_number(spark):
    rows = asks(spark, (0.0, float("nan"), 3), (-5.0, None, None))
    assert {r.status for r in allocate(rows).collect()} == {"NO_BUDGET"}
