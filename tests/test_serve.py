import pytest
from pyspark.sql import functions as F

from spendlake.operators.serve import (
    advisor_plan,
    advisor_response,
    client_histories,
    client_history,
    client_ids,
    client_snapshot,
    client_snapshots,
    clients_without_history,
    clients_without_profile,
    display_plan,
    latest_month,
    latest_profile,
    rolling_mean_forecast,
    snapshots_from_months,
    spend_trend,
    table_counts,
)
from spendlake.schemas import ADVISOR_REQUEST, TIME_SERIES_FEATURES
from spendlake.sources import guest_request, read_table, write_table


@pytest.fixture(scope="module")
def series(spark):
    return spark.createDataFrame(
        [
            ("1", "2020-01", 100.0, None, None, None, None),
            ("1", "2020-03", 200.0, 100.0, None, None, 100.0),
            ("2", "2020-02", 50.0, None, None, None, None),
            ("2", None, 7.0, None, None, None, None),
            ("3", "bad", 5.0, None, None, None, None),
        ],
        TIME_SERIES_FEATURES,
    )


@pytest.fixture(scope="module")
def profiles(spark):
    return spark.createDataFrame(
        [("1", 5000.0, 5, 15), ("2", 10.0, 3, 4), ("4", 1.0, 1, 1)],
        "client_id string, monthly_income double, risk_tolerance_score int, investment_horizon int",
    )


def test_ids_and_counts(series, profiles):
    assert {r.client_id for r in client_ids(series).collect()} == {"1", "2", "3"}
    assert tuple(table_counts(series, profiles).first()) == (3, 5, 3)
    assert tuple(table_counts(series.limit(0), profiles).first()) == (0, 0, 3)


def test_latest_month(series):
    rows = {r.client_id: r.txn_month for r in latest_month(series).collect()}
    assert rows == {"1": "2020-03", "2": None, "3": "bad"}


def test_latest_month_prunes_before_the_shuffle(spark, series, tmp_path, plan_of):
    write_table(series, str(tmp_path / "s"))
    plan = plan_of(latest_month(read_table(spark, str(tmp_path / "s"))))
    assert plan.index("WindowGroupLimit") < plan.index("Exchange") < plan.rindex("WindowGroupLimit")


def test_snapshots(series, profiles):
    snapshot = client_snapshots(series, profiles)
    assert {r.client_id: tuple(r)[1:] for r in snapshot.collect()} == {
        "1": (5000.0, 5, 15, 200.0, 100.0, None),
        "2": (10.0, 3, 4, 7.0, None, None),
    }
    assert [r.client_id for r in clients_without_profile(series, profiles).collect()] == ["3"]
    assert [r.client_id for r in clients_without_history(series, profiles).collect()] == ["4"]


def test_snapshot_of_one_client(series, profiles):
    assert client_snapshot(series, profiles, "1").first().spend_1_month_ago == 100.0
    assert client_snapshot(series, profiles, "3").count() == 0
    by_id = profiles.withColumnRenamed("client_id", "id")
    assert client_snapshot(series, by_id, "2").first().risk_score == 3


def test_trend(series):
    rows = {(r.client_id, r.txn_month): r.smoothed_target_spend for r in spend_trend(series).collect()}
    assert rows == {("1", "2020-01"): 100.0, ("1", "2020-03"): 150.0, ("2", "2020-02"): 50.0}


def test_profile_key_may_be_id(spark):
    rows = spark.createDataFrame([(1, 2.0), (1, 2.0)], "id int, monthly_income double")
    assert [r.client_id for r in latest_profile(rows).collect()] == ["1"]


def test_histories(series):
    assert client_histories(series).count() == 3  # unreadable months dropped
    assert [r.txn_month for r in client_history(series, "1").collect()] == ["2020-01", "2020-03"]
    assert client_history(series, "nobody").count() == 0


def test_history_of_an_older_series(series):
    older = series.drop("spend_3_months_ago", "avg_spend_last_3_months")
    rows = client_history(older, "1")
    assert rows.columns == series.columns
    assert [r.avg_spend_last_3_months for r in rows.collect()] == [None, None]


def test_history_lookup_reaches_the_scan(spark, series, tmp_path, plan_of):
    write_table(series, str(tmp_path / "s"))
    plan = plan_of(client_history(read_table(spark, str(tmp_path / "s")), "1"))
    assert "EqualTo(client_id,1)" in plan


def test_one_pass_equals_join_of_tables(spark, sf_dir):
    from spendlake.plans import testdata
    from spendlake.plans.catalog import _features, _months, _series

    users = testdata.silver_users(spark, sf_dir)
    one = snapshots_from_months(users, _months(spark, sf_dir))
    joined = client_snapshots(_series(spark, sf_dir), _features(spark, sf_dir)).na.fill(-1.0)
    one = one.withColumnRenamed("risk_tolerance_score", "risk_score").select(joined.columns).na.fill(-1.0)
    assert sorted(map(tuple, one.collect())) == sorted(map(tuple, joined.collect()))


def test_both_snapshot_forms_settle_odd_rows_alike(spark, sf_dir):
    """Unreadable months and repeated users."""
    from spendlake.operators.monthly import client_months, time_series_features
    from spendlake.operators.profile import user_portfolio_features
    from spendlake.plans import testdata

    users = testdata.silver_users(spark, sf_dir).limit(3)
    users = users.union(users.withColumn("yearly_income", F.col("yearly_income") + 1200))
    first, second, third = sorted(r.id for r in users.select("id").distinct().collect())
    rows = [
        (first, "no date", -5.0), (second, "2020-01-05", -7.0), (second, "?", -9.0), (second, "2020-03-01", -11.0),
        (third, "2020-01-05", -1.0), (third, "2020-02-05", -2.0),
    ]
    months = client_months(spark.createDataFrame(rows, "client_id string, date string, amount double"))
    joined = client_snapshots(time_series_features(months), user_portfolio_features(users, months))
    one = snapshots_from_months(users, months).withColumnRenamed("risk_tolerance_score", "risk_score")
    found = sorted(map(str, joined.collect()))
    assert found == sorted(map(str, one.select(joined.columns).collect())) and len(found) == 3
    assert {r.client_id: r.current_month_spend for r in joined.collect()} == {first: 5.0, second: 9.0, third: 2.0}


def requests(spark, *rows):
    return spark.createDataFrame(list(rows), ADVISOR_REQUEST)


def test_rolling_mean(spark):
    rows = requests(
        spark,
        ("a", 1.0, 1, 1, 100.0, 200.0, 301.0),
        ("b", 1.0, 1, 1, 100.0, 50.05, None),
        ("c", 1.0, 1, 1, 7.0, None, None),
        ("d", 1.0, 1, 1, None, None, None),
    )
    predicted = {r.client_id: r.prediction for r in rolling_mean_forecast(rows).collect()}
    assert predicted == {"a": 200.33, "b": 75.03, "c": 7.0, "d": None}


def test_guest_plan(spark):
    plan = advisor_plan(guest_request(spark)).first()
    assert (plan.client_id, plan.predicted_expense, plan.safe_investable_budget) == ("Guest", 2000.0, 3000.0)
    assert (plan.Savings, plan.Crypto, plan.status) == (1666.67, 1333.33, "OPTIMAL")
    assert advisor_plan(guest_request(spark, investment_horizon=4)).first().ETFs == 2400.0


def test_plan_without_budget(spark):
    plan = advisor_plan(guest_request(spark, monthly_income=100.0)).first()
    assert (plan.status, plan.safe_investable_budget, plan.Savings) == ("NO_BUDGET", -1900.0, 0.0)


def test_any_forecast(spark):
    plan = advisor_plan(guest_request(spark), lambda df: df.withColumn("prediction", F.lit(4999.994)))
    row = plan.first()
    assert (row.predicted_expense, row.safe_investable_budget) == (4999.99, 0.01)


def test_response_and_display(spark):
    plan = advisor_plan(guest_request(spark))
    row = advisor_response(plan).first()
    assert row.financial_forecast.safe_investable_budget == 3000.0
    assert row.recommended_action.Crypto == 1333.33
    assert tuple(display_plan(plan).first()) == ("Guest", "$5,000.00", "$2,000.00", "$3,000.00")
