import pytest
from pyspark.sql import functions as F

from spendlake.operators.forecast import training_rows
from spendlake.operators.monthly import (
    category_spend,
    client_months,
    client_net_amount,
    client_spend_totals,
    expenses,
    monthly_spend,
    smoothed_spend,
    tag_discretionary,
    time_series_features,
    top_rows,
)

COLUMNS = "client_id string, date string, amount double, category_name string"


def frame(spark, *rows):
    return spark.createDataFrame(list(rows), COLUMNS)


@pytest.fixture(scope="module")
def worked(spark):
    """One client with 100, 200, 301, 400 in four months, a gap among them, and one single month."""
    return frame(
        spark,
        ("a", "2020-01-05 00:00:00", -60.0, "BOOK STORES"),
        ("a", "2020-01-31 23:59:59", -40.0, "TAXI"),
        ("a", "2020-01-31 23:59:59", 1000.0, "BOOK STORES"),
        ("a", "2020-03-01 00:00:00", -200.0, "BOOK STORES"),
        ("a", "2020-04-01 00:00:00", -301.0, "UNKNOWN"),
        ("a", "2021-01-01 00:00:00", -400.0, "TAXI"),
        ("b", "2020-01-01 00:00:00", -0.07, "TAXI"),
        ("c", "2020-01-01 00:00:00", 5.0, "TAXI"),
    )


def series_of(df, *columns):
    return [tuple(r[c] for c in columns) for r in df.orderBy("client_id", "txn_month").collect()]


def test_worked_series(worked):
    features = time_series_features(client_months(worked))
    assert [tuple(r) for r in features.orderBy("client_id", "txn_month").collect()] == [
        ("a", "2020-01", 100.0, None, None, None, None),
        ("a", "2020-03", 200.0, 100.0, None, None, 100.0),
        ("a", "2020-04", 301.0, 200.0, 100.0, None, 150.0),
        ("a", "2021-01", 400.0, 301.0, 200.0, 100.0, 200.33),
        ("b", "2020-01", 0.07, None, None, None, None),
    ]


def test_min_history(worked):
    months = client_months(worked)
    kept = time_series_features(months, min_history=2)
    assert series_of(kept, "txn_month") == [("2020-04",), ("2021-01",)]
    assert kept.columns == time_series_features(months).columns


def test_smoothed(worked):
    smooth = smoothed_spend(monthly_spend(client_months(worked)))
    assert series_of(smooth, "smoothed_target_spend") == [
        (100.0,), (150.0,), (200.33,), (300.33,), (0.07,),
    ]


def test_half_cents_round_up(spark):
    rows = frame(spark, *[("a", f"2020-0{m}-01", -x, "T") for m, x in ((1, 100.10), (2, 100.15), (3, 1.0))])
    features = time_series_features(client_months(rows))
    assert features.filter("txn_month = '2020-03'").first().avg_spend_last_3_months == 100.13


def test_totals(worked):
    months = client_months(worked)
    rows = {r.client_id: tuple(r)[1:] for r in client_spend_totals(months).collect()}
    assert rows == {"a": (1001.0, 260.0, 4), "b": (0.07, 0.0, 1)}
    assert "discretionary" not in client_months(worked.drop("category_name")).columns
    spare = client_spend_totals(client_months(worked.drop("category_name")))
    assert {r.discretionary_spending for r in spare.collect()} == {None}


def test_unreadable_dates_count_as_spend_but_not_as_month(spark):
    rows = frame(spark, ("a", "nope", -5.0, "T"), ("a", None, -1.0, "T"), ("a", "2020-01-01", -4.0, "T"))
    total = client_spend_totals(client_months(rows)).first()
    assert (total.total_expenses, total.active_months) == (10.0, 1)


def test_positive_expenses(worked):
    flipped = worked.withColumn("amount", -F.col("amount"))
    assert (
        client_months(flipped, expense_is_negative=False).exceptAll(client_months(worked)).count() == 0
    )


def test_tag(worked):
    tagged = tag_discretionary(expenses(worked))
    assert {r.is_discretionary for r in tagged.filter("category_name = 'TAXI'").collect()} == {0.0}
    assert tagged.filter("category_name = 'BOOK STORES' AND is_discretionary = amount * -1").count() == 2


def test_net_amount(worked):
    rows = {r.client_id: r.net_amount for r in client_net_amount(worked).collect()}
    assert rows == {"a": -1.0, "b": -0.07, "c": 5.0}


def test_categories(worked):
    rows = [(r.category_name, r.total_spent) for r in category_spend(worked).collect()]
    assert rows == [("TAXI", -440.07), ("UNKNOWN", -301.0), ("BOOK STORES", -260.0)]
    assert category_spend(worked, top=1).count() == 1


def test_top_rows(worked, plan_of):
    top = top_rows(worked, "amount", 2, tie_break="date")
    assert [r.amount for r in top.collect()] == [1000.0, 5.0]
    assert "TakeOrderedAndProject" in plan_of(top)


def test_one_sort_serves_all_features(worked, plan_of):
    plan = plan_of(time_series_features(client_months(worked)))
    assert plan.count("Window [") == 1
    assert plan.count("Exchange hashpartitioning") == 2


def test_training_rows_need_no_further_shuffle(worked, plan_of):
    plan = plan_of(training_rows(time_series_features(client_months(worked))))
    assert plan.count("Exchange hashpartitioning") == 2


def test_hot_client_is_summed_before_the_shuffle(spark, plan_of):
    rows = spark.range(0, 9000, 1, 4).selectExpr(
        "case when id % 3 = 0 then 'hot' else cast(id as string) end client_id",
        "'2020-01-01' date", "-0.01 amount",
    ).withColumn("amount", F.col("amount").cast("double"))
    months = client_months(rows)
    plan = plan_of(months)
    assert plan.index("partial_sum") > plan.index("Exchange")  # printed parents first
    assert months.filter("client_id = 'hot'").first().spend == 30


def test_null_counts_of_lags(spark, sf_dir):
    """n clients lack lag 1, and every client with fewer months lacks the longer lags throughout."""
    from spendlake.plans.catalog import QUERIES

    series = QUERIES["time_series_features"](spark, sf_dir).cache()
    per_client = [r["count"] for r in series.groupBy("client_id").count().collect()]
    for n, column in ((1, "spend_1_month_ago"), (2, "spend_2_months_ago"), (3, "spend_3_months_ago")):
        assert series.filter(F.col(column).isNull()).count() == sum(min(n, c) for c in per_client)
    assert series.filter("avg_spend_last_3_months IS NULL").count() == len(per_client)
