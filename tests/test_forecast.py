import pytest
from pyspark.sql import functions as F

from spendlake.operators.forecast import (
    GRID,
    TARGETS,
    fit_forecaster,
    fold_months,
    forecast_errors,
    gbt,
    grid_search,
    holdout_split,
    load_model_if_saved,
    model_forecast,
    model_report,
    naive_errors,
    record_run,
    refit_best,
    save_model,
    score,
    supervised,
    time_folds,
    training_rows,
    with_vector,
)
from spendlake.operators.serve import advisor_plan
from spendlake.plans.catalog import _requests, _series
from spendlake.schemas import TIME_SERIES_FEATURES
from spendlake.session import materialize
from spendlake.sources import guest_request, read_table


@pytest.fixture(scope="module")
def rows(spark, sf_dir):
    return materialize(training_rows(_series(spark, sf_dir)))


@pytest.fixture(scope="module")
def model(rows):
    return fit_forecaster(rows, "smoothed", trees=10)


def small_series(spark, months):
    data = [
        (client, f"2020-{m + 1:02d}", float(spend), None, None, None, None)
        for client, spends in months.items()
        for m, spend in enumerate(spends)
    ]
    return training_rows(spark.createDataFrame(data, TIME_SERIES_FEATURES))


def test_targets_and_holdout(spark):
    df = small_series(spark, {"a": (100, 200, 301, 400), "b": (5,), "c": (1, 2)})
    got = [
        (r.client_id, r.smoothed_target_spend, r.next_smoothed_spend, r.is_test, r.is_test_next)
        for r in df.orderBy("client_id", "txn_month").collect()
    ]
    assert got == [
        ("a", 100.0, 150.0, False, False),
        ("a", 150.0, 200.33, False, True),
        ("a", 200.33, 300.33, True, True),
        ("a", 300.33, None, True, False),
        ("b", 5.0, None, True, False),
        ("c", 1.0, 1.5, True, True),
        ("c", 1.5, None, True, False),
    ]
    assert df.filter("spend_1_month_ago IS NULL").count() == 0


@pytest.mark.parametrize("target", TARGETS)
def test_split_is_complete(rows, target):
    train, test = holdout_split(rows, target)
    labelled = rows.filter(F.col(TARGETS[target].label).isNotNull())
    assert train.count() + test.count() == labelled.count()
    months = labelled.groupBy("client_id").count().collect()
    assert test.count() == sum(min(2, r["count"]) for r in months)
    last_train = train.groupBy("client_id").agg(F.max("txn_month").alias("last"))
    assert test.join(last_train, "client_id").filter("txn_month <= last").count() == 0


def test_smoothed_target_follows_from_its_features(rows):
    """Why the ``smoothed`` error says nothing about the future."""
    full = rows.filter("spend_2_months_ago > 0")
    gap = F.abs(
        F.round((F.col("current_month_spend") + F.col("spend_1_month_ago") + F.col("spend_2_months_ago")) / 3, 2)
        - F.col("smoothed_target_spend")
    )
    assert full.count() > 100
    assert full.select(F.max(gap)).first()[0] < 0.011


def test_errors(spark):
    df = spark.createDataFrame([(100.0, 90.0), (0.0, 1.0), (-50.0, -25.0)], "y double, p double")
    row = forecast_errors(df, "y", "p").first()
    assert (row.rows, row.mae) == (3, 12.0)
    assert row.mape == pytest.approx((0.1 + 1 / 2.220446049250313e-16 + 0.5) / 3)


def test_folds(spark):
    df = small_series(spark, {"a": range(1, 11), "b": range(1, 4)})
    folds = {r.fold: tuple(r)[1:] for r in time_folds(df, folds=3).collect()}
    # ten months, blocks of two: 4+2, 6+2, 8+2; client b only has the first three
    assert folds == {
        1: ("2020-04", "2020-05", "2020-06", 7, 2),
        2: ("2020-06", "2020-07", "2020-08", 9, 2),
        3: ("2020-08", "2020-09", "2020-10", 11, 2),
    }
    assert fold_months(df, 3).count() == 6 + 8 + 10


def test_too_few_months(spark):
    with pytest.raises(ValueError, match="months"):
        grid_search(small_series(spark, {"a": (1, 2, 3, 4)}), grid={"maxDepth": (2,), "stepSize": (0.1,), "maxIter": (1,)})


def test_model_beats_naive(rows, model):
    scored = score(rows, model)
    assert scored.count() == rows.count()
    report = model_report(scored).first()
    naive = naive_errors(rows, "smoothed").first()
    assert report.naive_mae == pytest.approx(naive.mae)
    assert report.test_mae < report.naive_mae and report.beats_naive
    assert report.train_rows + report.test_rows == rows.count()


def test_next_month_model(rows):
    report = model_report(score(rows, fit_forecaster(rows, "next", trees=10), "next")).first()
    assert 0 < report.test_mae < naive_errors(rows, "raw").first().mae


def test_defaults():
    assert gbt().getMaxIter() == 100 and gbt().getMaxDepth() == 4 and gbt().getStepSize() == 0.1
    assert GRID == {"maxDepth": (3, 4, 6), "stepSize": (0.01, 0.1), "maxIter": (100, 200)}


def test_grid_search_and_refit(rows):
    scores = grid_search(rows, grid={"maxDepth": (2, 3), "stepSize": (0.1, 0.5), "maxIter": (2, 4)}, folds=2)
    found = scores.collect()
    assert len(found) == 8
    assert [r.mae for r in found] == sorted(r.mae for r in found)
    best = refit_best(rows, scores)
    assert best.getNumTrees == found[0].trees


def test_error_of_fewer_trees_is_that_of_a_smaller_model(rows):
    """What lets one fit serve every tree count of the grid."""
    train, test = holdout_split(rows)
    frame = with_vector(supervised(train, "smoothed"), TARGETS["smoothed"].features)
    check = with_vector(supervised(test, "smoothed"), TARGETS["smoothed"].features)
    errors = gbt(trees=5).fit(frame).evaluateEachIteration(check, "absolute")
    small = gbt(trees=3).fit(frame).transform(check)
    assert errors[2] == pytest.approx(forecast_errors(small, "label", "prediction").first().mae)


def test_save_load_and_record(spark, rows, model, tmp_path):
    path = str(tmp_path / "model")
    save_model(model, path)
    save_model(model, path)
    loaded = load_model_if_saved(spark, path)
    assert loaded is not None and loaded.getNumTrees == 10
    before, after = (score(rows, m).agg(F.sum("prediction")).first()[0] for m in (model, loaded))
    assert before == pytest.approx(after)
    runs = str(tmp_path / "runs")
    report = model_report(score(rows, model))
    record_run(report, runs, "first", {"trees": 10})
    record_run(report, runs, "second", {})
    table = read_table(spark, runs)
    assert {r.run_name: r.params for r in table.collect()} == {"first": {"trees": "10"}, "second": None}
    assert table.filter("test_mae IS NULL OR run_at IS NULL").count() == 0


def test_advisor_with_a_model(spark, sf_dir, model):
    requests = _requests(spark, sf_dir)
    plan = advisor_plan(requests, model_forecast(model))
    assert plan.count() == requests.count()
    row = advisor_plan(guest_request(spark, spend_2_months_ago=None), model_forecast(model)).first()
    assert row.safe_investable_budget == pytest.approx(5000.0 - row.predicted_expense, abs=0.011)
