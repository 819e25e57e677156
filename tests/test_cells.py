"""Trees fitted on weighted cells are the trees of all rows."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from spendlake.operators import forecast as f
from spendlake.operators.forecast import boosted, cells, fit_cells, gbt, grid_search, nearest, steps, with_vector

NAMES = ("a", "b")


@pytest.fixture(scope="module")
def frame(spark):
    place = F.col("id")
    return spark.range(4000).select(
        (place % 7 * 10.0).alias("a"),
        (place % 11 * place % 5 - 2.0).alias("b"),
        (F.sin(place * 0.37) * 50 + place % 7 * (place % 5)).alias("label"),
    )


def test_model_of_cells_is_that_of_all_rows(frame):
    stored = cells(frame, NAMES)
    distinct = frame.select(*NAMES).distinct().count()
    assert stored.count() == distinct < 40
    assert stored.agg(F.sum("weight")).first()[0] == 4000
    whole = gbt(trees=5, depth=3).fit(with_vector(frame, NAMES))
    small = fit_cells(gbt(trees=5, depth=3), stored)
    check = with_vector(frame.select(*NAMES).distinct(), NAMES)
    expected, got = ([r.prediction for r in m.transform(check.orderBy(*NAMES)).collect()] for m in (whole, small))
    assert got == pytest.approx(expected)


def test_cells_do_not_grow_with_rows(spark):
    rows = spark.range(50_000).select(F.sqrt("id").alias("a"), F.col("id").alias("b"), F.col("id").alias("label"))
    stored = cells(rows, NAMES, bins=8)
    assert stored.count() <= 64 and stored.agg(F.sum("weight")).first()[0] == 50_000


def test_steps_and_nearest(spark):
    df = spark.createDataFrame([(0.0,), (0.0,), (10.0,), (20.0,), (float("nan"),), (None,)], "a double")
    assert steps(df, ["a"]) == [[0.0, 10.0, 20.0]]
    asked = spark.createDataFrame([(-9.0,), (5.0,), (5.01,), (15.0,), (99.0,), (float("nan"),), (None,)], "a double")
    got = [r[0] for r in asked.select(nearest(F.col("a"), [0.0, 10.0, 20.0])).collect()]
    assert got == [0.0, 0.0, 10.0, 10.0, 20.0, None, None]


def test_boosting_in_a_task_is_that_of_spark_ml(frame):
    stored = cells(frame, NAMES)
    found = [(*r.features, r.label, r.weight) for r in stored.collect()]
    values = np.array(found)
    x = np.stack([np.unique(values[:, k], return_inverse=True)[1] for k in range(2)], axis=1)
    after = boosted(x, values[:, 2], values[:, 3], 3, 0.1, (2, 6))
    for trees, got in zip((2, 6), after):
        model = fit_cells(gbt(trees=trees, depth=3), stored)
        expected = {tuple(r.features): r.prediction for r in model.transform(stored).collect()}
        assert dict(zip((tuple(v[:2]) for v in values), got)) == pytest.approx(expected)


def test_jobs_of_the_grid_do_not_grow_with_its_trees(spark, sf_dir):
    from spendlake.plans.catalog import _training

    rows, context = _training(spark, sf_dir), spark.sparkContext

    def jobs(trees: int) -> int:
        context.setJobGroup(f"trees{trees}", "")
        try:
            assert grid_search(rows, grid={"maxDepth": (2, 3), "stepSize": (0.1,), "maxIter": (trees,)}).count() == 2
            return len(context.statusTracker().getJobIdsForGroup(f"trees{trees}"))
        finally:
            context._jsc.clearJobGroup()

    assert 0 < jobs(12) <= jobs(2) + 2 and f.GRID["maxIter"] == (100, 200)
