"""Spend forecasting on Spark ML: features, hold-out, boosted trees, grid search, reports.

Three targets are offered. ``raw`` is the month's spend from its lags. ``smoothed`` is the rolling
mean of the very three months used as features, kept because it is what the published error was
measured on; the features determine it, so its error says nothing about the future. ``next`` is
the smoothed spend of the following month and is the honest one.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Sequence
from functools import reduce
from itertools import product
from multiprocessing.pool import ThreadPool
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark import inheritable_thread_target
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import GBTRegressionModel, GBTRegressor
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from spendlake.functions import cents_from_exact, exact
from spendlake.operators.monthly import LAGS
from spendlake.session import materialize
from spendlake.sources.lake import DEFAULT_FORMAT, table_exists, write_table

LAG_COLUMNS = (*LAGS, "avg_spend_last_3_months")
# Smallest divisor of the percentage error: the float64 machine epsilon.
EPSILON = 2.220446049250313e-16
HOLDOUT_MONTHS = 2
#: Values that trees tell a feature's values apart by; Spark ML's default.
BINS = 32


class Target(NamedTuple):
    features: tuple[str, ...]
    label: str
    naive: str


TARGETS = {
    "raw": Target(LAG_COLUMNS, "current_month_spend", "spend_1_month_ago"),
    "smoothed": Target(
        ("current_month_spend", "spend_1_month_ago", "spend_2_months_ago"),
        "smoothed_target_spend",
        "spend_1_month_ago",
    ),
    "next": Target(
        ("current_month_spend", "spend_1_month_ago", "spend_2_months_ago"),
        "next_smoothed_spend",
        "smoothed_target_spend",
    ),
}


def fill_lags(series: DataFrame) -> DataFrame:
    """Missing history counts as zero spend."""
    return series.na.fill(0.0, subset=list(LAG_COLUMNS))


def training_rows(series: DataFrame, holdout: int = HOLDOUT_MONTHS) -> DataFrame:
    """Filled lags, the three targets, and ``is_test`` for the last months of each client.

    ``next_smoothed_spend`` is null on a client's last month, which nothing can be tested on, so
    ``is_test_next`` marks the last months *with* that target. Every column comes from the same
    (client, month) window: one shuffle and one sort, and train and test need no join.
    """
    months = Window.partitionBy("client_id").orderBy("txn_month")
    smoothed = F.avg(exact(F.col("current_month_spend"))).over(months.rowsBetween(-2, 0))

    def in_last(n: int) -> Column:
        return F.lead(F.lit(1), n).over(months).isNull()

    with_flags = series.select(
        *series.columns,
        cents_from_exact(smoothed).alias("smoothed_target_spend"),
        in_last(holdout).alias("is_test"),
        (in_last(holdout + 1) & ~in_last(1)).alias("is_test_next"),
    )
    return fill_lags(with_flags).withColumn(
        "next_smoothed_spend", F.lead("smoothed_target_spend", 1).over(months)
    )


def holdout_split(rows: DataFrame, target: str = "smoothed") -> tuple[DataFrame, DataFrame]:
    """(train, test) for one target."""
    flag = F.col("is_test_next" if target == "next" else "is_test")
    labelled = rows.filter(F.col(TARGETS[target].label).isNotNull())
    return labelled.filter(~flag), labelled.filter(flag)


def supervised(rows: DataFrame, target: str) -> DataFrame:
    """``client_id, txn_month, <features>, naive, label, is_test`` for one target."""
    spec = TARGETS[target]
    return rows.select(
        "client_id",
        "txn_month",
        *spec.features,
        F.col(spec.naive).alias("naive"),
        F.col(spec.label).alias("label"),
        F.col("is_test_next" if target == "next" else "is_test").alias("is_test"),
    ).filter(F.col("label").isNotNull())


def with_vector(frame: DataFrame, features: Sequence[str]) -> DataFrame:
    return VectorAssembler(inputCols=list(features), outputCol="features").transform(frame)


def absolute_error(label: Column, prediction: Column) -> Column:
    return F.abs(label - prediction)


def percentage_error(label: Column, prediction: Column) -> Column:
    return F.abs(label - prediction) / F.greatest(F.abs(label), F.lit(EPSILON))


def forecast_errors(frame: DataFrame, label: str, prediction: str) -> DataFrame:
    """One row: number of rows, MAE and MAPE."""
    y, p = F.col(label), F.col(prediction)
    return frame.agg(
        F.count(F.lit(1)).alias("rows"),
        F.avg(absolute_error(y, p)).alias("mae"),
        F.avg(percentage_error(y, p)).alias("mape"),
    )


def naive_errors(rows: DataFrame, target: str) -> DataFrame:
    """Error of repeating last month's spend (or, for ``next``, the last smoothed value)."""
    return forecast_errors(supervised(rows, target).filter("is_test"), "label", "naive")


def gbt(trees: int = 100, depth: int = 4, rate: float = 0.1, seed: int = 42) -> GBTRegressor:
    """Boosted trees. Rows walk the shallow tree at hand anew: remembering their nodes costs more jobs than it spares."""
    return GBTRegressor(
        cacheNodeIds=False,
        featuresCol="features",
        labelCol="label",
        predictionCol="prediction",
        maxIter=trees,
        maxDepth=depth,
        stepSize=rate,
        seed=seed,
    )


def fit_forecaster(
    rows: DataFrame, target: str = "smoothed", trees: int = 100, depth: int = 4, rate: float = 0.1
) -> GBTRegressionModel:
    """Boosted trees on the training part, through its :func:`cells`; with a checkpoint folder set, Spark ML
    cuts the lineage of the residuals every ten trees.
    """
    features = TARGETS[target].features
    return fit_cells(gbt(trees, depth, rate), cells(supervised(rows, target).filter("NOT is_test"), features))


def steps(frame: DataFrame, features: Sequence[str], bins: int = BINS) -> list[list[float]]:
    """Up to ``bins`` values of each feature, ascending and at even ranks, found in one pass over all rows.

    Zero, which missing history counts as, is one of them wherever it occurs, and takes no rank of the others.
    """
    ranks = [(i + 0.5) / (bins - 1) for i in range(bins - 1)]

    def found(name: str) -> Column:
        x = F.col(name).cast("double")
        zero = F.when(F.count_if(x == 0) > 0, F.array(F.lit(0.0)))
        others = F.percentile_approx(F.when((x != 0) & ~F.isnan(x), x), ranks)
        empty = F.array().cast("array<double>")
        return F.array_sort(F.array_distinct(F.concat(F.coalesce(zero, empty), F.coalesce(others, empty))))

    return [list(values) for values in frame.agg(*[found(name).alias(name) for name in features]).first()]


def nearest(x: Column, values: Sequence[float], give: Sequence | None = None) -> Column:
    """The nearest of the ascending ``values``, of two the lower, by the midpoints at which Spark ML splits them.

    ``give`` holds what to give in place of each value. Unknown stays unknown.
    """
    give = values if give is None else give

    def found(a: int, b: int) -> Column:
        if b - a <= 1:
            return F.lit(give[a]) if values else F.lit(None)
        half = (a + b) // 2
        return F.when(x <= (values[half - 1] + values[half]) / 2, found(a, half)).otherwise(found(half, b))

    return F.when(x.isNotNull() & ~F.isnan(x), found(0, len(values)))


def cells(frame: DataFrame, features: Sequence[str], bins: int = BINS) -> DataFrame:
    """``features, label, weight``: the rows that no split can tell apart as one, with their mean label and number.

    Trees split a feature halfway between two of its :func:`steps`, so that all rows nearest to the same
    steps go the same way. Of their labels a tree of squared error takes only the sum and the number: fitted
    on the weighted cells it is the tree of all rows. There are at most ``bins`` cells for each
    feature's step, however many rows. They are stored once for all levels of all trees, in partitions
    sized by bytes; unknown features fail as they do in the assembler.
    """
    values = steps(frame, features, bins)

    snapped = [nearest(F.col(f).cast("double"), v).cast("double").alias(f) for f, v in zip(features, values)]
    summed = (
        frame.select(*snapped, "label")
        .groupBy(*features)
        .agg(F.avg("label").alias("label"), F.count(F.lit(1)).cast("double").alias("weight"))
    )
    stored = materialize(with_vector(summed, features).select("features", "label", "weight").hint("rebalance"))
    return stored.coalesce(len(stored.inputFiles()) or 1)


def fit_cells(trees: GBTRegressor, stored: DataFrame) -> GBTRegressionModel:
    """A model of all rows of the cells.

    Spark ML looks for splits in a sample of as many rows as the square of ``maxBins``; here it is all cells,
    whose features have few values, so that each midpoint between two steps is a split.
    """
    bins = max(trees.getMaxBins(), math.ceil(math.sqrt(stored.count())))
    return trees.copy({trees.maxBins: bins, trees.weightCol: "weight"}).fit(stored)


def score(rows: DataFrame, model: GBTRegressionModel, target: str = "smoothed") -> DataFrame:
    """Prediction next to label and naive forecast, for the train and the test part."""
    frame = with_vector(supervised(rows, target), TARGETS[target].features)
    return model.transform(frame).select(
        "client_id", "txn_month", "label", "naive", "prediction", "is_test"
    )


def model_report(scored: DataFrame) -> DataFrame:
    """One row of train and test errors beside the naive forecast, in one pass."""
    y, p, test = F.col("label"), F.col("prediction"), F.col("is_test")
    return scored.agg(
        F.count_if(~test).alias("train_rows"),
        F.count_if(test).alias("test_rows"),
        F.avg(F.when(~test, absolute_error(y, p))).alias("train_mae"),
        F.avg(F.when(test, absolute_error(y, p))).alias("test_mae"),
        F.avg(F.when(test, percentage_error(y, p))).alias("test_mape"),
        F.avg(F.when(test, absolute_error(y, F.col("naive")))).alias("naive_mae"),
    ).withColumn("beats_naive", F.col("test_mae") < F.col("naive_mae"))


def fold_months(rows: DataFrame, folds: int = 3) -> DataFrame:
    """``fold, txn_month, month_rows, is_validation`` for expanding folds over the months.

    The distinct months are cut into ``folds + 1`` equal blocks, the remainder going to the
    first; fold i trains on all months before its block. Rows are counted per month first; the
    unpartitioned ranking sees only the months, of which the calendar has at most 120,000.
    """
    whole = Window.orderBy("txn_month")
    months = (
        rows.filter(F.col("txn_month").isNotNull())
        .groupBy("txn_month")
        .agg(F.count(F.lit(1)).alias("month_rows"))
        .withColumn("position", F.row_number().over(whole))
        .withColumn("months", F.count(F.lit(1)).over(whole.rowsBetween(
            Window.unboundedPreceding, Window.unboundedFollowing)))
        .withColumn("block", F.floor(F.col("months") / (folds + 1)))
        .withColumn("fold", F.explode(F.sequence(F.lit(1), F.lit(folds))))
        .withColumn("train_months", F.col("months") - (folds + 1 - F.col("fold")) * F.col("block"))
    )
    return months.filter(F.col("position") <= F.col("train_months") + F.col("block")).select(
        "fold",
        "txn_month",
        "month_rows",
        (F.col("position") > F.col("train_months")).alias("is_validation"),
    )


def time_folds(rows: DataFrame, folds: int = 3) -> DataFrame:
    """One row per fold: its last training month, validation months, and rows on both sides."""
    validation, month = F.col("is_validation"), F.col("txn_month")
    return (
        fold_months(rows, folds)
        .groupBy("fold")
        .agg(
            F.max(F.when(~validation, month)).alias("train_end"),
            F.min(F.when(validation, month)).alias("test_start"),
            F.max(F.when(validation, month)).alias("test_end"),
            F.sum(F.when(~validation, F.col("month_rows"))).alias("train_rows"),
            F.sum(F.when(validation, F.col("month_rows"))).alias("test_rows"),
        )
    )


# The grid searched by default.
GRID = {"maxDepth": (3, 4, 6), "stepSize": (0.01, 0.1), "maxIter": (100, 200)}


def fit_forecasters(rows: DataFrame, targets: Sequence[str], **options) -> list[GBTRegressionModel]:
    """A model per target, all fitted side by side."""
    pool = ThreadPool(max(1, len(targets)))
    try:
        fit = inheritable_thread_target(rows.sparkSession)(lambda t: fit_forecaster(rows, t, **options))
        return pool.map(fit, targets)
    finally:
        pool.close()


def grow(x: np.ndarray, label: np.ndarray, weight: np.ndarray, depth: int) -> np.ndarray:
    """What a regression tree of the weighted cells predicts for each cell, split as Spark ML splits.

    ``x`` numbers the step of each feature. A node goes by the first of the splits that lessen its variance
    most, and stays whole where none does. Cells without weight only walk the tree.
    """
    bins, node = int(x.max(initial=0)) + 1, np.zeros(len(x), np.int64)
    total = weight * label
    for level in range(depth):
        shape = (1 << level, bins)
        gains = np.full((shape[0], x.shape[1], bins), -np.inf)
        for f in range(x.shape[1]):
            place = node * bins + x[:, f]
            n, s = (np.bincount(place, v, shape[0] * bins).reshape(shape).cumsum(1) for v in (weight, total))
            n_right, s_right = n[:, -1:] - n, s[:, -1:] - s
            both = (n > 0) & (n_right > 0)
            with np.errstate(divide="ignore", invalid="ignore"):
                gain = s**2 / n + s_right**2 / n_right - s[:, -1:] ** 2 / n[:, -1:]
            gains[:, f][both] = gain[both]
        best = gains.reshape(shape[0], -1).argmax(1)
        found = gains.reshape(shape[0], -1)[np.arange(shape[0]), best] > 0
        feature, split = best // bins, best % bins
        node = 2 * node + (found[node] & (x[np.arange(len(x)), feature[node]] > split[node]))
    n, s = (np.bincount(node, v, 1 << depth) for v in (weight, total))
    return (s / np.maximum(n, 1))[node]


def boosted(
    x: np.ndarray, label: np.ndarray, weight: np.ndarray, depth: int, rate: float, trees: Sequence[int]
) -> list[np.ndarray]:
    """Predictions for each cell after each of the ascending numbers of ``trees``, boosted as by :func:`gbt`.

    As in Spark ML the first tree counts whole, and the others, on twice the residual, by ``rate``.
    """
    marks, out = set(trees), []
    p = grow(x, label, weight, depth)
    for tree in range(1, trees[-1] + 1):
        if tree > 1:
            p = p + rate * grow(x, 2 * (label - p), weight, depth)
        if tree in marks:
            out.append(p)
    return out


def _fit_point(part: pa.Table, trees: Sequence[int]) -> pa.Table:
    """The predictions of one depth and rate for the cells of one fold."""
    x = part.column("cell").combine_chunks().flatten().to_numpy().reshape(len(part), -1).astype(np.int64)
    label, weight = (part.column(c).to_numpy() for c in ("label", "weight"))
    depth, rate = (part.column(c)[0].as_py() for c in ("max_depth", "step_size"))
    after = np.stack(boosted(x, label, weight, depth, rate, trees), axis=1)
    kept = part.select(["fold", "cell", "max_depth", "step_size"])
    return kept.append_column("after", pa.array(list(after), pa.list_(pa.float64())))


def grid_search(
    rows: DataFrame,
    target: str = "smoothed",
    grid: dict[str, Sequence] | None = None,
    folds: int = 3,
) -> DataFrame:
    """Mean validation error per grid point, best first: ``max_depth, step_size, trees, mae``.

    Boosting adds trees one by one, so a model of 200 trees contains the one of 100. Each depth,
    rate and fold is therefore fitted once with the largest tree count. What Spark ML's trees can tell
    apart are the :func:`cells` of a fold's training rows, in number bounded by the steps: all rows are
    counted into them, each fit is one task over the cells of its fold instead of a job per level of each
    tree, and every validation row is compared with the predictions of its cell.
    """
    grid = GRID if grid is None else grid
    train, _ = holdout_split(rows, target)
    features = TARGETS[target].features
    frame = materialize(supervised(train, target).select("txn_month", *features, "label"))
    bounds = time_folds(train, folds).collect()  # one row per fold
    if any(fold["test_start"] is None for fold in bounds):
        raise ValueError(f"fewer than {folds + 1} months to cut into folds")
    trees = sorted(set(grid["maxIter"]))
    month = F.col("txn_month")

    def folded(fold) -> DataFrame:
        values = steps(frame.filter(month <= fold["train_end"]), features)
        cell = F.array(*[nearest(F.col(f).cast("double"), v, range(len(v))).cast("int") for f, v in zip(features, values)])
        part = frame.filter(month <= fold["test_end"])
        return part.select(F.lit(fold["fold"]).alias("fold"), cell.alias("cell"), "label", (month > fold["train_end"]).alias("late"))

    parts = reduce(DataFrame.unionByName, [folded(fold) for fold in bounds])
    counted = parts.groupBy("fold", "cell").agg(
        F.coalesce(F.avg(F.when(~F.col("late"), F.col("label"))), F.lit(0.0)).alias("label"),
        F.count_if(~F.col("late")).cast("double").alias("weight"),
    )
    points = [F.struct(F.lit(int(d)).alias("max_depth"), F.lit(float(r)).alias("step_size")) for d, r in product(grid["maxDepth"], grid["stepSize"])]
    key = ["fold", "max_depth", "step_size"]
    fitted = (
        counted.select("*", F.inline(F.array(*points)))
        .repartition(len(points) * len(bounds), *key)
        .groupBy(*key)
        .applyInArrow(
            lambda part: _fit_point(part, trees),
            "fold int, cell array<int>, max_depth int, step_size double, after array<double>",
        )
        .groupBy("fold", "cell")
        .agg(F.collect_list(F.struct("max_depth", "step_size", "after")).alias("models"))  # one per point
    )
    scored = (
        parts.filter("late")
        .join(fitted, ["fold", "cell"])
        .select("fold", "label", F.inline("models"))
        .select("fold", "label", "max_depth", "step_size", F.posexplode("after").alias("place", "prediction"))
        .groupBy("fold", "max_depth", "step_size", F.element_at(F.lit(trees), F.col("place") + 1).alias("trees"))
        .agg(F.avg(absolute_error(F.col("label"), F.col("prediction"))).alias("fold_mae"))
    )
    # one row per point, fold and number of trees, stored: fitted once, however often the scores are read
    return (
        materialize(scored).groupBy("max_depth", "step_size", "trees")
        .agg(F.avg("fold_mae").alias("mae"))
        .orderBy("mae", "max_depth", "step_size", "trees")
    )


def refit_best(rows: DataFrame, scores: DataFrame, target: str = "smoothed") -> GBTRegressionModel:
    """The model of the best grid point, fitted on the whole training part."""
    best = scores.orderBy("mae", "max_depth", "step_size", "trees").first()
    return fit_forecaster(
        rows, target, trees=best["trees"], depth=best["max_depth"], rate=best["step_size"]
    )


def save_model(model: GBTRegressionModel, path: str) -> None:
    model.write().overwrite().save(path)


def load_model(path: str) -> GBTRegressionModel:
    return GBTRegressionModel.load(path)


def load_model_if_saved(spark: SparkSession, path: str) -> GBTRegressionModel | None:
    """The saved model, or None while there is none."""
    return load_model(path) if table_exists(spark, f"{path}/data") else None


def record_run(
    report: DataFrame, path: str, run_name: str, params: dict, fmt: str = DEFAULT_FORMAT
) -> None:
    """Append a report with its run name, time and parameters to the table of model runs."""
    row = report.select(
        F.lit(run_name).alias("run_name"),
        F.current_timestamp().alias("run_at"),
        F.create_map(*[F.lit(str(x)) for pair in params.items() for x in pair]).alias("params")
        if params
        else F.lit(None).cast("map<string,string>").alias("params"),
        "*",
    )
    write_table(row, path, fmt, mode="append")


def model_forecast(
    model: GBTRegressionModel, target: str = "smoothed"
) -> Callable[[DataFrame], DataFrame]:
    """Scorer for :func:`spendlake.operators.serve.advisor_plan`; unknown lags count as zero."""
    features = TARGETS[target].features

    def forecast(requests: DataFrame) -> DataFrame:
        filled = requests.na.fill(0.0, subset=list(features))
        return model.transform(with_vector(filled, features)).drop(
            "features", "rawPrediction", "probability"
        )

    return forecast
