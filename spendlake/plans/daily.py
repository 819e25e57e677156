"""The daily refresh: raw files to silver and gold tables, each stage a table-to-table job."""

from __future__ import annotations

import logging
from collections.abc import Collection
from typing import NamedTuple

from pyspark.ml.regression import GBTRegressionModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from spendlake.operators.allocate import portfolio_recommendations
from spendlake.operators.enrich import add_category
from spendlake.functions import month_label, month_start
from spendlake.operators.forecast import (
    fit_forecaster,
    load_model,
    load_model_if_saved,
    model_forecast,
    model_report,
    record_run,
    save_model,
    score,
    TARGETS,
    training_rows,
)
from spendlake.operators.monthly import client_months, time_series_features
from spendlake.operators.profile import user_portfolio_features
from spendlake.operators.rejects import (
    TRANSACTION_REASONS,
    USER_REASONS,
    accepted_transactions,
    accepted_users,
    judge_transactions,
    judge_users,
    reason_table,
    write_counting,
)
from spendlake.operators.serve import advisor_plan, client_snapshots
from spendlake.session import materialize, shuffle_partitions_for, stored_bytes
from spendlake.sources import (
    read_mcc_json,
    read_table,
    read_transaction_lines,
    read_user_lines,
    write_table,
)
from spendlake.sources.lake import DEFAULT_FORMAT, write_bucketed
from spendlake.streaming import RollupTables, stream_client_months


log = logging.getLogger(__name__)


class Lake(NamedTuple):
    """Where the tables of one lake live."""

    root: str
    fmt: str = DEFAULT_FORMAT

    def path(self, table: str) -> str:
        return f"{self.root.rstrip('/')}/{table}"

    def read(self, spark: SparkSession, table: str) -> DataFrame:
        return read_table(spark, self.path(table), self.fmt)

    def write(self, df: DataFrame, table: str, **options) -> None:
        write_table(df, self.path(table), self.fmt, **options)


SILVER_TRANSACTIONS = "silver/transactions"
SILVER_USERS = "silver/users"
TRANSACTION_COUNTS = "silver/transactions_counts"
USER_COUNTS = "silver/users_counts"
CLIENT_MONTHS = "gold/client_months"
MONTH_PARTS = "gold/client_month_parts"
ROLLUP_CHECKPOINT = "checkpoints/client_months"
USER_FEATURES = "gold/user_portfolio_features"
TIME_SERIES = "gold/time_series_features"
RECOMMENDATIONS = "gold/portfolio_recommendations"
ADVISOR_PLAN = "gold/advisor_plan"
MODEL = "models/spend_forecaster"
MODEL_RUNS = "models/runs"


def refresh_transactions(
    spark: SparkSession,
    csv_path: str,
    mcc_path: str,
    lake: Lake,
    parse_dates: bool = False,
    by_month: bool = False,
) -> None:
    """Raw transaction files to the silver table: one pass, no shuffle.

    ``by_month`` stores it partitioned by ``txn_month``, rebalanced so that a hot month becomes
    several files, for readers that look at a span of months. Beside the table stands how many raw
    rows were taken and how many dropped for which reason, counted in the same pass.
    """
    lines = add_category(read_transaction_lines(spark, csv_path), read_mcc_json(spark, mcc_path))

    def write(judged: DataFrame) -> None:
        silver = accepted_transactions(judged, parse_dates)
        if by_month:
            month = month_label(month_start(F.col("date"), text=not parse_dates))
            lake.write(silver.withColumn("txn_month", month), SILVER_TRANSACTIONS, partition_by=["txn_month"])
        else:
            lake.write(silver, SILVER_TRANSACTIONS)

    counts = write_counting(judge_transactions(lines), TRANSACTION_REASONS, write)
    lake.write(reason_table(spark, counts).coalesce(1), TRANSACTION_COUNTS)


def refresh_users(spark: SparkSession, csv_path: str, lake: Lake) -> None:
    """Raw user files to the silver table, with the counts of dropped rows beside it."""

    def write(judged: DataFrame) -> None:
        lake.write(accepted_users(judged), SILVER_USERS)

    counts = write_counting(judge_users(read_user_lines(spark, csv_path)), USER_REASONS, write)
    lake.write(reason_table(spark, counts).coalesce(1), USER_COUNTS)


def rollup_tables(lake: Lake) -> RollupTables:
    """The tables that the incremental roll-up keeps in a lake."""
    paths = (lake.path(t) for t in (SILVER_TRANSACTIONS, MONTH_PARTS, CLIENT_MONTHS))
    return RollupTables(*paths, lake.fmt)


def refresh_rollup(
    spark: SparkSession, csv_folder: str, mcc_path: str, lake: Lake, parse_dates: bool = False
) -> RollupTables:
    """Take the raw files that are new since the last run into silver and into the months they touch."""
    tables = rollup_tables(lake)
    run = stream_client_months(
        spark, csv_folder, lambda session: read_mcc_json(session, mcc_path), tables,
        lake.path(ROLLUP_CHECKPOINT), parse_dates,
    )
    run.awaitTermination()
    return tables


def refresh_client_months(
    spark: SparkSession, lake: Lake, bucketed_as: str | None = None, buckets: int | None = None
) -> DataFrame:
    """The roll-up both gold tables need, computed once from silver.

    With ``bucketed_as`` it becomes a catalog table bucketed by client, and the gold jobs group,
    window and join it without another shuffle. Safe against hot clients: a client has one row
    per month here. The number of buckets follows from the bytes of the roll-up, unless given.
    """
    months = client_months(lake.read(spark, SILVER_TRANSACTIONS))
    if bucketed_as:
        if buckets is None:
            months = materialize(months)
            buckets = shuffle_partitions_for(stored_bytes(months))
        return write_bucketed(
            months,
            bucketed_as,
            lake.path(CLIENT_MONTHS),
            buckets,
            keys=["client_id"],
            sort=["client_id", "month_start"],
        )
    lake.write(months, CLIENT_MONTHS)
    return lake.read(spark, CLIENT_MONTHS)


def refresh_user_features(spark: SparkSession, months: DataFrame, lake: Lake) -> None:
    lake.write(user_portfolio_features(lake.read(spark, SILVER_USERS), months), USER_FEATURES)


def refresh_time_series(months: DataFrame, lake: Lake, min_history: int = 0) -> None:
    lake.write(time_series_features(months, min_history), TIME_SERIES)


def refresh_recommendations(spark: SparkSession, lake: Lake) -> None:
    """An allocation for every user of the gold table, with its inputs, return and risk."""
    lake.write(portfolio_recommendations(lake.read(spark, USER_FEATURES)), RECOMMENDATIONS)


def refresh_forecaster(
    spark: SparkSession,
    lake: Lake,
    target: str = "smoothed",
    trees: int = 200,
    depth: int = 6,
    rate: float = 0.1,
) -> GBTRegressionModel:
    """Train on the stored series, save the model, and append its errors to the run table.

    The errors are those of the model as loaded back; the fitted one is returned.
    """
    rows_path = "models/training_rows"
    lake.write(training_rows(lake.read(spark, TIME_SERIES)), rows_path)
    rows = lake.read(spark, rows_path)
    model = fit_forecaster(rows, target, trees, depth, rate)
    save_model(model, lake.path(MODEL))
    params = {"target": target, "trees": trees, "depth": depth, "rate": rate}
    report = model_report(score(rows, load_model(lake.path(MODEL)), target))
    record_run(report, lake.path(MODEL_RUNS), "spend_forecaster", params, lake.fmt)
    return model


def refresh_advisor(spark: SparkSession, lake: Lake) -> bool:
    """Plan with the saved model, without training; false, with a warning, where it cannot be used."""
    model = load_model_if_saved(spark, lake.path(MODEL))
    if model is None:
        log.warning("no saved model at %s: no plan written", lake.path(MODEL))
        return False
    if model.numFeatures != len(TARGETS["smoothed"].features):
        log.warning("the saved model needs lags that a snapshot does not carry: no plan written")
        return False
    snapshots = client_snapshots(lake.read(spark, TIME_SERIES), lake.read(spark, USER_FEATURES))
    lake.write(advisor_plan(snapshots, model_forecast(model)), ADVISOR_PLAN)
    return True


#: Run only when named.
MODEL_STAGES = ("forecaster", "advisor")
STAGES = (
    "transactions",
    "users",
    "client_months",
    "user_features",
    "recommendations",
    "time_series",
)


def run_pipeline(
    spark: SparkSession,
    transactions_csv: str,
    users_csv: str,
    mcc_json: str,
    out: str,
    fmt: str = DEFAULT_FORMAT,
    bucketed_as: str | None = None,
    buckets: int | None = None,
    stages: Collection[str] = STAGES,
    parse_dates: bool = False,
    by_month: bool = False,
    min_history: int = 0,
    target: str = "smoothed",
    trees: int = 200,
    depth: int = 6,
    incremental: bool = False,
) -> Lake:
    """All tables, or those of the named stages, in dependency order.

    With ``incremental`` the transactions are a folder that files are added to: one stream takes the new
    ones into silver and the roll-up, in place of the first and the third stage. It excludes
    ``bucketed_as`` and ``by_month``.

    ``forecaster`` and ``advisor`` are stages as well, which run only when named: one trains and
    saves the model, the other plans with whichever model is saved.

    A stage reads only tables that earlier stages committed and replaces its own, so a failed run
    is repeated from the stage that failed.
    """
    unknown = set(stages) - {*STAGES, *MODEL_STAGES}
    if unknown:
        raise ValueError(f"unknown stages: {sorted(unknown)}")
    if incremental and (bucketed_as or by_month):
        raise ValueError("the incremental roll-up is stored by batch and month, neither bucketed nor otherwise")
    lake = Lake(out, fmt)

    def months() -> DataFrame:
        if incremental:
            return rollup_tables(lake).read_months(spark)
        return spark.table(bucketed_as) if bucketed_as else lake.read(spark, CLIENT_MONTHS)

    if incremental and {"transactions", "client_months"} & set(stages):
        refresh_rollup(spark, transactions_csv, mcc_json, lake, parse_dates)
        stages = set(stages) - {"transactions", "client_months"}
    if "transactions" in stages:
        refresh_transactions(spark, transactions_csv, mcc_json, lake, parse_dates, by_month)
    if "users" in stages:
        refresh_users(spark, users_csv, lake)
    if "client_months" in stages:
        refresh_client_months(spark, lake, bucketed_as, buckets)
    if "user_features" in stages:
        refresh_user_features(spark, months(), lake)
    if "recommendations" in stages:
        refresh_recommendations(spark, lake)
    if "time_series" in stages:
        refresh_time_series(months(), lake, min_history)
    if "forecaster" in stages:
        refresh_forecaster(spark, lake, target, trees, depth)
    if "advisor" in stages:
        refresh_advisor(spark, lake)
    return lake


__all__ = [
    "MODEL_STAGES",
    "STAGES",
    "Lake",
    "refresh_advisor",
    "refresh_client_months",
    "refresh_forecaster",
    "refresh_recommendations",
    "refresh_rollup",
    "refresh_time_series",
    "refresh_transactions",
    "refresh_user_features",
    "refresh_users",
    "rollup_tables",
    "run_pipeline",
]
