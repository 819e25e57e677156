"""Every operator as a named query over the shared test tables.

Each query runs over whole tables. Those that read raw files first write the tables as such files
to the shared scratch folder, so their work grows with the tables too.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from spendlake.functions import is_number, month_label, parse_timestamp
from spendlake.operators import allocate, assortment, cleaning, enrich, forecast, frontier, monthly, profile, rejects, serve, sketches
from spendlake.plans import daily, testdata
from spendlake.schemas import BRONZE_USERS, USER_PORTFOLIO_FEATURES
from spendlake.session import materialize, scratch_dir, settings, shuffles_freed
from spendlake.sources import (
    look_up,
    read_inferred_csv,
    read_mcc_json,
    read_table,
    read_table_or_empty,
    read_transaction_lines,
    read_transactions_csv,
    read_user_lines,
    read_users_csv,
    write_clustered,
    write_table,
)
from spendlake.sources.files import drop_mistyped
from spendlake.streaming import (
    add_batch,
    stream_distinct_transactions,
    stream_silver_transactions,
)

Query = Callable[[SparkSession, str], DataFrame]

def _round6(df: DataFrame, *columns: str) -> DataFrame:
    return df.withColumns({c: F.round(c, 6) for c in columns})


# -- shared inputs -----------------------------------------------------------------------------


def _spend_rows(spark: SparkSession, sf: str) -> DataFrame:
    return testdata.silver_transactions(spark, sf, "id", "client_id", "date", "amount")


def _category_rows(spark: SparkSession, sf: str) -> DataFrame:
    return testdata.silver_transactions(
        spark, sf, "id", "client_id", "date", "amount", "category_name"
    )


def _months(spark: SparkSession, sf: str, with_category: bool = True) -> DataFrame:
    rows = _category_rows(spark, sf) if with_category else _spend_rows(spark, sf)
    return monthly.client_months(rows)


def _series(spark: SparkSession, sf: str) -> DataFrame:
    return monthly.time_series_features(_months(spark, sf, with_category=False))


def _features(spark: SparkSession, sf: str, with_category: bool = True) -> DataFrame:
    return profile.user_portfolio_features(
        testdata.silver_users(spark, sf), _months(spark, sf, with_category)
    )


def _training(spark: SparkSession, sf: str) -> DataFrame:
    return materialize(forecast.training_rows(_series(spark, sf)))


def _requests(spark: SparkSession, sf: str) -> DataFrame:
    """Snapshots of all clients from one pass over the roll-up."""
    return serve.snapshots_from_months(
        testdata.silver_users(spark, sf), _months(spark, sf, with_category=False)
    ).select(
        "client_id",
        "monthly_income",
        F.col("risk_tolerance_score").alias("risk_score"),
        "investment_horizon",
        "current_month_spend",
        "spend_1_month_ago",
        "spend_2_months_ago",
    )


def _csv(df: DataFrame) -> str:
    """Raw files without quotes, so that a comma in a value makes a line too long."""
    path = scratch_dir(df.sparkSession)
    df.write.csv(path, header=True, quote="\u0000")
    return path


def _mcc_file(spark: SparkSession) -> str:
    path = scratch_dir(spark)
    text = json.dumps(testdata.CATEGORY_OF_PART_TYPE)
    spark.createDataFrame([(text,)], "value string").coalesce(1).write.text(path)
    return path


# -- sources and sinks -------------------------------------------------------------------------


def csv_transactions(spark: SparkSession, sf: str) -> DataFrame:
    return read_transactions_csv(spark, _csv(testdata.dirty_transactions(spark, sf)))


def csv_users(spark: SparkSession, sf: str) -> DataFrame:
    return cleaning.clean_users(
        read_users_csv(spark, _csv(testdata.dirty_users(spark, sf)))
    )


def csv_inferred(spark: SparkSession, sf: str) -> DataFrame:
    return read_inferred_csv(spark, _csv(testdata.bronze_users(spark, sf)))


def rejected_transactions(spark: SparkSession, sf: str) -> DataFrame:
    """Raw transactions by why cleaning drops them, counted while the silver table is written."""
    lake = daily.Lake(scratch_dir(spark))
    raw = _csv(testdata.dirty_transactions(spark, sf))
    daily.refresh_transactions(spark, raw, _mcc_file(spark), lake)
    return lake.read(spark, daily.TRANSACTION_COUNTS).filter("rows > 0")


def rejected_users(spark: SparkSession, sf: str) -> DataFrame:
    """Raw users by why cleaning drops them."""
    lake = daily.Lake(scratch_dir(spark))
    daily.refresh_users(spark, _csv(testdata.dirty_users(spark, sf)), lake)
    return lake.read(spark, daily.USER_COUNTS).filter("rows > 0")


def transactions_judged(spark: SparkSession, sf: str) -> DataFrame:
    """Every raw transaction that fits the schema or not, with the reason for which it goes."""
    lines = read_transaction_lines(spark, _csv(testdata.dirty_transactions(spark, sf)))
    return rejects.judge_transactions(lines).filter("reason IS NOT NULL").select("date", "card_id", "reason")


def users_judged(spark: SparkSession, sf: str) -> DataFrame:
    """Every raw user that cleaning drops, with the reason."""
    lines = read_user_lines(spark, _csv(testdata.dirty_users(spark, sf)))
    return rejects.judge_users(lines).filter("reason IS NOT NULL").select("address", "reason")


def csv_to_silver(spark: SparkSession, sf: str) -> DataFrame:
    lake = daily.Lake(scratch_dir(spark))
    raw = _csv(testdata.dirty_transactions(spark, sf))
    daily.refresh_transactions(spark, raw, _mcc_file(spark), lake)
    return lake.read(spark, daily.SILVER_TRANSACTIONS)


def table_overwrite(spark: SparkSession, sf: str) -> DataFrame:
    """A table written, replaced and read back."""
    path = scratch_dir(spark)
    spend = monthly.monthly_spend(_months(spark, sf, with_category=False))
    write_table(spend.filter("current_month_spend > 1000"), path)
    write_table(spend, path)
    return read_table(spark, path)


def table_partitioned(spark: SparkSession, sf: str) -> DataFrame:
    """Silver transactions stored by month, rebalanced so that a hot month is split."""
    path = scratch_dir(spark)
    rows = testdata.silver_transactions(spark, sf)
    rows = rows.withColumn("txn_month", month_label(F.col("date")))
    rows = rows.withColumn("date", F.date_format("date", "yyyy-MM-dd HH:mm:ss"))
    write_table(rows, path, partition_by=["txn_month"])
    return read_table(spark, path).withColumn("txn_month", F.col("txn_month").cast("string"))


def snapshot_of_missing_profiles(spark: SparkSession, sf: str) -> DataFrame:
    """Clients without a profile: before its table is written, and after one without some users."""
    path, series = scratch_dir(spark), materialize(_series(spark, sf))

    def lacking(state: str) -> DataFrame:
        profiles = read_table_or_empty(spark, path, USER_PORTFOLIO_FEATURES)
        return serve.clients_without_profile(series, profiles).withColumn("profiles", F.lit(state))

    before = lacking("none yet")
    users = cleaning.clean_users(drop_mistyped(testdata.dirty_users(spark, sf), BRONZE_USERS))
    write_table(profile.user_portfolio_features(users, _months(spark, sf)), path)
    return before.unionByName(lacking("written"))


# -- cleaning and enrichment -------------------------------------------------------------------


def silver_transactions(spark: SparkSession, sf: str) -> DataFrame:
    raw = testdata.dirty_transactions(spark, sf)
    return cleaning.clean_transactions(enrich.add_category(raw, testdata.mcc_codes(spark)))


def silver_transactions_salted(spark: SparkSession, sf: str) -> DataFrame:
    """The same table by the join used for a dictionary too large to broadcast."""
    raw = testdata.dirty_transactions(spark, sf)
    return cleaning.clean_transactions(enrich.add_category(raw, testdata.mcc_codes(spark), small=False))


def silver_users(spark: SparkSession, sf: str) -> DataFrame:
    return testdata.silver_users(spark, sf)


def timestamps_parsed(spark: SparkSession, sf: str) -> DataFrame:
    raw = testdata.bronze_transactions(spark, sf)
    parsed = raw.select("id", parse_timestamp(F.col("date")).alias("date"))
    return parsed.withColumn("date", F.date_format("date", "yyyy-MM-dd HH:mm:ss"))


def _contract_input(spark: SparkSession, sf: str) -> DataFrame:
    """Orders as records: some status and priority pairs stand for a missing id or a bad date."""
    status, priority = F.col("o_orderstatus"), F.col("o_orderpriority")
    no_id = (status == "P") & (priority == "5-LOW")
    no_date = (status == "O") & (priority == "2-HIGH")
    ordered = F.date_format("o_orderdate", "yyyy-MM-dd HH:mm:ss")
    return testdata.table(spark, sf, "orders").select(
        F.when(~no_id, F.col("o_orderkey").cast("string")).alias("transaction_id"),
        F.when(no_date, "no date").otherwise(ordered).alias("date"),
        (F.col("o_totalprice") * 4).cast("decimal(18,2)").cast("string").alias("amount"),
        F.concat(F.lit("\t "), F.lower(priority), F.lit(" \n")).alias("merchant_name"),
        F.when(status != "F", status).alias("category"),
    )


def contract_valid(spark: SparkSession, sf: str) -> DataFrame:
    valid = cleaning.store_contract(_contract_input(spark, sf), scratch_dir(spark)).valid
    return valid.withColumn("date", F.date_format("date", "yyyy-MM-dd HH:mm:ss"))


def contract_rejected(spark: SparkSession, sf: str) -> DataFrame:
    return cleaning.store_contract(_contract_input(spark, sf), scratch_dir(spark)).rejected


def discretionary_tags(spark: SparkSession, sf: str) -> DataFrame:
    tagged = monthly.tag_discretionary(monthly.expenses(_category_rows(spark, sf)))
    return tagged.select("id", "category_name", "expense_amount", "is_discretionary")


def transactions_with_users(spark: SparkSession, sf: str) -> DataFrame:
    return _with_users(spark, sf)


def transactions_with_users_salted(spark: SparkSession, sf: str) -> DataFrame:
    return _with_users(spark, sf, salts=8)


def _with_users(spark: SparkSession, sf: str, **options) -> DataFrame:
    """All columns of both sides; users that cleaning dropped leave nulls."""
    rows = testdata.silver_transactions(spark, sf)
    rows = rows.withColumn("date", F.date_format("date", "yyyy-MM-dd HH:mm:ss"))
    users = cleaning.clean_users(drop_mistyped(testdata.dirty_users(spark, sf), BRONZE_USERS))
    return enrich.add_users(rows, users, **options)


# -- aggregates and windows --------------------------------------------------------------------


def monthly_spend(spark: SparkSession, sf: str) -> DataFrame:
    return monthly.monthly_spend(_months(spark, sf, with_category=False))


def time_series_features(spark: SparkSession, sf: str) -> DataFrame:
    return _series(spark, sf)


def time_series_min_history(spark: SparkSession, sf: str) -> DataFrame:
    return monthly.time_series_features(_months(spark, sf, with_category=False), min_history=2)


def smoothed_spend(spark: SparkSession, sf: str) -> DataFrame:
    return monthly.smoothed_spend(monthly.monthly_spend(_months(spark, sf, with_category=False)))


def calendar_features(spark: SparkSession, sf: str) -> DataFrame:
    """Lags and mean by the calendar, months without spending being gaps."""
    return monthly.calendar_features(_months(spark, sf, with_category=False))


def calendar_features_filled(spark: SparkSession, sf: str) -> DataFrame:
    """The same, months without spending counting as zero."""
    return monthly.calendar_features(_months(spark, sf, with_category=False), absent_is_zero=True)


def client_net_amount(spark: SparkSession, sf: str) -> DataFrame:
    return monthly.client_net_amount(
        testdata.silver_transactions(spark, sf, "client_id", "amount")
    )


def distinct_clients_by_year(spark: SparkSession, sf: str) -> DataFrame:
    """Distinct clients and merchants per year from stored sketches of months, beside the exact counts."""
    rows = testdata.silver_transactions(spark, sf, "date", "client_id", "merchant_id")
    stored = materialize(sketches.monthly_sketches(rows, "client_id", "merchant_id"))
    year = F.year("month_start").alias("year")
    estimates = sketches.united(stored, year, "client_id", "merchant_id")
    exact = rows.groupBy(F.year("date").alias("year")).agg(
        F.count_distinct("client_id").alias("clients"), F.count_distinct("merchant_id").alias("merchants")
    )
    return estimates.join(exact, "year").select(
        "year", "rows", "clients", "merchants",
        sketches.within_error(F.col("distinct_client_id"), F.col("clients")).alias("clients_within_error"),
        sketches.within_error(F.col("distinct_merchant_id"), F.col("merchants")).alias("merchants_within_error"),
    )


def client_spend_totals(spark: SparkSession, sf: str) -> DataFrame:
    return monthly.client_spend_totals(_months(spark, sf))


def category_spend_profile(spark: SparkSession, sf: str) -> DataFrame:
    return monthly.category_spend(
        testdata.silver_transactions(spark, sf, "amount", "category_name")
    )


def top_transactions(spark: SparkSession, sf: str) -> DataFrame:
    rows = testdata.silver_transactions(spark, sf, "id", "client_id", "amount")
    return monthly.top_rows(rows, "amount", 5, tie_break="id")


# -- user features -----------------------------------------------------------------------------


def user_portfolio_features(spark: SparkSession, sf: str) -> DataFrame:
    return _round6(
        _features(spark, sf), "avg_monthly_spend", "avg_monthly_discretionary", "monthly_income"
    )


def top_discretionary_users(spark: SparkSession, sf: str) -> DataFrame:
    top = monthly.top_rows(
        _features(spark, sf), "avg_monthly_discretionary", 50, tie_break="client_id"
    )
    return _round6(
        top.select("client_id", "avg_monthly_discretionary", "risk_tolerance_score"),
        "avg_monthly_discretionary",
    )


# -- allocation --------------------------------------------------------------------------------


def portfolio_recommendations(spark: SparkSession, sf: str) -> DataFrame:
    return allocate.portfolio_recommendations(_features(spark, sf, with_category=False))


def allocation_statuses(spark: SparkSession, sf: str) -> DataFrame:
    """Requests that are optimal, without budget, infeasible, or short of an input."""
    planned = allocate.allocate(testdata.allocation_requests(spark, sf), "budget", "risk", "horizon")
    return planned.drop("budget", "risk", "horizon")


def allocation_rows(spark: SparkSession, sf: str) -> DataFrame:
    return allocate.allocation_rows(portfolio_recommendations(spark, sf))


def positive_allocations(spark: SparkSession, sf: str) -> DataFrame:
    return allocate.positive_allocations(allocation_rows(spark, sf))


def portfolio_return_and_risk(spark: SparkSession, sf: str) -> DataFrame:
    rows = allocate.positive_allocations(allocation_rows(spark, sf))
    return allocate.return_and_risk_of_rows(rows)


def _held(spark: SparkSession, sf: str, small: bool) -> DataFrame:
    requests = testdata.allocation_requests(spark, sf)
    return frontier.allocate_from(requests, testdata.part_assets(spark, sf), "budget", "risk", "horizon", small)


def any_asset_holdings(spark: SparkSession, sf: str) -> DataFrame:
    """Budgets spread over assets that are rows of a table."""
    return frontier.holding_rows(_held(spark, sf, small=True))


def any_asset_return_and_risk(spark: SparkSession, sf: str) -> DataFrame:
    """The same by the join used for edges too large to broadcast."""
    expected = frontier.add_expected(_held(spark, sf, small=False))
    return expected.select("client_id", "status", "expected_annual_return", "expected_annual_risk")


def card_offers(spark: SparkSession, sf: str) -> DataFrame:
    offers = allocate.offer_cards(testdata.silver_users(spark, sf)).select(
        F.col("id").alias("client_id"), "risk_budget", "status", "bundle", "revenue", "risk_cost"
    )
    return _round6(offers, "risk_budget")


def any_card_offers(spark: SparkSession, sf: str) -> DataFrame:
    """Bundles of up to three of thirty products that are rows of a table."""
    bundles = assortment.product_bundles(*testdata.part_products(spark, sf), max_cards=3)
    offers = assortment.offer_bundles(testdata.silver_users(spark, sf), bundles).select(
        F.col("id").alias("client_id"), "risk_budget", "status", "bundle", "revenue", "risk_cost"
    )
    return _round6(offers, "risk_budget")


# -- serving -----------------------------------------------------------------------------------


def client_ids(spark: SparkSession, sf: str) -> DataFrame:
    return serve.client_ids(monthly_spend(spark, sf))


def table_counts(spark: SparkSession, sf: str) -> DataFrame:
    months = materialize(_months(spark, sf, with_category=False))
    users = testdata.silver_users(spark, sf)
    return serve.table_counts(monthly.monthly_spend(months), profile.user_portfolio_features(users, months))


def latest_month(spark: SparkSession, sf: str) -> DataFrame:
    return serve.latest_month(_series(spark, sf))


def client_snapshots(spark: SparkSession, sf: str) -> DataFrame:
    """Snapshots joined from the two stored gold tables, as the serving side reads them."""
    lake = daily.Lake(scratch_dir(spark))
    months = materialize(_months(spark, sf, with_category=False))
    daily.refresh_time_series(months, lake)
    lake.write(
        profile.user_portfolio_features(testdata.silver_users(spark, sf), months), daily.USER_FEATURES
    )
    snapshots = serve.client_snapshots(
        lake.read(spark, daily.TIME_SERIES), lake.read(spark, daily.USER_FEATURES)
    )
    return _round6(snapshots, "monthly_income")


def client_snapshots_as_of(spark: SparkSession, sf: str) -> DataFrame:
    """Snapshots of clients as they stood in the months of their pending orders."""
    orders = testdata.table(spark, sf, "orders").filter("o_orderstatus = 'P'")
    asks = orders.select(
        F.col("o_custkey").cast("string").alias("client_id"), month_label(F.add_months("o_orderdate", -1)).alias("as_of_month")
    )
    months = materialize(_months(spark, sf, with_category=False))
    profiles = profile.user_portfolio_features(testdata.silver_users(spark, sf), months)
    return _round6(serve.client_snapshots_as_of(asks, monthly.time_series_features(months), profiles), "monthly_income")


def client_lookup(spark: SparkSession, sf: str) -> DataFrame:
    """The series of one client, the first by id, out of files clustered by client."""
    path, series = scratch_dir(spark), _series(spark, sf)
    write_clustered(series, path, "client_id", ["txn_month"], files=16)
    first = read_table(spark, path).agg(F.min("client_id")).first()[0]  # one value
    return look_up(spark, path, "client_id", first, series.schema)


def client_snapshots_one_pass(spark: SparkSession, sf: str) -> DataFrame:
    return _round6(_requests(spark, sf), "monthly_income")


def clients_without_history(spark: SparkSession, sf: str) -> DataFrame:
    """Users that did not spend in the first year on record."""
    users = testdata.silver_users(spark, sf).select("id")
    first_year = monthly_spend(spark, sf).filter("txn_month < '1993-01'")
    return serve.clients_without_history(first_year, users)


def client_histories(spark: SparkSession, sf: str) -> DataFrame:
    return serve.ordered_histories(serve.client_histories(_series(spark, sf)))


def spend_trend(spark: SparkSession, sf: str) -> DataFrame:
    return serve.spend_trend(_series(spark, sf))


def top_spender_history(spark: SparkSession, sf: str) -> DataFrame:
    """All months of the client with the highest total spend, looked up by id."""
    months = _months(spark, sf, with_category=False)
    totals = months.groupBy("client_id").agg(F.sum("spend").alias("total"))
    top = monthly.top_rows(totals, "total", 1, tie_break="client_id").select("client_id")
    # one row
    chosen = months.join(F.broadcast(top), "client_id", "left_semi")
    return serve.ordered_histories(serve.client_histories(monthly.time_series_features(chosen)))


def advisor_plan(spark: SparkSession, sf: str) -> DataFrame:
    return _round6(serve.advisor_plan(_requests(spark, sf)), "monthly_income")


def advisor_responses(spark: SparkSession, sf: str) -> DataFrame:
    """The nested response of every client, its fields side by side."""
    nested = serve.advisor_response(advisor_plan(spark, sf))
    return nested.select("client_id", "financial_forecast.*", "recommended_action.*")


def advisor_display(spark: SparkSession, sf: str) -> DataFrame:
    return serve.display_plan(serve.advisor_plan(_requests(spark, sf)))


# -- forecasting -------------------------------------------------------------------------------


def lags_filled(spark: SparkSession, sf: str) -> DataFrame:
    return forecast.fill_lags(_series(spark, sf))


def holdout_split(spark: SparkSession, sf: str) -> DataFrame:
    return forecast.training_rows(_series(spark, sf)).select(
        "client_id", "txn_month", "smoothed_target_spend", "next_smoothed_spend",
        "is_test", "is_test_next",
    )


def supervised_raw(spark: SparkSession, sf: str) -> DataFrame:
    return forecast.supervised(forecast.training_rows(_series(spark, sf)), "raw")


def supervised_smoothed(spark: SparkSession, sf: str) -> DataFrame:
    return forecast.supervised(forecast.training_rows(_series(spark, sf)), "smoothed")


def supervised_next(spark: SparkSession, sf: str) -> DataFrame:
    return forecast.supervised(forecast.training_rows(_series(spark, sf)), "next")


def naive_errors(spark: SparkSession, sf: str) -> DataFrame:
    """Error of the naive forecast for all three targets."""
    rows = _training(spark, sf)
    parts = [
        forecast.naive_errors(rows, target).withColumn("target", F.lit(target))
        for target in forecast.TARGETS
    ]
    return _round6(reduce(DataFrame.unionByName, parts), "mae", "mape")


def time_folds(spark: SparkSession, sf: str) -> DataFrame:
    train, _ = forecast.holdout_split(forecast.training_rows(_series(spark, sf)))
    return forecast.time_folds(train)


def forecast_scores(spark: SparkSession, sf: str) -> DataFrame:
    """Every row that got a number as its prediction."""
    rows = _training(spark, sf)
    scored = forecast.score(rows, forecast.fit_forecaster(rows, "smoothed"), "smoothed")
    return scored.filter(is_number(F.col("prediction"))).drop("prediction")


def forecast_report(spark: SparkSession, sf: str) -> DataFrame:
    """Model against naive forecast for each target; the errors themselves vary with the trees."""
    rows = _training(spark, sf)
    parts = []
    models = forecast.fit_forecasters(rows, list(forecast.TARGETS))
    for target, model in zip(forecast.TARGETS, models):
        report = forecast.model_report(forecast.score(rows, model, target))
        parts.append(report.withColumn("target", F.lit(target)))
    reports = reduce(DataFrame.unionByName, parts)
    return _round6(reports.drop("train_mae", "test_mae", "test_mape"), "naive_mae")


def forecast_runs(spark: SparkSession, sf: str) -> DataFrame:
    """Two runs of the job's forecaster: the recorded ones whose saved model scores as the fitted one."""
    lake = daily.Lake(scratch_dir(spark))
    lake.write(_series(spark, sf), daily.TIME_SERIES)
    rows, fitted = _training(spark, sf), []
    for target, trees, depth in (("smoothed", 200, 6), ("next", 100, 4)):
        model = daily.refresh_forecaster(spark, lake, target, trees, depth)
        report = forecast.model_report(forecast.score(rows, model, target))
        fitted.append(report.select(F.lit(target).alias("target"), F.col("test_mae").alias("fitted_mae")))
    runs = lake.read(spark, daily.MODEL_RUNS)
    params = [F.col("params")[name].alias(name) for name in ("target", "trees", "depth", "rate")]
    runs = runs.select("run_name", *params, "train_rows", "test_rows", "naive_mae", "test_mae")
    same = F.abs(F.col("test_mae") - F.col("fitted_mae")) < 1e-6
    return _round6(
        runs.join(reduce(DataFrame.unionByName, fitted), "target").filter(same).drop("test_mae", "fitted_mae"),
        "naive_mae",
    )


def grid_search(spark: SparkSession, sf: str) -> DataFrame:
    """The points of the whole grid, as far as they beat the mean naive error of their folds."""
    rows = _training(spark, sf)
    scores = forecast.grid_search(rows)
    train, _ = forecast.holdout_split(rows)
    naive = forecast.forecast_errors(forecast.supervised(train, "smoothed"), "label", "naive").first()["mae"]
    return scores.filter((F.col("mae") > 0) & (F.col("mae") < naive)).drop("mae")


def advisor_plan_model(spark: SparkSession, sf: str) -> DataFrame:
    """Plans on the model's forecast that add up: to the income, to the budget, within the risk."""
    model = forecast.fit_forecaster(_training(spark, sf), "smoothed")
    requests = materialize(_requests(spark, sf))
    plan = serve.advisor_plan(requests, forecast.model_forecast(model))
    plan = allocate.add_return_and_risk(plan).join(requests.select("client_id", "risk_score"), "client_id")
    budget, spent = F.col("safe_investable_budget"), F.col("Savings") + F.col("Bonds") + F.col("ETFs") + F.col("Crypto")
    adds_up = F.abs(F.col("monthly_income") - F.col("predicted_expense") - budget) < 0.011
    spends = F.abs(spent - F.greatest(budget, F.lit(0.0))) < 0.021
    safe = F.col("expected_annual_risk") <= F.col("risk_score") * spent + 0.2
    return _round6(plan.filter(adds_up & spends & safe), "monthly_income").select("client_id", "monthly_income")


# -- whole jobs --------------------------------------------------------------------------------


def _refreshed(spark: SparkSession, sf: str, **options) -> daily.Lake:
    return daily.run_pipeline(
        spark,
        _csv(testdata.bronze_transactions(spark, sf)),
        _csv(testdata.bronze_users(spark, sf)),
        _mcc_file(spark),
        scratch_dir(spark),
        **options,
    )


def daily_refresh(spark: SparkSession, sf: str) -> DataFrame:
    """Raw files to all tables; gives the recommendations."""
    return _refreshed(spark, sf).read(spark, daily.RECOMMENDATIONS)


def daily_refresh_bucketed(spark: SparkSession, sf: str) -> DataFrame:
    """The same with the roll-up bucketed by client; gives the time series."""
    name = f"client_months_{scratch_dir(spark).rsplit('/', 1)[1]}"
    try:
        lake = _refreshed(spark, sf, bucketed_as=name)
    finally:
        spark.sql(f"DROP TABLE IF EXISTS {name}")
    return lake.read(spark, daily.TIME_SERIES)


def stream_silver(spark: SparkSession, sf: str) -> DataFrame:
    """Silver transactions written by the streaming form."""
    out = scratch_dir(spark)
    query = stream_silver_transactions(
        spark,
        _csv(testdata.dirty_transactions(spark, sf)),
        read_mcc_json(spark, _mcc_file(spark)),
        out,
        scratch_dir(spark),
    )
    query.awaitTermination()
    return read_table(spark, out)


def _deliver(df: DataFrame, folder: str) -> None:
    """Add raw files to a folder."""
    df.write.mode("append").csv(folder, header=True, quote="\u0000")


def _staged(
    spark: SparkSession, sf: str, rows: Callable[[SparkSession, str, testdata.Share], DataFrame], deliveries: Sequence[Column]
) -> str:
    """A folder with the raw files of all deliveries, packed; a row may be in several of them."""
    path = scratch_dir(spark)
    taken = F.array_compact(F.array(*[F.when(part, F.lit(number)) for number, part in enumerate(deliveries)]))
    # a file for each delivery is open in every task: else its rows would be sorted by delivery
    with settings(spark, {"spark.sql.maxConcurrentOutputFileWriters": str(len(deliveries))}):
        for share in testdata.order_shares(spark, sf):
            (
                rows(spark, sf, share).select("*", F.explode(taken).alias("delivery"))
                .write.mode("append").partitionBy("delivery")
                .csv(path, header=True, quote="\u0000", compression="gzip")
            )
    return path


def _deliver_staged(spark: SparkSession, staged: str, number: int, folder: str) -> None:
    """Move the raw files of one delivery to a folder."""
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs
    source, target = hadoop.Path(f"{staged}/delivery={number}"), hadoop.Path(folder)
    files = target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    files.mkdirs(target)
    for file in files.listStatus(source) if files.exists(source) else ():
        if not files.rename(file.getPath(), hadoop.Path(target, f"{number}-{file.getPath().getName()}")):
            raise OSError(f"not moved: {file.getPath()}")


def incremental_months(spark: SparkSession, sf: str) -> DataFrame:
    """The roll-up after two deliveries, of which the second brings late rows and is then taken again."""
    lake, folder, codes = daily.Lake(scratch_dir(spark)), scratch_dir(spark), _mcc_file(spark)
    rows = materialize(testdata.dirty_transactions(spark, sf))
    late = (F.col("date") >= "2000-07") | (F.col("merchant_state") == "S3")
    _deliver(rows.filter(~late), folder)
    daily.refresh_rollup(spark, folder, codes, lake)
    _deliver(rows.filter(late), folder)
    tables = daily.refresh_rollup(spark, folder, codes, lake)
    again = spark.read.parquet(tables.silver).filter("batch_id = 1").drop("batch_id")
    add_batch(materialize(again), 1, tables)
    sums = [F.col(c).cast("double").alias(c) for c in ("spend", "discretionary")]
    return tables.read_months(spark).select("client_id", "txn_month", *sums)


def incremental_features(spark: SparkSession, sf: str) -> DataFrame:
    """The daily job over two deliveries, the second run taking only the new files; gives the time series."""
    folder, users, codes, out = scratch_dir(spark), _csv(testdata.bronze_users(spark, sf)), _mcc_file(spark), scratch_dir(spark)
    with shuffles_freed(spark):
        staged = _staged(spark, sf, testdata.bronze_transactions, (F.col("date") < "1999", F.col("date") >= "1999"))
        for number in range(2):
            _deliver_staged(spark, staged, number, folder)
            lake = daily.run_pipeline(spark, folder, users, codes, out, incremental=True)
    return lake.read(spark, daily.TIME_SERIES)


def stream_distinct(spark: SparkSession, sf: str) -> DataFrame:
    """Three deliveries: later ones repeat transactions, and bring some that are too late to be told from repeats."""
    date, held_back = F.col("date"), (F.col("merchant_state") == "S3") & F.col("date").between("1996", "1997")
    deliveries = (
        (date < "1999") & ~held_back,
        (date >= "1998-10") & (date < "2001"),
        (date >= "2000-11") | held_back | date.startswith("1995-05"),
    )
    folder, out, checkpoint = (scratch_dir(spark) for _ in range(3))
    codes = read_mcc_json(spark, _mcc_file(spark))
    with shuffles_freed(spark):
        staged = _staged(spark, sf, testdata.dirty_transactions, deliveries)
        for number in range(len(deliveries)):
            _deliver_staged(spark, staged, number, folder)
            stream_distinct_transactions(spark, folder, codes, out, checkpoint, delay="180 days").awaitTermination()
    silver = read_table(spark, out).withColumn("date", F.date_format("date", "yyyy-MM-dd HH:mm:ss"))
    return silver.select("id", "date", "client_id")


def financial_overview(spark: SparkSession, sf: str) -> DataFrame:
    """Flagship: per client, latest spend, features, and the recommended portfolio."""
    clients = serve.snapshots_from_months(testdata.silver_users(spark, sf), _months(spark, sf))
    planned = allocate.add_return_and_risk(allocate.allocate(clients))
    return _round6(planned, "avg_monthly_spend", "avg_monthly_discretionary").select(
        "client_id", "avg_monthly_spend", "avg_monthly_discretionary",
        "discretionary_spend_ratio", "monthly_disposable_income", "risk_tolerance_score",
        "investment_horizon", "current_month_spend", "spend_1_month_ago", "spend_2_months_ago",
        "status", "Savings", "Bonds", "ETFs", "Crypto", "expected_annual_return",
        "expected_annual_risk",
    )


QUERIES: dict[str, Query] = {
    query.__name__: query
    for query in (
        financial_overview,
        csv_transactions,
        csv_users,
        csv_inferred,
        rejected_transactions,
        rejected_users,
        transactions_judged,
        users_judged,
        csv_to_silver,
        table_overwrite,
        table_partitioned,
        snapshot_of_missing_profiles,
        silver_transactions,
        silver_transactions_salted,
        silver_users,
        timestamps_parsed,
        contract_valid,
        contract_rejected,
        discretionary_tags,
        transactions_with_users,
        transactions_with_users_salted,
        monthly_spend,
        time_series_features,
        time_series_min_history,
        smoothed_spend,
        calendar_features,
        calendar_features_filled,
        client_net_amount,
        distinct_clients_by_year,
        client_spend_totals,
        category_spend_profile,
        top_transactions,
        user_portfolio_features,
        top_discretionary_users,
        portfolio_recommendations,
        allocation_statuses,
        allocation_rows,
        positive_allocations,
        portfolio_return_and_risk,
        any_asset_holdings,
        any_asset_return_and_risk,
        card_offers,
        any_card_offers,
        client_ids,
        table_counts,
        latest_month,
        client_snapshots,
        client_snapshots_one_pass,
        client_snapshots_as_of,
        client_lookup,
        clients_without_history,
        client_histories,
        spend_trend,
        top_spender_history,
        advisor_plan,
        advisor_responses,
        advisor_display,
        lags_filled,
        holdout_split,
        supervised_raw,
        supervised_smoothed,
        supervised_next,
        naive_errors,
        time_folds,
        forecast_scores,
        forecast_report,
        forecast_runs,
        grid_search,
        advisor_plan_model,
        daily_refresh,
        daily_refresh_bucketed,
        stream_silver,
        stream_distinct,
        incremental_months,
        incremental_features,
    )
}
