import json

import pytest

from spendlake.operators.cleaning import clean_transactions
from spendlake.operators.enrich import add_category
from spendlake.operators.monthly import client_months, time_series_features
from spendlake.plans import daily, testdata
from spendlake.schemas import TIME_SERIES_FEATURES, USER_PORTFOLIO_FEATURES
from spendlake.sources import read_mcc_json, read_table, read_transactions_csv
from spendlake.streaming import stream_silver_transactions


@pytest.fixture(scope="module")
def raw(spark, sf_dir, tmp_path_factory):
    root = tmp_path_factory.mktemp("raw")
    testdata.bronze_transactions(spark, sf_dir).repartition(4).write.csv(f"{root}/transactions", header=True)
    testdata.bronze_users(spark, sf_dir).write.csv(f"{root}/users", header=True)
    (root / "mcc.json").write_text(json.dumps(testdata.CATEGORY_OF_PART_TYPE))
    return str(root)


def same(left, right):
    right = right.select(left.columns)
    return left.exceptAll(right).count() == 0 and right.exceptAll(left).count() == 0


def test_whole_run(spark, raw, tmp_path):
    lake = daily.run_pipeline(
        spark, f"{raw}/transactions", f"{raw}/users", f"{raw}/mcc.json", str(tmp_path)
    )
    series = lake.read(spark, daily.TIME_SERIES)
    features = lake.read(spark, daily.USER_FEATURES)
    assert [(f.name, f.dataType) for f in series.schema] == [(f.name, f.dataType) for f in TIME_SERIES_FEATURES]
    assert features.columns == USER_PORTFOLIO_FEATURES.fieldNames()
    plans = lake.read(spark, daily.RECOMMENDATIONS)
    assert plans.count() == features.count() == series.select("client_id").distinct().count() > 0

    args = (f"{raw}/transactions", f"{raw}/users", f"{raw}/mcc.json", str(tmp_path))
    daily.run_pipeline(spark, *args, stages=["advisor"])  # warns and goes on without a model
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        lake.read(spark, daily.ADVISOR_PLAN)
    daily.run_pipeline(spark, *args, stages=["forecaster"], trees=3, depth=3)
    assert lake.read(spark, daily.MODEL_RUNS).first().params["trees"] == "3"
    daily.run_pipeline(spark, *args, stages=["advisor"])
    advice = lake.read(spark, daily.ADVISOR_PLAN)
    assert advice.count() == features.count()
    assert lake.read(spark, daily.MODEL_RUNS).count() == 1  # the advisor fitted nothing
    daily.refresh_forecaster(spark, lake, "raw", trees=1, depth=1)
    assert not daily.refresh_advisor(spark, lake)  # needs lags a snapshot lacks

    bucketed = daily.run_pipeline(
        spark, f"{raw}/transactions", f"{raw}/users", f"{raw}/mcc.json", str(tmp_path / "b"),
        bucketed_as="months_of_clients",
    )
    assert same(series, bucketed.read(spark, daily.TIME_SERIES))
    assert same(features, bucketed.read(spark, daily.USER_FEATURES))
    spark.sql("DROP TABLE months_of_clients")


def test_gold_reads_only_what_it_needs(spark, sf_dir, tmp_path, plan_of):
    lake = daily.Lake(str(tmp_path))
    lake.write(testdata.silver_transactions(spark, sf_dir), daily.SILVER_TRANSACTIONS)
    silver = lake.read(spark, daily.SILVER_TRANSACTIONS)
    plan = plan_of(client_months(silver.drop("category_name")))
    assert "LessThan(amount,0.0)" in plan
    assert "ReadSchema: struct<date:timestamp_ntz,client_id:string,amount:double>" in plan
    plan = plan_of(time_series_features(client_months(silver)))
    assert "category_name" not in plan  # the unused discretionary sum is pruned with its input


def test_switches_of_the_job(spark, raw, tmp_path, plan_of):
    args = (f"{raw}/transactions", f"{raw}/users", f"{raw}/mcc.json")
    plain = daily.run_pipeline(spark, *args, str(tmp_path / "a"))
    other = daily.run_pipeline(
        spark, *args, str(tmp_path / "b"), parse_dates=True, by_month=True, min_history=2
    )
    silver = other.read(spark, daily.SILVER_TRANSACTIONS)
    assert dict(silver.dtypes)["date"] == "timestamp"
    assert "PartitionFilters: [isnotnull(txn_month" in plan_of(silver.filter("txn_month = '1995-01'"))
    assert same(plain.read(spark, daily.USER_FEATURES), other.read(spark, daily.USER_FEATURES))
    months, late = (x.read(spark, daily.TIME_SERIES) for x in (plain, other))
    clients = months.groupBy("client_id").count().filter("count > 2").selectExpr("sum(count - 2)").first()[0]
    assert late.count() == clients


def test_single_stages(spark, raw, tmp_path):
    args = (f"{raw}/transactions", f"{raw}/users", f"{raw}/mcc.json", str(tmp_path))
    lake = daily.run_pipeline(spark, *args, stages=["transactions", "client_months"])
    daily.run_pipeline(spark, *args, stages=["time_series"])
    assert lake.read(spark, daily.TIME_SERIES).count() > 0
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        lake.read(spark, daily.USER_FEATURES)
    with pytest.raises(ValueError, match="unknown"):
        daily.run_pipeline(spark, *args, stages=["nothing"])


def test_command_line(spark, raw, tmp_path):
    from spendlake.__main__ import main

    main(
        ["--transactions", f"{raw}/transactions", "--users", f"{raw}/users", "--mcc", f"{raw}/mcc.json",
         "--out", str(tmp_path), "--train", "next", "--trees", "2", "--depth", "2"]
    )
    lake = daily.Lake(str(tmp_path))
    assert lake.read(spark, daily.ADVISOR_PLAN).count() == lake.read(spark, daily.USER_FEATURES).count()
    assert lake.read(spark, daily.MODEL_RUNS).count() == 1


def test_silver_shortcut_equals_cleaning_the_raw_rows(spark, sf_dir):
    cleaned = clean_transactions(
        add_category(testdata.bronze_transactions(spark, sf_dir), testdata.mcc_codes(spark)),
        parse_dates=True,
    )
    short = testdata.silver_transactions(spark, sf_dir)
    short = short.withColumn("date", short["date"].cast("timestamp"))
    assert same(cleaned, short)


def test_silver_stage_has_no_shuffle(spark, raw, plan_of):
    codes = read_mcc_json(spark, f"{raw}/mcc.json")
    silver = clean_transactions(add_category(read_transactions_csv(spark, f"{raw}/transactions"), codes))
    plan = plan_of(silver)
    assert "BroadcastHashJoin" in plan
    big_side = plan[: plan.index("BroadcastExchange")]
    assert "Exchange hashpartitioning" not in big_side


def test_stream_equals_batch_and_resumes(spark, raw, tmp_path):
    source = tmp_path / "in"
    source.mkdir()
    header = "id,date,client_id,card_id,amount,use_chip,merchant_id,merchant_city,merchant_state,zip,mcc,errors"
    row = "{},2020-01-01 00:00:00,c,k,$-{}.50,u,m,t,s,z,SMALL,"
    codes = read_mcc_json(spark, f"{raw}/mcc.json")

    def run():
        query = stream_silver_transactions(
            spark, str(source), codes, str(tmp_path / "out"), str(tmp_path / "cp"), max_files_per_batch=1
        )
        query.awaitTermination()
        return {r.id: (r.amount, r.category_name) for r in read_table(spark, str(tmp_path / "out")).collect()}

    (source / "1.csv").write_text("\n".join([header, row.format(1, 5), "bad,row", row.format(2, 2000000)]) + "\n")
    (source / "2.csv").write_text("\n".join([header, row.format(3, 7)]) + "\n")
    assert run() == {"1": (-5.5, "FAST FOOD RESTAURANTS"), "3": (-7.5, "FAST FOOD RESTAURANTS")}
    (source / "3.csv").write_text("\n".join([header, row.format(4, 9)]) + "\n")
    rows = run()
    assert set(rows) == {"1", "3", "4"}
    assert read_table(spark, str(tmp_path / "out")).count() == 3  # nothing written twice
