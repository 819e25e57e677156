"""Queries on the test tables with hot keys: a third of all lines share one order, so one client
and one month, another third one part, so one category, and a third of the orders one client."""

import pytest
from pyspark.sql import functions as F

from __spark_entry__ import oracle_sql, queries
from tests.check import TABLES, connect, differences

NAMES = (
    "financial_overview", "silver_transactions", "silver_transactions_salted",
    "transactions_with_users", "transactions_with_users_salted", "monthly_spend",
    "time_series_features", "client_spend_totals", "category_spend_profile",
    "user_portfolio_features", "advisor_plan", "latest_month", "naive_errors", "table_partitioned",
)


@pytest.fixture(scope="module")
def hot_dir(spark, sf_dir, tmp_path_factory):
    root = tmp_path_factory.mktemp("hot")
    read = {t: spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in TABLES}
    hot_order = read["orders"].first().o_orderkey
    hot_part = read["part"].first().p_partkey
    line = F.col("l_suppkey") + F.col("l_linenumber")
    read["lineitem"] = read["lineitem"].withColumns(
        {
            "l_orderkey": F.when(line % 3 == 0, hot_order).otherwise(F.col("l_orderkey")),
            "l_partkey": F.when(line % 3 == 1, hot_part).otherwise(F.col("l_partkey")),
        }
    )
    read["orders"] = read["orders"].withColumn(
        "o_custkey", F.when(F.col("o_orderkey") % 3 == 0, F.lit(7).cast("long")).otherwise(F.col("o_custkey"))
    )
    for name, df in read.items():
        df.write.parquet(f"{root}/{name}.parquet")
    return str(root)


@pytest.fixture(scope="module")
def connection(hot_dir):
    return connect(hot_dir, files="/*.parquet")


@pytest.mark.parametrize("broadcast", ["10m", "-1"])
@pytest.mark.parametrize("name", NAMES)
def test_hot_keys_change_nothing(spark, hot_dir, connection, name, broadcast):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", broadcast)
    try:
        assert differences(queries()[name](spark, hot_dir), connection, oracle_sql()[name]) == []
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
