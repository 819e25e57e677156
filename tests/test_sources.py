import json
import os
import subprocess
import sys
import time

import pytest
from pyspark.sql import functions as F

from spendlake.operators.forecast import load_model_if_saved
from spendlake.schemas import BRONZE_TRANSACTIONS, TIME_SERIES_FEATURES
from spendlake.session import BASE_CONF, is_local, materialize, scratch_dir, shuffle_partitions_for
from spendlake.sources import (
    asset_table,
    card_product_table,
    guest_request,
    read_inferred_csv,
    read_mcc_json,
    read_table,
    read_table_or_empty,
    read_transactions_csv,
    read_users_csv,
    rows_table,
    table_exists,
    write_table,
)
from spendlake.sources.lake import write_bucketed

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
HEADER = ",".join(BRONZE_TRANSACTIONS.fieldNames())
USER_HEADER = (
    "id,current_age,retirement_age,birth_year,birth_month,gender,address,latitude,longitude,"
    "per_capita_income,yearly_income,total_debt,credit_score,num_credit_cards"
)


def _row(row_id, **changes):
    values = dict.fromkeys(BRONZE_TRANSACTIONS.fieldNames(), "x") | {"id": row_id} | changes
    return ",".join(values.values())


def _file(path, *lines):
    path.write_text("\n".join(lines) + "\n")
    return str(path)


def test_short_and_long_rows_drop_whatever_is_selected(spark, tmp_path):
    path = _file(tmp_path / "t.csv", HEADER, _row("1"), "2,short", _row("3") + ",long", _row("4"))
    df = read_transactions_csv(spark, path)
    assert df.count() == 2
    assert [r.id for r in df.select("id").orderBy("id").collect()] == ["1", "4"]
    assert len(df.collect()) == 2
    assert df.schema == BRONZE_TRANSACTIONS


def test_globs_and_folders(spark, tmp_path):
    _file(tmp_path / "a.csv", HEADER, _row("1"))
    _file(tmp_path / "b.csv", HEADER, _row("2"))
    assert read_transactions_csv(spark, f"{tmp_path}/*.csv").count() == 2
    assert read_transactions_csv(spark, str(tmp_path)).count() == 2
    assert read_transactions_csv(spark, [f"{tmp_path}/a.csv"]).count() == 1


def test_foreign_header_fails_unless_allowed(spark, tmp_path):
    names = BRONZE_TRANSACTIONS.fieldNames()
    swapped = ",".join([names[1], names[0], *names[2:]])
    path = _file(tmp_path / "t.csv", swapped, _row("1"))
    with pytest.raises(Exception, match="CSV header does not conform"):
        read_transactions_csv(spark, path).collect()
    assert read_transactions_csv(spark, path, check_header=False).count() == 1


def test_mistyped_users_drop_whatever_is_selected(spark, tmp_path):
    path = _file(
        tmp_path / "u.csv",
        USER_HEADER,
        "1,30,65,1990,1,F,a,1.5,-2.5,$1,$2,$3,700,2",
        "2,old,65,1990,1,F,a,1.5,2.5,$1,$2,$3,700,2",
        "3,30,65,1990,1,F,a,north,2.5,$1,$2,$3,700,2",
        "4,,65,1990,1,F,a,,2.5,$1,,$3,,2",
        "5,30.0,65,1990,1,F,a,1.5,2.5,$1,$2,$3,700,2",
    )
    df = read_users_csv(spark, path)
    assert df.count() == 2
    assert [r.id for r in df.select("id").orderBy("id").collect()] == ["1", "4"]
    assert df.schema["current_age"].dataType.simpleString() == "int"
    assert df.schema["latitude"].dataType.simpleString() == "float"
    assert df.filter("id = '4'").first().current_age is None


def test_mcc_json(spark, tmp_path):
    path = tmp_path / "mcc.json"
    path.write_text(json.dumps({"5812": "Eating Places", "a.b": "Dotted", "1": None}, indent=2))
    rows = {r.mcc: r.category_name for r in read_mcc_json(spark, str(path)).collect()}
    assert rows == {"5812": "Eating Places", "a.b": "Dotted", "1": None}


def test_repeated_code_keeps_last_name(spark, tmp_path):
    path = tmp_path / "mcc.json"
    path.write_text('{"1": "first", "2": "other", "1": "last"}')
    rows = {r.mcc: r.category_name for r in read_mcc_json(spark, str(path)).collect()}
    assert rows == {"1": "last", "2": "other"}


def test_inferred_csv(spark, tmp_path):
    path = _file(tmp_path / "c.csv", "id,amount,when", "1,2.5,2020-01-01 10:00:00")
    types = dict(read_inferred_csv(spark, path).dtypes)
    assert types == {"id": "int", "amount": "double", "when": "timestamp"}


def test_overwrite_replaces(spark, tmp_path):
    path = str(tmp_path / "t")
    write_table(spark.range(10), path)
    write_table(spark.range(3), path)
    assert read_table(spark, path).count() == 3
    write_table(spark.range(2), path, mode="append")
    assert read_table(spark, path).count() == 5


def test_other_format(spark, tmp_path):
    path = str(tmp_path / "t")
    write_table(spark.range(4), path, fmt="orc")
    assert read_table(spark, path, "orc").count() == 4


def test_partitioned_table_prunes(spark, tmp_path, plan_of):
    path = str(tmp_path / "t")
    months = spark.range(100).withColumn("m", F.concat(F.lit("2020-"), F.col("id") % 3))
    write_table(months, path, partition_by=["m"])
    hit = read_table(spark, path).filter("m = '2020-1'")
    assert hit.count() == 33
    assert "PartitionFilters: [isnotnull(m" in plan_of(hit)


def test_bucketed_table_needs_no_shuffle(spark, tmp_path, plan_of):
    rows = spark.range(100).selectExpr("cast(id % 7 as string) client_id", "id month_start")
    df = write_bucketed(rows, "b_test", str(tmp_path / "b"), 4, ["client_id"], ["client_id"])
    assert "Exchange" not in plan_of(df.groupBy("client_id").count())
    assert df.count() == 100
    again = write_bucketed(rows.filter("client_id > 3"), "b_test", str(tmp_path / "b"), 2, ["client_id"], ["client_id"])
    assert again.count() == rows.filter("client_id > 3").count()
    assert len([p for p in (tmp_path / "b").iterdir() if p.is_dir()]) == 1  # the folder replaced is gone
    bad = rows.withColumn("month_start", F.raise_error(F.lit("stop")).cast("long"))
    with pytest.raises(Exception, match="stop"):
        write_bucketed(bad, "b_test", str(tmp_path / "b"), 2, ["client_id"], ["client_id"])
    assert spark.table("b_test").count() == again.count()  # a failed run leaves the table as it was
    assert not [t for t in spark.catalog.listTables() if t.name.startswith("b_test_")]
    spark.sql("DROP TABLE b_test")


def test_a_failed_swap_gives_the_name_back(spark, tmp_path, monkeypatch):
    rows = spark.range(20).selectExpr("cast(id as string) client_id")
    write_bucketed(rows, "b_swap", str(tmp_path / "b"), 2, ["client_id"], ["client_id"])
    run = type(spark).sql

    def failing(self, query, *args, **kwargs):
        if "_old" not in query and query.endswith("RENAME TO b_swap"):
            raise RuntimeError("stop")
        return run(self, query, *args, **kwargs)

    monkeypatch.setattr(type(spark), "sql", failing)
    with pytest.raises(RuntimeError):
        write_bucketed(rows.limit(1), "b_swap", str(tmp_path / "b"), 2, ["client_id"], ["client_id"])
    assert spark.table("b_swap").count() == 20
    assert not [t for t in spark.catalog.listTables() if t.name.startswith("b_swap_")]
    monkeypatch.undo()
    assert write_bucketed(rows.limit(1), "b_swap", str(tmp_path / "b"), 2, ["client_id"], ["client_id"]).count() == 1
    spark.sql("DROP TABLE b_swap")


@pytest.mark.parametrize("text", ['{"1": "a", "2": ', '["a", "b"]', "", "7"])
def test_unreadable_dictionary_fails(spark, tmp_path, text):
    (tmp_path / "mcc.json").write_text(text)
    with pytest.raises(Exception, match="MALFORMED_RECORD|no JSON object"):
        read_mcc_json(spark, str(tmp_path / "mcc.json")).collect()


def test_missing_table_is_empty(spark, tmp_path):
    path = str(tmp_path / "none")
    assert not table_exists(spark, path)
    empty = read_table_or_empty(spark, path, TIME_SERIES_FEATURES)
    assert empty.count() == 0 and empty.schema == TIME_SERIES_FEATURES
    write_table(spark.range(1), path)
    assert read_table_or_empty(spark, path, TIME_SERIES_FEATURES).count() == 1
    assert load_model_if_saved(spark, str(tmp_path / "model")) is None


def test_literal_tables(spark):
    assert rows_table(spark, {"a": 1, "b": 2}).count() == 1
    assert rows_table(spark, [{"a": 1, "b": None}, {"a": 2, "b": 3}], "a int, b int").count() == 2
    assert asset_table(spark).filter("min_horizon = 5").first().asset == "Crypto"
    assert card_product_table(spark).count() == 4
    assert guest_request(spark, risk_score=7).first().risk_score == 7


def test_materialize_goes_to_the_shared_folder(spark):
    root = spark.conf.get("spark.checkpoint.dir")
    assert scratch_dir(spark).startswith(root)
    df = materialize(spark.range(5))
    assert root in df.inputFiles()[0]
    assert df.count() == 5


def test_cluster_must_name_a_shared_folder():
    class Context:
        master = "spark://host:7077"

        def getCheckpointDir(self):
            return None

    class Session:
        sparkContext = Context()
        conf = {}

    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        scratch_dir(Session())


def test_scratch_goes_with_the_application(tmp_path):
    code = (
        "from spendlake.session import get_spark, materialize\n"
        f"spark = get_spark('t', 'local[1]', {{'spark.checkpoint.dir': {str(tmp_path)!r}}})\n"
        "df = materialize(spark.range(3))\n"
        "print(df.inputFiles()[0], df.count())\n"
    )
    done = subprocess.run([sys.executable, "-c", code], capture_output=True, text=True, cwd=ROOT, timeout=300)
    assert done.returncode == 0 and str(tmp_path) in done.stdout
    deadline = time.time() + 30
    while list(tmp_path.rglob("*.parquet")) and time.time() < deadline:
        time.sleep(0.5)
    assert not list(tmp_path.rglob("*.parquet"))


def test_local_masters_only():
    assert [is_local(m) for m in ("local", "local[4]", "local[*]", "local-cluster[2,1,1024]", "yarn")] == [
        True, True, True, False, False,
    ]


def test_shuffles_start_from_many_partitions(spark, plan_of):
    assert int(BASE_CONF["spark.sql.adaptive.coalescePartitions.initialPartitionNum"]) >= 10_000
    key = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"
    before = spark.conf.get(key)
    try:
        spark.conf.set(key, BASE_CONF[key])
        wide = spark.createDataFrame([("a",)], "client_id string")
        plan = plan_of(wide.groupBy("client_id").count())
        assert f", {BASE_CONF[key]}), ENSURE_REQUIREMENTS" in plan
    finally:
        spark.conf.set(key, before)


def test_shuffle_sizing():
    assert shuffle_partitions_for(0) == 8
    assert shuffle_partitions_for(10 << 40) == 81920
