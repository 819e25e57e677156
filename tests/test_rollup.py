import json
import random
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from spendlake.operators.cleaning import clean_transactions
from spendlake.operators.enrich import add_category
from spendlake.operators.monthly import client_months
from spendlake.plans import daily, testdata
from spendlake.schemas import BRONZE_TRANSACTIONS
from spendlake.sources import read_mcc_json, read_transactions_csv
from spendlake.streaming import RollupTables, add_batch, distinct_within, stream_client_months

SILVER = "id string, client_id string, date string, amount double, category_name string"


def silver(spark, *rows):
    return spark.createDataFrame([(str(i), *r) for i, r in enumerate(rows)], SILVER)


def files(folder):
    return {
        str(p.relative_to(folder)): p.stat().st_mtime_ns for p in folder.rglob("*.parquet")
    }


def by_month(found):
    months = defaultdict(dict)
    for path, time in found.items():
        months[path.split("/")[0]][path] = time
    return months


@pytest.fixture
def tables(tmp_path):
    return RollupTables(*(str(tmp_path / name) for name in ("silver", "parts", "months")))


def sums(tables, spark):
    rows = tables.read_months(spark).collect()
    assert len({(r.client_id, r.txn_month) for r in rows}) == len(rows)
    return {(r.client_id, r.txn_month): (float(r.spend), float(r.discretionary)) for r in rows}


def test_only_touched_months_are_written(spark, tables, tmp_path):
    first = silver(
        spark, ("a", "2020-01-05 10:00:00", -5.0, "TAXI"), ("a", "2020-02-05 10:00:00", -7.0, "BOOK STORES"),
        ("b", "2020-03-01 00:00:00", -1.0, "TAXI"), ("b", "2020-04-01 00:00:00", 9.0, "TAXI"), ("c", "no date", -2.0, "TAXI"),
    )
    assert set(add_batch(first, 0, tables)) == {"2020-01", "2020-02", "2020-03", None}
    before = by_month(files(tmp_path / "months"))
    second = silver(spark, ("a", "2020-02-09 10:00:00", -0.5, "TAXI"), ("d", "2020-05-01 00:00:00", -4.0, "TAXI"), ("c", "?", -1.0, "TAXI"))
    assert set(add_batch(second, 1, tables)) == {"2020-02", "2020-05", None}
    after = by_month(files(tmp_path / "months"))
    for month in ("txn_month=2020-01", "txn_month=2020-03"):
        assert before[month] == after[month]
    assert before["txn_month=2020-02"] != after["txn_month=2020-02"]
    expected = {
        ("a", "2020-01"): (5.0, 0.0), ("a", "2020-02"): (7.5, 7.0), ("b", "2020-03"): (1.0, 0.0),
        ("c", None): (3.0, 0.0), ("d", "2020-05"): (4.0, 0.0),
    }
    if sums(tables, spark)[("a", "2020-02")][1] == 0:  # whichever categories are discretionary
        expected[("a", "2020-02")] = (7.5, 0.0)
    assert sums(tables, spark) == expected
    for batch, number in ((second, 1), (first, 0), (second, 1)):  # taken again, in any order
        add_batch(batch, number, tables)
        assert sums(tables, spark) == expected


def test_batches_without_expenses(spark, tables):
    assert add_batch(silver(spark, ("a", "2020-01-05 10:00:00", 5.0, "TAXI")), 0, tables) == []
    assert add_batch(silver(spark, ("a", "2020-01-05 10:00:00", -5.0, "TAXI")), 1, tables) == ["2020-01"]
    assert sums(tables, spark) == {("a", "2020-01"): (5.0, 0.0)}


def test_random_deliveries_equal_one_roll_up(spark, tables):
    rng = random.Random(5)
    rows = [
        (f"c{rng.randint(0, 9)}", f"20{rng.randint(10, 12)}-{rng.randint(1, 12):02}-11 00:00:00", -rng.randint(1, 999) / 100,
         rng.choice(["TAXI", "BOOK STORES"])) for _ in range(600)
    ]
    for number, start in enumerate(range(0, 600, 150)):
        add_batch(silver(spark, *rows[start : start + 150]), number, tables)
    whole = client_months(silver(spark, *rows))
    got = tables.read_months(spark).drop("txn_month")
    assert got.exceptAll(whole).isEmpty() and whole.exceptAll(got).isEmpty() and whole.count() > 200


@pytest.fixture(scope="module")
def raw(spark, sf_dir, tmp_path_factory):
    root = tmp_path_factory.mktemp("raw")
    testdata.bronze_users(spark, sf_dir).write.csv(f"{root}/users", header=True)
    (root / "mcc.json").write_text(json.dumps(testdata.CATEGORY_OF_PART_TYPE))
    return str(root)


def test_daily_job_takes_only_new_files(spark, sf_dir, raw, tmp_path):
    folder, out = str(tmp_path / "in"), str(tmp_path / "lake")
    rows = testdata.dirty_transactions(spark, sf_dir).filter("date < '1996'")
    parts = (F.col("date") < "1995-09", F.col("date") >= "1995-09")
    for part in parts:
        rows.filter(part).repartition(3).write.mode("append").csv(folder, header=True, quote="\u0000")
        lake = daily.run_pipeline(spark, folder, f"{raw}/users", f"{raw}/mcc.json", out, incremental=True)
    whole = daily.run_pipeline(spark, folder, f"{raw}/users", f"{raw}/mcc.json", str(tmp_path / "whole"))
    for table in (daily.TIME_SERIES, daily.USER_FEATURES, daily.RECOMMENDATIONS):
        one, other = lake.read(spark, table), whole.read(spark, table)
        assert one.exceptAll(other).isEmpty() and other.exceptAll(one).isEmpty() and one.count() > 0
    before = files(tmp_path / "lake" / "gold" / "client_months")
    daily.run_pipeline(spark, folder, f"{raw}/users", f"{raw}/mcc.json", out, incremental=True)  # nothing new
    assert files(tmp_path / "lake" / "gold" / "client_months") == before
    with pytest.raises(ValueError, match="incremental"):
        daily.run_pipeline(spark, folder, "", "", out, incremental=True, by_month=True)


def test_many_small_batches_and_a_lost_checkpoint(spark, sf_dir, raw, tables, tmp_path):
    folder = str(tmp_path / "in")
    rows = testdata.bronze_transactions(spark, sf_dir).filter("date < '1995-06'")
    rows.repartition(3).write.csv(folder, header=True, quote="\u0000")

    def codes(session):
        return read_mcc_json(session, f"{raw}/mcc.json")

    for checkpoint in ("one", "two"):  # the second knows of nothing and delivers all batches again
        stream_client_months(spark, folder, codes, tables, str(tmp_path / checkpoint), max_files_per_batch=1).awaitTermination()
        whole = client_months(clean_transactions(add_category(read_transactions_csv(spark, folder), codes(spark))))
        got = tables.read_months(spark).drop("txn_month")
        assert got.exceptAll(whole).isEmpty() and whole.exceptAll(got).isEmpty()


HEADER = ",".join(BRONZE_TRANSACTIONS.fieldNames())


def test_distinct_transactions(spark, tmp_path):
    source, out, checkpoint = (str(tmp_path / n) for n in ("in", "out", "state"))
    spark.createDataFrame([], "id string, date timestamp, note string").write.parquet(source)

    def deliver(*rows):
        frame = spark.createDataFrame([(i, d, n) for i, d, n in rows], "id string, date string, note string")
        frame.withColumn("date", F.to_timestamp("date")).coalesce(1).write.mode("append").parquet(source)
        stream = spark.readStream.schema("id string, date timestamp, note string").parquet(source)
        (
            distinct_within(stream, "10 days").writeStream.option("checkpointLocation", checkpoint)
            .trigger(availableNow=True).start(out).awaitTermination()
        )
        return sorted((r.id, r.note) for r in spark.read.parquet(out).collect())

    first = deliver(("a", "2020-01-01", "1"), ("a", "2020-01-01", "1"), ("b", "2020-01-20", "1"), ("n", None, "1"))
    assert first == [("a", "1"), ("b", "1")]
    second = deliver(("b", "2020-01-20", "2"), ("c", "2020-01-15", "2"), ("late", "2020-01-05", "2"), ("d", "2020-03-01", "2"))
    assert second == [("a", "1"), ("b", "1"), ("c", "2"), ("d", "2")]
    # an id whose time is over may come again with a new moment
    assert ("b", "3") in deliver(("b", "2020-03-02", "3"), ("d", "2020-03-01", "3"), ("d", "2020-02-25", "3"))
