"""What jobs over raw files leave on disk while they run: packed files, and no shuffle files of finished steps."""

import datetime as dt
import time
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from spendlake.operators import enrich
from spendlake.plans import catalog, testdata
from spendlake.schemas import BRONZE_TRANSACTIONS
from spendlake.streaming import distinct, stream_distinct_transactions

DAYS = ("1995-05-02", "1996-06-01", "1998-11-05", "1999-03-01", "2000-12-24", None)


@pytest.fixture(scope="module")
def tables(spark, tmp_path_factory):
    path = tmp_path_factory.mktemp("tables")
    moments = [dt.datetime.fromisoformat(d) if d else None for d in DAYS]
    orders = [(k, k % 4, "O", 1.0, moments[k % len(moments)], "5-LOW") for k in range(40)] + [(None, 1, "O", 1.0, moments[0], None)]
    lines = [
        (key, k % 3, k % 23, n, 1.0, 100.0 + k + n, 0.05, n / 100, "NAR"[k % 3], "O", dt.datetime(2001, 1, 1))
        for k, key in [*((k, k) for k in [*range(40), *range(5)]), (7, None)] for n in range(9)
    ]
    rows = {
        "customer": [(k, f"c{k}", k, 10.0, "BUILDING") for k in range(4)],
        "part": [(0, "p", "b", "SMALL", 1, 1.0), (1, "p", "b", "PROMO", 1, 1.0)],
        "orders": orders,
        "lineitem": lines,
    }
    for name, values in rows.items():
        spark.createDataFrame(values, testdata.TABLES[name]).write.parquet(f"{path}/{name}.parquet")
    return str(path)


@pytest.mark.parametrize("rows", (testdata.bronze_transactions, testdata.dirty_transactions))
def test_shares_are_all_rows(spark, tables, rows, monkeypatch):
    whole = sorted(map(str, rows(spark, tables).collect()))
    monkeypatch.setattr(testdata, "SHARE_BYTES", 1)
    shares = testdata.order_shares(spark, tables)
    parts = [rows(spark, tables, share).collect() for share in shares]
    assert len(shares) == testdata.MOST_SHARES and sum(map(bool, parts)) > 1
    assert sorted(str(r) for part in parts for r in part) == whole


def test_staged_deliveries(spark, tables, tmp_path, monkeypatch):
    monkeypatch.setattr(testdata, "SHARE_BYTES", 1)
    date, folder = F.col("date"), tmp_path / "raw"
    deliveries = (date < "1999", date.between("1998", "2000"), date > "2010")
    staged = catalog._staged(spark, tables, testdata.bronze_transactions, deliveries)
    seen, whole = 0, testdata.bronze_transactions(spark, tables)
    for number, part in enumerate(deliveries):
        catalog._deliver_staged(spark, staged, number, str(folder))
        files = [str(f) for f in folder.iterdir() if f.name.startswith(f"{number}-")]
        assert all(f.endswith(".csv.gz") for f in files)
        wanted = whole.filter(part).select("id", "date", "amount").collect()
        got = spark.read.csv(files, header=True, schema=whole.schema).select("id", "date", "amount").collect() if files else []
        assert sorted(got) == sorted(wanted)
        seen += len(files)
    assert seen == len([f for f in folder.iterdir() if f.name.endswith(".gz")]) > 0


def shuffle_files(spark):
    dirs = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirsString()
    return {str(f) for d in dirs for f in Path(d).rglob("shuffle_*.data")}


@pytest.mark.parametrize("query", (catalog.incremental_features, catalog.stream_distinct))
def test_no_shuffle_files_stay(spark, tables, query):
    before = shuffle_files(spark)
    query(spark, tables)
    for _ in range(20):
        if not (left := shuffle_files(spark) - before):
            break
        time.sleep(0.2)
    assert not left


TEXTS = ("c", 'a "quoted" one', "", None, "two\nlines, a comma", " spaces ", "ü\\n", "7", None)


def test_packed_texts_come_back(spark):
    schema = "id string, date timestamp, amount double, " + ", ".join(f"{c} string" for c in distinct._TEXTS)
    moment = dt.datetime(2020, 1, 1)
    rows = [("a", moment, -0.1, *TEXTS), ("b", None, 1e-7, *[None] * len(TEXTS))]
    frame = spark.createDataFrame(rows, schema).select(*BRONZE_TRANSACTIONS.fieldNames())
    back = distinct._unpacked(distinct._packed(frame))
    assert back.columns == frame.columns
    assert sorted(back.collect()) == sorted(frame.collect())


@pytest.mark.parametrize("small", (True, False))
def test_distinct_state_is_stored_without_the_log_of_its_changes(spark, tmp_path, monkeypatch, small):
    monkeypatch.setattr(enrich, "fits_broadcast", lambda _: small)
    folder, out, checkpoint = (str(tmp_path / n) for n in ("in", "out", "state"))
    codes = spark.createDataFrame([("5", "Taxi "), ("5", "Taxi "), (None, "none")], "mcc string, category_name string")

    def deliver(*rows):
        full = [(i, f"{d} 10:00:00", "c", "k", "$-1.50", None, "m", "", "S", "z", mcc, None) for i, d, mcc in rows]
        spark.createDataFrame(full, BRONZE_TRANSACTIONS).coalesce(1).write.mode("append").csv(folder, header=True)
        stream_distinct_transactions(spark, folder, codes, out, checkpoint, "10 days").awaitTermination()
        found = spark.read.parquet(out)
        assert found.columns == ["mcc", *[c for c in BRONZE_TRANSACTIONS.fieldNames() if c != "mcc"], "category_name"]
        return sorted((r.id, r.date.day, r.category_name, r.amount) for r in found.collect())

    first = deliver(("a", "2020-01-01", "5"), ("a", "2020-01-01", "5"), ("b", "2020-01-20", "6"))
    assert first == [("a", 1, "TAXI", -1.5), ("b", 20, "UNKNOWN", -1.5)]
    second = deliver(("b", "2020-01-20", "5"), ("late", "2020-01-05", "5"), ("c", "2020-01-21", "5"))
    assert second == [*first, ("c", 21, "TAXI", -1.5)]
    state = [f.suffix for f in Path(checkpoint, "state").rglob("*") if f.is_file()]
    assert ".zip" in state and ".changelog" not in state
