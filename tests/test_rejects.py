import pytest
from pyspark.sql import functions as F

from spendlake.operators import rejects
from spendlake.operators.cleaning import clean_transactions, clean_users
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
from spendlake.plans import testdata
from spendlake.schemas import BRONZE_TRANSACTIONS, BRONZE_USERS
from spendlake.sources import read_transaction_lines, read_transactions_csv, read_user_lines, read_users_csv


def lines(path, schema, *rows):
    names = schema.fieldNames()
    text = [",".join(names)]
    for row in rows:
        text.append(row if isinstance(row, str) else ",".join(str(row.get(n, "")) for n in names))
    path.write_text("\n".join(text) + "\n")
    return str(path)


GOOD = {"id": "1", "client_id": "c", "amount": "$-3.00"}


@pytest.fixture
def transactions(tmp_path):
    return lines(
        tmp_path / "t.csv", BRONZE_TRANSACTIONS, GOOD, {**GOOD, "id": ""}, {**GOOD, "client_id": "", "id": ""}, {**GOOD, "client_id": ""},
        {**GOOD, "amount": ""}, {**GOOD, "amount": "x"}, {**GOOD, "amount": "$1000000"}, {**GOOD, "amount": "NaN"}, {**GOOD, "amount": "$999999.99"},
        "1,2", ",".join("x" * 13), {**GOOD, "amount": "-Infinity"},
    )


def test_first_reason_counts(spark, transactions, tmp_path):
    judged = judge_transactions(read_transaction_lines(spark, transactions).withColumn("category_name", F.lit("x")))
    out = str(tmp_path / "silver")
    counts = write_counting(judged, TRANSACTION_REASONS, lambda df: accepted_transactions(df).write.parquet(out))
    assert counts == {
        "accepted": 2, "malformed line": 2, "missing id": 2, "missing client": 1, "missing amount": 1,
        "amount is no number": 1, "amount out of bounds": 3,
    }
    kept = spark.read.parquet(out)
    raw = read_transactions_csv(spark, transactions).withColumn("category_name", F.lit("x"))
    assert sorted(kept.collect()) == sorted(clean_transactions(raw).collect())
    assert {r.reason: r.rows for r in reason_table(spark, counts).collect()} == counts


def test_one_scan(spark, transactions, plan_of):
    judged = judge_transactions(read_transaction_lines(spark, transactions).withColumn("category_name", F.lit("x")))
    plans = []
    write_counting(judged, TRANSACTION_REASONS, lambda df: (plans.append(plan_of(accepted_transactions(df))), df.write.format("noop").mode("overwrite").save()))
    assert plans[0].count("FileScan csv") == 1 and "CollectMetrics" in plans[0] and "Exchange" not in plans[0]


def test_same_rows_as_the_strict_readers(spark, sf_dir, tmp_path):
    path = str(tmp_path / "dirty")
    testdata.dirty_transactions(spark, sf_dir).write.csv(path, header=True, quote="\u0000")
    strict = clean_transactions(read_transactions_csv(spark, path).withColumn("category_name", F.lit("x")))
    judged = judge_transactions(read_transaction_lines(spark, path).withColumn("category_name", F.lit("x")))
    got = accepted_transactions(judged)
    assert got.exceptAll(strict).isEmpty() and strict.exceptAll(got).isEmpty()
    users = str(tmp_path / "users")
    testdata.dirty_users(spark, sf_dir).write.csv(users, header=True)
    strict, got = clean_users(read_users_csv(spark, users)), accepted_users(judge_users(read_user_lines(spark, users)))
    assert got.dtypes == strict.dtypes
    assert got.exceptAll(strict).isEmpty() and strict.exceptAll(got).isEmpty()


def test_users(spark, tmp_path):
    good = dict.fromkeys(BRONZE_USERS.fieldNames(), "1")
    path = lines(
        tmp_path / "u.csv", BRONZE_USERS, good, {**good, "current_age": "old"}, {**good, "latitude": "north", "id": ""}, {**good, "id": ""},
        {**good, "yearly_income": "none"}, {**good, "yearly_income": ""}, "1,2,3", {**good, "current_age": ""},
    )
    counts = write_counting(
        judge_users(read_user_lines(spark, path)), USER_REASONS, lambda df: df.write.format("noop").mode("overwrite").save()
    )
    assert counts == {"accepted": 2, "malformed line": 1, "mistyped field": 2, "missing id": 1, "yearly income is no number": 2}


def test_nothing_to_read(spark, tmp_path):
    path = lines(tmp_path / "t.csv", BRONZE_TRANSACTIONS)
    counts = write_counting(
        judge_transactions(read_transaction_lines(spark, path)), TRANSACTION_REASONS,
        lambda df: df.write.format("noop").mode("overwrite").save(),
    )
    assert set(counts) == {"accepted", *rejects.TRANSACTION_REASONS} and not any(counts.values())
