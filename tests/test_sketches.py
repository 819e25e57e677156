from pyspark.sql import functions as F

from spendlake.operators.sketches import monthly_sketches, relative_error, united, within_error

COLUMNS = "client_id string, date string, merchant_id string"


def test_united_months_count_a_client_once(spark):
    rows = [(f"c{i}", f"2020-{m:02}-01 00:00:00", "m" if m < 3 else None) for m in range(1, 7) for i in range(50 * m)]
    rows += [("c1", "no date", "m")] * 3
    months = monthly_sketches(spark.createDataFrame(rows, COLUMNS), "client_id", "merchant_id")
    assert months.count() == 7
    year = united(months, F.year("month_start").alias("year"), "client_id", "merchant_id")
    got = {r.year: (r.rows, r.distinct_client_id, r.distinct_merchant_id) for r in year.collect()}
    assert got[2020][0] == 1050 and abs(got[2020][1] - 300) <= 300 * relative_error() and got[2020][2] == 1
    assert got[None] == (3, 1, 1)


def test_large_counts_stay_within_the_bound(spark):
    rows = spark.range(200_000).select(
        (F.col("id") % 60_000).cast("string").alias("client_id"),
        F.concat(F.lit("2020-"), F.lpad((F.col("id") % 12 + 1).cast("string"), 2, "0"), F.lit("-01")).alias("date"),
        F.lit("m").alias("merchant_id"),
    )
    year = united(monthly_sketches(rows, "client_id"), F.year("month_start").alias("year"), "client_id")
    assert year.select(within_error(F.col("distinct_client_id"), F.lit(60_000))).first()[0]
    assert not year.select(within_error(F.col("distinct_client_id"), F.lit(80_000))).first()[0]


def test_no_rows(spark):
    empty = monthly_sketches(spark.createDataFrame([], COLUMNS), "client_id")
    assert united(empty, F.year("month_start").alias("year"), "client_id").count() == 0
