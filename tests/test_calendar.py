import random

from spendlake.operators.monthly import calendar_features, client_months, time_series_features

COLUMNS = "client_id string, date string, amount double"


def months_of(spark, rows):
    return client_months(spark.createDataFrame(rows, COLUMNS))


def rows_of(df):
    return [tuple(r) for r in df.orderBy("client_id", "txn_month").collect()]


WORKED = [
    ("a", "2020-11-05 00:00:00", -60.0), ("a", "2021-01-31 23:59:59", -40.01), ("a", "2021-02-01 00:00:00", -0.5),
    ("a", "2021-06-01 00:00:00", -9.0), ("b", "2020-01-01 00:00:00", -1.0), ("b", "no date", -5.0), ("b", "no date", -2.0),
]


def test_gaps_are_gaps(spark):
    assert rows_of(calendar_features(months_of(spark, WORKED))) == [
        ("a", "2020-11", 60.0, None, None, None, None),
        ("a", "2021-01", 40.01, None, 60.0, None, 60.0),
        ("a", "2021-02", 0.5, 40.01, None, 60.0, 50.01),
        ("a", "2021-06", 9.0, None, None, None, None),
        ("b", None, 7.0, None, None, None, None),
        ("b", "2020-01", 1.0, None, None, None, None),
    ]


def test_gaps_as_zero(spark):
    assert rows_of(calendar_features(months_of(spark, WORKED), absent_is_zero=True)) == [
        ("a", "2020-11", 60.0, 0.0, 0.0, 0.0, 0.0),
        ("a", "2021-01", 40.01, 0.0, 60.0, 0.0, 20.0),
        ("a", "2021-02", 0.5, 40.01, 0.0, 60.0, 33.34),
        ("a", "2021-06", 9.0, 0.0, 0.0, 0.0, 0.0),
        ("b", None, 7.0, None, None, None, None),
        ("b", "2020-01", 1.0, 0.0, 0.0, 0.0, 0.0),
    ]


def test_one_window(spark, plan_of):
    plan = plan_of(calendar_features(months_of(spark, WORKED)))
    assert plan.count("+- Window ") == 1 and plan.count("Exchange hashpartitioning") == 2


def test_row_lags_and_calendar_lags_differ_exactly_at_gaps(spark):
    rng = random.Random(3)
    rows = [(f"c{c}", f"20{y}-{m:02}-01 00:00:00", -float(1 + c + m)) for c in range(6) for y in (10, 11) for m in range(1, 13) if rng.random() < 0.5]
    months = months_of(spark, rows)
    by_row = {r[:2]: r[3] for r in rows_of(time_series_features(months))}
    by_month = {r[:2]: r[3] for r in rows_of(calendar_features(months))}
    active = set(by_row)

    def follows(client, month):
        year, number = int(month[:4]), int(month[5:])
        return (client, f"{year - (number == 1)}-{(number - 2) % 12 + 1:02}") in active

    for key, lag in by_month.items():
        assert lag == (by_row[key] if follows(*key) else None)
    gaps = [k for k in active if by_row[k] is not None and not follows(*k)]
    assert len(gaps) > 10 and all(by_month[k] is None for k in gaps)


def test_no_rows(spark):
    assert calendar_features(months_of(spark, [])).count() == 0
