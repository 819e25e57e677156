"""Wide transactions are joined with their users without being sorted."""

import pytest

from spendlake.operators.enrich import add_users


@pytest.mark.parametrize("salts", (None, 4))
def test_users_join_without_a_sort(spark, plan_of, salts):
    rows = spark.createDataFrame([("t1", "a"), ("t2", None), ("t3", "a")], "id string, client_id string")
    users = spark.createDataFrame([("a", 1), ("a", 2), (None, 3)], "id string, age int")
    joined = add_users(rows, users, salts)
    plan = plan_of(joined)
    assert "ShuffledHashJoin" in plan and "Sort" not in plan
    assert sorted(map(tuple, joined.select("transaction_id", "age").collect()), key=str) == [
        ("t1", 1), ("t1", 2), ("t2", None), ("t3", 1), ("t3", 2)
    ]
