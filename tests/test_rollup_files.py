"""The rows of a batch are stored by the tasks that cleaned them."""

from spendlake.streaming.rollup import _replace


def test_a_batch_is_written_without_a_shuffle(spark, tmp_path):
    path = str(tmp_path / "silver")
    for _ in range(2):
        rows = spark.range(100, numPartitions=5).selectExpr("id", "7L AS batch_id")
        _replace(rows, path, "parquet", "batch_id", rebalance=False)
    stored = spark.read.parquet(path)
    assert stored.count() == stored.filter("batch_id = 7").count() == 100
    assert len(stored.inputFiles()) == 5
