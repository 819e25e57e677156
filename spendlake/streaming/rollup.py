"""The monthly roll-up kept up to date by a stream.

Every batch of raw files is cleaned once and stored as silver rows of that batch. Its sums per client
and month are stored as the batch's part; then the months that the batch touches, and only those, are
summed anew from the parts of all batches. Each of the three writes replaces whole partitions: a batch
that is repeated after a failure writes what it wrote before, and nothing is counted twice.
"""

from __future__ import annotations

from collections.abc import Callable
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from spendlake.functions import month_label
from spendlake.operators.cleaning import clean_transactions
from spendlake.operators.enrich import add_category
from spendlake.operators.monthly import client_months
from spendlake.schemas import BRONZE_TRANSACTIONS
from spendlake.sources.files import strict_csv_options
from spendlake.sources.lake import DEFAULT_FORMAT

_SUMS = "spend decimal(38,10), discretionary decimal(38,10)"
MONTHS_SCHEMA = f"client_id string, month_start date, {_SUMS}, txn_month string"
PARTS_SCHEMA = f"client_id string, month_start date, {_SUMS}, batch_id long, txn_month string"


class RollupTables(NamedTuple):
    """Folders of the silver rows by batch, the parts by batch and month, and the roll-up by month."""

    silver: str
    parts: str
    months: str
    fmt: str = DEFAULT_FORMAT

    def read_months(self, spark: SparkSession) -> DataFrame:
        return spark.read.format(self.fmt).schema(MONTHS_SCHEMA).load(self.months)


def _replace(df: DataFrame, path: str, fmt: str, *partitions: str, rebalance: bool = True) -> None:
    """Write ``df``; partitions that it has rows of are replaced, all others keep their files.

    Without ``rebalance``, for rows of one partition, each task writes its own file and nothing is shuffled.
    """
    (
        (df.hint("rebalance", *partitions) if rebalance else df)
        .write.format(fmt).mode("overwrite").option("partitionOverwriteMode", "dynamic")
        .option("compression", "zstd")
        .partitionBy(*partitions).save(path)
    )


def touched_months(part: DataFrame) -> list[str | None]:
    """The months a batch has rows of: at most as many as the calendar has, and null for unreadable dates."""
    return [row.txn_month for row in part.select("txn_month").distinct().collect()]


def _any_of(months: list[str | None]) -> Column:
    """A filter on the partition column, so that only these months are listed and read."""
    known = F.col("txn_month").isin(*[m for m in months if m is not None])
    return known | F.col("txn_month").isNull() if None in months else known


def add_batch(silver: DataFrame, batch_id: int, tables: RollupTables) -> list[str | None]:
    """Add silver transactions to the roll-up under the number of their batch; gives the touched months.

    The same batch given again changes nothing, in whatever order batches are repeated.
    """
    spark, fmt = silver.sparkSession, tables.fmt
    _replace(silver.withColumn("batch_id", F.lit(batch_id).cast("long")), tables.silver, fmt, "batch_id", rebalance=False)
    stored = spark.read.format(fmt).schema(silver.withColumn("batch_id", F.lit(0).cast("long")).schema)
    own = stored.load(tables.silver).filter(F.col("batch_id") == batch_id)
    sums = client_months(own).withColumn("batch_id", F.lit(batch_id).cast("long"))
    _replace(sums.withColumn("txn_month", month_label(F.col("month_start"))), tables.parts, fmt, "batch_id", "txn_month")
    parts = spark.read.format(fmt).schema(PARTS_SCHEMA).load(tables.parts)
    touched = touched_months(parts.filter(F.col("batch_id") == batch_id))
    if touched:
        months = (
            parts.filter(_any_of(touched))
            .groupBy("client_id", "month_start", "txn_month")
            .agg(F.sum("spend").alias("spend"), F.sum("discretionary").alias("discretionary"))
        )
        _replace(months, tables.months, fmt, "txn_month")
    return touched


def stream_client_months(
    spark: SparkSession,
    csv_folder: str,
    categories: Callable[[SparkSession], DataFrame],
    tables: RollupTables,
    checkpoint: str,
    parse_dates: bool = False,
    max_files_per_batch: int | None = None,
) -> StreamingQuery:
    """Start an ``availableNow`` run over the raw files that are new; it ends once they are in the roll-up.

    ``categories`` reads the category dictionary, anew for every batch.
    """
    reader = spark.readStream.schema(BRONZE_TRANSACTIONS).options(**strict_csv_options())
    if max_files_per_batch:
        reader = reader.option("maxFilesPerTrigger", max_files_per_batch)

    def apply(batch: DataFrame, batch_id: int) -> None:
        rows = add_category(batch, categories(batch.sparkSession))
        add_batch(clean_transactions(rows, parse_dates), batch_id, tables)

    return (
        reader.option("maxFileAge", "36500d").csv(csv_folder).writeStream.foreachBatch(apply)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
