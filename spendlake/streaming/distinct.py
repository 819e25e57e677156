"""Silver transactions of which each is written once, however often it is delivered.

Card processors deliver a transaction again after a correction or a lost acknowledgement. The stream
remembers each id for a stated time after the transaction, in a state store on disk, and drops
what comes again within it. Rows older than that when they arrive are dropped too, as nothing tells
whether they were seen: the state is bounded by the rows of that time, not by all of history.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from spendlake.functions import clean_category
from spendlake.operators.cleaning import clean_transactions
from spendlake.operators.enrich import add_category
from spendlake.schemas import BRONZE_TRANSACTIONS
from spendlake.session import rocksdb_state, settings, shuffles_freed
from spendlake.sources.files import strict_csv_options
from spendlake.sources.lake import DEFAULT_FORMAT

#: A run adds the ids of a whole delivery and drops those whose time is over. The next one loads what is left, which
#: takes less disk and time than all changes again: the state is packed and stored itself, not the log of its changes.
PACKED_STATE = {
    "spark.sql.streaming.stateStore.compression.codec": "zstd",
    "spark.sql.streaming.stateStore.rocksdb.compression": "zstd",
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "false",
    "spark.sql.streaming.stateStore.rocksdb.compactOnCommit": "true",
    "spark.sql.streaming.stateStore.rocksdb.trackTotalNumberOfRows": "false",
    "spark.sql.streaming.stateStore.rocksdb.blockSizeKB": "32",
    # what a repeated batch starts from, and the state it had made
    "spark.sql.streaming.minBatchesToRetain": "2",
}


def distinct_within(transactions: DataFrame, delay: str, key: str = "id", moment: str = "date") -> DataFrame:
    """The first row of each ``key``; ``delay`` is how long after the latest ``moment`` a copy may still come.

    Rows without a readable moment cannot be placed in time and are left out.
    """
    dated = transactions.filter(F.col(moment).isNotNull())
    return dated.withWatermark(moment, delay).dropDuplicatesWithinWatermark([key])


#: Moved as they are; all other columns of a transaction are text.
_TYPED = ("id", "date", "amount")
_TEXTS = [c for c in BRONZE_TRANSACTIONS.fieldNames() if c not in _TYPED]


def _packed(transactions: DataFrame) -> DataFrame:
    """The texts of a row in one column, which is shorter to shuffle than many."""
    return transactions.select(*_TYPED, F.to_json(F.array(*_TEXTS)).alias("texts"))


def _unpacked(packed: DataFrame) -> DataFrame:
    texts = packed.withColumn("texts", F.from_json("texts", "array<string>"))
    return texts.select(*_TYPED, *[F.col("texts")[i].alias(c) for i, c in enumerate(_TEXTS)]).select(
        *BRONZE_TRANSACTIONS.fieldNames()
    )


def stream_distinct_transactions(
    spark: SparkSession,
    csv_folder: str,
    categories: DataFrame,
    out: str,
    checkpoint: str,
    delay: str = "30 days",
    fmt: str = DEFAULT_FORMAT,
    max_files_per_batch: int | None = None,
) -> StreamingQuery:
    """Start an ``availableNow`` run over the new files; dates become timestamps.

    The first run fixes the number of state stores, the session's ``spark.sql.shuffle.partitions``.
    """
    reader = spark.readStream.schema(BRONZE_TRANSACTIONS).options(**strict_csv_options())
    if max_files_per_batch:
        reader = reader.option("maxFilesPerTrigger", max_files_per_batch)
    raw = reader.option("maxFileAge", "36500d").csv(csv_folder)
    # the category follows from the code, so it is not moved with the rows but looked up after, one for each code
    plain = clean_transactions(raw.withColumn("category_name", F.lit(None).cast("string")), parse_dates=True)
    once = _unpacked(distinct_within(_packed(plain.drop("category_name")), delay))
    named = add_category(once, categories.dropDuplicates(["mcc"]))
    silver = named.withColumn("category_name", clean_category(F.col("category_name")))
    with rocksdb_state(spark), settings(spark, PACKED_STATE), shuffles_freed(spark):
        return (
            silver.writeStream.format(fmt)
            .outputMode("append")
            .option("compression", "zstd")
            .option("checkpointLocation", checkpoint)
            .trigger(availableNow=True)
            .start(out)
        )
