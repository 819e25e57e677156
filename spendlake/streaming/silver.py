"""Incremental silver transactions: each run cleans only the files that arrived since the last."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from spendlake.operators.cleaning import clean_transactions
from spendlake.operators.enrich import add_category
from spendlake.schemas import BRONZE_TRANSACTIONS
from spendlake.sources.files import strict_csv_options
from spendlake.sources.lake import DEFAULT_FORMAT


def stream_silver_transactions(
    spark: SparkSession,
    csv_folder: str,
    categories: DataFrame,
    out: str,
    checkpoint: str,
    fmt: str = DEFAULT_FORMAT,
    parse_dates: bool = False,
    max_files_per_batch: int | None = None,
) -> StreamingQuery:
    """Start an ``availableNow`` run; it ends once all files present at its start are written.

    Reuses the batch operators, which keep no state, so the stream needs no watermark. Finished
    files are remembered in ``checkpoint``, and a run repeated after a failure writes none twice.
    """
    reader = spark.readStream.schema(BRONZE_TRANSACTIONS).options(**strict_csv_options())
    if max_files_per_batch:
        reader = reader.option("maxFilesPerTrigger", max_files_per_batch)
    silver = clean_transactions(add_category(reader.csv(csv_folder), categories), parse_dates)
    return (
        silver.writeStream.format(fmt)
        .outputMode("append")
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start(out)
    )
