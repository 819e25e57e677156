"""Quality by importance resampling.

Two generative models over hashed words and word pairs, one of target texts and one of all raw
texts, give each document the log ratio of its probabilities. Adding Gumbel noise, fixed by the
document's id, and keeping the largest keys draws without replacement in proportion to
those ratios. The cut between kept and left is found exactly by counting keys in ever finer
intervals; no key list reaches the driver.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from spendlake.llm.common import bottom_rows, map_arrow, materialize, text_rows, with_row_id
from spendlake.llm.wordhash import BLANK_SEPARATED, hashed_words, mix

BUCKET_BITS = 16
SMOOTHING = 1.0
#: Bounds of the target sample.
TARGET_ROWS = 20_000
TARGET_BYTES = 1 << 15
KEEP_SHARE = 0.5
SEED = 42
_INTERVALS = 4096


def _features(counts: np.ndarray, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of all words, then of the pairs inside a row, each with its row."""
    row = np.repeat(np.arange(len(counts)), counts)
    shift = np.uint64(64 - BUCKET_BITS)
    words = (hashes >> shift).astype(np.int64)
    inside = row[1:] == row[:-1]
    pairs = (mix(mix(hashes[:-1]) + hashes[1:]) >> shift).astype(np.int64)[inside]
    return np.concatenate((words, pairs)), np.concatenate((row, row[1:][inside]))


def _count_batches(batches) -> Iterator[pa.RecordBatch]:
    """Feature counts of a task's texts: one small vector a task, however much it reads."""
    total = np.zeros(1 << BUCKET_BITS, np.int64)
    for batch in batches:
        for _, counts, hashes in hashed_words(text_rows(batch), BLANK_SEPARATED):
            total += np.bincount(_features(counts, hashes)[0], minlength=len(total))
    full = np.flatnonzero(total)
    yield pa.RecordBatch.from_arrays([pa.array(full), pa.array(total[full])], ["bucket", "n"])


def feature_counts(docs: DataFrame) -> np.ndarray:
    """Feature counts over all texts of ``docs`` (``text``)."""
    counted = (
        docs.select("text").transform(map_arrow, _count_batches, "bucket long, n long")
        .groupBy("bucket").agg(F.sum("n").alias("n")).toArrow()
    )
    total = np.zeros(1 << BUCKET_BITS)
    total[counted.column("bucket").to_numpy()] = counted.column("n").to_numpy()
    return total


def _log_share(counts: np.ndarray) -> np.ndarray:
    smoothed = counts + SMOOTHING
    return np.log(smoothed / smoothed.sum())


def _weigh_batches(batches, ratio) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts = text_rows(batch)
        weight = np.zeros(len(texts))
        for a, counts, hashes in hashed_words(texts, BLANK_SEPARATED):
            bucket, row = _features(counts, hashes)
            weight[a : a + len(counts)] = np.bincount(row, weights=ratio.value[bucket], minlength=len(counts))
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), batch.column(2), pa.array(weight)], ["doc_id", "row_id", "log_weight"]
        )


def target_sample(docs: DataFrame, target_ids: DataFrame, rows: int = TARGET_ROWS) -> DataFrame:
    """A bounded sample of the texts whose ``doc_id`` is in ``target_ids``; the ids are sent out."""
    chosen = bottom_rows(target_ids.select("doc_id").filter("doc_id is not null").distinct(), "doc_id", rows)
    return docs.filter(F.octet_length("text") <= TARGET_BYTES).join(F.broadcast(chosen), "doc_id").select("text")


def largest(keyed: DataFrame, k: int) -> DataFrame:
    """``keyed`` with ``selected`` for exactly the ``k`` rows of largest ``key``; ties by least ``row_id``.

    Each round counts keys in equal intervals and goes on inside the one where the cut lies, until it
    is a single value; ties are then cut the same way by ``row_id``.
    """

    def cut(df: DataFrame, column: str, wanted: int) -> tuple[float | None, int]:
        """Value at the cut of the largest ``wanted``, and how many rows of that value are in."""
        if wanted <= 0:
            return None, 0
        low, high = df.agg(F.min(column), F.max(column)).first()
        while low is not None and low < high:
            width = high / _INTERVALS - low / _INTERVALS
            number = F.least(F.floor((F.col(column) - F.lit(low)) / F.lit(width)), F.lit(_INTERVALS - 1)).alias("at")
            counts = (
                df.filter(F.col(column).between(low, high)).groupBy(number)
                .agg(F.count("*").alias("n"), F.min(column).alias("low"), F.max(column).alias("high"))
                .orderBy(F.desc("low")).collect()
            )
            for row in counts:
                if row.n >= wanted:
                    low, high = row.low, row.high
                    break
                wanted -= row.n
            else:
                return low, wanted
        return low, wanted

    threshold, inside = cut(keyed, "key", k)
    if threshold is None:
        return keyed.withColumn("selected", F.lit(False))
    ties = keyed.filter(F.col("key") == F.lit(threshold)).withColumn("rank", -F.col("row_id").cast("double"))
    last, _ = cut(ties, "rank", inside)
    chosen = (F.col("key") > threshold) | ((F.col("key") == threshold) & (-F.col("row_id").cast("double") >= last))
    return keyed.withColumn("selected", chosen)


def resample(
    docs: DataFrame, target_ids: DataFrame, keep_share: float = KEEP_SHARE, seed: int = SEED
) -> DataFrame:
    """``doc_id, log_weight, key, selected`` for every row of ``docs`` (``doc_id, text``).

    The nearest whole number to ``keep_share`` of the rows is selected. Null and empty texts have
    weight zero, as likely under one model as under the other. Repeated rows share a key and are
    cut by their order in the written table. Without target texts the target model is uniform.
    Further columns are ignored; an empty table gives no rows.
    """
    spark = docs.sparkSession
    raw = _log_share(feature_counts(docs))
    target = _log_share(feature_counts(target_sample(docs, target_ids)))
    ratio = spark.sparkContext.broadcast(target - raw)
    noise = (F.pmod(F.xxhash64(F.lit(seed), F.col("doc_id")), F.lit(1 << 52)) + 0.5) / F.lit(float(1 << 52))
    keyed = materialize(
        with_row_id(docs.select("doc_id", "text"))
        .transform(map_arrow, partial(_weigh_batches, ratio=ratio), "doc_id long, row_id long, log_weight double")
        .withColumn("key", F.col("log_weight") - F.log(-F.log(noise)))
    )
    return largest(keyed, round(keep_share * keyed.count())).select("doc_id", "log_weight", "key", "selected")
