"""Helpers the text operators share: inputs, row ids, bounded samples, Arrow text access."""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from spendlake.session import materialize, scratch_dir

__all__ = [
    "HASH_SEED", "bottom_rows", "hex64", "let", "map_arrow", "materialize", "pick_name", "read_input", "scratch_dir",
    "text_rows", "with_row_id",
]

HASH_SEED = 42


def read_input(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def pick_name(df: DataFrame, stem: str) -> str:
    """A column name that ``df`` does not use yet, whatever extra columns it carries."""
    taken = {c.lower() for c in df.columns}
    while stem.lower() in taken:
        stem = f"_{stem}"
    return stem


def let(value: Column, body) -> Column:
    """``body(value)`` with ``value`` computed once per row.

    Referring to a costly expression inside a lambda would otherwise compute it once per element.
    """
    return F.transform(F.array(value), body)[0]


def hex64(value: Column) -> Column:
    """Sixteen lower-case hex digits of a long."""
    return F.lower(F.lpad(F.hex(value), 16, "0"))


def with_row_id(df: DataFrame, name: str = "row_id") -> DataFrame:
    """Number the rows, for tables that are written before the number is used: it is not repeatable."""
    return df.withColumn(name, F.monotonically_increasing_id())


def bottom_rows(df: DataFrame, key: str, limit: int) -> DataFrame:
    """A bounded, repeatable sample: the ``limit`` rows with the smallest hash of ``key``."""
    return df.orderBy(F.xxhash64(F.col(key), F.lit("sample")), F.col(key)).limit(limit)


#: What one Arrow batch may hold, for tables of texts and pages.
BATCH_ROWS, BATCH_BYTES = 1024, 8 << 20


def map_arrow(df: DataFrame, function, schema) -> DataFrame:
    """``df.mapInArrow`` over batches of bounded size.

    The limits are settings of the session, whose defaults suit short rows: a batch of ten thousand
    texts, once on its way in and once out for every task, outgrows a small executor. A smaller
    limit that the session has already stays.
    """
    conf = df.sparkSession.conf
    for key, limit in (("maxRecordsPerBatch", BATCH_ROWS), ("maxBytesPerBatch", BATCH_BYTES)):
        name = f"spark.sql.execution.arrow.{key}"
        have = int(re.match(r"-?\d+", conf.get(name))[0])
        if not 0 < have <= limit:
            conf.set(name, str(limit))
    return df.mapInArrow(partial(_released, function=function), schema)


def _released(batches: Iterator[pa.RecordBatch], function) -> Iterator[pa.RecordBatch]:
    """Give Arrow's unused memory back at the end of a task: the worker idles on beside later stages."""
    yield from function(batches)
    pa.default_memory_pool().release_unused()


def text_rows(batch: pa.RecordBatch, column: str = "text") -> list[bytes]:
    """The UTF-8 bytes of a text column; null is empty."""
    values = batch.column(batch.schema.get_field_index(column))
    return [b"" if v is None else v for v in values.cast(pa.binary()).to_pylist()]


def groups_by_size(sizes: np.ndarray, limit: int) -> Iterator[tuple[int, int]]:
    """Consecutive row ranges of at most ``limit`` bytes; a larger row stands alone."""
    start, total = 0, 0
    for i, size in enumerate(sizes):
        if i > start and total + size > limit:
            yield start, i
            start, total = i, 0
        total += int(size)
    if start < len(sizes):
        yield start, len(sizes)
