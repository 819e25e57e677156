"""Stored tables. The format is a parameter; ``delta`` works where its package is installed."""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

DEFAULT_FORMAT = "parquet"
#: Of clustered tables: bytes of a file before compression, files at most, bytes of a row group.
FILE_BYTES, MOST_FILES, ROW_GROUP_BYTES = 1 << 30, 100_000, 16 << 20


def read_table(spark: SparkSession, path: str, fmt: str = DEFAULT_FORMAT) -> DataFrame:
    return spark.read.format(fmt).load(path)


def write_table(
    df: DataFrame,
    path: str,
    fmt: str = DEFAULT_FORMAT,
    partition_by: Sequence[str] = (),
    mode: str = "overwrite",
) -> None:
    """Replace the table at ``path``.

    With ``partition_by`` the rows are first rebalanced on those columns: one task then writes
    few partitions, and AQE splits a value that holds too many rows over several tasks, so the
    files come out near the advisory size instead of one per task and value.
    """
    if partition_by:
        df = df.hint("rebalance", *partition_by)
    writer = df.write.format(fmt).mode(mode)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.save(path)


def write_bucketed(
    df: DataFrame, name: str, path: str, buckets: int, keys: Sequence[str], sort: Sequence[str]
) -> DataFrame:
    """Replace the external parquet table ``name``, hashed into ``buckets`` files by ``keys``.

    Later group-bys, windows and joins on ``keys`` read it without a shuffle. Only for tables
    in which no key value can be hot, because one task reads one bucket. Each run writes a folder
    of its own below ``path`` and takes over the name once it is whole; the earlier table is named
    aside until then, and a run that fails gives it its name back. The folder replaced is deleted last.
    """
    spark = df.sparkSession
    run = uuid.uuid4().hex
    fresh, aside = f"{name}_{run}", f"{name}_{run}_old"
    old = _location(spark, name)
    try:
        (
            df.repartition(buckets, *keys)
            .write.format("parquet")
            .bucketBy(buckets, *keys)
            .sortBy(*sort)
            .option("path", f"{path}/{run}")
            .saveAsTable(fresh)
        )
        if old is not None:
            spark.sql(f"ALTER TABLE {name} RENAME TO {aside}")
        spark.sql(f"ALTER TABLE {fresh} RENAME TO {name}")
    except Exception:
        spark.sql(f"DROP TABLE IF EXISTS {fresh}")
        if spark.catalog.tableExists(aside):
            spark.sql(f"ALTER TABLE {aside} RENAME TO {name}")
        raise
    if old is not None:
        spark.sql(f"DROP TABLE {aside}")
        folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(old)
        files = folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
        files.delete(folder, True)
    return spark.table(name)


def write_clustered(
    df: DataFrame, path: str, key: str, order: Sequence[str] = (), files: int | None = None
) -> None:
    """Replace the Parquet table at ``path``, its files being ranges of ``key``, with Bloom filters on it.

    A look-up of one key then opens the files whose range holds it, and of their row groups those whose
    filter knows it. Ranges are cut by key and then by ``order``, so that a hot key fills several files.
    ``files`` follows from the bytes unless given.
    """
    if files is None:
        size = int(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())
        files = min(MOST_FILES, max(1, -(-size // FILE_BYTES)))
    (
        df.repartitionByRange(files, key, *order).sortWithinPartitions(key, *order)
        .write.mode("overwrite")
        .option(f"parquet.bloom.filter.enabled#{key}", "true")
        .option("parquet.block.size", ROW_GROUP_BYTES)
        .parquet(path)
    )


def look_up(spark: SparkSession, path: str, key: str, value: object, schema: T.StructType | None = None) -> DataFrame:
    """The rows of one key of a clustered table. Give ``schema`` to spare the reading of a footer."""
    reader = spark.read if schema is None else spark.read.schema(schema)
    return reader.parquet(path).filter(F.col(key) == F.lit(value))


def _location(spark: SparkSession, name: str) -> str | None:
    """Folder of a catalog table, or None if there is no such table."""
    if not spark.catalog.tableExists(name):
        return None
    rows = spark.sql(f"DESCRIBE TABLE EXTENDED {name}").filter("col_name = 'Location'").collect()
    return rows[0]["data_type"] if rows else None


def table_exists(spark: SparkSession, path: str, fmt: str = DEFAULT_FORMAT) -> bool:
    try:
        read_table(spark, path, fmt)
    except AnalysisException as error:
        if error.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA", "DELTA_TABLE_NOT_FOUND"):
            return False
        raise
    return True


def read_table_or_empty(
    spark: SparkSession, path: str, schema: T.StructType, fmt: str = DEFAULT_FORMAT
) -> DataFrame:
    """The table at ``path``, or no rows of ``schema`` while nothing has been written there."""
    if table_exists(spark, path, fmt):
        return read_table(spark, path, fmt)
    return spark.createDataFrame([], schema)
