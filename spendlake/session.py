"""Session factory, shuffle sizing and the shared scratch folder."""

from __future__ import annotations

import math
import re
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import AbstractContextManager, contextmanager

from pyspark.sql import DataFrame, SparkSession

#: AQE merges small shuffle partitions but never adds any, so it starts from many.
INITIAL_PARTITIONS = 16_384

BASE_CONF = {
    "spark.sql.adaptive.coalescePartitions.initialPartitionNum": str(INITIAL_PARTITIONS),
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    # Splits a hot join key into several tasks; see operators.enrich for the salted form.
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128m",
    # The silver stage writes one file per input split; text shrinks about fourfold in Parquet.
    # Small inputs are still cut by core, whatever this limit.
    "spark.sql.files.maxPartitionBytes": "512m",
}

LOCAL_CONF = {
    "spark.ui.enabled": "false",
    "spark.sql.shuffle.partitions": "8",
    "spark.sql.adaptive.coalescePartitions.initialPartitionNum": "8",
    "spark.driver.memory": "8g",
}


# What a session needs to read and write Delta tables.
DELTA_CONF = {
    "spark.sql.extensions": "io.delta.sql.DeltaSparkSessionExtension",
    "spark.sql.catalog.spark_catalog": "org.apache.spark.sql.delta.catalog.DeltaCatalog",
}

# Scratch folders of applications that the JVM already knows to delete.
_marked: set[str] = set()


def get_spark(
    app_name: str = "spendlake",
    master: str | None = None,
    conf: dict[str, str] | None = None,
    delta: bool = False,
    shuffle_bytes: int | None = None,
) -> SparkSession:
    """Session with the settings every operator here assumes.

    ``master`` stays unset on a cluster, where the submit command names it. ANSI mode is left
    at Spark 4's default (on); the operators use ``try_*`` where bad input must become null.
    ``delta`` needs the Delta package on the classpath. ``shuffle_bytes``, the size of the largest
    expected exchange, replaces the default start of :data:`INITIAL_PARTITIONS`, which suits
    exchanges of up to two terabytes: about 40 bytes per client and month for the roll-up, the
    width of a row for joins of transactions.
    """
    builder = SparkSession.builder.appName(app_name)
    settings = dict(BASE_CONF)
    if master is not None:
        builder = builder.master(master)
        if is_local(master):
            settings.update(LOCAL_CONF)
    if shuffle_bytes is not None:
        settings["spark.sql.adaptive.coalescePartitions.initialPartitionNum"] = str(
            shuffle_partitions_for(shuffle_bytes)
        )
    if delta:
        settings.update(DELTA_CONF)
    settings.update(conf or {})
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shuffle_partitions_for(shuffle_bytes: int, target_bytes: int = 128 << 20, cores: int = 8) -> int:
    """Initial shuffle partition count for a stage that moves ``shuffle_bytes``.

    AQE merges small partitions but never adds any, so the initial number has to be right for
    the largest exchange: about ``target_bytes`` each, and never fewer than the cores.
    """
    return max(cores, math.ceil(shuffle_bytes / target_bytes))


def is_local(master: str) -> bool:
    """Whether driver and executor are one process; ``local-cluster`` has executors of its own."""
    return re.fullmatch(r"local(\[.*\])?", master) is not None


def scratch_root(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    Only a local session that names none falls back to a temporary folder of this machine.
    """
    context = spark.sparkContext
    root = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if not root:
        if not is_local(context.master):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors can reach")
        root = tempfile.mkdtemp(prefix="spendlake-")
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(root)
    return root.rstrip("/")


def scratch_dir(spark: SparkSession) -> str:
    """Fresh folder below :func:`scratch_root`, in one of the application's own.

    The application's folder goes when the driver's JVM ends, whatever file system it is on.
    """
    own = f"{scratch_root(spark)}/{spark.sparkContext.applicationId}"
    if own not in _marked:
        jvm = spark.sparkContext._jvm
        path = jvm.org.apache.hadoop.fs.Path(own)
        files = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
        files.mkdirs(path)
        files.deleteOnExit(path)
        _marked.add(own)
    return f"{own}/{uuid.uuid4().hex}"


#: State of streams on disk instead of the heap, all stores of an executor within one bound, changes uploaded as logs.
STATE_CONF = {
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
    "spark.sql.streaming.stateStore.rocksdb.boundedMemoryUsage": "true",
    "spark.sql.streaming.stateStore.rocksdb.maxMemoryUsageMB": "256",
    # a store takes the disk its rows need, not four megabytes beforehand
    "spark.sql.streaming.stateStore.rocksdb.allowFAllocate": "false",
}


#: Shuffle files go when their execution ends, not when the driver happens to collect its garbage.
SHUFFLE_CONF = {"spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true"}


@contextmanager
def settings(spark: SparkSession, values: dict[str, str]) -> Iterator[None]:
    """The session's settings inside; those of before come back."""
    before = {key: spark.conf.get(key, None) for key in values}
    try:
        for key, value in values.items():
            spark.conf.set(key, value)
        yield
    finally:
        for key, value in before.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)


def rocksdb_state(spark: SparkSession) -> AbstractContextManager[None]:
    """Streams started and states read inside keep their state in RocksDB; the session's settings come back."""
    return settings(spark, STATE_CONF)


def shuffles_freed(spark: SparkSession) -> AbstractContextManager[None]:
    """Tables written and streams started inside leave no shuffle files behind."""
    return settings(spark, SHUFFLE_CONF)


def materialize(df: DataFrame) -> DataFrame:
    """Write ``df`` to the shared scratch folder and read it back.

    Cuts lineage for inputs that are scanned many times, such as model training data. Unlike
    executor-local storage it survives lost executors, and the columns stay prunable.
    """
    path = scratch_dir(df.sparkSession)
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def stored_bytes(df: DataFrame) -> int:
    """Size of the files that ``df`` reads, as Spark's own statistics have it; no job runs."""
    return int(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())
