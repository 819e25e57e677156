"""Exact deduplication as a stream with disk-backed state.

Documents arrive as files. A streaming aggregation keeps, for every digest of a normalised text, the
stable identifier of the row that stays, the locator of its content (file and row) and the number of
rows, in RocksDB below the checkpoint folder. The state has no expiry, so a copy is found however late
it comes, and a run that ends early goes on where it stopped. Only digests, ids and locators move.

A digest that comes again is a hit, and hits are checked by their full bytes: the texts of all rows with
such a digest, one copy of each per task, are grouped by their bytes. Rows whose digest stands
for more than one text are told apart by the text itself. A bitmap of fixed size, a bit for each digest
hit, keeps all other texts out of that step.

Built-in functions only; no Python touches a row.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from spendlake.llm.common import materialize, scratch_dir
from spendlake.session import rocksdb_state

#: Bytes of input that a micro-batch reads.
BATCH_BYTES = 64 << 30
#: Bits of the bitmap of hits: 2 MiB whatever the input's size.
BITMAP_BITS = 1 << 24

Digest = Callable[[Column], Column]

def normalised(text: Column) -> Column:
    """Each run of white space as one space; null as empty."""
    # single spaces stay as they are and need no replacing
    return F.regexp_replace(F.coalesce(text, F.lit("")), r"[\x20\x09-\x0D]{2,}|[\x09-\x0D]", " ")


def sha256(text: Column) -> Column:
    return F.unhex(F.sha2(text, 256))


def _located(files: DataFrame, digest: Digest) -> DataFrame:
    """``doc_id, text, digest, locator`` of each row of Parquet files; the text is normalised."""
    return files.select(
        "doc_id",
        normalised(F.col("text")).alias("text"),
        F.struct(F.col("_metadata.file_path").alias("file"), F.col("_metadata.row_index").alias("row")).alias("locator"),
    ).withColumn("digest", digest(F.col("text")))


class StreamDedup:
    """Deduplicates the Parquet files below ``source``, which may grow between runs.

    ``root`` keeps the stream's checkpoint and with it the state. The number of state stores is the
    session's ``spark.sql.shuffle.partitions`` at the first run. ``batch_bytes`` bounds a micro-batch.
    Files must not be rewritten: their rows are found again by file and place.
    """

    def __init__(
        self, spark: SparkSession, source: str, root: str, digest: Digest = sha256, batch_bytes: int = BATCH_BYTES
    ):
        self.spark, self.source, self.root = spark, source.rstrip("/"), root
        self.digest, self.batch_bytes = digest, batch_bytes

    def ingest(self) -> None:
        """Take all files that are new since the last run into the state."""
        schema = self.spark.read.parquet(self.source).schema
        files = (
            self.spark.readStream.schema(schema)
            # no file is too old, whenever it arrives
            .option("maxFileAge", "36500d")
            .option("maxBytesPerTrigger", str(self.batch_bytes))
            # a pattern that only the source matches: a plain path must be a folder here, not a single file
            .parquet(f"{self.source[:-1]}[{self.source[-1]}]")
        )
        # rows without id come last; equal ids go by place
        first = F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "locator")
        groups = _located(files, self.digest).groupBy("digest").agg(
            F.min(first).alias("first"), F.count(F.lit(1)).alias("n")
        )
        with rocksdb_state(self.spark):
            run = (
                groups.writeStream.format("noop").outputMode("update")
                .option("checkpointLocation", self.root).trigger(availableNow=True).start()
            )
            run.awaitTermination()

    def groups(self) -> DataFrame:
        """The state as a stored table: ``digest, first (no_id, doc_id, locator), n``."""
        with rocksdb_state(self.spark):
            state = self.spark.read.format("statestore").load(self.root)
            value = state.schema["value"].dataType.names
            return materialize(
                state.select(
                    F.col("key.digest").alias("digest"),
                    F.col(f"value.{value[0]}").alias("first"),
                    F.col(f"value.{value[1]}").alias("n"),
                )
            )

    def rows(self) -> DataFrame:
        """``doc_id, text, digest, locator`` of all rows of the files."""
        return _located(self.spark.read.parquet(self.source), self.digest)

    def result(self) -> DataFrame:
        """One row per document: ``doc_id, keep_id, group_size, kept, text_sha256``."""
        groups = self.groups()
        rows = self.rows()
        found = rows.select("doc_id", "locator", "digest", F.sha2("text", 256).alias("text_sha256"))
        found = found.join(groups, "digest")
        shared = materialize(self.shared_digests(rows, groups))
        if not shared.isEmpty():  # one digest for several texts: the text decides
            # as many as hits, so neither side is broadcast by hint
            apart = rows.join(shared, "digest", "left_semi")
            first = F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "locator")
            texts = apart.groupBy("digest", "text").agg(F.min(first).alias("first"), F.count(F.lit(1)).alias("n"))
            apart = apart.withColumn("text_sha256", F.sha2("text", 256)).join(texts, ["digest", "text"])
            found = found.join(shared, "digest", "left_anti").unionByName(apart.drop("text"))
        return found.select(
            "doc_id",
            F.col("first.doc_id").alias("keep_id"),
            F.col("n").alias("group_size"),
            (F.col("locator") == F.col("first.locator")).alias("kept"),
            "text_sha256",
        )

    def shared_digests(self, rows: DataFrame, groups: DataFrame) -> DataFrame:
        """Digests of hits whose full bytes differ: ``digest``."""
        slot = F.pmod(F.xxhash64("digest"), F.lit(BITMAP_BITS)) + 1
        # at most 512 rows of 4 KiB
        hit = groups.filter("n > 1").groupBy(F.bitmap_bucket_number(slot).alias("bucket")).agg(
            F.bitmap_construct_agg(F.bitmap_bit_position(slot)).alias("bits")
        )
        place = F.bitmap_bit_position(slot)
        byte = F.conv(F.hex(F.substring("bits", (place / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
        is_hit = F.getbit(byte, (place % 8).cast("int")) == 1
        texts = rows.select("digest", "text").withColumn("bucket", F.bitmap_bucket_number(slot))
        texts = texts.join(F.broadcast(hit), "bucket").filter(is_hit)
        # copies of a text merge within each task before they move
        return texts.select("digest", "text").distinct().groupBy("digest").count().filter("count > 1").select("digest")


def deduplicate(spark: SparkSession, source: str, root: str | None = None, **options) -> DataFrame:
    """Stream the Parquet files at ``source`` (``doc_id``, ``text``) through the state and report every row.

    Texts are equal when identical after replacing each run of white space by one space; null is
    empty. Of equal texts the row of the smallest ``doc_id`` stays; rows without id come last, equal
    ids go by file and row, so that exactly one row of a group is kept. Texts of any length are read whole;
    other columns, of any name, are not read; an empty table gives an empty result.
    """
    stream = StreamDedup(spark, source, root or scratch_dir(spark), **options)
    stream.ingest()
    return stream.result()
