"""Benchmark decontamination by a prefix-filtered set join.

A benchmark item is cut into item-sized windows of words, a window into shingles. Exact
containment needs every shingle of the window in the document, so one of them, the prefix, is
necessary; the rarest over all documents is chosen, which orders shingles by rarity. Documents
send only positions whose shingle may be a prefix (a bitmap of fixed size tells) together with the
words around it. The join on the prefix yields aligned candidates; position and length bounds
discard those whose window would overrun the document, and equality of the words verifies the rest.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from spendlake.llm.common import map_arrow, materialize, pick_name, text_rows, with_row_id
from spendlake.llm.wordhash import ALPHANUMERIC, hash_words, sequence_hash, word_bounds

WINDOW_WORDS = 13
SHINGLE_WORDS = 3
#: A document is contaminated from one hit word in this many on.
MAX_CLEAN_RATIO = 20
#: Bits of the broadcast bitmap, 2 MiB whatever the benchmark's size.
BITMAP_BITS = 1 << 24

_ITEM_SCHEMA = (
    "item_row long, item_id long, at int, window string, width int, "
    "shingles array<struct<hash:long,offset:int,length:int>>"
)


def _item_windows(batches, window_words: int, shingle_words: int) -> Iterator[pa.RecordBatch]:
    """A row per window of each item, with the window's shingles."""
    schema = pa.schema(
        [
            ("item_row", pa.int64()), ("item_id", pa.int64()), ("at", pa.int32()),
            ("window", pa.string()), ("width", pa.int32()),
            ("shingles", pa.list_(pa.struct([("hash", pa.int64()), ("offset", pa.int32()), ("length", pa.int32())]))),
        ]
    )
    for batch in batches:
        ids, rows = batch.column(0).to_pylist(), batch.column(2).to_pylist()
        for row, item, text in zip(rows, ids, text_rows(batch)):
            mapped = text.translate(ALPHANUMERIC)
            _, hashes = hash_words(mapped)
            words = mapped.split(b" ")
            words = [w for w in words if w]
            width = min(window_words, len(words))
            if not width:
                continue
            length = min(shingle_words, width)
            shingles = sequence_hash(hashes, length).view(np.int64).tolist()
            out = []
            for at in range(len(words) - width + 1):
                own = [
                    {"hash": shingles[at + k], "offset": k, "length": length}
                    for k in range(width - length + 1)
                ]
                text_at = b" ".join(words[at : at + width]).decode("utf-8", "replace")
                out.append((row, item, at, text_at, width, own))
            yield pa.RecordBatch.from_pylist([dict(zip(schema.names, x)) for x in out], schema)


def item_windows(items: DataFrame, window_words: int, shingle_words: int) -> DataFrame:
    """Windows of all items (``item_id, text``); items without words have none."""
    return with_row_id(items.select("item_id", "text"), "item_row").transform(
        map_arrow, partial(_item_windows, window_words=window_words, shingle_words=shingle_words), _ITEM_SCHEMA
    )


def _bitmap(hashes: DataFrame) -> np.ndarray:
    """One bit per slot of the ``hash`` values: at most ``BITMAP_BITS / 64`` rows reach the driver."""
    slot = F.shiftrightunsigned("hash", 40)
    words = hashes.groupBy(F.shiftright(slot, 6).alias("word")).agg(
        F.bit_or(F.expr("shiftleft(1L, cast(shiftrightunsigned(hash, 40) & 63 AS int))")).alias("bits")
    )
    bitmap = np.zeros(BITMAP_BITS // 64, np.int64)
    for row in words.toLocalIterator():
        bitmap[row.word] = row.bits
    return bitmap.view(np.uint64)


def _maybe(bitmap: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    slot = hashes >> np.uint64(40)
    return (bitmap[slot >> np.uint64(6)] >> (slot & np.uint64(63))) & np.uint64(1) == 1


def _count_shingles(batches, bitmap, lengths) -> Iterator[pa.RecordBatch]:
    """Documents per shingle that may be an item's, summed over each batch."""
    for batch in batches:
        seen = []
        for text in text_rows(batch):
            _, hashes = hash_words(text.translate(ALPHANUMERIC))
            for length in lengths:
                all_of = sequence_hash(hashes, length)
                seen.append(np.unique(all_of[_maybe(bitmap.value, all_of)]))
        found, counts = np.unique(np.concatenate(seen), return_counts=True) if seen else (np.zeros(0, np.uint64),) * 2
        yield pa.RecordBatch.from_arrays(
            [pa.array(found.view(np.int64)), pa.array(counts.astype(np.int64))], ["hash", "docs"]
        )


def _probe(batches, bitmap, lengths, window_words) -> Iterator[pa.RecordBatch]:
    """Per document its word count and, for positions that may hold a prefix, the words around it.

    ``before`` words precede the shingle in ``words``: as many as any window can start earlier.
    """
    probe = pa.struct(
        [("hash", pa.int64()), ("length", pa.int32()), ("pos", pa.int32()), ("before", pa.int32()), ("words", pa.string())]
    )
    for batch in batches:
        n_words, probes = [], []
        for text in text_rows(batch):
            mapped = text.translate(ALPHANUMERIC)
            _, hashes = hash_words(mapped)
            n_words.append(len(hashes))
            own, bounds = [], None
            for length in lengths:
                all_of = sequence_hash(hashes, length)
                hits = np.flatnonzero(_maybe(bitmap.value, all_of))
                if len(hits) and bounds is None:
                    bounds = word_bounds(mapped)
                for pos in hits.tolist():
                    reach = window_words - length
                    first = max(0, pos - reach)
                    last = min(len(hashes), pos + window_words) - 1
                    around = b" ".join(mapped[bounds[0][first] : bounds[1][last]].split())
                    own.append(
                        {
                            "hash": int(all_of[pos].view(np.int64)), "length": length, "pos": pos,
                            "before": pos - first, "words": around.decode("utf-8", "replace"),
                        }
                    )
            probes.append(own)
        yield pa.RecordBatch.from_arrays(
            [
                batch.column(0), batch.column(2), pa.array(n_words, pa.int64()),
                pa.array(probes, pa.list_(probe)),
            ],
            ["doc_id", "row_id", "n_words", "probes"],
        )


_PROBE_SCHEMA = (
    "doc_id long, row_id long, n_words long, "
    "probes array<struct<hash:long,length:int,pos:int,before:int,words:string>>"
)


def prefixes(windows: DataFrame, docs: DataFrame, lengths: list[int]) -> DataFrame:
    """Each window's rarest shingle over all documents: ``hash, offset, length, window, ...``.

    Shingles no document has come first: they prove that their window is in none.
    """
    shingles = windows.select("*", F.explode("shingles").alias("s")).select(
        "item_row", "item_id", "at", "window", "width", "s.*"
    )
    bitmap = docs.sparkSession.sparkContext.broadcast(_bitmap(shingles.select("hash").distinct()))
    counted = (
        docs.select("doc_id", "text")
        .transform(map_arrow, partial(_count_shingles, bitmap=bitmap, lengths=lengths), "hash long, docs long")
        .groupBy("hash").agg(F.sum("docs").alias("docs"))
    )
    rarity = F.coalesce("docs", F.lit(0))
    return (
        shingles.join(counted, "hash", "left")
        .groupBy("item_row", "item_id", "at", "window", "width")
        .agg(F.min(F.struct(rarity.alias("docs"), "hash", "offset", "length")).alias("p"))
        .filter("p.docs > 0")
        .select("item_row", "item_id", "window", "width", "p.hash", "p.offset", "p.length")
    )


def _covered(hits: DataFrame) -> DataFrame:
    """Words inside at least one hit interval, per document row."""
    order = W.partitionBy("row_id").orderBy("start", "end")
    before = F.max("end").over(order.rowsBetween(W.unboundedPreceding, -1))
    fresh = F.greatest(F.lit(0), F.col("end") - F.greatest("start", F.coalesce(before, F.lit(0))))
    return hits.select("row_id", fresh.cast("long").alias("fresh")).groupBy("row_id").agg(
        F.sum("fresh").alias("n_hit")
    )


def item_digest(items: Column) -> Column:
    """Hex digest of item ids, sorted as strings and joined by commas."""
    return F.sha2(F.array_join(F.array_sort(items), ","), 256)


def contamination(
    docs: DataFrame,
    items: DataFrame,
    window_words: int = WINDOW_WORDS,
    shingle_words: int = SHINGLE_WORDS,
    row_id: str | None = None,
) -> DataFrame:
    """Per row of ``docs``: ``doc_id, n_words, n_hit, n_items, item_ids, contaminated``.

    ``n_hit`` counts the document's words inside any occurrence of an item's window, ``item_ids``
    are the items that have one, as strings, and ``n_items`` their number. Null and empty texts have no
    words and are clean; items without words match nothing. Items without id match like others and count
    as one item, which the list cannot name. Repeated documents each keep a row, repeated items
    count once. Extra columns are ignored. Empty tables give no rows, or only clean ones. A written
    column of row numbers, named by ``row_id``, is used and comes last in the result, as ``row_id``.
    """
    spark = docs.sparkSession
    windows = materialize(item_windows(items, window_words, shingle_words))
    lengths = sorted(
        r.length for r in windows.select(F.explode("shingles.length").alias("length")).distinct().collect()
    )
    chosen = materialize(prefixes(windows, docs, lengths))
    bitmap = spark.sparkContext.broadcast(_bitmap(chosen.select("hash").distinct()))
    texts = docs.select("doc_id", "text", F.col(row_id).alias("row_id")) if row_id else with_row_id(docs.select("doc_id", "text"))
    probed = materialize(
        texts.transform(
            map_arrow, partial(_probe, bitmap=bitmap, lengths=lengths, window_words=window_words), _PROBE_SCHEMA
        )
    )
    positions = probed.select("row_id", F.col("n_words").alias("words_in_doc"), F.explode("probes").alias("p"))
    positions = positions.select("row_id", "words_in_doc", "p.*")
    start = F.col("pos") - F.col("offset")
    words = F.split("words", " ")
    same = F.array_join(F.slice(words, F.col("before") - F.col("offset") + 1, F.col("width")), " ") == F.col("window")
    hits = materialize(
        positions.join(chosen, ["hash", "length"])
        .filter((start >= 0) & (start + F.col("width") <= F.col("words_in_doc")))
        .filter(same)
        .select("row_id", "item_id", start.alias("start"), (start + F.col("width")).alias("end"))
        .distinct()
    )
    found = hits.groupBy("row_id").agg(
        F.collect_set(F.col("item_id").cast("string")).alias("item_ids"),
        F.max(F.col("item_id").isNull().cast("long")).alias("nameless"),
    )
    per_row = _covered(hits.select("row_id", "start", "end").distinct()).join(found, "row_id")
    n_hit = F.coalesce("n_hit", F.lit(0).cast("long"))
    return probed.select("doc_id", "row_id", "n_words").join(per_row, "row_id", "left").select(
        "doc_id",
        "n_words",
        n_hit.alias("n_hit"),
        F.coalesce(F.size("item_ids") + F.col("nameless"), F.lit(0).cast("long")).alias("n_items"),
        F.coalesce("item_ids", F.array().cast("array<string>")).alias("item_ids"),
        ((n_hit > 0) & (n_hit * MAX_CLEAN_RATIO >= F.col("n_words"))).alias("contaminated"),
        *(["row_id"] if row_id else []),
    )


def drop_contaminated_rows(docs: DataFrame, items: DataFrame, **options) -> DataFrame:
    """The rows that are not contaminated, with all their columns, whatever other rows of their id are."""
    key, own = pick_name(docs, "bad_row"), pick_name(docs, "own_row")
    rows = materialize(with_row_id(docs, own))
    bad = contamination(rows, items, row_id=own, **options).filter("contaminated").select(F.col("row_id").alias(key))
    return rows.join(bad.hint("shuffle_hash"), rows[own] == bad[key], "left_anti").drop(own)
