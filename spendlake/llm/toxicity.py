"""Toxicity by class-conditional Kneser-Ney models over the letters of words.

Two interpolated Kneser-Ney models predict each byte of a word from up to six bytes before it,
one from toxic and one from ordinary training texts. Below the highest order they share one
back-off chain of pooled continuation counts, so an event neither class has seen weighs only what
their contexts say, and rare or inflected expressions still count through the beginnings they
share. A document's evidence is the log-likelihood ratio per word, over the whole text, in its
strongest word and in its three strongest; a logistic link fitted on labelled texts apart from the
counted ones turns these into a probability. The models are broadcast as one exact hash table of all events
of the bounded labelled sample, in contexts of one length whatever their number.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from spendlake.llm.common import bottom_rows, groups_by_size, map_arrow, materialize, text_rows
from spendlake.llm.wordhash import ALPHANUMERIC, PIECE_BYTES, SPACE

#: Bound of the labelled sample.
LABELLED_ROWS = 20_000
THRESHOLD = 0.3
CONTEXT_BYTES = 6
DISCOUNT = 0.75
#: Words that count as a text's strongest.
STRONGEST = 3
FEATURES = 3
_CONTEXT_FLAG = np.uint64(1 << 56)
_MULTIPLIER = np.uint64(0x9E3779B97F4A7C15)
_LENGTH_MASK = np.array([(1 << (8 * k)) - 1 for k in range(8)], np.uint64)


class Table(NamedTuple):
    """An open hash table of events, at most half full; key 0, which no event has, is a free slot."""

    keys: np.ndarray
    ratios: np.ndarray
    context: int


class Model(NamedTuple):
    """Log ratios by event, and the logistic link over the features: their weights, then the constant."""

    table: Table
    weights: tuple[float, ...]


def events(
    texts: list[bytes], context: int = CONTEXT_BYTES
) -> Iterator[tuple[int, int, np.ndarray, np.ndarray, np.ndarray]]:
    """``(first row, past row, grams, word of each gram, words per row)`` for bounded row groups.

    A gram packs a byte and its context into one integer: the byte lowest, at most ``context`` before it,
    none before the blank that opens the word. The blank after a word is an event as well.
    """
    sizes = np.fromiter((len(t) + 2 for t in texts), np.int64, len(texts))
    for a, b in groups_by_size(sizes, PIECE_BYTES):
        mapped = b"".join(b" " + t.translate(ALPHANUMERIC) + b" " for t in texts[a:b])
        data = np.frombuffer(mapped, np.uint8)
        index = np.arange(len(data))
        blank = data == SPACE
        last = np.empty(len(data), np.int64)
        last[0] = 0
        np.maximum.accumulate(np.where(blank, index, 0)[:-1], out=last[1:])
        reach = index - last
        keep = ~(blank & (reach <= 1))
        keep[0] = False
        packed = data.astype(np.uint64)
        for k in range(1, context + 1):
            packed[k:] |= data[:-k].astype(np.uint64) << np.uint64(8 * k)
        opens = keep & (reach == 1)
        word = np.cumsum(opens)[keep] - 1
        grams = packed[keep] & _LENGTH_MASK[np.minimum(reach[keep], context) + 1]
        ends = np.cumsum(sizes[a:b])
        words = np.diff(np.concatenate(([0], np.cumsum(opens)[ends - 1])))
        yield a, b, grams, word, words


def _count_batches(batches) -> Iterator[pa.RecordBatch]:
    """Events per class, summed over each batch; columns text, toxic."""
    for batch in batches:
        toxic = np.array([bool(x) for x in batch.column(1).to_pylist()], bool)
        seen, sides = [], []
        for a, b, grams, word, words in events(text_rows(batch)):
            seen.append(grams)
            sides.append(np.repeat(toxic[a:b], words)[word])
        if not seen:
            continue
        all_grams, side = np.concatenate(seen), np.concatenate(sides)
        found, inverse = np.unique(all_grams, return_inverse=True)
        hot = np.bincount(inverse, weights=side, minlength=len(found)).astype(np.int64)
        total = np.bincount(inverse, minlength=len(found))
        yield pa.RecordBatch.from_arrays(
            [pa.array(found.view(np.int64)), pa.array(hot), pa.array(total - hot)], ["gram", "toxic", "ordinary"]
        )


def _lengths(grams: np.ndarray) -> np.ndarray:
    return np.searchsorted(_LENGTH_MASK, grams, side="left")


def _lower_order(grams: np.ndarray) -> np.ndarray:
    """Shared back-off probability of each gram's last byte, one context byte shorter."""
    length = _lengths(grams)
    result = np.full(len(grams), 1 / 256)
    deep = length > 1
    if not deep.any():
        return result
    suffixes, inverse, spread = np.unique(
        grams[deep] & _LENGTH_MASK[length[deep] - 1], return_inverse=True, return_counts=True
    )
    contexts, of = np.unique(
        (suffixes >> np.uint64(8)) | (_lengths(suffixes).astype(np.uint64) << np.uint64(56)), return_inverse=True
    )
    total = np.bincount(of, weights=spread, minlength=len(contexts))[of]
    kinds = np.bincount(of, minlength=len(contexts))[of]
    chain = _lower_order(suffixes)
    result[deep] = ((np.maximum(spread - DISCOUNT, 0) + DISCOUNT * kinds * chain) / total)[inverse]
    return result


def log_ratios(grams: np.ndarray, toxic: np.ndarray, ordinary: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Keys and log ratios: of every seen gram, then, flagged, of an unseen one after each context."""
    contexts, of = np.unique(grams >> np.uint64(8), return_inverse=True)
    shared = _lower_order(grams)
    log_p, log_free = [], []
    for counts in (toxic, ordinary):
        total = np.bincount(of, weights=counts, minlength=len(contexts))
        kinds = np.bincount(of, weights=counts > 0, minlength=len(contexts))
        free = np.where(total > 0, DISCOUNT * kinds / np.maximum(total, 1), 1.0)
        own = np.where(total[of] > 0, np.maximum(counts - DISCOUNT, 0) / np.maximum(total[of], 1), 0.0)
        log_p.append(np.log(own + free[of] * shared))
        log_free.append(np.log(free))
    keys = np.concatenate((grams, contexts | _CONTEXT_FLAG))
    return keys, np.concatenate((log_p[0] - log_p[1], log_free[0] - log_free[1]))


def _slots(keys: np.ndarray, size: int) -> np.ndarray:
    mixed = keys * _MULTIPLIER
    mixed ^= mixed >> np.uint64(29)
    mixed = mixed * _MULTIPLIER
    return (mixed >> np.uint64(64 - (size.bit_length() - 1))).astype(np.int64)


def build_table(keys: np.ndarray, ratios: np.ndarray, context: int = CONTEXT_BYTES) -> Table:
    """All events, each in the first free slot from its own on."""
    size = 1 << max(1, (2 * len(keys)).bit_length())
    table, values = np.zeros(size, np.uint64), np.zeros(size, np.float32)
    waiting, slot = np.arange(len(keys)), _slots(keys, size)
    while len(waiting):
        free = table[slot] == 0
        table[slot[free]] = keys[waiting[free]]  # of several the last one written stays
        placed = table[slot] == keys[waiting]
        values[slot[placed]] = ratios[waiting[placed]]
        waiting, slot = waiting[~placed], (slot[~placed] + 1) & (size - 1)
    return Table(table, values, context)


def look_up(table: Table, keys: np.ndarray) -> np.ndarray:
    """The ratio of each event, NaN of those the table does not hold."""
    size = len(table.keys)
    out = np.full(len(keys), np.nan, np.float32)
    waiting, slot = np.arange(len(keys)), _slots(keys, size)
    while len(waiting):
        held = table.keys[slot]
        found = held == keys[waiting]
        out[waiting[found]] = table.ratios[slot[found]]
        on = ~found & (held != 0)
        waiting, slot = waiting[on], (slot[on] + 1) & (size - 1)
    return out


def features(texts: list[bytes], table: Table) -> np.ndarray:
    """Per text: log ratio per word over the whole text, of its strongest word, and of its
    :data:`STRONGEST` strongest together. Empty: zeros.
    """
    out = np.zeros((len(texts), FEATURES))
    for a, b, grams, word, words in events(texts, table.context):
        value = look_up(table, grams)
        unseen = np.flatnonzero(np.isnan(value))
        value[unseen] = np.nan_to_num(look_up(table, (grams[unseen] >> np.uint64(8)) | _CONTEXT_FLAG), nan=0.0)
        per_word = np.bincount(word, weights=value, minlength=int(words.sum()))
        full = np.flatnonzero(words)
        if len(full):
            starts = (np.cumsum(words) - words)[full]
            out[a + full, 0] = np.add.reduceat(per_word, starts) / words[full]
            row = np.repeat(np.arange(b - a), words)
            order = np.lexsort((-per_word, row))
            place = np.arange(len(row)) - np.repeat(np.cumsum(words) - words, words)
            first = order[place < STRONGEST]
            out[a + full, 1] = per_word[order[place == 0]]
            out[a : b, 2] = np.bincount(row[first], weights=per_word[first], minlength=b - a)
    return out


def _feature_batches(batches, model) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        x = features(text_rows(batch), model.value)
        yield pa.RecordBatch.from_arrays([batch.column(1), pa.array(list(x), pa.list_(pa.float64()))], ["toxic", "x"])


def _fit_link(x: np.ndarray, y: np.ndarray, ridge: float = 1.0) -> tuple[float, ...]:
    """Ridge logistic regression by Newton steps; weights of the raw features, then the constant."""
    if not len(y):
        return (*[0.0] * x.shape[1], -np.inf)
    centre, scale = x.mean(0), x.std(0) + 1e-9
    z = np.column_stack(((x - centre) / scale, np.ones(len(x))))
    penalty = np.append(np.full(x.shape[1], ridge), 1e-3)
    w = np.zeros(len(penalty))
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(z @ w, -30, 30)))
        step = np.linalg.solve(
            (z * (p * (1 - p))[:, None]).T @ z + np.diag(penalty), z.T @ (y - p) - penalty * w
        )
        w += step
        if np.abs(step).max() < 1e-9:
            break
    raw = w[:-1] / scale
    return (*(float(r) for r in raw), float(w[-1] - raw @ centre))


def held_out(doc_id: Column) -> Column:
    """Rows no label may be learned from. A null id is not held out."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % 4 == 2, F.lit(False))


def _within(rows: DataFrame, most_events: int | None) -> tuple[DataFrame, int]:
    """Counts by gram and the length of their contexts: all of them, or as long as the caller's bound on events allows."""
    context = CONTEXT_BYTES
    while True:
        counts = rows.groupBy("gram").agg(F.sum("toxic").alias("toxic"), F.sum("ordinary").alias("ordinary"))
        counts = materialize(counts)
        if most_events is None:
            return counts, context
        past = F.shiftrightunsigned("gram", 8)
        found = counts.count() + counts.select(past).distinct().count()
        if found <= most_events or not context:
            return counts, context
        context -= 1
        rows = counts.withColumn("gram", F.col("gram").bitwiseAND(F.lit((1 << (8 * (context + 1))) - 1)))


def fit(
    docs: DataFrame, labels: DataFrame, labelled_rows: int = LABELLED_ROWS, most_events: int | None = None
) -> Model:
    """Train on a bounded sample of labelled rows that are not held out, texts of any length.

    A quarter of the sample fits the link, the rest the models. Conflicting labels of one
    document count as toxic. Contexts are shortened only for a caller that bounds the events. Without labels every score is zero; with one class only, every score
    is near that class's share.
    """
    spark = docs.sparkSession
    usable = labels.filter(~held_out(F.col("doc_id"))).filter("doc_id is not null and toxic is not null")
    sample = bottom_rows(usable.groupBy("doc_id").agg((F.max("toxic") > 0).alias("toxic")), "doc_id", labelled_rows)
    # at most labelled_rows ids are sent out
    train = materialize(
        docs.select("doc_id", "text")
        .filter(F.col("text").isNotNull())
        .join(F.broadcast(sample), "doc_id")
        .select("text", "toxic", (F.pmod(F.xxhash64("doc_id", F.lit("link")), F.lit(4)) == 0).alias("link"))
    )
    counted, context = _within(
        train.filter("not link").select("text", "toxic")
        .transform(map_arrow, _count_batches, "gram long, toxic long, ordinary long"),
        most_events,
    )
    counted = counted.toArrow()
    grams = counted.column("gram").to_numpy().view(np.uint64)
    order = np.argsort(grams)
    toxic, ordinary = (counted.column(c).to_numpy()[order].astype(np.float64) for c in ("toxic", "ordinary"))
    table = build_table(*log_ratios(grams[order], toxic, ordinary), context)
    shared = spark.sparkContext.broadcast(table)
    seen = (
        train.filter("link").select("text", "toxic")
        .transform(map_arrow, partial(_feature_batches, model=shared), "toxic boolean, x array<double>")
        .toArrow()
    )
    x = seen.column("x").combine_chunks().flatten().to_numpy().reshape(len(seen), FEATURES)
    y = seen.column("toxic").to_numpy(zero_copy_only=False).astype(np.float64)
    shared.unpersist()
    return Model(table, _fit_link(x, y))


def scores(texts: list[bytes], model: Model) -> np.ndarray:
    x = features(texts, model.table)
    w = model.weights
    if np.isneginf(w[-1]):
        return np.zeros(len(texts))
    return 1 / (1 + np.exp(-np.clip(x @ np.array(w[:-1]) + w[-1], -700, 700)))


def _score_batches(batches, model) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), pa.array(scores(text_rows(batch), model.value))], ["doc_id", "score"]
        )


def toxicity(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD, **options) -> DataFrame:
    """``doc_id, held_out, score, predicted`` for every row of ``docs`` (``doc_id, text``).

    Only the text is scored. Null and empty texts get the score of no evidence. Repeated rows and
    null ids keep their rows; further columns are ignored; an empty table gives no rows.
    """
    model = docs.sparkSession.sparkContext.broadcast(fit(docs, labels, **options))
    scored = docs.select("doc_id", "text").transform(map_arrow, partial(_score_batches, model=model), "doc_id long, score double")
    return scored.select(
        "doc_id",
        held_out(F.col("doc_id")).alias("held_out"),
        "score",
        (F.col("score") >= threshold).cast("int").alias("predicted"),
    )


def _keep_batches(batches, model, threshold) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        yield batch.filter(pa.array(scores(text_rows(batch), model.value) < threshold))


def drop_toxic(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD, **options) -> DataFrame:
    """The documents scored below the threshold, with all their columns; no join, no shuffle."""
    model = docs.sparkSession.sparkContext.broadcast(fit(docs, labels, **options))
    return docs.transform(map_arrow, partial(_keep_batches, model=model, threshold=threshold), docs.schema)
