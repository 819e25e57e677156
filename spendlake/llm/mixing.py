"""Mixing to target weights with soft domain membership.

A multinomial classifier over hashed words, trained on a labelled table, gives every document a
posterior over the domains. Each document then gets a rate, the number of times to draw it, such
that expected domain token totals ``sum rate * tokens * posterior`` meet the targets: nonnegative
least squares by projected gradient, with momentum. A step moves a rate by the residual seen through
the document's posterior, so the rates after any number of steps follow from the residuals alone;
each step is one pass over the posteriors that returns one small vector, and no state is kept. It ends
where the totals meet the targets or the projected gradient vanishes, and warns with the residual if it has to
end elsewhere.
"""

from __future__ import annotations

import warnings
from collections.abc import Iterator
from functools import partial
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from spendlake.llm.common import bottom_rows, map_arrow, materialize, pick_name, text_rows
from spendlake.llm.wordhash import ALPHANUMERIC, hashed_words

#: Bound of the labelled sample.
LABELLED_ROWS = 20_000
BUCKET_BITS = 16
SMOOTHING = 0.1
#: Evidence counts as at most this many independent words; the best of these on labelled rows is used.
WORD_CAPS = (1.0, 2.0, 4.0, 8.0, 16.0, 32.0, 64.0)
#: Beyond these the solver warns and ends: each is a pass over the posteriors.
MAX_STEPS = 200
#: Share of all tokens that the totals may miss the targets by, and root mean square change of a
#: rate, weighted by tokens, below which the projected gradient counts as vanished.
TOLERANCE, STILL = 1e-6, 1e-6
#: Where the targets are out of reach: steps over which the squared error must fall by this share to go on.
PATIENCE, PROGRESS = 10, 1e-4


class Classifier(NamedTuple):
    """Log probabilities of each word bucket and of each domain, and the cap on evidence."""

    words: np.ndarray
    prior: np.ndarray
    cap: float


def _buckets(hashes: np.ndarray) -> np.ndarray:
    return (hashes >> np.uint64(64 - BUCKET_BITS)).astype(np.int64)


def _count_batches(batches, size: int) -> Iterator[pa.RecordBatch]:
    """Words per domain and bucket, summed over each batch; columns text, domain."""
    for batch in batches:
        domain = np.array(batch.column(1).to_pylist(), np.int64)
        total = np.zeros(size << BUCKET_BITS, np.int64)
        for a, counts, hashes in hashed_words(text_rows(batch), ALPHANUMERIC):
            where = (np.repeat(domain[a : a + len(counts)], counts) << BUCKET_BITS) | _buckets(hashes)
            total += np.bincount(where, minlength=len(total))
        full = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(full), pa.array(total[full])], ["slot", "words"])


def _evidence(texts: list[bytes], words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Mean log probability per domain, and the number of words, of each text."""
    mean, n = np.zeros((len(texts), words.shape[1])), np.zeros(len(texts), np.int64)
    for a, counts, hashes in hashed_words(texts, ALPHANUMERIC):
        n[a : a + len(counts)] = counts
        full = np.flatnonzero(counts)
        if len(full):
            sums = np.add.reduceat(words[_buckets(hashes)], (np.cumsum(counts) - counts)[full], axis=0)
            mean[a + full] = sums / counts[full, None]
    return mean, n


def _posterior(mean: np.ndarray, n: np.ndarray, prior: np.ndarray, cap: float) -> np.ndarray:
    logits = mean * np.minimum(n, cap)[:, None] + prior
    p = np.exp(logits - logits.max(axis=1, keepdims=True))
    return p / p.sum(axis=1, keepdims=True)


def _evidence_batches(batches, words) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        mean, n = _evidence(text_rows(batch), words.value)
        yield pa.RecordBatch.from_arrays(
            [batch.column(1), pa.array(n), pa.array(list(mean), pa.list_(pa.float64()))], ["domain", "n", "mean"]
        )


def fit_classifier(
    docs: DataFrame, labelled: DataFrame, domains: list[str], labelled_rows: int = LABELLED_ROWS
) -> Classifier:
    """Train on a bounded sample of ``labelled`` (``doc_id, domain``); a quarter of it picks the cap.

    Rows of unknown domain are not used; a document with several labels keeps the first by name.
    Without usable rows all posteriors are uniform.
    """
    spark = docs.sparkSession
    number = F.array_position(F.array(*(F.lit(d) for d in domains)), F.col("domain")).cast("int") - 1
    known = labelled.filter(F.col("doc_id").isNotNull() & F.col("domain").isin(domains))
    known = known.groupBy("doc_id").agg(F.min("domain").alias("domain")).select("doc_id", number.alias("domain"))
    sample = bottom_rows(known, "doc_id", labelled_rows)
    held = F.pmod(F.xxhash64("doc_id", F.lit("cap")), F.lit(4)) == 0
    train = materialize(  # at most labelled_rows ids are sent out
        docs.select("doc_id", "text")
        .filter(F.col("text").isNotNull())
        .join(F.broadcast(sample), "doc_id")
        .select("text", "domain", held.alias("held"))
    )
    size = len(domains)
    counted = (
        train.filter("not held").select("text", "domain")
        .transform(map_arrow, partial(_count_batches, size=size), "slot long, words long")
        .groupBy("slot").agg(F.sum("words").alias("words"))
        .toArrow()
    )
    counts = np.zeros(size << BUCKET_BITS)
    counts[counted.column("slot").to_numpy()] = counted.column("words").to_numpy()
    counts = counts.reshape(size, -1).T + SMOOTHING
    words = np.log(counts / counts.sum(axis=0)).astype(np.float32)
    share = {r.domain: r["count"] for r in train.groupBy("domain").count().collect()}
    prior = np.log(np.array([share.get(k, 0) + 1.0 for k in range(size)]))
    sent = spark.sparkContext.broadcast(words)
    seen = (
        train.filter("held").select("text", "domain")
        .transform(map_arrow, partial(_evidence_batches, words=sent), "domain int, n long, mean array<double>")
        .toArrow()
    )
    cap = WORD_CAPS[0]
    if len(seen):
        mean = seen.column("mean").combine_chunks().flatten().to_numpy().reshape(-1, size)
        n, domain = seen.column("n").to_numpy(), seen.column("domain").to_numpy()
        own = [_posterior(mean, n, prior, c)[np.arange(len(n)), domain] for c in WORD_CAPS]
        cap = WORD_CAPS[int(np.argmax([np.log(np.maximum(p, 1e-9)).sum() for p in own]))]
    sent.unpersist()
    return Classifier(words, prior, cap)


def _posteriors(texts: list[bytes], model: Classifier) -> tuple[np.ndarray, np.ndarray]:
    mean, n = _evidence(texts, model.words)
    return _posterior(mean, n, model.prior, model.cap), n


def _membership_batches(batches, model) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        p, n = _posteriors(text_rows(batch), model.value)
        yield pa.RecordBatch.from_arrays([pa.array(n), pa.array(list(p), pa.list_(pa.float64()))], ["n", "p"])


class Descent(NamedTuple):
    """What the rates follow from: the steps, and how far each went on from the point before it."""

    steps: list[np.ndarray]
    momentum: list[float]


def _points(p: np.ndarray, descent: Descent) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The rates, those before the last step, and the point that step was taken from; from one draw each."""
    rate = before = start = np.ones(len(p))
    for step, on in zip(descent.steps, descent.momentum):
        start = rate + on * (rate - before)
        before, rate = rate, np.maximum(0.0, start - p @ step)
    return rate, before, start


def rates(p: np.ndarray, steps: list[np.ndarray], momentum: list[float] | None = None) -> np.ndarray:
    """Rates after the given steps, from one draw of each document, never below zero."""
    return _points(p, Descent(steps, momentum or [0.0] * len(steps)))[0]


def _matrix(column: pa.Array, size: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, size)


def _total_batches(batches, descent: Descent, size: int) -> Iterator[pa.RecordBatch]:
    """Per task: expected tokens of each domain at the rates so far, the moments of the posteriors, the
    square of the last move, and whether it went on in the direction of the one before.
    """
    totals = np.zeros(size + size * size + 2)
    for batch in batches:
        n, p = batch.column(0).to_numpy(), _matrix(batch.column(1), size)
        weighted = p * n[:, None]
        rate, before, start = _points(p, descent)
        totals[:size] += rate @ weighted
        totals[size:-2] += (p.T @ weighted).ravel()
        totals[-2] += n @ (rate - start) ** 2
        totals[-1] += n @ ((rate - start) * (rate - before))
    yield pa.RecordBatch.from_arrays(
        [pa.array(np.arange(len(totals))), pa.array(totals)], ["at", "total"]
    )


def _totals(membership: DataFrame, descent: Descent, size: int) -> np.ndarray:
    rows = (
        membership.mapInArrow(partial(_total_batches, descent=descent, size=size), "at long, total double")
        .groupBy("at").agg(F.sum("total").alias("total"))
        .collect()
    )
    out = np.zeros(size + size * size + 2)
    for row in rows:
        out[row["at"]] = row.total
    return out


def fit_rates(membership: DataFrame, targets: np.ndarray, max_steps: int = MAX_STEPS) -> Descent:
    """Projected gradient descent on the squared error of the domain totals.

    The error is measured, and the steps are scaled, by the inverse second moments of the posteriors,
    so that unequal domains converge alike and a step of one is the longest that cannot fail. Momentum
    starts anew whenever a step goes back on it. It ends when the totals meet the targets, when the
    projected gradient vanishes, or when the squared error, which is what is minimised, falls no more: then
    the rates are a solution of the least squares. Otherwise, after ``max_steps``, it warns with the residual.
    """
    size, descent = len(targets), Descent([], [])
    first = _totals(membership, descent, size)
    tokens = max(first[:size].sum(), 1.0)
    goal = targets / targets.sum() * first[:size].sum()
    scale = np.linalg.pinv(first[size:-2].reshape(size, size), rcond=1e-10)
    error = before = first[:size] - goal
    pace, errors = 1.0, []
    while np.abs(error).sum() / tokens >= TOLERANCE:
        if len(descent.steps) == max_steps:
            left = np.abs(error).sum() / tokens
            warnings.warn(f"{max_steps} steps leave {left:.3g} of all tokens off target", RuntimeWarning, stacklevel=2)
            break
        following = (1 + np.sqrt(1 + 4 * pace * pace)) / 2
        on = (pace - 1) / following
        descent.steps.append(scale @ (error + on * (error - before)))  # the error is linear in the rates
        descent.momentum.append(on)
        now = _totals(membership, descent, size)
        before, error = error, now[:size] - goal
        errors.append(error @ scale @ error)
        if np.sqrt(now[-2] / tokens) < STILL:
            break
        if len(errors) > PATIENCE and errors[-1] > errors[-1 - PATIENCE] * (1 - PROGRESS):
            break
        pace = following if now[-1] >= 0 else 1.0
    return descent


def _rate_batches(batches, model, descent, domains, columns) -> Iterator[pa.RecordBatch]:
    """The columns asked for that are there, then the added ones."""
    names = np.array(domains, object)
    for batch in batches:
        p, n = _posteriors(text_rows(batch), model.value)
        best = pa.array(names[p.argmax(axis=1)].tolist(), pa.string())
        added = [pa.array(n), best, pa.array(list(p), pa.list_(pa.float64())), pa.array(rates(p, *descent))]
        yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in columns[:-4]), *added], columns)


def mix(
    docs: DataFrame,
    labelled: DataFrame,
    targets: dict[str, float],
    labelled_rows: int = LABELLED_ROWS,
    leave_out: tuple[str, ...] = (),
) -> DataFrame:
    """``docs``, less the columns in ``leave_out``, with ``n_tokens, domain, posterior, rate``; posteriors in the order of ``targets``.

    ``docs`` has ``doc_id, text``, ``labelled`` has ``doc_id, domain``; weights need not sum to one.
    Expected tokens per domain at the returned rates have the targets' proportions and the corpus'
    total, or come as near as nonnegative rates allow. Null and empty texts have no tokens, the
    prior as posterior, and the rate that goes with it. Repeated rows count each; columns of ``docs``
    with these names stay and the new ones get a leading underscore. An empty table gives no rows.
    """
    spark = docs.sparkSession
    domains = list(targets)
    model = spark.sparkContext.broadcast(fit_classifier(docs, labelled, domains, labelled_rows))
    membership = materialize(
        docs.select("text").transform(map_arrow, partial(_membership_batches, model=model), "n long, p array<double>")
    )
    descent = fit_rates(membership, np.array([float(targets[d]) for d in domains]))
    kinds = {
        "n_tokens": T.LongType(), "domain": T.StringType(), "posterior": T.ArrayType(T.DoubleType()), "rate": T.DoubleType()
    }
    added = [T.StructField(pick_name(docs, name), kind) for name, kind in kinds.items()]
    schema = T.StructType([*(f for f in docs.schema.fields if f.name not in leave_out), *added])
    add = partial(_rate_batches, model=model, descent=descent, domains=domains, columns=schema.fieldNames())
    return docs.transform(map_arrow, add, schema)
