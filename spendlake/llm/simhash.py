"""SimHash near-duplicates: fingerprints linked exactly through vantage-point trees.

1. Every document gets a 64-bit fingerprint from the XXH64 of its word shingles.
2. Distinct fingerprints only go on: any number of exact copies is one row.
3. A vantage-point tree over a bounded sample splits the space into shards. At each node a point
   with distance at most ``radius`` beyond the inner ball is also sent inside as a guest, so by the
   triangle bound every pair within ``max_bits`` meets in at least one shard.
4. Inside a shard the same split goes on in memory down to small leaves, where all pairs are
   compared. A leaf reports each linked point with one partner, never all pairs of a dense group.
5. Components of those links name each document's group.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from spendlake.llm.common import HASH_SEED, map_arrow, materialize, pick_name, text_rows, with_row_id
from spendlake.llm.components import connected

SHINGLE_WORDS = 3
MAX_BITS = 2
#: Bound of the sample the top tree is built from, and the shard size it aims at.
TREE_SAMPLE = 8192
SHARD_ROWS = 32768
LEAF_ROWS = 192
_BITS_AT_ONCE = 1 << 15
_ROUTED_AT_ONCE = 1 << 18


def fingerprint(text: bytes, shingle_words: int = SHINGLE_WORDS) -> int:
    """Unsigned fingerprint of a text; zero if it has no words.

    ``bytes.lower`` touches A-Z only and ``bytes.split`` cuts at the six ASCII blanks.
    """
    words = text.lower().split()
    if not words:
        return 0
    flat = b" ".join(words)
    lengths = np.fromiter(map(len, words), np.int64, len(words))
    ends = np.cumsum(lengths + 1) - 1
    starts = ends - lengths
    width = min(shingle_words, len(words))
    digest = xxhash.xxh64_intdigest
    hashes = np.fromiter(
        (
            digest(flat[s:e], HASH_SEED)
            for s, e in zip(starts[: len(words) - width + 1].tolist(), ends[width - 1 :].tolist())
        ),
        np.uint64,
        len(words) - width + 1,
    )
    ones = np.zeros(64, np.int64)
    for i in range(0, len(hashes), _BITS_AT_ONCE):
        part = hashes[i : i + _BITS_AT_ONCE].astype("<u8").view(np.uint8).reshape(-1, 8)
        ones += np.unpackbits(part, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > len(hashes), bitorder="little").view("<u8")[0])


def _fingerprint_batches(
    batches: Iterator[pa.RecordBatch], shingle_words: int
) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        prints = np.array([fingerprint(t, shingle_words) for t in text_rows(batch)], np.uint64)
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), pa.array(prints.view(np.int64)), *batch.columns[2:]],
            ["doc_id", "fp", *batch.schema.names[2:]],
        )


def fingerprints(docs: DataFrame, shingle_words: int = SHINGLE_WORDS, row_id: str | None = None) -> DataFrame:
    """``doc_id, fp``: the fingerprint as a signed long, one row per input row; null text is empty.

    A column of row numbers, named by ``row_id``, comes last as ``row_id``.
    """
    row = [F.col(row_id).alias("row_id")] if row_id else []
    return docs.select("doc_id", "text", *row).transform(
        map_arrow, partial(_fingerprint_batches, shingle_words=shingle_words),
        "doc_id long, fp long" + (", row_id long" if row_id else ""),
    )


def _distance(points: np.ndarray, vantage: np.uint64) -> np.ndarray:
    return np.bitwise_count(points ^ vantage).astype(np.int64)


def _best_split(points: np.ndarray, radius: int, tries: int = 8) -> tuple[np.uint64, int] | None:
    """Vantage point and inner distance with the least work below, or None if no split helps.

    Guests go inside, so ``n`` points become ``inner + outer >= n``; the work is their squares' sum.
    """
    n, best, least = len(points), None, 0.9 * len(points) ** 2
    for at in np.linspace(0, n - 1, min(tries, n)).astype(np.int64):
        counts = np.bincount(_distance(points, points[at]), minlength=65)
        below = np.cumsum(counts)
        inner = below[np.minimum(np.arange(65) + radius, 64)]
        work = inner.astype(float) ** 2 + (n - below).astype(float) ** 2
        cut = int(np.argmin(work))
        if work[cut] < least:
            least, best = work[cut], (points[at], cut)
    return best


def build_tree(sample: np.ndarray, per_leaf: float, radius: int) -> tuple[list[tuple], int]:
    """Nodes ``(vantage, cut, inside, outside)`` and the number of leaves.

    A child is a node's index or, for a leaf, minus its number less one. ``per_leaf`` is the sample
    share a shard should have; a subset that does not split stays one leaf.
    """
    nodes: list[tuple] = []
    leaves = 0

    def grow(points: np.ndarray) -> int:
        nonlocal leaves
        split = _best_split(points, radius) if len(points) > max(per_leaf, 8) else None
        if split is None:
            leaves += 1
            return -leaves
        vantage, cut = split
        far = _distance(points, vantage)
        at = len(nodes)
        nodes.append(None)
        inside = grow(points[far <= cut + radius])
        outside = grow(points[far > cut])
        nodes[at] = (vantage, cut, inside, outside)
        return at

    grow(sample)
    return nodes, leaves


def route(points: np.ndarray, nodes: list[tuple], radius: int) -> Iterator[tuple[int, np.ndarray]]:
    """``(shard, points)`` for every shard that the points reach.

    Two points in reach of each other go the same way at every node, or meet inside: if one is
    beyond the cut, the other is beyond it too or less than ``radius`` nearer.
    """
    stack = [(0 if nodes else -1, points)]
    while stack:
        at, own = stack.pop()
        if not len(own):
            continue
        if at < 0:
            yield -at - 1, own
            continue
        vantage, cut, inside, outside = nodes[at]
        far = _distance(own, vantage)
        stack.append((inside, own[far <= cut + radius]))
        stack.append((outside, own[far > cut]))


def _route_batches(batches, nodes, radius) -> Iterator[pa.RecordBatch]:
    held, size = [], 0

    def sent() -> Iterator[pa.RecordBatch]:
        for shard, own in route(np.concatenate(held), nodes, radius):
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(len(own), shard, np.int32)), pa.array(own.view(np.int64))], ["shard", "fp"]
            )
        held.clear()

    for batch in batches:
        held.append(batch.column(0).to_numpy(zero_copy_only=False).view(np.uint64))
        size += len(held[-1])
        if size >= _ROUTED_AT_ONCE:
            yield from sent()
            size = 0
    if held:
        yield from sent()


def _settle(adjacent: np.ndarray) -> np.ndarray:
    """Least reachable index of each point of a symmetric adjacency matrix."""
    n = len(adjacent)
    label = np.arange(n)
    while True:
        reach = np.where(adjacent, label[None, :], n).min(axis=1)
        new = np.minimum(label, reach)
        new = new[new]
        if (new == label).all():
            return label
        label = new


def _compare(points: np.ndarray, radius: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Links of an unsplittable set, block against block, a spanning set of links per block pair."""
    size = 1024
    for i in range(0, len(points), size):
        for j in range(i, len(points), size):
            a, b = points[i : i + size], points[j : j + size]
            close = np.bitwise_count(a[:, None] ^ b[None, :]) <= radius
            if i == j:
                np.fill_diagonal(close, False)
            if not close.any():
                continue
            both = points[i : i + size] if i == j else np.concatenate((a, b))
            adjacent = close
            if i != j:
                adjacent = np.zeros((len(both), len(both)), bool)
                adjacent[: len(a), len(a) :] = close
                adjacent[len(a) :, : len(a)] = close.T
            label = _settle(adjacent)
            linked = np.flatnonzero(label != np.arange(len(both)))
            yield both[linked], both[label[linked]]


def link(points: np.ndarray, radius: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Links among the points of one shard whose components are those of all pairs in reach."""
    stack = [points]
    while stack:
        own = stack.pop()
        if len(own) < 2:
            continue
        split = _best_split(own, radius) if len(own) > LEAF_ROWS else None
        if split is None:
            yield from _compare(own, radius)
            continue
        vantage, cut = split
        far = _distance(own, vantage)
        stack.append(own[far <= cut + radius])
        stack.append(own[far > cut])


def _link_shard(table: pa.Table, radius: int) -> pa.Table:
    points = table.column("fp").to_numpy().view(np.uint64)
    found = list(link(points, radius))
    a = np.concatenate([x for x, _ in found]) if found else np.zeros(0, np.uint64)
    b = np.concatenate([y for _, y in found]) if found else np.zeros(0, np.uint64)
    return pa.table({"a": a.view(np.int64), "b": b.view(np.int64)})


def near_links(distinct: DataFrame, max_bits: int = MAX_BITS, shard_rows: int = SHARD_ROWS) -> DataFrame:
    """Links ``a, b`` between the distinct fingerprints ``fp``, spanning all pairs in ``max_bits``."""
    rows = distinct.count()
    sample = np.array(
        [r.fp for r in distinct.orderBy(F.xxhash64("fp"), "fp").limit(TREE_SAMPLE).collect()], np.int64
    ).view(np.uint64)
    nodes, _ = build_tree(sample, shard_rows * len(sample) / max(rows, 1), max_bits)
    routed = distinct.select("fp").mapInArrow(
        partial(_route_batches, nodes=nodes, radius=max_bits), "shard int, fp long"
    )

    def links(table: pa.Table) -> pa.Table:
        return _link_shard(table, max_bits)

    return routed.groupBy("shard").applyInArrow(links, "a long, b long")


def _grouped(distinct: DataFrame, max_bits: int, shard_rows: int) -> DataFrame:
    """``fp, least, root`` of the distinct fingerprints ``fp, least``."""
    roots = connected(near_links(distinct, max_bits, shard_rows))
    return materialize(
        distinct.join(roots, distinct.fp == roots.node, "left").select(
            "fp", "least", F.coalesce("root", "fp").alias("root")
        )
    )


def near_duplicates(
    docs: DataFrame,
    shingle_words: int = SHINGLE_WORDS,
    max_bits: int = MAX_BITS,
    shard_rows: int = SHARD_ROWS,
) -> DataFrame:
    """``doc_id, fp, component_id`` for every row of ``docs`` (``doc_id, text``; more columns are ignored).

    ``component_id`` is the least ``doc_id`` that can be reached over fingerprints differing in at
    most ``max_bits``. Null and empty texts have fingerprint zero and link like any other. Rows
    without ``doc_id`` belong to groups but never name one; a group of such rows only has a null
    id. Repeated rows each keep a row. An empty table gives no rows.
    """
    prints = materialize(fingerprints(docs, shingle_words))
    distinct = materialize(prints.groupBy("fp").agg(F.min("doc_id").alias("least")))
    grouped = _grouped(distinct, max_bits, shard_rows)
    named = grouped.groupBy("root").agg(F.min("least").alias("component_id"))
    members = grouped.join(named, "root").select(F.col("fp").alias("member"), "component_id")
    return prints.join(members, prints.fp == members.member).select("doc_id", "fp", "component_id")


def one_row_of_each_group(
    docs: DataFrame,
    shingle_words: int = SHINGLE_WORDS,
    max_bits: int = MAX_BITS,
    shard_rows: int = SHARD_ROWS,
) -> DataFrame:
    """Exactly one row of each group, with all columns of ``docs``: that of the least ``doc_id``.

    Rows without ``doc_id`` come after all others; of rows with the same id any one may stay.
    """
    own, key = pick_name(docs, "own_row"), pick_name(docs, "kept_row")
    rows = materialize(with_row_id(docs, own))
    first = F.min(F.struct(F.col("doc_id").isNull().alias("lacks"), "doc_id", "row_id"))
    distinct = materialize(fingerprints(rows, shingle_words, own).groupBy("fp").agg(first.alias("least")))
    kept = _grouped(distinct, max_bits, shard_rows).groupBy("root").agg(F.min("least").alias("least"))
    kept = kept.select(F.col("least.row_id").alias(key))
    return rows.join(kept.hint("shuffle_hash"), rows[own] == kept[key], "left_semi").drop(own)
