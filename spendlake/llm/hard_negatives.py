"""Hard negatives from an inverted multi-index, with exact results.

Vectors are split into two halves, each with a codebook of its own (k-means on a bounded sample). A
pair of codes is a cell. The inner product of an anchor with any vector of a cell is at most the sum of
two half bounds: anchor half times centroid, plus the anchor half's length times the radius of the code.
A heap merges the two lists of half bounds and visits the cells of a shard in descending order of
the sum. The search ends once that sum falls below everything that still counts: the last of the best
rows so far, or the lower end of the window of scores asked for. What was not visited is then certified
not to matter, so results equal those of a full scan, whatever the codebooks.

The index is a table sorted by cell; every stretch of :data:`SHARD_ROWS` rows is a shard, so that a cell
with a third of all rows spreads over many. Anchors go round in blocks of bounded size, broadcast one
after the other. A pilot (the codebooks' sample) gives each anchor scores to beat beforehand, which
spares shards that hold nothing near it.
"""

from __future__ import annotations

import heapq
import math
from collections.abc import Iterator
from functools import partial, reduce
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from spendlake.llm.common import bottom_rows, map_arrow, materialize, with_row_id

#: Rows that codebooks are fitted on and that serve as the pilot.
SAMPLE_ROWS = 8192
#: Codes of a half: one for so many rows of a cell, within limits.
CELL_ROWS, LEAST_CODES, MOST_CODES = 128, 4, 256
#: Rows that a task searches at once, and anchors broadcast at once.
SHARD_ROWS = 1 << 15
BLOCK_ANCHORS = 1 << 12
#: Rows scored together; cells are visited until so many are waiting.
SCORED_ROWS = 512
#: Stands for a missing id, which comes after all others.
NO_ID = (1 << 63) - 1
NEVER = -(1 << 63)

_INDEX_SCHEMA = "c1 int, c2 int, row long, id long, label long, vector binary"


class Codebooks(NamedTuple):
    first: np.ndarray
    second: np.ndarray


class Index(NamedTuple):
    rows: DataFrame
    sample: pa.Table
    books: Codebooks
    width: int
    #: Floats where all sums are exact in 53 bits, which is faster; else integers.
    kind: type


class Block(NamedTuple):
    """Anchors, the windows of scores asked for, and the scores that enough rows reach already."""

    rows: np.ndarray
    labels: np.ndarray
    vectors: np.ndarray
    low: np.ndarray
    high: np.ndarray
    floors: np.ndarray


# -- preparation ---------------------------------------------------------------------------------


def integer_vectors(rows: DataFrame, scale: int = 256) -> DataFrame:
    """``id, label, vector`` of the rows that take part, components as ``floor(scale * x)``.

    A row without label or vector, or with a null or non-finite component, takes no part.
    """
    finite = F.forall(
        "embedding", lambda x: x.isNotNull() & ~F.isnan(x.cast("double")) & (F.abs(x.cast("double")) < float("inf"))
    )
    return rows.filter(F.col("label").isNotNull() & F.col("embedding").isNotNull() & finite).select(
        F.coalesce(F.col("vec_id").cast("long"), F.lit(NO_ID)).alias("id"),
        F.col("label").cast("long").alias("label"),
        F.transform("embedding", lambda x: F.floor(x.cast("double") * scale)).alias("vector"),
    )


def _matrix(column: pa.Array, width: int) -> np.ndarray:
    """Vectors as rows of equal width; zeros follow a shorter one."""
    lists = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    sizes = lists.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
    out = np.zeros((len(sizes), width), np.int64)
    at = np.repeat(np.arange(len(sizes)), sizes)
    place = np.arange(len(at)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    out[at, place] = lists.flatten().to_numpy(zero_copy_only=False)
    return out


def k_means(points: np.ndarray, k: int, rounds: int = 8) -> np.ndarray:
    """Centroids of float points; repeatable."""
    centres = points[np.linspace(0, len(points) - 1, min(k, len(points))).astype(int)].copy()
    for _ in range(rounds):
        code = nearest(points, centres)
        sums = np.zeros_like(centres)
        np.add.at(sums, code, points)
        size = np.bincount(code, minlength=len(centres))
        centres[size > 0] = sums[size > 0] / size[size > 0, None]
    return centres


def nearest(points: np.ndarray, centres: np.ndarray) -> np.ndarray:
    return np.argmin((centres**2).sum(1) - 2 * points @ centres.T, axis=1)


def _halves(vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    middle = vectors.shape[1] // 2
    return vectors[:, :middle], vectors[:, middle:]


def _assign(batches, books, width: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        vectors = _matrix(batch.column("vector"), width)
        first, second = _halves(vectors.astype(float))
        yield pa.RecordBatch.from_pydict(
            {
                "c1": pa.array(nearest(first, books.value.first), pa.int32()),
                "c2": pa.array(nearest(second, books.value.second), pa.int32()),
                "row": batch.column("row"),
                "id": batch.column("id"),
                "label": batch.column("label"),
                "vector": pa.array([v.tobytes() for v in vectors], pa.binary()),
            }
        )


def _unpacked(column: pa.ChunkedArray, width: int) -> np.ndarray:
    """Vectors of the index, stored as bytes."""
    flat = np.frombuffer(b"".join(column.to_pylist()) or bytearray(), np.int64)
    return flat.reshape(len(column), width)


def build_index(vectors: DataFrame) -> Index:
    """Codebooks from a sample, all rows with their cells as a table sorted by cell."""
    vectors = materialize(with_row_id(vectors, "row"))
    size, width, most = vectors.agg(
        F.count(F.lit(1)), F.max(F.size("vector")),
        F.max(F.aggregate("vector", F.lit(0).cast("long"), lambda m, x: F.greatest(m, F.abs(x)))),
    ).first()
    width, most = width or 0, most or 0
    if width * most * most >= 1 << 56:  # a hundred times that must fit a long
        raise ArithmeticError("inner products of these vectors may pass 56 bits")
    sample = bottom_rows(vectors, "row", SAMPLE_ROWS).toArrow()
    codes = min(MOST_CODES, max(LEAST_CODES, math.isqrt(size // CELL_ROWS)))
    points = _halves(_matrix(sample["vector"], width).astype(float))
    books = Codebooks(*(k_means(p, codes) for p in points)) if size else Codebooks(*points)
    shared = vectors.sparkSession.sparkContext.broadcast(books)
    cells = map_arrow(vectors, partial(_assign, books=shared, width=width), _INDEX_SCHEMA)
    # by cell, and within it by row: a hot cell spreads over shards
    shards = max(1, math.ceil(size / SHARD_ROWS))
    index = materialize(cells.repartitionByRange(shards, "c1", "c2", "row").sortWithinPartitions("c1", "c2", "row"))
    shared.destroy()
    return Index(index, sample, books, width, float if width * most * most < 1 << 53 else np.int64)


# -- search --------------------------------------------------------------------------------------


class Shard:
    """Rows of some cells, sorted by cell, with the radius of every code as these rows have it."""

    def __init__(self, c1, c2, row, ids, labels, vectors, books: Codebooks, kind: type):
        order = np.lexsort((c2, c1))
        c1, c2 = c1[order], c2[order]
        self.row, self.ids, self.labels = row[order], ids[order], labels[order]
        self.numbers = vectors[order].astype(kind)
        (self.codes1, at1), (self.codes2, at2) = (np.unique(c, return_inverse=True) for c in (c1, c2))
        self.centres = books.first[self.codes1], books.second[self.codes2]
        self.radii = []
        for half, centres, at in zip(_halves(self.numbers.astype(float)), self.centres, (at1, at2)):
            radius = np.zeros(len(centres))
            np.maximum.at(radius, at, np.linalg.norm(half - centres[at], axis=1))
            self.radii.append(radius)
        cell = at1 * len(self.codes2) + at2
        cells, starts = np.unique(cell, return_index=True)
        self.starts = np.full(len(self.codes1) * len(self.codes2), -1)
        self.ends = self.starts.copy()
        self.starts[cells], self.ends[cells] = starts, np.append(starts[1:], len(cell))

    def half_bounds(self, anchors: np.ndarray) -> list[np.ndarray]:
        """Most that a row of each code can add to each anchor's score, for both halves."""
        bounds = []
        for half, centres, radius in zip(_halves(anchors.astype(float)), self.centres, self.radii):
            length = np.linalg.norm(half, axis=1)[:, None]
            reach = np.linalg.norm(centres, axis=1) + radius
            bounds.append(half @ centres.T + length * radius + 1e-9 * length * reach + 1e-6)
        return bounds

    def visit(self, first: np.ndarray, second: np.ndarray) -> Iterator[tuple[float, int, int]]:
        """``(bound, start, end)`` of the cells by descending bound, from an anchor's two lists."""
        order1, order2 = np.argsort(-first, kind="stable").tolist(), np.argsort(-second, kind="stable").tolist()
        best1, best2 = first[order1].tolist(), second[order2].tolist()
        width = len(self.codes2)
        heap, reached = [(-(best1[0] + best2[0]), 0, 0)], [0] * len(order1)
        while heap:
            bound, i, j = heapq.heappop(heap)
            cell = order1[i] * width + order2[j]
            if (start := self.starts[cell]) >= 0:
                yield -bound, start, self.ends[cell]
            reached[i] = j + 1
            # a cell is due once its neighbours in both lists have been seen
            if j + 1 < len(order2) and (i == 0 or reached[i - 1] > j + 1):
                heapq.heappush(heap, (-(best1[i] + best2[j + 1]), i, j + 1))
            if i + 1 < len(order1) and reached[i + 1] == j:
                heapq.heappush(heap, (-(best1[i + 1] + best2[j]), i + 1, j))


def _best(scores: np.ndarray, ids: np.ndarray, limit: int) -> np.ndarray:
    """Indices of the first ``limit`` by score descending, id ascending."""
    return np.lexsort((ids, -scores))[:limit]


def search(
    shard: Shard, block: Block, anchor: int, bounds: list[np.ndarray], limit: int, same: bool
) -> list[tuple[np.ndarray, np.ndarray]]:
    """Per window of the anchor the first ``limit`` rows of the shard: ``(scores, ids)``.

    ``same`` asks for other rows of the anchor's label, else for rows of different labels.
    """
    low, high = block.low[anchor], block.high[anchor]
    query = block.vectors[anchor].astype(shard.numbers.dtype)
    least = np.maximum(low, block.floors[anchor])
    found = [(np.zeros(0, np.int64), np.zeros(0, np.int64)) for _ in low]
    waiting, size = [], 0

    def judge() -> None:
        at = np.concatenate([np.arange(a, b) for a, b in waiting])
        alike = shard.labels[at] == block.labels[anchor]
        at = at[alike & (shard.row[at] != block.rows[anchor]) if same else ~alike]
        scores = (shard.numbers[at] @ query).astype(np.int64)
        for w in range(len(low)):
            ok = (scores >= least[w]) & (scores <= high[w])
            if ok.any():
                s, i = np.append(found[w][0], scores[ok]), np.append(found[w][1], shard.ids[at[ok]])
                kept = _best(s, i, limit)
                found[w] = s[kept], i[kept]
                if len(kept) == limit:
                    least[w] = max(least[w], s[kept[-1]])

    for bound, start, end in shard.visit(bounds[0][anchor], bounds[1][anchor]):
        if bound < least.min():
            break  # certified: no row left can enter any window
        waiting.append((start, end))
        size += end - start
        if size >= SCORED_ROWS:
            judge()
            waiting, size = [], 0
    if waiting:
        judge()
    return found


def _shards(batches, books: Codebooks, kind: type, rows: int) -> Iterator[Shard]:
    held, size = [], 0

    def shard() -> Shard:
        table = pa.Table.from_batches(held)
        columns = [table[c].to_numpy() for c in ("c1", "c2", "row", "id", "label")]
        width = books.first.shape[1] + books.second.shape[1]
        return Shard(*columns, _unpacked(table["vector"], width), books, kind)

    for batch in batches:
        if held and size + batch.num_rows > rows:
            yield shard()
            held, size = [], 0
        if batch.num_rows:
            held.append(batch)
            size += batch.num_rows
    if held:
        yield shard()


def _search(batches, shared, limit: int, same: bool, rows: int) -> Iterator[pa.RecordBatch]:
    block, books, kind = shared.value
    for shard in _shards(batches, books, kind, rows):
        bounds = shard.half_bounds(block.vectors)
        out: dict[str, list] = {"anchor": [], "window": [], "id": [], "score": []}
        for a, row in enumerate(block.rows.tolist()):
            for w, (scores, ids) in enumerate(search(shard, block, a, bounds, limit, same)):
                out["anchor"].extend([row] * len(ids))
                out["window"].extend([w] * len(ids))
                out["id"].extend(ids.tolist())
                out["score"].extend(scores.tolist())
        yield pa.RecordBatch.from_pydict(
            {k: pa.array(v, pa.int32() if k == "window" else pa.int64()) for k, v in out.items()}
        )


def _floors(batches, shared, limit: int, same: bool) -> Iterator[pa.RecordBatch]:
    """The asks with the score that ``limit`` rows of the pilot reach in each window."""
    rows, labels, vectors = shared.value
    for batch in batches:
        floors = []
        asked = (batch.column(c) for c in ("row", "label", "vector", "low", "high"))
        for row, label, vector, low, high in zip(*(c.to_pylist() for c in asked)):
            scores = (vectors @ np.frombuffer(vector or bytearray(), np.int64).astype(vectors.dtype)).astype(np.int64)
            alike = labels == label
            scores = scores[alike & (rows != row) if same else ~alike]
            own = []
            for a, b in zip(low, high):
                inside = scores[(scores >= a) & (scores <= b)]
                reached = len(inside) >= limit
                own.append(int(np.partition(inside, len(inside) - limit)[len(inside) - limit]) if reached else NEVER)
            floors.append(own)
        yield batch.append_column("floors", pa.array(floors, pa.list_(pa.int64())))


def _blocks(asks: DataFrame, size: int, width: int, windows: int) -> Iterator[Block]:
    """The asks in parts of about ``size``, one at a time; windows that an anchor lacks are empty."""
    parts = math.ceil(asks.count() / size)
    for part in range(parts):
        own = asks if parts == 1 else asks.filter(F.pmod(F.xxhash64("row"), F.lit(parts)) == part)
        own = own.toArrow()
        if not own.num_rows:
            continue
        edges = []
        for name, filler in (("low", NO_ID), ("high", NEVER), ("floors", NO_ID)):
            filled = [(x + [filler] * windows)[:windows] for x in own[name].to_pylist()]
            edges.append(np.array(filled, np.int64).reshape(own.num_rows, windows))
        yield Block(own["row"].to_numpy(), own["label"].to_numpy(), _unpacked(own["vector"], width), *edges)


def _answers(
    index: Index, asks: DataFrame, windows: int, limit: int, same: bool, shard_rows: int, block_anchors: int
) -> DataFrame:
    """``anchor, window, id, score, rank``: for each ask (``row, label, vector, low, high``) the first ``limit`` rows.

    ``low`` and ``high`` are arrays of up to ``windows`` scores.
    """
    spark, context = asks.sparkSession, asks.sparkSession.sparkContext
    pilot = index.sample["row"].to_numpy(), index.sample["label"].to_numpy(), _matrix(index.sample["vector"], index.width)
    shared = context.broadcast((*pilot[:2], pilot[2].astype(index.kind)))
    schema = "row long, label long, vector binary, low array<long>, high array<long>, floors array<long>"
    asks = materialize(map_arrow(asks, partial(_floors, shared=shared, limit=limit, same=same), schema))
    shared.destroy()
    order, parts = Window.partitionBy("anchor", "window").orderBy(F.desc("score"), "id"), []
    for block in _blocks(asks, block_anchors, index.width, windows):
        shared = context.broadcast((block, index.books, index.kind))
        found = map_arrow(
            index.rows, partial(_search, shared=shared, limit=limit, same=same, rows=shard_rows),
            "anchor long, window int, id long, score long",
        )
        parts.append(materialize(found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= limit)))
        shared.destroy()
    if not parts:
        return spark.createDataFrame([], "anchor long, window int, id long, score long, rank int")
    return reduce(DataFrame.unionByName, parts)


def hard_negatives(
    rows: DataFrame,
    is_anchor: Column,
    positives: int = 5,
    negatives: int = 3,
    low_percent: int = 50,
    high_percent: int = 95,
    scale: int = 256,
    shard_rows: int = SHARD_ROWS,
    block_anchors: int = BLOCK_ANCHORS,
) -> DataFrame:
    """For each anchor and positive the best rows of other labels whose score lies in the positive's window.

    ``rows`` has ``vec_id``, ``label`` and ``embedding``; ``is_anchor`` is a condition on ``id``. Gives
    ``anchor_id, positive_id, rank, negative_id, positive_score, negative_score``. Higher scores come
    first, ties by smaller id. A pair without a negative in its window has no row.

    Rows without label, vector or finite components take no part; rows without id do, after all
    others, and have null as id. Repeated ids are rows of their own. Zeros follow a shorter vector; an
    empty one scores 0. Vectors whose inner products may pass 56 bits fail with ``ArithmeticError``.
    Other columns, of any name, are not read. An empty table gives an empty result.
    """
    index = build_index(integer_vectors(rows, scale))
    anchors = index.rows.filter(is_anchor).select("row", "id", "label", "vector")
    sizes = {"shard_rows": shard_rows, "block_anchors": block_anchors}
    everything = anchors.select(
        "row", "label", "vector", F.array(F.lit(NEVER)).alias("low"), F.array(F.lit(NO_ID)).alias("high")
    )
    chosen = _answers(index, everything, 1, positives, True, **sizes).select(
        F.col("anchor").alias("row"), (F.col("rank") - 1).alias("window"), F.col("id").alias("positive_id"),
        F.col("score").alias("positive_score"),
    )
    low = F.ceil(F.lit(low_percent).cast("decimal(3,0)") * F.col("positive_score") / 100).cast("long")
    high = F.floor(F.lit(high_percent).cast("decimal(3,0)") * F.col("positive_score") / 100).cast("long")
    windows = chosen.withColumn("low", low).withColumn("high", high)
    # an empty window asks for nothing
    windows = windows.withColumn("low", F.when(F.col("low") <= F.col("high"), F.col("low")).otherwise(NO_ID))
    windows = windows.groupBy("row").agg(F.sort_array(F.collect_list(F.struct("window", "low", "high"))).alias("w"))
    asked = anchors.join(windows, "row").select(
        "row", "label", "vector", F.col("w.low").alias("low"), F.col("w.high").alias("high")
    )
    far = _answers(index, asked, positives, negatives, False, **sizes).withColumnsRenamed(
        {"anchor": "row", "id": "negative_id", "score": "negative_score"}
    )
    found = far.join(chosen, ["row", "window"]).join(anchors.select("row", F.col("id").alias("anchor_id")), "row")

    def known(name: str) -> Column:
        return F.nullif(F.col(name), F.lit(NO_ID)).alias(name)

    return found.select(
        known("anchor_id"), known("positive_id"), "rank", known("negative_id"), "positive_score", "negative_score"
    )
