import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from spendlake.llm import hard_negatives as module
from spendlake.llm.hard_negatives import hard_negatives

SCHEMA = "vec_id long, embedding array<double>, label int, row string, id string, c1 int, vector int, score int"


def frame(spark, rows):
    return spark.createDataFrame([(*r, None, "x", 1, 2, 3) for r in rows], SCHEMA)


def plain(rows, every=5, positives=5, negatives=3):
    own = []
    for vec_id, vector, label in rows:
        if label is None or vector is None or any(x is None or not math.isfinite(x) for x in vector):
            continue
        own.append((vec_id, [math.floor(256 * x) for x in vector], label))
    out = []

    def first(found, limit):
        return sorted(found, key=lambda x: (-x[0], x[1] is None, x[1] or 0))[:limit]

    for a, (anchor, query, label) in enumerate(own):
        if anchor is None or anchor % every:
            continue
        scored = [(sum(x * y for x, y in zip(query, v)), i, k) for j, (i, v, k) in enumerate(own) if j != a]
        for p, positive, _ in first([s for s in scored if s[2] == label], positives):
            window = [s for s in scored if s[2] != label and 50 * p <= 100 * s[0] <= 95 * p]
            for rank, (n, negative, _) in enumerate(first(window, negatives), 1):
                out.append((anchor, positive, rank, negative, p, n))
    return sorted(out, key=str)


def got(spark, rows, every=5, **options):
    found = hard_negatives(frame(spark, rows), F.col("id") % every == 0, **options)
    return sorted((tuple(r) for r in found.collect()), key=str)


def random_rows(n, width, seed, clusters=0, labels=4):
    rng = np.random.default_rng(seed)
    points = rng.normal(size=(n, width))
    if clusters:
        points = rng.normal(size=(clusters, width))[rng.integers(0, clusters, n)] + 0.2 * points
    points /= np.linalg.norm(points, axis=1)[:, None]
    return [(int(i), p.tolist(), int(k)) for i, p, k in zip(rng.permutation(n), points, rng.integers(0, labels, n))]


@pytest.mark.parametrize("clusters", [0, 12])
def test_against_all_pairs(spark, clusters):
    rows = random_rows(700, 16, 1, clusters)
    assert len(plain(rows)) > 500
    assert got(spark, rows) == plain(rows)
    assert got(spark, rows, shard_rows=50, block_anchors=20) == plain(rows)


def test_without_a_full_pilot(spark, monkeypatch):
    monkeypatch.setattr(module, "SAMPLE_ROWS", 30)
    rows = random_rows(400, 7, 2, 5)
    assert got(spark, rows, shard_rows=64) == plain(rows)


def test_hot_vector_and_ties(spark):
    rows = random_rows(200, 8, 3)
    rows += [(1000 + i, rows[0][1], i % 3) for i in range(150)]
    assert got(spark, rows, shard_rows=40) == plain(rows)


def test_edges(spark):
    nan, inf = float("nan"), float("inf")
    rows = [
        (0, [1.0, 0.5], 1), (5, None, 1), (10, [1.0, None], 1), (15, [nan, 1.0], 2), (20, [inf, 1.0], 2), (25, [0.0, 1.0], None),
        (1, [0.9, 0.4], 1), (None, [0.8, 0.5], 1), (None, [0.5, 0.5], 2), (2, [0.6, 0.3], 2), (2, [0.6, 0.3], 2), (2, [0.7, 0.3], 1),
        (3, [-1.0, -1.0], 2), (4, [0.5], 3), (6, [], 3), (30, [-0.5, 0.1], 1), (35, [], 3), (0, [1.0, 0.5], 1), (7, [0.5, 0.2, 0.9], 2),
    ]
    assert got(spark, rows) == plain(rows)


def test_few_rows_and_none(spark):
    assert got(spark, []) == []
    assert got(spark, [(0, [1.0], 1)]) == []
    assert got(spark, [(0, [1.0], 1), (1, [1.0], 1)]) == []
    assert got(spark, [(0, [], 1), (1, [], 1), (2, [], 2)]) == plain([(0, [], 1), (1, [], 1), (2, [], 2)])


def test_large_components(spark):
    rows = [(i, [1e4 * math.sin(i * j + 1) for j in range(5)], i % 3) for i in range(60)]
    assert got(spark, rows) == plain(rows)
    wide = [(i, [1e5 * math.sin(i * j + 1) for j in range(5)], i % 3) for i in range(60)]
    assert got(spark, wide) == plain(wide)  # beyond 53 bits
    with pytest.raises(ArithmeticError):
        got(spark, [(0, [1e30], 1)])


def test_cells_come_by_descending_bound():
    rng = np.random.default_rng(4)
    vectors = rng.integers(-200, 200, (500, 6))
    books = module.Codebooks(*(module.k_means(h.astype(float), 9) for h in module._halves(vectors)))
    codes = [module.nearest(h.astype(float), b) for h, b in zip(module._halves(vectors), books)]
    n = np.arange(500)
    shard = module.Shard(*codes, n, n, n % 3, vectors, books, float)
    query = rng.integers(-200, 200, (1, 6))
    first, second = shard.half_bounds(query)
    visited = list(shard.visit(first[0], second[0]))
    bounds = [b for b, _, _ in visited]
    assert bounds == sorted(bounds, reverse=True)
    assert sorted(i for _, a, b in visited for i in range(a, b)) == list(range(500))
    for bound, a, b in visited:
        assert (shard.numbers[a:b] @ query[0] <= bound).all()
