import re

import numpy as np
import pytest
import xxhash

from spendlake.llm import simhash
from spendlake.llm.catalog import QUERIES
from spendlake.llm.common import read_input
from spendlake.llm.components import connected
from tests.llm.conftest import edge_rows

LOW = str.maketrans({chr(65 + i): chr(97 + i) for i in range(26)})


def plain_fingerprint(text, width=3):
    w = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOW))
    shingles = [" ".join(w[k : k + width]) for k in range(len(w) - width + 1)] if len(w) >= width else [" ".join(w)] * bool(w)
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_components(ids, prints, radius):
    parent = {}

    def find(x):
        while parent.setdefault(x, x) != x:
            x = parent[x]
        return x

    values = np.array(prints, np.uint64)
    for i, value in enumerate(values):
        for j in np.flatnonzero(np.bitwise_count(values ^ value) <= radius):
            a, b = find(int(values[i])), find(int(values[j]))
            parent[max(a, b)] = min(a, b)
    least = {}
    for i, f in zip(ids, prints):
        if i is not None:
            root = find(int(f))
            least[root] = min(i, least.get(root, i))
    return [least.get(find(int(f))) for f in prints]


def test_whole_table_matches_brute_force(spark, sf_dir):
    rows = read_input(spark, sf_dir, "documents").select("doc_id", "text").collect()
    prints = [plain_fingerprint(r.text) for r in rows]
    expected = plain_components([r.doc_id for r in rows], prints, 2)
    found = {r.doc_id: (r.fingerprint, r.component_id) for r in QUERIES["op5_simhash"](spark, sf_dir).collect()}
    assert found == {r.doc_id: (f"{f:016x}", c) for r, f, c in zip(rows, prints, expected)}


def test_edges(edge):
    rows = edge_rows()
    found = [(r.doc_id, r.fp % (1 << 64), r.component_id) for r in simhash.near_duplicates(edge).collect()]
    prints = [plain_fingerprint(t) for _, t in rows]
    expected = plain_components([i for i, _ in rows], prints, 2)
    key = lambda x: tuple(-1 if v is None else v for v in x)
    assert sorted(found, key=key) == sorted(((i, f, c) for (i, _), f, c in zip(rows, prints, expected)), key=key)


def test_no_documents(none):
    assert simhash.near_duplicates(none).count() == 0
    assert simhash.one_row_of_each_group(none).columns == none.columns


@pytest.mark.parametrize("shape", ["random", "dense", "chain"])
def test_tree_loses_no_link(spark, shape):
    rng = np.random.default_rng(5)
    if shape == "random":
        points = rng.integers(0, 1 << 64, 3000, dtype=np.uint64)
        points[::7] = points[0::7] ^ np.uint64(1 << 9)
        points[1::7] = points[0::7][: len(points[1::7])] ^ np.uint64(3)
    elif shape == "dense":  # one ball of more points than any leaf holds
        flips = rng.integers(0, 64, (3000, 3), dtype=np.uint64)
        points = np.uint64(0x123456789ABCDEF0) ^ np.bitwise_xor.reduce(np.uint64(1) << flips, axis=1)
    else:
        steps = np.uint64(1) << rng.integers(0, 64, 2500, dtype=np.uint64)
        points = np.bitwise_xor.accumulate(steps)
    points = np.unique(points)
    table = spark.createDataFrame([(int(p),) for p in points.view(np.int64)], "fp long")
    roots = {r.node: r.root for r in connected(simhash.near_links(table, 2, shard_rows=200)).collect()}
    own = [roots.get(int(p), int(p)) for p in points.view(np.int64)]
    expected = plain_components(range(len(points)), points.tolist(), 2)
    pairs = set(zip(own, expected))
    assert len(pairs) == len(set(own)) == len(set(expected))


def test_shards_stay_small():
    points = np.random.default_rng(1).integers(0, 1 << 64, 40_000, dtype=np.uint64)
    nodes, leaves = simhash.build_tree(points[:4000], 250, 2)
    sent = sum(len(own) for _, own in simhash.route(points, nodes, 2))
    assert leaves >= 16 and sent < 3.5 * len(points)


def test_components_of_hub_and_chain(spark):
    edges = [(0, i) for i in range(1, 500)] + [(i, i + 1) for i in range(1000, 1100)] + [(7, 7)]
    roots = {r.node: r.root for r in connected(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert roots == {i: 0 for i in range(500)} | {i: 1000 for i in range(1000, 1101)}
    assert connected(spark.createDataFrame([], "a long, b long")).count() == 0


def test_one_row_of_each_group_whatever_the_ids(docs_of, none, edge):
    a, b, c, d = ("alpha beta gamma delta", "one two three four", "red green blue black", "north south east west")
    rows = [
        (1, a), (1, b), (2, b),  # two texts under one id; the second's copy has another
        (None, c), (None, c), (None, d), (7, d),  # a group without ids, and one with a row without
    ]
    for table in (docs_of(rows), docs_of(rows[::-1]), docs_of(rows).selectExpr("*", "doc_id AS own_row")):
        kept = simhash.one_row_of_each_group(table)
        assert kept.columns == table.columns
        got = sorted(((r.doc_id, r.text) for r in kept.collect()), key=lambda r: r[1])
        assert got == [(1, a), (7, d), (1, b), (None, c)]
    assert simhash.one_row_of_each_group(none).count() == 0
    fps = simhash.near_duplicates(edge).select("fp", "component_id").distinct().collect()
    named = {r.component_id for r in fps}
    assert {r.doc_id for r in simhash.one_row_of_each_group(edge).select("doc_id").collect()} == named
