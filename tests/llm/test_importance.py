import math
import random

import pytest
from pyspark.sql import functions as F

from spendlake.llm import importance as im
from spendlake.llm.catalog import QUERIES
from spendlake.llm.common import read_input
from tests.llm.conftest import edge_rows


@pytest.fixture(scope="module")
def corpus(docs_of, spark):
    rng = random.Random(1)
    good, bad = ["calm", "clear", "river", "stone", "light"], ["spam", "click", "buy", "now", "win"]
    rows = []
    for i in range(400):
        mix = 0.9 if i % 4 == 0 else 0.1
        rows.append((i, " ".join(rng.choice(good if rng.random() < mix else bad) for _ in range(30))))
    ids = spark.createDataFrame([(i,) for i in range(0, 200, 4)], "doc_id long")
    return docs_of(rows), ids


def test_target_like_texts_are_preferred(corpus):
    docs, ids = corpus
    rows = im.resample(docs, ids, keep_share=0.25).collect()
    kept = [r.doc_id for r in rows if r.selected]
    assert len(rows) == 400 and len(kept) == 100
    assert sum(i % 4 == 0 for i in kept) > 90
    again = im.resample(docs, ids, keep_share=0.25).collect()
    assert sorted(rows) == sorted(again)


def test_draw_is_gumbel_top_k_in_proportion_to_the_weights(docs_of, spark):
    """Of texts with equal weight every share is as likely as any other."""
    docs = docs_of([(i, "same words in every text") for i in range(4000)])
    rows = im.resample(docs, spark.createDataFrame([(1,)], "doc_id long"), keep_share=0.5).collect()
    assert len({round(r.log_weight, 9) for r in rows}) == 1
    noise = [r.key - r.log_weight for r in rows]
    assert abs(sum(noise) / len(noise) - 0.5772) < 0.08  # the mean of a standard Gumbel variable
    share = sum(math.exp(-math.exp(-x)) < 0.25 for x in noise) / len(noise)
    assert abs(share - 0.25) < 0.04


@pytest.mark.parametrize("k", [0, 1, 7, 500, 999, 1000])
def test_cut_is_exact_with_ties(spark, k):
    rng = random.Random(k)
    keys = [rng.choice([0.0, 1.5, -2.0, rng.gauss(0, 1e3), rng.gauss(0, 1e-9)]) for _ in range(1000)]
    table = spark.createDataFrame(list(enumerate(keys)), "row_id long, key double")
    found = {r.row_id for r in im.largest(table, k).collect() if r.selected}
    assert found == {i for i, _ in sorted(enumerate(keys), key=lambda x: (-x[1], x[0]))[:k]}


def test_whole_table(spark, sf_dir):
    rows = QUERIES["op2_resampling"](spark, sf_dir).collect()
    n = read_input(spark, sf_dir, "documents").count()
    assert len(rows) == n and sum(r.selected for r in rows) == round(n / 2)
    quality = {r.doc_id: r.quality for r in read_input(spark, sf_dir, "labels").collect()}
    good = [r.log_weight for r in rows if quality.get(r.doc_id) == 1]
    bad = [r.log_weight for r in rows if quality.get(r.doc_id) == 0]
    assert sum(a > b for a in good for b in bad) / len(good) / len(bad) > 0.9


def test_weights_match_plain_counting(spark, docs_of):
    texts = ["a b a", "b c", "A  b", ""]
    docs = docs_of(list(enumerate(texts)))
    rows = {r.doc_id: r.log_weight for r in im.resample(docs, docs.filter("doc_id = 0")).collect()}
    from collections import Counter

    def features(t):
        w = t.lower().split()
        return Counter(w) + Counter(zip(w, w[1:]))

    raw, target, size = sum((features(t) for t in texts), Counter()), features(texts[0]), 1 << im.BUCKET_BITS
    ratio = lambda f: math.log((target[f] + 1) / (sum(target.values()) + size)) - math.log((raw[f] + 1) / (sum(raw.values()) + size))
    for i, t in enumerate(texts):
        assert rows[i] == pytest.approx(sum(n * ratio(f) for f, n in features(t).items()))


def test_edges(edge, none, corpus, spark):
    _, ids = corpus
    rows = im.resample(edge, ids).collect()
    assert len(rows) == len(edge_rows()) and sum(r.selected for r in rows) == round(len(rows) / 2)
    assert {r.log_weight for r in rows if r.doc_id in (1, 2, 3)} == {0.0}
    assert im.resample(none, ids).count() == 0
    assert im.resample(edge, ids.limit(0)).count() == len(edge_rows())
    assert im.resample(edge, spark.createDataFrame([(None,), (7,), (7,)], "doc_id long")).filter(F.col("selected")).count() == round(len(rows) / 2)
