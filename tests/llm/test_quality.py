import math
import re
from collections import Counter

import pytest

from spendlake.llm import quality as q
from spendlake.llm.catalog import QUERIES
from spendlake.llm.common import read_input
from tests.llm.conftest import edge_rows, words


def plain(text):
    t = text or ""
    w = re.findall(r"[^\x20\x09-\x0D]+", t)
    windows = [tuple(w[k : k + 3]) for k in range(len(w) - 2)]
    seen, repeated = Counter(windows), set()
    for k, x in enumerate(windows):
        if seen[x] > 1:
            repeated.update((k, k + 1, k + 2))
    lines = [x for x in t.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    symbols = len(re.findall(r"[#*$%&|<>]", t))
    failed = len(w) < 50 or 100 * len(repeated) > 50 * len(w)
    return len(w), sum(map(len, w)), symbols, len(lines) - len(set(lines)), len(repeated), failed


def shown(r):
    return r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed


def test_measures_of_edges(docs_of, none):
    texts = [t for _, t in edge_rows()] + ["a b c a b c", "a b c a b", "x x x x", "a b a b a", "#*$%&|<>", "<b>\n<b>\r\n<b>", words(5, 60) + " " + words(5, 60)]
    rows = {r.doc_id: shown(r) for r in q.judge_quality(docs_of(list(enumerate(texts)))).collect()}
    assert rows == {i: plain(t) for i, t in enumerate(texts)}
    assert q.judge_quality(none).count() == 0


def test_rows_are_kept(edge):
    rows = q.judge_quality(edge).collect()
    assert len(rows) == len(edge_rows()) and not any(r.kept for r in rows if r.base_failed)


def test_whole_table(spark, sf_dir):
    text = {r.doc_id: r.text for r in read_input(spark, sf_dir, "documents").collect()}
    rows = QUERIES["op6_quality"](spark, sf_dir).collect()
    assert {r.doc_id: shown(r) for r in rows} == {i: plain(t) for i, t in text.items()}
    truth = {r.doc_id: r.quality for r in read_input(spark, sf_dir, "labels").collect()}
    judged = [r for r in rows if r.doc_id in truth and not r.base_failed]
    assert sum(r.kept == bool(truth[r.doc_id]) for r in judged) / len(judged) > 0.9


def plain_em(votes, rules, tolerance, limit):
    good, keep = 0.8, {r: (0.8, 0.2) for r in rules}

    def posterior(v):
        a, b = good, 1 - good
        for r in rules:
            if v[r] is not None:
                g, w = keep[r]
                a, b = a * (g if v[r] else 1 - g), b * (w if v[r] else 1 - w)
        return a / (a + b)

    for _ in range(limit):
        p = [posterior(v) for v in votes]
        new = {}
        for r in rules:
            sides = []
            for weight in (p, [1 - x for x in p]):
                k = sum(x for x, v in zip(weight, votes) if v[r] is True)
                d = sum(x for x, v in zip(weight, votes) if v[r] is False)
                sides.append((k + 1) / (k + d + 2))
            new[r] = tuple(sides)
        share = (sum(p) + 1) / (len(votes) + 2)
        moved = max([abs(share - good)] + [abs(a - b) for r in rules for a, b in zip(new[r], keep[r])])
        good, keep = share, new
        if moved < tolerance:
            break
    return good, keep


def test_em_matches_plain_em_and_finds_accuracies(spark):
    import random

    rng, names = random.Random(1), ["r0", "r1", "r2", "r3"]
    right = dict(zip(names, (0.95, 0.9, 0.8, 0.6)))
    rows = []
    for _ in range(1500):
        truth = rng.random() < 0.7
        rows.append([None if rng.random() < 0.2 else (truth if rng.random() < right[n] else not truth) for n in names])
    rules = tuple(q.Rule(n, None) for n in names)
    fit = q.estimate(spark.createDataFrame(rows, ", ".join(f"{n} boolean" for n in names)), rules)
    good, keep = plain_em([dict(zip(names, r)) for r in rows], names, q.TOLERANCE, q.MAX_ITERATIONS)
    assert fit.good == pytest.approx(good) and abs(good - 0.7) < 0.08
    for n in names:
        assert fit.keep[n] == pytest.approx(keep[n])
        assert abs(fit.keep[n][0] - right[n]) < 0.1


def test_posterior_ignores_abstentions(spark):
    fit = q.Fit(0.5, {"r": (0.9, 0.3)}, {"r": (0.1, 0.7)})
    rows = spark.createDataFrame([(True,), (False,), (None,)], "r boolean")
    got = [x[0] for x in rows.select(q.posterior(fit, (q.Rule("r", None),))).collect()]
    assert got == pytest.approx([0.75, 0.125, 0.5]) and not any(map(math.isnan, got))


def test_native_plan(edge, plan_of):
    plan = plan_of(q.measures(edge))
    assert "Python" not in plan and "Arrow" not in plan
