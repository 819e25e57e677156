import numpy as np
import pytest

from spendlake.llm import mixing
from spendlake.llm.catalog import MIX_TARGETS, QUERIES
from spendlake.llm.common import read_input
from tests.llm.conftest import edge_rows


@pytest.fixture(scope="module")
def corpus(docs_of, spark):
    rng = np.random.default_rng(2)
    vocabulary = {"a": ["apple", "axe", "ant", "arm"], "b": ["bee", "bow", "bat", "bin"], "c": ["cow", "car", "cap", "cup"]}
    docs, labels = [], []
    for i in range(300):
        d = "aaaabbc"[i % 7]
        other = "abc"[i % 3] if i % 10 == 0 else d  # some texts are mixed
        text = [str(rng.choice(vocabulary[d if k % 2 else other])) for k in range(int(rng.integers(5, 60)))]
        docs.append((i, " ".join(text)))
        if i % 2:
            labels.append((i, d))
    return docs_of(docs), spark.createDataFrame(labels, "doc_id long, domain string")


def totals(rows):
    rate, tokens = np.array([r._rate for r in rows]), np.array([r._n_tokens for r in rows])
    return (rate * tokens) @ np.array([r._posterior for r in rows]), tokens.sum()


@pytest.mark.parametrize("weights", [(1, 1, 1), (0.7, 0.2, 0.1), (0, 3, 1)])
def test_totals_meet_the_targets(corpus, weights):
    docs, labels = corpus
    out = mixing.mix(docs, labels, dict(zip("abc", weights)))
    assert out.columns[: len(docs.columns)] == docs.columns
    rows = out.collect()
    got, tokens = totals(rows)
    want = np.array(weights) / sum(weights) * tokens
    assert np.abs(got - want).max() < 0.02 * tokens
    assert all(r._rate >= 0 for r in rows)
    assert all(abs(sum(r._posterior) - 1) < 1e-9 for r in rows)


def test_steps_match_plain_projected_gradient():
    rng = np.random.default_rng(0)
    p = rng.dirichlet([0.3, 0.3, 0.3], 50)
    steps = [rng.normal(size=3) for _ in range(5)]
    rate = [1.0] * 50
    for s in steps:
        rate = [max(0.0, r - float(np.dot(s, q))) for r, q in zip(rate, p)]
    assert np.allclose(mixing.rates(p, steps), rate)


def table(seed):
    """Tokens, posteriors and targets; the blurred posteriors of even seeds may not reach them."""
    rng = np.random.default_rng(seed)
    p = rng.dirichlet([0.4, 0.4, 0.4] if seed % 2 else [3.0, 2.0, 4.0], 120)
    return rng.integers(0, 400, 120), p, rng.dirichlet([0.5, 0.5, 0.5])


def solves(n, p, targets, rate):
    """The conditions of a solution: no gradient at positive rates, none that points below zero at others."""
    error = (rate * n) @ p - targets * n.sum()
    gradient = p @ np.linalg.inv((p * n[:, None]).T @ p) @ error
    assert (rate >= 0).all()
    assert np.abs(gradient[(rate > 1e-4) & (n > 0)]).max() < 1e-4 and gradient[n > 0].min() > -1e-4
    assert np.abs(error).sum() / n.sum() < 1e-3 or (rate == 0).any()


@pytest.mark.parametrize("seed", range(8))
def test_rates_solve_the_least_squares(monkeypatch, seed):
    n, p, targets = table(seed)

    def totals(_, descent, size):
        rate, before, start = mixing._points(p, descent)
        weighted = p * n[:, None]
        moved = [n @ (rate - start) ** 2, n @ ((rate - start) * (rate - before))]
        return np.concatenate((rate @ weighted, (p.T @ weighted).ravel(), moved))

    monkeypatch.setattr(mixing, "_totals", totals)
    solves(n, p, targets, mixing.rates(p, *mixing.fit_rates(None, targets, max_steps=3000)))


def test_distributed_rates_solve_the_least_squares(spark):
    n, p, targets = table(0)
    membership = spark.createDataFrame([(int(a), b.tolist()) for a, b in zip(n, p)], "n long, p array<double>").repartition(3)
    descent = mixing.fit_rates(membership, targets)
    assert len(descent.steps) > 5
    solves(n, p, targets, mixing.rates(p, *descent))


def test_an_unfinished_descent_warns(spark):
    rng = np.random.default_rng(0)
    rows = [(int(a), b.tolist()) for a, b in zip(rng.integers(1, 99, 60), rng.dirichlet([2.0, 3.0, 2.0], 60))]
    membership = spark.createDataFrame(rows, "n long, p array<double>")
    with pytest.warns(RuntimeWarning, match="off target"):
        mixing.fit_rates(membership, np.array([0.98, 0.01, 0.01]), max_steps=2)


def test_labelled_texts_of_any_length_teach(docs_of, spark):
    docs = docs_of([(1, "apple " * 20_000), (2, "bee " * 20_000), (3, "apple apple"), (4, "bee")])
    labels = spark.createDataFrame([(1, "a"), (2, "b")], "doc_id long, domain string")
    found = {r.doc_id: r._domain for r in mixing.mix(docs, labels, {"a": 1, "b": 1}).collect()}
    assert found == {1: "a", 2: "b", 3: "a", 4: "b"}


def test_whole_table(spark, sf_dir):
    rows = QUERIES["op3_mixing"](spark, sf_dir).collect()
    lang = {r.doc_id: r.lang for r in read_input(spark, sf_dir, "documents").collect()}
    assert len(rows) == len(lang)
    assert sum(r.domain == lang[r.doc_id] for r in rows) / len(rows) > 0.95
    tokens = sum(r.n_tokens for r in rows)
    for k, d in enumerate(MIX_TARGETS):
        assert sum(r.rate * r.n_tokens * r.posterior[k] for r in rows) == pytest.approx(MIX_TARGETS[d] * tokens, rel=1e-3)


def test_edges(edge, none, corpus, spark):
    _, labels = corpus
    rows = mixing.mix(edge, labels, {"a": 1, "b": 1}).collect()
    assert len(rows) == len(edge_rows())
    assert all(r._n_tokens == 0 for r in rows if r.doc_id in (1, 2, 3))
    assert mixing.mix(none, labels, {"a": 1, "b": 1}).count() == 0
    odd = spark.createDataFrame([(None, "a"), (1, None), (7, "zzz"), (7, "b"), (7, "a"), (6, "a")], labels.schema)
    assert mixing.mix(edge, odd, {"a": 1, "b": 1}).count() == len(edge_rows())
    assert mixing.mix(edge, labels.limit(0), {"a": 1, "b": 1}).count() == len(edge_rows())
