import zlib

import numpy as np
import pytest

from spendlake.llm import toxicity as t
from spendlake.llm.catalog import QUERIES
from spendlake.llm.common import read_input
from tests.llm.conftest import edge_rows, words


@pytest.fixture(scope="module")
def corpus(docs_of, labels_of):
    """Ordinary texts, and toxic ones with a few inflected forms of three stems."""
    rng = np.random.default_rng(3)
    docs, labels = [], []
    for i in range(400):
        text = words(i, int(rng.integers(20, 120))).split()
        toxic = i % 5 == 0
        if toxic:
            for _ in range(1 + len(text) // 40):
                stem, ending = rng.choice(["zorgva", "kwimple", "brexxi"]), words(int(rng.integers(1e6)), 1)[:2]
                text.insert(int(rng.integers(len(text))), str(stem) + ending)
        docs.append((i, " ".join(text)))
        labels.append((i, 1, int(toxic), None, None))
    return docs_of(docs), labels_of(labels)


def test_held_out_quality(corpus):
    docs, labels = corpus
    truth = {r.doc_id: r.toxic for r in labels.collect()}
    rows = [r for r in t.toxicity(docs, labels).collect() if r.held_out]
    assert len(rows) > 60
    hot = [r.score for r in rows if truth[r.doc_id]]
    cold = [r.score for r in rows if not truth[r.doc_id]]
    assert np.mean([a > b for a in hot for b in cold]) > 0.95
    right = sum(r.predicted == truth[r.doc_id] for r in rows)
    assert right / len(rows) > 0.9


def test_whole_table(spark, sf_dir):
    truth = {r.doc_id: r.toxic for r in read_input(spark, sf_dir, "labels").collect()}
    rows = QUERIES["op4_toxicity"](spark, sf_dir).collect()
    assert len(rows) == read_input(spark, sf_dir, "documents").count()
    for r in rows:
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2)
        assert 0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3)
    judged = [r for r in rows if r.doc_id in truth]
    assert sum(r.predicted == truth[r.doc_id] for r in judged) / len(judged) > 0.85


def test_held_out_labels_are_not_learned(corpus, labels_of):
    docs, labels = corpus
    flipped = labels_of(
        [
            (r.doc_id, 1, 1 - r.toxic if zlib.crc32(str(r.doc_id).encode()) % 4 == 2 else r.toxic, None, None)
            for r in labels.collect()
        ]
    )
    one = sorted(t.toxicity(docs, labels).collect())
    assert one == sorted(t.toxicity(docs, flipped).collect())


def test_edges(edge, none, corpus, labels_of):
    _, labels = corpus
    rows = t.toxicity(edge, labels).collect()
    assert len(rows) == len(edge_rows()) and all(0 <= r.score <= 1 for r in rows)
    empty = {r.score for r in rows if r.doc_id in (1, 2, 3)}
    assert len(empty) == 1 and not next(r.held_out for r in rows if r.doc_id is None)
    assert t.toxicity(none, labels).count() == 0
    no_labels = t.toxicity(edge, labels_of([])).collect()
    assert {r.score for r in no_labels} == {0.0}
    odd = labels_of([(None, 1, 1, "x", "y"), (4, 1, None, "x", "y"), (7, 1, 1, "x", "y"), (7, 1, 0, "x", "y"), (8, 0, 1, "", "")])
    assert len(t.toxicity(edge, odd).collect()) == len(edge_rows())


def test_filter_keeps_columns_and_clean_rows(edge, none, corpus):
    docs, labels = corpus
    kept = t.drop_toxic(docs, labels)
    assert kept.columns == docs.columns
    scored = {r.doc_id for r in t.toxicity(docs, labels).collect() if not r.predicted}
    assert {r.doc_id for r in kept.collect()} == scored
    assert t.drop_toxic(none, labels).count() == 0
    assert t.drop_toxic(edge, labels).count() <= edge.count()


def plain_kneser_ney(counts, gram, discount=0.75):
    """Class probability of a gram by the textbook recursion, over dictionaries of byte strings."""

    def shared(level, g):
        if len(g) == 0:
            return 1 / 256
        tails = {}
        for h in level:
            if len(h) > 1:
                tails.setdefault(h[1:], set()).add(h)
        ctx = g[:-1]
        same = {h: len(v) for h, v in tails.items() if h[:-1] == ctx and len(h) == len(g)}
        total = sum(same.values())
        lower = shared(set(tails), g[1:])
        return (max(same[g] - discount, 0) + discount * len(same) * lower) / total

    both = set(counts[0]) | set(counts[1])
    out = []
    for own in counts:
        same = {h: c for h, c in own.items() if h[:-1] == gram[:-1]}
        total, lower = sum(same.values()), shared(both, gram[1:])
        out.append(
            (max(same.get(gram, 0) - discount, 0) + discount * len(same) * lower) / total if total else lower
        )
    return np.log(out[0]) - np.log(out[1])


def test_ratios_match_the_textbook():
    tox, plain = [b"zorg zorgva banana", b"zorg an"], [b"banana band ban", b"an andana"]
    counts = []
    for texts in (tox, plain):
        seen = {}
        for text in texts:
            for w in text.split():
                w = b" " + w + b" "
                for i in range(1, len(w)):
                    g = w[max(0, i - t.CONTEXT_BYTES) : i + 1]
                    seen[g] = seen.get(g, 0) + 1
        counts.append(seen)
    pack = lambda g: int.from_bytes(g, "big")
    grams = sorted(set(counts[0]) | set(counts[1]), key=pack)
    found = np.concatenate([x[2] for x in t.events(tox + plain)])
    assert set(found.tolist()) == {pack(g) for g in grams}
    keys, ratios = t.log_ratios(
        np.array([pack(g) for g in grams], np.uint64), *(np.array([c.get(g, 0) for g in grams], float) for c in counts)
    )
    by_key = dict(zip(keys.tolist(), ratios))
    for g in grams:
        assert by_key[pack(g)] == pytest.approx(plain_kneser_ney(counts, g)), g


def test_table_holds_every_event():
    rng = np.random.default_rng(1)
    keys = np.unique(rng.integers(1, 1 << 60, 50_000).astype(np.uint64))
    ratios = rng.normal(size=len(keys))
    table = t.build_table(keys, ratios)
    assert len(table.keys) <= 4 * len(keys)
    assert np.allclose(t.look_up(table, keys), ratios.astype(np.float32))
    others = np.setdiff1d(rng.integers(1, 1 << 60, 50_000).astype(np.uint64), keys)
    assert np.isnan(t.look_up(table, others)).all()
    assert np.isnan(t.look_up(t.build_table(keys[:0], ratios[:0]), keys[:9])).all()


def test_shorter_contexts_hold_all_events(corpus, spark):
    docs, labels = corpus
    whole = t.fit(docs, labels)
    short = t.fit(docs, labels, most_events=(whole.table.keys != 0).sum() // 2)
    assert whole.table.context == t.CONTEXT_BYTES > short.table.context > 0
    assert (short.table.keys != 0).sum() <= (whole.table.keys != 0).sum() // 2
    text = b"zorgvaab some words"
    grams = next(t.events([text], short.table.context))[2]
    assert grams.max() < 1 << (8 * (short.table.context + 1))
    score = dict(zip("ab", t.scores([text, b"some words"], short)))
    assert score["a"] > score["b"]


def test_long_labelled_texts_teach(docs_of, labels_of):
    filler = words(1, 9000)
    learned = [i for i in range(200) if zlib.crc32(str(i).encode()) % 4 != 2][:80]
    docs = [(i, f"{filler} zorgva {filler}" if k % 2 else words(i, 30)) for k, i in enumerate(learned)]
    labels = labels_of([(i, 1, k % 2, None, None) for k, i in enumerate(learned)])
    rows = {r.doc_id: r.score for r in t.toxicity(docs_of([*docs, (900, "zorgva"), (901, "plain")]), labels).collect()}
    assert rows[900] > rows[901]


def test_contexts_do_not_depend_on_the_number_of_events(docs_of, labels_of):
    """More than two million events, at which all contexts were once shortened."""
    learned = [i for i in range(400) if zlib.crc32(str(i).encode()) % 4 != 2][:140]
    letters = np.random.default_rng(3).integers(97, 123, (140, 2800, 8)).astype(np.uint8)
    docs = [(i, " ".join(bytes(w).decode() for w in letters[k])) for k, i in enumerate(learned)]
    model = t.fit(docs_of(docs), labels_of([(i, 1, k % 2, None, None) for k, i in enumerate(learned)]))
    assert (model.table.keys != 0).sum() > 1 << 21 and model.table.context == t.CONTEXT_BYTES
