import math
import zlib
from collections import Counter

import numpy as np
import pytest

from spendlake.llm import bloom_lm as b
from spendlake.llm.catalog import QUERIES
from spendlake.llm.common import read_input
from tests.llm.conftest import edge_rows

LOW = str.maketrans({chr(65 + i): chr(97 + i) for i in range(26)})


def plain(rows):
    """Token counts and base scores by plain counting."""
    token = lambda t: (t or "").translate(LOW).encode().split() + [None]
    held = lambda i: i is not None and zlib.crc32(str(i).encode()) % 5 == 1
    counts = Counter(x for i, t in rows if not held(i) for x in token(t))
    n, v = sum(counts.values()), len(counts)
    out = []
    for i, t in rows:
        w = token(t)
        base = sum(math.log10((counts[x] + 0.5) / (n + 0.5 * (v + 1))) for x in w)
        out.append((i, held(i), len(w), sum(x in counts for x in w), n, base))
    return out


def check(found, rows):
    key = lambda x: (x[0] is None, x[0] or 0, x[2], x[5])
    got = sorted([(r.doc_id, r.held_out, r.n_tokens, r.n_known, r.train_tokens, r.base_score) for r in found], key=key)
    want = sorted(plain(rows), key=key)
    assert [x[:5] for x in got] == [x[:5] for x in want]
    assert [x[5] for x in got] == pytest.approx([x[5] for x in want])
    assert all(r.score <= 0 and math.isfinite(r.score) for r in found)


def test_whole_table(spark, sf_dir):
    rows = [(r.doc_id, r.text) for r in read_input(spark, sf_dir, "documents").collect()]
    found = QUERIES["op9_language_model"](spark, sf_dir).collect()
    check(found, rows)
    held = [r for r in found if r.held_out]
    assert sum(r.score for r in held) > sum(r.base_score for r in held)  # pairs help on unseen texts


def test_edges(edge, none):
    check(b.language_scores(edge).collect(), edge_rows())
    assert b.language_scores(none).count() == 0


def test_nothing_to_learn_from(docs_of):
    held = [i for i in range(100) if zlib.crc32(str(i).encode()) % 5 == 1][:3]
    check(b.language_scores(docs_of([(i, "some words") for i in held])).collect(), [(i, "some words") for i in held])


def test_rare_words_come_by_the_join(docs_of, monkeypatch):
    monkeypatch.setattr(b, "FREQUENT_WORDS", 3)
    rows = [(i, " ".join(f"w{k}" for k in range(i % 17)) + " the the of") for i in range(60)]
    check(b.language_scores(docs_of(rows)).collect(), rows)


def grams(n, seed=1):
    return np.unique(np.random.default_rng(seed).integers(0, 1 << 64, n, dtype=np.uint64))


def model_of(words, word_counts, pairs, pair_counts, bits):
    packed, kept = b.build_segment(words, word_counts, pairs, pair_counts, bits)
    empty = np.zeros(0, np.uint64)
    sizes = np.array([8 * len(packed)], np.uint64)
    return b.Model(np.concatenate([np.zeros(8, np.uint8), packed]), np.array([8]), sizes, 1, 1, 1, 0.0, empty, empty), kept


def test_filter_never_forgets_and_rarely_invents():
    words, pairs = grams(3000), grams(20_000, 2)
    counts = np.random.default_rng(3).zipf(1.5, len(words)).clip(1, 10**7)
    pair_counts = np.random.default_rng(4).zipf(2.0, len(pairs)).clip(1, 10**6)
    model, kept = model_of(words, counts, pairs, pair_counts, 1 << 22)
    assert kept == pair_counts.sum()
    for g, c, steps in ((words, counts, b.WORD_STEPS), (pairs, pair_counts, b.PAIR_STEPS)):
        level, found = b.levels(c, steps), b.look_up(g, model, 0)
        assert (found >= level).all()
        assert (found > level).mean() < 0.1
    assert (b.look_up(grams(50_000, 9), model, 0) > 0).mean() < 0.06


def test_full_filter_leaves_out_the_rarest_pairs_together():
    words, pairs = grams(10), grams(5000, 2)
    counts = np.where(np.arange(len(pairs)) < 500, 9, 1)
    model, kept = model_of(words, np.ones(len(words), np.int64), pairs, counts, 1 << 14)
    assert kept == 500 * 9
    assert (b.look_up(pairs[:500], model, 0) >= 4).all()
    assert (b.look_up(pairs[500:], model, 0) > 0).mean() < 0.25


def test_levels():
    assert b.levels(np.array([1, 2, 3, 4, 7, 8]), 1).tolist() == [1, 2, 2, 3, 3, 4]
    assert b.level_counts(1)[:5].tolist() == [0, 1, 2.5, 5.5, 11.5]
    every = np.arange(1, 2000)
    assert (np.abs(b.level_counts(4)[b.levels(every, 4)] / every - 1) < 0.2).all()


def test_tokens():
    groups = list(b.token_groups([b"A b", b"", b"a"]))
    (first, counts, tokens, before), = groups
    assert (first, counts.tolist()) == (0, [3, 1, 2])
    assert tokens[0] == tokens[4] and tokens[2] == tokens[3] == tokens[5] == b.END
    assert before.tolist() == [b.START, tokens[0], tokens[1], b.START, b.START, tokens[4]]


def test_nothing_is_left_out_beyond_the_room_of_a_fixed_segment():
    words, pairs = grams(1_000_000, 5), grams(9_000_000, 6)  # 10 million levels: the former 2**26 bits had room for 9.3
    bits, kept = b.build_segment(words, np.ones(len(words), np.int64), pairs, np.ones(len(pairs), np.int64))
    assert kept == len(pairs)
    at = np.array([0]), np.array([8 * len(bits)], np.uint64)
    model = b.Model(bits, *at, 1, 1, 1, 0.0, words[:0], words[:0])
    assert (b.look_up(pairs[::50], model, 0) >= 1).all()
    assert (b.look_up(grams(100_000, 9), model, 0) > 0).mean() < 0.06


def test_parts_and_chunks_leave_scores_alone(docs_of, monkeypatch):
    rng = np.random.default_rng(7)
    rows = [(i, " ".join(f"w{k}" for k in rng.zipf(1.3, 200).clip(1, 500))) for i in range(150)]
    one = {r.doc_id: r for r in b.language_scores(docs_of(rows)).collect()}
    assert len(one) == len(rows)
    counts, pairs = Counter(), Counter()
    texts = [t.split() + [None] for i, t in rows if zlib.crc32(str(i).encode()) % 5 != 1]
    for w in texts:
        counts.update(w)
        pairs.update(zip(["<s>", *w], w))
    total = sum(counts.values()) + 0.5 * (len(counts) + 1)
    word, pair = b.level_counts(b.WORD_STEPS), b.level_counts(b.PAIR_STEPS)
    level = lambda c, steps, of: of[b.levels(np.array([c]), steps)[0]] if c else 0.0

    def wanted(text):
        w, out = text.split() + [None], 0.0
        for first, second in zip(["<s>", *w], w):
            context = len(texts) if first == "<s>" else level(counts[first], b.WORD_STEPS, word)
            weight = b.PAIR_WEIGHT * context / (context + b.PAIR_PRIOR)
            joint = min(level(pairs[first, second], b.PAIR_STEPS, pair), context)
            single = (level(counts[second], b.WORD_STEPS, word) + 0.5) / total
            out += math.log10(min(1.0, weight * joint / max(context, 1) + (1 - weight) * single))
        return out

    want = np.array([wanted(t) for _, t in rows])
    assert np.abs(np.array([one[i].score for i, _ in rows]) / want - 1).max() < 0.05  # false levels only
    monkeypatch.setattr(b, "PART_BYTES", 1 << 12)
    monkeypatch.setattr(b, "CHUNK_TOKENS", 1000)
    many = {r.doc_id: r for r in b.language_scores(docs_of(rows)).collect()}
    assert np.abs(np.array([many[i].score for i, _ in rows]) / want - 1).max() < 0.05
    assert [many[i].base_score for i in one] == pytest.approx([one[i].base_score for i in one])
