import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest

from spendlake.llm import phrases
from spendlake.llm.phrases import build_trie, collocations, walk
from tests.llm.conftest import edge_rows

LOWER = {c: c + 32 for c in range(65, 91)}


def plain(rows, min_count, limit=2000, percent=100):
    counts, n = defaultdict(Counter), Counter()
    for _, text, lang in rows:
        lang = "und" if lang is None else lang
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", (text or "").translate(LOWER)):
            own = re.findall(r"[^\x20\x09]+", piece)
            n[lang] += len(own)
            for size in range(1, 6):
                counts[lang].update(tuple(own[i : i + size]) for i in range(len(own) - size + 1))
    out = []
    for lang, f in counts.items():
        often = {p: c for p, c in f.items() if c >= min_count}
        scored = []
        for p, a in often.items():
            if len(p) == 1:
                continue
            longer = (q for q in often if len(q) > len(p) and any(q[i : i + len(p)] == p for i in range(len(q))))
            if any(100 * often[q] >= percent * a for q in longer):
                continue
            score, _, l, r = min((1000 * a * n[lang] // (f[p[:k]] * f[p[k:]]), k, f[p[:k]], f[p[k:]]) for k in range(1, len(p)))
            scored.append((-score, -a, " ".join(p).encode(), l, r))
        for rank, (score, a, phrase, l, r) in enumerate(sorted(scored)[:limit], 1):
            out.append((lang, rank, phrase.decode(), -a, l, r, n[lang], -score))
    return sorted(out)


def got(df):
    return sorted(tuple(r) for r in df.collect())


def chatter(seed, texts, vocabulary=12):
    rng = random.Random(seed)
    common = [f"w{i}" for i in range(vocabulary)]
    rows = []
    for i in range(texts):
        own = [rng.choice(common) if rng.random() < 0.8 else f"Rare{rng.random()}" for _ in range(rng.randint(0, 60))]
        for _ in range(3):
            own.insert(rng.randint(0, len(own)), "New York city, hall")
        rows.append((i, rng.choice([" ", "\t", ". "]).join(own), rng.choice(["en", "de", None, "und"])))
    return rows


def test_against_plain_counting(docs_of):
    rows = chatter(1, 300) + [(None, None, "en"), (1, "", None), (1, " \t\n. ,", "fr")]
    assert len(plain(rows, 20)) > 30
    assert got(collocations(docs_of(rows), min_count=20)) == plain(rows, 20)


@pytest.mark.parametrize("sizes", [{"trie_phrases": 9}, {"trie_phrases": 40, "shard_words": 1}])
def test_many_tries_and_small_shards(docs_of, sizes):
    rows = chatter(2, 120, vocabulary=6)
    assert got(collocations(docs_of(rows).repartition(5), min_count=15, **sizes)) == plain(rows, 15)


def test_limit_ties_and_part_of_a_longer_one(docs_of):
    rows = [(i, "a b c d e f g. x y! y z? É é Æ", "en") for i in range(9)]
    assert got(collocations(docs_of(rows), min_count=9, limit=2)) == plain(rows, 9, limit=2)
    rows += [(1, "a b", "en")] * 3
    assert got(collocations(docs_of(rows), min_count=9, percent=70)) == plain(rows, 9, percent=70)


def test_edge_rows(edge, none):
    rows = [(r[0], r[1], r[2] if len(r) > 2 else "en") for r in edge_rows()]
    assert got(collocations(edge, min_count=2)) == plain(rows, 2)
    assert collocations(none).count() == 0
    assert collocations(edge).count() == 0  # nothing is frequent


def test_colliding_words_are_encoded_anew(docs_of):
    asked = []

    def narrow(lang, word, seed):
        asked.append(seed)
        return phrases.hash_word(lang, word, seed) % (97 if seed == 0 else 1 << 63)

    rows = chatter(3, 60)
    assert got(collocations(docs_of(rows), min_count=8, word_hash=narrow)) == plain(rows, 8)


def test_a_phrase_spread_over_all_shards_is_found(docs_of):
    rows = [(i, "rare pair", "en") for i in range(40)] + [(i, "other words here " * 30, "en") for i in range(200)]
    found = collocations(docs_of(rows).repartition(40), min_count=40, shard_words=100)
    assert "rare pair" in {r.phrase for r in found.collect()}


def test_trie_walks_like_a_set():
    rng = np.random.default_rng(0)
    paths = np.unique(rng.integers(0, 40, (700, 3)).astype(np.uint64) * np.uint64(1 << 58), axis=0)
    trie = build_trie(paths, np.arange(len(paths)) + 1000)
    words = rng.integers(-1, len(trie.known), 5000)
    position, state = walk(trie, words)
    known = {tuple(np.searchsorted(trie.known, p).tolist()): i for i, p in enumerate(paths)}
    expected = {i: known[t] for i in range(4998) if (t := tuple(words[i : i + 3].tolist())) in known}
    assert dict(zip(position.tolist(), trie.accept[state].tolist())) == expected and expected


def test_scores_beyond_64_bits(spark):
    big = 10**13
    f = spark.createDataFrame([("en", "a", 1, big), ("en", "b", 1, big + 1), ("en", "a b", 2, big - 1)], "lang string, phrase string, n_parts int, f long")
    totals = spark.createDataFrame([("en", 10**15 + 7)], "lang string, n long")
    row = phrases.score_phrases(f, totals).first()
    assert row.score == 1000 * (big - 1) * (10**15 + 7) // (big * (big + 1))
