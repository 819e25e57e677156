"""Phrase collocations per language, counted by double-array tries.

Texts are encoded once as chunks: a dictionary of the chunk's words and their codes in order, with a
break between pieces. Then, for phrases of two words and more, two passes over the chunks a length:

* **Candidates.** A phrase can be frequent only if the phrase without its last word and the one
  without its first are. Positions where the trie of frequent shorter phrases accepts are extended by
  the next word. A shard (chunks that one task holds together) reports how often it holds each, up to
  ``min_count`` and no further: sums of these tell whether ``min_count`` is reached, so that no frequent
  phrase is missed, and nothing else becomes a candidate.
* **Counts.** The candidates go into a double-array trie, which is broadcast. Numpy moves the states
  of all positions of a chunk one word on at a time, drops those that fail, and counts accepting
  states. The counts of the shards are summed.

A trie holds some :data:`TRIE_PHRASES` phrases; more candidates go into more tries, chosen by hash, one
broadcast and one pass after the other. Words are compared by 64-bit hashes that are checked to differ
for all distinct words of the corpus; where two meet, everything is encoded anew with another seed.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import partial, reduce
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from spendlake.llm.common import map_arrow, materialize, text_rows, with_row_id

#: Phrases of one broadcast trie: some 60 MB with five words each.
TRIE_PHRASES = 1 << 19
#: Places tried for a state's children before they go behind all others.
PLACED = 16
#: Words that a task holds at once when it looks for candidates.
SHARD_WORDS = 1 << 20
#: Tasks for each core that look for candidates: what a task sums up beforehand stays in memory.
GATHERING = 4
#: Parts of a language in the first of two rounds of its ranking.
RANK_PARTS = 64
NO_LANGUAGE = "und"

_SPACE, _BREAK = 0x20, 0x0A


def _byte_table() -> bytes:
    table = bytearray(range(256))
    for c in range(ord("A"), ord("Z") + 1):
        table[c] = c + 32
    for c in b".,;:!?\n\x0b\x0c\r":
        table[c] = _BREAK
    table[ord("\t")] = _SPACE
    return bytes(table)


_TABLE = _byte_table()

_CHUNK_SCHEMA = "n_words long, codes binary, words array<string>, hashes array<long>, counts array<long>, lang string"


def hash_word(lang: bytes, word: bytes, seed: int) -> int:
    """64 bits of a word of a language; both in one, so that languages share tries."""
    return xxhash.xxh64_intdigest(lang + b"\n" + word, seed)


# -- encoding ----------------------------------------------------------------------------------


def coded_words(texts: list[bytes]) -> tuple[np.ndarray, pa.Array, int]:
    """Codes of all words in order with -1 between pieces, the distinct words, the number of words."""
    mapped = np.frombuffer(b"\n".join(texts).translate(_TABLE), np.uint8)
    inside = np.zeros(len(mapped) + 2, np.int8)
    inside[1:-1] = (mapped != _SPACE) & (mapped != _BREAK)
    change = np.diff(inside)
    starts, ends = np.flatnonzero(change == 1), np.flatnonzero(change == -1)
    del change
    offsets = np.zeros(len(starts) + 1, np.int64)
    np.cumsum(ends - starts, out=offsets[1:])
    del ends
    data = mapped[inside[1:-1].view(bool)]
    del inside
    words = pa.Array.from_buffers(
        pa.large_binary(), len(starts), [None, pa.py_buffer(offsets), pa.py_buffer(data)]
    ).dictionary_encode()
    codes = words.indices.to_numpy().astype(np.int32)
    piece = np.searchsorted(np.flatnonzero(mapped == _BREAK), starts)
    cuts = np.flatnonzero(np.diff(piece)) + 1
    return np.insert(codes, cuts, -1), words.dictionary, len(starts)


def _one_list(values: pa.Array) -> pa.ListArray:
    return pa.ListArray.from_arrays(pa.array([0, len(values)], pa.int32()), values)


def _encode(batches, seed: int, word_hash) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        of: dict[bytes, list[bytes]] = {}
        for lang, text in zip(text_rows(batch, "lang"), text_rows(batch)):
            of.setdefault(lang, []).append(text)
        for lang, texts in of.items():
            codes, words, n_words = coded_words(texts)
            if not n_words:
                continue
            hashes = np.fromiter((word_hash(lang, w, seed) for w in words.to_pylist()), np.uint64, len(words))
            counts = np.bincount(codes[codes >= 0], minlength=len(words))
            yield pa.RecordBatch.from_pydict(
                {
                    "n_words": pa.array([n_words]),
                    "codes": pa.array([codes.tobytes()], pa.binary()),
                    "words": _one_list(words.cast(pa.binary()).cast(pa.string())),
                    "hashes": _one_list(pa.array(hashes.view(np.int64))),
                    "counts": _one_list(pa.array(counts)),
                    "lang": pa.array([lang.decode()]),
                }
            )


def encode(docs: DataFrame, seed: int = 0, word_hash=hash_word) -> DataFrame:
    """Chunks of one language each, from ``text`` and ``lang``."""
    rows = docs.select(F.coalesce("lang", F.lit(NO_LANGUAGE)).alias("lang"), "text")
    return map_arrow(rows, partial(_encode, seed=seed, word_hash=word_hash), _CHUNK_SCHEMA)


def count_words(chunks: DataFrame) -> DataFrame:
    """``lang, phrase, token, f`` of every distinct word."""
    entries = chunks.select("lang", F.explode(F.arrays_zip("words", "hashes", "counts")).alias("e"))
    return (
        entries.groupBy("lang", F.col("e.words").alias("phrase"), F.col("e.hashes").alias("token"))
        .agg(F.sum("e.counts").alias("f"))
    )


def _encoded(docs: DataFrame, word_hash) -> tuple[DataFrame, DataFrame]:
    """Chunks and counted words, under a seed for which no two words share a hash."""
    seed = 0
    while True:
        chunks = materialize(encode(docs, seed, word_hash))
        words = materialize(count_words(chunks))
        if words.groupBy("token").count().filter("count > 1").isEmpty():
            return chunks, words
        seed += 1


# -- tries -------------------------------------------------------------------------------------


class Trie(NamedTuple):
    """A double-array trie: the child of state ``s`` by digit ``d`` is ``base[s] + d`` if ``check`` there is ``s``.

    A word is its place among the ``known`` hashes, written in ``digits`` digits of base 256: children
    then lie close together, whatever the number of words.
    """

    known: np.ndarray
    digits: int
    base: np.ndarray
    check: np.ndarray
    accept: np.ndarray  # index of the phrase that ends in a state, or -1
    numbers: np.ndarray  # of the phrases
    depth: int


class _Slots:
    """Free places of a growing double array. Place 0 is the root's."""

    def __init__(self, room: int):
        self.used = np.zeros(room, bool)
        self.used[0] = True
        self.size = 1
        self.random = np.random.default_rng(0)

    def _grow(self, by: int) -> None:
        self.size += by
        if self.size > len(self.used):
            more = max(self.size - len(self.used), len(self.used))
            self.used = np.concatenate((self.used, np.zeros(more, bool)))

    def place(self, digits: np.ndarray) -> int:
        """A base under which all ``digits`` (sorted) fall on free places, behind all others if need be."""
        first, last = int(digits[0]), int(digits[-1])
        if last - first + 1 < self.size:
            for base in self.random.integers(1 - first, self.size - last, PLACED).tolist():
                if not self.used[base + digits].any():
                    self.used[base + digits] = True
                    return base
        base = self.size - first
        self._grow(last - first + 1)
        self.used[base + digits] = True
        return base

    def place_singles(self, digits: np.ndarray) -> np.ndarray:
        """A base for each of the digits, one free place apiece."""
        free = np.flatnonzero(~self.used[: self.size])[: len(digits)]
        lacking = len(digits) - len(free)
        if lacking:
            free = np.append(free, np.arange(self.size, self.size + lacking))
            self._grow(lacking)
        self.used[free] = True
        return free - digits


def _in_digits(words: np.ndarray, digits: int) -> np.ndarray:
    """Each word's digits of base 256, the highest first, as further columns."""
    return np.stack([(words >> (8 * d)) & 255 for d in reversed(range(digits))], axis=-1).reshape(len(words), -1)


def build_trie(paths: np.ndarray, numbers: np.ndarray) -> Trie:
    """The trie of phrases that are given as rows of word hashes."""
    n, depth = paths.shape
    known, words = np.unique(paths, return_inverse=True)
    digits = max(1, -(-int(len(known) - 1).bit_length() // 8))
    steps = _in_digits(words.reshape(n, depth), digits)
    slots = _Slots(max(2 * n, 16))
    node = np.zeros(n, np.int64)  # state that each phrase has reached
    edges = []
    for level in range(depth * digits):
        key, which = np.unique(node << 8 | steps[:, level], return_inverse=True)
        parent, digit = key >> 8, key & 255
        starts = np.flatnonzero(np.concatenate(([True], np.diff(parent) != 0)))
        sizes = np.diff(np.append(starts, len(parent)))
        base = np.zeros(len(starts), np.int64)
        for i in np.argsort(-sizes, kind="stable")[: int((sizes > 1).sum())].tolist():
            base[i] = slots.place(digit[starts[i] : starts[i] + sizes[i]])
        single = sizes == 1
        base[single] = slots.place_singles(digit[starts[single]])
        at = np.repeat(base, sizes) + digit
        edges.append((parent[starts], base, at, parent))
        node = at[which.ravel()]
    bases, checks = np.zeros(slots.size, np.int32), np.full(slots.size, -1, np.int32)
    for parents, base, at, parent in edges:
        bases[parents] = base
        checks[at] = parent
    accept = np.full(slots.size, -1, np.int32)
    accept[node] = np.arange(n)
    return Trie(known, digits, bases, checks, accept, numbers, depth)


def word_numbers(trie: Trie, hashes: np.ndarray) -> np.ndarray:
    """The trie's number of each hash, -1 where it has none, and -1 once more for breaks (code -1)."""
    at = np.minimum(np.searchsorted(trie.known, hashes), len(trie.known) - 1)
    return np.append(np.where(trie.known[at] == hashes, at, -1), -1).astype(np.int32)


def walk(trie: Trie, words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Positions where a phrase of the trie begins, and the states in which they end."""
    words = np.concatenate((words, np.full(trie.depth, -1, words.dtype)))
    position = np.flatnonzero(words >= 0).astype(np.int32)
    state = np.zeros(len(position), np.int32)
    for level in range(trie.depth):
        word = words[position + level]
        inside = word >= 0
        position, state, word = position[inside], state[inside], word[inside]
        for digit in reversed(range(trie.digits)):
            ahead = trie.base[state] + ((word >> (8 * digit)) & 255)
            ok = (ahead >= 0) & (ahead < len(trie.check))
            ok &= trie.check[np.where(ok, ahead, 0)] == state
            position, state, word = position[ok], ahead[ok], word[ok]
    return position, state


def _tries(phrases: DataFrame, size: int) -> Iterator[tuple[Trie, bool]]:
    """The tries of all phrases, one after the other, and whether there is only one."""
    n = phrases.count()
    parts = math.ceil(n / size)
    for part in range(parts):
        own = phrases.filter(F.pmod(F.xxhash64("path"), F.lit(parts)) == part) if parts > 1 else phrases
        rows = own.select("number", "path").toArrow()
        if not rows.num_rows:
            continue
        paths = rows["path"].combine_chunks().flatten().to_numpy(zero_copy_only=False)
        yield build_trie(paths.reshape(rows.num_rows, -1).view(np.uint64), rows["number"].to_numpy()), parts == 1


# -- passes over the chunks ----------------------------------------------------------------------


def _chunks(batch: pa.RecordBatch) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    hashes = batch.column("hashes")
    for i, (n_words, codes) in enumerate(zip(batch.column("n_words").to_pylist(), batch.column("codes"))):
        own = hashes[i].values.to_numpy(zero_copy_only=False).view(np.uint64)
        yield n_words, np.frombuffer(codes.as_buffer(), np.int32), own


def _extensions(shard, trie: Trie, whole: bool, enough: int) -> pa.RecordBatch:
    """``(number of a phrase, hash of the word after it)`` with its count in the shard, ``enough`` at most."""
    alphabet = np.unique(np.concatenate([hashes for _, _, hashes in shard]))
    found = []
    for _, codes, hashes in shard:
        position, state = walk(trie, word_numbers(trie, hashes)[codes])
        after = np.append(codes, -1)[position + trie.depth]
        ok = after >= 0
        if whole:  # then the phrase without its first word must be accepted too
            begins = np.zeros(len(codes) + 1, bool)
            begins[position] = True
            ok &= begins[position + 1]
        place = np.searchsorted(alphabet, hashes)
        found.append(trie.accept[state[ok]].astype(np.int64) * len(alphabet) + place[after[ok]])
    keys, counts = np.unique(np.concatenate(found), return_counts=True)
    phrase, word = np.divmod(keys, len(alphabet))
    return pa.RecordBatch.from_pydict(
        {
            "number": pa.array(trie.numbers[phrase]),
            "token": pa.array(alphabet[word].view(np.int64)),
            "found": pa.array(np.minimum(counts, enough), pa.int64()),
        }
    )


def _gather(batches, shared, whole: bool, enough: int, shard_words: int) -> Iterator[pa.RecordBatch]:
    trie, shard, size = shared.value, [], 0
    for batch in batches:
        for chunk in _chunks(batch):
            if shard and size + chunk[0] > shard_words:
                yield _extensions(shard, trie, whole, enough)
                shard, size = [], 0
            shard.append(chunk)
            size += chunk[0]
    if shard:
        yield _extensions(shard, trie, whole, enough)


def _count(batches, shared) -> Iterator[pa.RecordBatch]:
    trie = shared.value
    counts = np.zeros(len(trie.check), np.int64)
    for batch in batches:
        for _, codes, hashes in _chunks(batch):
            _, state = walk(trie, word_numbers(trie, hashes)[codes])
            counts += np.bincount(state, minlength=len(counts))
    ended = np.flatnonzero(counts)
    yield pa.RecordBatch.from_pydict(
        {"number": pa.array(trie.numbers[trie.accept[ended]]), "f": pa.array(counts[ended])}
    )


def _each_trie(
    chunks: DataFrame, phrases: DataFrame, size: int, function, schema: str, measure: str, least: int, tasks: int = 1
) -> DataFrame | None:
    """Rows of ``function(trie, whole)`` over all chunks with ``measure`` summed, for every trie of the phrases.

    Sums below ``least`` are left out. None without phrases. A task's output hardly grows with what it reads,
    so there are ``tasks`` for each core and not one for each input split.
    """
    context, parts = chunks.sparkSession.sparkContext, []
    columns = chunks.select("n_words", "codes", "hashes").coalesce(tasks * context.defaultParallelism)
    for trie, whole in _tries(phrases, size):
        shared = context.broadcast(trie)
        rows = map_arrow(columns, function(shared, whole), f"{schema}, {measure} long")
        keys = [c for c in rows.columns if c != measure]
        sums = rows.groupBy(*keys).agg(F.sum(measure).alias(measure)).filter(F.col(measure) >= least)
        parts.append(materialize(sums))
        shared.destroy()
    return reduce(DataFrame.unionByName, parts) if parts else None


def frequent_phrases(
    docs: DataFrame,
    min_count: int = 100,
    max_words: int = 5,
    trie_phrases: int = TRIE_PHRASES,
    shard_words: int = SHARD_WORDS,
    word_hash=hash_word,
) -> tuple[DataFrame, DataFrame]:
    """All phrases of up to ``max_words`` words found ``min_count`` times or more, and all counted words.

    Phrases as ``lang, phrase, n_parts, f``; words as ``lang, phrase, f``, whatever their count.
    """
    chunks, words = _encoded(docs, word_hash)
    common = words.filter(F.col("f") >= min_count)
    level = materialize(with_row_id(common.withColumn("path", F.array("token")), "number"))
    levels = [level.withColumn("n_parts", F.lit(1))]
    letters = level.select(F.col("phrase").alias("word"), "token")
    gather = partial(_gather, enough=min_count, shard_words=shard_words)
    for length in range(2, max_words + 1):
        seen = _each_trie(
            chunks, level, trie_phrases, lambda trie, whole: partial(gather, shared=trie, whole=whole),
            "number long, token long", "found", min_count, GATHERING,
        )
        if seen is None:
            break
        candidates = (
            seen.join(letters, "token").join(level.select("number", "lang", "phrase", "path"), "number")
            .select(
                "lang", F.concat_ws(" ", "phrase", "word").alias("phrase"),
                F.concat("path", F.array("token")).alias("path"),
            )
        )
        candidates = materialize(with_row_id(candidates, "number"))
        counts = _each_trie(
            chunks, candidates, trie_phrases, lambda trie, _: partial(_count, shared=trie), "number long", "f", min_count
        )
        if counts is None:
            break
        level = materialize(candidates.join(counts, "number"))
        levels.append(level.withColumn("n_parts", F.lit(length)))
    columns = ("lang", "phrase", "n_parts", "f")
    return reduce(DataFrame.unionByName, [x.select(*columns) for x in levels]), words.select("lang", "phrase", "f")


# -- scores --------------------------------------------------------------------------------------


def score_phrases(phrases: DataFrame, totals: DataFrame) -> DataFrame:
    """The lowest-scoring cut of each phrase of two words and more: ``a, l, r, n, score``.

    A score is ``floor(1000 * a * n / (l * r))`` in decimals of 38 places: an overflow fails.
    """
    parts = phrases.select("lang", F.col("phrase").alias("part"), F.col("f").alias("part_f"))
    words = F.split("phrase", " ")
    cuts = (
        phrases.filter("n_parts > 1")
        .select("lang", "phrase", F.col("f").alias("a"), words.alias("words"), "n_parts",
                F.explode(F.sequence(F.lit(1), F.col("n_parts") - 1)).alias("k"))
        .select(
            "lang", "phrase", "a", "k",
            F.array_join(F.slice("words", F.lit(1), F.col("k")), " ").alias("first"),
            F.array_join(F.slice("words", F.col("k") + 1, F.col("n_parts") - F.col("k")), " ").alias("rest"),
        )
    )
    cuts = (
        cuts.join(parts.withColumnsRenamed({"part": "first", "part_f": "l"}), ["lang", "first"])
        .join(parts.withColumnsRenamed({"part": "rest", "part_f": "r"}), ["lang", "rest"])
        .join(totals, "lang")
    )

    def exact(column: str):
        return F.col(column).cast("decimal(18,0)")

    above = F.lit(1000).cast("decimal(4,0)") * (exact("a").cast("decimal(16,0)") * exact("n"))
    cuts = cuts.withColumn("above", above).withColumn("below", exact("l") * exact("r"))
    cuts = cuts.withColumn("score", F.expr("above div below"))
    lowest = cuts.groupBy("lang", "phrase").agg(F.min(F.struct("score", "k", "a", "l", "r", "n")).alias("c"))
    return lowest.select("lang", "phrase", "c.*").drop("k")


def drop_swallowed(scored: DataFrame, phrases: DataFrame, percent: int = 100) -> DataFrame:
    """Leave out phrases inside a longer one that is found at least ``percent`` in a hundred times as often.

    Phrases one word longer tell: any longer one lies around one of these, which is as frequent.
    """
    words = F.split("phrase", " ")
    size = F.col("n_parts") - 1
    inner = F.array(
        F.array_join(F.slice(words, F.lit(1), size), " "), F.array_join(F.slice(words, F.lit(2), size), " ")
    )
    around = (
        phrases.filter("n_parts > 2").select("lang", F.explode(inner).alias("phrase"), "f")
        .groupBy("lang", "phrase").agg(F.max("f").alias("around"))
    )
    kept = F.col("around").isNull() | (100 * F.col("around") < percent * F.col("a"))
    return scored.join(around, ["lang", "phrase"], "left").filter(kept).drop("around")


def first_of_each_language(scored: DataFrame, limit: int) -> DataFrame:
    """Each language's first ``limit`` phrases with their ``rank``; first among parts of a language, then among their winners."""
    order = (F.desc("score"), F.desc("a"), F.asc("phrase"))
    part = F.pmod(F.xxhash64("phrase"), F.lit(RANK_PARTS))
    ahead = scored.withColumn("rank", F.row_number().over(Window.partitionBy("lang", part).orderBy(*order)))
    ahead = ahead.filter(F.col("rank") <= limit)
    ranked = ahead.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order)))
    return ranked.filter(F.col("rank") <= limit).withColumn("rank", F.col("rank").cast("long"))


def collocations(
    docs: DataFrame, min_count: int = 100, max_words: int = 5, limit: int = 2000, percent: int = 100, **sizes
) -> DataFrame:
    """The strongest phrases of each language of ``docs`` (``text``, ``lang``): ``lang, rank, phrase, a, l, r, n, score``.

    Null and empty texts hold no words; a null language is ``und``. Repeated rows count as often as
    they stand there. Ties are broken by frequency, then by the phrase's bytes. A text of any length
    is read whole. Tables without words, and other columns of any name, are fine: only the two are read.
    """
    phrases, words = frequent_phrases(docs, min_count, max_words, **sizes)
    phrases = materialize(phrases)
    totals = words.groupBy("lang").agg(F.sum("f").alias("n"))
    scored = drop_swallowed(score_phrases(phrases, totals), phrases, percent)
    return first_of_each_language(scored, limit).select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
