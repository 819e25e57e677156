"""Language-model scores from a log-frequency Bloom filter.

Counts of single words and of word pairs are gathered from all training texts by one shuffle of
packed hash arrays. A count is stored by its logarithm: a word or pair of level ``q`` is put into
the filter ``q`` times, under a different name each time, and is looked up by asking for levels
one after the other until a probe misses. The filter is cut into segments by hash, as many as the
text asks for and each as large as its words and pairs ask for, so that none is left out. It is not
broadcast: every chunk of texts sends its distinct words and pairs to their segments, with the
counts that training texts add, and gets levels back, for words the exact counts too.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from spendlake.llm.common import map_arrow, text_rows, with_row_id
from spendlake.llm.wordhash import BLANK_SEPARATED, hashed_words, mix

PROBES = 5
BITS_PER_PROBE = 1 / np.log(2)
#: Bounds nothing any more: the exact counts of all words come from their segments.
FREQUENT_WORDS = 1 << 20
#: Text that one segment stands for.
PART_BYTES = 16 << 20
#: Bits of a pair's hash below its part: of the few million pairs of a part one in 10**5 meets
#: another, far fewer than the filter invents; words keep all bits.
PAIR_BITS = 40
#: Grams looked up at once.
LOOKED_UP = 1 << 18
#: Tokens of a chunk; a longer text is a chunk of its own.
CHUNK_TOKENS = 1 << 20
WORD_STEPS, PAIR_STEPS = 4, 1  # levels per doubling of the count
#: Largest weight of pairs against single words, and the occurrences of a word that give it half.
PAIR_WEIGHT = 0.4
PAIR_PRIOR = 1.0

END = np.uint64(0x5EED5EED5EED5EED)
START = np.uint64(0x0DDBA11F00DCAFE5)
_PAIR = np.uint64(0x9E3779B97F4A7C15)
_LEVEL = np.uint64(0xC2B2AE3D27D4EB4F)


class Model(NamedTuple):
    """Segments of the filter and the counts that were put into them."""

    bits: np.ndarray
    offsets: np.ndarray
    sizes: np.ndarray
    tokens: int
    words: int
    texts: int
    pair_share: float
    known: np.ndarray
    known_counts: np.ndarray


def held_out(doc_id: Column) -> Column:
    """Rows that nothing is learned from. A null id is not held out."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % 5 == 1, F.lit(False))


def token_groups(texts: list[bytes]) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray]]:
    """``(first row, tokens per row, tokens, the token before each)``, an end closing each row."""
    for a, counts, hashes in hashed_words(texts, BLANK_SEPARATED):
        ends = np.cumsum(counts)
        tokens = np.insert(hashes, ends, END)
        before = np.empty_like(tokens)
        before[1:] = tokens[:-1]
        before[np.concatenate(([0], (ends + np.arange(1, len(ends) + 1))[:-1]))] = START
        yield a, counts + 1, tokens, before


def pair_hash(before: np.ndarray, token: np.ndarray) -> np.ndarray:
    return mix(mix(before * _PAIR) + token)


def _part_of(hashes: np.ndarray, part_bits: int) -> np.ndarray:
    return (hashes >> np.uint64(64 - part_bits)).astype(np.int64) if part_bits else np.zeros(len(hashes), np.int64)


def _pairs_of(which: np.ndarray, lengths: np.ndarray, kinds: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct pairs as indices ``(before, token)`` and each token's pair; ``kinds`` stands for the start."""
    before = np.empty_like(which)
    before[1:] = which[:-1]
    before[np.cumsum(lengths) - lengths] = kinds
    keys, pair = np.unique(before * (kinds + 1) + which, return_inverse=True)
    return keys // (kinds + 1), keys % (kinds + 1), pair


def _by_part(kinds: np.ndarray, first: np.ndarray, second: np.ndarray, part_bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Part and hash of pairs of indices in ``PAIR_BITS + part_bits`` bits, and their order."""
    hashes = pair_hash(np.append(kinds, START)[first], kinds[second]) >> np.uint64(64 - PAIR_BITS - part_bits)
    return hashes, np.argsort(hashes, kind="stable")


def _packed(values: np.ndarray, width: int) -> bytes:
    """Whole numbers of at most ``width`` bytes, compressed byte by byte."""
    if not len(values):
        return b""
    planes = values.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :width].T.tobytes()
    return len(values).to_bytes(4, "little") + pa.compress(planes, "zstd", asbytes=True)


def _unpacked(data: bytes, width: int) -> np.ndarray:
    if not data:
        return np.zeros(0, np.uint64)
    n = int.from_bytes(data[:4], "little")
    out = np.zeros((n, 8), np.uint8)
    out[:, :width] = np.frombuffer(pa.decompress(data[4:], n * width, "zstd", asbytes=True), np.uint8).reshape(width, n).T
    return out.reshape(-1).view("<u8")


_ASKED = pa.schema(
    [
        ("part", pa.int64()), ("chunk", pa.int64()), ("words", pa.binary()), ("word_counts", pa.binary()),
        ("pairs", pa.binary()), ("pair_counts", pa.binary()), ("doc_ids", pa.list_(pa.int64())),
        ("held", pa.list_(pa.bool_())), ("lengths", pa.binary()), ("order", pa.binary()), ("tokens", pa.binary()),
    ]
)
_ASKED_DDL = (
    "part long, chunk long, words binary, word_counts binary, pairs binary, pair_counts binary, "
    "doc_ids array<long>, held array<boolean>, lengths binary, order binary, tokens binary"
)


def _ask_batches(batches, part_bits: int) -> Iterator[pa.RecordBatch]:
    """Per chunk a row with its texts as word numbers (a part below zero), and for every part a row with
    its distinct words and pairs and how often training texts have them; columns doc_id, text, held, row_id."""
    pieces: list[tuple] = []
    size = 0

    def sent() -> Iterator[pa.RecordBatch]:
        chunk = pieces[0][0]
        ids, held = [i for p in pieces for i in p[1]], np.concatenate([p[2] for p in pieces])
        lengths = np.concatenate([p[3] for p in pieces])
        kinds, which = np.unique(np.concatenate([p[4] for p in pieces]), return_inverse=True)
        pieces.clear()
        first, second, pair = _pairs_of(which, lengths, len(kinds))
        pairs, order = _by_part(kinds, first, second, part_bits)
        learned = np.repeat(~held, lengths)
        word_counts = np.bincount(which[learned], minlength=len(kinds))
        pair_counts = np.bincount(pair[learned], minlength=len(pairs))[order]
        pairs = pairs[order]
        parts = np.arange((1 << part_bits) + 1)
        of_word = np.searchsorted(_part_of(kinds, part_bits), parts)
        of_pair = np.searchsorted((pairs >> np.uint64(PAIR_BITS)).astype(np.int64), parts)
        frequent = np.argsort(-np.bincount(which, minlength=len(kinds)), kind="stable")
        rank = np.empty_like(frequent)
        rank[frequent] = np.arange(len(frequent))
        rows = [
            {
                "part": -1 - chunk, "chunk": chunk, "doc_ids": ids, "held": held.tolist(),
                "lengths": _packed(lengths, 8), "order": _packed(frequent, 4), "tokens": _packed(rank[which], 4),
            }
        ]
        for part in range(1 << part_bits):  # also without words: its answer has totals
            w, p = slice(of_word[part], of_word[part + 1]), slice(of_pair[part], of_pair[part + 1])
            rows.append(
                {
                    "part": part, "chunk": chunk, "words": _packed(kinds[w], 8), "word_counts": _packed(word_counts[w], 4),
                    "pairs": _packed(pairs[p], 8), "pair_counts": _packed(pair_counts[p], 4),
                }
            )
        for at in range(0, len(rows), 256):
            yield pa.RecordBatch.from_pylist(rows[at : at + 256], _ASKED)

    for batch in batches:
        ids, row_ids = batch.column(0).to_pylist(), batch.column(3).to_pylist()
        held = np.array(batch.column(2).to_pylist(), bool)
        for a, lengths, tokens, _ in token_groups(text_rows(batch)):
            b = a + len(lengths)
            pieces.append((row_ids[a], ids[a:b], held[a:b], lengths, tokens))
            size += len(tokens)
            if size >= CHUNK_TOKENS:
                yield from sent()
                size = 0
    if pieces:
        yield from sent()


def levels(counts: np.ndarray, steps: int) -> np.ndarray:
    """Level of a count of one or more: one, and ``steps`` more for every doubling."""
    return 1 + np.floor(steps * np.log2(counts) + 1e-9).astype(np.int64)


def level_counts(steps: int, most: int = 300) -> np.ndarray:
    """The count a level stands for: the mean of the whole numbers it may come from; zero for none."""
    out = np.zeros(most)
    for q in range(1, most):
        low, high = np.ceil(2 ** ((q - 1) / steps) - 1e-9), np.ceil(2 ** (q / steps) - 1e-9) - 1
        out[q] = (low + high) / 2 if high >= low else 2 ** ((q - 1) / steps)
    return out


def _positions(grams: np.ndarray, level: int, probe: int, size: np.ndarray | int) -> np.ndarray:
    """Bit of a gram in its segment, for one level and probe; sizes are powers of two."""
    with np.errstate(over="ignore"):
        h = mix(grams + _LEVEL * np.uint64(level))
        step = (h >> np.uint64(32)) | np.uint64(1)
    return ((h + np.uint64(probe) * step) & (np.uint64(size) - np.uint64(1) if np.isscalar(size) else size - np.uint64(1))).astype(np.int64)


def build_segment(
    words: np.ndarray, word_counts: np.ndarray, pairs: np.ndarray, pair_counts: np.ndarray, most_bits: float = np.inf
) -> tuple[np.ndarray, int]:
    """Packed bits of one segment and the number of pair occurrences it holds.

    A segment is as large as its levels ask for. Under a caller's ``most_bits`` words go in first
    and pairs follow from the highest level down while whole levels fit; scores set no such bound.
    """
    word_level, pair_level = levels(word_counts, WORD_STEPS), levels(pair_counts, PAIR_STEPS)
    room = most_bits / (PROBES * BITS_PER_PROBE)
    used = float(word_level.sum())
    least = int(pair_level.max(initial=0)) + 1
    per_level = np.bincount(pair_level, weights=pair_level, minlength=least + 1)
    while least > 1 and used + per_level[least - 1] <= room:
        least -= 1
        used += per_level[least]
    kept = pair_level >= least
    pairs, pair_level = pairs[kept], pair_level[kept]
    size = 64
    while size < used * PROBES * BITS_PER_PROBE and size < most_bits:
        size *= 2
    bits = np.zeros(size, bool)
    for grams, level in ((words, word_level), (pairs, pair_level)):
        for q in range(1, int(level.max(initial=0)) + 1):
            own = grams[level >= q]
            for probe in range(PROBES):
                bits[_positions(own, q, probe, size)] = True
    return np.packbits(bits, bitorder="little"), int(pair_counts[kept].sum())


_ANSWERED_DDL = _ASKED_DDL + ", n_tokens long, n_kinds long"
_ANSWERED = pa.schema([*_ASKED, ("n_tokens", pa.int64()), ("n_kinds", pa.int64())])


def _gathered(table: pa.Table, name: str, counts: str, width: int) -> tuple[np.ndarray, np.ndarray, list[np.ndarray]]:
    """Distinct grams of all chunks, their counts, and the places of each chunk's grams among them."""
    grams = [_unpacked(x, 8) for x in table.column(name).to_pylist()]
    ends = np.cumsum([len(x) for x in grams])
    found, at = np.unique(np.concatenate(grams), return_inverse=True)
    added = np.concatenate([_unpacked(x, width) for x in table.column(counts).to_pylist()])
    total = np.bincount(at, weights=added, minlength=len(found)).astype(np.int64)
    return found, total, np.split(at, ends[:-1])


def _answer_part(table: pa.Table) -> pa.Table:
    """Fill one segment with all that training texts have of it, and look up all that is asked.

    An answer has the words' hashes, exact counts and levels and the pairs' levels (as ``pair_counts``),
    and the segment's tokens and distinct words. Texts pass as they are.
    """
    part = table.column("part")[0].as_py()
    if part < 0:
        return pa.table([*table.columns, *(pa.nulls(len(table), f.type) for f in list(_ANSWERED)[-2:])], _ANSWERED)
    chunks = table.column("chunk").to_pylist()
    words, word_counts, of_word = _gathered(table, "words", "word_counts", 4)
    pairs, pair_counts, of_pair = _gathered(table, "pairs", "pair_counts", 4)
    known, seen = word_counts > 0, pair_counts > 0
    bits, pair_tokens = build_segment(words[known], word_counts[known], pairs[seen], pair_counts[seen])
    tokens = int(word_counts.sum())
    model = Model(
        bits, np.zeros(1, np.int64), np.array([8 * len(bits)], np.uint64), tokens, int(known.sum()), 0,
        pair_tokens / max(tokens, 1), words[known], word_counts[known],
    )
    word_level, pair_level = (
        np.concatenate([look_up(x[i : i + LOOKED_UP], model, 0) for i in range(0, max(len(x), 1), LOOKED_UP)])
        for x in (words, pairs)
    )
    rows = [
        {
            "part": part, "chunk": chunk, "words": _packed(words[w], 8), "word_counts": _packed(word_counts[w], 8),
            "order": _packed(word_level[w], 2), "pair_counts": _packed(pair_level[p], 2),
            "n_tokens": model.tokens, "n_kinds": model.words,
        }
        for chunk, w, p in zip(chunks, of_word, of_pair)
    ]
    answers = pa.Table.from_pylist(rows, _ANSWERED)
    pa.default_memory_pool().release_unused()
    return answers


def look_up(grams: np.ndarray, model: Model, part_bits: int) -> np.ndarray:
    """Level of each gram: probes go on while every bit asked for is set."""
    level = np.zeros(len(grams), np.int64)
    part = _part_of(grams, part_bits)
    offset, size = model.offsets[part], model.sizes[part]
    alive, q = np.arange(len(grams)), 0
    while len(alive):
        q += 1
        for probe in range(PROBES):
            at = _positions(grams[alive], q, probe, size[alive])
            set_ = (model.bits[offset[alive] + (at >> 3)] >> (at & 7).astype(np.uint8)) & 1
            alive = alive[set_ == 1]
        level[alive] = q
        if q >= 299:
            break
    return level


_SCORED = (
    "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"
)


def _score_chunk(table: pa.Table, part_bits: int, n_texts: int) -> pa.Table:
    """Scores of one chunk's texts from its own row and the answers of all parts."""
    rows = sorted(table.to_pylist(), key=lambda r: r["part"])
    texts, answers = rows[0], rows[1:]
    of_word, of_pair = level_counts(WORD_STEPS), level_counts(PAIR_STEPS)
    train_tokens = sum(r["n_tokens"] for r in answers)
    total = train_tokens + 0.5 * (sum(r["n_kinds"] for r in answers) + 1)
    kinds, exact, word_level, levels_in_order = (
        np.concatenate([_unpacked(r[name], width) for r in answers])
        for name, width in (("words", 8), ("word_counts", 8), ("order", 2), ("pair_counts", 2))
    )
    lengths = _unpacked(texts["lengths"], 8).astype(np.int64)
    which = _unpacked(texts["order"], 4).astype(np.int64)[_unpacked(texts["tokens"], 4).astype(np.int64)]
    starts = np.cumsum(lengths) - lengths
    first, second, pair = _pairs_of(which, lengths, len(kinds))
    _, order = _by_part(kinds, first, second, part_bits)
    pair_level = np.empty(len(first), np.int64)
    pair_level[order] = levels_in_order
    about = np.append(of_word[word_level.astype(np.int64)], n_texts)
    context = about[first]
    pairs = np.minimum(of_pair[pair_level], context)
    weight = PAIR_WEIGHT * context / (context + PAIR_PRIOR)
    p = weight * pairs / np.maximum(context, 1) + (1 - weight) * (about[second] + 0.5) / total
    base, score = np.log10((exact + 0.5) / total), np.log10(np.minimum(p, 1.0))
    return pa.table(
        {
            "doc_id": pa.array(texts["doc_ids"], pa.int64()),
            "held_out": pa.array(texts["held"], pa.bool_()),
            "n_tokens": lengths,
            "n_known": np.add.reduceat((exact > 0).astype(np.int64)[which], starts),
            "train_tokens": np.full(len(lengths), train_tokens, np.int64),
            "base_score": np.add.reduceat(base[which], starts),
            "score": np.add.reduceat(score[pair], starts),
        }
    )


def language_scores(docs: DataFrame) -> DataFrame:
    """``doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score`` of every row.

    ``docs`` has ``doc_id, text``. Null and empty texts are one end token. Without training texts
    every count is zero and both scores are those of unknown words. Repeated rows keep their rows
    and count each; further columns are ignored; an empty table gives no rows.
    """
    held = held_out(F.col("doc_id"))
    seen = docs.select(
        F.coalesce(F.sum((~held).cast("long")), F.lit(0)).alias("texts"),
        F.coalesce(F.sum(F.octet_length("text").cast("long")), F.lit(0)).alias("size"),
    ).first()
    part_bits = max(0, int(seen["size"] // PART_BYTES).bit_length())
    answered = (
        with_row_id(docs.select("doc_id", "text", held.alias("held")))
        .transform(map_arrow, partial(_ask_batches, part_bits=part_bits), _ASKED_DDL)
        .groupBy("part").applyInArrow(_answer_part, _ANSWERED_DDL)
    )
    n_texts = seen["texts"]

    def score(table: pa.Table) -> pa.Table:
        return _score_chunk(table, part_bits, n_texts)

    return answered.groupBy("chunk").applyInArrow(score, _SCORED)
