"""Whole-batch tokenising: word boundaries and 64-bit word hashes by numpy, no per-word Python.

A word is a maximal run of bytes that the given table does not map to a space. Its hash is a
polynomial over its (mapped) bytes modulo 2**64, read off one running sum per piece of text and
then mixed. Equal words have equal hashes; different ones share a hash with odds of about 2**-64.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np

from spendlake.llm.common import groups_by_size

PIECE_BYTES = 1 << 20
_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 1 << 64)
_powers: dict[str, np.ndarray] = {}

SPACE = 0x20


def byte_table(separators: bytes, lower: bool = True) -> bytes:
    """Translation table: separators become spaces, A-Z become a-z if asked."""
    table = bytearray(range(256))
    if lower:
        for c in range(ord("A"), ord("Z") + 1):
            table[c] = c + 32
    for c in separators:
        table[c] = SPACE
    return bytes(table)


#: Words between white space: space, tab, line feed, vertical tab, form feed, carriage return.
BLANK_SEPARATED = byte_table(b" \t\n\x0b\x0c\r")
#: Words of ASCII letters, digits and all characters beyond ASCII.
ALPHANUMERIC = byte_table(
    bytes(c for c in range(128) if not (48 <= c <= 57 or 65 <= c <= 90 or 97 <= c <= 122))
)


def _powers_of(length: int) -> tuple[np.ndarray, np.ndarray]:
    have = _powers.get("up")
    if have is None or len(have) < length:
        n = max(length, PIECE_BYTES + 1)
        for name, base in (("up", _BASE), ("down", _INVERSE)):
            powers = np.full(n, base, np.uint64)
            powers[0] = 1
            _powers[name] = np.multiply.accumulate(powers)
    return _powers["up"], _powers["down"]


def mix(h: np.ndarray) -> np.ndarray:
    """Finaliser that spreads every input bit."""
    h = h ^ (h >> np.uint64(32))
    h = h * np.uint64(0xD6E8FEB86659FD93)
    h = h ^ (h >> np.uint64(32))
    h = h * np.uint64(0xD6E8FEB86659FD93)
    return h ^ (h >> np.uint64(32))


def sequence_hash(hashes: np.ndarray, length: int) -> np.ndarray:
    """Hash of each run of ``length`` words, by the run's first word."""
    n = len(hashes) - length + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    total = np.full(n, length, np.uint64)
    for k in range(length):
        total = mix(total * np.uint64(_BASE) + hashes[k : k + n])
    return total


def word_bounds(mapped: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Start and end of each word of a mapped text."""
    inside = np.zeros(len(mapped) + 2, np.int8)
    inside[1:-1] = np.frombuffer(mapped, np.uint8) != SPACE
    change = np.diff(inside)
    return np.flatnonzero(change == 1), np.flatnonzero(change == -1)


def _hash_piece(mapped: bytes) -> tuple[np.ndarray, np.ndarray]:
    starts, ends = word_bounds(mapped)
    up, down = _powers_of(len(mapped) + 1)
    sums = np.zeros(len(mapped) + 1, np.uint64)
    np.cumsum(np.frombuffer(mapped, np.uint8) * up[: len(mapped)], out=sums[1:])
    return starts, mix((sums[ends] - sums[starts]) * down[starts])


def hash_words(mapped: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Starts and hashes of a text's words, in pieces cut at spaces so that memory stays bounded."""
    if len(mapped) <= PIECE_BYTES:
        return _hash_piece(mapped)
    starts, hashes, at = [], [], 0
    while at < len(mapped):
        cut = len(mapped) if at + PIECE_BYTES >= len(mapped) else mapped.rfind(b" ", at, at + PIECE_BYTES)
        if cut <= at:  # one word longer than a piece
            cut = mapped.find(b" ", at + PIECE_BYTES)
            cut = len(mapped) if cut < 0 else cut
        s, h = _hash_piece(mapped[at : cut + 1])
        starts.append(s + at)
        hashes.append(h)
        at = cut + 1
    return np.concatenate(starts), np.concatenate(hashes)


def hashed_words(texts: list[bytes], table: bytes) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """Yields ``(first row, words per row, word hashes)`` for consecutive rows of bounded size."""
    sizes = np.fromiter((len(t) + 1 for t in texts), np.int64, len(texts))
    for a, b in groups_by_size(sizes, PIECE_BYTES):
        mapped = b" ".join(texts[a:b]).translate(table)
        starts, hashes = hash_words(mapped)
        bounds = np.concatenate(([0], np.cumsum(sizes[a:b])))
        counts = np.diff(np.searchsorted(starts, bounds))
        yield a, counts, hashes

