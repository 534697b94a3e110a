"""UTF-8 text of an Arrow batch as one byte array, and hashes of words and shingles over it."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

GROUP_BYTES = 1 << 21
U64 = np.uint64
_random = np.random.default_rng(20240)
#: A random odd value per byte.
BYTE_VALUE = _random.integers(1, 1 << 63, 256, dtype=np.uint64) * U64(2) + U64(1)
BASE = int(_random.integers(1, 1 << 62)) * 2 + 1


def powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base & (2**64 - 1), dtype=np.uint64)
    out[0] = 1
    return np.multiply.accumulate(out)


WORD_POWERS = powers(BASE, 1 << 16)
#: White space and control bytes end a word.
WORD_VALUE = np.where(np.arange(256) <= 32, U64(0), BYTE_VALUE)


def mixed(h: np.ndarray) -> np.ndarray:
    """Finaliser that spreads every bit (splitmix64)."""
    h = h ^ (h >> U64(30))
    h = h * U64(0xBF58476D1CE4E5B9)
    h = h ^ (h >> U64(27))
    h = h * U64(0x94D049BB133111EB)
    return h ^ (h >> U64(31))


def utf8(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of all texts and the offset of each (one more than there are texts). Nulls are empty."""
    if not pa.types.is_large_string(column.type):
        column = column.cast(pa.large_string())
    if column.null_count:
        column = column.fill_null("")
    _, offsets, data = column.buffers()
    at = np.frombuffer(offsets, dtype=np.int64)[column.offset : column.offset + len(column) + 1]
    held = np.frombuffer(data, dtype=np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return held[at[0] : at[-1]], at - at[0]


def groups(offsets: np.ndarray, limit: int = GROUP_BYTES) -> Iterator[tuple[int, int]]:
    """Ranges of consecutive texts of about `limit` bytes; a longer text stands alone."""
    first, n = 0, len(offsets) - 1
    while first < n:
        last = max(first + 1, int(np.searchsorted(offsets, offsets[first] + limit, side="right")) - 1)
        yield first, min(last, n)
        first = min(last, n)


def word_hashes(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hash, text index and first byte of each white-space separated word of the texts."""
    inside = data > 32
    begins = np.empty(len(data), dtype=bool)
    if len(data):
        begins[0] = inside[0]
        np.greater(inside[1:], inside[:-1], out=begins[1:])
        cut = offsets[:-1][offsets[:-1] < len(data)]
        begins[cut] = inside[cut]
    starts = np.flatnonzero(begins)
    if not len(starts):
        return np.zeros(0, np.uint64), np.zeros(0, np.int64), starts
    # A text that begins with white space ends the last word of the one before: white space counts as nothing.
    place = np.arange(starts[0], len(data)) - np.repeat(starts, np.diff(np.append(starts, len(data))))
    terms = WORD_VALUE[data[starts[0] :]] * WORD_POWERS[place & 0xFFFF]
    sums = np.add.reduceat(terms, starts - starts[0])
    return mixed(sums), np.searchsorted(offsets, starts, side="right") - 1, starts


def shingles(words: np.ndarray, text: np.ndarray, n_texts: int, size: int = 5) -> tuple[np.ndarray, np.ndarray]:
    """Hash and text index of every run of `size` words; a text of fewer words, but at least one, is one run."""
    if not len(words):
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    count = len(words) - size + 1
    whole, owner = np.zeros(0, np.uint64), np.zeros(0, np.int64)
    if count > 0:
        h = np.zeros(count, np.uint64)
        for k in range(size):
            h = h * U64(0x9E3779B97F4A7C15) + words[k : k + count]
        same = text[:count] == text[size - 1 :]
        whole, owner = mixed(h[same]), text[:count][same]
    n_words = np.bincount(text, minlength=n_texts)
    short = np.flatnonzero((n_words > 0) & (n_words < size))
    if len(short):
        first = np.searchsorted(text, short)
        extra = np.array([np.bitwise_xor.reduce(mixed(words[a : a + k] + U64(k) * np.arange(1, k + 1, dtype=np.uint64))) for a, k in zip(first, n_words[short], strict=True)], dtype=np.uint64)
        whole, owner = np.append(whole, extra), np.append(owner, short)
        order = np.argsort(owner, kind="stable")
        whole, owner = whole[order], owner[order]
    return whole, owner
