"""Suffix order of a bounded text by difference-cover blockwise construction, in numpy.

A sample of positions (those in a difference cover modulo PERIOD) is ranked first. The suffixes of interest are
then sorted one bucket at a time by their first PERIOD bytes; of suffixes that tie, any two have a common shift
below PERIOD at which both stand in the sample, so one look at two ranks orders them. Memory is that of the text,
the sample's ranks and one bucket.
"""

from __future__ import annotations

import numpy as np

#: A perfect difference set: every shift modulo PERIOD is a difference of two of its elements.
PERIOD, COVER = 31, (1, 5, 11, 24, 25, 27)
_IN_COVER = np.isin(np.arange(PERIOD), COVER)
#: Bytes that order by words of eight; at least PERIOD.
HEAD_WORDS = 4


def _shifts() -> np.ndarray:
    """The least shift that puts a pair of residues into the cover."""
    steps = np.arange(PERIOD)
    inside = _IN_COVER[(steps[:, None] + steps) % PERIOD]
    return (inside[:, None, :] & inside[None, :, :]).argmax(axis=2)


SHIFT = _shifts()


def words_at(text: np.ndarray) -> np.ndarray:
    """The eight bytes from each position as one big-endian number."""
    n = len(text) - 7
    out = np.zeros(n, np.uint64)
    for k in range(8):
        out = (out << np.uint64(8)) | text[k : k + n]
    return out


def dense(new: np.ndarray, order: np.ndarray) -> np.ndarray:
    out = np.empty(len(order), np.int64)
    out[order] = np.cumsum(new)
    return out


def sample_ranks(words: np.ndarray, n: int, depth: int) -> np.ndarray:
    """For each of n positions in the sample, its rank by at least `depth` bytes; other positions hold 0."""
    at = np.flatnonzero(_IN_COVER[np.arange(n) % PERIOD])
    keys = [words[at + 8 * k] for k in range(HEAD_WORDS)]
    order = np.lexsort(keys[::-1])
    new = np.ones(len(at), bool)
    new[1:] = np.logical_or.reduce([k[order][1:] != k[order][:-1] for k in keys]) if len(at) > 1 else True
    ranks = np.zeros(n + 2 * depth + PERIOD, np.int64)
    ranks[at] = dense(new, order)
    reach = PERIOD
    while reach < depth:
        both = ranks[at] * (len(at) + 1) + ranks[at + reach]
        order = np.argsort(both, kind="stable")
        new[1:] = both[order][1:] != both[order][:-1]
        ranks[at] = dense(new, order)
        reach *= 2
    return ranks


def merge_network(size: int) -> list[tuple[np.ndarray, np.ndarray]]:
    """Stages of Batcher's odd-even merge sort for a power of two: pairs to compare at once."""
    stages, p = [], 1
    while p < size:
        k = p
        while k >= 1:
            low = [i + j for j in range(k % p, size - k, 2 * k) for i in range(min(k, size - j - k)) if (i + j) // (2 * p) == (i + j + k) // (2 * p)]
            stages.append((np.array(low), np.array(low) + k))
            k //= 2
        p *= 2
    return stages


def order_ties(groups: np.ndarray, starts: np.ndarray, ranks: np.ndarray) -> np.ndarray:
    """Rows of indices of starts (padded with -1), each row put in suffix order by sample ranks."""
    for low, high in merge_network(groups.shape[1]):
        a, b = groups[:, low], groups[:, high]
        p, q = starts[a], starts[b]
        shift = SHIFT[p % PERIOD, q % PERIOD]
        swap = (b >= 0) & ((a < 0) | (ranks[p + shift] > ranks[q + shift]))
        groups[:, low], groups[:, high] = np.where(swap, b, a), np.where(swap, a, b)
    return groups


def sorted_suffixes(words: np.ndarray, ranks: np.ndarray, starts: np.ndarray, bucket: np.ndarray) -> np.ndarray:
    """Indices of `starts` by bucket, then by suffix, as deep as the sample's ranks are."""
    keys = [words[starts + 8 * k] for k in range(HEAD_WORDS)]
    order = np.lexsort([*keys[::-1], bucket])
    same = np.zeros(len(order), bool)
    if len(order) > 1:
        same[1:] = (bucket[order][1:] == bucket[order][:-1]) & np.logical_and.reduce([k[order][1:] == k[order][:-1] for k in keys])
    begin = np.flatnonzero(~same)
    size = np.diff(np.append(begin, len(order)))
    width = 2
    while (size > width // 2).any():
        ties = np.flatnonzero((size > width // 2) & (size <= width) & (size > 1))
        # Ties of about one size at a time, in pieces of bounded memory.
        some = max(1, (1 << 18) // width)
        for at in range(0, len(ties), some):
            first, held = begin[ties[at : at + some]], size[ties[at : at + some]]
            inside = np.arange(width) < held[:, None]
            cell = np.minimum(first[:, None] + np.arange(width), len(order) - 1)
            order[cell[inside]] = order_ties(np.where(inside, order[cell], -1), starts, ranks)[inside]
        width *= 2
    return order


def equal_to_neighbour(words: np.ndarray, starts: np.ndarray, bucket: np.ndarray, order: np.ndarray, length: int) -> np.ndarray:
    """Which starts (by index) share `length` bytes (a multiple of 8) with a neighbour in suffix order."""
    p = starts[order]
    equal = np.flatnonzero(bucket[order][1:] == bucket[order][:-1])
    for k in range(0, length, 8):
        equal = equal[words[p[equal] + k] == words[p[equal + 1] + k]]
    out = np.zeros(len(starts), bool)
    out[order[equal]] = out[order[equal + 1]] = True
    return out
