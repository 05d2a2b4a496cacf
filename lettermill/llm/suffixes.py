"""Suffix order, common prefixes and longest previous factors of many short strings, as arrays."""

from __future__ import annotations

import numpy as np

LEVELS = 8  # prefixes are compared up to 2^8 symbols


def suffix_ranks(symbols: np.ndarray) -> list[np.ndarray]:
    """Ranks of all suffixes by their first 4, 8, 16 ... 2^LEVELS symbols (shorter ones sort first)."""
    n = len(symbols)
    base = int(symbols.max()) + 2
    key, padded = np.zeros(n, np.uint64), np.zeros(n + 4, np.uint64)
    padded[:n] = symbols + 1
    assert base**4 < 1 << 63, "too many strings at once"
    for k in range(4):
        key = key * np.uint64(base) + padded[k : n + k]
    ranks = [np.unique(key, return_inverse=True)[1]]
    for level in range(3, LEVELS + 1):
        width, last = 1 << (level - 1), ranks[-1]
        ahead = np.zeros(n, np.int64)
        ahead[: max(0, n - width)] = last[width:] + 1
        ranks.append(np.unique(last * np.int64(n + 2) + ahead, return_inverse=True)[1])
    return ranks


def common_prefixes(ranks: list[np.ndarray], i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Length of the common prefix of the suffixes at i and j, in steps of 4, up to twice the widest rank."""
    n, length = len(ranks[0]), np.zeros(len(i), np.int64)
    for level in range(len(ranks) - 1, -1, -1):
        width = 4 << level
        a, b = i + length, j + length
        fits = (a < n) & (b < n)
        same = fits & (ranks[level][np.minimum(a, n - 1)] == ranks[level][np.minimum(b, n - 1)])
        length += np.where(same, width, 0)
    return length


def _previous_smaller(order: np.ndarray, lcp: np.ndarray, least: int) -> np.ndarray:
    """For each place in suffix order the length shared with the nearest place before it that holds an
    earlier position (0 if below `least`), and that place. lcp[k]: of places k - 1 and k."""
    n = len(order)
    place, shared = np.arange(n) - 1, lcp.copy()
    live = np.flatnonzero((place >= 0) & (shared >= least))
    shared[(place < 0) | (shared < least)] = 0
    while True:
        live = live[(shared[live] >= least) & (order[np.maximum(place[live], 0)] > order[live])]
        if not len(live):
            break
        through = place[live]  # everything between a place and its link is later than the place
        shared[live] = np.minimum(shared[live], shared[through])
        place[live] = place[through]
        shared[live[(place[live] < 0) | (shared[live] < least)]] = 0
    return shared, np.where(shared > 0, place, -1)


def previous_factors(symbols: np.ndarray, least: int) -> tuple[np.ndarray, np.ndarray]:
    """At each position the longest factor that also starts earlier (0 if shorter than `least`; capped
    near 2^LEVELS), and whether the position is such an earlier start of another one.

    The earlier starts are the previous and the next smaller position in suffix order.
    """
    ranks = suffix_ranks(symbols)
    order = np.lexsort((np.arange(len(symbols)), ranks[-1]))
    lcp = np.zeros(len(order), np.int64)
    lcp[1:] = common_prefixes(ranks, order[:-1], order[1:])
    before, source_before = _previous_smaller(order, lcp, least)
    flipped = np.concatenate([[0], lcp[:0:-1]])
    after, source_after = _previous_smaller(order[::-1], flipped, least)
    after, source_after = after[::-1], source_after[::-1]
    factor = np.zeros(len(order), np.int64)
    factor[order] = np.maximum(before, after)
    source = np.zeros(len(order), bool)
    source[order[source_before[before > 0]]] = True
    source[order[len(order) - 1 - source_after[after > 0]]] = True
    return factor, source
