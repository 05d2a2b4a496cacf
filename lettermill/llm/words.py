"""Words of many texts at once, as arrays: places, owners and 64-bit hashes."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

#: Bytes of text handled in one go by the operators that use this.
BLOCK_BYTES = 1 << 20
_BLANK = np.zeros(256, bool)
_BLANK[[32, *range(9, 14)]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_M = 0x9E3779B97F4A7C15 | 1
_M_INVERSE = pow(_M, -1, 1 << 64)
_FIRST_BYTES = np.array([(1 << 8 * n) - 1 for n in range(9)], np.uint64)


def mix64(x: np.ndarray) -> np.ndarray:
    """A one-to-one scrambling of 64 bits."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _powers(m: int, n: int) -> np.ndarray:
    out = np.full(n, m, np.uint64)
    out[0] = 1
    return np.cumprod(out, dtype=np.uint64)


def range_hashes(raw: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of raw[start:end] for each pair; the ranges lie in order and don't overlap.

    Eight bytes at a time are scrambled together with their place before they are summed: a sum of
    bytes times powers has whole families of texts that collide.
    """
    out = np.empty(len(starts), np.uint64)
    padded = np.concatenate([raw, np.zeros(8, np.uint8)])
    eights = np.lib.stride_tricks.sliding_window_view(padded, 8)
    i = 0
    while i < len(starts):  # in stretches, so that the arrays stay small
        j = max(i + 1, int(np.searchsorted(ends, starts[i] + BLOCK_BYTES, "right")))
        sizes = ends[i:j] - starts[i:j]
        pieces = np.maximum((sizes + 7) >> 3, 1)
        first = np.concatenate([[0], np.cumsum(pieces)[:-1]])
        number = np.arange(int(pieces.sum())) - np.repeat(first, pieces)
        at = np.repeat(starts[i:j], pieces) + 8 * number
        left = np.clip(np.repeat(sizes, pieces) - 8 * number, 0, 8)
        value = np.ascontiguousarray(eights[at]).view("<u8")[:, 0]
        value &= _FIRST_BYTES[left]
        value = mix64(value + mix64((number + 1).astype(np.uint64) * np.uint64(_M)))
        out[i:j] = mix64(np.add.reduceat(value, first) + sizes.astype(np.uint64))
        i = j
    return out


@dataclass(slots=True)
class Words:
    raw: np.ndarray  # bytes of all texts, a line feed after each
    bounds: np.ndarray  # where each text starts in raw; one more at the end
    starts: np.ndarray
    ends: np.ndarray
    first: np.ndarray  # number of the first word of each text; one more at the end
    owner: np.ndarray  # the text of each word
    hashes: np.ndarray


def text_blocks(sizes: list[int], most: int = BLOCK_BYTES):
    """Ranges (start, end) of texts with at most `most` bytes together, or one text."""
    start, held = 0, 0
    for i, n in enumerate(sizes):
        if held and held + n > most:
            yield start, i
            start, held = i, 0
        held += n
    if start < len(sizes):
        yield start, len(sizes)


def split_words(texts: list[bytes], lower: bool = False) -> Words:
    """Words are runs without the bytes 0x20 and 0x09-0x0D; lower: A-Z count as a-z."""
    raw = np.frombuffer(b"\n".join([*texts, b""]), np.uint8)
    if lower:
        raw = _LOWER[raw]
    bounds = np.zeros(len(texts) + 1, np.int64)
    np.cumsum([len(t) + 1 for t in texts], out=bounds[1:])
    inside = np.zeros(len(raw) + 2, np.int8)
    inside[1:-1] = ~_BLANK[raw]
    turns = np.diff(inside)
    starts, ends = np.flatnonzero(turns == 1), np.flatnonzero(turns == -1)
    first = np.searchsorted(starts, bounds)
    owner = np.repeat(np.arange(len(texts)), np.diff(first))
    return Words(raw, bounds, starts, ends, first, owner, range_hashes(raw, starts, ends))


def window_hashes(w: Words, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the runs of n words that lie in one text, and the number of the first word of each."""
    if len(w.hashes) < n:
        return np.empty(0, np.uint64), np.empty(0, np.int64)
    at = np.flatnonzero(w.owner[: len(w.owner) - n + 1] == w.owner[n - 1 :])
    h = w.hashes[at]
    for k in range(1, n):
        h = mix64(h * np.uint64(_M) + w.hashes[at + k])
    return h, at
