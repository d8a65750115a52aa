"""Word shingles of whole texts as 64-bit sets, computed a batch at a time."""

from __future__ import annotations

from functools import lru_cache

import numpy as np
import pyarrow as pa

WORDS = 5
GROUP = 4 << 20
PIECE = 1 << 20
_RNG = np.random.Generator(np.random.PCG64(20240607))
_BYTE = _RNG.integers(0, 2**64, 256, dtype=np.uint64)        # a random number per byte, A-Z as a-z
_BYTE[65:91] = _BYTE[97:123]
_PLACE = _RNG.integers(0, 2**64, 8, dtype=np.uint64) | np.uint64(1)
_BASE = 0x9E3779B97F4A7C15 | 1
_INVERSE = pow(_BASE, -1, 2**64)
_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True


def mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


@lru_cache(maxsize=4)
def _powers(base: int, n: int) -> np.ndarray:
    p = np.full(n, base, np.uint64)
    p[0] = 1
    return np.cumprod(p, dtype=np.uint64)


def _cut(data: np.ndarray, hi: int) -> int:
    """The first white space at or after ``hi``, or the end."""
    while hi < len(data):
        window = _SPACE[data[hi:hi + 4096]]
        if window.any():
            return hi + int(window.argmax())
        hi += len(window)
    return len(data)


def word_hashes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(hash, row) of every word of a batch of texts, in order; nulls have none.

    Bytes are hashed in pieces of about ``PIECE``, cut at white space, which bounds the
    working memory; a word's hash does not depend on its place.
    """
    texts = texts.cast(pa.large_binary())
    offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset:texts.offset + len(texts) + 1]
    if not len(texts) or offsets[-1] == offsets[0]:
        return np.empty(0, np.uint64), np.empty(0, np.int64)
    data = np.frombuffer(texts.buffers()[2], np.uint8)[offsets[0]:offsets[-1]]
    offsets = offsets - offsets[0]
    hashes, rows, lo = [], [], 0
    while lo < len(data):
        hi = _cut(data, min(lo + PIECE, len(data)))
        h, starts = _piece_hashes(data[lo:hi], offsets[np.searchsorted(offsets, lo):np.searchsorted(offsets, hi, "right")] - lo)
        hashes.append(h)
        rows.append(np.searchsorted(offsets, starts + lo, side="right") - 1)
        lo = hi
    return np.concatenate(hashes), np.concatenate(rows)


def _piece_hashes(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(hash, first byte) of the words of a piece; ``offsets`` are the text bounds in it."""
    inside = ~_SPACE[data]
    edge = np.zeros(len(data) + 1, bool)                      # a text's end ends a word too
    edge[offsets] = True
    edge[[0, -1]] = True                                      # pieces are cut between words
    starts = np.flatnonzero(inside & (edge[:-1] | ~np.concatenate([[False], inside[:-1]])))
    ends = np.flatnonzero(inside & (edge[1:] | ~np.concatenate([inside[1:], [False]]))) + 1
    room = max(PIECE + 4096, len(data)) + 1
    sums = np.concatenate([[np.uint64(0)], np.cumsum(_BYTE[data] * _powers(_BASE, room)[:len(data)], dtype=np.uint64)])
    h = (sums[ends] - sums[starts]) * _powers(_INVERSE, room)[starts]
    return mixed(h + (ends - starts).astype(np.uint64)), starts


def shingle_sets(texts: pa.Array, words: int = WORDS) -> tuple[np.ndarray, np.ndarray]:
    """(shingle, row) sorted by row then shingle, distinct within a row.

    A text with fewer than ``words`` words has its whole sequence as one
    shingle; a text without words has none.  Texts are taken in groups of about
    ``GROUP`` bytes, so the memory needed is that of one group and the result.
    """
    texts = texts.cast(pa.large_binary())
    offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset:texts.offset + len(texts) + 1] if len(texts) else []
    out, lo = [(np.empty(0, np.uint64), np.empty(0, np.int64))], 0
    while lo < len(texts):
        hi = max(lo + 1, int(np.searchsorted(offsets, offsets[lo] + GROUP, side="right")) - 1)
        s, r = _group_sets(texts.slice(lo, hi - lo), words)
        out.append((s, r + lo))
        lo = hi
    return np.concatenate([s for s, _ in out]), np.concatenate([r for _, r in out])


def _group_sets(texts: pa.Array, words: int) -> tuple[np.ndarray, np.ndarray]:
    h, rows = word_hashes(texts)
    n = len(h)
    if not n:
        return h, rows
    count = np.bincount(rows, minlength=len(texts))
    full = np.flatnonzero(rows[words - 1:] == rows[:n - words + 1]) if n >= words else np.empty(0, np.int64)
    s = np.zeros(len(full), np.uint64)
    for k in range(words):
        s += h[full + k] * _PLACE[k]
    out, of = [mixed(s)], [rows[full]]
    short = np.flatnonzero((count > 0) & (count < words))
    if len(short):
        first = np.searchsorted(rows, short)
        t = np.zeros(len(short), np.uint64)
        for k in range(words - 1):
            have = count[short] > k
            t[have] += h[first[have] + k] * _PLACE[k]
        out.append(mixed(t + count[short].astype(np.uint64) * _PLACE[7]))
        of.append(short)
    s, r = np.concatenate(out), np.concatenate(of)
    order = np.lexsort((s, r))
    s, r = s[order], r[order]
    keep = np.ones(len(s), bool)
    keep[1:] = (s[1:] != s[:-1]) | (r[1:] != r[:-1])
    return s[keep], r[keep]
