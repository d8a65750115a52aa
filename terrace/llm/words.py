"""Words of whole texts as 64-bit hashes, computed by array operations a piece at a time.

A text's UTF-8 bytes are of three kinds: word bytes, gaps between words, and
breaks, which also end the piece of text that a phrase may span.  Every byte
that separates words in the text contracts is ASCII, so a letter of several
bytes is never cut.  A-Z count as a-z.

Texts are taken in groups of about ``GROUP`` bytes (a longer text is a group
of its own) and hashed in pieces of about ``PIECE`` bytes cut between words,
so the working memory is about 30 times ``PIECE`` plus 40 bytes a word of one
group, whatever the size of the batch.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

from terrace.llm.shingles import mixed

GROUP = 4 << 20
PIECE = 1 << 20
WORD, GAP, BREAK = 0, 1, 2

LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32


def kinds(gaps: bytes, breaks: bytes = b"") -> np.ndarray:
    """The kind of every byte: what is neither a gap nor a break belongs to a word."""
    k = np.full(256, WORD, np.uint8)
    k[list(gaps)] = GAP
    k[list(breaks)] = BREAK
    return k


@dataclass
class Group:
    """Some texts of a batch and their words, in order."""
    first: int              # row of the group's first text in its batch
    n: int                  # number of texts
    data: np.ndarray        # their bytes
    start: np.ndarray       # of each word: its bytes are data[start:end]
    end: np.ndarray
    ids: np.ndarray         # hash of each word's lower-cased bytes
    text: np.ndarray        # each word's text, counted from ``first``
    after_break: np.ndarray  # no phrase spans this word and the one before

    def words(self) -> np.ndarray:
        """Number of words of each text."""
        return np.bincount(self.text, minlength=self.n)

    def lowered(self, lo: int, hi: int) -> bytes:
        return LOWER[self.data[lo:hi]].tobytes()


class Hasher:
    """Polynomial hash of a word's bytes; another ``seed`` is another function."""

    def __init__(self, seed: int = 0):
        rng = np.random.Generator(np.random.PCG64([20241107, seed]))
        self.base = np.uint64(int(rng.integers(0, 2**63)) * 2 + 1)
        self.byte = rng.integers(0, 2**64, 256, dtype=np.uint64)
        self.powers = np.ones(1, np.uint64)

    def __call__(self, data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        """Hash of data[start:end] for words that lie in order, apart from each other."""
        size = end - start
        longest = int(size.max())
        if len(self.powers) < longest:
            p = np.full(2 * longest, self.base, np.uint64)
            p[0] = 1
            self.powers = np.cumprod(p, dtype=np.uint64)
        at = np.cumsum(size) - size
        place = np.arange(int(size.sum()), dtype=np.int64) - np.repeat(at, size)
        letters = self.byte[LOWER[data[place + np.repeat(start, size)]]]
        return mixed(np.add.reduceat(letters * self.powers[place], at) + size.astype(np.uint64))


def _buffers(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    texts = texts.cast(pa.large_binary()).fill_null(b"")
    if not len(texts):
        return np.zeros(1, np.int64), np.empty(0, np.uint8)
    offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset:texts.offset + len(texts) + 1]
    data = texts.buffers()[2]
    return offsets, np.empty(0, np.uint8) if data is None else np.frombuffer(data, np.uint8)


def _cut(kind: np.ndarray, data: np.ndarray, lo: int, hi: int) -> int:
    """The first place at or after ``hi`` between two words."""
    while hi < len(data):
        window = kind[data[hi:hi + 4096]] != WORD
        if window.any():
            return hi + int(window.argmax())
        hi += len(window)
    return len(data)


def groups(texts: pa.Array, kind: np.ndarray, hasher: Hasher) -> Iterator[Group]:
    """All texts of a batch (null: empty), a group at a time, with their words."""
    offsets, data = _buffers(texts)
    row, n = 0, len(offsets) - 1
    while row < n:
        stop = max(row + 1, int(np.searchsorted(offsets, offsets[row] + GROUP, side="right")) - 1)
        yield _group(row, offsets[row:stop + 1] - offsets[row], data[offsets[row]:offsets[stop]], kind, hasher)
        row = stop


def _group(first: int, offsets: np.ndarray, data: np.ndarray, kind: np.ndarray, hasher: Hasher) -> Group:
    starts, ends, ids, breaks = [], [], [], []
    lo = 0
    while lo < len(data):
        hi = _cut(kind, data, lo, min(lo + PIECE, len(data)))
        k = kind[data[lo:hi]]
        inside = k == WORD
        edge = np.zeros(hi - lo + 1, bool)                  # a text's end ends a word too
        here = offsets[(offsets >= lo) & (offsets <= hi)] - lo
        edge[here] = True
        edge[[0, -1]] = True                                # pieces are cut between words
        s = np.flatnonzero(inside & (edge[:-1] | ~np.concatenate([[False], inside[:-1]])))
        e = np.flatnonzero(inside & (edge[1:] | ~np.concatenate([inside[1:], [False]]))) + 1
        if len(s):
            starts.append(s + lo)
            ends.append(e + lo)
            ids.append(hasher(data[lo:hi], s, e))
        breaks.append(np.flatnonzero(k == BREAK) + lo)
        lo = hi
    n = len(offsets) - 1
    none = np.empty(0, np.int64)
    start = np.concatenate(starts) if starts else none
    end = np.concatenate(ends) if ends else none
    h = np.concatenate(ids) if ids else np.empty(0, np.uint64)
    text = np.searchsorted(offsets, start, side="right") - 1
    passed = np.searchsorted(np.concatenate(breaks) if breaks else none, start)
    fresh = np.ones(len(start), bool)
    fresh[1:] = (text[1:] != text[:-1]) | (passed[1:] != passed[:-1])
    return Group(first, n, data, start, end, h, text, fresh)


# ------------------------------------------------------------------ fixed-size filters
MAX_BITS = 26


class BitFilter:
    """Which 64-bit hashes may be in a set, by two bits each: no member is refused.

    The size is fixed by ``MAX_BITS`` (8 MB), not by the set; a set that fills
    it lets more strangers through, which its user has to drop.
    """

    def __init__(self, bits: int, cells: np.ndarray, at: np.ndarray):
        self.bits = bits
        self.table = np.zeros(1 << (bits - 6), np.uint64)
        self.table[at] = cells.view(np.uint64)

    def _bit(self, place: np.ndarray) -> np.ndarray:
        return (self.table[place >> np.uint64(6)] >> (place & np.uint64(63))) & np.uint64(1) != 0

    def __call__(self, h: np.ndarray) -> np.ndarray:
        fit = self._bit(h >> np.uint64(64 - self.bits))
        at = np.flatnonzero(fit)
        fit[at] = self._bit(h[at] & np.uint64((1 << self.bits) - 1))
        return fit


def bit_filter(hashes, column: str) -> BitFilter:
    """The filter of a column of well-mixed 64-bit hashes, built in the cluster as cells of 64 bits."""
    from pyspark.sql import functions as F

    n = hashes.count()
    bits = min(MAX_BITS, max(12, int(n * 256).bit_length()))
    places = F.array(F.shiftrightunsigned(F.col(column), 64 - bits),           # the first bits and the last
                     F.col(column).bitwiseAND((1 << bits) - 1))
    # at most 2 ** (MAX_BITS - 6) rows of two longs come to the driver
    cells = (hashes.select(F.explode(places).alias("place"))
             .select(F.shiftrightunsigned("place", 6).alias("at"),
                     F.call_function("shiftleft", F.lit(1).cast("bigint"),
                                     F.col("place").bitwiseAND(63).cast("int")).alias("bit"))
             .groupBy("at").agg(F.bit_or("bit").alias("cell")).toArrow())
    return BitFilter(bits, cells["cell"].to_numpy().astype(np.int64), cells["at"].to_numpy())
