"""Vectorised text helpers for tasks: words, rolling hashes, sliding minima.

All work on one Arrow batch or on a slice of it (``pieces``), so the working arrays
stay a small multiple of PIECE bytes, or of the longest single text.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

#: Bytes of text whose arrays are held at once.
PIECE = 1 << 20
#: Bytes of text of a batch part: what repeats within a part is settled before a shuffle.
PART = 8 << 20

_BASE = np.uint64(0x9E3779B97F4A7C15)
_SPACE = np.zeros(256, bool)
_SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[ord("A"):ord("Z") + 1] += 32
#: Letters and digits in lower case, other ASCII to spaces.
_PLAIN = np.where((np.arange(256) < 128) & ~np.isin(np.arange(256), [*range(48, 58), *range(65, 91), *range(97, 123)]), 32,
                  _LOWER).astype(np.uint8)


def mix(x: np.ndarray) -> np.ndarray:
    """Finaliser of splitmix64: spreads every input bit over the output."""
    x = x.astype(np.uint64)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


_BYTES = mix(np.arange(1, 257, dtype=np.uint64) * _BASE)


class Powers:
    """Powers of an odd multiplier modulo 2 ** 64 and of its inverse, extended on demand."""

    def __init__(self, base: int):
        self.base, self.back = np.uint64(base), np.uint64(pow(base, -1, 1 << 64))
        self.up = self.down = np.ones(1, np.uint64)

    def upto(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(self.up) < n:
            size = max(n, 2 * len(self.up))
            for name, b in (("up", self.base), ("down", self.back)):
                x = np.full(size, b, np.uint64)
                x[0] = 1
                setattr(self, name, np.cumprod(x))
        return self.up[:n], self.down[:n]


FIRST, SECOND = Powers(0x9E3779B97F4A7C15), Powers(0xD1342543DE82EF95)


class Spans:
    """Hashes of any spans of a value sequence from one prefix sum."""

    def __init__(self, values: np.ndarray, powers: Powers = FIRST):
        up, self.down = powers.upto(len(values) + 1)
        self.sums = np.zeros(len(values) + 1, np.uint64)
        np.cumsum(values * up[:-1], out=self.sums[1:])

    def __call__(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return mix((self.sums[end] - self.sums[start]) * self.down[start] + (end - start).astype(np.uint64) * _BASE)

    def rolling(self, k: int) -> np.ndarray:
        """Hash of the k values from every position (empty if there are fewer)."""
        n = len(self.sums) - k
        if n <= 0:
            return np.empty(0, np.uint64)
        return mix((self.sums[k:] - self.sums[:n]) * self.down[:n])


def sliding_min(x: np.ndarray, width: int) -> np.ndarray:
    """Minimum of every ``width`` neighbours, by doubling."""
    out, have = x, 1
    while have < width:
        step = min(have, width - have)
        if len(out) <= step:
            return np.empty(0, x.dtype)
        out = np.minimum(out[:-step], out[step:])
        have += step
    return out


def buffers(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets from 0) of a string array without nulls."""
    a = texts.cast(pa.large_binary())
    off = np.frombuffer(a.buffers()[1], np.int64)[a.offset:a.offset + len(a) + 1]
    data = np.frombuffer(a.buffers()[2], np.uint8) if a.buffers()[2] is not None else np.empty(0, np.uint8)
    return data[off[0]:off[-1]] if len(off) else data[:0], off - off[0]


def pieces(texts: pa.Array, limit: int = PIECE) -> Iterator[tuple[int, int]]:
    """Ranges of texts with about ``limit`` bytes each, or of one longer text."""
    if not len(texts):
        return
    off = np.concatenate([[0], np.cumsum(pa.compute.binary_length(texts).to_numpy(zero_copy_only=False).astype(np.int64))])
    lo = 0
    while lo < len(texts):
        hi = max(lo + 1, int(np.searchsorted(off, off[lo] + limit, "right")) - 1)
        yield lo, hi
        lo = hi


class Words:
    """Words of some texts: ``data`` has them joined by one space within a text (no space
    between texts); ``start`` and ``end`` are byte positions, ``first`` the first word of
    each text and, last, the number of words.  ``plain`` takes ASCII punctuation as
    separators and lower-cases A-Z."""

    def __init__(self, texts: pa.Array, lower: bool = False, plain: bool = False):
        raw, off = buffers(texts)
        if plain:
            raw = _PLAIN[raw]
        space = _SPACE[raw]
        # a separator stays if it follows a word byte of the same text
        keep = ~space
        keep[1:] |= space[1:] & ~space[:-1]
        opens = off[:-1][off[:-1] < len(raw)]
        if len(raw):
            keep[opens] &= ~space[opens]
        new = np.zeros(len(raw) + 1, np.int64)
        np.cumsum(keep, out=new[1:])
        self.data = (_LOWER[raw] if lower else raw)[keep]
        gap = space[keep]
        self.data[gap] = 0x20
        bounds = new[off]
        begin = ~gap
        if len(gap):
            at_open = np.zeros(len(gap), bool)
            at_open[bounds[:-1][bounds[:-1] < len(gap)]] = True
            begin[1:] &= gap[:-1] | at_open[1:]
        self.start = np.flatnonzero(begin)
        finish = ~gap
        if len(gap):
            finish[:-1] &= gap[1:] | at_open[1:]
        self.end = np.flatnonzero(finish) + 1
        self.first = np.searchsorted(self.start, bounds)

    def hashes(self) -> np.ndarray:
        return Spans(_BYTES[self.data])(self.start, self.end)

    def strings(self) -> pa.Array:
        """The words as a binary array."""
        lengths = self.end - self.start
        off = np.concatenate([[0], np.cumsum(lengths)])
        inside = np.zeros(len(self.data) + 1, np.int8)
        inside[self.start] += 1  # starts are distinct, and so are ends
        inside[self.end] -= 1
        flat = self.data[np.cumsum(inside[:-1]).astype(bool)]
        return pa.Array.from_buffers(pa.large_binary(), len(lengths), [None, pa.py_buffer(off.astype(np.int64)), pa.py_buffer(flat)])


def expand(start: np.ndarray, count: np.ndarray) -> np.ndarray:
    """start[i] .. start[i] + count[i] - 1 for every i, one after another."""
    total = int(count.sum())
    if not total:
        return np.empty(0, np.int64)
    first = np.cumsum(count) - count
    return np.repeat(start - first, count) + np.arange(total)


def runs_of(flag: np.ndarray, key: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Index and length of maximal runs of set flags with equal key and consecutive positions."""
    i = np.flatnonzero(flag)
    if not len(i):
        return i, i
    new = np.ones(len(i), bool)
    new[1:] = (i[1:] != i[:-1] + 1) | (key[i[1:]] != key[i[:-1]]) | (at[i[1:]] != at[i[:-1]] + 1)
    first = np.flatnonzero(new)
    return i[first], np.diff(np.concatenate([first, [len(i)]]))


def super_kmers(values: np.ndarray, first: np.ndarray, window: int, seed: int) -> tuple[np.ndarray, ...]:
    """Maximal runs of consecutive windows with one minimiser, in text order.

    ``values`` are hashed symbols (words or bytes) of some texts, ``first`` the first
    symbol of each text and, last, their number.  The minimiser of a window is the
    smallest hash of its ``seed``-symbol sequences.  Returns (text, first symbol within
    the text, windows, minimiser, twin): only a twin run, which holds its minimiser
    twice, can have two equal windows.
    """
    none = np.empty(0, np.int64)
    windows = np.maximum(0, np.diff(first) - window + 1)
    if not windows.sum():
        return none, none, none, none.astype(np.uint64), none.astype(bool)
    width, seeds = window - seed + 1, Spans(values).rolling(seed)
    least = sliding_min(seeds, width)
    change = np.ones(len(least), bool)
    change[1:] = least[1:] != least[:-1]
    some = np.flatnonzero(windows)
    change[first[some]] = True
    # windows that would cross into the next text are left out
    valid = np.zeros(len(least) + 1, np.int32)
    np.add.at(valid, first[some], 1)
    np.add.at(valid, first[some] + windows[some], -1)
    valid = np.cumsum(valid[:-1]) > 0
    edge = np.flatnonzero((change & valid)[:])
    text = np.searchsorted(first, edge, "right") - 1
    last = first[text] + windows[text]
    stop = np.minimum(np.concatenate([edge[1:], [len(least)]]), last)
    # seeds that are the least of some window; the places of one value in a run are neighbours among them
    around = np.concatenate([np.zeros(width - 1, np.uint64), least, np.zeros(width - 1, np.uint64)])
    chosen = np.flatnonzero(~sliding_min(~around, width) == seeds)
    pair = np.zeros(len(chosen) + 1, np.int64)
    np.cumsum((seeds[chosen[1:]] == seeds[chosen[:-1]]) & (np.diff(chosen) <= width), out=pair[1:len(chosen)])
    a, b = np.searchsorted(chosen, edge), np.searchsorted(chosen, stop + width - 1)
    twin = (b - a > 1) & (pair[np.maximum(b - 1, 0)] > pair[a])
    return text, edge - first[text], stop - edge, least[edge], twin
