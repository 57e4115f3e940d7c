"""External induced sorting: suffix arrays with common-prefix values.

The S*-substrings of a text are named by rank and the names sorted recursively; from
the order of the S*-suffixes the L-suffixes are induced in one ascending sweep and from
these the S-suffixes in one descending sweep.  The sweeps run over a monotone priority
queue of (symbol; position, common prefix): the priority is the first symbol, suffixes
of one symbol leave in the order in which they came.  The queue keeps a bounded number
of entries in memory and the rest in an unlinked file, and large arrays are mapped to
such files, so a shard may exceed memory; the files vanish with the task.

The common prefix of two neighbours in a bucket is one more than the least common
prefix swept between their successors; values are cut at ``cap``.
"""

from __future__ import annotations

import tempfile
from bisect import bisect_left

import numpy as np
import pyarrow as pa

from stayflow.llm.vec import _BYTES, PIECE, SECOND, Spans, buffers, expand, mix, runs_of

#: Queue entries kept in memory, and bytes above which an array goes to a file.
QUEUE_MEMORY = 4 << 20
ARRAY_MEMORY = 256 << 20
#: Symbols are swept in whole batches if a bucket has this many suffixes on average.
BATCH = 48
#: An alphabet of this size always is swept so.
SMALL = 512


def array(n: int, kind, limit: int = ARRAY_MEMORY) -> np.ndarray:
    """Zeros, in an unlinked file if they are larger than ``limit`` bytes."""
    if n * np.dtype(kind).itemsize <= limit:
        return np.zeros(n, kind)
    return np.memmap(tempfile.TemporaryFile(), kind, "w+", shape=(n,))


class SuffixQueue:
    """Suffix tuples (position, common prefix) by symbol, first in, first out per symbol.

    When more than ``memory`` entries are held, they are written to the file and only
    their places are kept.
    """

    def __init__(self, memory: int = QUEUE_MEMORY):
        self.memory, self.held, self.file = memory, 0, None
        self.parts: dict[int, list] = {}

    def push(self, symbol: int, pos: np.ndarray, lcp: np.ndarray) -> None:
        self.parts.setdefault(symbol, []).append((pos, lcp))
        self.held += len(pos)
        if self.held > self.memory:
            self._spill()

    def _spill(self) -> None:
        if self.file is None:
            self.file = tempfile.TemporaryFile()
        self.file.seek(0, 2)
        for symbol, parts in self.parts.items():
            loose = [p for p in parts if len(p) == 2]
            if loose:
                both = np.concatenate([np.concatenate([p[i] for p in loose]).astype(np.int64) for i in (0, 1)])
                at = self.file.tell()
                self.file.write(both.tobytes())
                self.parts[symbol] = [p for p in parts if len(p) == 3] + [(at, len(both) // 2, None)]
        self.held = 0

    def pop(self, symbol: int) -> tuple[np.ndarray, np.ndarray] | None:
        """All entries of a symbol so far, or None."""
        parts = self.parts.pop(symbol, None)
        if not parts:
            return None
        out = []
        for p in parts:  # spilled parts come first: they were pushed first
            if len(p) == 3:
                self.file.seek(p[0])
                both = np.frombuffer(self.file.read(16 * p[1]), np.int64)
                p = both[:p[1]], both[p[1]:]
            else:
                self.held -= len(p[0])
            out.append(p)
        return out[0] if len(out) == 1 else tuple(np.concatenate([p[i] for p in out]) for i in (0, 1))


def s_types(t: np.ndarray) -> np.ndarray:
    """Whether each suffix is smaller than the next one (the last symbol is the least: S)."""
    n = len(t)
    s = np.ones(n, bool)
    if n > 1:
        differs = np.flatnonzero(t[:-1] != t[1:])
        nxt = differs[np.minimum(np.searchsorted(differs, np.arange(n - 1)), len(differs) - 1)]
        s[:-1] = t[nxt] < t[nxt + 1]
    return s


def common(t: np.ndarray, a: int, b: int, cap: int) -> int:
    k = 0
    while k < cap and t[a + k] == t[b + k]:
        k += 1
    return k


def common_from(t: np.ndarray, a: np.ndarray, b: np.ndarray, base: np.ndarray, cap: int) -> np.ndarray:
    """Common prefixes of suffix pairs that are known to agree on ``base`` symbols; cut at ``cap``."""
    out = np.minimum(base, cap).astype(np.int64)
    live = np.flatnonzero(out < cap)
    while len(live):
        k = out[live]
        live = live[t[a[live] + k] == t[b[live] + k]]
        out[live] += 1
        live = live[out[live] < cap]
    return out


def name_substrings(t: np.ndarray, lms: np.ndarray) -> tuple[np.ndarray, int]:
    """Rank of the S*-substring at every S*-position (it ends with the first symbol of the next)."""
    end = np.minimum(np.concatenate([lms[1:] + 1, [len(t)]]), len(t))
    _, one, which = np.unique(Spans(mix(t.astype(np.uint64) + np.uint64(1)))(lms, end), return_index=True, return_inverse=True)
    # past its end a substring sorts above every symbol: there an L-suffix goes on in its extensions
    big = t.astype(">u4").tobytes()
    keys = [big[4 * a:4 * b] + b"\xff\xff\xff\xff" for a, b in zip(lms[one].tolist(), end[one].tolist(), strict=True)]
    rank = np.empty(len(one), np.int64)
    rank[np.array(sorted(range(len(keys)), key=keys.__getitem__))] = np.arange(len(keys))
    return rank[which], len(one)


class _Least:
    """Per target symbol the least common prefix swept since its last suffix came (batches)."""

    def __init__(self, symbols: int, cap: int):
        self.cap, self.low = cap, np.zeros(symbols, np.int64)

    def push(self, queue: SuffixQueue, lcp: np.ndarray, pos: np.ndarray, to: np.ndarray, at: np.ndarray) -> None:
        """``pos`` go to the symbols ``to``; they were induced by the swept entries ``at`` (of ``lcp``)."""
        order = np.argsort(to, kind="stable")
        sym = to[order]
        cuts = np.concatenate([[0], np.flatnonzero(sym[1:] != sym[:-1]) + 1, [len(sym)]]) if len(sym) else [0]
        after = np.minimum(self.low, lcp.min())
        for lo, hi in zip(cuts[:-1], cuts[1:], strict=True):
            g, c = order[lo:hi], int(sym[lo])
            starts = np.concatenate([[0], at[g] + 1])
            tail = starts[-1] < len(lcp)
            least = np.minimum.reduceat(lcp, starts if tail else starts[:-1])
            own = least[:len(g)].copy()
            own[0] = min(own[0], self.low[c])
            queue.push(c, pos[g], np.where(own < 0, 0, np.minimum(own + 1, self.cap)))
            after[c] = least[-1] if tail else self.cap
        self.low = after


def _sweep(t, s, symbols, up, seeds, cap, batches):
    """One induction sweep.

    ``seeds(symbol)`` gives the known suffixes of a bucket, in sweep order with the common
    prefix to the one swept before.  Returns per symbol the induced suffixes in sweep order
    with the same values, and per symbol the common prefix at the change from induced to known.
    A value of -1 (nothing came to a symbol yet) becomes 0.
    """
    queue = SuffixQueue()
    out_pos, out_lcp, change = {}, {}, {}
    least = _Least(int(symbols[-1]) + 1, cap) if batches else None
    if batches:
        least.low[:] = -1
    count, stack_at, stack_low, last = 0, [], [], {}

    def induce(c, pos, lcp, known):
        nonlocal count
        if batches:
            prev = np.where(pos > 0, t[pos - 1], 0).astype(np.int64)
            if up:
                at = np.flatnonzero((pos > 0) & ((prev > c) if known else (prev >= c)))
            else:
                at = np.flatnonzero((pos > 0) & ((prev < c) if known else (prev <= c)))
            least.push(queue, lcp, pos[at] - 1, prev[at], at)
            return
        new: dict[int, tuple[list, list]] = {}
        for p, v in zip(pos.tolist(), lcp.tolist(), strict=True):
            while stack_low and stack_low[-1] >= v:
                stack_low.pop()
                stack_at.pop()
            stack_low.append(v)
            stack_at.append(count)
            if p:
                b = int(t[p - 1])
                if (b > c or (b == c and not known)) if up else (b < c or (b == c and not known)):
                    was = last.get(b)
                    low = 0 if was is None else min(stack_low[bisect_left(stack_at, was + 1)] + 1, cap)
                    last[b] = count
                    to = new.get(b)
                    if to is None:
                        to = new[b] = ([], [])
                    to[0].append(p - 1)
                    to[1].append(low)
            count += 1
        for b, (ps, vs) in new.items():
            queue.push(b, np.array(ps, np.int64), np.array(vs, np.int64))

    for c in symbols.tolist() if up else symbols[::-1].tolist():
        ps, vs = [], []
        while (got := queue.pop(c)) is not None:
            pos, lcp = got
            if not ps:
                lcp = lcp.copy()
                lcp[0] = 0  # the bucket before has another first symbol
            ps.append(pos)
            vs.append(lcp)
            induce(c, pos, lcp, False)
        if ps:
            out_pos[c], out_lcp[c] = np.concatenate(ps), np.concatenate(vs)
        pos, lcp = seeds(c)
        if len(pos):
            lcp = lcp.copy()
            lcp[0] = change[c] = common(t, int(out_pos[c][-1]), int(pos[0]), cap) if ps else 0
            induce(c, pos, lcp, True)
    return out_pos, out_lcp, change


def suffix_array(t: np.ndarray, cap: int) -> tuple[np.ndarray, np.ndarray]:
    """Sorted suffixes of ``t`` and the common prefix (at most ``cap``) of each with the one before.

    The last symbol must be 0 and the only 0.
    """
    n = len(t)
    if n == 1:
        return np.zeros(1, np.int64), np.zeros(1, np.int64)
    s = s_types(t)
    lms = np.flatnonzero(s[1:] & ~s[:-1]) + 1
    names, distinct = name_substrings(t, lms)
    if distinct < len(lms):
        order, agree = suffix_array(names, cap)
        base = np.zeros(len(order), np.int64)
        base[1:] = lms[np.minimum(order[1:] + agree[1:], len(lms) - 1)] - lms[order[1:]]
    else:
        order = np.argsort(names, kind="stable")
        base = np.zeros(len(order), np.int64)
    star = lms[order]
    star_lcp = np.zeros(len(star), np.int64)
    star_lcp[1:] = common_from(t, star[:-1], star[1:], base[1:], cap)

    symbols = np.unique(t)
    batches = n >= BATCH * len(symbols) or len(symbols) <= SMALL
    lo, hi = np.searchsorted(t[star], symbols, "left"), np.searchsorted(t[star], symbols, "right")
    place = {int(c): (int(a), int(b)) for c, a, b in zip(symbols, lo, hi, strict=True)}

    def stars(c):
        a, b = place[c]
        return star[a:b], star_lcp[a:b]

    l_pos, l_lcp, _ = _sweep(t, s, symbols, True, stars, cap, batches)
    none = np.empty(0, np.int64)

    def ls(c):
        pos = l_pos.get(c, none)
        lcp = np.zeros(len(pos), np.int64)
        if len(pos) > 1:
            lcp[1:] = l_lcp[c][:0:-1]
        return pos[::-1], lcp

    s_pos, s_lcp, change = _sweep(t, s, symbols, False, ls, cap, batches)
    sa, lcp = array(n, np.int64), array(n, np.int64)
    sa[0], at = n - 1, 1
    for c in symbols[1:].tolist():
        p = l_pos.get(c, none)
        sa[at:at + len(p)] = p
        if len(p):
            lcp[at:at + len(p)] = l_lcp[c]
        at += len(p)
        q = s_pos.get(c, none)
        if len(q):
            sa[at:at + len(q)] = q[::-1]
            lcp[at] = change[c] if len(p) else 0
            lcp[at + 1:at + len(q)] = s_lcp[c][:0:-1]
        at += len(q)
    return sa, lcp


def _window_hashes(raw: np.ndarray, begin: np.ndarray, size: np.ndarray, windows: np.ndarray, window: int) -> np.ndarray:
    """Hash of every window of every string; string i is ``raw[begin[i]:begin[i] + size[i]]``."""
    out, done = array(int(windows.sum()), np.uint64), 0
    end, lo = begin + size, 0
    while lo < len(size):  # strings of about PIECE bytes at once
        hi = max(lo + 1, int(np.searchsorted(end, begin[lo] + PIECE, "right")))
        rolled = Spans(_BYTES[raw[begin[lo]:end[hi - 1]]], SECOND).rolling(window)
        some = rolled[expand(begin[lo:hi] - begin[lo], windows[lo:hi])]
        out[done:done + len(some)] = some
        done, lo = done + len(some), hi
    return out


def recurring(hashes: np.ndarray) -> np.ndarray:
    """Whether each value is there twice or more."""
    ordered = array(len(hashes), hashes.dtype)
    ordered[:] = hashes
    ordered.sort()
    twice = np.unique(ordered[1:][ordered[1:] == ordered[:-1]])
    if not len(twice):
        return np.zeros(len(hashes), bool)
    return twice[np.minimum(np.searchsorted(twice, hashes), len(twice) - 1)] == hashes


class Shard:
    """Strings of a shard, spooled to an unlinked file, with the place of each."""

    def __init__(self):
        self.file = tempfile.TemporaryFile()
        self.size, self.cols = [], []

    def add(self, strings: pa.Array, windows, key, tie, start) -> None:
        raw, off = buffers(strings)
        self.file.write(raw)
        self.size.append(np.diff(off))
        self.cols.append((windows, key, tie, start))

    def repeated(self, window: int) -> tuple[np.ndarray, ...]:
        """(flags, string of each window, window number, key, tie, start): a flag says that the
        window, of ``window`` bytes, equals one that starts earlier by (key, tie, start, number).

        Windows whose 64-bit hash no other window of the shard has are left out: they equal
        none.  The suffix order decides about all others.
        """
        size = np.concatenate(self.size)
        windows, key, tie, start = (np.concatenate([c[i] for c in self.cols]).astype(np.int64) for i in range(4))
        self.file.flush()
        raw = np.memmap(self.file, np.uint8, "r") if size.sum() else np.empty(0, np.uint8)
        begin = np.cumsum(size) - size
        # only the stretches of windows that may have an equal one are sorted
        of, offset = np.repeat(np.arange(len(size)), windows), expand(np.zeros(len(size), np.int64), windows)
        i, windows = runs_of(recurring(_window_hashes(raw, begin, size, windows, window)), of, offset)
        of, offset = of[i], offset[i]
        begin, key, tie, start = begin[of] + offset, key[of], tie[of], start[of] + offset
        size = windows + window - 1
        if not len(size):
            none = np.empty(0, np.int64)
            return none.astype(bool), none, none, key, tie, start
        t = array(int(size.sum()) + len(size) + 1, np.uint16)
        first = np.cumsum(size + 1) - size - 1
        for lo in range(0, len(size), 4096):  # symbols are bytes + 2; 1 ends a string, the closing 0 stays
            part, a = size[lo:lo + 4096], first[lo]
            x = np.ones(int(part.sum()) + len(part), np.uint16)
            inside = np.ones(len(x), bool)
            inside[np.cumsum(part + 1) - 1] = False
            x[inside] = raw[expand(begin[lo:lo + 4096], part)].astype(np.uint16) + 2
            t[a:a + len(x)] = x
        sa, lcp = suffix_array(t, window)
        place = np.lexsort((start, tie, key))
        rank = np.empty(len(size), np.int64)
        rank[place] = np.arange(len(size))
        of = np.repeat(np.arange(len(size)), windows)
        offset = expand(np.zeros(len(size), np.int64), windows)
        number = np.full(len(t), -1, np.int64)
        number[first[of] + offset] = np.arange(len(of))
        w, group = number[sa], np.cumsum(lcp < window)  # equal windows are neighbours
        live = w >= 0
        w, group = w[live], group[live]
        head = np.lexsort((offset[w], rank[of[w]], group))
        again = np.zeros(len(w), bool)
        again[1:] = group[head[1:]] == group[head[:-1]]
        out = np.zeros(len(of), bool)
        out[w[head]] = again
        return out, of, offset, key, tie, start
