"""Regression trees, forests and boosting on a binned matrix that all folds share.

* **Matrix.**  Each row carries one byte per feature, the rank of its value among at most
  256 values of the training rows (all of them where a feature has few, else quantiles).
  It is written once; folds and bootstrap samples are weights, not copies.
* **Growth.**  Trees grow level by level and without a depth bound of the library.  While a
  node has more than ``finish_rows`` rows, its statistics come from one aggregate per
  level over all rows, for every node, tree and fold at once.  A node with fewer rows is
  sent whole to one task, which grows the rest of it by the same rule.  Which bound is
  taken changes no tree: labels are summed as integers, and every random choice is a hash
  of the row or of the node's path, so trees depend neither on the partitioning nor on it.
* **Fits.**  Fit ``f`` learns from the rows whose fold is neither ``f`` nor ``HELD_OUT`` and
  predicts those of fold ``f``, in the task that has them anyway.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator, Mapping, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stayflow.session import discard, materialize

cloudpickle.register_pickle_by_value(sys.modules[__name__])  # tasks need no copy of this library

#: Fold of rows that no fit learns from, and fit that predicts them.
HELD_OUT = -1
#: Values of a feature that splits can lie between.
VALUES = 256
#: Labels are summed as integers of 1 / SCALE.
SCALE = 1 << 24
#: Rows of a node that one task takes over.
FINISH_ROWS = 1 << 20
#: Share of a node's sum of squares up to which a gain is rounding.
NOTHING = 1e-11
#: Rows from which a node's counts are kept for its children, at least.
SHARED_ROWS = 256
#: Rows a node from which nodes' rows are copied by slices, on average.
SLICED_ROWS = 200
#: Tasks that the trees of a forest are dealt to when one task can hold all rows.
TREE_TASKS = 64
#: Bytes of statistics that a task holds in one pass over the rows.
PASS_BYTES = 1 << 26
#: Rounds of boosting between two writes of the predictions so far, and where the rows are read in every level.
KEEP_ROUNDS, KEEP_PASSES = 25, 5
#: Depth up to which boosted trees of many rows are grown by passes over them only.
PASS_DEPTH = 8
#: Rows that are packed together.
BLOCK_ROWS = 1 << 14
MATRIX = "row long, fold int, y double, x binary"


@dataclass(frozen=True)
class Growth:
    """How a tree grows.  ``features`` 0 looks at all of them in every node."""
    max_depth: int | None = None
    min_split: int = 2
    min_leaf: int = 1
    features: int = 0
    bootstrap: bool = False
    sample: float = 1.0
    random_split: bool = False


def subset(name: str, p: int) -> int:
    return max(1, int(p ** 0.5)) if name == "sqrt" else 0


# ------------------------------------------------------------------ matrix

def feature_values(df: DataFrame, features: Sequence[str], limit: int = VALUES) -> list[np.ndarray]:
    """Sorted values of each feature between which splits can lie: all of them where there are few, else
    quantiles.  Two aggregates for all features."""
    q = [F.col(f"`{c}`").cast("double") for c in features]
    about = df.agg(*[F.approx_count_distinct(c).alias(f"c{i}") for i, c in enumerate(q)]).first()
    shares = F.array(*[F.lit((k + 1) / limit) for k in range(limit)])
    few = limit * 3 // 4  # an estimate under this has fewer values than the limit
    row = df.agg(*[(F.sort_array(F.collect_set(c)) if about[i] <= few else F.percentile_approx(c, shares, 1 << 14)).alias(f"v{i}")
                   for i, c in enumerate(q)]).first()
    out = []
    for v in row:
        v = np.unique(np.array(v or [0.0], np.float64))
        out.append(v if len(v) <= limit else v[np.unique(np.linspace(0, len(v) - 1, limit).astype(int))])
    return out


def binned(df: DataFrame, values: Sequence[np.ndarray], features: Sequence[str], key: str, fold: str, label: str) -> DataFrame:
    """The matrix: row, fold, label, and the rank of every feature's value (those above the last have the last rank)."""
    cols = df.select(F.col(key).cast("long").alias("row"), F.col(fold).cast("int").alias("fold"), F.col(label).cast("double").alias("y"),
                     *[F.col(f"`{c}`").cast("double").alias(f"f{i}") for i, c in enumerate(features)])

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            x = np.empty((b.num_rows, len(values)), np.uint8)
            for i, v in enumerate(values):
                x[:, i] = np.minimum(np.searchsorted(v, b.column(3 + i).to_numpy(zero_copy_only=False)), len(v) - 1)
            yield pa.record_batch([*b.columns[:3], pa.array([r.tobytes() for r in x], pa.binary())], ["row", "fold", "y", "x"])

    return materialize(cols.mapInArrow(task, MATRIX))


# ------------------------------------------------------------------ chance: hashes of 32 bits

def mixed(x: np.ndarray) -> np.ndarray:
    """A hash of 32-bit numbers (held in 64 bits)."""
    shape = np.shape(x)
    x = np.atleast_1d(np.asarray(x, np.uint64)).astype(np.uint32)  # products of arrays wrap at 2 ** 32
    for _ in range(2):
        x ^= x >> np.uint32(16)
        x *= np.uint32(0x45D9F3B)
    x ^= x >> np.uint32(16)
    return x.astype(np.uint64).reshape(shape)


def drawn(a, b, c=0) -> np.ndarray:
    """Uniform 32-bit number of two or three numbers."""
    return mixed(mixed(mixed(a) + np.asarray(b, np.uint64)) + np.asarray(c, np.uint64))


def poisson_bounds() -> np.ndarray:
    """32-bit numbers from which a Poisson count of mean 1 is 1, 2, ..."""
    steps = np.cumsum(np.exp(-1.0) / np.cumprod([1, *range(1, 13)]))
    return np.floor(steps * 2.0 ** 32).astype(np.uint64)


def weights(rows: np.ndarray, tree: int, g: Growth) -> np.ndarray:
    """How often a tree sees each row: Poisson counts, a share of the rows, or once."""
    if not g.bootstrap and g.sample >= 1:
        return np.ones(len(rows), np.int64)
    u = drawn(np.asarray(rows).astype(np.uint64), (tree + 1) * 2654435761 % 2 ** 32)
    if g.bootstrap:
        return np.searchsorted(poisson_bounds(), u, "right").astype(np.int64)
    return (u < np.uint64(int(g.sample * 2 ** 32))).astype(np.int64)


def root_path(tree: int) -> int:
    return int(mixed(tree + 17))


def child_paths(paths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    return drawn(paths, 1), drawn(paths, 2)


def draw_features(order: np.ndarray, paths: np.ndarray, lo: int, hi: int) -> None:
    """Every node draws the features at places ``lo`` to ``hi`` of its own order, in place."""
    nodes, p = order.shape
    k = np.arange(nodes)
    for j in range(lo, min(hi, p)):
        other = j + (drawn(paths, j, 3) % np.uint64(p - j)).astype(np.int64)
        order[k, j], order[k, other] = order[k, other], order[k, j].copy()


# ------------------------------------------------------------------ splits

def _begins(x: np.ndarray) -> np.ndarray:
    """Whether each value of a sorted array that is not empty is the first of its kind."""
    out = np.ones(len(x), bool)
    np.not_equal(x[1:], x[:-1], out=out[1:])
    return out


def gains(lw: np.ndarray, ls: np.ndarray, tw: np.ndarray, ts: np.ndarray) -> np.ndarray:
    """Fall of the squared error by splits, from weights and sums on the left and of all."""
    ls, rs, ts = ls.astype(np.float64), (ts - ls).astype(np.float64), ts.astype(np.float64)
    return ls * ls / lw + rs * rs / (tw - lw) - ts * ts / tw


def best_splits(entries: tuple, feat: np.ndarray, totals: tuple, paths: np.ndarray, values: Sequence[np.ndarray], g: Growth) -> tuple:
    """Best split of each node from entries (segment, code, rows, weight, sum) sorted by segment and code.

    Segment k * m + j is feature ``feat[k, j]`` in node k.  A split puts codes up to one of
    them left; the gain is the fall of the squared error, and of equal gains the first
    segment and code win.  With ``random_split`` each segment has one threshold, drawn
    evenly between its least and greatest value.  Returns (gain, feature, code), feature -1
    where no split leaves enough rows on both sides.
    """
    seg, code, n, w, s = entries
    nodes, m = feat.shape
    gain, feature, at = np.zeros(nodes), np.full(nodes, -1), np.zeros(nodes, np.int64)
    if not len(seg):
        return gain, feature, at
    begins = _begins(seg)
    first = np.flatnonzero(begins)
    cand = np.flatnonzero((code[1:] != code[:-1]) & ~begins[1:])
    if not len(cand):
        return gain, feature, at
    if g.random_split:
        size = np.diff(first, append=len(seg))
        table = np.concatenate([v for v in values])
        of = np.concatenate([[0], np.cumsum([len(v) for v in values])])[feat.ravel()[seg]]
        value = table[of + code]
        last = first + size - 1
        which = feat.ravel()[seg[first]]
        u = drawn(paths[seg[first] // m], which, 5) / 2.0 ** 32
        bound = np.repeat(value[first] + u * (value[last] - value[first]), size)
        cand = cand[(value[cand] <= bound[cand]) & (value[cand + 1] > bound[cand])]
    node = seg[cand] // m
    begun = np.zeros(nodes * m, np.int64)

    def up_to(x):  # sums up to each candidate, less those before its segment
        c = np.cumsum(x)
        begun[seg[first]] = c[first] - x[first]
        return c[cand] - begun[seg[cand]]

    ln, ls = up_to(n), up_to(s)
    lw = ln if w is n else up_to(w)
    tn, tw, ts = (t[node] for t in totals)
    ok = (ln >= g.min_leaf) & (tn - ln >= g.min_leaf)
    cand, node, lw, ls, tw, ts = (x[ok] for x in (cand, node, lw, ls, tw, ts))
    if not len(cand):
        return gain, feature, at
    more = gains(lw, ls, tw, ts)
    begin = np.flatnonzero(_begins(node))
    top = np.maximum.reduceat(more, begin)
    hit = np.flatnonzero(more == np.repeat(top, np.diff(begin, append=len(node))))
    hit = hit[_begins(node[hit])]
    k = node[hit]
    gain[k], feature[k], at[k] = more[hit], feat.ravel()[seg[cand[hit]]], code[cand[hit]]
    return gain, feature, at


def level_splits(gather, paths: np.ndarray, totals: tuple, squares: np.ndarray, p: int, values, g: Growth) -> tuple:
    """Splits of all nodes of a level; ``gather(nodes, feat)(j)`` gives the entries of some nodes for the ``j``-th of their features.

    A node that no feature of its subset can split looks at the next ones in its order.
    """
    count = len(paths)
    gain, feature, code = np.zeros(count), np.full(count, -1), np.zeros(count, np.int64)
    m = g.features or p
    order = np.tile(np.arange(p, dtype=np.int16), (count, 1))
    for lo in range(0, p, m):
        todo = np.flatnonzero(feature < 0)
        if not len(todo):
            break
        if m < p:
            drawn_now = order[todo]
            draw_features(drawn_now, paths[todo], lo, lo + m)
            order[todo] = drawn_now
        feat = np.sort(order[todo, lo:lo + m], axis=1)
        own, looked, entries = tuple(t[todo] for t in totals), paths[todo], gather(todo, feat)
        for j in range(feat.shape[1]):  # columns stay in the processor's cache; of equal gains the first feature wins
            got = best_splits(entries(j), feat[:, j:j + 1], own, looked, values, g)
            better = np.flatnonzero((got[1] >= 0) & ((feature[todo] < 0) | (got[0] > gain[todo])))
            at = todo[better]
            gain[at], feature[at], code[at] = (v[better] for v in got)
    feature[gain <= NOTHING * squares] = -1  # nothing left to gain but rounding
    return gain, feature, code


# ------------------------------------------------------------------ a subtree in one task

NODE = [("feature", "<i2"), ("code", "u1"), ("depth", "<i2"), ("left", "<i4"), ("rows", "<i8"), ("weight", "<i8"), ("gain", "<f8"), ("value", "<f8")]


def leaf_rows(count: int) -> np.ndarray:
    out = np.zeros(count, NODE)
    out["feature"], out["left"] = -1, -1
    return out


class _Tally:
    """Exact sums over rows by group: rows, weights and weighted labels, all integers."""

    def __init__(self, w: np.ndarray, sw: np.ndarray) -> None:
        self.weighted = bool((w[w > 0] != 1).any())
        self.together = int(w.sum()) < 1 << 26  # rows and weights fit one number below 2 ** 53
        self.counted = (w << 26 | 1 if self.together else w).astype(np.float64) if self.weighted else None
        self.parts = [sw.astype(np.float64)]
        if float(np.abs(self.parts[0]).sum()) >= 2.0 ** 53:
            self.parts = [(sw >> 26).astype(np.float64), (sw & ((1 << 26) - 1)).astype(np.float64)]

    def of(self, rows: np.ndarray) -> tuple:
        """What ``by`` adds up for ``rows``."""
        return self.counted.take(rows) if self.weighted else None, [v.take(rows) for v in self.parts]

    def by(self, group: np.ndarray, held: tuple, groups: int) -> tuple:
        """(rows, weight, sum) of every group; the first two are one array where all weights are 1."""
        counted, parts = held
        s = [np.bincount(group, v, groups).astype(np.int64) for v in parts]
        s = s[0] if len(s) == 1 else (s[0] << 26) + s[1]
        if counted is None:
            n = w = np.bincount(group, minlength=groups)
        elif self.together:
            both = np.bincount(group, counted, groups).astype(np.int64)
            n, w = both & ((1 << 26) - 1), both >> 26
        else:
            n, w = np.bincount(group, minlength=groups), np.bincount(group, counted, groups).astype(np.int64)
        return n, w, s

    def sums(self, rows: np.ndarray, add, counted: np.ndarray | None, parts: Sequence[np.ndarray]) -> tuple:
        """(rows, weight, sum) of groups of ``rows`` rows; ``add`` gives the sums of a column by group."""
        s = [add(v).astype(np.int64) for v in parts]
        w = rows if counted is None else add(counted).astype(np.int64) >> (26 if self.together else 0)
        return rows, w, s[0] if len(s) == 1 else (s[0] << 26) + s[1]

    def each(self, held: tuple, rows: int) -> tuple:
        """(rows, weight, sum) of every row by itself; weights are None where all are 1."""
        counted, parts = held
        s = [v.astype(np.int64) for v in parts]
        w = None if counted is None else counted.astype(np.int64) >> 26 if self.together else counted.astype(np.int64)
        return np.ones(rows, np.int64), w, s[0] if len(s) == 1 else (s[0] << 26) + s[1]


def _filled(cells: Sequence[np.ndarray], nodes: int) -> tuple:
    """Entries of the cells (node by code) that have rows."""
    n, w, s = (c.ravel() for c in cells)
    full = np.flatnonzero(n)
    seg, code = np.divmod(full, len(n) // nodes)
    few = n[full]
    return seg, code, few, few if cells[1] is cells[0] else w[full], s[full]


def _listed(seg: np.ndarray, code: np.ndarray, n: np.ndarray, w: np.ndarray | None, s: np.ndarray) -> tuple:
    """Entries in order of segment and code, from any order; without ``w`` weights are rows."""
    bits = max(1, len(seg).bit_length())
    keys = np.sort((seg.astype(np.int64) << 8 | code) << bits | np.arange(len(seg)))
    order = keys & ((1 << bits) - 1)
    keys >>= bits
    n = n[order]
    return keys >> 8, keys & 255, n, n if w is None else w[order], s[order]


def _among(rare: Sequence[tuple | None], height: int, rows: np.ndarray) -> list[tuple | None]:
    """``rare`` of ``rows`` alone (ascending), by their places."""
    place = np.full(height, -1)
    place[rows] = np.arange(len(rows))
    out: list[tuple | None] = []
    for held in rare:
        if held is not None:
            at = place.take(held[0])
            keep = np.flatnonzero(at >= 0)
            held = at[keep], held[1][keep]
        out.append(held)
    return out


class Codes:
    """Codes of a task's rows by column, and where nodes look at all features the rows of each feature that lack its commonest code.

    Flags and levels have one code in most rows, so only the others are counted: what is left of a node's totals has
    the commonest code.  ``rare`` are places and codes, None where they are more than half of the rows.
    Where nodes look at a subset, features of two codes are kept as bits of ``words``, too.
    """

    def __init__(self, x: np.ndarray, g: Growth, bits: bool | None = None) -> None:
        bits = 0 < g.features < x.shape[1] if bits is None else bits
        self.columns = np.ascontiguousarray(x.T)
        self.common: list[int] = []
        self.rare: list[tuple | None] = []
        self.flags: dict[int, tuple] = {}  # of features with codes 0 and 1 only: word, bit, rarer code
        self.words: list[np.ndarray] = []  # 64 of those features in a number
        for f in np.flatnonzero(self.columns.max(1, initial=0) <= 1).tolist() if bits else ():
            word, bit = divmod(len(self.flags), 64)
            if not bit:
                self.words.append(np.zeros(len(x), np.uint64))
            self.flags[f] = word, bit, int(2 * np.count_nonzero(self.columns[f]) <= len(x))
            self.words[word].view(np.uint8)[bit // 8::8] |= self.columns[f] << np.uint8(bit % 8)
        for c in () if bits else self.columns:
            self.common.append(int(np.bincount(c, minlength=1).argmax()))
            at = np.flatnonzero(c != self.common[-1])
            self.rare.append(None if 2 * len(at) > len(c) else (at, c[at]))


def _steps(x: np.ndarray) -> np.ndarray:
    """Each value less the one before it, the first less 0."""
    out = x.copy()
    out[1:] -= x[:-1]
    return out


def _run(x: np.ndarray) -> np.ndarray:
    """Sums of the first 0, 1, ... values."""
    out = np.zeros(len(x) + 1, x.dtype)
    np.cumsum(x, out=out[1:])
    return out


class _Held:
    """Rows of the nodes of a level, node by node, with their labels, weights and flags."""

    def __init__(self, rows: np.ndarray, start: np.ndarray, size: np.ndarray, counted, parts, square, words, tally: _Tally) -> None:
        self.rows, self.start, self.size, self.tally = rows, start, size, tally
        self.counted, self.parts, self.square, self.words = counted, parts, square, words
        self.order = np.argsort(start)  # nodes by their rows
        self.totals = tuple(map(self.by_node, tally.sums(size[self.order], self.added, counted, parts)))

    def added(self, x: np.ndarray) -> np.ndarray:
        """Sums of a column by node, in order of the rows."""
        return np.add.reduceat(x, self.start[self.order]) if len(x) else np.zeros(1)

    def by_node(self, x: np.ndarray) -> np.ndarray:
        out = np.empty_like(x)
        out[self.order] = x
        return out

    def next(self, rows: np.ndarray, start: np.ndarray, size: np.ndarray) -> _Held:
        """The nodes below, whose rows are at places ``rows``."""
        def take(x):
            return x.take(rows, mode="clip")

        return _Held(take(self.rows), start, size, None if self.counted is None else take(self.counted), [take(v) for v in self.parts],
                     take(self.square), [take(v) for v in self.words], self.tally)

    def of(self, nodes: np.ndarray) -> tuple:
        """(sizes, pick, shift): the rows of some nodes; ``pick(x)`` gives their values of a column over all rows of the level
        (``pick(x, byte)`` one byte of them), ``shift`` is how far each node's are from their place in it."""
        start, size = self.start[nodes], self.size[nodes]
        total, shift = int(size.sum()), start - (np.cumsum(size) - size)
        if total > SLICED_ROWS * len(nodes):  # neighbours are copied faster than looked up
            pieces = [slice(a, a + n) for a, n in zip(start.tolist(), size.tolist(), strict=True)]

            def copied(x, byte=None):
                x = x if byte is None else x.view(np.uint8)[byte::x.itemsize]
                return x[pieces[0]] if len(pieces) == 1 else np.concatenate([x[k] for k in pieces])

            return size, copied, shift
        place = np.repeat(shift, size)
        place += np.arange(total)

        def looked_up(x, byte=None):
            x = x.take(place, mode="clip")
            return x if byte is None else x.view(np.uint8)[byte::x.itemsize]

        return size, looked_up, shift

    def two_codes(self, flag: tuple, nodes: np.ndarray) -> tuple:
        """(rows, weights, sums) with code 0 of a flag: only rows with its rarer code are looked up."""
        size, pick, shift = self.of(nodes)
        word, bit, rare = flag
        code = pick(self.words[word], bit // 8) & np.uint8(1 << bit % 8)
        hit = np.flatnonzero(code != 0 if rare else code == 0)
        ends = np.searchsorted(hit, np.cumsum(size))
        n = _steps(ends)
        hit += np.repeat(shift, n)
        left = self.tally.sums(n, lambda v: _steps(_run(v.take(hit))[ends]), self.counted, self.parts)
        return tuple(t[nodes] - v for t, v in zip(self.totals, left, strict=True)) if rare else left

    def entries(self, column: np.ndarray, width: int, nodes: np.ndarray) -> tuple:
        """Entries of :func:`best_splits` for one feature of some nodes."""
        size, pick, _ = self.of(nodes)
        code, cells = column.take(pick(self.rows), mode="clip"), len(nodes) * width
        if cells > 2 * len(code):  # fewer rows to sort than cells
            n, w, s = self.tally.each((None if self.counted is None else pick(self.counted), [pick(v) for v in self.parts]), len(code))
            return _listed(np.repeat(np.arange(len(nodes)), size), code, n, w, s)
        at = np.repeat(np.arange(0, cells, width), size)
        at += code
        n, w, s = self.tally.by(at, (None if self.counted is None else pick(self.counted), [pick(v) for v in self.parts]), cells)
        full = np.flatnonzero(n)
        seg = np.repeat(np.arange(len(nodes)), width)[full]
        few = n[full]
        return seg, full - seg * width, few, few if w is n else w[full], s[full]


def _drawn_bound(paths: np.ndarray, feature: int, low: float, high: float) -> np.ndarray:
    """Threshold of an extra tree's nodes between two values of a feature."""
    return low + drawn(paths, feature, 5) / 2.0 ** 32 * (high - low)


def first_best(who: np.ndarray, feat: np.ndarray, more: np.ndarray) -> np.ndarray:
    """Of pairs of a node and a feature, those with each node's largest gain; of equal gains the first feature wins."""
    best = np.lexsort((feat, -more, who))
    return best[_begins(who[best])] if len(best) else best


def subset_splits(held: _Held, codes: Codes, nodes: np.ndarray, paths: np.ndarray, squares: np.ndarray, values, g: Growth) -> tuple:
    """:func:`level_splits` of some nodes that look at a subset of the features: (gain, feature, code).

    Feature by feature, for all nodes that look at it, so that one column is read at a time.
    """
    count, p, m = len(nodes), len(values), g.features
    gain, feature, code = np.zeros(count), np.full(count, -1), np.zeros(count, np.int64)
    order = np.tile(np.arange(p, dtype=np.int16), (count, 1))
    for lo in range(0, p, m):
        todo = np.flatnonzero(feature < 0)
        if not len(todo):
            break
        drawn_now = order[todo]
        draw_features(drawn_now, paths[todo], lo, lo + m)
        order[todo] = drawn_now
        feat = drawn_now[:, lo:lo + m]
        who, feat = np.repeat(todo, feat.shape[1]), feat.ravel()  # pairs of a node and a feature
        by = np.argsort(feat, kind="stable")
        who, feat = who[by], feat[by].astype(np.int64)
        more, at, valid = np.zeros(len(who)), np.zeros(len(who), np.int64), np.zeros(len(who), bool)
        begin = np.flatnonzero(_begins(feat))
        lists: list = []
        twos: list = []
        for a, b in zip(begin.tolist(), [*begin[1:].tolist(), len(feat)], strict=True):
            f = int(feat[a])
            if len(values[f]) == 2:
                twos.append((a, b, held.two_codes(codes.flags[f], nodes[who[a:b]])))
            elif len(values[f]) > 2:
                seg, *rest = held.entries(codes.columns[f], len(values[f]), nodes[who[a:b]])
                lists.append((seg + a, *rest))
        if twos:
            of = np.concatenate([np.arange(a, b) for a, b, _ in twos])
            ln, lw, ls = (np.concatenate([left[i] for _, _, left in twos]) for i in range(3))
            tn, tw, ts = (t[nodes[who[of]]] for t in held.totals)
            ok = (ln >= max(g.min_leaf, 1)) & (tn - ln >= max(g.min_leaf, 1))
            if g.random_split:
                low, high = (np.array([v[i] if len(v) == 2 else 0.0 for v in values])[feat[of]] for i in (0, 1))
                bound = _drawn_bound(paths[who[of]], feat[of], low, high)
                ok &= (low <= bound) & (high > bound)
            of, lw, ls, tw, ts = (v[ok] for v in (of, lw, ls, tw, ts))
            more[of], valid[of] = gains(lw, ls, tw, ts), True
        if lists:
            entries = [np.concatenate([e[i] for e in lists]) for i in (0, 1, 2, 4)]
            n = entries[2]
            w = n if all(e[3] is e[2] for e in lists) else np.concatenate([e[3] for e in lists])
            got = best_splits((*entries[:2], n, w, entries[3]), feat[:, None], tuple(t[nodes[who]] for t in held.totals), paths[who], values, g)
            found = np.flatnonzero(got[1] >= 0)
            more[found], at[found], valid[found] = got[0][found], got[2][found], True
        who, feat, more, at = (v[valid] for v in (who, feat, more, at))
        best = first_best(who, feat, more)
        gain[who[best]], feature[who[best]], code[who[best]] = more[best], feat[best], at[best]
    feature[gain <= NOTHING * squares] = -1  # nothing left to gain but rounding
    return gain, feature, code


def grown_on_subsets(codes: Codes, y: np.ndarray, w: np.ndarray, path: int, depth: int, values: Sequence[np.ndarray], g: Growth,
                     ends: np.ndarray | None = None) -> np.ndarray:
    """:func:`grown` where nodes look at a subset of the features: the rows are kept node by node."""
    flat, height = codes.columns.ravel(), len(y)
    label = w * y
    tally, rows = _Tally(w, label), np.flatnonzero(w > 0)
    if len(rows) == height:
        pick = lambda x: x
    else:
        pick = lambda x: x.take(rows)
    held = _Held(rows, np.zeros(1, np.int64), np.array([len(rows)]), tally.counted if tally.counted is None else pick(tally.counted), [pick(v) for v in tally.parts],
                 pick(label.astype(np.float64) * y), [pick(v) for v in codes.words], tally)
    paths, out, made = np.array([path], np.uint64), [], 1
    while True:
        k = len(paths)
        totals = held.totals
        table = leaf_rows(k)
        table["rows"], table["weight"], table["depth"] = totals[0], totals[1], depth
        mean = totals[2] / np.maximum(totals[1], 1)
        table["value"] = mean / SCALE
        out.append(table)
        open_ = totals[0] >= max(g.min_split, 2)
        if g.max_depth is not None and depth >= g.max_depth:
            open_[:] = False
        if open_.any():
            squares = held.by_node(held.added(held.square))
            open_ &= squares - mean * totals[2] > NOTHING / 2 * squares  # one label: no split can gain
        gain, feature, code = np.zeros(k), np.full(k, -1), np.zeros(k, np.int64)
        own = np.flatnonzero(open_)
        if len(own):
            gain[own], feature[own], code[own] = subset_splits(held, codes, own, paths[own], squares[own], values, g)
        split = np.flatnonzero(feature >= 0)
        table["feature"][split], table["code"][split], table["gain"][split] = feature[split], code[split], gain[split] / SCALE ** 2
        table["left"][split] = made + 2 * np.arange(len(split))
        stop = np.flatnonzero(feature < 0)
        if ends is not None and len(stop):
            size, pick, _ = held.of(stop)
            ends[pick(held.rows)] = np.repeat(made - k + stop, size)
        if not len(split):
            return np.concatenate(out)
        order = split[np.argsort(held.start[split])]
        size, pick, shift = held.of(order)
        place = np.repeat((feature * height)[order], size)
        place += pick(held.rows)
        right = flat.take(place, mode="clip") > np.repeat(code.astype(np.uint8)[order], size)
        sides = np.flatnonzero(~right), np.flatnonzero(right)  # all left children, then all right ones, in the order of their parents
        upto = [np.searchsorted(side, np.cumsum(size)) for side in sides]
        place = np.concatenate(sides)
        if len(stop):
            place += np.repeat(np.concatenate([shift, shift]), np.concatenate([_steps(n) for n in upto]))
        start, size = np.empty((2, k, 2), np.int64)
        for side, begin in ((0, 0), (1, len(sides[0]))):
            size[order, side] = _steps(upto[side])
            start[order, side] = begin + upto[side] - size[order, side]
        held = held.next(place, start[split].ravel(), size[split].ravel())
        paths = np.stack(child_paths(paths[split]), 1).ravel()
        made += 2 * len(split)
        depth += 1


def grown(x: np.ndarray | Codes, y: np.ndarray, w: np.ndarray, path: int, depth: int, values: Sequence[np.ndarray], g: Growth,
          ends: np.ndarray | None = None) -> np.ndarray:
    """Nodes (``NODE``) of the subtree over rows with codes ``x``, integer labels ``y`` and weights ``w``,
    level by level; ``left`` is the place of the left child, the right one follows it.

    Where every node looks at all features, the counts of a larger child are those of its parent less
    those of its sibling, so only rows of smaller children are counted while nodes are large.
    ``ends`` is given the place of the leaf of every row with a weight.
    """
    codes = x if isinstance(x, Codes) else Codes(x, g)
    columns, common, p = codes.columns, codes.common, len(codes.columns)
    if 0 < g.features < p:
        return grown_on_subsets(codes, y, w, path, depth, values, g, ends)
    flat, height = columns.ravel(), len(y)
    base = np.flatnonzero(w > 0)  # rows by their places in what follows
    w = w[base]
    label = w * y[base]
    square = label.astype(np.float64) * y[base]
    tally, rare = _Tally(w, label), _among(codes.rare, height, base) if len(base) < height else codes.rare
    here = np.arange(len(base))  # places of the rows of the level's nodes
    node, paths = np.zeros(len(base), np.int64), np.array([path], np.uint64)
    out, made = [leaf_rows(1)], 1  # places of the level's nodes
    sizes = np.array([len(v) for v in values])
    keep_rows = max(SHARED_ROWS, int(sizes.sum()) // 4)  # so what is kept has at most four cells a row
    parent, kept = np.full(1, -1), None  # place of each node's parent in ``kept``, the cells of each feature
    while True:
        k = len(paths)
        if 2 * len(here) < len(base):
            rare, base = _among(rare, len(base), here), base[here]
            w, label, square = w[here], label[here], square[here]
            tally, here = _Tally(w, label), np.arange(len(here))
        totals = tally.by(node, tally.of(here), k)
        count = totals[0]
        table = leaf_rows(k)
        table["rows"], table["weight"], table["depth"] = count, totals[1], depth
        table["value"] = totals[2] / np.maximum(totals[1], 1) / SCALE
        squares = np.bincount(node, weights=square[here], minlength=k)
        open_ = count >= max(g.min_split, 2)
        mean = totals[2] / np.maximum(totals[1], 1)
        open_ &= squares - mean * totals[2] > NOTHING / 2 * squares  # one label: no split can gain
        if g.max_depth is not None and depth >= g.max_depth:
            open_[:] = False
        gain, feature, code = np.zeros(k), np.full(k, -1), np.zeros(k, np.int64)
        last = g.max_depth is not None and depth + 1 >= g.max_depth
        large = open_ & ((parent >= 0) | (k == 1))
        cells: list = []  # of each feature, for the large nodes
        node_of = np.full(len(base), k)
        if open_.any():
            node_of[here] = node

        def counted(f, slots, use, rare=rare, base=base):
            """(places, slots, codes) of the rows of feature ``f`` that are counted, and whether those with its commonest code are left
            out.  ``slots`` are those of all rows (-1: none), ``use`` the rows that have one."""
            held = rare[f]
            if held is None or 2 * len(use) < len(held[0]):
                return use, slots[use], columns[f][base[use]], False
            at = slots.take(held[0])
            hit = np.flatnonzero(at >= 0)
            return (held[0], at, held[1], True) if len(hit) == len(at) else (held[0][hit], at[hit], held[1][hit], True)

        def cells_of(f, rows, at, code, less, whole, tally=tally):
            """Cells (slot by code) of ``counted`` rows; ``whole`` are the totals of the slots."""
            width = int(sizes[f])
            got = list(tally.by(at * width + code, tally.of(rows), len(whole[0]) * width))
            for i in (0, 1, 2) if less else ():
                if i != 1 or got[1] is not got[0]:
                    c = got[i].reshape(-1, width)
                    c[:, common[f]] = whole[i] - c.sum(1)
            return got

        def derived(todo, feat, node_of=node_of, large=np.flatnonzero(large), parent=parent, kept=kept, cells=cells, totals=totals, last=last):
            count = totals[0]
            less = np.zeros(len(count), bool)  # is the larger of two siblings
            if kept is not None:
                pair = count.reshape(-1, 2)
                less[::2], less[1::2] = pair[:, 0] > pair[:, 1], pair[:, 0] <= pair[:, 1]
            differ = np.flatnonzero(less[large])
            other = large[differ] ^ 1
            asked = np.union1d(large[~less[large]], other)
            slot = np.full(len(count) + 1, -1)
            slot[asked] = np.arange(len(asked))
            slots = slot[node_of]
            use, whole = np.flatnonzero(slots >= 0), tuple(t[asked] for t in totals)
            where = slot[np.where(less[large], large ^ 1, large)]

            def entries(f):
                got = cells_of(f, *counted(f, slots, use), whole)
                of = [c.reshape(-1, int(sizes[f]))[where] for c in got]
                if len(differ):
                    for c, above in zip(of, kept[f], strict=True):
                        c[differ] = above[parent[large[differ]]] - c[differ]
                if got[1] is got[0]:
                    of[1] = of[0]
                if not last:
                    cells.append(of)
                return _filled(of, len(large))

            return entries

        def every(todo, feat, node_of=node_of, nodes=np.flatnonzero(open_ & ~large), k=k, totals=totals, w=w, label=label, tally=tally):
            """All features of nodes."""
            slot, count = np.full(k + 1, -1), len(todo)
            slot[nodes[todo]] = np.arange(count)
            slots = slot[node_of]
            use, whole = np.flatnonzero(slots >= 0), tuple(t[nodes[todo]] for t in totals)

            def entries(f):
                rows, at, code, less = counted(f, slots, use)
                if count * sizes[f] <= max(2 * len(rows), 8 * count):  # fewer cells than rows to sort
                    return _filled(cells_of(f, rows, at, code, less, whole), count)
                n, v, s = np.ones(len(rows), np.int64), w[rows] if tally.weighted else None, label[rows]
                if less:  # one entry of the commonest code for the nodes that have others, too
                    other = tally.by(at, tally.of(rows), count)
                    rest = np.flatnonzero((other[0] > 0) & (whole[0] > other[0]))
                    left = [t[rest] - o[rest] for t, o in zip(whole, other, strict=True)]
                    at, code = np.concatenate([at, rest]), np.concatenate([code, np.full(len(rest), common[f])])
                    n, s = np.concatenate([n, left[0]]), np.concatenate([s, left[2]])
                    v = None if v is None else np.concatenate([v, left[1]])
                return _listed(at, code, n, v, s)

            return entries

        for find, own in ((derived, large), (every, open_ & ~large)):
            own = np.flatnonzero(own)
            if len(own):
                gain[own], feature[own], code[own] = level_splits(
                    find, paths[own], tuple(t[own] for t in totals), squares[own], p, values, g)
        split = np.flatnonzero(feature >= 0)
        if len(split):
            table["feature"][split], table["code"][split], table["gain"][split] = feature[split], code[split], gain[split] / SCALE ** 2
            table["left"][split] = made + 2 * np.arange(len(split))
        out[-1] = table
        down = np.full(k, -1)
        down[split] = np.arange(len(split))
        at = down[node]
        if ends is not None:
            stop = np.flatnonzero(at < 0)
            ends[base[here[stop]]] = made - k + node[stop]
        if not len(split):
            return np.concatenate(out)
        place, held_rows = np.full(k, -1), np.full(k, -1)
        place[large] = np.arange(int(large.sum()))
        keep = split[(place[split] >= 0) & (count[split] >= keep_rows)] if cells else split[:0]
        held_rows[keep] = np.arange(len(keep))
        kept = [[c[place[keep]] for c in of] for of in cells] if len(keep) else None
        parent = np.repeat(held_rows[split], 2)
        stay = np.flatnonzero(at >= 0)
        here, before = here[stay], node[stay]
        at_row = (feature * height).take(before)
        at_row += base.take(here)
        right = flat.take(at_row) > code.take(before)
        node = 2 * at[stay] + right
        below = child_paths(paths[split])
        paths = np.stack(below, 1).ravel()
        made += 2 * len(split)
        depth += 1
        out.append(leaf_rows(0))


def descend(nodes: np.ndarray, x: np.ndarray, rows: np.ndarray | None = None) -> np.ndarray:
    """Place of the node where each row, or each of ``rows``, ends."""
    feature, left, code = nodes["feature"].astype(np.int64), nodes["left"].astype(np.int64), nodes["code"].copy()
    if x.flags.f_contiguous and not x.flags.c_contiguous:
        flat, row, column = x.T.ravel(), 1, len(x)
    else:
        flat, row, column = np.ascontiguousarray(x).ravel(), x.shape[1], 1
    begin = np.arange(len(x)) if rows is None else rows
    if row != 1:
        begin = begin * row
    out, at, n = np.zeros(len(begin), np.int64), np.arange(len(begin)), np.zeros(len(begin), np.int64)
    feature *= column
    while len(at):
        f = feature.take(n)
        if f.min() < 0:
            stop, go = np.flatnonzero(f < 0), np.flatnonzero(f >= 0)
            out[at.take(stop)] = n.take(stop)
            at, begin, n, f = at.take(go), begin.take(go), n.take(go), f.take(go)
        f += begin
        right = flat.take(f, mode="clip") > code.take(n)
        n = left.take(n)
        n += right
    return out


# ------------------------------------------------------------------ distributed growth

class _Top:
    """Top of a tree while its nodes are too large for one task: node table, paths and the nodes to look at."""

    def __init__(self, tree: int, rows: int) -> None:
        self.nodes, self.paths, self.open = leaf_rows(1), [root_path(tree)], [0]
        self.nodes["rows"] = rows

    def split(self, n: int, r) -> None:
        t = self.nodes
        t["rows"][n], t["weight"][n], t["value"][n] = r["rows"], r["weight"], r["sum"] / max(r["weight"], 1) / SCALE
        if r["feature"] < 0:
            return
        t["feature"][n], t["code"][n], t["gain"][n], t["left"][n] = r["feature"], r["code"], r["gain"] / SCALE ** 2, len(t)
        two = leaf_rows(2)
        two["depth"] = t["depth"][n] + 1
        two["rows"] = r["left_rows"], r["rows"] - r["left_rows"]
        two["weight"] = r["left_weight"], r["weight"] - r["left_weight"]
        two["value"] = np.array([r["left_sum"], r["sum"] - r["left_sum"]]) / np.maximum(two["weight"], 1) / SCALE
        self.open += [len(t), len(t) + 1]
        self.paths += [int(v[0]) for v in child_paths(np.array([self.paths[n]], np.uint64))]
        self.nodes = np.concatenate([t, two])


def _plain(tops: Mapping) -> dict:
    """Node tables and paths as arrays and lists, which tasks read without this module."""
    return {key: (top.nodes, top.paths) for key, top in tops.items()}


#: Rows of several batches in one row of a table: codes by column, predictions so far by fit.
PACKED = "rows binary, folds binary, ys binary, xs binary, sofar binary"


def _fixed(column: pa.Array, kind: type, width: int) -> np.ndarray:
    """(rows, width) numbers of a column of binary values of one length, without nulls."""
    column = column.cast(pa.binary())
    data = column.buffers()[2]
    if not len(column) or not width or data is None:
        return np.empty((len(column), width), kind)
    first = np.frombuffer(column.buffers()[1], np.int32)[column.offset]
    return np.frombuffer(data, kind, len(column) * width, int(first)).reshape(len(column), width)


def _blocks(batches: Iterator[pa.RecordBatch], p: int, least: int = 0) -> Iterator[tuple]:
    """(row, fold, y, codes, predictions so far) of each batch of the matrix, or of each row of a ``PACKED`` table; batches
    of the matrix are put together while they have fewer than ``least`` rows."""
    held: list = []
    for b in batches:
        if b.schema.names[0] == "rows":
            for i in range(b.num_rows):
                rows, fold, y, x, sofar = (np.frombuffer(c[i].as_buffer(), k) for c, k in zip(
                    b.columns, (np.int64, np.int32, np.float64, np.uint8, np.float64), strict=True))
                yield rows, fold, y, x.reshape(p, len(rows)).T, sofar.reshape(-1, len(rows)).T
            continue
        held.append((*(c.to_numpy(zero_copy_only=False) for c in b.columns[:3]), _fixed(b.column(3), np.uint8, p)))
        if sum(len(v[0]) for v in held) >= least:
            yield (*(held[0] if len(held) == 1 else map(np.concatenate, zip(*held, strict=True))), None)
            held = []
    if held:
        yield (*map(np.concatenate, zip(*held, strict=True)), None)


def _by_column(parts: Sequence[bytes], p: int) -> np.ndarray:
    """Codes of all rows, stored by column."""
    return np.asfortranarray(np.frombuffer(b"".join(parts), np.uint8).reshape(-1, p))


def integer(y: np.ndarray) -> np.ndarray:
    return np.rint(y * SCALE).astype(np.int64)


def labels(y: np.ndarray, x: np.ndarray, fit: int, sofar, later) -> np.ndarray:
    """What a tree of ``fit`` learns: the label, or in boosting what is left of it."""
    return y if later is None else y - later(x, fit, sofar)


DECIDED = "k int, gain double, feature long, code long, rows long, weight long, sum long, left_rows long, left_weight long, left_sum long, cells binary"


def _features(paths: np.ndarray, lo: np.ndarray, p: int, m: int) -> np.ndarray:
    """(nodes, m or fewer) features that nodes look at when those before place ``lo`` of their order cannot split them."""
    order = np.tile(np.arange(p, dtype=np.int16), (len(paths), 1))
    if m < p:
        draw_features(order, paths, 0, lo + m)
    return np.sort(order[:, lo:lo + m], axis=1).astype(np.int64)


def _add_cells(cells: np.ndarray, begin: np.ndarray, feat: np.ndarray, held: _Held, nodes: np.ndarray, codes: Codes, sizes: np.ndarray) -> None:
    """Adds rows of some nodes, those of ``held``, to the cells of all nodes' features and, last, to the nodes' totals."""
    k, m = feat.shape
    for c, whole in zip(cells, held.totals, strict=True):
        c[len(c) - k + nodes] += whole
    pair = (nodes[:, None] * m + np.arange(m)).ravel()
    own, looked = np.repeat(np.arange(len(nodes)), m), feat[nodes].ravel()
    by = np.argsort(looked, kind="stable")
    pair, own, looked = pair[by], own[by], looked[by]
    first = np.flatnonzero(_begins(looked))
    for a, b in zip(first.tolist(), [*first[1:].tolist(), len(looked)], strict=True):
        f, to = int(looked[a]), begin[pair[a:b]]
        if sizes[f] == 2:
            left = held.two_codes(codes.flags[f], own[a:b])
            for c, x, whole in zip(cells, left, held.totals, strict=True):
                c[to] += x
                c[to + 1] += whole[own[a:b]] - x
        elif sizes[f] > 2:
            seg, code, *sums = held.entries(codes.columns[f], int(sizes[f]), own[a:b])
            at = to[seg] + code
            for c, x in zip(cells, sums, strict=True):
                np.add.at(c, at, x)


def _look(matrix: DataFrame, tops: dict, later, values, g: Growth, look: list, lo: int, above: Mapping, keep: bool) -> dict:
    """One pass over the rows: the best split of every node in ``look`` ((tree, fit, node)), by one aggregate of the cells of
    the features that each looks at.  Feature -2: none of them splits it, and there are others.

    ``above`` has the cells of parents by left child: of such a pair only the smaller node is counted.  With ``keep``, the
    cells of every node come with its split.
    """
    p = len(values)
    m, sizes = g.features if 0 < g.features < p else p, np.array([len(v) for v in values])
    index = {v: k for k, v in enumerate(look)}
    less = {}  # larger node: smaller one of a pair
    for tree, fit, node in above:
        pair = (tree, fit, node), (tree, fit, node + 1)
        if all(v in index for v in pair):
            small, large = sorted(pair, key=lambda v: tops[v[:2]].nodes["rows"][v[2]])
            less[large] = small
    groups: dict = {}
    rest: dict = {}  # nodes that are not counted, the place of the one that is, and their parents' cells
    for tree, fit, node in look:
        if (tree, fit, node) not in less:
            groups.setdefault((tree, fit), []).append((index[tree, fit, node], node))
    for (tree, fit, node), small in less.items():
        place = groups[tree, fit].index((index[small], small[2]))
        rest.setdefault((tree, fit), []).append((index[tree, fit, node], node, place, above[tree, fit, min(node, small[2])]))
    paths = {key: np.array([tops[key].paths[n] for _, n in own], np.uint64) for key, own in groups.items()}
    asked = {key: _features(v, lo, p, m) for key, v in paths.items()}
    begins = {key: np.cumsum(sizes[v.ravel()]) - sizes[v.ravel()] for key, v in asked.items()}
    lengths = {key: int(sizes[v.ravel()].sum()) + len(v) for key, v in asked.items()}
    sent = matrix.sparkSession.sparkContext.broadcast((_plain(tops), groups, rest, paths, asked, begins, lengths, values))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tops, groups, rest, _, asked, begins, lengths, _ = sent.value
        cells = {key: np.zeros((3, length), np.int64) for key, length in lengths.items()}
        squares = {key: np.zeros(len(own) + len(rest.get(key, ()))) for key, own in groups.items()}
        for rows, fold, y, x, sofar in _blocks(batches, p, BLOCK_ROWS):
            codes, seen = Codes(x, g, True), {}
            x = codes.columns.T
            for (tree, fit), own in groups.items():
                if tree not in seen:
                    seen[tree] = weights(rows, tree, g)
                w = np.where((fold == fit) | (fold == HELD_OUT), 0, seen[tree])
                nodes = tops[tree, fit][0]
                slot = np.full(len(nodes), -1)
                slot[[n for _, n in own] + [v[1] for v in rest.get((tree, fit), ())]] = np.arange(len(squares[tree, fit]))
                use = np.flatnonzero(w)
                at = slot[descend(nodes, x, use)]
                t = integer(labels(y, x, fit, sofar, later))
                label = w * t
                square = label.astype(np.float64) * t
                squares[tree, fit] += np.bincount(at + 1, square.take(use), len(squares[tree, fit]) + 1)[1:]
                use, at = (v[(at >= 0) & (at < len(own))] for v in (use, at))
                order = np.argsort(at.astype(np.int16) if len(own) < 1 << 15 else at, kind="stable")
                size = np.bincount(at, minlength=len(own))
                here = np.flatnonzero(size)
                if not len(here):
                    continue
                use, tally = use.take(order), _Tally(w, label)
                counted, parts = tally.of(use)
                held = _Held(use, (np.cumsum(size) - size)[here], size[here], counted, parts, square, [v.take(use) for v in codes.words], tally)
                key = tree, fit
                _add_cells(cells[key], begins[key], asked[key], held, here, codes, sizes)
        for k, key in enumerate(groups):
            yield pa.record_batch([pa.array([k], pa.int32()), pa.array([cells[key].tobytes()], pa.binary()), pa.array([squares[key].tobytes()], pa.binary())],
                                  ["k", "cells", "squares"])

    def decide(table: pa.Table) -> pa.Table:
        tops, groups, rest, paths, asked, begins, lengths, values = sent.value
        key = list(groups)[table["k"][0].as_py()]
        own, path, feat, begin, others = groups[key], paths[key], asked[key], begins[key], rest.get(key, [])
        c = sum(np.frombuffer(v, np.int64).reshape(3, lengths[key]) for v in table["cells"].to_pylist())
        squares = sum(np.frombuffer(v) for v in table["squares"].to_pylist())
        k, m = feat.shape
        totals, cells = c[:, c.shape[1] - k:], c[:, :c.shape[1] - k]
        if others:  # nodes look at all features: as many cells in each
            up = np.stack([np.frombuffer(v[3], np.int64).reshape(3, -1) for v in others], 1)
            small = [v[2] for v in others]
            totals = np.concatenate([totals, up[:, :, -1] - totals[:, small]], 1)
            each = cells.reshape(3, k, -1)
            cells = np.concatenate([each, up[:, :, :-1] - each[:, small]], 1).reshape(3, -1)
            k, own = k + len(others), own + [v[:2] for v in others]
            feat, path = np.tile(feat[:1], (k, 1)), np.concatenate([path, np.array([tops[key][1][v[1]] for v in others], np.uint64)])
            begin = np.cumsum(sizes[feat.ravel()]) - sizes[feat.ravel()]
        totals = tuple(totals)
        who, pairs = np.repeat(np.arange(k), m), feat.ravel()
        full = np.flatnonzero(cells[0])
        seg = np.repeat(np.arange(len(pairs)), sizes[pairs])[full]
        got = best_splits((seg, full - begin[seg], *(v[full] for v in cells)), pairs[:, None], tuple(t[who] for t in totals), path[who], values, g)
        found = np.flatnonzero(got[1] >= 0)
        best = found[first_best(who[found], pairs[found], got[0][found])]
        gain, feature, code, left = np.zeros(k), np.full(k, -1 if lo + m >= p else -2), np.zeros(k, np.int64), np.zeros((3, k), np.int64)
        gain[who[best]], feature[who[best]], code[who[best]] = got[0][best], pairs[best], got[2][best]
        for i in best.tolist():
            left[:, who[i]] = cells[:, begin[i]:begin[i] + got[2][i] + 1].sum(1)
        feature[(feature >= 0) & (gain <= NOTHING * squares)] = -1  # nothing left to gain but rounding
        mean = totals[2] / np.maximum(totals[1], 1)
        feature[(totals[0] < max(g.min_split, 2)) | (squares - mean * totals[2] <= NOTHING / 2 * squares)] = -1  # one label: no split can gain
        columns = [np.array([n for n, _ in own], np.int32), gain, feature, code, *totals, *left]
        with_totals = np.concatenate([cells.reshape(3, k, -1), np.stack(totals)[:, :, None]], 2) if keep else None
        sums = [with_totals[:, i].tobytes() if keep and feature[i] >= 0 else b"" for i in range(k)]
        return pa.table([*(pa.array(v) for v in columns), pa.array(sums, pa.binary())], names=[c.split()[0] for c in DECIDED.split(", ")])

    found = matrix.mapInArrow(count, "k int, cells binary, squares binary").groupBy("k").applyInArrow(decide, DECIDED).collect()
    return {look[r["k"]]: r for r in found}


def _grow_tops(matrix: DataFrame, tops: dict, later, values, g: Growth, finish_rows: int) -> None:
    """Splits nodes with more than ``finish_rows`` rows, level by level, until none is left."""
    p = len(values)
    m = g.features if 0 < g.features < p else p
    most = 3 * 8 * sum(sorted(map(len, values))[-m:])
    at_once, of_one = max(1, PASS_BYTES // most), max(1, PASS_BYTES // 8 // most)  # nodes of a pass, and of one tree in it
    cells_of_all = 3 * 8 * (sum(map(len, values)) + 1)
    depth, above = 0, {}
    while g.max_depth is None or depth < g.max_depth:
        look = [(*key, n) for key, top in tops.items() for n in top.open if top.nodes["rows"][n] > finish_rows]
        if not look:
            return
        for top in tops.values():
            top.open = []
        keep = m == p and depth + 1 != g.max_depth and cells_of_all * len(look) <= PASS_BYTES  # for the driver
        below: dict = {}
        trees: dict = {}
        for v in look:
            trees.setdefault(v[:2], []).append(v)
        turns = [[v for own in trees.values() for v in own[i:i + of_one]] for i in range(0, max(map(len, trees.values())), of_one)]
        for now in [turn[k:k + at_once] for turn in turns for k in range(0, len(turn), at_once)]:
            lo = 0
            while now:
                found = _look(matrix, tops, later, values, g, now, lo, above, keep)
                now, lo = [n for n in now if found[n]["feature"] == -2], lo + m
                for (tree, fit, n), r in sorted(found.items()):
                    if r["feature"] != -2:
                        tops[tree, fit].split(n, r)
                    if keep and r["feature"] >= 0:
                        below[tree, fit, int(tops[tree, fit].nodes["left"][n])] = bytes(r["cells"])
        depth, above = depth + 1, below


#: Subtrees; ``predictions`` are sums over ``trees`` trees (0 where a later row of the task has them).
GROWN = "tree int, fit int, root int, nodes binary, rows binary, predictions binary, trees int"
_GROWN_NAMES = [c.split()[0] for c in GROWN.split(", ")]
_GROWN_TYPES = [pa.int32()] * 3 + [pa.binary()] * 3 + [pa.int32()]


def grow(matrix: DataFrame, trees: Sequence[int], fits: Sequence[int], values: Sequence[np.ndarray], g: Growth, train_rows: Mapping[int, int],
         later=None, finish_rows: int = FINISH_ROWS, share: bool = True, predict: bool = True, keep_nodes: bool = True) -> tuple[DataFrame, dict]:
    """Grows every tree of every fit; returns (subtrees with the predictions of their rows, tops of the trees).

    With ``share`` the trees of fits whose roots are small enough are dealt to tasks, which read all
    rows once for their trees and fits.  Rows that end in a leaf too large for one task are
    predicted where they are.  Without ``keep_nodes`` those shared trees leave predictions only.
    """
    p = len(values)
    tops = {(t, f): _Top(t, train_rows[f]) for t in trees for f in fits if train_rows[f] > finish_rows}
    _grow_tops(matrix, tops, later, values, g, finish_rows)
    whole = [f for f in fits if share and train_rows[f] <= finish_rows]
    single = [f for f in fits if not share or train_rows[f] > finish_rows]
    sent = matrix.sparkSession.sparkContext.broadcast((_plain(tops), values))
    trees = list(trees)

    def large(nodes: np.ndarray) -> np.ndarray:
        return (nodes["feature"] < 0) & (nodes["rows"] > finish_rows)

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tops, _ = sent.value
        for rows, fold, y, x, sofar in _blocks(batches, p):
            units, x = [], np.ascontiguousarray(x)  # (tree, fit, root), rows
            for t in trees:
                w = weights(rows, t, g)
                for f in single:
                    use = np.flatnonzero(((w > 0) & (fold != f) & (fold != HELD_OUT)) | (predict & (fold == f)))
                    at = np.zeros(len(use), np.int64)
                    if (t, f) in tops:
                        at = descend(tops[t, f][0], x[use])
                        keep = ~large(tops[t, f][0])[at]
                        use, at = use[keep], at[keep]
                    units += [(t, f, int(n), use[at == n]) for n in np.unique(at)]
            for lo in range(0, len(units), 32):
                some = units[lo:lo + 32]
                yield pa.record_batch([
                    *[pa.array([u[k] for u in some], pa.int32()) for k in range(3)],
                    *[pa.array([v[u[3]].tobytes() for u in some], pa.binary()) for v in (rows, fold.astype(np.int32))],
                    pa.array([labels(y[u[3]], x[u[3]], u[1], None if sofar is None else sofar[u[3]], later).tobytes() for u in some], pa.binary()),
                    pa.array([x[u[3]].tobytes() for u in some], pa.binary())], ["tree", "unit", "root", "rows", "folds", "ys", "xs"])

    def finish(table: pa.Table) -> pa.Table:
        tops, values = sent.value
        tree, fit, root = (table[c][0].as_py() for c in ("tree", "unit", "root"))
        rows, fold, y = (np.frombuffer(b"".join(table[c].to_pylist()), k) for c, k in (("rows", np.int64), ("folds", np.int32), ("ys", np.float64)))
        x = _by_column(table["xs"].to_pylist(), p)
        learn = np.where((fold != fit) & (fold != HELD_OUT), weights(rows, tree, g), 0)
        top = tops.get((tree, fit))
        path, depth = (top[1][root], int(top[0]["depth"][root])) if top else (root_path(tree), 0)
        own = grown(x, integer(y), learn, path, depth, values, g)
        ask = np.flatnonzero(predict & (fold == fit))
        out = (tree, fit, root, own.tobytes(), rows[ask].tobytes(), own["value"].take(descend(own, x, ask)).tobytes(), 1)
        return pa.table([pa.array([v], k) for v, k in zip(out, _GROWN_TYPES, strict=True)], names=_GROWN_NAMES)

    tasks = min(TREE_TASKS, len(trees))

    def repeat(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, fold, y, x, sofar in _blocks(batches, p):
            own = [v.tobytes() for v in (rows, fold.astype(np.int32), y, x)]
            for k in range(tasks):
                yield pa.record_batch([pa.array([k], pa.int32()), *[pa.array([v], pa.binary()) for v in own]], ["task", "rows", "folds", "ys", "xs"])

    def finish_all(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if not (held := list(batches)):
            return
        table = pa.Table.from_batches(held)
        task, values = table["task"][0].as_py(), sent.value[1]
        rows, fold, y = (np.frombuffer(b"".join(table[c].to_pylist()), k) for c, k in (("rows", np.int64), ("folds", np.int32), ("ys", np.float64)))
        x, t = _by_column(table["xs"].to_pylist(), p), integer(y)
        codes, own = Codes(x, g), trees[task::tasks]
        ask = {fit: np.flatnonzero(predict & (fold == fit)) for fit in whole}
        total = {fit: np.zeros(len(use)) for fit, use in ask.items()}
        for k, tree in enumerate(own):
            seen = weights(rows, tree, g)
            for fit in whole:
                nodes = grown(codes, t, np.where((fold != fit) & (fold != HELD_OUT), seen, 0), root_path(tree), 0, values, g)
                total[fit] += nodes["value"].take(descend(nodes, x, ask[fit]))
                last = k + 1 == len(own)
                if last or keep_nodes:
                    out = (tree, fit, 0, nodes.tobytes() if keep_nodes else b"", *((rows[ask[fit]].tobytes(), total[fit].tobytes(), len(own)) if last else (b"", b"", 0)))
                    yield pa.record_batch([pa.array([v], c) for v, c in zip(out, _GROWN_TYPES, strict=True)], _GROWN_NAMES)

    def in_place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tops, _ = sent.value
        for rows, fold, _, x, _ in _blocks(batches, p):
            for (t, f), (nodes, _) in tops.items():
                use = np.flatnonzero(fold == f)
                at = descend(nodes, x[use])
                use, at = use[large(nodes)[at]], at[large(nodes)[at]]
                if len(use):
                    yield pa.record_batch([pa.array([v], k) for v, k in zip(
                        (t, f, -1, b"", rows[use].tobytes(), nodes["value"][at].tobytes(), 1), _GROWN_TYPES, strict=True)], _GROWN_NAMES)

    parts = []
    if whole:
        copies = matrix.mapInArrow(repeat, "task int, rows binary, folds binary, ys binary, xs binary")
        parts.append(copies.repartitionById(tasks, "task").mapInArrow(finish_all, GROWN))
    if single:
        units = matrix.mapInArrow(deal, "tree int, unit int, root int, rows binary, folds binary, ys binary, xs binary")
        parts.append(units.groupBy("tree", "unit", "root").applyInArrow(finish, GROWN))
    out = parts[0] if len(parts) == 1 else parts[0].unionAll(parts[1])
    if predict and any(large(top.nodes).any() for top in tops.values()):
        out = out.unionAll(matrix.mapInArrow(in_place, GROWN))
    return out, tops


def whole_tree(top: _Top | None, parts: Sequence[tuple[int, bytes]]) -> np.ndarray:
    """One node table of a tree's top and its subtrees (root, nodes)."""
    out = leaf_rows(1) if top is None else top.nodes.copy()
    for root, nodes in parts:
        sub = np.frombuffer(nodes, NODE).copy()
        if len(sub):
            sub["left"] = np.where(sub["left"] >= 0, sub["left"] + len(out) - 1, -1)
            out[root] = sub[0]
            out = np.concatenate([out, sub[1:]])
    return out


NODES = "tree int, fit int, subtree int, node int, feature int, code int, depth int, left int, rows long, weight long, gain double, value double"


def node_table(grown_trees: DataFrame, tops: Mapping) -> DataFrame:
    """Every node of every subtree and top (subtree -1) as a row."""
    spark = grown_trees.sparkSession

    def unpack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for tree, fit, root, nodes in zip(*(c.to_pylist() for c in b.columns), strict=True):
                n = np.frombuffer(nodes, NODE)
                own = [pa.array(np.full(len(n), v, np.int32)) for v in (tree, fit, root)] + [pa.array(np.arange(len(n), dtype=np.int32))]
                yield pa.record_batch([*own, *[pa.array(n[c].astype(k)) for c, k in (
                    ("feature", np.int32), ("code", np.int32), ("depth", np.int32), ("left", np.int32), ("rows", np.int64), ("weight", np.int64),
                    ("gain", np.float64), ("value", np.float64))]], [c.split()[0] for c in NODES.split(", ")])

    packed = grown_trees.filter("root >= 0").select("tree", "fit", "root", "nodes")
    if tops:
        packed = packed.unionAll(spark.createDataFrame([(t, f, -1, bytearray(top.nodes.tobytes())) for (t, f), top in tops.items()],
                                                       "tree int, fit int, root int, nodes binary"))
    return packed.mapInArrow(unpack, NODES)


def importances(nodes: DataFrame) -> DataFrame:
    """(fit, feature, importance): each tree's gains as shares of their sum, averaged over the trees that split, and summing to 1."""
    gains = nodes.filter("feature >= 0").groupBy("fit", "tree", "feature").agg(F.sum("gain").alias("gain"))
    whole = gains.groupBy("fit", "tree").agg(F.sum("gain").alias("all"))
    shares = gains.join(whole, ["fit", "tree"]).groupBy("fit", "feature").agg(F.sum(F.col("gain") / F.col("all")).alias("share"))
    total = shares.groupBy("fit").agg(F.sum("share").alias("total"))
    return shares.join(total, "fit").select("fit", "feature", (F.col("share") / F.col("total")).alias("importance"))


def forest_predictions(grown_trees: DataFrame, matrix: DataFrame) -> DataFrame:
    """(fit, row, y, prediction): the mean over the trees."""
    def unpack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for fit, rows, values, trees in zip(*(c.to_pylist() for c in b.columns), strict=True):
                r = np.frombuffer(rows, np.int64)
                yield pa.record_batch([pa.array(np.full(len(r), fit, np.int32)), pa.array(r), pa.array(np.frombuffer(values, np.float64)),
                                       pa.array(np.full(len(r), trees, np.int32))], ["fit", "row", "value", "trees"])

    each = grown_trees.select("fit", "rows", "predictions", "trees").mapInArrow(unpack, "fit int, row long, value double, trees int")
    mean = each.groupBy("fit", "row").agg((F.sum("value") / F.sum("trees")).alias("prediction"))
    return mean.join(matrix.select("row", "y"), "row").select("fit", "row", "y", "prediction")


def training_rows(matrix: DataFrame, fits: Sequence[int]) -> dict[int, tuple[int, float]]:
    """(rows, mean label) that each fit learns from: one aggregate by fold."""
    by = {r["fold"]: (r["n"], r["s"]) for r in matrix.filter(F.col("fold") != HELD_OUT).groupBy("fold").agg(
        F.count(F.lit(1)).alias("n"), F.sum(F.round(F.col("y") * SCALE).cast("long")).alias("s")).collect()}
    out = {}
    for f in fits:
        n, s = (sum(v[i] for k, v in by.items() if k != f) for i in (0, 1))
        out[f] = n, s / max(n, 1) / SCALE
    return out


def fit_forest(matrix: DataFrame, fits: Sequence[int], values: Sequence[np.ndarray], trees: int, g: Growth,
               finish_rows: int = FINISH_ROWS, keep_nodes: bool = True) -> tuple[DataFrame, dict]:
    """All trees of all fits, written once: (subtrees with predictions, tops).  ``keep_nodes`` as in :func:`grow`."""
    n = {f: v[0] for f, v in training_rows(matrix, fits).items()}
    out, tops = grow(matrix, range(trees), fits, values, g, n, finish_rows=finish_rows, keep_nodes=keep_nodes)
    return materialize(out), tops


@dataclass
class Boosted:
    """Start and trees of each fit."""
    start: dict
    trees: dict
    rate: float

    def predict(self, x: np.ndarray, fit: int, rounds: int | None = None) -> np.ndarray:
        out = np.full(len(x), self.start[fit])
        for nodes in self.trees[fit][:rounds]:
            out += self.rate * nodes["value"][descend(nodes, x)]
        return out


def _boosted_units(state: DataFrame, fits: list[int], place: dict, rounds: range, values: Sequence[np.ndarray], rate: float, g: Growth) -> DataFrame:
    """(fit, round, nodes): fits whose rows one task takes over go on for several rounds there."""
    p = len(values)
    sent = state.sparkSession.sparkContext.broadcast(values)

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, fold, y, x, sofar in _blocks(batches, p):
            x = np.ascontiguousarray(x)
            for f in fits:
                use = np.flatnonzero((fold != f) & (fold != HELD_OUT))
                yield pa.record_batch([pa.array([f], pa.int32()), *[pa.array([v[use].tobytes()], pa.binary()) for v in (rows, y, x)],
                                       pa.array([sofar[use, place[f]].tobytes()], pa.binary())], ["fit", "rows", "ys", "xs", "sofar"])

    def boost(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if not (held := list(batches)):
            return
        table = pa.Table.from_batches(held)
        fit, values = table["fit"][0].as_py(), sent.value
        rows, y, now = (np.frombuffer(b"".join(table[c].to_pylist()), k) for c, k in (("rows", np.int64), ("ys", np.float64), ("sofar", np.float64)))
        x = _by_column(table["xs"].to_pylist(), p)
        now, out, codes = now.copy(), [], Codes(x, g)
        for r in rounds:
            ends = np.full(len(y), -1)
            nodes = grown(codes, integer(y - now), weights(rows, r, g), root_path(r), 0, values, g, ends)
            rest = np.flatnonzero(ends < 0)  # rows that the tree did not learn from
            if len(rest):
                ends[rest] = descend(nodes, x, rest)
            now += (rate * nodes["value"]).take(ends)
            out.append(nodes.tobytes())
        yield pa.record_batch([pa.array([fit] * len(out), pa.int32()), pa.array(list(rounds), pa.int32()), pa.array(out, pa.binary())], ["fit", "round", "nodes"])

    units = state.mapInArrow(deal, "fit int, rows binary, ys binary, xs binary, sofar binary")
    slot = F.array_position(F.array(*map(F.lit, fits)), F.col("fit")).cast("int") - 1  # a partition for each fit
    return units.repartitionById(len(fits), slot).mapInArrow(boost, "fit int, round int, nodes binary").orderBy("fit", "round")


def fit_boosting(matrix: DataFrame, fits: Sequence[int], values: Sequence[np.ndarray], rounds: int, rate: float, g: Growth,
                 finish_rows: int = FINISH_ROWS, keep_rounds: int = KEEP_ROUNDS) -> tuple[DataFrame, Boosted]:
    """Boosted trees of all fits together; returns ((fit, row, y, prediction), model).

    Rows carry the predictions so far; trees of the last rounds are applied on the way, and every
    ``keep_rounds`` rounds the rows are written anew.  Large fits grow one tree of each fit per
    round, by passes over the rows only where trees are shallow; a fit of at most ``finish_rows`` rows goes on for
    ``keep_rounds`` rounds in its task.
    The model has at most rounds x fits x 2 ** depth nodes.
    """
    p, fits = len(values), list(fits)
    found = training_rows(matrix, fits)
    n = {f: v[0] for f, v in found.items()}
    place = {f: k for k, f in enumerate(fits)}
    model = Boosted({f: v[1] for f, v in found.items()}, {f: [] for f in fits}, rate)
    spark = matrix.sparkSession

    def sofar_of(recent):
        sent = spark.sparkContext.broadcast(recent)

        def later(x, fit, sofar):
            out = sofar[:, place[fit]].copy()
            for nodes in sent.value[fit]:
                out += (rate * nodes["value"]).take(descend(nodes, x))
            return out

        return later

    def carry(rows: DataFrame, recent: dict | None) -> DataFrame:
        later = recent and sofar_of(recent)
        start = np.array([model.start[f] for f in fits])

        def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for row, fold, y, x, sofar in _blocks(batches, p, BLOCK_ROWS):
                now = np.stack([later(x, f, sofar) for f in fits]) if later else np.repeat(start, len(y))
                own = (row.astype(np.int64), fold.astype(np.int32), y, np.ascontiguousarray(x.T), now)
                yield pa.record_batch([pa.array([v.tobytes()], pa.binary()) for v in own], [c.split()[0] for c in PACKED.split(", ")])

        packed = rows.mapInArrow(task, PACKED)
        if not later and large:  # every pass reads all rows, so tasks should have as many
            packed = packed.repartition(8 * spark.sparkContext.defaultParallelism)
        return materialize(packed, "none")  # read often, kept shortly

    large = [f for f in fits if n[f] > finish_rows]
    state = carry(matrix, None)
    if large:
        keep_rounds = min(keep_rounds, KEEP_PASSES)
    for kept in range(0, rounds, keep_rounds):
        now = range(kept, min(kept + keep_rounds, rounds))
        small = [f for f in fits if f not in large]
        if small:
            for row in _boosted_units(state, small, place, now, values, rate, g).collect():  # trees, bounded by their depth
                model.trees[row["fit"]].append(np.frombuffer(bytes(row["nodes"]), NODE))
        for r in now if large else ():
            later = sofar_of({f: model.trees[f][kept:] for f in large})
            if g.max_depth is not None and g.max_depth <= PASS_DEPTH:
                tops = {(r, f): _Top(r, n[f]) for f in large}
                _grow_tops(state, tops, later, values, g, 1)
                for f in large:
                    model.trees[f].append(tops[r, f].nodes)
                continue
            out, tops = grow(state, [r], large, values, g, n, later, finish_rows, share=False, predict=False)
            parts: dict = {}
            for row in out.select("fit", "root", "nodes").collect():  # one tree of each fit, bounded by its depth
                parts.setdefault(row["fit"], []).append((row["root"], bytes(row["nodes"])))
            for f in large:
                model.trees[f].append(whole_tree(tops.get((r, f)), sorted(parts.get(f, []))))
        before, state = state, carry(state, {f: model.trees[f][kept:] for f in fits})
        discard(before)

    def predictions(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, fold, y, _, sofar in _blocks(batches, p):
            for f in fits:
                use = np.flatnonzero(fold == f)
                yield pa.record_batch([pa.array(np.full(len(use), f, np.int32)), pa.array(rows[use]), pa.array(y[use]), pa.array(sofar[use, place[f]])],
                                      ["fit", "row", "y", "prediction"])

    return state.mapInArrow(predictions, "fit int, row long, y double, prediction double"), model
