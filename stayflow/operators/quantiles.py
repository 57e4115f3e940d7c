"""Exact (linearly interpolated) quantiles of whole columns and of groups, one way at every size.

pandas' ``quantile`` / ``median`` need the order statistics at ranks ``floor(p (n - 1))``
and the next one.

* **Columns.**  A double is a 64-bit number of the same order.  A round counts the values of all
  columns by the next ``DIGIT`` bits (of those that share the bits found before), so each wanted
  rank's bits are found from the top; a cell of one value ends the search.  A round reads only the
  columns that are still open, and the driver gets one row per rank.
* **Groups.**  Each wanted rank has a bracket: an open interval of values that holds it, with the
  number of values below and inside.  A round sketches the inside (``percentile_approx``), takes two
  values around the rank and counts the values below and up to each, exactly; the rank is then one of
  the two values or lies in a narrower bracket.  When at most ``LISTED`` values are inside, they are
  listed and the rank is read off.

Nothing that grows with the column reaches one task or the driver.
"""

from __future__ import annotations

import math
import sys
from collections.abc import Callable, Iterator, Mapping, Sequence

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from stayflow.session import materialize

cloudpickle.register_pickle_by_value(sys.modules[__name__])  # tasks need no copy of this library

#: Bits of a value that a round finds, and searches of a round (a task holds 24 bytes a cell for each).
DIGIT = 14
SEARCHES = 256
#: Values of a bracket that may be listed.
LISTED = 1000
ACCURACY = 10_000
#: Steps of the sketch of a group (its percentages must be literals).
STEPS = 128


def _q(c: str) -> str:
    return f"`{c}`"


def _ranks(n: int, p: float) -> tuple[int, float]:
    pos = p * (n - 1)
    return int(math.floor(pos)), pos - math.floor(pos)


def ordered(v: np.ndarray) -> np.ndarray:
    """Unsigned numbers in the order of doubles; both zeros are one, NaN is above all (as Spark sorts)."""
    bits = np.where(np.isnan(v), np.nan, v + 0.0).view(np.uint64)
    return np.where(bits >> np.uint64(63), ~bits, bits | np.uint64(1 << 63))


def unordered(k: int) -> float:
    return float(np.array([k & ~(1 << 63) if k >> 63 else ~k & (1 << 64) - 1], np.uint64).view(np.float64)[0])


#: Frame that has the values of the named columns, and what reads a batch of it: the non-null values of each.
Reader = Callable[[Sequence[str]], tuple[DataFrame, Callable[[pa.RecordBatch], Iterator[np.ndarray]]]]


def reader(df: DataFrame) -> Reader:
    """Reads columns of their own."""
    def read(columns):
        frame = df.select(*[F.col(_q(c)).cast("double").alias(f"c{i}") for i, c in enumerate(columns)])
        return frame, lambda b: (c.drop_null().to_numpy(zero_copy_only=False) for c in b.columns)

    return read


def _cells(read: Reader, searches: Sequence[tuple[str, int]], known: int) -> DataFrame:
    """(search, cell, n, least, greatest): values of each search's column that begin with its bits, by the next ones."""
    columns = list(dict.fromkeys(c for c, _ in searches))
    values, each = read(columns)
    own = [[(k, start) for k, (c, start) in enumerate(searches) if c == name] for name in columns]
    found = min(64, known + DIGIT)
    drop, count = np.uint64(64 - found), 1 << found - known
    flip = np.uint64(1 << 63)  # Spark's longs are signed

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, tuple] = {}
        for b in batches:
            for mine, v in zip(own, each(b), strict=True):
                key = ordered(v)
                key.sort()
                for k, start in mine:
                    part = key
                    if known:
                        first = start << 64 - known
                        lo, hi = np.searchsorted(key, np.uint64(first)), np.searchsorted(key, np.uint64(first + (1 << 64 - known) - 1), "right")
                        part = key[lo:hi]
                    if not len(part):
                        continue
                    cell = (part >> drop & np.uint64(count - 1)).astype(np.int64)
                    begin = np.flatnonzero(np.diff(cell, prepend=-1))
                    end = np.append(begin[1:], len(part))
                    if k not in held:
                        held[k] = np.zeros(count, np.int64), np.full(count, ~np.uint64(0)), np.zeros(count, np.uint64)
                    n, least, greatest = held[k]
                    at = cell[begin]
                    n[at] += end - begin
                    least[at] = np.minimum(least[at], part[begin])
                    greatest[at] = np.maximum(greatest[at], part[end - 1])
        for k, (n, least, greatest) in held.items():
            at = np.flatnonzero(n)
            yield pa.record_batch([pa.array(np.full(len(at), k, np.int32)), pa.array(at.astype(np.int32)), pa.array(n[at]),
                                   *[pa.array((v[at] ^ flip).view(np.int64)) for v in (least, greatest)]],
                                  ["search", "cell", "n", "least", "greatest"])

    return values.mapInArrow(task, "search int, cell int, n long, least long, greatest long").groupBy("search", "cell").agg(
        F.sum("n").alias("n"), F.min("least").alias("least"), F.max("greatest").alias("greatest"))


def order_statistics(df: DataFrame, wanted: Sequence[tuple[str, int]], read: Reader | None = None) -> dict[tuple[str, int], float]:
    """``{(column, rank): value}`` of non-null values; ``read`` for columns that ``df`` has not as columns of their own."""
    read = read or reader(df)
    found: dict[tuple[str, int], float] = {}
    left = {w: (0, w[1]) for w in dict.fromkeys(wanted)}  # bits found so far, rank among the values that begin with them
    known = 0
    while left:
        searches = list(dict.fromkeys((c, start) for (c, _), (start, _) in left.items()))
        after: dict[tuple[str, int], tuple[int, int]] = {}
        width = min(DIGIT, 64 - known)
        for lo in range(0, len(searches), SEARCHES):
            some = {s: k for k, s in enumerate(searches[lo:lo + SEARCHES])}
            asked = [(w, some[w[0], start], rank) for w, (start, rank) in left.items() if (w[0], start) in some]
            upto = F.sum("n").over(Window.partitionBy("search").orderBy("cell"))  # at most 2 ** DIGIT rows
            cells = _cells(read, list(some), known).withColumn("upto", upto)
            ranks = df.sparkSession.createDataFrame([(k, search, rank) for k, (_, search, rank) in enumerate(asked)], "k int, search int, rank long")
            for r in cells.join(ranks, "search").filter("rank < upto AND rank >= upto - n").collect():
                w, _, rank = asked[r["k"]]
                if r["least"] == r["greatest"]:
                    found[w] = unordered(r["least"] + (1 << 63))
                else:
                    after[w] = left[w][0] << width | r["cell"], rank - (r["upto"] - r["n"])
        left, known = after, known + width
    return found


def exact_percentiles(df: DataFrame, specs: Sequence[tuple[str, float]]) -> dict[tuple[str, float], float | None]:
    """``{(column, p): value}`` with pandas' linear interpolation; None for a column without values."""
    specs = list(dict.fromkeys((c, float(p)) for c, p in specs))
    if not specs:
        return {}
    cols = list(dict.fromkeys(c for c, _ in specs))
    row = df.agg(*[F.count(F.col(_q(c))).alias(f"n{j}") for j, c in enumerate(cols)]).first()
    return interpolated(df, specs, {c: row[f"n{j}"] for j, c in enumerate(cols)})


def interpolated(df: DataFrame, specs: Sequence[tuple[str, float]], sizes: Mapping[str, int],
                 read: Reader | None = None) -> dict[tuple[str, float], float | None]:
    """:func:`exact_percentiles` of distinct ``specs`` with the number of non-null values of each column."""
    wanted = []
    for c, p in specs:
        if sizes[c]:
            i, frac = _ranks(sizes[c], p)
            wanted += [(c, i)] + ([(c, i + 1)] if frac > 0 else [])
    at = order_statistics(df, wanted, read) if wanted else {}
    out: dict[tuple[str, float], float | None] = {}
    for c, p in specs:
        out[(c, p)] = None
        if sizes[c]:
            i, frac = _ranks(sizes[c], p)
            out[(c, p)] = at[(c, i)] + (frac * (at[(c, i + 1)] - at[(c, i)]) if frac > 0 else 0.0)
    return out


def exact_percentile(df: DataFrame, col: str, p: float) -> float | None:
    return exact_percentiles(df, [(col, p)])[(col, float(p))]


def _matched(values: DataFrame, state: DataFrame, by: Sequence[str]) -> DataFrame:
    """Values with the brackets of their group that hold them (groups match null-safe).
    The planner broadcasts the brackets under its measured limit, else AQE splits a hot group."""
    cond = None
    for b in by:
        c = values[b].eqNullSafe(state[f"_g_{b}"])
        cond = c if cond is None else cond & c
    return values.join(state, cond & (values["_x"] > F.coalesce(state["_lo"], F.lit(float("-inf"))))
                       & (values["_x"] < F.coalesce(state["_hi"], F.lit(float("inf")))))


def grouped_exact_percentiles(df: DataFrame, by: Sequence[str], col: str, probs: Sequence[float],
                              names: Sequence[str]) -> DataFrame:
    """Per group: ``n`` (non-null values) and the exact interpolated quantiles of ``col`` as ``names``.

    The brackets of all groups narrow together, as DataFrames.  Null keys are a group;
    a group without values has NULL quantiles.
    """
    by, probs = list(by), [float(p) for p in probs]
    values = df.select(*by, F.col(_q(col)).cast("double").alias("_x"))
    sizes = values.groupBy(*by).agg(F.count("_x").alias("n"))
    values = values.filter(F.col("_x").isNotNull())
    wanted = []
    for k, p in enumerate(probs):
        pos = F.lit(p) * (F.col("n") - 1)
        for j in (0, 1):
            wanted.append(F.struct(F.lit(2 * k + j).alias("k"), (F.floor(pos) + j).cast("long").alias("r")))
    groups = [f"_g_{b}" for b in by]
    state = sizes.filter("n > 0").select(*[F.col(b).alias(g) for b, g in zip(by, groups, strict=True)], "n",
                                         F.explode(F.array(*wanted)).alias("w"))
    state = state.select(*groups, "w.k", F.least("w.r", F.col("n") - 1).alias("_r"), F.col("n").alias("_in"), F.lit(0).cast("long").alias("_below"),
                         *[F.lit(None).cast("double").alias(c) for c in ("_lo", "_hi", "_v")])
    state = materialize(state)
    key = [*groups, "k"]
    while (state.filter("_v IS NULL").agg(F.max("_in")).first()[0] or 0) > LISTED:
        wide = state.filter(f"_v IS NULL AND _in > {LISTED}")
        sketch = _matched(values, wide, by).groupBy(*key, "_r", "_in", "_below", "_lo", "_hi").agg(
            F.percentile_approx("_x", [j / STEPS for j in range(STEPS + 1)], ACCURACY).alias("_s"))
        step = F.floor(F.lit(STEPS) * (F.col("_r") - F.col("_below")) / F.col("_in"))
        ends = sketch.withColumn("_a", F.element_at("_s", F.greatest(step, F.lit(1)).cast("int"))).withColumn(
            "_b", F.element_at("_s", F.least(step + 3, F.lit(STEPS + 1)).cast("int"))).drop("_s")
        ends = materialize(ends)
        x = F.col("_x")
        counted = _matched(values, ends, by).groupBy(*key, "_r", "_in", "_below", "_lo", "_hi", "_a", "_b").agg(
            *[(F.col("_below") + F.count_if(c)).alias(name) for name, c in
              (("_ba", x < F.col("_a")), ("_ua", x <= F.col("_a")), ("_bb", x < F.col("_b")), ("_ub", x <= F.col("_b")))])
        r = F.col("_r")

        def pick(first, a, mid, b, last, r=r):
            return (F.when(r < F.col("_ba"), first).when(r < F.col("_ua"), a).when(r < F.col("_bb"), mid)
                    .when(r < F.col("_ub"), b).otherwise(last))

        null, c = F.lit(None).cast("double"), F.col
        narrowed = counted.select(
            *key, "_r", pick(c("_ba") - c("_below"), c("_in"), c("_bb") - c("_ua"), c("_in"), c("_below") + c("_in") - c("_ub")).alias("_in"),
            pick(c("_below"), c("_below"), c("_ua"), c("_below"), c("_ub")).alias("_below"),
            pick(c("_lo"), c("_lo"), c("_a"), c("_lo"), c("_b")).alias("_lo"), pick(c("_a"), c("_hi"), c("_b"), c("_hi"), c("_hi")).alias("_hi"),
            pick(null, c("_a"), null, c("_b"), null).alias("_v"))
        state = materialize(state.filter(f"_v IS NOT NULL OR _in <= {LISTED}").unionByName(narrowed))
    # at most LISTED values per bracket are left
    w = Window.partitionBy(*key).orderBy("_x").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    runs = _matched(values, state.filter("_v IS NULL"), by).groupBy(*key, "_r", "_below", "_x").agg(F.count(F.lit(1)).alias("_c"))
    runs = runs.withColumn("_upto", F.col("_below") + F.sum("_c").over(w)).filter("_upto - _c <= _r AND _r < _upto")
    stats = state.filter("_v IS NOT NULL").select(*key, "_v").unionByName(runs.select(*key, F.col("_x").alias("_v")))
    wide = stats.groupBy(*groups).agg(*[F.max(F.when(F.col("k") == j, F.col("_v"))).alias(f"_v{j}") for j in range(2 * len(probs))])
    cond = None
    for b, g in zip(by, groups, strict=True):
        e = sizes[b].eqNullSafe(wide[g])
        cond = e if cond is None else cond & e
    out = [*by, "n"]
    for k, (p, name) in enumerate(zip(probs, names, strict=True)):
        pos = F.lit(p) * (F.col("n") - 1)
        frac, lo, hi = pos - F.floor(pos), F.col(f"_v{2 * k}"), F.col(f"_v{2 * k + 1}")
        out.append(F.when(frac > 0, lo + frac * (hi - lo)).otherwise(lo).alias(name))
    return sizes.join(wide, cond, "left").select(*out)
