"""Linear models from sufficient statistics.

One pass over the rows gives, for every fold, the row count, the means and the centred
products of all columns (features and label), in blocks that Spark merges by the rule for
pairs of samples, so no digits are lost to large means.  What a fit learns from is the
merger of the other folds, so all folds, models, scalings and penalties come from the same
pass; the solutions need only matrices of the number of features.  Objectives are the
published ones: least squares (of least norm where columns depend on each other), ridge, and
lasso and elastic net by coordinate descent.
"""

from __future__ import annotations

import sys
from collections.abc import Iterable, Iterator, Mapping, Sequence
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stayflow.operators.quantiles import interpolated
from stayflow.plans.trees import HELD_OUT

cloudpickle.register_pickle_by_value(sys.modules[__name__])  # tasks need no copy of this library

#: Rows of the product matrix that are summed together.
BLOCK = 8
#: Share of the largest eigenvalue under which a direction counts as dependent.
DEPENDENT = 1e-11
SWEEPS, TOLERANCE = 20_000, 1e-11


class Products(NamedTuple):
    """Rows, means and centred products of the features and, last, the label."""
    n: float
    mean: np.ndarray
    centred: np.ndarray


def merged(parts: Iterable[Products], rows: slice = slice(None)) -> Products:
    """Products of several samples together; ``centred`` may hold only some rows of the matrix."""
    total = None
    for part in parts:
        if total is None or not total.n:
            total = part
        elif part.n:
            n, step = total.n + part.n, part.mean - total.mean
            total = Products(n, total.mean + step * (part.n / n),
                             total.centred + part.centred + np.outer(step[rows], step) * (total.n * part.n / n))
    return total


#: Columns of a packed table; a row's features are one value, so that later passes do not handle them one by one.
PACKED = "row long, fold int, y double, x binary, gaps binary"


def packed(df: DataFrame, features: Sequence[str], key: str, fold: str, label: str) -> DataFrame:
    """Key, fold, label and features of every row: ``x`` holds the features' doubles, a null as NaN, and ``gaps``,
    only in rows with nulls, a byte for each feature that is 1 where it is null."""
    rows = df.select(F.col(key).cast("long").alias("row"), F.col(fold).cast("int").alias("fold"), F.col(label).cast("double").alias("y"),
                     *[F.col(f"`{c}`").cast("double").alias(f"f{i}") for i, c in enumerate(features)])

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            x = np.empty((b.num_rows, len(features)))
            gaps = np.zeros((b.num_rows, len(features)), np.uint8)
            for i, c in enumerate(b.columns[3:]):
                x[:, i] = c.to_numpy(zero_copy_only=False)
                if c.null_count:
                    gaps[:, i] = c.is_null().to_numpy(zero_copy_only=False)
            absent = [g.tobytes() if g.any() else None for g in gaps] if gaps.any() else [None] * b.num_rows
            yield pa.record_batch([*b.columns[:3], _binary(x), pa.array(absent, pa.binary())], ["row", "fold", "y", "x", "gaps"])

    return rows.mapInArrow(pack, PACKED)


def _binary(x: np.ndarray) -> pa.Array:
    """The rows of ``x`` as binary values."""
    ends = np.arange(len(x) + 1, dtype=np.int32) * np.int32(x.shape[1] * x.itemsize)
    return pa.Array.from_buffers(pa.binary(), len(x), [None, pa.py_buffer(ends), pa.py_buffer(np.ascontiguousarray(x))])


def unpacked(column: pa.Array, width: int, kind: type = np.float64) -> np.ndarray:
    """(rows, width) numbers of a column of :func:`_binary`, which has no nulls."""
    size = width * np.dtype(kind).itemsize
    column = column.cast(pa.binary())
    data = column.buffers()[2]
    if not size or data is None:
        return np.empty((len(column), width), kind)
    first = np.frombuffer(column.buffers()[1], np.int32)[column.offset]
    return np.frombuffer(data, kind, len(column) * width, int(first)).reshape(len(column), width)


def values(b: pa.RecordBatch, width: int, features: Sequence[int]) -> Iterator[np.ndarray]:
    """The non-null values of some features in a batch of (x, gaps)."""
    x, gaps = unpacked(b.column(0), width), b.column(1)
    absent = None
    if gaps.null_count < len(gaps):
        absent = np.zeros(x.shape, bool)
        absent[gaps.is_valid().to_numpy(zero_copy_only=False)] = unpacked(gaps.drop_null(), width, np.uint8) == 1
    for i in features:
        yield x[:, i] if absent is None else x[~absent[:, i], i]


def products(df: DataFrame, features: Sequence[str], key: str, fold: str, label: str) -> dict[int, Products]:
    """Products of features and label by fold, from one pass."""
    return packed_products(packed(df, features, key, fold, label), len(features))


def packed_products(rows: DataFrame, width: int) -> dict[int, Products]:
    """:func:`products` of a packed table of ``width`` features."""
    size = width + 1
    blocks = (size + BLOCK - 1) // BLOCK
    kind = "fold int, block int, n double, mean binary, sums binary"
    names = [c.split()[0] for c in kind.split(", ")]

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, Products] = {}
        for b in batches:
            folds, y = (b.column(k).to_numpy(zero_copy_only=False) for k in range(2))
            v = np.column_stack([unpacked(b.column(2), width), y])
            for f in np.unique(folds):
                own = v[folds == f]
                mean = own.mean(0)
                own = Products(float(len(own)), mean, (own - mean).T @ (own - mean))
                held[int(f)] = merged([held[int(f)], own]) if int(f) in held else own
        for f, (n, mean, centred) in held.items():
            yield pa.record_batch([pa.array([f] * blocks, pa.int32()), pa.array(range(blocks), pa.int32()), pa.array([n] * blocks),
                                   pa.array([mean.tobytes()] * blocks, pa.binary()),
                                   pa.array([centred[k * BLOCK:(k + 1) * BLOCK].tobytes() for k in range(blocks)], pa.binary())], names)

    def add(table: pa.Table) -> pa.Table:
        at = slice(table["block"][0].as_py() * BLOCK, (table["block"][0].as_py() + 1) * BLOCK)
        cols = zip(*(table[c].to_pylist() for c in ("n", "mean", "sums")), strict=True)
        total = merged((Products(n, np.frombuffer(mean), np.frombuffer(sums).reshape(-1, size)) for n, mean, sums in cols), at)
        return pa.table([table["fold"][:1], table["block"][:1], pa.array([total.n]), pa.array([total.mean.tobytes()], pa.binary()),
                         pa.array([total.centred.tobytes()], pa.binary())], names=names)

    out: dict[int, Products] = {}
    for r in rows.select("fold", "y", "x").mapInArrow(count, kind).groupBy("fold", "block").applyInArrow(add, kind).collect():
        part = np.frombuffer(bytes(r["sums"])).reshape(-1, size)
        if r["fold"] not in out:
            out[r["fold"]] = Products(r["n"], np.frombuffer(bytes(r["mean"])), np.zeros((size, size)))
        out[r["fold"]].centred[r["block"] * BLOCK:r["block"] * BLOCK + len(part)] = part
    return out


def learned_from(sums: Mapping[int, Products], fit: int) -> Products:
    """Products of the rows that a fit learns from."""
    return merged(m for f, m in sorted(sums.items()) if f not in (fit, HELD_OUT))


def robust_scales(rows: DataFrame, width: int) -> np.ndarray:
    """Median and quartile range of every feature of a packed table, by column; a range of 0 (or no values) is 1."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n = np.zeros(width, np.int64)
        for b in batches:
            n += b.num_rows
            gaps = b.column(0).drop_null()
            if len(gaps):
                n -= unpacked(gaps, width, np.uint8).sum(0, dtype=np.int64)
        yield pa.record_batch([pa.array(range(width), pa.int32()), pa.array(n)], ["feature", "n"])

    def read(features: Sequence[int]):
        return rows.select("x", "gaps"), lambda b: values(b, width, features)

    sizes = dict.fromkeys(range(width), 0) | {r["feature"]: r["n"] for r in rows.select("gaps").mapInArrow(
        count, "feature int, n long").groupBy("feature").agg(F.sum("n").alias("n")).collect()}  # a row for each feature
    q = interpolated(rows, [(i, p) for i in range(width) for p in (0.25, 0.5, 0.75)], sizes, read)
    spread = [(q[i, 0.75] - q[i, 0.25]) if sizes[i] else None for i in range(width)]
    return np.array([[q[i, 0.5] or 0.0 for i in range(width)], [v or 1.0 for v in spread]])


def standard_scales(total: Products) -> np.ndarray:
    """Mean and population standard deviation of every feature, by column; a constant's scale is 1."""
    spread = np.sqrt(np.maximum(np.diag(total.centred)[:-1] / total.n, 0.0))
    level = np.maximum(np.abs(total.mean[:-1]), 1e-300)
    return np.stack([total.mean[:-1], np.where(spread > 1e-12 * level, spread, 1.0)])


def scaled(total: Products, scales: np.ndarray) -> Products:
    """Products of features less a centre and divided by a scale."""
    by = np.append(scales[1], 1.0)
    return Products(total.n, (total.mean - np.append(scales[0], 0.0)) / by, total.centred / np.outer(by, by))


def solve(total: Products, spec: Mapping) -> tuple[np.ndarray, float]:
    """(coefficients, intercept) of one model from the products of its training rows."""
    n, mean, centred = total
    kind, xx, xy = spec["kind"], centred[:-1, :-1], centred[:-1, -1]
    if kind == "linear":
        values, vectors = np.linalg.eigh(xx)
        keep = values > DEPENDENT * max(values.max(initial=0.0), 1e-300)
        w = vectors[:, keep] @ ((vectors[:, keep].T @ xy) / values[keep])
    elif kind == "ridge":
        w = np.linalg.solve(xx + spec["alpha"] * np.eye(len(xx)), xy)
    else:
        share = 1.0 if kind == "lasso" else spec["l1_ratio"]
        w = descended(xx / n, xy / n, spec["alpha"] * share, spec["alpha"] * (1 - share))
    return w, float(mean[-1] - mean[:-1] @ w)


def descended(xx: np.ndarray, xy: np.ndarray, l1: float, l2: float) -> np.ndarray:
    """Minimum of w'xx w / 2 - xy'w + l1 |w| + l2 w'w / 2 by coordinate descent."""
    w, slope = np.zeros(len(xy)), xy.copy()
    diagonal = np.diag(xx)
    for _ in range(SWEEPS):
        moved = 0.0
        for j in range(len(w)):
            if diagonal[j] <= 1e-14:
                continue
            at = slope[j] + diagonal[j] * w[j]
            new = np.sign(at) * max(abs(at) - l1, 0.0) / (diagonal[j] + l2)
            if new != w[j]:
                slope -= xx[j] * (new - w[j])
                moved = max(moved, abs(new - w[j]) * diagonal[j] ** 0.5)
                w[j] = new
        if moved <= TOLERANCE:
            break
    return w


def predictions(df: DataFrame, features: Sequence[str], scales: np.ndarray, solved: Mapping[tuple[str, int], tuple],
                key: str, fold: str, label: str) -> DataFrame:
    """(model, fit, row, y, prediction) of the rows of every fit's fold."""
    return packed_predictions(packed(df, features, key, fold, label), len(features), scales, solved)


def packed_predictions(rows: DataFrame, width: int, scales: np.ndarray, solved: Mapping[tuple[str, int], tuple]) -> DataFrame:
    """:func:`predictions` of a packed table of ``width`` features."""
    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            ids, folds, y = (b.column(k).to_numpy(zero_copy_only=False) for k in range(3))
            x = (unpacked(b.column(3), width) - scales[0]) / scales[1]
            for (name, fit), (w, intercept) in solved.items():
                use = np.flatnonzero(folds == fit)
                yield pa.record_batch([pa.array([name] * len(use), pa.string()), pa.array(np.full(len(use), fit, np.int32)), pa.array(ids[use]),
                                       pa.array(y[use]), pa.array(x[use] @ w + intercept)], ["model", "fit", "row", "y", "prediction"])

    return rows.select("row", "fold", "y", "x").mapInArrow(task, "model string, fit int, row long, y double, prediction double")
