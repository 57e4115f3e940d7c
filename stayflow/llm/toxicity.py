"""Toxicity: a linear classifier over character n-grams whose features are scaled by
naive Bayes log-count ratios.

Log-count ratios use every labelled training row (one hashed count table, summed by
Spark).  The logistic regression on the scaled features is fitted on a bounded,
hash-ordered sample per class (``SAMPLE``) over the ``FEATURES`` most telling buckets.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stayflow.llm.common import staged

ORDERS = (3, 4, 5)
BUCKETS = 1 << 18
FEATURES = 1 << 15
#: Distinct labelled texts of each class that the regression sees, those with the smallest hashes.
SAMPLE = 3000
SMOOTHING = 1.0
L2 = 1e-3
STEPS = 150
#: Characters that are hashed at once.
CHUNK = 1 << 20


def ngram_ids(text: str) -> np.ndarray:
    """Bucket of every character n-gram of the lower-cased text between two spaces; empty: none.

    Runs of white space count as one space, so line breaks do not matter.
    """
    folded = " ".join(text.lower().split())
    if not folded:
        return np.empty(0, np.uint32)
    c = np.frombuffer(f" {folded} ".encode("utf-32-le", "replace"), np.uint32)
    parts = []
    for lo in range(0, len(c), CHUNK):  # bounded work space for very long texts; chunks overlap by an n-gram
        x = c[lo:lo + CHUNK + max(ORDERS) - 1]
        for n in ORDERS:
            m = min(CHUNK, len(x) - n + 1)
            if m <= 0:
                continue
            h = np.full(m, 0x9E3779B1 * n & 0xFFFFFFFF, np.uint32)
            for k in range(n):
                h += x[k:k + m]
                h *= np.uint32(0x85EBCA6B)
                h ^= h >> np.uint32(15)
            parts.append(h & np.uint32(BUCKETS - 1))
    return np.concatenate(parts) if parts else np.empty(0, np.uint32)


def distinct_ids(text: str | None, seen: np.ndarray) -> np.ndarray:
    """Distinct buckets of a text; ``seen`` is a cleared scratch array of BUCKETS flags."""
    ids = ngram_ids(text or "")
    if len(ids) < 2048:
        return np.unique(ids)
    seen[ids] = True
    out = np.flatnonzero(seen)
    seen[out] = False
    return out


def count_table(train: DataFrame, text_col: str, label_col: str) -> DataFrame:
    """(bucket, label, n): documents of each label that have the bucket; bucket -1 counts all."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, rows, seen = np.zeros((2, BUCKETS), np.int64), [0, 0], np.zeros(BUCKETS, bool)
        for b in batches:
            for t, y in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                total[y][distinct_ids(t, seen)] += 1
                rows[y] += 1
        for y in (0, 1):
            ids = np.flatnonzero(total[y])
            yield pa.RecordBatch.from_arrays([
                pa.array(np.concatenate([[-1], ids]).astype(np.int32)), pa.array(np.full(len(ids) + 1, y, np.int32)),
                pa.array(np.concatenate([[rows[y]], total[y][ids]]).astype(np.int64))], names=["bucket", "label", "n"])

    return (train.select(F.col(f"`{text_col}`"), F.col(f"`{label_col}`").cast("int"))
            .mapInArrow(run, "bucket int, label int, n long").groupBy("bucket", "label").agg(F.sum("n").alias("n")))


def fit_logistic(rows: list[np.ndarray], y: np.ndarray, weight: np.ndarray, scale: np.ndarray,
                 l2: float = L2, steps: int = STEPS) -> tuple[np.ndarray, float]:
    """Weights on the scaled features and the intercept (weighted loss, Adam on the full sample)."""
    k = len(scale)
    size = np.array([len(r) for r in rows], np.int64)
    blocks = range(0, len(rows), 256)  # work space for a few rows at a time
    w, b = np.zeros(k), 0.0
    m, v = np.zeros(k + 1), np.zeros(k + 1)
    total = max(weight.sum(), 1e-9)
    for t in range(1, steps + 1):
        ws, slope, bias = w * scale, np.zeros(k), 0.0
        for lo in blocks:
            own = slice(lo, lo + 256)
            at, n = np.concatenate(rows[own]), size[own]
            z = np.bincount(np.repeat(np.arange(len(n)), n), ws[at], len(n)) + b
            e = weight[own] * (1 / (1 + np.exp(-np.clip(z, -35, 35))) - y[own]) / total
            slope += np.bincount(at, np.repeat(e, n), k)
            bias += e.sum()
        g = np.concatenate([slope * scale + l2 * w / k, [bias]])
        m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
        step = 0.05 * (m / (1 - 0.9 ** t)) / (np.sqrt(v / (1 - 0.999 ** t)) + 1e-9)
        w, b = w - step[:k], b - step[k]
    return w, b


def train(labelled: DataFrame, text_col: str = "text", label_col: str = "toxic", sample: int = SAMPLE) -> tuple[np.ndarray, float]:
    """Weight of each bucket and the intercept, from rows with a text and a label 0 or 1.

    Null labels and other values are left out; without rows of both classes every
    weight is 0 and the intercept gives the only class (or 0.5).
    """
    y = F.col(f"`{label_col}`").cast("int")
    text = F.coalesce(F.col(f"`{text_col}`"), F.lit(""))
    # read for the counts and for each class's sample: written once
    rows = staged(labelled.filter(y.isin(0, 1)).select(text.alias("_t"), F.xxhash64(text).alias("_h"), y.alias("_y")), "toxicity-train")
    # at most 2 * BUCKETS + 2 rows, whatever the corpus
    counts = count_table(rows, "_t", "_y").toPandas()
    n = np.zeros((2, BUCKETS))
    size = [0.0, 0.0]
    for label in (0, 1):
        part = counts[counts["label"] == label]
        at = part["bucket"].to_numpy()
        n[label][at[at >= 0]] = part["n"].to_numpy()[at >= 0]
        size[label] = float(part["n"].to_numpy()[at < 0].sum())
    weights = np.zeros(BUCKETS, np.float32)
    if not size[0] or not size[1]:
        return weights, 4.0 if size[1] else -4.0 if size[0] else 0.0
    p, q = n[1] + SMOOTHING, n[0] + SMOOTHING
    ratio = np.log((p / (size[1] + 2 * SMOOTHING)) / (q / (size[0] + 2 * SMOOTHING)))
    both = (n[0] + n[1]) / (size[0] + size[1])
    gap = n[1] / size[1] - n[0] / size[0]
    telling = gap ** 2 / np.maximum(both * (1 - both), 1e-9)
    chosen = np.sort(np.argsort(-telling, kind="stable")[:FEATURES])
    chosen = chosen[n[0][chosen] + n[1][chosen] > 0]
    index = np.full(BUCKETS, -1, np.int32)
    index[chosen] = np.arange(len(chosen))
    shared = labelled.sparkSession.sparkContext.broadcast(index)

    def features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        where, seen = shared.value, np.zeros(BUCKETS, bool)
        for b in batches:
            found = [where[distinct_ids(t, seen)] for t in b.column(0).to_pylist()]
            yield pa.RecordBatch.from_arrays([pa.array([f[f >= 0].tobytes() for f in found], pa.binary()), b.column(1)],
                                             names=["x", "y"])

    parts = []
    for label in (0, 1):
        own = rows.filter(F.col("_y") == label)
        # the bound is found on hashes alone, so no more than the sampled texts move
        bound = own.select("_h").distinct().orderBy("_h").limit(sample).agg(F.max("_h")).first()[0]
        picked = own.filter(F.col("_h") <= bound).dropDuplicates(["_h"])
        parts.append(picked.select("_t", "_y").mapInArrow(features, "x binary, y int").orderBy("x").toPandas())
    xs = [np.frombuffer(x, np.int32) for part in parts for x in part["x"]]
    ys = np.concatenate([part["y"].to_numpy() for part in parts]).astype(float)
    share = np.array([size[int(label)] / len(parts[int(label)]) for label in ys])
    w, b = fit_logistic(xs, ys, share, ratio[chosen])
    weights[chosen] = (w * ratio[chosen]).astype(np.float32)
    return weights, float(b)


def score(docs: DataFrame, weights: np.ndarray, intercept: float, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id and score (0 to 1) per row of ``docs``, over whole texts.

    Null and empty texts score by the intercept alone.  Only the id and the text are
    read; repeated rows and null ids pass through.
    """
    shared = docs.sparkSession.sparkContext.broadcast((weights, intercept))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        w, b0 = shared.value
        for b in batches:
            out = np.empty(b.num_rows)
            for i, t in enumerate(b.column(1)):
                ids = ngram_ids(t.as_py() or "")
                hit = np.unique(ids[w[ids] != 0])  # few n-grams carry weight
                out[i] = 1 / (1 + np.exp(-np.clip(float(w[hit].sum(dtype=np.float64)) + b0, -35, 35)))
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(out)], names=["doc_id", "score"])

    return docs.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), F.col(f"`{text_col}`").alias("text")).mapInArrow(
        run, "doc_id long, score double")
