"""Quality classifier: regularised quadratic discriminant analysis of document statistics.

Every text gives ``STATISTICS``: shares of kinds of characters, words and lines, drawn
towards a usual value in short texts and put on a logarithmic scale.  Class means and
covariances come from sums of products over all labelled rows (one aggregate, no sample).
Each class covariance is shrunk towards the pooled one and towards a round one; its
Cholesky factor is computed once, and a document's score is the logistic function of the
difference of two log densities, whose Mahalanobis distances are solves with the factors.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

STATISTICS = ("symbols", "shouts", "capitals", "digits", "marked_words", "word_length", "word_spread", "long_words",
              "single_letters", "closed_words", "repeated_words", "repeated_lines", "line_words", "other_marks")
#: Words (or characters, by the statistic) of a usual text that every text counts as having besides its own.
PRIOR_WORDS = 20.0
#: Words of a window in which repeated words are counted.
WINDOW = 100
#: Weight of the pooled covariance, and of the round one, in each class covariance.
TO_POOLED, TO_ROUND = 0.2, 0.05
SYMBOLS = b"#*$%&|<>{}[]\\^~=+_@"
#: Characters that are looked at together.
CHUNK = 1 << 20
_MARK = re.compile(r"[#*$%&|<>{}\[\]\\^~=+_@!?]")
_TABLE = np.zeros(256, np.int8)  # kinds of bytes
for _kind, _bytes in enumerate((SYMBOLS, b"!?", bytes(range(65, 91)), b"0123456789", b"\"'();:/-", bytes(range(97, 123))), 1):
    _TABLE[list(_bytes)] = _kind


def _share(count: float, of: float, usual: float, prior: float) -> float:
    """Logarithm of a share, drawn towards ``usual`` as if ``prior`` more had been counted."""
    return float(np.log((count + usual * prior) / (of + prior)))


def statistics(text: str | None) -> list[float]:
    """Values of :data:`STATISTICS`; null and empty texts have the usual ones."""
    text = text or ""
    kinds = np.zeros(7, np.int64)
    for lo in range(0, len(text), CHUNK):
        kinds += np.bincount(_TABLE[np.frombuffer(text[lo:lo + CHUNK].encode("utf-8", "replace"), np.uint8)], minlength=7)
    words = text.split()
    n = len(words)
    size = np.fromiter(map(len, words), np.float64, n)
    marked = sum(1 for w in words if _MARK.search(w))
    closed = sum(1 for w in words if w[-1] in ".,;:!?")
    repeated = n - sum(len(set(words[lo:lo + WINDOW])) for lo in range(0, n, WINDOW))
    lines = [x for x in text.split("\n") if x.strip()]
    again = sum(map(len, lines)) - sum(map(len, set(lines)))
    chars, latin = float(kinds.sum()), float(kinds[3] + kinds[6])
    w, c = PRIOR_WORDS, 6 * PRIOR_WORDS
    mean = (size.sum() + 5.5 * w) / (n + w)
    spread = (size @ size + (5.5 ** 2 + 9) * w) / (n + w) - mean * mean
    return [_share(kinds[1], chars, 0.001, c), _share(kinds[2], chars, 0.001, c), _share(kinds[3], latin, 0.03, c),
            _share(kinds[4], chars, 0.002, c), _share(marked, n, 0.01, w), float(np.log(mean)), float(np.log(max(spread, 0.1))),
            _share((size > 14).sum(), n, 0.02, w), _share((size == 1).sum(), n, 0.05, w), _share(closed, n, 0.12, w),
            _share(repeated, n, 0.25, w), _share(again, chars, 0.02, c), float(np.log((n + 10.0) / (len(lines) + 1.0))),
            _share(kinds[5], chars, 0.005, c)]


def with_statistics(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id and the statistics of every row's text; other columns are left out."""
    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = np.array([statistics(t) for t in batch.column(1).to_pylist()]).reshape(-1, len(STATISTICS))
            yield pa.record_batch([batch.column(0), *map(pa.array, x.T.copy())], ["doc_id", *STATISTICS])

    cols = docs.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), F.col(f"`{text_col}`").alias("text"))
    return cols.mapInArrow(task, ", ".join(["doc_id long", *[f"{s} double" for s in STATISTICS]]))


class Discriminant(NamedTuple):
    """Means, Cholesky factors and log priors of the classes 0 and 1; without rows of both, only ``share`` of class 1."""
    share: float
    means: list
    factors: list
    priors: list


def moments(rows: DataFrame, columns: tuple[str, ...] = STATISTICS, label_col: str = "label") -> dict[int, tuple]:
    """(rows, sums, sums of products) of each label: one aggregate, as many figures at every size."""
    d = len(columns)
    pairs = [(i, j) for i in range(d) for j in range(i, d)]
    found = rows.filter(F.col(label_col).isin(0, 1)).groupBy(F.col(label_col).cast("int").alias("label")).agg(
        F.count(F.lit(1)).alias("n"), F.array(*[F.sum(c) for c in columns]).alias("s"),
        F.array(*[F.sum(F.col(columns[i]) * F.col(columns[j])) for i, j in pairs]).alias("p")).collect()  # two rows
    out = {}
    for r in found:
        products = np.zeros((d, d))
        for (i, j), v in zip(pairs, r["p"], strict=True):
            products[i, j] = products[j, i] = v
        out[r["label"]] = r["n"], np.array(r["s"]), products
    return out


def fit(found: dict[int, tuple], to_pooled: float = TO_POOLED, to_round: float = TO_ROUND) -> Discriminant:
    """Class covariances, shrunk towards the pooled one and towards its diagonal."""
    total = sum(n for n, _, _ in found.values())
    share = found[1][0] / total if 1 in found else 0.5 if not total else 0.0
    if len(found) < 2:
        return Discriminant(share, [], [], [])
    means = {k: s / n for k, (n, s, _) in found.items()}
    own = {k: p / n - np.outer(means[k], means[k]) for k, (n, _, p) in found.items()}
    pooled = sum(n * own[k] for k, (n, _, _) in found.items()) / total
    diagonal = np.diag(np.maximum(np.diag(pooled), 1e-6))
    shrunk = [(1 - to_pooled - to_round) * own[k] + to_pooled * pooled + to_round * diagonal for k in (0, 1)]
    return Discriminant(share, [means[0], means[1]], [np.linalg.cholesky(c) for c in shrunk],
                        [float(np.log(found[k][0] / total)) for k in (0, 1)])


def train(rows: DataFrame, label_col: str = "label") -> Discriminant:
    """Model of rows with the statistics and a label; labels other than 0 and 1 (null too) are left out."""
    return fit(moments(rows, STATISTICS, label_col))


def score(rows: DataFrame, model: Discriminant, columns: tuple[str, ...] = STATISTICS) -> DataFrame:
    """``rows`` with ``score`` from 0 to 1: the posterior of class 1.

    Without training rows of both classes every score is the share of class 1 (0.5 without any).
    """
    if not model.means:
        return rows.withColumn("score", F.lit(float(model.share)))

    def log_density(mean: np.ndarray, factor: np.ndarray, prior: float) -> Column:
        back = np.linalg.inv(factor)  # of the triangular factor, once
        distance = F.lit(0.0)
        for i in range(len(columns)):
            z = sum(((F.col(columns[j]) - float(mean[j])) * float(back[i, j]) for j in range(i + 1)), F.lit(0.0))
            distance += z * z
        return distance * -0.5 + float(prior - np.log(np.diag(factor)).sum())

    low, high = (log_density(*x) for x in zip(model.means, model.factors, model.priors, strict=True))
    return rows.withColumn("score", 1.0 / (1.0 + F.exp(low - high)))
