"""Sorts, limits, distinct, sampling and unions (survey section 2.7)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def sort_multi(df: DataFrame, keys: Sequence[str | Column], descending: Sequence[bool] | None = None,
               tiebreak: Sequence[str] = ()) -> DataFrame:
    """``orderBy`` several keys (asc/desc) plus unique tie-break columns."""
    descending = descending or [False] * len(keys)
    cols = []
    for k, d in zip(keys, descending):
        c = F.col(k) if isinstance(k, str) else k
        cols.append(c.desc() if d else c.asc())
    cols += [F.col(t).asc() for t in tiebreak]
    return df.orderBy(*cols)


def limit_n(df: DataFrame, n: int, order: Sequence[str | Column] = ()) -> DataFrame:
    """Top ``n`` by ``order`` (planned as TakeOrderedAndProject)."""
    return (df.orderBy(*order) if order else df).limit(n)


def distinct_rows(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    return (df.select(*columns) if columns else df).distinct()


def sample_bound(target_rows: int, total: int) -> int:
    """Keys whose 60-bit hash is below this are sampled."""
    return (1 << 60) if total <= target_rows else (target_rows << 60) // total


def sample_fraction(df: DataFrame, target_rows: int = 50000, seed: int = 42, total: int | None = None,
                    key: str | Sequence[str] | None = None) -> DataFrame:
    """Bernoulli sample with fraction ``min(1, target_rows / n)``.

    With ``key`` (a column or several) the sample is decided by 60 bits of the md5 of seed
    and key, which other engines can repeat; otherwise Spark's seeded sampler is used.
    """
    if total is None:
        total = df.count()
    fraction = 1.0 if total <= target_rows else target_rows / total
    if key is None:
        return df.sample(withReplacement=False, fraction=fraction, seed=seed)
    keys = [key] if isinstance(key, str) else list(key)
    text = F.concat_ws("|", F.lit(str(seed)), *[F.coalesce(F.col(k).cast("string"), F.lit("")) for k in keys])
    place = F.conv(F.substring(F.md5(text), 1, 15), 16, 10).cast("long")
    return df.filter(place < F.lit(sample_bound(target_rows, total)))


def union_results(frames: Sequence[DataFrame], labels: Sequence[str] | None = None,
                  label_col: str = "pipeline") -> DataFrame:
    """``unionByName`` of result tables, optionally tagged with a label column."""
    out = None
    for i, f in enumerate(frames):
        g = f.withColumn(label_col, F.lit(labels[i])) if labels else f
        out = g if out is None else out.unionByName(g, allowMissingColumns=True)
    return out
