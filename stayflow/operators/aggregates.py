"""Aggregations (survey section 2.5).

All are single declarative aggregates: algebraic ones (count, sum, min, max, avg,
stddev) get map-side partial aggregation, so a hot group is collapsed before the
shuffle.  Holistic ones (exact percentile, mode) are only used over one numeric
column per group or over the whole table and never collect a group into Python.
Where the reference ran one Spark job per column (sums of 19 flags, null counts),
one aggregate computes every column and ``stack`` unpivots the single row.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _q(name: str) -> str:
    return f"`{name}`"


def _stack(one_row: DataFrame, names: Sequence[str], value_cols: Sequence[Sequence[str]],
           out_cols: Sequence[str], keep: Sequence[str] = ()) -> DataFrame:
    """Unpivot a one-row frame: for each name i, emit (name, value_cols[i]...)."""
    parts = []
    for n, vals in zip(names, value_cols):
        parts.append(", ".join([f"'{n}'"] + [_q(v) for v in vals]))
    expr = f"stack({len(names)}, {', '.join(parts)}) AS ({', '.join(out_cols)})"
    return one_row.selectExpr(expr, *[_q(k) for k in keep])


# ------------------------------------------------------------------ counts

def count_rows(df: DataFrame, alias: str = "row_count") -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias(alias))


def count_distinct(df: DataFrame, col: str, alias: str | None = None) -> DataFrame:
    """Distinct values of ``col`` counting NULL as one value (``distinct().count()``)."""
    alias = alias or f"distinct_{col}"
    nulls = F.coalesce(F.max(F.col(col).isNull().cast("int")), F.lit(0))
    return df.agg((F.count_distinct(col) + nulls).cast("long").alias(alias))


def group_count_having(df: DataFrame, key: str, counted: str, alias: str = "child_count",
                       min_count: int = 1) -> DataFrame:
    """Entities with more than ``min_count`` children."""
    return df.groupBy(key).agg(F.count(counted).alias(alias)).filter(F.col(alias) > min_count)


def count_histogram(df: DataFrame, key: str, counted: str, count_alias: str = "stays_count",
                    entity_alias: str = "patient_count") -> DataFrame:
    """Distribution of children per entity (group twice), ordered by the child count."""
    per_entity = df.groupBy(key).agg(F.count(counted).alias(count_alias))
    return (per_entity.groupBy(count_alias).agg(F.count(key).alias(entity_alias))
            .orderBy(count_alias))


def group_count_topk(df: DataFrame, key: str, k: int = 200, alias: str = "count") -> DataFrame:
    """Frequency table, descending, top ``k``; the key breaks ties so the cut is stable."""
    return (df.groupBy(key).agg(F.count(F.lit(1)).alias(alias))
            .orderBy(F.col(alias).desc(), F.col(key).asc_nulls_first()).limit(k))


def group_count_rare(df: DataFrame, key: str, max_count: int = 4000, alias: str = "count") -> DataFrame:
    return (df.groupBy(key).agg(F.count(F.lit(1)).alias(alias))
            .filter(F.col(alias) <= max_count).orderBy(F.col(alias).desc(), F.col(key)))


def source_distribution(events: DataFrame, items: DataFrame, stay_col: str = "ICUSTAY_ID",
                        item_col: str = "ITEMID", source_col: str = "DBSOURCE",
                        alias: str = "count") -> DataFrame:
    """Events that belong to a stay, per item source system, descending."""
    ev = events.filter(F.col(stay_col).isNotNull()).select(item_col)
    # counted per item first: a hot item is one row of the join
    per_item = ev.groupBy(item_col).agg(F.count(F.lit(1)).alias("_n"))
    return (per_item.join(items.select(item_col, source_col), item_col, "inner")
            .groupBy(source_col).agg(F.sum("_n").alias(alias))
            .orderBy(F.col(alias).desc(), F.col(source_col)))


# ------------------------------------------------------------------ per-group statistics

def conditional_agg(df: DataFrame, key: str, category_col: str, categories: Sequence[str],
                    prefix: str = "HAS_", distinct_alias: str = "DISEASE_COUNT") -> DataFrame:
    """``MAX(CASE WHEN cat = c THEN 1 ELSE 0 END)`` per category + ``COUNT(DISTINCT cat)``."""
    aggs = [F.max(F.when(F.col(category_col) == c, 1).otherwise(0)).alias(f"{prefix}{c.upper()}")
            for c in categories]
    aggs.append(F.count_distinct(category_col).alias(distinct_alias))
    return df.groupBy(key).agg(*aggs)


def stats_per_group(df: DataFrame, key: str, value: str, prefix: str = "") -> DataFrame:
    """avg, min, max, sample stddev (NULL for one row) and count per group."""
    v = F.col(value)
    return df.groupBy(key).agg(F.avg(v).alias(f"{prefix}avg"), F.min(v).alias(f"{prefix}min"),
                               F.max(v).alias(f"{prefix}max"), F.stddev_samp(v).alias(f"{prefix}std"),
                               F.count(v).alias(f"{prefix}count"))


def median_approx(df: DataFrame, key: str, value: str, alias: str = "median") -> DataFrame:
    return df.groupBy(key).agg(F.percentile_approx(value, 0.5).alias(alias))


def first_last_offset(df: DataFrame, key: str, offset: str, prefix: str = "") -> DataFrame:
    return df.groupBy(key).agg(F.min(offset).alias(f"{prefix}first_measurement_hour"),
                               F.max(offset).alias(f"{prefix}last_measurement_hour"))


def range_and_cv(df: DataFrame, prefix: str, eps: float | None = None) -> DataFrame:
    """``{p}_range = max - min``; ``{p}_coefficient_of_variation = std / avg``
    (``try_divide``: 0 average gives NULL; with ``eps``: std / (avg + eps))."""
    mx, mn, sd, av = (F.col(f"{prefix}_{s}") for s in ("max", "min", "std", "avg"))
    cv = F.try_divide(sd, av if eps is None else av + F.lit(eps))
    return df.withColumn(f"{prefix}_range", mx - mn).withColumn(f"{prefix}_coefficient_of_variation", cv)


def sum_columns(df: DataFrame, columns: Sequence[str], name_col: str = "column",
                sum_col: str = "count", pct_col: str | None = "percentage") -> DataFrame:
    """One aggregate of all column sums (+ row count), unpivoted to (name, sum, pct)."""
    aggs = [F.coalesce(F.sum(c), F.lit(0)).cast("long").alias(f"s__{i}") for i, c in enumerate(columns)]
    aggs.append(F.count(F.lit(1)).alias("n__"))
    one = df.agg(*aggs)
    out = _stack(one, list(columns), [[f"s__{i}"] for i in range(len(columns))], [name_col, sum_col], ["n__"])
    if pct_col:
        out = out.withColumn(pct_col, F.try_divide(F.col(sum_col) * 100.0, F.col("n__")))
    return out.drop("n__")


def null_counts(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """(column, null_count) for each column from one aggregate."""
    columns = [c for c in (columns or df.columns) if c in df.columns]
    one = df.agg(*[F.count_if(F.col(_q(c)).isNull()).alias(f"n__{i}") for i, c in enumerate(columns)])
    return _stack(one, columns, [[f"n__{i}"] for i in range(len(columns))], ["column", "null_count"])


def describe_column(df: DataFrame, col: str) -> DataFrame:
    """count, mean, sample stddev, min, max of one numeric column (typed, not strings)."""
    c = F.col(col)
    return df.agg(F.count(c).alias("count"), F.avg(c).alias("mean"), F.stddev_samp(c).alias("stddev"),
                  F.min(c).cast("double").alias("min"), F.max(c).cast("double").alias("max"))


def exact_quantiles(df: DataFrame, col: str, probs: Sequence[float] = (0.25, 0.5, 0.75),
                    names: Sequence[str] | None = None, by: Sequence[str] = ()) -> DataFrame:
    """Exact (interpolated) quantiles, as pandas ``quantile``/``median``."""
    names = names or [f"q{int(round(p * 100)):02d}" for p in probs]
    if by:
        from stayflow.operators.quantiles import grouped_exact_percentiles
        return grouped_exact_percentiles(df, list(by), col, list(probs), names).drop("n")
    from stayflow.operators.quantiles import exact_percentiles
    q = exact_percentiles(df, [(col, p) for p in probs])
    row = [tuple(q[(col, float(p))] for p in probs)]
    return df.sparkSession.createDataFrame(row, ", ".join(f"`{n}` double" for n in names))


def mode_value(df: DataFrame, col: str, alias: str = "mode", by: Sequence[str] = ()) -> DataFrame:
    """Most frequent non-null value, the smallest one on ties (pandas ``mode().iloc[0]``).

    Values are counted by a shuffle on (group, value), so no task holds the values of a
    group; a group without values gives NULL."""
    count = df.groupBy(*by, col).agg(F.count(F.col(col)).alias("_n"))
    best = F.min_by(F.col(col), F.when(F.col(col).isNotNull(), F.struct(-F.col("_n"), F.col(col)))).alias(alias)
    return count.groupBy(*by).agg(best) if by else count.agg(best)


def scalar_row(one_row: DataFrame):
    """The single row of a one-row aggregate (bounded: a few numbers reach the driver)."""
    return one_row.first()


def value_share(df: DataFrame, col: str, top: int | None = None, alias: str = "count",
                pct_col: str = "percentage") -> DataFrame:
    """``value_counts`` with the share of all rows (NULLs counted in the total only)."""
    total = scalar_row(df.agg(F.count(F.lit(1)).alias("n")))["n"]
    out = (df.filter(F.col(col).isNotNull()).groupBy(col).agg(F.count(F.lit(1)).alias(alias))
           .select(col, alias, F.try_divide(F.col(alias) * 100.0, F.lit(total).cast("double")).alias(pct_col))
           .orderBy(F.col(alias).desc(), F.col(col)))
    return out.limit(top) if top else out


def hourly_counts(df: DataFrame, ts_col: str, alias: str = "count") -> DataFrame:
    return (df.filter(F.col(ts_col).isNotNull()).groupBy(F.hour(ts_col).cast("long").alias("hour"))
            .agg(F.count(F.lit(1)).alias(alias)).orderBy("hour"))


def histogram_bins(df: DataFrame, col: str, bins: int = 50, low: float | None = None,
                   high: float | None = None) -> DataFrame:
    """Fixed-width bin counts between min and max (last bin closed, as numpy).

    The two bounds are a one-row aggregate read as scalars; the binning itself is
    one distributed ``groupBy`` over literal bounds.
    """
    v = F.col(col)
    data = df.filter(v.isNotNull())
    if low is not None:
        data = data.filter(v > low)
    if high is not None:
        data = data.filter(v < high)
    b = scalar_row(data.agg(F.min(v).cast("double").alias("lo"), F.max(v).cast("double").alias("hi")))
    lo, hi = b["lo"], b["hi"]
    if lo is None:
        return data.select(F.lit(0).alias("bin"), F.lit(0.0).alias("bin_start"), F.lit(0.0).alias("bin_end"),
                           F.lit(0).cast("long").alias("count")).limit(0)
    width = (hi - lo) / bins
    if width == 0:
        idx = F.lit(0)
    else:
        idx = F.least(F.floor((v - F.lit(lo)) / F.lit(width)).cast("int"), F.lit(bins - 1))
    return (data.groupBy(idx.alias("bin")).agg(F.count(F.lit(1)).alias("count"))
            .select("bin", (F.lit(lo) + F.col("bin") * F.lit(width)).alias("bin_start"),
                    (F.lit(lo) + (F.col("bin") + 1) * F.lit(width)).alias("bin_end"), "count")
            .orderBy("bin"))


def boxplot_stats(df: DataFrame, group: str, value: str, min_rows: int = 10) -> DataFrame:
    """Five-number summary per group, only groups with more than ``min_rows`` rows.

    Quartiles are exact and interpolated (:func:`grouped_exact_percentiles`: no
    per-group value map); min / max / n come from one algebraic aggregate."""
    from stayflow.operators.quantiles import grouped_exact_percentiles
    v = F.col(value)
    data = df.filter(v.isNotNull() & F.col(group).isNotNull())
    mm = data.groupBy(group).agg(F.count(v).alias("n"), F.min(v).alias("min"), F.max(v).alias("max"))
    q = grouped_exact_percentiles(data, [group], value, [0.25, 0.5, 0.75], ["q1", "median", "q3"]).drop("n")
    return (mm.filter(F.col("n") > min_rows).join(q, group, "inner")
            .select(group, "n", "min", "q1", "median", "q3", "max"))


def rate_percent(df: DataFrame, flag: str, alias: str = "rate_pct") -> DataFrame:
    return df.agg((F.avg(F.col(flag).cast("double")) * 100).alias(alias))


def count_where(df: DataFrame, predicate: Column, alias: str = "matching") -> DataFrame:
    """Rows meeting ``predicate``, the total, and the share (%)."""
    return df.agg(F.count_if(predicate).alias(alias), F.count(F.lit(1)).alias("total")).withColumn(
        "percentage", F.try_divide(F.col(alias) * 100.0, F.col("total")))
