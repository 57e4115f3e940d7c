"""Model preparation on Spark: missing profile, target cleaning, imputation,
encoding, split and scaling.

The reference moved the whole feature table into pandas for these steps; here
each is a DataFrame transformation.  Global statistics (medians, modes,
quantiles, means) are computed for all columns together and read back as a handful of
scalars, then applied with column expressions -- no per-column scan, no join.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import NumericType, StringType

from stayflow.operators.quantiles import exact_percentiles
from stayflow.session import materialize

VITAL_MARKERS = ("heart_rate", "respiratory_rate", "spo2")
# Feature groups of the baseline model step.
BASELINE_DEMOGRAPHIC = ["GENDER", "age_at_admission"]
BASELINE_ADMIN = ["ADMISSION_TYPE", "FIRST_CAREUNIT", "INSURANCE"]
BASELINE_VITALS = [f"{v}_{s}" for v in VITAL_MARKERS for s in ("avg", "min", "max", "std", "count")]
ENHANCED_EXCLUDE = ["LOS", "ICUSTAY_ID", "DIAGNOSIS"]
# Known only after the stay (defect D8): kept in the feature table, not used as model inputs.
LEAKAGE_COLUMNS = ["EXPIRE_FLAG", "HOSPITAL_EXPIRE_FLAG", "age_mortality_risk", "diagnosis_mortality_risk"]


def _q(c: str) -> str:
    return f"`{c}`"


def missing_profile(df: DataFrame) -> DataFrame:
    """(column, missing_count, missing_percentage, data_type), most missing first."""
    cols = df.columns
    one = df.agg(F.count(F.lit(1)).alias("n__"),
                 *[F.count_if(F.col(_q(c)).isNull()).alias(f"m__{i}") for i, c in enumerate(cols)])
    types = dict(df.dtypes)
    parts = ", ".join(f"'{c}', `m__{i}`, '{types[c]}'" for i, c in enumerate(cols))
    long = one.selectExpr(f"stack({len(cols)}, {parts}) AS (column, missing_count, data_type)", "n__")
    return (long.select("column", "missing_count",
                        F.try_divide(F.col("missing_count") * 100.0, F.col("n__")).alias("missing_percentage"),
                        "data_type")
            .orderBy(F.col("missing_percentage").desc(), F.col("column")))


def target_clean_fixed(df: DataFrame, target: str = "LOS", threshold: float = 30.0) -> DataFrame:
    """Drop NULL / non-positive targets and targets above ``threshold``."""
    t = F.col(target)
    return df.filter(t.isNotNull() & (t > 0) & (t <= threshold))


def target_clean_report(df: DataFrame, target: str = "LOS", threshold: float = 30.0) -> DataFrame:
    """One row: input rows, invalid (NULL or <= 0) removed, outliers removed, kept."""
    t = F.col(target)
    valid = t.isNotNull() & (t > 0)
    return df.agg(F.count(F.lit(1)).alias("input_rows"),
                  F.count_if(~F.coalesce(valid, F.lit(False))).alias("invalid_removed"),
                  F.count_if(valid & (t > threshold)).alias("outliers_removed"),
                  F.count_if(valid & (t <= threshold)).alias("kept_rows"))


def iqr_threshold(df: DataFrame, target: str = "LOS", k: float = 2.0) -> float | None:
    """Q3 + k * (Q3 - Q1) of the valid targets (exact, interpolated quantiles)."""
    t = F.col(target)
    q = exact_percentiles(df.filter(t.isNotNull() & (t > 0)), [(target, 0.25), (target, 0.75)])
    q1, q3 = q[(target, 0.25)], q[(target, 0.75)]
    if q1 is None:
        return None
    return q3 + k * (q3 - q1)


def target_clean_iqr(df: DataFrame, target: str = "LOS", k: float = 2.0) -> DataFrame:
    """Keep valid targets at or below Q3 + k * IQR (k = 2.0 in the reference)."""
    thr = iqr_threshold(df, target, k)
    t = F.col(target)
    valid = df.filter(t.isNotNull() & (t > 0))
    return valid if thr is None else valid.filter(t <= F.lit(thr))


@dataclass
class ColumnRoles:
    categorical: list[str] = field(default_factory=list)
    numeric: list[str] = field(default_factory=list)
    vital: list[str] = field(default_factory=list)
    encode: list[str] = field(default_factory=list)


# Names by which the model steps tell features apart.
FLAG_NAMES = {False: {"prefixes": ("has_",), "suffixes": (), "grouped": ()},
              True: {"prefixes": ("has_", "is_"), "suffixes": ("_abnormal", "_FLAG"), "grouped": ("group",)}}


def column_roles(df: DataFrame, features: Sequence[str], enhanced: bool = False) -> ColumnRoles:
    """Roles of the features: 0/1 flags by name, text and grouped columns to encode, the rest numeric."""
    names = FLAG_NAMES[enhanced]
    texts = {f.name for f in df.schema.fields if isinstance(f.dataType, StringType)}
    flags = {c for c in features if c.startswith(names["prefixes"]) or c.endswith(names["suffixes"] or ("\0",))}
    encode = [c for c in features if c not in flags and (c in texts or any(g in c for g in names["grouped"]))]
    numeric = [c for c in features if c not in flags and c not in encode]
    return ColumnRoles(categorical=[c for c in features if c in flags or c in encode], numeric=numeric,
                       vital=[c for c in numeric if any(v in c for v in VITAL_MARKERS)], encode=encode)


def column_modes(df: DataFrame, columns: Sequence[str]) -> dict[str, object]:
    """Most frequent non-null value of each column, the smallest on ties: one shuffle on
    (column, value) for the text columns and one for the others, so no task holds a column's values."""
    texts = {f.name for f in df.schema.fields if isinstance(f.dataType, StringType)}
    out: dict[str, object] = dict.fromkeys(columns)
    for cols, kind in (([c for c in columns if c in texts], "string"), ([c for c in columns if c not in texts], "double")):
        if cols:
            parts = ", ".join(f"{i}, CAST(`{c}` AS {kind})" for i, c in enumerate(cols))
            count = (df.selectExpr(f"stack({len(cols)}, {parts}) AS (k, v)").filter("v IS NOT NULL")
                     .groupBy("k", "v").agg(F.count(F.lit(1)).alias("n")))
            for r in count.groupBy("k").agg(F.min_by("v", F.struct(-F.col("n"), "v")).alias("v")).collect():
                out[cols[r["k"]]] = r["v"]
    return out


def imputation_values(df: DataFrame, roles: ColumnRoles) -> dict:
    """Fill values: mode for categorical columns, 0 for ``*count*`` numeric columns, exact
    median for the other numeric columns.  Columns without missing values get no fill (as
    the reference); one aggregate finds them."""
    aggs = [F.count_if(F.col(_q(c)).isNull()).alias(f"n__c{i}") for i, c in enumerate(roles.categorical)]
    for i, c in enumerate(roles.numeric):
        aggs.append(F.count_if(F.col(_q(c)).isNull()).alias(f"n__n{i}"))
    if not aggs:
        return {}
    row = df.agg(*aggs).first()
    # medians only for the numeric columns that have gaps
    need = [c for i, c in enumerate(roles.numeric) if row[f"n__n{i}"] and "count" not in c]
    medians = exact_percentiles(df, [(c, 0.5) for c in need])
    modes = column_modes(df, [c for i, c in enumerate(roles.categorical) if row[f"n__c{i}"]])
    fills = {}
    for i, c in enumerate(roles.categorical):
        if row[f"n__c{i}"]:
            v = modes[c]
            fills[c] = "Unknown" if v is None else v
    for i, c in enumerate(roles.numeric):
        if row[f"n__n{i}"]:
            fills[c] = 0 if "count" in c else medians[(c, 0.5)]
    return fills


def apply_fills(df: DataFrame, fills: Mapping[str, object]) -> DataFrame:
    """``coalesce(col, fill)`` per filled column; a float fill of a numeric column
    makes it double (as pandas, where a missing value already made it float)."""
    cols = []
    for f in df.schema.fields:
        v = fills.get(f.name)
        c = F.col(_q(f.name))
        if v is None:
            cols.append(c)
        elif isinstance(f.dataType, NumericType) and isinstance(v, float):
            cols.append(F.coalesce(c.cast("double"), F.lit(v)).alias(f.name))
        else:
            cols.append(F.coalesce(c, F.lit(v).cast(f.dataType)).alias(f.name))
    return df.select(*cols)


def impute_features(df: DataFrame, roles: ColumnRoles, numeric_as_double: bool = False) -> DataFrame:
    """Fill missing values.  With ``numeric_as_double`` every non-count numeric feature leaves as double, whether
    or not it had gaps (a stable schema for the model matrix)."""
    return with_fills(df, roles, imputation_values(df, roles), numeric_as_double)


def with_fills(df: DataFrame, roles: ColumnRoles, fills: Mapping[str, object], numeric_as_double: bool = False) -> DataFrame:
    """:func:`impute_features` with fill values known before (from the training rows)."""
    out = apply_fills(df, fills)
    if numeric_as_double:
        to_double = {c for c in roles.numeric if "count" not in c}
        out = out.select(*[F.col(_q(c)).cast("double").alias(c) if c in to_double else F.col(_q(c))
                           for c in out.columns])
    return out


#: Distinct levels that a column may have as columns of its own; beyond, :func:`one_hot_sparse`.
WIDE_LEVELS = 10_000


def level_table(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(k, level, place): the distinct non-null levels of every column (by its number), as text for text
    columns, numbered from 0 in order.  Ranges of levels are numbered in their own tasks from the ranges'
    counts, so no task holds a column's levels."""
    texts = {f.name for f in df.schema.fields if isinstance(f.dataType, StringType)}
    parts = ", ".join(f"{i}, CAST(`{c}` AS string), {'CAST(NULL AS double)' if c in texts else f'CAST(`{c}` AS double)'}" for i, c in enumerate(columns))
    levels = (df.selectExpr(f"stack({len(columns)}, {parts}) AS (k, level, number)").filter("level IS NOT NULL").distinct()
              .repartitionByRange("k", "number", "level").sortWithinPartitions("k", "number", "level"))
    levels = materialize(levels.withColumn("at", F.monotonically_increasing_id())).withColumn("range", F.shiftright("at", 33))
    sizes = levels.groupBy("k", "range").agg(F.count(F.lit(1)).alias("n"), F.min("at").alias("first"))
    before = Window.partitionBy("k").orderBy("range").rowsBetween(Window.unboundedPreceding, -1)  # a row for each range
    sizes = sizes.withColumn("before", F.coalesce(F.sum("n").over(before), F.lit(0))).drop("n")
    return levels.join(sizes, ["k", "range"]).select("k", "level", (F.col("at") - F.col("first") + F.col("before")).alias("place"))


def category_levels(df: DataFrame, columns: Sequence[str], limit: int = WIDE_LEVELS) -> dict[str, list]:
    """Sorted distinct non-null levels per categorical column, from one job.

    They become columns, so a column may have ``limit`` of them at most; one with more raises and
    is for :func:`one_hot_sparse`.
    """
    if not columns:
        return {}
    kinds = dict(df.dtypes)
    parts = ", ".join(f"{i}, CAST(`{c}` AS string)" for i, c in enumerate(columns))
    rows = df.selectExpr(f"stack({len(columns)}, {parts}) AS (k, level)").filter("level IS NOT NULL").distinct().limit(
        limit * len(columns) + 1).collect()
    out: dict[str, list] = {c: [] for c in columns}
    for r in rows:
        out[columns[r["k"]]].append(r["level"])
    for c, levels in out.items():
        if len(levels) > limit or len(rows) > limit * len(columns):
            raise ValueError(f"{c} has more than {limit} levels; use one_hot_sparse")
        if kinds[c] != "string":
            levels[:] = [float(v) if kinds[c] in ("double", "float") else int(v) if kinds[c] in ("int", "bigint", "smallint", "tinyint") else v for v in levels]
        levels.sort()
    return out


def one_hot_sparse(df: DataFrame, columns: Sequence[str], key: str, drop_first: bool = False) -> DataFrame:
    """``key`` and ``indices``: the places of a row's levels among the dummy columns of all ``columns``, ascending.

    The levels stay a table (:func:`level_table`) and are joined, so any number of them is taken.
    A null has no place; with ``drop_first`` neither has a column's first level.
    """
    levels = level_table(df, columns)
    first = 1 if drop_first else 0
    sizes = levels.groupBy("k").agg(F.max("place").alias("last")).collect()  # one row for each column
    width = {r["k"]: r["last"] + 1 - first for r in sizes}
    offset = {k: sum(width.get(j, 0) for j in range(k)) for k in range(len(columns))}
    starts = F.element_at(F.create_map(*[F.lit(v) for k in range(len(columns)) for v in (k, int(offset[k]) - first)]), F.col("k"))
    parts = ", ".join(f"{i}, CAST(`{c}` AS string)" for i, c in enumerate(columns))
    long = df.selectExpr(f"`{key}`", f"stack({len(columns)}, {parts}) AS (k, level)").filter("level IS NOT NULL")
    at = long.join(levels.filter(F.col("place") >= first), ["k", "level"]).select(key, (F.col("place") + starts).alias("at"))
    grouped = at.groupBy(key).agg(F.sort_array(F.collect_list("at")).alias("indices"))
    return df.select(key).join(grouped, key, "left").select(key, F.coalesce("indices", F.array().cast("array<bigint>")).alias("indices"))


def one_hot(df: DataFrame, columns: Sequence[str], drop_first: bool = False,
            levels: Mapping[str, list] | None = None) -> DataFrame:
    """``get_dummies``: one 0/1 column ``{col}_{level}`` per sorted level, source column
    removed; ``drop_first`` drops the first level.  NULL -> all zeros."""
    levels = dict(levels or category_levels(df, columns))
    keep = [F.col(_q(c)) for c in df.columns if c not in set(columns)]
    dummies = []
    for c in columns:
        lv = levels[c][1:] if drop_first else levels[c]
        dummies += [F.when(F.col(_q(c)) == F.lit(v), 1).otherwise(0).alias(f"{c}_{v}") for v in lv]
    return df.select(*keep, *dummies)


# Knuth's multiplicative hash: reproducible in any SQL engine, unlike a seeded RNG.  The key
# is reduced first, so no key overflows a 64-bit product.
SPLIT_MULTIPLIER = 2654435761
SPLIT_MODULUS = 4294967296
KEY_MODULUS = 2147483648


def split_bucket(key_col: str, buckets: int = 100):
    reduced = F.pmod(F.col(key_col).cast("long"), F.lit(KEY_MODULUS))
    return F.pmod(F.pmod(reduced * F.lit(SPLIT_MULTIPLIER), F.lit(SPLIT_MODULUS)), F.lit(buckets))


def bucket_sql(key: str, buckets: int) -> str:
    """The same number in SQL (for keys of 0 and more)."""
    return f"((({key} % {KEY_MODULUS}) * {SPLIT_MULTIPLIER}) % {SPLIT_MODULUS}) % {buckets}"


def with_split(df: DataFrame, key: str = "ICUSTAY_ID", test_pct: int = 20, out: str = "split") -> DataFrame:
    """80/20 split by a hash of the key (stable across runs, engines and partitionings)."""
    return df.withColumn(out, F.when(split_bucket(key) < test_pct, "test").otherwise("train"))


def with_fold(df: DataFrame, key: str = "ICUSTAY_ID", k: int = 5, out: str = "fold") -> DataFrame:
    return df.withColumn(out, split_bucket(key, k).cast("int"))


@dataclass
class Preparation:
    """Fill values and levels learned on training rows, to be applied to any rows."""
    roles: ColumnRoles
    fills: dict
    levels: dict[str, list]
    drop_first: bool = False

    @staticmethod
    def fit(train: DataFrame, features: Sequence[str], enhanced: bool = False) -> Preparation:
        roles = column_roles(train, features, enhanced)
        fills = imputation_values(train, roles)
        return Preparation(roles, fills, category_levels(with_fills(train, roles, fills), roles.encode), drop_first=enhanced)

    def apply(self, df: DataFrame) -> DataFrame:
        """Filled and encoded rows; a level that training did not have encodes as all zeros.
        A gap in a column that had none in training is filled with 0."""
        out = one_hot(with_fills(df, self.roles, self.fills, numeric_as_double=True), self.roles.encode, self.drop_first, self.levels)
        return out.fillna(0, subset=self.roles.numeric)


def scaling_stats(df: DataFrame, columns: Sequence[str], robust: bool = False) -> dict[str, tuple[float, float]]:
    """(center, scale) per column: (mean, population std) from one aggregate, or
    (median, Q3 - Q1) from the distributed exact quantiles."""
    out = {}
    if robust:
        q = exact_percentiles(df, [(c, p) for c in columns for p in (0.25, 0.5, 0.75)])
        for c in columns:
            q1, med, q3 = q[(c, 0.25)], q[(c, 0.5)], q[(c, 0.75)]
            out[c] = (med, (q3 - q1) if q3 is not None else None)
        return out
    aggs = []
    for i, c in enumerate(columns):
        x = F.col(_q(c)).cast("double")
        aggs += [F.avg(x).alias(f"a{i}"), F.stddev_pop(x).alias(f"s{i}")]
    row = df.agg(*aggs).first()
    for i, c in enumerate(columns):
        out[c] = (row[f"a{i}"], row[f"s{i}"])
    return out


def apply_scaling(df: DataFrame, stats: Mapping[str, tuple[float, float]], suffix: str = "") -> DataFrame:
    """(x - center) / scale; a zero scale leaves x - center (as sklearn)."""
    cols = []
    for c in df.columns:
        if c in stats:
            center, scale = stats[c]
            x = F.col(_q(c)).cast("double") - F.lit(center)
            if scale:
                x = x / F.lit(scale)
            cols.append(x.alias(c + suffix))
            if suffix:
                cols.append(F.col(_q(c)))
        else:
            cols.append(F.col(_q(c)))
    return df.select(*cols)


def standard_scale(df: DataFrame, columns: Sequence[str], fit_on: DataFrame | None = None) -> DataFrame:
    return apply_scaling(df, scaling_stats(fit_on if fit_on is not None else df, columns))


def robust_scale(df: DataFrame, columns: Sequence[str], fit_on: DataFrame | None = None) -> DataFrame:
    return apply_scaling(df, scaling_stats(fit_on if fit_on is not None else df, columns, robust=True))
