"""Registered queries: model preparation and models (survey section 2.9).

All run on the feature table of the test roles (see :mod:`stayflow.catalog.features`).
Preparation steps and one-feature fits have SQL oracles; models on all features are
checked on rows only (their exact values depend on the learner).
"""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from stayflow.catalog import query
from stayflow.catalog.features import FEATURE_SQL, _feature_table
from stayflow.functions.codes import FLAG_COLUMNS
from stayflow.operators.quantiles import exact_percentile
from stayflow.plans import enhanced as X
from stayflow.plans import linear
from stayflow.plans import mlprep as P
from stayflow.plans import models as M
from stayflow.plans.trees import HELD_OUT
from stayflow.session import materialize
from stayflow.sources import testmap as tm

_OV = tm.TEST_ORDER_VITALS
_VCOLS = [f"{n}_{s}" for n in _OV for s in ("avg", "min", "max", "std", "count")]
# Column types of the feature table of the test roles (the oracle reports Spark's names).
FEATURE_TYPES = ({"ICUSTAY_ID": "bigint", "FIRST_CAREUNIT": "string", "LOS": "double", "ADMISSION_TYPE": "string",
                  "INSURANCE": "string", "GENDER": "string", "EXPIRE_FLAG": "int"}
                 | {c: "int" for c in FLAG_COLUMNS} | {"total_diagnoses": "bigint"}
                 | {c: ("bigint" if c.endswith("_count") else "double") for c in _VCOLS}
                 | {"age_at_admission": "double"})
BASELINE_FEATURES = (P.BASELINE_DEMOGRAPHIC + P.BASELINE_ADMIN + FLAG_COLUMNS + ["total_diagnoses"] + _VCOLS)


@query("missing_profile", dbl="missing_percentage", sql=f"""
WITH ft AS ({FEATURE_SQL}),
m AS (SELECT count(*) AS n, {', '.join(f'CAST(count_if("{c}" IS NULL) AS BIGINT) AS "{c}"' for c in FEATURE_TYPES)}
      FROM ft)
SELECT u."column", u.missing_count, u.missing_count * 100.0 / m.n AS missing_percentage, t.data_type
FROM (UNPIVOT (SELECT * EXCLUDE (n) FROM m) ON COLUMNS(*) INTO NAME "column" VALUE missing_count) u,
     m, (VALUES {', '.join(f"('{c}', '{t}')" for c, t in FEATURE_TYPES.items())}) t("column", data_type)
WHERE t."column" = u."column" """)
def missing_profile(spark, d):
    return P.missing_profile(_feature_table(spark, d))


@query("target_clean_fixed", dbl="LOS", sql=f"""
SELECT ICUSTAY_ID, LOS FROM ({FEATURE_SQL}) WHERE LOS IS NOT NULL AND LOS > 0 AND LOS <= 30""")
def target_clean_fixed(spark, d):
    return P.target_clean_fixed(_feature_table(spark, d)).select("ICUSTAY_ID", "LOS")


@query("target_clean_report", sql=f"""
SELECT count(*) AS input_rows, CAST(count_if(NOT coalesce(LOS IS NOT NULL AND LOS > 0, false)) AS BIGINT)
       AS invalid_removed, CAST(count_if(LOS > 0 AND LOS > 30) AS BIGINT) AS outliers_removed,
       CAST(count_if(LOS > 0 AND LOS <= 30) AS BIGINT) AS kept_rows
FROM ({FEATURE_SQL})""")
def target_clean_report(spark, d):
    return P.target_clean_report(_feature_table(spark, d))


@query("target_clean_iqr", dbl="value", sql="""
WITH v AS (SELECT event_id, value FROM events WHERE value IS NOT NULL AND value > 0),
q AS (SELECT quantile_cont(value, 0.25) AS q1, quantile_cont(value, 0.75) AS q3 FROM v)
SELECT event_id, value FROM v, q WHERE value <= q3 + 2.0 * (q3 - q1)""")
def target_clean_iqr(spark, d):
    """IQR rule (k = 2) on the event values playing the target."""
    return P.target_clean_iqr(tm.read(spark, d, "events").select("event_id", "value"), "value", 2.0)


def _impute_sql() -> tuple[str, list[str]]:
    roles_cat = [c for c in BASELINE_FEATURES if FEATURE_TYPES[c] == "string" or c.startswith("has_")]
    cols, dbl = [], []
    for c in BASELINE_FEATURES:
        if c in roles_cat:
            mode = (f"(SELECT \"{c}\" FROM ft WHERE \"{c}\" IS NOT NULL GROUP BY \"{c}\" "
                    f"ORDER BY count(*) DESC, \"{c}\" LIMIT 1)")
            cols.append(f"coalesce(\"{c}\", {mode}) AS \"{c}\"")
        elif "count" in c:
            cols.append(f"coalesce(\"{c}\", 0) AS \"{c}\"")
        else:
            cols.append(f"CAST(coalesce(\"{c}\", (SELECT quantile_cont(\"{c}\", 0.5) FROM ft)) AS DOUBLE) AS \"{c}\"")
            dbl.append(c)
    return f"WITH ft AS ({FEATURE_SQL}) SELECT ICUSTAY_ID, {', '.join(cols)} FROM ft", dbl


_IMPUTE_SQL, _IMPUTE_DBL = _impute_sql()


def _imputed(spark, d):
    # null counts, modes and medians are read before the output: one checkpoint of the table
    ft = materialize(_feature_table(spark, d))
    roles = P.column_roles(ft, BASELINE_FEATURES)
    return P.impute_features(ft, roles, numeric_as_double=True).select("ICUSTAY_ID", *BASELINE_FEATURES)


@query("impute_features", dbl=_IMPUTE_DBL, sql=_IMPUTE_SQL)
def impute_features(spark, d):
    """Mode for categorical, 0 for counts, median for the other numeric features."""
    return _imputed(spark, d)


# The order-priority, order-status and market-segment domains of the test tables.
PRIORITIES = ["1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW"]
STATUSES = ["F", "O", "P"]
SEGMENTS = ["AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY"]


@query("one_hot", sql="SELECT ICUSTAY_ID, " + ", ".join(
    [f"CASE WHEN FIRST_CAREUNIT = '{v}' THEN 1 ELSE 0 END AS \"FIRST_CAREUNIT_{v}\"" for v in PRIORITIES]
    + [f"CASE WHEN GENDER = '{v}' THEN 1 ELSE 0 END AS \"GENDER_{v}\"" for v in SEGMENTS])
    + f" FROM ({FEATURE_SQL})")
def one_hot(spark, d):
    ft = _feature_table(spark, d).select("ICUSTAY_ID", "FIRST_CAREUNIT", "GENDER")
    return P.one_hot(ft, ["FIRST_CAREUNIT", "GENDER"])


@query("train_test_split", sql=f"""
SELECT ICUSTAY_ID, CASE WHEN {P.bucket_sql("ICUSTAY_ID", 100)} < 20 THEN 'test' ELSE 'train' END AS split
FROM ({FEATURE_SQL})""")
def train_test_split(spark, d):
    return P.with_split(_feature_table(spark, d).select("ICUSTAY_ID"))


_SCALE_COLS = ["LOS", "age_at_admission", "total_diagnoses"]


@query("standard_scale", dbl=_SCALE_COLS, sql=f"""
WITH ft AS ({FEATURE_SQL})
SELECT ICUSTAY_ID, {', '.join(f'(CAST({c} AS DOUBLE) - avg({c}) OVER ()) / stddev_pop({c}) OVER () AS {c}'
                              for c in _SCALE_COLS)}
FROM ft""")
def standard_scale(spark, d):
    ft = _feature_table(spark, d).select("ICUSTAY_ID", *_SCALE_COLS)
    return P.standard_scale(ft, _SCALE_COLS)


@query("robust_scale", dbl=_SCALE_COLS, sql=f"""
WITH ft AS ({FEATURE_SQL}),
q AS (SELECT {', '.join(f'quantile_cont({c}, 0.5) AS {c}_m, quantile_cont({c}, 0.75) - quantile_cont({c}, 0.25) AS {c}_r'
                        for c in _SCALE_COLS)} FROM ft)
SELECT ICUSTAY_ID, {', '.join(f'(CAST({c} AS DOUBLE) - q.{c}_m) / q.{c}_r AS {c}' for c in _SCALE_COLS)}
FROM ft, q""")
def robust_scale(spark, d):
    ft = _feature_table(spark, d).select("ICUSTAY_ID", *_SCALE_COLS)
    return P.robust_scale(ft, _SCALE_COLS)


# ------------------------------------------------------------------ models

_CLEAN_SQL = f"SELECT * FROM ({FEATURE_SQL}) WHERE LOS IS NOT NULL AND LOS > 0 AND LOS <= 30"


_SPLIT = P.bucket_sql("ICUSTAY_ID", 100)
_ONE = f"SELECT LOS, total_diagnoses AS x, {_SPLIT} < 20 AS held, {P.bucket_sql('ICUSTAY_ID', 5)} AS fold FROM ({_CLEAN_SQL})"


def _one_feature(spark, d):
    """LOS and the diagnosis count of the cleaned stays, with split and fold."""
    df = P.target_clean_fixed(_feature_table(spark, d)).select(
        "ICUSTAY_ID", "LOS", F.col("total_diagnoses").cast("double").alias("x"))
    return P.with_fold(P.with_split(df))


@query("regression_metrics", dbl="rmse mae r2 mape", sql=f"""
WITH c AS (SELECT * FROM ({_ONE}) WHERE NOT held), f AS (SELECT regr_slope(LOS, x) AS b, regr_intercept(LOS, x) AS a FROM c),
p AS (SELECT LOS, a + b * x AS prediction FROM c, f)
SELECT sqrt(avg((LOS - prediction) * (LOS - prediction))) AS rmse, avg(abs(LOS - prediction)) AS mae,
       1 - sum((LOS - prediction) * (LOS - prediction)) / (var_pop(LOS) * count(LOS)) AS r2,
       avg(abs((LOS - prediction) / LOS)) * 100 AS mape
FROM p""")
def regression_metrics(spark, d):
    """RMSE, MAE, R², MAPE of the one-feature OLS predictions (one aggregate)."""
    df = M.assemble(_one_feature(spark, d).filter("split = 'train'"), ["x"])
    model = M.make_estimator({"kind": "linear"}, "LOS").fit(df)
    return M.regression_metrics(model.transform(df), "LOS")


def _data(spark, d, enhanced: bool = False):
    """(training rows, hold-out rows, feature columns), prepared on training rows only.

    Split first; the enhanced set's outlier bound, fill values and levels come from the
    training rows and are applied to both.  The feature table is written once and the
    prepared rows once, however many models read them.
    """
    raw, feats = _raw(spark, d, enhanced)
    prep = P.Preparation.fit(raw.filter("split = 'train'"), feats, enhanced)
    rows = materialize(prep.apply(raw.select("ICUSTAY_ID", "LOS", "split", *feats)))
    train, test = (rows.filter(F.col("split") == s).drop("split") for s in ("train", "test"))
    return train, test, [c for c in train.columns if c not in ("ICUSTAY_ID", "LOS")]


def _raw(spark, d, enhanced: bool = False):
    """Cleaned rows with split column, before imputation, and the feature names."""
    ft = P.with_split(_feature_table(spark, d))
    if not enhanced:
        return materialize(P.target_clean_fixed(ft).select("ICUSTAY_ID", "LOS", "split", *BASELINE_FEATURES)), BASELINE_FEATURES
    ft = X.create_enhanced_features(materialize(ft))
    # outcome-derived columns are known only after the stay (leakage, defect D8): not features.
    # The discharge codes stay features, as in the published models.
    feats = [c for c in ft.columns if c not in P.ENHANCED_EXCLUDE + P.LEAKAGE_COLUMNS + ["split"]]
    ft = materialize(ft.select("ICUSTAY_ID", "LOS", "split", *feats))
    bound = P.iqr_threshold(ft.filter("split = 'train'"), "LOS", 2.0)
    return (ft.filter("LOS > 0") if bound is None else ft.filter((F.col("LOS") > 0) & (F.col("LOS") <= F.lit(bound)))), feats


# Rows and label statistics of the hold-out set, checked in SQL next to metrics that SQL cannot give.
_HELD_SQL = f"(SELECT count(*) AS held_rows, avg(LOS) AS held_mean FROM ({_ONE}) WHERE held)"


def _with_held(res, test):
    one = test.agg(F.count(F.lit(1)).alias("held_rows"), F.avg("LOS").alias("held_mean")).first()
    return res.withColumns({"held_rows": F.lit(one["held_rows"]), "held_mean": F.lit(one["held_mean"])})


def _coefficients(spark, d, kind, **kw):
    """Coefficients on the scaled features, with the one-feature fit of the same kind beside them."""
    train, _, feats = _data(spark, d)
    total = linear.learned_from(linear.products(train.withColumn("fold", F.lit(0)), feats, "ICUSTAY_ID", "fold", "LOS"), HELD_OUT)
    weights, intercept = linear.solve(linear.scaled(total, linear.standard_scales(total)), {"kind": kind, **kw})
    rows = [*zip(feats, map(float, weights), strict=True), ("(intercept)", intercept)]
    return spark.createDataFrame(rows, "feature string, coefficient double")


def _one_coefficient(spark, d, kind, **kw):
    """The same model kind on one scaled feature: its closed form is SQL."""
    one = _one_feature(spark, d).filter("split = 'train'")
    n, s = M._label_stats(one, "LOS")
    z = M.assemble(P.apply_scaling(one, P.scaling_stats(one, ["x"])), ["x"])
    model = M.make_estimator({"kind": kind, **kw}, "LOS", "features", n, s).fit(z)
    return spark.createDataFrame([(float(model.coefficients[0]), float(model.intercept))], "coefficient double, intercept double")


def _closed_form(l1: float, l2_total: float) -> str:
    """One standardised feature: (cov - l1, not past 0) / (1 + l2 / n); the intercept is the label's mean."""
    return f"""
WITH c AS (SELECT LOS, (x - avg(x) OVER ()) / stddev_pop(x) OVER () AS z FROM ({_ONE}) WHERE NOT held),
s AS (SELECT covar_pop(LOS, z) AS c, count(*) AS n, avg(LOS) AS m FROM c)
SELECT sign(c) * greatest(abs(c) - {l1}, 0) / (1 + {l2_total}) AS coefficient, m AS intercept FROM s"""


@query("linear_regression", dbl="coefficient intercept", sql=_closed_form(0.0, "0.0"))
def linear_regression(spark, d):
    """Ordinary least squares of LOS on one scaled feature (closed form in SQL)."""
    return _one_coefficient(spark, d, "linear")


@query("ridge_regression", dbl="coefficient intercept", sql=_closed_form(0.0, "1.0 / n"))
def ridge_regression(spark, d):
    """Ridge, alpha 1.0."""
    return _one_coefficient(spark, d, "ridge", alpha=1.0)


@query("lasso_regression", dbl="coefficient intercept", sql=_closed_form(0.1, "0.0"))
def lasso_regression(spark, d):
    """Lasso, alpha 0.1."""
    return _one_coefficient(spark, d, "lasso", alpha=0.1)


@query("elastic_net", dbl="coefficient intercept", sql=_closed_form(0.05, "0.05"))
def elastic_net(spark, d):
    """Elastic net, alpha 0.1, half L1."""
    return _one_coefficient(spark, d, "elastic_net", alpha=0.1, l1_ratio=0.5)


def _ridge_sql(alpha: float) -> str:
    """Normal equations of ridge on all scaled features, solved by elimination: means, fills and levels of the
    training rows, one matrix of sums of products, a pivot in each step."""
    exprs = {}
    for c in BASELINE_FEATURES:
        if c in (*P.BASELINE_ADMIN, "GENDER"):
            mode = f'(SELECT "{c}" FROM tr WHERE "{c}" IS NOT NULL GROUP BY "{c}" ORDER BY count(*) DESC, "{c}" LIMIT 1)'
            levels = SEGMENTS if c == "GENDER" else STATUSES if c == "INSURANCE" else PRIORITIES
            exprs |= {f"{c}_{v}": f"CASE WHEN coalesce(\"{c}\", {mode}) = '{v}' THEN 1.0 ELSE 0.0 END" for v in levels}
        elif c.startswith("has_"):
            exprs[c] = f'coalesce("{c}", (SELECT "{c}" FROM tr WHERE "{c}" IS NOT NULL GROUP BY "{c}" ORDER BY count(*) DESC, "{c}" LIMIT 1))'
        else:
            exprs[c] = f'coalesce("{c}", {"0" if "count" in c else f"(SELECT quantile_cont(CAST({c} AS DOUBLE), 0.5) FROM tr)"})'
    p = len(exprs)
    rows = ", ".join("[" + ", ".join([f"sum(z{min(i, j)} * z{max(i, j)})" + (f" + {alpha}" if i == j else "") for j in range(p)] + [f"sum(z{i} * y)"]) + "]"
                     for i in range(p))
    return f"""SELECT * FROM (WITH RECURSIVE tr AS MATERIALIZED (SELECT * FROM ({_CLEAN_SQL}) WHERE {_SPLIT} >= 20),
x AS MATERIALIZED (SELECT CAST(LOS AS DOUBLE) AS LOS, {', '.join(f'CAST({e} AS DOUBLE) AS x{i}' for i, e in enumerate(exprs.values()))} FROM tr),
s AS (SELECT avg(LOS) AS m, {', '.join(f'avg(x{i}) AS a{i}, stddev_pop(x{i}) AS s{i}' for i in range(p))} FROM x),
z AS MATERIALIZED (SELECT LOS - m AS y, {', '.join(f'(x{i} - a{i}) / CASE WHEN s{i} > 1e-12 * abs(a{i}) THEN s{i} ELSE 1 END AS z{i}' for i in range(p))} FROM x, s),
el(k, m) AS (
  SELECT 0, [{rows}] FROM z
  UNION ALL
  SELECT k + 1, list_transform(m, lambda r, i: CASE WHEN i = k + 1 THEN list_transform(r, lambda v: v / top[k + 1])
                                               ELSE list_transform(r, lambda v, j: v - r[k + 1] * top[j] / top[k + 1]) END)
  FROM (SELECT k, m, m[k + 1] AS top FROM el) WHERE k < {p})
SELECT feature, m[i][{p + 1}] AS coefficient FROM el, (VALUES {', '.join(f"({i + 1}, '{c}')" for i, c in enumerate(exprs))}) names(i, feature) WHERE k = {p}
UNION ALL SELECT '(intercept)', m FROM s)"""


@query("linear_regression_all")
def linear_regression_all(spark, d):
    """Ordinary least squares on all scaled features."""
    return _coefficients(spark, d, "linear")


@query("ridge_regression_all", dbl="coefficient", sql=_ridge_sql(1.0))
def ridge_regression_all(spark, d):
    """Ridge, alpha 1.0, on all scaled features."""
    return _coefficients(spark, d, "ridge", alpha=1.0)


@query("lasso_regression_all")
def lasso_regression_all(spark, d):
    """Lasso, alpha 0.1, on all scaled features."""
    return _coefficients(spark, d, "lasso", alpha=0.1)


@query("elastic_net_all")
def elastic_net_all(spark, d):
    return _coefficients(spark, d, "elastic_net", alpha=0.1, l1_ratio=0.5)


@query("column_roles", sql="SELECT * FROM (VALUES " + ", ".join(
    f"('{c}', '{'flag' if c.startswith('has_') else 'encoded' if FEATURE_TYPES[c] == 'string' else 'vital' if any(v in c for v in P.VITAL_MARKERS) else 'numeric'}')"
    for c in BASELINE_FEATURES) + f""") r(feature, role), (SELECT count(*) AS rows FROM ({FEATURE_SQL}))""")
def column_roles(spark, d):
    """Role of every baseline feature in the model step."""
    ft = _feature_table(spark, d)
    roles = P.column_roles(ft, BASELINE_FEATURES)
    named = {c: "encoded" if c in roles.encode else "flag" if c in roles.categorical else "vital" if c in roles.vital else "numeric"
             for c in BASELINE_FEATURES}
    rows = ", ".join(f"'{c}', '{r}'" for c, r in named.items())
    return ft.agg(F.count(F.lit(1)).alias("rows")).selectExpr(f"stack({len(named)}, {rows}) AS (feature, role)", "rows")


@query("cache_reuse", dbl="mean_los", sql=f"""
SELECT FIRST_CAREUNIT, count(*) AS stays, avg(LOS) AS mean_los, (SELECT count(*) FROM ({FEATURE_SQL})) AS all_stays
FROM ({FEATURE_SQL}) GROUP BY FIRST_CAREUNIT""")
def cache_reuse(spark, d):
    """The feature table written once and read by two aggregates."""
    ft = materialize(_feature_table(spark, d).select("FIRST_CAREUNIT", "LOS"))
    total = ft.agg(F.count(F.lit(1)).alias("all_stays"))
    return ft.groupBy("FIRST_CAREUNIT").agg(F.count(F.lit(1)).alias("stays"), F.avg("LOS").alias("mean_los")).withColumn(
        "all_stays", total.scalar())


def _holdout(spark, d, models, enhanced: bool = False, keep_nodes: bool = False):
    train, test, feats = _data(spark, d, enhanced)
    res, fitted = M.fit_evaluate(train, test, models, feats, robust=enhanced, keep_nodes=keep_nodes)
    return _with_held(res, test), fitted, feats


def _only(name, models):
    return {name: models[name]}


@query("random_forest")
def random_forest(spark, d):
    """100-tree forest, hold-out metrics."""
    return _holdout(spark, d, _only("Random Forest", M.BASELINE_MODELS))[0]


@query("gradient_boosting")
def gradient_boosting(spark, d):
    """100 boosting rounds, depth 3, hold-out metrics."""
    return _holdout(spark, d, _only("Gradient Boosting", M.BASELINE_MODELS))[0]


@query("holdout_rows", dbl="held_mean", sql=f"SELECT * FROM {_HELD_SQL}")
def holdout_rows(spark, d):
    """Rows and label mean of the hold-out set that every baseline model is scored on."""
    _, test, _ = _data(spark, d)
    return test.agg(F.count(F.lit(1)).alias("held_rows"), F.avg("LOS").alias("held_mean"))


@query("los_baseline_models")
def los_baseline_models(spark, d):
    """Clean -> split -> impute -> encode -> linear, forest, boosting -> hold-out metrics, ranked."""
    return M.rank_models(_holdout(spark, d, M.BASELINE_MODELS)[0])


@query("rank_models", dbl="rmse", sql=f"""
WITH c AS ({_ONE}), t AS (SELECT * FROM c WHERE NOT held),
f AS (SELECT regr_slope(LOS, x) AS b, regr_intercept(LOS, x) AS a, avg(LOS) AS m, median(LOS) AS d FROM t)
SELECT model, rmse, row_number() OVER (ORDER BY rmse, model) AS rank FROM (
  SELECT 'line' AS model, sqrt(avg((LOS - a - b * x) ** 2)) AS rmse FROM c, f WHERE held
  UNION ALL SELECT 'mean', sqrt(avg((LOS - m) ** 2)) FROM c, f WHERE held
  UNION ALL SELECT 'median', sqrt(avg((LOS - d) ** 2)) FROM c, f WHERE held)""")
def rank_models(spark, d):
    """Ranking of hold-out results: one-feature line, training mean and training median."""
    df = M.assemble(materialize(_one_feature(spark, d)), ["x"])
    train, test = df.filter("split = 'train'"), df.filter("split = 'test'")
    fits = {"line": M.make_estimator({"kind": "linear"}, "LOS").fit(train).transform(test)}
    for name, value in (("mean", train.agg(F.avg("LOS")).first()[0]), ("median", exact_percentile(train, "LOS", 0.5))):
        fits[name] = test.withColumn("prediction", F.lit(value))
    rows = None
    for name, pred in fits.items():
        one = M.regression_metrics(pred, "LOS").select(F.lit(name).alias("model"), "rmse")
        rows = one if rows is None else rows.unionByName(one)
    ranked = M.rank_models(rows)
    return ranked.withColumn("rank", F.row_number().over(Window.orderBy("rmse", "model")).cast("long"))  # three rows


@query("feature_importance")
def feature_importance(spark, d):
    """Top 20 importances of the enhanced forest, with rank, family and whether an engineered feature made the top 10."""
    _, fitted, feats = _holdout(spark, d, _only("Random Forest", M.ENHANCED_MODELS), enhanced=True, keep_nodes=True)
    top = M.feature_family(M.feature_importance(fitted["Random Forest"], feats, 20))
    ranked = top.withColumn("rank", F.row_number().over(Window.orderBy(F.desc("importance"), "feature")))  # twenty rows
    return ranked.withColumn("new_in_top_10", (F.col("rank") <= 10) & ~F.col("feature").isin(BASELINE_FEATURES))


@query("kfold_cv", dbl="cv_rmse_mean cv_rmse_std cv_mae_mean cv_mae_std cv_r2_mean cv_r2_std", sql=f"""
WITH c AS (SELECT * FROM ({_ONE}) WHERE NOT held), k AS (SELECT unnest(range(5)) AS i),
f AS (SELECT i, regr_slope(LOS, x) AS b, regr_intercept(LOS, x) AS a FROM c, k WHERE fold <> i GROUP BY i),
m AS (SELECT i, sqrt(avg((LOS - a - b * x) ** 2)) AS rmse, avg(abs(LOS - a - b * x)) AS mae,
             1 - sum((LOS - a - b * x) ** 2) / (var_pop(LOS) * count(*)) AS r2 FROM c JOIN f ON fold = i GROUP BY i)
SELECT 'Linear Regression' AS model, avg(rmse) AS cv_rmse_mean, stddev_pop(rmse) AS cv_rmse_std, avg(mae) AS cv_mae_mean,
       stddev_pop(mae) AS cv_mae_std, avg(r2) AS cv_r2_mean, stddev_pop(r2) AS cv_r2_std FROM m""")
def kfold_cv(spark, d):
    """5-fold CV of the one-feature line on the training rows, checked in SQL."""
    df = materialize(_one_feature(spark, d).filter("split = 'train'"))
    return M.kfold_cv(df.drop("split"), _only("Linear Regression", M.BASELINE_MODELS), ["x"], "LOS", "fold", 5)


def _folds(spark, d, names, enhanced: bool = False):
    raw, feats = _raw(spark, d, enhanced)
    k, models = (10, M.ENHANCED_MODELS) if enhanced else (5, M.BASELINE_MODELS)
    df = P.with_fold(raw.filter("split = 'train'"), "ICUSTAY_ID", k)
    return M.kfold_cv(df, {n: models[n] for n in names}, feats, "LOS", "fold", k, enhanced)


def _register_cv():
    """One query per model of both sets: 5 folds of the baseline models, 10 of the enhanced ones."""
    for enhanced, models in ((False, M.BASELINE_MODELS), (True, M.ENHANCED_MODELS)):
        for name in models:
            label = name.lower().replace(" (", "_").replace(")", "").replace(" ", "_")

            def fn(spark, d, name=name, enhanced=enhanced):
                return _folds(spark, d, [name], enhanced)

            fn.__name__ = f"kfold_{'enhanced' if enhanced else 'baseline'}_{label}"
            fn.__doc__ = f"{10 if enhanced else 5}-fold CV of {name} on the training rows."
            query(fn.__name__)(fn)


_register_cv()


_FAMILY_SQL = ("CASE WHEN contains(f, 'age') THEN 'age' WHEN starts_with(f, 'has_') OR contains(f, 'diagnosis') OR contains(f, 'risk') "
               "THEN 'diagnosis' WHEN contains(f, 'heart_rate') OR contains(f, 'respiratory_rate') OR contains(f, 'spo2') THEN 'vital' "
               "WHEN contains(f, 'interaction') OR contains(f, 'instability') OR ends_with(f, '_system') THEN 'engineered' ELSE 'other' END")


@query("feature_family", dbl="missing_percentage", sql=f"""
WITH ft AS ({FEATURE_SQL}),
m AS (SELECT count(*) AS n, {', '.join(f'CAST(count_if("{c}" IS NULL) AS BIGINT) AS "{c}"' for c in FEATURE_TYPES)} FROM ft)
SELECT f AS feature, {_FAMILY_SQL} AS family, c * 100.0 / n AS missing_percentage
FROM (UNPIVOT (SELECT * EXCLUDE (n) FROM m) ON COLUMNS(*) INTO NAME f VALUE c), m""")
def feature_family(spark, d):
    """Family of every column of the feature table, with its missing share."""
    prof = P.missing_profile(_feature_table(spark, d)).withColumnRenamed("column", "feature")
    return M.feature_family(prof).select("feature", "family", "missing_percentage")


@query("enhanced_feature_family")
def enhanced_feature_family(spark, d):
    """Family of every enhanced feature, with its missing share."""
    prof = P.missing_profile(X.create_enhanced_features(materialize(_feature_table(spark, d)))).withColumnRenamed("column", "feature")
    return M.feature_family(prof).select("feature", "family", "missing_percentage")


@query("los_enhanced_models")
def los_enhanced_models(spark, d):
    """Enhanced features -> split -> IQR clean -> impute -> encode (drop first) -> robust scaling -> 8 models."""
    return M.rank_models(_holdout(spark, d, M.ENHANCED_MODELS, enhanced=True)[0])


@query("compare_pipelines", dbl="baseline_best enhanced_best improvement_pct", sql=f"""
WITH c AS ({_ONE}), t AS (SELECT * FROM c WHERE NOT held),
f AS (SELECT regr_slope(LOS, x) AS b, regr_intercept(LOS, x) AS a, avg(LOS) AS m, median(LOS) AS d FROM t),
r AS (SELECT sqrt(avg((LOS - m) ** 2)) AS mean, sqrt(avg((LOS - d) ** 2)) AS med, sqrt(avg((LOS - a - b * x) ** 2)) AS line
      FROM c, f WHERE held)
SELECT CASE WHEN mean <= med THEN 'mean' ELSE 'median' END AS baseline_best_model, least(mean, med) AS baseline_best,
       'line' AS enhanced_best_model, line AS enhanced_best, (least(mean, med) - line) / least(mean, med) * 100 AS improvement_pct
FROM r""")
def compare_pipelines(spark, d):
    """Best constant prediction against the one-feature line, improvement %."""
    ranked = rank_models(spark, d).drop("rank")
    return M.compare_pipelines(ranked.filter("model <> 'line'"), ranked.filter("model = 'line'"))


@query("compare_model_sets")
def compare_model_sets(spark, d):
    """Best baseline model against best enhanced model, improvement %."""
    base, _, _ = _holdout(spark, d, M.BASELINE_MODELS)
    enh, _, _ = _holdout(spark, d, M.ENHANCED_MODELS, enhanced=True)
    return M.compare_pipelines(base, enh)
