"""Length-of-stay models: linear family, forests, extra trees and boosting on shared preparations.

* Linear family: :mod:`stayflow.plans.linear` (products of all columns by fold, one pass).
  :func:`make_estimator` maps the same objectives onto ``pyspark.ml``, which scales the L2
  term by the label's standard deviation.
* Trees: :mod:`stayflow.plans.trees` (one binned matrix for all models and folds, the
  published settings in full: growth to the end, ``min_split``, random thresholds).
* Every model gives per-row predictions of the rows that it did not learn from, as one table;
  metrics are aggregates of that table.  Splits and folds come from a hash of the stay
  key, so they are reproducible in SQL and independent of the partitioning.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from multiprocessing.pool import ThreadPool

from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import LinearRegression
from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stayflow.plans import linear, trees
from stayflow.plans.mlprep import Preparation
from stayflow.session import materialize

FEATURES = "features"

# Model settings of the baseline and enhanced model sets.
BASELINE_MODELS = {
    "Linear Regression": {"kind": "linear"},
    "Random Forest": {"kind": "forest", "num_trees": 100, "bootstrap": True},
    "Gradient Boosting": {"kind": "gbt", "max_iter": 100, "max_depth": 3, "step_size": 0.1},
}
ENHANCED_MODELS = {
    "Linear Regression": {"kind": "linear"},
    "Ridge": {"kind": "ridge", "alpha": 1.0},
    "Lasso": {"kind": "lasso", "alpha": 0.1},
    "Elastic Net": {"kind": "elastic_net", "alpha": 0.1, "l1_ratio": 0.5},
    "Random Forest": {"kind": "forest", "num_trees": 300, "max_depth": 15, "min_split": 5, "min_leaf": 2, "subset": "sqrt", "bootstrap": True},
    "Extra Trees": {"kind": "forest", "num_trees": 300, "max_depth": 15, "min_split": 5, "min_leaf": 2, "subset": "sqrt", "random_split": True},
    "Gradient Boosting": {"kind": "gbt", "max_iter": 200, "step_size": 0.1, "max_depth": 6, "subsample": 0.8,
                          "subset": "sqrt"},
    "Gradient Boosting (Enhanced)": {"kind": "gbt", "max_iter": 300, "step_size": 0.05, "max_depth": 8,
                                 "subsample": 0.7, "subset": "sqrt"},
}
#: Models that are fitted at a time.
PARALLELISM = 4
KEY, FOLD = "ICUSTAY_ID", "fold"


def assemble(df: DataFrame, features: Sequence[str], out: str = FEATURES) -> DataFrame:
    return VectorAssembler(inputCols=list(features), outputCol=out, handleInvalid="keep").transform(df)


def linear_params(kind: str, n: int, label_std: float, alpha: float = 1.0, l1_ratio: float = 0.5) -> tuple[float, float]:
    """(regParam, elasticNetParam) equal to sklearn's objective for the given kind."""
    if kind == "linear":
        return 0.0, 0.0
    if kind == "ridge":
        l1, l2 = 0.0, alpha / n
    elif kind == "lasso":
        l1, l2 = alpha, 0.0
    elif kind == "elastic_net":
        l1, l2 = alpha * l1_ratio, alpha * (1 - l1_ratio)
    else:
        raise ValueError(kind)
    reg = l1 + l2 * label_std
    return reg, (l1 / reg if reg else 0.0)


def make_estimator(spec: Mapping, label: str, features_col: str = FEATURES, n: int | None = None,
                   label_std: float | None = None):
    kind = spec["kind"]
    if kind in ("linear", "ridge", "lasso", "elastic_net"):
        reg, en = linear_params(kind, n or 1, label_std or 1.0, spec.get("alpha", 1.0), spec.get("l1_ratio", 0.5))
        return LinearRegression(featuresCol=features_col, labelCol=label, regParam=reg, elasticNetParam=en,
                                standardization=False, maxIter=200, tol=1e-9)
    raise ValueError(kind)


def _metrics(label: str = "LOS", prediction: str = "prediction") -> list:
    """rmse, mae, r2 (1 - SSE / SST), mape (%) as aggregates."""
    y, p = F.col(label).cast("double"), F.col(prediction).cast("double")
    e = y - p
    return [F.sqrt(F.avg(e * e)).alias("rmse"), F.avg(F.abs(e)).alias("mae"),
            (F.lit(1.0) - F.try_divide(F.sum(e * e), F.var_pop(y) * F.count(y))).alias("r2"),
            (F.avg(F.abs(F.try_divide(e, y))) * 100).alias("mape")]


def regression_metrics(pred: DataFrame, label: str = "LOS", prediction: str = "prediction") -> DataFrame:
    """One row: rmse, mae, r2, mape."""
    return pred.agg(*_metrics(label, prediction))


def _label_stats(df: DataFrame, label: str) -> tuple[int, float]:
    r = df.agg(F.count(label).alias("n"), F.stddev_pop(label).alias("s")).first()
    return r["n"], r["s"] or 0.0


LINEAR_KINDS = ("linear", "ridge", "lasso", "elastic_net")


def growth(spec: Mapping, features: int) -> trees.Growth:
    return trees.Growth(spec.get("max_depth"), spec.get("min_split", 2), spec.get("min_leaf", 1), trees.subset(spec.get("subset", "all"), features),
                        spec.get("bootstrap", False), spec.get("subsample", 1.0), spec.get("random_split", False))


def fit_predict(rows: DataFrame, models: Mapping[str, Mapping], features: Sequence[str], fits: Sequence[int], label: str = "LOS",
                robust: bool = False, key: str = KEY, fold: str = FOLD, parallelism: int = PARALLELISM,
                finish_rows: int = trees.FINISH_ROWS, keep_nodes: bool = True) -> tuple[DataFrame, dict]:
    """Fits every model once for each of ``fits``; returns (predictions, forests).

    Fit ``f`` learns from the rows whose fold is neither ``f`` nor ``trees.HELD_OUT``.  Linear models see
    features scaled by statistics of all training rows (mean and population std, or median and
    quartile range when ``robust``), trees their bins; both are read by all fits.  Predictions
    (model, fit, row, y, prediction) are written once; forests are (subtrees, tops) by name,
    whose node tables are written unless ``keep_nodes`` is false.
    """
    train = rows.filter(F.col(fold) != trees.HELD_OUT)
    lines = {name: m for name, m in models.items() if m["kind"] in LINEAR_KINDS}
    out, forests = [], {}
    if lines:
        table, width = materialize(linear.packed(rows, features, key, fold, label), "zstd"), len(features)
        sums = linear.packed_products(table, width)
        if robust:
            scales = linear.robust_scales(table.filter(F.col("fold") != trees.HELD_OUT), width)
        else:
            scales = linear.standard_scales(linear.learned_from(sums, trees.HELD_OUT))
        solved = {(name, f): linear.solve(linear.scaled(linear.learned_from(sums, f), scales), m) for name, m in lines.items() for f in fits}
        out.append(linear.packed_predictions(table, width, scales, solved))
    rest = {name: m for name, m in models.items() if name not in lines}
    if rest:
        values = trees.feature_values(train, features)
        matrix = trees.binned(rows, values, features, key, fold, label)

        def one(item):
            name, m = item
            g = growth(m, len(features))
            if m["kind"] == "forest":
                forests[name] = trees.fit_forest(matrix, fits, values, m["num_trees"], g, finish_rows, keep_nodes)
                pred = trees.forest_predictions(forests[name][0], matrix)
            else:
                pred, _ = trees.fit_boosting(matrix, fits, values, m["max_iter"], m["step_size"], g, finish_rows)
            return pred.select(F.lit(name).alias("model"), "fit", "row", "y", "prediction")

        with ThreadPool(max(1, min(parallelism, len(rest)))) as pool:
            out += pool.map(inheritable_thread_target(rows.sparkSession)(one), list(rest.items()))
    both = out[0]
    for pred in out[1:]:
        both = both.unionAll(pred)
    return materialize(both), forests


def held_out(train: DataFrame, test: DataFrame, fold: str = FOLD) -> DataFrame:
    """Training and hold-out rows as one table for :func:`fit_predict` with the fit ``trees.HELD_OUT``."""
    return train.withColumn(fold, F.lit(0)).unionByName(test.withColumn(fold, F.lit(trees.HELD_OUT)))


def fit_evaluate(train: DataFrame, test: DataFrame, models: Mapping[str, Mapping], features: Sequence[str],
                 label: str = "LOS", robust: bool = False, parallelism: int = PARALLELISM, key: str = KEY,
                 keep_nodes: bool = True) -> tuple[DataFrame, dict]:
    """Fit each model on ``train``, score ``test``; returns (metrics per model, forests)."""
    rows = held_out(train, test).select(key, label, FOLD, *features)
    pred, forests = fit_predict(rows, models, features, [trees.HELD_OUT], label, robust, key, parallelism=parallelism, keep_nodes=keep_nodes)
    return pred.groupBy("model").agg(*_metrics("y")), forests


def rank_models(results: DataFrame, by: str = "rmse") -> DataFrame:
    return results.orderBy(F.col(by).asc(), F.col("model"))


def kfold_cv(df: DataFrame, models: Mapping[str, Mapping], features: Sequence[str], label: str = "LOS",
             fold_col: str = "fold", k: int = 5, enhanced: bool = False, key: str = KEY) -> DataFrame:
    """k-fold CV over a key-hash fold column: mean and population std of RMSE, MAE, R² per model.

    Fill values, levels, scaling and bins are learned once on all rows, as in the published
    evaluation; all folds then come from the same passes.
    """
    prep = Preparation.fit(df, features, enhanced)
    rows = prep.apply(df.select(key, label, fold_col, *features))
    if any(m["kind"] not in LINEAR_KINDS for m in models.values()):  # linear models read the rows once
        rows = materialize(rows)
    names = [c for c in rows.columns if c not in (key, label, fold_col)]
    pred, _ = fit_predict(rows, models, names, range(k), label, enhanced, key, fold_col, keep_nodes=False)
    per_fold = pred.groupBy("model", "fit").agg(*_metrics("y"))
    return (per_fold.groupBy("model").agg(
        F.avg("rmse").alias("cv_rmse_mean"), F.stddev_pop("rmse").alias("cv_rmse_std"),
        F.avg("mae").alias("cv_mae_mean"), F.stddev_pop("mae").alias("cv_mae_std"),
        F.avg("r2").alias("cv_r2_mean"), F.stddev_pop("r2").alias("cv_r2_std"))
        .orderBy("cv_rmse_mean", "model"))


def feature_importance(forest: tuple, feature_names: Sequence[str], top: int | None = 15) -> DataFrame:
    """(feature, importance) of a fitted forest, most important first, aggregated from its node table; features
    that no tree splits on have 0."""
    grown, tops = forest
    names = grown.sparkSession.createDataFrame(list(enumerate(feature_names)), "at int, name string")
    found = trees.importances(trees.node_table(grown, tops)).select(F.col("feature").alias("at"), "importance")
    df = names.join(found, "at", "left").select(F.col("name").alias("feature"), F.coalesce("importance", F.lit(0.0)).alias("importance"))
    df = df.orderBy(F.col("importance").desc(), F.col("feature"))
    return df.limit(top) if top else df


# Feature families by name, first match wins.
FAMILY_RULES: list[tuple[str, Callable]] = [
    ("age", lambda c: c.contains("age")),
    ("diagnosis", lambda c: c.startswith("has_") | c.contains("diagnosis") | c.contains("risk")),
    ("vital", lambda c: c.contains("heart_rate") | c.contains("respiratory_rate") | c.contains("spo2")),
    ("engineered", lambda c: c.contains("interaction") | c.contains("instability") | c.endswith("_system")),
]


def feature_family(df: DataFrame, name_col: str = "feature", out: str = "family") -> DataFrame:
    c = F.col(name_col)
    expr = None
    for fam, rule in FAMILY_RULES:
        expr = F.when(rule(c), F.lit(fam)) if expr is None else expr.when(rule(c), F.lit(fam))
    return df.withColumn(out, expr.otherwise(F.lit("other")))


def compare_pipelines(baseline: DataFrame, enhanced: DataFrame, metric: str = "rmse") -> DataFrame:
    """Best model per result set and the improvement % = (b - e) / b * 100, as one row
    (a pivot of the two-row best-per-set table; no join)."""
    both = baseline.withColumn("set", F.lit("baseline")).unionByName(enhanced.withColumn("set", F.lit("enhanced")))
    best = both.groupBy("set").agg(F.min_by("model", F.struct(F.col(metric), F.col("model"))).alias("best_model"),
                                   F.min(metric).alias("best_metric"))
    wide = best.groupBy().pivot("set", ["baseline", "enhanced"]).agg(
        F.first("best_model").alias("best_model"), F.first("best_metric").alias("best"))
    return wide.select(
        F.col("baseline_best_model"), F.col("baseline_best"), F.col("enhanced_best_model"), F.col("enhanced_best"),
        ((F.col("baseline_best") - F.col("enhanced_best")) / F.col("baseline_best") * 100).alias("improvement_pct"))
