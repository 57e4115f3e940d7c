"""Model operators against closed forms and small numpy solutions."""

import numpy as np
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as E
from stayflow.catalog import mlq
from stayflow.plans import mlprep as P
from stayflow.plans import models as M
from stayflow.plans.trees import HELD_OUT, NODE


def _data(spark, n=300, seed=7):
    rng = np.random.default_rng(seed)
    x = rng.normal(size=(n, 3))
    y = 2.0 + x @ np.array([1.5, -0.7, 0.3]) + rng.normal(scale=0.5, size=n)
    rows = [(i, float(y[i]), *map(float, x[i])) for i in range(n)]
    return spark.createDataFrame(rows, "ICUSTAY_ID long, LOS double, a double, b double, c double"), x, y


def test_ols_matches_numpy(spark):
    df, x, y = _data(spark)
    m = M.make_estimator({"kind": "linear"}, "LOS", "features").fit(M.assemble(df, ["a", "b", "c"]))
    X1 = np.column_stack([np.ones(len(y)), x])
    beta = np.linalg.lstsq(X1, y, rcond=None)[0]
    assert m.intercept == pytest.approx(beta[0], rel=1e-6)
    assert list(m.coefficients) == pytest.approx(list(beta[1:]), rel=1e-6)


def test_ridge_mapping_matches_sklearn_objective(spark):
    df, x, y = _data(spark)
    n, s = M._label_stats(df, "LOS")
    alpha = 5.0
    m = M.make_estimator({"kind": "ridge", "alpha": alpha}, "LOS", "features", n, s).fit(
        M.assemble(df, ["a", "b", "c"]))
    xc, yc = x - x.mean(0), y - y.mean()
    w = np.linalg.solve(xc.T @ xc + alpha * np.eye(3), xc.T @ yc)
    assert list(m.coefficients) == pytest.approx(list(w), rel=1e-4)


def test_metrics_match_numpy(spark):
    df, x, y = _data(spark)
    pred = df.withColumn("prediction", F.col("LOS") * 0.9 + 0.1)
    r = M.regression_metrics(pred).first()
    p = y * 0.9 + 0.1
    e = y - p
    assert r.rmse == pytest.approx(np.sqrt(np.mean(e ** 2)))
    assert r.mae == pytest.approx(np.mean(np.abs(e)))
    assert r.r2 == pytest.approx(1 - np.sum(e ** 2) / np.sum((y - y.mean()) ** 2))
    assert r.mape == pytest.approx(np.mean(np.abs(e / y)) * 100)


def test_split_and_folds_are_stable(spark):
    df, _, _ = _data(spark)
    a = P.with_split(df).filter("split = 'test'").count()
    assert 0.1 * 300 < a < 0.3 * 300
    folds = P.with_fold(df, k=5).groupBy("fold").count().collect()
    assert sorted(r.fold for r in folds) == [0, 1, 2, 3, 4]


def test_scaling(spark):
    df, x, _ = _data(spark)
    z = P.standard_scale(df, ["a"]).select("a").toPandas()["a"].to_numpy()
    assert z == pytest.approx((x[:, 0] - x[:, 0].mean()) / x[:, 0].std(), rel=1e-9)
    rb = P.robust_scale(df, ["b"]).select("b").toPandas()["b"].to_numpy()
    q1, med, q3 = np.percentile(x[:, 1], [25, 50, 75])
    assert rb == pytest.approx((x[:, 1] - med) / (q3 - q1), rel=1e-9)


def test_impute_and_one_hot(spark):
    df = spark.createDataFrame([(1, "A", None, None), (2, "B", 2.0, 3), (3, None, 4.0, None), (4, "B", 6.0, 1)],
                               "ICUSTAY_ID long, GENDER string, heart_rate_avg double, heart_rate_count int")
    roles = P.column_roles(df, ["GENDER", "heart_rate_avg", "heart_rate_count"])
    out = P.impute_features(df, roles).orderBy("ICUSTAY_ID").collect()
    assert out[2].GENDER == "B" and out[0].heart_rate_avg == 4.0 and out[0].heart_rate_count == 0
    oh = P.one_hot(df, ["GENDER"], drop_first=True)
    assert [c for c in oh.columns if c.startswith("GENDER")] == ["GENDER_B"]


def test_feature_importance_sums_to_one(spark):
    df, _, _ = _data(spark)
    rows = P.with_fold(df, k=5)
    _, forests = M.fit_predict(rows, {"f": {"kind": "forest", "num_trees": 5, "max_depth": 4, "bootstrap": True}}, ["a", "b", "c"], [HELD_OUT])
    imp = M.feature_importance(forests["f"], ["a", "b", "c"], top=None).collect()
    assert sum(r.importance for r in imp) == pytest.approx(1.0)
    assert imp[0].feature == "a"
    grown, tops = forests["f"]
    plain = np.zeros(3)
    for r in grown.collect():
        n = np.frombuffer(bytes(r["nodes"]), NODE)
        own = np.bincount(n["feature"][n["feature"] >= 0], weights=n["gain"][n["feature"] >= 0], minlength=3)
        plain += own / own.sum()
    assert not tops
    assert {r.feature: r.importance for r in imp} == pytest.approx(dict(zip("abc", plain / plain.sum())), abs=1e-9)


def test_compare_pipelines(spark):
    base = spark.createDataFrame([("LR", 4.2, 3.0, 0.2, 10.0), ("RF", 4.0, 3.0, 0.3, 9.0)],
                                 "model string, rmse double, mae double, r2 double, mape double")
    enh = spark.createDataFrame([("GB", 3.6, 2.0, 0.4, 8.0)], "model string, rmse double, mae double, r2 double, "
                                "mape double")
    r = M.compare_pipelines(base, enh).first()
    assert r.baseline_best_model == "RF" and r.enhanced_best_model == "GB"
    assert r.improvement_pct == pytest.approx(10.0)


def test_ridge_and_lasso_on_all_features(spark):
    sf = "/root/testdata/sf0.001"
    train, _, feats = mlq._data(spark, sf)
    rows = train.select("LOS", *feats).toPandas().astype(float)
    x, y = rows[feats].to_numpy(), rows["LOS"].to_numpy()
    sd = x.std(0)
    z, yc = (x - x.mean(0)) / np.where(sd > 0, sd, 1), y - y.mean()
    out = {kind: {r["feature"]: r["coefficient"] for r in E.queries()[f"{kind}_regression_all"](spark, sf).collect()} for kind in ("ridge", "lasso")}
    for got in out.values():
        assert sorted(got) == sorted([*feats, "(intercept)"])
        assert got["(intercept)"] == pytest.approx(y.mean(), rel=1e-6)
    ridge, lasso = (np.array([out[k][f] for f in feats]) for k in ("ridge", "lasso"))
    # the objectives' conditions for a minimum
    assert np.abs(z.T @ (yc - z @ ridge) - ridge).max() < 1e-3 * np.abs(z.T @ yc).max()
    slope = z.T @ (yc - z @ lasso) / len(y)
    assert np.abs(slope).max() < 0.1 * 1.05
    assert np.allclose(slope[lasso != 0], 0.1 * np.sign(lasso[lasso != 0]), atol=5e-3)
