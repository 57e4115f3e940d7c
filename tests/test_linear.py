"""Linear models from products against numpy."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from stayflow.plans import linear as L
from stayflow.plans import mlprep as P
from stayflow.plans import models as M
from stayflow.plans.trees import HELD_OUT
from stayflow.session import materialize

NAMES = ["a", "b", "c", "d"]


@pytest.fixture(scope="module")
def table(spark):
    rng = np.random.default_rng(2)
    x = rng.normal(size=(500, 3)) * [1, 20, 0.1] + [5, -300, 0]
    y = 3 + x @ [0.5, -0.1, 4.0] + rng.normal(size=500)
    x = np.column_stack([x, x[:, 0] * 2 - x[:, 2]])  # depends on others
    fold = np.where(np.arange(500) % 9 == 0, HELD_OUT, np.arange(500) % 4)
    df = spark.createDataFrame([(i, int(fold[i]), float(y[i]), *map(float, x[i])) for i in range(500)],
                               "ICUSTAY_ID long, fold int, LOS double, a double, b double, c double, d double").repartition(4)
    return df, x, y, fold


def scaled(x, train):
    return (x - x[train].mean(0)) / x[train].std(0)


def test_products_of_every_fold(table):
    df, x, y, fold = table
    sums = L.products(df, NAMES, "ICUSTAY_ID", "fold", "LOS")
    v = np.column_stack([x, y])
    assert sorted(sums) == [-1, 0, 1, 2, 3]
    for f, m in sums.items():
        own = v[fold == f]
        assert m.n == len(own)
        np.testing.assert_allclose(m.mean, own.mean(0))
        np.testing.assert_allclose(m.centred, (own - own.mean(0)).T @ (own - own.mean(0)), rtol=1e-9, atol=1e-6)
    total = L.learned_from(sums, 2)
    own = v[(fold != 2) & (fold >= 0)]
    np.testing.assert_allclose(total.centred, (own - own.mean(0)).T @ (own - own.mean(0)), rtol=1e-9, atol=1e-6)
    scales = L.standard_scales(L.learned_from(sums, HELD_OUT))
    want = P.scaling_stats(df.filter("fold >= 0"), NAMES)
    np.testing.assert_allclose(scales.T, [want[c] for c in NAMES], rtol=1e-9)


def test_least_squares_of_least_norm(table):
    df, x, y, fold = table
    pred, _ = M.fit_predict(df, {"ols": {"kind": "linear"}}, NAMES, [HELD_OUT, 2])
    z = scaled(x, fold >= 0)
    for fit in (HELD_OUT, 2):
        use = (fold != fit) & (fold != HELD_OUT)
        zc, yc = z[use] - z[use].mean(0), y[use] - y[use].mean()
        w = np.linalg.lstsq(zc, yc, rcond=1e-9)[0]
        want = (z - z[use].mean(0)) @ w + y[use].mean()
        got = {r["row"]: r["prediction"] for r in pred.filter(F.col("fit") == fit).collect()}
        assert sorted(got) == np.flatnonzero(fold == fit).tolist()
        np.testing.assert_allclose([got[k] for k in sorted(got)], want[fold == fit], rtol=1e-7)


@pytest.mark.parametrize("spec", [{"kind": "ridge", "alpha": 7.0}, {"kind": "lasso", "alpha": 0.1}, {"kind": "elastic_net", "alpha": 0.2, "l1_ratio": 0.5}])
def test_minima_of_the_penalised_objectives(table, spec):
    _, x, y, fold = table
    z = scaled(x, fold >= 0)[fold >= 0]
    t = y[fold >= 0]
    v = np.column_stack([z, t])
    w, intercept = L.solve(L.Products(len(t), v.mean(0), (v - v.mean(0)).T @ (v - v.mean(0))), spec)
    n, slope = len(t), z.T @ (t - z @ w - intercept)
    if spec["kind"] == "ridge":
        np.testing.assert_allclose(slope, spec["alpha"] * w, atol=1e-7)
    else:
        share = 1.0 if spec["kind"] == "lasso" else spec["l1_ratio"]
        rest = slope / n - spec["alpha"] * (1 - share) * w
        assert (np.abs(rest) <= spec["alpha"] * share + 1e-8).all()
        np.testing.assert_allclose(rest[w != 0], spec["alpha"] * share * np.sign(w[w != 0]), atol=1e-8)
    assert intercept == pytest.approx(t.mean() - z.mean(0) @ w)


def test_constant_and_no_features(spark):
    df = spark.createDataFrame([(k, k % 2, float(k), 3.0) for k in range(8)], "ICUSTAY_ID long, fold int, LOS double, a double")
    pred, _ = M.fit_predict(df, {"ols": {"kind": "linear"}, "lasso": {"kind": "lasso", "alpha": 0.1}}, ["a"], [0, 1])
    for r in pred.collect():
        assert r["prediction"] == pytest.approx(4.0 if r["fit"] == 0 else 3.0)


def test_packed_rows_keep_values_and_nulls(spark):
    rng = np.random.default_rng(6)
    rows = [(i, i % 3 - 1, float(i), *[None if rng.random() < 0.2 and i % 2 else float(v) for v in rng.normal(size=3)], None) for i in range(300)]
    names = ["a", "b", "c", "none"]
    df = spark.createDataFrame(rows, "k long, fold int, y double, a double, b double, c double, none double").repartition(3)
    table = L.packed(df, names, "k", "fold", "y")
    for r in table.collect():
        want = rows[r["row"]]
        assert (r["fold"], r["y"]) == want[1:3]
        np.testing.assert_array_equal(np.frombuffer(bytes(r["x"])), [np.nan if v is None else v for v in want[3:]])
        assert list(bytes(r["gaps"])) == [v is None for v in want[3:]]
    got = L.robust_scales(table.filter("fold >= 0"), len(names))
    want = P.scaling_stats(df.filter("fold >= 0"), names, robust=True)
    np.testing.assert_array_equal(got, [[want[c][0] or 0.0 for c in names], [want[c][1] or 1.0 for c in names]])
    assert L.robust_scales(table.filter("fold > 9"), len(names)).tolist() == [[0.0] * 4, [1.0] * 4]


def test_linear_folds_write_only_packed_rows(spark, monkeypatch):
    """Folds of linear models write no table with a column for each feature."""
    rng = np.random.default_rng(8)
    names = [f"x{i}" for i in range(6)]
    df = spark.createDataFrame([(i, i % 5, float(rng.exponential()), *map(float, rng.normal(size=6))) for i in range(400)],
                               "ICUSTAY_ID long, fold int, LOS double, " + ", ".join(f"{c} double" for c in names))
    written = []

    def write(frame, *args):
        written.append(frame.columns)
        return materialize(frame, *args)

    monkeypatch.setattr(M, "materialize", write)
    out = M.kfold_cv(df, {"ridge": {"kind": "ridge", "alpha": 1.0}}, names, enhanced=True).collect()
    assert written == [["row", "fold", "y", "x", "gaps"], ["model", "fit", "row", "y", "prediction"]]
    assert len(out) == 1 and out[0]["cv_rmse_mean"] > 0
