"""Distributed exact quantiles equal Spark's exact percentile (pandas interpolation)."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from stayflow.operators import quantiles
from stayflow.operators.quantiles import exact_percentiles


@pytest.fixture(params=[1, 40], ids=["listed-1", "listed-40"])
def path(request, monkeypatch):
    # the same steps run at every size; small lists make small columns take many rounds
    monkeypatch.setattr(quantiles, "LISTED", request.param)


@pytest.mark.parametrize("values", [
    [5.0],
    [2.0, 2.0, 2.0, 2.0],
    [1.0, 2.0],
    list(np.round(np.random.default_rng(3).normal(size=5000), 2)),   # many ties
    list(np.random.default_rng(4).exponential(size=20000)),
])
def test_matches_spark_percentile(spark, values, path):
    df = spark.createDataFrame([(float(v),) for v in values] + [(None,)], "x double").repartition(4)
    probs = [0.0, 0.1, 0.25, 0.5, 0.75, 0.9, 1.0]
    got = exact_percentiles(df, [("x", p) for p in probs])
    want = df.agg(*[F.percentile("x", p).alias(f"p{i}") for i, p in enumerate(probs)]).first()
    for i, p in enumerate(probs):
        assert got[("x", p)] == pytest.approx(want[f"p{i}"], rel=1e-12, abs=1e-12)
        assert got[("x", p)] == pytest.approx(np.quantile(values, p), rel=1e-12, abs=1e-12)


def test_empty_column(spark):
    df = spark.createDataFrame([(None,)], "x double")
    assert exact_percentiles(df, [("x", 0.5)]) == {("x", 0.5): None}


def test_grouped_matches_spark_percentile(spark, path):
    from stayflow.operators.quantiles import grouped_exact_percentiles
    rng = np.random.default_rng(5)
    rows = [("hot", float(v)) for v in np.round(rng.normal(size=6000), 2)]
    rows += [(f"g{i % 7}", float(v)) for i, v in enumerate(rng.exponential(size=3000))]
    rows += [("single", 4.0), ("pair", 1.0), ("pair", 3.0), (None, 1.0), ("hot", None), ("none", None), ("none", None)]
    rows += [("tied", 5.0)] * 300 + [("tied", 7.0)] * 300
    df = spark.createDataFrame(rows, "g string, x double").repartition(4)
    probs = [0.25, 0.5, 0.75]
    got = {r.g: r for r in grouped_exact_percentiles(df, ["g"], "x", probs, ["q1", "med", "q3"]).collect()}
    want = {r.g: r for r in df.groupBy("g").agg(
        F.count("x").alias("n"), *[F.percentile("x", p).alias(n) for p, n in zip(probs, ["q1", "med", "q3"])]
    ).collect()}
    assert set(got) == set(want)
    for g in want:
        assert got[g].n == want[g].n
        for n in ("q1", "med", "q3"):
            if want[g][n] is None:
                assert got[g][n] is None
            else:
                assert got[g][n] == pytest.approx(want[g][n], rel=1e-12, abs=1e-12)


def test_any_doubles_in_order(spark):
    values = [float("nan"), float("inf"), float("-inf"), -0.0, 0.0, 5e-324, -5e-324, 1.0, float(np.nextafter(1.0, 2)), -1.0, -1e300, 1e300, 2.0 ** 53, 3.5, 3.5]
    df = spark.createDataFrame([(v, int(i)) for i, v in enumerate(values)] + [(None, None)], "`x.y` double, i int").repartition(3)
    want = np.sort(np.array(values))  # NaN last
    got = quantiles.order_statistics(df, [("x.y", k) for k in range(len(values))] + [("i", 0), ("i", 14)])
    np.testing.assert_array_equal([got["x.y", k] for k in range(len(values))], want)
    assert (got["i", 0], got["i", 14]) == (0.0, 14.0)


def test_columns_are_counted_together_without_a_sketch_for_each_rank(spark, monkeypatch):
    def sketch(*_):
        raise AssertionError("a sketch for each rank of each column")

    monkeypatch.setattr(F, "percentile_approx", sketch)
    monkeypatch.setattr(quantiles, "SEARCHES", 7)
    rng = np.random.default_rng(6)
    x = np.column_stack([rng.integers(0, k + 1, 3000) * 1.0 for k in range(8)] + [rng.normal(size=3000) * 10.0 ** k for k in range(4)])
    df = spark.createDataFrame([tuple(map(float, r)) for r in x], ", ".join(f"c{k} double" for k in range(12))).repartition(3)
    got = exact_percentiles(df, [(f"c{k}", p) for k in range(12) for p in (0.25, 0.5, 0.75)])
    for k in range(12):
        for p in (0.25, 0.5, 0.75):
            assert got[f"c{k}", p] == pytest.approx(np.quantile(x[:, k], p), rel=1e-12)
