"""Trees against a plain greedy version, and independence of bounds and partitions."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from stayflow.plans import trees as T


def _rows(spark, n=400, seed=3, parts=3):
    rng = np.random.default_rng(seed)
    a, b, c = rng.normal(size=n).round(1), rng.integers(0, 4, n).astype(float), rng.integers(0, 2, n).astype(float)
    y = (2 * a + b * c + rng.normal(size=n)).round(3)
    data = [(i * 3, int(i % 5) if i % 11 else -1, float(y[i]), float(a[i]), float(b[i]), float(c[i])) for i in range(n)]
    return spark.createDataFrame(data, "key long, fold int, LOS double, a double, b double, c double").repartition(parts)


def _matrix(df):
    values = T.feature_values(df.filter("fold >= 0"), ["a", "b", "c"])
    return T.binned(df, values, ["a", "b", "c"], "key", "fold", "LOS"), values


def plain_tree(x, y, w, g, depth=0):
    """Greedy recursion with whole numbers, one node at a time (no subsets, no random thresholds)."""
    n, s = w.sum(), (w * y).sum()
    node = {"rows": len(y), "weight": int(n), "value": s / n / T.SCALE}
    if len(y) < max(2, g.min_split) or (g.max_depth is not None and depth >= g.max_depth) or (y == y[0]).all():
        return node
    best = None
    for f in range(x.shape[1]):
        for code in np.unique(x[:, f])[:-1]:
            left = x[:, f] <= code
            if min(left.sum(), (~left).sum()) < g.min_leaf:
                continue
            lw, ls = float(w[left].sum()), float((w * y)[left].sum())
            gain = ls * ls / lw + (s - ls) ** 2 / (n - lw) - float(s) * s / n
            if best is None or gain > best[0]:
                best = gain, f, int(code)
    if best is None or best[0] <= 1e-11 * (w * y.astype(float) * y).sum():
        return node
    left = x[:, best[1]] <= best[2]
    return node | {"feature": best[1], "code": best[2], "gain": best[0], "children": [plain_tree(x[m], y[m], w[m], g, depth + 1) for m in (left, ~left)]}


def same(nodes, at, want):
    n = nodes[at]
    assert (n["rows"], n["weight"]) == (want["rows"], want["weight"]) and n["value"] == pytest.approx(want["value"], rel=1e-12)
    if "feature" not in want:
        assert n["feature"] == -1
        return
    assert (n["feature"], n["code"]) == (want["feature"], want["code"]) and n["gain"] == pytest.approx(want["gain"] / T.SCALE ** 2, rel=1e-9)
    for side, child in enumerate(want["children"]):
        same(nodes, n["left"] + side, child)


@pytest.mark.parametrize("g", [T.Growth(), T.Growth(max_depth=3), T.Growth(min_split=9, min_leaf=4), T.Growth(bootstrap=True)])
def test_local_growth_is_the_greedy_tree(g):
    rng = np.random.default_rng(1)
    x = np.stack([rng.integers(0, 30, 300), rng.integers(0, 2, 300), rng.integers(0, 5, 300)], 1).astype(np.uint8)
    y = T.integer(x[:, 0] * 0.3 + x[:, 1] * x[:, 2] + rng.normal(size=300))
    w = T.weights(np.arange(300), 4, g)
    u = w > 0
    values = [np.arange(30.0), np.arange(2.0), np.arange(5.0)]
    same(T.grown(x[u], y[u], w[u], 7, 0, values, g), 0, plain_tree(x[u], y[u], w[u], g))


GROWTHS = [T.Growth(max_depth=6, features=2, bootstrap=True), T.Growth(min_split=5, min_leaf=2), T.Growth(max_depth=5, features=1, random_split=True)]


@pytest.mark.parametrize("g", GROWTHS)
def test_bounds_and_partitions_change_no_prediction(spark, g):
    results = []
    for parts, finish in ((3, 1 << 15), (5, 40), (2, 150)):
        matrix, values = _matrix(_rows(spark, parts=parts))
        grown, tops = T.fit_forest(matrix, [-1, 0, 3], values, 4, g, finish_rows=finish)
        assert bool(tops) == (finish < 1000)
        nodes = T.node_table(grown, tops).filter("feature >= 0").groupBy("fit", "tree").agg(F.count("*").alias("n"), F.sum("gain").alias("gain"))
        results.append((sorted(map(tuple, T.forest_predictions(grown, matrix).collect())), sorted((r[0], r[1], r[2], round(r[3], 6)) for r in nodes.collect())))
    assert len(results[0][0]) > 100
    for other in results[1:]:
        assert other[1] == results[0][1]
        assert [r[:2] for r in other[0]] == [r[:2] for r in results[0][0]]
        np.testing.assert_allclose([r[3] for r in other[0]], [r[3] for r in results[0][0]], rtol=1e-12)


def test_large_leaves_are_predicted_in_place(spark):
    matrix, values = _matrix(_rows(spark))
    g = T.Growth(max_depth=1)
    near, far = (T.fit_forest(matrix, [0], values, 1, g, finish_rows=f) for f in (1 << 15, 5))
    a, b = (sorted(map(tuple, T.forest_predictions(x[0], matrix).collect())) for x in (near, far))
    assert [r[:2] for r in a] == [r[:2] for r in b] and np.allclose([r[3] for r in a], [r[3] for r in b])


def plain_boosting(rows, values, fit, rounds, rate, g):
    use = [r for r in rows if r["fold"] not in (fit, -1)]
    x, y, key = _arrays(use)
    now = np.full(len(use), T.integer(y).sum() / len(use) / T.SCALE)
    ask = [r for r in rows if r["fold"] == fit]
    qx, _, qkey = _arrays(ask)
    out = np.full(len(ask), now[0])
    for r in range(rounds):
        w = T.weights(key, r, g)
        u = w > 0
        nodes = T.grown(x[u], T.integer((y - now)[u]), w[u], T.root_path(r), 0, values, g)
        now += rate * nodes["value"][T.descend(nodes, x)]
        out += rate * nodes["value"][T.descend(nodes, qx)]
    return dict(zip(qkey.tolist(), out))


def _arrays(rows):
    return (np.frombuffer(b"".join(bytes(r["x"]) for r in rows), np.uint8).reshape(len(rows), -1), np.array([r["y"] for r in rows]),
            np.array([r["row"] for r in rows]))


@pytest.mark.parametrize("finish, keep", [(1 << 15, 3), (60, 2)])
def test_boosting(spark, finish, keep):
    matrix, values = _matrix(_rows(spark))
    g = T.Growth(max_depth=3, features=2, sample=0.8)
    pred, model = T.fit_boosting(matrix, [-1, 2], values, 5, 0.3, g, finish_rows=finish, keep_rounds=keep)
    rows = matrix.collect()
    got = {}
    for r in pred.collect():
        got.setdefault(r["fit"], {})[r["row"]] = r["prediction"]
    for fit in (-1, 2):
        assert len(model.trees[fit]) == 5
        want = plain_boosting(rows, values, fit, 5, 0.3, g)
        assert got[fit] == pytest.approx(want, rel=1e-9)
        x, _, key = _arrays([r for r in rows if r["fold"] == fit])
        np.testing.assert_allclose(model.predict(x, fit), [want[k] for k in key.tolist()], rtol=1e-9)


def test_full_growth_ends_in_pure_leaves(spark):
    matrix, values = _matrix(_rows(spark))
    grown, tops = T.fit_forest(matrix, [0], values, 1, T.Growth(), finish_rows=30)
    nodes = T.node_table(grown, tops)
    leaves = nodes.filter("feature < 0 AND rows <= 30")
    assert nodes.agg(F.max("depth")).first()[0] > 3 and leaves.count() > 30
    train = {tuple(bytes(r["x"])): [] for r in matrix.collect()}
    for r in matrix.filter("fold > 0").collect():
        train[tuple(bytes(r["x"]))].append(r["y"])
    held = {r["row"]: r for r in matrix.filter("fold = 0").collect()}
    for r in T.forest_predictions(grown, matrix).collect():
        seen = train[tuple(bytes(held[r["row"]]["x"]))]
        if seen:
            assert r["prediction"] == pytest.approx(np.mean(seen), abs=1e-6)


def test_few_rows_constant_features_and_one_label(spark):
    df = spark.createDataFrame([(k, k % 2, 5.0, 1.0, 2.0, 0.0) for k in range(6)] + [(9, -1, 1.0, 3.0, 2.0, 0.0)],
                               "key long, fold int, LOS double, a double, b double, c double")
    matrix, values = _matrix(df)
    grown, _ = T.fit_forest(matrix, [-1, 0], values, 3, T.Growth(features=1))
    got = {(r["fit"], r["row"]): r["prediction"] for r in T.forest_predictions(grown, matrix).collect()}
    assert got == pytest.approx({(-1, 9): 5.0, (0, 0): 5.0, (0, 2): 5.0, (0, 4): 5.0})


def test_values_of_a_feature(spark):
    df = spark.range(5000).select(F.col("id").cast("double").alias("many"), (F.col("id") % 7).cast("double").alias("few"))
    many, few = T.feature_values(df, ["many", "few"])
    assert len(many) == T.VALUES and many[-1] == 4999 and few.tolist() == [0, 1, 2, 3, 4, 5, 6]


def test_bootstrap_counts_are_poisson():
    w = T.weights(np.arange(200_000), 1, T.Growth(bootstrap=True))
    for k, share in enumerate([0.3679, 0.3679, 0.1839, 0.0613]):
        assert (w == k).mean() == pytest.approx(share, abs=0.005)
    other = T.weights(np.arange(200_000), 2, T.Growth(bootstrap=True))
    assert abs(np.corrcoef(w, other)[0, 1]) < 0.01
    assert T.weights(np.arange(200_000), 1, T.Growth(sample=0.8)).mean() == pytest.approx(0.8, abs=0.005)


def test_trees_share_one_copy_of_the_rows_in_a_task(spark, monkeypatch):
    """Few tasks read all rows once for all their trees, and predictions need no node tables."""
    monkeypatch.setattr(T, "TREE_TASKS", 2)
    matrix, values = _matrix(_rows(spark))
    g = T.Growth(max_depth=5, bootstrap=True)
    kept, tops = T.fit_forest(matrix, [-1, 0], values, 5, g)
    bare, _ = T.fit_forest(matrix, [-1, 0], values, 5, g, keep_nodes=False)
    assert not tops and kept.count() == 10 and bare.count() == 4  # (tree, fit) against (task, fit)
    assert bare.filter("length(nodes) > 0").count() == 0
    assert {r["fit"]: r["n"] for r in bare.groupBy("fit").agg(F.sum("trees").alias("n")).collect()} == {-1: 5, 0: 5}
    one, other = (sorted(map(tuple, T.forest_predictions(f, matrix).collect())) for f in (kept, bare))
    assert [r[:3] for r in one] == [r[:3] for r in other]
    assert [r[3] for r in one] == pytest.approx([r[3] for r in other], rel=1e-12)


@pytest.mark.parametrize("size", [1, 10 ** 6])
def test_rows_without_weight_and_large_labels(size):
    """Rows of weight 0 are no part of a tree; sums beyond 2 ** 53 stay exact."""
    rng = np.random.default_rng(2)
    x = np.stack([rng.integers(0, 9, 400), rng.integers(0, 3, 400)], 1).astype(np.uint8)
    y, w = T.integer((x[:, 0] + rng.normal(size=400)) * size), rng.integers(0, 3, 400)
    values, u = [np.arange(9.0), np.arange(3.0)], w > 0
    g = T.Growth(max_depth=2)
    got = T.grown(x, y, w, 7, 0, values, g)
    assert got.tobytes() == T.grown(x[u], y[u], w[u], 7, 0, values, g).tobytes()
    same(got, 0, plain_tree(x[u], y[u], w[u], g))


@pytest.mark.parametrize("g", [T.Growth(), T.Growth(max_depth=4), T.Growth(bootstrap=True, min_split=5, min_leaf=2)])
@pytest.mark.parametrize("size", [1.0, 1e7])
def test_larger_children_are_not_counted(monkeypatch, g, size):
    rng = np.random.default_rng(4)
    n = 4000
    x = np.stack([rng.integers(0, k, n) for k in (200, 2, 9, 40, 2, 2)], 1).astype(np.uint8)
    y = T.integer(size * (x[:, 0] ** 2 * 0.01 + x[:, 1] * x[:, 2] + rng.normal(size=n)))
    values = [np.arange(k) * 1.0 for k in (200, 2, 9, 40, 2, 2)]
    w = T.weights(np.arange(n), 3, g)
    counted, plain = [], np.bincount

    def bincount(group, weights=None, minlength=0):
        counted.append(len(group))
        return plain(group, weights, minlength)

    monkeypatch.setattr(np, "bincount", bincount)
    found, work = [], []
    for least in (16, 256, 1 << 40):  # rows from which counts are kept; the last keeps none
        monkeypatch.setattr(T, "SHARED_ROWS", least)
        counted.clear()
        found.append(T.grown(x, y, w, 7, 0, values, g))
        work.append(sum(counted))
    assert (found[0] == found[2]).all() and (found[1] == found[2]).all()
    assert work[0] < 0.8 * work[2]


@pytest.mark.parametrize("g", [T.Growth(max_depth=4), T.Growth(), T.Growth(bootstrap=True, min_split=4)])
def test_rows_with_the_commonest_code_are_not_counted(monkeypatch, g):
    """Flags that few rows have cost these rows only, whichever code is the common one; leaves of the rows come with the tree."""
    rng = np.random.default_rng(6)
    n = 1500
    rare = [np.where(rng.random(n) < 0.04, rng.integers(0, k, n), c) for k, c in ((2, 0), (2, 1), (9, 4), (3, 2), (40, 0), (2, 0), (2, 0))]
    x = np.stack([rng.integers(0, 30, n), *rare], 1).astype(np.uint8)
    y = T.integer(x[:, 0] * 0.1 + 3 * x[:, 1] - 2 * x[:, 2] + x[:, 3] * x[:, 4] + rng.normal(size=n))
    values = [np.arange(k) * 1.0 for k in (30, 2, 2, 9, 3, 40, 2, 2)]
    w = T.weights(np.arange(n), 3, g)
    codes, counted, plain = T.Codes(x, g), [], np.bincount

    def bincount(group, weights=None, minlength=0):
        counted.append(len(group))
        return plain(group, weights, minlength)

    monkeypatch.setattr(np, "bincount", bincount)
    ends = np.full(n, -1)
    nodes = T.grown(codes, y, w, 7, 0, values, g, ends)
    if g.max_depth:
        assert sum(counted) < 2 * 4 * n + 3 * 4 * n  # totals and squares of each level, one dense feature; else 8 features
    monkeypatch.undo()
    u = w > 0
    same(nodes, 0, plain_tree(x[u], y[u], w[u], g))
    assert (ends[u] == T.descend(nodes, x[u])).all() and (ends[~u] == -1).all()


def plain_subset_tree(x, y, w, values, g, path, depth=0):
    """Greedy recursion where a node looks at ``g.features`` features at a time of its own order until one can split."""
    n, s, p = w.sum(), (w * y).sum(), x.shape[1]
    node = {"rows": len(y), "weight": int(n), "value": s / n / T.SCALE}
    if len(y) < max(2, g.min_split) or (g.max_depth is not None and depth >= g.max_depth) or (y == y[0]).all():
        return node
    order, paths, best = np.arange(p)[None].copy(), np.array([path], np.uint64), None
    for lo in range(0, p, g.features):
        T.draw_features(order, paths, lo, lo + g.features)
        for f in np.sort(order[0, lo:lo + g.features]):
            codes = np.unique(x[:, f])
            if g.random_split:
                low, high = values[f][codes[0]], values[f][codes[-1]]
                bound = low + T.drawn(paths, f, 5)[0] / 2.0 ** 32 * (high - low)
                codes = np.append(codes[values[f][codes] <= bound][-1:], 0)
                if high <= bound:
                    continue
            for code in codes[:-1]:
                left = x[:, f] <= code
                if min(left.sum(), (~left).sum()) < g.min_leaf:
                    continue
                lw, ls = float(w[left].sum()), float((w * y)[left].sum())
                gain = ls * ls / lw + (s - ls) ** 2 / (n - lw) - float(s) * s / n
                if best is None or gain > best[0]:
                    best = gain, int(f), int(code)
        if best is not None:
            break
    if best is None or best[0] <= 1e-11 * (w * y.astype(float) * y).sum():
        return node
    left, below = x[:, best[1]] <= best[2], T.child_paths(paths)
    return node | {"feature": best[1], "code": best[2], "gain": best[0], "children": [
        plain_subset_tree(x[m], y[m], w[m], values, g, int(b[0]), depth + 1) for m, b in zip((left, ~left), below, strict=True)]}


@pytest.mark.parametrize("g", [T.Growth(max_depth=8, features=3, min_split=5, min_leaf=2, bootstrap=True), T.Growth(features=2, min_leaf=3, sample=0.8),
                               T.Growth(max_depth=7, features=3, random_split=True), T.Growth(features=1, bootstrap=True, min_split=4)])
@pytest.mark.parametrize("size, sliced", [(1.0, 200), (1e8, 200), (1.0, 0), (1.0, 1 << 40)])
def test_growth_on_subsets_of_the_features(monkeypatch, g, size, sliced):
    """The greedy tree over each node's own features; flags (more than one word of them) and other features, one that is constant."""
    monkeypatch.setattr(T, "SLICED_ROWS", sliced)
    rng = np.random.default_rng(8)
    n, widths = 1200, (60, 1, 7, 3, *[2] * 70)
    x = np.stack([rng.integers(0, k, n) for k in widths[:4]] + [rng.random(n) < share for share in np.linspace(0, 1, 70)], 1).astype(np.uint8)
    y = T.integer(size * (x[:, 0] * 0.1 + x[:, 2] * x[:, 30] - 2 * x[:, 40] + rng.normal(size=n)))
    values = [np.cumsum(rng.random(k)) for k in widths]
    w, ends = T.weights(np.arange(n), 3, g), np.full(n, -1)
    nodes = T.grown(T.Codes(x, g), y, w, 7, 0, values, g, ends)
    u = w > 0
    same(nodes, 0, plain_subset_tree(x[u], y[u], w[u], values, g, 7))
    assert (ends[u] == T.descend(nodes, x[u])).all() and (ends[~u] == -1).all()
    assert (T.descend(nodes, np.asfortranarray(x), np.flatnonzero(u)) == ends[u]).all()


def test_flags_of_a_subset_are_not_counted_row_by_row(monkeypatch):
    """Of features with two codes no node counts its rows; only those with the rarer code are added up."""
    rng = np.random.default_rng(9)
    n, g = 2000, T.Growth(max_depth=6, features=3, bootstrap=True)
    x = (rng.random((n, 12)) < 0.1).astype(np.uint8)
    y, w = T.integer(x[:, 0] + 2 * x[:, 1] * x[:, 2] + rng.normal(size=n)), T.weights(np.arange(n), 1, g)
    counted, plain = [], np.bincount

    def bincount(group, weights=None, minlength=0):
        counted.append(len(group))
        return plain(group, weights, minlength)

    monkeypatch.setattr(np, "bincount", bincount)
    nodes = T.grown(x, y, w, 7, 0, [np.arange(2.0)] * 12, g)
    assert len(nodes) > 20 and sum(counted) < n


def test_no_rows_on_subsets():
    nodes = T.grown(np.zeros((5, 4), np.uint8), np.arange(5), np.zeros(5, np.int64), 7, 0, [np.arange(2.0)] * 4, T.Growth(features=2))
    assert len(nodes) == 1 and nodes["rows"][0] == 0 and nodes["feature"][0] == -1


@pytest.mark.parametrize("g", [T.Growth(max_depth=3), T.Growth(max_depth=5, features=1, sample=0.8, min_split=4), T.Growth(max_depth=4, min_leaf=3, sample=0.7)])
def test_large_shallow_boosting_deals_no_rows(spark, monkeypatch, g):
    """Fits beyond the bound grow shallow trees by passes over the rows, never by dealing them; the trees are those of one task."""
    matrix, values = _matrix(_rows(spark))
    near, one = T.fit_boosting(matrix, [-1, 0, 3], values, 4, 0.3, g)

    def dealt(*args, **kwargs):
        raise AssertionError("rows are dealt to nodes")

    monkeypatch.setattr(T, "grow", dealt)
    passes, plain = [], T._look
    monkeypatch.setattr(T, "_look", lambda *args: passes.append(len(args[5])) or plain(*args))
    far, many = T.fit_boosting(matrix, [-1, 0, 3], values, 4, 0.3, g, finish_rows=20)
    assert passes and {len(n) for n in one.trees[0]} == {len(n) for n in many.trees[0]}
    for fit in (-1, 0, 3):
        for a, b in zip(one.trees[fit], many.trees[fit], strict=True):
            assert sorted(map(tuple, a[["feature", "code", "depth", "rows", "weight"]])) == sorted(map(tuple, b[["feature", "code", "depth", "rows", "weight"]]))
    a, b = (sorted(map(tuple, f.collect())) for f in (near, far))
    assert [r[:3] for r in a] == [r[:3] for r in b] and [r[3] for r in a] == pytest.approx([r[3] for r in b], rel=1e-9)
