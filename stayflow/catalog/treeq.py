"""Registered queries: small trees and boosting whose every step SQL repeats.

The learners of :mod:`stayflow.plans.trees` on features of few values, where the candidate
splits are all values.  SQL grows the same trees level by level: counts and sums per
node, feature and value, prefix sums over the values, the largest gain.  Labels are summed
as integers on both sides, so equal gains are equal; the random thresholds of the extra tree
are hashes of node and feature, listed in the SQL.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Window
from pyspark.sql import functions as F

from stayflow.catalog import query
from stayflow.catalog.features import _feature_table
from stayflow.catalog.mlq import _CLEAN_SQL, _SPLIT, _VCOLS
from stayflow.functions.codes import FLAG_COLUMNS
from stayflow.plans import mlprep as P
from stayflow.plans import models as M
from stayflow.plans import trees as T
from stayflow.session import materialize

FEATURES = [*FLAG_COLUMNS, "total_diagnoses", *[c for c in _VCOLS if c.endswith("_count")]]
#: Nodes with more rows are split by aggregates over all rows.
FINISH_ROWS = 1 << 10
DEPTH, ROUNDS, RATE = 3, 2, 0.1
TREE, EXTRA = T.Growth(max_depth=DEPTH), T.Growth(max_depth=DEPTH, random_split=True)

_ROWS_SQL = (f"SELECT ICUSTAY_ID AS id, {_SPLIT} < 20 AS held, LOS, CAST(round(LOS * {T.SCALE}) AS BIGINT) AS y, "
             + ", ".join(f'CAST(coalesce("{c}", 0) AS DOUBLE) AS f{i}' for i, c in enumerate(FEATURES)) + f" FROM ({_CLEAN_SQL})")


def _heap_paths(tree: int, depth: int) -> dict[int, int]:
    """Path hash of every node by its heap number (root 1, children 2 n and 2 n + 1)."""
    out = {1: T.root_path(tree)}
    for n in range(1, 2 ** depth):
        out[2 * n], out[2 * n + 1] = (int(v[0]) for v in T.child_paths(np.array([out[n]], np.uint64)))
    return out


def _tree_ctes(name: str, rows: str, depth: int, tree: int = 0, random: bool = False) -> str:
    """CTEs that grow a tree over ``rows`` (id, held, y, f0, ...): ``<name>_nodes`` (node, f, v, n, s, gain) and
    ``<name>_at`` (id, node), the node where each row ends."""
    long = ", ".join(f"({i}, f{i})" for i in range(len(FEATURES)))
    ctes = [f"{name}_l AS MATERIALIZED (SELECT id, held, y, u.f, u.v FROM {rows}, LATERAL (VALUES {long}) u(f, v))",
            f"{name}_a0 AS (SELECT id, 1 AS node FROM {rows})"]
    draws = ", ".join(f"({n}, {i}, {int(T.drawn(p, i, 5))}::DOUBLE / 4294967296)" for n, p in _heap_paths(tree, depth).items() for i in range(len(FEATURES)))
    if random:
        ctes.append(f"{name}_u(node, f, u) AS (VALUES {draws})")
    for d in range(depth):
        c = f"{name}_c{d}"
        ctes.append(f"""{c} AS (SELECT node, f, v, count(*) AS n, sum(y) AS s FROM {name}_l JOIN {name}_a{d} USING (id) WHERE NOT held GROUP BY node, f, v)""")
        ctes.append(f"""{c}p AS (SELECT node, f, v, CAST(sum(n) OVER w AS DOUBLE) AS ln, CAST(sum(s) OVER w AS DOUBLE) AS ls,
  CAST(sum(n) OVER a AS DOUBLE) AS n, CAST(sum(s) OVER a AS DOUBLE) AS s, min(v) OVER a AS lo, max(v) OVER a AS hi,
  lead(v) OVER (PARTITION BY node, f ORDER BY v) AS after FROM {c}
  WINDOW w AS (PARTITION BY node, f ORDER BY v ROWS UNBOUNDED PRECEDING), a AS (PARTITION BY node, f))""")
        chance = f"JOIN {name}_u USING (node, f) WHERE v <= lo + u * (hi - lo) AND after > lo + u * (hi - lo) AND ln < n" if random else "WHERE ln < n"
        ctes.append(f"""{c}b AS (SELECT *, row_number() OVER (PARTITION BY node ORDER BY gain DESC, f, v) AS best FROM (
  SELECT node, f, v, n, s, ls * ls / ln + (s - ls) * (s - ls) / (n - ln) - s * s / n AS gain FROM {c}p {chance}))""")
        ctes.append(f"""{name}_b{d} AS (SELECT b.* FROM {c}b b JOIN (SELECT node, sum(CAST(y AS DOUBLE) * y) AS q FROM {name}_l JOIN {name}_a{d} USING (id)
  WHERE NOT held AND f = 0 GROUP BY node) USING (node) WHERE best = 1 AND gain > 1e-11 * q)""")
        ctes.append(f"""{name}_a{d + 1} AS (SELECT id, 2 * node + CAST(l.v > b.v AS INT) AS node FROM {name}_a{d} JOIN {name}_b{d} b USING (node)
  JOIN {name}_l l USING (id) WHERE l.f = b.f)""")
    stays = " UNION ALL ".join([f"SELECT id, node FROM {name}_a{d} ANTI JOIN {name}_b{d} USING (node)" for d in range(depth)] + [f"SELECT id, node FROM {name}_a{depth}"])
    splits = " UNION ALL ".join(f"SELECT node, f, v, gain FROM {name}_b{d}" for d in range(depth))
    every = " UNION ALL ".join(f"SELECT node, id FROM {name}_a{d}" for d in range(depth + 1))
    ctes.append(f"{name}_at AS ({stays})")
    ctes.append(f"""{name}_nodes AS (SELECT node, f, v, CAST(count(*) AS BIGINT) AS n, CAST(sum(y) AS DOUBLE) / count(*) / {T.SCALE} AS value, any_value(gain) AS gain
  FROM ({every}) JOIN {rows} USING (id) LEFT JOIN ({splits}) USING (node) WHERE NOT held GROUP BY node, f, v)""")
    return ",\n".join(ctes)


_NAMES_SQL = "(VALUES " + ", ".join(f"({i}, '{c}')" for i, c in enumerate(FEATURES)) + ") names(f, feature)"


def _nodes_sql(random: bool) -> str:
    return f"""WITH r AS MATERIALIZED ({_ROWS_SQL}),
{_tree_ctes("t", "r", DEPTH, 0, random)}
SELECT node, feature, v AS threshold, n AS rows, gain / {T.SCALE}.0 / {T.SCALE}.0 AS gain, value FROM t_nodes LEFT JOIN {_NAMES_SQL} USING (f)"""


def _matrix(spark, d):
    """Matrix of the cleaned stays: fold 0 learns, the hold-out rows do not."""
    ft = P.with_split(P.target_clean_fixed(_feature_table(spark, d)).select("ICUSTAY_ID", "LOS", *FEATURES).fillna(0, FEATURES))
    rows = materialize(ft.withColumn("fold", F.when(F.col("split") == "test", T.HELD_OUT).otherwise(0)))
    values = T.feature_values(rows.filter("fold = 0"), FEATURES)
    return T.binned(rows, values, FEATURES, "ICUSTAY_ID", "fold", "LOS"), values


def _grown(spark, d, g):
    matrix, values = _matrix(spark, d)
    grown, tops = T.fit_forest(matrix, [T.HELD_OUT], values, 1, g, FINISH_ROWS)
    return matrix, values, grown, tops


def _nodes(spark, d, g):
    """The node table of one tree with heap numbers, feature names and thresholds: at most 2 ** (depth + 1) rows."""
    _, values, grown, tops = _grown(spark, d, g)
    parts = sorted((r["root"], bytes(r["nodes"])) for r in grown.filter("root >= 0").select("root", "nodes").collect())
    nodes = T.whole_tree(tops.get((0, T.HELD_OUT)), parts)
    out, todo = [], [(1, 0)]
    while todo:
        heap, at = todo.pop()
        n = nodes[at]
        f = int(n["feature"])
        named = (FEATURES[f], float(values[f][n["code"]]), float(n["gain"])) if f >= 0 else (None, None, None)
        out.append((heap, *named[:2], int(n["rows"]), named[2], float(n["value"])))
        if f >= 0:
            todo += [(2 * heap, int(n["left"])), (2 * heap + 1, int(n["left"]) + 1)]
    return spark.createDataFrame(out, "node int, feature string, threshold double, rows long, gain double, value double")


@query("regression_tree_nodes", dbl="threshold gain value", sql=_nodes_sql(False))
def regression_tree_nodes(spark, d):
    """Node table of a tree of depth 3: best splits by prefix sums over the sorted values."""
    return _nodes(spark, d, TREE)


@query("extra_tree_nodes", dbl="threshold gain value", sql=_nodes_sql(True))
def extra_tree_nodes(spark, d):
    """Node table of an extra tree of depth 3: one random threshold for each node and feature."""
    return _nodes(spark, d, EXTRA)


@query("tree_importance", dbl="importance", sql=f"""WITH r AS MATERIALIZED ({_ROWS_SQL}),
{_tree_ctes("t", "r", DEPTH)}
SELECT feature, coalesce(sum(gain), 0) / (SELECT sum(gain) FROM t_nodes) AS importance FROM {_NAMES_SQL} LEFT JOIN t_nodes USING (f) GROUP BY feature""")
def tree_importance(spark, d):
    """Importance of every feature, aggregated from the node table: share of all gains."""
    _, _, grown, tops = _grown(spark, d, TREE)
    return M.feature_importance((grown, tops), FEATURES, top=None)


def _boost_ctes() -> str:
    start = f"CAST((SELECT sum(y) FROM r WHERE NOT held) AS DOUBLE) / (SELECT count(*) FROM r WHERE NOT held) / {T.SCALE}"
    cols = ", ".join(f"f{i}" for i in range(len(FEATURES)))
    ctes = [f"s0 AS MATERIALIZED (SELECT *, {start} AS now FROM r)"]
    for k in range(ROUNDS):
        ctes.append(f"r{k} AS MATERIALIZED (SELECT id, held, LOS, now, CAST(round((LOS - now) * {T.SCALE}) AS BIGINT) AS y, {cols} FROM s{k})")
        ctes.append(_tree_ctes(f"b{k}", f"r{k}", 1))
        ctes.append(f"s{k + 1} AS MATERIALIZED (SELECT r{k}.* REPLACE (now + {RATE} * value AS now) FROM r{k} JOIN b{k}_at USING (id) JOIN b{k}_nodes USING (node))")
    return ",\n".join(ctes)


@query("boosted_stumps", dbl="prediction", sql=f"""WITH r AS MATERIALIZED ({_ROWS_SQL}),
{_boost_ctes()}
SELECT id AS "row", now AS prediction FROM s{ROUNDS} WHERE held""")
def boosted_stumps(spark, d):
    """Hold-out predictions of two boosting rounds of depth 1."""
    matrix, values = _matrix(spark, d)
    pred, _ = T.fit_boosting(matrix, [T.HELD_OUT], values, ROUNDS, RATE, T.Growth(max_depth=1), FINISH_ROWS)
    return pred.select("row", "prediction")


_FITTED_SQL = f"""r AS MATERIALIZED ({_ROWS_SQL}),
{_tree_ctes("t", "r", DEPTH)},
{_tree_ctes("e", "r", DEPTH, 0, True)},
{_boost_ctes()},
p AS (SELECT 'Regression Tree' AS model, LOS, value AS p FROM r JOIN t_at USING (id) JOIN t_nodes USING (node) WHERE held
  UNION ALL SELECT 'Extra Tree', LOS, value FROM r JOIN e_at USING (id) JOIN e_nodes USING (node) WHERE held
  UNION ALL SELECT 'Boosted Stumps', LOS, now FROM s{ROUNDS} WHERE held),
m AS (SELECT model, sqrt(avg((LOS - p) * (LOS - p))) AS rmse, avg(abs(LOS - p)) AS mae,
  1 - sum((LOS - p) * (LOS - p)) / (var_pop(LOS) * count(*)) AS r2, avg(abs((LOS - p) / LOS)) * 100 AS mape FROM p GROUP BY model)"""
_SPECS = {"Regression Tree": {"kind": "forest", "num_trees": 1, "max_depth": DEPTH},
          "Extra Tree": {"kind": "forest", "num_trees": 1, "max_depth": DEPTH, "random_split": True},
          "Boosted Stumps": {"kind": "gbt", "max_iter": ROUNDS, "step_size": RATE, "max_depth": 1}}


def _fitted(spark, d):
    """Hold-out metrics of the fitted models, from the written table of their predictions."""
    ft = P.with_split(P.target_clean_fixed(_feature_table(spark, d)).select("ICUSTAY_ID", "LOS", *FEATURES).fillna(0, FEATURES))
    rows = materialize(ft)
    train, test = (rows.filter(F.col("split") == s).drop("split") for s in ("train", "test"))
    return M.fit_evaluate(train, test, _SPECS, FEATURES)[0]


@query("rank_fitted_models", dbl="rmse mae r2 mape", sql=f"""WITH {_FITTED_SQL}
SELECT *, row_number() OVER (ORDER BY rmse, model) AS rank FROM m""")
def rank_fitted_models(spark, d):
    """Ranking of fitted models by metrics of their written hold-out predictions."""
    return M.rank_models(_fitted(spark, d)).withColumn("rank", F.row_number().over(Window.orderBy("rmse", "model")).cast("long"))  # three rows


@query("compare_fitted_models", dbl="baseline_best enhanced_best improvement_pct", sql=f"""WITH {_FITTED_SQL},
b AS (SELECT * FROM m WHERE model <> 'Regression Tree' ORDER BY rmse, model LIMIT 1), e AS (SELECT * FROM m WHERE model = 'Regression Tree')
SELECT b.model AS baseline_best_model, b.rmse AS baseline_best, e.model AS enhanced_best_model, e.rmse AS enhanced_best,
  (b.rmse - e.rmse) / b.rmse * 100 AS improvement_pct FROM b, e""")
def compare_fitted_models(spark, d):
    """Best of the extra tree and the boosted stumps against the tree, improvement %."""
    m = materialize(_fitted(spark, d))
    return M.compare_pipelines(m.filter("model <> 'Regression Tree'"), m.filter("model = 'Regression Tree'"))
