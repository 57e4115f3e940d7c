"""Quadratic discriminant against numpy, held-out accuracy, edge cases."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from stayflow.llm import quadratic as q
from stayflow.llm.queries import queries

SF = "/root/testdata/sf0.01"


def plain_scores(x, y, of, a=q.TO_POOLED, b=q.TO_ROUND):
    own = [np.cov(x[y == k].T, bias=True) for k in (0, 1)]
    pooled = sum(own[k] * (y == k).sum() for k in (0, 1)) / len(y)
    density = []
    for k in (0, 1):
        s = (1 - a - b) * own[k] + a * pooled + b * np.diag(np.maximum(np.diag(pooled), 1e-6))
        d = of - x[y == k].mean(0)
        density.append(np.log((y == k).mean()) - 0.5 * np.einsum("ij,jk,ik->i", d, np.linalg.inv(s), d) - 0.5 * np.linalg.slogdet(s)[1])
    return 1 / (1 + np.exp(np.clip(density[0] - density[1], -700, 700)))


def test_scores_equal_a_plain_version(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    rows = q.with_statistics(docs).join(spark.read.parquet(f"{SF}/labels.parquet").select("doc_id", F.col("quality").alias("label")), "doc_id")
    got = q.score(rows, q.train(rows)).toPandas()
    x, y = got[list(q.STATISTICS)].to_numpy(), got["label"].to_numpy()
    np.testing.assert_allclose(got["score"], plain_scores(x, y, x), rtol=1e-6, atol=1e-9)


def test_held_out_accuracy(spark):
    out = queries()["op12_quality_classifier"](spark, SF).join(spark.read.parquet(f"{SF}/labels.parquet"), "doc_id").toPandas()
    held = out[out["held_out"]]
    assert (held["predicted"] == held["quality"]).mean() > 0.97
    assert held["score"].between(0, 1).all()


def test_every_row_is_scored(spark):
    rows = [(1, None), (2, ""), (3, "word"), (3, "word"), (None, "a b"), (5, "fine words. " * 60000), (6, "\n \t\n"), (7, "é ß\n" * 40)]
    docs = spark.createDataFrame([(i, t, "x", 1.0) for i, t in rows], "doc_id long, text string, score string, symbols double")
    stats = q.with_statistics(docs)
    assert stats.columns == ["doc_id", *q.STATISTICS]
    one = q.fit({0: (9, np.zeros(14), np.eye(14) * 9), 1: (9, np.ones(14) * 9, np.eye(14) * 18 + 9)})
    got = q.score(stats, one).toPandas()
    assert len(got) == len(rows) and got["score"].between(0, 1).all()
    assert np.isfinite(got[list(q.STATISTICS)].to_numpy()).all()
    same = got[got["doc_id"] == 3]
    assert same["score"].nunique() == 1
    assert np.allclose(q.statistics(None), q.statistics(""))


@pytest.mark.parametrize("labels, share", [([], 0.5), ([1, 1], 1.0), ([0], 0.0), ([None, 7], 0.5)])
def test_without_both_classes(spark, labels, share):
    rows = spark.createDataFrame([(k, "text", y) for k, y in enumerate(labels)], "doc_id long, text string, label int")
    stats = q.with_statistics(rows).join(rows.select("doc_id", "label"), "doc_id")
    model = q.train(stats)
    assert model.share == share
    assert all(r["score"] == share for r in q.score(stats, model).collect())


def test_empty_table(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert q.score(q.with_statistics(docs), q.fit({})).count() == 0


def test_statistics_follow_the_text():
    at = dict(zip(q.STATISTICS, range(len(q.STATISTICS))))
    plain, junk = q.statistics("some plain words here. " * 50), q.statistics("some$$ plain## WORDS!! here|| " * 50)
    for name in ("symbols", "shouts", "capitals", "marked_words"):
        assert junk[at[name]] > plain[at[name]]
    assert q.statistics("one line of text\n" * 30)[at["repeated_lines"]] > q.statistics("\n".join(f"line {k} of text" for k in range(30)))[at["repeated_lines"]]
