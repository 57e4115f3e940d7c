"""Large tables are dealt by key, so that a task's share of them stays bounded."""

import pytest
from pyspark.sql import functions as F

from stayflow.operators import quality as Q
from stayflow.operators import relational as R


@pytest.fixture
def few(monkeypatch):
    monkeypatch.setattr(R, "TASK_ROWS", 10)


def _rows(spark, n=600):
    return spark.range(n).select(F.when(F.col("id") % 97 > 0, F.col("id") % 200).alias("k"), (F.col("id") % 7).alias("s"))


def test_pk_violations_deals_rows_by_key(spark, few):
    df = _rows(spark)
    want = df.groupBy("k", "s").count().filter("count > 1 OR k IS NULL OR s IS NULL")
    got = Q.pk_violations(df, ["k", "s"])
    assert sorted(map(str, got.collect())) == sorted(map(str, want.collect()))
    assert got.rdd.getNumPartitions() == 60


def test_left_join_deals_both_sides_by_key(spark, few):
    left, right = spark.range(-20, 300).select(F.when(F.col("id") % 11 > 0, F.col("id")).alias("k")), _rows(spark)
    got, want = R.salted_left_join(left, right, ["k"], 1024), left.join(right, "k", "left")
    assert sorted(map(str, got.select("k", "s").collect())) == sorted(map(str, want.select("k", "s").collect()))
    assert R.dealt(right, ["k"], 600).rdd.getNumPartitions() == 60
    heavy = R.salted_left_join(left, right.withColumn("k", F.coalesce("k", F.lit(5))), ["k"], 4)
    assert heavy.count() == left.join(right.withColumn("k", F.coalesce("k", F.lit(5))), "k", "left").count()


def test_small_tables_stay_as_they_are(spark):
    df = _rows(spark)
    assert R.dealt(df, ["k"], 600) is df
