"""A stay holding a third of all events: the salted event join spreads it over several
tasks, partial aggregation collapses it before the shuffle on the stay id, and the
per-stay statistics stay exact."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from stayflow.plans import vitals as V

T0 = dt.datetime(2150, 1, 1)


@pytest.fixture
def skew_conf(spark):
    keys = {"spark.sql.autoBroadcastJoinThreshold": "-1",
            "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
            "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1k",
            "spark.sql.adaptive.advisoryPartitionSizeInBytes": "1k",
            "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    old = {k: spark.conf.get(k, None) for k in keys}
    for k, v in keys.items():
        spark.conf.set(k, v)
    yield
    for k, v in old.items():
        if v is None:
            spark.conf.unset(k)
        else:
            spark.conf.set(k, v)


def test_hot_stay_is_split_and_exact(spark, skew_conf):
    n_hot, n_cold, stays_n = 20000, 40000, 400
    hot = spark.range(n_hot).select(F.lit(0).alias("ICUSTAY_ID"), F.lit(211).alias("ITEMID"),
                                    (F.lit(T0) + F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), F.col("id") % 3600)
                                     ).alias("CHARTTIME"), (F.col("id") % 100).cast("double").alias("VALUENUM"))
    cold = spark.range(n_cold).select((F.col("id") % (stays_n - 1) + 1).cast("int").alias("ICUSTAY_ID"),
                                      F.lit(211).alias("ITEMID"),
                                      (F.lit(T0) + F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), F.col("id") % 3600)
                                       ).alias("CHARTTIME"), (F.col("id") % 50).cast("double").alias("VALUENUM"))
    events = hot.unionByName(cold).repartition(8)
    stays = spark.range(stays_n).select(F.col("id").cast("int").alias("ICUSTAY_ID"), F.lit(T0).alias("INTIME"))
    out = V.vitals_first_window(events, stays, {"heart_rate": [211]})
    rows = {r.ICUSTAY_ID: r for r in out.collect()}
    assert rows[0].heart_rate_count == n_hot
    assert rows[0].heart_rate_avg == pytest.approx(sum(i % 100 for i in range(n_hot)) / n_hot)
    assert sum(r.heart_rate_count for r in rows.values()) == n_hot + n_cold
    final = out._jdf.queryExecution().executedPlan().toString()
    assert "isFinalPlan=true" in final
    # the event join runs on (stay, salt): the hot stay is spread over the salt tasks ...
    join_line = next(line for line in final.split("\n") if "Join" in line and "Inner" in line)
    assert "_salt" in join_line
    # ... and is pre-aggregated there, before the shuffle on the stay id alone
    i_partial = final.index("partial_count")
    assert "Exchange hashpartitioning(ICUSTAY_ID" in final[:i_partial] or \
        "hashpartitioning(ICUSTAY_ID#" in final[:i_partial]
