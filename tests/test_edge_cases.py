"""Edge cases of single operators: NULL keys, empty frames, fractions of hours, large keys, malformed cells."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from stayflow.functions.timefn import plus_hours
from stayflow.operators import aggregates as A
from stayflow.operators import ordering as O
from stayflow.operators import quality as Q
from stayflow.operators import relational as R
from stayflow.plans import mlprep as P
from stayflow.plans import vitals as V
from stayflow.sources import io
from stayflow.sources.schemas import schema_of

T0 = dt.datetime(2150, 1, 1)


def test_a_window_of_an_hour_and_a_half(spark):
    stays = spark.createDataFrame([(1, 1, T0)], "ICUSTAY_ID int, HADM_ID int, INTIME timestamp")
    events = spark.createDataFrame([(1, 1, 211, T0 + dt.timedelta(minutes=m), v) for m, v in ((30, 10.0), (75, 20.0), (91, 90.0))],
                                   "ICUSTAY_ID int, HADM_ID int, ITEMID int, CHARTTIME timestamp, VALUENUM double")
    base = stays.select("ICUSTAY_ID")
    hr = V.heart_rate_window(base, events, stays, 1.5, item_ids=[211]).first()
    lab = V.lab_window(base, events, stays, 1.5, item_ids=[211]).first()
    vit = V.vitals_first_window(events, stays, {"heart_rate": [211]}, 1.5).first()
    assert hr.HR_MEAN == lab.CREATININE_MEAN == vit.heart_rate_avg == 15.0
    assert stays.select(plus_hours(F.col("INTIME"), 0.25)).first()[0] == T0 + dt.timedelta(minutes=15)


def test_null_keys_violate_and_empty_frames_count_zero(spark):
    df = spark.createDataFrame([(1, 1), (None, 2)], "a int, b int")
    assert [tuple(r) for r in Q.pk_violations(df, ["a", "b"]).collect()] == [(None, 2, 1)]
    assert A.count_distinct(df.filter("b > 9"), "a").first()[0] == 0
    assert A.count_distinct(df, "a").first()[0] == 2


def test_modes(spark):
    df = spark.createDataFrame([("x", "b"), ("x", "a"), ("x", "a"), ("x", "b"), ("x", None), ("x", None), ("x", None), ("y", None)],
                               "g string, v string")
    assert A.mode_value(df, "v").first()[0] == "a"
    assert {r.g: r["mode"] for r in A.mode_value(df, "v", by=["g"]).collect()} == {"x": "a", "y": None}
    assert P.column_modes(df, ["v", "g"]) == {"v": "a", "g": "x"}


def test_large_keys_split_and_sample(spark):
    df = spark.range(10 ** 10, 10 ** 10 + 4000).withColumnRenamed("id", "ICUSTAY_ID")
    share = P.with_split(df).filter("split = 'test'").count() / 4000
    assert 0.15 < share < 0.25
    assert P.with_fold(df, k=5).select("fold").distinct().count() == 5
    assert O.sample_bound(50_000, 10 ** 12) == (50_000 << 60) // 10 ** 12 > 0
    kept = O.sample_fraction(df, 50_000, total=10 ** 12 // 10 ** 7, key="ICUSTAY_ID").count()
    assert 1800 < kept < 2200


def test_malformed_cells_fail_the_scan(spark, tmp_path):
    schema = schema_of("D_LABITEMS")
    (tmp_path / "x.csv").write_text(",".join(schema.names) + "\n1,seven,a,b,c,d\n")
    with pytest.raises(Exception, match="(?i)malformed"):
        io.typed_event_scan(spark, str(tmp_path / "x.csv"), schema).collect()
    assert io.typed_event_scan(spark, str(tmp_path / "x.csv"), schema, {"ITEMID": "string"}).first().ITEMID == "seven"


def test_only_heavy_keys_are_salted_in_proportion(spark):
    events = spark.range(9000).select(F.when(F.col("id") < 3000, 0).otherwise(F.col("id")).alias("k"), F.col("id").alias("v"))
    stays = spark.range(9000).select(F.col("id").alias("k"), (F.col("id") * 2).alias("s"))
    assert R.heavy_keys(events, ["k"], 600) == [(0, 200)]
    assert R.heavy_keys(stays, ["k"], 600) == []
    ev, st, on = R.salted(events, stays, ["k"], ["k", "v"], 600)
    assert on == ["k", "_salt"] and st.count() == 9000 + 199
    assert ev.filter("k = 0").select("_salt").distinct().count() == 200
    out = R.salted_join(events, stays, "k", ["k", "v"], 600)
    assert out.count() == 9000 - 2999 + 2999 and out.filter("s <> 2 * k").count() == 0


def test_one_hot_of_many_levels(spark):
    df = spark.range(5000).select(F.col("id").alias("key"), F.when(F.col("id") % 10 != 3, F.concat(F.lit("v"), F.col("id") % 4001)).alias("a"),
                                  (F.col("id") % 3).alias("b")).repartition(5)
    rows = df.collect()
    places = {("a", v): k for k, v in enumerate(sorted({r["a"] for r in rows if r["a"] is not None}))}
    width = len(places)
    places |= {("b", v): width + k for k, v in enumerate(sorted({r["b"] for r in rows}))}
    want = {r["key"]: sorted(places[c, r[c]] for c in "ab" if r[c] is not None) for r in rows}
    got = {r["key"]: r["indices"] for r in P.one_hot_sparse(df, ["a", "b"], "key").collect()}
    assert got == want
    fewer = {r["key"]: r["indices"] for r in P.one_hot_sparse(df, ["b", "a"], "key", drop_first=True).collect()}
    for r in rows:
        own = [r["b"] - 1] if r["b"] else []
        own += [places["a", r["a"]] + 1] if r["a"] is not None and places["a", r["a"]] else []
        assert fewer[r["key"]] == own
    with pytest.raises(ValueError, match="more than 100 levels"):
        P.category_levels(df, ["a", "b"], limit=100)
    assert P.category_levels(df, ["b"]) == {"b": [0, 1, 2]}
