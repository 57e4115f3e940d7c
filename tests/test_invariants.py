"""Invariants on the test-table roles: N:1 joins keep rows, flags are 0/1, min <= avg <= max,
and the one-pass vitals plan equals the reference's per-vital join plan."""

from pyspark.sql import functions as F

from stayflow.functions.codes import FLAG_COLUMNS
from stayflow.operators import relational as R
from stayflow.plans import diagnoses as D
from stayflow.plans import vitals as V
from stayflow.sources import testmap as tm

SF = "/root/testdata/sf0.001"


def test_n_to_1_joins_keep_rows(spark):
    s = tm.icustays(spark, SF)
    sa = R.join_stay_admission(s, tm.admissions(spark, SF))
    sap = R.join_patient(sa, tm.patients(spark, SF))
    assert s.count() == sa.count() == sap.count()


def test_flags_are_binary_and_bounded(spark):
    f = D.icd9_chapter_flags(tm.icustays(spark, SF), tm.diagnoses_icd(spark, SF), keys=["HADM_ID"])
    row = f.agg(*[F.max(c).alias(c) for c in FLAG_COLUMNS], *[F.min(c).alias("min_" + c) for c in FLAG_COLUMNS],
                F.count(F.lit(1)).alias("n")).first().asDict()
    assert all(row[c] in (0, 1) and row["min_" + c] in (0, 1) for c in FLAG_COLUMNS)
    freq = D.icd9_category_frequency(f).collect()
    assert len(freq) == 19 and all(r["count"] <= row["n"] for r in freq)


def test_min_avg_max(spark):
    v = V.vitals_first_window(tm.chartevents(spark, SF), tm.event_stays(spark, SF), tm.TEST_VITALS)
    for n in tm.TEST_VITALS:
        bad = v.filter((F.col(f"{n}_min") > F.col(f"{n}_avg")) | (F.col(f"{n}_avg") > F.col(f"{n}_max"))).count()
        assert bad == 0


def test_one_pass_equals_per_vital_joins(spark):
    ev, st = tm.chartevents(spark, SF), tm.event_stays(spark, SF)
    one = V.vitals_first_window(ev, st, tm.TEST_VITALS)
    # the reference's shape: one filtered aggregate per vital, left-joined in turn
    win = V.window_events(ev, st, [i for items in tm.TEST_VITALS.values() for i in items])
    multi = st.select("ICUSTAY_ID")
    for n, items in tm.TEST_VITALS.items():
        part = win.filter(F.col("ITEMID").isin(items)).groupBy("ICUSTAY_ID").agg(
            F.avg("VALUENUM").alias(f"{n}_avg"), F.min("VALUENUM").alias(f"{n}_min"),
            F.max("VALUENUM").alias(f"{n}_max"), F.stddev("VALUENUM").alias(f"{n}_std"),
            F.count("VALUENUM").alias(f"{n}_count"))
        multi = multi.join(part, "ICUSTAY_ID", "left")
    multi = multi.fillna(0, subset=[f"{n}_count" for n in tm.TEST_VITALS])
    cols = sorted(one.columns)
    a = sorted(tuple(round(x, 9) if isinstance(x, float) else x for x in r) for r in one.select(cols).collect())
    b = sorted(tuple(round(x, 9) if isinstance(x, float) else x for x in r) for r in multi.select(cols).collect())
    assert a == b


def test_bucketed_interval_join_equals_naive(spark):
    import datetime as dt

    from stayflow.functions.timefn import plus_hours
    base = dt.datetime(2150, 1, 1)
    stays = spark.createDataFrame(
        [(s, 1, base + dt.timedelta(hours=h)) for s, h in [(1, 0), (2, 23), (3, 30.5), (4, 100)]]
        + [(5, 2, base)], "ICUSTAY_ID int, HADM_ID int, INTIME timestamp")
    events = spark.createDataFrame(
        [(1, base + dt.timedelta(minutes=m), float(m)) for m in range(0, 150 * 60, 37)]
        + [(2, base + dt.timedelta(hours=24), 1.0), (3, base, 2.0)],
        "HADM_ID int, CHARTTIME timestamp, VALUENUM double")
    fast = R.interval_join(events, stays, "HADM_ID", "CHARTTIME", "INTIME", 24)
    naive = events.join(stays, "HADM_ID").filter(
        (F.col("CHARTTIME") >= F.col("INTIME")) & (F.col("CHARTTIME") <= plus_hours(F.col("INTIME"), 24)))
    cols = ["ICUSTAY_ID", "CHARTTIME", "VALUENUM"]
    assert sorted(fast.select(cols).collect()) == sorted(naive.select(cols).collect())
    assert fast.count() > 0


def test_salted_left_join_equals_left_join(spark):
    left = spark.createDataFrame([(1, "a"), (1, "b"), (2, "c"), (3, "d"), (None, "e")], "k int, l string")
    right = spark.createDataFrame([(1, i) for i in range(500)] + [(2, 7), (2, 7), (None, 9)], "k int, r int")
    fast = R.salted_left_join(left, right, ["k"], parts=4)
    plain = left.join(right, ["k"], "left")
    def key(r):
        return tuple((v is None, v if v is not None else 0) for v in r)
    assert sorted(fast.collect(), key=key) == sorted(plain.select(*fast.columns).collect(), key=key)
