"""Hand-made clinical fixtures (FIXTURES.md section 1) with expected rows worked out by hand."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from stayflow.functions.codes import FLAG_COLUMNS
from stayflow.operators import relational as R
from stayflow.plans import age as G
from stayflow.plans import diagnoses as D
from stayflow.plans import enhanced as X
from stayflow.plans import stays as S
from stayflow.plans import vitals as V

T0 = dt.datetime(2150, 1, 1, 8, 0, 0)


def _stays(spark, rows=None):
    rows = rows or [(1, 10, 100, T0), (2, 10, 100, T0), (3, 20, 200, T0)]
    return spark.createDataFrame(rows, "ICUSTAY_ID int, SUBJECT_ID int, HADM_ID int, INTIME timestamp")


def _events(spark, rows):
    return spark.createDataFrame(rows, "ICUSTAY_ID int, ITEMID int, CHARTTIME timestamp, VALUENUM double")


def test_window_edges_and_counts(spark):
    sec = dt.timedelta(seconds=1)
    day = dt.timedelta(hours=24)
    ev = _events(spark, [
        (1, 211, T0 - sec, 50.0),        # before INTIME: dropped
        (1, 211, T0, 60.0),              # 0 h: kept
        (1, 211, T0 + day, 80.0),        # 24 h: kept
        (1, 211, T0 + day + sec, 90.0),  # after: dropped
        (2, 211, T0 + sec, 70.0),        # one measurement
        (2, 618, T0 + sec, None),        # null value: dropped
        (None, 211, T0 + sec, 99.0),     # null stay: dropped
    ])
    out = {r.ICUSTAY_ID: r for r in V.vitals_first_window(ev, _stays(spark)).collect()}
    assert out[1].heart_rate_count == 2 and out[1].heart_rate_avg == 70.0
    assert out[1].heart_rate_min == 60.0 and out[1].heart_rate_max == 80.0
    assert out[2].heart_rate_count == 1 and out[2].heart_rate_std is None
    assert out[2].respiratory_rate_count == 0 and out[2].respiratory_rate_avg is None
    # stay without any measurement is kept, counts 0
    assert out[3].heart_rate_count == 0 and out[3].spo2_count == 0 and out[3].heart_rate_avg is None
    assert len(out) == 3


def test_full_window_extras(spark):
    ev = _events(spark, [(1, 211, T0 + dt.timedelta(hours=h), v) for h, v in [(1, 60.0), (2, 80.0), (5, 100.0)]])
    r = V.vitals_first_window(ev, _stays(spark), full=True).filter("ICUSTAY_ID = 1").first()
    assert r.heart_rate_median == 80.0
    assert r.heart_rate_first_measurement_hour == 1.0 and r.heart_rate_last_measurement_hour == 5.0
    assert r.heart_rate_range == 40.0
    assert r.heart_rate_coefficient_of_variation == pytest.approx(20.0 / 80.0)


def _diag(spark, rows):
    return spark.createDataFrame(rows, "SUBJECT_ID int, HADM_ID int, SEQ_NUM int, ICD9_CODE string")


def _flags_for(spark, codes, **kw):
    d = _diag(spark, [(10, 100, i, c) for i, c in enumerate(codes)])
    out = D.icd9_chapter_flags(_stays(spark), d, **kw).filter("ICUSTAY_ID = 1").first().asDict()
    return {k for k in FLAG_COLUMNS if out[k] == 1}, out["total_diagnoses"]


def test_chapter_rules(spark):
    assert _flags_for(spark, ["0389"]) == ({"has_infectious"}, 1)
    assert _flags_for(spark, ["2900"]) == ({"has_psychiatric"}, 1)
    assert _flags_for(spark, ["2900"], compat=True) == ({"has_psychiatric", "has_hematologic"}, 1)
    assert _flags_for(spark, ["E8889", "V3001"]) == ({"has_external_causes", "has_supplemental"}, 2)
    assert _flags_for(spark, ["V"]) == ({"has_supplemental"}, 1)
    assert _flags_for(spark, ["V"], strict_letters=True) == (set(), 1)
    assert _flags_for(spark, ["0001"]) == (set(), 1)
    assert _flags_for(spark, ["4019", "42731", None]) == ({"has_cardiovascular"}, 2)


def test_stays_without_diagnosis_and_shared_admission(spark):
    d = _diag(spark, [(10, 100, 1, "4019"), (10, 100, 2, "5849")])
    out = {r.ICUSTAY_ID: r for r in D.icd9_chapter_flags(_stays(spark), d).collect()}
    # two stays of one admission both carry all its diagnoses
    for sid in (1, 2):
        assert out[sid].has_cardiovascular == 1 and out[sid].has_genitourinary == 1
        assert out[sid].total_diagnoses == 2
    assert all(out[3][c] == 0 for c in FLAG_COLUMNS) and out[3].total_diagnoses == 0


def test_labs_stay_separate_per_stay(spark):
    stays = spark.createDataFrame([(1, 100, T0), (2, 100, T0 + dt.timedelta(hours=48))],
                                  "ICUSTAY_ID int, HADM_ID int, INTIME timestamp")
    labs = spark.createDataFrame([(100, 50912, T0 + dt.timedelta(hours=1), 1.0),
                                  (100, 50912, T0 + dt.timedelta(hours=49), 3.0)],
                                 "HADM_ID int, ITEMID int, CHARTTIME timestamp, VALUENUM double")
    out = {r.ICUSTAY_ID: r for r in V.lab_window(stays.select("ICUSTAY_ID"), labs, stays).collect()}
    assert out[1].CREATININE_MEAN == 1.0 and out[2].CREATININE_MEAN == 3.0
    assert len(out) == 2  # no row multiplication (defect D4 avoided)


def test_heart_rate_bounds(spark):
    st = _stays(spark)
    ev = _events(spark, [(1, 211, T0 + dt.timedelta(hours=1), v) for v in (0.0, 299.9, 300.0)])
    r = V.heart_rate_window(st.select("ICUSTAY_ID"), ev, st).filter("ICUSTAY_ID = 1").first()
    assert r.HR_MEAN == 299.9 and r.HR_MIN == 299.9 and r.HR_MAX == 299.9


def _age_frame(spark, rows):
    return spark.createDataFrame(rows, "ADMITTIME timestamp, DOB timestamp")


def test_age_examples(spark):
    rows = [(dt.datetime(2157, 12, 3, 4, 14), dt.datetime(2101, 12, 25)),
            (dt.datetime(2150, 1, 1), dt.datetime(1850, 1, 1)),
            (dt.datetime(2100, 1, 1), dt.datetime(2101, 1, 1))]
    got = [r.age_at_admission for r in G.age_validated(_age_frame(spark, rows)).collect()]
    assert got == [55.9, 90.0, None]
    groups = [r.age_group for r in G.age_validated(_age_frame(spark, rows)).collect()]
    assert groups == ["Adult", "Very Elderly", "Unknown"]


def test_enhanced_age_65(spark):
    df = spark.createDataFrame([(65.0,), (0.0,), (18.0,)], "age_at_admission double")
    rows = X.enh_age(df).collect()
    assert rows[0].age_group == "middle_aged" and rows[0].is_elderly == 1
    assert rows[1].age_group is None  # 0 falls outside (0, 18]
    assert rows[2].age_group == "pediatric" and rows[2].is_pediatric == 0


def test_remaining_los_floor(spark):
    stays = spark.createDataFrame([(1, 10, 100, "MICU", "MICU", 0.5), (2, 10, 101, "MICU", "CCU", 3.0)],
                                  "ICUSTAY_ID int, SUBJECT_ID int, HADM_ID int, FIRST_CAREUNIT string, "
                                  "LAST_CAREUNIT string, LOS double")
    pat = spark.createDataFrame([(10, "F", dt.datetime(2100, 1, 1))], "SUBJECT_ID int, GENDER string, DOB timestamp")
    adm = spark.createDataFrame([(100, dt.datetime(2150, 1, 1, 7), "EMERGENCY", 0),
                                 (101, dt.datetime(2150, 2, 1, 23), "ELECTIVE", 1)],
                                "HADM_ID int, ADMITTIME timestamp, ADMISSION_TYPE string, HOSPITAL_EXPIRE_FLAG int")
    out = {r.ICUSTAY_ID: r for r in S.base_stay_features(stays, pat, adm, 24).collect()}
    assert out[1].REMAINING_LOS == 0.0 and out[2].REMAINING_LOS == 2.0
    assert out[1].IS_EMERGENCY == 1 and out[2].IS_EMERGENCY == 0
    assert out[1].SAME_UNIT_STAY == 1 and out[2].SAME_UNIT_STAY == 0
    assert out[1].ADMISSION_HOUR == 7


def test_keyword_first_match_and_orphan_code(spark):
    d = _diag(spark, [(10, 100, 1, "8001"), (10, 100, 2, "9999")])
    dic = spark.createDataFrame([("8001", "Heart injury", "long")], "ICD9_CODE string, SHORT_TITLE string, "
                                                                    "LONG_TITLE string")
    cat = D.diagnosis_keyword_category(d, dic).collect()
    assert [r.CATEGORY for r in cat] == ["cardiac"]
    joined = R.join_code_dictionary(d, dic).orderBy("SEQ_NUM").collect()
    assert len(joined) == 2 and joined[1].LONG_TITLE is None and "SHORT_TITLE" not in joined[0].asDict()
    feats = D.diagnosis_keyword_features(_stays(spark), d, dic).orderBy("ICUSTAY_ID").collect()
    assert feats[0].HAS_CARDIAC == 1 and feats[0].DISEASE_COUNT == 1
    assert feats[2].HAS_CARDIAC is None  # stay without diagnosis -> NULL
