"""Registered queries: projections, filters, joins, aggregates, ordering, scalar
functions (survey sections 2.3, 2.4, 2.5, 2.7, 2.8)."""

from __future__ import annotations

from pyspark.sql import functions as F

from stayflow.catalog import query
from stayflow.functions.codes import CHAPTERS, FLAG_COLUMNS, HEMATOLOGIC_COMPAT_HIGH, LETTER_CHAPTERS
from stayflow.functions.timefn import hours_between, plus_hours
from stayflow.operators import aggregates as A
from stayflow.operators import ordering as O
from stayflow.operators import relational as R
from stayflow.plans import diagnoses as D
from stayflow.plans.features import stay_table
from stayflow.sources import testmap as tm

HOURS_SQL = "(floor(epoch({a})) - floor(epoch({b}))) / 3600.0"
WIN_SQL = HOURS_SQL.format(a="c.CHARTTIME", b="s.INTIME")
VITAL_ITEMS_SQL = "('click', 'view', 'purchase')"

# ------------------------------------------------------------------ 2.3 projections and filters


@query("project_columns", sql="SELECT ICUSTAY_ID, INTIME FROM r_icustays")
def project_columns(spark, d):
    return R.project_columns(tm.icustays(spark, d), ["ICUSTAY_ID", "INTIME"])


@query("drop_columns", dbl="LOS", sql="""
SELECT SUBJECT_ID, HADM_ID, ICUSTAY_ID, INTIME, OUTTIME, LOS FROM r_icustays""")
def drop_columns(spark, d):
    return R.drop_columns(tm.icustays(spark, d), ["DBSOURCE", "FIRST_CAREUNIT", "LAST_CAREUNIT", "DOD_HOSP"])


@query("select_available", dbl="LOS", sql="SELECT ICUSTAY_ID, FIRST_CAREUNIT, LOS FROM r_icustays")
def select_available(spark, d):
    out, _missing = R.select_available(tm.icustays(spark, d), ["ICUSTAY_ID", "FIRST_CAREUNIT", "INSURANCE",
                                                                "ADMISSION_TYPE"], target="LOS")
    return out


@query("filter_not_null", dbl="VALUENUM", sql="""
SELECT ICUSTAY_ID, ITEMID, VALUENUM FROM r_chartevents WHERE ICUSTAY_ID IS NOT NULL AND VALUENUM IS NOT NULL""")
def filter_not_null(spark, d):
    return R.filter_not_null(tm.chartevents(spark, d), ["ICUSTAY_ID", "VALUENUM"]).select(
        "ICUSTAY_ID", "ITEMID", "VALUENUM")


@query("filter_item_set", dbl="VALUENUM", sql=f"""
SELECT ICUSTAY_ID, ITEMID, VALUENUM FROM r_chartevents WHERE ITEMID IN {VITAL_ITEMS_SQL}""")
def filter_item_set(spark, d):
    return R.filter_item_set(tm.chartevents(spark, d), ["click", "view", "purchase"]).select(
        "ICUSTAY_ID", "ITEMID", "VALUENUM")


@query("filter_value_bounds", dbl="VALUENUM", sql="""
SELECT ICUSTAY_ID, ITEMID, VALUENUM FROM r_chartevents WHERE VALUENUM > 0 AND VALUENUM < 300""")
def filter_value_bounds(spark, d):
    return R.filter_value_bounds(tm.chartevents(spark, d), "VALUENUM", 0, 300).select(
        "ICUSTAY_ID", "ITEMID", "VALUENUM")


@query("filter_time_window", dbl="VALUENUM hours_from_intime", sql=f"""
SELECT c.ICUSTAY_ID, c.ITEMID, c.VALUENUM, {WIN_SQL} AS hours_from_intime
FROM r_chartevents c JOIN r_event_stays s ON c.ICUSTAY_ID = s.ICUSTAY_ID
WHERE {WIN_SQL} BETWEEN 0 AND 24""")
def filter_time_window(spark, d):
    j = R.join_events_to_stay(tm.chartevents(spark, d), tm.event_stays(spark, d))
    return R.filter_time_window(j, "CHARTTIME", "INTIME", 24).select(
        "ICUSTAY_ID", "ITEMID", "VALUENUM", "hours_from_intime")


@query("filter_source_system", sql="SELECT ICUSTAY_ID, DBSOURCE FROM r_icustays WHERE DBSOURCE = 'carevue'")
def filter_source_system(spark, d):
    return R.filter_source_system(tm.icustays(spark, d), "carevue").select("ICUSTAY_ID", "DBSOURCE")


@query("filter_sql_expression", sql="""
SELECT SUBJECT_ID, count(ICUSTAY_ID) AS icu_stays_count FROM r_icustays GROUP BY SUBJECT_ID
HAVING count(ICUSTAY_ID) > 1""")
def filter_sql_expression(spark, d):
    per = tm.icustays(spark, d).groupBy("SUBJECT_ID").agg(F.count("ICUSTAY_ID").alias("icu_stays_count"))
    return R.filter_sql_expression(per, "icu_stays_count > 1")


@query("filter_like_ci", sql="""
SELECT HADM_ID, ADMISSION_TYPE FROM r_admissions WHERE lower(ADMISSION_TYPE) LIKE '%urgent%'""")
def filter_like_ci(spark, d):
    return R.filter_like_ci(tm.admissions(spark, d), "ADMISSION_TYPE", "%urgent%").select("HADM_ID", "ADMISSION_TYPE")


@query("filter_regex_prefix", sql="""
SELECT HADM_ID, SEQ_NUM, ICD9_CODE FROM r_diagnoses_icd WHERE regexp_matches(ICD9_CODE, '^(E|V)[0-9]')""")
def filter_regex_prefix(spark, d):
    return R.filter_regex_prefix(tm.diagnoses_icd(spark, d), "ICD9_CODE", "^(E|V)[0-9]")


@query("fill_null_zero", sql="""
SELECT s.ICUSTAY_ID, coalesce(n.lines, 0) AS lines
FROM r_icustays s LEFT JOIN (SELECT HADM_ID, count(*) AS lines FROM r_diagnoses_icd GROUP BY HADM_ID) n
  ON s.HADM_ID = n.HADM_ID""")
def fill_null_zero(spark, d):
    n = tm.diagnoses_icd(spark, d).groupBy("HADM_ID").agg(F.count(F.lit(1)).alias("lines"))
    s = tm.icustays(spark, d).select("ICUSTAY_ID", "HADM_ID")
    return R.fill_null_zero(s.join(n, "HADM_ID", "left"), ["lines"]).select("ICUSTAY_ID", "lines")


@query("clip_floor", dbl="REMAINING_LOS", sql="""
SELECT ICUSTAY_ID, greatest(LOS - 24 / 24.0, 0) AS REMAINING_LOS FROM r_icustays""")
def clip_floor(spark, d):
    s = tm.icustays(spark, d)
    return s.select("ICUSTAY_ID", R.clip_floor(F.col("LOS") - F.lit(1.0), 0.0).alias("REMAINING_LOS"))


# ------------------------------------------------------------------ 2.4 joins

STAY_ADM_SQL = """
SELECT s.*, a.ADMITTIME, a.DISCHTIME, a.ADMISSION_TYPE, a.INSURANCE, a.MARITAL_STATUS, a.HOSPITAL_EXPIRE_FLAG
FROM r_icustays s LEFT JOIN r_admissions a ON s.SUBJECT_ID = a.SUBJECT_ID AND s.HADM_ID = a.HADM_ID"""


@query("join_stay_admission", dbl="LOS", sql=STAY_ADM_SQL)
def join_stay_admission(spark, d):
    return R.join_stay_admission(tm.icustays(spark, d), tm.admissions(spark, d))


STAY_TABLE_SQL = f"""
SELECT sa.*, p.GENDER, p.DOB, p.EXPIRE_FLAG
FROM ({STAY_ADM_SQL}) sa LEFT JOIN r_patients p ON sa.SUBJECT_ID = p.SUBJECT_ID"""


@query("join_patient", dbl="LOS", sql=STAY_TABLE_SQL)
def join_patient(spark, d):
    sa = R.join_stay_admission(tm.icustays(spark, d), tm.admissions(spark, d))
    return R.join_patient(sa, tm.patients(spark, d))


@query("join_code_dictionary", sql="""
SELECT d.HADM_ID, d.SEQ_NUM, d.ICD9_CODE, k.LONG_TITLE
FROM r_diagnoses_icd d LEFT JOIN r_d_icd_diagnoses k ON d.ICD9_CODE = k.ICD9_CODE""")
def join_code_dictionary(spark, d):
    return R.join_code_dictionary(tm.diagnoses_icd(spark, d), tm.d_icd_diagnoses(spark, d))


@query("join_fanout_diagnoses", sql="""
SELECT s.ICUSTAY_ID, s.HADM_ID, d.SEQ_NUM, d.ICD9_CODE
FROM r_icustays s LEFT JOIN r_diagnoses_icd d ON s.HADM_ID = d.HADM_ID""")
def join_fanout_diagnoses(spark, d):
    s = tm.icustays(spark, d).select("ICUSTAY_ID", "HADM_ID")
    return R.join_fanout_diagnoses(s, tm.diagnoses_icd(spark, d), ["HADM_ID"])


@query("join_item_dictionary", dbl="VALUENUM", sql="""
SELECT l.ITEMID, l.HADM_ID, l.CHARTTIME, l.VALUENUM, i.LABEL, i.DBSOURCE
FROM r_labevents l LEFT JOIN r_d_items i ON l.ITEMID = i.ITEMID""")
def join_item_dictionary(spark, d):
    return R.join_item_dictionary(tm.labevents(spark, d), tm.d_items(spark, d))


@query("join_inner_chain", dbl="LOS", sql="""
SELECT s.ICUSTAY_ID, s.SUBJECT_ID, s.HADM_ID, s.LOS, p.GENDER, a.ADMISSION_TYPE
FROM r_icustays s JOIN r_patients p ON s.SUBJECT_ID = p.SUBJECT_ID JOIN r_admissions a ON s.HADM_ID = a.HADM_ID""")
def join_inner_chain(spark, d):
    s = tm.icustays(spark, d).select("ICUSTAY_ID", "SUBJECT_ID", "HADM_ID", "LOS")
    return R.join_inner_chain(s, tm.patients(spark, d).select("SUBJECT_ID", "GENDER"),
                              tm.admissions(spark, d).select("HADM_ID", "ADMISSION_TYPE"))


@query("join_events_to_stay", dbl="VALUENUM", sql="""
SELECT c.ICUSTAY_ID, c.ITEMID, c.CHARTTIME, c.VALUENUM, s.INTIME
FROM r_chartevents c JOIN r_event_stays s ON c.ICUSTAY_ID = s.ICUSTAY_ID""")
def join_events_to_stay(spark, d):
    ev = tm.chartevents(spark, d).select("ICUSTAY_ID", "ITEMID", "CHARTTIME", "VALUENUM")
    return R.join_events_to_stay(ev, tm.event_stays(spark, d))


@query("join_interval", dbl="VALUENUM", sql=f"""
SELECT s.ICUSTAY_ID, l.ITEMID, l.CHARTTIME, l.VALUENUM
FROM r_icustays s JOIN r_labevents l ON l.HADM_ID = s.HADM_ID
WHERE l.CHARTTIME BETWEEN s.INTIME AND s.INTIME + to_hours({tm.TEST_LAB_WINDOW_HOURS})""")
def join_interval(spark, d):
    s = tm.icustays(spark, d).select("ICUSTAY_ID", "HADM_ID", "INTIME")
    j = R.interval_join(tm.labevents(spark, d), s, "HADM_ID", "CHARTTIME", "INTIME", tm.TEST_LAB_WINDOW_HOURS)
    return j.select("ICUSTAY_ID", "ITEMID", "CHARTTIME", "VALUENUM")


@query("join_semi_examples", dbl="LOS", sql="""
SELECT s.SUBJECT_ID, s.HADM_ID, s.ICUSTAY_ID, s.INTIME, s.OUTTIME, s.LOS FROM r_icustays s
WHERE s.SUBJECT_ID IN (SELECT SUBJECT_ID FROM r_icustays GROUP BY SUBJECT_ID HAVING count(ICUSTAY_ID) > 1
                       ORDER BY SUBJECT_ID LIMIT 3)""")
def join_semi_examples(spark, d):
    s = tm.icustays(spark, d)
    multi = A.group_count_having(s, "SUBJECT_ID", "ICUSTAY_ID", "icu_stays_count")
    return R.join_semi_examples(s, multi, 3, columns=["SUBJECT_ID", "HADM_ID", "ICUSTAY_ID", "INTIME", "OUTTIME",
                                                      "LOS"])


@query("join_feature_blocks", dbl="LOS avg_quantity", sql="""
SELECT s.ICUSTAY_ID, s.LOS, f.total_diagnoses, q.avg_quantity
FROM r_icustays s
LEFT JOIN (SELECT HADM_ID AS ICUSTAY_ID, count(ICD9_CODE) AS total_diagnoses FROM r_diagnoses_icd
           WHERE ICD9_CODE IS NOT NULL GROUP BY HADM_ID) f ON s.ICUSTAY_ID = f.ICUSTAY_ID
LEFT JOIN (SELECT ICUSTAY_ID, avg(VALUENUM) AS avg_quantity FROM r_order_events GROUP BY ICUSTAY_ID) q
  ON s.ICUSTAY_ID = q.ICUSTAY_ID""")
def join_feature_blocks(spark, d):
    s = tm.icustays(spark, d).select("ICUSTAY_ID", "LOS")
    f = (tm.diagnoses_icd(spark, d).filter(F.col("ICD9_CODE").isNotNull()).groupBy("HADM_ID")
         .agg(F.count("ICD9_CODE").alias("total_diagnoses")).withColumnRenamed("HADM_ID", "ICUSTAY_ID"))
    q = tm.order_events(spark, d).groupBy("ICUSTAY_ID").agg(F.avg("VALUENUM").alias("avg_quantity"))
    return R.join_feature_blocks(s, [f, q])


# ------------------------------------------------------------------ 2.5 aggregates


@query("count_rows", sql="SELECT count(*) AS row_count FROM lineitem")
def count_rows(spark, d):
    return A.count_rows(tm.read(spark, d, "lineitem"))


@query("count_distinct", sql="""
SELECT CAST(count(DISTINCT ICD9_CODE) + coalesce(max(CASE WHEN ICD9_CODE IS NULL THEN 1 ELSE 0 END), 0) AS BIGINT)
       AS distinct_ICD9_CODE
FROM r_diagnoses_icd""")
def count_distinct(spark, d):
    return A.count_distinct(tm.diagnoses_icd(spark, d), "ICD9_CODE")


@query("group_count_having", sql="""
SELECT SUBJECT_ID, count(ICUSTAY_ID) AS icu_stays_count FROM r_icustays GROUP BY SUBJECT_ID
HAVING count(ICUSTAY_ID) > 1""")
def group_count_having(spark, d):
    return A.group_count_having(tm.icustays(spark, d), "SUBJECT_ID", "ICUSTAY_ID", "icu_stays_count")


@query("count_histogram", sql="""
SELECT stays_count, count(SUBJECT_ID) AS patient_count
FROM (SELECT SUBJECT_ID, count(ICUSTAY_ID) AS stays_count FROM r_icustays GROUP BY SUBJECT_ID)
GROUP BY stays_count""")
def count_histogram(spark, d):
    return A.count_histogram(tm.icustays(spark, d), "SUBJECT_ID", "ICUSTAY_ID")


@query("group_count_topk", sql="""
SELECT ICD9_CODE, count(*) AS count FROM r_diagnoses_icd GROUP BY ICD9_CODE
ORDER BY count DESC, ICD9_CODE ASC NULLS FIRST LIMIT 200""")
def group_count_topk(spark, d):
    return A.group_count_topk(tm.diagnoses_icd(spark, d), "ICD9_CODE", 200)


@query("group_count_rare", sql="""
SELECT ICD9_CODE, count(*) AS count FROM r_diagnoses_icd GROUP BY ICD9_CODE HAVING count(*) <= 4000""")
def group_count_rare(spark, d):
    return A.group_count_rare(tm.diagnoses_icd(spark, d), "ICD9_CODE", 4000)


@query("source_distribution", sql="""
SELECT i.DBSOURCE, count(*) AS count
FROM r_labevents l JOIN r_d_items i ON l.ITEMID = i.ITEMID WHERE l.HADM_ID IS NOT NULL GROUP BY i.DBSOURCE""")
def source_distribution(spark, d):
    return A.source_distribution(tm.labevents(spark, d), tm.d_items(spark, d), stay_col="HADM_ID")


def _flag_sql(code: str = "ICD9_CODE", compat: bool = False, strict: bool = False) -> list[str]:
    """Oracle form of the chapter rule: the first three characters as a number within the
    chapter's range, or the chapter's letter (``strict``: a digit after it)."""
    number = f"TRY_CAST(CASE WHEN regexp_matches({code}, '^[0-9][0-9][0-9]') THEN substr({code}, 1, 3) END AS INTEGER)"
    out = {}
    for name, low, high, _label in CHAPTERS:
        top = HEMATOLOGIC_COMPAT_HIGH if compat and name == "has_hematologic" else high
        out[name] = f"CASE WHEN {number} BETWEEN {low} AND {top} THEN 1 ELSE 0 END"
    for name, letter, _label in LETTER_CHAPTERS:
        digit = f" AND TRY_CAST(substr({code}, 2, 1) AS INTEGER) IS NOT NULL" if strict else ""
        out[name] = f"CASE WHEN starts_with({code}, '{letter}'){digit} THEN 1 ELSE 0 END"
    return [out[f] for f in FLAG_COLUMNS]


ADM_FLAGS_SQL = ("SELECT HADM_ID, " + ", ".join(f"max({e}) AS {f}" for e, f in zip(_flag_sql(), FLAG_COLUMNS))
                 + ", count(ICD9_CODE) AS total_diagnoses FROM r_diagnoses_icd WHERE ICD9_CODE IS NOT NULL"
                 " GROUP BY HADM_ID")


@query("flag_max", sql=ADM_FLAGS_SQL)
def flag_max(spark, d):
    return D.admission_chapter_flags(tm.diagnoses_icd(spark, d), keys=["HADM_ID"])


def _keyword_case_sql(title: str, keywords) -> str:
    parts = []
    for cls, pats in keywords:
        cond = " OR ".join(f"lower({title}) LIKE '{p}'" for p in pats)
        parts.append(f"WHEN {cond} THEN '{cls}'")
    return "CASE " + " ".join(parts) + " ELSE 'other' END"


KEYWORD_CAT_SQL = f"""
SELECT d.HADM_ID, k.SHORT_TITLE, {_keyword_case_sql('k.SHORT_TITLE', tm.TEST_KEYWORDS)} AS CATEGORY
FROM r_diagnoses_icd d JOIN r_d_icd_diagnoses k ON d.ICD9_CODE = k.ICD9_CODE"""


@query("conditional_agg", sql=f"""
SELECT HADM_ID, {', '.join(f"max(CASE WHEN CATEGORY = '{c}' THEN 1 ELSE 0 END) AS HAS_{c.upper()}"
                           for c, _ in tm.TEST_KEYWORDS)},
       count(DISTINCT CATEGORY) AS DISEASE_COUNT
FROM ({KEYWORD_CAT_SQL}) GROUP BY HADM_ID""")
def conditional_agg(spark, d):
    cat = D.diagnosis_keyword_category(tm.diagnoses_icd(spark, d), tm.d_icd_diagnoses(spark, d),
                                       keywords=tm.TEST_KEYWORDS, keep=("HADM_ID",))
    return A.conditional_agg(cat, "HADM_ID", "CATEGORY", [c for c, _ in tm.TEST_KEYWORDS])


@query("stats_per_group", dbl="avg min max std", sql="""
SELECT ICUSTAY_ID, avg(VALUENUM) AS avg, min(VALUENUM) AS min, max(VALUENUM) AS max,
       stddev_samp(VALUENUM) AS std, count(VALUENUM) AS count
FROM r_chartevents GROUP BY ICUSTAY_ID""")
def stats_per_group(spark, d):
    return A.stats_per_group(tm.chartevents(spark, d), "ICUSTAY_ID", "VALUENUM")


@query("median_approx", dbl="median", sql="""
SELECT ICUSTAY_ID, quantile_disc(VALUENUM, 0.5) AS median FROM r_chartevents GROUP BY ICUSTAY_ID""")
def median_approx(spark, d):
    return A.median_approx(tm.chartevents(spark, d), "ICUSTAY_ID", "VALUENUM")


@query("first_last_offset", dbl="first_measurement_hour last_measurement_hour", sql=f"""
SELECT c.ICUSTAY_ID, min({WIN_SQL}) AS first_measurement_hour, max({WIN_SQL}) AS last_measurement_hour
FROM r_chartevents c JOIN r_event_stays s ON c.ICUSTAY_ID = s.ICUSTAY_ID
WHERE {WIN_SQL} BETWEEN 0 AND 24 GROUP BY c.ICUSTAY_ID""")
def first_last_offset(spark, d):
    j = R.join_events_to_stay(tm.chartevents(spark, d), tm.event_stays(spark, d))
    w = R.filter_time_window(j, "CHARTTIME", "INTIME", 24)
    return A.first_last_offset(w, "ICUSTAY_ID", "hours_from_intime")


@query("range_and_cv", dbl="v_avg v_min v_max v_std v_range v_coefficient_of_variation", sql="""
SELECT ICUSTAY_ID, avg(VALUENUM) AS v_avg, min(VALUENUM) AS v_min, max(VALUENUM) AS v_max,
       stddev_samp(VALUENUM) AS v_std, count(VALUENUM) AS v_count,
       max(VALUENUM) - min(VALUENUM) AS v_range,
       CASE WHEN avg(VALUENUM) = 0 THEN NULL ELSE stddev_samp(VALUENUM) / avg(VALUENUM) END
           AS v_coefficient_of_variation
FROM r_chartevents GROUP BY ICUSTAY_ID""")
def range_and_cv(spark, d):
    return A.range_and_cv(A.stats_per_group(tm.chartevents(spark, d), "ICUSTAY_ID", "VALUENUM", "v_"), "v")


@query("sum_columns", dbl="percentage", sql=f"""
WITH f AS ({ADM_FLAGS_SQL}), s AS (
  SELECT count(*) AS n, {', '.join(f'CAST(coalesce(sum({c}), 0) AS BIGINT) AS {c}' for c in FLAG_COLUMNS)} FROM f)
SELECT "column", count, count * 100.0 / n AS percentage
FROM (UNPIVOT s ON {', '.join(FLAG_COLUMNS)} INTO NAME "column" VALUE count)""")
def sum_columns(spark, d):
    flags = D.admission_chapter_flags(tm.diagnoses_icd(spark, d), keys=["HADM_ID"])
    return A.sum_columns(flags, FLAG_COLUMNS)


@query("null_counts", sql="""
WITH t AS (SELECT s.SUBJECT_ID, s.HADM_ID, s.ICUSTAY_ID, s.INTIME, s.OUTTIME, a.ADMITTIME, a.DISCHTIME
           FROM r_icustays s LEFT JOIN r_admissions a ON s.SUBJECT_ID = a.SUBJECT_ID AND s.HADM_ID = a.HADM_ID
           LEFT JOIN r_patients p ON s.SUBJECT_ID = p.SUBJECT_ID)
SELECT "column", null_count FROM (UNPIVOT (
  SELECT CAST(count_if(SUBJECT_ID IS NULL) AS BIGINT) AS SUBJECT_ID, CAST(count_if(HADM_ID IS NULL) AS BIGINT) AS HADM_ID,
         CAST(count_if(ICUSTAY_ID IS NULL) AS BIGINT) AS ICUSTAY_ID, CAST(count_if(INTIME IS NULL) AS BIGINT) AS INTIME,
         CAST(count_if(OUTTIME IS NULL) AS BIGINT) AS OUTTIME, CAST(count_if(ADMITTIME IS NULL) AS BIGINT) AS ADMITTIME,
         CAST(count_if(DISCHTIME IS NULL) AS BIGINT) AS DISCHTIME FROM t)
  ON COLUMNS(*) INTO NAME "column" VALUE null_count)""")
def null_counts(spark, d):
    t = stay_table(tm.icustays(spark, d), tm.admissions(spark, d), tm.patients(spark, d))
    return A.null_counts(t, ["SUBJECT_ID", "HADM_ID", "ICUSTAY_ID", "INTIME", "OUTTIME", "ADMITTIME", "DISCHTIME"])


@query("describe_column", dbl="mean stddev min max", sql="""
SELECT count(LOS) AS count, avg(LOS) AS mean, stddev_samp(LOS) AS stddev, min(LOS) AS min, max(LOS) AS max
FROM r_icustays""")
def describe_column(spark, d):
    return A.describe_column(tm.icustays(spark, d), "LOS")


@query("exact_quantiles", dbl="q25 q50 q75", sql="""
SELECT quantile_cont(LOS, 0.25) AS q25, quantile_cont(LOS, 0.5) AS q50, quantile_cont(LOS, 0.75) AS q75
FROM r_icustays""")
def exact_quantiles(spark, d):
    return A.exact_quantiles(tm.icustays(spark, d), "LOS")


@query("mode_value", sql="""
SELECT ICD9_CODE AS mode FROM r_diagnoses_icd WHERE ICD9_CODE IS NOT NULL GROUP BY ICD9_CODE
ORDER BY count(*) DESC, ICD9_CODE LIMIT 1""")
def mode_value(spark, d):
    return A.mode_value(tm.diagnoses_icd(spark, d), "ICD9_CODE")


@query("value_share", dbl="percentage", sql="""
SELECT ADMISSION_TYPE, count(*) AS count, count(*) * 100.0 / (SELECT count(*) FROM r_admissions) AS percentage
FROM r_admissions WHERE ADMISSION_TYPE IS NOT NULL GROUP BY ADMISSION_TYPE""")
def value_share(spark, d):
    return A.value_share(tm.admissions(spark, d), "ADMISSION_TYPE")


@query("hourly_counts", sql="""
SELECT CAST(hour(ts) AS BIGINT) AS hour, count(*) AS count FROM events WHERE ts IS NOT NULL GROUP BY 1""")
def hourly_counts(spark, d):
    return A.hourly_counts(tm.read(spark, d, "events"), "ts")


@query("histogram_bins", dbl="bin_start bin_end", sql="""
WITH v AS (SELECT LOS FROM r_icustays WHERE LOS IS NOT NULL AND LOS > 0 AND LOS < 30),
b AS (SELECT CAST(min(LOS) AS DOUBLE) AS lo, CAST(max(LOS) AS DOUBLE) AS hi FROM v),
w AS (SELECT lo, (hi - lo) / 50 AS width FROM b)
SELECT bin, lo + bin * width AS bin_start, lo + (bin + 1) * width AS bin_end, count(*) AS count
FROM (SELECT CAST(least(floor((LOS - lo) / width), 49) AS INTEGER) AS bin, lo, width FROM v, w)
GROUP BY bin, lo, width""")
def histogram_bins(spark, d):
    return A.histogram_bins(tm.icustays(spark, d), "LOS", 50, low=0, high=30)


@query("boxplot_stats", dbl="min q1 median q3 max", sql="""
SELECT a.ADMISSION_TYPE, count(s.LOS) AS n, min(s.LOS) AS min, quantile_cont(s.LOS, 0.25) AS q1,
       quantile_cont(s.LOS, 0.5) AS median, quantile_cont(s.LOS, 0.75) AS q3, max(s.LOS) AS max
FROM r_icustays s JOIN r_admissions a ON s.HADM_ID = a.HADM_ID
WHERE s.LOS > 0 AND s.LOS < 30 AND a.ADMISSION_TYPE IS NOT NULL
GROUP BY a.ADMISSION_TYPE HAVING count(s.LOS) > 10""")
def boxplot_stats(spark, d):
    s = tm.icustays(spark, d).select("HADM_ID", "LOS").join(
        tm.admissions(spark, d).select("HADM_ID", "ADMISSION_TYPE"), "HADM_ID")
    return A.boxplot_stats(s.filter((F.col("LOS") > 0) & (F.col("LOS") < 30)), "ADMISSION_TYPE", "LOS", 10)


@query("rate_percent", dbl="rate_pct", sql="""
SELECT avg(CAST(HOSPITAL_EXPIRE_FLAG AS DOUBLE)) * 100 AS rate_pct FROM r_admissions""")
def rate_percent(spark, d):
    return A.rate_percent(tm.admissions(spark, d), "HOSPITAL_EXPIRE_FLAG")


@query("count_where", dbl="percentage", sql="""
SELECT CAST(count_if(LOS > 30) AS BIGINT) AS matching, count(*) AS total, count_if(LOS > 30) * 100.0 / count(*) AS percentage
FROM r_icustays""")
def count_where(spark, d):
    return A.count_where(tm.icustays(spark, d), F.col("LOS") > 30)


# ------------------------------------------------------------------ 2.7 ordering, limits, sets


@query("sort_multi", dbl="LOS", sql="SELECT ICUSTAY_ID, FIRST_CAREUNIT, LOS FROM r_icustays")
def sort_multi(spark, d):
    s = tm.icustays(spark, d).select("ICUSTAY_ID", "FIRST_CAREUNIT", "LOS")
    return O.sort_multi(s, ["FIRST_CAREUNIT", "LOS"], [False, True], tiebreak=["ICUSTAY_ID"])


@query("limit_n", dbl="LOS", sql="""
SELECT ICUSTAY_ID, LOS FROM r_icustays ORDER BY LOS DESC, ICUSTAY_ID LIMIT 1000""")
def limit_n(spark, d):
    s = tm.icustays(spark, d).select("ICUSTAY_ID", "LOS")
    return O.limit_n(s, 1000, [F.col("LOS").desc(), F.col("ICUSTAY_ID")])


@query("distinct_rows", sql="SELECT DISTINCT SUBJECT_ID, FIRST_CAREUNIT FROM r_icustays")
def distinct_rows(spark, d):
    return O.distinct_rows(tm.icustays(spark, d), ["SUBJECT_ID", "FIRST_CAREUNIT"])


_SAMPLE_ROWS = 50_000


@query("sample_fraction", sql=f"""
WITH n AS (SELECT count(*)::HUGEINT AS total FROM lineitem)
SELECT l_orderkey, l_linenumber FROM lineitem, n
WHERE ('0x' || substr(md5('42|' || l_orderkey::VARCHAR || '|' || l_linenumber::VARCHAR), 1, 15))::BIGINT
      < CASE WHEN total <= {_SAMPLE_ROWS} THEN {1 << 60}::HUGEINT ELSE {_SAMPLE_ROWS << 60}::HUGEINT // total END""")
def sample_fraction(spark, d):
    """Bernoulli sample by a hash of the line's key, fraction min(1, 50,000 / n), seed 42."""
    out = O.sample_fraction(tm.read(spark, d, "lineitem"), _SAMPLE_ROWS, 42, key=["l_orderkey", "l_linenumber"])
    return out.select("l_orderkey", "l_linenumber")


@query("union_results", dbl="percentage", sql="""
SELECT 'FIRST_CAREUNIT' AS variable, FIRST_CAREUNIT AS value, count(*) AS count,
       count(*) * 100.0 / (SELECT count(*) FROM r_icustays) AS percentage
FROM r_icustays GROUP BY FIRST_CAREUNIT
UNION ALL
SELECT 'DBSOURCE', DBSOURCE, count(*), count(*) * 100.0 / (SELECT count(*) FROM r_icustays)
FROM r_icustays GROUP BY DBSOURCE""")
def union_results(spark, d):
    s = tm.icustays(spark, d)
    parts = [A.value_share(s, c).select(F.lit(c).alias("variable"), F.col(c).alias("value"), "count",
                                         "percentage") for c in ("FIRST_CAREUNIT", "DBSOURCE")]
    return O.union_results(parts)


# ------------------------------------------------------------------ 2.8 scalar functions


@query("scalar_functions", dbl="age_years price_k price_ln los_floor hours_since_start", sql="""
SELECT o_orderkey,
       lower(o_orderpriority) AS priority_lower,
       CASE WHEN lower(o_orderpriority) LIKE '%urgent%' THEN 1 ELSE 0 END AS is_urgent,
       CASE WHEN regexp_matches(o_orderpriority, '^[12]-') THEN 1 ELSE 0 END AS high_prefix,
       starts_with(o_orderpriority, '5') AS starts_5,
       replace(o_orderpriority, '-', ' ') AS priority_spaced,
       array_to_string(list_transform(string_split(lower(o_orderpriority), ' '),
                       lambda w: upper(w[1:1]) || w[2:]), ' ') AS priority_title,
       CAST(datediff('day', DATE '1990-01-01', CAST(o_orderdate AS DATE)) AS BIGINT) AS days_since_1990,
       CAST(hour(o_orderdate + to_hours(CAST(o_custkey % 24 AS BIGINT))) AS BIGINT) AS shifted_hour,
       CAST(datediff('day', CAST(c.DOB AS DATE), CAST(o_orderdate AS DATE)) AS DOUBLE) / 365.25 AS age_years,
       round(o_totalprice / 1000, 1) AS price_k,
       ln(o_totalprice + 1) AS price_ln,
       greatest(o_totalprice / 15000 - 10, 0) AS los_floor,
       (epoch(o_orderdate) - epoch(TIMESTAMP '1995-01-01 00:00:00')) / 3600.0 AS hours_since_start,
       CAST(o_custkey AS DOUBLE) > 1000 AS big_customer,
       coalesce(CASE WHEN o_orderstatus = 'F' THEN 'MARRIED' END, 'UNKNOWN') AS status_fill,
       try_strptime(CASE WHEN o_orderstatus = 'P' THEN 'not a time' ELSE strftime(o_orderdate, '%Y-%m-%d %H:%M:%S')
                    END, '%Y-%m-%d %H:%M:%S') AS parsed_time
FROM orders o JOIN r_patients c ON o.o_custkey = c.SUBJECT_ID""")
def scalar_functions(spark, d):
    o = tm.read(spark, d, "orders")
    p = tm.patients(spark, d).select(F.col("SUBJECT_ID").alias("o_custkey"), "DOB")
    o = o.join(p, "o_custkey", "inner")
    pr = F.col("o_orderpriority")
    text = F.when(F.col("o_orderstatus") == "P", F.lit("not a time")).otherwise(
        F.date_format("o_orderdate", "yyyy-MM-dd HH:mm:ss"))
    return o.select(
        "o_orderkey",
        F.lower(pr).alias("priority_lower"),
        F.when(F.lower(pr).like("%urgent%"), 1).otherwise(0).alias("is_urgent"),
        F.when(pr.rlike("^[12]-"), 1).otherwise(0).alias("high_prefix"),
        pr.startswith("5").alias("starts_5"),
        F.replace(pr, F.lit("-"), F.lit(" ")).alias("priority_spaced"),
        F.initcap(pr).alias("priority_title"),
        F.datediff(F.col("o_orderdate").cast("date"), F.lit("1990-01-01").cast("date")).cast("long").alias(
            "days_since_1990"),
        F.hour(plus_hours(F.col("o_orderdate"), (F.col("o_custkey") % 24))).cast("long").alias("shifted_hour"),
        (F.datediff(F.col("o_orderdate").cast("date"), F.col("DOB").cast("date")).cast("double") / 365.25).alias(
            "age_years"),
        F.round(F.col("o_totalprice") / 1000, 1).alias("price_k"),
        F.ln(F.col("o_totalprice") + 1).alias("price_ln"),
        F.greatest(F.col("o_totalprice") / 15000 - 10, F.lit(0)).alias("los_floor"),
        hours_between(F.col("o_orderdate"), F.lit("1995-01-01 00:00:00").cast("timestamp_ntz")).alias(
            "hours_since_start"),
        (F.col("o_custkey").cast("double") > 1000).alias("big_customer"),
        F.coalesce(F.when(F.col("o_orderstatus") == "F", "MARRIED"), F.lit("UNKNOWN")).alias("status_fill"),
        F.try_to_timestamp(text, F.lit("yyyy-MM-dd HH:mm:ss")).cast("timestamp_ntz").alias("parsed_time"),
    )
