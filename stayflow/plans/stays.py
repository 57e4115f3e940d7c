"""Stay-level operators: multi-stay statistics, joined-table profile, base features."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stayflow.functions.timefn import years_by_days
from stayflow.operators.quantiles import exact_percentiles
from stayflow.operators.relational import clip_floor

# The key and time columns whose nulls the profile counts.
KEY_COLUMNS = ("SUBJECT_ID", "HADM_ID", "ICUSTAY_ID", "INTIME", "OUTTIME", "ADMITTIME", "DISCHTIME")
# What stay_admission_profile reads.
PROFILE_COLUMNS = (*KEY_COLUMNS, "DOB", "HOSPITAL_EXPIRE_FLAG", "ADMISSION_TYPE")


def multi_stay_stats(stays: DataFrame, patient_col: str = "SUBJECT_ID", admission_col: str = "HADM_ID",
                     stay_col: str = "ICUSTAY_ID") -> DataFrame:
    """(metric, value): total stays, distinct patients / admissions, patients with more
    than one stay, admissions with more than one stay.

    Two two-level aggregates (per entity, then over entities); both are algebraic,
    so a patient with a third of all stays is combined map-side.
    """
    per_patient = stays.groupBy(patient_col).agg(F.count(stay_col).alias("n"), F.count(F.lit(1)).alias("rows"))
    p = per_patient.agg(
        F.sum("rows").cast("long").alias("total_stays"),
        F.count(F.lit(1)).cast("long").alias("unique_patients"),
        F.count_if(F.col("n") > 1).cast("long").alias("patients_with_multiple_stays"))
    per_adm = stays.groupBy(admission_col).agg(F.count(stay_col).alias("n"))
    a = per_adm.agg(F.count(F.lit(1)).cast("long").alias("unique_admissions"),
                    F.count_if(F.col("n") > 1).cast("long").alias("admissions_with_multiple_icu_stays"))
    p_long = p.selectExpr("stack(3, 'total_stays', total_stays, 'unique_patients', unique_patients, "
                          "'patients_with_multiple_stays', patients_with_multiple_stays) AS (metric, value)")
    a_long = a.selectExpr("stack(2, 'unique_admissions', unique_admissions, "
                          "'admissions_with_multiple_icu_stays', admissions_with_multiple_icu_stays) "
                          "AS (metric, value)")
    return p_long.unionByName(a_long)


def stay_admission_profile(joined: DataFrame, key_columns: Sequence[str] = KEY_COLUMNS,
                           flag_col: str = "HOSPITAL_EXPIRE_FLAG", max_age: float = 120.0) -> DataFrame:
    """Profile of the stays x admissions x patients table as (metric, value) rows, from
    one aggregate over the full table (the reference profiled a 50,000-row sample):
    row count, null count per key column, ICU and hospital LOS (days) summary,
    median age (< ``max_age``), mortality rate (%); mean ICU LOS by admission type and by
    mortality, and the shares of the three most frequent admission types."""
    secs = lambda a, b: (F.unix_timestamp(a) - F.unix_timestamp(b)).cast("double")
    cols = set(joined.columns)
    aggs = [F.count(F.lit(1)).cast("double").alias("total_records")]
    medians = {}  # metric -> column expression; exact, distributed (no single-task value map)
    for c in key_columns:
        if c in cols:
            aggs.append(F.count_if(F.col(c).isNull()).cast("double").alias(f"null_{c}"))
    if {"INTIME", "OUTTIME"} <= cols:
        icu = secs(F.col("OUTTIME"), F.col("INTIME")) / 86400
        aggs += [F.avg(icu).alias("icu_los_days_mean"), F.stddev_samp(icu).alias("icu_los_days_std"),
                 F.min(icu).alias("icu_los_days_min"), F.max(icu).alias("icu_los_days_max")]
        medians["icu_los_days_median"] = icu
    if {"ADMITTIME", "DISCHTIME"} <= cols:
        hosp = secs(F.col("DISCHTIME"), F.col("ADMITTIME")) / 86400
        aggs.append(F.avg(hosp).alias("hospital_los_days_mean"))
        medians["hospital_los_days_median"] = hosp
    if {"ADMITTIME", "DOB"} <= cols:
        # pandas ``(a - b).dt.days / 365.25``: whole days, floored
        age = F.floor(secs(F.col("ADMITTIME"), F.col("DOB")) / 86400) / 365.25
        medians["age_median"] = F.when(age < max_age, age)
    if flag_col in cols:
        aggs.append((F.avg(F.col(flag_col).cast("double")) * 100).alias("mortality_rate_pct"))
    one = joined.agg(*aggs)
    if medians:
        derived = joined.select(*[e.alias(m) for m, e in medians.items()])
        q = exact_percentiles(derived, [(m, 0.5) for m in medians])
        one = one.select("*", *[F.lit(q[(m, 0.5)]).cast("double").alias(m) for m in medians])
    names = one.columns
    expr = ", ".join(f"'{n}', CAST(`{n}` AS DOUBLE)" for n in names)
    out = one.selectExpr(f"stack({len(names)}, {expr}) AS (metric, value)")
    if "ADMISSION_TYPE" in cols:
        kind, total = F.col("ADMISSION_TYPE"), joined.select(F.count(F.lit(1))).scalar()
        per_type = joined.filter(kind.isNotNull()).groupBy(kind).agg(F.count(F.lit(1)).alias("n"))
        top = per_type.orderBy(F.desc("n"), kind).limit(3)
        out = out.unionByName(top.select(F.concat(F.lit("top type share_pct "), kind).alias("metric"), (F.col("n") * 100.0 / total).alias("value")))
    if {"INTIME", "OUTTIME"} <= cols:
        for c, label in (("ADMISSION_TYPE", "type"), (flag_col, "died")):
            if c in cols:
                out = out.unionByName(joined.filter(F.col(c).isNotNull()).groupBy(c).agg(F.avg(icu).alias("value")).select(
                    F.concat(F.lit(f"icu_los_days_mean {label} "), F.col(c).cast("string")).alias("metric"), "value"))
    return out


def base_stay_features(stays: DataFrame, patients: DataFrame, admissions: DataFrame, window_hours: float = 24,
                       emergency_pattern: str = "%emerg%") -> DataFrame:
    """One row per stay with LOS > 0 (inner joins to patient and admission):
    AGE (datediff / 365.25), TOTAL_LOS, REMAINING_LOS = max(LOS - w/24, 0),
    ADMISSION_HOUR, IS_EMERGENCY, SAME_UNIT_STAY."""
    i = stays.filter(F.col("LOS").isNotNull() & (F.col("LOS") > 0)).select(
        "ICUSTAY_ID", "SUBJECT_ID", "HADM_ID", "FIRST_CAREUNIT", "LAST_CAREUNIT", "LOS")
    p = patients.select("SUBJECT_ID", "GENDER", "DOB")
    a = admissions.select("HADM_ID", "ADMITTIME", "ADMISSION_TYPE", "HOSPITAL_EXPIRE_FLAG")
    j = i.join(p, "SUBJECT_ID", "inner").join(a, "HADM_ID", "inner")
    return j.select(
        "ICUSTAY_ID", "SUBJECT_ID", "HADM_ID", "GENDER",
        years_by_days(F.col("ADMITTIME"), F.col("DOB")).alias("AGE"),
        "ADMISSION_TYPE", "FIRST_CAREUNIT",
        F.col("LOS").alias("TOTAL_LOS"),
        clip_floor(F.col("LOS") - F.lit(window_hours / 24.0), 0.0).alias("REMAINING_LOS"),
        "HOSPITAL_EXPIRE_FLAG",
        F.hour("ADMITTIME").alias("ADMISSION_HOUR"),
        F.when(F.lower("ADMISSION_TYPE").like(emergency_pattern), 1).otherwise(0).alias("IS_EMERGENCY"),
        F.when(F.col("FIRST_CAREUNIT") == F.col("LAST_CAREUNIT"), 1).otherwise(0).alias("SAME_UNIT_STAY"),
    )
