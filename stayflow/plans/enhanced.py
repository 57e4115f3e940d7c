"""Enhanced features (the reference's second feature set), as column expressions.

Each function adds columns with one ``select``; only the data-density flags need
global statistics, which are one-row aggregates read as scalars (no join).
pandas semantics are kept: comparisons with a missing value give 0, and sums over
flags treat missing flags as 0.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stayflow.operators.quantiles import exact_percentiles

# Enhanced age bins (right-closed) and labels.
AGE_BINS = [0, 18, 35, 50, 65, 80, 120]
AGE_LABELS = ["pediatric", "young_adult", "adult", "middle_aged", "elderly", "very_elderly"]
# High-risk flags, risk weights, organ systems.
HIGH_RISK = ["has_cardiovascular", "has_respiratory", "has_neurological", "has_malignancy"]
RISK_WEIGHTS = {"has_malignancy": 3, "has_cardiovascular": 2, "has_respiratory": 2, "has_neurological": 2,
                "has_trauma": 1.5, "has_infectious": 1, "has_gastrointestinal": 1, "has_genitourinary": 1}
ORGAN_SYSTEMS = {"cardiovascular": ["has_cardiovascular"], "respiratory": ["has_respiratory"],
                 "neurological": ["has_neurological", "has_psychiatric"]}
# Vital-sign thresholds on the average (flag name, predicate kind, thresholds).
VITAL_FLAGS = {
    "heart_rate": [("abnormal", "outside", (60, 100)), ("very_abnormal", "outside", (50, 120)),
                   ("tachycardia", "above", 100), ("bradycardia", "below", 60),
                   ("severe_tachy", "above", 120), ("severe_brady", "below", 50)],
    "respiratory_rate": [("abnormal", "outside", (12, 20)), ("very_abnormal", "outside", (10, 25)),
                         ("tachypnea", "above", 20), ("bradypnea", "below", 12)],
    "spo2": [("abnormal", "below", 95), ("very_abnormal", "below", 90), ("hypoxic", "below", 92),
             ("severe_hypoxic", "below", 88)],
}
VITALS = list(VITAL_FLAGS)
CV_EPS = 1e-8
MARITAL = {"is_married": "MARRIED", "is_single": "SINGLE"}


def _flag(cond: Column) -> Column:
    """pandas ``cond.astype(int)``: a comparison with a missing value is False -> 0."""
    return F.when(cond, 1).otherwise(0)


def _zero(c: str) -> Column:
    return F.coalesce(F.col(c), F.lit(0))


def enh_age(df: DataFrame, age_col: str = "age_at_admission") -> DataFrame:
    a = F.col(age_col)
    group = None
    for lo, hi, label in zip(AGE_BINS[:-1], AGE_BINS[1:], AGE_LABELS):
        cond = (a > lo) & (a <= hi)
        group = F.when(cond, label) if group is None else group.when(cond, label)
    return df.select("*", group.alias("age_group"), _flag(a >= 65).alias("is_elderly"),
                     _flag(a < 18).alias("is_pediatric"), (a * a).alias("age_squared"),
                     F.ln(a + 1).alias("age_log"))


def _has_cols(df: DataFrame) -> list[str]:
    return [c for c in df.columns if c.startswith("has_")]


def enh_diagnosis_load(df: DataFrame) -> DataFrame:
    flags = _has_cols(df)
    total = sum((_zero(c) for c in flags), F.lit(0)) if flags else F.lit(0)
    risk = [c for c in HIGH_RISK if c in df.columns]
    cols = [total.alias("diagnosis_count_calculated"),
            _flag(total > 1).alias("has_multiple_diagnoses"), _flag(total >= 3).alias("has_complex_case")]
    if risk:
        cols += [F.greatest(*[_zero(c) for c in risk]).alias("has_high_risk_condition") if len(risk) > 1
                 else _zero(risk[0]).alias("has_high_risk_condition"),
                 sum((_zero(c) for c in risk), F.lit(0)).alias("high_risk_count")]
    return df.select("*", *cols)


def enh_risk_score(df: DataFrame) -> DataFrame:
    score = F.lit(0.0)
    for c, w in RISK_WEIGHTS.items():
        if c in df.columns:
            score = score + F.col(c) * F.lit(float(w))
    return df.select("*", score.alias("diagnosis_risk_score"))


def enh_organ_system(df: DataFrame) -> DataFrame:
    cols = []
    for system, flags in ORGAN_SYSTEMS.items():
        present = [c for c in flags if c in df.columns]
        if present:
            e = F.greatest(*[F.col(c) for c in present]) if len(present) > 1 else F.col(present[0])
            cols.append(e.alias(f"has_{system}_system"))
    return df.select("*", *cols)


def enh_vital_ranges(df: DataFrame, vitals: Sequence[str] = VITALS) -> DataFrame:
    cols = []
    for p in vitals:
        if all(f"{p}_{s}" in df.columns for s in ("avg", "min", "max")):
            cols.append((F.col(f"{p}_max") - F.col(f"{p}_min")).alias(f"{p}_range"))
            if f"{p}_std" in df.columns:
                cols.append((F.col(f"{p}_std") / (F.col(f"{p}_avg") + F.lit(CV_EPS))).alias(f"{p}_cv"))
    return df.select("*", *cols)


def enh_vital_flags(df: DataFrame, vitals: Sequence[str] = VITALS) -> DataFrame:
    cols = []
    for p in vitals:
        if f"{p}_avg" not in df.columns:
            continue
        a = F.col(f"{p}_avg")
        for name, kind, t in VITAL_FLAGS[p]:
            cond = (a < t[0]) | (a > t[1]) if kind == "outside" else (a > t if kind == "above" else a < t)
            cols.append(_flag(cond).alias(f"{p}_{name}"))
    return df.select("*", *cols)


def enh_data_density(df: DataFrame, vitals: Sequence[str] = VITALS) -> DataFrame:
    """``{v}_data_rich``: count > global median of the count; ``{v}_sparse_data``:
    count < global first quartile (pandas linear-interpolated quantiles)."""
    present = [p for p in vitals if f"{p}_count" in df.columns]
    if not present:
        return df
    stats = exact_percentiles(df, [(f"{p}_count", q) for p in present for q in (0.5, 0.25)])
    cols = []
    for p in present:
        c = F.col(f"{p}_count")
        med, q1 = stats[(f"{p}_count", 0.5)], stats[(f"{p}_count", 0.25)]
        cols.append(_flag(c > F.lit(med)).alias(f"{p}_data_rich") if med is not None else F.lit(0).alias(f"{p}_data_rich"))
        cols.append(_flag(c < F.lit(q1)).alias(f"{p}_sparse_data") if q1 is not None else F.lit(0).alias(f"{p}_sparse_data"))
    return df.select("*", *cols)


def enh_interactions(df: DataFrame, age_col: str = "age_at_admission") -> DataFrame:
    cols = []
    a = F.col(age_col) if age_col in df.columns else None
    if a is not None:
        if "diagnosis_count_calculated" in df.columns:
            cols.append((a * F.col("diagnosis_count_calculated")).alias("age_diagnosis_interaction"))
        if "diagnosis_risk_score" in df.columns:
            cols.append((a * F.col("diagnosis_risk_score")).alias("age_risk_interaction"))
        if "has_high_risk_condition" in df.columns and "is_elderly" in df.columns:
            cols.append((F.col("is_elderly") * F.col("has_high_risk_condition")).alias("elderly_high_risk"))
    mort = "EXPIRE_FLAG" if "EXPIRE_FLAG" in df.columns else (
        "HOSPITAL_EXPIRE_FLAG" if "HOSPITAL_EXPIRE_FLAG" in df.columns else None)
    if mort:
        if a is not None:
            cols.append((a * F.col(mort)).alias("age_mortality_risk"))
        if "diagnosis_risk_score" in df.columns:
            cols.append((F.col("diagnosis_risk_score") * F.col(mort)).alias("diagnosis_mortality_risk"))
    return df.select("*", *cols)


def enh_instability(df: DataFrame) -> DataFrame:
    ab = [c for c in df.columns if c.endswith("_abnormal") and not c.endswith("_very_abnormal")]
    very = [c for c in df.columns if c.endswith("_very_abnormal")]
    cols = []
    if ab:
        cols.append(sum((_zero(c) for c in ab), F.lit(0)).alias("vital_instability_score"))
    if very:
        cols.append(sum((_zero(c) for c in very), F.lit(0)).alias("severe_instability_score"))
    return df.select("*", *cols)


def enh_marital(df: DataFrame, col: str = "MARITAL_STATUS") -> DataFrame:
    if col not in df.columns:
        return df
    return df.select("*", *[_flag(F.col(col) == v).alias(n) for n, v in MARITAL.items()])


def create_enhanced_features(df: DataFrame, age_col: str = "age_at_admission", density: bool = True) -> DataFrame:
    """All enhanced features in the reference's order; ``density=False`` leaves out the
    data-density flags, the only ones that need statistics of the whole table."""
    out = df
    if age_col in out.columns:
        out = enh_age(out, age_col)
    if _has_cols(out):
        out = enh_organ_system(enh_risk_score(enh_diagnosis_load(out)))
    out = enh_vital_flags(enh_vital_ranges(out))
    if density:
        out = enh_data_density(out)
    out = enh_instability(enh_interactions(out, age_col))
    return enh_marital(out)
