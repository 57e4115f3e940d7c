"""Final assemblies: the notebook's feature table and the script's feature table."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame

from stayflow.functions.keywords import DIAGNOSIS_KEYWORDS
from stayflow.operators.relational import drop_columns, join_patient, join_stay_admission
from stayflow.plans.age import age_at_admission
from stayflow.plans.diagnoses import DIAG_KEYS, diagnosis_keyword_features, icd9_chapter_flags
from stayflow.plans.stays import base_stay_features
from stayflow.plans.vitals import CLINICAL_VITALS, CREATININE_ITEMS, HEART_RATE_ITEMS, heart_rate_window, \
    lab_window, vital_statistics

# Columns the notebook drops before modelling.  ADMISSION_TYPE,
# FIRST_CAREUNIT and INSURANCE are wanted by the model step afterwards (defect D7),
# so by default they are kept.
EXCLUDED_COLUMNS = ["HOSPITAL_EXPIRE_FLAG", "MARITAL_STATUS", "SUBJECT_ID", "HADM_ID", "DBSOURCE",
                    "FIRST_CAREUNIT", "LAST_CAREUNIT", "FIRST_WARDID", "LAST_WARDID", "INTIME", "OUTTIME",
                    "ADMITTIME", "DISCHTIME", "DEATHTIME", "ADMISSION_TYPE", "ADMISSION_LOCATION",
                    "DISCHARGE_LOCATION", "INSURANCE", "LANGUAGE", "RELIGION", "ETHNICITY", "EDREGTIME",
                    "EDOUTTIME", "HAS_CHARTEVENTS_DATA", "DOB", "DOD"]
KEPT_FOR_MODELS = ["ADMISSION_TYPE", "FIRST_CAREUNIT", "INSURANCE"]


def stay_table(stays: DataFrame, admissions: DataFrame, patients: DataFrame,
               stay_admission_keys: Sequence[str] = ("SUBJECT_ID", "HADM_ID")) -> DataFrame:
    """stays LEFT JOIN admissions LEFT JOIN patients (death-date duplicates dropped)."""
    return join_patient(join_stay_admission(stays, admissions, stay_admission_keys), patients)


def feature_table(stays: DataFrame, admissions: DataFrame, patients: DataFrame, diagnoses: DataFrame,
                  events: DataFrame, vitals: Mapping[str, Sequence] = CLINICAL_VITALS, window_hours: float = 24,
                  diagnosis_keys: Sequence[str] = DIAG_KEYS, stay_admission_keys=("SUBJECT_ID", "HADM_ID"),
                  keep_for_models: bool = True, age_cap_threshold: float = 150.0,
                  event_stays: DataFrame | None = None) -> DataFrame:
    """One row per stay: stay/admission/patient columns, 19 chapter flags and the
    diagnosis count, vital statistics of the first window, age at admission; the
    notebook's drop list applied (minus the model inputs when ``keep_for_models``)."""
    base = stay_table(stays, admissions, patients, stay_admission_keys)
    flags = icd9_chapter_flags(base, diagnoses, diagnosis_keys)
    known = event_stays if event_stays is not None else stays
    v = vital_statistics(events, known, vitals, window_hours)
    joined = flags.join(v, "ICUSTAY_ID", "left").fillna(0, subset=[f"{n}_count" for n in vitals])
    out = age_at_admission(joined, cap_threshold=age_cap_threshold)
    drop = [c for c in EXCLUDED_COLUMNS if not (keep_for_models and c in KEPT_FOR_MODELS)]
    return drop_columns(out, drop)


def script_feature_table(stays: DataFrame, patients: DataFrame, admissions: DataFrame, chart_events: DataFrame,
                         lab_events: DataFrame, diagnoses: DataFrame, dictionary: DataFrame,
                         window_hours: float = 24, heart_rate_items=HEART_RATE_ITEMS,
                         lab_items=CREATININE_ITEMS, keywords=DIAGNOSIS_KEYWORDS,
                         emergency_pattern: str = "%emerg%") -> DataFrame:
    """Base stay features + heart rate + creatinine in the first window + keyword classes."""
    base = base_stay_features(stays, patients, admissions, window_hours, emergency_pattern)
    out = heart_rate_window(base, chart_events, stays, window_hours, item_ids=heart_rate_items)
    out = lab_window(out, lab_events, stays, window_hours, item_ids=lab_items)
    return diagnosis_keyword_features(out, diagnoses, dictionary, keywords=keywords)
