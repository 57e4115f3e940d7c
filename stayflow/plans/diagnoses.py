"""Diagnosis features: ICD-9 chapter flags, category frequencies, keyword classes.

Plan choices (versus the reference's stay x diagnosis fan-out followed by a
full-row ``distinct``):

* Flags and the diagnosis count are aggregated **per admission** first
  (algebraic max / count, so a hot admission is combined map-side), then joined
  to the stays.  Every stay of an admission sees all its diagnoses, exactly as the
  fan-out join does, but the fan-out rows are never materialised and no full-row
  shuffle for ``distinct`` is needed.
* The chapter rule is a numeric range check on the code prefix (no regex per
  chapter).
* Keyword classes are aggregated per admission the same way; the number of
  distinct classes is the sum of the per-class flags (no distinct aggregate).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from stayflow.functions.codes import FLAG_COLUMNS, RANGE_LABELS, chapter_flag_columns, code_prefix_number
from stayflow.functions.keywords import DIAGNOSIS_KEYWORDS, OTHER, flag_name, keyword_class
from stayflow.operators.aggregates import sum_columns

DIAG_KEYS = ("SUBJECT_ID", "HADM_ID")


def admission_chapter_flags(diagnoses: DataFrame, keys: Sequence[str] = DIAG_KEYS, code_col: str = "ICD9_CODE",
                            compat: bool = False, strict_letters: bool = False) -> DataFrame:
    """Per admission: max of the 19 chapter flags over its non-null codes and their count."""
    code = F.col(code_col)
    # the numeric prefix is computed once per row, the 19 range checks read it
    rows = (diagnoses.filter(code.isNotNull()).select(*keys, code_col, code_prefix_number(code).alias("_code3"))
            .select(*keys, code_col, *chapter_flag_columns(code, compat, strict_letters, F.col("_code3"))))
    return rows.groupBy(*keys).agg(*[F.max(c).alias(c) for c in FLAG_COLUMNS],
                                   F.count(code_col).alias("total_diagnoses"))


def icd9_chapter_flags(stays: DataFrame, diagnoses: DataFrame, keys: Sequence[str] = DIAG_KEYS,
                       code_col: str = "ICD9_CODE", compat: bool = False, strict_letters: bool = False,
                       drop: Sequence[str] = ("ICD9_CODE", "LONG_TITLE", "SEQ_NUM")) -> DataFrame:
    """Stays + 19 chapter flags + ``total_diagnoses``; 0 for stays without codes.

    ``strict_letters=True`` is the first version (``E``/``V`` followed by a digit);
    ``compat=True`` reproduces the reference's 290-299 overlap of hematologic.
    """
    per_adm = admission_chapter_flags(diagnoses, keys, code_col, compat, strict_letters)
    base = stays.drop(*[c for c in drop if c in stays.columns])
    return base.join(per_adm, list(keys), "left").fillna(0, subset=FLAG_COLUMNS + ["total_diagnoses"])


def category_label(flag_col):
    """'has_symptoms_signs' -> 'Symptoms Signs'."""
    return F.initcap(F.regexp_replace(F.regexp_replace(flag_col, "^has_", ""), "_", " "))


def icd9_category_frequency(flags: DataFrame, columns: Sequence[str] = FLAG_COLUMNS) -> DataFrame:
    """(flag, category, count, pct_of_stays, rank) over the 19 flags, plus the mean and
    median count over categories.  One aggregate over the stays; the ranking runs
    on the 19-row result (bounded by the number of chapters)."""
    sums = sum_columns(flags, columns, name_col="flag", sum_col="count", pct_col="pct_of_stays")
    whole = Window.partitionBy()  # 19 rows by construction
    return sums.select(
        "flag", category_label(F.col("flag")).alias("category"), "count", "pct_of_stays",
        F.row_number().over(Window.orderBy(F.col("count").desc(), F.col("flag"))).alias("rank"),
        F.avg("count").over(whole).alias("mean_count"),
        F.percentile(F.col("count"), 0.5).over(whole).alias("median_count"),
    )


def icd9_summary_table(flags: DataFrame, columns: Sequence[str] = FLAG_COLUMNS) -> DataFrame:
    """Category, ICD-9 code range, count and percentage (1 dp), most frequent first."""
    sums = sum_columns(flags, columns, name_col="flag", sum_col="count", pct_col="percentage")
    label = None
    for name in columns:
        cond = F.col("flag") == name
        label = F.when(cond, F.lit(RANGE_LABELS.get(name, "Unknown"))) if label is None else \
            label.when(cond, F.lit(RANGE_LABELS.get(name, "Unknown")))
    return (sums.select(category_label(F.col("flag")).alias("category"), label.otherwise("Unknown").alias("code_range"),
                        "count", F.round("percentage", 1).alias("percentage"))
            .orderBy(F.col("count").desc(), F.col("category")))


def diagnosis_keyword_category(diagnoses: DataFrame, dictionary: DataFrame, code_col: str = "ICD9_CODE",
                               title_col: str = "SHORT_TITLE", keywords=DIAGNOSIS_KEYWORDS,
                               keep: Sequence[str] = ("SUBJECT_ID", "HADM_ID")) -> DataFrame:
    """Diagnoses joined (inner) to the dictionary with the first-match keyword class."""
    keep = [k for k in keep if k in diagnoses.columns]
    return diagnoses.join(dictionary.select(code_col, title_col), code_col, "inner").select(
        *keep, title_col, keyword_class(F.col(title_col), keywords).alias("CATEGORY"))


def diagnosis_keyword_features(base: DataFrame, diagnoses: DataFrame, dictionary: DataFrame,
                               key: str = "HADM_ID", keywords=DIAGNOSIS_KEYWORDS, code_col: str = "ICD9_CODE",
                               title_col: str = "SHORT_TITLE") -> DataFrame:
    """Base rows + one ``HAS_<CLASS>`` flag per keyword class + ``DISEASE_COUNT``
    (distinct classes, 'other' included); NULL for rows without any diagnosis."""
    classes = [c for c, _ in keywords]
    cat = diagnosis_keyword_category(diagnoses, dictionary, code_col, title_col, keywords, keep=(key,))
    per_adm = cat.groupBy(key).agg(
        *[F.max(F.when(F.col("CATEGORY") == c, 1).otherwise(0)).alias(flag_name(c)) for c in classes],
        F.max(F.when(F.col("CATEGORY") == OTHER, 1).otherwise(0)).alias("_has_other"))
    total = sum((F.col(flag_name(c)) for c in classes), F.col("_has_other"))
    per_adm = per_adm.select(key, *[flag_name(c) for c in classes], total.cast("long").alias("DISEASE_COUNT"))
    return base.join(per_adm, key, "left")
