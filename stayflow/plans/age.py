"""Age at admission and the features derived from it."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stayflow.functions.timefn import years_by_months

# Ages above the threshold are privacy-shifted and capped.
CAP_THRESHOLD = 150.0
CAP_VALUE = 90.0
# Validated age groups (upper bounds exclusive, in order).
VALIDATED_GROUPS = [(18, "Pediatric"), (65, "Adult"), (80, "Elderly")]
VALIDATED_TOP = "Very Elderly"
UNKNOWN = "Unknown"


def _raw(admit_col: str, dob_col: str):
    return years_by_months(F.col(admit_col), F.col(dob_col))


def age_at_admission(df: DataFrame, admit_col: str = "ADMITTIME", dob_col: str = "DOB",
                     cap_threshold: float = CAP_THRESHOLD, cap_value: float = CAP_VALUE,
                     out: str = "age_at_admission") -> DataFrame:
    """``months_between / 12``; above the threshold -> ``cap_value``; else rounded to 1 dp."""
    raw = _raw(admit_col, dob_col)
    return df.withColumn(out, F.when(raw > cap_threshold, F.lit(cap_value)).otherwise(F.round(raw, 1)))


def age_validated(df: DataFrame, admit_col: str = "ADMITTIME", dob_col: str = "DOB",
                  cap_threshold: float = CAP_THRESHOLD, cap_value: float = CAP_VALUE,
                  out: str = "age_at_admission") -> DataFrame:
    """As :func:`age_at_admission`, negative ages -> NULL, plus ``age_group`` and ``is_elderly``."""
    raw = _raw(admit_col, dob_col)
    age = (F.when(raw > cap_threshold, F.lit(cap_value)).when(raw < 0, F.lit(None).cast("double"))
           .otherwise(F.round(raw, 1)))
    df = df.withColumn(out, age)
    a = F.col(out)
    group = None
    for bound, label in VALIDATED_GROUPS:
        group = F.when(a < bound, label) if group is None else group.when(a < bound, label)
    group = group.when(a >= VALIDATED_GROUPS[-1][0], VALIDATED_TOP).otherwise(UNKNOWN)
    return df.withColumn("age_group", group).withColumn("is_elderly", F.when(a >= 65, 1).otherwise(0))


def age_distribution(df: DataFrame, age_col: str = "age_at_admission", cap_value: float = CAP_VALUE) -> DataFrame:
    """(metric, value): describe of the age, rows per age group and per elderly flag,
    and the number / share of capped ages -- one aggregate, unpivoted."""
    a = F.col(age_col)
    aggs = [F.count(a).cast("double").alias("count"), F.avg(a).alias("mean"), F.stddev_samp(a).alias("stddev"),
            F.min(a).cast("double").alias("min"), F.max(a).cast("double").alias("max")]
    groups = [label for _, label in VALIDATED_GROUPS] + [VALIDATED_TOP, UNKNOWN]
    aggs += [F.count_if(F.col("age_group") == g).cast("double").alias(f"group_{g}") for g in groups]
    aggs += [F.count_if(F.col("is_elderly") == v).cast("double").alias(f"is_elderly_{v}") for v in (0, 1)]
    aggs += [F.count_if(a == cap_value).cast("double").alias("capped_count"),
             (F.count_if(a == cap_value) * 100.0 / F.count(F.lit(1))).alias("capped_pct")]
    one = df.agg(*aggs)
    expr = ", ".join(f"'{n}', CAST(`{n}` AS DOUBLE)" for n in one.columns)
    return one.selectExpr(f"stack({len(one.columns)}, {expr}) AS (metric, value)")


def age_features(df: DataFrame, age_col: str = "age_at_admission") -> DataFrame:
    """age squared, decade (round(age/10)*10), very young < 30, middle-aged [30, 65), geriatric >= 80."""
    a = F.col(age_col)
    return df.select(
        "*",
        (a * a).alias("age_squared"),
        (F.round(a / 10, 0) * 10).alias("age_decades"),
        F.when(a < 30, 1).otherwise(0).alias("is_very_young"),
        F.when((a >= 30) & (a < 65), 1).otherwise(0).alias("is_middle_aged"),
        F.when(a >= 80, 1).otherwise(0).alias("is_geriatric"),
    )
