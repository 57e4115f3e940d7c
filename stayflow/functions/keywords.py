"""Keyword classes of diagnosis titles (first match wins)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Classes in match order and their LIKE patterns on the lower-cased
# short title; anything else (and a NULL title) is 'other'.
DIAGNOSIS_KEYWORDS: list[tuple[str, list[str]]] = [
    ("cardiac", ["%cardiac%", "%heart%", "%myo%infarct%", "%coronary%"]),
    ("respiratory", ["%pneumonia%", "%respiratory%", "%copd%", "%lung%"]),
    ("renal", ["%renal%", "%kidney%"]),
    ("infectious", ["%sepsis%", "%septic%", "%infection%"]),
    ("diabetes", ["%diabetes%", "%diabetic%"]),
    ("stroke", ["%stroke%", "%cerebral%"]),
    ("trauma", ["%trauma%", "%fracture%", "%injury%"]),
]
OTHER = "other"


def keyword_class(title: Column, keywords: list[tuple[str, list[str]]] = DIAGNOSIS_KEYWORDS,
                  other: str = OTHER) -> Column:
    """Ordered CASE over LIKE patterns of ``lower(title)``."""
    low = F.lower(title)
    expr = None
    for cls, patterns in keywords:
        cond = None
        for p in patterns:
            c = low.like(p)
            cond = c if cond is None else (cond | c)
        expr = F.when(cond, F.lit(cls)) if expr is None else expr.when(cond, F.lit(cls))
    return expr.otherwise(F.lit(other))


def flag_name(cls: str) -> str:
    return f"HAS_{cls.upper()}"
