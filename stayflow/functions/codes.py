"""ICD-9 chapter rules.

A diagnosis code carries no dot.  Numeric chapters are decided by the first three
characters read as a number (so ``"0389"`` -> 38 -> infectious); ``E`` and ``V``
codes by their first letter.  The rule is evaluated with plain column functions
(substring, translate, cast, between), so it stays inside whole-stage codegen and
needs neither a regex per chapter nor a Python UDF.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Chapter flags, their three-digit code ranges (inclusive) and the
# range labels reported with them, in the reference's order.
CHAPTERS: list[tuple[str, int, int, str]] = [
    ("has_infectious", 1, 139, "001-139"),
    ("has_malignancy", 140, 239, "140-239"),
    ("has_endocrine", 240, 279, "240-279"),
    ("has_hematologic", 280, 289, "280-289"),
    ("has_psychiatric", 290, 319, "290-319"),
    ("has_neurological", 320, 389, "320-389"),
    ("has_cardiovascular", 390, 459, "390-459"),
    ("has_respiratory", 460, 519, "460-519"),
    ("has_gastrointestinal", 520, 579, "520-579"),
    ("has_genitourinary", 580, 629, "580-629"),
    ("has_obstetric", 630, 679, "630-679"),
    ("has_skin", 680, 709, "680-709"),
    ("has_musculoskeletal", 710, 739, "710-739"),
    ("has_congenital", 740, 759, "740-759"),
    ("has_perinatal", 760, 779, "760-779"),
    ("has_symptoms_signs", 780, 799, "780-799"),
    ("has_trauma", 800, 999, "800-999"),
]
# Letter chapters and their labels.
LETTER_CHAPTERS: list[tuple[str, str, str]] = [
    ("has_external_causes", "E", "E codes"),
    ("has_supplemental", "V", "V codes"),
]
# The reference's code pattern for hematologic also accepts 290-299 (overlapping
# psychiatric) although its label says 280-289; ``compat=True`` reproduces that.
HEMATOLOGIC_COMPAT_HIGH = 299

FLAG_COLUMNS: list[str] = [c[0] for c in CHAPTERS] + [c[0] for c in LETTER_CHAPTERS]
RANGE_LABELS: dict[str, str] = {c[0]: c[3] for c in CHAPTERS} | {c[0]: c[2] for c in LETTER_CHAPTERS}


def code_prefix_number(code: Column) -> Column:
    """First three characters as an int when all three are digits, else NULL."""
    head = F.substring(code, 1, 3)
    all_digits = (F.length(head) == 3) & (F.length(F.translate(head, "0123456789", "")) == 0)
    return F.when(all_digits, head.cast("int"))


def chapter_flag_columns(code: Column, compat: bool = False, strict_letters: bool = False,
                         prefix_number: Column | None = None) -> list[Column]:
    """One 0/1 column per chapter for a code column (NULL code -> all 0).  Pass the
    already computed ``code_prefix_number`` column to avoid recomputing it per flag."""
    num = code_prefix_number(code) if prefix_number is None else prefix_number
    cols = []
    for name, lo, hi, _ in CHAPTERS:
        if compat and name == "has_hematologic":
            hi = HEMATOLOGIC_COMPAT_HIGH
        cols.append(F.when(num.between(lo, hi), 1).otherwise(0).alias(name))
    for name, letter, _ in LETTER_CHAPTERS:
        if strict_letters:
            # v1 form: the letter must be followed by a digit
            second = F.substring(code, 2, 1)
            hit = code.startswith(letter) & (F.length(F.translate(second, "0123456789", "")) == 0) & (F.length(second) == 1)
        else:
            hit = code.startswith(letter)
        cols.append(F.when(hit, 1).otherwise(0).alias(name))
    return cols
