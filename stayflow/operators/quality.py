"""Constraint checks: the reference's DDL constraints re-aimed as data-quality queries."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stayflow.operators.relational import dealt


def pk_violations(df: DataFrame, key: Sequence[str] | str, alias: str = "count") -> DataFrame:
    """Key values that occur more than once or have a NULL part.

    Rows are dealt by key before they are counted, so that no task holds more keys as the table grows.
    """
    key = [key] if isinstance(key, str) else list(key)
    null_part = None
    for k in key:
        c = F.col(k).isNull()
        null_part = c if null_part is None else null_part | c
    return dealt(df.select(*key), key, df.count()).groupBy(*key).agg(F.count(F.lit(1)).alias(alias)).filter((F.col(alias) > 1) | null_part)


def fk_orphans(child: DataFrame, parent: DataFrame, child_cols: Sequence[str] | str,
               parent_cols: Sequence[str] | str | None = None) -> DataFrame:
    """Child rows with a non-null key that has no parent (``left_anti``)."""
    child_cols = [child_cols] if isinstance(child_cols, str) else list(child_cols)
    parent_cols = child_cols if parent_cols is None else (
        [parent_cols] if isinstance(parent_cols, str) else list(parent_cols))
    nonnull = child
    for c in child_cols:
        nonnull = nonnull.filter(F.col(c).isNotNull())
    p = parent.select(*[F.col(pc).alias(cc) for pc, cc in zip(parent_cols, child_cols)])
    return nonnull.join(p, child_cols, "left_anti")


def not_null_violations(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(column, null_count) for every declared NOT NULL column, from one aggregate."""
    cols = [c for c in columns if c in df.columns]
    one = df.agg(*[F.count_if(F.col(f"`{c}`").isNull()).alias(f"n__{i}") for i, c in enumerate(cols)])
    parts = ", ".join(f"'{c}', `n__{i}`" for i, c in enumerate(cols))
    return one.selectExpr(f"stack({len(cols)}, {parts}) AS (column, null_count)")


def join_row_audit(stages: Mapping[str, DataFrame]) -> DataFrame:
    """Row count of each stage (e.g. before / after each N:1 join) as (stage, rows, order).

    Each count is a one-row aggregate; they are combined with ``unionByName`` so
    the audit is one result, not one driver round trip per stage.
    """
    out = None
    for i, (name, df) in enumerate(stages.items()):
        row = df.agg(F.count(F.lit(1)).alias("rows")).select(
            F.lit(i).alias("step"), F.lit(name).alias("stage"), "rows")
        out = row if out is None else out.unionByName(row)
    return out
