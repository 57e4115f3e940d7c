"""Registered queries: every operator of the survey run on the test-table roles.

Each entry is a callable ``(spark, sf_dir) -> DataFrame`` plus, where the result
is SQL-expressible, the equivalent DuckDB SQL over the raw test tables (role views
are added as CTEs).  Double columns are rounded to 6 places on both sides so the
comparison does not depend on summation order.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, FloatType, TimestampType

from stayflow.session import apply_runtime_conf
from stayflow.sources.testmap import with_roles

DIGITS = 6


@dataclass
class Entry:
    name: str
    fn: Callable[[SparkSession, str], DataFrame]
    sql: str | None
    dbl: tuple[str, ...]


REGISTRY: dict[str, Entry] = {}


def round_doubles(df: DataFrame, digits: int = DIGITS) -> DataFrame:
    cols = []
    for f in df.schema.fields:
        if isinstance(f.dataType, (DoubleType, FloatType)):
            cols.append(F.round(F.col(f"`{f.name}`").cast("double"), digits).alias(f.name))
        elif isinstance(f.dataType, TimestampType):
            # session-zone timestamps leave as wall-clock (naive) values, as DuckDB's TIMESTAMP
            cols.append(F.col(f"`{f.name}`").cast("timestamp_ntz").alias(f.name))
        else:
            cols.append(F.col(f"`{f.name}`"))
    return df.select(*cols)


def query(name: str, sql: str | None = None, dbl: str | tuple[str, ...] = ()):
    """Register ``fn(spark, sf_dir)`` under ``name`` with its oracle SQL."""
    dbl_cols = tuple(dbl.split()) if isinstance(dbl, str) else tuple(dbl)

    def deco(fn):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            apply_runtime_conf(spark)
            return round_doubles(fn(spark, sf_dir))

        run.__name__ = fn.__name__
        run.__doc__ = fn.__doc__
        REGISTRY[name] = Entry(name, run, sql, dbl_cols)
        return fn

    return deco


def rounded_sql(sql: str, dbl: tuple[str, ...], digits: int = DIGITS) -> str:
    body = with_roles(sql)
    if not dbl:
        return body
    repl = ", ".join(f"round(CAST(\"{c}\" AS DOUBLE), {digits}) AS \"{c}\"" for c in dbl)
    return f"SELECT * REPLACE ({repl}) FROM (\n{body}\n) AS q"


def load_all() -> dict[str, Entry]:
    # importing the modules fills REGISTRY
    from stayflow.catalog import (  # noqa: F401
        features,
        mlq,
        relationalq,
        sourcesq,
        treeq,
    )
    return REGISTRY
