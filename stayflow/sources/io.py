"""Scans and sinks (survey section 2.1).

CSV is read with a declared schema (never inferred by default) and written with
a header; Parquet is the columnar copy.  Event tables can be laid out by value
ranges (``partitionBy`` on a derived bucket column) and read back with the bucket
predicate derived from the item filter, so partition pruning applies.
"""

from __future__ import annotations

import os
import uuid
from collections.abc import Iterator, Mapping, Sequence
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from stayflow.session import ensure_checkpoint_dir
from stayflow.sources.schemas import schema_of, table_spec


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh folder under the shared ``spark.checkpoint.dir`` (never machine-local
    on a cluster: the setting is the cluster's shared folder)."""
    base = ensure_checkpoint_dir(spark)
    if not base:
        raise RuntimeError("spark.checkpoint.dir is not set; scratch output needs a shared folder")
    return f"{base.rstrip('/')}/stayflow-scratch/{name}-{uuid.uuid4().hex[:12]}"


# ------------------------------------------------------------------ scans

def load_csv_table(spark: SparkSession, csv_dir: str, table_name: str, schema: StructType | None = None,
                   drop_row_id: bool = True, check_header: bool = True) -> DataFrame:
    """``{csv_dir}/{NAME}.csv`` with header and the declared schema; ``ROW_ID`` dropped.

    ``check_header`` makes Spark compare the file header with the schema
    (``enforceSchema=False``) so a column-order mismatch fails instead of silently
    shifting columns.
    """
    path = os.path.join(csv_dir, f"{table_name.upper()}.csv")
    schema = schema or schema_of(table_name)
    df = (spark.read.schema(schema).option("header", True)
          .option("enforceSchema", not check_header).option("mode", "FAILFAST")
          .option("timestampFormat", "yyyy-MM-dd HH:mm:ss[.SSSSSS]").csv(path))
    if drop_row_id and "ROW_ID" in df.columns:
        df = df.drop("ROW_ID")
    return df


def load_csv_sampled_infer(spark: SparkSession, path: str, sampling_ratio: float = 0.1, mode: str = "PERMISSIVE") -> DataFrame:
    """Schema inference on a sample of the file (kept as an option; the default is declared).
    With ``mode`` FAILFAST a value outside the sample that does not fit fails the read instead
    of turning NULL."""
    return spark.read.csv(path, header=True, inferSchema=True, samplingRatio=sampling_ratio, mode=mode)


def typed_event_scan(spark: SparkSession, path: str, base_schema: StructType,
                     overrides: Mapping[str, str] | None = None, fmt: str = "csv",
                     timestamp_format: str = "yyyy-MM-dd HH:mm:ss[.SSSSSS]") -> DataFrame:
    """Read with per-column type overrides on top of a declared schema; a malformed cell fails
    the read instead of turning NULL."""
    overrides = {k.upper(): v for k, v in (overrides or {}).items()}
    fields = []
    for f in base_schema.fields:
        t = overrides.get(f.name.upper())
        fields.append(f"`{f.name}` {t if t else f.dataType.simpleString()}")
    schema = StructType.fromDDL(", ".join(fields))
    reader = spark.read.schema(schema).option("mode", "FAILFAST").option("timestampFormat", timestamp_format)
    return reader.option("header", True).csv(path) if fmt == "csv" else reader.format(fmt).load(path)


def sql_view_scan(spark: SparkSession, views: Mapping[str, DataFrame], sql: str) -> DataFrame:
    """Register DataFrames as temp views and run SQL over them."""
    for name, df in views.items():
        df.createOrReplaceTempView(name)
    return spark.sql(sql)


def load_manifest(tables: Mapping[str, DataFrame], total: str | None = "TOTAL") -> DataFrame:
    """(table, rows) for each table from one count per table, combined in one result,
    plus a ``total`` row from the same counts (the seconds per table are timing, kept out of the result)."""
    out = None
    for name, df in tables.items():
        row = df.agg(F.count(F.lit(1)).alias("rows")).select(F.lit(name).alias("table"), "rows")
        out = row if out is None else out.unionByName(row)
    if total:
        out = out.rollup("table").agg(F.sum("rows").alias("rows")).select(
            F.coalesce("table", F.lit(total)).alias("table"), "rows")
    return out


#: Settings under which a count over Parquet files is answered from their footers.
FOOTER_CONF = {"spark.sql.sources.useV1SourceList": "avro,csv,json,kafka,orc,text", "spark.sql.parquet.aggregatePushdown": "true"}


@contextmanager
def footer_settings(spark: SparkSession) -> Iterator[None]:
    """Parquet is read by the source that pushes aggregates down; earlier settings come back."""
    before = {k: spark.conf.get(k, None) for k in FOOTER_CONF}
    try:
        for k, v in FOOTER_CONF.items():
            spark.conf.set(k, v)
        yield
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def footer_manifest(spark: SparkSession, paths: Mapping[str, str], total: str | None = "TOTAL") -> DataFrame:
    """:func:`load_manifest` of Parquet files, from the row counts in their footers: no row is read."""
    with footer_settings(spark):
        rows = load_manifest({name: spark.read.parquet(path) for name, path in paths.items()}, total).collect()  # a row for each table
    return spark.createDataFrame(rows, "table string, rows long")


# ------------------------------------------------------------------ sinks

def save_features(df: DataFrame, output_path: str, sample_rows: int | None = 1000,
                  order: Sequence[str] = ("ICUSTAY_ID",), fmt: str = "csv", sample_to: str | None = None) -> dict[str, str]:
    """Write the full table (CSV with header, overwrite) and its first ``sample_rows`` rows to
    ``sample_to`` (ordered by key so the sample is stable)."""
    writer = df.write.mode("overwrite")
    if fmt == "csv":
        writer.option("header", True).csv(output_path)
    else:
        writer.format(fmt).save(output_path)
    paths = {"full": output_path}
    if sample_rows:
        sample_path = sample_to or f"{output_path.rstrip('/')}.first_rows"
        keys = [k for k in order if k in df.columns]
        # from the written output, so the input is computed once
        back = read_csv_back(df.sparkSession, output_path, df.schema) if fmt == "csv" else df.sparkSession.read.format(fmt).load(output_path)
        sample = (back.orderBy(*keys) if keys else back).limit(sample_rows)
        sample.write.mode("overwrite").option("header", True).csv(sample_path)
        paths["sample"] = sample_path
    return paths


def csv_sink(df: DataFrame, path: str) -> str:
    df.write.mode("overwrite").option("header", True).csv(path)
    return path


def parquet_sink(df: DataFrame, path: str, partition_by: Sequence[str] = ()) -> str:
    w = df.write.mode("overwrite")
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)
    return path


def read_csv_back(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    return spark.read.schema(schema).option("header", True).option("mode", "FAILFAST").csv(path)


# ------------------------------------------------------------------ range layout

# Item-id ranges of the chart-event layout ([lo, hi)) and year ranges of
# the lab layout (inclusive), as declared in the reference's partitioned tables.
CHART_ITEM_RANGES: list[tuple[str, int, int]] = [
    ("vitals", 0, 1000), ("labs", 1000, 50000), ("metavision", 50000, 1000000)]
LAB_YEAR_RANGES: list[tuple[str, int, int]] = [
    ("y2001_2005", 2001, 2005), ("y2006_2010", 2006, 2010), ("y2011_2015", 2011, 2015)]
OTHER_BUCKET = "other"


def range_bucket(col, ranges: Sequence[tuple[str, int, int]], closed_high: bool = False):
    """Bucket label of a value: ``lo <= v < hi`` (or ``<= hi``); outside -> 'other'."""
    expr = None
    for name, lo, hi in ranges:
        cond = (col >= lo) & ((col <= hi) if closed_high else (col < hi))
        expr = F.when(cond, F.lit(name)) if expr is None else expr.when(cond, F.lit(name))
    return expr.otherwise(F.lit(OTHER_BUCKET))


def write_range_layout(df: DataFrame, path: str, bucket_expr, bucket_col: str = "bucket") -> str:
    """Write ``df`` partitioned by a derived bucket column (one folder per range)."""
    df.withColumn(bucket_col, bucket_expr).write.mode("overwrite").partitionBy(bucket_col).parquet(path)
    return path


def buckets_for_values(values: Sequence[int], ranges: Sequence[tuple[str, int, int]],
                       closed_high: bool = False) -> list[str]:
    """Buckets that can hold any of ``values`` (the predicate added for pruning)."""
    out = set()
    for v in values:
        hit = [n for n, lo, hi in ranges if lo <= v and (v <= hi if closed_high else v < hi)]
        out.update(hit or [OTHER_BUCKET])
    return sorted(out)


def read_range_layout(spark: SparkSession, path: str, bucket_col: str = "bucket",
                      buckets: Sequence[str] | None = None) -> DataFrame:
    """Read the layout; with ``buckets`` only those partitions are scanned."""
    df = spark.read.parquet(path)
    if buckets is not None:
        df = df.filter(F.col(bucket_col).isin(list(buckets)))
    return df


# ------------------------------------------------------------------ co-located layout

def bucketed_layout(df: DataFrame, key: str, buckets: int, path: str) -> DataFrame:
    """``df`` written to ``path`` in ``buckets`` files by a hash of ``key``, each sorted by it, and read back as a table.

    Tables of one key and number of buckets are joined and grouped by the key without an
    exchange.  Rows are dealt by the same hash first, so every bucket is one file.
    """
    spark, name = df.sparkSession, f"bucketed_{uuid.uuid4().hex}"
    (df.repartition(buckets, key).write.bucketBy(buckets, key).sortBy(key).option("path", path).format("parquet").saveAsTable(name))
    return spark.table(name)
