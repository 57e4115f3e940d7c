"""Sources and sinks: declared-schema CSV, range layout with partition pruning."""

import datetime as dt

import pytest
from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from stayflow.catalog import sourcesq
from stayflow.operators import quality as Q
from stayflow.sources import io
from stayflow.sources.schemas import TABLES, table_spec


def test_registry_has_all_tables():
    assert len(TABLES) == 16
    assert table_spec("icustays").not_null_columns()[:4] == ["ROW_ID", "SUBJECT_ID", "HADM_ID", "ICUSTAY_ID"]


def test_declared_schema_keeps_leading_zero(spark, tmp_path):
    folder = tmp_path / "csv"
    folder.mkdir()
    (folder / "DIAGNOSES_ICD.csv").write_text(
        "ROW_ID,SUBJECT_ID,HADM_ID,SEQ_NUM,ICD9_CODE\n1,10,100,1,0389\n2,10,100,2,\n")
    df = io.load_csv_table(spark, str(folder), "diagnoses_icd")
    rows = df.orderBy("SEQ_NUM").collect()
    assert "ROW_ID" not in df.columns
    assert rows[0].ICD9_CODE == "0389" and rows[1].ICD9_CODE is None
    inferred = io.load_csv_sampled_infer(spark, str(folder / "DIAGNOSES_ICD.csv"), 1.0)
    assert inferred.orderBy("SEQ_NUM").first().ICD9_CODE == 389  # why inference is not the default


def test_range_layout_prunes(spark):
    df = spark.createDataFrame([(i, dt.datetime(2003, 1, 1)) for i in (5, 211, 1500, 60000, 2_000_000)],
                               "ITEMID int, CHARTTIME timestamp")
    path = io.scratch_path(spark, "layout_test")
    io.write_range_layout(df, path, io.range_bucket(F.col("ITEMID"), io.CHART_ITEM_RANGES))
    buckets = io.buckets_for_values([211, 618], io.CHART_ITEM_RANGES)
    assert buckets == ["vitals"]
    back = io.read_range_layout(spark, path, buckets=buckets)
    assert sorted(r.ITEMID for r in back.collect()) == [5, 211]
    plan = back._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters" in plan and "vitals" in plan
    everything = io.read_range_layout(spark, path).groupBy("bucket").count().collect()
    assert {r.bucket: r["count"] for r in everything} == {"vitals": 2, "labs": 1, "metavision": 1, "other": 1}


def test_quality_checks(spark):
    parent = spark.createDataFrame([(1,), (2,)], "HADM_ID int")
    child = spark.createDataFrame([(1, 1), (1, 1), (3, 1), (None, 2)], "HADM_ID int, SEQ_NUM int")
    assert [r.HADM_ID for r in Q.fk_orphans(child, parent, "HADM_ID").collect()] == [3]
    assert Q.pk_violations(child, ["HADM_ID", "SEQ_NUM"]).collect()[0]["count"] == 2
    nn = {r.column: r.null_count for r in Q.not_null_violations(child, ["HADM_ID", "SEQ_NUM"]).collect()}
    assert nn == {"HADM_ID": 1, "SEQ_NUM": 0}


def test_sampled_inference_reads_every_value(spark, monkeypatch):
    rows = spark.range(2000, numPartitions=1).select("id", F.when(F.col("id") == 1234, "x").otherwise(F.col("id").cast("string")).alias("v"))
    monkeypatch.setattr(sourcesq.tm, "read", lambda *_: rows.filter("id <> 1234"))
    assert [tuple(r) for r in sourcesq.csv_scan_sampled_infer(spark, "").collect()] == [("id", "int", 1999), ("v", "int", 1999)]
    assert sourcesq.csv_sampled_infer_rows(spark, "").agg(F.count("v"), F.sum("v")).first()[:] == (1999, sum(range(2000)) - 1234)
    monkeypatch.setattr(sourcesq.tm, "read", lambda *_: rows)
    with pytest.raises((PySparkException, Py4JJavaError)):
        sourcesq.csv_scan_sampled_infer(spark, "").collect()
