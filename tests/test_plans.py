"""Physical-plan checks: pushdown, pruning, no cross products, one pass for all vitals."""

import pytest

import __spark_entry__ as E
from stayflow.catalog import features, load_all
from stayflow.plans import diagnoses as D
from stayflow.plans import vitals as V
from stayflow.sources import io
from stayflow.sources import testmap as tm

SF = "/root/testdata/sf0.001"
# Fits of whole model sets take minutes to plan; their data come from the queries checked here.
MODEL_QUERIES = {n for n in load_all() if n.startswith("kfold_") or n.endswith(("_models", "_all"))} | {
    "random_forest", "gradient_boosting", "feature_importance", "compare_model_sets", "enhanced_feature_family",
    "regression_tree_nodes", "extra_tree_nodes", "tree_importance", "boosted_stumps", "rank_fitted_models", "compare_fitted_models"}
FILE_QUERIES = {"csv_scan", "csv_scan_sampled_infer", "typed_event_scan", "csv_sink", "sample_sink",
                "parquet_sink", "range_partitioned_layout", "load_manifest_footers", "vitals_first_window_colocated"}


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def _formatted(df) -> str:
    return df._sc._jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), "formatted")


def test_vitals_filters_reach_the_scan(spark):
    df = V.vitals_first_window(tm.chartevents(spark, SF), tm.event_stays(spark, SF), tm.TEST_VITALS)
    text = _formatted(df)
    assert "In(event_type, [click,purchase,view])" in text
    assert "IsNotNull(value)" in text
    # events are read for the windowed values and for INTIME; only needed columns are read
    assert "ReadSchema: struct<ts:timestamp_ntz,user_id:bigint,event_type:string,value:double>" in text
    # one aggregate for all vitals: no join per vital (two joins mark heavy stays)
    assert text.count("partial_stddev_samp") <= 2 * len(tm.TEST_VITALS)


def test_chapter_flags_aggregate_before_join_without_regex(spark):
    df = D.icd9_chapter_flags(tm.icustays(spark, SF), tm.diagnoses_icd(spark, SF), keys=["HADM_ID"])
    text = _formatted(df)
    assert "RLike" not in text
    assert "partial_max" in text  # map-side combine before the shuffle


@pytest.mark.parametrize("name", sorted(set(load_all()) - MODEL_QUERIES - FILE_QUERIES))
def test_no_cross_products(spark, name):
    plan = _plan(E.queries()[name](spark, SF))
    assert "CartesianProduct" not in plan
    assert "BroadcastNestedLoopJoin" not in plan


def _scans(df) -> int:
    return _plan(df).count("FileScan parquet")


def test_assemblies_do_not_repeat_their_inputs(spark):
    q = E.queries()
    script = _scans(q["script_feature_table"](spark, SF))
    assert script <= 14, script
    table = _scans(q["feature_table"](spark, SF))
    assert table <= 8, table
    assert _scans(q["load_manifest"](spark, SF)) == 14


def test_bucketed_tables_need_no_exchange(spark):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        events, stays = features._bucketed(spark, SF.replace("0.001", "0.01"))  # enough rows that no stay is heavy
        text = _plan(V.vitals_first_window(events, stays, tm.TEST_ORDER_VITALS))
        assert text.count("SortMergeJoin") == 2 and "HashAggregate" in text
        assert "Exchange" not in text
        plain = _plan(V.vitals_first_window(tm.order_events(spark, SF), tm.icustays(spark, SF), tm.TEST_ORDER_VITALS))
        assert "Exchange" in plain
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_counts_come_from_footers(spark):
    with io.footer_settings(spark):
        df = io.load_manifest({"lineitem": spark.read.parquet(f"{SF}/lineitem.parquet")}, None)
        assert "PushedAggregation: [COUNT(*)]" in _formatted(df)
    assert "parquet" in spark.conf.get("spark.sql.sources.useV1SourceList", "parquet")
