"""Plan shape: the properties the design relies on at scale."""

from __future__ import annotations

import re

from pyspark.sql import Row

from helpers import SF_SMALL
from runlens.plans import catalog
from runlens.plans.documents import document_features, normalize_documents
from runlens.sources.documents import read_sessions


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_flat_kernel_without_hot_sessions_is_one_shuffle(spark):
    """No session longer than a chunk: the plain plan, one exchange on the session."""
    df = catalog.queries()["session_features"](spark, SF_SMALL)
    plan = plan_of(df)
    assert "BroadcastExchange" not in plan and "Join" not in plan
    exchanges = re.findall(r"Exchange hashpartitioning\(([^)]*)\)", plan)
    assert len(exchanges) == 1 and exchanges[0].startswith("_key")


def test_chunked_plan_shuffles_by_session_and_chunk(spark):
    from runlens.sources.tables import LINEITEM_ORDER, lineitem_runs
    from runlens.operators.flat_kernel import flat_run_statistics
    df = flat_run_statistics(lineitem_runs(spark, SF_SMALL), "session_key", LINEITEM_ORDER, strategy="chunked", chunk_bits=8)
    plan = plan_of(df)
    assert "ShuffledHashJoin" in plan
    assert "BroadcastExchange" not in plan  # nothing whose size grows with the data is broadcast
    exchanges = re.findall(r"Exchange hashpartitioning\(([^)]*)\)", plan)
    # runs are moved by (key, chunk) only; by key alone only chunk rows
    assert sum("_chunk" in e or "_mc" in e for e in exchanges) >= 2


def test_order_free_metrics_are_one_aggregation(spark):
    for name in ("run_counts", "tool_metrics"):
        plan = plan_of(catalog.queries()[name](spark, SF_SMALL))
        assert "Window" not in plan and "Sort " not in plan and plan.count("Exchange hashpartitioning") == 1


def test_hot_sessions_take_the_chunked_plan(spark):
    from pyspark.sql import functions as F
    from runlens.operators.flat_kernel import flat_run_statistics
    runs = spark.range(0, 5000).select(
        F.when(F.col("id") < 3000, F.lit(0)).otherwise(F.col("id") % 500).alias("sid"), F.col("id").alias("pos"),
        (F.col("id") % 7).cast("double").alias("total_tokens"), F.lit(1.0).alias("output_tokens"),
        (F.col("id") % 3).cast("double").alias("execution_time"), F.lit(1).cast("long").alias("tool_calls_count"),
        F.lit(0).cast("long").alias("error_count"), (F.col("id") % 4 == 0).alias("success"),
        F.lit(False).alias("has_timeout"))
    df = flat_run_statistics(runs, "sid", "pos", chunk_bits=8)
    plan = plan_of(df)
    assert "Union" in plan and "ShuffledHashJoin" in plan and "BroadcastExchange" in plan
    assert df.filter("sid = 0").first()["n_runs"] == 3000 + 4  # ids 3000, 3500, 4000, 4500 also map to 0


def test_lineitem_scan_is_pruned(spark):
    df = catalog.queries()["session_features"](spark, SF_SMALL)
    scans = re.findall(r"FileScan parquet \[([^\]]*)\]", plan_of(df))
    assert len(scans) == 1  # plain plan: one pass over the runs (the hot-session count ran before)
    assert all("l_tax" not in s and "l_linestatus" not in s and "l_orderkey" in s for s in scans)


def test_nested_kernel_has_no_exchange(spark):
    df = catalog.queries()["document_features"](spark, SF_SMALL)
    assert "Exchange" not in plan_of(df)


def test_typed_session_source_pushes_date_filter(spark, tmp_path):
    path = str(tmp_path / "typed")
    rows = [Row(_id=f"d{i}", session_id=f"s{i}", created_at=1734652800 + i * 86400,
                agent_data=Row(name="a", model=Row(provider="p", id="m")),
                memory=Row(runs=[Row(status="RUNNING", metrics=Row(total_tokens=[10.0], time=[1.0]),
                                     tools=["t"], events=["RunCompleted"])]))
            for i in range(10)]
    spark.createDataFrame(rows).write.parquet(path)
    df = read_sessions(spark, path, "parquet", "2024-12-21", "2024-12-22")
    spark.conf.set("spark.sql.maxMetadataStringLength", "10000")
    plan = df._jdf.queryExecution().executedPlan().toString()
    spark.conf.unset("spark.sql.maxMetadataStringLength")
    assert "GreaterThanOrEqual(created_at,1734739200)" in plan
    assert "LessThanOrEqual(created_at,1734911999)" in plan
    feats = document_features(normalize_documents(df)).collect()
    assert sorted(r["doc_key"] for r in feats) == ["d1", "d2"]
    assert all(r["total_runs"] == 1 and r["success_rate"] == 1.0 for r in feats)


def test_landed_documents_prune_partitions(spark):
    spark.conf.set("spark.sql.maxMetadataStringLength", "10000")
    df = catalog.queries()["scan_sessions"](spark, SF_SMALL)
    plan = plan_of(df)
    spark.conf.unset("spark.sql.maxMetadataStringLength")
    assert re.search(r"PartitionFilters: \[[^\]]*date", plan)
    assert "GreaterThanOrEqual(created_at," in plan and "LessThanOrEqual(created_at," in plan


def test_order_export_cuts_runs_with_a_broadcast_key_set(spark):
    df = catalog.queries()["order_training_export"](spark, SF_SMALL)
    plan = plan_of(df)
    semi = [line for line in plan.splitlines() if "LeftSemi" in line]
    assert semi and all("BroadcastHashJoin" in line and "BuildRight" in line for line in semi)


def test_tune_session_keeps_user_settings(spark):
    from runlens.session import tune_session
    spark.conf.set("spark.sql.codegen.hugeMethodLimit", "12345")
    try:
        tune_session(spark)
        assert spark.conf.get("spark.sql.codegen.hugeMethodLimit") == "12345"
    finally:
        spark.conf.unset("spark.sql.codegen.hugeMethodLimit")
    tune_session(spark)
    assert spark.conf.get("spark.sql.codegen.hugeMethodLimit") == "8000"
