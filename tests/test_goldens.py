"""Hand-derived goldens for written-out sessions and edge documents
(FIXTURES.md section 4), read through the JSON/VARIANT reader."""

from __future__ import annotations

import json

import pytest

from helpers import approx
from runlens.config import ALL_METRICS
from runlens.plans.documents import document_features, normalize_documents, quarantined_documents, run_table
from runlens.sources.documents import pruned_schema, read_sessions

DAY = 1734652800  # 2024-12-20 00:00:00 UTC


def session(key: str, created_at: int, runs: list[dict], agent: str = "scout") -> dict:
    return {"_id": key, "session_id": f"chat-{key}", "created_at": created_at, "user_id": "u7",
            "agent_data": {"name": agent, "model": {"provider": "acme", "id": "m-1"}}, "memory": {"runs": runs}}


# Two sessions written out, with every metric worked out by hand (6 digits); metrics not listed are 0.
CLIMBING = [
    {"status": "RUNNING", "metrics": {"total_tokens": [120], "output_tokens": [30], "time": [2]},
     "tools": ["look"], "events": []},
    {"status": "FAILED", "metrics": {"total_tokens": 480, "output_tokens": [90], "time": 6},
     "tools": ["look", "ask", "ask", "move", "stop"], "events": ["error: no door"]},
]
CLIMBING_METRICS = {
    "avg_total_tokens": 300, "max_total_tokens": 480, "token_explosion_ratio": 1.6, "output_explosion_ratio": 1.5,
    "token_coefficient_variation": 0.6, "max_token_growth_rate": 4,
    "avg_execution_time": 4, "max_execution_time": 6, "execution_time_cv": 0.5, "time_explosion_events": 1,
    "avg_tool_calls": 3, "max_tool_calls": 5, "total_tool_calls": 6, "tool_explosion_ratio": 1.666667, "tool_chaos_score": 0.166667,
    "avg_tokens_per_second": 70, "min_tokens_per_second": 60, "max_tokens_per_second": 80, "speed_inconsistency_ratio": 1.333333,
    "success_rate": 0.5, "failure_rate": 0.5, "max_consecutive_failures": 1, "avg_errors_per_run": 0.5, "total_errors": 1,
}
JUMPY = [
    {"status": "FAILED", "metrics": {"total_tokens": [10], "output_tokens": [], "time": [1]}, "tools": [], "events": []},
    {"status": "DONE", "metrics": {"total_tokens": [90], "time": [0.0625]}, "events": [{"event": "RunCompleted"}]},
    {"status": "FAILED", "metrics": {"total_tokens": [20], "output_tokens": 0, "time": [4]}, "events": ["Gateway Timeout"]},
]
JUMPY_METRICS = {
    "avg_total_tokens": 40, "max_total_tokens": 90, "token_explosion_ratio": 2.25, "output_explosion_ratio": 1,
    "token_coefficient_variation": 0.889757, "token_spike_frequency": 0.333333, "max_token_growth_rate": 9, "explosive_growth_events": 1,
    "avg_execution_time": 1.6875, "max_execution_time": 4, "timeout_frequency": 0.333333, "execution_time_cv": 0.995187,
    "time_explosion_events": 1, "infinite_loop_risk_score": 0.333333, "timeout_flag": 1,
    "avg_tokens_per_second": 485, "min_tokens_per_second": 5, "max_tokens_per_second": 1440, "speed_inconsistency_ratio": 288,
    "inconsistent_speed_frequency": 1, "temporal_chaos_score": 1, "speed_anomaly_flag": 1,
    "success_rate": 0.333333, "failure_rate": 0.666667, "max_consecutive_failures": 1, "systematic_failure_flag": 1,
}


def _read(spark, tmp_path, docs, name="docs.jsonl"):
    return read_sessions(spark, str(_write(tmp_path, docs, name)), "json")


def test_written_out_sessions_match_their_goldens(spark, tmp_path):
    docs = [session("up", DAY + 3 * 3600, CLIMBING), session("hop", DAY + 86400, JUMPY, agent="scout two")]
    feats = document_features(normalize_documents(_read(spark, tmp_path, docs)))
    rows = {r["doc_key"]: r.asDict() for r in feats.collect()}
    for key, runs, golden, date in (("up", CLIMBING, CLIMBING_METRICS, "2024-12-20"), ("hop", JUMPY, JUMPY_METRICS, "2024-12-21")):
        assert rows[key]["total_runs"] == len(runs) and rows[key]["date"] == date
        for metric in ALL_METRICS:
            assert approx(rows[key][metric], golden.get(metric, 0), 1e-6), (key, metric, rows[key][metric])
    assert rows["hop"]["agent_name"] == "scout two" and rows["up"]["timestamp"] == "2024-12-20T03:00:00"


def test_date_range_read_keeps_boundaries(spark, tmp_path):
    docs = []
    for i, ts in enumerate([1734652799, 1734652800, 1735171199, 1735171200]):
        docs.append(session(f"b{i}", ts, CLIMBING))
    df = read_sessions(spark, str(_write(tmp_path, docs)), "json", "2024-12-20", "2024-12-25")
    got = sorted(r[0] for r in normalize_documents(df).select("doc_key").collect())
    assert got == ["b1", "b2"]


def _write(tmp_path, docs, name="b.jsonl"):
    path = tmp_path / name
    path.write_text("\n".join(json.dumps(d) for d in docs) + "\n")
    return path


def _run(t=0, o=0, x=0, tools=0, status="COMPLETED", events=()):
    return {"status": status, "metrics": {"total_tokens": t, "output_tokens": o, "time": x},
            "tools": ["t"] * tools, "events": list(events)}


def _doc(i, runs=None, **extra):
    d = {"_id": f"e{i}", "session_id": f"s{i}", "created_at": DAY,
         "agent_data": {"name": "a", "model": {"provider": "p", "id": "m"}}}
    if runs is not None:
        d["memory"] = {"runs": runs}
    d.update(extra)
    return d


EDGE_DOCS = [
    _doc(0),                                               # no memory
    _doc(1, []),                                           # empty run list
    _doc(2, [_run(10)], agent_data=None),                  # agent_data null -> quarantine
    {"_id": "e3", "session_id": "s3", "created_at": DAY, "memory": {"runs": [_run(10)]}},  # no agent_data
    _doc(4, [_run(10, x=1), {**_run(20, x=1), "tools": None}, _run(30, x=1)]),  # middle run dropped
    _doc(5, [_run([7, 9]), _run([]), {"status": "X", "metrics": {}}, _run(7)]),  # list/empty/missing/scalar
    _doc(6, [{**_run(10), "metrics": {"total_tokens": 10, "time": [None]}}]),    # null metric -> quarantine
    _doc(7, [_run(0)]),                                    # all t = 0, one run
    _doc(8, [_run(10), _run(0), _run(30)]),                # growth rates {0}
    _doc(9, [_run(1, x=0), _run(1, x=5)]),                 # 0 -> positive time counts as a jump
    _doc(10, [_run(0, x=0, events=["Gateway TIMEOUT"])]),  # time group empty even with a timeout
    _doc(11, [_run(0, x=2), _run(100, x=1)]),              # min rate 0
    _doc(12, [_run(1, status=s) for s in ["C", "C", "RUNNING", "C", "C", "C"]]),  # F F S F F F
    _doc(13, [_run(1, status="RUNNING" if i < 5 else "C") for i in range(10)]),   # 5 of 10 succeed
    _doc(14, [_run(1, status="RUNNING" if i < 1 else "C") for i in range(10)]),   # 1 of 10 succeeds
    _doc(15, [_run(50000, x=30, tools=10), _run(50000, x=60, tools=20)]),        # exact thresholds
    _doc(16, [_run(1), _run(1, events=[{"event": "RunCompleted"}])]),            # success via event
    _doc(17, [_run(1, events=["Error A", {"error": None}, "ok"])]),              # error count 2
    {**_doc(18, [_run(5)]), "session_id": "s0"},          # same session_id as e0
]


@pytest.fixture(scope="module")
def edge(spark, tmp_path_factory):
    path = _write(tmp_path_factory.mktemp("edge"), EDGE_DOCS, "edge.jsonl")
    norm = normalize_documents(read_sessions(spark, str(path), "json"))
    feats = {r["doc_key"]: r.asDict() for r in document_features(norm).collect()}
    quarantine = {r["doc_key"]: r["quarantine_reason"] for r in quarantined_documents(norm).collect()}
    runs = run_table(norm).collect()
    return feats, quarantine, runs


def test_edge_quarantine(edge):
    feats, quarantine, _ = edge
    assert quarantine == {"e2": "agent_data_null", "e6": "null_metric"}
    assert set(feats) == {f"e{i}" for i in range(19)} - {"e2", "e6"}


def test_edge_empty_sessions(edge):
    feats, _, _ = edge
    for key in ("e0", "e1"):
        assert feats[key]["total_runs"] == 0
        assert all(feats[key][m] is None for m in ALL_METRICS)
        assert feats[key]["date"] is None
    assert feats["e3"]["agent_name"] == "" and feats["e3"]["total_runs"] == 1


def test_edge_run_values(edge):
    feats, _, runs = edge
    e5 = [r["total_tokens"] for r in sorted((r for r in runs if r["doc_key"] == "e5"), key=lambda r: r["pos"])]
    assert e5 == [7.0, 0.0, 0.0, 7.0]
    assert feats["e4"]["total_runs"] == 2
    assert approx(feats["e4"]["max_token_growth_rate"], 3.0)  # 10 -> 30 once the middle run is dropped


def test_edge_metric_rules(edge):
    f, _, _ = edge
    assert f["e7"]["avg_total_tokens"] == 0 and f["e7"]["max_token_growth_rate"] == 1
    assert f["e8"]["max_token_growth_rate"] == 0 and f["e8"]["explosive_growth_events"] == 0
    assert f["e9"]["time_explosion_events"] == 1
    assert f["e10"]["timeout_flag"] == 0 and f["e10"]["timeout_frequency"] == 0
    assert f["e11"]["min_tokens_per_second"] == 0 and f["e11"]["speed_inconsistency_ratio"] == 0
    assert f["e11"]["inconsistent_speed_frequency"] == 0.5
    assert f["e12"]["max_consecutive_failures"] == 3
    assert f["e13"]["systematic_failure_flag"] == 0
    assert f["e14"]["complete_breakdown_flag"] == 0
    e15 = f["e15"]
    assert (e15["extreme_token_flag"], e15["extreme_duration_flag"], e15["tool_overuse_flag"]) == (0, 0, 0)
    assert e15["extreme_time_frequency"] == 0.5 and e15["excessive_tools_frequency"] == 0.5
    assert f["e16"]["success_rate"] == 0.5
    assert f["e17"]["total_errors"] == 2
    assert f["e18"]["session_id"] == "s0" and f["e0"]["session_id"] == "s0"


def test_flat_layout_documents(spark, tmp_path):
    """The job's flat layout: _id as the session, agent fields and runs at top level."""
    docs = [{"_id": "f1", "agent_name": "agent", "model_provider": "p", "model_id": "m", "created_at": DAY,
             "runs": [_run(10, x=1, status="RUNNING"), _run(40, x=2)]},
            {"_id": "f2", "created_at": DAY}]
    df = read_sessions(spark, str(_write(tmp_path, docs, "flat.jsonl")), "json")
    rows = {r["doc_key"]: r.asDict() for r in document_features(normalize_documents(df)).collect()}
    f1 = rows["f1"]
    assert (f1["session_id"], f1["agent_name"], f1["model_provider"], f1["model_id"]) == ("f1", "agent", "p", "m")
    assert f1["total_runs"] == 2 and f1["max_token_growth_rate"] == 4.0 and f1["success_rate"] == 0.5
    assert rows["f2"]["total_runs"] == 0 and rows["f2"]["agent_name"] == ""


def test_more_edge_rules(spark, tmp_path):
    """
    after 23:59:59 is outside the range (9); no created_at keeps the session
    without dates (10); an explicit null id becomes '' (13)."""
    docs = [
        _doc(30, [_run(10), {**_run(20), "metrics": None}, {**_run(40), "events": None}, _run(30)]),
        {**_doc(31, [_run(5)]), "created_at": 1735171199.5},
        {"_id": "e32", "session_id": None, "memory": {"runs": [_run(5)]}},
    ]
    path = str(_write(tmp_path, docs, "more.jsonl"))
    feats = {r["doc_key"]: r.asDict() for r in document_features(normalize_documents(
        read_sessions(spark, path, "json"))).collect()}
    assert feats["e30"]["total_runs"] == 2 and approx(feats["e30"]["max_token_growth_rate"], 3.0)
    assert feats["e32"]["session_id"] == "" and feats["e32"]["date"] is None
    assert feats["e32"]["created_at"] == 0 and feats["e32"]["total_runs"] == 1
    in_range = read_sessions(spark, path, "json", "2024-12-20", "2024-12-25")
    keys = sorted(r["doc_key"] for r in normalize_documents(in_range).collect())
    assert keys == ["e30"]  # e31 is 0.5 s after the end; e32 has no created_at


def test_identity_on_both_kernels(spark, tmp_path):
    """Documents without ``_id``, with the same ``_id``, and equal documents are rows of their own."""
    nameless = [{k: v for k, v in session("x", DAY, runs).items() if k != "_id"} for runs in (CLIMBING, JUMPY)]
    docs = [*nameless, session("same", DAY, CLIMBING), session("same", DAY, JUMPY), session("twin", DAY, JUMPY), session("twin", DAY, JUMPY)]
    norm = normalize_documents(_read(spark, tmp_path, docs, "ids.jsonl"))
    for kernel in ("nested", "flat"):
        got = sorted((r["doc_key"], r["total_runs"], round(r["avg_total_tokens"], 3)) for r in document_features(norm, kernel=kernel).collect())
        assert got == [("", 2, 300.0), ("", 3, 40.0), ("same", 2, 300.0), ("same", 3, 40.0), ("twin", 3, 40.0), ("twin", 3, 40.0)]


def test_typed_source_reads_null_as_missing(spark, tmp_path):
    docs = [session("a", DAY, [_run(10)]), session("b", DAY, [{"status": "RUNNING", "metrics": {"total_tokens": 5}}]),
            {"_id": "c", "created_at": DAY, "memory": {"runs": [_run(3)]}},
            {"_id": "d", "created_at": DAY, "agent_data": {"name": "n", "model": {"provider": "p", "id": "i"}}}]
    for d in docs[:1]:
        d["memory"]["runs"][0]["content"] = "long text that no feature reads"
    path = str(_write(tmp_path, docs, "typed.jsonl"))
    spark.read.json(path).write.parquet(str(tmp_path / "typed"))
    want = sorted(map(tuple, document_features(normalize_documents(read_sessions(spark, path, "json"))).collect()))
    typed = read_sessions(spark, str(tmp_path / "typed"), "parquet", "2024-12-20", "2024-12-20")
    norm = normalize_documents(typed)
    assert sorted(map(tuple, document_features(norm).collect())) == want and len(want) == 4
    assert quarantined_documents(norm).count() == 0
    plan = typed._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(created_at," in plan
    kept = pruned_schema(spark.read.parquet(str(tmp_path / "typed")).schema).simpleString()
    assert "content" not in kept and "total_tokens" in kept and "events" in kept


def test_dates_follow_the_time_zone(spark, tmp_path):
    path = str(_write(tmp_path, [session("z", DAY + 3600, CLIMBING)], "zone.jsonl"))  # 22:00 of the day before in Sao Paulo
    docs = read_sessions(spark, path, "json", "2024-12-19", "2024-12-19", "America/Sao_Paulo")
    row = document_features(normalize_documents(docs), tz="America/Sao_Paulo").first()
    assert (row["date"], row["timestamp"]) == ("2024-12-19", "2024-12-19T22:00:00")


def test_own_metric_group(spark, tmp_path):
    from pyspark.sql import functions as F
    from runlens.plans.features import features_from_nested
    norm = normalize_documents(_read(spark, tmp_path, [session("m", DAY, CLIMBING)], "own.jsonl"))
    own = {"tokens_per_tool": F.col("t_sum") / F.col("k_sum")}
    assert features_from_nested(norm, keep=["doc_key"], metrics=["success_rate"], extra_metrics=own).first()["tokens_per_tool"] == 100
