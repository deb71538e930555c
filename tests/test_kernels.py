"""Both kernels against the plain-Python oracle, on random sessions.

The flat kernel runs with tiny chunks (2 and 4 runs) as well as the default,
so sessions cross many chunk borders and the stitching of growth pairs,
time jumps and failure streaks is exercised.
"""

from __future__ import annotations

import random

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from pyspark.sql import types as T

from helpers import approx
from pyoracle import session_metrics
from runlens.config import ALL_METRICS
from runlens.plans.features import features_from_nested, features_from_run_table, features_from_runs

RUN_TYPE = T.StructType([
    T.StructField("total_tokens", T.DoubleType()),
    T.StructField("output_tokens", T.DoubleType()),
    T.StructField("execution_time", T.DoubleType()),
    T.StructField("tool_calls_count", T.LongType()),
    T.StructField("error_count", T.LongType()),
    T.StructField("success", T.BooleanType()),
    T.StructField("has_timeout", T.BooleanType()),
])
FIELDS = [f.name for f in RUN_TYPE.fields]


def random_run(rng: random.Random) -> dict:
    pick = lambda *vals: rng.choice(vals)
    return {
        "total_tokens": pick(0.0, 0.0, 1.0, 7.0, 100.0, 250.0, 600.0, 5000.0, 60000.0, 120000.0, -5.0),
        "output_tokens": pick(0.0, 3.0, 50.0, 80.0, 900.0),
        "execution_time": pick(0.0, 0.0, 0.5, 1.5, 2.0, 30.0, 31.0, 60.0, 61.0, -1.0),
        "tool_calls_count": pick(0, 0, 0, 1, 3, 10, 11, 20, 21),
        "error_count": pick(0, 0, 1, 2),
        "success": rng.random() < 0.45,
        "has_timeout": rng.random() < 0.1,
    }


def random_sessions(seed: int, n: int, max_runs: int) -> dict[int, list[dict]]:
    rng = random.Random(seed)
    return {s: [random_run(rng) for _ in range(rng.randint(1, max_runs))] for s in range(n)}


def flat_frame(spark, sessions, gap: int = 1):
    rows = [(s, i * gap, *[r[f] for f in FIELDS]) for s, runs in sessions.items() for i, r in enumerate(runs)]
    schema = T.StructType([T.StructField("sid", T.LongType()), T.StructField("pos", T.LongType()), *RUN_TYPE.fields])
    return spark.createDataFrame(rows, schema)


def nested_frame(spark, sessions):
    rows = [(s, [tuple(r[f] for f in FIELDS) for r in runs]) for s, runs in sessions.items()]
    schema = T.StructType([T.StructField("sid", T.LongType()), T.StructField("runs", T.ArrayType(RUN_TYPE))])
    return spark.createDataFrame(rows, schema)


def check(got: dict[int, dict], sessions: dict[int, list[dict]]):
    assert set(got) == set(sessions)
    for s, runs in sessions.items():
        want = session_metrics(runs)
        row = got[s]
        assert row["total_runs"] == want["total_runs"]
        for m in ALL_METRICS:
            assert approx(row[m], want[m], 1e-9), (s, m, row[m], want[m], runs)


@pytest.mark.parametrize("chunk_bits", [1, 2, 16])
def test_flat_kernel_matches_oracle(spark, chunk_bits):
    sessions = random_sessions(7 + chunk_bits, 150, 40)
    df = features_from_runs(flat_frame(spark, sessions), "sid", "pos", digits=None, chunk_bits=chunk_bits)
    check({r["session_key"]: r.asDict() for r in df.collect()}, sessions)


@pytest.mark.parametrize("strategy", ["plain", "chunked"])
def test_flat_kernel_forced_strategy(spark, strategy):
    sessions = random_sessions(13, 120, 30)
    df = features_from_runs(flat_frame(spark, sessions), "sid", "pos", digits=None, chunk_bits=2,
                            strategy=strategy)
    check({r["session_key"]: r.asDict() for r in df.collect()}, sessions)


def test_summary_of_staged_runs(spark):
    """The summary of a narrow copy gives the same as that of the source's key column."""
    sessions = random_sessions(17, 80, 30)
    df = features_from_runs(flat_frame(spark, sessions), "sid", "pos", digits=None, chunk_bits=2, staged=True)
    check({r["session_key"]: r.asDict() for r in df.collect()}, sessions)


def test_flat_kernel_sparse_positions(spark):
    """Positions need only be ordered, not dense (gaps leave chunks empty)."""
    sessions = random_sessions(3, 60, 30)
    df = features_from_runs(flat_frame(spark, sessions, gap=3), "sid", "pos", digits=None, chunk_bits=2)
    check({r["session_key"]: r.asDict() for r in df.collect()}, sessions)


def test_nested_kernel_matches_oracle(spark):
    sessions = random_sessions(11, 150, 40)
    df = features_from_nested(nested_frame(spark, sessions), keep=["sid"], digits=None)
    check({r["sid"]: r.asDict() for r in df.collect()}, sessions)


def test_one_hot_session_spread_over_chunks(spark):
    """A session holding most rows is split into chunks and still exact."""
    rng = random.Random(5)
    sessions = {0: [random_run(rng) for _ in range(3000)], 1: [random_run(rng)], 2: [random_run(rng) for _ in range(5)]}
    df = features_from_runs(flat_frame(spark, sessions), "sid", "pos", digits=None, chunk_bits=7)
    check({r["session_key"]: r.asDict() for r in df.collect()}, sessions)


run_strategy = st.fixed_dictionaries({
    "total_tokens": st.sampled_from([0.0, 1.0, 2.0, 10.0, 11.0, 55.0, 50001.0]),
    "output_tokens": st.sampled_from([0.0, 1.0, 9.0]),
    "execution_time": st.sampled_from([0.0, 0.1, 1.0, 2.0, 31.0, 61.0]),
    "tool_calls_count": st.sampled_from([0, 1, 11, 21]),
    "error_count": st.sampled_from([0, 1]),
    "success": st.booleans(),
    "has_timeout": st.booleans(),
})


@settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.lists(run_strategy, min_size=1, max_size=12), min_size=1, max_size=25))
def test_kernels_agree_property(spark, batch):
    sessions = dict(enumerate(batch))
    flat = features_from_runs(flat_frame(spark, sessions), "sid", "pos", digits=None, chunk_bits=1)
    check({r["session_key"]: r.asDict() for r in flat.collect()}, sessions)
    nested = features_from_nested(nested_frame(spark, sessions), keep=["sid"], digits=None)
    check({r["sid"]: r.asDict() for r in nested.collect()}, sessions)


def test_invariants(spark):
    sessions = random_sessions(21, 200, 25)
    df = features_from_runs(flat_frame(spark, sessions), "sid", "pos", digits=None)
    bad = df.filter(
        (F.col("token_spike_frequency") < 0) | (F.col("token_spike_frequency") > 1)
        | (F.col("timeout_frequency") > 1) | (F.col("excessive_tools_frequency") > 1)
        | (F.col("inconsistent_speed_frequency") > 1)
        | (F.abs(F.col("success_rate") + F.col("failure_rate") - 1) > 1e-12)
        | (F.col("max_consecutive_failures") > F.col("total_runs"))
        | ((F.col("avg_total_tokens") > 0) & (F.col("token_explosion_ratio") < 1))
    )
    assert bad.count() == 0


def test_inserting_a_success_never_lengthens_streak(spark):
    rng = random.Random(9)
    base = random_sessions(9, 80, 20)
    more = {}
    for s, runs in base.items():
        runs2 = list(runs)
        runs2.insert(rng.randint(0, len(runs2)), {**random_run(rng), "success": True})
        more[s] = runs2
    a = features_from_runs(flat_frame(spark, base), "sid", "pos", digits=None)
    b = features_from_runs(flat_frame(spark, more), "sid", "pos", digits=None)
    sa = {r["session_key"]: r["max_consecutive_failures"] for r in a.collect()}
    sb = {r["session_key"]: r["max_consecutive_failures"] for r in b.collect()}
    assert all(sb[k] <= sa[k] for k in sa)


def test_chunked_equals_plain_on_lineitem(spark):
    """Ranges of 64 runs cut orders in two, so real multi-column orders are stitched."""
    from helpers import SF_SMALL
    from runlens.sources.tables import LINEITEM_ORDER, lineitem_runs
    runs = lineitem_runs(spark, SF_SMALL)
    plain, chunked = ({r["session_key"]: r.asDict() for r in features_from_runs(
        runs, "session_key", LINEITEM_ORDER, strategy=s, chunk_bits=6).collect()} for s in ("plain", "chunked"))
    assert set(plain) == set(chunked) and len(plain) == 1473
    for k, row in plain.items():
        for m in ["total_runs", *ALL_METRICS]:
            assert approx(row[m], chunked[k][m], 1e-9), (k, m, row[m], chunked[k][m])


def test_nulls_follow_one_rule_in_every_plan(spark):
    """NULL keys, NULL and equal positions, NULL success: plain, chunked, auto below and above the bound."""
    rng = random.Random(23)
    rows = []
    for s in (None, 1, 2, 3):
        for i in range({None: 40, 1: 30, 2: 5, 3: 1}[s]):
            r = random_run(rng)
            r["success"] = rng.choice([True, False, None])
            r["has_timeout"] = rng.choice([True, False, None])
            rows.append((s, rng.choice([None, i, i // 3, i * 10**9]), *[r[f] for f in FIELDS]))
    schema = T.StructType([T.StructField("sid", T.LongType()), T.StructField("pos", T.LongType()), *RUN_TYPE.fields])
    df = spark.createDataFrame(rows, schema).repartition(3)
    ordered = {}
    for row in sorted(rows, key=lambda r: tuple((v is not None, v if v is not None else 0) for v in (r[1], *r[2:7])) +
                      (bool(r[7]), bool(r[8]))):
        ordered.setdefault(row[0], []).append(dict(zip(FIELDS, row[2:])))
    for kw in (dict(strategy="plain"), dict(strategy="chunked"), dict(), dict(staged=True)):
        got = features_from_runs(df, "sid", "pos", chunk_bits=2, **kw)
        check({r["session_key"]: r.asDict() for r in got.collect()}, ordered)
    nested = spark.createDataFrame([(s, [tuple(r[f] for f in FIELDS) for r in runs]) for s, runs in ordered.items()],
                                   T.StructType([T.StructField("sid", T.LongType()), T.StructField("runs", T.ArrayType(RUN_TYPE))]))
    check({r["sid"]: r.asDict() for r in features_from_nested(nested, keep=["sid"]).collect()}, ordered)


def rise_and_fall(tokens):
    best = now = 1
    high, fall = tokens[0], 0.0
    for a, b in zip(tokens, tokens[1:]):
        now = now + 1 if b > a else 1
        best, fall, high = max(best, now), max(fall, high - b), max(high, b)
    return best, fall


@pytest.mark.parametrize("how", ["plain", "chunked", "auto", "nested"])
def test_own_metrics_are_the_same_on_every_kernel(spark, how, monkeypatch):
    """Order-dependent states folded in blocks, stitched at chunk borders, folded in a row."""
    from runlens.operators import run_metric
    monkeypatch.setattr(run_metric, "BLOCK_BITS", 1)
    monkeypatch.setattr("runlens.operators.flat_kernel.BLOCK_BITS", 1)
    rng = random.Random(31)
    sessions = {s: [{**random_run(rng), "total_tokens": float(rng.choice([i, i, rng.randint(0, 9)]))} for i in range(rng.randint(1, 40))] for s in range(60)}
    own = ["longest_token_rise", run_metric.DEEPEST_FALL]
    if how == "nested":
        df = features_from_nested(nested_frame(spark, sessions), keep=["sid"], digits=None, own_metrics=own).withColumnRenamed("sid", "session_key")
    else:
        df = features_from_runs(flat_frame(spark, sessions), "sid", "pos", digits=None, chunk_bits=3, strategy=how, own_metrics=own)
    rows = {r["session_key"]: r.asDict() for r in df.collect()}
    check(rows, sessions)
    for s, runs in sessions.items():
        assert (rows[s]["longest_token_rise"], rows[s]["deepest_token_fall"]) == rise_and_fall([r["total_tokens"] for r in runs])


def test_a_session_without_runs_has_no_own_metric(spark):
    got = features_from_nested(nested_frame(spark, {1: []}), keep=["sid"], own_metrics=["longest_token_rise"]).first()
    assert got["total_runs"] == 0 and got["longest_token_rise"] is None


def test_metric_registry():
    from runlens.operators.run_metric import LONGEST_RISE, RunMetric, register_metric, run_metrics
    assert register_metric(LONGEST_RISE) is LONGEST_RISE and run_metrics(None) == []
    with pytest.raises(ValueError, match="registered already"):
        register_metric(RunMetric("longest_token_rise", {}, dict, dict, len))
    with pytest.raises(ValueError, match="no metric named"):
        run_metrics(["nothing"])
    with pytest.raises(ValueError, match="the state has the fields"):
        RunMetric("x", {"a": "int"}, lambda run: {"b": run("total_tokens")}, dict, len).lift(F.col)


def test_the_summary_returns_every_hot_key(spark):
    """Keys above the limit are found among very many others; the error bound of the sketch leaves room."""
    from runlens.operators import flat_kernel
    n = 400_000
    runs = spark.range(n).select(
        F.when(F.col("id") % 10 < 2, F.lit("hot")).when(F.col("id") % 10 == 3, F.lit(None)).when(F.col("id") % 1000 == 4, F.lit("warm"))
        .otherwise(F.col("id").cast("string")).alias(flat_kernel.K))
    for staged in (True, False):
        r, hot, n_hot, limit = flat_kernel.hot_keys(runs.withColumn("x", F.lit(1)), staged, 8)
        assert limit == 256 and set(hot) == {"hot", None, "warm"} and n_hot >= n * 0.3 + n / 1000
        assert r.count() == n
    assert flat_kernel.hot_limit(10**11, 16) * flat_kernel.MOST_CHUNKS >= 10**11
    error = 3.5 * 0.75 / flat_kernel.TRACKED
    assert 1 / flat_kernel.MOST_CHUNKS > 2 * error


def test_the_source_is_read_once(spark):
    """The runs of an expensive source are evaluated once, hot sessions or not."""
    rng = random.Random(41)
    sessions = {0: [random_run(rng) for _ in range(300)], **{s: [random_run(rng)] for s in range(1, 50)}}
    seen = spark.sparkContext.accumulator(0)

    def touch(x):
        seen.add(1)
        return x

    df = flat_frame(spark, sessions).withColumn("pos", F.udf(touch, "long")("pos"))
    for chunk_bits in (5, 16):
        seen.value = 0
        got = features_from_runs(df, "sid", "pos", digits=None, chunk_bits=chunk_bits, staged=True)
        check({r["session_key"]: r.asDict() for r in got.collect()}, sessions)
        assert seen.value == 349


@pytest.mark.parametrize("chunk_bits", [3, 16])
def test_run_table_needs_no_exchange(spark, tmp_path, chunk_bits):
    from runlens.sources.run_table import open_run_table, write_run_table
    sessions = random_sessions(43, 60, 30)
    path = write_run_table(flat_frame(spark, sessions), str(tmp_path / "runs"), "sid", "pos", buckets=4, chunk_bits=chunk_bits)
    table = open_run_table(spark, path)
    assert (table.hot is not None) == (chunk_bits == 3)
    got = features_from_run_table(table, own_metrics=["longest_token_rise"])
    check({r["session_key"]: r.asDict() for r in got.collect()}, sessions)
    for r in got.collect():
        assert r["longest_token_rise"] == rise_and_fall([x["total_tokens"] for x in sessions[r["session_key"]]])[0]
    if chunk_bits == 16:
        plan = got._jdf.queryExecution().executedPlan().toString()
        assert "Exchange" not in plan and "SelectedBucketsCount: 4 out of 4" in plan
    import glob
    assert len(glob.glob(f"{path}/sessions/*.parquet")) <= 4  # one file a bucket: sessions lie in order
    again = open_run_table(spark, path)  # registered already
    assert again.sessions.count() == table.sessions.count()
