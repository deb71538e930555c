"""Flat kernel: base run statistics per session from a run table (one row per run).

Input columns (after normalisation, invalid runs already removed):
  key    session key (any type)
  order  one or more columns giving a total order of runs within a session
  total_tokens, output_tokens, execution_time (double), tool_calls_count,
  error_count (bigint), success, has_timeout (boolean)

NULL keys, positions and flags follow one rule whatever the plan: a NULL key
is one session, a NULL position sorts first, a NULL ``success`` is a failure
and a NULL ``has_timeout`` is none. Runs at equal positions are ordered by
their values, so the result never depends on how rows arrive.

Two plans, chosen per session (skew-safe: one session may hold a large
share of all runs):

  0. Metric sets without order need neither: one aggregation on the session.
     Otherwise a heavy-hitter summary of the session keys is taken: a
     mergeable sketch per task, so no key is shuffled. It reads the key column of a
     columnar run table, or, with ``staged``, of a narrow copy of the runs that is
     written once to the shared folder, so that a source that is costly to read
     (documents, joins) is read once. The error of the sketch is bounded, so
     its keys with more than ``limit`` counted runs are a superset of the
     sessions with more than ``limit`` runs (see ``hot_limit``). These are
     *hot*: at most ``2 * MOST_CHUNKS`` keys, broadcast. A key that the sketch
     overrates takes the chunked plan with the same result.

  Plain plan (all other sessions): one shuffle on the session, a window in
  run order (previous run, row number, running last success) and one
  aggregation. A window partition holds at most ``limit`` runs.

  Chunked plan (hot sessions):
  1. Their runs are range-partitioned by (session, run order) into about
     ``limit`` runs each and written to the shared folder; the number
     of the range is the *chunk*. Ranges are cut by rank, so sparse, equal or
     NULL positions give chunks of the same size as dense ones. ``limit`` is
     ``2**chunk_bits`` runs and grows with the data where that would make more
     than ``MOST_CHUNKS`` chunks.
  2. Session means: run count and sums per (session, chunk) with map-side
     partial aggregation, then a window over the chunk rows of each session.
  3. Ordered pass: runs are joined to their chunk's session means on
     ``(session, chunk)``: a hot session is spread over as many tasks as it
     has chunks. Within a chunk the same window and aggregation as the plain
     plan run, against the session mean (spikes, exact two-pass variance).
  4. Chunk summaries are stitched per session in chunk order: boundary
     pairs (last run of one chunk, first run of the next) and failure
     streaks that cross chunk borders; sums, maxima and minima combine.

Metrics of the caller's own (``run_metric``) are folded beside the base statistics:
runs in blocks, blocks of a session or chunk, chunks at their borders.

Both plans share the per-group aggregation, so they cannot drift apart; the
tests run both, and their union, against a plain-Python oracle.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from runlens.config import DEFAULT_THRESHOLDS, Thresholds
from runlens.functions.arith import safe_div
from runlens.operators.run_metric import BLOCK_BITS, RunMetric
from runlens.session import shared_dir


K = "_key"
C = "_chunk"

# Base statistics shared by both kernels and consumed by ``derive``.
BASE_STATS = [
    "n_runs", "t_sum", "t_max", "t_nonzero", "o_sum", "o_max",
    "x_sum", "x_max", "x_nonzero", "x_long", "w_count",
    "k_sum", "k_max", "k_nonzero", "k_excess",
    "r_count", "r_sum", "r_min", "r_max", "r_slow", "r_fast",
    "s_count", "e_sum",
    "t_spikes", "t_m2", "x_m2",
    "g_count", "g_max", "g_explosive", "x_jumps", "fail_streak",
]

_SUMMED = ["n_runs", "t_sum", "t_nonzero", "o_sum", "x_sum", "x_nonzero", "x_long", "w_count",
           "k_sum", "k_nonzero", "k_excess", "r_count", "r_sum", "r_slow", "r_fast", "s_count", "e_sum"]
_MAXED = ["t_max", "o_max", "x_max", "k_max", "r_max"]
_MINNED = ["r_min"]


def _count_if(cond: Column) -> Column:
    return F.count(F.when(cond, F.lit(1)))


def order_free_aggs(th: Thresholds) -> list[Column]:
    """Aggregates that do not depend on run order (partial-aggregation friendly)."""
    t, o, x = F.col("total_tokens"), F.col("output_tokens"), F.col("execution_time")
    k = F.col("tool_calls_count")
    rate = F.when(x > 0, safe_div(t, x))
    return [
        F.count(F.lit(1)).alias("n_runs"),
        F.sum(t).alias("t_sum"), F.max(t).alias("t_max"), _count_if(t != 0).alias("t_nonzero"),
        F.sum(o).alias("o_sum"), F.max(o).alias("o_max"),
        F.sum(x).alias("x_sum"), F.max(x).alias("x_max"), _count_if(x != 0).alias("x_nonzero"),
        _count_if(x > th.extreme_time_limit).alias("x_long"),
        _count_if(F.col("has_timeout")).alias("w_count"),
        F.sum(k).alias("k_sum"), F.max(k).alias("k_max"), _count_if(k != 0).alias("k_nonzero"),
        _count_if(k > th.excessive_tools_limit).alias("k_excess"),
        F.count(rate).alias("r_count"), F.sum(rate).alias("r_sum"),
        F.min(rate).alias("r_min"), F.max(rate).alias("r_max"),
        _count_if(rate < th.slow_tokens_per_second).alias("r_slow"),
        _count_if(rate > th.fast_tokens_per_second).alias("r_fast"),
        _count_if(F.col("success")).alias("s_count"),
        F.sum("error_count").alias("e_sum"),
    ]


def _ordered_pass(seq: DataFrame, w) -> DataFrame:
    """Previous run, row number and running last success over window ``w``."""
    t, x, s = F.col("total_tokens"), F.col("execution_time"), F.col("success")
    seq = (
        seq.withColumn("_prev_t", F.lag(t).over(w))
        .withColumn("_prev_x", F.lag(x).over(w))
        .withColumn("_rn", F.row_number().over(w))
    )
    return seq.withColumn(
        "_run_last_s", F.max(F.when(s, F.col("_rn"))).over(w.rowsBetween(Window.unboundedPreceding, 0)))


def _group_aggs(th: Thresholds) -> list[Column]:
    """Per-group statistics over the output of ``_ordered_pass`` with the
    session means in ``_t_mean`` / ``_x_mean`` (a group is a whole session on
    the plain path, one chunk of a session on the chunked path)."""
    t, x, s = F.col("total_tokens"), F.col("execution_time"), F.col("success")
    growth = F.when(F.col("_prev_t") > 0, safe_div(t, F.col("_prev_t")))
    return [
        *order_free_aggs(th),
        _count_if(t > F.col("_t_mean") * th.token_spike_multiplier).alias("t_spikes"),
        F.sum((t - F.col("_t_mean")) * (t - F.col("_t_mean"))).alias("t_m2"),
        F.sum((x - F.col("_x_mean")) * (x - F.col("_x_mean"))).alias("x_m2"),
        F.count(growth).alias("_g_count"),
        F.max(growth).alias("_g_max"),
        _count_if(growth > th.explosive_growth).alias("_g_explosive"),
        _count_if(F.col("_prev_x").isNotNull() & (x > F.col("_prev_x") * th.time_jump_multiplier)).alias("_x_jumps"),
        F.min_by(t, "_rn").alias("_first_t"), F.max_by(t, "_rn").alias("_last_t"),
        F.min_by(x, "_rn").alias("_first_x"), F.max_by(x, "_rn").alias("_last_x"),
        F.min(F.when(s, F.col("_rn"))).alias("_first_s"),
        F.max(F.when(s, F.col("_rn"))).alias("_last_s"),
        F.max(F.when(~s, F.col("_rn") - F.coalesce(F.col("_run_last_s"), F.lit(0)))).alias("_streak"),
    ]


_BLOCK_SUMS = [*_SUMMED, "t_spikes", "t_m2", "x_m2", "_g_count", "_g_explosive", "_x_jumps"]
_BLOCK_MAXES = [*_MAXED, "_g_max", "_last_s", "_streak"]
_BLOCK_MINS = [*_MINNED, "_first_s"]


def _grouped(seq: DataFrame, keys: list[str], th: Thresholds, metrics: Sequence[RunMetric]) -> DataFrame:
    """``_group_aggs`` per ``keys``; with metrics of the caller's own first per block of runs, then over the blocks
    (both groupings need the keys together only, so the blocks add no exchange)."""
    if not metrics:
        return seq.groupBy(*keys).agg(*_group_aggs(th))
    block = F.shiftright(F.col("_rn") - 1, BLOCK_BITS).alias("_block")
    parts = seq.groupBy(*keys, block).agg(*_group_aggs(th), *[m.folded("_rn", m.lift(F.col)) for m in metrics])
    return parts.groupBy(*keys).agg(
        *[F.sum(c).alias(c) for c in _BLOCK_SUMS], *[F.max(c).alias(c) for c in _BLOCK_MAXES], *[F.min(c).alias(c) for c in _BLOCK_MINS],
        *[F.min_by(c, "_block").alias(c) for c in ("_first_t", "_first_x")], *[F.max_by(c, "_block").alias(c) for c in ("_last_t", "_last_x")],
        *[m.folded("_block", F.col(m.column)) for m in metrics])


def plain_statistics(r: DataFrame, ords: list[str], th: Thresholds = DEFAULT_THRESHOLDS,
                     metrics: Sequence[RunMetric] = ()) -> DataFrame:
    """Sessions processed whole: one shuffle on the session, windows, one
    aggregation. Used for sessions no longer than one chunk, so a window
    partition never exceeds ``2**chunk_bits`` runs."""
    w = Window.partitionBy(K).orderBy(*ords)
    # the session mean over the whole partition, with the same ordering as
    # the other window functions: one sort and one window operator for all
    whole = w.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    seq = r.withColumn("_t_mean", F.avg("total_tokens").over(whole)) \
           .withColumn("_x_mean", F.avg("execution_time").over(whole))
    g = _grouped(_ordered_pass(seq, w), [K], th, metrics)
    return g.select(
        K, *_SUMMED, *_MAXED, *_MINNED, "t_spikes", "t_m2", "x_m2",
        F.col("_g_count").alias("g_count"), F.col("_g_max").alias("g_max"),
        F.col("_g_explosive").alias("g_explosive"), F.col("_x_jumps").alias("x_jumps"),
        F.coalesce(F.col("_streak"), F.lit(0)).cast("long").alias("fail_streak"), *[m.column for m in metrics],
    )


def chunked_statistics(r: DataFrame, ords: list[str], th: Thresholds = DEFAULT_THRESHOLDS,
                       metrics: Sequence[RunMetric] = ()) -> DataFrame:
    """Sessions cut into chunks (steps 2-4 of the module docstring)."""
    # -- step 2: session means from per-(session, chunk) sums (narrow, partial aggregation)
    sums = r.groupBy(K, C).agg(
        F.count(F.lit(1)).alias("_cn"), F.sum("total_tokens").alias("_cts"), F.sum("execution_time").alias("_cxs"))
    wk = Window.partitionBy(K)
    means = sums.select(
        K, C,
        (F.sum("_cts").over(wk) / F.sum("_cn").over(wk)).alias("_t_mean"),
        (F.sum("_cxs").over(wk) / F.sum("_cn").over(wk)).alias("_x_mean"),
    )

    # -- step 3: ordered pass inside each chunk. Shuffled hash join on
    # (session, chunk), building on the chunk-level means: runs are never
    # broadcast and never sorted for the join, and a hot session is spread
    # over as many tasks as it has chunks.
    means = means.withColumnsRenamed({K: "_mk", C: "_mc"}).hint("shuffle_hash")
    seq = r.join(means, F.col(K).eqNullSafe(F.col("_mk")) & (F.col(C) == F.col("_mc"))).drop("_mk", "_mc")
    chunks = _grouped(_ordered_pass(seq, Window.partitionBy(K, C).orderBy(*ords)), [K, C], th, metrics)

    # -- step 4: stitch chunks of a session in order
    wc = Window.partitionBy(K).orderBy(C)
    before = wc.rowsBetween(Window.unboundedPreceding, -1)
    chunks = (
        chunks.withColumn("_prev_last_t", F.lag("_last_t").over(wc))
        .withColumn("_prev_last_x", F.lag("_last_x").over(wc))
        .withColumn("_offset", F.coalesce(F.sum("n_runs").over(before), F.lit(0)))
    )
    chunks = chunks.withColumn("_succ_abs", F.col("_offset") + F.col("_last_s"))
    chunks = chunks.withColumn("_prev_succ", F.max("_succ_abs").over(before))
    border_growth = F.when(F.col("_prev_last_t") > 0, safe_div(F.col("_first_t"), F.col("_prev_last_t")))
    border_jump = F.col("_prev_last_x").isNotNull() & (
        F.col("_first_x") > F.col("_prev_last_x") * th.time_jump_multiplier
    )
    lead_streak = F.when(
        F.col("_first_s").isNotNull(),
        F.col("_offset") + F.col("_first_s") - 1 - F.coalesce(F.col("_prev_succ"), F.lit(0)),
    )
    return chunks.groupBy(K).agg(
        *[F.sum(c).alias(c) for c in _SUMMED],
        *[F.max(c).alias(c) for c in _MAXED],
        *[F.min(c).alias(c) for c in _MINNED],
        F.sum("t_spikes").alias("t_spikes"),
        F.sum("t_m2").alias("t_m2"),
        F.sum("x_m2").alias("x_m2"),
        (F.sum("_g_count") + F.count(border_growth)).alias("g_count"),
        F.greatest(F.max("_g_max"), F.max(border_growth)).alias("g_max"),
        (F.sum("_g_explosive") + _count_if(border_growth > th.explosive_growth)).alias("g_explosive"),
        (F.sum("_x_jumps") + _count_if(border_jump)).alias("x_jumps"),
        F.greatest(
            F.coalesce(F.max("_streak"), F.lit(0)),
            F.coalesce(F.max(lead_streak), F.lit(0)),
            F.sum("n_runs") - F.coalesce(F.max("_succ_abs"), F.lit(0)),
        ).cast("long").alias("fail_streak"),
        *[m.folded(C, F.col(m.column)) for m in metrics],
    )


MOST_CHUNKS = 1 << 14
TRACKED = 100_000  # keys the summary follows: its error is at most 3.5 * 0.75 / TRACKED of the runs
SKETCHED = ("boolean", "tinyint", "smallint", "int", "bigint", "float", "double", "date", "timestamp", "timestamp_ntz", "string")
VALUES = ["total_tokens", "output_tokens", "execution_time", "tool_calls_count", "error_count", "success", "has_timeout"]


def hot_limit(n_runs: int, chunk_bits: int) -> int:
    """Runs of a chunk, and of the longest session that the plain plan takes: ``2**chunk_bits``, more where that
    would make more than ``MOST_CHUNKS`` chunks.

    The sketch returns a key if its lower count exceeds the error, and then an upper count. The error is at most
    e = 3.5 * 0.75 * n_runs / TRACKED; a session of more than limit runs has a lower count above limit - e, which
    exceeds e as limit >= n_runs / MOST_CHUNKS > 2 * e: it is returned, with a count above limit."""
    return max(1 << chunk_bits, -(-n_runs // MOST_CHUNKS))


def hot_keys(r: DataFrame, staged: bool, chunk_bits: int) -> tuple[DataFrame, list, int, int]:
    """(runs to go on with, hot keys, their runs at most, limit)."""
    spark = r.sparkSession
    if staged:
        path = f"{shared_dir(spark)}/runs-{uuid.uuid4().hex}"
        r.write.parquet(path)
        r = spark.read.schema(r.schema).parquet(path)
    total = F.count(F.lit(1)).alias("runs")
    counted = F.expr(f"approx_top_k({K}, {2 * MOST_CHUNKS}, {TRACKED})").alias("keys")
    sketchable = dict(r.dtypes)[K] in SKETCHED or dict(r.dtypes)[K].startswith("decimal")
    found = r.select(K).agg(total, *([counted] if sketchable else [])).first().asDict()
    limit = hot_limit(found["runs"], chunk_bits)
    if not sketchable:  # a key that the summary cannot hold: exact counts
        keys = [(k, n) for k, n in r.groupBy(K).agg(total).where(F.col("runs") > limit).collect()]
    else:
        keys = [(k, n) for k, n in found["keys"] or [] if n > limit]
    return r, [k for k, _ in keys], sum(n for _, n in keys), limit


def with_chunks(r: DataFrame, n_runs: int, ords: list[str], limit: int) -> DataFrame:
    """Runs with their chunk, cut by rank in (session, run order)."""
    return r.repartitionByRange(n_runs // limit + 1, K, *ords).withColumn(C, F.spark_partition_id())


def _cut(r: DataFrame, n_runs: int, ords: list[str], limit: int) -> DataFrame:
    """Runs with their chunk, written once."""
    path = f"{shared_dir(r.sparkSession)}/hot-runs-{uuid.uuid4().hex}"
    cut = with_chunks(r, n_runs, ords, limit)
    cut.write.parquet(path)
    return r.sparkSession.read.schema(cut.schema).parquet(path)


def run_columns(runs: DataFrame, key: str, order: Sequence[str] | str) -> tuple[DataFrame, list[str]]:
    """The columns the kernel works on, under its names, and those that order the runs of a session."""
    order = [order] if isinstance(order, str) else list(order)
    ords = [f"_o{i}" for i in range(len(order))]
    r = runs.select(
        F.col(key).alias(K),
        *[F.col(c).alias(a) for c, a in zip(order, ords)],
        *[F.coalesce(F.col(c), F.lit(False)).alias(c) if c in ("success", "has_timeout") else F.col(c) for c in VALUES],
    )
    return r, [*ords, *VALUES]  # ties in the order are settled by the runs' values


def flat_run_statistics(
    runs: DataFrame,
    key: str,
    order: Sequence[str] | str,
    th: Thresholds = DEFAULT_THRESHOLDS,
    chunk_bits: int = 16,
    strategy: str = "auto",
    ordered: bool = True,
    staged: bool = False,
    metrics: Sequence[RunMetric] = (),
) -> DataFrame:
    """One row per session key with the columns of ``BASE_STATS`` (key kept under its name) and the states of ``metrics``.

    ``strategy="auto"`` sends sessions of more than ``hot_limit`` runs through the chunked plan
    and all others through the plain plan (see the module's text). ``"chunked"`` and ``"plain"``
    force one plan for all. ``ordered=False`` (no statistic that depends on order or on a session
    mean is read) needs no summary. ``staged`` writes the narrow run columns once before the summary is taken: for
    runs that do not lie in a columnar table as they are.
    """
    r, ords = run_columns(runs, key, order)
    if strategy not in ("auto", "plain", "chunked"):
        raise ValueError(f"unknown strategy {strategy!r}")
    if not ordered and not metrics and strategy == "auto":
        strategy = "plain"
    if strategy == "plain":
        stats = plain_statistics(r, ords, th, metrics)
    elif strategy == "chunked":
        n = r.count()
        stats = chunked_statistics(_cut(r, n, ords, hot_limit(n, chunk_bits)), ords, th, metrics)
    else:
        r, hot, n_hot, limit = hot_keys(r, staged, chunk_bits)
        stats = routed_statistics(r, hot, n_hot, limit, ords, th, metrics)
    return stats.select(F.col(K).alias(key), *BASE_STATS, *[m.column for m in metrics])


def routed_statistics(r: DataFrame, hot: list, n_hot: int, limit: int, ords: list[str], th: Thresholds,
                      metrics: Sequence[RunMetric]) -> DataFrame:
    """Hot sessions through the chunked plan, all others through the plain plan."""
    if not hot:
        return plain_statistics(r, ords, th, metrics)
    keys = F.broadcast(r.sparkSession.createDataFrame([(k,) for k in hot], r.select(F.col(K).alias("_hot")).schema))
    same = F.col(K).eqNullSafe(F.col("_hot"))
    cut = _cut(r.join(keys, same, "left_semi"), n_hot, ords, limit)
    return plain_statistics(r.join(keys, same, "left_anti"), ords, th, metrics).unionByName(chunked_statistics(cut, ords, th, metrics))
