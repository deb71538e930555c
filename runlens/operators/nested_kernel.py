"""Nested kernel: base run statistics from a session row that carries its runs.

The session document is the unit of the source store, so a row holds one
session and its ``runs`` array (already normalised and filtered, in run
order). All statistics are row-local higher-order functions: no shuffle, no
join, no window. Output columns are ``BASE_STATS``; they are NULL for a
session without valid runs (the "no metrics at all" level of empty).

The work is staged in three projections — per-field arrays, then means and
pair arrays, then statistics — so every array is built once and later
stages read it as an attribute (Catalyst does not inline an expensive
expression that is used more than once).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from runlens.config import DEFAULT_THRESHOLDS, Thresholds
from runlens.functions.arith import safe_div
from runlens.operators.flat_kernel import BASE_STATS
from runlens.operators.run_metric import RunMetric


def _count(arr: Column, pred) -> Column:
    return F.size(F.filter(arr, pred)).cast("long")


def _sum(arr: Column, zero=0.0) -> Column:
    start = F.lit(zero).cast("double" if isinstance(zero, float) else "long")
    return F.aggregate(arr, start, lambda acc, v: acc + v)


def _pairs(arr: Column, n: Column, fn) -> Column:
    """fn(previous, current) for each adjacent pair of ``arr`` (n elements)."""
    m = F.greatest(n - 1, F.lit(0)).cast("int")
    return F.zip_with(F.slice(arr, 1, m), F.slice(arr, 2, m), fn)


def _longest_false_stretch(flags: Column) -> Column:
    """Longest stretch of consecutive false values, folded in order."""
    zero = F.lit(0).cast("long")
    return F.aggregate(
        flags,
        F.struct(zero.alias("cur"), zero.alias("best")),
        lambda acc, ok: F.when(ok, F.struct(zero.alias("cur"), acc["best"].alias("best"))).otherwise(
            F.struct((acc["cur"] + 1).alias("cur"), F.greatest(acc["best"], acc["cur"] + 1).alias("best"))),
        lambda acc: acc["best"],
    )


def nested_statistics(df: DataFrame, runs_col: str = "runs", keep: Sequence[str] = (),
                      th: Thresholds = DEFAULT_THRESHOLDS, metrics: Sequence[RunMetric] = ()) -> DataFrame:
    """``keep`` columns plus ``BASE_STATS`` and the states of ``metrics`` for each row of ``df``."""
    keep = list(keep)
    runs = F.col(runs_col)
    field = lambda name: F.transform(runs, lambda r: r[name])
    arrays = df.select(
        *keep,
        F.size(runs).cast("long").alias("_n"),
        field("total_tokens").alias("_t"),
        field("output_tokens").alias("_o"),
        field("execution_time").alias("_x"),
        field("tool_calls_count").alias("_k"),
        field("success").alias("_s"),
        field("error_count").alias("_e"),
        field("has_timeout").alias("_w"),
        F.transform(F.filter(runs, lambda r: r["execution_time"] > 0),
                    lambda r: safe_div(r["total_tokens"], r["execution_time"])).alias("_r"),
        *[m.over(runs).alias(m.column) for m in metrics],
    )
    c = F.col
    n = c("_n")
    derived = arrays.select(
        *keep, "_n", "_t", "_o", "_x", "_k", "_s", "_e", "_w", "_r", *[m.column for m in metrics],
        _sum(c("_t")).alias("_t_sum"),
        _sum(c("_x")).alias("_x_sum"),
        F.filter(_pairs(c("_t"), n, lambda a, b: F.when(a > 0, safe_div(b, a))),
                 lambda g: g.isNotNull()).alias("_g"),
        _pairs(c("_x"), n, lambda a, b: b > a * th.time_jump_multiplier).alias("_j"),
    )
    t_mean = safe_div(c("_t_sum"), n)
    x_mean = safe_div(c("_x_sum"), n)
    sq_dev = lambda arr, mean: F.aggregate(
        arr, F.lit(0.0).cast("double"), lambda acc, v: acc + (v - mean) * (v - mean))
    stats = {
        "n_runs": n,
        "t_sum": c("_t_sum"),
        "t_max": F.array_max("_t"),
        "t_nonzero": _count(c("_t"), lambda v: v != 0),
        "o_sum": _sum(c("_o")),
        "o_max": F.array_max("_o"),
        "x_sum": c("_x_sum"),
        "x_max": F.array_max("_x"),
        "x_nonzero": _count(c("_x"), lambda v: v != 0),
        "x_long": _count(c("_x"), lambda v: v > th.extreme_time_limit),
        "w_count": _count(c("_w"), lambda v: v),
        "k_sum": _sum(c("_k"), 0),
        "k_max": F.array_max("_k"),
        "k_nonzero": _count(c("_k"), lambda v: v != 0),
        "k_excess": _count(c("_k"), lambda v: v > th.excessive_tools_limit),
        "r_count": F.size("_r").cast("long"),
        "r_sum": F.when(F.size("_r") > 0, _sum(c("_r"))),
        "r_min": F.array_min("_r"),
        "r_max": F.array_max("_r"),
        "r_slow": _count(c("_r"), lambda v: v < th.slow_tokens_per_second),
        "r_fast": _count(c("_r"), lambda v: v > th.fast_tokens_per_second),
        "s_count": _count(c("_s"), lambda v: v),
        "e_sum": _sum(c("_e"), 0),
        "t_spikes": _count(c("_t"), lambda v: v > t_mean * th.token_spike_multiplier),
        "t_m2": sq_dev(c("_t"), t_mean),
        "x_m2": sq_dev(c("_x"), x_mean),
        "g_count": F.size("_g").cast("long"),
        "g_max": F.array_max("_g"),
        "g_explosive": _count(c("_g"), lambda g: g > th.explosive_growth),
        "x_jumps": _count(c("_j"), lambda j: j),
        "fail_streak": _longest_false_stretch(c("_s")),
    }
    has_runs = F.coalesce(n, F.lit(0)) > 0
    return derived.select(*keep, *[F.when(has_runs, stats[s]).alias(s) for s in BASE_STATS],
                          *[m.column for m in metrics])
