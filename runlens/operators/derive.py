"""The 43 session metrics from base statistics, shared by both kernels.

Group guards (the reference's "empty metrics" rules):
  tokens  no run with total_tokens != 0  -> all 0, max_token_growth_rate 1
  time    no run with execution_time != 0 -> all 0 (timeout counters too)
  tools   no run with tool_calls_count != 0 -> all 0
  speed   no run with execution_time > 0  -> all 0
A session without valid runs has NULL base statistics and so NULL metrics;
the export turns them into 0 (see ``plans.export``).
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from runlens.config import DEFAULT_THRESHOLDS, Thresholds
from runlens.functions.arith import safe_div



def _flag(cond: Column) -> Column:
    return F.when(cond, F.lit(1)).otherwise(F.lit(0))


def _guard(ok: Column, value: Column, empty) -> Column:
    """value when the group guard holds, the group's empty value otherwise;
    NULL stays NULL (session without runs)."""
    return F.when(ok.isNull(), F.lit(None)).when(ok, value).otherwise(F.lit(empty))


def ratio_columns(th: Thresholds = DEFAULT_THRESHOLDS) -> list[Column]:
    """Means, ratios and guards shared by several metrics, computed once.

    Deriving the metrics in two projections keeps each generated method
    small: inlining these into all 43 metric expressions produced one huge
    method that the JVM would not compile."""
    c = F.col
    n = c("n_runs")
    t_mean = safe_div(c("t_sum"), n)
    o_mean = safe_div(c("o_sum"), n)
    x_mean = safe_div(c("x_sum"), n)
    k_mean = safe_div(c("k_sum"), n)
    r_min = c("r_min")
    return [
        t_mean.alias("_t_mean"),
        o_mean.alias("_o_mean"),
        x_mean.alias("_x_mean"),
        k_mean.alias("_k_mean"),
        (c("t_nonzero") > 0).alias("_tok_ok"),
        (c("x_nonzero") > 0).alias("_time_ok"),
        (c("k_nonzero") > 0).alias("_tool_ok"),
        (c("r_count") > 0).alias("_speed_ok"),
        safe_div(c("w_count"), n).alias("_timeout_freq"),
        safe_div(c("x_long"), n).alias("_long_freq"),
        safe_div(c("k_excess"), n).alias("_excess_freq"),
        F.when(k_mean > 0, safe_div(c("k_max"), k_mean)).otherwise(F.lit(1.0)).alias("_tool_explosion"),
        F.when(r_min > 0, safe_div(c("r_max"), r_min)).otherwise(F.lit(0.0)).alias("_inconsistency"),
        safe_div(c("r_slow") + c("r_fast"), c("r_count")).alias("_odd_speed"),
        safe_div(c("s_count"), n).alias("_success_rate"),
    ]


def with_ratios(stats: DataFrame, th: Thresholds = DEFAULT_THRESHOLDS) -> DataFrame:
    """Base statistics plus the shared ratios (the input of ``derive_metrics``)."""
    return stats.select("*", *ratio_columns(th))


def metric_columns(th: Thresholds = DEFAULT_THRESHOLDS) -> dict[str, Column]:
    """Metric expressions over base statistics and ``ratio_columns``."""
    c = F.col
    n = c("n_runs")
    t_mean, o_mean, x_mean, k_mean = c("_t_mean"), c("_o_mean"), c("_x_mean"), c("_k_mean")

    # tokens
    tokens = {
        "avg_total_tokens": (t_mean, 0.0),
        "max_total_tokens": (c("t_max").cast("double"), 0.0),
        "token_explosion_ratio": (
            F.when(t_mean > 0, safe_div(c("t_max"), t_mean)).otherwise(F.lit(1.0)), 0.0),
        "output_explosion_ratio": (
            F.when(o_mean > 0, safe_div(c("o_max"), o_mean)).otherwise(F.lit(1.0)), 0.0),
        "token_coefficient_variation": (
            F.when(t_mean > 0, safe_div(F.sqrt(safe_div(c("t_m2"), n)), t_mean)).otherwise(F.lit(0.0)), 0.0),
        "token_spike_frequency": (safe_div(c("t_spikes"), n), 0.0),
        "max_token_growth_rate": (F.when(c("g_count") > 0, c("g_max")).otherwise(F.lit(1.0)), 1.0),
        "explosive_growth_events": (c("g_explosive").cast("long"), 0),
        "extreme_token_flag": (_flag(c("t_max") > th.extreme_token_limit), 0),
        "mega_explosion_flag": (_flag(c("t_max") > th.mega_explosion_limit), 0),
    }
    # time
    time = {
        "avg_execution_time": (x_mean, 0.0),
        "max_execution_time": (c("x_max").cast("double"), 0.0),
        "timeout_frequency": (c("_timeout_freq"), 0.0),
        "extreme_time_frequency": (c("_long_freq"), 0.0),
        "execution_time_cv": (
            F.when(x_mean > 0, safe_div(F.sqrt(safe_div(c("x_m2"), n)), x_mean)).otherwise(F.lit(0.0)), 0.0),
        "time_explosion_events": (c("x_jumps").cast("long"), 0),
        "infinite_loop_risk_score": (c("_timeout_freq") + c("_long_freq"), 0.0),
        "timeout_flag": (_flag(c("w_count") > 0), 0),
        "extreme_duration_flag": (_flag(c("x_max") > th.long_duration_limit), 0),
    }
    # tools
    tool_explosion = c("_tool_explosion")
    tools = {
        "avg_tool_calls": (k_mean, 0.0),
        "max_tool_calls": (c("k_max").cast("long"), 0),
        "total_tool_calls": (c("k_sum").cast("long"), 0),
        "tool_explosion_ratio": (tool_explosion, 0.0),
        "excessive_tools_frequency": (c("_excess_freq"), 0.0),
        "duplicate_tools_score": (F.lit(0.0), 0.0),
        "tool_chaos_score": (c("_excess_freq") + tool_explosion / th.tool_chaos_divisor, 0.0),
        "tool_overuse_flag": (_flag(c("k_max") > th.tool_overuse_limit), 0),
        "tool_explosion_flag": (_flag(tool_explosion > th.explosive_growth), 0),
    }
    # speed (tokens per second over runs with execution_time > 0)
    speed = {
        "avg_tokens_per_second": (safe_div(c("r_sum"), c("r_count")), 0.0),
        "min_tokens_per_second": (c("r_min"), 0.0),
        "max_tokens_per_second": (c("r_max"), 0.0),
        "speed_inconsistency_ratio": (c("_inconsistency"), 0.0),
        "inconsistent_speed_frequency": (c("_odd_speed"), 0.0),
        "temporal_chaos_score": (c("_odd_speed"), 0.0),
        "speed_anomaly_flag": (_flag(c("_inconsistency") > th.speed_anomaly_ratio), 0),
    }
    # failures (no guard beyond "has runs")
    success_rate = c("_success_rate")
    failure_rate = 1.0 - success_rate
    failure = {
        "success_rate": success_rate,
        "failure_rate": failure_rate,
        "max_consecutive_failures": c("fail_streak").cast("long"),
        "avg_errors_per_run": safe_div(c("e_sum"), n),
        "total_errors": c("e_sum").cast("long"),
        "degradation_score": F.lit(0.0),
        "systematic_failure_flag": _flag(failure_rate > th.systematic_failure_rate),
        "complete_breakdown_flag": _flag(success_rate < th.breakdown_success_rate),
    }

    out: dict[str, Column] = {}
    for ok, group in ((c("_tok_ok"), tokens), (c("_time_ok"), time), (c("_tool_ok"), tools),
                      (c("_speed_ok"), speed)):
        for name, (value, empty) in group.items():
            out[name] = _guard(ok, value, empty)
    has_runs = n > 0
    for name, value in failure.items():
        out[name] = F.when(has_runs, value)
    return out


# Output types of the metrics (the export and the oracles use the same).
INT_METRICS = {
    "extreme_token_flag", "mega_explosion_flag", "timeout_flag", "extreme_duration_flag",
    "tool_overuse_flag", "tool_explosion_flag", "speed_anomaly_flag",
    "systematic_failure_flag", "complete_breakdown_flag",
}
LONG_METRICS = {
    "explosive_growth_events", "time_explosion_events", "max_tool_calls", "total_tool_calls",
    "max_consecutive_failures", "total_errors",
}


# Metrics that read the run order or a session mean; the others need one aggregation only.
ORDERED_METRICS = {
    "token_coefficient_variation", "token_spike_frequency", "max_token_growth_rate", "explosive_growth_events",
    "execution_time_cv", "time_explosion_events", "max_consecutive_failures",
}


def metric_type(name: str) -> str:
    if name in INT_METRICS:
        return "int"
    if name in LONG_METRICS:
        return "bigint"
    return "double"


def round_digits(col: Column, digits: int) -> Column:
    """Round to ``digits`` decimals as ``round(col * 10**digits) / 10**digits``.

    ``round(double, d)`` rounds the shortest decimal text of the value in some
    engines and the binary value in others, so a value printed as ``…5`` at
    digit d+1 can round differently; scaling first gives every engine the same
    IEEE product to round to an integer (halves away from zero)."""
    scale = float(10 ** digits)
    return F.round(col * scale, 0) / scale


def derive_metrics(names: list[str] | None = None, th: Thresholds = DEFAULT_THRESHOLDS,
                   digits: int | None = None, extra: Mapping[str, Column] | None = None) -> list[Column]:
    """Metric columns (optionally a subset, optionally rounded) over the output
    of ``with_ratios``. ``extra`` is a metric group of the caller's own: name ->
    expression over the base statistics and ratios, appended as it is."""
    cols = metric_columns(th)
    names = list(cols) if names is None else names
    out = []
    for name in names:
        col = cols[name].cast(metric_type(name))
        if digits is not None and metric_type(name) == "double":
            col = round_digits(col, digits)
        out.append(col.alias(name))
    return out + [col.alias(name) for name, col in (extra or {}).items()]
