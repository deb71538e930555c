"""Thresholds and the export layout.

Everything in this module is a fixed value: it must equal the reference
job's constants and column order, or the features and the CSV differ.
"""

from __future__ import annotations

from dataclasses import dataclass


@dataclass(frozen=True)
class Thresholds:
    # --- fixed values (must match the reference job) -------------------
    token_spike_multiplier: float = 2.0  # run is a spike if t > 2.0 * mean t
    time_jump_multiplier: float = 2.0  # x[i] > 2.0 * x[i-1] (same constant reused)
    explosive_growth: float = 5.0  # growth rate and tool-explosion ratio limit
    extreme_token_limit: float = 50000.0
    mega_explosion_limit: float = 100000.0
    extreme_time_limit: float = 30.0
    long_duration_limit: float = 60.0
    excessive_tools_limit: float = 10.0
    tool_overuse_limit: float = 20.0
    slow_tokens_per_second: float = 50.0
    fast_tokens_per_second: float = 1000.0
    speed_anomaly_ratio: float = 10.0
    systematic_failure_rate: float = 0.5
    breakdown_success_rate: float = 0.1
    tool_chaos_divisor: float = 10.0


DEFAULT_THRESHOLDS = Thresholds()

# --- fixed values: the 48 training-export columns, in export order -------
EXPORT_COLUMNS: list[str] = [
    "session_id",
    "agent_name",
    "model_provider",
    "model_id",
    "total_runs",
    "avg_total_tokens",
    "max_total_tokens",
    "token_explosion_ratio",
    "output_explosion_ratio",
    "token_coefficient_variation",
    "token_spike_frequency",
    "max_token_growth_rate",
    "explosive_growth_events",
    "extreme_token_flag",
    "mega_explosion_flag",
    "avg_execution_time",
    "max_execution_time",
    "timeout_frequency",
    "extreme_time_frequency",
    "execution_time_cv",
    "time_explosion_events",
    "infinite_loop_risk_score",
    "timeout_flag",
    "extreme_duration_flag",
    "avg_tool_calls",
    "max_tool_calls",
    "total_tool_calls",
    "tool_explosion_ratio",
    "excessive_tools_frequency",
    "duplicate_tools_score",
    "tool_chaos_score",
    "tool_overuse_flag",
    "tool_explosion_flag",
    "avg_tokens_per_second",
    "min_tokens_per_second",
    "max_tokens_per_second",
    "speed_inconsistency_ratio",
    "inconsistent_speed_frequency",
    "temporal_chaos_score",
    "speed_anomaly_flag",
    "success_rate",
    "failure_rate",
    "max_consecutive_failures",
    "avg_errors_per_run",
    "total_errors",
    "degradation_score",
    "systematic_failure_flag",
    "complete_breakdown_flag",
]

TEXT_COLUMNS = ["session_id", "agent_name", "model_provider", "model_id"]

# --- fixed values: placeholder written when a range has no session -------
EMPTY_EXPORT_HEADER = ["session_id", "message"]
EMPTY_EXPORT_ROW = ("no_data", "Nenhuma conversa encontrada")

# --- fixed values: export layout below the export root --------------------
EXPORT_DIR_TEMPLATE = "ml-training-data/{start}_to_{end}/conversations_{start}_to_{end}"

# Metric groups in composition order (tokens, time, tools, speed, failure).
TOKEN_METRICS = EXPORT_COLUMNS[5:15]
TIME_METRICS = EXPORT_COLUMNS[15:24]
TOOL_METRICS = EXPORT_COLUMNS[24:33]
SPEED_METRICS = EXPORT_COLUMNS[33:40]
FAILURE_METRICS = EXPORT_COLUMNS[40:48]
ALL_METRICS = EXPORT_COLUMNS[5:]
