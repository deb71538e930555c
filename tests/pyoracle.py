"""Plain-Python oracle of the session metrics, in exact rational arithmetic.

One session = an ordered list of valid runs, each a dict with total_tokens,
output_tokens, execution_time, tool_calls_count, error_count, success and
has_timeout. Every metric is one line of a table: its group, and its value as
a function of a few quantities of the session. Ratios, means and variances
are ``Fraction``s, so thresholds are compared without rounding; only the final
value becomes a float.
"""

from __future__ import annotations

from fractions import Fraction
from itertools import groupby, pairwise
from math import sqrt

from runlens.config import ALL_METRICS
from runlens.config import DEFAULT_THRESHOLDS as TH


class Numbers(list):
    """A list of exact numbers with the summaries the metrics are made of."""

    def __init__(self, values):
        super().__init__(Fraction(v) for v in values)

    @property
    def mean(self):
        return sum(self, Fraction(0)) / len(self)

    @property
    def peak(self):
        """Largest value over the mean; 1 where the mean is not positive."""
        return max(self) / self.mean if self.mean > 0 else 1

    @property
    def cv(self):
        variance = sum(((v - self.mean) ** 2 for v in self), Fraction(0)) / len(self)
        return sqrt(variance) / float(self.mean) if self.mean > 0 else 0

    def share(self, test):
        return Fraction(sum(map(test, self)), len(self))


def _above(limit):
    return lambda v: v > Fraction(limit)


def session_metrics(runs: list[dict]) -> dict | None:
    """All 43 metrics plus total_runs; None for a session without runs."""
    if not runs:
        return None
    tokens, output, seconds, tools, errors = (
        Numbers(r[f] for r in runs) for f in
        ("total_tokens", "output_tokens", "execution_time", "tool_calls_count", "error_count"))
    rates = Numbers(t / x for t, x in zip(tokens, seconds) if x > 0)
    growth = [b / a for a, b in pairwise(tokens) if a > 0]
    steps = [b > a * Fraction(TH.time_jump_multiplier) for a, b in pairwise(seconds)]
    timeouts = Numbers(bool(r["has_timeout"]) for r in runs)
    good = Numbers(bool(r["success"]) for r in runs)
    streaks = [len(list(same)) for ok, same in groupby(bool(r["success"]) for r in runs) if not ok]
    spread = (max(rates) / min(rates) if min(rates) > 0 else 0) if rates else 0
    odd = rates.share(lambda v: v < TH.slow_tokens_per_second or v > TH.fast_tokens_per_second) if rates else 0
    late = seconds.share(_above(TH.extreme_time_limit))
    many = tools.share(_above(TH.excessive_tools_limit))
    flag = lambda value, limit: int(value > Fraction(limit))

    table = [(any(tokens), {
        "avg_total_tokens": lambda: tokens.mean, "max_total_tokens": lambda: max(tokens),
        "token_explosion_ratio": lambda: tokens.peak, "output_explosion_ratio": lambda: output.peak,
        "token_coefficient_variation": lambda: tokens.cv,
        "token_spike_frequency": lambda: tokens.share(_above(tokens.mean * Fraction(TH.token_spike_multiplier))),
        "max_token_growth_rate": lambda: max(growth, default=1),
        "explosive_growth_events": lambda: sum(map(_above(TH.explosive_growth), growth)),
        "extreme_token_flag": lambda: flag(max(tokens), TH.extreme_token_limit),
        "mega_explosion_flag": lambda: flag(max(tokens), TH.mega_explosion_limit),
    }), (any(seconds), {
        "avg_execution_time": lambda: seconds.mean, "max_execution_time": lambda: max(seconds),
        "timeout_frequency": lambda: timeouts.mean, "extreme_time_frequency": lambda: late,
        "execution_time_cv": lambda: seconds.cv, "time_explosion_events": lambda: sum(steps),
        "infinite_loop_risk_score": lambda: timeouts.mean + late, "timeout_flag": lambda: int(any(timeouts)),
        "extreme_duration_flag": lambda: flag(max(seconds), TH.long_duration_limit),
    }), (any(tools), {
        "avg_tool_calls": lambda: tools.mean, "max_tool_calls": lambda: max(tools), "total_tool_calls": lambda: sum(tools),
        "tool_explosion_ratio": lambda: tools.peak, "excessive_tools_frequency": lambda: many,
        "tool_chaos_score": lambda: many + Fraction(tools.peak) / Fraction(TH.tool_chaos_divisor),
        "tool_overuse_flag": lambda: flag(max(tools), TH.tool_overuse_limit),
        "tool_explosion_flag": lambda: flag(tools.peak, TH.explosive_growth),
    }), (bool(rates), {
        "avg_tokens_per_second": lambda: rates.mean, "min_tokens_per_second": lambda: min(rates),
        "max_tokens_per_second": lambda: max(rates), "speed_inconsistency_ratio": lambda: spread,
        "inconsistent_speed_frequency": lambda: odd, "temporal_chaos_score": lambda: odd,
        "speed_anomaly_flag": lambda: flag(spread, TH.speed_anomaly_ratio),
    }), (True, {
        "success_rate": lambda: good.mean, "failure_rate": lambda: 1 - good.mean,
        "max_consecutive_failures": lambda: max(streaks, default=0),
        "avg_errors_per_run": lambda: errors.mean, "total_errors": lambda: sum(errors),
        "systematic_failure_flag": lambda: flag(1 - good.mean, TH.systematic_failure_rate),
        "complete_breakdown_flag": lambda: int(good.mean < Fraction(str(TH.breakdown_success_rate))),
    })]
    out = dict.fromkeys(ALL_METRICS, 0.0) | {"max_token_growth_rate": 1.0, "total_runs": len(runs)}
    for applies, metrics in table:
        if applies:
            out |= {name: float(value()) for name, value in metrics.items()}
    return out
