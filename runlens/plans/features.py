"""End-to-end feature plans: run table or session documents -> 43 metrics."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from runlens.config import DEFAULT_THRESHOLDS, Thresholds
from runlens.operators.derive import ORDERED_METRICS, derive_metrics, with_ratios
from runlens.operators.flat_kernel import flat_run_statistics
from runlens.operators.nested_kernel import nested_statistics
from runlens.operators.run_metric import RunMetric, run_metrics
from runlens.sources.run_table import RunTable, run_table_statistics


def features_from_runs(
    runs: DataFrame,
    key: str,
    order: Sequence[str] | str,
    metrics: list[str] | None = None,
    digits: int | None = None,
    th: Thresholds = DEFAULT_THRESHOLDS,
    chunk_bits: int = 16,
    strategy: str = "auto",
    extra_metrics: Mapping[str, Column] | None = None,
    own_metrics: Sequence[RunMetric | str] | None = None,
    staged: bool = False,
) -> DataFrame:
    """Flat layout: one row per session with ``total_runs`` and the metrics.

    Sessions appear only if they have at least one run; join the result to a
    session table (left) to keep sessions without runs. ``extra_metrics`` adds
    the caller's own columns over the base statistics (see ``derive_metrics``),
    ``own_metrics`` (or their registered names) metrics with a state of their own.
    """
    own = run_metrics(own_metrics)
    ordered = metrics is None or bool(ORDERED_METRICS & set(metrics)) or bool(extra_metrics)
    stats = with_ratios(flat_run_statistics(runs, key, order, th=th, chunk_bits=chunk_bits, strategy=strategy,
                                            ordered=ordered, staged=staged, metrics=own), th)
    return stats.select(
        F.col(key).alias("session_key"),
        F.col("n_runs").cast("long").alias("total_runs"),
        *derive_metrics(metrics, th, digits, extra_metrics), *[m.value(F.col(m.column)) for m in own],
    )


def features_from_run_table(table: RunTable, metrics: list[str] | None = None, digits: int | None = None,
                            th: Thresholds = DEFAULT_THRESHOLDS, extra_metrics: Mapping[str, Column] | None = None,
                            own_metrics: Sequence[RunMetric | str] | None = None) -> DataFrame:
    """``features_from_runs`` over a stored run table (``sources.run_table``): ordinary sessions need no exchange."""
    own = run_metrics(own_metrics)
    stats = with_ratios(run_table_statistics(table, th, own), th)
    return stats.select(F.col(table.key).alias("session_key"), F.col("n_runs").cast("long").alias("total_runs"),
                        *derive_metrics(metrics, th, digits, extra_metrics), *[m.value(F.col(m.column)) for m in own])


def features_from_nested(
    sessions: DataFrame,
    runs_col: str = "runs",
    keep: Sequence[str] = (),
    metrics: list[str] | None = None,
    digits: int | None = None,
    th: Thresholds = DEFAULT_THRESHOLDS,
    extra_metrics: Mapping[str, Column] | None = None,
    own_metrics: Sequence[RunMetric | str] | None = None,
) -> DataFrame:
    """Nested layout: each row carries its (valid, ordered) runs; row-local."""
    own = run_metrics(own_metrics)
    stats = with_ratios(nested_statistics(sessions, runs_col, keep, th, own), th)
    return stats.select(
        *keep,
        F.coalesce(F.col("n_runs"), F.lit(0)).cast("long").alias("total_runs"),
        *derive_metrics(metrics, th, digits, extra_metrics), *[m.value(F.col(m.column)) for m in own],
    )
