"""Column builders that turn a run (a VARIANT value) into typed run fields.

Rules (the reference's per-run extraction):
  * a metric is a number or a list of numbers: a list gives its first
    element (0 if empty), a scalar gives itself, missing or null gives 0;
    a list whose first element is null gives NULL (the document is then
    quarantined with reason ``null_metric``)
  * success: status is 'RUNNING', or the text of the event list contains
    'RunCompleted' (case-sensitive); 'COMPLETED' alone is a failure
  * timeout: some event's text contains 'timeout' (any case)
  * error count: number of events whose text contains 'error' (any case)
  * tool calls: length of the tool list
  * a run whose ``metrics``, ``tools`` or ``events`` is an explicit null, or
    which is itself null, is invalid and dropped before any metric, so its
    neighbours become adjacent
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

RUN_FIELDS = ["total_tokens", "input_tokens", "output_tokens", "execution_time",
              "success", "tool_calls_count", "error_count", "has_timeout"]


def _sub(v: Column, path: str) -> Column:
    return F.try_variant_get(v, path, "variant")


def _explicit_null(v: Column) -> Column:
    """true for a JSON null, false for a value or a missing key."""
    return F.coalesce(F.is_variant_null(v), F.lit(False))


def metric_value(m: Column) -> Column:
    """First-or-scalar rule for one metric (VARIANT in, double out).

    Common cases take one probe: ``$[0]`` finds the first element of a list
    (a JSON null there reads as NULL), a number reads directly. Only a value
    that is neither — an empty list (0) or a non-number (NULL) — is cast to an
    array to tell the two apart."""
    first = F.try_variant_get(m, "$[0]", "variant")
    number = F.try_variant_get(m, "$", "double")
    empty_list = F.coalesce(F.size(F.try_variant_get(m, "$", "array<variant>")) == 0, F.lit(False))
    return (
        F.when(m.isNull(), F.lit(0.0))
        .when(first.isNotNull(), F.try_variant_get(first, "$", "double"))
        .when(F.is_variant_null(m), F.lit(0.0))
        .when(number.isNotNull(), number)
        .when(empty_list, F.lit(0.0))
    )


def _text(v: Column) -> Column:
    return F.lower(v.cast("string"))


def run_struct(r: Column) -> Column:
    """Typed run fields plus a ``valid`` flag, from one run VARIANT."""
    events = F.coalesce(F.try_variant_get(r, "$.events", "array<variant>"),
                        F.array().cast("array<variant>"))
    events_text = F.coalesce(_sub(r, "$.events").cast("string"), F.lit(""))
    tools = F.try_variant_get(r, "$.tools", "array<variant>")
    status = F.try_variant_get(r, "$.status", "string")
    valid = _run_valid(r)
    return F.struct(
        metric_value(_sub(r, "$.metrics.total_tokens")).alias("total_tokens"),
        metric_value(_sub(r, "$.metrics.input_tokens")).alias("input_tokens"),
        metric_value(_sub(r, "$.metrics.output_tokens")).alias("output_tokens"),
        metric_value(_sub(r, "$.metrics.time")).alias("execution_time"),
        (F.coalesce(status == F.lit("RUNNING"), F.lit(False))
         | events_text.contains("RunCompleted")).alias("success"),
        F.coalesce(F.size(tools), F.lit(0)).cast("long").alias("tool_calls_count"),
        F.size(F.filter(events, lambda e: _text(e).contains("error"))).cast("long").alias("error_count"),
        F.coalesce(F.exists(events, lambda e: _text(e).contains("timeout")), F.lit(False)).alias("has_timeout"),  # a null event is none
        valid.alias("valid"),
    )


# Fields whose explicit null drops a run; the run itself may be null as well.
_DROPPING = ["$", "$.metrics", "$.tools", "$.events"]


def _run_valid(r: Column) -> Column:
    return ~(
        _explicit_null(r)
        | _explicit_null(_sub(r, "$.metrics"))
        | _explicit_null(_sub(r, "$.tools"))
        | _explicit_null(_sub(r, "$.events"))
    )


def dropping_nulls(r: Column) -> Column:
    """Paths, below the run, of the nulls that make it invalid ('' for the run itself); empty for a valid run."""
    return F.array_compact(F.array(*[
        F.when(_explicit_null(r if path == "$" else _sub(r, path)), F.lit(path[1:])) for path in _DROPPING]))


def null_metric_in(runs_variant: Column) -> Column:
    """Some valid run has a total_tokens, output_tokens or time that reads as
    NULL (``[null]`` or not a number)."""
    return F.coalesce(F.exists(runs_variant, lambda r: _run_valid(r) & (
        metric_value(_sub(r, "$.metrics.total_tokens")).isNull()
        | metric_value(_sub(r, "$.metrics.output_tokens")).isNull()
        | metric_value(_sub(r, "$.metrics.time")).isNull()
    )), F.lit(False))


def valid_runs(runs_variant: Column) -> Column:
    """array<variant> of runs -> array of typed valid runs, order kept."""
    typed = F.transform(F.coalesce(runs_variant, F.array().cast("array<variant>")), run_struct)
    kept = F.filter(typed, lambda r: r["valid"])
    return F.transform(kept, lambda r: F.struct(*[r[f].alias(f) for f in RUN_FIELDS]))
