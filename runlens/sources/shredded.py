"""Shredded run records: typed leaves beside a VARIANT rest.

A run record (one VARIANT run per row) is written with a column per leaf that the run
fields are made of, so a query reads only the leaves of its fields. Each leaf keeps its kind:

  <leaf>        the typed value (number as double, text as string, list of texts)
  <leaf>_list   a metric that is a list: its numbers, nulls included
  <leaf>_rest   VARIANT of any other value, JSON null included; NULL if the typed
                column holds it or the key is missing

so scalar, list, null and missing are told apart (``leaf_kind``) and every field comes
out as from the VARIANT itself (``functions.runs``). ``valid`` says whether the run counts.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from runlens.functions.runs import RUN_FIELDS, metric_value, run_struct

METRICS = {"total_tokens": "$.metrics.total_tokens", "input_tokens": "$.metrics.input_tokens",
           "output_tokens": "$.metrics.output_tokens", "execution_time": "$.metrics.time"}
LEAVES = [*METRICS, "status", "tools", "events"]


def _metric_leaf(run: Column, name: str) -> list[Column]:
    v = F.try_variant_get(run, METRICS[name], "variant")
    kind = F.schema_of_variant(v)
    number = F.when(kind.isin("BIGINT", "DOUBLE", "FLOAT") | kind.startswith("DECIMAL"), F.try_variant_get(v, "$", "double"))
    items = F.when(kind.startswith("ARRAY<"), F.try_variant_get(v, "$", "array<double>"))
    return [number.alias(name), items.alias(f"{name}_list"), F.when(number.isNull() & items.isNull(), v).alias(f"{name}_rest")]


def _status_leaf(run: Column) -> list[Column]:
    v = F.try_variant_get(run, "$.status", "variant")
    text = F.when(F.schema_of_variant(v) == "STRING", F.try_variant_get(v, "$", "string"))
    return [text.alias("status"), F.when(text.isNull(), v).alias("status_rest")]


def _list_leaf(run: Column, name: str, element: Column) -> list[Column]:
    v = F.try_variant_get(run, f"$.{name}", "variant")
    return [element.alias(name), F.when(element.isNull(), v).alias(f"{name}_rest")]


def shredded_runs(records: DataFrame, run_col: str = "run") -> DataFrame:
    """Run records with their leaves instead of the run."""
    run = F.col(run_col)
    tools = F.size(F.try_variant_get(run, "$.tools", "array<variant>")).cast("long")
    events = F.transform(F.try_variant_get(run, "$.events", "array<variant>"), lambda e: e.cast("string"))
    leaves = [c for name in METRICS for c in _metric_leaf(run, name)] + _status_leaf(run) + \
        _list_leaf(run, "tools", F.when(tools >= 0, tools)) + _list_leaf(run, "events", events)
    return records.select(*[c for c in records.columns if c != run_col], run_struct(run)["valid"].alias("valid"), *leaves)


def leaf_kind(name: str) -> Column:
    """value, list, null, odd (a value of another type) or missing."""
    listed = F.col(f"{name}_list").isNotNull() if name in METRICS else F.lit(False)
    rest = F.col(f"{name}_rest")
    return (F.when(F.col(name).isNotNull(), "value").when(listed, "list").when(rest.isNull(), "missing")
            .when(F.is_variant_null(rest), "null").otherwise("odd"))


def _metric(name: str) -> Column:
    number, items, rest = F.col(name), F.col(f"{name}_list"), F.col(f"{name}_rest")
    return (F.when(number.isNotNull(), number)
            .when(items.isNotNull(), F.when(F.size(items) > 0, F.get(items, F.lit(0))).otherwise(F.lit(0.0)))
            .otherwise(metric_value(rest)))


def run_fields() -> dict[str, Column]:
    """The typed run fields from the leaves; a field reads its own leaves only."""
    texts = F.coalesce("events", F.array().cast("array<string>"))
    low = lambda e: F.lower(e)
    # the text of the whole list holds a text if an event does, whatever an event's type
    done = F.exists(texts, lambda e: F.coalesce(e.contains("RunCompleted"), F.lit(False))) | \
        F.coalesce(F.col("events_rest").cast("string").contains("RunCompleted"), F.lit(False))
    status = F.coalesce(F.col("status"), F.try_variant_get("status_rest", "$", "string"))
    return {
        **{name: _metric(name) for name in METRICS},
        "success": F.coalesce(status == "RUNNING", F.lit(False)) | done,
        "tool_calls_count": F.coalesce("tools", F.lit(0).cast("long")),
        "error_count": F.size(F.filter(texts, lambda e: F.coalesce(low(e).contains("error"), F.lit(False)))).cast("long"),
        "has_timeout": F.exists(texts, lambda e: F.coalesce(low(e).contains("timeout"), F.lit(False))),
    }


def typed_shredded_runs(rows: DataFrame, keep: list[str], fields: list[str] = RUN_FIELDS) -> DataFrame:
    """``keep`` and typed fields of valid runs from shredded records."""
    made = run_fields()
    return rows.where("valid").select(*keep, *[made[f].alias(f) for f in fields])
