"""Document plans: VARIANT session documents -> basic fields, runs, features.

Everything here is row-local (one document = one row): no shuffle. The
store bounds the size of a document, so a row never grows with the data.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from runlens.config import DEFAULT_THRESHOLDS, Thresholds
from runlens.functions.dates import rendered_dates
from runlens.functions.runs import RUN_FIELDS, dropping_nulls, null_metric_in, run_struct, valid_runs
from runlens.operators.derive import derive_metrics, with_ratios
from runlens.operators.flat_kernel import flat_run_statistics
from runlens.operators.nested_kernel import nested_statistics
from runlens.operators.run_metric import RunMetric, run_metrics
from runlens.session import shared_dir

ROW = "_row"
BASIC_COLUMNS = ["doc_key", "session_id", "created_at", "agent_name", "model_provider", "model_id", "user_id"]


def _get(doc: Column, path: str, typ: str) -> Column:
    return F.try_variant_get(doc, path, typ)


def _null_at(doc: Column, path: str) -> Column:
    return F.coalesce(F.is_variant_null(_get(doc, path, "variant")), F.lit(False))


def basic_fields(doc: Column) -> list[Column]:
    """Basic session fields; the flat layout (agent_name, model_provider,
    model_id at top level, ``_id`` as the session) is accepted as well."""
    text = lambda *paths: F.coalesce(*[_get(doc, p, "string") for p in paths], F.lit(""))
    flat_layout = _get(doc, "$.runs", "variant").isNotNull() | _get(doc, "$.agent_name", "variant").isNotNull()
    session_id = (
        F.when(_get(doc, "$.session_id", "variant").isNotNull(), text("$.session_id"))  # null -> ''
        .when(flat_layout, text("$._id"))  # the flat layout names the session by _id
        .otherwise(F.lit(""))
    )
    return [
        F.coalesce(_get(doc, "$._id", "string"), F.lit("")).alias("doc_key"),
        session_id.alias("session_id"),
        F.coalesce(_get(doc, "$.created_at", "double"), F.lit(0.0)).alias("created_at"),
        text("$.agent_data.name", "$.agent_name").alias("agent_name"),
        text("$.agent_data.model.provider", "$.model_provider").alias("model_provider"),
        text("$.agent_data.model.id", "$.model_id").alias("model_id"),
        text("$.user_id").alias("user_id"),
    ]


def raw_runs(doc: Column) -> Column:
    return F.coalesce(_get(doc, "$.memory.runs", "array<variant>"), _get(doc, "$.runs", "array<variant>"))


def quarantine_reason(doc: Column, raw: Column) -> Column:
    """Why a document cannot be processed, NULL when it can.

    Reads the raw runs with light checks only (validity and the three
    metrics), so a filter on the reason stays cheap wherever Catalyst
    pushes it."""
    return (
        F.when(_null_at(doc, "$.agent_data"), F.lit("agent_data_null"))
        .when(_null_at(doc, "$.agent_data.model"), F.lit("model_null"))
        .when(_null_at(doc, "$.memory"), F.lit("memory_null"))
        .when(null_metric_in(raw), F.lit("null_metric"))
    )


def normalize_documents(docs: DataFrame, doc_col: str = "doc") -> DataFrame:
    """Basic fields, ``runs`` (typed valid runs in order), ``raw_run_count``
    and ``quarantine_reason`` per document."""
    doc = F.col(doc_col)
    staged = docs.select(*basic_fields(doc), raw_runs(doc).alias("_raw"),
                         quarantine_reason(doc, raw_runs(doc)).alias("quarantine_reason"))
    return staged.select(
        *BASIC_COLUMNS,
        F.coalesce(F.size("_raw"), F.lit(0)).cast("long").alias("raw_run_count"),
        valid_runs(F.col("_raw")).alias("runs"),
        "quarantine_reason",
    )


def good_documents(norm: DataFrame) -> DataFrame:
    return norm.filter(F.col("quarantine_reason").isNull())


def quarantined_documents(norm: DataFrame) -> DataFrame:
    return norm.filter(F.col("quarantine_reason").isNotNull()).select(
        "doc_key", "session_id", "quarantine_reason")


def quarantined_runs(docs: DataFrame, doc_col: str = "doc") -> DataFrame:
    """Runs that the normaliser drops: document key, position in the document's run list (from 0) and the JSON path
    of the null; a run with several nulls gives a row for each. A missing or scalar run list has none."""
    doc = F.col(doc_col)
    nested = _get(doc, "$.memory.runs", "array<variant>")
    at = F.when(nested.isNotNull(), F.lit("$.memory.runs")).otherwise(F.lit("$.runs"))
    runs = docs.select(basic_fields(doc)[0], at.alias("_at"), F.posexplode(raw_runs(doc)).alias("pos", "_run"))
    nulls = runs.select("doc_key", F.col("pos").cast("long").alias("pos"), "_at", F.explode(dropping_nulls(F.col("_run"))).alias("_null"))
    return nulls.select("doc_key", "pos", F.concat("_at", F.lit("["), F.col("pos").cast("string"), F.lit("]"), "_null").alias("json_path"))


REASONS = ["agent_data_null", "model_null", "memory_null", "null_metric"]


def observed_documents(norm: DataFrame, seen: Observation) -> DataFrame:
    """``norm``, with its documents, those set aside by reason and the range of ``created_at`` of the good ones counted
    into ``seen`` by whatever job reads it next."""
    good = F.when(F.col("quarantine_reason").isNull(), F.col("created_at"))
    return norm.observe(seen, F.count(F.lit(1)).alias("documents"), F.min(good).alias("first"), F.max(good).alias("last"),
                        *[F.count(F.when(F.col("quarantine_reason") == r, F.lit(1))).alias(r) for r in REASONS])


def quarantine_counts(norm: DataFrame) -> dict[str, int]:
    """Set-aside documents by reason (at most one row per reason)."""
    rows = norm.filter(F.col("quarantine_reason").isNotNull()).groupBy("quarantine_reason").count().collect()
    return {reason: n for reason, n in rows}


def flat_projection(docs: DataFrame, doc_col: str = "doc") -> DataFrame:
    """The job's flat projection: session id from ``_id``, agent fields, time and ``runs`` (as in the document)."""
    doc = F.col(doc_col)
    fields = basic_fields(doc)
    return docs.select(
        F.try_variant_get(doc, "$._id", "string").alias("session_id"), fields[3], fields[4], fields[5],
        F.try_variant_get(doc, "$.created_at", "bigint").alias("created_at"), raw_runs(doc).alias("runs"))


def document_features(norm: DataFrame, th: Thresholds = DEFAULT_THRESHOLDS, digits: int | None = None,
                      metrics: list[str] | None = None, kernel: str = "nested",
                      chunk_bits: int = 16, tz: str = "UTC",
                      own_metrics: Sequence[RunMetric | str] | None = None) -> DataFrame:
    """Feature table of good documents: basic fields, ``total_runs``, metrics
    (NULL for a session without valid runs), ``date`` and ``timestamp``
    (present only when the session has runs and a non-zero ``created_at``).

    ``kernel="nested"`` (default) computes each document in its own row, no
    shuffle. ``kernel="flat"`` is for sessions too long to be handled as one
    row: the normalised documents are written once to the shared folder with a
    row number of their own (``_id`` may be missing or repeat), their runs are
    exploded with their position through the flat kernel, and the statistics
    are joined back by row number. Dates are rendered in ``tz``. ``own_metrics``
    are metrics with a state of their own, or their registered names.
    """
    good = good_documents(norm)
    own = run_metrics(own_metrics)
    if kernel == "nested":
        stats = nested_statistics(good, "runs", BASIC_COLUMNS, th, own)
    elif kernel == "flat":
        numbered = good.withColumn(ROW, F.monotonically_increasing_id())
        path = f"{shared_dir(norm.sparkSession)}/numbered-documents-{uuid.uuid4().hex}"
        numbered.write.parquet(path)
        numbered = norm.sparkSession.read.schema(numbered.schema).parquet(path)
        flat = flat_run_statistics(run_table(numbered, ROW), ROW, "pos", th=th, chunk_bits=chunk_bits, metrics=own)
        stats = numbered.select(ROW, *BASIC_COLUMNS).join(flat, ROW, "left")
    else:
        raise ValueError(f"unknown kernel {kernel!r}")
    stats = with_ratios(stats, th)
    date, stamp = rendered_dates(F.col("created_at"), tz)
    has_runs = F.coalesce(F.col("n_runs"), F.lit(0)) > 0
    return stats.select(
        *[c for c in BASIC_COLUMNS if c != "created_at"],
        F.col("created_at").cast("long").alias("created_at"),
        F.coalesce(F.col("n_runs"), F.lit(0)).cast("long").alias("total_runs"),
        *derive_metrics(metrics, th, digits),
        *[m.value(F.col(m.column)) for m in own],
        F.when(has_runs, date).alias("date"),
        F.when(has_runs, stamp).alias("timestamp"),
    )


def run_table(norm: DataFrame, key: str = "doc_key") -> DataFrame:
    """Flat run table (one row per valid run, ``pos`` from 0) of good documents."""
    exploded = good_documents(norm).select(key, F.posexplode("runs").alias("pos", "run"))
    return exploded.select(key, F.col("pos").cast("long").alias("pos"),
                           *[F.col("run")[f].alias(f) for f in RUN_FIELDS])


def typed_runs(records: DataFrame, run_col: str = "run") -> DataFrame:
    """Run records (one VARIANT run per row) -> typed valid runs."""
    typed = records.select("*", run_struct(F.col(run_col)).alias("_r")).drop(run_col)
    return typed.filter(F.col("_r")["valid"]).select(
        *[c for c in typed.columns if c != "_r"], *[F.col("_r")[f].alias(f) for f in RUN_FIELDS])
