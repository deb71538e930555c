"""Query catalog: every implemented operator as a (spark, sf_dir) -> DataFrame
callable, each with an independent DuckDB oracle where SQL can express it.

Every query reads the driver tables in full (no id subsets or row caps).
"""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from runlens.config import (ALL_METRICS, EMPTY_EXPORT_ROW, EXPORT_COLUMNS, FAILURE_METRICS, SPEED_METRICS, TIME_METRICS,
                            TOKEN_METRICS, TOOL_METRICS)
from runlens.functions.dates import default_range, range_bounds, rendered_dates, request_error
from runlens.functions.variant_schema import infer_schema, typed_copy
from runlens.plans import oracle_sql as O
from runlens.plans.documents import (document_features, flat_projection, normalize_documents, quarantined_documents,
                                     quarantined_runs, run_table, typed_runs)
from runlens.plans.export import (EXPORT_METADATA, export_frame, export_manifest, export_path, extraction_summary,
                                  read_export, training_rows, write_training_export)
from runlens.operators.derive import INT_METRICS, LONG_METRICS
from runlens.operators.restrict import restrict_to_keys
from runlens.plans.features import features_from_run_table, features_from_runs
from runlens.session import shared_dir, tune_session
from runlens.sources.documents import (document_sessions, document_sessions_json, event_run_records, landing_batches,
                                       typed_document_sessions)
from runlens.sources import documents, shredded
from runlens.sources import run_table as stored_runs
from runlens.sources.landing import land_folder, upsert_sessions
from runlens.sources.run_table import write_run_table
from runlens.sources.zone_map import read_json_range
from runlens.sources.tables import (LINEITEM_ORDER, conversation_runs, lineitem_runs,
                                    order_sessions, table)

Query = Callable[[SparkSession, str], DataFrame]

# --- fixed parameters of the registered queries ---------------------------------
DOC_RANGE = ("2024-01-20", "2024-02-10")  # B5 documents span 2024-01-01 .. 2024-03-30
EMPTY_RANGE = ("2030-01-01", "2030-01-31")  # no document falls in it
ORDER_RANGE = ("1996-01-01", "1996-03-31")
DIGITS = 6  # the queries and their oracles round doubles; the job's export does not
AS_OF = dt.date(1998, 3, 31)  # default range: 1998-02-28 .. 1998-03-30


# ---------------------------------------------------------------- B1 lineitem
def _lineitem_features(metrics: list[str] | None = None, with_runs: bool = True) -> Query:
    def q(spark: SparkSession, sf_dir: str) -> DataFrame:
        df = features_from_runs(lineitem_runs(spark, sf_dir), "session_key", LINEITEM_ORDER,
                                metrics=metrics, digits=DIGITS)
        keep = ["session_key"] + (["total_runs"] if with_runs else []) + \
            (ALL_METRICS if metrics is None else metrics)
        return df.select(*keep)
    return q


def _lineitem_sql(metrics: list[str] | None = None, with_runs: bool = True) -> str:
    return O.features_sql(O.LINEITEM_RUNS_SQL, "k", metrics, with_runs)


def stored_session_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``session_features`` from a run table that is stored in buckets, in run order (written once)."""
    path = land_folder(spark, "lineitem-runs", [f"{sf_dir.rstrip('/')}/lineitem.parquet"], stored_runs,
                       lambda tmp: write_run_table(lineitem_runs(spark, sf_dir), tmp, "session_key", LINEITEM_ORDER))
    return features_from_run_table(stored_runs.open_run_table(spark, path), digits=DIGITS)


OWN_METRICS = ["longest_token_rise", "deepest_token_fall"]


def run_rises(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two metrics with a state of their own (order-dependent, mergeable) through the flat kernel."""
    df = features_from_runs(lineitem_runs(spark, sf_dir), "session_key", LINEITEM_ORDER, metrics=[], own_metrics=OWN_METRICS)
    return df.select("session_key", *OWN_METRICS)


# ------------------------------------------------------------ B3 conversations
def conversation_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    return features_from_runs(conversation_runs(spark, sf_dir), "session_key", "turn", digits=DIGITS)


# ---------------------------------------------------------------- B2 events
def _event_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return typed_runs(event_run_records(spark, sf_dir))


def normalize_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _event_runs(spark, sf_dir).select(
        "session_key", "pos", "total_tokens", "input_tokens", "output_tokens", "execution_time",
        "success", "tool_calls_count", "error_count", "has_timeout")


def _shredded_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = land_folder(spark, "events-shredded", [f"{sf_dir.rstrip('/')}/events.parquet"], shredded,
                       lambda tmp: shredded.shredded_runs(event_run_records(spark, sf_dir)).write.parquet(tmp))
    return spark.read.parquet(path)


def shredded_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``normalize_runs`` from the shredded run records."""
    return shredded.typed_shredded_runs(_shredded_events(spark, sf_dir), ["session_key", "pos"])


def shredded_run_success(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``run_success`` from the shredded run records: reads the leaves of status and events only."""
    return shredded.typed_shredded_runs(_shredded_events(spark, sf_dir), ["session_key", "pos"], ["success"])


def run_success(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _event_runs(spark, sf_dir).select("session_key", "pos", "success")


def run_timeouts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _event_runs(spark, sf_dir).select("session_key", "pos", "has_timeout")


def run_errors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _event_runs(spark, sf_dir).select("session_key", "pos", "error_count")


def event_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    return features_from_runs(_event_runs(spark, sf_dir), "session_key", "pos", digits=DIGITS, staged=True)


# ------------------------------------------------------------- B5 documents
def _norm(spark: SparkSession, sf_dir: str) -> DataFrame:
    return normalize_documents(document_sessions(spark, sf_dir))


def _nullable_ints_as_double(df: DataFrame) -> DataFrame:
    """Integer metrics are NULL for sessions without runs; as doubles they
    compare the same way in every client (a nullable integer column becomes
    float in one and a nullable integer type in another)."""
    return df.select(*[F.col(c).cast("double").alias(c) if c in INT_METRICS | LONG_METRICS else F.col(c)
                       for c in df.columns])


def document_features_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _nullable_ints_as_double(document_features(_norm(spark, sf_dir), digits=DIGITS))


def quarantine_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Dropped runs with their place in the document and the JSON path of the null that dropped them."""
    return quarantined_runs(document_sessions(spark, sf_dir))


def landed_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two batches of documents that share days and the day-less ones, landed one after the other: the newest version of
    each document, on its present day."""
    target = f"{shared_dir(spark)}/upsert-{uuid.uuid4().hex}"
    for batch in landing_batches(spark, sf_dir):
        upsert_sessions(batch, target)
    rows = spark.read.parquet(target)
    return rows.select("doc_key", F.col("date").cast("string").alias("date"), F.col("created_at").cast("long").alias("created_at"),
                       F.try_variant_get("doc", "$.user_id", "string").alias("user_id"))


def quarantine_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quarantined_documents(_norm(spark, sf_dir))


def _docs_in_range(spark: SparkSession, sf_dir: str, start: str, end: str) -> DataFrame:
    return document_sessions(spark, sf_dir, start, end)


def scan_sessions(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _docs_in_range(spark, sf_dir, *DOC_RANGE)
    return docs.select(F.try_variant_get("doc", "$._id", "string").alias("doc_key"),
                       F.try_variant_get("doc", "$.created_at", "bigint").alias("created_at"))


def zone_map_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``scan_sessions`` from raw JSON files: a zone map names the files that overlap the range."""
    path = land_folder(spark, "documents-json", [f"{sf_dir.rstrip('/')}/documents.parquet"], documents, lambda tmp: (
        document_sessions_json(spark, sf_dir).withColumn("at", F.get_json_object("json", "$.created_at").cast("long"))
        .repartitionByRange(16, "at").select(F.col("json").alias("value")).write.text(tmp)))
    docs = read_json_range(spark, path, f"{path}-zones", *DOC_RANGE)
    return docs.select(F.try_variant_get("doc", "$._id", "string").alias("doc_key"),
                       F.try_variant_get("doc", "$.created_at", "bigint").alias("created_at"))


def infer_schema_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The schema of the session documents: one row per path with the counts of its types."""
    return infer_schema(document_sessions(spark, sf_dir)).drop("n_other", "whole")


def typed_by_schema(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A typed copy of the session documents, by the inferred schema, landed and read for its basic fields and run count."""
    docs = document_sessions(spark, sf_dir)
    path = f"{shared_dir(spark)}/typed-copy-{uuid.uuid4().hex}"
    typed_copy(docs, infer_schema(docs)).write.parquet(path)
    return spark.read.parquet(path).select(
        F.col("_id").alias("session_id"), F.coalesce("agent_data.name", F.lit("")).alias("agent_name"),
        F.coalesce("agent_data.model.provider", F.lit("")).alias("model_provider"), F.coalesce("agent_data.model.id", F.lit("")).alias("model_id"),
        "created_at", F.coalesce(F.size("memory.runs"), F.lit(0)).cast("long").alias("run_count"))


def project_sessions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The job's flat projection: session id from ``_id``, agent fields, time, runs."""
    rows = flat_projection(document_sessions(spark, sf_dir))
    return rows.withColumn("run_count", F.coalesce(F.size("runs"), F.lit(0)).cast("long")).drop("runs")


def basic_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    norm = _norm(spark, sf_dir).filter(F.col("quarantine_reason").isNull())
    return norm.select("doc_key", "session_id", "agent_name", "model_provider", "model_id", "user_id",
                       F.col("created_at").cast("long").alias("created_at"))


def format_timestamps(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = order_sessions(spark, sf_dir)
    date, stamp = rendered_dates(F.col("created_at"))
    return s.select("session_id", "created_at", date.alias("date"), stamp.alias("timestamp"))


def document_features_flat(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Same table as ``document_features`` through the flat (chunked) kernel."""
    return _nullable_ints_as_double(document_features(_norm(spark, sf_dir), kernel="flat", digits=DIGITS))


def document_rises(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same two metrics through the nested kernel (sessions without runs have none)."""
    df = document_features(_norm(spark, sf_dir), metrics=[], own_metrics=OWN_METRICS)
    return df.where("total_runs > 0").select("doc_key", *OWN_METRICS)


def document_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return run_table(_norm(spark, sf_dir))


def training_export(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _docs_in_range(spark, sf_dir, *DOC_RANGE)
    return training_rows(document_features(normalize_documents(docs), digits=DIGITS))


def empty_export(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _docs_in_range(spark, sf_dir, *EMPTY_RANGE)
    return export_frame(spark, document_features(normalize_documents(docs), digits=DIGITS))


def extraction_summary_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _docs_in_range(spark, sf_dir, *DOC_RANGE)
    good = normalize_documents(docs).filter(F.col("quarantine_reason").isNull())
    return extraction_summary(good, *DOC_RANGE)


def export_manifest_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _docs_in_range(spark, sf_dir, *DOC_RANGE)
    feats = document_features(normalize_documents(docs), digits=DIGITS)
    root = f"{shared_dir(spark)}/exports/{uuid.uuid4().hex}"
    path = write_training_export(spark, feats, root, *DOC_RANGE)
    return export_manifest(spark, path).select(
        "rows", "success", F.expr(f"substring(location, {len(root) + 2})").alias("layout"), *EXPORT_METADATA)


def csv_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The training export as read back from its CSV files."""
    docs = _docs_in_range(spark, sf_dir, *DOC_RANGE)
    feats = document_features(normalize_documents(docs), digits=DIGITS)
    path = write_training_export(spark, feats, f"{shared_dir(spark)}/exports/{uuid.uuid4().hex}", *DOC_RANGE)
    back, types = read_export(spark, path), dict(training_rows(feats).dtypes)
    if "message" in back.columns:  # an empty range: the placeholder has no training rows
        return training_rows(feats).limit(0)
    return back.select(*[F.coalesce(F.col(c), F.lit("")).cast(types[c]).alias(c) for c in EXPORT_COLUMNS])


def typed_sessions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Features of documents from a typed source, where a NULL field is a missing key."""
    norm = normalize_documents(typed_document_sessions(spark, sf_dir))
    return _nullable_ints_as_double(document_features(norm, digits=DIGITS))


# ------------------------------------------------------------------ B4 orders
def date_range_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return order_sessions(spark, sf_dir, *ORDER_RANGE).select("session_id", "created_at")


def default_date_range(spark: SparkSession, sf_dir: str) -> DataFrame:
    start, end = default_range(AS_OF)
    s = order_sessions(spark, sf_dir, start, end)
    return s.select(
        "session_id", "created_at", F.lit(start).alias("start_date"), F.lit(end).alias("end_date"))


def order_requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Extraction requests derived from orders, some of them malformed."""
    o = table(spark, sf_dir, "orders")
    key, day = F.col("o_orderkey"), F.col("o_orderdate")
    m = key % 23
    start = (
        F.when(m == 1, F.lit(None).cast("string"))
        .when(m == 3, F.lit(""))
        .when(m == 4, F.date_format(day, "yyyy-M-d"))
        .when(m == 5, F.concat(F.year(day).cast("string"), F.lit("-02-30")))
        .otherwise(F.date_format(day, "yyyy-MM-dd"))
    )
    end_day = F.date_add(day.cast("date"), (key % 40 - 10).cast("int"))
    end = (
        F.when(m == 2, F.lit(None).cast("string"))
        .when(m == 6, F.date_format(end_day, "yyyy/MM/dd"))
        .otherwise(F.date_format(end_day, "yyyy-MM-dd"))
    )
    return o.select(key.alias("request_id"), start.alias("start_date"), end.alias("end_date"))


def validate_requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    r = order_requests(spark, sf_dir)
    return r.select("request_id", "start_date", "end_date",
                    request_error(F.col("start_date"), F.col("end_date")).alias("error"))


def order_training_export(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sessions of a date range (orders) with features of their runs
    (line items), as the 48 export columns. Runs are cut to the sessions of
    the range before the kernel's shuffle."""
    sessions = order_sessions(spark, sf_dir, *ORDER_RANGE)
    runs = restrict_to_keys(lineitem_runs(spark, sf_dir), sessions, "session_key", "_id_key")
    feats = features_from_runs(runs, "session_key", LINEITEM_ORDER, digits=DIGITS)
    joined = sessions.join(feats, sessions["_id_key"] == feats["session_key"], "left")
    return training_rows(joined)


# ---------------------------------------------------------------- registries
def _tuned(fn: Query) -> Query:
    def q(spark: SparkSession, sf_dir: str) -> DataFrame:
        tune_session(spark)
        return fn(spark, sf_dir)
    q.__name__ = getattr(fn, "__name__", "query")
    q.__doc__ = fn.__doc__
    return q


def queries() -> dict[str, Query]:
    return {name: _tuned(fn) for name, fn in _queries().items()}


def _queries() -> dict[str, Query]:
    return {
        "session_features": _lineitem_features(),
        "token_metrics": _lineitem_features(TOKEN_METRICS, with_runs=False),
        "time_metrics": _lineitem_features(TIME_METRICS, with_runs=False),
        "tool_metrics": _lineitem_features(TOOL_METRICS, with_runs=False),
        "speed_metrics": _lineitem_features(SPEED_METRICS, with_runs=False),
        "failure_metrics": _lineitem_features(FAILURE_METRICS, with_runs=False),
        "run_counts": _lineitem_features([], with_runs=True),
        "run_growth": _lineitem_features(["max_token_growth_rate", "explosive_growth_events"], with_runs=False),
        "run_time_jumps": _lineitem_features(["time_explosion_events"], with_runs=False),
        "run_spikes": _lineitem_features(["token_spike_frequency"], with_runs=False),
        "failure_streaks": _lineitem_features(["max_consecutive_failures"], with_runs=False),
        "stored_session_features": stored_session_features,
        "run_rises": run_rises,
        "conversation_features": conversation_features,
        "normalize_runs": normalize_runs,
        "run_success": run_success,
        "shredded_runs": shredded_runs,
        "shredded_run_success": shredded_run_success,
        "run_timeouts": run_timeouts,
        "run_errors": run_errors,
        "event_features": event_features,
        "document_features": document_features_q,
        "document_features_flat": document_features_flat,
        "document_runs": document_runs,
        "document_rises": document_rises,
        "quarantine_documents": quarantine_documents,
        "quarantine_runs": quarantine_runs,
        "landed_upsert": landed_upsert,
        "scan_sessions": scan_sessions,
        "zone_map_scan": zone_map_scan,
        "infer_schema": infer_schema_q,
        "typed_by_schema": typed_by_schema,
        "project_sessions": project_sessions,
        "basic_features": basic_features,
        "format_timestamps": format_timestamps,
        "date_range_filter": date_range_filter,
        "default_date_range": default_date_range,
        "validate_requests": validate_requests,
        "training_export": training_export,
        "order_training_export": order_training_export,
        "empty_export": empty_export,
        "extraction_summary": extraction_summary_q,
        "export_manifest": export_manifest_q,
        "csv_round_trip": csv_round_trip,
        "typed_sessions": typed_sessions,
    }


def oracle_sql() -> dict[str, str]:
    return {
        "session_features": _lineitem_sql(),
        "token_metrics": _lineitem_sql(TOKEN_METRICS, False),
        "time_metrics": _lineitem_sql(TIME_METRICS, False),
        "tool_metrics": _lineitem_sql(TOOL_METRICS, False),
        "speed_metrics": _lineitem_sql(SPEED_METRICS, False),
        "failure_metrics": _lineitem_sql(FAILURE_METRICS, False),
        "run_counts": _lineitem_sql([], True),
        "run_growth": _lineitem_sql(["max_token_growth_rate", "explosive_growth_events"], False),
        "run_time_jumps": _lineitem_sql(["time_explosion_events"], False),
        "run_spikes": _lineitem_sql(["token_spike_frequency"], False),
        "failure_streaks": _lineitem_sql(["max_consecutive_failures"], False),
        "stored_session_features": _lineitem_sql(),
        "run_rises": O.rises_sql(O.LINEITEM_RUNS_SQL, "session_key"),
        "conversation_features": O.features_sql(O.CONVERSATION_RUNS_SQL, "k"),
        "normalize_runs": O.EVENT_RUNS_SELECT,
        "run_success": f"SELECT session_key, pos, success FROM ({O.EVENT_RUNS_SELECT})",
        "run_timeouts": f"SELECT session_key, pos, has_timeout FROM ({O.EVENT_RUNS_SELECT})",
        "run_errors": f"SELECT session_key, pos, error_count FROM ({O.EVENT_RUNS_SELECT})",
        "event_features": O.features_sql(O.EVENT_RUNS_SQL, "k"),
        "document_features": O.document_features_sql(ints_as_double=True),
        "document_features_flat": O.document_features_sql(ints_as_double=True),
        "document_runs": O.DOCUMENT_RUNS_SELECT,
        "document_rises": O.rises_sql(f"{O.DOC_STAT_RUNS} JOIN good g USING (doc_key)", "doc_key", f"{O.DOC_CTES},"),
        "quarantine_documents": O.QUARANTINE_SQL,
        "quarantine_runs": O.QUARANTINE_RUNS_SQL,
        "landed_upsert": O.LANDED_UPSERT_SQL,
        "scan_sessions": O.scan_sessions_sql(*range_bounds(*DOC_RANGE)),
        "zone_map_scan": O.scan_sessions_sql(*range_bounds(*DOC_RANGE)),
        "infer_schema": O.INFER_SCHEMA_SQL,
        "typed_by_schema": O.PROJECT_SESSIONS_SQL,
        "shredded_runs": O.EVENT_RUNS_SELECT,
        "shredded_run_success": f"SELECT session_key, pos, success FROM ({O.EVENT_RUNS_SELECT})",
        "project_sessions": O.PROJECT_SESSIONS_SQL,
        "basic_features": O.BASIC_FEATURES_SQL,
        "format_timestamps": O.FORMAT_TIMESTAMPS_SQL,
        "date_range_filter": O.order_range_sql(*range_bounds(*ORDER_RANGE)),
        "default_date_range": O.default_range_sql(AS_OF.isoformat()),
        "validate_requests": O.VALIDATE_REQUESTS_SQL,
        "training_export": O.training_export_sql(*range_bounds(*DOC_RANGE)),
        "order_training_export": O.order_training_export_sql(*range_bounds(*ORDER_RANGE)),
        "empty_export": O.empty_export_sql(*range_bounds(*EMPTY_RANGE), *EMPTY_EXPORT_ROW),
        "csv_round_trip": O.training_export_sql(*range_bounds(*DOC_RANGE)),
        "typed_sessions": O.document_features_sql(ints_as_double=True, ctes=O.TYPED_CTES),
        "export_manifest": O.export_manifest_sql(*range_bounds(*DOC_RANGE), export_path("", *DOC_RANGE).lstrip("/"), EXPORT_METADATA),
        "extraction_summary": O.extraction_summary_sql(*DOC_RANGE, *range_bounds(*DOC_RANGE)),
    }


FLAGSHIP = "session_features"
