"""Session-document sources.

The canonical input is a collection of session documents (one JSON object
per session, runs nested under ``memory.runs``). Documents are read into one
VARIANT column ``doc`` so that "scalar or list" and "null or missing" survive
the read — a typed JSON schema would silently turn a scalar metric into NULL.

``read_sessions`` handles four kinds of source:
  * ``json``     JSON lines, read with ``singleVariantColumn``
  * ``landed``   VARIANT documents in Parquet partitioned by day
                 (``landing.land_sessions``): a range prunes partitions and
                 pushes its epoch bounds into the scan
  * ``parquet``  documents landed with a typed schema, where a NULL is a missing
                 key; only the fields features use are read, and the date
                 filter runs on the typed ``created_at`` column, in the scan
  * any other format name (a document-store connector, when it is on the
    class path), with options passed through; handled like ``parquet``

Test bindings (derived row by row from the driver tables, no grouping; landed
once as JSON lines under the shared folder, see ``landing``):
  B5 ``documents`` -> one session document per row; runs are the text's lines
  B2 ``events``    -> one run record per event; session = (user, day); landed
                      as Parquet with the run as a VARIANT column
"""

from __future__ import annotations

import sys

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from runlens.functions.dates import range_bounds
from runlens.sources.landing import land_parquet, land_sessions
from runlens.sources.tables import table


def read_sessions(
    spark: SparkSession,
    path: str | None = None,
    fmt: str = "json",
    start: str | None = None,
    end: str | None = None,
    tz: str = "UTC",
    **options: str,
) -> DataFrame:
    """Session documents as one VARIANT column ``doc``, optionally cut to a date range."""
    reader = spark.read.options(**options)
    if fmt == "landed":
        df = reader.parquet(path)
        if start is not None:
            lo, hi = range_bounds(start, end, tz)
            pad = 0 if tz == "UTC" else 1  # partitions are UTC days
            first = F.date_sub(F.lit(start).cast("date"), pad)
            last = F.date_add(F.lit(end).cast("date"), pad)
            df = df.filter((F.col("date") >= first) & (F.col("date") <= last)
                           & (F.col("created_at") >= lo) & (F.col("created_at") <= hi))
        return df.select("doc")
    if fmt == "json":
        df = reader.option("singleVariantColumn", "doc").json(path)
        if start is not None:
            lo, hi = range_bounds(start, end, tz)
            created = F.try_variant_get("doc", "$.created_at", "double")
            df = df.filter((created >= lo) & (created <= hi))
        return df
    load = lambda r: r.load(path) if path else r.load()
    # only the fields the features use are read
    df = load(reader.format(fmt).schema(pruned_schema(load(reader.format(fmt)).schema)))
    if start is not None:
        lo, hi = range_bounds(start, end, tz)
        df = df.filter((F.col("created_at") >= lo) & (F.col("created_at") <= hi))
    # a typed source cannot tell a missing key from a null: NULL fields are left out, as missing keys
    return df.select(F.parse_json(F.to_json(F.struct(*[F.col(f"`{c}`") for c in df.columns]))).alias("doc"))


# Fields of a session document that features read; None: the whole field.
_RUN_FIELDS = {"status": None, "tools": None, "events": None,
               "metrics": {"total_tokens": None, "input_tokens": None, "output_tokens": None, "time": None}}
_SESSION_FIELDS = {
    "_id": None, "session_id": None, "created_at": None, "user_id": None, "agent_name": None, "model_provider": None,
    "model_id": None, "agent_data": {"name": None, "model": {"provider": None, "id": None}},
    "memory": {"runs": _RUN_FIELDS}, "runs": _RUN_FIELDS,
}


def pruned_schema(schema: T.StructType, wanted: dict = _SESSION_FIELDS) -> T.StructType:
    """The part of a typed schema that ``wanted`` names (inside arrays of structs as well)."""
    def cut(kind: T.DataType, fields: dict | None) -> T.DataType:
        if fields is None:
            return kind
        if isinstance(kind, T.ArrayType):
            return T.ArrayType(cut(kind.elementType, fields), kind.containsNull)
        return pruned_schema(kind, fields) if isinstance(kind, T.StructType) else kind

    return T.StructType([T.StructField(f.name, cut(f.dataType, wanted[f.name]), True) for f in schema if f.name in wanted])


def landed_layout(docs: DataFrame, doc_col: str = "doc") -> DataFrame:
    """``same`` (what makes two documents versions of one: the key, without a key the whole text), ``doc_key`` (the
    document's ``_id``), ``created_at`` (double, as in the document), ``date`` (its UTC day, the partition column) and
    the document itself."""
    doc = F.col(doc_col)
    key = F.try_variant_get(doc, "$._id", "string")
    created = F.try_variant_get(doc, "$.created_at", "double")
    day = F.date_add(F.lit("1970-01-01").cast("date"), F.floor(created / 86400).cast("int"))
    same = F.coalesce(F.concat(F.lit("k"), key), F.concat(F.lit("t"), F.sha2(F.to_json(doc), 256)))
    return docs.select(same.alias("same"), key.alias("doc_key"), created.alias("created_at"), day.alias("date"), doc.alias("doc"))


# --- B5: documents -> session documents ----------------------------------------
EPOCH_2024 = 1704067200  # 2024-01-01 00:00:00 UTC


def _num(c: Column) -> Column:
    return c.cast("string")


def _line_run_json(line: Column, i: Column, d: Column) -> Column:
    """JSON text of the run made from line ``i`` (1-based) of document ``d``."""
    n = F.length(line)
    spaces = n - F.length(F.regexp_replace(line, " ", ""))
    total = (
        F.when(n % 17 == 5, F.lit("[]"))
        .when((d + i) % 2 == 1, F.concat(F.lit("["), _num(n), F.lit("]")))
        .otherwise(_num(n))
    )
    time = F.when((d % 37 == 3) & (i == 1), F.lit("[null]")).otherwise(
        F.concat(F.lit("["), _num((n % 7) * F.lit(0.5)), F.lit("]")))
    tools = F.when((d + i) % 29 == 0, F.lit("null")).otherwise(
        F.to_json(F.array_repeat(F.lit("search"), (n % 13).cast("int"))))
    events = F.concat(
        F.lit("["),
        F.concat_ws(
            ",",
            F.when(n % 5 == 1, F.lit('"RunCompleted"')),
            F.when(n % 11 == 2, F.lit('"Gateway TIMEOUT"')),
            F.when(n % 4 == 3, F.lit('"Error in step", {"error": null}')),
        ),
        F.lit("]"),
    )
    status = F.when(n % 3 == 0, F.lit("RUNNING")).otherwise(F.lit("COMPLETED"))
    return F.concat(
        F.lit('{"status":"'), status, F.lit('","metrics":{"total_tokens":'), total,
        F.lit(',"input_tokens":'), _num(n % 10),
        F.lit(',"output_tokens":'), _num(spaces),
        F.lit(',"time":'), time,
        F.lit('},"tools":'), tools,
        F.lit(',"events":'), events, F.lit("}"),
    )


def document_sessions_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    """JSON text of one session document per ``documents`` row (column ``json``).

    Runs are the lines of the text, in order. Variants by ``doc_id``:
    agent_data null (quarantine), no ``memory`` (no runs), empty run list,
    ``time: [null]`` in the first run (quarantine), ``tools: null`` in some
    runs (run dropped), metrics alternating between scalar and list.
    """
    docs = table(spark, sf_dir, "documents")
    d = F.col("doc_id")
    lines = F.coalesce(F.split(F.col("text"), "\n"), F.array().cast("array<string>"))  # a null text has no runs
    runs = F.array_join(F.transform(lines, lambda line, i: _line_run_json(line, i + 1, d)), ",")
    agent = F.when(d % 53 == 7, F.lit("null")).otherwise(F.to_json(F.struct(
        F.col("source").alias("name"),
        F.struct(F.col("lang").alias("provider"), F.concat(F.lit("m-"), F.col("lang")).alias("id")).alias("model"),
    )))
    memory = (
        F.when(d % 41 == 5, F.lit(""))
        .when(d % 43 == 9, F.lit(',"memory":{"runs":[]}'))
        .otherwise(F.concat(F.lit(',"memory":{"runs":['), runs, F.lit("]}")))
    )
    created = (F.lit(EPOCH_2024) + (d * 7919) % 7776000).cast("long")
    return docs.select(
        F.concat(
            F.lit('{"_id":"doc-'), _num(d),
            F.lit('","session_id":"sess-'), _num(d % 97),
            F.lit('","created_at":'), _num(created),
            F.lit(',"user_id":"u'), _num(d % 13),
            F.lit('","agent_data":'), agent,
            memory, F.lit("}"),
        ).alias("json")
    )


def landing_batches(spark: SparkSession, sf_dir: str) -> list[DataFrame]:
    """Two batches of small session documents from ``documents``: the second one brings every third document again, on
    the same day, a day later or without time, and late documents for days of the first; some documents have no key
    and come with both."""
    docs = table(spark, sf_dir, "documents")
    d = F.col("doc_id")
    t = F.lit(EPOCH_2024) + (d * 7919) % 7776000

    def batch(rows: DataFrame, key: Column, user: Column, created: Column) -> DataFrame:
        fields = F.struct(key.alias("_id"), user.alias("user_id"), created.cast("long").alias("created_at"))
        return rows.select(F.parse_json(F.to_json(fields)).alias("doc"))  # null fields are left out

    doc_key, none = F.concat(F.lit("doc-"), d), F.lit(None).cast("string")
    keyless = batch(docs.where(d % 50 == 1), none, F.concat(F.lit("keyless-"), d), t)
    first = batch(docs, doc_key, F.lit("first"), F.when(d % 7 != 0, t))
    again = batch(docs.where(d % 3 == 0), doc_key, F.lit("second"), F.when(d % 9 != 0, F.when(d % 6 == 0, t + 86400).otherwise(t)))
    late = batch(docs.where(d % 10 == 0), F.concat(F.lit("late-"), d), F.lit("late"), F.when(d % 20 != 0, t))
    return [first.unionAll(keyless), again.unionAll(late).unionAll(keyless)]


def document_sessions(spark: SparkSession, sf_dir: str, start: str | None = None,
                      end: str | None = None) -> DataFrame:
    """B5 session documents as VARIANT (``doc``), landed once as Parquet
    partitioned by day; a date range prunes partitions."""
    path = land_sessions(spark, "documents-sessions", lambda: document_sessions_json(spark, sf_dir).select(
        F.parse_json("json").alias("doc")), [f"{sf_dir.rstrip('/')}/documents.parquet"], sys.modules[__name__])
    return read_sessions(spark, path, "landed", start, end)


def _typed_sessions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """B5 documents with a typed schema; missing keys (agent data, memory, time, tools) are NULL fields."""
    d = F.col("doc_id")

    def run(line: Column, i: Column) -> Column:
        n = F.length(line)
        return F.struct(
            F.when(n % 3 == 0, "RUNNING").otherwise("COMPLETED").alias("status"),
            line.alias("content"),
            F.struct(
                F.when(n % 17 == 5, F.array().cast("array<bigint>")).otherwise(F.array(n.cast("bigint"))).alias("total_tokens"),
                (n % 10).alias("input_tokens"),
                (n - F.length(F.regexp_replace(line, " ", ""))).alias("output_tokens"),
                F.when((d % 37 == 3) & (i == 0), None).otherwise((n % 7) * F.lit(0.5)).alias("time")).alias("metrics"),
            F.when((d + i + 1) % 29 == 0, None).otherwise(F.array_repeat(F.lit("search"), (n % 13).cast("int"))).alias("tools"),
            F.array_compact(F.array(
                F.when(n % 5 == 1, "RunCompleted"), F.when(n % 11 == 2, "Gateway TIMEOUT"),
                F.when(n % 4 == 3, "Error in step"), F.when(n % 4 == 3, "error again"))).alias("events"))

    runs = F.when(d % 43 == 9, F.filter(F.transform(F.split("text", "\n"), run), lambda r: F.lit(False))).otherwise(
        F.transform(F.split("text", "\n"), run))
    agent = F.struct(F.col("source").alias("name"), F.struct(
        F.col("lang").alias("provider"), F.concat(F.lit("m-"), "lang").alias("id")).alias("model"))
    return table(spark, sf_dir, "documents").select(
        F.concat(F.lit("doc-"), d).alias("_id"), F.concat(F.lit("sess-"), d % 97).alias("session_id"),
        (F.lit(EPOCH_2024) + (d * 7919) % 7776000).cast("long").alias("created_at"), F.concat(F.lit("u"), d % 13).alias("user_id"),
        F.when(d % 53 == 7, None).otherwise(agent).alias("agent_data"),
        F.when(d % 41 == 5, None).otherwise(F.struct(runs.alias("runs"))).alias("memory"))


def typed_document_sessions(spark: SparkSession, sf_dir: str, start: str | None = None, end: str | None = None) -> DataFrame:
    """The typed B5 sessions, landed once as Parquet and read by the typed reader."""
    path = land_parquet(spark, "typed-sessions", lambda: _typed_sessions(spark, sf_dir),
                        [f"{sf_dir.rstrip('/')}/documents.parquet"], sys.modules[__name__])
    return read_sessions(spark, path, "parquet", start, end)


# --- B2: events -> run records --------------------------------------------------
def event_run_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One run record per event: ``session_key`` (user and day), ``pos``
    (event_id) and ``run`` (VARIANT), landed once.

    status RUNNING for views; total_tokens = floor(100 * value), written as a
    list on odd days and as a scalar on even days; output_tokens an empty
    list for odd k; time 0 when k % 5 = 0; tools one per click (null when
    k % 31 = 0, which drops the run); events: purchase -> RunCompleted,
    signup -> a timeout, error -> two error texts, view -> ok.
    """
    path = land_parquet(spark, "events-runs", lambda: _event_run_records(spark, sf_dir),
                        [f"{sf_dir.rstrip('/')}/events.parquet"], sys.modules[__name__])
    return spark.read.parquet(path)


def _event_run_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = table(spark, sf_dir, "events")
    k = F.get_json_object("props", "$.k").cast("long")
    day = F.dayofmonth("ts")
    t = F.floor(F.col("value") * 100).cast("long")
    total = F.when(day % 2 == 1, F.concat(F.lit("["), _num(t), F.lit("]"))).otherwise(_num(t))
    output = F.when(k % 2 == 1, F.lit("[]")).otherwise(_num(k * 3))
    time = F.when(k % 5 == 0, F.lit("0")).otherwise(_num(F.col("value") / 4))
    tools = (
        F.when(k % 31 == 0, F.lit("null"))
        .when(F.col("event_type") == "click", F.to_json(F.array_repeat(F.lit("browse"), (k % 4 + 1).cast("int"))))
        .otherwise(F.lit("[]"))
    )
    events = (
        F.when(F.col("event_type") == "purchase", F.lit('["RunCompleted"]'))
        .when(F.col("event_type") == "signup", F.lit('["Gateway TIMEOUT"]'))
        .when(F.col("event_type") == "error", F.lit('["Error: upstream", {"error": null}]'))
        .when(F.col("event_type") == "view", F.lit('["ok"]'))
        .otherwise(F.lit("[]"))
    )
    status = F.when(F.col("event_type") == "view", F.lit("RUNNING")).otherwise(F.lit("COMPLETED"))
    text = F.concat(
        F.lit('{"status":"'), status, F.lit('","metrics":{"total_tokens":'), total,
        F.lit(',"input_tokens":'), _num(k), F.lit(',"output_tokens":'), output,
        F.lit(',"time":['), time, F.lit(']},"tools":'), tools, F.lit(',"events":'), events, F.lit("}"),
    )
    key = F.concat(_num(F.col("user_id")), F.lit("|"), F.date_format("ts", "yyyy-MM-dd"))
    return ev.select(key.alias("session_key"), F.col("event_id").alias("pos"), F.parse_json(text).alias("run"))
