"""Independent DuckDB SQL for the correctness gate.

The oracle uses the textbook method — number runs per session with
``row_number``, ``lag`` over the whole session, ``stddev_pop`` — while the
Spark side uses the chunked kernel or the higher-order-function kernel. Both
round doubles to 6 digits.
"""

from __future__ import annotations

from runlens.config import ALL_METRICS, DEFAULT_THRESHOLDS as TH
from runlens.operators.derive import metric_type

_SQL_TYPES = {"double": "DOUBLE", "int": "INTEGER", "bigint": "BIGINT"}


def _metric_sql() -> dict[str, tuple[str, str]]:
    """metric -> (expression over the agg CTE, guard column)."""
    mt = "(t_sum / n)"
    mo = "(o_sum / n)"
    mx = "(x_sum / n)"
    mk = "(k_sum / n)"
    tool_ratio = f"(CASE WHEN {mk} > 0 THEN k_max / {mk} ELSE 1 END)"
    incons = "(CASE WHEN r_min > 0 THEN r_max / r_min ELSE 0 END)"
    odd = "((r_slow + r_fast) / r_count)"
    return {
        "avg_total_tokens": (mt, "tok"),
        "max_total_tokens": ("t_max", "tok"),
        "token_explosion_ratio": (f"CASE WHEN {mt} > 0 THEN t_max / {mt} ELSE 1 END", "tok"),
        "output_explosion_ratio": (f"CASE WHEN {mo} > 0 THEN o_max / {mo} ELSE 1 END", "tok"),
        "token_coefficient_variation": (f"CASE WHEN {mt} > 0 THEN t_sd / {mt} ELSE 0 END", "tok"),
        "token_spike_frequency": ("t_spikes / n", "tok"),
        "max_token_growth_rate": ("coalesce(g_max, 1)", "tok"),
        "explosive_growth_events": ("g_explosive", "tok"),
        "extreme_token_flag": (f"CASE WHEN t_max > {TH.extreme_token_limit} THEN 1 ELSE 0 END", "tok"),
        "mega_explosion_flag": (f"CASE WHEN t_max > {TH.mega_explosion_limit} THEN 1 ELSE 0 END", "tok"),
        "avg_execution_time": (mx, "tim"),
        "max_execution_time": ("x_max", "tim"),
        "timeout_frequency": ("w_count / n", "tim"),
        "extreme_time_frequency": ("x_long / n", "tim"),
        "execution_time_cv": (f"CASE WHEN {mx} > 0 THEN x_sd / {mx} ELSE 0 END", "tim"),
        "time_explosion_events": ("x_jumps", "tim"),
        "infinite_loop_risk_score": ("w_count / n + x_long / n", "tim"),
        "timeout_flag": ("CASE WHEN w_count > 0 THEN 1 ELSE 0 END", "tim"),
        "extreme_duration_flag": (f"CASE WHEN x_max > {TH.long_duration_limit} THEN 1 ELSE 0 END", "tim"),
        "avg_tool_calls": (mk, "too"),
        "max_tool_calls": ("k_max", "too"),
        "total_tool_calls": ("k_sum", "too"),
        "tool_explosion_ratio": (tool_ratio, "too"),
        "excessive_tools_frequency": ("k_excess / n", "too"),
        "duplicate_tools_score": ("0", "too"),
        "tool_chaos_score": (f"k_excess / n + {tool_ratio} / {TH.tool_chaos_divisor}", "too"),
        "tool_overuse_flag": (f"CASE WHEN k_max > {TH.tool_overuse_limit} THEN 1 ELSE 0 END", "too"),
        "tool_explosion_flag": (f"CASE WHEN {tool_ratio} > {TH.explosive_growth} THEN 1 ELSE 0 END", "too"),
        "avg_tokens_per_second": ("r_sum / r_count", "spd"),
        "min_tokens_per_second": ("r_min", "spd"),
        "max_tokens_per_second": ("r_max", "spd"),
        "speed_inconsistency_ratio": (incons, "spd"),
        "inconsistent_speed_frequency": (odd, "spd"),
        "temporal_chaos_score": (odd, "spd"),
        "speed_anomaly_flag": (f"CASE WHEN {incons} > {TH.speed_anomaly_ratio} THEN 1 ELSE 0 END", "spd"),
        "success_rate": ("s_count / n", "run"),
        "failure_rate": ("1 - s_count / n", "run"),
        "max_consecutive_failures": ("streak", "run"),
        "avg_errors_per_run": ("e_sum / n", "run"),
        "total_errors": ("e_sum", "run"),
        "degradation_score": ("0", "run"),
        "systematic_failure_flag": (f"CASE WHEN 1 - s_count / n > {TH.systematic_failure_rate} THEN 1 ELSE 0 END", "run"),
        "complete_breakdown_flag": (f"CASE WHEN s_count / n < {TH.breakdown_success_rate} THEN 1 ELSE 0 END", "run"),
    }


_EMPTY_VALUE = {"max_token_growth_rate": "1"}


def metric_select(name: str, digits: int = 6, ints_as_double: bool = False) -> str:
    expr, guard = _metric_sql()[name]
    typ = metric_type(name)
    if ints_as_double and typ != "double":
        typ_out = "DOUBLE"
    else:
        typ_out = None
    if guard == "run":
        body = expr
    else:
        body = f"CASE WHEN {guard} THEN {expr} ELSE {_EMPTY_VALUE.get(name, '0')} END"
    body = f"CAST({body} AS {_SQL_TYPES[typ]})"
    if typ == "double":
        body = f"(round({body} * {10 ** digits}, 0) / {10 ** digits})"
    if typ_out:
        body = f"CAST({body} AS {typ_out})"
    return f"CASE WHEN n > 0 THEN {body} END AS {name}"


def stats_ctes(runs_sql: str) -> str:
    """CTEs ``seq`` and ``agg`` over a runs query with columns
    k, pos, t, o, x, kc, s, e, w (pos dense from 1 within k)."""
    th = TH
    return f"""
runs AS ({runs_sql}),
seq AS (
  SELECT *,
    lag(t) OVER (PARTITION BY k ORDER BY pos) AS pt,
    lag(x) OVER (PARTITION BY k ORDER BY pos) AS px,
    avg(t) OVER (PARTITION BY k) AS mean_t,
    pos - coalesce(max(CASE WHEN s THEN pos END) OVER (PARTITION BY k ORDER BY pos
                   ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW), 0) AS fail_run,
    CASE WHEN x > 0 THEN t / x END AS r
  FROM runs),
agg AS (
  SELECT k,
    count(*) AS n,
    sum(t) AS t_sum, max(t) AS t_max, stddev_pop(t) AS t_sd,
    sum(o) AS o_sum, max(o) AS o_max,
    sum(x) AS x_sum, max(x) AS x_max, stddev_pop(x) AS x_sd,
    count(*) FILTER (WHERE x > {th.extreme_time_limit}) AS x_long,
    count(*) FILTER (WHERE w) AS w_count,
    sum(kc) AS k_sum, max(kc) AS k_max,
    count(*) FILTER (WHERE kc > {th.excessive_tools_limit}) AS k_excess,
    count(r) AS r_count, sum(r) AS r_sum, min(r) AS r_min, max(r) AS r_max,
    count(*) FILTER (WHERE r < {th.slow_tokens_per_second}) AS r_slow,
    count(*) FILTER (WHERE r > {th.fast_tokens_per_second}) AS r_fast,
    count(*) FILTER (WHERE s) AS s_count, sum(e) AS e_sum,
    count(*) FILTER (WHERE t > {th.token_spike_multiplier} * mean_t) AS t_spikes,
    max(CASE WHEN pt > 0 THEN t / pt END) AS g_max,
    count(*) FILTER (WHERE pt > 0 AND t / pt > {th.explosive_growth}) AS g_explosive,
    count(*) FILTER (WHERE px IS NOT NULL AND x > {th.time_jump_multiplier} * px) AS x_jumps,
    coalesce(max(CASE WHEN NOT s THEN fail_run END), 0) AS streak,
    bool_or(t <> 0) AS tok, bool_or(x <> 0) AS tim, bool_or(kc <> 0) AS too, bool_or(x > 0) AS spd
  FROM seq GROUP BY k)"""


def features_sql(runs_sql: str, key_sql: str, metrics: list[str] | None = None,
                 with_total_runs: bool = True) -> str:
    metrics = ALL_METRICS if metrics is None else metrics
    cols = [f"{key_sql} AS session_key"]
    if with_total_runs:
        cols.append("CAST(n AS BIGINT) AS total_runs")
    cols += [metric_select(m) for m in metrics]
    return f"WITH {stats_ctes(runs_sql)}\nSELECT {', '.join(cols)} FROM agg"


def rises_sql(runs_sql: str, key: str, ctes: str = "") -> str:
    """The longest stretch of rising token counts (islands between runs that do not rise) and the deepest fall below the
    highest count before."""
    return f"""WITH {ctes} runs AS ({runs_sql}),
step AS (SELECT k, pos, t, CASE WHEN t > lag(t) OVER (PARTITION BY k ORDER BY pos) THEN 0 ELSE 1 END AS new,
  max(t) OVER (PARTITION BY k ORDER BY pos ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) - t AS below FROM runs),
island AS (SELECT *, sum(new) OVER (PARTITION BY k ORDER BY pos) AS i FROM step),
size AS (SELECT k, i, count(*) AS n, max(below) AS below FROM island GROUP BY k, i)
SELECT k AS {key}, CAST(max(n) AS BIGINT) AS longest_token_rise, CAST(max(below) AS DOUBLE) AS deepest_token_fall FROM size GROUP BY k"""


# --- bindings in SQL ---------------------------------------------------------
LINEITEM_RUNS_SQL = """
  SELECT l_orderkey AS k,
    row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey,
                       l_extendedprice, l_shipdate, l_quantity) AS pos,
    CASE WHEN l_discount = 0 THEN 0.0 ELSE floor(l_extendedprice) END AS t,
    floor(l_extendedprice * l_discount) AS o,
    CASE WHEN l_quantity <= 2 THEN 0.0 ELSE l_quantity * 1.5 END AS x,
    CASE WHEN l_partkey % 7 = 0 THEN l_partkey % 25 ELSE 0 END AS kc,
    l_returnflag <> 'R' AS s,
    CASE WHEN l_returnflag = 'A' THEN 1 ELSE 0 END AS e,
    l_quantity = 50 AS w
  FROM lineitem"""

CONVERSATION_RUNS_SQL = """
  SELECT conv_id AS k,
    row_number() OVER (PARTITION BY conv_id ORDER BY turn) AS pos,
    CAST(length(text) AS DOUBLE) AS t,
    CASE WHEN role = 'assistant' THEN CAST(length(text) AS DOUBLE) ELSE 0.0 END AS o,
    0.0 AS x,
    length(text) - length(replace(text, '?', '')) AS kc,
    role <> 'system' AS s,
    0 AS e,
    false AS w
  FROM conversations"""


# --- B2 events: one run per event, session = (user, day) -----------------------
EVENT_BASE = """
  SELECT CAST(user_id AS VARCHAR) || '|' || strftime(ts, '%Y-%m-%d') AS session_key,
         event_id AS pos, event_type, value,
         CAST(json_extract_string(props, '$.k') AS BIGINT) AS kk
  FROM events"""

EVENT_RUNS_SELECT = f"""
SELECT session_key, pos,
  CAST(floor(value * 100) AS DOUBLE) AS total_tokens,
  CAST(kk AS DOUBLE) AS input_tokens,
  CASE WHEN kk % 2 = 1 THEN 0.0 ELSE CAST(kk * 3 AS DOUBLE) END AS output_tokens,
  CASE WHEN kk % 5 = 0 THEN 0.0 ELSE value / 4 END AS execution_time,
  event_type IN ('view', 'purchase') AS success,
  CAST(CASE WHEN event_type = 'click' THEN kk % 4 + 1 ELSE 0 END AS BIGINT) AS tool_calls_count,
  CAST(CASE WHEN event_type = 'error' THEN 2 ELSE 0 END AS BIGINT) AS error_count,
  event_type = 'signup' AS has_timeout
FROM ({EVENT_BASE}) WHERE kk % 31 <> 0"""

EVENT_RUNS_SQL = f"""
  SELECT session_key AS k, row_number() OVER (PARTITION BY session_key ORDER BY pos) AS pos,
    total_tokens AS t, output_tokens AS o, execution_time AS x, tool_calls_count AS kc,
    success AS s, error_count AS e, has_timeout AS w
  FROM ({EVENT_RUNS_SELECT})"""


# --- B5 documents: one session document per row, runs = lines of the text ------
DOC_BASE = """
  SELECT doc_id AS d, 'doc-' || CAST(doc_id AS VARCHAR) AS doc_key,
    'sess-' || CAST(doc_id % 97 AS VARCHAR) AS session_id,
    CAST(1704067200 + (doc_id * 7919) % 7776000 AS BIGINT) AS created_at,
    'u' || CAST(doc_id % 13 AS VARCHAR) AS user_id,
    source AS agent_name, lang AS model_provider, 'm-' || lang AS model_id,
    doc_id % 53 = 7 AS agent_null,
    NOT (doc_id % 41 = 5 OR doc_id % 43 = 9) AS has_runs_list,
    text
  FROM documents"""

DOC_LINES = f"""
  SELECT d, doc_key, i, length(line) AS L, length(line) - length(replace(line, ' ', '')) AS spaces
  FROM (SELECT d, doc_key, unnest(string_split(text, chr(10))) AS line,
               generate_subscripts(string_split(text, chr(10)), 1) AS i
        FROM ({DOC_BASE}) WHERE has_runs_list)"""

DOC_RUNS = f"""
  SELECT d, doc_key, i,
    CASE WHEN L % 17 = 5 THEN 0.0 ELSE CAST(L AS DOUBLE) END AS total_tokens,
    CAST(L % 10 AS DOUBLE) AS input_tokens,
    CAST(spaces AS DOUBLE) AS output_tokens,
    CASE WHEN d % 37 = 3 AND i = 1 THEN NULL ELSE (L % 7) * 0.5 END AS execution_time,
    (L % 3 = 0) OR (L % 5 = 1) AS success,
    CAST(L % 13 AS BIGINT) AS tool_calls_count,
    CAST(CASE WHEN L % 4 = 3 THEN 2 ELSE 0 END AS BIGINT) AS error_count,
    L % 11 = 2 AS has_timeout
  FROM ({DOC_LINES}) WHERE (d + i) % 29 <> 0"""

DOC_CTES = f"""
base AS ({DOC_BASE}),
doc_runs AS ({DOC_RUNS}),
quar AS (SELECT doc_key, bool_or(execution_time IS NULL) AS null_metric FROM doc_runs GROUP BY doc_key),
good AS (
  SELECT b.* FROM base b LEFT JOIN quar q ON q.doc_key = b.doc_key
  WHERE NOT b.agent_null AND NOT coalesce(q.null_metric, false))"""

# The typed copy: what a JSON document writes as null is a missing key there, so nothing is set aside or dropped.
TYPED_CTES = f"""
base AS ({DOC_BASE}),
doc_runs AS (SELECT d, doc_key, i, total_tokens, input_tokens, output_tokens, coalesce(execution_time, 0.0) AS execution_time,
    success, CASE WHEN (d + i) % 29 = 0 THEN 0 ELSE tool_calls_count END AS tool_calls_count, error_count, has_timeout
  FROM ({DOC_RUNS.replace("WHERE (d + i) % 29 <> 0", "")})),
good AS (SELECT * REPLACE (CASE WHEN agent_null THEN '' ELSE agent_name END AS agent_name,
    CASE WHEN agent_null THEN '' ELSE model_provider END AS model_provider,
    CASE WHEN agent_null THEN '' ELSE model_id END AS model_id) FROM base)"""

DOC_STAT_RUNS = """
  SELECT doc_key AS k, row_number() OVER (PARTITION BY doc_key ORDER BY i) AS pos,
    total_tokens AS t, output_tokens AS o, execution_time AS x, tool_calls_count AS kc,
    success AS s, error_count AS e, has_timeout AS w
  FROM doc_runs"""


def _ts(col: str, fmt: str) -> str:
    return f"strftime(make_timestamp(CAST({col} AS BIGINT) * 1000000), '{fmt}')"


def document_features_sql(lo: int | None = None, hi: int | None = None, ints_as_double: bool = False,
                          ctes: str = DOC_CTES) -> str:
    where = "" if lo is None else f"WHERE g.created_at BETWEEN {lo} AND {hi}"
    metrics = ", ".join(metric_select(m, ints_as_double=ints_as_double) for m in ALL_METRICS)
    return f"""WITH {ctes},
{stats_ctes(DOC_STAT_RUNS)}
SELECT g.doc_key, g.session_id, g.agent_name, g.model_provider, g.model_id, g.user_id, g.created_at,
  CAST(coalesce(n, 0) AS BIGINT) AS total_runs, {metrics},
  CASE WHEN n > 0 THEN {_ts('g.created_at', '%Y-%m-%d')} END AS date,
  CASE WHEN n > 0 THEN {_ts('g.created_at', '%Y-%m-%dT%H:%M:%S')} END AS timestamp
FROM good g LEFT JOIN agg ON agg.k = g.doc_key {where}"""


DOCUMENT_RUNS_SELECT = f"""WITH {DOC_CTES}
SELECT r.doc_key, CAST(row_number() OVER (PARTITION BY r.doc_key ORDER BY r.i) - 1 AS BIGINT) AS pos,
  r.total_tokens, r.input_tokens, r.output_tokens, r.execution_time, r.success,
  r.tool_calls_count, r.error_count, r.has_timeout
FROM doc_runs r JOIN good g ON g.doc_key = r.doc_key"""

QUARANTINE_SQL = f"""WITH {DOC_CTES}
SELECT b.doc_key, b.session_id,
  CASE WHEN b.agent_null THEN 'agent_data_null' WHEN coalesce(q.null_metric, false) THEN 'null_metric' END
    AS quarantine_reason
FROM base b LEFT JOIN quar q ON q.doc_key = b.doc_key
WHERE b.agent_null OR coalesce(q.null_metric, false)"""


QUARANTINE_RUNS_SQL = f"""
SELECT doc_key, CAST(i - 1 AS BIGINT) AS pos, '$.memory.runs[' || CAST(i - 1 AS VARCHAR) || '].tools' AS json_path
FROM ({DOC_LINES}) WHERE (d + i) % 29 = 0"""

_RUN = "$.memory.runs[*]"
# path -> (rows, what of them counts as n, and the kind of value by condition), from how the documents are made
_PATHS = {
    "$": ("base", "1", {"object": "true"}),
    "$._id": ("base", "1", {"string": "true"}),
    "$.session_id": ("base", "1", {"string": "true"}),
    "$.user_id": ("base", "1", {"string": "true"}),
    "$.created_at": ("base", "1", {"number": "true"}),
    "$.agent_data": ("base", "1", {"null": "agent_null", "object": "NOT agent_null"}),
    "$.agent_data.name": ("base WHERE NOT agent_null AND agent_name IS NOT NULL", "1", {"string": "true"}),
    "$.agent_data.model": ("base WHERE NOT agent_null", "1", {"object": "true"}),
    "$.agent_data.model.provider": ("base WHERE NOT agent_null AND model_provider IS NOT NULL", "1", {"string": "true"}),
    "$.agent_data.model.id": ("base WHERE NOT agent_null AND model_id IS NOT NULL", "1", {"string": "true"}),
    "$.memory": ("base WHERE d % 41 <> 5", "1", {"object": "true"}),
    "$.memory.runs": ("base WHERE d % 41 <> 5", "1", {"array": "true"}),
    _RUN: ("lines", "1", {"object": "true"}),
    f"{_RUN}.status": ("lines", "1", {"string": "true"}),
    f"{_RUN}.metrics": ("lines", "1", {"object": "true"}),
    f"{_RUN}.metrics.total_tokens": ("lines", "1", {"array": "L % 17 = 5 OR (d + i) % 2 = 1", "number": "NOT (L % 17 = 5 OR (d + i) % 2 = 1)"}),
    f"{_RUN}.metrics.total_tokens[*]": ("lines WHERE L % 17 <> 5 AND (d + i) % 2 = 1", "1", {"number": "true"}),
    f"{_RUN}.metrics.input_tokens": ("lines", "1", {"number": "true"}),
    f"{_RUN}.metrics.output_tokens": ("lines", "1", {"number": "true"}),
    f"{_RUN}.metrics.time": ("lines", "1", {"array": "true"}),
    f"{_RUN}.metrics.time[*]": ("lines", "1", {"null": "d % 37 = 3 AND i = 1", "number": "NOT (d % 37 = 3 AND i = 1)"}),
    f"{_RUN}.tools": ("lines", "1", {"null": "(d + i) % 29 = 0", "array": "(d + i) % 29 <> 0"}),
    f"{_RUN}.tools[*]": ("lines WHERE (d + i) % 29 <> 0", "L % 13", {"string": "true"}),
    f"{_RUN}.events": ("lines", "1", {"array": "true"}),
    f"{_RUN}.events[*]": ("(SELECT unnest([L % 5 = 1, L % 11 = 2, L % 4 = 3, L % 4 = 3]) AS there, unnest(['s', 's', 's', 'o']) AS e FROM lines) WHERE there",
                          "1", {"string": "e = 's'", "object": "e = 'o'"}),
    f"{_RUN}.events[*].error": ("lines WHERE L % 4 = 3", "1", {"null": "true"}),
}


def _path_sql(path: str, rows: str, n: str, kinds: dict[str, str]) -> str:
    counts = ", ".join(f"CAST(sum(CASE WHEN {kinds.get(k, 'false')} THEN {n} ELSE 0 END) AS BIGINT) AS n_{k}"
                       for k in ("null", "boolean", "number", "string", "object", "array"))
    return f"SELECT '{path}' AS path, CAST(sum({n}) AS BIGINT) AS n, {counts} FROM {rows} HAVING sum({n}) > 0"


INFER_SCHEMA_SQL = f"WITH base AS ({DOC_BASE}), lines AS ({DOC_LINES})\n" + "\nUNION ALL\n".join(
    _path_sql(p, *parts) for p, parts in _PATHS.items())

# batch 2 replaces every third document (user and time), batch 1 the others; late documents are in batch 2 only,
# documents without a key are in both and stay once
LANDED_UPSERT_SQL = """
WITH b AS (SELECT doc_id AS d, CAST(1704067200 + (doc_id * 7919) % 7776000 AS BIGINT) AS t FROM documents),
v AS (
  SELECT 'doc-' || CAST(d AS VARCHAR) AS doc_key, 'first' AS user_id, CASE WHEN d % 7 <> 0 THEN t END AS created_at FROM b WHERE d % 3 <> 0
  UNION ALL
  SELECT 'doc-' || CAST(d AS VARCHAR), 'second', CASE WHEN d % 9 <> 0 THEN CASE WHEN d % 6 = 0 THEN t + 86400 ELSE t END END FROM b WHERE d % 3 = 0
  UNION ALL
  SELECT 'late-' || CAST(d AS VARCHAR), 'late', CASE WHEN d % 20 <> 0 THEN t END FROM b WHERE d % 10 = 0
  UNION ALL
  SELECT NULL, 'keyless-' || CAST(d AS VARCHAR), t FROM b WHERE d % 50 = 1)
SELECT doc_key, CASE WHEN created_at IS NOT NULL THEN strftime(make_timestamp(created_at * 1000000), '%Y-%m-%d') END AS date, created_at, user_id FROM v"""


def scan_sessions_sql(lo: int, hi: int) -> str:
    return f"WITH {DOC_CTES}\nSELECT doc_key, created_at FROM base WHERE created_at BETWEEN {lo} AND {hi}"


PROJECT_SESSIONS_SQL = f"""WITH {DOC_CTES}
SELECT doc_key AS session_id,
  CASE WHEN agent_null THEN '' ELSE agent_name END AS agent_name,
  CASE WHEN agent_null THEN '' ELSE model_provider END AS model_provider,
  CASE WHEN agent_null THEN '' ELSE model_id END AS model_id,
  created_at,
  CAST(CASE WHEN has_runs_list THEN len(string_split(text, chr(10))) ELSE 0 END AS BIGINT) AS run_count
FROM base"""

BASIC_FEATURES_SQL = f"""WITH {DOC_CTES}
SELECT doc_key, session_id, agent_name, model_provider, model_id, user_id, created_at FROM good"""

FORMAT_TIMESTAMPS_SQL = """
SELECT CAST(o_orderkey AS VARCHAR) AS session_id, CAST(epoch(o_orderdate) AS BIGINT) AS created_at,
  CASE WHEN epoch(o_orderdate) <> 0 THEN strftime(o_orderdate, '%Y-%m-%d') END AS date,
  CASE WHEN epoch(o_orderdate) <> 0 THEN strftime(o_orderdate, '%Y-%m-%dT%H:%M:%S') END AS timestamp
FROM orders"""


def order_range_sql(lo: int, hi: int) -> str:
    return f"""
SELECT CAST(o_orderkey AS VARCHAR) AS session_id, CAST(epoch(o_orderdate) AS BIGINT) AS created_at
FROM orders WHERE epoch(o_orderdate) BETWEEN {lo} AND {hi}"""


def default_range_sql(as_of: str) -> str:
    return f"""
WITH r AS (SELECT CAST(DATE '{as_of}' - INTERVAL 1 MONTH AS DATE) AS s, DATE '{as_of}' - 1 AS e)
SELECT CAST(o_orderkey AS VARCHAR) AS session_id, CAST(epoch(o_orderdate) AS BIGINT) AS created_at,
  strftime(r.s, '%Y-%m-%d') AS start_date, strftime(r.e, '%Y-%m-%d') AS end_date
FROM orders, r
WHERE epoch(o_orderdate) BETWEEN epoch(CAST(r.s AS TIMESTAMP)) AND epoch(CAST(r.e AS TIMESTAMP)) + 86399"""


VALIDATE_REQUESTS_SQL = r"""
WITH r AS (
  SELECT o_orderkey AS request_id,
    CASE WHEN o_orderkey % 23 = 1 THEN NULL
         WHEN o_orderkey % 23 = 3 THEN ''
         WHEN o_orderkey % 23 = 4 THEN strftime(o_orderdate, '%Y-%-m-%-d')
         WHEN o_orderkey % 23 = 5 THEN CAST(year(o_orderdate) AS VARCHAR) || '-02-30'
         ELSE strftime(o_orderdate, '%Y-%m-%d') END AS start_date,
    CASE WHEN o_orderkey % 23 = 2 THEN NULL
         WHEN o_orderkey % 23 = 6
           THEN strftime(CAST(o_orderdate AS DATE) + CAST(o_orderkey % 40 - 10 AS INTEGER), '%Y/%m/%d')
         ELSE strftime(CAST(o_orderdate AS DATE) + CAST(o_orderkey % 40 - 10 AS INTEGER), '%Y-%m-%d')
    END AS end_date
  FROM orders),
v AS (
  SELECT *,
    coalesce(regexp_full_match(start_date, '\d{4}-\d{2}-\d{2}')
             AND try_strptime(start_date, '%Y-%m-%d') IS NOT NULL, false) AS start_ok,
    coalesce(regexp_full_match(end_date, '\d{4}-\d{2}-\d{2}')
             AND try_strptime(end_date, '%Y-%m-%d') IS NOT NULL, false) AS end_ok
  FROM r)
SELECT request_id, start_date, end_date,
  CASE WHEN start_date IS NULL OR start_date = '' THEN 'start_required'
       WHEN end_date IS NULL OR end_date = '' THEN 'end_required'
       WHEN NOT start_ok THEN 'start_invalid'
       WHEN NOT end_ok THEN 'end_invalid'
       WHEN try_strptime(start_date, '%Y-%m-%d') > try_strptime(end_date, '%Y-%m-%d') THEN 'start_after_end'
  END AS error
FROM v"""


def training_export_sql(lo: int, hi: int) -> str:
    from runlens.config import EXPORT_COLUMNS, TEXT_COLUMNS
    cols = []
    for c in EXPORT_COLUMNS:
        cols.append(f"coalesce({c}, '') AS {c}" if c in TEXT_COLUMNS else f"coalesce({c}, 0) AS {c}")
    return f"SELECT {', '.join(cols)} FROM ({document_features_sql(lo, hi)})"


def export_manifest_sql(lo: int, hi: int, layout: str, metadata: dict[str, str]) -> str:
    fixed = ", ".join(f"'{v}' AS {k}" for k, v in metadata.items())
    return f"""WITH {DOC_CTES}
SELECT greatest(count(*), 1) AS rows, true AS success, '{layout}' AS layout, {fixed} FROM good WHERE created_at BETWEEN {lo} AND {hi}"""


def empty_export_sql(lo: int, hi: int, session_id: str, message: str) -> str:
    return f"""WITH {DOC_CTES}
SELECT '{session_id}' AS session_id, '{message}' AS message
WHERE NOT EXISTS (SELECT 1 FROM good WHERE created_at BETWEEN {lo} AND {hi})"""


def extraction_summary_sql(start: str, end: str, lo: int, hi: int) -> str:
    return f"""WITH {DOC_CTES}
SELECT '{start}' AS start_date, '{end}' AS end_date, count(*) AS total_conversations,
  min(created_at) AS first_created_at, max(created_at) AS last_created_at,
  CAST(NULL AS VARCHAR) AS location
FROM good WHERE created_at BETWEEN {lo} AND {hi}"""


def order_training_export_sql(lo: int, hi: int) -> str:
    from runlens.config import EXPORT_COLUMNS
    runs = LINEITEM_RUNS_SQL + " WHERE l_orderkey IN (SELECT o_orderkey FROM sess)"
    metrics = ", ".join(metric_select(m) for m in ALL_METRICS)
    cols = ", ".join(f"coalesce({c}, 0) AS {c}" for c in EXPORT_COLUMNS[4:])
    return f"""WITH sess AS (
  SELECT o_orderkey, CAST(o_orderkey AS VARCHAR) AS session_id, o_orderpriority AS agent_name,
         o_orderstatus AS model_provider, 'm' || CAST(o_custkey % 10 AS VARCHAR) AS model_id
  FROM orders WHERE epoch(o_orderdate) BETWEEN {lo} AND {hi}),
{stats_ctes(runs)},
feats AS (SELECT k, CAST(n AS BIGINT) AS total_runs, {metrics} FROM agg)
SELECT session_id, coalesce(agent_name, '') AS agent_name, coalesce(model_provider, '') AS model_provider,
       coalesce(model_id, '') AS model_id, {cols}
FROM sess LEFT JOIN feats ON feats.k = sess.o_orderkey"""
