"""Schema inference over VARIANT documents: one row per path, and a typed copy.

The schema of one document is a set of paths with a type; those of many documents
merge by adding up (path, type) counts, so the aggregate is mergeable and runs with
map-side partial sums. Objects and arrays are opened with ``variant_explode``, all levels in
one reading of the documents; all elements of an array share the path ``[*]``. A JSON null is a
type of its own, told apart from a missing key by the counts.

Columns per path: ``n`` values (nulls included), ``n_null``, ``n_boolean``, ``n_number``,
``n_string``, ``n_object``, ``n_array``, ``n_other`` (dates, binary), and ``whole`` (all its numbers are integers).
"""

from __future__ import annotations

import re
from collections import Counter

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

KINDS = ["null", "boolean", "number", "string", "object", "array", "other"]
OPENED = 8  # levels of containers opened by one reading


_STEP = "\x01"  # before every step of a path while it is counted


def _type(value: Column) -> Column:
    """Type of a value. Objects and arrays are told by a shallow cast, so that nothing below them is read."""
    return (F.when(F.try_variant_get(value, "$", "struct<>").isNotNull(), "OBJECT")
            .when(F.try_variant_get(value, "$", "array<struct<>>").isNotNull(), "ARRAY").otherwise(F.schema_of_variant(value)))


def _kind(t: str) -> str:
    """Kind of a type; ``whole`` for integers."""
    if t == "BIGINT" or re.fullmatch(r"DECIMAL\(\d+,0\)", t):
        return "whole"
    if t in ("DOUBLE", "FLOAT") or t.startswith("DECIMAL"):
        return "number"
    return {"VOID": "null", "BOOLEAN": "boolean", "STRING": "string", "OBJECT": "object", "ARRAY": "array"}.get(t, "other")


def _leaves(docs: DataFrame, doc_col: str, opened: int) -> list[tuple[str, str, int, bool, int]]:
    """(steps, type, parents, closed, values) of the documents opened ``opened`` levels deep, one row for a value that has
    nothing below it (or is not opened any more). A value stands for itself and for as many of the containers around it,
    from the innermost, as it is the first one of."""
    spark = docs.sparkSession
    rows = docs.select(F.lit("$").alias("steps"), F.col(doc_col).alias("v")).where("v is not null").select(
        "steps", _type(F.col("v")).alias("type"), F.lit(0).alias("parents"), "v")
    escaped = F.replace(F.replace("key", F.lit("\x02"), F.lit("\x02a")), F.lit(_STEP), F.lit("\x02b"))
    step = F.when(F.col("key").isNull(), F.lit(_STEP + "[*]")).otherwise(F.concat(F.lit(_STEP + "."), escaped))
    leaf = F.col("pos").isNull()
    for _ in range(opened):
        rows = rows.lateralJoin(spark.tvf.variant_explode_outer(F.col("v").outer())).select(
            F.when(leaf, F.col("steps")).otherwise(F.concat("steps", step)).alias("steps"),
            F.when(leaf, F.col("type")).otherwise(_type(F.col("value"))).alias("type"),
            F.when(leaf, F.col("parents")).when(F.col("pos") == 0, F.col("parents") + 1).otherwise(0).alias("parents"),
            F.col("value").alias("v"))
    closed = F.col("v").isNull() | ~F.col("type").isin("OBJECT", "ARRAY")
    return [tuple(r) for r in rows.groupBy("steps", "type", "parents", closed.alias("closed")).agg(
        F.count(F.lit(1)).alias("n")).collect()]  # one row for a path, type and number of parents


def _plain(steps: list[str]) -> str:
    return "".join(s.replace("\x02b", _STEP).replace("\x02a", "\x02") for s in steps)


def infer_schema(docs: DataFrame, doc_col: str = "doc", depth: int = 32) -> DataFrame:
    """One row per path of the documents; documents nested deeper than ``depth`` levels are an error. A NULL document
    has no path. The documents are read once, or once more for every doubling of ``OPENED`` that they need."""
    opened = min(OPENED, depth - 1)
    leaves = _leaves(docs, doc_col, opened)
    while not all(r[3] for r in leaves):
        if opened == depth - 1:
            raise ValueError(f"documents are nested deeper than {depth} levels")
        opened = min(2 * opened, depth - 1)
        leaves = _leaves(docs, doc_col, opened)
    counts: Counter = Counter()
    for steps, t, parents, _, n in leaves:
        at = steps.split(_STEP)
        counts[_plain(at), _kind(t)] += n
        for k in range(len(at) - 1, len(at) - 1 - parents, -1):
            counts[_plain(at[:k]), "array" if at[k].startswith("[") else "object"] += n
    rows = docs.sparkSession.createDataFrame([(*k, n) for k, n in counts.items()], "path string, kind string, n long")
    number = F.col("kind").isin("whole", "number")
    return rows.groupBy("path").agg(
        F.sum("n").alias("n"), *[F.coalesce(F.sum(F.when(number if k == "number" else F.col("kind") == k, F.col("n"))), F.lit(0)).alias(f"n_{k}") for k in KINDS],
        (F.coalesce(F.sum(F.when(F.col("kind") == "number", F.col("n"))), F.lit(0)) == 0).alias("whole"))


def _children(paths: dict[str, dict], at: str) -> dict[str, str]:
    """Names and paths of the fields right below an object's path."""
    out = {}
    for p in paths:
        rest = p[len(at) + 1:] if p.startswith(at + ".") else ""
        if rest and "." not in rest and "[" not in rest:
            out[rest] = p
    return out


def typed_ddl(paths: dict[str, dict], at: str = "$") -> str:
    """SQL type of a path: one kind besides nulls gives a type, several kinds (or none) stay VARIANT."""
    row = paths[at]
    kinds = [k for k in KINDS[1:] if row[f"n_{k}"]]
    if kinds == ["object"]:
        fields = _children(paths, at)
        return "STRUCT<" + ", ".join(f"`{f}`: {typed_ddl(paths, p)}" for f, p in sorted(fields.items())) + ">" if fields else "VARIANT"
    if kinds == ["array"]:
        return f"ARRAY<{typed_ddl(paths, at + '[*]') if at + '[*]' in paths else 'VARIANT'}>"
    if kinds == ["number"]:
        return "BIGINT" if row["whole"] else "DOUBLE"
    return {"string": "STRING", "boolean": "BOOLEAN"}.get(kinds[0], "VARIANT") if len(kinds) == 1 else "VARIANT"


def typed_copy(docs: DataFrame, schema: DataFrame, doc_col: str = "doc") -> DataFrame:
    """Documents as typed columns by an inferred schema (``schema``: the rows of ``infer_schema``; as many as there are paths).
    Nulls and missing keys are both NULL here; paths with values of several kinds stay VARIANT."""
    paths = {r["path"]: r.asDict() for r in schema.collect()}
    if "$" not in paths:
        return docs.select()
    return docs.select(F.try_variant_get(F.col(doc_col), "$", typed_ddl(paths)).alias("d")).select("d.*")
