"""Operator 5 — line dedup by log templates (built-in functions only).

Each line goes down a tree of fixed depth: its token count, then its leading
``depth`` tokens (tokens with a digit are the wildcard ``<*>``). Inside a
leaf, a position is a variable field of a line if another distinct line differs from it
there and nowhere else, or if no other line has its token there. The line's template has
``<*>`` at its variable fields: at most a share of 1 - ``similarity`` of its tokens,
tokens with a digit among them, those with the most lines that differ there only first, then the earlier ones. A
template that occurs in two or more documents is recurring: its first occurrence
(smallest doc_id, then position) stays, all others are dropped. More lines never
make a field constant again. Lines of fewer than ``min_tokens`` tokens, and lines with digits
in more than half of their tokens (tables, dates, scores), have no
template: they recur as the whole line, blanks collapsed. Blank lines stay.

Plan: one narrow aggregation over distinct lines (exact copies collapse on the
map side, so a line in a third of all documents is one row a task); only leaves
with two or more distinct lines are tokenised; the decisions come back to the
documents as arrays of line positions. Keys of the exchanges are distinct lines,
(leaf, position, token) and (leaf, position, line without it), never a whole leaf. A line
without a token is known by the exclusive-or of its tokens' hashes, so long lines cost no more than their length.

Defined results: a null text is empty; a text keeps its line ends; a text or line of any length counts whole; an
empty table gives no rows; extra columns are carried along; rows that
repeat (same doc_id and text) are one document for the counting, and each row
gets the same result; null ids sort first.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from runlens.llm.common import checked, free_name, staged, table, work_dir

MIN_TOKENS = 5
DEPTH = 3
SIMILARITY = 0.8


def _normal(line: Column) -> Column:
    """Blanks collapsed, tokens with a digit replaced by the wildcard; lines that need neither skip the patterns."""
    masked = F.when(line.rlike("[0-9]"), F.regexp_replace(line, r"(?<!\S)[^\s0-9]*+[0-9]\S*", "<*>")).otherwise(line)
    odd = F.lit(False)
    for blank in ("  ", "\t", "\r", "\f", "\x0b"):
        odd = odd | line.contains(blank)
    return F.trim(F.when(odd, F.regexp_replace(masked, r"\s+", " ")).otherwise(masked))


def _limit(n: Column, similarity: float) -> Column:
    """Wildcards of a template of n tokens at most."""
    return F.floor(n * (1 - similarity) + 1e-9).cast("int")


def _lines(docs: DataFrame, min_tokens: int, depth: int) -> DataFrame:
    """(d, k, p, n, masked, norm, leaf, h) of the lines that are not blank; norm is the whole line where it has no template."""
    lines = docs.select("d", "k", F.posexplode(F.split("t", "\n", -1)).alias("p", "line"))
    lines = lines.select("d", "k", "p", "line", _normal(F.col("line")).alias("norm")).where("norm <> ''")
    lines = lines.withColumns({"n": F.octet_length("norm") - F.octet_length(F.replace("norm", F.lit(" "))) + 1,
                               "masked": F.when(F.col("norm").contains("<*>"), F.size(F.filter(F.split("norm", " "), lambda w: w == "<*>"))).otherwise(0)})
    general = (F.col("n") >= min_tokens) & (F.col("masked") * 2 <= F.col("n"))
    whole = F.when(F.col("masked") > 0, F.trim(F.regexp_replace("line", r"\s+", " "))).otherwise(F.col("norm"))
    lines = lines.select("d", "k", "p", "n", "masked", general.alias("general"), F.when(general, F.col("norm")).otherwise(whole).alias("norm"))
    leaf = F.when(F.col("general"), F.xxhash64("n", F.substring_index("norm", " ", depth))).otherwise(F.xxhash64(F.lit("whole"), "norm"))
    return lines.select("d", "k", "p", "n", "masked", "norm", leaf.alias("leaf"), F.xxhash64("norm").alias("h"))


def _variable_fields(several: DataFrame, depth: int, similarity: float) -> DataFrame:
    """(leaf, h, variable): positions to generalise, of the distinct lines of leaves with two or more."""
    hashed = several.select("leaf", "h", "n", "masked", F.transform(F.split("norm", " "), lambda w, i: F.xxhash64(i, w)).alias("hs"))
    summed = hashed.withColumn("all", F.aggregate("hs", F.lit(0).cast("long"), lambda a, x: a.bitwiseXOR(x)))
    tokens = summed.select("leaf", "h", "n", "masked", "all", F.posexplode("hs").alias("i", "token")).where(F.col("i") >= depth)
    tokens = tokens.withColumn("rest", F.col("all").bitwiseXOR(F.col("token")))
    alone = tokens.groupBy("leaf", "i", "token").agg(F.count(F.lit(1)).alias("c"), F.min("h").alias("h"), F.min("n").alias("n"), F.min("masked").alias("masked")).where(
        "c = 1").select("leaf", "h", "n", "masked", "i", F.lit(1).cast("long").alias("lines"))
    differ = tokens.groupBy("leaf", "i", "rest").agg(F.count(F.lit(1)).alias("lines")).where("lines > 1")
    there = tokens.join(differ, ["leaf", "i", "rest"]).select("leaf", "h", "n", "masked", "i", "lines")
    fields = there.unionByName(alone).groupBy("leaf", "h", "n", "masked", "i").agg(F.max("lines").alias("lines"))
    ranked = fields.groupBy("leaf", "h", "n", "masked").agg(F.sort_array(F.collect_list(F.struct((-F.col("lines")).alias("most"), "i"))).alias("f"))  # of one line
    room = _limit(F.col("n"), similarity) - F.col("masked")
    return ranked.where(room > 0).select("leaf", "h", F.transform(F.slice("f", 1, room), lambda x: x["i"]).alias("variable"))


def dropped_lines(docs: DataFrame, min_tokens: int = MIN_TOKENS, depth: int = DEPTH,
                  similarity: float = SIMILARITY) -> DataFrame:
    """(d, k, positions) of the lines to drop; ``docs`` has d (doc_id), k (row key), t (text)."""
    spark = docs.sparkSession
    out = work_dir(spark, "line-templates")
    lines = _lines(docs, min_tokens, depth)
    place = F.struct(F.col("d"), F.col("k"), F.col("p"))
    narrow = staged(lines.select("d", "k", "p", "leaf", "h"), f"{out}/lines")
    distinct = staged(narrow.groupBy("leaf", "h").agg(F.min(place).alias("first"), F.min("k").alias("k0"), F.max("k").alias("k1")),
                      f"{out}/distinct")
    # variable fields: only in leaves with two or more distinct lines
    leaves = distinct.groupBy("leaf").count().where("count > 1").select("leaf")
    several = staged(lines.join(checked(leaves), "leaf", "left_semi").groupBy("leaf", "h").agg(
        F.first("n").alias("n"), F.first("masked").alias("masked"), F.first("norm").alias("norm")), f"{out}/several")
    general = several.join(_variable_fields(several, depth, similarity), ["leaf", "h"]).select(
        "leaf", "h", F.xxhash64(F.concat_ws(" ", F.transform(
            F.split("norm", " "), lambda w, i: F.when(F.array_contains("variable", i), F.lit("<*>")).otherwise(w)))).alias("g"))
    named = staged(distinct.join(general, ["leaf", "h"], "left").withColumn("g", F.coalesce("g", "h")), f"{out}/templates")
    recurring = (named.groupBy("leaf", "g").agg(F.min("first").alias("keep"), F.min("k0").alias("k0"), F.max("k1").alias("k1"))
                 .where("k0 <> k1").select("leaf", "g", "keep"))
    drop = named.join(recurring, ["leaf", "g"]).select("leaf", "h", "keep")
    hit = narrow.join(drop, ["leaf", "h"]).where(
        ~(F.col("k").eqNullSafe(F.col("keep.k")) & (F.col("p") == F.col("keep.p"))))
    return hit.groupBy("d", "k").agg(F.collect_set("p").alias("positions"))


def dedup_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_tokens: int = MIN_TOKENS,
                depth: int = DEPTH, similarity: float = SIMILARITY) -> DataFrame:
    """``docs`` with recurring template lines taken out of ``text_col``; plus ``lines_before`` and
    ``lines_dropped`` (columns of these names are replaced)."""
    docs = docs.drop("lines_before", "lines_dropped")
    k, t, gone = (free_name(n, docs.columns) for n in ("key", "whole", "gone"))
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    ident = F.col(id_col).cast("long")
    key = F.xxhash64(ident, text)
    src = docs.select(ident.alias("d"), key.alias("k"), text.alias("t"))
    drop = dropped_lines(src, min_tokens, depth, similarity).select(F.col("k").alias(k), F.col("positions").alias(gone))
    joined = docs.withColumns({k: key, t: text}).join(drop, k, "left")
    parts = F.split(t, "\n", -1)
    kept = F.when(F.col(gone).isNull(), F.col(t)).otherwise(
        F.array_join(F.filter(parts, lambda x, i: ~F.array_contains(gone, i)), "\n"))
    return joined.withColumns({text_col: kept, "lines_before": F.size(parts).cast("long"),
                               "lines_dropped": F.coalesce(F.size(gone), F.lit(0)).cast("long")}).select(
        *docs.columns, "lines_before", "lines_dropped")


def op5_line_templates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per document: lines, dropped lines, and the md5 of the text that stays."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return dedup_lines(docs).select("doc_id", F.col("lines_before").alias("n_lines"), F.col("lines_dropped").alias("n_dropped"),
                                    F.md5("text").alias("kept_md5"))


def oracle(min_tokens: int = MIN_TOKENS, depth: int = DEPTH, similarity: float = SIMILARITY) -> str:
    """The rule as stated, over token rows and whole strings: a line without a token is the line with a gap."""
    return rf"""WITH l AS (
        SELECT doc_id, p, line, trim(regexp_replace(line, '\s+', ' ', 'g')) AS clean,
          trim(regexp_replace(regexp_replace(line, '\S*[0-9]\S*', '<*>', 'g'), '\s+', ' ', 'g')) AS norm FROM (
          SELECT doc_id, unnest(x) AS line, generate_subscripts(x, 1) AS p FROM (
            SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS x FROM documents))),
      s AS (SELECT *, string_split(norm, ' ') AS w, len(list_filter(string_split(norm, ' '), lambda x: x = '<*>')) AS masked FROM l WHERE norm <> ''),
      k AS (SELECT doc_id, p, len(w) AS n, masked, w, floor(len(w) * (1 - {similarity}) + 1e-9) AS most,
          len(w) >= {min_tokens} AND masked * 2 <= len(w) AS general, norm, clean FROM s),
      t AS (SELECT *, CASE WHEN general THEN array_to_string(w[1:{depth}], ' ') ELSE 'whole line ' || clean END AS lead,
          CASE WHEN general THEN norm ELSE clean END AS text FROM k),
      u AS (SELECT DISTINCT n, masked, most, lead, text, w FROM t WHERE general),
      tok AS (SELECT *, w[i] AS token, array_to_string(w[1:i - 1], ' ') || ' _ ' || array_to_string(w[i + 1:n], ' ') AS gap
              FROM (SELECT *, unnest(range({depth} + 1, n + 1)) AS i FROM u)),
      v AS (SELECT *, count(*) OVER (PARTITION BY n, lead, i, token) AS c, count(*) OVER (PARTITION BY n, lead, i) AS m,
              count(*) OVER (PARTITION BY n, lead, i, gap) AS lines FROM tok),
      f AS (SELECT *, m > 1 AND (c = 1 OR lines > 1) AS var FROM v),
      r0 AS (SELECT *, row_number() OVER (PARTITION BY n, lead, text ORDER BY var DESC, lines DESC, i) AS place FROM f),
      g AS (SELECT n, lead, text, lead || ' ' || string_agg(CASE WHEN var AND place <= most - masked THEN '<*>' ELSE token END, ' ' ORDER BY i) AS g
            FROM r0 GROUP BY n, lead, text),
      o AS (SELECT t.doc_id, t.p, t.n, t.lead, coalesce(g.g, t.text) AS g FROM t LEFT JOIN g ON t.general AND g.n = t.n AND g.lead = t.lead AND g.text = t.text),
      r AS (SELECT n, lead, g, min((doc_id, p)) AS keep FROM o GROUP BY n, lead, g HAVING count(DISTINCT doc_id) > 1),
      gone AS (SELECT o.doc_id, o.p FROM o JOIN r USING (n, lead, g) WHERE (o.doc_id, o.p) <> r.keep)
      SELECT l.doc_id, count(*) AS n_lines, count(gone.p) AS n_dropped,
             md5(coalesce(string_agg(l.line, chr(10) ORDER BY l.p) FILTER (gone.p IS NULL), '')) AS kept_md5
      FROM l LEFT JOIN gone ON l.doc_id = gone.doc_id AND l.p = gone.p GROUP BY l.doc_id"""
