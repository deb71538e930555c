"""Readers for the driver's parquet tables and their bindings to the run model.

A *binding* says which columns of a table play the run roles. Bindings are
plain projections: they keep the scan prunable (only the columns a binding
uses are read) and add no shuffle.

  B1 lineitem       session = l_orderkey; run order = (l_linenumber, l_partkey,
                    l_suppkey, l_extendedprice, l_shipdate, l_quantity)
  B3 conversations  session = conv_id; run order = turn
  B4 orders         sessions without runs; created_at = o_orderdate
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from runlens.functions.dates import epoch_seconds

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations"]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


# --- B1 lineitem ---------------------------------------------------------
LINEITEM_ORDER = ["l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice", "l_shipdate", "l_quantity"]


def lineitem_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Run table: one run per line item, session = order."""
    li = table(spark, sf_dir, "lineitem")
    c = F.col
    return li.select(
        c("l_orderkey").alias("session_key"),
        *[c(o) for o in LINEITEM_ORDER],
        F.when(c("l_discount") == 0, F.lit(0.0)).otherwise(F.floor("l_extendedprice").cast("double"))
        .alias("total_tokens"),
        F.floor(c("l_extendedprice") * c("l_discount")).cast("double").alias("output_tokens"),
        F.when(c("l_quantity") <= 2, F.lit(0.0)).otherwise(c("l_quantity") * 1.5).alias("execution_time"),
        F.when(c("l_partkey") % 7 == 0, c("l_partkey") % 25).otherwise(F.lit(0)).cast("long")
        .alias("tool_calls_count"),
        (c("l_returnflag") != "R").alias("success"),
        F.when(c("l_returnflag") == "A", F.lit(1)).otherwise(F.lit(0)).cast("long").alias("error_count"),
        (c("l_quantity") == 50).alias("has_timeout"),
    )


# --- B3 conversations ------------------------------------------------------
def conversation_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Run table: one run per turn; no execution time, so the time and speed
    groups take their empty values."""
    cv = table(spark, sf_dir, "conversations")
    c = F.col
    n_chars = F.length("text").cast("double")
    return cv.select(
        c("conv_id").alias("session_key"),
        c("turn"),
        n_chars.alias("total_tokens"),
        F.when(c("role") == "assistant", n_chars).otherwise(F.lit(0.0)).alias("output_tokens"),
        F.lit(0.0).alias("execution_time"),
        (F.length("text") - F.length(F.regexp_replace("text", "\\?", ""))).cast("long").alias("tool_calls_count"),
        (c("role") != "system").alias("success"),
        F.lit(0).cast("long").alias("error_count"),
        F.lit(False).alias("has_timeout"),
    )


# --- B4 orders --------------------------------------------------------------
def order_sessions(spark: SparkSession, sf_dir: str, start: str | None = None,
                   end: str | None = None) -> DataFrame:
    """Session table (documents without runs) from orders.

    With a range, the filter compares ``o_orderdate`` itself with literal
    bounds (``start 00:00:00`` .. ``end 23:59:59``, session time zone), so it
    reaches the Parquet scan as a pushed filter.
    """
    o = table(spark, sf_dir, "orders")
    if start is not None:
        typ = dict(o.dtypes)["o_orderdate"]
        lo = F.lit(f"{start} 00:00:00").cast(typ)
        hi = F.lit(f"{end} 23:59:59").cast(typ)
        o = o.filter((F.col("o_orderdate") >= lo) & (F.col("o_orderdate") <= hi))
    return o.select(
        F.col("o_orderkey").alias("_id_key"),
        F.col("o_orderkey").cast("string").alias("_id"),
        F.col("o_orderkey").cast("string").alias("session_id"),
        F.col("o_custkey").cast("string").alias("user_id"),
        epoch_seconds(F.col("o_orderdate"), dict(o.dtypes)["o_orderdate"]).alias("created_at"),
        F.col("o_orderpriority").alias("agent_name"),
        F.col("o_orderstatus").alias("model_provider"),
        F.concat(F.lit("m"), (F.col("o_custkey") % 10).cast("string")).alias("model_id"),
    )
