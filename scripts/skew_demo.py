"""Skew demonstration: one session holds a third of all runs.

Derives a run table from lineitem (sf0.1 by default, replicated ``copies``
times): every line item of an order with ``l_orderkey % 3 = 0`` is moved into
one hot session, all others keep their order (and copy) as session.

Runs the same 43-metric computation with the flat kernel's three
strategies — ``plain`` (every session in one window partition, the textbook
plan), ``auto`` (sessions longer than one chunk are chunked, the rest plain)
and ``chunked`` (every session chunked) — and prints wall time and task
times of each, read from Spark's event log in a scratch folder.

Usage: python scripts/skew_demo.py [sf_dir] [chunk_bits] [copies]
"""

from __future__ import annotations

import glob
import json
import os
import sys
import tempfile
import time

import zstandard

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import SparkSession  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402

from runlens.plans.features import features_from_runs  # noqa: E402
from runlens.sources.tables import lineitem_runs  # noqa: E402


def skewed_runs(spark, sf_dir, copies):
    """lineitem runs, ``copies`` times (copy c of order k is session k * copies + c);
    sessions with k % 3 = 0 all become session 0. Positions are per session,
    as in the run model (a run's index in its session): the line number, and
    for the hot session (k div 3, copy, line number) packed into one number."""
    runs = lineitem_runs(spark, sf_dir).withColumn("_copy", F.explode(F.sequence(F.lit(0), F.lit(copies - 1))))
    hot = F.col("session_key") % 3 == 0
    key = F.col("session_key") * copies + F.col("_copy")
    hot_pos = ((F.col("session_key") / 3).cast("long") * copies + F.col("_copy")) * 8 + F.col("l_linenumber")
    return runs.select(
        F.when(hot, F.lit(0)).otherwise(key).alias("session_key"),
        F.when(hot, hot_pos).otherwise(F.col("l_linenumber").cast("long")).alias("pos"),
        "total_tokens", "output_tokens", "execution_time", "tool_calls_count", "error_count", "success",
        "has_timeout",
    )


def task_times(log_dir):
    """(job group -> list of task durations in ms) from the event log."""
    out = {}
    stage_group = {}
    tasks = []
    for f in glob.glob(f"{log_dir}/*/events*"):
        raw = open(f, "rb").read()
        text = zstandard.ZstdDecompressor().stream_reader(raw).read().decode() if f.endswith(".zstd") else raw.decode()
        for line in text.splitlines():
            e = json.loads(line)
            if e["Event"] == "SparkListenerJobStart":
                group = e.get("Properties", {}).get("spark.jobGroup.id")
                for sid in e.get("Stage IDs", []):
                    stage_group[sid] = group
            elif e["Event"] == "SparkListenerTaskEnd":
                info = e["Task Info"]
                tasks.append((e["Stage ID"], info["Finish Time"] - info["Launch Time"]))
    for sid, ms in tasks:
        out.setdefault(stage_group.get(sid), []).append(ms)
    return out


def main():
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    chunk_bits = int(sys.argv[2]) if len(sys.argv) > 2 else 16
    copies = int(sys.argv[3]) if len(sys.argv) > 3 else 10
    log_dir = tempfile.mkdtemp(prefix="skew-demo-")
    spark = (SparkSession.builder.master("local[8]").config("spark.sql.shuffle.partitions", "32")
             .config("spark.ui.enabled", "false").config("spark.sql.session.timeZone", "UTC")
             .config("spark.eventLog.enabled", "true").config("spark.eventLog.dir", log_dir)
             .config("spark.driver.memory", "16g").config("spark.sql.codegen.hugeMethodLimit", "8000").getOrCreate())
    spark.sparkContext.setLogLevel("ERROR")
    def kernel(strategy):
        return lambda: features_from_runs(skewed_runs(spark, sf_dir, copies), "session_key", "pos",
                                          chunk_bits=chunk_bits, strategy=strategy)

    plans = {
        "plain": kernel("plain"),      # every session in one window partition
        "auto": kernel("auto"),        # hot sessions chunked, the rest plain
        "chunked": kernel("chunked"),  # every session chunked
    }
    wall = {}
    for rep in range(2):
        for name, build in plans.items():
            spark.sparkContext.setJobGroup(f"{name}-{rep}", name)
            t0 = time.perf_counter()
            build().write.format("noop").mode("overwrite").save()
            wall[name] = time.perf_counter() - t0
    spark.stop()
    tasks = task_times(log_dir)
    for name in plans:
        d = sorted(tasks.get(f"{name}-1", []))
        print(json.dumps({"plan": name, "wall_s": round(wall[name], 2), "tasks": len(d),
                          "max_task_ms": d[-1] if d else None, "median_task_ms": d[len(d) // 2] if d else None}))


if __name__ == "__main__":
    main()
