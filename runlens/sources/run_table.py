"""Run tables stored in the order the flat kernel works in.

``write_run_table`` lays a run table down once, in three parts of one folder:

  sessions  runs of ordinary sessions, bucketed by session and sorted by (session,
            run order): one file a bucket, so windows and aggregations over a session read
            their bucket and need no exchange
  hot       runs of hot sessions, cut by rank into chunks (see ``flat_kernel``), with their chunk
  layout    one row: columns, number of buckets, which parts hold rows

The hot sessions are found while writing, by the heavy-hitter summary, so reading needs
neither a count nor a look at the source. Buckets are a property of a catalog
table: a session that opens the folder registers it under a name made from its place.
"""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from runlens.config import DEFAULT_THRESHOLDS, Thresholds
from runlens.operators.flat_kernel import BASE_STATS, C, K, chunked_statistics, hot_keys, plain_statistics, run_columns, with_chunks
from runlens.operators.run_metric import RunMetric

LAYOUT = "key string, orders array<string>, buckets int, any_hot boolean"


@dataclass(frozen=True)
class RunTable:
    path: str
    key: str
    orders: list[str]  # columns that order the runs of a session
    sessions: DataFrame
    hot: DataFrame | None


def write_run_table(runs: DataFrame, path: str, key: str, order: Sequence[str] | str, buckets: int | None = None,
                    chunk_bits: int = 16) -> str:
    """Write ``runs`` (read once) to ``path``; returns it. The folder must not exist."""
    spark = runs.sparkSession
    buckets = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
    r, orders = run_columns(runs, key, order)
    r, hot, n_hot, limit = hot_keys(r, True, chunk_bits)
    if hot:
        keys = F.broadcast(spark.createDataFrame([(k,) for k in hot], r.select(F.col(K).alias("_hot")).schema))
        same = F.col(K).eqNullSafe(F.col("_hot"))
        with_chunks(r.join(keys, same, "left_semi"), n_hot, orders, limit).write.parquet(f"{path}/hot")
        r = r.join(keys, same, "left_anti")
    name = f"runlens_write_{uuid.uuid4().hex}"  # only a catalog table can be bucketed
    (r.repartition(buckets, K).write.format("parquet").bucketBy(buckets, K).sortBy(K, *orders)
     .option("path", f"{path}/sessions").saveAsTable(name))
    spark.sql(f"DROP TABLE {name}")  # external: the files stay
    spark.createDataFrame([(key, orders, buckets, bool(hot))], LAYOUT).coalesce(1).write.parquet(f"{path}/layout")
    return path


def open_run_table(spark: SparkSession, path: str) -> RunTable:
    key, orders, buckets, any_hot = spark.read.schema(LAYOUT).parquet(f"{path}/layout").first()
    name = f"runlens_runs_{hashlib.sha1(path.encode()).hexdigest()[:16]}"
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in spark.read.parquet(f"{path}/sessions").schema)
    sort = ", ".join(f"`{c}`" for c in [K, *orders])
    place = f"{path}/sessions".replace("'", "\\'")
    spark.sql(f"CREATE TABLE IF NOT EXISTS {name} ({columns}) USING parquet CLUSTERED BY (`{K}`) SORTED BY ({sort}) "
              f"INTO {buckets} BUCKETS LOCATION '{place}'")
    return RunTable(path, key, list(orders), spark.table(name), spark.read.parquet(f"{path}/hot") if any_hot else None)


def run_table_statistics(table: RunTable, th: Thresholds = DEFAULT_THRESHOLDS, metrics: Sequence[RunMetric] = ()) -> DataFrame:
    """Base statistics as of ``flat_run_statistics``: ordinary sessions without an exchange, hot ones from their chunks."""
    stats = plain_statistics(table.sessions, table.orders, th, metrics)
    if table.hot is not None:
        stats = stats.unionByName(chunked_statistics(table.hot, table.orders, th, metrics))
    return stats.select(F.col(K).alias(table.key), *BASE_STATS, *[m.column for m in metrics])
