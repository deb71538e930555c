"""Zone map of raw session files: which files can hold documents of a date range.

JSON files cannot be pruned by their content, so a range would parse all of them.
The zone map is a side table with one row per file: size, time stamp, number of
documents and the least and greatest ``created_at``. It is brought up to date
before a read (files that are new or have another size or time stamp are
parsed once, rows of files that went are dropped), and a range then opens only the files that
overlap it. Documents without ``created_at`` are in no range and do not widen one.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from runlens.functions.dates import range_bounds
from runlens.sources.landing import Files

ZONES = "file string, path string, bytes long, modified timestamp, documents long, first double, last double"


def _listed(spark: SparkSession, path: str) -> DataFrame:
    """The files below ``path``, from the listing (no content is read)."""
    return spark.read.format("binaryFile").load(path).select(
        F.col("_metadata.file_path").alias("file"), "path", F.col("length").alias("bytes"), F.col("modificationTime").alias("modified"))


def _measured(spark: SparkSession, files: DataFrame) -> DataFrame:
    """Zones of ``files`` by parsing them."""
    paths = [p for (p,) in files.select("path").collect()]  # names of new files, as many as the read lists
    if not paths:
        return spark.createDataFrame([], ZONES)
    docs = spark.read.option("singleVariantColumn", "doc").json(paths)
    created = F.try_variant_get("doc", "$.created_at", "double")
    zones = docs.select(F.col("_metadata.file_path").alias("file"), created.alias("created")).groupBy("file").agg(
        F.count(F.lit(1)).alias("documents"), F.min("created").alias("first"), F.max("created").alias("last"))
    return files.join(zones, "file", "left").select("file", "path", "bytes", "modified", F.coalesce("documents", F.lit(0)).alias("documents"), "first", "last")


def refresh_zone_map(spark: SparkSession, path: str, map_path: str) -> DataFrame:
    """The zone map of the files below ``path``, kept at ``map_path`` (outside ``path``) and written anew if a file changed."""
    files = Files(spark)
    listed = _listed(spark, path)
    known = spark.read.schema(ZONES).parquet(map_path) if files.exists(map_path) else spark.createDataFrame([], ZONES)
    same = ["file", "path", "bytes", "modified"]
    kept = known.join(listed, same, "left_semi")
    fresh = listed.join(known, same, "left_anti")
    if fresh.isEmpty() and known.count() == kept.count() and files.exists(map_path):
        return known
    beside, before = f"{map_path}.{uuid.uuid4().hex}", f"{map_path}.before-{uuid.uuid4().hex}"
    kept.unionByName(_measured(spark, fresh)).coalesce(1).write.parquet(beside)
    if files.exists(map_path):
        files.rename(map_path, before)
    files.rename(beside, map_path)
    files.delete(before)
    return spark.read.schema(ZONES).parquet(map_path)


def files_in_range(zones: DataFrame, start: str, end: str, tz: str = "UTC") -> list[str]:
    """Paths of the files whose documents may lie in the range."""
    lo, hi = range_bounds(start, end, tz)
    return [p for (p,) in zones.where((F.col("last") >= lo) & (F.col("first") <= hi)).select("path").orderBy("path").collect()]


def read_json_range(spark: SparkSession, path: str, map_path: str, start: str, end: str, tz: str = "UTC", **options: str) -> DataFrame:
    """Session documents (``doc``) of a range from the JSON files below ``path``: only files that overlap it are opened."""
    paths = files_in_range(refresh_zone_map(spark, path, map_path), start, end, tz)
    if not paths:
        return spark.createDataFrame([], "doc variant")
    lo, hi = range_bounds(start, end, tz)
    created = F.try_variant_get("doc", "$.created_at", "double")
    docs = spark.read.options(**options).option("singleVariantColumn", "doc").json(paths)
    return docs.where((created >= lo) & (created <= hi))
