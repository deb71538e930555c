"""Landing: write derived JSON documents once to the shared folder.

The test bindings derive session documents from the driver tables. Landing
them once and reading them back through ``read_sessions`` means the queries
exercise a real reader, and the JSON is parsed once — a computed
``parse_json`` column would be re-evaluated by every predicate that filter
pushdown copies it into. Session documents land as Parquet partitioned by
day (``land_sessions``), run records as Parquet with a VARIANT column.

A landed folder is keyed by the source files' path, size and modification
time and by the text of the module that derives the data, so a change of
either lands anew. It is written to a unique temporary folder, renamed into
place, and marked complete by a marker file written last; the derivation is
not even planned when a complete copy exists. A client without a JVM gateway
(Spark Connect) cannot list or rename: it lands a copy of its own per call.
"""

from __future__ import annotations

import hashlib
import inspect
import uuid
from collections.abc import Callable
from urllib.parse import quote

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from runlens.session import shared_dir

MARKER = "_LANDED"


class Files:
    """Hadoop's file system of a path (any scheme the cluster supports)."""

    def __init__(self, spark: SparkSession):
        sc = spark.sparkContext
        self._path_class, self._conf = sc._jvm.org.apache.hadoop.fs.Path, sc._jsc.hadoopConfiguration()

    def _at(self, path: str):
        p = self._path_class(path)
        return p.getFileSystem(self._conf), p

    def exists(self, path: str) -> bool:
        fs, p = self._at(path)
        return fs.exists(p)

    def stamp(self, path: str) -> str:
        """Size and time of a file, or of all files of a folder."""
        fs, p = self._at(path)
        found = fs.listStatus(p) if fs.getFileStatus(p).isDirectory() else [fs.getFileStatus(p)]
        return "|".join(sorted(f"{x.getPath().getName()}:{x.getLen()}:{x.getModificationTime()}" for x in found))

    def rename(self, src: str, dst: str) -> bool:
        fs, s = self._at(src)
        return fs.rename(s, self._path_class(dst))

    def touch(self, path: str) -> None:
        fs, p = self._at(path)
        fs.create(p, True).close()

    def delete(self, path: str) -> None:
        fs, p = self._at(path)
        fs.delete(p, True)


def _land(spark: SparkSession, name: str, sources: list[str], write: Callable[[str], None], derivation) -> str:
    """Run ``write(folder)`` once per source fingerprint and text of ``derivation`` (a module)."""
    root = f"{shared_dir(spark)}/landing"
    try:
        files = Files(spark)
    except Exception:  # no JVM gateway on the client
        path = f"{root}/{name}-{uuid.uuid4().hex}"
        write(path)
        return path
    key = "".join(f"{src}|{files.stamp(src)}" for src in sources) + inspect.getsource(derivation)
    path = f"{root}/{name}-{hashlib.sha1(key.encode()).hexdigest()[:16]}"
    if files.exists(f"{path}/{MARKER}"):
        return path
    tmp = f"{path}.tmp-{uuid.uuid4().hex}"
    write(tmp)
    if files.exists(path) or not files.rename(tmp, path):
        return tmp  # another caller landed it meanwhile, or left a part of a copy: use ours
    files.touch(f"{path}/{MARKER}")
    return path


def land_folder(spark: SparkSession, name: str, sources: list[str], derivation, write: Callable[[str], object]) -> str:
    """A folder that ``write`` fills, once per source fingerprint and text of ``derivation``."""
    return _land(spark, name, sources, write, derivation)


def _spread(spark: SparkSession, df: DataFrame) -> DataFrame:
    """A small input (fewer partitions than the cluster runs in parallel, e.g.
    one Parquet row group) is spread before landing, so that reads of the
    landed copy are parallel; large inputs are written as they are."""
    try:
        parallelism = spark.sparkContext.defaultParallelism
        if df.rdd.getNumPartitions() < parallelism:
            return df.repartition(parallelism)
    except Exception:  # no SparkContext on the client (Spark Connect)
        pass
    return df


def land_parquet(spark: SparkSession, name: str, derive: Callable[[], DataFrame], sources: list[str], derivation) -> str:
    """Write what ``derive`` returns (VARIANT columns included) as Parquet, once."""
    return _land(spark, name, sources, lambda tmp: _spread(spark, derive()).write.mode("overwrite").parquet(tmp), derivation)


def land_sessions(spark: SparkSession, name: str, derive: Callable[[], DataFrame], sources: list[str], derivation,
                  doc_col: str = "doc") -> str:
    """Write VARIANT session documents (once) as Parquet partitioned by the
    UTC day of ``created_at``, with ``created_at`` as a typed column: a date
    range then prunes partitions and pushes its bounds into the scan. Rows are
    dealt to tasks by day (a large day to several), so a day has few files.
    Read back with ``read_sessions(fmt="landed")``."""
    from runlens.sources.documents import landed_layout
    return _land(spark, name, sources, lambda tmp: landed_layout(derive(), doc_col).hint("rebalance", "date").write
                 .mode("overwrite").partitionBy("date").parquet(tmp), derivation)


# --- landing batch after batch ------------------------------------------------------
PENDING = "_pending"  # names the merged days that are being put in place
LANDED = "same string, doc_key string, created_at double, doc variant, date date"
NO_DAY = "__HIVE_DEFAULT_PARTITION__"


def _landed(spark: SparkSession, files: Files, target: str) -> DataFrame | None:
    """The landed documents, None if there are none."""
    if not files.exists(target):
        return None
    try:
        rows = spark.read.parquet(target)
    except AnalysisException:  # a folder without data files
        return None
    if "same" not in rows.columns:  # landed by an older layout
        from runlens.sources.documents import landed_layout
        rows = landed_layout(rows)
    return rows


def _put_in_place(spark: SparkSession, files: Files, merged: str, target: str) -> None:
    """Replace the merged days of the target; days that lost all their documents go. May be repeated."""
    spark.read.schema(LANDED).parquet(f"{merged}/days").write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("date").parquet(target)
    for (day,) in spark.read.schema("date string").parquet(f"{merged}/emptied").collect():  # days at most
        files.delete(f"{target}/date={NO_DAY if day is None else quote(day)}")
    files.delete(f"{target}/{PENDING}")


def upsert_sessions(docs: DataFrame, target: str, doc_col: str = "doc") -> str:
    """Land a batch of VARIANT session documents into ``target`` (Parquet by UTC day, see ``land_sessions``): a document
    whose key is there already replaces it, on whatever day the old one lies; all others are added.

    Of several versions in the batch the one with the latest ``created_at`` counts (then the greater hash of
    its text). Documents without a key are the same if their text is, so a batch that is landed twice is there
    once. Documents without ``created_at`` lie on a day of their own. Only days of the batch and days that
    lose a version are rewritten; of the others the keys are read. The merged days are written aside in full first and named in
    ``target/_pending``; a landing that was lost on the way is completed by the next one, before its own batch."""
    from runlens.sources.documents import landed_layout
    spark = docs.sparkSession
    files = Files(spark)
    if files.exists(f"{target}/{PENDING}"):
        _put_in_place(spark, files, spark.read.text(f"{target}/{PENDING}").first()[0], target)
    out = f"{shared_dir(spark)}/landing/upsert-{uuid.uuid4().hex}"
    columns = ["same", "doc_key", "created_at", "doc", "date"]
    version = F.struct("created_at", F.xxhash64(F.to_json("doc")))
    newest = landed_layout(docs, doc_col).groupBy(F.col("same").alias("_same")).agg(F.max_by(F.struct(*columns), version).alias("r")).select("r.*")
    newest.write.parquet(f"{out}/batch")
    batch = spark.read.schema(newest.schema).parquet(f"{out}/batch")
    landed, touched = _landed(spark, files, target), batch.select("date").limit(0)
    if landed is None:
        merged = batch
    else:
        moved = landed.join(batch.select("same"), "same", "left_semi").select("date")  # reads the key column
        days_of = moved.unionAll(batch.select("date")).distinct()
        days_of.write.parquet(f"{out}/touched")
        touched = spark.read.schema(days_of.schema).parquet(f"{out}/touched")
        days = [d for (d,) in touched.collect()]  # days at most
        in_days = F.col("date").isin([d for d in days if d is not None]) | (F.col("date").isNull() if None in days else F.lit(False))
        merged = landed.where(in_days).join(batch.select("same"), "same", "left_anti").select(*columns).unionAll(batch.select(*columns))
    if landed is None and batch.isEmpty():
        return target
    merged.hint("rebalance", "date").write.partitionBy("date").parquet(f"{out}/days")
    day = F.col("date").cast("string").alias("date")
    left = spark.read.schema(merged.schema).parquet(f"{out}/days").select(day).distinct()
    touched.select(day).distinct().exceptAll(left).coalesce(1).write.parquet(f"{out}/emptied")
    spark.createDataFrame([(out,)], "path string").coalesce(1).write.mode("overwrite").text(f"{target}/{PENDING}")
    _put_in_place(spark, files, out, target)
    files.delete(out)
    return target
