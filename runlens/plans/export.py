"""Training export: 48 fixed columns as CSV, the empty-range placeholder,
the manifest read back from the written files, and the run summary."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from runlens.config import (EMPTY_EXPORT_HEADER, EMPTY_EXPORT_ROW, EXPORT_COLUMNS, EXPORT_DIR_TEMPLATE,
                            TEXT_COLUMNS)
from runlens.sources.landing import Files


def training_rows(features: DataFrame) -> DataFrame:
    """The 48 export columns in order; missing text is '' and missing numbers 0
    (so a session without runs exports 0 everywhere, growth rate included)."""
    cols = []
    for name in EXPORT_COLUMNS:
        if name in features.columns:
            c = F.col(name)
        else:
            c = F.lit(None)
        if name in TEXT_COLUMNS:
            cols.append(F.coalesce(c.cast("string"), F.lit("")).alias(name))
        else:
            dtype = dict(features.dtypes).get(name, "int")
            cols.append(F.coalesce(c, F.lit(0).cast(dtype)).cast(dtype).alias(name))
    return features.select(*cols)


def empty_placeholder(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([EMPTY_EXPORT_ROW], EMPTY_EXPORT_HEADER)


def export_frame(spark: SparkSession, features: DataFrame, sessions: DataFrame | None = None) -> DataFrame:
    """Training rows, or the one-row placeholder when there is no session.
    ``isEmpty`` reads at most one row (no full count), of ``sessions`` (the
    documents the features come from) if given, so no kernel runs for it."""
    empty = (features if sessions is None else sessions).isEmpty()
    return empty_placeholder(spark) if empty else training_rows(features)


# Quotes are doubled, text is kept as it is (blanks, line breaks), an empty text is an empty field.
CSV_OPTIONS = {"header": "true", "quote": '"', "escape": '"', "ignoreLeadingWhiteSpace": "false",
               "ignoreTrailingWhiteSpace": "false", "emptyValue": "", "nullValue": ""}


def read_export(spark: SparkSession, path: str, **options: str) -> DataFrame:
    """An export read back by the rules it was written by (all columns text)."""
    return spark.read.options(**CSV_OPTIONS, **options).option("multiLine", True).csv(path)


def export_path(root: str, start: str, end: str) -> str:
    return f"{root.rstrip('/')}/" + EXPORT_DIR_TEMPLATE.format(start=start, end=end)


EXPORT_METADATA = {"generated_by": "runlens", "version": "2.0"}
MANIFEST = "_manifest"  # inside the export; readers pass over names that begin with _
_FILE = "file string, bytes long, rows long, digest decimal(38,0), version string, written_at timestamp"


class ExportNotVerified(RuntimeError):
    """What was read back is not what was written; the export that was there before is left alone."""


def _row_digest(columns: list[str]) -> Column:
    """A row's hash, of its texts as the CSV holds them."""
    return F.xxhash64(*[F.coalesce(F.col(c).cast("string"), F.lit("")) for c in columns]).cast("decimal(38,0)")


def _read_files(spark: SparkSession, path: str) -> DataFrame:
    """(file, bytes, rows, digest) of every part file: rows and digest from reading it back, bytes from the listing."""
    back = read_export(spark, path)
    name = F.element_at(F.split(F.col("_metadata.file_path"), "/"), -1)
    rows = back.select(_row_digest(back.columns).alias("d"), name.alias("file")).groupBy("file").agg(
        F.count(F.lit(1)).alias("rows"), F.sum("d").alias("digest"))
    files = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(path).select(
        F.element_at(F.split("path", "/"), -1).alias("file"), F.col("length").alias("bytes"))
    return files.join(rows, "file", "left").select("file", "bytes", F.coalesce("rows", F.lit(0)).alias("rows"), F.coalesce("digest", F.lit(0)).alias("digest"))


def _write_verified(spark: SparkSession, out: DataFrame, path: str, version: str, single_file: bool) -> int:
    """Write rows, counted and digested while they are written, read the files back, compare and add the manifest."""
    seen = Observation()
    counted = out.observe(seen, F.count(F.lit(1)).alias("rows"), F.sum(_row_digest(out.columns)).alias("digest"))
    (counted.repartition(1) if single_file else counted).write.options(**CSV_OPTIONS).csv(path)
    written = seen.get
    files = _read_files(spark, path).withColumns({"version": F.lit(version), "written_at": F.current_timestamp()})
    files.coalesce(1).write.json(f"{path}/{MANIFEST}")
    back = spark.read.schema(_FILE).json(f"{path}/{MANIFEST}").agg(F.sum("rows").alias("rows"), F.sum("digest").alias("digest")).first()
    if (back["rows"] or 0, back["digest"] or 0) != (written["rows"], written["digest"] or 0):
        raise ExportNotVerified(f"{path}: {written['rows']} rows written, {back['rows']} read back, or their digests differ")
    return written["rows"]


def write_training_export(spark: SparkSession, features: DataFrame, root: str, start: str, end: str,
                          single_file: bool = False) -> str:
    """Write the export as CSV with a header; returns the folder.

    Two phases: the new export is written beside the old one and verified (row count and digest taken while
    writing against the files read back, one placeholder row if there was no row); then the folder is switched and the
    old export goes. A run that fails before the switch leaves the old export as it was; one that fails
    between the two renames leaves it under ``<folder>.before``, and the next run starts from there. The features are
    computed once, without a reading for the empty range.

    Many part files by default. ``single_file`` adds ``repartition(1)`` — one
    shuffle into one writer task, while everything upstream stays parallel
    (``coalesce(1)`` would pull the whole plan into a single task).
    """
    path = export_path(root, start, end)
    files = Files(spark)
    before, version = f"{path}.before", uuid.uuid4().hex
    if files.exists(before):  # a switch was lost halfway
        if files.exists(path):
            files.delete(before)
        else:
            files.rename(before, path)
    parent, name = path.rsplit("/", 1)
    beside = f"{parent}/_{name}-{version}"
    try:
        if not _write_verified(spark, training_rows(features), beside, version, single_file):
            files.delete(beside)
            _write_verified(spark, empty_placeholder(spark), beside, version, True)
    except Exception:
        files.delete(beside)
        raise
    if files.exists(path) and not files.rename(path, before):
        raise OSError(f"the old export {path} could not be moved")
    if not files.rename(beside, path):
        if files.exists(before):
            files.rename(before, path)
        raise OSError(f"the new export could not be moved to {path}")
    if files.exists(before):
        files.delete(before)
    return path


def export_files(spark: SparkSession, path: str) -> DataFrame:
    """The committed version's part files: file, bytes, rows, digest, version, written_at."""
    return spark.read.schema(_FILE).json(f"{path}/{MANIFEST}")


def export_manifest(spark: SparkSession, path: str) -> DataFrame:
    """One row describing a written export, from its list of files: how many there are, their rows and bytes,
    whether the write is complete, the committed version, and static metadata."""
    return export_files(spark, path).agg(
        F.lit(path).alias("location"), F.count(F.lit(1)).alias("files"), F.coalesce(F.sum("rows"), F.lit(0)).alias("rows"),
        F.coalesce(F.sum("bytes"), F.lit(0)).alias("bytes"), (F.count(F.lit(1)) > 0).alias("success"),
        *[F.lit(v).alias(k) for k, v in EXPORT_METADATA.items()], F.max("version").alias("committed"), F.max("written_at").alias("written_at"))


def extraction_summary(sessions: DataFrame, start: str, end: str, location: str | None = None) -> DataFrame:
    """One-row summary of an extraction (one aggregation, no repeated scans)."""
    return sessions.agg(
        F.lit(start).alias("start_date"),
        F.lit(end).alias("end_date"),
        F.count(F.lit(1)).alias("total_conversations"),
        F.min("created_at").cast("long").alias("first_created_at"),
        F.max("created_at").cast("long").alias("last_created_at"),
        F.lit(location).cast("string").alias("location"),
    )
