"""The extraction job: request -> sessions in range -> features -> CSV export.

    python -m runlens.plans.job --source /data/sessions/ --format json \\
        --start 2024-12-20 --end 2024-12-25 --output /data/exports
    python -m runlens.plans.job --source /data/sessions/ --land-to /data/landed
    python -m runlens.plans.job --source /data/landed --format landed --start ... --end ... --output ...

Steps (one lazy plan up to the sink, which counts what passes; then the written
files are read back):
  1. check the request (start required, end required, formats, order);
     if a date is missing, use the default range (one month before ``as_of``
     to the day before)
  2. read the session documents of the range (VARIANT reader for JSON, typed
     reader with a pushed-down date filter for Parquet or a store connector)
  3. normalise runs, set malformed documents aside with a reason
  4. nested kernel (row-local) -> 43 metrics; or the flat kernel over the
     exploded runs (``kernel="flat"``) for sessions too long for one row
  5. write the 48-column CSV beside the old one (placeholder when the range is
     empty), verify it, switch; the summary comes from the counts taken on the
     way and the manifest of the written files
"""

from __future__ import annotations

import argparse
import datetime as dt
import json

from pyspark.sql import Observation, SparkSession
from pyspark.sql import functions as F

from runlens.config import DEFAULT_THRESHOLDS, Thresholds
from runlens.functions.dates import default_range, request_error
from runlens.plans.documents import (REASONS, document_features, normalize_documents, observed_documents,
                                     quarantined_documents, quarantined_runs)
from runlens.plans.export import export_manifest, write_training_export
from runlens.session import tune_session
from runlens.sources.documents import read_sessions
from runlens.sources.landing import upsert_sessions


class InvalidRequest(ValueError):
    pass


def check_request(spark: SparkSession, start: str | None, end: str | None,
                  as_of: dt.date | None = None) -> tuple[str, str]:
    """Validated (start, end); a missing date -> the default range for both."""
    if not start or not end:
        return default_range(as_of or dt.datetime.now(dt.timezone.utc).date())
    err = spark.createDataFrame([(start, end)], "s string, e string").select(
        request_error(F.col("s"), F.col("e"))).first()[0]
    if err:
        raise InvalidRequest(err)
    return start, end


def run_extraction(
    spark: SparkSession,
    source: str,
    output_root: str,
    start: str | None = None,
    end: str | None = None,
    fmt: str = "json",
    kernel: str = "nested",
    single_file: bool = False,
    write_quarantine: bool = False,
    as_of: dt.date | None = None,
    th: Thresholds = DEFAULT_THRESHOLDS,
    tz: str = "UTC",
    **source_options: str,
) -> dict:
    """Run the extraction for one request; returns the summary.

    ``tz`` is the zone of the range and of the rendered dates. Exported doubles
    are not rounded. The summary counts the set-aside documents by reason.

    The source is read once: documents, reasons and times are observed while the export is written.
    ``write_quarantine`` also writes the set-aside documents with their
    reason and the dropped runs with their place next to the export — further
    passes over the source, so off by default.
    """
    tune_session(spark)
    start, end = check_request(spark, start, end, as_of)
    docs = read_sessions(spark, source, fmt, start, end, tz, **source_options)
    norm, seen = normalize_documents(docs), Observation()
    feats = document_features(observed_documents(norm, seen), th, kernel=kernel, tz=tz)
    path = write_training_export(spark, feats, output_root, start, end, single_file=single_file)
    counts = seen.get  # counted by the job that wrote the export
    manifest = export_manifest(spark, path).first().asDict()
    set_aside = {r: counts[r] for r in REASONS if counts[r]}
    summary = {
        "message": f"sessions between {start} and {end} extracted",
        "start_date": start,
        "end_date": end,
        "total_conversations": counts["documents"] - sum(set_aside.values()),
        "first_created_at": counts["first"],
        "last_created_at": counts["last"],
        "location": path,
        "files": manifest["files"],
        "bytes": manifest["bytes"],
        "success": manifest["success"],
        "version": manifest["committed"],
        "quarantined": set_aside,
        "processing_timestamp": dt.datetime.now(dt.timezone.utc).isoformat(),
    }
    if write_quarantine:
        summary["quarantine_location"] = f"{path}_quarantine"
        quarantined_documents(norm).write.mode("overwrite").json(summary["quarantine_location"])
        summary["quarantined_runs_location"] = f"{path}_quarantined_runs"
        quarantined_runs(docs).write.mode("overwrite").json(summary["quarantined_runs_location"])
    return summary


def land_documents(spark: SparkSession, source: str, target: str, fmt: str = "json", **options: str) -> str:
    """Merge session documents into the landed layout (VARIANT in Parquet, partitioned by day) by their key, the newest
    version staying (``upsert_sessions``), so later extractions read only the days of their
    range: ``run_extraction(..., fmt="landed", source=target)``."""
    return upsert_sessions(read_sessions(spark, source, fmt, **options), target)


def main(argv: list[str] | None = None) -> None:
    p = argparse.ArgumentParser(description="Extract session features to a training CSV.")
    p.add_argument("--source", required=True)
    p.add_argument("--output", help="export root (required unless --land-to)")
    p.add_argument("--format", default="json")
    p.add_argument("--start")
    p.add_argument("--end")
    p.add_argument("--tz", default="UTC")
    p.add_argument("--kernel", choices=["nested", "flat"], default="nested")
    p.add_argument("--single-file", action="store_true")
    p.add_argument("--write-quarantine", action="store_true")
    p.add_argument("--option", action="append", default=[], help="source option key=value")
    p.add_argument("--land-to", help="only copy the source into the landed layout at this path")
    a = p.parse_args(argv)
    if not a.land_to and not a.output:
        p.error("--output is required for an extraction")
    options = dict(kv.split("=", 1) for kv in a.option)
    spark = SparkSession.builder.appName("runlens-extraction").getOrCreate()
    if a.land_to:
        print(json.dumps({"landed": land_documents(spark, a.source, a.land_to, a.format, **options)}))
        return
    result = run_extraction(spark, a.source, a.output, a.start, a.end, a.format, a.kernel, a.single_file,
                            a.write_quarantine, tz=a.tz, **options)
    print(json.dumps(result))


if __name__ == "__main__":
    main()
