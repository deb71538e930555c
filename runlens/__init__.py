"""runlens — session anomaly features for AI-agent run logs, on Spark.

Layout:
  sources/    readers for session documents and run tables; landing; test-table bindings
  functions/  column builders (run normalisation, dates, request checks)
  operators/  run-statistics kernels (flat, nested), metric derivation, semi-join restriction
  plans/      end-to-end plans (documents, features, export), the job, the query catalog

Typical use::

    from runlens import read_sessions, normalize_documents, document_features, training_rows
    docs = read_sessions(spark, "/data/sessions", "json", "2024-12-20", "2024-12-25")
    feats = document_features(normalize_documents(docs))

or the whole job: ``run_extraction(spark, source, output_root, start, end)``.
"""

from runlens.config import EXPORT_COLUMNS, Thresholds
from runlens.plans.documents import document_features, normalize_documents, quarantined_documents, run_table
from runlens.plans.export import export_manifest, training_rows, write_training_export
from runlens.plans.features import features_from_nested, features_from_runs
from runlens.plans.job import check_request, land_documents, run_extraction
from runlens.session import tune_session
from runlens.sources.documents import read_sessions

__all__ = [
    "EXPORT_COLUMNS", "Thresholds",
    "read_sessions", "normalize_documents", "quarantined_documents", "run_table", "document_features",
    "features_from_runs", "features_from_nested",
    "training_rows", "write_training_export", "export_manifest",
    "check_request", "run_extraction", "land_documents", "tune_session",
]
