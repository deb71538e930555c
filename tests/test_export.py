"""Training export: column order, fills, CSV round trip, empty range,
manifest read back from the files."""

from __future__ import annotations

import pytest

import csv
import glob
import os

from runlens.config import EMPTY_EXPORT_ROW, EXPORT_COLUMNS
from runlens.plans.export import export_manifest, export_path, read_export, training_rows, write_training_export


def _features(spark):
    # one session with metrics, one without runs (NULL metrics)
    cols = ", ".join(f"CAST(NULL AS DOUBLE) AS {c}" for c in EXPORT_COLUMNS[5:])
    with_runs = ", ".join(
        f"CAST(1 AS {'INT' if c.endswith('_flag') else 'DOUBLE'}) AS {c}" for c in EXPORT_COLUMNS[5:])
    return spark.sql(f"""
        SELECT 'a' AS session_id, 'agent' AS agent_name, 'p' AS model_provider, 'm' AS model_id,
               CAST(3 AS BIGINT) AS total_runs, 'extra' AS user_id, {with_runs}
        UNION ALL
        SELECT 'b', NULL, NULL, NULL, CAST(0 AS BIGINT), NULL, {cols}""")


def test_training_rows_order_and_fill(spark):
    rows = training_rows(_features(spark))
    assert rows.columns == EXPORT_COLUMNS
    b = rows.filter("session_id = 'b'").first().asDict()
    assert b["agent_name"] == "" and b["max_token_growth_rate"] == 0 and b["failure_rate"] == 0


def test_write_and_manifest(spark, tmp_path):
    root = str(tmp_path)
    path = write_training_export(spark, _features(spark), root, "2024-12-20", "2024-12-25", single_file=True)
    assert path == export_path(root, "2024-12-20", "2024-12-25")
    assert path.endswith("ml-training-data/2024-12-20_to_2024-12-25/conversations_2024-12-20_to_2024-12-25")
    parts = glob.glob(os.path.join(path, "part-*.csv"))
    assert len(parts) == 1
    with open(parts[0]) as fh:
        rows = list(csv.reader(fh))
    assert rows[0] == EXPORT_COLUMNS and len(rows) == 3
    m = export_manifest(spark, path).first()
    assert (m["files"], m["rows"]) == (1, 2)
    assert m["bytes"] == os.path.getsize(parts[0])


def test_text_survives_the_round_trip(spark, tmp_path):
    texts = ['say "hi", ok', "  pad  ", "two\nlines", "", 'a\\b"', ","]
    cols = [f"CAST(0.1 AS DOUBLE) AS {c}" for c in EXPORT_COLUMNS[5:]]
    feats = spark.createDataFrame([(f"s{i}", t) for i, t in enumerate(texts)], "session_id string, agent_name string").selectExpr(
        "*", "'p' AS model_provider", "'m' AS model_id", "1L AS total_runs", *cols)
    for n, single in enumerate((True, False)):
        path = write_training_export(spark, feats.repartition(4), str(tmp_path / str(n)), "2024-12-20", "2024-12-25", single_file=single)
        parts = glob.glob(os.path.join(path, "part-*.csv"))
        rows = [r for p in parts for r in csv.DictReader(open(p, newline=""))]
        assert {r["session_id"]: r["agent_name"] for r in rows} == {f"s{i}": t for i, t in enumerate(texts)}
        assert all(len(r) == len(EXPORT_COLUMNS) and r["avg_tool_calls"] == "0.1" for r in rows)
        back = {r["session_id"]: r["agent_name"] or "" for r in read_export(spark, path).collect()}
        assert back == {f"s{i}": t for i, t in enumerate(texts)}
        m = export_manifest(spark, path).first()
        assert (m["files"], m["rows"], m["bytes"], m["success"]) == (len(parts), len(texts), sum(map(os.path.getsize, parts)), True)


def test_empty_range_writes_placeholder(spark, tmp_path):
    empty = _features(spark).filter("false")
    path = write_training_export(spark, empty, str(tmp_path), "2030-01-01", "2030-01-02")
    back = spark.read.option("header", True).csv(path).collect()
    assert [tuple(r) for r in back] == [EMPTY_EXPORT_ROW]


def test_a_failed_write_leaves_the_old_export(spark, tmp_path, monkeypatch):
    """The second write is killed in its rows, in its check and in its switch: the first version stays."""
    import os
    from pyspark.sql import functions as F
    from runlens.plans import export
    feats, args = _features(spark), (str(tmp_path), "2024-12-20", "2024-12-25")
    path = write_training_export(spark, feats, *args)
    rows, first = read_export(spark, path).count(), export_manifest(spark, path).first()["committed"]
    assert first and rows > 0

    def old_is_there():
        assert export_manifest(spark, path).first()["committed"] == first and read_export(spark, path).count() == rows
        assert [x for x in os.listdir(os.path.dirname(path)) if not x.endswith("crc")] == [os.path.basename(path)]

    broken = feats.withColumn("session_id", F.when(F.length("session_id") >= 0, F.raise_error(F.lit("killed"))).cast("string"))
    with pytest.raises(Exception, match="killed"):
        write_training_export(spark, broken, *args)
    old_is_there()
    with monkeypatch.context() as m:
        read = export._read_files
        m.setattr(export, "_read_files", lambda *a: read(*a).withColumn("digest", F.col("digest") + 1))
        with pytest.raises(export.ExportNotVerified):
            write_training_export(spark, feats, *args)
    old_is_there()
    with monkeypatch.context() as m:
        rename = export.Files.rename
        m.setattr(export.Files, "rename", lambda self, a, b: "before" in a + b and rename(self, a, b))
        with pytest.raises(OSError, match="new export"):
            write_training_export(spark, feats, *args)
    assert export_manifest(spark, path).first()["committed"] == first
    # lost between the two renames: the next run starts from the old export
    os.rename(path, path + ".before")
    with pytest.raises(Exception, match="killed"):
        write_training_export(spark, broken, *args)
    assert export_manifest(spark, path).first()["committed"] == first
    write_training_export(spark, feats.limit(1), *args)
    second = export_manifest(spark, path).first()
    assert second["committed"] != first and second["rows"] == 1 == read_export(spark, path).count()


def test_files_of_an_export(spark, tmp_path):
    from runlens.plans.export import export_files
    path = write_training_export(spark, _features(spark).repartition(3), str(tmp_path), "2024-12-20", "2024-12-25")
    files = export_files(spark, path).collect()
    import glob
    import os
    assert {f["file"]: f["bytes"] for f in files} == {os.path.basename(p): os.path.getsize(p) for p in glob.glob(f"{path}/part-*")}
    assert sum(f["rows"] for f in files) == export_manifest(spark, path).first()["rows"] and len({f["version"] for f in files}) == 1
