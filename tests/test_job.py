"""End-to-end extraction job and the size-checked semi-join."""

from __future__ import annotations

import csv
import datetime as dt
import glob
import json
import os

import pytest

from runlens.config import EXPORT_COLUMNS
from runlens.operators.restrict import restrict_to_keys
from runlens.plans.job import InvalidRequest, check_request, run_extraction
from test_goldens import CLIMBING, DAY, EDGE_DOCS, session


@pytest.fixture(scope="module")
def source(tmp_path_factory):
    d = tmp_path_factory.mktemp("src")
    docs = [session(f"{k}-{v}", DAY + k * 86400 + v * 60, CLIMBING) for k in range(10) for v in (1, 2, 3)] + EDGE_DOCS
    (d / "docs.jsonl").write_text("\n".join(json.dumps(x) for x in docs) + "\n")
    return str(d / "docs.jsonl")


@pytest.mark.parametrize("kernel", ["nested", "flat"])
def test_run_extraction(spark, source, tmp_path, kernel):
    out = run_extraction(spark, source, str(tmp_path), "2024-12-20", "2024-12-25", kernel=kernel,
                         single_file=True, write_quarantine=True)
    # 6 days x 3 plain sessions + 17 good edge documents (all on 2024-12-20)
    assert out["total_conversations"] == 18 + 17
    assert out["quarantined"] == {"agent_data_null": 1, "null_metric": 1} and out["success"]
    parts = glob.glob(os.path.join(out["location"], "part-*.csv"))
    with open(parts[0]) as fh:
        rows = list(csv.DictReader(fh))
    assert list(rows[0].keys()) == EXPORT_COLUMNS and len(rows) == 35
    empty_session = next(r for r in rows if r["session_id"] == "s0" and r["total_runs"] == "0")
    assert empty_session["max_token_growth_rate"] == "0" or float(empty_session["max_token_growth_rate"]) == 0
    quarantined = spark.read.json(out["quarantine_location"]).collect()
    assert sorted(r["quarantine_reason"] for r in quarantined) == ["agent_data_null", "null_metric"]
    dropped = spark.read.schema("doc_key string, pos long, json_path string").json(out["quarantined_runs_location"])
    assert dropped.where("json_path not like '$.%runs[%]%'").count() == 0


def test_landed_source_gives_the_same_export(spark, source, tmp_path):
    from runlens.plans.job import land_documents
    landed = land_documents(spark, source, str(tmp_path / "landed"))
    a = run_extraction(spark, source, str(tmp_path / "a"), "2024-12-21", "2024-12-23", single_file=True)
    b = run_extraction(spark, landed, str(tmp_path / "b"), "2024-12-21", "2024-12-23", fmt="landed",
                       single_file=True)
    assert a["total_conversations"] == b["total_conversations"] == 9
    read = lambda p: sorted(tuple(r) for r in spark.read.option("header", True).csv(p).collect())
    assert read(a["location"]) == read(b["location"])


def test_run_extraction_empty_range(spark, source, tmp_path):
    out = run_extraction(spark, source, str(tmp_path), "2030-01-01", "2030-01-02")
    assert out["total_conversations"] == 0
    back = spark.read.option("header", True).csv(out["location"]).collect()
    assert [r["session_id"] for r in back] == ["no_data"]


def test_a_second_landing_keeps_earlier_days(spark, tmp_path):
    from runlens.plans.job import land_documents
    for day in (0, 1):
        (tmp_path / f"{day}.jsonl").write_text(json.dumps(session(f"d{day}", DAY + day * 86400, CLIMBING)) + "\n")
        land_documents(spark, str(tmp_path / f"{day}.jsonl"), str(tmp_path / "landed"))
    assert sorted(r["date"].isoformat() for r in spark.read.parquet(str(tmp_path / "landed")).collect()) == ["2024-12-20", "2024-12-21"]


def land(spark, tmp_path, name, docs):
    from runlens.plans.job import land_documents
    (tmp_path / f"{name}.jsonl").write_text("".join(json.dumps(d) + "\n" for d in docs))
    land_documents(spark, str(tmp_path / f"{name}.jsonl"), str(tmp_path / "landed"))
    rows = spark.read.parquet(str(tmp_path / "landed")).selectExpr(
        "doc_key", "cast(date as string) date", "try_variant_get(doc, '$.user_id', 'string') user").collect()
    return sorted(((r["doc_key"], r["date"], r["user"]) for r in rows), key=str)


def doc(key, created, user):
    fields = {"_id": key, "created_at": created, "user_id": user}
    return {k: v for k, v in fields.items() if v is not None}


def test_batches_that_share_days_are_merged(spark, tmp_path):
    day = "2024-12-20"
    assert land(spark, tmp_path, 1, [doc("a", DAY, "1"), doc("b", None, "1"), doc("c", DAY + 86400, "1"), doc(None, DAY, "x")]) == sorted(
        [("a", day, "1"), ("b", None, "1"), ("c", "2024-12-21", "1"), (None, day, "x")], key=str)
    # late documents for the same day and the day-less ones; c moves, so its old day has none left; a comes twice
    two = [doc("late", DAY, "2"), doc("d", None, "2"), doc("c", DAY, "2"), doc("a", DAY + 5, "3"), doc("a", DAY + 1, "2"), doc(None, DAY, "x")]
    want = sorted([("a", day, "3"), ("b", None, "1"), ("c", day, "2"), (None, day, "x"), ("late", day, "2"), ("d", None, "2")], key=str)
    assert land(spark, tmp_path, 2, two) == want
    assert not os.path.exists(tmp_path / "landed" / "date=2024-12-21")
    assert land(spark, tmp_path, 2, two) == want  # landed again: nothing doubles
    assert land(spark, tmp_path, 3, []) == want


def test_a_landing_that_was_lost_is_completed_by_the_next(spark, tmp_path, monkeypatch):
    from runlens.sources import landing
    land(spark, tmp_path, 1, [doc("a", DAY, "1"), doc("b", DAY, "1")])

    def lost(spark, files, merged, target):
        files.delete(f"{target}/date=2024-12-20")  # a day is gone, its successor not yet there
        raise OSError("lost")

    with monkeypatch.context() as m:
        m.setattr(landing, "_put_in_place", lost)
        with pytest.raises(OSError, match="lost"):
            land(spark, tmp_path, 2, [doc("b", DAY, "2"), doc("c", DAY, "2")])
    assert land(spark, tmp_path, 3, [doc("d", DAY, "3")]) == [("a", "2024-12-20", "1"), ("b", "2024-12-20", "2"), ("c", "2024-12-20", "2"), ("d", "2024-12-20", "3")]


def test_an_empty_landing_and_one_of_the_older_layout(spark, tmp_path):
    from runlens.sources.documents import landed_layout
    from runlens.sources.landing import upsert_sessions
    docs = spark.sql("""SELECT parse_json('{"_id":"a","created_at":1734652800,"user_id":"1"}') AS doc""")
    target = str(tmp_path / "landed")
    upsert_sessions(docs.limit(0), target)
    landed_layout(docs).drop("same", "doc_key").write.partitionBy("date").mode("append").parquet(target)
    upsert_sessions(docs.selectExpr("""parse_json('{"_id":"a","created_at":1734739200,"user_id":"2"}') AS doc"""), target)
    assert [(r["doc_key"], r["date"].isoformat()) for r in spark.read.parquet(target).collect()] == [("a", "2024-12-21")]


def test_the_job_reads_its_source_once(spark, source, tmp_path, monkeypatch):
    from pyspark.sql import functions as F
    from runlens.plans import job
    seen = spark.sparkContext.accumulator(0)

    def touch(x):
        seen.add(1)
        return True

    read = job.read_sessions
    monkeypatch.setattr(job, "read_sessions", lambda *a, **k: read(*a, **k).where(F.udf(touch, "boolean")(F.rand())))
    out = run_extraction(spark, source, str(tmp_path), "2024-12-20", "2024-12-25")
    assert seen.value == out["total_conversations"] + sum(out["quarantined"].values()) == 37
    assert out["first_created_at"] == DAY and DAY + 5 * 86400 <= out["last_created_at"] < DAY + 6 * 86400


def test_check_request(spark):
    assert check_request(spark, None, None, dt.date(1998, 3, 31)) == ("1998-02-28", "1998-03-30")
    assert check_request(spark, "2024-12-20", "2024-12-20") == ("2024-12-20", "2024-12-20")
    with pytest.raises(InvalidRequest, match="start_after_end"):
        check_request(spark, "2024-12-21", "2024-12-20")
    assert check_request(spark, "2024-12-21", None, dt.date(1998, 3, 31)) == ("1998-02-28", "1998-03-30")


@pytest.mark.parametrize("bound", [0, 10_000])
def test_restrict_to_keys_both_strategies(spark, bound):
    runs = spark.range(0, 1000).selectExpr("id % 50 AS k", "id AS v")
    keys = spark.range(0, 10).selectExpr("id * 3 AS key")
    got = restrict_to_keys(runs, keys, "k", "key", max_broadcast_keys=bound)
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert ("BroadcastExchange" in plan) == (bound > 0)
    assert sorted({r["k"] for r in got.collect()}) == list(range(0, 30, 3))
    assert got.count() == 10 * 20


def test_cli(spark, source, tmp_path, capsys):
    from runlens.plans.job import main
    landed = str(tmp_path / "landed")
    main(["--source", source, "--land-to", landed])
    assert json.loads(capsys.readouterr().out.strip().splitlines()[-1]) == {"landed": landed}
    main(["--source", landed, "--format", "landed", "--start", "2024-12-20", "--end", "2024-12-20",
          "--output", str(tmp_path / "out"), "--single-file"])
    summary = json.loads(capsys.readouterr().out.strip().splitlines()[-1])
    assert summary["total_conversations"] == 3 + 17 and summary["files"] == 1
    assert summary["location"].endswith("conversations_2024-12-20_to_2024-12-20")
