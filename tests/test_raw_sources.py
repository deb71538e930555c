"""Raw JSON by zone map, shredded runs, inferred schemas, dropped runs."""

from __future__ import annotations

import json
import os
import re
import time

import pytest
from pyspark.sql import functions as F

from helpers import SF_SMALL
from runlens.functions.runs import RUN_FIELDS, run_struct
from runlens.functions.variant_schema import infer_schema, typed_copy, typed_ddl
from runlens.plans import catalog
from runlens.plans.documents import normalize_documents, quarantined_runs
from runlens.sources.shredded import LEAVES, METRICS, leaf_kind, shredded_runs, typed_shredded_runs
from runlens.sources.zone_map import files_in_range, read_json_range, refresh_zone_map
from test_goldens import DAY


def variants(spark, texts):
    return spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i long, t string").select("i", F.try_parse_json("t").alias("doc"))


# ------------------------------------------------------------------ zone map
def test_zone_map_opens_the_files_of_the_range(spark, tmp_path):
    src, zones = tmp_path / "src dir", str(tmp_path / "zones")
    src.mkdir()

    def write(name, days):
        (src / name).write_text("".join(json.dumps({"_id": f"{name}-{d}", "created_at": DAY + d * 86400} if d is not None else {"_id": name}) + "\n" for d in days))

    for k in range(5):
        write(f"f{k}.jsonl", [3 * k, 3 * k + 1, 3 * k + 2])
    write("undated.jsonl", [None, None])
    write("empty.jsonl", [])

    def ids(start, end):
        df = read_json_range(spark, str(src), zones, start, end)
        return sorted(r[0] for r in df.select(F.try_variant_get("doc", "$._id", "string")).collect()), sorted(os.path.basename(f) for f in df.inputFiles())

    assert ids("2024-12-21", "2024-12-22") == (["f0.jsonl-1", "f0.jsonl-2"], ["f0.jsonl"])
    assert ids("2024-12-22", "2024-12-23") == (["f0.jsonl-2", "f1.jsonl-3"], ["f0.jsonl", "f1.jsonl"])
    assert ids("2030-01-01", "2030-01-02") == ([], [])
    kept = {r["path"]: r["documents"] for r in spark.read.parquet(zones).collect()}
    assert len(kept) == 6 and sorted(kept.values()) == [2, 3, 3, 3, 3, 3]  # a file without bytes is not listed
    # nothing changed: the map is not written again
    before = os.stat(zones).st_ino
    refresh_zone_map(spark, str(src), zones)
    assert os.stat(zones).st_ino == before
    # a changed, a new and a removed file
    time.sleep(1.1)
    write("f1.jsonl", [1])
    write("late.jsonl", [2])
    os.remove(src / "f0.jsonl")
    assert ids("2024-12-21", "2024-12-22") == (["f1.jsonl-1", "late.jsonl-2"], ["f1.jsonl", "late.jsonl"])
    assert len(files_in_range(refresh_zone_map(spark, str(src), zones), "2000-01-01", "2100-01-01")) == 5


# ------------------------------------------------------------------ shredded runs
RUNS = ['{"status":"RUNNING","metrics":{"total_tokens":5,"time":[1.5,2]},"tools":["a"],"events":["RunCompleted"]}',
        '{"status":"COMPLETED","metrics":{"total_tokens":[7],"output_tokens":[],"time":null},"tools":[],"events":["An ERROR",{"error":null},"a TimeOut"]}',
        '{"status":null,"metrics":{"total_tokens":[null],"input_tokens":"12","time":"x"},"events":"RunCompleted"}',
        '{"status":5,"metrics":{"total_tokens":["8",1],"time":{"a":1}},"tools":"abc","events":[]}',
        '{}', 'null', '5', '"text"', '[1]', '{"metrics":null}', '{"tools":null}', '{"events":null}', '{"metrics":5,"tools":{"a":1},"events":{"b":"timeout RunCompleted"}}',
        '{"metrics":{"total_tokens":true,"output_tokens":1e400,"input_tokens":[[1]],"time":[true]},"events":[null,1,true,["error"]]}',
        '{"status":"COMPLETED","events":["Run","Completed"]}', '{"events":[{"x":"RunCompleted"}]}',
        '{"metrics":{"total_tokens":12345678901234567890,"time":0.1}}']


def test_shredded_fields_equal_those_of_the_variant(spark):
    records = variants(spark, RUNS).withColumnRenamed("doc", "run").where("run is not null")
    want = {r["i"]: tuple(r["s"][f] for f in RUN_FIELDS) for r in records.select("i", run_struct(F.col("run")).alias("s")).collect() if r["s"]["valid"]}
    rows = shredded_runs(records)
    got = {r["i"]: tuple(r[f] for f in RUN_FIELDS) for r in typed_shredded_runs(rows, ["i"]).collect()}
    assert got == want and len(want) >= 10


def test_shredded_leaves_keep_their_kind(spark):
    rows = shredded_runs(variants(spark, RUNS).withColumnRenamed("doc", "run").where("i < 5"))
    kinds = {r["i"]: r for r in rows.select("i", *[leaf_kind(c).alias(c) for c in LEAVES]).collect()}
    assert [kinds[i]["total_tokens"] for i in range(5)] == ["value", "list", "list", "list", "missing"]
    assert [kinds[i]["execution_time"] for i in range(5)] == ["list", "null", "odd", "odd", "missing"]
    assert [kinds[i]["status"] for i in range(5)] == ["value", "value", "null", "odd", "missing"]
    assert [kinds[i]["tools"] for i in range(5)] == ["value", "value", "missing", "odd", "missing"]
    assert [kinds[i]["events"] for i in range(5)] == ["value", "value", "odd", "value", "missing"]


def test_a_query_reads_its_leaves_only(spark):
    spark.conf.set("spark.sql.maxMetadataStringLength", "10000")
    plan = catalog.queries()["shredded_run_success"](spark, SF_SMALL)._jdf.queryExecution().executedPlan().toString()
    spark.conf.unset("spark.sql.maxMetadataStringLength")
    read = set(re.findall(r"(\w+):", re.search(r"ReadSchema: struct<([^\n]*)>", plan)[1]))
    assert {"session_key", "pos", "valid", "status", "events"} <= read
    assert not read & {*METRICS, "tools", *[f"{m}_list" for m in METRICS], *[f"{m}_rest" for m in METRICS]}


# ------------------------------------------------------------------ inferred schema
def test_schema_of_mixed_documents(spark):
    docs = variants(spark, ['{"a":1,"b":{"c":[1,2.5,null]},"k":"x"}', '{"a":null,"b":{"c":[],"d":true}}', '{"a":"s","k":"y","e":{}}', '[1]', 'null', None, "not json"])
    got = {r["path"]: r.asDict() for r in infer_schema(docs).collect()}
    brief = {p: {k[2:]: v for k, v in r.items() if k.startswith("n_") and v} for p, r in got.items()}
    assert brief == {"$": {"object": 3, "array": 1, "null": 1}, "$[*]": {"number": 1}, "$.a": {"number": 1, "null": 1, "string": 1}, "$.b": {"object": 2},
                     "$.b.c": {"array": 2}, "$.b.c[*]": {"number": 2, "null": 1}, "$.b.d": {"boolean": 1}, "$.k": {"string": 2}, "$.e": {"object": 1}}
    assert all(r["n"] == sum(brief[p].values()) for p, r in got.items())
    assert got["$.b.c[*]"]["whole"] is False and got["$[*]"]["whole"] is True
    assert typed_ddl(got, "$.b") == "STRUCT<`c`: ARRAY<DOUBLE>, `d`: BOOLEAN>" and typed_ddl(got, "$.a") == "VARIANT" and typed_ddl(got, "$.e") == "VARIANT"
    assert infer_schema(docs.limit(0)).count() == 0
    with pytest.raises(ValueError, match="deeper"):
        infer_schema(variants(spark, ["[" * 6 + "]" * 6]), depth=4)


def test_schema_equals_a_walk_and_reads_once(spark):
    import pyarrow as pa

    texts = ['{"a.b":{"[*]":[1,{"x":[]},[[2.5]]],"\\u0001":{"\\u0002a":null}},"e":{},"f":[],"g":[{},{"h":[[]]}]}', '{"g":[1,"s",{"h":[[true]]}],"f":[[1],[2]]}',
             '[[1,2],[],{"k":{"l":{"m":{"n":0.5}}}}]', '5', '"s"', 'null', '{}', '[]']
    want: dict = {}

    def walk(path, v):
        kind = ("null" if v is None else "boolean" if isinstance(v, bool) else "string" if isinstance(v, str) else "object" if isinstance(v, dict)
                else "array" if isinstance(v, list) else "number")
        row = want.setdefault(path, {"n": 0})
        row["n"] += 1
        row["n_" + kind] = row.get("n_" + kind, 0) + 1
        for k, x in v.items() if isinstance(v, dict) else [(None, x) for x in v] if isinstance(v, list) else []:
            walk(path + ("[*]" if k is None else "." + k), x)

    def schema(docs):
        return {r["path"]: {k: x for k, x in r.asDict().items() if k[0] == "n" and x} for r in infer_schema(docs).collect()}

    for t in texts:
        walk("$", json.loads(t))
    read = spark.sparkContext.accumulator(0)

    def counted(batches):
        for b in batches:
            read.add(b.num_rows)
            yield b

    docs = spark.createDataFrame([(t,) for t in texts], "t string").mapInArrow(counted, "t string").select(F.parse_json("t").alias("doc"))
    assert schema(docs) == want and read.value == len(texts)
    deep = '{"a":' * 13 + "[1]" + "}" * 13  # needs more levels than one reading opens
    want.clear()
    walk("$", json.loads(deep))
    assert schema(variants(spark, [deep])) == want
    assert len(schema(variants(spark, ["[[]]", "[1]"]))) == 2
    with pytest.raises(ValueError, match="deeper"):
        infer_schema(variants(spark, ["[[]]"]), depth=2)
    with pytest.raises(ValueError, match="deeper"):
        infer_schema(variants(spark, ["{}"]), depth=1)


def test_typed_copy_keeps_the_values(spark):
    docs = variants(spark, ['{"a":1,"b":{"c":[1,2.5,null]},"m":1}', '{"a":3,"m":"x"}', '{"b":{"c":[]},"m":[1]}'])
    typed = typed_copy(docs, infer_schema(docs))
    assert [f"{n} {t}" for n, t in typed.dtypes] == ["a bigint", "b struct<c:array<double>>", "m variant"]
    rows = typed.select("a", "b", F.to_json("m").alias("m")).collect()
    assert sorted(((r["a"], r["b"] and r["b"]["c"], r["m"]) for r in rows), key=str) == sorted([(1, [1.0, 2.5, None], "1"), (3, None, '"x"'), (None, [], "[1]")], key=str)


# ------------------------------------------------------------------ dropped runs
def test_dropped_runs_name_their_nulls(spark):
    docs = variants(spark, ['{"_id":"a","memory":{"runs":[{},null,{"tools":null,"events":null},{"metrics":null}]}}', '{"_id":"b","runs":[{"events":null},{"events":[]}]}',
                            '{"_id":"c"}', '{"_id":"d","memory":{"runs":5}}', '{"_id":"e","memory":null}', '{"memory":{"runs":[{"tools":null}]}}'])
    got = sorted(tuple(r) for r in quarantined_runs(docs).collect())
    assert got == [("", 0, "$.memory.runs[0].tools"), ("a", 1, "$.memory.runs[1]"), ("a", 2, "$.memory.runs[2].events"), ("a", 2, "$.memory.runs[2].tools"),
                   ("a", 3, "$.memory.runs[3].metrics"), ("b", 0, "$.runs[0].events")]
    kept = {r["doc_key"]: (r["raw_run_count"], len(r["runs"])) for r in normalize_documents(docs).collect()}
    assert kept["a"] == (4, 1) and kept["b"] == (2, 1)
