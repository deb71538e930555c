"""Operators 5, 9 and 10: oracles on the small tables and hand-made cases."""

from __future__ import annotations

import os

import duckdb
import pytest

from runlens.llm import decontaminate, license_scan, line_templates, queries, topk_search

SF_SMALL = "/root/testdata/sf0.001"

PROSE = "the quick brown fox jumps over the lazy dog near the old river bank while seven grey geese watch"


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for f in os.listdir(SF_SMALL):
        con.execute(f"CREATE VIEW {f[:-8]} AS SELECT * FROM '{SF_SMALL}/{f}'")
    return con


@pytest.mark.parametrize("name", sorted(queries.oracle_sql()))
def test_query_equals_oracle(spark, duck, name):
    got = queries.queries()[name](spark, SF_SMALL)
    columns = sorted(got.columns)
    want = duck.execute(f"SELECT {', '.join(columns)} FROM ({queries.oracle_sql()[name]})").fetchall()
    assert sorted(map(repr, want)) == sorted(repr(tuple(r)) for r in got.select(*columns).collect())


# ------------------------------------------------------------------ 5
def lines_of(spark, texts, **kw):
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    return {r.doc_id: r.text for r in line_templates.dedup_lines(docs, **kw).collect()}


def test_recurring_templates_go(spark):
    a = "Posted on 2024-01-02 by user17 in the garden forum"
    b = "Posted on 2023-11-30 by user9 in the garden forum"
    varied = ["report filed by anna for the north office today", "report filed by boris for the north office today",
              "report filed by carla for the north office today"]
    got = lines_of(spark, [f"own line of the first document here\n{a}\n{varied[0]}", f"{b}\nsecond document says something else entirely",
                           varied[1], varied[2] + "\nshort line\nshort line"], similarity=0.8)
    assert got[0] == f"own line of the first document here\n{a}\n{varied[0]}"
    assert got[1] == "second document says something else entirely"
    assert got[2] == "" and got[3] == "short line\nshort line"


@pytest.mark.parametrize("names", [4, 20])
def test_two_recurring_fields_are_found_at_any_size(spark, names):
    """A template whose two fields take recurring values: all lines but the first go, however many there are."""
    line = "on the way to the old town {} met the mayor of {} again"
    grid = [line.format(f"name{chr(97 + a)}", f"city{chr(97 + b)}") for a in range(names) for b in range(names)]
    got = lines_of(spark, grid)
    assert sum(bool(t) for t in got.values()) == 1 and got[0] == grid[0]
    unused = [line.format(f"only{chr(97 + a)}", f"place{chr(97 + a)}") for a in range(names)]
    assert sum(bool(t) for t in lines_of(spark, unused).values()) == 1


def test_short_lines_recur_as_they_are(spark):
    got = lines_of(spark, ["All rights reserved.\nown words", "All  rights reserved.\nother words", "漢字漢字\nAll rights", "漢字漢字\n\n"])
    assert got == {0: "All rights reserved.\nown words", 1: "other words", 2: "漢字漢字\nAll rights", 3: "\n"}


def test_rows_of_numbers_are_no_template(spark):
    rows = ["12 34 56 78 90", "7 8 9 10 11", "2024-01-02 5 5 goals scored", "2024-01-03 6 7 goals scored", "12 34 56 78 90"]
    got = lines_of(spark, rows)
    assert [got[i] for i in range(5)] == rows[:4] + [""]


def test_lines_of_one_document_stay(spark):
    same = "this very line is written twice in one document"
    assert lines_of(spark, [f"{same}\n{same}", "another document without that line at all"])[0] == f"{same}\n{same}"


def test_line_dedup_odd_rows(odd_docs, clashing, no_docs):
    got = line_templates.dedup_lines(clashing).collect()
    assert len(got) == odd_docs.count() and all(r.key == "mine key" and r.gone == "mine gone" for r in got)
    by = {}
    for r in got:
        by.setdefault(r.doc_id, []).append(r)
    assert by[1][0].lines_dropped == 0 and by[2][0].text == "" and by[4][0].text == "" and by[4][0].lines_before == 1
    assert [r.text for r in by[9]] == ["repeated row of this very small table\nMIT"] * 2  # one document
    assert by[6][0].text == "   \n\t "
    assert line_templates.dedup_lines(no_docs).count() == 0


# ------------------------------------------------------------------ 9
def licences(spark, text):
    docs = spark.createDataFrame([(1, text)], "doc_id long, text string")
    return license_scan.scan(docs).first()["licenses"]


def test_rules_need_their_order(spark):
    s = license_scan.SENTENCES
    full = "Copyright (c) 2020 Somebody\n\n" + ". ".join([s["mit-grant"], s["mit-notice"], s["mit-as-is"], s["mit-liability"]]) + "."
    assert licences(spark, full) == "MIT"
    wrapped = full.replace(" software ", "\nsoftware\n").replace(" copies ", "\n copies\n")
    assert licences(spark, wrapped) == "MIT"
    assert licences(spark, ". ".join([s["mit-as-is"], s["mit-notice"], s["mit-grant"]])) == ""
    bsd = [s["bsd-redistribution"] + ":", s["bsd-source"] + ".", "Something else.", s["bsd-binary"] + "."]
    assert licences(spark, "\n".join(bsd)) == "BSD-2-Clause"
    # the longer licence takes its sentences, and its notice is not taken for a reservation
    assert licences(spark, "\n".join([*bsd, s["bsd-endorse"] + "."])) == "BSD-3-Clause"
    assert licences(spark, "Copyright (c) 2020, Somebody. All rights reserved.\n\n" + "\n".join([*bsd, s["bsd-endorse"] + "."])) == "BSD-3-Clause"
    assert licences(spark, "Copyright (c) 2020, Somebody. All rights reserved.") == "Proprietary"
    assert licences(spark, "# SPDX-License-Identifier: MIT") == "MIT" and licences(spark, "SPDX-License-Identifier: other") == ""
    assert licences(spark, "\n".join([*bsd, "own words", *bsd, s["bsd-endorse"] + "."])) == "BSD-2-Clause,BSD-3-Clause"  # both texts


@pytest.mark.parametrize("name", sorted(n for n, seqs in license_scan.RULES.items()))
def test_every_rule_is_found(spark, name):
    for seq in license_scan.RULES[name]:
        text = "Before.\n" + ".\n".join(license_scan.SENTENCES[s] for s in seq) + ".\nAfter it."
        assert name in licences(spark, text).split(",")


def test_licence_odd_rows(odd_docs, clashing, no_docs):
    got = license_scan.scan(clashing).collect()
    assert len(got) == odd_docs.count() and {r.doc_id: r.licenses for r in got if r.doc_id}[11] == "MIT"
    assert all(r.licenses == "" for r in got if not r.text) and license_scan.scan(no_docs).count() == 0


# ------------------------------------------------------------------ 10
def test_items_are_found_anywhere(spark):
    filler = " ".join(f"w{i}" for i in range(5000))
    item = PROSE + " and then they all went home before the rain began to fall"
    texts = [f"{filler} {item} {filler}", item.upper().replace(" ", "  \n"), filler, item[: len(item) // 2], None, "",
             f"{filler} " + item.replace("quick", "slow")]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    bench = spark.createDataFrame([(1, item), (2, "too short item"), (3, None), (None, "no id " + item), (4, item)], "item_id long, text string")
    got = {(r.doc_id, r.item_id): r.containment for r in decontaminate.contained_items(docs, bench).collect()}
    n = len(item.split()) - 4
    assert got.pop((6, 1), None) == pytest.approx((n - 2) / n) or (n - 2) / n < 0.8
    got.pop((6, 4), None), got.pop((6, None), None)
    assert set(got) >= {(0, 1), (0, 4), (1, 1), (1, 4)} and all(d in (0, 1) for d, _ in got)
    kept = decontaminate.drop_contaminated(docs, bench).collect()
    assert {r.doc_id for r in kept} >= {2, 3, 4, 5} and not {r.doc_id for r in kept} & {0, 1}


def test_short_items_are_never_missed():
    items = [(g, " ".join(f"i{g}w{j}" for j in range(5 + g % 4))) for g in range(600)]
    texts = [" ".join([item] + [f"t{g}b{j}" for j in range(15)]) for g, item in items]
    found = decontaminate.Index(items, decontaminate.THRESHOLD).search([t.encode() for t in texts])
    assert found == [(g, g, 1 + g % 4, 1 + g % 4) for g in range(600)]


def test_benchmark_in_blocks(spark):
    from runlens.llm.common import table
    docs, bench = table(spark, SF_SMALL, "documents"), table(spark, SF_SMALL, "benchmark")
    whole = sorted(map(tuple, decontaminate.contained_items(docs, bench).collect()))
    assert whole and whole == sorted(map(tuple, decontaminate.contained_items(docs, bench, block_chars=2000).collect()))


def test_decontamination_odd_rows(spark, odd_docs, clashing, no_docs):
    d = SF_SMALL
    bench = spark.read.parquet(f"{d}/benchmark.parquet")
    assert decontaminate.contained_items(clashing, bench).count() == 0
    kept = decontaminate.drop_contaminated(clashing, bench)
    assert kept.columns == clashing.columns and kept.count() == odd_docs.count()
    assert decontaminate.contained_items(no_docs, bench).count() == 0
    assert decontaminate.contained_items(odd_docs, bench.limit(0)).count() == 0


# ------------------------------------------------------------------ 4
def test_top_k_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [0.5, -0.5]), (20, [1.0, 1.0]), (1, [1.0, 1.0]), (2, [1.0, 1.0]), (3, None), (4, [nan, 1.0]), (5, [inf, 0.0]), (6, [None, 1.0]),
            (40, [0.0, 0.0]), (None, [1.0, 1.0]), (2, [1.0, 1.0]), (60, [1.0]), (20, [1.0, 1.0]), (7, [])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").selectExpr("*", "1 AS rank", "2 AS score", "3 AS v")
    got = {}
    for r in topk_search.top_k(df, df.where("vec_id % 20 = 0"), k=4).orderBy("query_id", "rank").collect():
        got.setdefault(r.query_id, []).append((r.vec_id, r.score))
    one = 64 * 64
    assert got[20] == [(1, 2 * one), (2, 2 * one), (2, 2 * one), (None, 2 * one)]
    assert got[0] == [(1, 0), (2, 0), (2, 0), (20, 0)] and got[40] == [(0, 0), (1, 0), (2, 0), (2, 0)]
    assert 60 not in got
    assert topk_search.top_k(df.limit(0), df.limit(0)).count() == 0


def test_top_k_blocks_and_widths():
    import numpy as np
    rng = np.random.default_rng(5)
    for scale in (8, 5000, 1 << 26):
        x = np.floor(rng.normal(size=(900, 12)) * scale)
        ids = list(range(100, 1000))
        q, q_ids = x[:30], np.arange(100, 130)
        top = topk_search.Top(30, 7)
        for a in range(0, 900, 300):
            topk_search.search_block(q, q_ids, x[a:a + 300], ids[a:a + 300], top, 0)
        for i in range(30):
            exact = sorted(((-int(sum(int(a) * int(b) for a, b in zip(q[i], x[j]))), ids[j]) for j in range(900) if ids[j] != q_ids[i]))[:7]
            assert [(-s, v) for s, v in top.best[i]] == exact


def test_top_k_queries_in_blocks(spark):
    df = spark.read.parquet(f"{SF_SMALL}/embeddings.parquet")
    asked = df.where("vec_id % 20 = 0")
    assert sorted(map(tuple, topk_search.top_k(df, asked, query_block=7).collect())) == sorted(map(tuple, topk_search.top_k(df, asked).collect()))


def test_bare_names_are_sentences_in_any_text(spark):
    """"Mit." is a sentence that an SPDX line may hold: it is identified whether or not the text has a word of the other sentences."""
    texts = ["Sie kam.\n- Mit.\nDann", "(MIT)", "Er kam; mit! Licence", "Apache-2.0\n\nnothing else", "Er kam mit. Dann", "mit\nihm", "commit.", ""]
    got = license_scan.scan(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).collect()
    ids = license_scan.sentence_ids()
    mit, apache = str(ids["mit"]), str(ids["apache 2 0"])
    assert [(r.line_sentences, r.block_sentences) for r in sorted(got, key=lambda r: r.doc_id)] == [
        (mit, mit), (mit, mit), (mit, mit), (apache, apache), ("", ""), (mit, ""), ("", ""), ("", "")]
