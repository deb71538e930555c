"""Operator 7: records, revisits, the two-level index."""

from __future__ import annotations

import base64
import hashlib

import pytest

from runlens.llm import warc
from runlens.llm.common import table, work_dir

SF_SMALL = "/root/testdata/sf0.001"


def _expected(pages):
    last = {}
    for page_id, html in pages:
        if page_id is not None:
            last[html] = max(last.get(html, page_id), page_id)
    out = []
    for page_id, html in pages:
        body = html.encode()
        top = last.get(html)
        revisit = top is not None and (page_id is None or page_id < top)
        if sum(h == html for _, h in pages) == 1:
            revisit = False
        out.append((page_id, len(body), base64.b32encode(hashlib.sha1(body).digest()).decode(),
                    "revisit" if revisit else "response", top if revisit else None))
    return sorted(out, key=str)


def test_query_equals_brute_force(spark):
    pages = [(r[0], r[1] or "") for r in table(spark, SF_SMALL, "pages").select("page_id", "html").collect()]
    assert sorted(map(tuple, warc.op7_warc(spark, SF_SMALL).collect()), key=str) == _expected(pages)


@pytest.fixture(scope="module")
def odd_pages(spark):
    rows = [(1, "http://a.example.com/x", "same"), (2, "https://a.example.com:443/x#f", "same"), (3, None, None), (4, "http://b.org", ""),
            (None, "http://b.org", "same"), (5, "not a url\t", "é漢 body"), (6, "http://[bad", "x" * 300_000),
            (7, "http://a.example.com/x?q=1", "tie"), (7, "http://a.example.com/x?q=1", "tie")]
    return spark.createDataFrame(rows, "page_id long, url string, html string")


def test_odd_rows_and_lookup(spark, odd_pages):
    out = work_dir(spark, "w")
    extra = odd_pages.selectExpr("*", "'mine' AS same", "'mine' AS payload", "'mine' AS last")
    warc.build_index(warc.write_archive(extra, out), out, block_lines=2)
    got = [tuple(r) for r in warc.read_archive(spark, out).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to").collect()]
    assert sorted(got, key=str) == _expected([(r[0], r[2] or "") for r in odd_pages.collect()])
    asked = spark.createDataFrame([("http://A.example.com/x",), ("http://nowhere.org/",), ("http://a.example.com/x?q=1",)], "url string")
    found = warc.lookup(asked, out).collect()
    assert sorted(r.page_id for r in found) == [1, 2, 7, 7]
    assert {r.page_id: r.payload and bytes(r.payload) for r in found} == {1: None, 2: b"same", 7: b"tie"}


def test_small_payloads_are_responses(spark, odd_pages):
    out = work_dir(spark, "w")
    warc.build_index(warc.write_archive(odd_pages, out, min_revisit_bytes=5), out)
    assert {r.record_type for r in warc.read_archive(spark, out).collect()} == {"response"}


def test_empty_table(spark, odd_pages):
    out = work_dir(spark, "w")
    warc.build_index(warc.write_archive(odd_pages.limit(0), out), out)
    assert warc.read_archive(spark, out).count() == 0
    assert warc.lookup(odd_pages.select("url"), out).count() == 0


def test_url_keys_sort_by_reversed_host():
    assert warc.url_key("https://www.Example.com:8080/a?b=c#d") == "com,example,www:8080)/a?b=c"
    assert warc.url_key(None) == "" and warc.url_key("http://e.org") == "org,e)/"
