"""Operators 1 and 6: piece ids and token ids against the libraries, round trips, edge cases."""

from __future__ import annotations

import tracemalloc
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import sentencepiece
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from runlens.llm import ragged, toxicity
from runlens.llm import sentencepiece_codec as sp
from runlens.llm import token_output as to
from runlens.llm.common import table, work_dir

SF_SMALL = "/root/testdata/sf0.001"

ODD = ["", " ", "a  b   c", "\n\n x", "▁a▁▁b", "aaaaaaaaaaaa", "     indent    four        eight", "x" * 3000, " " * 37 + "a",
       "a\tb \r\n c", "it's). foo", "漢字 𝒳　z 12,5!!", "<s> </s> <0x41> <|endoftext|>", "é" * 50, "ab  cd  ef"]


@pytest.fixture(scope="module")
def small_texts(spark):
    return [r[0] for r in table(spark, SF_SMALL, "documents").select("text").collect()]


def test_pieces_equal_the_library(small_texts):
    codec = sp.Codec(sp.model_path())
    lib = sentencepiece.SentencePieceProcessor(model_file=sp.model_path())
    texts = small_texts + ODD
    ids, counts = codec.encode_texts([t.encode() for t in texts])
    got = np.split(ids, np.cumsum(counts)[:-1])
    for t, mine, theirs in zip(texts, got, lib.encode(texts)):
        assert mine.tolist() == theirs, t[:60]
        assert codec.decode(mine).decode() == lib.decode(theirs)


def test_forward_pass_is_the_merge_order():
    codec = sp.Codec(sp.model_path())
    words = sorted({"▁" + w for w in ("thing things thinking think thin the then there banana bananas mississippi aaaa aaaaa xyzzy "
                                       "internationalisation internationally inter").split()})
    assert codec._walk(words) == {w: codec._ids(codec.merge(w)) for w in words}


def test_sentencepiece_odd_rows(odd_docs, clashing, no_docs):
    out = {(r.doc_id, r.text): r for r in sp.encode_documents(clashing, sp.model_path(), with_text=True).collect()}
    lib = sentencepiece.SentencePieceProcessor(model_file=sp.model_path())
    assert len(out) == odd_docs.distinct().count() and sp.encode_documents(clashing, sp.model_path()).count() == odd_docs.count()
    for (_, text), r in out.items():
        want = lib.encode(text or "")
        assert r.piece_ids == want and r.n_pieces == len(want) and r.ids_crc32 == zlib.crc32(np.asarray(want, "<u4").tobytes())
        assert r.decoded_text == lib.decode(want) and r.decoded_equal == (r.decoded_text == (text or ""))
        assert r.key == "mine key"
    assert sp.encode_documents(no_docs, sp.model_path()).count() == 0


def _expected(docs):
    tok = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    start, out = 0, []
    for doc_id, text in sorted(docs, key=lambda r: (r[0] is not None, r[0] or 0)):
        ids = np.asarray(tok.encode(text or "", add_special_tokens=False).ids + [0], "<u4")
        out.append((doc_id, start, len(ids), zlib.crc32(ids.tobytes())))
        start += len(ids)
    return out


def test_token_output_equals_the_library(spark):
    got = [tuple(r) for r in to.op6_token_output(spark, SF_SMALL).collect()]
    docs = [tuple(r) for r in table(spark, SF_SMALL, "documents").select("doc_id", "text").collect()]
    assert sorted(got) == sorted(_expected(docs))


def test_token_output_odd_rows(spark, clashing, odd_docs, no_docs):
    vocab = public_tokenizers.path("byte_bpe_50k.json")
    path = work_dir(spark, "t")
    to.write_tokens(clashing, path, vocab)
    got = [tuple(r) for r in to.token_positions(to.read_tokens(spark, path), path + "-d").collect()]
    want = _expected([(r.doc_id, r.text) for r in odd_docs.collect()])
    key = lambda r: (r[0] is None, r[0] or 0, r[2], r[3])
    assert sorted((r[0], r[2], r[3]) for r in got if r[0] is not None) == sorted((r[0], r[2], r[3]) for r in want if r[0] is not None)
    assert sorted(x[1] for x in got)[0] == 0 and len(got) == len(want)
    ordered = sorted(got, key=lambda r: r[1])
    assert all(a[1] + a[2] == b[1] for a, b in zip(ordered, ordered[1:]))  # the ids of all documents in a row
    assert [r[0] for r in ordered] == sorted((r[0] for r in got), key=lambda i: (i is not None, i or 0)) and key
    empty = work_dir(spark, "t")
    to.write_tokens(no_docs, empty, vocab)
    assert to.token_positions(to.read_tokens(spark, empty), empty + "-d").count() == 0


def test_special_strings_and_repeated_ids(spark):
    """The ids of the plain library call, and places in the file for rows with one id."""
    texts = ["a <|endoftext|> b", "x<|endoftext|>", "<|endoftext|", "plain", "", None, "a <|endoftext|> b"]
    docs = spark.createDataFrame([(i % 2, t) for i, t in enumerate(texts)], "doc_id long, text string").repartition(3)
    path = work_dir(spark, "t")
    to.write_tokens(docs, path, public_tokenizers.path("byte_bpe_50k.json"))
    tok = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    assert 50256 in tok.encode("a <|endoftext|> b", add_special_tokens=False).ids
    want = sorted((i % 2, tuple(tok.encode(t or "", add_special_tokens=False).ids + [0])) for i, t in enumerate(texts))
    rows = sorted((tuple(r) for r in to.read_tokens(spark, path).select("_metadata.file_name", "row", "doc_id", "ids").collect()))
    assert sorted((r[2], tuple(r[3])) for r in rows) == want
    start, places = 0, []
    for _, _, doc_id, ids in rows:
        places.append((doc_id, start, len(ids), zlib.crc32(np.asarray(ids, "<u4").tobytes())))
        start += len(ids)
    assert sorted(tuple(r) for r in to.token_positions(to.read_tokens(spark, path), path + "-d").collect()) == sorted(places)


def test_a_cache_of_two_generations():
    cache = sp.Generations()
    cache.update({1: "a", 2: "b"})
    cache.clear()
    assert 1 in cache and len(cache) == 0 and cache[1] == "a" and len(cache) == 1
    cache.clear()
    assert 1 in cache and 2 not in cache


def test_orc_is_pruned_by_document(spark):
    path = work_dir(spark, "t")
    docs = table(spark, SF_SMALL, "documents")
    to.write_tokens(docs, path, public_tokenizers.path("byte_bpe_50k.json"))
    one = to.read_tokens(spark, path).where(F.col("doc_id") == 17)
    assert one.count() == 1 and "EqualTo(doc_id,17)" in one._jdf.queryExecution().toString()


@pytest.mark.parametrize("kind", [pa.string(), pa.large_string()])
def test_a_text_column_is_taken_out_group_by_group(kind):
    texts = [f"{i} " * (i % 900) for i in range(10_000)]
    texts[::7], texts[5] = [None] * len(texts[::7]), "x" * 100_000
    column = pa.array(["not read", *texts], kind).slice(1)
    plain = [(t or "").encode() for t in texts]
    assert list(ragged.text_groups(column, 50_000)) == list(ragged.groups(plain, 50_000))
    assert list(ragged.text_groups(column.slice(0, 0))) == []
    tracemalloc.start()
    try:
        assert sum(sum(map(len, g)) for _, g in ragged.text_groups(column, 200_000)) == sum(map(len, plain))
        assert tracemalloc.get_traced_memory()[1] < sum(map(len, plain)) / 10
    finally:
        tracemalloc.stop()


def test_a_worker_holds_one_cache_of_the_toxicity_stage():
    class Scores:
        value = np.zeros(toxicity.SLOTS, np.float32)

    toxicity._counter()([b"some words of a line"])
    toxicity.Model("m", Scores, 1.0, 1.0, []).word_scores([b"some words of a line"])
    assert [len(x.known) for state in ragged._held for x in state.values() if isinstance(x, ragged.Chunks)] == [5]
