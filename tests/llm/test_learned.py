"""Operators 2, 3 and 8 and the pipeline: brute force, held-out quality, hand-made cases, edge cases."""

from __future__ import annotations

import math
import random
import re
import sys
import zlib
from collections import Counter
from types import SimpleNamespace

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from runlens.llm import lm_score, near_dedup, toxicity
from runlens.llm.common import staged, table, work_dir
from runlens.llm.common import words_of as plain_words

SF_SMALL = "/root/testdata/sf0.001"
SF_MID = "/root/testdata/sf0.01"


# ------------------------------------------------------------------ 2
def words_of(text):
    low = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    return re.findall(r"[^\x20\x09-\x0D]+", low) + ["\n"]


def base_scores(docs):
    held = {i: zlib.crc32(("" if i is None else str(i)).encode()) % 7 == 2 for i, _ in docs}
    counts = Counter(w for i, t in docs if not held[i] for w in words_of(t))
    n, v = sum(counts.values()), len(counts)
    return {(i, t): (held[i], len(words_of(t)), sum(counts[w] > 0 for w in words_of(t)), n,
                     sum(math.log10((counts[w] + 1) / (n + v + 1)) for w in words_of(t))) for i, t in docs}


def check_base(got, docs):
    want = base_scores(docs)
    assert len(got) == len(docs)
    by_id = {i: w for (i, _), w in want.items()}
    for r in got:
        held, n, known, total, base = by_id[r.doc_id]
        assert (r.held_out, r.n_tokens, r.n_known, r.train_tokens) == (held, n, known, total)
        assert r.base_score == pytest.approx(base, abs=1e-6) and math.isfinite(r.score) and r.score < 0


def test_lm_base_and_gain(spark):
    docs = [tuple(r) for r in table(spark, SF_MID, "documents").select("doc_id", "text").collect()]
    got = lm_score.op2_lm_score(spark, SF_MID).collect()
    check_base(got, docs)
    held = [r for r in got if r.held_out]
    assert sum(r.score for r in held) > 1.02 * sum(r.base_score for r in held)
    assert sum(r.score for r in got) > 0.95 * sum(r.base_score for r in got)


def test_lm_odd_rows(spark, clashing, odd_docs, no_docs):
    docs = staged(clashing, work_dir(spark, "t"))
    got = lm_score.score_documents(docs, known=8).collect()
    rows = [(r.doc_id, r.text) for r in odd_docs.collect()]
    want = base_scores(rows)
    key = lambda x: repr((x[0], x[1:5], round(x[5], 6)))
    mine = sorted(((r.doc_id, r.held_out, r.n_tokens, r.n_known, r.train_tokens, r.base_score) for r in got), key=key)
    theirs = sorted(((i, *want[i, t]) for i, t in rows), key=key)
    for a, b in zip(mine, theirs, strict=True):
        assert a[:5] == b[:5] and a[5] == pytest.approx(b[5], abs=1e-6)
    assert all(math.isfinite(r.score) and r.score < 0 for r in got)
    assert lm_score.score_documents(staged(no_docs, work_dir(spark, "t"))).count() == 0


def test_decisions_are_a_distribution():
    """The byte decisions of all words up to two letters over the whole alphabet: probabilities sum to at most one."""
    rng = np.random.default_rng(1)
    code = lm_score.Code(rng.integers(0, 1000, 256))
    tables = lm_score.Tables([rng.integers(0, 9, (2, 1 << b)).astype(np.float32) for b in lm_score.SLOT_BITS], code)
    mixer = lm_score.Mixer(len(lm_score.SLOT_BITS), lm_score.BIT_SETS, 256)
    words = [bytes([b]) for b in range(256) if b != 32]
    bits = lm_score.Bits(words, np.zeros(len(words), np.int64), code)
    p = mixer.probability(*bits.inputs(tables, False), bits.node)
    each = np.log(np.where(bits.bit == 1, p, 1 - p))
    first = np.exp([each[bits.word == i][:code.length[w[0]]].sum() for i, w in enumerate(words)]).sum()
    empty = lm_score.Bits([b""], np.zeros(1, np.int64), code)
    q = mixer.probability(*empty.inputs(tables, False), empty.node)
    first += np.exp(np.log(np.where(empty.bit == 1, q, 1 - q)).sum())
    assert first == pytest.approx(1.0, abs=1e-6) and np.exp(np.bincount(bits.word, each)).sum() < 1


def test_words_of_a_block_equal_their_definition():
    texts = [b"The  cat\tthe Cat\x0bsat", b"", b" \n ", "été the\x85x".encode(), b"cat"]
    words = lm_score.Words(np.random.default_rng(3).normal(size=(256, 3)))
    token, gate, counts = words.tokens(texts[:2])
    more = words.tokens(texts[2:])
    token, gate, counts = (np.r_[a, b] for a, b in zip((token, gate, counts), more))
    spelled = [list(words.number)[i] if i >= 0 else b"\n" for i in token]
    want = [w.encode() for t in texts for w in words_of(t.decode())]
    assert spelled == want and counts.tolist() == [len(words_of(t.decode())) for t in texts]
    at = 0
    for n in counts:
        pull = np.zeros(3)
        for i in range(at, at + n):
            assert gate[i] == (8 if i == at else sum((pull[k] >= 0) << k for k in range(3)))
            pull = pull + words.directions[np.frombuffer(spelled[i], np.uint8)].sum(axis=0)
        at += n


def block_batches(texts):
    """Two blocks, the second begins inside a batch; every third text is held out."""
    table_ = pa.table({"block": pa.array([int(i >= 3 * len(texts) // 4) for i in range(len(texts))], pa.int64()), "text": texts,
                       "held_out": [i % 3 == 0 for i in range(len(texts))], "doc_id": pa.array(range(len(texts)), pa.int64())})
    return table_.to_batches(max_chunksize=len(texts) // 2)


def written_results(path, vocabulary, score):
    """Results of the vocabulary's rows as the query writes them: ``score(word, gate)`` and 2 occurrences each."""
    for block in {r["block"] for r in vocabulary}:
        mine = [r for r in vocabulary if r["block"] == block and r["word"] != lm_score.REPEAT][::-1]
        (path / "results" / f"block={block}").mkdir(parents=True)
        pq.write_table(pa.table({"word": pa.array([r["word"] for r in mine], pa.binary()), "c": pa.array([2] * len(mine), pa.int64()), **{
            s: pa.array([None if r[n] is None else score(r["word"], g) for r in mine], pa.float64())
            for g, (s, n) in enumerate(zip(lm_score.S, lm_score.N))}}), path / "results" / f"block={block}" / "part.parquet")


@pytest.mark.parametrize("held", [1, 1 << 21])
def test_blocks_are_counted_and_added_up(tmp_path, monkeypatch, held):
    """Held groups and blocks against the words one by one, however many tokens are held."""
    monkeypatch.setattr(lm_score, "HELD_TOKENS", held)
    monkeypatch.setattr(lm_score, "GROUP_BYTES", 40)
    texts = ["The cat the  the CAT", "", "sat été\tcat", " x x x\x0by", "mat the mat", "q " * 30, "cat", "été the z"]
    directions = np.random.default_rng(3).normal(size=(256, 3))
    shared = SimpleNamespace(value=directions)
    batches = block_batches(texts)
    got = [r for b in lm_score._vocabulary(shared)(iter([b.select([0, 1, 2]) for b in batches])) for r in b.to_pylist()]
    count, again, score = {}, {0: Counter(), 1: Counter()}, []
    spelled = lambda w, g: -1.0 - g - len(w) / 8
    for i, text in enumerate(texts):
        pull, words = np.zeros(3), [w.encode() for w in words_of(text)]
        score.append(0.0)
        for j, w in enumerate(words):
            g = 8 if j == 0 else sum((pull[k] >= 0) << k for k in range(3))
            pull = pull + directions[np.frombuffer(w, np.uint8)].sum(axis=0)
            cell = count.setdefault((int(i >= 6), w), [None] * 9)
            cell[g] = (cell[g] or 0) + (i % 3 > 0)
            same = [j > k and words[j - k] == words[j - k - 1] for k in range(3)]
            context = same[1] + 2 * same[2]
            again[int(i >= 6)][f"n{2 * context + same[0]}"] += i % 3 > 0
            score[-1] += -0.5 - context if same[0] else -0.1 * context + spelled(w, g)
    assert {(r["block"], r["word"]): [r[n] for n in lm_score.N] for r in got if r["word"] != lm_score.REPEAT} == {
        k: v for k, v in count.items()}
    assert {r["block"]: Counter({n: r[n] for n in lm_score.N if r[n]}) for r in got if r["word"] == lm_score.REPEAT} == {
        k: +v for k, v in again.items()}
    written_results(tmp_path, got, spelled)
    repeated = np.array([[-0.1 * c for c in range(4)], [-0.5 - c for c in range(4)]])
    rows = [r for b in lm_score._add_up(str(tmp_path), shared, 1.0, repeated)(iter(
        [b.select([0, 1, 2, 3]) for b in batches])) for r in b.to_pylist()]
    assert [r["doc_id"] for r in rows] == list(range(len(texts)))
    for r, text, want in zip(rows, texts, score):
        n = len(words_of(text))
        assert (r["held_out"], r["n_tokens"], r["n_known"], r["n_bytes"]) == (r["doc_id"] % 3 == 0, n, n, len(text.encode()))
        assert r["score"] == pytest.approx(want) and r["base_score"] == pytest.approx(n * (math.log10(3) - 1))


def test_lm_makes_no_python_calls_a_word(tmp_path):
    """Words are numbered together when they are counted and when results are added up: the calls do not grow with the words."""
    shared = SimpleNamespace(value=np.random.default_rng(3).normal(size=(256, 3)))
    batches = block_batches([" ".join(f"unseen{j}word{i}" for i in range(500)) for j in range(40)])
    found = []
    written_results(tmp_path, [r for b in lm_score._vocabulary(shared)(iter(batches)) for r in b.to_pylist()], lambda w, g: -1.0)
    for kernel in (lm_score._vocabulary(shared), lm_score._add_up(str(tmp_path), shared, 1.0, np.zeros((2, 4)))):
        calls = Counter()
        sys.setprofile(lambda frame, event, arg: calls.update([event]))
        try:
            found.append(sum(b.num_rows for b in kernel(iter(batches))))
        finally:
            sys.setprofile(None)
        assert calls["call"] + calls["c_call"] < 10_000  # half of the words
    assert found == [20_000 + 4, 40]


def test_scores_do_not_depend_on_files(spark):
    docs = table(spark, SF_SMALL, "documents").select("doc_id", "text")
    found = []
    for n in (1, 5):
        split = staged(docs.repartition(n, "doc_id"), work_dir(spark, "t"))
        found.append({r.doc_id: r.score for r in lm_score.score_documents(split).select("doc_id", "score").collect()})
    assert found[0].keys() == found[1].keys() and all(found[1][i] == pytest.approx(x, rel=1e-6) for i, x in found[0].items())


def test_tree_is_a_distribution():
    counts = np.random.default_rng(2).integers(0, 50, (40, lm_score.GATES)).astype(float)
    assert np.allclose((10 ** lm_score.Tree(counts).scores()).sum(axis=0), 1)


# ------------------------------------------------------------------ 3
def edits(a, b):
    p = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        q = [i]
        for j, y in enumerate(b, 1):
            q.append(min(p[j] + 1, q[-1] + 1, p[j - 1] + (x != y)))
        p = q
    return p[-1]


def changed(rng, words, n):
    words = list(words)
    for _ in range(n):
        at = rng.randrange(len(words))
        kind = rng.random()
        if kind < 0.4:
            words[at] = f"new{rng.randrange(10**6)}"
        elif kind < 0.7 and len(words) > 1:
            del words[at]
        else:
            words.insert(at, f"more{rng.randrange(10**6)}")
    return words


def test_alignment_equals_the_full_table():
    rng = random.Random(1)
    for _ in range(1500):
        a = [rng.randrange(6) for _ in range(rng.randrange(1, 18))]
        b = [rng.randrange(6) if rng.random() < 0.2 else x for x in a if rng.random() < 0.9] or [1]
        d, limit = edits(a, b), rng.randrange(0, 9)
        assert near_dedup.edit_distance(np.asarray(a, np.int32), np.asarray(b, np.int32), limit) == (d if d <= limit else None)


def brute_classes(texts, similarity=0.8):
    words = [re.findall(r"[^\W_]+", (t or "").lower()) for t in texts]
    root = list(range(len(texts)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(texts)):
        for j in range(i):
            most = max(len(words[i]), len(words[j]))
            near = (texts[i] or "") == (texts[j] or "") or (
                min(len(words[i]), len(words[j])) and abs(len(words[i]) - len(words[j])) <= (1 - similarity) * most
                and len(set(words[i]) & set(words[j])) > 0.3 * len(set(words[i]))
                and edits(words[i], words[j]) <= (1 - similarity) * most + 1e-9)
            if near:
                a, b = sorted((find(i), find(j)))
                root[b] = a
    return [find(i) for i in range(len(texts))]


def test_many_alignments_at_once_equal_single_ones():
    rng = np.random.default_rng(6)
    a, b = [], []
    for _ in range(400):
        x = rng.integers(0, 40, rng.integers(1, 60)).astype(np.int32)
        y = x.tolist()
        for _ in range(rng.integers(0, 14)):
            at = rng.integers(0, len(y) + 1)
            if rng.random() < 0.5:
                y.insert(at, int(rng.integers(0, 40)))
            elif len(y) > 1:
                y.pop(min(at, len(y) - 1))
        a.append(x)
        b.append(np.asarray(y, np.int32))
    for similarity in (0.8, 0.95, 0.5):
        want = [near_dedup.edit_distance(x, y, int((1 - similarity) * max(len(x), len(y)) + 1e-9)) is not None for x, y in zip(a, b)]
        assert near_dedup.near_many(a, b, similarity).tolist() == want and 0 < sum(want) < 400
        assert near_dedup.near_pairs(a, b, similarity).tolist() == want
    long = np.arange(near_dedup.SHORT + 50, dtype=np.int32)
    assert near_dedup.near_pairs([long, long[:30]], [long[::-1].copy(), long[:27]], 0.8).tolist() == [False, True]


@pytest.fixture(scope="module")
def planted():
    rng = random.Random(7)
    texts = []
    for g in range(25):
        words = [f"g{rng.randrange(400)}" for _ in range(rng.choice([30, 80, 200]))]
        texts.append(" ".join(words))
        for _ in range(rng.randrange(0, 5)):
            texts.append(" ".join(changed(rng, words, rng.randrange(0, max(2, len(words) // 25)))))
    return texts + [None, "", "one", "One!", "two words"]


def test_classes_equal_brute_force(spark, planted):
    docs = spark.createDataFrame(list(enumerate(planted)), "doc_id long, text string")
    got = {r.doc_id: r.class_id for r in near_dedup.near_duplicate_classes(docs).collect()}
    assert [got[i] for i in range(len(planted))] == brute_classes(planted)
    kept = near_dedup.drop_near_duplicates(docs)
    assert sorted(r.doc_id for r in kept.collect()) == sorted(set(got.values()))


def test_pairs_with_one_word_in_ten_changed_meet(spark):
    texts = []
    for g in range(60):
        words = [f"g{g}w{i}" for i in range(100)]
        other = [f"new{g}x{i}" if i % 10 == g % 10 else w for i, w in enumerate(words)]
        texts += [" ".join(words), " ".join(other)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r.doc_id: r.class_id for r in near_dedup.near_duplicate_classes(docs).collect()}
    assert sum(got[2 * g] == got[2 * g + 1] for g in range(60)) >= 58


def test_near_pairs_in_a_large_bucket_are_linked(spark):
    """Hundreds of texts share a passage; every near pair among them that shares a sketch is one class, no other is."""
    rng = random.Random(17)
    passage = [f"p{i}" for i in range(80)]
    words = []
    for g in range(200):
        one = passage + [f"g{g}w{i}" for i in range(80)]
        other = [f"new{g}x{i}" if rng.random() < 0.14 else w for i, w in enumerate(one)]
        words += [one, other]
    texts = [" ".join(w) for w in words]
    sketches = near_dedup.sketch(near_dedup.word_hashes([t.encode() for t in texts]))
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r.doc_id: r.class_id for r in near_dedup.near_duplicate_classes(docs).collect()}
    for a in range(0, 400, 2):
        changes = sum(x != y for x, y in zip(words[a], words[a + 1]))
        if (sketches[a] == sketches[a + 1]).any():
            assert (got[a] == got[a + 1]) == (changes <= 32)
    assert all(i // 2 == c // 2 for i, c in got.items())


def test_least_distance_is_a_lower_bound():
    rng = random.Random(5)
    for _ in range(300):
        a = [rng.randrange(40) for _ in range(rng.randrange(1, 60))]
        b = changed(rng, a, rng.randrange(0, 20)) if rng.random() < 0.7 else [rng.randrange(40) for _ in range(rng.randrange(1, 60))]
        x, y = (near_dedup.bags([np.asarray([zlib.crc32(str(w).encode()) << 32 for w in t], np.uint64)]) for t in (a, b))
        assert near_dedup.least_distance(x, y)[0] <= edits(a, b)


def test_near_dedup_odd_rows(odd_docs, clashing, no_docs):
    kept = near_dedup.drop_near_duplicates(clashing)
    ids = Counter(r.doc_id for r in kept.collect())
    assert kept.columns == clashing.columns
    assert ids == Counter([1, 4, 6, None, 7, 8, 9, 10, 11])
    assert near_dedup.near_duplicate_classes(no_docs).count() == 0 and near_dedup.drop_near_duplicates(no_docs).count() == 0


def test_far_position_keeps_its_order():
    """Beyond the position bits the k-mer is still found."""
    words = [np.arange(1, (1 << near_dedup.POSITION_BITS) + 50, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)]
    assert near_dedup.sketch(words, 2).shape == (1, 2)


def test_components_of_chains(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(0, 40)] + [(100, 90), (90, 95), (7, 7)], "u long, v long")
    got = dict(map(tuple, near_dedup.components(edges, work_dir(spark, "t")).collect()))
    assert all(got[i] == 0 for i in range(1, 41)) and got[100] == 90 and got[95] == 90


# ------------------------------------------------------------------ 8
def brute_segments(s):
    """All maximal scoring segments by their definition: repeatedly the best segment, then left and right of it."""
    out = []

    def cut(a, b):
        best = max(((sum(s[i:j]), -(j - i), -i) for i in range(a, b) for j in range(i + 1, b + 1)), default=None)
        if best is None or best[0] <= 0:
            return
        i, j = -best[2], -best[2] - best[1]
        cut(a, i)
        out.append((i, j, best[0]))
        cut(j, b)

    cut(0, len(s))
    return out


def test_segments_equal_their_definition():
    rng = random.Random(3)
    for _ in range(400):
        s = [rng.choice([-3.0, -1.5, -0.25, 0.5, 1.25, 2.75]) + rng.random() / 100 for _ in range(rng.randrange(0, 14))]
        got = [(a, b, pytest.approx(x)) for a, b, x in toxicity.segments(np.asarray(s))]
        assert got == brute_segments(s)


def word_features(word):
    """The word and its stems, as slots."""
    return [zlib.crc32(x.encode()) % toxicity.SLOTS for x in [word, *(word[:k] + "-" for k in toxicity.STEMS if k < len(word))]]


def odd_chunks():
    rng = random.Random(11)
    signs = "aAbBzZ09_-.,' \n\t\x00éÉßΣσς漢字𝒳ﬁǅ²½٣\u0301"
    drawn = ["".join(rng.choice(signs if rng.random() < .6 else "abcdefgh") for _ in range(rng.choice([0, 1, 3, 8, 12, 30, 80])))
             for _ in range(3000)]
    drawn += [x * n for x in ("x", "é", "𝒳", "ab漢") for n in range(1, 60)] + ["word", "", " .", "ΑΣ"]
    return rng.sample(drawn, len(drawn))


@pytest.mark.parametrize("more", [[], ["İstanbul'İ"]])  # a capital that becomes two characters
@pytest.mark.parametrize("ascii_only", [False, True])
def test_toxicity_slots_are_those_of_each_word(ascii_only, more):
    chunks = [c for c in odd_chunks() + more if c.isascii() or not ascii_only]
    slots, counts = toxicity.word_slots([c.encode() for c in chunks])
    got = [[x for x in row if x >= 0] for row in slots.tolist()]
    assert got == [word_features(w) for c in chunks for w in plain_words(c)]
    assert counts.tolist() == [len(plain_words(c)) for c in chunks]
    for few in ([], [b""], [b"", b" .", b"a", b""]):
        assert toxicity.word_slots(few)[1].tolist() == [len(plain_words(c.decode())) for c in few]


def test_toxicity_word_scores_and_counts_equal_their_definition():
    value = np.random.default_rng(1).normal(0, 1, toxicity.SLOTS).astype(np.float32)
    value[::3] = 0
    chunks = [c.replace("Σ", "S") for c in odd_chunks()]  # whose small letter depends on the chunks beside it
    texts = [" ".join(chunks[i:i + 9]) for i in range(0, len(chunks), 9)]
    got = toxicity.Model("defined", SimpleNamespace(value=value), 1.0, 1.0, []).word_scores([t.encode() for t in texts])
    assert [x.tolist() for x in got] == [[float(max((value[f] for f in word_features(w)), key=abs) - np.float32(toxicity.DRIFT))
                                          for w in plain_words(t)] for t in texts]
    label = [i % 3 % 2 for i in range(len(texts))]
    want = Counter((f, y) for t, y in zip(texts, label) for w in plain_words(t) for f in word_features(w))
    batch = pa.RecordBatch.from_arrays([pa.array(texts), pa.array(label, pa.int32())], names=["line", "y"])
    rows = [r for b in toxicity._count(iter([batch.slice(0, 100), batch.slice(100)])) for r in b.to_pylist()]
    assert {(r["slot"], y): n for r in rows for y, n in ((1, r["toxic"]), (0, r["clean"])) if n} == want


def test_toxicity_makes_no_python_calls_a_word():
    """Words are hashed and scored together: the calls do not grow with the words."""
    texts = [" ".join(f"unseen{j}word{i}é" for i in range(500)).encode() for j in range(40)]
    model = toxicity.Model("calls", SimpleNamespace(value=np.zeros(toxicity.SLOTS, np.float32)), 1.0, 1.0, [])
    model.word_scores([b"first \xc3\xa9"])
    for work in (model.word_scores, toxicity._counter()):
        calls = Counter()
        sys.setprofile(lambda frame, event, arg: calls.update([event]))
        try:
            work(texts)
        finally:
            sys.setprofile(None)
        assert calls["call"] + calls["c_call"] < 20_000  # words


def test_toxicity_held_out(spark):
    scored = toxicity.op8_toxicity(spark, "/root/testdata/sf0.1").join(table(spark, "/root/testdata/sf0.1", "labels"), "doc_id").where("held_out")
    by = {(r.toxic, r.predicted): r.n for r in scored.groupBy("toxic", "predicted").agg(F.count("*").alias("n")).collect()}
    right, total = by.get((0, 0), 0) + by.get((1, 1), 0), sum(by.values())
    assert total > 500 and right / total > 0.96 and by[1, 1] / (by[1, 1] + by.get((1, 0), 0)) > 0.8


def test_toxicity_odd_rows(spark, odd_docs, clashing, no_docs):
    labels = spark.createDataFrame([(1, 1), (2, 1), (3, 1), (4, 0), (8, 0), (9, None), (None, 1), (11, 0), (11, 1)], "doc_id long, toxic int")
    model = toxicity.fit(clashing, labels)
    got = toxicity.score_documents(clashing, model).collect()
    assert len(got) == odd_docs.count() and all(0 <= r.toxic_score <= 1 and r.y == "mine y" for r in got)
    nothing = toxicity.fit(odd_docs, labels.limit(0))
    assert {r.toxic_score for r in toxicity.score_documents(odd_docs, nothing).collect()} == {0.0}
    assert toxicity.score_documents(no_docs, toxicity.fit(no_docs, labels)).count() == 0


# ------------------------------------------------------------------ pipeline
def test_pipeline_stages(spark):
    import corpus_pipeline

    docs = table(spark, SF_MID, "documents")
    columns = docs.columns
    seen = [docs.count()]
    for i, (name, stage) in enumerate(corpus_pipeline.STAGES):
        before, docs = docs, staged(stage(spark, docs, SF_MID), work_dir(spark, "t"))
        seen.append(docs.count())
        if i < 4:
            assert docs.columns == columns, name
        if name == "near dedup":
            texts = [r.text for r in before.select("text").where(F.length("text") > 2000).collect()]
            assert len(texts) > docs.where(F.length("text") > 2000).count() - 1
            assert docs.groupBy("text").count().where("count > 1").count() == 0
        if name == "decontamination":
            items = [r.text for r in table(spark, SF_MID, "benchmark").collect()]
            assert not [r.doc_id for r in docs.collect() if any(x in r.text for x in items)]
    assert seen[1] == seen[2] and seen[1] < seen[0] and seen[3] < seen[2] and seen[4] < seen[3] and seen[5] == seen[4]
    assert docs.where("not decoded_equal").count() == 0


def test_pipeline_odd_rows(spark, odd_docs, clashing, tmp_path):
    import corpus_pipeline

    for frame in (clashing, clashing.limit(0)):
        docs = frame
        for _, stage in corpus_pipeline.STAGES:
            docs = staged(stage(spark, docs, SF_SMALL), work_dir(spark, "t"))
        assert set(frame.columns) <= set(docs.columns)
        assert docs.count() == (0 if frame is not clashing else len({r.doc_id for r in docs.collect()}))
