"""Operators 11, 12 and 13 against brute force, with hand-made odd rows; and their parts."""

from __future__ import annotations

import hashlib
import heapq
import math
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from runlens.llm import flat_graph, phrase_mining, prefix_trie

# ------------------------------------------------------------------ 11
TURN = "conv_id long, turn long, role string, text string"


def brute_trie(rows):
    """One tuple per node, from the lists of whole prefixes. Ties of a turn must differ in their role."""
    turns = defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            turns[c].append((turn is not None, turn or 0, role or "", text or ""))
    own = {c: [x[2:] for x in sorted(t)] for c, t in turns.items()}
    built = {}
    for c, t in own.items():
        h = zlib.crc32(str(c).encode()) % 4
        base = c - int(math.fmod(c, 20))
        built[c] = own.get(base, [])[:h] + t[h:]
    members = defaultdict(list)
    for c, t in built.items():
        for d in range(len(t) + 1):
            members[tuple(t[:d])].append(c)
    kids = defaultdict(list)
    for p in members:
        if p:
            kids[p[:-1]].append(p)

    def totals(p):
        leaves, saved = 0 if kids[p] else 1, 0
        if p:
            saved = (len(members[p]) - 1) * len(re.findall(r"[^\x20\x09-\x0D]+", p[-1][1]))
        for k in kids[p]:
            a, b = totals(k)
            leaves, saved = leaves + a, saved + b
        return leaves, saved

    out = []
    for p, m in members.items():
        ends = ",".join(str(c) for c in sorted(c for c in m if len(built[c]) == len(p)))
        out.append((min(m), len(p), min(members[p[:-1]]) if p else None, len(m), len(kids[p]), *totals(p), hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(out, key=str)


def trie_of(spark, rows, **options):
    got = prefix_trie.conversation_trie(spark.createDataFrame(rows, TURN), **options)
    return sorted([tuple(r) for r in got.collect()], key=str)


def random_turns(seed, n=60, alphabet="ab"):
    rng = random.Random(seed)
    rows = []
    for c in range(n):
        length = rng.choice([1, 1, 2, 3, 5, 9])
        rows += [(c * rng.choice([1, 1, 1, 7]), i, rng.choice(["user", "bot"]), " ".join(rng.choices(alphabet, k=rng.randint(0, 3)))) for i in range(length)]
    seen, out = set(), []
    for r in rows:  # one row per conversation and turn
        if r[:2] not in seen:
            seen.add(r[:2])
            out.append(r)
    return out


@pytest.mark.parametrize("bound, band", [(None, prefix_trie.BAND), (3, 2), (1, 1)])
def test_trie_equals_brute_force(spark, bound, band):
    rows = random_turns(bound or 7)
    assert trie_of(spark, rows, bound=bound, band=band) == brute_trie(rows)


def test_trie_of_odd_rows(spark):
    long = " ".join(f"w{i}" for i in range(20_000))
    rows = [(None, 0, "user", "nobody's"), (1, None, "user", "first"), (1, 0, None, None), (1, 1, "user", "  "), (1, 1, "bot", "tie"),
            (2, 0, "user", long), (22, 0, "user", long), (40, 0, "a", "x"), (41, 0, "b", "y"), (41, 0, "b", "y"), (41, 2, "b", "z"), (-3, 0, "user", "x"),
            (9_000_000_000, 5, "user", "x"), (9_000_000_001, 5, "user", "x")]
    assert trie_of(spark, rows) == brute_trie(rows)
    alone = [(c, 0, "user", "x") for c in range(61, 70)]  # some lose their only turn and borrow none
    assert trie_of(spark, alone) == brute_trie(alone)
    assert trie_of(spark, []) == []
    df = spark.createDataFrame(rows, TURN).select("*", *[F.lit("mine").alias(c) for c in ("c", "id1", "depth", "rows", "words", "chunk")])
    assert sorted([tuple(r) for r in prefix_trie.conversation_trie(df).collect()], key=str) == brute_trie(rows)


def test_trie_of_a_long_conversation_in_bands(spark, monkeypatch):
    monkeypatch.setattr(prefix_trie, "BAND_BITS", 2)
    monkeypatch.setattr(prefix_trie, "BAND", 4)
    rows = [(5, i, "user", f"t{i % 3}") for i in range(45)] + [(25, i, "user", f"t{i % 3}") for i in range(45)] + [(26, i, "user", f"t{i % 3}") for i in range(30)]
    assert trie_of(spark, rows, bound=10, band=7) == brute_trie(rows)


def test_spilling_queue_and_sweep():
    rng = random.Random(3)
    items = [((rng.randint(-9, 0), rng.randint(0, 5)), (i,)) for i in range(500)]
    queue, plain, got, want = prefix_trie.SpillingQueue(7), [], [], []
    for i, item in enumerate(items):
        queue.push(*item)
        heapq.heappush(plain, item)
        if i % 3 == 0:
            assert queue.least() == plain[0][0]
            got.append(queue.pop())
            want.append(heapq.heappop(plain)[1])
    while plain:
        got.append(queue.pop())
        want.append(heapq.heappop(plain)[1])
    assert got == want and queue.least() is None and len(queue.rows) <= 7
    nodes = [(d, i, 0, i // 2, 0, 100 + i, 2, 3, 0, 0, 0) for d in (4, 3, 2, 1) for i in range(2 ** d)]
    assert list(prefix_trie.sweep(iter(nodes), 3)) == list(prefix_trie.sweep(iter(nodes)))
    top = [r for r in prefix_trie.sweep(iter(nodes)) if not r[-1]]
    assert [(r[0], r[8], r[9]) for r in top] == [(1, 8, 45), (1, 8, 45)]


# ------------------------------------------------------------------ 12
def brute_phrases(docs, least, top):
    f, n = defaultdict(Counter), Counter()
    for lang, text in docs:
        lang = "und" if lang is None else lang
        low = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", low):
            w = [x for x in re.split(r"[\x20\x09]+", piece) if x]
            n[lang] += len(w)
            for k in range(1, 6):
                f[lang].update(tuple(w[i:i + k]) for i in range(len(w) - k + 1))
    out = []
    for lang, counts in f.items():
        found = {p: a for p, a in counts.items() if len(p) > 1 and a >= least}
        covered = set()
        for p, a in found.items():
            for i in range(len(p)):
                for j in range(i + 2, len(p) + 1):
                    q = p[i:j]
                    if len(q) < len(p) and 100 * a >= 100 * found[q]:
                        covered.add(q)
        rows = []
        for p, a in found.items():
            if p not in covered:
                score, _, left, right = min((1000 * a * n[lang] // (counts[p[:k]] * counts[p[k:]]), k, counts[p[:k]], counts[p[k:]]) for k in range(1, len(p)))
                rows.append((-score, -a, " ".join(p).encode(), a, left, right, n[lang], score))
        out += [(lang, i, r[2].decode(), *r[3:]) for i, r in enumerate(sorted(rows)[:top], 1)]
    return sorted(out)


def random_texts(seed, n=300):
    rng = random.Random(seed)
    words = ["the", "The", "of", "rivér", "漢字", "a", "b", "New", "York", "it's", "x y"]
    seps = [" "] * 12 + ["  ", "\t", ". ", ",", "\n", " \r\n", "!?", "\x0b"]
    return [(rng.choice(["en", "en", "en", "fr", None, ""]), "".join(rng.choice(words) + rng.choice(seps) for _ in range(rng.randint(0, 40)))) for _ in range(n)]


@pytest.mark.parametrize("least, top", [(2, 10_000), (20, 7)])
def test_collocations_equal_brute_force(spark, least, top):
    docs = random_texts(least) + [(None, None), ("en", ""), ("de", "nothing twice"), ("en", "New York the " * 30_000)]
    df = spark.createDataFrame(docs, "lang string, text string").repartition(5)
    got = phrase_mining.collocations(df.select("*", F.lit(1).alias("n"), F.lit("x").alias("phrase"), F.lit(2).alias("score")), least, top)
    assert got.columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]
    assert sorted(tuple(r) for r in got.collect()) == brute_phrases(docs, least, top)


def test_no_phrases(spark):
    empty = spark.createDataFrame([], "lang string, text string")
    assert phrase_mining.collocations(empty).collect() == []
    assert phrase_mining.collocations(spark.createDataFrame([("en", "a b c")], "lang string, text string")).collect() == []


def test_containers_burst_and_spill():
    rng = np.random.default_rng(5)
    want, trie, spilled = Counter(), phrase_mining.HatTrie(burst=400), Counter()
    for _ in range(60):
        ids = rng.zipf(1.4, (500, 5)).clip(1, 30)
        bits = phrase_mining.WORD_BITS
        a = ids[:, 0] << 2 * bits | ids[:, 1] << bits | ids[:, 2] * rng.integers(0, 2, 500)
        b = (ids[:, 3] << bits | ids[:, 4]) * (a & (1 << bits) - 1 > 0)
        want.update(zip(a.tolist(), b.tolist()))
        trie.add(*phrase_mining._sums(a, b, np.ones(500, np.int64)))
        if len(trie) > 9000:
            for run in trie.spill(4000):
                assert sorted(zip(run[0].tolist(), run[1].tolist())) == list(zip(run[0].tolist(), run[1].tolist()))  # a sorted run
                for x, y, m in zip(*[c.tolist() for c in run]):
                    spilled[x, y] += m
            assert len(trie) <= 4000
    assert len(trie.leaves) > 5 and (np.diff(trie.bounds) > 0).all()
    for run in trie.spill(0):
        for x, y, m in zip(*[c.tolist() for c in run]):
            spilled[x, y] += m
    assert spilled == want and len(trie) == 0


def test_a_task_that_spills_and_renumbers_counts_the_same():
    docs = [t.encode() for _, t in random_texts(9, 200)]
    ones = np.full(phrase_mining.SLOTS // 8, 255, np.uint8)  # everything passes the filters
    for pairs in (None, ones):
        found = []
        for held, known in ((1 << 20, 1 << 20), (50, 1 << 20), (10, 3)):
            counter, sums = phrase_mining.Counter(ones, pairs, held, known), Counter()
            batches = [x for i in range(0, 200, 10) for x in counter.add(b"en", docs[i:i + 10])] + list(counter.flush(0))
            for b in batches:
                for p, m in zip(b.column(1).to_pylist(), b.column(2).to_pylist()):
                    sums[p] += m
            found.append(sums)
        assert found[0] == found[1] == found[2] and len(found[0]) > 50


# ------------------------------------------------------------------ 13
EMBEDDING = "vec_id long, embedding array<double>, label string"


def brute_links(rows, similarity=flat_graph.SIMILARITY):
    def usable(v, label):
        return label is not None and v is not None and len(v) > 0 and all(x is not None and math.isfinite(x) for x in v) and any(v)

    n = len(rows)
    vec = [np.asarray(v) / max(map(abs, v)) if usable(v, label) else None for _, v, label in rows]
    links = [[j for j in range(n) if j != i and vec[i] is not None and vec[j] is not None and rows[i][2] == rows[j][2] and len(vec[i]) == len(vec[j])
              and vec[i] @ vec[j] / math.sqrt((vec[i] @ vec[i]) * (vec[j] @ vec[j])) >= similarity] for i in range(n)]
    root = list(range(n))
    for i in range(n):
        todo, seen = [i], {i}
        while todo:
            for j in links[todo.pop()]:
                if j not in seen:
                    seen.add(j)
                    todo.append(j)
        ids = [rows[j][0] for j in seen if rows[j][0] is not None]
        root[i] = min(ids) if ids else None
    return sorted([(rows[i][0], len(links[i]), root[i], rows[i][0] == root[i]) for i in range(n)], key=str)


def links_of(df, **options):
    return sorted([tuple(r) for r in flat_graph.near_duplicates(df, **options).collect()], key=str)


def crowded(seed, n=500, dim=24):
    """Random vectors, pairs of near copies, a loose chain and a crowd around one direction."""
    rng = np.random.default_rng(seed)
    x = rng.normal(size=(n, dim))
    for i in range(0, 60, 2):
        x[i + 1] = x[i] + rng.normal(size=dim) * 0.1
    for i in range(60, 80):
        x[i + 1] = x[i] + rng.normal(size=dim) * 0.3
    x[200:360] = x[200] + rng.normal(size=(160, dim)) * 0.18
    return [(i, v.tolist(), "ab"[i % 5 == 0]) for i, v in enumerate(x)]


def test_links_equal_brute_force(spark):
    rows = crowded(1)
    df = spark.createDataFrame(rows, EMBEDDING).repartition(6)
    assert links_of(df) == brute_links(rows)


def test_balls_and_divided_shards_give_the_same_links(spark, monkeypatch):
    rows = crowded(2, 700)
    df = spark.createDataFrame(rows, EMBEDDING)
    want = brute_links(rows)
    monkeypatch.setattr(flat_graph.fit_balls, "__defaults__", (20,))  # the crowd becomes a ball
    half = math.acos(flat_graph.SIMILARITY) / 2
    x = flat_graph.unit(np.asarray([v for _, v, label in rows if label == "a"]))
    assert len(flat_graph.fit_balls(x, half)) >= 1
    assert links_of(df) == want
    monkeypatch.setattr(flat_graph, "LARGE", 200)
    monkeypatch.setattr(flat_graph, "SHARD", 60)
    got = links_of(df)
    assert sum(r[1] for r in got) >= flat_graph.RECALL * sum(r[1] for r in want)
    assert all(g[1] <= w[1] for g, w in zip(sorted(got), sorted(want)))


def test_links_of_odd_vectors(spark):
    v, nan, inf = [1.0, 2.0, 3.0], float("nan"), float("inf")
    rows = [(1, v, "a"), (2, [1e300, 2e300, 3e300], "a"), (3, [1e-300, 2e-300, 3.1e-300], "a"), (4, v, "b"), (5, v, None), (6, None, "a"), (7, [0.0] * 3, "a"),
            (8, [1.0, None, 3.0], "a"), (9, [1.0, nan, 3.0], "a"), (10, [1.0, inf, 3.0], "a"), (11, v, "a"), (11, v, "a"), (None, v, "a"), (None, v, "c"), (12, v + [0.0], "a"),
            (13, [], "a"), (14, [-1.0, -2.0, -3.0], "a"), (15, [3.0, 2.0, 1.0], "a")]
    df = spark.createDataFrame(rows, EMBEDDING)
    assert links_of(df) == brute_links(rows)
    mine = df.select("*", *[F.lit(1).alias(c) for c in ("node", "grp", "v", "m", "ball", "shard", "first", "h1")])
    assert links_of(mine) == brute_links(rows)
    assert links_of(df.limit(0)) == []


def test_very_many_equal_vectors(spark):
    rows = [(i, [1.0, float(i % 2)], "a") for i in range(30_000)]
    got = flat_graph.near_duplicates(spark.createDataFrame(rows, EMBEDDING))
    assert sorted(tuple(r) for r in got.groupBy("n_links", "component_id").count().collect()) == [(14_999, 0, 15_000), (14_999, 1, 15_000)]


def test_pruned_graph_is_searched_in_full():
    rng = np.random.default_rng(4)
    x = rng.normal(size=(900, 32))
    x[1::3] = x[::3] + rng.normal(size=(300, 32)) * 0.1
    x = flat_graph.unit(x)
    graph = flat_graph.build_graph(x)
    assert graph.shape[1] == flat_graph.DEGREE and (graph != np.arange(900)[:, None]).all()
    found = flat_graph.range_search(x, graph, 0.93)
    true = {i * 900 + j for i, j in zip(*np.nonzero(x @ x.T >= 0.93))}
    assert set(found.tolist()) == true
    # robust pruning: no kept neighbour is nearer, by the factor, to a later one than the row is
    for i in range(0, 900, 50):
        kept = [j for j in graph[i] if j >= 0]
        for a in range(len(kept)):
            for b in range(a):
                assert flat_graph.ALPHA * np.linalg.norm(x[kept[a]] - x[kept[b]]) >= np.linalg.norm(x[i] - x[kept[a]]) - 1e-9


def test_packed_runs_hold_every_phrase_once_a_partition(monkeypatch):
    """A task's phrases leave it in few rows, whose lines and counts are those of the single phrases."""
    monkeypatch.setattr(phrase_mining, "PARTS", 16)

    class Bits:
        value = np.full(phrase_mining.SLOTS // 8, 255, np.uint8)

    docs = [(x or "und", t) for x, t in random_texts(4, 200)]
    batch = pa.RecordBatch.from_arrays([pa.array([x for x, _ in docs]), pa.array([t for _, t in docs])], names=["lang", "text"])
    for pairs in (None, Bits):
        want, sums, rows, part_of = Counter(), Counter(), 0, {}
        single = phrase_mining.Counter(Bits.value, pairs and Bits.value)
        for lang, texts in phrase_mining._by_lang(iter([batch])):
            for b in single.add(lang, texts):
                want.update(dict(zip(zip(*(b.column(i).to_pylist() for i in (0, 1))), b.column(2).to_pylist())))
        for b in single.flush(0):
            want.update(dict(zip(zip(*(b.column(i).to_pylist() for i in (0, 1))), b.column(2).to_pylist())))
        for b in phrase_mining._count_phrases(Bits, pairs)(iter([batch])):
            for part, lang, phrases, ns in zip(*(c.to_pylist() for c in b.columns), strict=True):
                rows += 1
                for p, n in zip(phrases.split("\n"), ns, strict=True):
                    sums[lang, p] += n
                    head = (lang, *p.split(" ")[:2])
                    assert part_of.setdefault(head, part) == part
        assert sums == want and rows < len(want) / 2
