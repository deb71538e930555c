"""Operator 3 — near-duplicate classes by Order MinHash, verified by banded alignment.

Sketch: the five-word k-mers of a text are labelled with their occurrence
number; each of ``sketches`` hash functions takes the two smallest labelled
k-mers and keeps them in text order, so a sketch agrees only where content and
order agree (sensitive to edit similarity, not to shared vocabulary).

Classes: texts that share a sketch meet in a bucket. In each bucket the smallest
node of each length class leads, and the others of its class are verified against
it, which joins groups of near copies at a cost of one pair a node. In buckets
that then still hold several classes, every node outside the largest may link with
nodes of other classes and of a length that allows it. In a bucket of at most
``SMALL`` nodes they all meet, as pairs. The nodes of a larger one are packed into blocks of about
``BLOCK_WORDS`` words; blocks with nodes outside the largest class meet every block of the bucket, and a task
compares what their nodes' lengths and word counts leave, in the bucket of the first sketch that two nodes share, until their classes
are joined, and sends the links alone: texts that only share a passage cost no row. Nothing else is left
out, so a pair that shares a sketch is in one class whenever it is near. These pairs are aligned a few of each node at a time,
without those that have come into one class meanwhile.
Pairs are linked if the word edit distance
is at most (1 - ``similarity``) times the longer length: refused if counts of the
words in ``BINS`` classes differ by more, accepted if a chain of unique common word
triples already bounds it, else aligned within that band.
Classes are the connected components of the links.
Equal texts are one node from the start.

Scale: the sketch table has ``sketches`` longs and ``BINS`` bytes a distinct text; joins
on buckets and leaders are splittable equi-joins; texts travel only for nodes in
pairs that their counts leave possible; every round ends in a written table in the shared folder.

Recall: a pair of similarity J in labelled five-word k-mers shares a sketch with
probability about J * J and is missed by all 32 with probability (1 - J * J) ** 32:
below 1e-6 at J = 0.63 (one word in twenty changed), about 0.2 % at 0.42 (one in
ten), 5 % at 0.3, 29 % at 0.2 (one in five, evenly spread: the limit itself).

Defined results: null and empty texts are equal texts; texts without words
match only equal texts; texts of fewer than five words are one k-mer; a null
doc_id sorts after ids when a class is named; repeated rows share a class.
"""

from __future__ import annotations

import math
from bisect import bisect_left
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from runlens.llm.common import checked, discard, free_name, staged, table, work_dir
from runlens.llm.ragged import text_groups
from runlens.llm.shingles import shingle_hashes, word_hashes

WORDS = 5
SKETCHES = 32
BINS = 128  # classes of words that are counted
FINE_BINS = 2048  # the same inside a task that holds the words
SHORT = 800  # words of texts that are aligned many at a time
SIMILARITY = 0.8
SMALL = 32  # nodes of a bucket that all meet as pairs
BLOCK_WORDS = 1 << 16  # words of a block of a larger bucket
BATCH_ROWS = 1000
BATCH_BYTES = 16 << 20
POSITION_BITS = 20

_rng = np.random.default_rng(310)
_MUL = _rng.integers(1, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_ADD = _rng.integers(0, 1 << 63, 256, dtype=np.uint64)
_POS = np.uint64((1 << POSITION_BITS) - 1)
_MAX = np.uint64(0xFFFFFFFFFFFFFFFF)


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    return x ^ (x >> np.uint64(29))


def _labelled(s: np.ndarray, doc: np.ndarray) -> np.ndarray:
    """k-mer hashes; from the second occurrence on with the occurrence number mixed in, so that a document's labels do not
    depend on those it is labelled with."""
    key = s ^ _mixed(doc.astype(np.uint64) + np.uint64(1))
    order = np.argsort(key, kind="stable")
    ordered = key[order]
    run = np.flatnonzero(np.r_[True, ordered[1:] != ordered[:-1]])
    if len(run) == len(s):
        return s
    number = np.empty(len(s), np.uint64)
    number[order] = np.arange(len(s)) - np.repeat(run, np.diff(np.r_[run, len(s)]))
    return np.where(number > 0, _mixed(s + number * np.uint64(0xD6E8FEB86659FD93)), s)


def sketch(words: list[np.ndarray], sketches: int = SKETCHES, k: int = WORDS) -> np.ndarray:
    """Order MinHash sketches of texts with at least one word: (text, sketch) as signed 64-bit keys."""
    parts = [shingle_hashes(w, min(k, len(w))) for w in words]
    sizes = np.asarray([len(p) for p in parts])
    starts = np.cumsum(sizes) - sizes
    doc = np.repeat(np.arange(len(parts)), sizes)
    label = _labelled(np.concatenate(parts), doc)
    place = np.minimum(np.arange(len(label)) - np.repeat(starts, sizes), int(_POS)).astype(np.uint64)
    out = np.empty((len(parts), sketches), np.uint64)
    for j in range(sketches):
        key = label * _MUL[j] + _ADD[j]  # labels are mixed already
        key &= ~_POS
        key |= place
        one = np.minimum.reduceat(key, starts)
        at = starts + (one & _POS).astype(np.int64)
        lost = key[at] != one  # a place beyond the position bits: look for the k-mer itself
        for d in np.flatnonzero(lost).tolist():
            at[d] = starts[d] + int(key[starts[d]:starts[d] + sizes[d]].argmin())
        key[at] = _MAX
        two = np.minimum.reduceat(key, starts)
        a, b = one >> np.uint64(POSITION_BITS), two >> np.uint64(POSITION_BITS)
        swap = (two & _POS) < (one & _POS)
        first, second = np.where(swap, b, a), np.where(swap, a, b)
        out[:, j] = _mixed(first * np.uint64(0x9E3779B97F4A7C15) + _mixed(second + np.uint64(j + 1)))
    return out.view(np.int64)


def bags(words: list[np.ndarray]) -> np.ndarray:
    """(text, class): how many of a text's words fall into each of ``BINS`` classes, at most 255."""
    out = np.empty((len(words), BINS), np.uint8)
    for i, w in enumerate(words):
        out[i] = np.minimum(np.bincount((w >> np.uint64(57)).astype(np.int64), minlength=BINS), 255)
    return out


def least_distance(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """A lower bound of the word edit distance from ``bags``: an edit takes at most one word out of a class and puts at
    most one into another."""
    d = a.astype(np.int16) - b
    return np.maximum(np.maximum(d, 0).sum(1), np.maximum(-d, 0).sum(1))


def _increasing(x: np.ndarray) -> np.ndarray:
    """Places of a longest increasing subsequence."""
    if len(x) < 2 or (x[1:] > x[:-1]).all():
        return np.arange(len(x))
    ends, at, before = [], [], []
    for i, v in enumerate(x.tolist()):
        k = bisect_left(ends, v)
        before.append(at[k - 1] if k else -1)
        if k == len(ends):
            ends.append(v)
            at.append(i)
        else:
            ends[k], at[k] = v, i
    out, i = [], at[-1]
    while i >= 0:
        out.append(i)
        i = before[i]
    return np.asarray(out[::-1])


def distance_bound(a: np.ndarray, b: np.ndarray) -> int:
    """An upper bound of the word edit distance: between the common triples that each text holds once, in the
    order of both, everything is taken as changed."""
    n, m = len(a), len(b)
    if n < 3 or m < 3:
        return max(n, m)
    x, y = (shingle_hashes(t.astype(np.uint64), 3) for t in (a, b))
    ux, px, cx = np.unique(x, return_index=True, return_counts=True)
    uy, py, cy = np.unique(y, return_index=True, return_counts=True)
    _, ix, iy = np.intersect1d(ux[cx == 1], uy[cy == 1], assume_unique=True, return_indices=True)
    i, j = px[cx == 1][ix], py[cy == 1][iy]
    order = np.argsort(i)
    i, j = i[order], j[order]
    chain = _increasing(j)
    if not len(chain):
        return max(n, m)
    i, j = i[chain], j[chain]
    di, dj = np.diff(np.append(i, n)), np.diff(np.append(j, m))
    return int(max(i[0], j[0]) + (np.maximum(di, dj) - np.minimum(np.minimum(di, dj), 3)).sum())


def edit_distance(a: np.ndarray, b: np.ndarray, limit: int) -> int | None:
    """Word edit distance if it is at most ``limit``, else None.

    The table is computed column by column inside the band of 2 * limit + 1 rows around the diagonal; a column's
    differences between neighbouring rows are the bits of two integers, bit t standing for row j - limit + t."""
    n, m = len(a), len(b)
    if abs(n - m) > limit:
        return None
    if not n or not m:
        return max(n, m)
    # a word of the longer text that the shorter one lacks costs at least one edit
    x, cx = np.unique(a, return_counts=True)
    y, cy = np.unique(b, return_counts=True)
    _, ix, iy = np.intersect1d(x, y, assume_unique=True, return_indices=True)
    if max(n, m) - int(np.minimum(cx[ix], cy[iy]).sum()) > limit:
        return None
    k = limit
    places: dict[int, int] = {}
    for i, w in enumerate(a.tolist()):
        places[w] = places.get(w, 0) | 1 << i
    full, top = (1 << 2 * k + 1) - 1, 1 << 2 * k
    rises, falls = full & ~((1 << k + 1) - 1), 0  # column 0 holds 0, 1, 2 ...
    distance = min(k, n)  # in the band's last row, later in row n
    for j, w in enumerate(b.tolist(), 1):
        rises, falls = rises >> 1 | top, falls >> 1
        same = places.get(w, 0)
        same = (same >> j - k - 1 if j > k else same << k + 1 - j) & full
        level = ((same & rises) + rises ^ rises | same | falls) & full  # equal to the cell up and left
        right_up, right_down = falls | full & ~(level | rises), level & rises
        if j + k <= n:
            distance += not level & top
        else:
            at = n - j + k
            distance += (right_up >> at & 1) - (right_down >> at & 1)
        above = right_up << 1 | 1
        rises, falls = (right_down << 1 | ~(level | above)) & full, level & above & full
    return distance if distance <= limit else None


def _sketches(sketches: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start, texts in text_groups(batch.column(1)):
                words = word_hashes(texts)
                some = [i for i, w in enumerate(words) if len(w)]
                if not some:
                    continue
                words = [words[i] for i in some]
                keys = sketch(words, sketches)
                offsets = pa.array(np.arange(len(some) + 1, dtype=np.int32) * sketches)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(start, len(texts)).take(pa.array(some)),
                     pa.array([len(w) for w in words], pa.int64()),
                     pa.ListArray.from_arrays(offsets, pa.array(keys.ravel())),
                     pa.array([x.tobytes() for x in bags(words)], pa.binary())], names=["node", "n", "keys", "bag"])

    return run


def _words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for start, texts in text_groups(batch.column(1)):
            words = [(w >> np.uint64(32)).astype(np.uint32).view(np.int32) for w in word_hashes(texts)]
            offsets = pa.array(np.cumsum([0] + [len(w) for w in words], dtype=np.int32))
            yield pa.RecordBatch.from_arrays([batch.column(0).slice(start, len(texts)),
                                              pa.ListArray.from_arrays(offsets, pa.array(np.concatenate(words)))],
                                             names=["node", "words"])


def _possible(similarity: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            a, b = (np.frombuffer(b"".join(batch.column(i).to_pylist()), np.uint8).reshape(-1, BINS) for i in (3, 4))
            limit = (1 - similarity) * np.asarray(batch.column(2)) + 1e-9
            yield batch.select(["leader", "node"]).filter(pa.array(least_distance(a, b) <= limit))

    return run


def _near(a: np.ndarray, b: np.ndarray, similarity: float) -> bool:
    limit = int((1 - similarity) * max(len(a), len(b)) + 1e-9)
    return distance_bound(a, b) <= limit or edit_distance(a, b, limit) is not None


def near_many(a: list[np.ndarray], b: list[np.ndarray], similarity: float) -> np.ndarray:
    """Which pairs are near: the table of all pairs at once, column by column inside the widest band among them."""
    n, m = (np.asarray([len(t) for t in side]) for side in (a, b))
    limit = ((1 - similarity) * np.maximum(n, m) + 1e-9).astype(np.int64)
    k, rows = int(limit.max()), np.arange(len(a))
    x, y = np.zeros((len(a), int(n.max()) + int(m.max()) + 2 * k + 2), np.int32), np.zeros((len(b), int(m.max())), np.int32)
    for i, (s, t) in enumerate(zip(a, b)):  # what lies outside a text is never part of a path inside the table
        x[i, k:k + len(s)], y[i, :len(t)] = s, t
    step = np.arange(2 * k + 1, dtype=np.int16)  # row i of column j stands at i - j + k
    now = np.broadcast_to(np.where(step >= k, step - k, 16_000).astype(np.int16), (len(a), 2 * k + 1)).copy()
    out = np.full(len(a), 1 << 30)
    for j in range(1, int(m.max()) + 1):
        new = now + (x[:, j - 1:j + 2 * k] != y[:, j - 1:j])
        np.minimum(new[:, :-1], now[:, 1:] + np.int16(1), out=new[:, :-1])
        new -= step
        np.minimum.accumulate(new, axis=1, out=new)
        new += step
        now = np.minimum(new, np.int16(16_000))
        done = rows[m == j]
        at = n[done] - j + k
        fits = (at >= 0) & (at <= 2 * k)
        out[done[fits]] = now[done[fits], at[fits]]
    return out <= limit


def near_pairs(a: list[np.ndarray], b: list[np.ndarray], similarity: float) -> np.ndarray:
    """Which pairs are near: texts of about one length together, very long ones one by one."""
    size = np.asarray([max(len(s), len(t)) for s, t in zip(a, b)])
    out, order, at = np.zeros(len(a), bool), np.argsort(size), 0
    while at < len(order):
        if size[order[at]] > SHORT:
            some = order[at:at + 1]
            out[some] = _near(a[some[0]], b[some[0]], similarity)
        else:
            some = order[at:at + int(np.searchsorted(size[order[at:]], min(SHORT, 1.4 * size[order[at]]), "right"))]
            out[some] = near_many([a[i] for i in some], [b[i] for i in some], similarity)
        at += len(some)
    return out


def _block(rows: pa.StructArray) -> tuple:
    """(nodes, classes, word lists, bags, keys) of a block."""
    words = rows.field("words")
    cuts, values = np.asarray(words.offsets), np.asarray(words.values)
    bags_ = np.frombuffer(b"".join(rows.field("bag").to_pylist()), np.uint8).reshape(-1, BINS)
    keys = np.asarray(rows.field("keys").flatten()).reshape(len(rows), -1)
    return np.asarray(rows.field("node")), np.asarray(rows.field("root")), [values[i:j] for i, j in zip(cuts[:-1], cuts[1:])], bags_, keys


def _fine_bags(words: list[np.ndarray]) -> np.ndarray:
    """Like ``bags``, in so many classes that unrelated words seldom share one."""
    out = np.empty((len(words), FINE_BINS), np.uint8)
    for i, w in enumerate(words):
        out[i] = np.minimum(np.bincount(w.view(np.uint32) & np.uint32(FINE_BINS - 1), minlength=FINE_BINS), 255)
    return out


def _linked(similarity: float):
    """Pairs of blocks (key, a, b) of a bucket -> links between nodes of different classes."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            u, v = [], []
            for r in range(batch.num_rows):
                key = batch.column(0)[r].as_py()
                left, right = (_block(batch.column(c)[r].values) for c in (1, 2))
                n, m = (np.asarray([len(w) for w in side[2]]) for side in (left, right))
                longer = np.maximum(n[:, None], m[None, :])
                may = (left[1][:, None] != right[1][None, :]) & (np.abs(n[:, None] - m[None, :]) <= (1 - similarity) * longer + 1e-9)
                for k in range(int(np.flatnonzero(left[4][0] == key)[0])):  # two nodes that share an earlier sketch meet there
                    may &= left[4][:, k][:, None] != right[4][:, k][None, :]
                i, j = np.nonzero(may)
                found = [np.empty(0, np.int64)] * 3
                fine = [_fine_bags(side[2]) for side in (left, right)] if len(i) else []
                for s in range(0, len(i), 1 << 13):
                    x, y = i[s:s + (1 << 13)], j[s:s + (1 << 13)]
                    fits = least_distance(left[3][x], right[3][y]) <= (1 - similarity) * longer[x, y] + 1e-9
                    x, y = x[fits], y[fits]
                    least = least_distance(fine[0][x], fine[1][y])
                    fits = least <= (1 - similarity) * longer[x, y] + 1e-9
                    found = [np.r_[f, g[fits]] for f, g in zip(found, (least, x, y))]
                root = {c: c for c in np.r_[left[1], right[1]].tolist()}

                def of(c: int) -> int:
                    while root[c] != c:
                        root[c] = c = root[root[c]]
                    return c

                order = np.argsort(found[0], kind="stable")  # the likeliest first
                todo, size = list(zip(found[1][order].tolist(), found[2][order].tolist())), 16
                while todo:  # a few pairs at a time, without those whose classes are one by now
                    todo = [(x, y) for x, y in todo if of(int(left[1][x])) != of(int(right[1][y]))]
                    some, todo, size = todo[:size], todo[size:], min(2 * size, 64)
                    near = near_pairs([left[2][x] for x, _ in some], [right[2][y] for _, y in some], similarity)
                    for (x, y), hit in zip(some, near.tolist()):
                        if hit:
                            root[of(int(left[1][x]))] = of(int(right[1][y]))
                            u.append(int(left[0][x]))
                            v.append(int(right[0][y]))
            yield pa.RecordBatch.from_arrays([pa.array(u, pa.int64()), pa.array(v, pa.int64())], names=["u", "v"])

    return run


def _large_buckets(rows: DataFrame, nodes: DataFrame, texts: DataFrame, similarity: float, out_dir: str) -> DataFrame:
    """(u, v) links between the classes of buckets; rows: (node, n, key, root, major)."""
    words = staged(texts.join(checked(rows.select("node").distinct()), "node", "left_semi").mapInArrow(_words, "node long, words array<int>")
                   .dropDuplicates(["node"]), f"{out_dir}-words")
    sided = rows.select("key", "node", "n", "root", (F.col("root") == F.col("major")).alias("main"))
    weights = sided.groupBy("key", "main").agg(F.ceil(F.sum(F.col("n") + 100) / BLOCK_WORDS).alias("blocks"))
    held = nodes.select("node", "bag", "keys").join(words, "node")
    numbered = sided.join(checked(weights), ["key", "main"]).withColumn("block", F.pmod(F.xxhash64("node"), "blocks"))
    packed = staged(numbered.join(held, "node").groupBy("key", "main", "block").agg(
        F.collect_list(F.struct("node", "root", "bag", "keys", "words")).alias("rows")), f"{out_dir}-packed")
    ids = packed.select("key", "main", "block")
    met = ids.where("not main").select("key", F.col("block").alias("first")).join(ids, "key").where(F.col("main") | (F.col("block") >= F.col("first")))
    firsts = packed.where("not main").select("key", F.col("block").alias("first"), F.col("rows").alias("a"))
    # few bytes stand for much work: a fixed number of partitions, which are not coalesced by their size
    spread = lambda df: df.repartition(4 * df.sparkSession.sparkContext.defaultParallelism, "key", "main", "block")
    pairs = spread(met.join(firsts, ["key", "first"])).join(spread(packed.withColumnRenamed("rows", "b")), ["key", "main", "block"])
    return staged(pairs.select("key", "a", "b").mapInArrow(_linked(similarity), "u long, v long").distinct(), f"{out_dir}-links")


def _align(similarity: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows(column):
            offsets, values = np.asarray(column.offsets), np.asarray(column.values)
            return [values[a:b] for a, b in zip(offsets[:-1], offsets[1:])]

        for batch in batches:
            near = []
            for a, b in zip(rows(batch.column(2)), rows(batch.column(3))):
                near.append(_near(a, b, similarity))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(near, pa.bool_())],
                                             names=["leader", "node", "near"])

    return run


def components(edges: DataFrame, out_dir: str) -> DataFrame:
    """(node, root) of every node in ``edges`` (u, v): alternating large-star and small-star rounds,
    each written to the shared folder; root is the component's smallest node."""
    def sized(e: DataFrame) -> tuple:
        r = e.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        return r[0], r[1]

    now = staged(edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).where("u <> v").distinct(), f"{out_dir}/0")
    size, i = sized(now), 0
    while True:
        i += 1
        both = now.unionAll(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
        large = both.join(low, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").unionAll(
            least.select("u", F.col("m").alias("v"))).distinct()
        now = staged(small, f"{out_dir}/{i}")
        after = sized(now)
        discard(edges.sparkSession, f"{out_dir}/{i - 1}")
        if after == size:
            break
        size = after
    return now.groupBy("u").agg(F.min("v").alias("root")).select(F.col("u").alias("node"), "root")


def _candidates(pairs: DataFrame, nodes: DataFrame, similarity: float, path: str) -> DataFrame:
    """(leader, node) of the distinct pairs (leader, node, longer) whose bags allow a link."""
    met = pairs.join(nodes.select(F.col("node").alias("leader"), F.col("bag").alias("a")), "leader").join(
        nodes.select("node", F.col("bag").alias("b")), "node")
    return staged(met.select("leader", "node", "longer", "a", "b").mapInArrow(_possible(similarity), "leader long, node long"), path)


def _verified(pairs: DataFrame, texts: DataFrame, similarity: float, out_dir: str) -> DataFrame:
    """(leader, node, near) of distinct pairs: the words of the nodes in them are joined on both sides and aligned."""
    wanted = pairs.select("node").union(pairs.select("leader")).distinct()
    words = staged(texts.join(checked(wanted), "node", "left_semi").mapInArrow(_words, "node long, words array<int>")
                   .dropDuplicates(["node"]), f"{out_dir}-words")
    # few bytes stand for much work: spread the pairs over all cores
    spread = pairs.repartition(4 * pairs.sparkSession.sparkContext.defaultParallelism)
    joined = spread.join(words.withColumnRenamed("words", "b"), "node").join(
        words.select(F.col("node").alias("leader"), F.col("words").alias("a")), "leader")
    return staged(joined.select("leader", "node", "a", "b").mapInArrow(_align(similarity), "leader long, node long, near boolean"),
                  f"{out_dir}-judged")


def _fits(n: str, m: str, similarity: float) -> Column:
    return F.abs(F.col(n) - F.col(m)) <= (1 - similarity) * F.greatest(n, m) + 1e-9


def _lengths_fit(pairs: DataFrame, lengths: DataFrame, similarity: float) -> DataFrame:
    """(leader, node, longer) of the pairs whose lengths allow a link."""
    both = pairs.join(lengths.select("node", "n"), "node").join(
        lengths.select(F.col("node").alias("leader"), F.col("n").alias("m")), "leader")
    return both.where(_fits("n", "m", similarity)).select("leader", "node", F.greatest("n", "m").alias("longer"))


def links(texts: DataFrame, out_dir: str, similarity: float = SIMILARITY, sketches: int = SKETCHES) -> DataFrame:
    """Verified (u, v) links between nodes, as many as connect every class; ``texts`` has node and text, a node may repeat.
    The jobs run here, with Arrow batches of at most ``BATCH_ROWS`` whole texts."""
    conf = texts.sparkSession.conf
    settings = {"spark.sql.execution.arrow.maxRecordsPerBatch": str(BATCH_ROWS), "spark.sql.execution.arrow.maxBytesPerBatch": str(BATCH_BYTES)}
    before = {k: conf.get(k) for k in settings}
    for k, v in settings.items():
        conf.set(k, v)
    try:
        return _links(texts, out_dir, similarity, sketches)
    finally:
        for k, v in before.items():
            conf.set(k, v)


def _links(texts: DataFrame, out_dir: str, similarity: float, sketches: int) -> DataFrame:
    spark = texts.sparkSession
    nodes = staged(texts.mapInArrow(_sketches(sketches), "node long, n long, keys array<long>, bag binary").dropDuplicates(["node"]),
                   f"{out_dir}/nodes")
    # length classes so wide that near texts are in the same or in neighbouring ones
    wide = nodes.select("node", "n", F.floor(F.log("n") / F.lit(math.log(1.01 / similarity))).alias("class"))
    rows = nodes.select("node", F.explode("keys").alias("key")).join(wide, "node")
    # the first node of each length class of a bucket leads
    first = rows.groupBy("key", "class").agg(F.min("node").alias("leader"), F.count(F.lit(1)).alias("size")).where("size > 1")
    led = rows.join(first, ["key", "class"]).where("node <> leader").select("leader", "node").distinct()
    pairs = _candidates(_lengths_fit(led, wide, similarity), nodes, similarity, f"{out_dir}/led")
    one = _verified(pairs, texts, similarity, f"{out_dir}/led")
    near = one.where("near").select(F.col("leader").alias("u"), F.col("node").alias("v"))
    roots = staged(components(near, f"{out_dir}/first"), f"{out_dir}/roots")
    discard(spark, f"{out_dir}/led", f"{out_dir}/led-words", f"{out_dir}/first")
    # buckets that still hold several classes: every node outside the largest meets every node of another class
    now = staged(rows.join(roots, "node", "left").select("node", "n", "class", "key", F.coalesce("root", "node").alias("root")), f"{out_dir}/rows")
    held = now.groupBy("key", "root").agg(F.count(F.lit(1)).alias("size")).groupBy("key").agg(
        F.max_by("root", F.struct("size", "root")).alias("major"), F.sum("size").alias("total"), F.count(F.lit(1)).alias("several")).where("several > 1")
    rest = staged(now.join(held.select("key", "major", "total"), "key"), f"{out_dir}/rest")
    discard(spark, f"{out_dir}/rows")
    minor = rest.where("root <> major").select(F.col("node").alias("x"), F.col("n").alias("m"), F.col("root").alias("r"), "key", "total",
                                               F.explode(F.expr("sequence(class - 1, class + 1)")).alias("class"))
    other = (F.col("root") != F.col("r")) & ((F.col("root") == F.col("major")) | (F.col("x") < F.col("node"))) & _fits("n", "m", similarity)
    met = rest.where(F.col("total") <= SMALL).join(minor.where(F.col("total") <= SMALL).drop("total"), ["key", "class"]).where(other)
    across = _large_buckets(rest.where(F.col("total") > SMALL), nodes, texts, similarity, f"{out_dir}/large")
    discard(spark, f"{out_dir}/large-words", f"{out_dir}/large-packed")
    sides = [F.least("x", "node").alias("leader"), F.greatest("x", "node").alias("node"), F.greatest("n", "m").alias("longer")]
    pairs = met.select(*sides).distinct()
    left = _candidates(pairs.join(one, ["leader", "node"], "left_anti"), nodes, similarity, f"{out_dir}/met")
    links = roots.select(F.col("root").alias("u"), F.col("node").alias("v")).unionByName(across)
    # a few pairs of each node first; those that classes have joined by then need no alignment
    i = 0
    while not left.isEmpty():
        # about 4 ** (i + 1) pairs of each leader, dealt by a hash, so that no leader's pairs go to one task
        many = checked(left.groupBy("leader").agg(F.count(F.lit(1)).alias("pairs")).where(F.col("pairs") > 4 ** (i + 1)))
        turns = F.ceil(F.coalesce("pairs", F.lit(1)) / 4 ** (i + 1))
        ranked = staged(left.join(many, "leader", "left").select("leader", "node", (F.pmod(F.xxhash64("leader", "node"), turns) == 0).alias("now")),
                        f"{out_dir}/ranked-{i}")
        judged = _verified(ranked.where("now").select("leader", "node"), texts, similarity, f"{out_dir}/round-{i}")
        links = links.unionByName(judged.where("near").select(F.col("leader").alias("u"), F.col("node").alias("v")))
        rest = ranked.where("not now").select("leader", "node")
        if rest.isEmpty():
            break
        roots = staged(components(links, f"{out_dir}/joined-{i}"), f"{out_dir}/roots-{i}")
        links = roots.select(F.col("root").alias("u"), F.col("node").alias("v"))
        left = staged(rest.join(roots.select("node", F.col("root").alias("r")), "node", "left").join(
            roots.select(F.col("node").alias("leader"), F.col("root").alias("s")), "leader", "left").where(
            F.coalesce("r", "node") != F.coalesce("s", "leader")).select("leader", "node"), f"{out_dir}/left-{i}")
        discard(spark, f"{out_dir}/ranked-{i}", f"{out_dir}/round-{i}-words", f"{out_dir}/round-{i}-judged")
        i += 1
    return links


def near_duplicate_classes(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", similarity: float = SIMILARITY,
                           sketches: int = SKETCHES) -> DataFrame:
    """(doc_id, node, n_rows, root, class_id) per distinct (doc_id, text): node is the hash of the text,
    n_rows counts repeated rows, root names the class, class_id is its smallest doc_id."""
    out = work_dir(docs.sparkSession, "near-dedup")
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    src = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.xxhash64(text).alias("node"), text.alias("text"))
    roots = components(links(src.select("node", "text"), out, similarity, sketches), f"{out}/components")
    members = staged(src.groupBy("doc_id", "node").agg(F.count(F.lit(1)).alias("n_rows")), f"{out}/members")
    named = members.groupBy("node").agg(F.min("doc_id").alias("first"))
    rooted = staged(named.join(roots, "node", "left").select("node", "first", F.coalesce("root", "node").alias("root")), f"{out}/rooted")
    classes = rooted.groupBy("root").agg(F.min("first").alias("class_id"))
    labels = rooted.join(classes, "root").select("node", "root", "class_id")
    return members.join(labels, "node")


def drop_near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", similarity: float = SIMILARITY,
                         sketches: int = SKETCHES) -> DataFrame:
    """One document of each class: the one with the smallest id; columns unchanged."""
    classes = staged(near_duplicate_classes(docs, id_col, text_col, similarity, sketches),
                     work_dir(docs.sparkSession, "near-dedup-classes"))
    n, i, kn, ki, many = (free_name(x, docs.columns) for x in ("node", "node_id", "kept_node", "kept_id", "n_rows"))
    # if the smallest id of a class has several texts, the one with the smallest hash stays
    kept = (classes.where(F.col("doc_id").eqNullSafe(F.col("class_id"))).groupBy("root")
            .agg(F.min_by("class_id", "node").alias(ki), F.min("node").alias(kn), F.max("n_rows").alias(many)))
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    keyed = docs.withColumns({n: F.xxhash64(text), i: F.col(id_col).cast("long")})
    rows = keyed.join(kept, (F.col(n) == F.col(kn)) & F.col(i).eqNullSafe(F.col(ki)), "left_semi")
    if not kept.where(F.col(many) > 1).isEmpty():
        rows = rows.dropDuplicates([n, i])
    return rows.select(*docs.columns)


def op3_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The near-duplicate class of every document."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return near_duplicate_classes(docs).select("doc_id", "class_id")
