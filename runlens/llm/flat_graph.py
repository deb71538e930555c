"""Operator 13 — near-duplicate embeddings through a robust-pruned flat graph.

Vectors of one label (and length) are linked if their cosine, in double precision, is
at least ``similarity``; classes are the connected components of the links.

1. Equal vectors are one node with a multiplicity. A sample of at most ``SAMPLE``
   nodes is fitted on the driver: centres of about one cluster for ``SHARD`` rows
   (spherical k-means), and *balls*, directions around which at least ``HOT`` sample rows lie
   within half the link angle. (Both only steer the work, results do not depend on them but by recall.)
2. Balls: members lie within half the link angle of the ball's direction, so all of them are linked by the
   triangle inequality and counted at once, without a pair. A node outside that is
   within one and a half link angles may link with some: those are multiplied out, block by block.
3. All other nodes go to the shards of their ``overlap`` nearest centres; shards beyond ``LARGE`` rows
   are divided again around centres of their own, up to ``LEVELS`` times. In a
   shard each node keeps, from its nearest rows, some random ones and the medoid, the neighbours that survive
   robust pruning (a candidate goes if a kept one is nearer to it by the factor ``ALPHA``).
4. The adjacency lists of a node from its shards are united. Every node of a
   shard is searched in it: greedy search with a beam from the medoid, then all rows in range are
   expanded until none is new. Found pairs are verified in double precision; both directions count.
5. Audit: a sample of at most ``AUDIT`` nodes is compared with brute force over all rows. If
   fewer than ``RECALL`` of their links are found, search and overlap are widened and the steps run again.

Defined results: a vector that is null, zero or has null or non-finite components, or no label, links
with nothing (n_links 0, its own component); vectors of different lengths do not link; components of any size count (vectors are scaled before
they are multiplied); repeated rows and equal vectors are linked rows of their own; a row without id has the component
id of its class, null if no row of it has one; kept compares nulls as equal; an empty table has no rows; other columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from runlens.llm.common import checked, staged, table, work_dir
from runlens.llm.near_dedup import components

SIMILARITY = 0.93
SAMPLE = 16_384  # nodes on which centres and balls are fitted
HOT = 64  # sample rows that make a ball
SHARD = 1024  # rows of a cluster that is aimed at
LARGE = 8192  # rows beyond which a shard is divided
LEVELS = 3
CENTRES = 1024  # centres of a division at most
OVERLAP = 3
BEAM = 24
DEGREE = 20
NEAREST, RANDOM = 40, 8  # candidates of a node's neighbours
ALPHA = 1.2
AUDIT = 1024
RECALL = 0.95
BLOCK = 512
TINY = 1e-9  # radians by which angle bounds are widened


def _matrix(column: pa.Array) -> np.ndarray:
    """Rows of one length as a matrix of doubles, each divided by its largest component."""
    x = np.asarray(column.flatten(), np.float64).reshape(len(column), -1)
    return x / np.abs(x).max(1, keepdims=True)


def unit(x: np.ndarray) -> np.ndarray:
    return x / np.sqrt((x * x).sum(1, keepdims=True))


def _angle(cos: np.ndarray) -> np.ndarray:
    return np.arccos(np.clip(cos, -1, 1))


def fit_centres(x: np.ndarray, k: int, rounds: int = 5) -> np.ndarray:
    """Spherical k-means from the first k rows."""
    c = x[:k].copy()
    for _ in range(rounds):
        near = (x @ c.T).argmax(1)
        s = np.zeros_like(c)
        np.add.at(s, near, x)
        size = np.sqrt((s * s).sum(1, keepdims=True))
        c = np.where(size > 1e-12, s / np.maximum(size, 1e-12), c)
    return c


def fit_balls(x: np.ndarray, half: float, least: int = HOT) -> np.ndarray:
    """Directions with at least ``least`` rows of x within the angle ``half``, each row used once."""
    left, out = np.arange(len(x)), []
    while len(left) >= least:
        some = x[left]
        members = some @ some[:BLOCK].T >= math.cos(2 * half)
        best = int(members.sum(0).argmax())
        if members[:, best].sum() < least:
            left = left[BLOCK:]  # none of these leads a large group
            continue
        p = unit(some[members[:, best]].sum(0, keepdims=True))[0]
        inside = some @ p >= math.cos(half)
        if inside.sum() >= least:
            out.append(p)
        left = left[~(inside | members[:, best])]
    return np.asarray(out).reshape(len(out), x.shape[1])


def robust_prune(x: np.ndarray, candidates: np.ndarray, degree: int = DEGREE, alpha: float = ALPHA) -> np.ndarray:
    """(row, neighbour): up to ``degree`` of each row's candidates, nearest first, -1 where there are fewer."""
    n, c = candidates.shape
    out = np.full((n, degree), -1)
    for s in range(0, n, 256):
        cand = candidates[s:s + 256]
        own = np.arange(s, s + len(cand))
        v = x[cand]
        near = np.einsum("rcd,rd->rc", v, x[own])
        near[cand == own[:, None]] = -9
        order = np.argsort(-near, 1)
        cand, near = np.take_along_axis(cand, order, 1), np.take_along_axis(near, order, 1)
        v = x[cand]
        dist = np.sqrt(np.maximum(2 - 2 * near, 0))
        alive = near > -8
        alive[:, 1:] &= cand[:, 1:] != cand[:, :-1]
        kept = np.zeros(len(cand), np.int64)
        for j in range(c):
            take = np.flatnonzero(alive[:, j] & (kept < degree))
            if not len(take):
                continue
            out[s + take, kept[take]] = cand[take, j]
            kept[take] += 1
            between = np.sqrt(np.maximum(2 - 2 * np.einsum("rcd,rd->rc", v[take], v[take, j]), 0))
            alive[take] &= alpha * between > dist[take]
    return out


def build_graph(x: np.ndarray) -> np.ndarray:
    """Adjacency of one shard: pruned from the nearest rows, random rows and the medoid."""
    n = len(x)
    k = min(n, NEAREST + 1)
    near = np.concatenate([np.argpartition(-(x[s:s + BLOCK] @ x.T), k - 1, 1)[:, :k] for s in range(0, n, BLOCK)])
    far = np.random.default_rng(13).integers(0, n, (n, RANDOM))
    return robust_prune(x, np.concatenate([near, far, np.full((n, 1), medoid(x))], 1))


def medoid(x: np.ndarray) -> int:
    return int((x @ x.mean(0)).argmax())


def beam_search(x: np.ndarray, graph: np.ndarray, start: int, queries: np.ndarray, beam: int) -> tuple[np.ndarray, np.ndarray]:
    """(query, place) of the best rows that greedy search finds, and their cosines; -1 for none."""
    q = x[queries]
    ids, sims = np.full((len(q), beam), -1), np.full((len(q), beam), -9, x.dtype)
    ids[:, 0], sims[:, 0] = start, q @ x[start]
    done = np.zeros((len(q), beam), bool)
    rows = np.arange(len(q))
    while len(rows):
        open_ = np.where(done[rows] | (ids[rows] < 0), -9, sims[rows])
        at = open_.argmax(1)
        more = open_[np.arange(len(rows)), at] > -9
        rows, at = rows[more], at[more]
        if not len(rows):
            break
        done[rows, at] = True
        nb = graph[ids[rows, at]]
        s = np.einsum("rcd,rd->rc", x[nb], q[rows])
        s[(nb < 0) | (nb[:, :, None] == ids[rows][:, None, :]).any(2)] = -9
        all_ids, all_sims = np.concatenate([ids[rows], nb], 1), np.concatenate([sims[rows], s], 1)
        all_done = np.concatenate([done[rows], np.zeros(nb.shape, bool)], 1)
        best = np.argpartition(-all_sims, beam - 1, 1)[:, :beam]
        ids[rows], sims[rows], done[rows] = (np.take_along_axis(t, best, 1) for t in (all_ids, all_sims, all_done))
        ids[sims == -9] = -1
    return ids, sims


def range_search(x: np.ndarray, graph: np.ndarray, low: float, beam: int = BEAM) -> np.ndarray:
    """Codes query * n + row of the pairs with a cosine of at least ``low`` that are found from the medoid:
    a beam search, then every row in range is expanded until none is new."""
    n, start, out = len(x), medoid(x), []
    for s in range(0, n, BLOCK):
        queries = np.arange(s, min(n, s + BLOCK))
        ids, sims = beam_search(x, graph, start, queries, beam)
        hit, place = np.nonzero((sims >= low) & (ids >= 0))
        # a query is a row of the graph: its own neighbours are in reach as well
        new = np.union1d(queries[hit] * n + ids[hit, place], queries * n + queries)
        seen = new
        while len(new):
            a, b = new // n, new % n
            nb = graph[b]
            a, b = np.repeat(a, nb.shape[1])[nb.ravel() >= 0], nb.ravel()[nb.ravel() >= 0]
            codes = np.unique(a * n + b)
            codes = np.setdiff1d(codes, seen, assume_unique=True)
            new = np.concatenate([c[np.einsum("ij,ij->i", x[c // n], x[c % n]) >= low] for c in np.array_split(codes, len(codes) // 65536 + 1)])
            seen = np.union1d(seen, new)
        out.append(seen)
    return np.concatenate(out) if out else np.empty(0, np.int64)


def _shards(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    """(shard, columns) of rows sorted by shard, the first column; a shard may span batches."""
    now, parts = None, []
    for b in batches:
        if not b.num_rows:
            continue
        names = np.asarray(b.column(0).to_pylist(), object)
        cuts = np.flatnonzero(names[1:] != names[:-1]) + 1
        for i, j in zip([0, *cuts.tolist()], [*cuts.tolist(), len(names)]):
            if parts and names[i] != now:
                yield now, pa.Table.from_batches(parts).combine_chunks()
                parts = []
            now = names[i]
            parts.append(b.slice(i, j - i))
    if parts:
        yield now, pa.Table.from_batches(parts).combine_chunks()


def _column(t: pa.Table, i: int) -> pa.Array:
    return t.column(i).combine_chunks() if t.column(i).num_chunks != 1 else t.column(i).chunk(0)


def _build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for _, t in _shards(batches):
        nodes = np.asarray(_column(t, 1))
        graph = build_graph(unit(_matrix(_column(t, 2))).astype(np.float32))
        have = graph >= 0
        offsets = np.concatenate([[0], np.cumsum(have.sum(1))]).astype(np.int32)
        yield pa.RecordBatch.from_arrays([pa.array(nodes), pa.ListArray.from_arrays(pa.array(offsets), pa.array(nodes[graph[have]]))],
                                         names=["node", "near"])


def _search(similarity: float, beam: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, t in _shards(batches):
            nodes, x = np.asarray(_column(t, 1)), _matrix(_column(t, 2))
            order = np.argsort(nodes)
            near = _column(t, 3)
            to = np.asarray(near.flatten())
            at = np.minimum(np.searchsorted(nodes[order], to), len(nodes) - 1)
            here = nodes[order][at] == to  # neighbours from other shards may not be in this one
            a, b = np.repeat(np.arange(len(nodes)), np.asarray(near.value_lengths()))[here], order[at[here]]
            a, b = np.concatenate([a, b]), np.concatenate([b, a])  # links work both ways
            code = np.unique(a * len(nodes) + b)
            a, b = code // len(nodes), code % len(nodes)
            degree = np.bincount(a, minlength=len(nodes))
            graph = np.full((len(nodes), max(1, int(degree.max(initial=0)))), -1)
            graph[a, np.arange(len(a)) - np.repeat(np.cumsum(degree) - degree, degree)] = b
            u = unit(x)
            pairs = range_search(u.astype(np.float32), graph, similarity - 1e-4, beam)
            a, b = pairs // len(nodes), pairs % len(nodes)
            a, b = a[a != b], b[a != b]
            fine = np.concatenate([_cosines(x, i, j) >= similarity for i, j in zip(np.array_split(a, len(a) // 65536 + 1), np.array_split(b, len(a) // 65536 + 1))])
            i, j = nodes[a[fine]], nodes[b[fine]]
            low, high = np.minimum(i, j), np.maximum(i, j)
            both = np.unique(np.stack([low, high], 1), axis=0)
            for s in range(0, len(both), 1 << 16):
                yield pa.RecordBatch.from_arrays([pa.array(both[s:s + (1 << 16), 0]), pa.array(both[s:s + (1 << 16), 1])], names=["a", "b"])

    return run


def _cosines(x: np.ndarray, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Cosines of pairs of rows in double precision."""
    p, q = x[i], x[j]
    return (p * q).sum(1) / (np.sqrt((p * p).sum(1)) * np.sqrt((q * q).sum(1)))


def _assign(fitted, overlap: int, half: float):
    """Nodes (grp, node, v) -> (node, ball, shards, close): the ball it is in, or its shards and the balls it may link with."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        centres, balls = fitted.value
        for b in batches:
            names = np.asarray(b.column(0).to_pylist(), object)
            ball, shards, close = np.full(b.num_rows, -1, np.int64), [None] * b.num_rows, [[]] * b.num_rows
            for g in dict.fromkeys(names.tolist()):
                at = np.flatnonzero(names == g)
                x = unit(_matrix(b.column(2).take(pa.array(at))))
                free = np.ones(len(at), bool)
                if g in balls:
                    first, p = balls[g]
                    angle = _angle(x @ p.T)
                    best = angle.argmin(1)
                    free = angle[np.arange(len(at)), best] > half - TINY
                    ball[at[~free]] = first + best[~free]
                    near = angle <= 3 * half + TINY  # a member may be half away from its ball
                    near[np.flatnonzero(~free), best[~free]] = False
                    for i in np.flatnonzero(near.any(1)).tolist():
                        close[at[i]] = (first + np.flatnonzero(near[i])).tolist()
                if g in centres:
                    c = centres[g]
                    k = min(overlap, len(c))
                    top = np.argpartition(-(x @ c.T), k - 1, 1)[:, :k]
                else:
                    top = np.zeros((len(at), 1), np.int64)
                for i in np.flatnonzero(free).tolist():
                    shards[at[i]] = [f"{g}/{c}" for c in top[i].tolist()]
            yield pa.RecordBatch.from_arrays([b.column(1), pa.array(ball), pa.array(shards, pa.list_(pa.string())), pa.array(close, pa.list_(pa.int64()))],
                                             names=["node", "ball", "shards", "close"])

    return run


def _divide(overlap: int):
    """Rows (group, kind, node, v), each group's centres (kind 0) first -> (shard, node): the nearest centres' shards."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, centres, names = None, [], []
        for b in batches:
            groups_, kinds, nodes = b.column(0).to_pylist(), b.column(1).to_pylist(), b.column(2).to_pylist()
            if not nodes:
                continue
            x = unit(_matrix(b.column(3))) if len(set(np.asarray(b.column(3).value_lengths()).tolist())) == 1 else None
            shards, out = [], []
            for i, (g, kind, node) in enumerate(zip(groups_, kinds, nodes)):
                v = x[i] if x is not None else unit(_matrix(b.column(3).slice(i, 1)))[0]
                if g != now:
                    now, centres, names = g, [], []
                if kind == 0:
                    centres.append(v)
                    names.append(node)
                    continue
                sims = np.asarray(centres) @ v
                for c in np.argsort(-sims)[:overlap].tolist():
                    shards.append(f"{g.rsplit('#', 1)[0]}/{names[c]}")
                    out.append(node)
            yield pa.RecordBatch.from_arrays([pa.array(shards, pa.string()), pa.array(out, pa.int64())], names=["shard", "node"])

    return run


def _multiply(similarity: float):
    """Pairs of blocks (ball, nodes, vectors, multiplicities; other nodes, ...) -> links counted on both sides."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out = []
            for row in b.to_pylist():
                p, q = (np.asarray(row[c], np.float64) for c in ("v", "w"))
                p, q = (t / np.abs(t).max(1, keepdims=True) for t in (p, q))
                cos = (p @ q.T) / (np.sqrt((p * p).sum(1))[:, None] * np.sqrt((q * q).sum(1))[None, :])
                hit = cos >= similarity
                m, k = np.asarray(row["m"]), np.asarray(row["k"])
                out += [(node, int(n), None) for node, n in zip(row["nodes"], hit @ k) if n]
                out += [(node, int(n), row["ball"]) for node, n in zip(row["others"], m @ hit) if n]
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in (zip(*out) if out else ([], [], []))], names=["node", "n", "ball"])

    return run


def _brute(queries, similarity: float):
    """Links of the audited nodes with all rows of a task."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = {g: np.zeros(len(nodes), np.int64) for g, (nodes, _) in queries.value.items()}
        for b in batches:
            names = np.asarray(b.column(0).to_pylist(), object)
            for g in set(names.tolist()) & set(found):
                at = np.flatnonzero(names == g)
                nodes, q = queries.value[g]
                x, m = _matrix(b.column(2).take(pa.array(at))), np.asarray(b.column(3))[at]
                cos = (q @ x.T) / (np.sqrt((q * q).sum(1))[:, None] * np.sqrt((x * x).sum(1))[None, :])
                found[g] += ((cos >= similarity) & (nodes[:, None] != np.asarray(b.column(1))[at][None, :])) @ m
        for g, n in found.items():
            yield pa.RecordBatch.from_arrays([pa.array(queries.value[g][0]), pa.array(n)], names=["node", "n"])

    return run


def _fit(nodes: DataFrame, half: float) -> tuple[dict, dict]:
    """Centres and balls (with the number of the first) of every group that the sample meets."""
    rows = nodes.orderBy(F.xxhash64("node"), "node").limit(SAMPLE).select("grp", "v").collect()
    by_group: dict[str, list] = {}
    for g, v in rows:
        by_group.setdefault(g, []).append(v)
    sizes = dict(nodes.groupBy("grp").count().where(F.col("grp").isin(list(by_group))).collect()) if len(by_group) <= 1000 else {}
    centres, balls, number = {}, {}, 0
    for g, vectors in by_group.items():
        x = _matrix(pa.array(vectors, pa.list_(pa.float64())))
        x = unit(x)
        k = min(-(-sizes.get(g, 0) // SHARD), len(x) // 8)
        if k > 1:
            centres[g] = fit_centres(x, k)
        p = fit_balls(x, half)
        if len(p):
            balls[g] = (number, p)
            number += len(p)
    return centres, balls


def _divided(shards: DataFrame, nodes: DataFrame, overlap: int, out: str) -> DataFrame:
    """(shard, node) with shards beyond ``LARGE`` rows divided around centres from their own rows."""
    for level in range(LEVELS):
        large = staged(shards.groupBy("shard").agg(F.count(F.lit(1)).alias("size")).where(F.col("size") > LARGE), f"{out}/large-{level}")
        if large.isEmpty():
            break
        of = checked(large)
        rows = shards.join(of, "shard").join(nodes.select("node", "v"), "node")
        mod = F.greatest(F.lit(SHARD), F.ceil(F.col("size") / CENTRES)).cast("long")
        salts = F.ceil(F.col("size") / LARGE).cast("int")
        name = lambda s: F.concat("shard", F.lit("#"), s.cast("string"))
        leads = rows.where(F.pmod(F.xxhash64("node", F.lit(level)), mod) == 0).select(
            F.explode(F.sequence(F.lit(0), salts - 1)).alias("salt"), "shard", "node", "v").select(name(F.col("salt")).alias("grp"), F.lit(0).alias("kind"), "node", "v")
        own = rows.select(name(F.pmod(F.xxhash64("node"), salts)).alias("grp"), F.lit(1).alias("kind"), "node", "v")
        parts = leads.unionByName(own).repartition("grp").sortWithinPartitions("grp", "kind", "node").mapInArrow(
            _divide(overlap), "shard string, node long")
        shards = staged(shards.join(of, "shard", "left_anti").select("shard", "node").unionByName(parts), f"{out}/divided-{level}")
    return shards


def _attempt(nodes: DataFrame, similarity: float, overlap: int, beam: int, out: str) -> tuple[DataFrame, DataFrame]:
    """(node, ball, n_links) and the edges (u, v) between nodes or balls, a ball standing as its number below zero."""
    spark = nodes.sparkSession
    half = math.acos(similarity) / 2
    fitted = spark.sparkContext.broadcast(_fit(nodes, half))
    placed = staged(nodes.select("grp", "node", "v").mapInArrow(_assign(fitted, overlap, half),
                                                                "node long, ball long, shards array<string>, close array<long>"), f"{out}/placed")
    # graph over all nodes outside balls
    shards = staged(placed.where("ball < 0").select(F.explode("shards").alias("shard"), "node"), f"{out}/shards")
    shards = _divided(shards, nodes, overlap, out)
    held = staged(shards.join(nodes.select("node", "v"), "node").select("shard", "node", "v"), f"{out}/held")
    lists = held.repartition("shard").sortWithinPartitions("shard", "node").mapInArrow(_build, "node long, near array<long>")
    union = staged(lists.groupBy("node").agg(F.array_distinct(F.flatten(F.collect_list("near"))).alias("near")), f"{out}/graph")
    found = held.join(union, "node").select("shard", "node", "v", "near").repartition("shard").sortWithinPartitions("shard", "node").mapInArrow(
        _search(similarity, beam), "a long, b long")
    links = staged(found.distinct(), f"{out}/links")
    # members of balls with each other: all; with others that are near enough: multiplied out in blocks
    m = nodes.select("node", "v", "m")
    members = placed.where("ball >= 0").select("node", "ball").join(m, "node")
    totals = checked(members.groupBy("ball").agg(F.sum("m").alias("rows")))
    near = placed.where(F.size("close") > 0).select("node", F.col("ball").alias("own"), F.explode("close").alias("ball")).where("own < ball").join(m, "node")
    block = F.pmod(F.xxhash64("node"), F.greatest(F.lit(1), F.ceil(F.col("rows") / BLOCK)).cast("long"))
    packed = members.join(totals, "ball").groupBy("ball", block.alias("block")).agg(F.collect_list(F.struct("node", "v", "m")).alias("s")).select(
        "ball", F.col("s.node").alias("nodes"), F.col("s.v").alias("v"), F.col("s.m").alias("m"))
    counts = near.groupBy("ball").agg(F.count(F.lit(1)).alias("rows"))
    others = near.join(checked(counts), "ball").groupBy("ball", block.alias("block"), "own").agg(F.collect_list(F.struct("node", "v", "m")).alias("s")).select(
        "ball", "own", F.col("s.node").alias("others"), F.col("s.v").alias("w"), F.col("s.m").alias("k"))
    crossed = staged(packed.join(others, "ball").mapInArrow(_multiply(similarity), "node long, n long, ball long"), f"{out}/crossed")
    each = links.select(F.col("a").alias("node"), F.col("b").alias("other")).unionByName(links.select(F.col("b").alias("node"), F.col("a").alias("other")))
    by_link = each.join(nodes.select(F.col("node").alias("other"), "m"), "other").select("node", F.col("m").alias("n"))
    extra = by_link.unionByName(crossed.select("node", "n")).groupBy("node").agg(F.sum("n").alias("extra"))
    counted = placed.select("node", "ball").join(totals, "ball", "left").join(nodes.select("node", "m"), "node").join(extra, "node", "left").select(
        "node", "ball", (F.coalesce("rows", "m") - 1 + F.coalesce("extra", F.lit(0))).alias("n_links"))
    own = placed.select("node", F.when(F.col("ball") >= 0, -1 - F.col("ball")).otherwise(F.col("node")).alias("u"))
    edges = links.select(F.col("a").alias("u"), F.col("b").alias("v")).unionByName(
        crossed.where("ball is not null").join(own, "node").select("u", (-1 - F.col("ball")).alias("v")).distinct())
    return staged(counted, f"{out}/counted"), edges


def audit(nodes: DataFrame, counted: DataFrame, similarity: float) -> float:
    """The share of the links of a sample of nodes that were found."""
    sample = nodes.orderBy(F.xxhash64(F.lit("audit"), "node"), "node").limit(AUDIT).select("grp", "node", "v").collect()
    by_group: dict[str, tuple[list, list]] = {}
    for g, node, v in sample:
        by_group.setdefault(g, ([], []))[0].append(node)
        by_group[g][1].append(v)
    held = {g: (np.asarray(ids), _matrix(pa.array(vs, pa.list_(pa.float64())))) for g, (ids, vs) in by_group.items()}
    queries = nodes.sparkSession.sparkContext.broadcast(held)
    true = nodes.select("grp", "node", "v", "m").mapInArrow(_brute(queries, similarity), "node long, n long").groupBy("node").agg(F.sum("n").alias("n"))
    # equal rows are linked anyway and prove nothing
    both = true.join(counted, "node").join(nodes.select("node", "m"), "node").agg(F.sum("n"), F.sum(F.col("n_links") - F.col("m") + 1)).first()
    return 1.0 if not both[0] else both[1] / both[0]


def near_duplicates(vectors: DataFrame, similarity: float = SIMILARITY, id_col: str = "vec_id", vector_col: str = "embedding",
                    label_col: str = "label", overlap: int = OVERLAP, beam: int = BEAM) -> DataFrame:
    """(vec_id, n_links, component_id, kept) of every row; see the module's text."""
    spark = vectors.sparkSession
    out = work_dir(spark, "flat-graph")
    v = F.col("v")
    src = vectors.select(F.col(id_col).cast("long").alias("vec_id"), F.col(label_col).cast("string").alias("label"), F.col(vector_col).cast("array<double>").alias("v"))
    finite = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    usable = F.col("label").isNotNull() & v.isNotNull() & finite & F.exists(v, lambda x: x != 0)
    rows = src.select("vec_id", F.when(F.coalesce(usable, F.lit(False)), F.concat_ws("|", F.size("v"), "label")).alias("grp"), "v").select(
        "vec_id", "grp", F.when(F.col("grp").isNotNull(), v).alias("v"))
    key = [F.xxhash64(F.lit(s), "grp", "v").alias(f"h{s}") for s in (1, 2)]
    # equal vectors are one node
    nodes = staged(rows.where("grp is not null").select("vec_id", "grp", "v", *key).groupBy("h1", "h2").agg(
        F.first("grp").alias("grp"), F.first("v").alias("v"), F.count(F.lit(1)).alias("m"), F.min("vec_id").alias("first")).withColumn(
        "node", F.monotonically_increasing_id()), f"{out}/nodes")
    for i in range(3):  # wider if the audit finds too little
        counted, edges = _attempt(nodes, similarity, overlap + 2 * i, beam << i, f"{out}/{i}")
        if audit(nodes, counted, similarity) >= RECALL:
            break
    roots = staged(components(edges, f"{out}/components"), f"{out}/roots")
    named = counted.withColumn("u", F.when(F.col("ball") >= 0, -1 - F.col("ball")).otherwise(F.col("node")))
    inside = checked(named.where("ball >= 0").select("u").distinct().join(roots.withColumnRenamed("node", "u"), "u"))
    rooted = staged(named.where("ball < 0").join(roots.withColumnRenamed("node", "u"), "u", "left").unionByName(
        named.where("ball >= 0").join(inside, "u", "left")).select("node", "n_links", F.coalesce("root", "u").alias("root")).join(
        nodes.select("node", "h1", "h2", "m", "first"), "node"), f"{out}/rooted")
    least = rooted.groupBy("root").agg(F.min("first").alias("component_id"), F.count(F.lit(1)).alias("size"))
    crowd = checked(least.where("size > 1000"))  # roots with many nodes
    alone = rooted.join(least.where("size <= 1000"), "root").unionByName(rooted.join(crowd, "root")).select("h1", "h2", "m", "n_links", "component_id")
    # rows take the results of their vectors; those of very frequent vectors are broadcast
    keyed = rows.select("vec_id", "grp", *key)
    frequent = checked(alone.where("m > 10000").drop("m"))
    rest = keyed.where("grp is not null").join(frequent, ["h1", "h2"], "left_anti").join(alone.where("m <= 10000").drop("m"), ["h1", "h2"])
    linked = rest.unionByName(keyed.where("grp is not null").join(frequent, ["h1", "h2"])).select("vec_id", "n_links", "component_id")
    single = keyed.where("grp is null").select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
    return linked.unionByName(single).withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id")))


def op13_flat_graph(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Links and classes of all embeddings, within labels."""
    return near_duplicates(table(spark, sf_dir, "embeddings").select("vec_id", "embedding", "label"))


def oracle() -> str:
    """All pairs of a label, and reachability along the links."""
    return f"""WITH RECURSIVE e AS (SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS v,
        label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
          AND len(list_filter(embedding, lambda x: x <> 0)) > 0 AS ok FROM embeddings),
      l AS (SELECT a.vec_id AS a, b.vec_id AS b FROM e a JOIN e b ON a.label = b.label AND a.vec_id <> b.vec_id AND len(a.v) = len(b.v)
        WHERE a.ok AND b.ok AND list_dot_product(a.v, b.v) / (sqrt(list_dot_product(a.v, a.v)) * sqrt(list_dot_product(b.v, b.v))) >= {SIMILARITY}),
      r AS (SELECT vec_id AS a, vec_id AS b FROM e UNION SELECT r.a, l.b FROM r JOIN l ON l.a = r.b),
      c AS (SELECT a, min(b) AS component_id FROM r GROUP BY a),
      n AS (SELECT a, count(*) AS n FROM l GROUP BY a)
    SELECT e.vec_id, CAST(coalesce(n.n, 0) AS BIGINT) AS n_links, c.component_id, e.vec_id = c.component_id AS kept
    FROM e JOIN c ON c.a = e.vec_id LEFT JOIN n ON n.a = e.vec_id"""
