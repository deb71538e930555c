"""Operator 4 — exact top-k inner products by no-random-access aggregation.

Components become integers, floor(64 x). A task cuts its candidates into
blocks; in a block each dimension is a list sorted by component. For a query the
best end of each list is read first: the large end where the query's component
is positive, the small end where it is negative. After reading all lists to the
same depth, a row's upper bound takes its component where it has been read and
the list's frontier where not; its lower bound takes the list's other end there.
Rows whose upper bound is below the k-th best lower bound (or below the k-th
best score of earlier blocks) cannot qualify; reading goes on, deeper, only for
queries with many rows left, and the final scores of the rows left are resolved.
Bounds for a batch of queries and a block are matrix products over the parts
that have been read; sums are exact in the chosen float width or in integers.

Queries are dealt in blocks of bounded size, each broadcast once and held
against all candidates; a task sends each query's best k rows only.

Defined results: vectors null or with null or non-finite components take no
part, as query or candidate; candidates have the query's length; a query's own
row is every row with its vec_id; a query row that repeats is one query; equal
scores go to the smaller vec_id, null ids last.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from runlens.llm.common import table

K = 20
SCALE = 64
QUERY_BLOCK = 16_384  # queries broadcast at once
BATCH = 512  # queries whose bounds are held at once
BLOCK = 4096  # candidate rows a block
DEPTHS = (0.2, 0.45, 1.0)  # parts of the lists read before bounds are looked at again
FEW = 0.05  # part of a block's rows that is resolved at once


def _exact(q: np.ndarray, x: np.ndarray) -> type:
    """A number type in which every partial sum of products is exact."""
    most = q.shape[1] * max(1.0, float(np.abs(q).max(initial=0))) * max(1.0, float(np.abs(x).max(initial=0)))
    return np.float32 if most < 1 << 24 else np.float64 if most < 1 << 53 else object


_INT = np.vectorize(int, otypes=[object])


class Top:
    """The best k (score, vec_id) of each query so far."""

    def __init__(self, n: int, k: int):
        self.k, self.best = k, [[] for _ in range(n)]
        self.floor = np.full(n, -np.inf)

    def add(self, query: int, scores: list, ids: list) -> None:
        rows = self.best[query] + list(zip(scores, ids))
        rows.sort(key=lambda r: (-r[0], r[1] is None, r[1] or 0))
        self.best[query] = rows[: self.k]
        if len(rows) >= self.k:
            self.floor[query] = rows[self.k - 1][0]


def search_block(q: np.ndarray, q_ids: np.ndarray, rows: np.ndarray, ids: list, top: Top, first: int) -> None:
    """Hold queries q (numbers ``first`` on) against one block of candidate rows."""
    kind = _exact(q, rows)
    n, k = len(rows), top.k
    q, x = (q.astype(kind), rows.astype(kind)) if kind is not object else (_INT(q), _INT(rows))
    lists = np.sort(x, axis=0) if kind is not object else np.asarray([sorted(c) for c in x.T], object).T
    up, down = np.maximum(q, 0), np.minimum(q, 0)
    low, high = lists[0], lists[-1]
    open_ = np.arange(len(q))
    own = np.asarray([-1 if i is None else i for i in ids])
    for part in DEPTHS:
        depth = max(1, int(n * part))
        top_end, low_end = lists[n - depth], lists[depth - 1]  # frontiers of the two reading directions
        a, b = up[open_], down[open_]
        upper = a @ np.maximum(x, top_end).T + b @ np.minimum(x, low_end).T
        floor = top.floor[first + open_]
        if part < 1 and n > k:
            lower = a @ np.where(x >= top_end, x, low).T + b @ np.where(x <= low_end, x, high).T
            lower[own[None, :] == q_ids[open_][:, None]] = -np.inf if kind is not object else -(1 << 62)
            floor = np.maximum(floor, np.partition(lower, n - k, axis=1)[:, n - k].astype(float))
        left = upper.astype(float) >= floor[:, None]
        left &= own[None, :] != q_ids[open_][:, None]
        many = left.sum(axis=1) > max(k, FEW * n)
        for i in np.flatnonzero(~many if part < 1 else np.ones(len(open_), bool)).tolist():
            at = np.flatnonzero(left[i])
            scores = upper[i][at] if part >= 1 else x[at] @ q[open_[i]]  # read to the end, the bound is the score
            if len(at) > k and kind is not object:
                cut = np.partition(scores, len(at) - k)[len(at) - k]
                at, scores = at[scores >= cut], scores[scores >= cut]
            top.add(first + int(open_[i]), [int(s) for s in scores], [ids[j] for j in at.tolist()])
        open_ = open_[many] if part < 1 else open_[:0]
        if not len(open_):
            return


def _vectors(column: pa.Array) -> tuple[list[int], list[np.ndarray]]:
    """Rows that take part, and their integer vectors (as floats)."""
    offsets, values = np.asarray(column.offsets), column.values
    bad = np.asarray(values.is_null()) if values.null_count else None
    v = np.asarray(values.fill_null(0) if values.null_count else values, dtype=np.float64)
    at, out = [], []
    valid = np.asarray(column.is_valid())
    for i, (a, b) in enumerate(zip(offsets[:-1].tolist(), offsets[1:].tolist())):
        if valid[i] and np.isfinite(v[a:b]).all() and (bad is None or not bad[a:b].any()):
            at.append(i)
            out.append(np.floor(SCALE * v[a:b]))
    return at, out


def _search(queries, k: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        by_length = queries.value  # length -> (query numbers, ids, vectors)
        tops = {d: Top(len(ids), k) for d, (_, ids, _) in by_length.items()}
        held: dict[int, tuple[list, list]] = defaultdict(lambda: ([], []))

        def flush(d: int) -> None:
            ids, rows = held.pop(d)
            _, q_ids, q = by_length[d]
            block = np.asarray(rows)
            for a in range(0, len(q), BATCH):
                search_block(q[a:a + BATCH], q_ids[a:a + BATCH], block, ids, tops[d], a)

        for batch in batches:
            names = batch.column(0).to_pylist()
            for i, v in zip(*_vectors(batch.column(1))):
                if len(v) in by_length:
                    ids, rows = held[len(v)]
                    ids.append(names[i])
                    rows.append(v)
                    if len(rows) >= BLOCK:
                        flush(len(v))
        for d in list(held):
            flush(d)
        for d, top in tops.items():
            numbers, q_ids, _ = by_length[d]
            rows = [(int(numbers[i]), int(q_ids[i]), vec, score) for i, best in enumerate(top.best) for score, vec in best]
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*rows)],
                                                 names=["query", "query_id", "vec_id", "score"])

    return run


def top_k(vectors: DataFrame, queries: DataFrame, k: int = K, id_col: str = "vec_id", vector_col: str = "embedding",
          query_block: int = QUERY_BLOCK) -> DataFrame:
    """(query_id, rank, vec_id, score): each query's k best rows of ``vectors``."""
    spark = vectors.sparkSession
    values = F.col(vector_col).cast("array<double>")
    src = vectors.select(F.col(id_col).cast("long").alias("vec_id"), values.alias("v"))
    asked = queries.select(F.col(id_col).cast("long").alias("vec_id"), values.alias("v")).where("v is not null").distinct()
    blocks = asked.count() // query_block + 1
    found = []
    for b in range(blocks):
        part = asked.where(F.pmod(F.xxhash64("vec_id"), F.lit(blocks)) == b).toArrow().combine_chunks()
        by_length: dict[int, list] = defaultdict(list)
        names, number = part.column("vec_id").to_pylist(), 0
        for chunk in part.column("v").chunks:  # one at most
            for i, v in zip(*_vectors(chunk)):
                by_length[len(v)].append((number * blocks + b, names[i], v))
                number += 1
        index = {d: (np.asarray([r[0] for r in rows]), np.asarray([r[1] for r in rows]), np.asarray([r[2] for r in rows]))
                 for d, rows in by_length.items()}
        found.append(src.mapInArrow(_search(spark.sparkContext.broadcast(index), k),
                                    "query long, query_id long, vec_id long, score long"))
    best = Window.partitionBy("query").orderBy(F.col("score").desc(), F.col("vec_id").asc_nulls_last())
    ranked = reduce(DataFrame.unionAll, found).withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")


def op4_topk_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 20 best rows of every embedding whose id is divisible by 20."""
    vectors = table(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    return top_k(vectors, vectors.where(F.col("vec_id") % 20 == 0))


def oracle() -> str:
    return f"""WITH e AS (SELECT vec_id, list_transform(embedding, lambda x: CAST(floor({SCALE} * CAST(x AS DOUBLE)) AS BIGINT)) AS v FROM embeddings
        WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
      p AS (SELECT q.vec_id AS query_id, c.vec_id, CAST(list_sum(list_transform(range(1, len(q.v) + 1), lambda i: q.v[i] * c.v[i])) AS BIGINT) AS score
            FROM e q JOIN e c ON q.vec_id <> c.vec_id AND len(q.v) = len(c.v) WHERE q.vec_id % 20 = 0),
      r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM p)
      SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score FROM r WHERE rank <= {K}"""
