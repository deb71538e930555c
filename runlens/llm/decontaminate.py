"""Operator 10 — benchmark decontamination by size-partitioned MinHash containment search.

Texts become lower-case words (runs of letters and digits) and five-word
shingles. A short test item inside a long document has a tiny Jaccard
similarity with it, so items are partitioned by size: an item of n shingles
belongs to the smallest class b = 8, 16, 32 ... with b >= n, and documents are
searched through windows of 2b shingles that start every b shingles. A window
then covers any occurrence of the item, and its Jaccard similarity with a
contained item is at least 0.19 at containment 0.8 (0.25 at 1.0). A window
and an item are a candidate when any of 64 minima agree: a contained item is
missed with probability below 2e-6. Items of fewer than five shingles, which are
too small a part of the smallest window for that, are looked up exactly: any of
their shingles makes a candidate. Candidates are verified on the words themselves: the share of the item's distinct shingles that the document holds.

The benchmark is indexed in blocks of bounded size (``block_chars``), each
broadcast once and searched over all documents; documents are never shuffled.

Defined results: null texts are empty; items and documents of fewer than five
words hold no shingle and match nothing; every repeated row gives its own
pairs; null ids are kept.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from runlens.llm.common import table, words_of
from runlens.llm.ragged import text_groups
from runlens.llm.shingles import shingle_hashes, word_hashes

WORDS = 5
THRESHOLD = 0.8
HASHES = 64
SMALLEST = 8
EXACT_BELOW = 5  # shingles
BLOCK_CHARS = 4 << 20

_rng = np.random.default_rng(20240229)
_MUL = _rng.integers(1, 1 << 63, HASHES, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_ADD = _rng.integers(0, 1 << 63, HASHES, dtype=np.uint64)


def _minima_input(s: np.ndarray, k: int) -> np.ndarray:
    return ((s * _MUL[k] + _ADD[k]) >> np.uint64(32)).astype(np.uint32)


class Index:
    """Items of one benchmark block by size class, with their minima."""

    def __init__(self, items: list[tuple], threshold: float):
        self.threshold = threshold
        self.items: list[tuple] = []  # (item_id, set of shingles as word tuples, their hashes)
        by_class: dict[int, list[int]] = defaultdict(list)
        self.short: dict[int, list[int]] = defaultdict(list)  # shingle hash -> items of few shingles
        for item_id, text in items:
            words = words_of(text)
            shingles = {tuple(words[i:i + WORDS]) for i in range(len(words) - WORDS + 1)}
            if not shingles:
                continue
            hashes = np.unique(shingle_hashes(word_hashes([text.encode()])[0], WORDS))
            if len(shingles) < EXACT_BELOW:
                for h in hashes.tolist():
                    self.short[h].append(len(self.items))
            else:
                b = SMALLEST
                while b < len(shingles):
                    b *= 2
                by_class[b].append(len(self.items))
            self.items.append((item_id, shingles, hashes))
        self.short_hashes = np.asarray(sorted(self.short), np.uint64)
        self.classes = sorted(by_class)
        self.tables = {}
        for b, members in by_class.items():
            bits = max(16, (16 * len(members)).bit_length())
            mask = np.uint32((1 << bits) - 1)
            tables, owners = np.zeros((HASHES, 1 << bits), bool), []
            for k in range(HASHES):
                found = defaultdict(list)
                for i in members:
                    m = int(_minima_input(self.items[i][2], k).min())
                    found[m].append(i)
                    tables[k, m & int(mask)] = True
                owners.append(dict(found))
            self.tables[b] = (mask, tables, owners)

    def candidates(self, s: np.ndarray, lengths: list[int]) -> set[tuple[int, int]]:
        """(document number, item number) pairs whose minima agree in some window, or that share a shingle where the item
        has few; s: all documents' shingles in a row."""
        out: set[tuple[int, int]] = set()
        ends = np.cumsum(lengths)
        if len(self.short_hashes) and len(s):
            near = np.searchsorted(self.short_hashes, s)
            at = np.flatnonzero(self.short_hashes[np.minimum(near, len(self.short_hashes) - 1)] == s)
            for d, h in zip(np.searchsorted(ends, at, side="right").tolist(), s[at].tolist()):
                out.update((d, i) for i in self.short[h])
        if not self.classes or not len(s):
            return out
        first = self.classes[0]
        doc_of, starts, level = {}, {}, first
        per_doc = [(d, e - n, n) for d, (n, e) in enumerate(zip(lengths, ends)) if n]
        blocks = [-(-n // first) for _, _, n in per_doc]
        base = np.concatenate([np.arange(a, a + n, first) for _, a, n in per_doc])
        docs = np.repeat(np.asarray([d for d, _, _ in per_doc]), blocks)
        doc_of[first] = docs
        while level < self.classes[-1]:  # each class's blocks are pairs of the class below, from a document's first on
            n = len(docs)
            begin = np.flatnonzero(np.r_[True, docs[1:] != docs[:-1]])
            within = np.arange(n) - np.repeat(begin, np.diff(np.r_[begin, n]))
            starts[level * 2] = np.flatnonzero(within % 2 == 0)
            docs = docs[starts[level * 2]]
            level *= 2
            doc_of[level] = docs
        for k in range(HASHES):
            low = np.minimum.reduceat(_minima_input(s, k), base)
            level = first
            while True:
                if level in self.tables:
                    docs = doc_of[level]
                    window = low.copy()
                    same = docs[1:] == docs[:-1]
                    np.minimum(window[:-1], low[1:], out=window[:-1], where=same)
                    mask, tables, owners = self.tables[level]
                    for at in np.flatnonzero(tables[k][window & mask]):
                        for i in owners[k].get(int(window[at]), ()):
                            out.add((int(docs[at]), i))
                if level >= self.classes[-1]:
                    break
                low = np.minimum.reduceat(low, starts[level * 2])
                level *= 2
        return out

    def search(self, texts: list[bytes]) -> list[tuple[int, object, int, int]]:
        """(document number, item_id, shared shingles, item's shingles) of every contained item."""
        parts = [shingle_hashes(w, WORDS) for w in word_hashes(texts)]
        found = []
        for d, i in sorted(self.candidates(np.concatenate(parts), list(map(len, parts)))):
            item_id, shingles, hashes = self.items[i]
            at = np.flatnonzero(np.isin(parts[d], hashes))
            if len(at) < self.threshold * len(shingles) - 1e-9:
                continue
            words = words_of(texts[d].decode())
            shared = len({tuple(words[j:j + WORDS]) for j in at.tolist()} & shingles)
            if shared >= self.threshold * len(shingles) - 1e-9:
                found.append((d, item_id, shared, len(shingles)))
        return found


def _indexes(benchmark: DataFrame, threshold: float, block_chars: int, item_col: str, text_col: str) -> Iterator:
    """A broadcast index for each block of the benchmark; a block is bounded whatever the benchmark's size."""
    spark = benchmark.sparkSession
    items = benchmark.select(F.col(item_col).cast("long").alias("item_id"),
                             F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    total = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    n = total // block_chars + 1
    for b in range(n):
        block = items.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(n)) == b)
        yield spark.sparkContext.broadcast(Index([tuple(r) for r in block.collect()], threshold))


def contained_items(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                    item_col: str = "item_id", item_text_col: str = "text", threshold: float = THRESHOLD,
                    block_chars: int = BLOCK_CHARS) -> DataFrame:
    """(doc_id, item_id, n_shared, n_item, containment) of every item a document contains."""
    src = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))

    def search(index):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for start, texts in text_groups(batch.column(1)):
                    rows = [(batch.column(0)[start + d].as_py(), i, a, b) for d, i, a, b in index.value.search(texts)]
                    if rows:
                        yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*rows)],
                                                         names=["doc_id", "item_id", "n_shared", "n_item"])

        return src.mapInArrow(run, "doc_id long, item_id long, n_shared long, n_item long")

    found = [search(x) for x in _indexes(benchmark, threshold, block_chars, item_col, item_text_col)]
    return reduce(DataFrame.unionAll, found).withColumn("containment", F.col("n_shared") / F.col("n_item"))


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, text_col: str = "text", item_col: str = "item_id",
                      item_text_col: str = "text", threshold: float = THRESHOLD, block_chars: int = BLOCK_CHARS) -> DataFrame:
    """Rows of ``docs`` that contain no benchmark item; columns unchanged."""
    at = docs.columns.index(text_col)

    def keep(index):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                bad = {start + d for start, texts in text_groups(batch.column(at)) for d, *_ in index.value.search(texts)}
                yield batch.filter(pa.array([i not in bad for i in range(batch.num_rows)], pa.bool_()))

        return run

    out = docs
    for index in _indexes(benchmark, threshold, block_chars, item_col, item_text_col):
        out = out.mapInArrow(keep(index), docs.schema)
    return out


def op10_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every (document, benchmark item) pair with a containment of 0.8 or more."""
    return contained_items(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def oracle() -> str:
    """Exact containment over all shingles."""
    def shingles(key: str, name: str) -> str:
        return rf"""SELECT DISTINCT r, {key}, s FROM (SELECT r, {key}, unnest(list_transform(range(1, len(w) - {WORDS - 2}),
              lambda i: array_to_string(w[i:i + {WORDS - 1}], ' '))) AS s FROM (SELECT row_number() OVER () AS r, {key},
              regexp_extract_all(lower(coalesce(text, '')), '[\p{{L}}\p{{N}}]+') AS w FROM {name}) WHERE len(w) >= {WORDS})"""
    return f"""WITH d AS ({shingles('doc_id', 'documents')}), b AS ({shingles('item_id', 'benchmark')}),
      n AS (SELECT r, count(*) AS n_item FROM b GROUP BY r),
      h AS (SELECT d.r AS dr, b.r AS br, doc_id, item_id, count(*) AS n_shared FROM d JOIN b USING (s) GROUP BY ALL)
      SELECT doc_id, item_id, n_shared, n_item, n_shared / n_item AS containment FROM h JOIN n ON n.r = h.br
      WHERE n_shared >= {THRESHOLD} * n_item - 1e-9"""
