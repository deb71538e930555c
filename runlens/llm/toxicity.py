"""Operator 8 — toxic passages by maximum-scoring segments, calibrated by extreme values.

Learning (rows whose crc32(doc_id) mod 5 is not 0): words of labelled documents
are counted per label, each distinct line once per label, so that copies do
not vote twice; a word counts for itself and for its stems. A feature's score is its log-odds between the labels with an
informative Dirichlet prior (the corpus frequencies), moved two standard
errors towards zero. A word's score is that of its strongest feature, less a
constant drift that makes ordinary text negative.

Scoring: a linear-time scan finds every maximal scoring segment of a document.
Scores of the best segments of random text follow an extreme-value law: lambda
solves sum p(s) exp(lambda s) = 1 over the clean words, K is fitted to the
best segments of the documents labelled clean. A segment of score S in a text
of m words has the expectation E = K m exp(-lambda S); segments with
E <= ``alpha`` are toxic passages, a document's evidence is the sum of their
-ln E, and the share of label 1 among the training documents of each evidence
class (pooled to be monotone) is its score.

The word table has 2**21 hashed slots (crc32 of a word or stem), so what is collected
and broadcast has a fixed size; counting covers every labelled training document.

Defined results: null or empty texts have no segment and the score of that
class; a document labelled more than once counts with its largest label; null
labels are not used; without labels every score is 0; repeated rows get equal
scores; a null doc_id is taken as the empty text by the hash rule.
"""

from __future__ import annotations

import math
import uuid
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from runlens.llm.common import checked, staged, table, work_dir
from runlens.llm.ragged import PUNCTUATION, Chunks, hold, text_groups

SLOTS = 1 << 21
STEMS = range(4, 9)  # characters of the stems
PRIOR_SHARE = 0.1  # weight of the Dirichlet prior against the training words
DRIFT = 0.25
ALPHA = 0.05
CLASS_WIDTH = 2.0  # evidence classes: 0, then (0, 2], (2, 4], ... up to CLASSES
CLASSES = 20
CACHE_CHUNKS = 250_000  # chunks a Python worker keeps
HASHED_BYTES = 48  # bytes of a word that are hashed by array operations, all stems among them


def _crc_table() -> np.ndarray:
    """Table of zlib's crc32: entry b is the register after byte b alone."""
    table = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        table = np.where(table & 1, table >> 1 ^ np.uint32(0xEDB88320), table >> 1).astype(np.uint32)
    return table


_CRC = _crc_table()
_LETTERS = np.full(0x110000, -1, np.int8)  # filled as code points are met


def _letters(points: np.ndarray) -> np.ndarray:
    """1 for code points that are letters or digits, else 0; each is looked up once per worker."""
    found = _LETTERS[points]
    if (found < 0).any():
        new = np.unique(points[found < 0])
        _LETTERS[new] = [chr(c).isalnum() for c in new.tolist()]
        found = _LETTERS[points]
    return found


def _after(register: np.ndarray, byte) -> np.ndarray:
    """crc32 registers after one more byte."""
    return _CRC[(register ^ byte) & np.uint32(255)] ^ register >> np.uint32(8)


def _slot(register: np.ndarray) -> np.ndarray:
    return (~register & np.uint32(SLOTS - 1)).astype(np.int32)


def word_slots(chunks: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Slots of the features of all words (``words_of``) of the chunks and the number of words of each chunk.

    A row a word: the word's own slot, then those of its stems, which inflected and compound forms share (a "-" follows
    the first characters), -1 where the word is no longer than the stem. All words are hashed together, byte by byte.
    """
    data = b"\n".join(chunks)
    sizes = np.fromiter(map(len, chunks), np.int64, len(chunks))
    if data.isascii():
        data = data.lower()
        point = np.frombuffer(data, np.uint8)
        byte_at = np.arange(len(data) + 1)
    else:
        text = data.decode()
        lower = text.lower()
        if len(lower) == len(text):  # a chunk has as many characters as before
            at = np.cumsum(sizes + 1) - 1
            n_chars = np.concatenate(([0], np.cumsum(np.frombuffer(data, np.uint8) & 0xC0 != 0x80)))
            sizes = n_chars[at] - n_chars[at - sizes]
        else:
            texts = [c.decode().lower() for c in chunks]
            lower = "\n".join(texts)
            sizes = np.fromiter(map(len, texts), np.int64, len(texts))
        data = lower.encode()
        point = np.frombuffer(lower.encode("utf-32-le"), np.uint32)
        byte_at = np.zeros(len(point) + 1, np.int64)
        np.cumsum(1 + (point >= 0x80) + (point >= 0x800) + (point >= 0x10000), out=byte_at[1:])
    letter = np.zeros(len(point) + 2, np.int8)
    letter[1:-1] = _letters(point)
    edges = np.flatnonzero(np.diff(letter))
    start, end = edges[::2], edges[1::2]
    begin = np.cumsum(sizes + 1) - sizes - 1
    counts = np.diff(np.append(np.searchsorted(start, begin), len(start)))
    slots = np.full((len(start), 1 + len(STEMS)), -1, np.int32)
    if not len(start):
        return slots, counts
    buf = np.frombuffer(data, np.uint8)
    # longest first: the words that have a further byte are always the first ones
    order = np.argsort(~np.minimum(byte_at[end] - byte_at[start], HASHED_BYTES).astype(np.uint8), kind="stable")
    start, end = start[order], end[order]
    first, n_bytes = byte_at[start], byte_at[end] - byte_at[start]
    have = len(start) - np.cumsum(np.bincount(np.minimum(n_bytes, HASHED_BYTES), minlength=HASHED_BYTES + 1))
    found = np.full(slots.shape, -1, np.int32)
    # bytes of each stem, 0 where the word is no longer
    stems = [np.where(end - start > k, byte_at[np.minimum(start + k, end)] - first, 0) for k in STEMS]
    wide = len(data) > len(point)
    register = np.full(len(start), 0xFFFFFFFF, np.uint32)
    for j in range(int(min(n_bytes[0], HASHED_BYTES))):
        n = have[j]
        register[:n] = _after(register[:n], buf[first[:n] + j])
        for c, k in enumerate(STEMS, 1):
            if k == j + 1 or wide and k <= j + 1 <= 4 * k:
                at = np.flatnonzero(stems[c - 1][:n] == j + 1)
                found[at, c] = _slot(_after(register[at], ord("-")))
    found[:, 0] = _slot(register)
    for i in np.flatnonzero(n_bytes > HASHED_BYTES).tolist():  # rare: words that go on
        found[i, 0] = zlib.crc32(data[first[i] + HASHED_BYTES:first[i] + n_bytes[i]], int(~register[i])) % SLOTS
    slots[order] = found
    return slots, counts


def _packed(values: np.ndarray, counts: np.ndarray) -> list[bytes]:
    """Raw bytes of successive ``counts`` of ``values``."""
    raw = values.tobytes()
    ends = np.cumsum(counts) * values.itemsize
    return [raw[a:b] for a, b in zip((ends - counts * values.itemsize).tolist(), ends.tolist())]


def _chunk_slots(chunks: list[bytes]) -> list[bytes]:
    """All features' slots of a chunk's words."""
    slots, counts = word_slots(chunks)
    has = slots >= 0
    before = np.concatenate(([0], np.cumsum(has.sum(axis=1))))
    last = np.cumsum(counts)
    return _packed(slots[has], before[last] - before[last - counts])


_counted: dict = {}  # caches of learning and of scoring: a worker holds one of them
_state: dict = {}


def _counter() -> Chunks:
    hold(_counted)
    if "count" not in _counted:
        _counted["count"] = Chunks(_chunk_slots, np.int32, tails=PUNCTUATION, most=CACHE_CHUNKS)
    return _counted["count"]


def held_out(id_col: str) -> Column:
    return F.crc32(F.coalesce(F.col(id_col).cast("string"), F.lit(""))) % 5 == 0


def segments(scores: np.ndarray) -> list[tuple[int, int, float]]:
    """All maximal scoring segments (start, end, score) of a score sequence, in linear time."""
    total = np.cumsum(scores)
    found: list[list] = []  # start, end, total before, total after, nearest earlier segment with a smaller total before
    for i in np.flatnonzero(scores > 0).tolist():
        after = float(total[i])
        start, before = i, after - float(scores[i])
        while True:
            j = len(found) - 1
            while j >= 0 and found[j][2] >= before:
                j = found[j][4]
            if j < 0 or found[j][3] >= after:
                found.append([start, i + 1, before, after, j])
                break
            start, before = found[j][0], found[j][2]
            del found[j:]
    return [(a, b, after - before) for a, b, before, after, _ in found]


def slot_scores(toxic: np.ndarray, clean: np.ndarray) -> np.ndarray:
    """Score of each slot: shrunken log-odds with an informative Dirichlet prior."""
    n1, n0 = toxic.sum(), clean.sum()
    if not n1 or not n0:
        return np.zeros(len(toxic), np.float32)
    prior = PRIOR_SHARE * (toxic + clean) + 1e-3
    a0 = prior.sum()
    y1, y0 = toxic + prior, clean + prior
    odds = np.log(y1 / (n1 + a0 - y1)) - np.log(y0 / (n0 + a0 - y0))
    error = 2 * np.sqrt(1 / y1 + 1 / y0)
    return (np.sign(odds) * np.maximum(np.abs(odds) - error, 0)).astype(np.float32)


def _lambda(scores: np.ndarray, counts: np.ndarray) -> float:
    """The positive root of sum p exp(lambda s) = 1 over the clean words' scores and their counts."""
    if not len(scores):
        return 1.0
    p = counts / counts.sum()
    grown = lambda x: float((p * np.exp(np.minimum(x * scores, 500))).sum()) - 1
    if scores.max() <= 0:
        return 1.0
    low, high = 1e-6, 1.0
    while grown(high) < 0 and high < 64:
        high *= 2
    for _ in range(60):
        mid = (low + high) / 2
        low, high = (mid, high) if grown(mid) < 0 else (low, mid)
    return (low + high) / 2


@dataclass
class Model:
    name: str
    scores: object  # broadcast of the slots' scores
    lam: float
    k: float
    shares: list[float]  # score of each evidence class
    alpha: float = ALPHA

    def _chunk_scores(self, chunks: list[bytes]) -> list[bytes]:
        slots, counts = word_slots(chunks)
        x = self.scores.value[slots]
        x[slots < 0] = 0
        strongest = x[np.arange(len(x)), np.abs(x).argmax(axis=1)] - np.float32(DRIFT)
        return _packed(strongest, counts)

    def word_scores(self, texts: list[bytes]) -> list[np.ndarray]:
        """Scores of each text's words; chunks are scored once per worker and model."""
        hold(_state)
        if _state.get("model") != self.name:
            _state.update(model=self.name, score=Chunks(self._chunk_scores, np.float32, tails=PUNCTUATION, most=CACHE_CHUNKS))
        values, counts = _state["score"](texts)
        return np.split(values, np.cumsum(counts)[:-1])

    def evidence(self, n_words: int, found: list[tuple[int, int, float]]) -> float:
        """Sum of -ln E over the significant segments."""
        base = math.log(max(self.k * max(n_words, 1), 1e-300))
        return sum(x for x in (self.lam * s - base for _, _, s in found) if x >= -math.log(self.alpha))

    def score(self, evidence: float) -> float:
        """Share of the evidence's class, moving on to the next class's share within it."""
        c = evidence_class(evidence)
        if c in (0, CLASSES):
            return self.shares[c]
        return self.shares[c] + (self.shares[c + 1] - self.shares[c]) * min(1.0, evidence / CLASS_WIDTH + 1 - c)


def evidence_class(evidence: float) -> int:
    return 0 if evidence <= 0 else min(CLASSES, 1 + int(evidence / CLASS_WIDTH))


def _monotone(ones: np.ndarray, counts: np.ndarray) -> list[float]:
    """Smoothed shares of label 1, pooled so that they never fall."""
    pooled: list[list[float]] = []
    for a, n in zip(ones, counts):
        pooled.append([a, n, 1])
        while len(pooled) > 1 and (pooled[-2][0] + .5) / (pooled[-2][1] + 1) >= (pooled[-1][0] + .5) / (pooled[-1][1] + 1):
            a2, n2, w2 = pooled.pop()
            pooled[-1] = [pooled[-1][0] + a2, pooled[-1][1] + n2, pooled[-1][2] + w2]
    return [(a + .5) / (n + 1) for a, n, w in pooled for _ in range(int(w))]


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Feature slots per label of (line, toxic) rows, summed within the task."""
    total = np.zeros((2, SLOTS), np.int64)
    flat = total.reshape(-1)
    count = _counter()
    for batch in batches:
        label = np.asarray(batch.column(1), np.int32)
        for start, lines in text_groups(batch.column(0)):
            slots, n = count(lines)
            np.add.at(flat, np.repeat(label[start:start + len(lines)] * np.int32(SLOTS), n) + slots, 1)
    at = np.flatnonzero(total.any(axis=0))
    if len(at):
        yield pa.RecordBatch.from_arrays([pa.array(at.astype(np.int32)), pa.array(total[1][at]), pa.array(total[0][at])],
                                         names=["slot", "toxic", "clean"])


def _histogram(model: Model):
    """Counts of word scores (to 0.01) in (text, y) rows labelled clean."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for _, texts in text_groups(batch.column(0)):
                values, n = np.unique(np.round(np.concatenate(model.word_scores(texts)) * 100).astype(np.int32), return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(values), pa.array(n)], names=["s", "n"])

    return run


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
        label_col: str = "toxic", alpha: float = ALPHA) -> Model:
    """Learn word scores, the extreme-value parameters and the evidence classes."""
    spark = docs.sparkSession
    marks = (labels.select(F.col(id_col).cast("long").alias("id"), F.col(label_col).cast("int").alias("y"))
             .where(F.col("id").isNotNull() & F.col("y").isin(0, 1) & ~held_out("id")).groupBy("id").agg(F.max("y").alias("y")))
    src = docs.select(F.col(id_col).cast("long").alias("id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    train = src.join(checked(marks), "id").select("text", "y")
    # each distinct line of a label counts once
    lines = train.select(F.explode(F.split("text", "\n")).alias("line"), "y").groupBy(
        F.xxhash64("line").alias("h"), "y").agg(F.first("line").alias("line")).select("line", "y")
    counts = lines.mapInArrow(_count, "slot int, toxic long, clean long").groupBy("slot").agg(
        F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean")).toArrow()  # at most SLOTS rows
    toxic, clean = np.zeros(SLOTS), np.zeros(SLOTS)
    at = counts.column("slot").to_numpy()
    toxic[at], clean[at] = counts.column("toxic").to_numpy(), counts.column("clean").to_numpy()
    model = Model(uuid.uuid4().hex, spark.sparkContext.broadcast(slot_scores(toxic, clean)), 1.0, 1.0, [0.0] * (CLASSES + 1), alpha)
    spread = lines.where("y = 0").mapInArrow(_histogram(model), "s int, n long").groupBy("s").agg(F.sum("n").alias("n")).toArrow()
    model.lam = _lambda(spread.column("s").to_numpy() / 100, spread.column("n").to_numpy())  # one row a score

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n, found = [], []
            for _, texts in text_groups(batch.column(0)):
                for scores in model.word_scores(texts):
                    n.append(len(scores))
                    found.append([s for _, _, s in segments(scores)])
            yield pa.RecordBatch.from_arrays([batch.column(1), pa.array(n, pa.int64()), pa.array(found, pa.list_(pa.float64()))],
                                             names=["y", "n", "found"])

    measured = staged(train.mapInArrow(measure, "y int, n long, found array<double>"), work_dir(spark, "toxicity"))
    # maximum likelihood of K under P(best < x) = exp(-K m exp(-lambda x)), over documents labelled clean
    best = F.coalesce(F.array_max("found"), F.lit(0.0))
    fitted = measured.where("y = 0 and n > 0").agg(F.count(F.lit(1)), F.sum(F.col("n") * F.exp(-model.lam * best))).first()
    model.k = float(f"{fitted[0] / fitted[1]:.6g}") if fitted[0] else 1.0
    gain = F.transform("found", lambda s: model.lam * s - F.log(F.greatest(model.k * F.greatest("n", F.lit(1)), F.lit(1e-300))))
    evidence = F.aggregate(F.filter(gain, lambda x: x >= -math.log(alpha)), F.lit(0.0), lambda a, x: a + x)
    cls = F.when(evidence <= 0, 0).otherwise(F.least(F.lit(CLASSES), 1 + F.floor(evidence / CLASS_WIDTH)))
    ones, all_ = np.zeros(CLASSES + 1), np.zeros(CLASSES + 1)
    for c, a, n in measured.groupBy(cls.cast("int").alias("c")).agg(F.sum("y"), F.count(F.lit(1))).collect():  # one row a class
        ones[c], all_[c] = a, n
    if all_.sum():
        model.shares = _monotone(ones, all_)
    return model


def score_documents(docs: DataFrame, model: Model, text_col: str = "text") -> DataFrame:
    """``docs`` plus ``toxic_score``, ``toxic_evidence`` and ``toxic_passages`` (first word, end word, score
    of each significant segment). Columns of these names are replaced."""
    added = {"toxic_score": "double", "toxic_evidence": "double", "toxic_passages": "array<struct<start:int,end:int,score:double>>"}
    src = docs.drop(*added)
    at, names = src.columns.index(text_col), [*src.columns, *added]
    schema = src.withColumns({c: F.lit(None).cast(t) for c, t in added.items()}).schema
    kind = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32()), ("score", pa.float64())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start, texts in text_groups(batch.column(at)):
                evidence, passages = [], []
                for scores in model.word_scores(texts):
                    found = segments(scores)
                    evidence.append(model.evidence(len(scores), found))
                    least = math.log(max(model.k * max(len(scores), 1), 1e-300)) - math.log(model.alpha)
                    passages.append([{"start": a, "end": b, "score": s} for a, b, s in found if model.lam * s >= least])
                kept = batch.slice(start, len(texts))
                yield pa.RecordBatch.from_arrays(
                    [*kept.columns, pa.array([model.score(x) for x in evidence], pa.float64()), pa.array(evidence, pa.float64()),
                     pa.array(passages, kind)], names=names)

    return src.mapInArrow(run, schema)


def op8_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity score of every document."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = fit(docs, table(spark, sf_dir, "labels"))
    scored = score_documents(docs, model)
    return scored.select("doc_id", held_out("doc_id").alias("held_out"), F.col("toxic_score").alias("score"),
                         (F.col("toxic_score") >= 0.5).cast("int").alias("predicted"),
                         F.size("toxic_passages").alias("n_passages"))
