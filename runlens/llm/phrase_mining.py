"""Operator 12 — phrase collocations, counted in burstable hash containers under a shallow word-id trie.

Texts are lower-cased (A-Z), cut into pieces at ``.,;:!?`` and line breaks, pieces
into words at blanks. Phrases of 2 to ``LONGEST`` words with at least ``least``
occurrences in a language are scored by their weakest cut into two parts.

Counting: a task numbers the words it meets and keeps the phrases of its texts in a
trie over word ids (``HatTrie``). The trie is shallow: its leaves are containers
that hold whole ranges of subtrees as (word ids, count) tables, into which the
phrases of a group of texts are merged. A container that grows beyond ``BURST``
entries bursts: between two first words, or, if it holds one first word only, between two second
words, and so on. When a task's containers hold more than ``HELD`` entries, the largest are spilled whole, as
sorted runs of (language, phrase, count), and Spark's shuffle merges the runs
per prefix partition: by language and the first two words, so a frequent first word is no hot key. A run leaves its task
packed, one row for a prefix partition, as single phrases would take several times the bytes.

Three passes over the texts: words; pairs of frequent words; phrases of three and
more words whose pairs are all frequent. No part of a phrase is rarer than the phrase, so
nothing that could be a candidate or a part of one is left out. The frequent words and pairs are known to the tasks as a bit table
of fixed size (``SLOTS`` bits): a bit that two words share lets a rare word through to the count,
which is exact and drops it.

Defined results: a null text is an empty one; a null lang is ``und``, an empty one is a language of its own;
pieces end with the text; a text of any length counts whole and alone fills a
group; repeated rows count each; equal scores are ranked by count and then by the phrase's bytes; an empty table,
or one without frequent phrases, gives no rows; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from runlens.llm.common import checked, staged, table, work_dir
from runlens.llm.ragged import groups

LEAST = 100  # occurrences of a candidate
LONGEST = 5
TOP = 2000  # phrases reported per language
SLOTS = 1 << 26  # bits of a filter: 8 MB
BURST = 1 << 16  # entries of a container
HELD = 1 << 20  # entries of all containers of a task
KNOWN = 1 << 20  # words a task numbers before it starts anew
GROUP_BYTES = 4 << 20
PACK_BYTES = 32 << 20  # of runs packed together
WORD_BITS = 21
FEW = 200_000  # phrases broadcast at most

PARTS = 4096  # prefix partitions: hashes of language and first two words
COUNTS = "lang string, phrase string, n long"
PACKED = "part int, lang string, phrases string, ns array<long>"
_SCHEMA = pa.schema([("lang", pa.string()), ("phrase", pa.string()), ("n", pa.int64())])
_RUN = _SCHEMA.append(pa.field("part", pa.int32()))
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_KIND = np.zeros(256, np.uint8)  # 0: of a word, 1: between words, 2: between pieces
_KIND[[0x20, 0x09]] = 1
_KIND[list(b".,;:!?\x0a\x0b\x0c\x0d")] = 2


def words_of(texts: list[bytes]) -> tuple[np.ndarray, pa.Array, np.ndarray]:
    """(number of each word's spelling, spellings, whether a word and the next are in one piece)."""
    buf = _LOWER[np.frombuffer(b"\n".join(texts), np.uint8)]
    kind = _KIND[buf]
    inside = kind == 0
    edge = np.flatnonzero(np.diff(inside, prepend=False, append=False))
    starts, ends = edge[::2], edge[1::2]
    offsets = np.zeros(len(starts) + 1, np.int64)
    np.cumsum(ends - starts, out=offsets[1:])
    words = pa.Array.from_buffers(pa.large_binary(), len(starts), [None, pa.py_buffer(offsets), pa.py_buffer(buf[inside])])
    coded = words.dictionary_encode()
    piece = np.searchsorted(np.flatnonzero(kind == 2), starts)
    return np.asarray(coded.indices), coded.dictionary, piece[1:] == piece[:-1]


def _hash(lang: bytes, word: bytes) -> int:
    return xxhash.xxh64_intdigest(lang + b"\n" + word)


def _pair_slots(first: np.ndarray, second: np.ndarray) -> np.ndarray:
    x = first * np.uint64(0x9E3779B97F4A7C15) + (second ^ second >> np.uint64(31))
    x = (x ^ x >> np.uint64(32)) * np.uint64(0xD6E8FEB86659FD93)
    return x >> np.uint64(64 - SLOTS.bit_length() + 1)


def _word_slots(hashes: np.ndarray) -> np.ndarray:
    return hashes & np.uint64(SLOTS - 1)


def _listed(bits: np.ndarray, slots: np.ndarray) -> np.ndarray:
    return (bits[slots >> np.uint64(3)] >> (slots & np.uint64(7)).astype(np.uint8) & 1).astype(bool)


def _sums(a: np.ndarray, b: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct (a, b) in ascending order and the sums of their n."""
    order = np.lexsort((b, a)) if b.any() else np.argsort(a, kind="stable")
    a, b, n = a[order], b[order], n[order]
    first = np.flatnonzero(np.r_[True, (a[1:] != a[:-1]) | (b[1:] != b[:-1])]) if len(a) else np.empty(0, np.int64)
    return a[first], b[first], np.add.reduceat(n, first) if len(first) else n


class Container:
    """Counted phrases of one range of subtrees: a merged table and runs that wait to be merged."""

    def __init__(self):
        self.runs: list[tuple] = []
        self.merged = self.waiting = 0

    def add(self, run: tuple) -> None:
        self.runs.append(run)
        self.waiting += len(run[0])
        if self.waiting > max(self.merged, 1024):
            self.merge()

    def merge(self) -> None:
        if len(self.runs) > 1:
            self.runs = [_sums(*[np.concatenate(c) for c in zip(*self.runs)])]
        self.merged, self.waiting = len(self.runs[0][0]) if self.runs else 0, 0


class HatTrie:
    """Trie over word ids. A phrase is (a, b): the ids of its first three words, from the highest bits down, and of
    the other two; 0 stands for no word, so a phrase comes right before those it begins, and a subtree is a range."""

    def __init__(self, burst: int = BURST):
        self.burst, self.leaves = burst, [Container()]
        self.bounds = np.empty(0, np.int64)  # first key of every leaf but the first

    def __len__(self) -> int:
        return sum(x.merged + x.waiting for x in self.leaves)

    def add(self, a: np.ndarray, b: np.ndarray, n: np.ndarray) -> None:
        cuts = [0, *np.searchsorted(a, self.bounds).tolist(), len(a)]
        for i in range(len(self.leaves) - 1, -1, -1):
            if cuts[i] < cuts[i + 1]:
                part = slice(cuts[i], cuts[i + 1])
                self.leaves[i].add((a[part], b[part], n[part]))
                if self.leaves[i].merged > self.burst and not self.leaves[i].waiting:
                    self._burst(i)

    def _burst(self, i: int) -> None:
        a, b, n = self.leaves[i].runs[0]
        for shift in (2 * WORD_BITS, WORD_BITS, 0):  # between first words, else below the one first word, ...
            words = a >> shift
            middle = words[len(a) // 2]
            cut = int(np.searchsorted(words, middle))
            if not cut:
                cut = int(np.searchsorted(words, middle, "right"))
            if cut < len(a):
                break
        else:
            return  # one phrase of three words and its continuations: stays whole
        left, right = Container(), Container()
        left.runs, left.merged = [(a[:cut], b[:cut], n[:cut])], cut
        right.runs, right.merged = [(a[cut:], b[cut:], n[cut:])], len(a) - cut
        self.leaves[i:i + 1] = [left, right]
        self.bounds = np.insert(self.bounds, i, a[cut] >> shift << shift)

    def spill(self, most: int) -> Iterator[tuple]:
        """Whole containers as sorted runs, the largest first, until at most ``most`` entries are left."""
        size = 0
        for leaf in self.leaves:
            leaf.merge()
            size += leaf.merged
        for leaf in sorted(self.leaves, key=lambda x: -x.merged):
            if size <= most:
                return
            if leaf.merged:
                yield leaf.runs[0]
            size -= leaf.merged
            leaf.runs, leaf.merged = [], 0


class Counter:
    """The tries of one task, by language, and the words it has numbered (from 1; 0: not frequent)."""

    def __init__(self, frequent: np.ndarray, pairs: np.ndarray | None, held: int = HELD, known: int = KNOWN):
        self.frequent, self.pairs, self.held, self.most = frequent, pairs, held, known
        self.tries: dict[bytes, HatTrie] = {}
        self.ids: dict[bytes, dict[bytes, int]] = {}
        self.words, self.hashes = [b""], [0]

    def _numbered(self, lang: bytes, spellings: list[bytes]) -> np.ndarray:
        ids = self.ids.setdefault(lang, {})
        new = [w for w in spellings if w not in ids]
        if new:
            hashes = np.fromiter((_hash(lang, w) for w in new), np.uint64, len(new))
            for w, h, ok in zip(new, hashes.tolist(), _listed(self.frequent, _word_slots(hashes)).tolist()):
                ids[w] = len(self.words) if ok else 0
                if ok:
                    self.words.append(w)
                    self.hashes.append(h)
        return np.fromiter((ids[w] for w in spellings), np.int64, len(spellings))

    def add(self, lang: bytes, texts: list[bytes]) -> Iterator[pa.RecordBatch]:
        codes, spellings, joined = words_of(texts)
        if len(self.words) + len(spellings) >= 1 << WORD_BITS or sum(map(len, self.ids.values())) > self.most:
            yield from self.flush(0)
            self.ids, self.words, self.hashes = {}, [b""], [0]
        if len(codes) < 2:
            return
        w = self._numbered(lang, spellings.to_pylist())[codes]
        good = joined & (w[:-1] > 0) & (w[1:] > 0)
        at = np.flatnonzero(good)
        if self.pairs is not None:
            h = np.asarray(self.hashes, np.uint64)
            distinct, where = np.unique(w[at] << WORD_BITS | w[at + 1], return_inverse=True)
            fine = _listed(self.pairs, _pair_slots(h[distinct >> WORD_BITS], h[distinct & (1 << WORD_BITS) - 1]))
            at = at[fine[where]]
            good = np.zeros(len(good), bool)
            good[at] = True
        trie = self.tries.setdefault(lang, HatTrie())
        a, b = w[at] << 2 * WORD_BITS | w[at + 1] << WORD_BITS, np.zeros(len(at), np.int64)
        if self.pairs is None:
            trie.add(*_sums(a, b, np.ones(len(a), np.int64)))
        else:
            for k in range(3, LONGEST + 1):  # good pairs in a row
                on = at + k - 2 < len(good)
                on[on] = good[at[on] + k - 2]
                at, a, b = at[on], a[on], b[on]
                more = w[at + k - 1]
                if k == 3:
                    a = a | more
                else:
                    b = b | more << WORD_BITS * (LONGEST - k)
                trie.add(*_sums(a, b, np.ones(len(a), np.int64)))
        if sum(map(len, self.tries.values())) > self.held:
            yield from self.flush(self.held // 2)

    def flush(self, most: int) -> Iterator[pa.RecordBatch]:
        words, mask, h = pa.array(self.words, pa.binary()), (1 << WORD_BITS) - 1, np.asarray(self.hashes, np.uint64)
        share = most // max(1, len(self.tries))
        for lang, trie in self.tries.items():
            for a, b, n in trie.spill(share):
                for j in range(0, len(a), BURST):
                    x, y, m = a[j:j + BURST], b[j:j + BURST], n[j:j + BURST]
                    ids = [x >> 2 * WORD_BITS, x >> WORD_BITS & mask, x & mask, y >> WORD_BITS, y & mask]
                    # absent words are null and leave no blank
                    parts = [words.take(pa.array(v)) if i < 2 else pc.if_else(pa.array(v > 0), words.take(pa.array(v)), pa.scalar(None, pa.binary()))
                             for i, v in enumerate(ids)]
                    text = pc.binary_join_element_wise(*parts, b" ", null_handling="skip")
                    part = (_pair_slots(h[ids[0]], h[ids[1]]) % np.uint64(PARTS)).astype(np.int32)
                    yield pa.RecordBatch.from_arrays([pa.array([lang] * len(x), pa.binary()).cast(pa.string()), text.cast(pa.string()), pa.array(m),
                                                      pa.array(part)], schema=_RUN)


def _by_lang(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[bytes, list[bytes]]]:
    for batch in batches:
        langs = [x.encode() for x in batch.column(0).to_pylist()]
        texts = batch.column(1).cast(pa.binary()).to_pylist()
        for lang in dict.fromkeys(langs):
            for _, group in groups([t for t, x in zip(texts, langs) if x == lang], GROUP_BYTES):
                yield lang, group


def _count_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Words and their counts; the empty phrase counts all words of a language."""
    counts: dict[bytes, dict[bytes, int]] = {}

    def flush() -> Iterator[pa.RecordBatch]:
        for lang, found in counts.items():
            words = sorted(found)
            for i in range(0, len(words), BURST):
                part = words[i:i + BURST]
                yield pa.RecordBatch.from_arrays([pa.array([lang.decode()] * len(part)), pa.array(part, pa.binary()).cast(pa.string()),
                                                  pa.array([found[w] for w in part], pa.int64())], schema=_SCHEMA)
        counts.clear()

    for lang, texts in _by_lang(batches):
        codes, spellings, _ = words_of(texts)
        found = counts.setdefault(lang, {})
        found[b""] = found.get(b"", 0) + len(codes)
        for w, n in zip(spellings.to_pylist(), np.bincount(codes, minlength=len(spellings)).tolist()):
            found[w] = found.get(w, 0) + n
        if sum(map(len, counts.values())) > HELD:
            yield from flush()
    yield from flush()


def _packed(runs: list[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Phrases of one language, one row for a prefix partition: phrases on lines of their own, their counts."""
    if not runs:
        return
    rows = pa.Table.from_batches(runs).combine_chunks()
    order = np.argsort(np.asarray(rows.column("part")), kind="stable")
    lang, phrase, n, part = (x.combine_chunks() for x in rows.take(pa.array(order)).columns)
    at = np.asarray(part)
    first = np.flatnonzero(np.r_[True, at[1:] != at[:-1]])
    offsets = pa.array(np.r_[first, len(at)], pa.int32())
    yield pa.RecordBatch.from_arrays([part.take(pa.array(first)), lang.take(pa.array(first)), pc.binary_join(pa.ListArray.from_arrays(offsets, phrase), "\n"),
                                      pa.ListArray.from_arrays(offsets, n)], names=["part", "lang", "phrases", "ns"])


def _count_phrases(frequent, pairs):
    def packed(runs: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        for run in runs:
            if held and (run.column(0)[0] != held[0].column(0)[0] or sum(x.nbytes for x in held) >= PACK_BYTES):
                yield from _packed(held)
                held = []
            held.append(run)
        yield from _packed(held)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = Counter(frequent.value, pairs and pairs.value)
        for lang, texts in _by_lang(batches):
            yield from packed(counter.add(lang, texts))
        yield from packed(counter.flush(0))

    return run


def _slots(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The filter's bits of words and of pairs."""
    for batch in batches:
        if not batch.num_rows:
            continue
        langs, phrases = ([x.encode() for x in c.to_pylist()] for c in batch.columns[:2])
        parts = [p.split(b" ") for p in phrases]
        first, last = (np.asarray([_hash(x, p[i]) for x, p in zip(langs, parts)], np.uint64) for i in (0, -1))
        slots = _word_slots(first) if len(parts[0]) == 1 else _pair_slots(first, last)
        yield pa.RecordBatch.from_arrays([pa.array(slots.astype(np.int64))], names=["slot"])


def _filter(phrases: DataFrame):
    """Broadcast bit table of ``SLOTS`` bits, whatever the number of phrases (all of one length)."""
    blocks = phrases.select("lang", "phrase").mapInArrow(_slots, "slot long").groupBy(F.shiftright("slot", 15).alias("block")).agg(
        F.bitmap_construct_agg(F.col("slot").bitwiseAND(F.lit(32767))).alias("bits"))
    table_ = np.zeros((SLOTS >> 15, 4096), np.uint8)
    for block, bits in blocks.toLocalIterator():
        table_[block] = np.frombuffer(bits, np.uint8)
    return phrases.sparkSession.sparkContext.broadcast(table_.ravel())


def _merged(runs: DataFrame, least: int) -> DataFrame:
    """Frequent phrases: the tasks' packed runs merged per prefix partition (language and first two words)."""
    rows = runs.repartition("part").select("part", "lang", F.explode(F.arrays_zip(F.split("phrases", "\n").alias("phrase"), F.col("ns").alias("n"))).alias("x"))
    return rows.groupBy("part", "lang", "x.phrase").agg(F.sum("x.n").alias("f")).where(F.col("f") >= least).select("lang", "phrase", "f")


def frequent_phrases(docs: DataFrame, out: str, least: int = LEAST) -> tuple[DataFrame, DataFrame]:
    """(lang, phrase, words, f) of all phrases of up to ``LONGEST`` words with f >= least, and (lang, n)."""
    src = docs.select(F.coalesce(F.col("lang").cast("string"), F.lit("und")).alias("lang"),
                      F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    words = staged(src.mapInArrow(_count_words, COUNTS).groupBy("lang", "phrase").agg(F.sum("n").alias("f")).where(
        (F.col("f") >= least) | (F.col("phrase") == "")), f"{out}/words")
    totals = words.where("phrase = ''").select("lang", F.col("f").alias("n"))
    single = words.where((F.col("phrase") != "") & (F.col("f") >= least))
    known = _filter(single)
    pairs = staged(_merged(src.mapInArrow(_count_phrases(known, None), PACKED), least), f"{out}/pairs")
    known_pairs = _filter(pairs)
    longer = staged(_merged(src.mapInArrow(_count_phrases(known, known_pairs), PACKED), least), f"{out}/longer")
    known.unpersist()
    known_pairs.unpersist()
    every = single.unionByName(pairs).unionByName(longer)
    return every.select("lang", "phrase", F.size(F.split("phrase", " ")).alias("words"), "f"), totals


def collocations(docs: DataFrame, least: int = LEAST, top: int = TOP) -> DataFrame:
    """Each language's ``top`` phrases: lang, rank, phrase, a, l, r, n, score."""
    spark = docs.sparkSession
    out = work_dir(spark, "phrases")
    phrases, totals = frequent_phrases(docs, out, least)
    found = phrases.where("words > 1")
    part = checked(phrases.select("lang", F.col("phrase").alias("part"), F.col("f")), FEW)
    cuts = found.select("lang", "phrase", F.col("f").alias("a"), "words", F.explode(F.expr("sequence(1, words - 1)")).alias("cut")).select(
        "lang", "phrase", "a", "cut", F.expr("substring_index(phrase, ' ', cut)").alias("left"),
        F.expr("substring_index(phrase, ' ', cut - words)").alias("right"))
    both = cuts.join(part.select("lang", F.col("part").alias("left"), F.col("f").alias("l")), ["lang", "left"]).join(
        part.select("lang", F.col("part").alias("right"), F.col("f").alias("r")), ["lang", "right"]).join(checked(totals), "lang")
    wide = lambda c: F.col(c).cast("decimal(20,0)")
    counted = both.withColumns({"top": wide("a") * wide("n") * F.lit(1000).cast("decimal(4,0)"), "below": wide("l") * wide("r")}).withColumn(
        "score", F.expr("top div below"))
    scored = counted.groupBy("lang", "phrase", "a", "n").agg(F.min(F.struct("score", "cut", "l", "r")).alias("worst"))
    # a longer phrase that is as frequent: if any contains this one, so does one that is longer by a word
    inner = F.array(F.expr("substring_index(phrase, ' ', words - 1)"), F.expr("substring_index(phrase, ' ', 1 - words)"))
    covered = found.where("words > 2").select("lang", F.explode(inner).alias("phrase"), "f").groupBy("lang", "phrase").agg(F.max("f").alias("outer"))
    kept = scored.join(covered, ["lang", "phrase"], "left").where(F.col("outer").isNull() | (100 * F.col("outer") < 100 * F.col("a")))
    rows = staged(kept.select("lang", "phrase", "a", F.col("worst.l").alias("l"), F.col("worst.r").alias("r"), "n", F.col("worst.score").alias("score")),
                  f"{out}/scored")
    order = [F.col("score").desc(), F.col("a").desc(), F.col("phrase")]
    # the best of every share of a language first, so that no language goes to one task
    near = rows.withColumn("share", F.pmod(F.xxhash64("phrase"), F.lit(64))).withColumn(
        "place", F.row_number().over(Window.partitionBy("lang", "share").orderBy(*order))).where(F.col("place") <= top)
    ranked = near.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order)).cast("long")).where(F.col("rank") <= top)
    return ranked.select("lang", "rank", "phrase", *[F.col(c).cast("long").alias(c) for c in ("a", "l", "r", "n", "score")])


def op12_phrase_mining(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 2,000 best phrases of every language of ``documents``."""
    return collocations(table(spark, sf_dir, "documents").select("lang", "text"))


def oracle(least: int = LEAST, top: int = TOP) -> str:
    """Every phrase is counted, then scored and compared with all longer ones that contain it."""
    upper, lower = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
    return f"""WITH piece AS (SELECT coalesce(lang, 'und') AS lang, unnest(string_split_regex(translate(coalesce(text, ''), '{upper}', '{lower}'),
        '[.,;:!?\\x0A-\\x0D]')) AS p FROM documents),
      w AS (SELECT lang, list_filter(string_split_regex(p, '[\\x20\\x09]+'), lambda x: x <> '') AS ws FROM piece),
      spot AS (SELECT lang, ws, unnest(range(1, len(ws) + 1)) AS i FROM w),
      g AS (SELECT lang, ws, i, unnest(range(1, least(5, len(ws) - i + 1) + 1)) AS k FROM spot),
      f AS (SELECT lang, list_slice(ws, i, i + k - 1) AS p, k, count(*) AS f FROM g GROUP BY ALL),
      tot AS (SELECT lang, sum(f) AS n FROM f WHERE k = 1 GROUP BY lang),
      c AS (SELECT * FROM f WHERE k > 1 AND f >= {least}),
      cut AS (SELECT *, unnest(range(1, k)) AS j FROM c),
      s AS (SELECT cut.lang, cut.p, cut.k, cut.f AS a, j, l.f AS l, r.f AS r, CAST(n AS BIGINT) AS n,
          (1000::HUGEINT * cut.f * CAST(n AS HUGEINT)) // (l.f::HUGEINT * r.f) AS score
        FROM cut JOIN tot USING (lang) JOIN f l ON l.lang = cut.lang AND l.p = list_slice(cut.p, 1, j)
        JOIN f r ON r.lang = cut.lang AND r.p = list_slice(cut.p, j + 1, cut.k)),
      worst AS (SELECT * FROM s QUALIFY row_number() OVER (PARTITION BY lang, p ORDER BY score, j) = 1),
      inside AS (SELECT lang, f, list_slice(p, b, e) AS p FROM (SELECT *, unnest(range(b + 1, k + 1)) AS e FROM (SELECT *, unnest(range(1, k)) AS b FROM c))
        WHERE e - b + 1 < k),
      cover AS (SELECT lang, p, max(f) AS f FROM inside GROUP BY ALL),
      kept AS (SELECT worst.*, array_to_string(worst.p, ' ') AS phrase FROM worst LEFT JOIN cover ON cover.lang = worst.lang AND cover.p = worst.p
        WHERE NOT coalesce(100 * cover.f >= 100 * a, false)),
      ranked AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, encode(phrase)) AS rank FROM kept)
    SELECT lang, rank, phrase, a, l, r, n, CAST(score AS BIGINT) AS score FROM ranked WHERE rank <= {top}"""
