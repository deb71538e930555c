"""Operator 11 — the prefix trie of rebuilt conversations, summed up by time-forward processing.

Rebuilding: conversation c takes the first h = crc32(decimal c) % 4 turns of
conversation c - c % 20 and then its own turns after its first h. A node is a
distinct sequence of first turns (role, text); its key is its depth and two
64-bit hashes, each the exclusive-or of hashes of (place, role, text), so the keys
of all prefixes of a conversation are running sums and a parent's key is known to its child.

Totals (children, leaves, saved tokens) go from the leaves up. Nodes are sorted
externally in reverse level order (deepest first, then by key); a node's final
row is put into a priority queue under its parent's place in that order, and the
parent takes it out when the sweep reaches it. The queue keeps ``QUEUE`` rows in
memory and spills the others as sorted runs (scratch files of the task, like
Spark's own shuffle spills; a lost task starts anew). Shards: the rows of
conversations at or below a node bound its subtree; nodes with at most ``bound``
rows below them are light, and every topmost light node roots a shard, whole in one
task. The heavy nodes above, at most (rows / bound) a level, are swept last, across the
shard roots, whose totals have been added up per parent before they move; they
take a round for every ``BAND`` levels, so one round unless a conversation is longer.

Scale and skew: turns are ranked through ranges of (conversation, turn), so one
conversation may spread over any number of tasks; prefix keys run over bands of
``BAND`` turns and are stitched; nodes, ends and shard roots are pre-aggregated
before their shuffles; a shard holds at most ``bound`` nodes whatever a first turn or a
conversation is repeated. The list of the conversations that end at a node is
hashed as one stream of blocks of 256 ids, in order: SHA-256 is sequential, so the ids (only those) of a
sequence that very many conversations equal pass one task, never its memory.

Defined results: null role or text is empty; a null conv_id is no conversation
and its rows take no part; a null turn comes first; equal turns are ordered by role,
then by a hash of the text, repeated rows are turns of their own; c - c % 20 rounds
towards zero for negative ids; texts of any length count whole; extra columns are
ignored; an empty table has no node, not even a root.
"""

from __future__ import annotations

import hashlib
import pickle
import tempfile
from collections.abc import Iterator
from heapq import heapify, heappop, heappush, heapreplace

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from runlens.llm.common import checked, staged, table, work_dir

GROUP = 20  # conversations that borrow from the same one
BORROWED = 4  # first turns borrowed: crc32 modulo this
BAND_BITS = 16
BAND = 1 << BAND_BITS
QUEUE = 200_000  # rows of the priority queue held in memory
LEAST, MOST = 256, 1 << 18  # bounds of a shard's rows
BATCH = 20_000

NODE = "depth long, id1 long, id2 long, pid1 long, pid2 long, conv_id long, n_convs long"
SWEPT = NODE + ", n_children long, n_leaves long, saved_tokens long, parent_conv_id long, resolved boolean"


class SpillingQueue:
    """Priority queue of (key, row) that holds at most ``most`` rows in memory; the others lie in sorted runs on disk."""

    def __init__(self, most: int = QUEUE):
        self.most, self.rows, self.heads, self.runs = most, [], [], []

    def push(self, key: tuple, row: tuple) -> None:
        heappush(self.rows, (key, row))
        if len(self.rows) > self.most:
            self._spill()

    def _spill(self) -> None:
        run = tempfile.TemporaryFile()
        for item in sorted(self.rows):
            pickle.dump(item, run, pickle.HIGHEST_PROTOCOL)
        run.seek(0)
        self.rows = []
        heappush(self.heads, (*pickle.load(run), len(self.runs)))
        self.runs.append(run)

    def least(self) -> tuple | None:
        """The smallest key, None if the queue is empty."""
        keys = [x[0][0] for x in (self.rows, self.heads) if x]
        return min(keys) if keys else None

    def pop(self) -> tuple:
        """The row with the smallest key."""
        if not self.heads or self.rows and self.rows[0] <= self.heads[0][:2]:
            return heappop(self.rows)[1]
        _, row, number = self.heads[0]
        try:
            heapreplace(self.heads, (*pickle.load(self.runs[number]), number))
        except EOFError:
            heappop(self.heads)
            self.runs[number].close()
        return row


def sweep(nodes: Iterator[tuple], most: int = QUEUE) -> Iterator[tuple]:
    """Final rows of nodes (depth, id1, id2, pid1, pid2, conv_id, n_convs, words, and children, leaves, saved tokens already
    known from elsewhere) that come in reverse level order. A row ends with its parent's conv_id and true, or, where the
    parent is not among the nodes, with -1 and false."""
    queue = SpillingQueue(most)
    for depth, id1, id2, pid1, pid2, conv, members, words, children, leaves, saved in nodes:
        here = (-depth, id1, id2)
        while (key := queue.least()) is not None and key < here:
            yield (*queue.pop(), -1, False)
        while key == here:
            child = queue.pop()
            children, leaves, saved = children + 1, leaves + child[8], saved + child[9]
            yield (*child, conv, True)
            key = queue.least()
        queue.push((1 - depth, pid1, pid2), (depth, id1, id2, pid1, pid2, conv, members, children,
                                            leaves if children else 1, saved + (members - 1) * words))
    while queue.least() is not None:
        yield (*queue.pop(), -1, False)


def _swept(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = [c.split()[0] for c in SWEPT.split(", ")]
    types = [pa.int64()] * (len(names) - 1) + [pa.bool_()]

    def batch(rows: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], names=names)

    rows = []
    for row in sweep(r for b in batches for r in zip(*[c.to_pylist() for c in b.columns])):
        rows.append(row)
        if len(rows) >= BATCH:
            yield batch(rows)
            rows = []
    if rows:
        yield batch(rows)


def _totals(nodes: DataFrame) -> DataFrame:
    """Nodes (one shard or several, whole in a partition) with their totals."""
    columns = [c.split()[0] for c in NODE.split(", ")] + ["words", "n_children", "n_leaves", "saved_tokens"]
    return nodes.select(*columns).sortWithinPartitions(F.col("depth").desc(), "id1", "id2").mapInArrow(_swept, SWEPT)


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(depth, id1, id2, sha) of rows (depth, id1, id2, text) sorted by node and block: a node's texts are hashed as one."""
    now, state, done = None, None, []

    def out() -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*done), [pa.int64()] * 3 + [pa.string()])],
                                          names=["depth", "id1", "id2", "ends_sha256"])

    for b in batches:
        for depth, id1, id2, text in zip(*[c.to_pylist() for c in b.columns]):
            if (depth, id1, id2) == now:
                state.update(b",")
            else:
                if now is not None:
                    done.append((*now, state.hexdigest()))
                now, state = (depth, id1, id2), hashlib.sha256()
            state.update(text.encode())
        if done:
            yield out()
            done = []
    if now is not None:
        done = [(*now, state.hexdigest())]
        yield out()


def _placed(conversations: DataFrame, out: str) -> tuple[DataFrame, DataFrame]:
    """(c, n, h, base, nb, len) per conversation, and its original turns (c, pos from 1, t1, t2, words, h, nb, len)."""
    text = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(""))
    src = conversations.select(F.col("conv_id").cast("long").alias("c"), F.col("turn").alias("turn"), text("role").alias("role"), text("text").alias("text")).where("c is not null").select(
        "c", "turn", "role", F.xxhash64(F.lit(1), "role", "text").alias("t1"), F.xxhash64(F.lit(2), "role", "text").alias("t2"),
        F.regexp_count("text", F.lit("[^\\x20\\x09-\\x0D]+")).cast("long").alias("words"))
    order = [F.col("turn").asc_nulls_first(), F.col("role"), F.col("t1"), F.col("t2")]
    # ranges of (conversation, turn): a long conversation lies in several, in order
    ranged = staged(src.repartitionByRange("c", *order).withColumn("chunk", F.spark_partition_id()), f"{out}/ranged")
    whole = Window.partitionBy("c")
    pieces = staged(ranged.groupBy("c", "chunk").agg(F.count(F.lit(1)).alias("size")).select(
        "c", "chunk", F.sum("size").over(whole).alias("n"),
        F.coalesce(F.sum("size").over(whole.orderBy("chunk").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("before")),
        f"{out}/pieces")
    convs = pieces.where("before = 0").select("c", "n", (F.crc32(F.col("c").cast("string")) % BORROWED).alias("h"),
                                              (F.col("c") - F.col("c") % GROUP).alias("base"))
    bases = convs.select(F.col("c").alias("base"), F.col("n").alias("m"))
    sized = staged(convs.join(bases, "base", "left").withColumn("nb", F.least("h", F.coalesce("m", F.lit(0)))).select(
        "c", "n", "h", "base", "nb", (F.col("nb") + F.greatest(F.col("n") - F.col("h"), F.lit(0))).alias("len")), f"{out}/sized")
    r = F.row_number().over(Window.partitionBy("c", "chunk").orderBy(*order))
    known = pieces.join(sized.select("c", "h", "nb", "len"), "c").select("c", "chunk", "before", "h", "nb", "len")
    placed = ranged.withColumn("r", r).join(known, ["c", "chunk"]).select(
        "c", (F.col("before") + F.col("r")).alias("pos"), "t1", "t2", "words", "h", "nb", "len")
    return sized, staged(placed, f"{out}/placed")


def rebuilt_turns(conversations: DataFrame, out: str) -> tuple[DataFrame, DataFrame]:
    """(c, len, ...) per rebuilt conversation, and its turns with the keys of the nodes they lead to and of their parents."""
    sized, placed = _placed(conversations, out)
    own = placed.where("pos > h").select("c", (F.col("nb") + F.col("pos") - F.col("h")).alias("depth"), "t1", "t2", "words", "len")
    heads = placed.where((F.col("c") % GROUP == 0) & (F.col("pos") < BORROWED)).select(F.col("c").alias("base"), "pos", "t1", "t2", "words")
    lent = sized.where("nb > 0").join(heads, "base").where("pos <= nb").select("c", F.col("pos").alias("depth"), "t1", "t2", "words", "len")
    turns = own.unionByName(lent).select(
        "c", "depth", F.shiftright(F.col("depth") - 1, BAND_BITS).alias("band"), "words", "len",
        F.xxhash64("depth", "t1").alias("x1"), F.xxhash64("depth", "t2").alias("x2"))
    band = Window.partitionBy("c", "band").orderBy("depth").rowsBetween(Window.unboundedPreceding, 0)
    earlier = Window.partitionBy("c").orderBy("band").rowsBetween(Window.unboundedPreceding, -1)
    # only conversations longer than a band have an earlier one
    offsets = turns.where(F.col("len") > BAND).groupBy("c", "band").agg(F.bit_xor("x1").alias("b1"), F.bit_xor("x2").alias("b2")).select(
        "c", "band", F.bit_xor("b1").over(earlier).alias("o1"), F.bit_xor("b2").over(earlier).alias("o2")).where("band > 0")
    keyed = turns.withColumns({"p1": F.bit_xor("x1").over(band), "p2": F.bit_xor("x2").over(band)}).join(
        checked(offsets), ["c", "band"], "left")
    ids = keyed.select("c", "depth", "words", "len", "x1", "x2", F.col("p1").bitwiseXOR(F.coalesce("o1", F.lit(0))).alias("id1"),
                       F.col("p2").bitwiseXOR(F.coalesce("o2", F.lit(0))).alias("id2"))
    return sized, staged(ids.select("c", "depth", "words", "len", "id1", "id2", F.col("id1").bitwiseXOR(F.col("x1")).alias("pid1"),
                                    F.col("id2").bitwiseXOR(F.col("x2")).alias("pid2")), f"{out}/turns")


def _ends(sized: DataFrame, turns: DataFrame) -> DataFrame:
    """(depth, id1, id2, ends_sha256) of the nodes at which conversations end."""
    key = ["depth", "id1", "id2"]
    zero = F.lit(0).cast("long")
    last = turns.where("depth = len").select(*key, "c").unionByName(
        sized.where("len = 0").select(zero.alias("depth"), zero.alias("id1"), zero.alias("id2"), "c"))
    blocks = last.groupBy(*key, F.shiftright("c", 8).alias("block")).agg(F.sort_array(F.collect_list("c")).alias("ids")).select(
        *key, "block", F.array_join(F.col("ids").cast("array<string>"), ",").alias("text"))
    return blocks.repartition(*key).sortWithinPartitions(*key, "block").select(*key, "text").mapInArrow(
        _digests, "depth long, id1 long, id2 long, ends_sha256 string")


def shard_bound(rows: int, tasks: int) -> int:
    """Rows of a shard at most: several shards for every task."""
    return min(MOST, max(LEAST, rows // (4 * tasks)))


def conversation_trie(conversations: DataFrame, bound: int | None = None, band: int = BAND) -> DataFrame:
    """One row per node of the trie of rebuilt conversations (columns conv_id, turn, role, text); see the module's text."""
    spark = conversations.sparkSession
    out = work_dir(spark, "prefix-trie")
    key = ["depth", "id1", "id2"]
    sized, turns = rebuilt_turns(conversations, out)
    zero = F.lit(0).cast("long")
    below = turns.groupBy(*key).agg(
        F.min("pid1").alias("pid1"), F.min("pid2").alias("pid2"), F.min("c").alias("conv_id"), F.count(F.lit(1)).alias("n_convs"),
        F.min("words").alias("words"), F.sum(F.col("len") - F.col("depth") + 1).alias("rows"))
    root = sized.agg(F.min("c").alias("conv_id"), F.count(F.lit(1)).alias("n_convs"), F.sum("len").alias("rows")).where("n_convs > 0").select(
        zero.alias("depth"), zero.alias("id1"), zero.alias("id2"), zero.alias("pid1"), zero.alias("pid2"), "conv_id", "n_convs",
        zero.alias("words"), "rows")
    nodes = staged(below.unionByName(root), f"{out}/nodes").select(
        "*", zero.alias("n_children"), zero.alias("n_leaves"), zero.alias("saved_tokens"))
    if bound is None:
        tasks = max(spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions")))
        bound = shard_bound(sized.agg(F.sum("len")).first()[0] or 0, tasks)
    is_heavy = (F.col("rows") > bound) | (F.col("depth") == 0)
    heavy = staged(nodes.where(is_heavy), f"{out}/heavy")

    # shards: every topmost light node with all below it
    tops = turns.join(checked(heavy.select(*key)), key, "left_anti").groupBy(F.col("c").alias("conv_id")).agg(
        F.min_by(F.struct(F.col("id1").alias("s1"), F.col("id2").alias("s2")), "depth").alias("shard"))
    light = nodes.where(~is_heavy).join(tops, "conv_id").repartition("shard")
    low = staged(_totals(light), f"{out}/light")

    # across shard roots: totals are added up per parent before they move
    def added(rows: DataFrame) -> DataFrame:
        return rows.where("not resolved").groupBy((F.col("depth") - 1).alias("depth"), F.col("pid1").alias("id1"), F.col("pid2").alias("id2")).agg(
            F.count(F.lit(1)).alias("a1"), F.sum("n_leaves").alias("a2"), F.sum("saved_tokens").alias("a3"))

    deepest = heavy.agg(F.max("depth")).first()[0] or 0
    swept, last = [], low
    for i in range(deepest // band, -1, -1):
        here = heavy.where((F.col("depth") >= i * band) & (F.col("depth") < (i + 1) * band))
        attached = added(low) if last is low else added(low).unionByName(added(last)).groupBy(*key).agg(*[F.sum(c).alias(c) for c in ("a1", "a2", "a3")])
        with_sums = here.join(attached, key, "left").withColumns(
            {c: F.coalesce(a, F.lit(0)) for c, a in (("n_children", "a1"), ("n_leaves", "a2"), ("saved_tokens", "a3"))})
        last = staged(_totals(with_sums.coalesce(1)), f"{out}/heavy-{i}")
        swept.append(last)

    rows = low.where("resolved")
    for part in swept:
        rows = rows.unionByName(part.where("resolved"))
    parents = checked(heavy.select((F.col("depth") + 1).alias("depth"), F.col("id1").alias("pid1"), F.col("id2").alias("pid2"),
                                   F.col("conv_id").alias("of")))
    open_ = low.where("not resolved")
    for part in swept:
        open_ = open_.unionByName(part.where("not resolved"))
    named = open_.join(parents, ["depth", "pid1", "pid2"], "left").withColumn("parent_conv_id", F.col("of")).select(*rows.columns)
    return rows.unionByName(named).join(_ends(sized, turns), key, "left").select(
        "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens",
        F.coalesce("ends_sha256", F.sha2(F.lit(""), 256)).alias("ends_sha256"))


def op11_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every node of the trie of all rebuilt conversations."""
    return conversation_trie(table(spark, sf_dir, "conversations"))


_CRC_STEP = "CASE WHEN {0} % 2 = 1 THEN xor({0} // 2, 3988292384) ELSE {0} // 2 END"


def _crc32(text: str) -> str:
    """CRC-32 of an ASCII text in SQL, from its definition: every byte is folded in, then eight shifts."""
    shifts = f"list_reduce(range(8), lambda s, i: {_CRC_STEP.format('s')}, xor(a, b))"
    codes = f"list_transform(string_split({text}, ''), lambda ch: CAST(ascii(ch) AS BIGINT))"
    return f"xor(list_reduce({codes}, lambda a, b: {shifts}, CAST(4294967295 AS BIGINT)), CAST(4294967295 AS BIGINT))"


def oracle() -> str:
    """The trie by lists of whole prefixes: nodes are grouped by the list itself, subtrees joined by list comparison."""
    return f"""WITH src AS (SELECT conv_id AS c, coalesce(role, '') AS role, coalesce(text, '') AS text,
        row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, '')) AS pos FROM conversations WHERE conv_id IS NOT NULL),
      conv AS (SELECT c, list(struct_pack(role := role, text := text) ORDER BY pos) AS t, {_crc32('CAST(c AS VARCHAR)')} % {BORROWED} AS h FROM src GROUP BY c),
      built AS (SELECT a.c, list_concat(coalesce(list_slice(b.t, 1, a.h), []), list_slice(a.t, a.h + 1, len(a.t))) AS t
        FROM conv a LEFT JOIN conv b ON b.c = a.c - a.c % {GROUP}),
      pre AS (SELECT c, len(t) AS n, unnest(range(0, len(t) + 1)) AS d, t FROM built),
      px AS (SELECT c, n, d, list_slice(t, 1, d) AS p FROM pre),
      node AS (SELECT p, d, min(c) AS conv_id, count(*) AS n_convs, string_agg(CAST(c AS VARCHAR), ',' ORDER BY c) FILTER (WHERE n = d) AS ends
        FROM px GROUP BY p, d),
      val AS (SELECT *, CASE WHEN d = 0 THEN 0 ELSE (n_convs - 1) * len(regexp_extract_all(p[d].text, '[^\\x20\\x09-\\x0D]+')) END AS own,
        list_slice(p, 1, d - 1) AS up FROM node),
      kids AS (SELECT up AS p, d - 1 AS d, count(*) AS n_children FROM val WHERE d > 0 GROUP BY 1, 2),
      full_node AS (SELECT v.*, coalesce(k.n_children, 0) AS n_children FROM val v LEFT JOIN kids k ON k.p = v.p AND k.d = v.d),
      anc AS (SELECT list_slice(p, 1, e) AS p, e AS d, own, n_children FROM (SELECT *, unnest(range(0, d + 1)) AS e FROM full_node)),
      tot AS (SELECT p, d, sum(own) AS saved, count(*) FILTER (WHERE n_children = 0) AS leaves FROM anc GROUP BY p, d)
    SELECT n.conv_id, CAST(n.d AS BIGINT) AS depth, u.conv_id AS parent_conv_id, n.n_convs, CAST(n.n_children AS BIGINT) AS n_children,
      CAST(t.leaves AS BIGINT) AS n_leaves, CAST(t.saved AS BIGINT) AS saved_tokens, sha256(coalesce(n.ends, '')) AS ends_sha256
    FROM full_node n JOIN tot t ON t.p = n.p AND t.d = n.d LEFT JOIN node u ON n.d > 0 AND u.p = n.up AND u.d = n.d - 1"""
