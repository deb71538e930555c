"""Operator 6 — token ids as ORC.

Documents are encoded with a public byte-level BPE vocabulary, an end id is
appended, and the ids are written in ascending document order as ORC: integer
run-length encoding of the ids (ORC's own), row indexes every
``row_index_stride`` rows and a Bloom filter on the document ids. A reader
that filters on ``doc_id`` prunes files, stripes and row groups from metadata;
a full read is parallel over stripes. The position of a document in the whole
id stream is rebuilt from the files: totals per file in file order, then a
running sum inside each file.

A text is cut where the vocabulary's own split pattern always cuts (after a
word, at white space and punctuation) and each distinct chunk is encoded once
by the library; the pattern's pieces are encoded independently of each other,
so the ids are those of the whole text (the test holds both against each
other). Special-token strings inside a text are ordinary text.

Defined results: a null text is empty and holds the end id alone; a null
``doc_id`` sorts first; repeated rows are kept, each with its own ids.
"""

from __future__ import annotations

import os
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window
from pyspark.sql import functions as F

from runlens.llm.common import staged, table, work_dir
from runlens.llm.ragged import PUNCTUATION, Chunks, groups, hold

TOKENS = "doc_id long, row long, ids array<int>"  # row: place in the file
_state: dict = {}


def _encoder(vocab: str):
    """Texts -> (ids in a row, number of ids of each text); made once per Python worker."""
    hold(_state)
    if _state.get("vocab") != vocab:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        tok = Tokenizer.from_file(vocab)
        special = [t.content.encode() for t in tok.get_added_tokens_decoder().values()]

        def make(chunks: list[bytes]) -> list[bytes]:
            coded = tok.encode_batch_fast([c.decode() for c in chunks], add_special_tokens=False)
            return [np.asarray(e.ids, "<u4").tobytes() for e in coded]

        # the split pattern never joins a letter to punctuation or a character to white space after it
        chunks = Chunks(make, "<u4", tails=PUNCTUATION)

        def encode(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
            whole = [i for i, t in enumerate(texts) if any(x in t for x in special)]
            if not whole:
                return chunks(texts)
            ids, counts = chunks([b"" if i in whole else t for i, t in enumerate(texts)])
            lists = np.split(ids, np.cumsum(counts)[:-1])
            for i, e in zip(whole, tok.encode_batch_fast([texts[i].decode() for i in whole], add_special_tokens=False)):
                lists[i] = np.asarray(e.ids, "<u4")
                counts[i] = len(lists[i])
            return np.concatenate(lists), counts

        _state.update(vocab=vocab, encode=encode)
    return _state["encode"]


def _encode(vocab: str, end_id: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, row = _encoder(vocab), 0
        for batch in batches:
            for start, texts in groups(batch.column(1).cast(pa.binary()).to_pylist(), 2 << 20):
                ids, counts = encode(texts)
                offsets = np.concatenate([[0], np.cumsum(counts + 1)]).astype(np.int32)
                values = np.full(offsets[-1], end_id, np.int32)
                inside = np.ones(len(values), bool)
                inside[offsets[1:] - 1] = False
                values[inside] = ids
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(start, len(texts)), pa.array(np.arange(row, row + len(texts))),
                     pa.ListArray.from_arrays(pa.array(offsets), pa.array(values))], names=["doc_id", "row", "ids"])
                row += len(texts)

    return run


def write_tokens(docs: DataFrame, path: str, vocab: str, end_id: int = 0, id_col: str = "doc_id", text_col: str = "text",
                 row_index_stride: int = 1000, stripe_bytes: int = 16 << 20) -> None:
    """Encode ``docs`` and write ORC files whose names sort in ascending document order."""
    src = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    n = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    order = [F.col("doc_id").asc_nulls_first(), F.xxhash64("text")]
    ordered = src.repartitionByRange(n, *order).sortWithinPartitions(*order)
    (ordered.mapInArrow(_encode(vocab, end_id), TOKENS).write
     .option("orc.compress", "LZ4").option("orc.stripe.size", str(stripe_bytes))
     .option("orc.create.index", "true").option("orc.row.index.stride", str(row_index_stride))
     .option("orc.bloom.filter.columns", "doc_id").option("orc.bloom.filter.fpp", "0.01").orc(path))


def read_tokens(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(TOKENS).orc(path)


def _digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        lists = batch.column(3)
        offsets, values = np.asarray(lists.offsets), np.ascontiguousarray(np.asarray(lists.values), "<i4")
        crc = [zlib.crc32(values[a:b]) for a, b in zip(offsets[:-1], offsets[1:])]
        yield pa.RecordBatch.from_arrays([*batch.columns[:3], pa.array(np.diff(offsets).astype(np.int64)), pa.array(crc, pa.int64())],
                                         names=["file", "doc_id", "row", "n_tokens", "ids_crc32"])


def token_positions(tokens: DataFrame, out_dir: str) -> DataFrame:
    """Per document of written ids: start in the whole id stream, length, crc32 of the ids.
    ``out_dir`` (shared) holds the narrow digest rows, so the ids are read once."""
    per_doc = staged(tokens.select(F.col("_metadata.file_name").alias("file"), "doc_id", "row", "ids").mapInArrow(
        _digest, "file string, doc_id long, row long, n_tokens long, ids_crc32 long"), out_dir)
    files = per_doc.groupBy("file").agg(F.sum("n_tokens").alias("n"))
    base = files.select("file", (F.sum("n").over(Window.orderBy("file")) - F.col("n")).alias("base"))  # one row a file
    inside = Window.partitionBy("file").orderBy("row").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    before = per_doc.withColumn("within", F.sum("n_tokens").over(inside) - F.col("n_tokens"))
    return before.join(base, "file").select("doc_id", (F.col("base") + F.col("within")).alias("start"), "n_tokens", "ids_crc32")


def op6_token_output(spark: SparkSession, sf_dir: str, vocab: str | None = None) -> DataFrame:
    """Encode every document, write ORC, read the files back."""
    import public_tokenizers

    path = work_dir(spark, "tokens-orc")
    write_tokens(table(spark, sf_dir, "documents"), path, vocab or public_tokenizers.path("byte_bpe_50k.json"))
    return token_positions(read_tokens(spark, path), f"{path}-digest")
