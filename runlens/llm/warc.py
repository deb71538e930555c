"""Operator 7 — WARC archives with a two-level capture index.

Writing: every page becomes one gzip-member WARC/1.1 record. Of pages with
byte-equal payloads the one with the largest id is a ``response``, the others
are ``revisit`` records that name it. Index: captures are sorted by their
reversed-host URL key, cut into compressed blocks, and a sparse directory
(first and last key, file, offset, length of each block) is kept beside them.
Reading: a block is found by binary search in the directory, its lines give
the byte range of each record, and only those ranges are read.

Spark does the grouping, the joins and the global sort; tasks write and read
their own byte ranges in the shared folder. Each attempt of a task writes to a
file name of its own, and only files named by the committed entry table are
ever read, so a lost executor leaves unused files at worst.

Defined results: a null payload is the empty payload; a null URL has the empty
key; a null page id never wins against an id, and pages whose ids are all null
are responses; rows that repeat the winning page (same id and payload) are
responses too; an empty table gives an empty archive.
"""

from __future__ import annotations

import base64
import bisect
import hashlib
import uuid
import zlib
from collections.abc import Iterator
from urllib.parse import urlsplit

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from runlens.llm.common import shared_fs, staged, table, work_dir

ENTRY = "urlkey string, page_id long, record_type string, refers_to long, file string, offset long, length long"
DIRECTORY = "first_key string, last_key string, n_captures long, file string, offset long, length long"
CAPTURE = ("page_id long, url string, urlkey string, record_type string, refers_to long, payload_bytes long, "
           "payload_digest string, payload binary")
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


def url_key(url: str | None) -> str:
    """Sort key of a URL: host labels reversed, then path and query; no scheme, default port or fragment."""
    if not url:
        return ""
    try:
        parts = urlsplit(url.strip())
        host, port = (parts.hostname or ""), parts.port
    except ValueError:
        return url.strip().lower()
    if not host:
        return url.strip().lower()
    tail = f":{port}" if port and (parts.scheme.lower(), port) not in (("http", 80), ("https", 443)) else ""
    return ",".join(reversed(host.split("."))) + tail + ")" + (parts.path or "/") + (f"?{parts.query}" if parts.query else "")


def _sha1_base32(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def _record(page_id, url, payload: bytes, leader, day: str) -> bytes:
    """One WARC record as a gzip member; ``leader`` is the page a revisit refers to (None: a response)."""
    fields = [
        ("WARC-Type", "response" if leader is None else "revisit"),
        ("WARC-Record-ID", f"<urn:page:{'' if page_id is None else page_id}>"),
        ("WARC-Date", day),
        ("WARC-Target-URI", "" if url is None else " ".join(url.split())),
        ("WARC-Payload-Digest", "sha1:" + _sha1_base32(payload)),
        ("X-Payload-Bytes", str(len(payload))),
    ]
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http + payload
    if leader is not None:
        fields += [("WARC-Profile", REVISIT_PROFILE), ("WARC-Refers-To", f"<urn:page:{leader}>")]
        block = http
    fields += [("Content-Type", "application/http; msgtype=response"), ("Content-Length", str(len(block)))]
    head = "WARC/1.1\r\n" + "".join(f"{k}: {v}\r\n" for k, v in fields) + "\r\n"
    packer = zlib.compressobj(4, zlib.DEFLATED, 31)
    return packer.compress(head.encode() + block + b"\r\n\r\n") + packer.flush()


def parse_record(member: bytes) -> tuple[dict[str, str], bytes]:
    """Header fields and payload (after the HTTP head) of one gzip-member record."""
    raw = zlib.decompress(member, 31)
    head, _, rest = raw.partition(b"\r\n\r\n")
    fields = dict(x.split(": ", 1) if ": " in x else (x.rstrip(":"), "") for x in head.decode().split("\r\n")[1:])
    block = rest[: int(fields["Content-Length"])]
    return fields, block.partition(b"\r\n\r\n")[2]


def _page_of(urn: str) -> int | None:
    digits = urn.strip("<>").rpartition(":")[2]
    return int(digits) if digits else None


def _writer(out_dir: str, day: str, max_file_bytes: int):
    schema = pa.schema([("urlkey", pa.string()), ("page_id", pa.int64()), ("record_type", pa.string()),
                        ("refers_to", pa.int64()), ("file", pa.string()), ("offset", pa.int64()), ("length", pa.int64())])

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, root = shared_fs(out_dir)
        out = name = None
        at = 0
        for batch in batches:
            rows = []
            for page_id, url, payload, leader in zip(*(c.to_pylist() for c in batch.columns)):
                if out is None or at >= max_file_bytes:
                    if out is not None:
                        out.close()
                    name, at = f"{uuid.uuid4().hex}.warc.gz", 0
                    fs.create_dir(root, recursive=True)
                    out = fs.open_output_stream(f"{root}/{name}", compression=None)
                member = _record(page_id, url, payload.encode(), leader, day)
                out.write(member)
                rows.append((url_key(url), page_id, "response" if leader is None else "revisit", leader, name, at, len(member)))
                at += len(member)
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), schema)], schema=schema)
        if out is not None:
            out.close()

    return write


def write_archive(pages: DataFrame, out_dir: str, id_col: str = "page_id", url_col: str = "url",
                  payload_col: str = "html", min_revisit_bytes: int = 0, day: str = "2024-01-01T00:00:00Z",
                  max_file_bytes: int = 1 << 30) -> DataFrame:
    """Write the records of ``pages`` below ``out_dir/archive``; returns the committed entry table."""
    src = pages.select(F.col(id_col).cast("long").alias("page_id"), F.col(url_col).cast("string").alias("url"),
                       F.coalesce(F.col(payload_col).cast("string"), F.lit("")).alias("payload"))
    src = src.withColumn("same", F.struct(F.sha1("payload").alias("sha"), F.octet_length("payload").alias("n")))
    # equal payloads: one row per digest after map-side combination, joined back only where it repeats
    groups = (src.where(F.col("same.n") >= min_revisit_bytes).groupBy("same")
              .agg(F.max("page_id").alias("last"), F.count(F.lit(1)).alias("copies"))
              .where("copies > 1 and last is not null").select("same", "last"))
    leader = F.when(F.col("page_id").isNull() | (F.col("page_id") < F.col("last")), F.col("last"))
    joined = src.join(groups, "same", "left").select("page_id", "url", "payload", leader.alias("leader"))
    entries = joined.mapInArrow(_writer(f"{out_dir}/archive", day, max_file_bytes), ENTRY)
    return staged(entries, f"{out_dir}/entries")


def build_index(entries: DataFrame, out_dir: str, block_lines: int = 1000) -> DataFrame:
    """Sort the captures by key into compressed blocks; returns the sparse block directory."""

    def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, root = shared_fs(f"{out_dir}/index")
        name, at, out = f"{uuid.uuid4().hex}.cdx", 0, None
        held: list[tuple] = []

        def flush():
            nonlocal at, out
            if out is None:
                fs.create_dir(root, recursive=True)
                out = fs.open_output_stream(f"{root}/{name}", compression=None)
            packed = zlib.compress("\n".join("\t".join("" if v is None else str(v).replace("\t", "%09").replace("\n", "%0A")
                                                       for v in row) for row in held).encode(), 6)
            out.write(packed)
            row = (held[0][0], held[-1][0], len(held), name, at, len(packed))
            at += len(packed)
            held.clear()
            return row

        found = []
        for batch in batches:
            for row in zip(*(c.to_pylist() for c in batch.columns)):
                held.append(row)
                if len(held) >= block_lines:
                    found.append(flush())
        if held:
            found.append(flush())
        if out is not None:
            out.close()
        if found:
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*found)],
                                             names=["first_key", "last_key", "n_captures", "file", "offset", "length"])

    ordered = entries.repartitionByRange("urlkey", "page_id").sortWithinPartitions("urlkey", "page_id")
    return staged(ordered.mapInArrow(blocks, DIRECTORY), f"{out_dir}/directory")


def _block_lines(fs, root: str, file: str, offset: int, length: int) -> list[list[str]]:
    with fs.open_input_file(f"{root}/index/{file}") as f:
        text = zlib.decompress(f.read_at(length, offset)).decode()
    return [line.split("\t") for line in text.split("\n")]


def _captures(fs, root: str, lines: list[list[str]], keep_payload: bool) -> Iterator[tuple]:
    """Range-read the records of index lines, file by file in offset order."""
    last, handle = None, None
    for urlkey, _, _, _, file, offset, length in sorted(lines, key=lambda x: (x[4], int(x[5]))):
        if file != last:
            if handle is not None:
                handle.close()
            last, handle = file, fs.open_input_file(f"{root}/archive/{file}")
        fields, payload = parse_record(handle.read_at(int(length), int(offset)))
        kind = fields["WARC-Type"]
        if kind == "response":
            n, digest, refers = len(payload), _sha1_base32(payload), None
        else:
            n, digest = int(fields["X-Payload-Bytes"]), fields["WARC-Payload-Digest"].partition(":")[2]
            refers = _page_of(fields["WARC-Refers-To"])
        yield (_page_of(fields["WARC-Record-ID"]), fields["WARC-Target-URI"], urlkey, kind, refers, n, digest,
               payload if keep_payload and kind == "response" else None)
    if handle is not None:
        handle.close()


def _capture_batch(rows: list[tuple]) -> pa.RecordBatch:
    types = [("page_id", pa.int64()), ("url", pa.string()), ("urlkey", pa.string()), ("record_type", pa.string()),
             ("refers_to", pa.int64()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()),
             ("payload", pa.binary())]
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, (_, t) in zip(zip(*rows), types)], names=[n for n, _ in types])


def read_archive(spark: SparkSession, out_dir: str, keep_payload: bool = False) -> DataFrame:
    """Every capture of an archive: index blocks are dealt to tasks, each range-reads its own records."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, root = shared_fs(out_dir)
        for batch in batches:
            for file, offset, length in zip(*(batch.column(c).to_pylist() for c in ("file", "offset", "length"))):
                rows = list(_captures(fs, root, _block_lines(fs, root, file, offset, length), keep_payload))
                yield _capture_batch(rows)

    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    directory = spark.read.schema(DIRECTORY).parquet(f"{out_dir}/directory")
    return directory.repartition(n).mapInArrow(read, CAPTURE)


def lookup(urls: DataFrame, out_dir: str, url_col: str = "url", keep_payload: bool = True) -> DataFrame:
    """Captures of the given URLs. Each task holds the sparse directory (one row per
    ``block_lines`` captures), binary-searches it and reads only the blocks and records it needs."""

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import pyarrow.parquet as pq

        fs, root = shared_fs(out_dir)
        rows = sorted(map(tuple, (r.values() for r in pq.read_table(f"{root}/directory", filesystem=fs).to_pylist())))
        first = [r[0] for r in rows]
        for batch in batches:
            wanted = sorted({url_key(u) for u in batch.column(0).to_pylist()})
            for key in wanted:
                at = max(0, bisect.bisect_left(first, key) - 1)
                lines = []
                while at < len(rows) and rows[at][0] <= key:
                    if rows[at][1] >= key:
                        lines += [x for x in _block_lines(fs, root, *rows[at][3:]) if x[0] == key]
                    at += 1
                if lines:
                    yield _capture_batch(list(_captures(fs, root, lines, keep_payload)))

    return urls.select(F.col(url_col)).distinct().mapInArrow(find, CAPTURE)


def op7_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Write all pages as WARC records, index them, and read every record back through the index."""
    out = work_dir(spark, "warc")
    build_index(write_archive(table(spark, sf_dir, "pages"), out), out)
    return read_archive(spark, out).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")
