"""Helpers shared by the corpus operators: tables, the shared folder, file access from tasks."""

from __future__ import annotations

import re
import uuid

from pyspark.sql import DataFrame, SparkSession

from pyspark.sql import functions as F

from runlens.session import shared_dir

BROADCAST_ROWS = 2_000_000  # rows of one or two numbers: 32 MB at most
_WORD = re.compile(r"[^\W_]+")


def words_of(text: str | None) -> list[str]:
    """Lower-case words: runs of letters and digits."""
    return _WORD.findall((text or "").lower())


def checked(keys: DataFrame, max_rows: int = BROADCAST_ROWS) -> DataFrame:
    """``keys`` (rows of a few numbers) marked for broadcast if a count shows that they are few;
    unmarked, so shuffled by a join, otherwise."""
    return F.broadcast(keys) if keys.limit(max_rows + 1).count() <= max_rows else keys


def free_name(name: str, columns: list[str]) -> str:
    """``name``, lengthened until no column has it."""
    taken = {c.lower() for c in columns}
    while name.lower() in taken:
        name += "_"
    return name


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def work_dir(spark: SparkSession, label: str) -> str:
    """A new folder name in the shared folder (``spark.checkpoint.dir``), one per call."""
    return f"{shared_dir(spark)}/{label}-{uuid.uuid4().hex}"


def staged(df: DataFrame, path: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back: cuts the lineage, survives lost executors."""
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def discard(spark: SparkSession, *paths: str) -> None:
    """Remove staged tables whose successor is written; what fails to go stays (no JVM gateway on the client)."""
    from runlens.sources.landing import Files

    try:
        files = Files(spark)
    except Exception:
        return
    for path in paths:
        files.delete(path)


def shared_fs(path: str):
    """(pyarrow file system, path in it) of a shared folder; used inside tasks."""
    from pyarrow import fs

    local = re.sub(r"^file:/+", "/", path)
    return (fs.LocalFileSystem(), local) if local.startswith("/") else fs.FileSystem.from_uri(path)
