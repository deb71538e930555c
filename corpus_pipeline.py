"""Corpus pipeline: five stages over ``documents``, each written as Parquet and reread as the next one's input.

toxicity          documents scored 0.5 or more are rejected
line dedup        recurring template lines go, ``n_chars`` follows the text
near dedup        one document of each near-duplicate class stays
decontamination   documents that contain a benchmark item are rejected
sentencepiece     the remaining documents with their piece ids, checked by decoding

The stages work on any rows of the documents table: null texts are empty texts,
repeated rows are kept by the first two stages and reduced to one by the third,
an empty table passes through, extra columns are carried along.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from runlens.llm import decontaminate, line_templates, near_dedup, sentencepiece_codec, toxicity
from runlens.llm.common import staged, table, work_dir


def reject_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    model = toxicity.fit(docs, table(spark, sf_dir, "labels"))
    return toxicity.score_documents(docs, model).where("toxic_score < 0.5").select(*docs.columns)


def dedup_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    out = line_templates.dedup_lines(docs).select(*docs.columns)
    return out.withColumn("n_chars", F.length("text").cast("long")) if "n_chars" in docs.columns else out


def dedup_near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return near_dedup.drop_near_duplicates(docs)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontaminate.drop_contaminated(docs, table(spark, sf_dir, "benchmark"))


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return sentencepiece_codec.encode_documents(docs, sentencepiece_codec.model_path())


STAGES = [
    ("toxicity", reject_toxic),
    ("line dedup", dedup_lines),
    ("near dedup", dedup_near),
    ("decontamination", drop_contaminated),
    ("sentencepiece", encode),
]

ORACLE_SQL = None  # learned scores and piece ids are no SQL; the stages are tested against brute force


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    out = work_dir(spark, "pipeline")
    for i, (_, stage) in enumerate(STAGES):
        docs = staged(stage(spark, docs, sf_dir), f"{out}/{i}")
    return docs
