"""Corpus pipeline: quality, near duplicates, personal data, mixing, encoding.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame, written as
Parquet and reread as the next stage's documents; all but the last return the
columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from daybook.llm import jaccard, mixing, pieces, pii, quality
from daybook.llm.common import read_table
from daybook.session import scratch_path


#: Bytes of rows that go to a Python worker at once.  Stages run one after the other in the same executors, where
#: the default (64 MB, and 10,000 rows) adds up to much of their memory.
BATCH_BYTES = 4 << 20


def _bounded(spark: SparkSession) -> None:
    """Batches to and from Python workers bounded by bytes, for this session."""
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the compression classifier accepts."""
    _bounded(spark)
    return quality.keep_good(docs, read_table(spark, sf_dir, "labels"))


def jaccard_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies."""
    _bounded(spark)
    return jaccard.keep_one(docs)


def pii_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts with personal data replaced."""
    return pii.redact(docs)


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix of sources takes them."""
    return mixing.mix_documents(docs)


def sentencepiece_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Piece ids of every document, with their round trip checked."""
    _bounded(spark)
    return pieces.op4_sentencepiece(docs)


STAGES = [
    ("quality classifier", quality_stage),
    ("n-gram Jaccard join", jaccard_stage),
    ("PII", pii_stage),
    ("mixing sources to target weights", mixing_stage),
    ("SentencePiece encoding and decoding", sentencepiece_stage),
]

#: Trained models and group closure have no SQL form; tests/llm/test_pipeline.py holds run() against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; what a stage returns is written and read again."""
    docs = read_table(spark, sf_dir, "documents")
    folder = scratch_path(spark, "pipeline")
    for k, (_, stage) in enumerate(STAGES):
        stage(spark, docs, sf_dir).write.parquet(f"{folder}/{k}")
        docs = spark.read.parquet(f"{folder}/{k}")
    return docs
