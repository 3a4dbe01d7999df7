"""Helpers the training-data operators share: tables, words, reliable cuts of lineage."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from daybook.session import checkpoint_root

# The six white-space characters that separate words.
WHITE_SPACE = " \t\n\x0b\x0c\r"
WORD = r"[^\x20\x09-\x0D]+"
NOT_WORD = r"[\x20\x09-\x0D]+"

#: Columns of the documents table, in order.
DOCUMENT_COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def cut(df: DataFrame) -> DataFrame:
    """``df`` computed once and kept in the shared checkpoint folder.

    Reliable (never local) checkpoint: a lost executor costs a re-read.  Also
    keeps a costly scan from being repeated by each use of its result.
    """
    checkpoint_root(df.sparkSession)
    return df.checkpoint(eager=True)


def words(text: Column) -> Column:
    """Array of the words of a text; empty for null and for word-less texts."""
    trimmed = F.btrim(F.coalesce(text, F.lit("")), F.lit(WHITE_SPACE))
    return F.when(trimmed == "", F.array().cast("array<string>")).otherwise(F.split(trimmed, NOT_WORD))


def word_count(text: Column) -> Column:
    """Number of words as long; 0 for null."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def sample_fraction(rows: int, bound: int) -> float:
    """Fraction that leaves about ``bound`` of ``rows`` rows."""
    return 1.0 if rows <= bound else bound / rows


def hash_sample(df: DataFrame, key: Column, fraction: float) -> DataFrame:
    """Rows whose hashed key falls under ``fraction``: the same ones on every run."""
    if fraction >= 1.0:
        return df
    return df.where(F.pmod(F.xxhash64(key, F.lit("sample")), F.lit(1 << 30)) < int(math.ceil(fraction * (1 << 30))))


def forget(spark: SparkSession, path: str) -> None:
    """Deletes a scratch folder of this run, in whatever store it is."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).delete(folder, True)
