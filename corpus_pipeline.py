"""A training corpus in five stages, each a function (spark, docs, sf_dir) -> DataFrame.

quality -> near-dedup -> decontamination -> secrets -> packing.  Stages keep
the columns of documents, others included; the last returns packed pieces.  The
labels and the benchmark come from sf_dir.  An empty table gives empty results.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sparquill.llm import decontaminate, overlap, packing, quality, secrets
from sparquill.llm.common import remove, scratch


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier accepts; it is trained on the labelled ones among docs.

    Null texts are scored as empty ones, repeated rows alike, and null ids are
    never labels.  Without labels all score 0.5, below the threshold, and go.
    """
    return quality.keep_good(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies (Jaccard similarity of five-word shingles of 0.8 or more): the smallest doc_id.

    Texts without words are copies of each other.  Repeated rows of the kept
    doc_id all stay, and rows without doc_id stay.
    """
    return overlap.keep_first(docs)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without any benchmark window; texts without words have none and stay."""
    return decontaminate.decontaminate(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def redact_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with secrets replaced by a mark and n_chars counted again; null texts stay null, with null n_chars."""
    return secrets.redact(docs).withColumn("n_chars", F.char_length("text").cast("long"))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of token sequences; a null or empty text is its end token alone, and every row is packed, repeated or not."""
    return packing.pack(docs)


STAGES = [
    ("quality classifier", keep_quality),
    ("near-dedup", drop_near_copies),
    ("benchmark decontamination", drop_contaminated),
    ("secret scans", redact_secrets),
    ("packing", pack),
]

#: SQL can express neither the classifier nor the tokens; tests compare with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents; each stage's result is written and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    before = None
    for _, stage in STAGES:
        folder = scratch(spark, "stage")
        stage(spark, docs, sf_dir).write.parquet(folder)
        docs = spark.read.parquet(folder)
        if before:  # the stage after it is written, so nothing reads it any more
            remove(spark, before)
        before = folder
    return docs
