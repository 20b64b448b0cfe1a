"""Raw documents to piece ids in five stages, each written and read again.

Quality first, as it needs no shuffle and rejects the most; exact copies before near
ones, which cost more per row; decontamination of what stays; piece ids last. A
stage judges all that its predecessor kept.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from offerloom.llm import decontamination, exact_dedup, near_dedup, pieces, quality
from offerloom.llm.frames import table
from offerloom.llm.queries import piece_model
from offerloom.session import staged


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop what the quality classifier rejects."""
    return quality.keep_good(docs)


def exact_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep one row of each text."""
    return exact_dedup.exact_dedup(docs)


def near_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep one document of each group of near copies: five words, similarity 0.8."""
    return near_dedup.near_dedup(docs, size=5)


def benchmark_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents that hold a benchmark window."""
    return decontamination.drop_contaminated(docs, table(spark, sf_dir, "benchmark"))


def pieces_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """(doc_id, ids, decoded) of what is left."""
    return pieces.encode(docs, piece_model())


STAGES = [
    ("quality classifier", quality_stage),
    ("exact dedup", exact_stage),
    ("minhash near-dedup", near_stage),
    ("benchmark decontamination", benchmark_stage),
    ("sentencepiece", pieces_stage),
]

# A trained classifier and the merges of a vocabulary have no SQL; tests compare with plain Python.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the whole documents table."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = staged(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return docs
