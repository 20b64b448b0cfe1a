"""The registered queries of this subpackage, each over its whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from offerloom.llm import (
    decontamination,
    exact_dedup,
    hard_negatives,
    licences,
    near_dedup,
    passages,
    phrases,
    pieces,
    quality,
    quotes,
    site_lines,
    urls,
    word_bpe,
)
from offerloom.llm.frames import table


def piece_model() -> str:
    """The piece vocabulary's file; its place is a parameter of `pieces.encode`."""
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


def word_vocabulary() -> str:
    """The word vocabulary's file; its place is a parameter of `word_bpe.encode`."""
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def op1_substring_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return passages.report(passages.repeats(table(spark, folder, "documents")))


def op2_quotation_linking(spark: SparkSession, folder: str) -> DataFrame:
    return quotes.link_conversations(table(spark, folder, "conversations"))


def op3_site_line_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return site_lines.report(site_lines.site_dedup(table(spark, folder, "pages")))


def op4_benchmark_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    docs, items = table(spark, folder, "documents"), table(spark, folder, "benchmark")
    return decontamination.report(decontamination.contamination(docs, items))


def op5_sentencepiece(spark: SparkSession, folder: str) -> DataFrame:
    return pieces.report(pieces.encode(table(spark, folder, "documents"), piece_model()))


def op6_quality_classifier(spark: SparkSession, folder: str) -> DataFrame:
    return quality.classify(table(spark, folder, "documents"))


def op7_minhash_near_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return near_dedup.report(near_dedup.near_classes(table(spark, folder, "documents"), size=4))


def op8_url_filters(spark: SparkSession, folder: str) -> DataFrame:
    return urls.filter_urls(table(spark, folder, "pages"))


def op9_exact_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return exact_dedup.report(table(spark, folder, "documents"))


def op10_license_scans(spark: SparkSession, folder: str) -> DataFrame:
    known = licences.known_licences(spark)
    return licences.report(licences.scan(table(spark, folder, "documents"), known))


def op11_word_bpe(spark: SparkSession, folder: str) -> DataFrame:
    return word_bpe.report(word_bpe.encode(table(spark, folder, "documents"), word_vocabulary()))


def op12_phrase_collocations(spark: SparkSession, folder: str) -> DataFrame:
    return phrases.collocations(table(spark, folder, "documents"))


def op13_hard_negatives(spark: SparkSession, folder: str) -> DataFrame:
    rows = table(spark, folder, "embeddings")
    # the labels that the query asks for: those of every seventh id are moved on by one
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives.hard_negatives(rows.withColumn("label", moved), anchors=F.col("vec_id") % 100 == 0)


def registered() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {name: f for name, f in globals().items() if name.startswith("op") and callable(f)}
