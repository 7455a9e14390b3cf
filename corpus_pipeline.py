"""The corpus pipeline: documents to packed training sequences.

Each stage takes (spark, docs, sf_dir) and works on all that the one before it kept. All but the
last return the columns of documents; the last returns the pieces of the packed sequences.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from plantwatch.llm.byte_cnn import in_known_language
from plantwatch.llm.line_runs import without_repeated_lines
from plantwatch.llm.ngram_join import without_near_duplicates
from plantwatch.llm.packing import pack
from plantwatch.llm.wu_manber import decontaminate
from plantwatch.session import materialise

NEAR_WORDS = 5
NEAR_PERCENT = 80


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops texts without letters and those of no language that could be told."""
    return in_known_language(docs)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Takes lines that many documents hold out of all but one."""
    return without_repeated_lines(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps the document with the least id of each group of near copies."""
    return without_near_duplicates(docs, size=NEAR_WORDS, percent=NEAR_PERCENT)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents in which a window of a benchmark item occurs."""
    items = spark.read.parquet(f"{sf_dir.rstrip('/')}/benchmark.parquet").select("item_id", "text")
    return decontaminate(docs, items)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Packs what is left into sequences."""
    return pack(docs.select("doc_id", "text"), public_tokenizers.path("word_bpe_49k.json"))


STAGES = [
    ("language_id", language_id),
    ("line_dedup", line_dedup),
    ("near_duplicates", near_duplicates),
    ("decontamination", decontamination),
    ("packing", packing),
]

# Languages are told by a trained network, which SQL cannot express.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir.rstrip('/')}/documents.parquet")
    *inner, (_, last) = STAGES
    for name, stage in inner:
        docs = materialise(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return last(spark, docs, sf_dir)
