"""The numbered queries: each applies one operator to its whole table."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from plantwatch.llm.byte_cnn import HELD_OUT, identify, learn
from plantwatch.llm.frames import sha256
from plantwatch.llm.line_runs import dedup_lines
from plantwatch.llm.merkle import fingerprint_edits
from plantwatch.llm.ngram_join import near_duplicates
from plantwatch.llm.packing import pack
from plantwatch.llm.pii_spans import scan_private
from plantwatch.llm.reputation import judge_urls
from plantwatch.llm.secret_crf import learn as learn_secrets, scan
from plantwatch.llm.spill_align import align_tokens
from plantwatch.llm.substrings import dedup_substrings
from plantwatch.llm.turn_repair import damage, repair_conversations
from plantwatch.llm.warc import resolve
from plantwatch.llm.wu_manber import find_benchmark

Query = Callable[[SparkSession, str], DataFrame]


def _table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder.rstrip('/')}/{name}.parquet")


def op1_warc_revisits(spark: SparkSession, folder: str) -> DataFrame:
    return resolve(_table(spark, folder, "pages"))


def op2_suffix_automata(spark: SparkSession, folder: str) -> DataFrame:
    done = dedup_substrings(_table(spark, folder, "documents").select("doc_id", "text"), texts=False)
    return done.select(F.col("_id").alias("doc_id"), "n_words", "n_removed", "kept_sha256")


def op3_wu_manber(spark: SparkSession, folder: str) -> DataFrame:
    docs = _table(spark, folder, "documents").select("doc_id", "text")
    found = find_benchmark(docs, _table(spark, folder, "benchmark").select("item_id", "text"))
    return found.select(
        F.col("_id").alias("doc_id"),
        F.col("_words").alias("n_words"),
        F.size("_hits").cast("long").alias("n_hit"),
        F.size("_items").cast("long").alias("n_items"),
        sha256(F.array_join(F.array_sort("_items"), ",")).alias("items_sha256"),
        (F.size("_hits") > 0).alias("contaminated"),
    )


def op4_byte_cnn(spark: SparkSession, folder: str) -> DataFrame:
    docs = _table(spark, folder, "documents").select("doc_id", "text", "lang")
    remainder = F.pmod(F.crc32(F.coalesce(F.col("_id").cast("string"), F.lit("")).cast("binary")), F.lit(4))
    return identify(docs.select("doc_id", "text"), learn(docs)).select(
        F.col("_id").alias("doc_id"), (remainder == HELD_OUT).alias("held_out"),
        F.col("_lang").alias("lang_pred"), F.col("_score").alias("score"),
    )


def op5_secret_crf(spark: SparkSession, folder: str) -> DataFrame:
    docs = _table(spark, folder, "documents").select("doc_id", "text")
    return scan(docs, learn_secrets(docs))


def op6_merkle(spark: SparkSession, folder: str) -> DataFrame:
    return fingerprint_edits(_table(spark, folder, "documents").select("doc_id", "text"))


def op7_host_reputation(spark: SparkSession, folder: str) -> DataFrame:
    labels = _table(spark, folder, "labels")
    bad = ((F.col("toxic") == 1) | (F.col("quality") == 0)).cast("int")
    outcomes = labels.select(F.col("doc_id").alias("page_id"), bad.alias("bad"))
    return judge_urls(_table(spark, folder, "pages").select("page_id", "url"), outcomes)


def op8_line_runs(spark: SparkSession, folder: str) -> DataFrame:
    docs = _table(spark, folder, "documents").select("doc_id", "text")
    return dedup_lines(docs).select(
        F.col("_id").alias("doc_id"), "n_lines", "n_dropped", sha256(F.col("_kept")).alias("kept_sha256")
    )


def op9_cutting_stock(spark: SparkSession, folder: str) -> DataFrame:
    docs = _table(spark, folder, "documents").select("doc_id", "text")
    return pack(docs, public_tokenizers.path("word_bpe_49k.json"))


def op10_ngram_join(spark: SparkSession, folder: str) -> DataFrame:
    return near_duplicates(_table(spark, folder, "documents").select("doc_id", "text"))


def op11_private_spans(spark: SparkSession, folder: str) -> DataFrame:
    return scan_private(_table(spark, folder, "documents").select("doc_id", "text")).drop("base_spans")


def op12_astar_repair(spark: SparkSession, folder: str) -> DataFrame:
    conversations = _table(spark, folder, "conversations").select("conv_id", "turn", "role", "text")
    return repair_conversations(damage(conversations), conversations)


def op13_spill_alignment(spark: SparkSession, folder: str) -> DataFrame:
    docs = _table(spark, folder, "documents").select("doc_id", "text")
    return align_tokens(
        docs, public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model"))


def llm_queries() -> dict[str, Query]:
    return {
        "op1_warc_revisits": op1_warc_revisits,
        "op2_suffix_automata": op2_suffix_automata,
        "op3_wu_manber": op3_wu_manber,
        "op4_byte_cnn": op4_byte_cnn,
        "op5_secret_crf": op5_secret_crf,
        "op6_merkle": op6_merkle,
        "op7_host_reputation": op7_host_reputation,
        "op8_line_runs": op8_line_runs,
        "op9_cutting_stock": op9_cutting_stock,
        "op10_ngram_join": op10_ngram_join,
        "op11_private_spans": op11_private_spans,
        "op12_astar_repair": op12_astar_repair,
        "op13_spill_alignment": op13_spill_alignment,
    }
