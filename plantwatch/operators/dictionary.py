"""Dictionaries: every word of some text columns with its place in alphabetical order.

Distinct words are dealt to ranges by a range shuffle and sorted there. A word's code is its place
in its range plus the number of words in the ranges before it, which a table of one row per range
gives. No task sees a whole vocabulary and none reaches the driver; the dictionary is stored as a
table and joined.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from plantwatch.operators.lookup import lookup_join
from plantwatch.session import fresh_path, materialise

RANGE_BITS = 33  # of monotonically increasing ids, below those of the partition


@dataclass(frozen=True)
class Dictionary:
    """A stored dictionary: words and bytes of each column, and where the table lies."""

    path: str
    words: dict[str, int]
    bytes: dict[str, int]

    def table(self, spark: SparkSession) -> DataFrame:
        return spark.read.schema("column string, word string, code long").parquet(self.path)

    def codes(self, spark: SparkSession, column: str) -> DataFrame:
        return self.table(spark).filter(F.col("column") == column).select("word", "code")

    def head(self, spark: SparkSession, column: str, most: int) -> list[str]:
        """The first words of a column in order; at most ``most`` of them."""
        rows = self.codes(spark, column).filter(F.col("code") < most).orderBy("code").collect()
        return [r["word"] for r in rows]

    def encode(self, df: DataFrame, column: str, output: str) -> DataFrame:
        """Add the code of each word, null for a word the dictionary lacks.

        Small dictionaries are broadcast, others joined by a shuffle (see ``lookup_join``).
        """
        codes = self.codes(df.sparkSession, column).select(F.col("word").alias("_word"), F.col("code").alias(output))
        rows = df.withColumn("_word", F.col(f"`{column}`").cast("string"))
        return lookup_join(rows, codes, "_word", "left", self.bytes.get(column, 0)).drop("_word")

    def copied(self, spark: SparkSession, path: str) -> "Dictionary":
        self.table(spark).write.mode("overwrite").parquet(path)
        return Dictionary(path, self.words, self.bytes)


def build_dictionary(df: DataFrame, columns: list[str]) -> Dictionary:
    """The dictionary of several columns, from one pass over them; gaps have no code."""
    spark = df.sparkSession
    path = fresh_path(spark, "dictionary")
    if not columns:
        spark.createDataFrame([], "column string, word string, code long").write.parquet(path)
        return Dictionary(path, {}, {})
    pairs = F.array(*[
        F.struct(F.lit(c).alias("column"), F.col(f"`{c}`").cast("string").alias("word")) for c in columns
    ])
    # Distinct in each map task first, so frequent words are not shuffled row by row.
    words = df.select(F.inline(pairs)).filter("word IS NOT NULL").distinct()
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    placed = materialise(
        words.repartitionByRange(tasks, "column", "word").sortWithinPartitions("column", "word")
        .withColumn("place", F.monotonically_increasing_id()), "words")
    ranges = placed.withColumn("range", F.shiftright("place", RANGE_BITS)).groupBy("column", "range").agg(
        F.count("*").alias("words"), F.min("place").alias("first"),
        F.sum(F.octet_length("word") + 24).alias("bytes"))
    before = Window.partitionBy("column").orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    offsets = materialise(  # one row per column and range
        ranges.withColumn("offset", F.coalesce(F.sum("words").over(before), F.lit(0))), "ranges")
    (
        placed.withColumn("range", F.shiftright("place", RANGE_BITS))
        .join(F.broadcast(offsets.drop("words", "bytes")), ["column", "range"])
        .select("column", "word", (F.col("offset") + F.col("place") - F.col("first")).alias("code"))
        .write.parquet(path)
    )
    sizes = offsets.groupBy("column").agg(F.sum("words").alias("words"), F.sum("bytes").alias("bytes")).collect()
    return Dictionary(path, {r["column"]: r["words"] for r in sizes}, {r["column"]: r["bytes"] for r in sizes})
