"""Line dedup over levelled sorted runs of line hashes.

A run is a stored table of (key, n_docs, holder), one row per line key, hash-partitioned and
sorted by the key. A batch of documents becomes one run of level 0; as soon as a level has
``fanout`` runs they are merged into one run of the next level, so a key is rewritten about
log(batches) times and there are never more than ``fanout`` runs of a level. At the end all
runs are merged and the lines joined with the keys that enough documents hold.

Native: only DataFrame functions.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from plantwatch.llm.frames import ascii_lower, unwrap, wrap
from plantwatch.session import fresh_path

SPACES = " \t\n\x0b\x0c\r"
MIN_CHARS = 40
MIN_DOCS = 5
BATCHES = 8
FANOUT = 4
# Parts into which the lines of one key are split where they meet the verdict on it.
SALTS = 16


def line_key(line: Column) -> Column:
    """The line without ASCII white space at both ends, A-Z lower-cased."""
    return ascii_lower(F.btrim(line, F.lit(SPACES)))


def key_hash(line: Column) -> Column:
    """128 bits of the line's key."""
    return F.unhex(F.md5(line_key(line).cast("binary")))


class LineRuns:
    """The levels of runs below one folder, with the two things one does to them."""

    def __init__(self, spark: SparkSession, folder: str, fanout: int = FANOUT):
        self.spark, self.folder, self.fanout = spark, folder, fanout
        self.levels: list[list[str]] = []
        self.written = 0

    def _write(self, df: DataFrame, level: int) -> None:
        path = f"{self.folder}/run-{self.written}"
        self.written += 1
        df.sortWithinPartitions("key").write.parquet(path)
        while len(self.levels) <= level:
            self.levels.append([])
        self.levels[level].append(path)

    def _merge(self, paths: list[str]) -> DataFrame:
        runs = reduce(DataFrame.unionAll, map(self.spark.read.parquet, paths))
        return runs.groupBy("key").agg(
            F.sum("n_docs").alias("n_docs"), F.max("holder").alias("holder")
        )

    def add(self, lines: DataFrame) -> None:
        """``lines``: (key, doc_id). A document must be whole within one batch."""
        run = (
            lines.groupBy("key", "doc_id").agg(F.lit(1).alias("one"))
            .groupBy("key").agg(F.count("one").alias("n_docs"), F.max("doc_id").alias("holder"))
        )
        self._write(run, 0)
        level = 0
        while level < len(self.levels) and len(self.levels[level]) >= self.fanout:
            paths, self.levels[level] = self.levels[level], []
            self._write(self._merge(paths), level + 1)
            level += 1

    def merged(self) -> DataFrame:
        """All runs as one: (key, n_docs, holder)."""
        return self._merge([path for level in self.levels for path in level])

    def unseen(self, lines: DataFrame) -> DataFrame:
        """Rows of ``lines`` whose key no run has."""
        for path in (path for level in self.levels for path in level):
            lines = lines.join(self.spark.read.parquet(path).select("key"), "key", "left_anti")
        return lines


def dedup_lines(
    docs: DataFrame,
    min_chars: int = MIN_CHARS,
    min_docs: int = MIN_DOCS,
    batches: int = BATCHES,
    fanout: int = FANOUT,
    id_column: str = "doc_id",
    text_column: str = "text",
) -> DataFrame:
    """(_id, _row, _kept, n_lines, n_dropped) of every row.

    Lines are what lies between ``\\n``; a null or empty text is one empty line. A key of at
    least ``min_chars`` code points that at least ``min_docs`` distinct ids hold loses all its
    lines except in the largest id that holds it. Ids decide, so rows with one id count as one
    document and get one verdict; rows with a null id are judged as one document below all
    others. An empty table gives an empty result.
    """
    spark = docs.sparkSession
    folder = fresh_path(spark, "line-runs")
    rows = wrap(docs, id_column, text_column)
    text = F.coalesce(F.col("_text"), F.lit(""))
    # A null id must not be lost in max(): it is the smallest possible id here.
    lines = (
        rows.select(F.coalesce("_id", F.lit(-(2**63))).alias("doc_id"), F.explode(F.split(text, "\n", -1)).alias("line"))
        .select("doc_id", line_key(F.col("line")).alias("line"))
        .where(F.length("line") >= min_chars)
        .select("doc_id", F.unhex(F.md5(F.col("line").cast("binary"))).alias("key"))
        .withColumn("batch", F.pmod(F.xxhash64("doc_id"), F.lit(batches)).cast("int"))
    )
    lines.write.partitionBy("batch").parquet(f"{folder}/lines")
    stored = spark.read.schema("doc_id long, key binary, batch int").parquet(f"{folder}/lines")
    runs = LineRuns(spark, f"{folder}/runs", fanout)
    for batch in range(batches):
        runs.add(stored.where(F.col("batch") == batch).drop("batch"))
    repeated = runs.merged().where(F.col("n_docs") >= min_docs).select("key", "holder")
    # A line may be in a third of all documents: its rows are split, its one verdict is repeated.
    split = repeated.withColumn("salt", F.explode(F.array(*map(F.lit, range(SALTS)))))
    dropped = (
        stored.withColumn("salt", F.pmod(F.xxhash64("doc_id", "batch"), F.lit(SALTS)).cast("int"))
        .join(split, ["key", "salt"]).where(F.col("doc_id") != F.col("holder"))
        .groupBy("doc_id").agg(F.collect_set("key").alias("_gone"))
        .withColumnRenamed("doc_id", "_gone_id")
    )
    joined = rows.join(dropped, F.coalesce("_id", F.lit(-(2**63))) == F.col("_gone_id"), "left")
    parts = F.split(text, "\n", -1)
    # Short lines have no key among the dropped ones, as their text has another length.
    kept = F.filter(parts, lambda x: ~F.array_contains(F.col("_gone"), key_hash(x)))
    return (
        joined.withColumn("_left", F.when(F.col("_gone").isNotNull(), kept))
        .select(
            "_id", "_row",
            F.when(F.col("_gone").isNull(), text).otherwise(F.array_join("_left", "\n")).alias("_kept"),
            F.size(parts).cast("long").alias("n_lines"),
            F.when(F.col("_gone").isNull(), F.lit(0)).otherwise(F.size(parts) - F.size("_left"))
            .cast("long").alias("n_dropped"),
        )
    )


def without_repeated_lines(docs: DataFrame, length_column: str = "n_chars", **options) -> DataFrame:
    """The documents with what is left of their texts (a null text stays null).

    A column that holds the text's length follows the text.
    """
    done = dedup_lines(docs, **options)
    text = options.get("text_column", "text")
    kept = F.when(F.col("_row").getField(text).isNotNull(), F.col("_kept"))
    new = {text: kept}
    if length_column in docs.columns:
        new[length_column] = F.length(kept).cast(docs.schema[length_column].dataType)
    return unwrap(done, docs.columns, **new)
