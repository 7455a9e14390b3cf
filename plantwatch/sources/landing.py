"""Landing folders: JSON files per entity, read as a batch or as a stream."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from plantwatch.schemas import RAW_DDL, columns_of
from plantwatch.session import shuffles_end_with_jobs

# Fixed value: at most this many telemetry files per trigger.
TELEMETRY_FILES_PER_TRIGGER = 1000
# At the quickest level: files a quarter larger than by default, written in some 60 % of the time.
LANDED_AS = {"compression": "gzip", "zlib.compress.level": "BEST_SPEED"}


def _reader(reader, ddl: str, multi_line: bool):
    return reader.schema(ddl).option("multiLine", multi_line)


def with_lineage(df: DataFrame) -> DataFrame:
    """Arrival time and source file of each row of a file source."""
    return df.select(
        "*",
        F.current_timestamp().alias("ingestion_time"),
        F.col("_metadata.file_path").alias("source_file"),
    )


def ingest(
    spark: SparkSession,
    path: str,
    entity: str,
    streaming: bool = False,
    multi_line: bool = True,
    max_files: int | None = None,
) -> DataFrame:
    """Raw rows of one entity with lineage columns and the declared schema.

    ``multi_line`` reads files that each hold one JSON array; such a file cannot be split, so
    large landings should use JSON lines (``multi_line=False``). Telemetry streams take at most
    1000 files per trigger unless told otherwise.
    """
    ddl = RAW_DDL[entity]
    if not streaming:
        return with_lineage(_reader(spark.read, ddl, multi_line).json(path))
    reader = _reader(spark.readStream, ddl, multi_line)
    if max_files is None and entity == "telemetry":
        max_files = TELEMETRY_FILES_PER_TRIGGER
    if max_files is not None:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return with_lineage(reader.json(path))


def land(df: DataFrame, path: str, entity: str) -> str:
    """Write an entity's raw columns as JSON lines, one compressed file per task.

    Lines repeat every field name, so plain files would be several times larger. A compressed file is read by one
    task, as it was written by one.
    """
    with shuffles_end_with_jobs(df.sparkSession):
        df.select(*columns_of(RAW_DDL[entity])).write.mode("append").options(**LANDED_AS).json(path)
    return path


ARRAY_ROWS = 50_000  # rows of a file that holds one JSON array, which one task has to read


def land_arrays(df: DataFrame, path: str, entity: str, multiple_of: int = 1, rows: int = ARRAY_ROWS) -> int:
    """Write an entity's raw columns as files of one JSON array each; how many files.

    A file has about ``rows`` rows at most, as such files are written and read by one task each.
    """
    raw = df.select(*columns_of(RAW_DDL[entity]))
    files = multiple_of * max(1, -(-raw.count() // (rows * multiple_of)))
    dealt = raw.select(
        F.pmod(F.xxhash64(*raw.columns), F.lit(files)).alias("file"),
        F.to_json(F.struct(*raw.columns), {"ignoreNullFields": "false"}).alias("line"),
    )
    arrays = dealt.groupBy("file").agg(F.concat(F.lit("["), F.array_join(F.collect_list("line"), ",\n"), F.lit("]")).alias("value"))
    arrays.repartitionByRange(files, "file").write.partitionBy("file").mode("append").text(path)
    return files
