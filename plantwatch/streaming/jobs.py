"""Streaming forms of the stateful tables, and triggered execution.

The cleaned tables, labels, dashboard and maintenance report are stateless: their batch
functions take a stream as they are. Hourly features and the learning table keep state, which
watermarks bound.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T
from pyspark.sql.streaming import StreamingQuery

from plantwatch.params import HourlyLimits, LabelHorizon
from plantwatch.plans.gold import device_features, ml_features
from plantwatch.session import fresh_path

READING_DELAY = "1 hour"
# Labels lie up to the whole horizon before their failure, so the join has to wait that long,
# plus a day for late failures.
LABEL_HOURS = LabelHorizon().horizon_hours + 24
LABEL_DELAY = f"{LABEL_HOURS} hours"
# State on the executors' disks, within a bound of memory: a join holds the rows of its whole delay, which outgrow a
# heap. One store a task of the join instead of four, and of a batch only what it changed is stored. What lies on disk is
# compressed more than by default, and a task's copy of it goes when its batch is committed: a run has few batches, and
# copies of a run that is over would otherwise lie beside those of the one that resumes it.
STATE = {
    "spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.boundedMemoryUsage": "true",
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
    "spark.sql.streaming.join.stateFormatVersion": "3",
    "spark.sql.streaming.stateStore.rocksdb.compression": "zstd",
    "spark.sql.streaming.stateStore.rocksdb.blockSizeKB": "32",
    "spark.sql.streaming.stateStore.compression.codec": "zstd",
    "spark.sql.streaming.stateStore.unloadOnCommit": "true",
}


def hourly_features_stream(
    health: DataFrame, delay: str = READING_DELAY, limits: HourlyLimits = HourlyLimits()
) -> DataFrame:
    """Hourly features, each hour emitted once, when no reading of it is awaited any more.

    The watermark is on the reading time and not on its hour: a delay on the truncated hour
    would close an hour as soon as the next one is seen.
    """
    return device_features(
        health.withWatermark("timestamp", delay), limits, hour=F.window("timestamp", "1 hour")
    )


def ml_features_stream(
    features: DataFrame, labels: DataFrame, delay: str = LABEL_DELAY
) -> DataFrame:
    """The learning table from two streams: a left join whose state the watermarks evict.

    Hours without a label are emitted once the watermark has passed them.
    """
    return ml_features(
        features.withWatermark("hour_bucket", delay), labels.withWatermark("prediction_hour", delay)
    )


# No batch for what the last one's watermark closes: the next run's first batch gives it out.
ONE_PASS = {"spark.sql.streaming.noDataMicroBatches.enabled": "false"}


@contextmanager
def _set(spark: SparkSession, settings: dict[str, str]) -> Iterator[None]:
    """Settings that the queries started here take; one that resumes keeps its checkpoint's kind of state."""
    before = {name: spark.conf.get(name, None) for name in settings}
    for name, value in settings.items():
        spark.conf.set(name, value)
    try:
        yield
    finally:
        for name, value in before.items():
            if value is None:
                spark.conf.unset(name)
            else:
                spark.conf.set(name, value)


def start_available_now(
    df: DataFrame, path: str, checkpoint: str, output_mode: str = "append", name: str | None = None,
) -> StreamingQuery:
    """Process what has arrived, in as many micro-batches as the source makes, then stop."""
    writer = (
        df.writeStream.format("parquet")
        .outputMode(output_mode)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
    )
    if name:
        writer = writer.queryName(name)
    with _set(df.sparkSession, STATE):
        return writer.start(path)


def run_available_now(
    df: DataFrame, path: str | None = None, checkpoint: str | None = None, label: str = "stream",
) -> tuple[DataFrame, StreamingQuery]:
    """Run to the end of the available input; the written table and the finished query."""
    spark = df.sparkSession
    path = path or fresh_path(spark, label)
    checkpoint = checkpoint or fresh_path(spark, f"{label}-checkpoint")
    query = start_available_now(df, path, checkpoint)
    query.awaitTermination()
    return spark.read.schema(df.schema).parquet(path), query


def run_and_drain(
    stream: Callable[[], DataFrame], drain: Callable[[], None], label: str = "stream", settings: dict[str, str] | None = None,
) -> tuple[DataFrame, int]:
    """Run to the end of the input, then once more to close what the watermarks still hold back.

    ``stream`` builds the query, which both runs resume from one checkpoint; ``drain`` puts into
    every source one row whose time lies beyond all others by more than the delay. It moves the
    watermarks past everything open, so the state gives its rows out; the rows put in stay open
    themselves. ``settings`` are those of the first run, such as ``ONE_PASS`` where nobody waits for what it
    closes. Returns the written table and how many of its rows the first run had written.
    """
    first = stream()
    spark, path, checkpoint = first.sparkSession, fresh_path(first.sparkSession, label), fresh_path(first.sparkSession, f"{label}-checkpoint")
    with _set(spark, settings or {}):
        closed = run_available_now(first, path, checkpoint)[0].count()
    # Shuffle files of a stream's batches stay until the driver collects its garbage.
    spark.sparkContext._jvm.System.gc()
    drain()
    return run_available_now(stream(), path, checkpoint)[0], closed


def run_in_batches(
    df: DataFrame, label: str = "batches", checkpoint: str | None = None, path: str | None = None,
    batch_table: Callable[[DataFrame], DataFrame] | None = None, keep: bool = False,
) -> DataFrame:
    """Run to the end of the input and keep with every row the number of its micro-batch.

    Each batch is written to a folder of its own number, over what a broken attempt may have left,
    so a batch that is repeated after a failure adds nothing. ``batch_table`` turns a batch into
    what is written of it, such as its rule counts; ``keep`` stores the batch while that is made, for
    tables that read it more than once.
    """
    spark = df.sparkSession
    path, checkpoint = path or fresh_path(spark, label), checkpoint or fresh_path(spark, f"{label}-checkpoint")

    def write(batch: DataFrame, number: int) -> None:
        held = batch.persist() if keep else batch
        out = held if batch_table is None else batch_table(held)
        out.write.mode("overwrite").parquet(f"{path}/batch={number}")
        if keep:
            held.unpersist()

    query = df.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    query.awaitTermination()
    kind = df.schema if batch_table is None else batch_table(spark.createDataFrame([], df.schema)).schema
    numbered = T.StructType([*kind.fields, T.StructField("batch", T.LongType())])
    return spark.read.schema(numbered).option("basePath", path).parquet(path)


def timeless(stream: DataFrame, time: str, label: str = "timeless") -> DataFrame:
    """Rows of a stream without a time. No watermark ever passes them, so they are written aside."""
    return run_available_now(stream.filter(F.col(time).isNull()), label=label)[0]


def run_to_table(df: DataFrame, table: str, checkpoint: str) -> StreamingQuery:
    """Append what has arrived to a managed table."""
    query = (
        df.writeStream.outputMode("append")
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .toTable(table)
    )
    query.awaitTermination()
    return query
