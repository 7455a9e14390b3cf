"""Session settings and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable, Iterable, Iterator
from contextlib import contextmanager
from functools import lru_cache
from multiprocessing.pool import ThreadPool

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession

# What a large run needs from Spark. AQE sizes the reduce side and splits skewed join
# partitions even where that costs the following aggregation an extra (pre-aggregated)
# exchange; a broadcast is only chosen from file sizes or run-time shuffle sizes.
RECOMMENDED = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.files.maxPartitionBytes": "128m",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def build_session(master: str | None = None, app: str = "plantwatch", **conf: str) -> SparkSession:
    """A session with the recommended settings; ``master`` only for local use."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**RECOMMENDED, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_folder(spark: SparkSession) -> str:
    """The folder all executors see, as named by ``spark.checkpoint.dir``.

    Where the setting is absent a temporary folder is used, but only for a local master:
    on a cluster a machine-local folder would lose data with its machine.
    """
    folder = spark.conf.get("spark.checkpoint.dir", "")
    if folder:
        return folder.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
    return _local_folder(spark.sparkContext.applicationId)


@lru_cache(maxsize=None)
def _local_folder(application: str) -> str:
    return tempfile.mkdtemp(prefix=f"plantwatch-{application}-")


def fresh_path(spark: SparkSession, label: str) -> str:
    """A new, unused path below the shared folder."""
    return f"{shared_folder(spark)}/plantwatch/{label}-{uuid.uuid4().hex}"


def materialise(df: DataFrame, label: str) -> DataFrame:
    """Write a frame that several jobs will read, and read it back.

    Parquet in the shared folder cuts the lineage, survives lost executors, and lets each
    later job read only the columns it needs.
    """
    spark = df.sparkSession
    path = fresh_path(spark, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def side_by_side(spark: SparkSession, work: Callable, items: Iterable) -> list:
    """The results of ``work`` on a few items, in order; their Spark jobs run at the same time.

    For passes of which each leaves cores idle: short ones, whose time is mostly planning and starting.
    """
    items = list(items)
    with ThreadPool(max(1, len(items))) as pool:
        return pool.map(inheritable_thread_target(spark)(work), items, chunksize=1)


def discard(spark: SparkSession, path: str) -> None:
    """Remove a scratch frame that a newer one replaces; only paths from ``fresh_path``."""
    if not path.startswith(f"{shared_folder(spark)}/plantwatch/"):
        raise ValueError(f"not a scratch path: {path}")
    jvm = spark.sparkContext._jvm
    target = jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(target, True)


@contextmanager
def shuffles_end_with_jobs(spark: SparkSession) -> Iterator[None]:
    """While this lasts, a job's shuffle files go when the job is over.

    Otherwise they stay until the driver collects its garbage. For chains of jobs that each write
    a table: what a later job needs, also after a lost executor, is in the table.
    """
    setting = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(setting, "false")
    spark.conf.set(setting, "true")
    try:
        yield
    finally:
        spark.conf.set(setting, before)
