"""Joins against the device side."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F, types as T

BROADCAST_BYTES = 64 * 1024 * 1024
# A key with one in so many rows is busy, so there are no more busy keys than that.
BUSY_KEYS = 64
TRACKED_KEYS = 2048


def frame_bytes(df: DataFrame) -> int:
    """Size of a frame's values: one aggregate over it, text by length, the rest by width."""
    width = F.lit(0)
    for field in df.schema.fields:
        if isinstance(field.dataType, T.StringType):
            width = width + F.coalesce(F.octet_length(field.name), F.lit(0)) + F.lit(16)
        else:
            width = width + F.lit(max(8, getattr(field.dataType, "defaultSize", lambda: 8)()))
    return df.agg(F.sum(width.cast("long")).alias("bytes")).first()["bytes"] or 0


def lookup_join(
    facts: DataFrame,
    dim: DataFrame,
    key: str,
    how: str = "inner",
    dim_bytes: int | None = None,
    limit_bytes: int = BROADCAST_BYTES,
    shuffled: str = "merge",
) -> DataFrame:
    """Join ``facts`` to ``dim`` on ``key`` (``how``: inner or left).

    A dimension measured to fit ``limit_bytes`` is broadcast: no shuffle, so a hot key costs
    nothing. A larger one is joined by a shuffle of both sides whose large partitions adaptive
    execution splits at run time, repeating only the few dimension rows they meet; see
    ``RECOMMENDED`` in the session settings. With ``shuffled="shuffle_hash"`` each task holds its share
    of the dimension as a hash table, so the facts are not sorted and keep the order they were read in. A stream's
    dimension is measured when the stream is built; one that is a stream itself is joined as Spark plans it.
    """
    if how not in ("inner", "left"):
        raise ValueError(f"unsupported join type: {how}")
    if dim.isStreaming:
        return facts.join(dim, key, how)
    size = frame_bytes(dim) if dim_bytes is None else dim_bytes
    if size <= limit_bytes:
        return facts.join(F.broadcast(dim), key, how)
    return facts.join(dim.hint(shuffled), key, how)


def busy_keys(facts: DataFrame, key: str) -> list:
    """Keys that hold at least one in ``BUSY_KEYS`` rows, by a sketch of the most frequent ones.

    One aggregate whose state has a fixed size; the null key is never among them.
    """
    seen = facts.where(F.col(key).isNotNull()).agg(
        F.count("*").alias("rows"), F.expr(f"approx_top_k(`{key}`, {BUSY_KEYS}, {TRACKED_KEYS})").alias("top")
    ).first()
    return [x["item"] for x in seen["top"] or [] if x["count"] * BUSY_KEYS >= seen["rows"]]


def split_lookup_join(
    facts: DataFrame,
    dim: DataFrame,
    key: str,
    how: str = "inner",
    dim_bytes: int | None = None,
    limit_bytes: int = BROADCAST_BYTES,
    shuffled: str = "merge",
) -> DataFrame:
    """The rows of ``lookup_join``, without a task that holds all rows of a busy key.

    Where the dimension is too large to broadcast, the rows of busy keys, and those without a key,
    meet the few dimension rows of these keys by broadcast and are not shuffled; all others are
    joined by a shuffle. A micro-batch of a stream gets no splitting by adaptive execution, so
    this is for ``foreachBatch``. A wrong estimate costs time and no rows: every key is on one side only.
    """
    if how not in ("inner", "left"):
        raise ValueError(f"unsupported join type: {how}")
    size = frame_bytes(dim) if dim_bytes is None else dim_bytes
    if size <= limit_bytes:
        return facts.join(F.broadcast(dim), key, how)
    busy = busy_keys(facts, key)
    few = dim.where(F.col(key).isin(busy))
    if frame_bytes(few) > limit_bytes:
        return facts.join(dim.hint(shuffled), key, how)
    apart = F.col(key).isNull() | F.col(key).isin(busy)
    return facts.where(apart).join(F.broadcast(few), key, how).unionByName(
        facts.where(~apart).join(dim.hint(shuffled), key, how)
    )


def latest_snapshot(df: DataFrame, key: str = "device_id", order: str = "ingestion_time") -> DataFrame:
    """One row per key: the most recently ingested.

    An aggregate rather than a ranking window, so the many snapshots of one key shrink to
    one row in each map task before anything is shuffled.
    """
    rest = [c for c in df.columns if c != key]
    picked = df.groupBy(key).agg(F.max_by(F.struct(*rest), F.struct(order, F.xxhash64(*rest))).alias("_row"))
    return picked.select(key, "_row.*").select(*df.columns)


def orphan_keys(facts: DataFrame, dim: DataFrame, key: str = "device_id") -> DataFrame:
    """Keys of ``facts`` that ``dim`` lacks. Keys are made distinct before they are shuffled."""
    return facts.select(key).distinct().join(dim.select(key).distinct(), key, "left_anti")
