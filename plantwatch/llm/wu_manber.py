"""Benchmark decontamination by Wu-Manber search over words.

The patterns are all windows of consecutive words of the benchmark items. Those of one length
share a shift table over hashed blocks of two words: the block that ends a window tells how far
no pattern can end, so most positions are never looked at. Where the shift is zero, the block's
bucket selects patterns, which are compared word by word and then byte by byte. The search runs
over many equal stretches of a batch's words side by side.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from plantwatch.llm.bytewords import ALNUM, LOWER, Words, runs, slices, text_bytes
from plantwatch.llm.frames import carry, restore
from plantwatch.session import fresh_path

WINDOW = 10
# Windows that one search pass broadcasts; further ones take further passes.
BLOCK_WINDOWS = 200_000
STRETCH = 256


def _block_hash(words: np.ndarray, ends: np.ndarray, width: int, bits: int) -> np.ndarray:
    value = words[ends]
    if width == 2:
        value = value + words[ends - 1] * np.uint64(0x9E3779B97F4A7C15)
    return (value * np.uint64(0xD6E8FEB86659FD93)) >> np.uint64(64 - bits)


@dataclass
class Patterns:
    """Patterns of one length with their shift table and suffix buckets."""

    length: int
    words: np.ndarray  # (patterns, length)
    texts: list[bytes]
    ids: list[int]  # what the caller knows the patterns by
    bits: int = 16
    shift: np.ndarray = field(init=False)
    bucket_at: np.ndarray = field(init=False)
    bucket: np.ndarray = field(init=False)

    def __post_init__(self):
        n, m = self.words.shape
        self.bits = max(self.bits, int(n * m).bit_length() + 2)
        self.width = min(2, m)
        flat = self.words.ravel()
        base = np.arange(n) * m
        self.shift = np.full(1 << self.bits, m - self.width + 1, np.uint8 if m < 256 else np.int64)
        for last in range(self.width - 1, m):
            hashed = _block_hash(flat, base + last, self.width, self.bits)
            np.minimum.at(self.shift, hashed, m - 1 - last)
        suffix = _block_hash(flat, base + m - 1, self.width, self.bits).astype(np.int64)
        self.bucket = np.argsort(suffix, kind="stable")
        self.bucket_at = np.searchsorted(suffix[self.bucket], np.arange((1 << self.bits) + 1))

    def candidates(self, words: np.ndarray) -> np.ndarray:
        """Window ends whose last block has shift zero, skipping by shifts in all stretches at once."""
        m, n = self.length, len(words)
        at = np.arange(m - 1, n, STRETCH)
        stop = np.minimum(at + STRETCH, n)
        found = []
        while len(at):
            shift = self.shift[_block_hash(words, at, self.width, self.bits)]
            found.append(at[shift == 0])
            at = at + np.maximum(shift, 1)
            inside = at < stop
            at, stop = at[inside], stop[inside]
        return np.sort(np.concatenate(found)) if found else np.zeros(0, np.int64)

    def find(self, words: np.ndarray, begin: np.ndarray, text_of) -> tuple[np.ndarray, np.ndarray]:
        """(window start, pattern) of all occurrences; ``begin``: first word of each word's text."""
        ends = self.candidates(words)
        starts = ends - self.length + 1
        ends, starts = (x[starts >= begin[ends]] for x in (ends, starts))
        hashed = _block_hash(words, ends, self.width, self.bits).astype(np.int64)
        counts = self.bucket_at[hashed + 1] - self.bucket_at[hashed]
        pattern = self.bucket[runs(self.bucket_at[hashed], counts)]
        start = np.repeat(starts, counts)
        same = np.ones(len(start), bool)
        for k in range(self.length):
            same &= words[start + k] == self.words[pattern, k]
        start, pattern = start[same], pattern[same]
        sure = [self.texts[p] == text_of(s, self.length) for s, p in zip(start.tolist(), pattern.tolist(), strict=True)]
        sure = np.array(sure, bool)
        return start[sure], pattern[sure]


def _windows(batches: Iterator[pa.RecordBatch], window: int) -> Iterator[pa.RecordBatch]:
    """(window text, length, item) of every window of every item."""
    for batch in slices(batches, "_text"):
        data, offsets = text_bytes(batch.column("_text"))
        words = Words(data, offsets, ALNUM)
        lowered = LOWER[data].tobytes()
        ids = batch.column("item").to_pylist()
        texts, lengths, items = [], [], []
        for i, item in enumerate(ids):
            first, last = words.first[i], words.first[i + 1]
            if first == last:
                continue
            own = [lowered[a:b] for a, b in zip(words.starts[first:last].tolist(), words.ends[first:last].tolist(), strict=True)]
            m = min(window, len(own))
            for k in range(len(own) - m + 1):
                texts.append(b" ".join(own[k : k + m]))
                lengths.append(m)
                items.append(item)
        yield pa.RecordBatch.from_arrays(
            [pa.array(texts, pa.binary()), pa.array(lengths, pa.int32()), pa.array(items, pa.string())],
            names=["window", "length", "item"],
        )


def _searcher(windows: list[bytes], lengths: list[int]) -> list[Patterns]:
    by_length: dict[int, list[int]] = {}
    for k, m in enumerate(lengths):
        by_length.setdefault(m, []).append(k)
    out = []
    for m, ids in sorted(by_length.items()):
        texts = [windows[k] for k in ids]
        data, offsets = text_bytes(pa.array(texts, pa.binary()))
        hashes = Words(data, offsets, ALNUM).hashes()
        out.append(Patterns(m, hashes.reshape(len(ids), m), texts, ids))
    return out


def _search(batches: Iterator[pa.RecordBatch], block) -> Iterator[pa.RecordBatch]:
    """Adds to each row's hit word positions and items those of one block of windows."""
    windows, lengths, items = block.value
    searcher = _searcher(windows, lengths)
    for batch in slices(batches, "_text"):
        data, offsets = text_bytes(batch.column("_text"))
        words = Words(data, offsets, ALNUM)
        hashes = words.hashes(lower=True)
        owner = words.owner()
        begin = words.first[owner] if len(owner) else owner
        lowered = LOWER[data]

        def text_of(start: int, m: int, words=words, lowered=lowered) -> bytes:
            spans = zip(words.starts[start : start + m], words.ends[start : start + m], strict=True)
            return b" ".join(lowered[a:b].tobytes() for a, b in spans)

        hit: dict[int, set[int]] = {}
        met: dict[int, set[str]] = {}
        for patterns in searcher:
            starts, which = patterns.find(hashes, begin, text_of)
            for s, p in zip(starts.tolist(), which.tolist(), strict=True):
                doc = int(owner[s])
                base = s - int(words.first[doc])
                hit.setdefault(doc, set()).update(range(base, base + patterns.length))
                met.setdefault(doc, set()).update(items[patterns.ids[p]])
        hits, seen = batch.column("_hits"), batch.column("_items")
        new_hits = [sorted(hit.get(i, set()).union(old)) if i in hit else old for i, old in enumerate(hits.to_pylist())]
        new_items = [sorted(met.get(i, set()).union(old)) if i in met else old for i, old in enumerate(seen.to_pylist())]
        yield pa.RecordBatch.from_arrays(
            [
                batch.column("_id"), batch.column("_text"), batch.column("_rest"),
                pa.array(new_hits, pa.list_(pa.int32())), pa.array(new_items, pa.list_(pa.string())),
                pa.array(words.counts, pa.int64()),
            ],
            names=["_id", "_text", "_rest", "_hits", "_items", "_words"],
        )


def benchmark_windows(items: DataFrame, window: int = WINDOW) -> DataFrame:
    """(window, length, items): distinct windows with the ids of the items that have them."""
    found = items.select(F.col("item_id").cast("string").alias("item"), F.col("text").alias("_text")).mapInArrow(
        lambda batches: _windows(batches, window), "window binary, length int, item string"
    )
    return found.groupBy("window", "length").agg(F.collect_set("item").alias("items"))


def find_benchmark(
    docs: DataFrame,
    items: DataFrame,
    window: int = WINDOW,
    block_windows: int = BLOCK_WINDOWS,
    id_column: str = "doc_id",
    text_column: str = "text",
) -> DataFrame:
    """Each row with ``_words``, ``_hits`` (positions of hit words) and ``_items`` (ids as text).

    Words are runs of digits, letters and all beyond ASCII, with A-Z lower-cased. An item of
    fewer than ``window`` words, but not none, is one window; a null or empty item has none and a
    null document no words. Repeated rows are judged alike. Items without an id hit words but
    name nothing. Windows are broadcast in blocks of about ``block_windows``; documents pass
    through one search per block, without a shuffle.
    """
    spark: SparkSession = docs.sparkSession
    path = fresh_path(spark, "benchmark-windows")
    benchmark_windows(items, window).write.parquet(path)
    stored = spark.read.schema("window binary, length int, items array<string>").parquet(path)
    blocks = max(1, -(-stored.count() // block_windows))
    rows = (
        carry(docs, id_column, text_column)
        .withColumn("_hits", F.array().cast("array<int>")).withColumn("_items", F.array().cast("array<string>"))
        .withColumn("_words", F.lit(0).cast("long"))
    )
    schema = rows.schema
    for k in range(blocks):
        own = stored.where(F.pmod(F.xxhash64("window"), F.lit(blocks)) == k).collect()
        own.sort(key=lambda r: (r.length, bytes(r.window)))
        block = spark.sparkContext.broadcast(
            ([bytes(r.window) for r in own], [r.length for r in own], [list(r["items"]) for r in own])
        )
        rows = rows.mapInArrow(lambda batches, block=block: _search(batches, block), schema)
    return rows


def decontaminate(docs: DataFrame, items: DataFrame, **options) -> DataFrame:
    """The documents in which no benchmark window occurs, with their columns."""
    found = find_benchmark(docs, items, **options)
    return restore(found.where(F.size("_hits") == 0), docs.columns, options.get("text_column", "text"))
