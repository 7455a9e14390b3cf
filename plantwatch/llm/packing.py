"""Packing by cutting-stock column generation.

Documents are tokenized once; all that moves between machines are piece descriptions. A document
of more than one sequence gives full sequences and a tail; the tails' length histogram (at most
``capacity / GRID`` entries, whatever the number of documents) is a cutting-stock problem. Its
linear program is solved over patterns that a knapsack dynamic program prices; patterns are
rounded down and the few lengths left over are placed best-fit. Tails are ranked within their
length and rank r of a length takes the r-th slot of that length in the chosen patterns.
"""

from __future__ import annotations

import os
import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, Window, functions as F

from plantwatch.llm.bytewords import NOT_SPACE, Words, runs, slices, text_bytes
from plantwatch.llm.frames import carry
from plantwatch.session import fresh_path

CAPACITY = 2048
GRID = 8
END_ID = 1
# Words that a worker remembers; beyond, its table is filled anew.
CACHE_WORDS = 600_000
CHUNK_ROWS = 4000
PIECE = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long"
# The parts the tokenizer splits a normalized word into, and one space.
_PARTS = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d|\p{L}+|\p{N}| |[^\s\p{L}\p{N}]+")
_ASCII_PARTS = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[a-z]+|[0-9]| |[^a-z0-9 ]+")
# White space beyond ASCII, and the start of a special token's text: such words are coded alone.
_ODD = re.compile("[\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]|<\\|")
_GAP = np.uint32(0xFFFFFFFF)


class WordIds:
    """Ids of texts by way of a table of words seen before.

    The tokenizer never joins text across white space, so a text's ids are those of its words in
    a row; and it splits a normalized word into parts (letters, single digits, other signs) that
    it codes alone. A batch is a few numpy steps; only words and parts not seen before cost more.
    Words are known by 64-bit hashes.
    """

    def __init__(self, path: str, size: int = CACHE_WORDS):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer, self.size = Tokenizer.from_file(path), size
        self.parts: dict[str, bytes] = {}
        self._forget()

    def _forget(self) -> None:
        self.keys = np.zeros(0, np.uint64)
        self.at, self.counts = np.zeros(0, np.int64), np.zeros(0, np.int64)
        self.pool = np.zeros(0, np.uint32)

    def _code_parts(self, parts: list[str]) -> None:
        """All parts in one call; the tokenizer numbers the part each id is of."""
        coded = self.tokenizer.encode(" ".join(parts), add_special_tokens=False)
        ids, of = np.array(coded.ids, "<u4"), np.array(coded.word_ids, np.int64)
        at = np.searchsorted(of, np.arange(len(parts) + 1)).tolist()
        for part, a, b in zip(parts, at[:-1], at[1:], strict=True):
            self.parts[part] = ids[a:b].tobytes()

    def _code_alone(self, words: list[str]) -> list[np.ndarray]:
        return [np.array(self.tokenizer.encode(w, add_special_tokens=False).ids, np.uint32) for w in words]

    def _code(self, joined: str) -> tuple[np.ndarray, np.ndarray]:
        """Ids and number of ids of words that one space parts; words hold no ASCII white space."""
        if _ODD.search(joined):
            each = self._code_alone(joined.split(" "))
            return np.concatenate(each), np.array([len(x) for x in each])
        if joined.isascii():
            parts = _ASCII_PARTS.findall(joined.lower())
        else:
            parts = _PARTS.findall(self.tokenizer.normalizer.normalize_str(joined))
        if len(self.parts) > self.size:
            self.parts.clear()
        self.parts[" "] = _GAP.tobytes()
        coded = list(map(self.parts.get, parts))
        missing = list({part for part, value in zip(parts, coded, strict=True) if value is None})
        for k in range(0, len(missing), 2000):
            self._code_parts(missing[k : k + 2000])
        if missing:
            coded = list(map(self.parts.__getitem__, parts))
        ids = np.frombuffer(b"".join(coded), "<u4")
        gaps = np.flatnonzero(ids == _GAP)
        counts = np.diff(np.concatenate([[-1], gaps, [len(ids)]])) - 1
        return ids[ids != _GAP], counts

    def _learn(self, words: Words, which: np.ndarray, hashes: np.ndarray) -> None:
        starts, sizes = words.starts[which], words.ends[which] - words.starts[which]
        high = np.maximum.reduceat(words.data[runs(starts, sizes)], np.cumsum(sizes) - sizes) > 127
        text = words.data.tobytes()
        plain, other = np.flatnonzero(~high), np.flatnonzero(high)
        spans = lambda own: [text[a : a + n].decode() for a, n in zip(starts[own].tolist(), sizes[own].tolist(), strict=True)]
        strings = spans(other)
        odd = np.array([bool(_ODD.search(x)) for x in strings], bool)
        groups = [(plain, spans(plain)), (other[~odd], [x for x, o in zip(strings, odd, strict=True) if not o]), (other[odd], [x for x, o in zip(strings, odd, strict=True) if o])]
        keys, counts, pools = [self.keys], [self.counts], [self.pool]
        for own, members in groups:
            if not len(own):
                continue
            ids, sizes_of = self._code(" ".join(members))
            if len(sizes_of) != len(own):
                each = self._code_alone(members)
                ids, sizes_of = np.concatenate(each), np.array([len(x) for x in each])
            keys.append(hashes[own])
            counts.append(sizes_of)
            pools.append(ids)
        joined_keys, joined_counts = np.concatenate(keys), np.concatenate(counts)
        new_at = len(self.pool) + np.cumsum(joined_counts[len(self.keys) :]) - joined_counts[len(self.keys) :]
        at = np.concatenate([self.at, new_at])
        order = np.argsort(joined_keys, kind="stable")
        self.keys, self.counts, self.at = joined_keys[order], joined_counts[order], at[order]
        self.pool = np.concatenate(pools)

    def of(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts in a row, and where each text's ids begin."""
        words = Words(data, offsets, NOT_SPACE)
        hashes, example, which = np.unique(words.hashes(), return_index=True, return_inverse=True)
        if len(self.keys) > self.size:
            self._forget()
        place = np.searchsorted(self.keys, hashes)
        known = np.zeros(len(hashes), bool)
        inside = place < len(self.keys)
        known[inside] = self.keys[place[inside]] == hashes[inside]
        if not known.all():
            self._learn(words, example[~known], hashes[~known])
            place = np.searchsorted(self.keys, hashes)
        at, counts = self.at[place][which], self.counts[place][which]
        begins = np.concatenate([[0], np.cumsum(counts)])
        return self.pool[runs(at, counts)], begins[words.first]


def _pieces(batches: Iterator[pa.RecordBatch], path: str, capacity: int, end_id: int) -> Iterator[pa.RecordBatch]:
    known = WordIds(path)
    end = np.array([end_id], "<u4")
    for batch in slices(batches, "_text", 2 << 20):
        ids, begins = known.of(*text_bytes(batch.column("_text")))
        rows: list[tuple] = []
        begins = begins.tolist()
        for doc, a, b in zip(batch.column("_id").to_pylist(), begins[:-1], begins[1:], strict=True):
            own = np.concatenate([ids[a:b], end]).astype("<u4")
            total = len(own)
            for start in range(0, total, capacity):
                stop = min(start + capacity, total)
                rows.append((doc, start, stop - start, zlib.crc32(own[start:stop].tobytes()), total))
        columns = zip(*rows, strict=True)
        yield pa.RecordBatch.from_arrays(
            [pa.array(c, pa.int64()) for c in columns], names=["doc_id", "start", "length", "ids_crc32", "doc_tokens"]
        )


@dataclass
class Patterns:
    """How often each pattern is used, and how many pieces of each length unit it holds."""

    times: np.ndarray
    holds: np.ndarray  # (patterns, units + 1)


def price(values: np.ndarray, units: int) -> tuple[float, np.ndarray]:
    """Unbounded knapsack: the most value in ``units`` of room; ``values[l]`` per piece of l units."""
    best = np.zeros(units + 1)
    take = np.zeros(units + 1, np.int64)
    lengths = np.flatnonzero(values > 0)
    for room in range(1, units + 1):
        usable = lengths[lengths <= room]
        best[room], take[room] = best[room - 1], 0
        if len(usable):
            gain = values[usable] + best[room - usable]
            k = int(np.argmax(gain))
            if gain[k] > best[room] + 1e-12:
                best[room], take[room] = gain[k], usable[k]
    counts = np.zeros(units + 1, np.int64)
    room = units
    while room > 0:
        if take[room]:
            counts[take[room]] += 1
            room -= take[room]
        else:
            room -= 1
    return float(best[units]), counts


def cutting_stock(demand: np.ndarray, units: int) -> tuple[np.ndarray, np.ndarray]:
    """Optimal fractional use of patterns: (uses, patterns) by revised simplex.

    The basis starts with one pattern per length; a pattern that the knapsack prices above one
    enters until there is none. Negative dual values let a surplus column enter.
    """
    lengths = np.flatnonzero(demand)
    m = len(lengths)
    if not m:
        return np.zeros(0), np.zeros((0, units + 1), np.int64)
    columns = np.zeros((m, m))
    columns[np.arange(m), np.arange(m)] = units // lengths
    cost = np.ones(m)
    inverse = np.linalg.inv(columns)
    b = demand[lengths].astype(float)
    for step in range(50 * m):
        if step % 200 == 199:
            inverse = np.linalg.inv(columns)
        dual = cost @ inverse
        low = int(np.argmin(dual))
        if dual[low] < -1e-9:
            new, price_of = np.zeros(m), 0.0
            new[low] = -1
        else:
            values = np.zeros(units + 1)
            values[lengths] = dual
            best, counts = price(values, units)
            if best <= 1 + 1e-7:
                break
            new, price_of = counts[lengths].astype(float), 1.0
        direction = inverse @ new
        level = inverse @ b
        able = direction > 1e-9
        if not able.any():
            break
        ratio = np.where(able, np.maximum(level, 0) / np.where(able, direction, 1), np.inf)
        out = int(np.argmin(ratio))
        columns[:, out], cost[out] = new, price_of
        pivot = inverse[out] / direction[out]
        inverse = inverse - np.outer(direction, pivot)
        inverse[out] = pivot
    uses = np.maximum(np.linalg.solve(columns, b), 0)
    real = cost > 0
    patterns = np.zeros((int(real.sum()), units + 1), np.int64)
    patterns[:, lengths] = columns.T[real].round().astype(np.int64)
    return uses[real], patterns


def choose_patterns(demand: np.ndarray, units: int) -> Patterns:
    """Whole patterns that hold at least ``demand[l]`` pieces of each length l."""
    uses, patterns = cutting_stock(demand, units)
    times = np.floor(uses + 1e-9).astype(np.int64)
    left = demand - times @ patterns if len(times) else demand.copy()
    left = np.maximum(left, 0)
    rooms: list[tuple[int, np.ndarray]] = []
    # What rounding left over: at most a few pieces per pattern.
    for length in range(units, 0, -1):
        for _ in range(int(left[length])):
            fit = min((k for k, (room, _) in enumerate(rooms) if room >= length), key=lambda k: rooms[k][0], default=None)
            if fit is None:
                rooms.append((units, np.zeros(units + 1, np.int64)))
                fit = len(rooms) - 1
            room, holds = rooms[fit]
            holds[length] += 1
            rooms[fit] = (room - length, holds)
    used = times > 0
    holds = [*patterns[used], *(h for _, h in rooms)]
    return Patterns(
        np.concatenate([times[used], np.ones(len(rooms), np.int64)]).astype(np.int64),
        np.array(holds, np.int64).reshape(len(holds), units + 1),
    )


def slots(patterns: Patterns) -> list[tuple[int, int, int, int, int]]:
    """(units, first rank, end rank, copies per sequence, first sequence) per length and pattern."""
    first = np.concatenate([[0], np.cumsum(patterns.times)[:-1]]) if len(patterns.times) else []
    out = []
    for unit in range(patterns.holds.shape[1]):
        rank = 0
        for p in np.flatnonzero(patterns.holds[:, unit]):
            copies = int(patterns.holds[p, unit])
            end = rank + copies * int(patterns.times[p])
            out.append((int(unit), rank, end, copies, int(first[p])))
            rank = end
    return out


def pack(
    docs: DataFrame,
    tokenizer: str,
    capacity: int = CAPACITY,
    end_id: int = END_ID,
    grid: int = GRID,
    id_column: str = "doc_id",
    text_column: str = "text",
) -> DataFrame:
    """One row per piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset.

    ``tokenizer``: path of a tokenizer file on every machine. A null text is empty and so one
    piece of the end id. Each row is a document of its own, also when its id is null or repeated.
    An empty table gives no pieces. Lengths are planned in units of ``grid`` tokens, rounded up,
    and laid out by their true lengths, so offsets have no gaps.
    """
    spark = docs.sparkSession
    units = capacity // grid
    folder = fresh_path(spark, "pieces")
    cut = carry(docs, id_column, text_column).select("_id", "_text").mapInArrow(
        lambda batches: _pieces(batches, tokenizer, capacity, end_id), PIECE
    )
    unit = F.ceil(F.col("length") / grid).cast("int")
    cut.withColumn("unit", unit).write.parquet(folder)
    pieces = spark.read.schema(f"{PIECE}, unit int").parquet(folder)
    histogram = {r.unit: r.n for r in pieces.groupBy("unit").agg(F.count("*").alias("n")).collect()}
    full = histogram.get(units, 0)
    demand = np.zeros(units + 1, np.int64)
    for length, n in histogram.items():
        demand[length] = n
    demand[units] = 0
    patterns = choose_patterns(demand, units)
    table = slots(patterns)
    if full:
        table.append((units, 0, full, 1, int(patterns.times.sum())))
    chosen = spark.createDataFrame(table, "u int, low long, high long, copies int, first long")

    # Ranks without one large group: counts per chunk give each chunk its first rank.
    chunks = max(1, sum(histogram.values()) // CHUNK_ROWS)
    keyed = pieces.withColumn("chunk", F.pmod(F.xxhash64("doc_id", "start", "ids_crc32"), F.lit(chunks)).cast("int"))
    sizes = keyed.groupBy("unit", "chunk").agg(F.count("*").alias("n"))
    before = sizes.select(
        F.col("unit").alias("b_unit"), F.col("chunk").alias("b_chunk"),
        (F.sum("n").over(Window.partitionBy("unit").orderBy("chunk")) - F.col("n")).alias("before"),
    )
    in_chunk = Window.partitionBy("unit", "chunk").orderBy("doc_id", "start", "ids_crc32", "doc_tokens")
    ranked = (
        keyed.withColumn("own", F.row_number().over(in_chunk) - 1)
        .join(before, (F.col("unit") == F.col("b_unit")) & (F.col("chunk") == F.col("b_chunk")))
        .withColumn("rank", F.col("before") + F.col("own"))
    )
    # The slot table has at most a few rows per length and pattern, whatever the input.
    placed = ranked.join(
        F.broadcast(chosen), (F.col("unit") == F.col("u")) & (F.col("rank") >= F.col("low")) & (F.col("rank") < F.col("high"))
    ).withColumn("sequence_id", F.col("first") + F.floor((F.col("rank") - F.col("low")) / F.col("copies")).cast("long"))
    order = Window.partitionBy("sequence_id").orderBy(F.desc("unit"), "rank")
    return placed.select(
        "doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id",
        (F.sum("length").over(order) - F.col("length")).alias("offset"),
    )
