"""Substring dedup with suffix automata of reference shards.

Every window of ``WINDOW`` words has an anchor, its least hashed k-gram, and equal windows have
equal anchors. Anchors that only one document has rule out their windows. The words around an
anchor that several documents have form a piece; all pieces of one anchor are a reference shard.
Its suffix automaton is grown in the order of document ids, and each document's piece streams
through the automaton of the smaller ids for its matching statistics before it is added: where at
least ``WINDOW`` words match, they are removed.

An anchor of very many documents has its shard broadcast to splits of them: its reference holds
only first occurrences of windows that recur, and each split streams its documents through the
automaton of that reference.

Shards go to the documents that have their anchor, by a shuffle. One broadcast of all automata to
all documents would grow with the corpus, and every document would meet every shard.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from plantwatch.llm.bytewords import NOT_SPACE, Words, covered, slices, text_bytes, window_hashes
from plantwatch.llm.frames import carry
from plantwatch.session import fresh_path

WINDOW = 50
GRAM = 8
# An anchor that more documents have is worked on in splits of about so many, each with a copy of
# the shard's reference, which is cut to the first occurrences of windows that recur.
CROWDED = 200
SPLIT = 2000
BLOCK_WINDOWS = 500_000
SALTS = 8
PIECE = "anchor long, doc long, at int, words binary, crowd long, crowded boolean"
_NULL_ID = -(2**63)


class SuffixAutomaton:
    """Suffix automaton over words of several sequences, each added once."""

    def __init__(self):
        self.next: list[dict[int, int]] = [{}]
        self.link = [-1]
        self.length = [0]
        self.last = 0

    def _clone(self, state: int, word: int, target: int) -> int:
        copy = len(self.next)
        self.next.append(self.next[target].copy())
        self.link.append(self.link[target])
        self.length.append(self.length[state] + 1)
        self.link[target] = copy
        while state >= 0 and self.next[state].get(word) == target:
            self.next[state][word] = copy
            state = self.link[state]
        return copy

    def add(self, words: list[int]) -> None:
        last = 0
        for word in words:
            target = self.next[last].get(word)
            if target is not None:
                if self.length[target] != self.length[last] + 1:
                    target = self._clone(last, word, target)
                last = target
                continue
            new = len(self.next)
            self.next.append({})
            self.length.append(self.length[last] + 1)
            self.link.append(0)
            state = last
            while state >= 0 and word not in self.next[state]:
                self.next[state][word] = new
                state = self.link[state]
            if state >= 0:
                target = self.next[state][word]
                if self.length[target] != self.length[state] + 1:
                    target = self._clone(state, word, target)
                self.link[new] = target
            last = new

    def matching(self, words: list[int]) -> list[int]:
        """For each position, how many words up to it are found in the sequences added so far."""
        state, size, out = 0, 0, []
        for word in words:
            while state and word not in self.next[state]:
                state = self.link[state]
                size = self.length[state]
            target = self.next[state].get(word)
            if target is None:
                state, size = 0, 0
            else:
                state, size = target, size + 1
            out.append(size)
        return out


def spans_of(matches: list[int], window: int) -> list[tuple[int, int]]:
    """Maximal spans of words covered by matches of at least ``window`` words."""
    out: list[tuple[int, int]] = []
    for end, size in enumerate(matches, 1):
        if size >= window:
            if out and end - window <= out[-1][1]:
                out[-1] = (out[-1][0], end)
            else:
                out.append((end - window, end))
    return out


def anchors(words: np.ndarray, window: int, gram: int) -> tuple[np.ndarray, np.ndarray]:
    """(place, hash) of the anchor of each window: the leftmost of the least hashed grams in it."""
    grams = window_hashes(words, gram)
    width = window - gram + 1
    n = len(grams) - width + 1
    if n <= 0:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    # Minima of runs of doubling length; two of them cover a window.
    best, place, size = grams, np.arange(len(grams)), 1
    while 2 * size <= width:
        left, right = best[:-size], best[size:]
        take = right < left
        best, place = np.where(take, right, left), np.where(take, place[size:], place[:-size])
        size *= 2
    left, right = best[:n], best[width - size : width - size + n]
    take = right < left
    return np.where(take, place[width - size : width - size + n], place[:n]), np.where(take, right, left)


def _anchor_rows(batches: Iterator[pa.RecordBatch], window: int, gram: int) -> Iterator[pa.RecordBatch]:
    """Each distinct anchor of each document."""
    for batch in slices(batches, "_text"):
        words = Words(*text_bytes(batch.column("_text")), NOT_SPACE)
        hashes = words.hashes()
        found, owners = [], []
        for k, (a, b) in enumerate(zip(words.first[:-1].tolist(), words.first[1:].tolist(), strict=True)):
            if b - a >= window:
                own = np.unique(anchors(hashes[a:b], window, gram)[1])
                found.append(own)
                owners.append(np.full(len(own), k))
        if found:
            ids = batch.column("_id").fill_null(_NULL_ID).to_numpy(zero_copy_only=False)
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.concatenate(found).view(np.int64)), pa.array(ids[np.concatenate(owners)])], names=["anchor", "doc"]
            )


def _pieces(batches: Iterator[pa.RecordBatch], window: int, gram: int) -> Iterator[pa.RecordBatch]:
    """The words around each anchor that other documents have too."""
    for batch in slices(batches, "_text"):
        words = Words(*text_bytes(batch.column("_text")), NOT_SPACE)
        hashes = words.hashes()
        rows: list[tuple] = []
        docs = batch.column("doc").to_pylist()
        for k, (a, b) in enumerate(zip(words.first[:-1].tolist(), words.first[1:].tolist(), strict=True)):
            if b - a < window:
                continue
            own = hashes[a:b]
            which = anchors(own, window, gram)[1]
            wanted = {h: crowd for h, crowd in zip(batch.column("anchors")[k].as_py(), batch.column("crowds")[k].as_py(), strict=True)}
            # Windows in a row with equal anchors are one piece, also where a text repeats itself.
            starts = np.flatnonzero(np.append(True, which[1:] != which[:-1]))
            stops = np.append(starts[1:], len(which))
            short = own.astype(np.uint32)
            for s, e, h in zip(starts.tolist(), stops.tolist(), which[starts].view(np.int64).tolist(), strict=True):
                if h in wanted:
                    rows.append((h, docs[k], s, short[s : e + window - 1].tobytes(), wanted[h], wanted[h] > 0))
        if rows:
            columns = list(zip(*rows, strict=True))
            kinds = (pa.int64(), pa.int64(), pa.int32(), pa.binary(), pa.int64(), pa.bool_())
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(columns, kinds, strict=True)], names=["anchor", "doc", "at", "words", "crowd", "crowded"]
            )


def _first_and_last(w: np.ndarray, doc: np.ndarray, at: np.ndarray, place: np.ndarray, anchor: np.ndarray, high: np.ndarray) -> tuple:
    """Per window hash: its first occurrence by (doc, at, place), and the largest document."""
    order = np.lexsort((place, at, doc, w))
    w, doc, at, place, anchor, high = (x[order] for x in (w, doc, at, place, anchor, high))
    first = np.flatnonzero(np.append(True, w[1:] != w[:-1])) if len(w) else np.zeros(0, np.int64)
    top = np.maximum.reduceat(high, first) if len(first) else high
    return w[first], doc[first], at[first], place[first], anchor[first], top


def _window_blocks(batches: Iterator[pa.RecordBatch], window: int, buckets: int) -> Iterator[pa.RecordBatch]:
    """All windows of the pieces, each hash once per block with its first occurrence, as packed columns.

    A window of very many documents is so sent once per block of pieces and not once per document.
    """

    def flush(parts: list[tuple]) -> Iterator[pa.RecordBatch]:
        columns = _first_and_last(*(np.concatenate(x) for x in zip(*parts, strict=True)))
        bucket = (columns[0].view(np.uint64) % np.uint64(buckets)).astype(np.int32)
        order = np.argsort(bucket, kind="stable")
        edges = np.searchsorted(bucket[order], np.arange(buckets + 1))
        rows = [(k, np.stack([c[order[x:y]] for c in columns]).tobytes()) for k, (x, y) in enumerate(zip(edges[:-1], edges[1:], strict=True)) if y > x]
        numbers, blocks = zip(*rows, strict=True)
        yield pa.RecordBatch.from_arrays([pa.array(numbers, pa.int32()), pa.array(blocks, pa.binary())], names=["bucket", "block"])

    parts, held = [], 0
    for batch in batches:
        for h, doc, at, words in zip(*(batch.column(c).to_pylist() for c in ("anchor", "doc", "at")), batch.column("words"), strict=True):
            own = window_hashes(np.frombuffer(words.as_buffer(), np.uint32).astype(np.uint64), window).view(np.int64)
            n = len(own)
            parts.append((own, np.full(n, doc), np.full(n, at), np.arange(n), np.full(n, h), np.full(n, doc)))
            held += n
        if held > BLOCK_WINDOWS:
            yield from flush(parts)
            parts, held = [], 0
    if held:
        yield from flush(parts)


def _owners(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """First occurrences of the windows that several documents have, by piece."""
    blocks = [np.frombuffer(b.as_buffer().to_pybytes(), np.int64).reshape(6, -1) for batch in batches for b in batch.column("block")]
    if not blocks:
        return
    _, doc, at, place, anchor, high = _first_and_last(*np.concatenate(blocks, axis=1))
    shared = doc != high
    doc, at, place, anchor = (x[shared] for x in (doc, at, place, anchor))
    order = np.lexsort((place, at, doc, anchor))
    doc, at, place, anchor = (x[order] for x in (doc, at, place, anchor))
    if len(doc):
        new = np.append(True, (doc[1:] != doc[:-1]) | (at[1:] != at[:-1]) | (anchor[1:] != anchor[:-1]))
        first = np.flatnonzero(new)
        lists = pa.ListArray.from_arrays(pa.array(np.append(first, len(doc)).astype(np.int32)), pa.array(place.astype(np.int32)))
        yield pa.RecordBatch.from_arrays(
            [pa.array(anchor[first]), pa.array(doc[first]), pa.array(at[first].astype(np.int32)), lists], names=["anchor", "doc", "at", "places"]
        )


def _cut(batches: Iterator[pa.RecordBatch], window: int) -> Iterator[pa.RecordBatch]:
    """Pieces cut to their runs of the windows named in ``places``."""
    for batch in batches:
        rows: list[tuple] = []
        for h, doc, crowd, words, places in zip(
            *(batch.column(c).to_pylist() for c in ("anchor", "doc", "crowd")), batch.column("words"), batch.column("places").to_pylist(), strict=True
        ):
            whole = words.as_buffer().to_pybytes()
            places = np.unique(np.array(places))
            for run in np.split(places, np.flatnonzero(np.diff(places) > 1) + 1):
                rows.append((h, doc, crowd, whole[4 * int(run[0]) : 4 * (int(run[-1]) + window)]))
        if rows:
            columns = list(zip(*rows, strict=True))
            kinds = (pa.int64(), pa.int64(), pa.int64(), pa.binary())
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds, strict=True)], names=["anchor", "doc", "crowd", "words"])


def _lanes(batches: Iterator[pa.RecordBatch], window: int) -> Iterator[pa.RecordBatch]:
    """Splits of crowded shards, sorted by document: its pieces match first, then its reference is added."""
    key, automaton = None, SuffixAutomaton()
    for batch in batches:
        rows: list[tuple] = []
        columns = (batch.column(c).to_pylist() for c in ("anchor", "split", "doc", "reference", "at"))
        for h, split, doc, reference, at, words in zip(*columns, batch.column("words"), strict=True):
            piece = np.frombuffer(words.as_buffer(), np.uint32).tolist()
            if (h, split) != key:
                key, automaton = (h, split), SuffixAutomaton()
            if reference:
                automaton.add(piece)
                continue
            for s, e in spans_of(automaton.matching(piece), window):
                rows.append((doc, ((at + s) << 32) + e - s))
        if rows:
            docs, spans = zip(*rows, strict=True)
            yield pa.RecordBatch.from_arrays([pa.array(docs, pa.int64()), pa.array(spans, pa.int64())], names=["doc", "span"])


def _stream(batches: Iterator[pa.RecordBatch], window: int) -> Iterator[pa.RecordBatch]:
    """Shards come one after the other, sorted by document: match against the smaller, then add."""
    key, automaton, doc, waiting = None, None, None, []
    for batch in batches:
        starts, ends = [], []
        for h, own, words in zip(batch.column("anchor").to_pylist(), batch.column("first").to_pylist(), batch.column("words"), strict=True):
            piece = np.frombuffer(words.as_buffer(), np.uint32).tolist()
            if h != key:
                key, automaton, doc, waiting = h, SuffixAutomaton(), own, []
            if own != doc:
                for earlier in waiting:
                    automaton.add(earlier)
                doc, waiting = own, []
            spans = spans_of(automaton.matching(piece), window)
            waiting.append(piece)
            starts.append([s for s, _ in spans])
            ends.append([e for _, e in spans])
        yield pa.RecordBatch.from_arrays(
            [batch.column("anchor"), batch.column("content"), batch.column("first"), pa.array(starts, pa.list_(pa.int32())), pa.array(ends, pa.list_(pa.int32()))],
            names=["anchor", "content", "first", "starts", "ends"],
        )


def _remove(batches: Iterator[pa.RecordBatch], texts: bool) -> Iterator[pa.RecordBatch]:
    """The words outside the spans, joined by one space."""
    for batch in slices(batches, "_text"):
        data, offsets = text_bytes(batch.column("_text"))
        words = Words(data, offsets, NOT_SPACE)
        raw = data.tobytes()
        starts, ends = words.starts.tolist(), words.ends.tolist()
        removed, kept, digests = [], [], []
        for k, (a, b) in enumerate(zip(words.first[:-1].tolist(), words.first[1:].tolist(), strict=True)):
            spans = batch.column("spans")[k].as_py() or []
            own = range(a, b)
            if spans:
                edges = np.array(spans, np.int64)
                gone = covered(b - a, edges >> 32, (edges & 0xFFFFFFFF))
                own = (np.flatnonzero(~gone) + a).tolist()
            text = b" ".join([raw[starts[i] : ends[i]] for i in own])
            removed.append(b - a - len(own))
            digests.append(hashlib.sha256(text).hexdigest())
            kept.append(text.decode() if texts else None)
        yield pa.RecordBatch.from_arrays(
            [
                batch.column("_id"), batch.column("_rest"), pa.array(kept, pa.string()),
                pa.array(words.counts, pa.int64()), pa.array(removed, pa.int64()), pa.array(digests),
            ],
            names=["_id", "_rest", "_kept", "n_words", "n_removed", "kept_sha256"],
        )


def dedup_substrings(
    docs: DataFrame,
    window: int = WINDOW,
    gram: int = GRAM,
    crowded: int = CROWDED,
    texts: bool = True,
    id_column: str = "doc_id",
    text_column: str = "text",
) -> DataFrame:
    """(_id, _rest, _kept, n_words, n_removed, kept_sha256) of every row.

    A word is removed if a window over it also starts in a row of a smaller id. Rows of one id do
    not remove each other's words; a null id is smaller than all others; null and empty texts have
    no words. ``_kept`` holds the words left, with one space between (null without ``texts``).
    Words are compared by 32 bits each, so a window of 50 is told apart by 1600.
    """
    spark: SparkSession = docs.sparkSession
    folder = fresh_path(spark, "substrings")
    rows = carry(docs, id_column, text_column)
    key = F.coalesce("_id", F.lit(_NULL_ID))

    # Read twice and so computed twice, which is cheaper than storing it.
    held = rows.select("_id", "_text").mapInArrow(lambda b: _anchor_rows(b, window, gram), "anchor long, doc long")
    common = (
        held.groupBy("anchor").agg(F.min("doc").alias("low"), F.max("doc").alias("high"), F.count("*").alias("n"))
        .where(F.col("low") != F.col("high"))
        .select("anchor", F.when(F.col("n") > crowded, F.col("n")).otherwise(0).alias("crowd"))
    )
    per_doc = held.join(common, "anchor").groupBy("doc").agg(
        F.collect_list(F.struct("anchor", "crowd")).alias("both")
    ).select(F.col("doc"), F.col("both.anchor").alias("anchors"), F.col("both.crowd").alias("crowds"))
    (
        rows.select(key.alias("doc"), "_text").join(per_doc, "doc").select("doc", "_text", "anchors", "crowds")
        .mapInArrow(lambda b: _pieces(b, window, gram), PIECE).write.partitionBy("crowded").parquet(f"{folder}/pieces")
    )
    stored = spark.read.schema(PIECE).parquet(f"{folder}/pieces")
    many = stored.where(F.col("crowded")).drop("crowded")

    # Around a crowded anchor most windows are met once; the reference is the first document's
    # occurrence of each window that others have too.
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    owners = (
        many.mapInArrow(lambda b: _window_blocks(b, window, buckets), "bucket int, block binary")
        .repartition("bucket").mapInArrow(_owners, "anchor long, doc long, at int, places array<int>")
        .groupBy("anchor", "doc", "at").agg(F.flatten(F.collect_list("places")).alias("places"))
    )
    reference = many.join(owners, ["anchor", "doc", "at"]).select("anchor", "doc", "crowd", "words", "places").mapInArrow(
        lambda b: _cut(b, window), "anchor long, doc long, crowd long, words binary"
    )
    splits = F.ceil(F.col("crowd") / SPLIT)
    lane = ("anchor", "split", "doc", "reference", "at", "words")
    streams = many.select("*", F.pmod(F.xxhash64("doc"), splits).alias("split"), F.lit(False).alias("reference")).select(*lane)
    copies = reference.select(
        "*", F.explode(F.sequence(F.lit(0).cast("long"), splits - 1)).alias("split"), F.lit(True).alias("reference"), F.lit(0).alias("at")
    ).select(*lane)
    of_many = (
        streams.unionAll(copies).repartition("anchor", "split").sortWithinPartitions("anchor", "split", "doc", "reference")
        .mapInArrow(lambda b: _lanes(b, window), "doc long, span long")
    )

    # Equal pieces of one anchor stream once, for the least id that has them.
    few = stored.where(~F.col("crowded")).select("anchor", "doc", "at", "words", F.xxhash64("words").alias("content"))
    distinct = few.groupBy("anchor", "content").agg(F.min("doc").alias("first"), F.first("words").alias("words"))
    judged = (
        distinct.repartition("anchor").sortWithinPartitions("anchor", "first", "content")
        .mapInArrow(lambda b: _stream(b, window), "anchor long, content long, first long, starts array<int>, ends array<int>")
    )
    answers = judged.withColumn("salt", F.explode(F.array(*map(F.lit, range(SALTS)))))
    first = F.col("doc") == F.col("first")
    # For larger ids than the first the whole piece has been met.
    length = (F.octet_length("words") / 4).cast("long")
    spans = (
        few.select("anchor", "content", "doc", "at", length.alias("length"))
        .withColumn("salt", F.pmod(F.xxhash64("doc"), F.lit(SALTS)).cast("int"))
        .join(answers, ["anchor", "content", "salt"])
        .select(
            "doc",
            F.when(first, F.transform(F.arrays_zip("starts", "ends"), lambda x: (F.col("at") + x["starts"]).cast("long") * (1 << 32) + (x["ends"] - x["starts"])))
            .otherwise(F.array(F.col("at").cast("long") * (1 << 32) + F.col("length"))).alias("s"),
        )
        .select("doc", F.explode("s").alias("span")).unionAll(of_many).groupBy("doc").agg(F.collect_list("span").alias("spans"))
    )
    kind = {f.name: f.dataType.simpleString() for f in rows.schema}["_rest"]
    return (
        rows.withColumn("doc", key).join(spans, "doc", "left").select("_id", "_text", "_rest", "spans")
        .mapInArrow(
            lambda b: _remove(b, texts),
            f"_id long, _rest {kind}, _kept string, n_words long, n_removed long, kept_sha256 string",
        )
    )
