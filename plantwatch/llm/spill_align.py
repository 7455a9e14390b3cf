"""Alignment of two tokenizers, with pair counts by external spill counting.

Each task encodes its texts once with both tokenizers. Where tokens of both end at one byte a
group ends; tokens whose byte ranges overlap are linked. Every document gives one record per
linked pair of ids. A task collects records of a bounded number of documents (a chunk), deals
them by the radix of the first tokenizer's id and writes each part as a zstd run, sorted by pair:
a directory (pair, documents of the chunk that hold it) and the documents themselves.

The directories of a part are merged by a k-way heap merge, ``FAN_IN`` runs at a time and as often
as it takes, which adds up how many documents hold a pair. Pairs come in the order of the first
id, so the highest count of an id is known as soon as its pairs are through. The counts then
stream past the runs again and each run returns what its documents gain, chunk by chunk.

A pair that every document holds is one directory entry per run, so no part grows with a hot
pair; parts hold a share of the different pairs, which the two vocabularies bound.

Rows without text, with an empty one or with one whose tokens do not spell a space and the text
have no tokens: all numbers are 0 and the digest is ''. Rows that share a doc_id, also a null one,
are documents of their own. Further columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
import heapq
import json
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain, groupby

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from plantwatch.llm.bytewords import slices
from plantwatch.session import materialise

PARTS = 64  # radix of the first id
CHUNK_RECORDS = 1 << 20  # records of a chunk, beyond which its runs are written
CHUNK_DOCS = 1 << 16
FAN_IN = 64  # runs that one heap merge reads side by side
BLOCK = 1 << 16  # entries of a run in memory during a merge
RUNS_PER_SPLIT = 512  # runs that one task gives their counts

ENTRY = np.dtype([("pair", "<u8"), ("n", "<u8")])
RECORD = np.dtype([("doc", "<u4"), ("links", "<u4")])
COUNT = np.dtype([("pair", "<u8"), ("n", "<u8"), ("best", "u1")])

STORED = (
    "chunk long, doc int, doc_id long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, "
    "part int, pairs binary, docs binary"
)
RESULT = "doc_id long, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups_sha256 string"

# Fixed value: how byte-level BPE cuts a text before merging.
SPLIT = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
QUICK_CHARS, QUICK_BELOW = 200_000, "ɐ"


class ByteLevel:
    """The byte-level BPE of a tokenizer file, and the bytes of its tokens.

    The merges of such a file usually are its ids in order. Then texts of Latin letters go through
    the quicker of two encoders, which give the same ids there; all others, and very long ones,
    through the file's own.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True
        plain = _byte_alphabet()
        special = {t["id"]: t["content"] for t in spec["added_tokens"]}
        vocab = {**spec["model"]["vocab"], **{t: i for i, t in special.items()}}
        self.tokens = [b""] * (max(vocab.values()) + 1)
        for token, i in vocab.items():
            if i in special or any(c not in plain for c in token):
                self.tokens[i] = token.encode()
            else:
                self.tokens[i] = bytes(plain[c] for c in token)
        self.quick = self._quick(spec, {self.tokens[i]: i for i in vocab.values() if i not in special})

    def _quick(self, spec: dict, ranks: dict[bytes, int]):
        cut, vocab = spec.get("pre_tokenizer") or {}, spec["model"]["vocab"]
        merged = ["".join(m if isinstance(m, list) else m.split(" ")) for m in spec["model"]["merges"]]
        ordered = all(vocab.get(m) == 256 + i for i, m in enumerate(merged))
        plain = cut.get("type") == "ByteLevel" and cut.get("use_regex", True) and not cut.get("add_prefix_space")
        if not (ordered and plain) or spec.get("normalizer"):
            return None
        import tiktoken

        return tiktoken.Encoding("file", pat_str=SPLIT, mergeable_ranks=ranks, special_tokens={})

    def encode(self, texts: list[str]) -> list[list[int]]:
        return [
            self.quick.encode_ordinary(t)
            if self.quick and len(t) <= QUICK_CHARS and max(t) < QUICK_BELOW
            else self.tokenizer.encode(t, add_special_tokens=False).ids
            for t in texts
        ]


def _byte_alphabet() -> dict[str, int]:
    """The letters that stand for bytes: printable ones for themselves, others moved up by 256."""
    printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
    moved = [b for b in range(256) if b not in printable]
    return {**{chr(b): b for b in printable}, **{chr(256 + i): b for i, b in enumerate(moved)}}


class Pieces:
    """A sentence-piece model and the bytes of its pieces."""

    def __init__(self, path: str):
        import sentencepiece

        self.model = sentencepiece.SentencePieceProcessor(model_file=path)
        self.tokens = [
            bytes([int(p[3:5], 16)]) if self.model.is_byte(i) else p.replace("▁", " ").encode()
            for i in range(self.model.get_piece_size())
            for p in [self.model.id_to_piece(i)]
        ]

    def encode(self, texts: list[str]) -> list[list[int]]:
        return self.model.encode(texts, num_threads=1)


class _Side:
    """A tokenizer with what the alignment looks up by id."""

    def __init__(self, encoder: ByteLevel | Pieces):
        self.encoder = encoder
        self.lengths = np.array([len(t) for t in encoder.tokens], np.int64)
        ids = [str(i) for i in range(len(encoder.tokens))]
        self.comma = np.array([i + "," for i in ids], object)
        self.bar = np.array([i + "|" for i in ids], object)
        self.semicolon = np.array([i + ";" for i in ids], object)


@lru_cache(maxsize=2)
def _sides(path_a: str, path_b: str) -> tuple[_Side, _Side]:
    return _Side(ByteLevel(path_a)), _Side(Pieces(path_b))


class Aligned:
    """Groups and links of a few texts, laid end to end as one string of bytes."""

    def __init__(self, a: _Side, b: _Side, ids_a: list[list[int]], ids_b: list[list[int]]):
        self.a, self.b = (np.fromiter(chain.from_iterable(ids), np.int64) for ids in (ids_a, ids_b))
        self.n_a, self.n_b = (np.array([len(i) for i in ids], np.int64) for ids in (ids_a, ids_b))
        ends_a, ends_b = np.cumsum(a.lengths[self.a]), np.cumsum(b.lengths[self.b])
        size = int(ends_a[-1]) + 1
        at_a, at_b = np.zeros(size, bool), np.zeros(size, bool)
        at_a[ends_a], at_b[ends_b] = True, True
        both = at_a & at_b
        doc_ends = ends_a[np.cumsum(self.n_a) - 1]
        # Between two ends of either side lies exactly one token of each: one link.
        ends = np.flatnonzero(at_a | at_b)
        self.doc = np.searchsorted(doc_ends, ends)
        if len(ids_a) < 1 << 16:
            self.doc = self.doc.astype(np.uint16)  # sorted in one pass per byte
        pair_a, pair_b = self.a[np.searchsorted(ends_a, ends)], self.b[np.searchsorted(ends_b, ends)]
        self.pair = (pair_a.astype(np.uint64) << np.uint64(32)) | pair_b.astype(np.uint64)
        common = np.flatnonzero(both)
        self.n_groups = np.bincount(np.searchsorted(doc_ends, common), minlength=len(ids_a))
        self.n_links = np.bincount(self.doc, minlength=len(ids_a))
        # Where each token's id stands in the text of groups: after the tokens of both sides before it.
        group_a, group_b = np.searchsorted(common, ends_a), np.searchsorted(common, ends_b)
        names = np.empty(len(self.a) + len(self.b), object)
        names[np.arange(len(self.a)) + np.searchsorted(group_b, group_a)] = np.where(
            both[ends_a], a.bar[self.a], a.comma[self.a])
        names[np.arange(len(self.b)) + np.searchsorted(group_a, group_b, "right")] = np.where(
            both[ends_b], b.semicolon[self.b], b.comma[self.b])
        self.names, self.name_ends = names.tolist(), np.cumsum(self.n_a + self.n_b).tolist()

    def digests(self) -> Iterator[str]:
        start = 0
        for end in self.name_ends:
            yield hashlib.sha256("".join(self.names[start:end])[:-1].encode()).hexdigest()
            start = end

    def records(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Each pair once per document: (pair, document, links of the document)."""
        order = np.argsort(self.pair, kind="stable")
        order = order[np.argsort(self.doc[order], kind="stable")]
        pair, doc = self.pair[order], self.doc[order]
        first = np.flatnonzero(np.r_[True, (pair[1:] != pair[:-1]) | (doc[1:] != doc[:-1])])
        return pair[first], doc[first], np.diff(np.r_[first, len(pair)])


class _Chunk:
    """Records of the documents of one chunk, until they are written as runs."""

    def __init__(self, number: int, most: int):
        self.number, self.most, self.docs, self.records, self.parts = number, most, 0, 0, []

    def add(self, pair: np.ndarray, doc: np.ndarray, links: np.ndarray) -> None:
        self.parts.append((pair, doc, links))
        self.records += len(pair)

    def full(self) -> bool:
        return self.records >= self.most or self.docs >= CHUNK_DOCS

    def runs(self) -> Iterator[tuple[int, bytes, bytes]]:
        if not self.records:
            return
        pair, doc, links = (np.concatenate(c) for c in zip(*self.parts))
        part = ((pair >> np.uint64(32)) % np.uint64(PARTS)).astype(np.uint8)
        # Documents come in ascending order already; the last pass is the radix of the first id.
        order = np.argsort(pair, kind="stable")
        order = order[np.argsort(part[order], kind="stable")]
        pair, doc, links, part = pair[order], doc[order], links[order], part[order]
        cuts = np.searchsorted(part, np.arange(PARTS + 1))
        for p, (start, end) in enumerate(zip(cuts[:-1], cuts[1:])):
            if start < end:
                held = np.empty(end - start, RECORD)
                held["doc"], held["links"] = doc[start:end], links[start:end]
                yield p, _packed(_entries(pair[start:end], np.ones(end - start, np.uint64))), _packed(held)


def _packed(values: np.ndarray) -> bytes:
    return zstandard.ZstdCompressor(level=3).compress(values.tobytes())


def _unpacked(blob: bytes, kind: np.dtype) -> np.ndarray:
    return np.frombuffer(zstandard.ZstdDecompressor().decompress(blob), kind)


def _entries(pair: np.ndarray, n: np.ndarray) -> np.ndarray:
    """Sorted pairs, each once, with the sum of its counts."""
    first = np.flatnonzero(np.r_[True, pair[1:] != pair[:-1]])
    out = np.empty(len(first), ENTRY)
    out["pair"], out["n"] = pair[first], np.add.reduceat(n, first)
    return out


class _Run:
    """A sorted run, decompressed one block at a time."""

    def __init__(self, blob: bytes):
        self.reader, self.block = zstandard.ZstdDecompressor().stream_reader(blob), np.empty(0, ENTRY)

    def head(self) -> int | None:
        if not len(self.block):
            data = self.reader.read(BLOCK * ENTRY.itemsize)
            self.block = np.frombuffer(data, ENTRY)
        return int(self.block["pair"][0]) if len(self.block) else None

    def last(self) -> int:
        return int(self.block["pair"][-1])

    def upto(self, bound: int) -> np.ndarray:
        cut = int(np.searchsorted(self.block["pair"], np.uint64(bound), "right"))
        taken, self.block = self.block[:cut], self.block[cut:]
        return taken


def heap_merge(blobs: list[bytes]) -> Iterator[np.ndarray]:
    """Entries of all runs in order, equal pairs added up, a bounded block at a time."""
    runs = [_Run(b) for b in blobs]
    heap = [(head, i) for i, r in enumerate(runs) if (head := r.head()) is not None]
    heapq.heapify(heap)
    while heap:
        # All that is at hand up to where the first block ends is complete.
        bound = min(runs[i].last() for _, i in heap)
        taken = []
        while heap and heap[0][0] <= bound:
            _, i = heapq.heappop(heap)
            taken.append(runs[i].upto(bound))
            if (head := runs[i].head()) is not None:
                heapq.heappush(heap, (head, i))
        met = np.concatenate(taken)
        met = met[np.argsort(met["pair"], kind="stable")]
        yield _entries(met["pair"], met["n"])


def with_best(blocks: Iterator[np.ndarray]) -> Iterator[np.ndarray]:
    """Marks the pairs with their first id's highest count; an id's pairs may span blocks."""
    kept = np.empty(0, ENTRY)
    for block in blocks:
        kept = np.concatenate([kept, block])
        done = int(np.searchsorted(kept["pair"], kept["pair"][-1] >> np.uint64(32) << np.uint64(32)))
        if done:
            yield _marked(kept[:done])
            kept = kept[done:]
    if len(kept):
        yield _marked(kept)


def _marked(entries: np.ndarray) -> np.ndarray:
    ids = entries["pair"] >> np.uint64(32)
    first = np.flatnonzero(np.r_[True, ids[1:] != ids[:-1]])
    highest = np.repeat(np.maximum.reduceat(entries["n"], first), np.diff(np.r_[first, len(ids)]))
    out = np.empty(len(entries), COUNT)
    out["pair"], out["n"], out["best"] = entries["pair"], entries["n"], entries["n"] == highest
    return out


def _encode(path_a: str, path_b: str, chunk_records: int):
    """Rows of documents and, once a chunk is full, of its runs."""
    schema = pa.schema([
        ("chunk", pa.int64()), ("doc", pa.int32()), ("doc_id", pa.int64()), ("n_a", pa.int64()),
        ("n_b", pa.int64()), ("n_groups", pa.int64()), ("n_links", pa.int64()), ("groups_sha256", pa.string()),
        ("part", pa.int32()), ("pairs", pa.binary()), ("docs", pa.binary()),
    ])

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        a, b = _sides(path_a, path_b)
        task = TaskContext.get().partitionId() << 32
        chunk = _Chunk(task, chunk_records)

        def written() -> Iterator[pa.RecordBatch]:
            nonlocal chunk
            for part, pairs, docs in chunk.runs():
                row = {"chunk": [chunk.number], "part": [part], "pairs": [pairs], "docs": [docs]}
                yield pa.RecordBatch.from_pydict(
                    {f.name: pa.array(row.get(f.name, [None]), f.type) for f in schema}, schema=schema)
            chunk = _Chunk(chunk.number + 1, chunk_records)

        for batch in slices(batches, "_text"):
            texts = batch.column("_text").to_pylist()
            n = len(texts)
            some = [i for i, t in enumerate(texts) if t]
            spaced = [" " + texts[i] for i in some]
            ids_a, ids_b = a.encoder.encode(spaced), b.encoder.encode([texts[i] for i in some])
            good = [
                k for k, text in enumerate(spaced)
                if (raw := text.encode()) == b"".join([a.encoder.tokens[i] for i in ids_a[k]])
                and raw == b"".join([b.encoder.tokens[i] for i in ids_b[k]])
            ]
            numbers = {c: np.zeros(n, np.int64) for c in ("n_a", "n_b", "n_groups", "n_links")}
            digests = [""] * n
            if good:
                met = Aligned(a, b, [ids_a[k] for k in good], [ids_b[k] for k in good])
                at = np.array([some[k] for k in good])
                for c, values in numbers.items():
                    values[at] = getattr(met, c)
                for i, digest in zip(at.tolist(), met.digests()):
                    digests[i] = digest
                pair, doc, links = met.records()
                chunk.add(pair, (at[doc] + chunk.docs).astype(np.uint32), links.astype(np.uint32))
            yield pa.RecordBatch.from_pydict({
                "chunk": pa.array(np.full(n, chunk.number)),
                "doc": pa.array(np.arange(chunk.docs, chunk.docs + n, dtype=np.int32)),
                "doc_id": batch.column("_id"),
                **{c: pa.array(v) for c, v in numbers.items()},
                "groups_sha256": pa.array(digests, pa.string()),
                "part": pa.nulls(n, pa.int32()), "pairs": pa.nulls(n, pa.binary()), "docs": pa.nulls(n, pa.binary()),
            }, schema=schema)
            chunk.docs += n
            if chunk.full():
                yield from written()
        yield from written()

    return rows


def _grouped(batches: Iterator[pa.RecordBatch], keys: list[str]) -> Iterator[tuple[tuple, Iterator[dict]]]:
    """Rows of sorted batches by key, one row at a time."""
    rows = (row for batch in batches for i in range(batch.num_rows) for row in batch.slice(i, 1).to_pylist())
    return groupby(rows, key=lambda r: tuple(r[k] for k in keys))


def _merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One run instead of the runs of a part and group."""
    for (part, group), rows in _grouped(batches, ["part", "group"]):
        packer, out = zstandard.ZstdCompressor(level=3).compressobj(), []
        for block in heap_merge([r["pairs"] for r in rows]):
            out.append(packer.compress(block.tobytes()))
        out.append(packer.flush())
        yield pa.RecordBatch.from_pydict({
            "part": pa.array([part], pa.int32()), "run": pa.array([group], pa.int64()),
            "pairs": pa.array([b"".join(out)], pa.binary()),
        })


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The last merge of a part: counts in blocks, in the order of the first id."""
    for (part,), rows in _grouped(batches, ["part"]):
        for number, block in enumerate(with_best(heap_merge([r["pairs"] for r in rows]))):
            yield pa.RecordBatch.from_pydict({
                "part": pa.array([part], pa.int32()), "number": pa.array([number], pa.int64()),
                "pairs": pa.array([_packed(block)], pa.binary()),
            })


def _gains(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """What the documents of each run gain by the counts of its part, which come before the runs."""
    for _, rows in _grouped(batches, ["part", "split"]):
        blocks, counts = [], None
        for row in rows:
            if row["docs"] is None:
                blocks.append(_unpacked(row["pairs"], COUNT))
                continue
            if counts is None:
                counts, blocks = np.concatenate(blocks), []
            entries, held = _unpacked(row["pairs"], ENTRY), _unpacked(row["docs"], RECORD)
            at = np.repeat(np.searchsorted(counts["pair"], entries["pair"]), entries["n"].astype(np.int64))
            n = int(held["doc"].max()) + 1
            best, total = np.zeros(n, np.int64), np.zeros(n, np.int64)
            links = held["links"].astype(np.int64)
            np.add.at(best, held["doc"], links * counts["best"][at])
            np.add.at(total, held["doc"], links * counts["n"][at].astype(np.int64))
            yield pa.RecordBatch.from_pydict({
                "chunk": pa.array([row["chunk"]], pa.int64()),
                "best": pa.array([_packed(best)], pa.binary()), "total": pa.array([_packed(total)], pa.binary()),
            })


def _with_gains(docs: pa.Table, gains: pa.Table) -> pa.Table:
    """The documents of a chunk with the sums of what the parts returned for them."""
    at = docs.column("doc").to_numpy()
    n = int(at.max()) + 1 if len(at) else 0
    sums = {}
    for name in ("best", "total"):
        sums[name] = np.zeros(n, np.int64)
        for blob in gains.column(name):
            part = _unpacked(blob.as_py(), np.dtype("<i8"))
            sums[name][: len(part)] += part
    out = docs.select(["doc_id", "n_a", "n_b", "n_groups", "n_links"])
    out = out.append_column("n_best", pa.array(sums["best"][at], pa.int64()))
    out = out.append_column("count_sum", pa.array(sums["total"][at], pa.int64()))
    return out.append_column("groups_sha256", docs.column("groups_sha256"))


def _tasks(df: DataFrame, least: int) -> int:
    return max(least, int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))


def pair_counts(runs: DataFrame, most_runs: int) -> DataFrame:
    """``part``, ``number`` and blocks of (pair, documents, whether highest of its first id)."""
    merged = runs.select("part", F.col("chunk").alias("run"), "pairs")
    tasks = _tasks(runs, 1)
    while most_runs > FAN_IN:
        groups = -(-most_runs // FAN_IN)
        dealt = merged.withColumn("group", F.pmod(F.xxhash64("run"), F.lit(groups)).cast("long"))
        merged = materialise(
            dealt.repartition(tasks, "part", "group").sortWithinPartitions("part", "group")
            .select("part", "group", "pairs").mapInArrow(_merge, "part int, run long, pairs binary"),
            "pair-runs",
        )
        most_runs = groups
    return merged.repartition(min(tasks, PARTS), "part").sortWithinPartitions("part").select("part", "pairs").mapInArrow(
        _count, "part int, number long, pairs binary")


def align_tokens(
    docs: DataFrame, path_a: str, path_b: str, id_column: str = "doc_id", text_column: str = "text",
    chunk_records: int = CHUNK_RECORDS,
) -> DataFrame:
    """Per document the numbers of tokens, groups, links, links with an id's commonest partner
    (``n_best``), the sum of the counts of its links and a digest of its groups.

    ``path_a`` is a byte-level BPE file, whose text gets a space in front, ``path_b`` a
    sentence-piece model that adds one. See the module for what odd rows give.
    """
    texts = docs.select(F.col(id_column).cast("long").alias("_id"), F.col(text_column).cast("string").alias("_text"))
    stored = materialise(texts.mapInArrow(_encode(path_a, path_b, chunk_records), STORED), "token-runs")
    runs = stored.filter("part IS NOT NULL").select("chunk", "part", "pairs", "docs")
    most = runs.groupBy("part").count().agg(F.max("count")).first()[0] or 0
    counts = materialise(pair_counts(runs, most), "pair-counts")

    splits = max(1, -(-most // RUNS_PER_SPLIT))
    dealt = runs.select(
        "part", F.pmod(F.xxhash64("chunk"), F.lit(splits)).cast("int").alias("split"),
        F.lit(None).cast("long").alias("number"), "chunk", "pairs", "docs")
    copied = counts.select(
        "part", F.explode(F.sequence(F.lit(0), F.lit(splits - 1))).alias("split"), "number",
        F.lit(None).cast("long").alias("chunk"), "pairs", F.lit(None).cast("binary").alias("docs"))
    gains = (
        copied.unionByName(dealt)
        .repartition(_tasks(docs, 1), "part", "split")
        # Counts carry a number and come first, in order.
        .sortWithinPartitions("part", "split", F.col("number").asc_nulls_last())
        .select("part", "split", "chunk", "pairs", "docs")
        .mapInArrow(_gains, "chunk long, best binary, total binary")
    )
    rows = stored.filter("part IS NULL").select(
        "chunk", "doc", "doc_id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256")
    return rows.groupBy("chunk").cogroup(gains.groupBy("chunk")).applyInArrow(_with_gains, RESULT)
