"""Document fingerprints: a Merkle tree over sections, paragraphs and pieces of paragraphs.

A paragraph is a line with its line end. It is cut after words that end a sentence or whose hash
says so, so that cuts depend on nearby words only and one edit changes few pieces. A paragraph
whose hash says so ends a section. Every byte is in exactly one piece; a node's hash is taken over
its children's, and the root over all. Equal roots mean equal texts; where roots differ, only
sections that differ need to be opened to find the pieces that changed.

A fingerprint is text: ``root|section:pieces|section:pieces...`` with pieces in six digits each.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from plantwatch.llm.bytewords import _BYTE_POWERS, _SPREAD, NOT_SPACE, Words, mix, slices, text_bytes
from plantwatch.llm.frames import carry

PIECE_EVERY = 16  # one word in so many ends a piece
SECTION_EVERY = 4  # one paragraph in so many ends a section
PIECE_DIGITS = 6
_SENTENCE_END = np.zeros(256, bool)
_SENTENCE_END[[0x21, 0x2E, 0x3F]] = True


class Trees:
    """The trees of a batch of texts as flat arrays.

    ``piece``: hash per piece; ``piece_first``: first piece of each text; ``section_of``: section
    number of each piece within the batch; ``section``: hash per section.
    """

    def __init__(self, data: np.ndarray, offsets: np.ndarray):
        words = Words(data, offsets, NOT_SPACE)
        hashes = words.hashes()
        n = len(data)
        last = data[words.ends - 1] if len(words) else np.zeros(0, np.uint8)
        ends_piece = _SENTENCE_END[last] | (hashes % np.uint64(PIECE_EVERY) == 0)
        line_ends = np.flatnonzero(data == 0x0A) + 1
        # A piece begins at each text, after each line end, and behind each word that ends one.
        sizes = np.diff(offsets)
        begins = np.unique(np.concatenate([offsets[:-1][sizes > 0], line_ends, words.ends[ends_piece]]))
        begins = begins[begins < n]
        stops = np.append(begins[1:], n) if len(begins) else begins
        up, down = _BYTE_POWERS.to(n + 1)
        sums = np.zeros(n + 1, np.uint64)
        np.cumsum(_SPREAD[data] * up[:-1], out=sums[1:])
        self.begins, self.stops = begins, stops
        self.piece = mix((sums[stops] - sums[begins]) * down[begins] + (stops - begins).astype(np.uint64))
        self.piece_first = np.searchsorted(begins, offsets)
        self.texts = len(sizes)
        # Paragraphs: runs of pieces up to a line end or the text's end.
        text = np.searchsorted(offsets, begins, side="right") - 1
        opens = np.zeros(len(begins), bool)
        opens[np.isin(begins, line_ends)] = True
        opens[self.piece_first[:-1][sizes > 0]] = True
        self.paragraph_of = np.cumsum(opens) - 1
        first = np.flatnonzero(opens)
        self.paragraph = self._node(self.piece, first)
        # Sections: runs of paragraphs up to one whose hash ends it.
        closes = self.paragraph % np.uint64(SECTION_EVERY) == 0
        new_text = np.append(True, text[first][1:] != text[first][:-1]) if len(first) else np.zeros(0, bool)
        starts = new_text | np.append(True, closes[:-1])[: len(first)]
        at = np.flatnonzero(starts)
        self.section = self._node(self.paragraph, at)
        self.section_of = (np.cumsum(starts) - 1)[self.paragraph_of] if len(begins) else self.paragraph_of
        self.text = text

    @staticmethod
    def _node(children: np.ndarray, first: np.ndarray) -> np.ndarray:
        """Hash of each run of children; order and number count."""
        if not len(first):
            return np.zeros(0, np.uint64)
        sizes = np.diff(np.append(first, len(children)))
        place = np.arange(len(children)) - np.repeat(first, sizes)
        return mix(np.add.reduceat(mix(children + mix(place.astype(np.uint64) + np.uint64(1))), first) + sizes.astype(np.uint64))

    @property
    def short(self) -> np.ndarray:
        return (self.piece >> np.uint64(64 - 4 * PIECE_DIGITS)).astype(np.int64)

    def fingerprints(self) -> list[str]:
        raw = self.piece.astype(">u8").tobytes()
        digits = np.frombuffer(raw, np.uint8).reshape(-1, 8)[:, : PIECE_DIGITS // 2].tobytes().hex()
        sections = self.section.astype(">u8").tobytes().hex()
        out = []
        of = self.section_of
        for a, b in zip(self.piece_first[:-1].tolist(), self.piece_first[1:].tolist(), strict=True):
            parts = [hashlib.sha256(raw[8 * a : 8 * b]).hexdigest()[:32]]
            if b > a:
                cuts = (np.flatnonzero(of[a + 1 : b] != of[a : b - 1]) + a + 1).tolist()
                for x, y in zip([a, *cuts], [*cuts, b], strict=True):
                    s = 16 * int(of[x])
                    parts.append(f"{sections[s : s + 16]}:{digits[PIECE_DIGITS * x : PIECE_DIGITS * y]}")
            out.append("|".join(parts))
        return out


def fingerprint(text: str | None) -> str:
    return Trees(*text_bytes(pa.array([text], pa.string()))).fingerprints()[0]


def pieces_of(mark: str) -> list[list[str]]:
    """Piece hashes per section of a fingerprint."""
    groups = [part.split(":")[1] for part in mark.split("|")[1:]]
    return [[g[k : k + PIECE_DIGITS] for k in range(0, len(g), PIECE_DIGITS)] for g in groups]


def changed_pieces(one: str, other: str) -> tuple[list[int], list[int]]:
    """Numbers of the pieces of either text that the other lacks, from fingerprints alone.

    Equal roots need no look at the sections, and sections both have are not opened.
    """
    if one.split("|")[0] == other.split("|")[0]:
        return [], []
    names = [[part.split(":")[0] for part in mark.split("|")[1:]] for mark in (one, other)]
    out = []
    for me, you in ((0, 1), (1, 0)):
        mark, against = (one, other) if me == 0 else (other, one)
        theirs, spare = set(names[you]), {p for section in pieces_of(against) for p in section}
        number, changed = 0, []
        for name, own in zip(names[me], pieces_of(mark), strict=True):
            if name not in theirs:
                changed += [number + k for k, piece in enumerate(own) if piece not in spare]
            number += len(own)
        out.append(changed)
    return out[0], out[1]


def likeness(one: Trees, other: Trees) -> np.ndarray:
    """Share of pieces that the k-th texts of both have in common: 2 common / all, as multisets.

    Uses what the fingerprints hold (short piece hashes) and nothing else; two texts without
    pieces are alike.
    """
    bits = 4 * PIECE_DIGITS
    keys = [np.unique((t.text.astype(np.int64) << bits) | t.short, return_counts=True) for t in (one, other)]
    common, at, to = np.intersect1d(keys[0][0], keys[1][0], assume_unique=True, return_indices=True)
    shared = np.bincount(common >> bits, np.minimum(keys[0][1][at], keys[1][1][to]), one.texts)[: one.texts]
    total = np.diff(one.piece_first) + np.diff(other.piece_first)
    return np.where(total == 0, 1.0, 2 * shared / np.maximum(total, 1))


def edit(text: str, following: str) -> str:
    """The last third of the code points replaced by the first as many of another text."""
    third = len(text) // 3
    return text[: len(text) - third] + following[:third]


def _blocks(batches: Iterator[pa.RecordBatch], bounds: np.ndarray, first_of: dict[int, int | None], before: dict[int, int]) -> Iterator[pa.RecordBatch]:
    """Adds the block of each row, and copies of blocks' first rows for the block before."""
    for batch in slices(batches, "_text"):
        ids = batch.column("_id")
        block = _block_of(ids, bounds)
        copies = [k for k, (b, i) in enumerate(zip(block.tolist(), ids.to_pylist(), strict=True)) if b in before and first_of[b] == i]
        take = np.concatenate([np.arange(batch.num_rows), np.array(copies, np.int64)])
        targets = np.concatenate([block, np.array([before[int(block[k])] for k in copies], np.int64)])
        extra = np.arange(len(take)) >= batch.num_rows
        part = batch.take(pa.array(take))
        yield pa.RecordBatch.from_arrays(
            [part.column("_id"), part.column("_text"), pa.array(targets, pa.int64()), pa.array(extra)],
            names=["_id", "_text", "block", "extra"],
        )


def _block_of(ids: pa.Array, bounds: np.ndarray) -> np.ndarray:
    """Blocks count from the largest ids down; null ids are in the last one."""
    values = ids.fill_null(-(2**63)).to_numpy(zero_copy_only=False)
    return (len(bounds) - np.searchsorted(bounds, values, side="left")).astype(np.int64)


def _marked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows in order; each is edited with the text of the row after it in its block."""

    def flush(ids: list, texts: list[str], following: list[str]) -> pa.RecordBatch:
        edited = [edit(a, b) for a, b in zip(texts, following, strict=True)]
        own, new, nxt = (Trees(*text_bytes(pa.array(x, pa.string()))) for x in (texts, edited, following))
        return pa.RecordBatch.from_arrays(
            [
                pa.array(ids, pa.int64()), pa.array([len(t) for t in texts], pa.int64()),
                pa.array([hashlib.sha256(t.encode()).hexdigest() for t in edited]),
                pa.array(own.fingerprints()), pa.array(new.fingerprints()),
                pa.array(likeness(own, new)), pa.array(likeness(own, nxt)),
            ],
            names=["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"],
        )

    held: tuple | None = None
    ids, texts, following = [], [], []
    size = 0
    for batch in slices(batches, "_text"):
        for i, text, block, extra in zip(*(batch.column(c).to_pylist() for c in ("_id", "_text", "block", "extra")), strict=True):
            text = text or ""
            if held is not None and held[2] == block:
                ids.append(held[0])
                texts.append(held[1])
                following.append(text)
                size += len(text)
                if size > 2 << 20:
                    yield flush(ids, texts, following)
                    ids, texts, following, size = [], [], [], 0
            held = None if extra else (i, text, block)
    if ids:
        yield flush(ids, texts, following)


def fingerprint_edits(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """Fingerprints of all texts and of their edited forms, and how near they are.

    A text (null: empty) is edited with the next one in descending id order, the last one with
    the first; rows of one id follow each other by text, null ids come last, and a single row
    follows itself. Ids are dealt into ranges by quantiles; the first row of each range also goes
    to the range before, so neighbours meet although no task sees all rows. Only range bounds and
    first ids, a few per partition, reach the driver. Rows of one id stay in one range.
    """
    spark = docs.sparkSession
    rows = carry(docs, id_column, text_column).select("_id", "_text")
    count = 4 * int(spark.conf.get("spark.sql.shuffle.partitions"))
    steps = [k / count for k in range(1, count)]
    found = rows.where(F.col("_id").isNotNull()).agg(F.percentile_approx("_id", steps, 10 * count).alias("q")).first()["q"]
    bounds = np.unique(np.array(found or [], np.int64))

    def firsts(batches):
        largest: dict[int, int] = {}
        nulls = False
        for batch in batches:
            ids = batch.column(0)
            nulls |= ids.null_count > 0
            block = _block_of(ids, bounds)
            for b, i in zip(block.tolist(), ids.to_pylist(), strict=True):
                if i is not None and largest.get(b, i) <= i:
                    largest[b] = i
        if nulls:
            largest.setdefault(len(bounds), None)
        yield pa.RecordBatch.from_arrays(
            [pa.array(list(largest), pa.int64()), pa.array(list(largest.values()), pa.int64())], names=["block", "first"]
        )

    tops = rows.select("_id").mapInArrow(firsts, "block long, first long").groupBy("block").agg(F.max("first").alias("first")).collect()
    first_of = {r["block"]: r["first"] for r in tops}
    order = sorted(first_of)
    before = {b: order[k - 1] for k, b in enumerate(order)}
    dealt = rows.mapInArrow(
        lambda batches: _blocks(batches, bounds, first_of, before), "_id long, _text string, block long, extra boolean"
    )
    return (
        dealt.repartition("block")
        .sortWithinPartitions("block", "extra", F.desc_nulls_last("_id"), F.coalesce("_text", F.lit("")))
        .mapInArrow(
            _marked,
            "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, "
            "near_edited double, near_next double",
        )
    )
