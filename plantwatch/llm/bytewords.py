"""Words of many texts at once: numpy over the UTF-8 bytes of an Arrow string column.

A batch is one byte buffer. Words are runs of the bytes a table allows, broken at text ends.
Word and window hashes come from running sums of a polynomial with an odd base modulo 2**64,
so that no Python code runs per word.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

_BASE = np.uint64(0x9E3779B97F4A7C15 | 1)
_UNBASE = np.uint64(pow(int(_BASE), -1, 2**64))
_STEP = np.uint64(0xD1B54A32D192ED03)
_UNSTEP = np.uint64(pow(int(_STEP), -1, 2**64))
_MIX_A = np.uint64(0xBF58476D1CE4E5B9)
_MIX_B = np.uint64(0x94D049BB133111EB)
# Bytes or words whose running sums are held at once; hashes do not depend on it.
BLOCK = 1 << 17
_SPREAD = np.random.default_rng(20240229).integers(1, 2**63, 256, dtype=np.uint64)

# Bytes that end a word: white space in the sense of ASCII.
SPACES = np.zeros(256, bool)
SPACES[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
NOT_SPACE = ~SPACES
# Bytes of a word in the sense of the benchmark search: digits, letters, all beyond ASCII.
ALNUM = np.zeros(256, bool)
ALNUM[0x30:0x3A] = True
ALNUM[0x41:0x5B] = True
ALNUM[0x61:0x7B] = True
ALNUM[0x80:] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[0x41:0x5B] += 32


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective scrambling of 64-bit values."""
    x = (x ^ (x >> np.uint64(30))) * _MIX_A
    x = (x ^ (x >> np.uint64(27))) * _MIX_B
    return x ^ (x >> np.uint64(31))


def _powers(base: np.uint64, n: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    if n:
        out[0] = 1
    return np.cumprod(out)


class _Powers:
    """Powers of a base and of its inverse: as many as one block asks for are kept."""

    def __init__(self, base: np.uint64, inverse: np.uint64):
        self.base, self.inverse = base, inverse
        self.up, self.down = _powers(base, BLOCK + 1), _powers(inverse, BLOCK + 1)

    def to(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if n > len(self.up):
            # A word or window of more than a block: its powers go with it.
            return _powers(self.base, n), _powers(self.inverse, n)
        return self.up[:n], self.down[:n]


_BYTE_POWERS = _Powers(_BASE, _UNBASE)
_WORD_POWERS = _Powers(_STEP, _UNSTEP)


def text_bytes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of all texts and the offsets between them; a null text has no bytes."""
    if texts.null_count:
        texts = texts.fill_null("")
    if pa.types.is_large_string(texts.type) or pa.types.is_large_binary(texts.type):
        kind = np.int64
    else:
        kind = np.int32
    buffers = texts.buffers()
    offsets = np.frombuffer(buffers[1], kind)[texts.offset : texts.offset + len(texts) + 1].astype(np.int64)
    if buffers[2] is None or not len(texts):
        return np.zeros(0, np.uint8), np.zeros(len(texts) + 1, np.int64)
    data = np.frombuffer(buffers[2], np.uint8)[offsets[0] : offsets[-1]]
    return data, offsets - offsets[0]


class Words:
    """Byte ranges of all words of a batch: ``starts``, ``ends``, and ``first`` of each text."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray, allowed: np.ndarray):
        self.data, self.offsets = data, offsets
        inside = allowed[data]
        edge = np.empty(len(data) + 1, bool)
        edge[1:-1] = inside[1:] != inside[:-1]
        edge[0], edge[-1] = (bool(inside[0]), bool(inside[-1])) if len(data) else (False, False)
        cuts = offsets[1:-1]
        cuts = np.unique(cuts[(cuts > 0) & (cuts < len(data))])
        joined = cuts[inside[cuts] & inside[cuts - 1]] if len(cuts) else cuts
        # A text end inside a run of word bytes is an end and a start at one place.
        at = np.sort(np.concatenate([np.flatnonzero(edge), joined, joined])) if len(joined) else np.flatnonzero(edge)
        self.starts, self.ends = at[0::2], at[1::2]
        self.first = np.searchsorted(self.starts, offsets)

    def __len__(self) -> int:
        return len(self.starts)

    @property
    def counts(self) -> np.ndarray:
        return np.diff(self.first)

    def owner(self) -> np.ndarray:
        """The text each word is of."""
        return np.repeat(np.arange(len(self.counts)), self.counts)

    def hashes(self, lower: bool = False) -> np.ndarray:
        spread = _SPREAD[LOWER] if lower else _SPREAD
        out = np.empty(len(self.starts), np.uint64)
        at = 0
        while at < len(out):
            # As many whole words as a block holds, one at least.
            low = self.starts[at]
            stop = max(at + 1, int(np.searchsorted(self.ends, low + BLOCK, side="right")))
            starts, ends = self.starts[at:stop] - low, self.ends[at:stop] - low
            size = int(ends[-1])
            up, down = _BYTE_POWERS.to(size + 1)
            sums = np.zeros(size + 1, np.uint64)
            np.cumsum(spread[self.data[low : low + size]] * up[:-1], out=sums[1:])
            out[at:stop] = mix((sums[ends] - sums[starts]) * down[starts] + (ends - starts).astype(np.uint64))
            at = stop
        return out


def window_hashes(words: np.ndarray, size: int) -> np.ndarray:
    """Hash of each run of ``size`` consecutive values; text ends are the caller's matter."""
    if len(words) < size:
        return np.zeros(0, np.uint64)
    out = np.empty(len(words) - size + 1, np.uint64)
    step = max(BLOCK - size + 1, size)
    for at in range(0, len(out), step):
        block = words[at : at + step + size - 1]
        up, down = _WORD_POWERS.to(len(block) + 1)
        sums = np.zeros(len(block) + 1, np.uint64)
        np.cumsum(block * up[:-1], out=sums[1:])
        out[at : at + step] = mix((sums[size:] - sums[:-size]) * down[: len(block) - size + 1])
    return out


def window_starts(first: np.ndarray, size: int) -> np.ndarray:
    """Word positions at which a run of ``size`` words lies within one text."""
    counts = np.maximum(np.diff(first) - size + 1, 0)
    return runs(first[:-1], counts)


def runs(starts: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """start, start + 1, ... for each start, ``counts`` values each, one after the other."""
    total = int(counts.sum())
    if not total:
        return np.zeros(0, np.int64)
    ends = np.cumsum(counts)
    return np.arange(total) + np.repeat(starts - (ends - counts), counts)


def covered(n: int, starts: np.ndarray, lengths: np.ndarray | int) -> np.ndarray:
    """Which of ``n`` positions lie in any of the ranges."""
    change = np.zeros(n + 1, np.int64)
    np.add.at(change, starts, 1)
    np.add.at(change, starts + lengths, -1)
    return np.cumsum(change[:-1]) > 0


def slices(batches: Iterator[pa.RecordBatch], column: str, limit: int = 1 << 20) -> Iterator[pa.RecordBatch]:
    """The batches cut so that the texts of one hold about ``limit`` bytes (one text may hold more)."""
    for batch in batches:
        at, n = 0, batch.num_rows
        if not n:
            continue
        sizes = np.cumsum(pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False))
        while at < n:
            before = sizes[at - 1] if at else 0
            end = max(at + 1, int(np.searchsorted(sizes, before + limit, side="right")))
            yield batch.slice(at, end - at)
            at = end
