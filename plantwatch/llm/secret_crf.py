"""Secret scans with a linear-chain conditional random field.

Tokens are runs of the letters secrets are made of. Each is tagged begin, inside or outside from
its shape, its neighbours' words and shapes, the signs around it, and features of the whole file.
The weights are trained in numpy on windows of tokens of a bounded sample, whose tags come from
the base patterns; the tagged spans are added to those of the patterns, which always stay.

Decoding is Viterbi. A token whose outside score leads by more than any change of its neighbours'
tags can win back is outside on every best path, so only the stretches between such tokens are
decoded step by step; the result is that of decoding whole texts.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from plantwatch.llm.bytewords import Words, slices, text_bytes
from plantwatch.llm.frames import carry

# The base patterns.
KEYWORDS = ("password", "passwd", "secret", "token", "api_?key")
_CASES = "|".join(re.sub("[a-z]", lambda m: f"[{m[0]}{m[0].upper()}]", k) for k in KEYWORDS)
ASSIGN = re.compile(f"({_CASES})[\"']?\\x20*[:=]\\x20*[\"']?([A-Za-z0-9+/_.=-]+)")
ACCESS = re.compile("AKIA[A-Z0-9]+")
HEX = re.compile("(?<![0-9a-f])[0-9a-f]{32,}")
_HINTS = ("passw", "secret", "token", "api")
KINDS = ("assign", "access", "hex", "crf")

OUTSIDE, BEGIN, INSIDE = 0, 1, 2
WINDOW = 24
# The bound of the training sample: windows around base spans, and windows of any text.
SPAN_WINDOWS = 4000
OTHER_WINDOWS = 4000
EPOCHS = 12
RATE = 0.02

TOKEN = np.zeros(256, bool)
TOKEN[[*range(0x30, 0x3A), *range(0x41, 0x5B), *range(0x61, 0x7B), *b"+/_.=-"]] = True
TOKEN[0x80:] = True
_LENGTHS = np.array([2, 3, 4, 6, 8, 12, 16, 24, 32, 48])
_WORDS = 1024
_AROUND = np.zeros(256, np.int64)
for _k, _signs in enumerate((b" ", b"\n\r", b"\"'`", b"=", b":", b"()[]{}<>", b",;.!?"), 1):
    _AROUND[list(_signs)] = _k
_BLOCKS = (11, 32, 352, 10, _WORDS, _WORDS, _WORDS, _WORDS, 9, 9, 32, 32, 12, 10)
_OFFSETS = np.concatenate([[0], np.cumsum(_BLOCKS)])
FEATURES = int(_OFFSETS[-1])


def base_spans(text: str) -> list[tuple[int, int, int, int]]:
    """(start, kind, end, start of the secret itself) of all base matches, by start, then kind."""
    out = []
    low = text.lower()
    if any(hint in low for hint in _HINTS):
        out += [(m.start(), 0, m.end(), m.start(2)) for m in ASSIGN.finditer(text) if m.end(2) - m.start(2) >= 8]
    if "AKIA" in text:
        out += [(m.start(), 1, m.end(), m.start()) for m in ACCESS.finditer(text) if m.end() - m.start() >= 16]
    out += [(m.start(), 2, m.end(), m.start()) for m in HEX.finditer(text)]
    return sorted(out)


def _has_hex(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Which texts hold a run of 32 hex digits, so that the pattern need not be tried on others."""
    allowed = np.zeros(256, bool)
    allowed[[*range(0x30, 0x3A), *range(0x61, 0x67)]] = True
    found = Words(data, offsets, allowed)
    long = found.starts[found.ends - found.starts >= 32]
    out = np.zeros(len(offsets) - 1, bool)
    out[np.searchsorted(offsets, long, side="right") - 1] = True
    return out


def _shift(values: np.ndarray, by: int, text: np.ndarray) -> np.ndarray:
    """Values of the token ``by`` places on, 0 beyond the text."""
    out = np.zeros_like(values)
    if len(values) > abs(by):
        if by < 0:
            same = text[-by:] == text[:by]
            out[-by:] = np.where(same, values[:by], 0)
        else:
            same = text[:-by] == text[by:]
            out[:-by] = np.where(same, values[by:], 0)
    return out


def features(data: np.ndarray, offsets: np.ndarray, tokens: Words) -> np.ndarray:
    """Active feature of each block for each token: (tokens, blocks)."""
    n = len(tokens)
    if not n:
        return np.zeros((0, len(_BLOCKS)), np.int32)
    s, e = tokens.starts, tokens.ends

    def count(flag: np.ndarray) -> np.ndarray:
        sums = np.zeros(len(data) + 1, np.int32)
        np.cumsum(flag, out=sums[1:])
        return sums[e] - sums[s]

    digit = (data >= 0x30) & (data <= 0x39)
    lower = (data >= 0x61) & (data <= 0x7A)
    upper = (data >= 0x41) & (data <= 0x5A)
    size = e - s
    digits, lowers, uppers, high = count(digit), count(lower), count(upper), count(data >= 0x80)
    hexes = count(digit | ((data >= 0x61) & (data <= 0x66)))
    signs = size - digits - lowers - uppers - high
    length = np.digitize(size, _LENGTHS)
    shape = (lowers > 0) + 2 * (uppers > 0) + 4 * (digits > 0) + 8 * (signs > 0) + 16 * (high > 0)
    share = np.minimum(4, 5 * digits // size) + 5 * ((hexes == size) & (size >= 8))
    word = (tokens.hashes(lower=True) % np.uint64(_WORDS)).astype(np.int64)
    text = tokens.owner()
    before = np.where(s > offsets[text], _AROUND[data[np.maximum(s - 1, 0)]], 8)
    after = np.where(e < offsets[text + 1], _AROUND[data[np.minimum(e, len(data) - 1)]], 8)
    in_text = np.maximum(tokens.counts, 1)
    many = np.minimum(11, np.log2(in_text).astype(np.int64))[text]
    odd = np.bincount(text, (digits > 0) | (signs > 1), len(in_text)) / in_text
    odd = np.minimum(9, (odd * 20).astype(np.int64))[text]
    blocks = (
        length, shape, length * 32 + shape, share, word, _shift(word, -1, text), _shift(word, -2, text),
        _shift(word, 1, text), before, after, _shift(shape, -1, text), _shift(shape, 1, text), many, odd,
    )
    return np.stack([b + o for b, o in zip(blocks, _OFFSETS[:-1], strict=True)], axis=1).astype(np.int32)


@dataclass
class Crf:
    """Scores: (features, tags), (tag, next tag), first tag. Inside never follows outside."""

    weights: np.ndarray
    moves: np.ndarray
    first: np.ndarray

    def emissions(self, active: np.ndarray) -> np.ndarray:
        out = np.zeros((len(active), 3), np.float32)
        for k in range(active.shape[1]):
            out += self.weights[active[:, k]]
        return out

    def lead(self) -> float:
        """More than any path can gain by having a token tagged in place of outside.

        Compared are paths that differ in that token, and in the next if it would be left inside.
        """
        t = self.moves
        before = [self.first[x] - self.first[OUTSIDE] for x in (BEGIN,)]
        before += [t[a, BEGIN] - t[a, OUTSIDE] for a in range(3)] + [t[a, INSIDE] - t[a, OUTSIDE] for a in (BEGIN, INSIDE)]
        ends = [t[x, c] - t[OUTSIDE, c] for x in (BEGIN, INSIDE) for c in (OUTSIDE, BEGIN)] + [0.0]
        stays = [t[x, INSIDE] - t[OUTSIDE, BEGIN] + d for x in (BEGIN, INSIDE) for d in [t[INSIDE, c] - t[BEGIN, c] for c in range(3)] + [0.0]]
        return float(max(before) + max(ends + stays)) + 1e-3

    def decode(self, scores: np.ndarray, starts_text: bool, ends_text: bool) -> list[int]:
        """Best tags of a stretch; before and behind it is outside or the text's end."""
        t = self.moves.tolist()
        first = self.first.tolist() if starts_text else t[OUTSIDE]
        rows = scores.tolist()
        blocked = float("-inf")
        best = [first[OUTSIDE] + rows[0][0], first[BEGIN] + rows[0][1], blocked]
        back = []
        for row in rows[1:]:
            now, came = [], []
            for tag in range(3):
                options = [best[a] + t[a][tag] for a in range(3)]
                if tag == INSIDE:
                    options[OUTSIDE] = blocked
                top = max(range(3), key=options.__getitem__)
                now.append(options[top] + row[tag])
                came.append(top)
            best = now
            back.append(came)
        if not ends_text:
            best = [best[a] + t[a][OUTSIDE] for a in range(3)]
        tag = max(range(3), key=best.__getitem__)
        tags = [tag]
        for came in reversed(back):
            tag = came[tag]
            tags.append(tag)
        return tags[::-1]

    def spans(self, active: np.ndarray, counts: np.ndarray) -> list[tuple[int, int]]:
        """(first, last) token of each tagged span, over all texts of a batch."""
        if not len(active):
            return []
        scores = self.emissions(active)
        text = np.repeat(np.arange(len(counts)), counts)
        last = np.append(text[1:] != text[:-1], True)
        slack = np.append(np.minimum(0, scores[1:, BEGIN] - scores[1:, INSIDE]), 0)
        slack[last] = 0
        sure = scores[:, OUTSIDE] - np.maximum(scores[:, BEGIN], scores[:, INSIDE]) + slack > self.lead()
        open_ = np.flatnonzero(~sure)
        if not len(open_):
            return []
        cut = np.flatnonzero((np.diff(open_) > 1) | (text[open_][1:] != text[open_][:-1])) + 1
        out = []
        for stretch in np.split(open_, cut):
            a, b = int(stretch[0]), int(stretch[-1])
            tags = self.decode(scores[a : b + 1], a == 0 or bool(last[a - 1]), bool(last[b]))
            for k, tag in enumerate(tags):
                if tag == BEGIN:
                    out.append((a + k, a + k))
                elif tag == INSIDE:
                    out[-1] = (out[-1][0], a + k)
        return out


def train(active: np.ndarray, tags: np.ndarray, seed: int = 11) -> Crf:
    """Maximum likelihood by Adam over windows of equal length: (windows, WINDOW, blocks) and tags."""
    crf = Crf(np.zeros((FEATURES, 3), np.float32), np.zeros((3, 3), np.float32), np.zeros(3, np.float32))
    rng = np.random.default_rng(seed)
    parts = (crf.weights, crf.moves, crf.first)
    moments = [(np.zeros_like(w), np.zeros_like(w)) for w in parts]
    step, batch = 0, 128
    barred = np.zeros((3, 3), np.float32)
    barred[OUTSIDE, INSIDE] = -1e4
    start_barred = np.array([0, 0, -1e4], np.float32)

    def add(x: np.ndarray, axis: int) -> np.ndarray:
        top = x.max(axis=axis, keepdims=True)
        return np.squeeze(top, axis) + np.log(np.exp(x - top).sum(axis=axis))

    for epoch in range(EPOCHS):
        order = rng.permutation(len(active))
        for k in range(0, len(order), batch):
            own, gold = active[order[k : k + batch]], tags[order[k : k + batch]]
            n, length = gold.shape
            scores = crf.weights[own].sum(axis=2)
            moves = crf.moves + barred
            forward = np.empty((n, length, 3), np.float32)
            forward[:, 0] = scores[:, 0] + crf.first + start_barred
            for t in range(1, length):
                forward[:, t] = scores[:, t] + add(forward[:, t - 1, :, None] + moves, 1)
            total = add(forward[:, -1], 1)
            backward = np.zeros((n, length, 3), np.float32)
            pairs = np.zeros((3, 3), np.float32)
            for t in range(length - 2, -1, -1):
                ahead = scores[:, t + 1] + backward[:, t + 1]
                joint = forward[:, t, :, None] + moves + ahead[:, None]
                pairs += np.exp(joint - total[:, None, None]).sum(axis=0)
                backward[:, t] = add(moves + ahead[:, None], 2)
            belief = np.exp(forward + backward - total[:, None, None])
            error = belief.copy()
            np.put_along_axis(error, gold[:, :, None], np.take_along_axis(error, gold[:, :, None], 2) - 1, 2)
            gold_pairs = np.zeros((3, 3), np.float32)
            np.add.at(gold_pairs, (gold[:, :-1].ravel(), gold[:, 1:].ravel()), 1)
            slope = np.zeros_like(crf.weights)
            flat = own.reshape(-1, own.shape[2])
            for block in range(flat.shape[1]):
                for tag in range(3):
                    slope[:, tag] += np.bincount(flat[:, block], error[:, :, tag].ravel(), FEATURES)
            step += 1
            slopes = (slope / n + 1e-4 * crf.weights, (pairs - gold_pairs) / n, error[:, 0].sum(axis=0) / n)
            for w, g, (m1, m2) in zip(parts, slopes, moments, strict=True):
                m1 += 0.1 * (g - m1)
                m2 += 0.001 * (g * g - m2)
                w -= RATE * (m1 / (1 - 0.9**step)) / (np.sqrt(m2 / (1 - 0.999**step)) + 1e-8)
    return crf


def _byte_places(text: str, places: list[int]) -> list[int]:
    return [len(text[:p].encode()) for p in places]


def _sample(batches: Iterator[pa.RecordBatch], share: float) -> Iterator[pa.RecordBatch]:
    """Windows of tokens with tags: one around each base span, and one of a share of all texts."""
    for batch in slices(batches, "_text"):
        data, offsets = text_bytes(batch.column("_text"))
        tokens = Words(data, offsets, TOKEN)
        hexed = _has_hex(data, offsets)
        keys = batch.column("key").to_pylist()
        wanted: list[tuple[int, int, bool, int]] = []
        tags = np.zeros(len(tokens), np.int8)
        for k, text in enumerate(batch.column("_text").to_pylist()):
            a, b = int(tokens.first[k]), int(tokens.first[k + 1])
            if not text or a == b:
                continue
            found = _spans_if_any(text, bool(hexed[k]))
            for _, _, end, secret in found:
                x, y = (int(offsets[k]) + p for p in _byte_places(text, [secret, end]))
                own = np.flatnonzero((tokens.starts[a:b] < y) & (tokens.ends[a:b] > x)) + a
                if len(own):
                    tags[own] = np.maximum(tags[own], INSIDE)
                    tags[own[0]] = BEGIN
                    wanted.append((max(a, int(own[0]) - WINDOW // 2), b, True, keys[k]))
            if keys[k] < share * 2**62:
                wanted.append((a + keys[k] % max(1, b - a - WINDOW + 1), b, False, keys[k]))
        if wanted:
            active = features(data, offsets, tokens)
            rows = []
            for at, end, near, key in wanted:
                at = max(min(at, end - WINDOW), 0)
                if end - at >= WINDOW and at >= int(tokens.first[np.searchsorted(tokens.first, end) - 1]):
                    rows.append((near, key, active[at : at + WINDOW].astype(np.int32).tobytes(), tags[at : at + WINDOW].tobytes()))
            if rows:
                columns = list(zip(*rows, strict=True))
                kinds = (pa.bool_(), pa.int64(), pa.binary(), pa.binary())
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds, strict=True)], names=["near", "key", "active", "tags"])


def _spans_if_any(text: str, hexed: bool) -> list[tuple[int, int, int, int]]:
    if hexed or "AKIA" in text:
        return base_spans(text)
    low = text.lower()
    return base_spans(text) if any(hint in low for hint in _HINTS) else []


def learn(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> Crf | None:
    """Train on at most ``SPAN_WINDOWS + OTHER_WINDOWS`` windows, picked by the hash of the id.

    Windows never cross texts; texts of fewer than ``WINDOW`` tokens give none. None without any
    window around a base span.
    """
    rows = carry(docs, id_column, text_column).select("_text", F.xxhash64("_id").bitwiseAND(F.lit(2**62 - 1)).alias("key"))
    share = min(1.0, OTHER_WINDOWS / max(1, docs.count()))
    found = rows.mapInArrow(lambda b: _sample(b, share), "near boolean, key long, active binary, tags binary")
    order = ("key", "active", "tags")
    # One pass serves both kinds: the sample keeps the first of each kind by key.
    numbered = found.where("near").orderBy(*order).limit(SPAN_WINDOWS).collect()
    if not numbered:
        return None
    numbered += found.where("not near").orderBy(*order).limit(OTHER_WINDOWS).collect()
    active = np.stack([np.frombuffer(bytes(r.active), np.int32).reshape(WINDOW, -1) for r in numbered])
    tags = np.stack([np.frombuffer(bytes(r.tags), np.int8) for r in numbered]).astype(np.int64)
    # A window that begins within a span begins it.
    tags[:, 0] = np.where(tags[:, 0] == INSIDE, BEGIN, tags[:, 0])
    return train(active, tags)


def _scan(batches: Iterator[pa.RecordBatch], crf: Crf | None) -> Iterator[pa.RecordBatch]:
    for batch in slices(batches, "_text"):
        data, offsets = text_bytes(batch.column("_text"))
        tokens = Words(data, offsets, TOKEN)
        hexed = _has_hex(data, offsets)
        tagged: dict[int, list[tuple[int, int]]] = {}
        if crf is not None:
            for a, b in crf.spans(features(data, offsets, tokens), tokens.counts):
                k = int(np.searchsorted(tokens.first, a, side="right")) - 1
                tagged.setdefault(k, []).append((int(tokens.starts[a] - offsets[k]), int(tokens.ends[b] - offsets[k])))
        rows = []
        for k, text in enumerate(batch.column("_text").to_pylist()):
            base = _spans_if_any(text or "", bool(hexed[k]))
            counts = [sum(1 for s in base if s[1] == kind) for kind in range(3)]
            every = [(s, kind, e) for s, kind, e, _ in base]
            if k in tagged:
                raw = text.encode()
                for x, y in tagged[k]:
                    s = len(raw[:x].decode())
                    e = s + len(raw[x:y].decode())
                    if all(e <= p or s >= q for p, _, q, _ in base):
                        every.append((s, 3, e))
            line = lambda spans: ",".join(f"{KINDS[kind]}:{s}:{e}" for s, kind, e in sorted(spans))
            rows.append((*counts, hashlib.sha256(line([(s, c, e) for s, c, e, _ in base]).encode()).hexdigest(), line(every)))
        columns = list(zip(*rows, strict=True))
        kinds = (pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.string())
        yield pa.RecordBatch.from_arrays(
            [batch.column("_id"), *(pa.array(c, t) for c, t in zip(columns, kinds, strict=True))],
            names=["doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "spans"],
        )


def scan(docs: DataFrame, crf: Crf | None, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """doc_id, counts of base spans, their digest, and all spans of every row.

    Spans are ``kind:start:end`` in code points, end exclusive, by start and then kind (assign,
    access, hex, crf). Tagged spans that overlap a base span are left out, as it has them. A null
    text is empty. Equal texts get equal spans; rows may repeat ids or have none.
    """
    rows = carry(docs, id_column, text_column).select("_id", "_text")
    return rows.mapInArrow(
        lambda b: _scan(b, crf), "doc_id long, n_assign long, n_access long, n_hex long, base_sha256 string, spans string"
    )
