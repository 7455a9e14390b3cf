"""Language identification by a small convolutional network over bytes.

A window of ``LENGTH`` bytes is embedded byte by byte; filters of several widths slide over it;
each filter's maximum goes through a rectifier into a softmax over the languages. The network is
trained in numpy on windows of a bounded sample of labelled rows. A text is cut into windows from
end to end, and its language is the one with the largest mean probability, weighted by bytes.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame, Window, functions as F

from plantwatch.llm.bytewords import runs, slices, text_bytes
from plantwatch.llm.frames import carry, restore

LENGTH = 256
DIMS = 8
WIDTHS = (2, 3, 4)
FILTERS = 12
# The bound of the training sample: windows per language, and of all languages together.
WINDOWS_PER_LANGUAGE = 1500
WINDOWS = 12_000
WINDOWS_PER_TEXT = 8  # at most, where a language has few texts
EPOCHS = 8
STEPS = 1000  # at least, for small samples
BATCH = 64
RATE = 0.004
UNKNOWN = "und"
MIN_SCORE = 0.3
HELD_OUT = 2  # the remainder modulo 4 of crc32(doc_id) that is never learned from
_LETTER = regex.compile(r"\p{L}")


@dataclass
class ByteCnn:
    """Weights. Byte 0 fills up short windows and is embedded as zero."""

    languages: list[str]
    embed: np.ndarray  # (256, DIMS)
    filters: dict[int, np.ndarray]  # width -> (width * DIMS, FILTERS)
    bias: np.ndarray  # (all filters,)
    dense: np.ndarray  # (all filters, languages)
    shift: np.ndarray  # (languages,)

    @staticmethod
    def fresh(languages: list[str], seed: int = 7) -> ByteCnn:
        rng = np.random.default_rng(seed)

        def normal(*shape: int, scale: float) -> np.ndarray:
            return rng.normal(0, scale, shape).astype(np.float32)

        embed = normal(256, DIMS, scale=0.5)
        embed[0] = 0
        total = FILTERS * len(WIDTHS)
        return ByteCnn(
            languages, embed, {w: normal(w * DIMS, FILTERS, scale=(w * DIMS) ** -0.5) for w in WIDTHS},
            np.zeros(total, np.float32), normal(total, len(languages), scale=total**-0.5),
            np.zeros(len(languages), np.float32),
        )

    def pooled(self, windows: np.ndarray, where: bool = False) -> tuple[np.ndarray, np.ndarray | None]:
        """Maximum of each filter over each window, and its place if asked for."""
        n, length = windows.shape
        embedded = self.embed[windows]
        tops, places = [], []
        for width in WIDTHS:
            seen = np.lib.stride_tricks.sliding_window_view(embedded.reshape(n, -1), width * DIMS, axis=1)[:, ::DIMS]
            value = seen.reshape(-1, width * DIMS) @ self.filters[width]
            value = value.reshape(n, length - width + 1, FILTERS)
            if where:
                place = value.argmax(axis=1)
                places.append(place)
                tops.append(np.take_along_axis(value, place[:, None], axis=1)[:, 0])
            else:
                tops.append(value.max(axis=1))
        return np.concatenate(tops, axis=1) + self.bias, np.concatenate(places, axis=1) if where else None

    def probabilities(self, windows: np.ndarray) -> np.ndarray:
        out = np.empty((len(windows), len(self.languages)), np.float32)
        for k in range(0, len(windows), BATCH):
            top, _ = self.pooled(windows[k : k + BATCH])
            out[k : k + BATCH] = np.maximum(top, 0) @ self.dense + self.shift
        out -= out.max(axis=1, keepdims=True)
        np.exp(out, out=out)
        return out / out.sum(axis=1, keepdims=True)

    def gradients(self, windows: np.ndarray, labels: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
        """(weights, gradient) pairs of the mean cross-entropy; only each filter's best place counts."""
        n = len(windows)
        top, place = self.pooled(windows, where=True)
        hidden = np.maximum(top, 0)
        logits = hidden @ self.dense + self.shift
        p = np.exp(logits - logits.max(axis=1, keepdims=True))
        p /= p.sum(axis=1, keepdims=True)
        p[np.arange(n), labels] -= 1
        p /= n
        back = (p @ self.dense.T) * (top > 0)
        pairs = [(self.dense, hidden.T @ p), (self.shift, p.sum(axis=0)), (self.bias, back.sum(axis=0))]
        to_embed = np.zeros_like(self.embed)
        for g, width in enumerate(WIDTHS):
            own = slice(g * FILTERS, (g + 1) * FILTERS)
            # (n, FILTERS, width) bytes under each filter's best place.
            at = place[:, own, None] + np.arange(width)
            under = windows[np.arange(n)[:, None, None], at]
            seen = self.embed[under].reshape(n, FILTERS, width * DIMS)
            pairs.append((self.filters[width], np.einsum("nfk,nf->kf", seen, back[:, own])))
            flow = back[:, own, None] * self.filters[width].T[None]
            np.add.at(to_embed, under.ravel(), flow.reshape(-1, DIMS))
        to_embed[0] = 0
        pairs.append((self.embed, to_embed))
        return pairs


def train(windows: np.ndarray, labels: np.ndarray, languages: list[str], seed: int = 7) -> ByteCnn:
    """Adam on shuffled small batches; equal samples give equal weights."""
    model = ByteCnn.fresh(languages, seed)
    rng = np.random.default_rng(seed)
    moments: dict[int, tuple[np.ndarray, np.ndarray]] = {}
    step = 0
    epochs = max(EPOCHS, -(-STEPS * BATCH // max(1, len(windows))))
    for epoch in range(epochs):
        rate = RATE * (1 - epoch / epochs)
        order = rng.permutation(len(windows))
        for k in range(0, len(order), BATCH):
            own = order[k : k + BATCH]
            step += 1
            for weights, gradient in model.gradients(windows[own], labels[own]):
                first, second = moments.setdefault(id(weights), (np.zeros_like(weights), np.zeros_like(weights)))
                first += 0.1 * (gradient - first)
                second += 0.001 * (gradient * gradient - second)
                weights -= rate * (first / (1 - 0.9**step)) / (np.sqrt(second / (1 - 0.999**step)) + 1e-8)
    return model


def cut(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """All windows of all texts: (windows, text of each, bytes of each)."""
    sizes = np.diff(offsets)
    counts = -(-sizes // LENGTH)
    text = np.repeat(np.arange(len(sizes)), counts)
    starts = np.repeat(offsets[:-1], counts) + runs(np.zeros(len(counts), np.int64), counts) * LENGTH
    lengths = np.minimum(LENGTH, offsets[1:][text] - starts)
    windows = np.zeros((len(starts), LENGTH), np.uint8)
    rows = np.repeat(np.arange(len(starts)), lengths)
    windows[rows, runs(np.zeros(len(starts), np.int64), lengths)] = data[runs(starts, lengths)]
    return windows, text, lengths


def _sample(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Some windows of each text, evenly apart from a place its row's hash picks."""
    for batch in slices(batches, "text"):
        data, offsets = text_bytes(batch.column("text"))
        counts = np.maximum(-(-np.diff(offsets) // LENGTH), 1).tolist()
        rows: list[tuple] = []
        columns = (batch.column(c).to_pylist() for c in ("lang", "key", "take"))
        for k, (lang, key, take) in enumerate(zip(*columns, strict=True)):
            parts = min(take, counts[k])
            for place in range(parts):
                start = int(offsets[k]) + (key + place * counts[k] // parts) % counts[k] * LENGTH
                own = data[start : min(start + LENGTH, int(offsets[k + 1]))]
                rows.append((lang, key, own.tobytes()))
        kinds = (pa.string(), pa.int64(), pa.binary())
        yield pa.RecordBatch.from_arrays(
            [pa.array(c, t) for c, t in zip(zip(*rows, strict=True), kinds, strict=True)], names=["lang", "key", "window"]
        )


def may_learn(doc_id: Column) -> Column:
    return F.pmod(F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")), F.lit(4)) != HELD_OUT


def learn(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", lang_column: str = "lang") -> ByteCnn | None:
    """Train on at most ``WINDOWS`` windows of labelled rows that are not held out.

    Rows are picked by the hash of id and text, so that each language gives about
    ``WINDOWS_PER_LANGUAGE`` of them, and with many languages no more than its part of all.
    None without labelled rows.
    """
    rows = docs.select(F.col(id_column).alias("id"), F.col(text_column).alias("text"), F.col(lang_column).cast("string").alias("lang"))
    usable = rows.where(F.col("lang").isNotNull() & F.col("text").isNotNull() & may_learn(F.col("id")))
    counted = usable.groupBy("lang").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "lang").limit(WINDOWS).collect()
    sizes = {r.lang: r.n for r in counted}
    shares = {lang: min(1.0, WINDOWS_PER_LANGUAGE / n) for lang, n in sizes.items()}
    if not shares:
        return None
    share = F.create_map(*[F.lit(x) for pair in shares.items() for x in pair])[F.col("lang")]
    taken = {lang: min(WINDOWS_PER_TEXT, max(1, -(-WINDOWS_PER_LANGUAGE // sizes[lang]))) for lang in shares}
    take = F.create_map(*[F.lit(x) for pair in taken.items() for x in pair])[F.col("lang")]
    key = F.xxhash64("id", "lang").bitwiseAND(F.lit(2**62 - 1))
    picked = usable.withColumn("key", key).withColumn("take", take).where(F.col("key") < share * float(2**62))
    # Keys of rare languages are spread wider than those of others, so no cut may go by the key alone.
    rank = F.row_number().over(Window.partitionBy("lang").orderBy("key", "window"))
    found = (
        picked.mapInArrow(_sample, "lang string, key long, window binary").withColumn("rank", rank)
        .where(F.col("rank") <= WINDOWS // len(shares)).orderBy("key", "lang", "window").collect()
    )
    languages = sorted({r.lang for r in found})
    if not languages:
        return None
    windows = np.zeros((len(found), LENGTH), np.uint8)
    for k, r in enumerate(found):
        windows[k, : len(r.window)] = np.frombuffer(bytes(r.window), np.uint8)
    labels = np.array([languages.index(r.lang) for r in found])
    return train(windows, labels, languages)


def _predict(batches: Iterator[pa.RecordBatch], model: ByteCnn | None) -> Iterator[pa.RecordBatch]:
    for batch in slices(batches, "_text"):
        data, offsets = text_bytes(batch.column("_text"))
        n = batch.num_rows
        letters = np.array([t is not None and bool(_LETTER.search(t)) for t in batch.column("_text").to_pylist()], bool)
        names, scores = [UNKNOWN] * n, np.zeros(n)
        if model is not None and n:
            windows, text, lengths = cut(data, offsets)
            mass = np.zeros((n, len(model.languages)))
            np.add.at(mass, text, model.probabilities(windows) * lengths[:, None])
            best = mass.argmax(axis=1)
            scores = np.where(letters, mass[np.arange(n), best] / np.maximum(np.diff(offsets), 1), 0.0).clip(0, 1)
            names = [model.languages[b] if ok else UNKNOWN for b, ok in zip(best.tolist(), letters.tolist(), strict=True)]
        yield pa.RecordBatch.from_arrays(
            [batch.column("_id"), batch.column("_text"), batch.column("_rest"), pa.array(names, pa.string()), pa.array(scores, pa.float64())],
            names=["_id", "_text", "_rest", "_lang", "_score"],
        )


def identify(docs: DataFrame, model: ByteCnn | None, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """Each row with ``_lang`` and ``_score``.

    Only the text decides. ``und`` with score 0 for a null text, one without any letter, or when
    nothing was learned. Equal texts get equal answers.
    """
    rows = carry(docs, id_column, text_column)
    kinds = {f.name: f.dataType.simpleString() for f in rows.schema}
    schema = f"_id long, _text string, _rest {kinds['_rest']}, _lang string, _score double"
    return rows.mapInArrow(lambda batches: _predict(batches, model), schema)


def in_known_language(docs: DataFrame, min_score: float = MIN_SCORE, **columns) -> DataFrame:
    """The documents whose text has letters and a language recognised with ``min_score`` or more."""
    found = identify(docs, learn(docs), **columns)
    kept = found.where((F.col("_lang") != UNKNOWN) & (F.col("_score") >= min_score))
    return restore(kept, docs.columns)
