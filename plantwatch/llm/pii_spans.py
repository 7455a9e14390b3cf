"""Personal data in texts, also in disguise, by transducers that keep offsets.

Two passes over each text. The base pass finds addresses, IP numbers, card and phone numbers as
they are written. The second pass sends the text through transducers: look-alike characters to
ASCII and invisible ones away, entities and bracketed or spelled dots to dots, spelled digits to
digits, disguised at signs to at signs. Each transducer records its edits, so that what the same
detectors find in the normalised text is mapped back, edit by edit, to code points of the source.
A span found this way is added if it meets no base span, or, for addresses, if it is a longer form of
base spans and cuts none; base spans always stay.

Every detector and transducer is linear in the length of a text: gaps between the parts of a
disguise are bounded, runs are matched possessively.

Null texts count as empty; rows that share an id are texts of their own; a null id stays null.
Further columns are ignored and an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
import re
import sys
import unicodedata
from bisect import bisect_left, bisect_right
from collections.abc import Callable, Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from plantwatch.llm.bytewords import slices

KINDS = ("email", "ip", "card", "phone")
Span = tuple[int, int]

# ---- detectors ----------------------------------------------------------------------------

_DOMAIN = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)+")
_LOCAL_END = re.compile(r"[A-Za-z0-9._%+-]*\Z")
_LOCAL_CHARS = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
# A match can start inside a run of digits only where the whole run fails as well.
_IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
_CARD = re.compile(r"(?<![0-9])[0-9](?:[ -]?[0-9])++")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_NOT_DIGIT = re.compile(r"[^0-9]+")


def emails(text: str) -> list[Span]:
    """Every at sign with a local part before it and a domain of two labels or more behind it."""
    found, done, at = [], 0, text.find("@")
    while at >= 0:
        start = at
        while start > done and text[start - 1] in _LOCAL_CHARS:
            start -= 1
        match = _DOMAIN.match(text, at + 1) if start < at else None
        if match:
            found.append((start, match.end()))
        done = match.end() if match else at + 1
        at = text.find("@", done)
    return found


def ips(text: str) -> list[Span]:
    return [
        m.span() for m in _IP.finditer(text)
        if all(len(p.lstrip("0")) <= 3 and int(p[-4:]) <= 255 for p in m.group().split("."))
    ]


def luhn(digits: str) -> bool:
    total = sum(int(d) for d in digits[-1::-2])
    return (total + sum(d * 2 - 9 * (d > 4) for d in map(int, digits[-2::-2]))) % 10 == 0


def cards(text: str) -> list[Span]:
    found = []
    for m in _CARD.finditer(text):
        if m.end() - m.start() >= 14:
            digits = _NOT_DIGIT.sub("", m.group())
            if len(digits) <= 19 and len(digits) >= 14 and luhn(digits):
                found.append(m.span())
    return found


def phones(text: str) -> list[Span]:
    return [
        m.span() for m in _PHONE.finditer(text)
        if m.end() - m.start() > 10 and 10 <= len(_NOT_DIGIT.sub("", m.group())) <= 15
    ]


DETECTORS: dict[str, Callable[[str], list[Span]]] = {"email": emails, "ip": ips, "card": cards, "phone": phones}

# ---- transducers --------------------------------------------------------------------------


class Tape:
    """A text made from another by replacing ranges; maps ranges of it back."""

    def __init__(self, source: str, edits: list[tuple[int, int, str]]):
        """``edits``: (start, end, new text) in the source, in order and apart."""
        self.starts, self.ends, self.origins, self.origin_ends = [], [], [], []
        pieces, at, size = [], 0, 0
        for start, end, new in edits:
            pieces += (source[at:start], new)
            size += start - at
            self.starts.append(size)
            size += len(new)
            self.ends.append(size)
            self.origins.append(start)
            self.origin_ends.append(end)
            at = end
        pieces.append(source[at:])
        self.text = "".join(pieces)

    def origin(self, span: Span) -> Span:
        """The source range of a range; one that cuts an edit takes all of what the edit replaced."""
        start, end = span
        i = bisect_right(self.starts, start) - 1
        if i >= 0:
            start = self.origins[i] if start < self.ends[i] else start - self.ends[i] + self.origin_ends[i]
        i = bisect_left(self.starts, end) - 1
        if i >= 0:
            end = self.origin_ends[i] if end <= self.ends[i] else end - self.ends[i] + self.origin_ends[i]
        return start, end


# Letters of other scripts that look like ASCII ones, and the ASCII ones.
LOOK_ALIKES = (
    "АВЕЅІЈКМНОРСТУХаеѕіјорсухԁԛԝһӏ" + "ΑΒΕΖΗΙΚΜΝΟΡΤΥΧορνικαυ" + "․‧·。｡٠۰",
    "ABESIJKMHOPCTYXaesijopcyxdqwhl" + "ABEZHIKMNOPTYXopvikau" + ".....00",
)
# Words for digits, dots, at signs and other signs; endings of domain names.
DIGITS = (
    "zero one two three four five six seven eight nine", "oh",
    "cero uno dos tres cuatro cinco seis siete ocho nueve", "zéro un deux trois quatre cinq six sept huit neuf",
    "null eins zwei drei vier fünf sechs sieben acht neun",
)
DOT_WORDS = ("dot", "punkt", "punto", "point", "d0t")
AT_WORDS = ("at", "arroba", "arobase", "klammeraffe")
ENDINGS = (
    "com org net edu gov mil int info biz dev app name pro io ai co me tv eu us uk ca au nz ie de at ch fr be nl lu "
    "es pt it pl cz se no dk fi gr ru ua tr in cn jp kr sg hk br mx ar cl pe za test example invalid local"
).split()

_DIGIT_OF = {w: str(i) for line in DIGITS if line != "oh" for i, w in enumerate(line.split())} | {"oh": "0"}
_ENTITY = re.compile(r"&#0*64;|&#x0*40;|&commat;|%40|&#0*46;|&#x0*2e;|&period;|%2e", re.I)
_DOTS = "|".join(map(re.escape, DOT_WORDS))
_ATS = "|".join(AT_WORDS)
_GAP = r"[ \t_-]{1,3}"
_DOT = re.compile(
    rf"[ \t]{{0,3}}[\[({{<][ \t]{{0,3}}(?:{_DOTS}|\.)[ \t]{{0,3}}[\])}}>][ \t]{{0,3}}"
    rf"|(?<=[^\W_]){_GAP}(?:{_DOTS}){_GAP}(?=[^\W_])", re.I)
_AT = re.compile(
    rf"[ \t]{{0,3}}(?:\[[ \t]{{0,3}}(?:{_ATS}|@|a)[ \t]{{0,3}}\]|\([ \t]{{0,3}}(?:{_ATS}|@|a)[ \t]{{0,3}}\)"
    rf"|\{{[ \t]{{0,3}}(?:{_ATS}|@|a)[ \t]{{0,3}}\}}|<[ \t]{{0,3}}(?:{_ATS}|@)[ \t]{{0,3}}>)[ \t]{{0,3}}"
    rf"|(?P<bare>(?<=[A-Za-z0-9._%+-]){_GAP}(?:{_ATS}){_GAP}|[ \t]{{1,3}}@[ \t]{{0,3}}|(?<![ \t])@[ \t]{{1,3}})"
    r"(?=[A-Za-z0-9])", re.I)
_HOST = re.compile(r"[A-Za-z0-9-]{1,63}+(?:\.[A-Za-z0-9-]{1,63}+){1,12}")
_WORD = re.compile(
    r"(?<![^\W_])(?:(?P<times>double|triple)[ \t-]{1,3})?(?P<digit>"
    + "|".join(sorted(_DIGIT_OF, key=len, reverse=True)) + r")(?![^\W_])", re.I)
_SIGN = re.compile(r"(?<![^\W_])(?:(?P<plus>plus)[ \t-]{1,3}(?=[0-9(])|(?<=[0-9])[ \t]{0,3}(?:dash|hyphen)[ \t]{0,3}(?=[0-9]))", re.I)
_NUMBER = re.compile(r"(?<![A-Za-z0-9])[0-9OoIl]*[0-9][0-9OoIl]*(?![A-Za-z0-9])")
_LETTER_DIGITS = str.maketrans("OoIl", "0011")
_NEAR = frozenset(" \t,.-()+/")


@lru_cache(maxsize=1)
def _ascii_table() -> dict[int, str | None]:
    """Look-alikes by rule: compatibility forms, digits, dashes and spaces; None for the invisible."""
    table: dict[int, str | None] = {}
    for code in range(0x80, sys.maxunicode + 1):
        c = chr(code)
        kind = unicodedata.category(c)
        if kind == "Cf" or code == 0x34F or 0xFE00 <= code <= 0xFE0F:
            table[code] = None
        elif kind == "Nd":
            table[code] = str(unicodedata.digit(c))
        elif kind == "Pd":
            table[code] = "-"
        elif kind == "Zs":
            table[code] = " "
        elif kind[0] in "LNSP":
            plain = unicodedata.normalize("NFKC", c)
            if len(plain) == 1 and "!" <= plain <= "~":
                table[code] = plain
    table.update({ord(c): plain for c, plain in zip(*LOOK_ALIKES)})
    return table


@lru_cache(maxsize=1)
def _invisible() -> re.Pattern:
    return re.compile("[" + "".join(re.escape(chr(c)) for c, to in _ascii_table().items() if to is None) + "]+")


@lru_cache(maxsize=1)
def _visible_table() -> dict[int, str]:
    return {c: to for c, to in _ascii_table().items() if to is not None}


def _entities(text: str) -> list[tuple[int, int, str]]:
    if "&" not in text and "%" not in text:
        return []
    signs = ("64", "40", "comm")
    return [(*m.span(), "@" if any(s in m.group().lower() for s in signs) else ".") for m in _ENTITY.finditer(text)]


def _dots(text: str, low: str) -> list[tuple[int, int, str]]:
    if not any(w in low for w in (*DOT_WORDS, "[.", "(.", "{.", "<.", "[ .", "( .", "{ .", "< .")):
        return []
    return [(*m.span(), ".") for m in _DOT.finditer(text)]


def _spelled(text: str) -> list[tuple[int, int, str]]:
    """Digits for digit words beside another digit or a dot; the blanks between them go."""
    words = [(m.start(), m.end(), _DIGIT_OF[m["digit"].lower()] * {"d": 2, "t": 3}.get((m["times"] or " ")[0].lower(), 1))
             for m in _WORD.finditer(text)]

    def number_near(at: int, step: int) -> bool:
        for _ in range(4):
            if not 0 <= at < len(text):
                return False
            if text[at] in "0123456789":
                return True
            if text[at] not in _NEAR:
                return False
            at += step
        return False

    def gap(i: int) -> str | None:
        """What stands between word i and the next one, if that is near."""
        if i < 0 or i + 1 >= len(words) or words[i + 1][0] - words[i][1] > 3:
            return None
        between = text[words[i][1] : words[i + 1][0]]
        return between if set(between) <= _NEAR else None

    edits = []
    for i, (start, end, digits) in enumerate(words):
        before, after = gap(i - 1), gap(i)
        if before is None and after is None and not number_near(start - 1, -1) and not number_near(end, 1):
            continue
        edits.append((start, end, digits))
        if after is not None and after.strip(" \t,") == "":
            edits.append((end, words[i + 1][0], ""))
    return edits


def _signs(text: str) -> list[tuple[int, int, str]]:
    return [(*m.span(), "+" if m["plus"] else "-") for m in _SIGN.finditer(text)]


def _ats(tapes: list[Tape], text: str, low: str) -> list[tuple[int, int, str]]:
    """At signs for disguises with a host behind them.

    A bare word or a spaced sign is taken for one only before a known ending; the word also asks
    for a disguised dot in the host or a local part that no plain word is.
    """
    if "@" not in text and not any(w in low for w in (*AT_WORDS, "(a", "[a", "{a")):
        return []
    edits = []
    for m in _AT.finditer(text):
        host = _HOST.match(text, m.end())
        if not host or not text[m.start() - 1 : m.start()].strip():
            continue
        ending = host.group().rsplit(".", 1)[1].lower()
        bracketed = m["bare"] is None
        if bracketed and "a" == m.group().strip(" \t[](){}<>").lower():
            bracketed = False
        if bracketed:
            good = len(ending) >= 2 and ending.isalpha()
        else:
            good = ending in ENDINGS
            if good and "@" not in m.group():
                start, end = host.span()
                for tape in reversed(tapes):
                    start, end = tape.origin((start, end))
                local = text[max(0, m.start() - 64) : m.start()].split()[-1]
                good = end - start != len(host.group()) or not local.isalpha()
        if good:
            edits.append((*m.span(), "@"))
    return edits


def disguised(text: str) -> tuple[str, list[Tape]]:
    """The normalised text and the tapes that lead to it."""
    tapes: list[Tape] = []

    def step(edits: list[tuple[int, int, str]]) -> None:
        nonlocal text
        if edits:
            tapes.append(Tape(text, edits))
            text = tapes[-1].text

    if not text.isascii():
        if any(unicodedata.category(c) == "Cf" or c in "͏" or "︀" <= c <= "️" for c in set(text)):
            step([(*m.span(), "") for m in _invisible().finditer(text)])
        text = text.translate(_visible_table())  # one for one: offsets stay
    step(_entities(text))
    step(_dots(text, text.lower()))
    step(_spelled(text))
    step(_signs(text))
    if "O" in text or "l" in text or "o" in text or "I" in text:
        text = _NUMBER.sub(lambda m: m.group().translate(_LETTER_DIGITS), text)
    step(_ats(tapes, text, text.lower()))
    return text, tapes


# ---- both passes --------------------------------------------------------------------------


def _longer(span: Span, taken: list[Span], same: list[Span]) -> bool:
    """Whether a span holds a base span of its kind, and more, and cuts none."""
    met = taken[bisect_left(taken, (span[0], 0)) : bisect_left(taken, (span[1], 0))]
    before = bisect_left(taken, (span[0], 0)) - 1
    if not met or span in same or (before >= 0 and taken[before][1] > span[0]):
        return False
    return all(s in same and s[1] <= span[1] for s in met)


def find(text: str) -> tuple[dict[str, list[Span]], dict[str, list[Span]]]:
    """Base spans and added spans of each kind, in code points of the text."""
    base = {k: detect(text) for k, detect in DETECTORS.items()}
    plain, tapes = disguised(text)
    added: dict[str, list[Span]] = {k: [] for k in KINDS}
    if plain == text:
        return base, added
    taken = sorted(s for spans in base.values() for s in spans)
    starts = [s for s, _ in taken]
    reach, furthest = [], 0
    for _, end in taken:
        furthest = max(furthest, end)
        reach.append(furthest)
    for kind, detect in DETECTORS.items():
        for span in detect(plain):
            for tape in reversed(tapes):
                span = tape.origin(span)
            i = bisect_left(starts, span[1]) - 1
            if i < 0 or reach[i] <= span[0] or (kind == "email" and _longer(span, taken, base[kind])):
                added[kind].append(span)
    return base, added


def _listed(spans: dict[str, list[Span]]) -> str:
    found = sorted((s, k, e) for k, kind in enumerate(KINDS) for s, e in spans[kind])
    return ",".join(f"{KINDS[k]}:{s}:{e}" for s, k, e in found)


def _scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in slices(batches, "_text"):
        counts: dict[str, list[int]] = {k: [] for k in KINDS}
        bases, digests, spans = [], [], []
        for text in batch.column("_text").to_pylist():
            base, added = find(text or "")
            for k in KINDS:
                counts[k].append(len(base[k]))
            listed = _listed(base)
            bases.append(listed)
            digests.append(hashlib.sha256(listed.encode()).hexdigest())
            spans.append(_listed({k: base[k] + added[k] for k in KINDS}))
        yield pa.RecordBatch.from_pydict({
            "doc_id": batch.column("_id"),
            **{f"n_{k}": pa.array(counts[k], pa.int64()) for k in KINDS},
            "base_sha256": pa.array(digests, pa.string()),
            "spans": pa.array(spans, pa.string()),
            "base_spans": pa.array(bases, pa.string()),
        })


def scan_private(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """Per text: numbers of base spans by kind, a digest of them, all spans and the base spans.

    Spans are ``kind:start:end`` in code points, end exclusive, by start and then kind. Nothing is
    shuffled. See the module for null ids, null texts and repeated rows.
    """
    texts = docs.select(F.col(id_column).cast("long").alias("_id"), F.col(text_column).cast("string").alias("_text"))
    return texts.mapInArrow(
        _scan,
        "doc_id long, n_email long, n_ip long, n_card long, n_phone long, base_sha256 string, spans string, "
        "base_spans string",
    )
