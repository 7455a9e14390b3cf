"""Operators 11 to 13 over awkward tables, against plain Python."""

from __future__ import annotations

import hashlib
import random
import re
from collections import Counter

import public_tokenizers
import pytest
import sentencepiece
from tokenizers import Tokenizer

from plantwatch.llm import pii_spans, spill_align, turn_repair

PATH_A, PATH_B = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
SCHEMA = "doc_id long, text string, _id string, _text string, chunk int, part int, conv string"


def _table(spark, rows):
    return spark.createDataFrame([(i, t, "x", "y", 1, 2, "z") for i, t in rows], SCHEMA).repartition(3)


# ---- 11 -----------------------------------------------------------------------------------

BASE = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def _plain_base(text: str) -> list[tuple[int, int, int]]:
    found = []
    for k, (kind, pattern) in enumerate(BASE.items()):
        for m in re.finditer(pattern, text):
            digits = [int(c) for c in m[0] if c in "0123456789"]
            if kind == "ip" and any(int(p) > 255 for p in m[0].split(".")):
                continue
            if kind == "card":
                doubled = [d if i % 2 == 0 else sum(divmod(2 * d, 10)) for i, d in enumerate(reversed(digits))]
                if not 14 <= len(digits) <= 19 or sum(doubled) % 10:
                    continue
            if kind == "phone" and not 10 <= len(digits) <= 15:
                continue
            found.append((m.start(), k, m.end()))
    return sorted(found)


DISGUISED = [
    ("mail john dot doe at example dot com today", "email", "john dot doe at example dot com"),
    ("jane [at] example [dot] org", "email", "jane [at] example [dot] org"),
    ("jane(at)example.org!", "email", "jane(at)example.org"),
    ("user@example dot com", "email", "user@example dot com"),
    ("ｊａｎｅ＠ｅｘａｍｐｌｅ．ｃｏｍ", "email", "ｊａｎｅ＠ｅｘａｍｐｌｅ．ｃｏｍ"),
    ("é jоhn@exаmple.com", "email", "jоhn@exаmple.com"),
    ("bob &#64; example&#46;com", "email", "bob &#64; example&#46;com"),
    ("call plus one five five five one two three four five six seven now", "phone",
     "plus one five five five one two three four five six seven"),
    ("+1 (five five five) 123 4567", "phone", "+1 (five five five) 123 4567"),
    ("一 +１ (５５５) １２３-４５６７", "phone", "+１ (５５５) １２３-４５６７"),
    ("ip 192[.]168[.]1[.]1", "ip", "192[.]168[.]1[.]1"),
    ("one nine two dot one six eight dot one dot one", "ip", "one nine two dot one six eight dot one dot one"),
    ("4111–1111–1111–1111", "card", "4111–1111–1111–1111"),
    ("pay four one one one one one one one one one one one one one one one", "card",
     "four one one one one one one one one one one one one one one one"),
]
CLEAN = [
    "meet us at example.com for lunch", "look at node dot js", "no one at home, two of them", "either (a) U.S. law",
    "we scored four two and then one one", "point five plus two makes three", "version 1.2.3 at 10.20",
    "le point final est un deux trois", "",
]


def test_disguised_spans_are_found_and_mapped_back():
    for text, kind, wanted in DISGUISED:
        base, added = pii_spans.find(text)
        spans = base[kind] + added[kind]
        assert [text[s:e] for s, e in spans] == [wanted], text


def test_clean_texts_have_no_spans():
    for text in CLEAN:
        base, added = pii_spans.find(text)
        assert not any(base.values()) and not any(added.values()), text


def test_base_detectors_agree_with_their_patterns():
    rng = random.Random(4)
    for _ in range(20_000):
        text = "".join(rng.choice("a.@-+1234 0(9%é") for _ in range(rng.randint(0, 60)))
        base, _ = pii_spans.find(text)
        assert sorted((s, k, e) for k, kind in enumerate(BASE) for s, e in base[kind]) == _plain_base(text)


def test_scan_over_an_awkward_table(spark):
    long = "word 1 2 " * 300_000 + "a@b.de 10.0.0.1" + " " * 200_000 + "9" * 5_000
    rows = [(k, t) for k, (t, _, _) in enumerate(DISGUISED)]
    rows += [(90, None), (91, ""), (None, "x@y.org"), (92, long), (93, "a@b.cd"), (93, "a@b.cd"), (94, "😀 a@b.cd +14155550123")]
    got = pii_spans.scan_private(_table(spark, rows)).collect()
    assert len(got) == len(rows)
    wanted = Counter()
    for i, text in rows:
        spans = _plain_base(text or "")
        kinds = list(BASE)
        listed = ",".join(f"{kinds[k]}:{s}:{e}" for s, k, e in spans)
        counts = Counter(k for _, k, _ in spans)
        wanted[(i, *[counts[k] for k in range(4)], hashlib.sha256(listed.encode()).hexdigest())] += 1
    assert Counter((r.doc_id, r.n_email, r.n_ip, r.n_card, r.n_phone, r.base_sha256) for r in got) == wanted
    for r in got:
        assert set(filter(None, r.base_spans.split(","))) <= set(filter(None, r.spans.split(",")))
    by_id = {r.doc_id: r.spans for r in got}
    assert by_id[94] == "email:2:8,phone:9:21" and by_id[90] == by_id[91] == ""
    assert pii_spans.scan_private(_table(spark, rows).limit(0)).collect() == []


# ---- 12 -----------------------------------------------------------------------------------


def _cheapest(rows: bytes) -> tuple[int, str]:
    """Least cost and edits by keeping the best path to every state, row by row."""
    due = {0: 2, 1: 2, 2: 3, 3: 2}
    kept = {(0, 0): 1, (0, 1): 2, (1, 1): 2, (2, 2): 3, (3, 1): 2}

    def inserted(best):
        for _ in range(3):
            for q, (cost, edits) in list(best.items()):
                new = (cost + 3, edits + "I")
                best[due[q]] = min(best.get(due[q], new), new)
        return best

    best = {0: (0, "")}
    for x in rows:
        after: dict = {}
        for q, (cost, edits) in inserted(dict(best)).items():
            moves = [(q, 4, "D")]
            if x >> 2 != 2:
                end = 3 * (x >> 2)
                moves.append((due[q], 3 + end, "R"))
                if (q, x & 3) in kept:
                    moves.append((kept[q, x & 3], end, "K"))
            for to, extra, edit in moves:
                new = (cost + extra, edits + edit)
                after[to] = min(after.get(to, new), new)
        best = after
    best = inserted(dict(best))
    return min(best[q] for q in (0, 3) if q in best)


def test_search_and_chain_give_the_cheapest_least_edits():
    rng = random.Random(9)
    for n in [*range(8)] * 100 + [14, 16, 30, 45] * 10:
        rows = bytes(rng.randint(0, 3) + 4 * rng.choice((0, 0, 0, 1, 2)) for _ in range(n))
        wanted = _cheapest(rows)
        if n <= 16:
            assert turn_repair.repair(rows) == wanted
        cuts = sorted({0, n, *(rng.randint(0, n) for _ in range(3)), *range(0, n, 16)})
        if n:
            assert turn_repair.chain([turn_repair.passages(rows[a:b]) for a, b in zip(cuts, cuts[1:])]) == wanted


def _plain_report(rows):
    """``rows``: (turn, role, text) of one conversation."""
    space = " \t\n\x0b\x0c\r"
    rows = [(t, " " if r is None else r, " " if x is None else x) for t, r, x in rows]
    rows.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1], hashlib.md5(r[2].encode()).hexdigest()))
    seen, symbols, counts = set(), [], [0, 0, 0]
    for _, role, text in rows:
        bare = text.strip(space)
        fault = 0 if not bare else 1 if (role, text) in seen else 2 if bare[-1] not in ".!?" else None
        if fault is not None:
            counts[fault] += 1
        seen.add((role, text))
        symbols.append(turn_repair.symbol(role, {None: 0, 2: 1}.get(fault, 2)))
    cost, audit = _cheapest(bytes(symbols))
    turns = [t for t, _, _ in rows if t is not None]
    gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
    illegal = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in zip(rows, rows[1:]))
    lines = [f"{r}:{x}" for _, r, x in turn_repair.edited(audit, iter([r[1:] for r in rows]))]
    return (gaps, *counts, illegal, cost, audit, hashlib.sha256("\n".join(lines).encode()).hexdigest())


def test_repair_over_an_awkward_table(spark):
    rng = random.Random(3)
    rows: list[tuple] = []
    for conv in range(30):
        for turn in range(rng.randint(0, 9)):
            rows.append((conv, turn, rng.choice(["user", "assistant", "system", "tool", None, ""]),
                         rng.choice(["Yes.", "no", "Why?", "", None, " \n", "Fine! "])))
    # A long conversation, one of a single repeated row, one without turns, one without an id.
    rows += [(50, t, "user" if t % 2 == 0 else "assistant", f"Part {t % 90}." if t % 7 else "cut") for t in range(700)]
    rows += [(51, 3, "user", "Same.")] * 40
    rows += [(52, None, r, f"{r} says so.") for r in ("user", "assistant", "assistant")]
    rows += [(None, t, "user", "Who?") for t in range(5)] + [(53, 0, "user", "x" * 3_000_000 + ".")]
    rows += [(54, 2**40, "user", "Far."), (54, -5, "system", "Near.")]
    df = spark.createDataFrame(
        [(*r, "c", 9, "a") for r in rows], "conv_id long, turn long, role string, text string, conv string, n int, audit string"
    ).repartition(5)
    ids = spark.createDataFrame([(k,) for k in (*range(30), 50, 51, 52, 53, 54, 77, None, None)], "conv_id long")
    got = {r.conv_id: tuple(r)[1:] for r in turn_repair.repair_conversations(df, ids).collect()}
    wanted = {c: _plain_report([r[1:] for r in rows if r[0] == c]) for c in {r[0] for r in rows}}
    nothing = (0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())
    for conv in (*range(30), 77):
        wanted.setdefault(conv, nothing)
    assert got == wanted
    repaired = turn_repair.repaired_turns(df).filter("conv_id = 50").orderBy("position").collect()
    assert re.fullmatch("(ua)+", "".join(r.role[0] for r in repaired))
    assert turn_repair.repair_conversations(df.limit(0), ids.limit(0)).collect() == []


def test_damage_hits_by_checksum(spark):
    rows = [(c, t, "assistant", f"Text {c}.") for c in range(20) for t in range(20)] + [(None, None, None, None)]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    import zlib

    def plain(v):
        return " " if v is None else str(v)

    wanted = Counter()
    for c, t, role, text in rows:
        hit = zlib.crc32(f"{plain(c)}:{plain(t)}".encode()) % 20
        role, text = plain(role), plain(text)
        text = "" if hit == 1 else text.replace(".", "") if hit == 2 else text
        if hit:
            wanted[(c, t, "user" if hit == 4 else role, text)] += 2 if hit == 3 else 1
    assert Counter(tuple(r) for r in turn_repair.damage(df).collect()) == wanted


# ---- 13 -----------------------------------------------------------------------------------


def _aligned(texts):
    a, b = Tokenizer.from_file(PATH_A), sentencepiece.SentencePieceProcessor(model_file=PATH_B)
    a.encode_special_tokens = True
    bytes_a, bytes_b = spill_align.ByteLevel(PATH_A).tokens, spill_align.Pieces(PATH_B).tokens
    links, facts, counts = [], [], Counter()
    for text in texts:
        raw = (" " + (text or "")).encode()
        ids = (a.encode(" " + text, add_special_tokens=False).ids, b.encode(text)) if text else ([], [])
        if not text or any(b"".join(t[i] for i in side) != raw for t, side in zip((bytes_a, bytes_b), ids)):
            links.append([])
            facts.append((0, 0, 0, 0, ""))
            continue
        spans = []
        for tokens, side in zip((bytes_a, bytes_b), ids):
            at, out = 0, []
            for i in side:
                out.append((at, at + len(tokens[i]), i))
                at += len(tokens[i])
            spans.append(out)
        met, j = [], 0
        for s, e, i in spans[0]:
            while spans[1][j][1] <= s:
                j += 1
            k = j
            while k < len(spans[1]) and spans[1][k][0] < e:
                met.append((i, spans[1][k][2]))
                k += 1
        common = sorted({e for _, e, _ in spans[0]} & {e for _, e, _ in spans[1]})
        groups, start = [], 0
        cursors = [0, 0]
        for end in common:
            sides = []
            for n in range(2):
                part = []
                while cursors[n] < len(spans[n]) and spans[n][cursors[n]][1] <= end:
                    part.append(str(spans[n][cursors[n]][2]))
                    cursors[n] += 1
                sides.append(",".join(part))
            groups.append("|".join(sides))
        links.append(met)
        facts.append((len(ids[0]), len(ids[1]), len(groups), len(met), hashlib.sha256(";".join(groups).encode()).hexdigest()))
        counts.update(set(met))
    highest: dict = {}
    for (x, _), n in counts.items():
        highest[x] = max(highest.get(x, 0), n)
    return [
        (*f[:4], sum(counts[p] == highest[p[0]] for p in met), sum(counts[p] for p in met), f[4])
        for f, met in zip(facts, links)
    ]


@pytest.mark.parametrize("chunk, fan_in, per_split", [(1 << 20, 64, 512), (500, 2, 2)])
def test_alignment_over_an_awkward_table(spark, monkeypatch, chunk, fan_in, per_split):
    rng = random.Random(8)
    words = "the of and naïve Straße <|endoftext|> <s> 日本語 😀 x=1; don't  two\tthree\n".split(" ")
    texts = [" ".join(rng.choice(words) for _ in range(rng.randint(1, 60))) for _ in range(40)]
    texts += [None, "", " ", "▁ lower block", "a\x00b", "ab" * 150_000, "   lead", texts[0], texts[0], "ﬁ ligature"]
    rows = [(k, t) for k, t in enumerate(texts)] + [(None, texts[1]), (3, texts[3])]
    # Small chunks need several levels of merging and several splits of a part.
    monkeypatch.setattr(spill_align, "FAN_IN", fan_in)
    monkeypatch.setattr(spill_align, "RUNS_PER_SPLIT", per_split)
    got = spill_align.align_tokens(_table(spark, rows), PATH_A, PATH_B, chunk_records=chunk).collect()
    wanted = Counter((i, *facts) for (i, _), facts in zip(rows, _aligned([t for _, t in rows])))
    assert Counter(tuple(r) for r in got) == wanted
    assert spill_align.align_tokens(_table(spark, rows).limit(0), PATH_A, PATH_B).collect() == []


def test_heap_merge_adds_up_in_order(monkeypatch):
    import numpy as np

    monkeypatch.setattr(spill_align, "BLOCK", 7)
    rng = np.random.default_rng(5)
    total, blobs = Counter(), []
    for _ in range(9):
        pairs = np.sort(rng.integers(0, 6, 50).astype(np.uint64) << np.uint64(32) | rng.integers(0, 20, 50).astype(np.uint64))
        total.update(pairs.tolist())
        blobs.append(spill_align._packed(spill_align._entries(pairs, np.ones(50, np.uint64))))
    merged = np.concatenate(list(spill_align.with_best(spill_align.heap_merge(blobs))))
    assert merged["pair"].tolist() == sorted(total)
    assert dict(zip(merged["pair"].tolist(), merged["n"].tolist())) == dict(total)
    for first in range(6):
        of_first = merged[merged["pair"] >> np.uint64(32) == first]
        assert (of_first["best"] == (of_first["n"] == of_first["n"].max())).all()
