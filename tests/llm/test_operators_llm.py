"""Each operator over awkward tables, against plain Python.

The tables hold nulls in every column, empty and very long texts, repeated rows, ties, copies and
columns whose names clash with those the operators use.
"""

from __future__ import annotations

import base64
import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from plantwatch.llm import byte_cnn, line_runs, merkle, ngram_join, packing, reputation, secret_crf, substrings, warc, wu_manber
from plantwatch.llm.bytewords import text_bytes
from plantwatch.llm.queries import llm_queries

SCHEMA = "doc_id long, text string, lang string, key string, n_words int, _id string, token double"
WORD = re.compile(r"[^\x20\x09-\x0D]+")
TOKENIZER = public_tokenizers.path("word_bpe_49k.json")


def _lower(text: str) -> str:
    return re.sub("[A-Z]", lambda m: m[0].lower(), text)


def _documents() -> list[tuple]:
    rng = random.Random(21)
    words = [f"w{k}" for k in range(60)] + ["Été", "ÉTÉ.", "x;y"]

    def prose(n: int) -> str:
        return " ".join(rng.choice(words) for _ in range(n))

    passage, line = prose(70), "A line that many documents of this table hold, É."
    texts = [prose(rng.randint(0, 120)) for _ in range(20)]
    texts += [prose(10) + " " + passage + " " + prose(9) for _ in range(4)] + [passage] * 3
    base = prose(200).split()
    for k in range(5):
        own = list(base)
        own[7 * k] = f"changed{k}"
        texts.append(" ".join(own))
    texts += [f"{prose(4)}\n  {line} \n{prose(3)}" for _ in range(6)] + [f"{line.upper().replace('É', 'É')}\n{line}"]
    texts += ["", None, "  \n\t ", "1 2 3", "a", "A", prose(9000), texts[0], texts[0]]
    rows = [(k, t, rng.choice(["en", "de", None]), "k", k, "i", 0.5) for k, t in enumerate(texts)]
    rows += [(None, texts[3], None, None, None, None, None), (None, None, None, None, None, None, None)]
    rows += [rows[5], rows[5], (6, texts[9], "en", "k", 1, "i", 1.0)]
    return rows


ROWS = _documents()


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(ROWS, SCHEMA).repartition(3)


@pytest.fixture(scope="module")
def nothing(spark):
    return spark.createDataFrame([], SCHEMA)


def _rows(df, *columns) -> list[tuple]:
    return sorted((tuple(r) for r in df.select(*columns).collect()), key=repr)


def _want(rows) -> list[tuple]:
    return sorted(rows, key=repr)


def _sha(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def test_warc(spark):
    gap = "\r\n\r\n"
    htmls = ["<a>", "<a>", None, "", f"x{gap}WARC/1.1{gap}y", f"end{gap}", "z\r\n", "é" * 70000, "<a>", None]
    rows = [(k, f"http://h/{k}\r\nX: y" if k % 3 else None, h, "c") for k, h in enumerate(htmls)]
    rows += [(None, "u", "<a>", "c"), (None, None, "only", "c"), (8, "u", "<a>", "c"), (3, None, "<other>", "c")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, digest string").repartition(3)
    out = warc.resolve(pages)
    want = []
    for page, _, html, _ in rows:
        body = (html or "").encode()
        best = max((-1 if p is None else p) for p, _, h, _ in rows if (h or "") == (html or ""))
        first = (-1 if page is None else page) == best
        want.append((page, len(body), base64.b32encode(hashlib.sha1(body).digest()).decode(), "response" if first else "revisit", None if first else best))
    assert _rows(out, "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to") == _want(want)
    assert out.where("not sound").count() == 0
    small = warc.resolve(pages, min_payload=4).where("payload_bytes < 4")
    assert {r.record_type for r in small.collect()} == {"response"}
    assert warc.resolve(pages.limit(0)).count() == 0


def test_archives_read_back(spark, tmp_path):
    pages = spark.createDataFrame([(1, "http://a", "one\r\n\r\ntwo"), (2, "http://b", None)], "page_id long, url string, html string")
    folder = f"file://{tmp_path}/w"
    warc.write_archives(pages, folder)
    back = {r.page_id: (bytes(r.payload).decode(), r.url) for r in warc.read_archives(spark, folder).collect()}
    assert back == {1: ("one\r\n\r\ntwo", "http://a"), 2: ("", "http://b")}


@pytest.mark.parametrize("end", ["\r\n", "\r\n\r\n", "\r\n\r\n\r\n", "\r", "\n"])
def test_archives_whose_last_page_ends_in_line_ends(spark, tmp_path, end):
    rows = [(k, "http://h", f"z{k}{end}") for k in range(3)]
    for count in (1, 3):
        pages = spark.createDataFrame(rows[:count], "page_id long, url string, html string")
        # One file for each page, read by one task.
        warc.write_archives(pages.repartition(count, "page_id"), f"file://{tmp_path}/{count}")
        back = warc.read_archives(spark, f"file://{tmp_path}/{count}").collect()
        assert {r.page_id: bytes(r.payload).decode() for r in back} == {k: html for k, _, html in rows[:count]}
        assert all(r.sound for r in back)


def test_substrings(docs, nothing):
    def brute(rows, size):
        starts = defaultdict(list)
        split = [WORD.findall(r[1] or "") for r in rows]
        ids = [-1 if r[0] is None else r[0] for r in rows]
        for own, words in zip(ids, split, strict=True):
            for k in range(len(words) - size + 1):
                starts[tuple(words[k : k + size])].append(own)
        for row, own, words in zip(rows, ids, split, strict=True):
            gone = set()
            for k in range(len(words) - size + 1):
                if min(starts[tuple(words[k : k + size])]) < own:
                    gone.update(range(k, k + size))
            yield row[0], len(words), len(gone), _sha(" ".join(w for k, w in enumerate(words) if k not in gone))

    columns = ("_id", "n_words", "n_removed", "kept_sha256")
    for options in ({}, {"crowded": 1}, {"window": 12, "gram": 4, "crowded": 2}):
        got = substrings.dedup_substrings(docs, **options)
        assert _rows(got, *columns) == _want(brute(ROWS, options.get("window", 50)))
        assert all(_sha(r._kept) == r.kept_sha256 for r in got.collect())
    assert substrings.dedup_substrings(nothing).count() == 0


def test_benchmark(spark, docs, nothing):
    rx = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
    split = lambda t: rx.findall(_lower(t or ""))
    picked = [WORD.findall(ROWS[k][1])[3:20] for k in (22, 27, 33)]
    texts = [(1, " ".join(picked[0])), (12, " ".join(picked[0][:11]).upper()), (3, " - ".join(picked[1])), (4, "1 2 3"), (None, "été"), (6, None), (7, "  "), (3, "W1!w2"), (9, " ".join(picked[2]))]
    items = spark.createDataFrame(texts, "item_id long, text string")

    def brute():
        windows = []
        for item, text in texts:
            words = split(text)
            m = min(10, len(words))
            windows += [(item, words[k : k + m]) for k in range(len(words) - m + 1) if m]
        for row in ROWS:
            words, hit, met = split(row[1]), set(), set()
            for item, window in windows:
                for k in range(len(words) - len(window) + 1):
                    if words[k : k + len(window)] == window:
                        hit.update(range(k, k + len(window)))
                        met.add(item)
            met.discard(None)
            yield row[0], len(words), len(hit), sorted(map(str, met))

    want = _want(brute())
    assert sum(1 for w in want if w[2]) > 8
    for options in ({}, {"block_windows": 5}):
        found = wu_manber.find_benchmark(docs, items, **options)
        assert _rows(found.withColumn("hit", F.size("_hits")), "_id", "_words", "hit", F.array_sort("_items")) == want
    clean = wu_manber.decontaminate(docs, items)
    assert clean.columns == docs.columns and clean.count() == sum(1 for w in want if not w[2])
    assert wu_manber.find_benchmark(docs, items.limit(0)).where(F.size("_hits") > 0).count() == 0
    assert wu_manber.find_benchmark(nothing, items).count() == 0


def test_language(spark, small, nothing):
    table = spark.read.parquet(f"{small}/documents.parquet")
    model = byte_cnn.learn(table)
    out = {r._id: r for r in byte_cnn.identify(table.drop("lang"), model).collect()}
    truth = {r.doc_id: r.lang for r in table.select("doc_id", "lang").collect()}
    held = [d for d in truth if zlib.crc32(str(d).encode()) % 4 == byte_cnn.HELD_OUT and truth[d]]
    assert sum(out[d]._lang == truth[d] for d in held) >= 0.9 * len(held)
    odd = spark.createDataFrame([(1, None, "c"), (2, "", "c"), (3, "12 -\x00", "c"), (None, "the of and", "c"), (5, "日本", "c"), (5, "日本", "c")], "doc_id long, text string, lang string")
    got = _rows(byte_cnn.identify(odd, model), "_id", "_lang")
    assert [g for g in got if g[0] in (1, 2, 3)] == [(1, "und"), (2, "und"), (3, "und")]
    assert len(got) == 6 and len({g for g in got if g[0] == 5}) == 1
    assert all(0 <= r._score <= 1 for r in byte_cnn.identify(odd, model).collect())
    assert byte_cnn.learn(nothing) is None
    assert {r._lang for r in byte_cnn.identify(odd, None).collect()} == {"und"}
    kept = byte_cnn.in_known_language(table)
    assert kept.columns == table.columns and kept.count() >= 0.97 * table.count()
    assert byte_cnn.identify(nothing, model).count() == 0


def test_held_out_rows_teach_nothing(spark, small):
    table = spark.read.parquet(f"{small}/documents.parquet").select("doc_id", "text", "lang")
    other = table.withColumn("lang", F.when(byte_cnn.may_learn(F.col("doc_id")), F.col("lang")).otherwise("zz"))
    assert np.array_equal(byte_cnn.learn(table).dense, byte_cnn.learn(other).dense)


def test_secrets(spark, docs, nothing):
    hexed, secret = "0123456789abcdef" * 2, "Zx9Qw8Er7Ty6"
    lines = [f"{w} api_key = '{secret}{k}' {w} {hexed}{k} and more words to fill the window up to its full length of tokens a b c d e f g h" for k, w in enumerate(["foo", "é", "bar"] * 20)]
    rows = [(100 + k, t) for k, t in enumerate(lines)] + [(None, None), (1, ""), (2, "token: short")]
    table = docs.select("doc_id", "text").unionAll(spark.createDataFrame(rows, "doc_id long, text string"))
    crf = secret_crf.learn(table)
    assert crf is not None

    def brute(rows):
        for own, text in rows:
            found = [s[:3] for s in secret_crf.base_spans(text or "")]
            digest = _sha(",".join(f"{secret_crf.KINDS[kind]}:{a}:{b}" for a, kind, b in found))
            yield own, *(sum(1 for s in found if s[1] == kind) for kind in range(3)), digest

    want = _want(brute([r[:2] for r in ROWS] + rows))
    for model in (crf, None):
        out = secret_crf.scan(table, model)
        assert _rows(out, "doc_id", "n_assign", "n_access", "n_hex", "base_sha256") == want
    for r in secret_crf.scan(table, crf).collect():
        spans = [s.split(":") for s in r.spans.split(",") if s]
        base = ",".join(":".join(s) for s in spans if s[0] != "crf")
        assert _sha(base) == r.base_sha256
    # Without their patterns, the tagger still finds most of the planted secrets.
    bare = spark.createDataFrame([(k, t.replace("api_key", "apiKeys")) for k, t in enumerate(lines)], "doc_id long, text string")
    assert secret_crf.scan(bare, crf).where("spans like '%crf%'").count() > 30
    assert secret_crf.learn(nothing) is None and secret_crf.scan(nothing, None).count() == 0


def test_fingerprints(spark, docs, nothing):
    order = sorted(ROWS, key=lambda r: (r[0] is None, -(r[0] or 0), (r[1] or "").encode()))
    want = []
    for k, row in enumerate(order):
        text, after = row[1] or "", order[(k + 1) % len(order)][1] or ""
        edited = merkle.edit(text, after)
        want.append((row[0], len(text), _sha(edited), merkle.fingerprint(text), merkle.fingerprint(edited)))
    columns = ("doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint")
    got = merkle.fingerprint_edits(docs)
    assert _rows(got, *columns) == _want(want)
    rows = got.collect()
    assert all(0 <= r.near_edited <= 1 and 0 <= r.near_next <= 1 for r in rows)
    long = [r for r in rows if r.n_chars > 200]
    assert np.mean([r.near_edited for r in long]) > np.mean([r.near_next for r in long]) + 0.2
    one = docs.where("doc_id = 3")
    assert one.count() == 1 and merkle.fingerprint_edits(one).first().near_next == 1
    assert merkle.fingerprint_edits(nothing).count() == 0


def test_reputation(spark):
    urls = ["http://A.Example.com/en/x?q", "https://www.example.com/en/", "http://b.net/es/1", "ftp://b.net/fr", "http://c.org", "http://x.com", "nothing", None, "http://bad.example.org:80/p#f", "http://:/", "://h/p", "http://a.com/://b.net/es/"]
    rows = [(k, u) for k, u in enumerate(urls)] + [(None, "http://c.org/x"), (3, None)] + [(100 + k, "http://spam.example.org/a") for k in range(40)] + [(200 + k, "http://fine.example.org/a") for k in range(40)]
    pages = spark.createDataFrame(rows, "page_id long, url string")
    outcomes = spark.createDataFrame([(100 + k, 1) for k in range(30)] + [(200 + k, 0) for k in range(30)] + [(100, None), (None, 1), (100, 0)], "page_id long, bad int")
    out = reputation.judge_urls(pages, outcomes)
    rules = [("com", "/", "allow"), ("example.com", "/en/", "block"), ("www.example.com", "/en/", "allow"), ("net", "/es/", "block"), ("net", "/fr/", "block")]

    def brute(url):
        rest = url.split("://", 1)[1] if url and "://" in url else None
        host = _lower(re.split("[/?#]", rest, maxsplit=1)[0]) if rest is not None else ""
        path = re.split("[?#]", rest[len(host):], maxsplit=1)[0] if rest is not None else ""
        fits = [(len(h + p), h + p, v) for h, p, v in rules if (host == h or host.endswith("." + h)) and path.startswith(p)]
        return host, path, max(fits)[1] if fits else None, max(fits)[2] if fits else None

    got = out.collect()
    assert Counter(r.page_id for r in got) == Counter(r[0] for r in rows)
    assert Counter((r.page_id, r.host, r.path, r.rule) for r in got) == Counter((k, *brute(u)[:3]) for k, u in rows)
    assert all(r.verdict == brute(u)[3] for r in got for k, u in rows if k == r.page_id and brute(u)[3] and r.rule)
    verdict = {r.host: r.verdict for r in got if r.rule is None}
    assert verdict["spam.example.org"] == "block" and verdict["fine.example.org"] == "allow"
    rate = {r.host: r.bad_rate for r in got}
    assert rate["fine.example.org"] < rate["bad.example.org:80"] < rate["spam.example.org"] < 1
    assert reputation.judge_urls(pages, outcomes.limit(0)).where("verdict = 'block' and rule is null").count() == 0
    assert reputation.judge_urls(pages.limit(0), outcomes).count() == 0


def test_lines(docs, nothing):
    key = lambda line: _lower(line.strip(" \t\n\x0b\x0c\r"))
    ids = [-1 if r[0] is None else r[0] for r in ROWS]
    held = defaultdict(set)
    for own, row in zip(ids, ROWS, strict=True):
        for line in (row[1] or "").split("\n"):
            if len(key(line)) >= 40:
                held[key(line)].add(own)
    want = []
    for own, row in zip(ids, ROWS, strict=True):
        lines = (row[1] or "").split("\n")
        kept = [x for x in lines if len(held.get(key(x), ())) < 5 or max(held[key(x)]) == own]
        want.append((row[0], len(lines), len(lines) - len(kept), _sha("\n".join(kept))))
    assert sum(w[2] for w in want) >= 5
    for options in ({}, {"batches": 20, "fanout": 2}, {"batches": 1}):
        got = line_runs.dedup_lines(docs, **options).withColumn("sha", F.sha2(F.col("_kept").cast("binary"), 256))
        assert _rows(got, "_id", "n_lines", "n_dropped", "sha") == _want(want)
    left = line_runs.without_repeated_lines(docs)
    assert left.columns == docs.columns and left.where("text is null").count() == docs.where("text is null").count()
    assert line_runs.dedup_lines(nothing).count() == 0


def test_runs_compact_and_tell_the_unseen(spark, tmp_path):
    runs = line_runs.LineRuns(spark, f"file://{tmp_path}/runs", fanout=3)
    for batch in range(7):
        runs.add(spark.createDataFrame([(bytes([k]), batch) for k in range(batch, batch + 3)], "key binary, doc_id long"))
        assert all(len(level) < 3 for level in runs.levels)
    merged = {bytes(r.key)[0]: (r.n_docs, r.holder) for r in runs.merged().collect()}
    assert merged == {k: (min(k, 6) - max(k - 2, 0) + 1, min(k, 6)) for k in range(9)}
    new = spark.createDataFrame([(bytes([4]), 1), (bytes([99]), 1)], "key binary, doc_id long")
    assert [bytes(r.key) for r in runs.unseen(new).collect()] == [bytes([99])]


def test_packing(docs, nothing):
    plain = Tokenizer.from_file(TOKENIZER)
    coded = [plain.encode(r[1] or "", add_special_tokens=False).ids + [1] for r in ROWS]
    pieces = packing.pack(docs, TOKENIZER).collect()
    parts = Counter((r.doc_id, r.start, r.length, r.ids_crc32, r.doc_tokens) for r in pieces)
    want = Counter()
    for row, ids in zip(ROWS, coded, strict=True):
        for start in range(0, len(ids), 2048):
            own = np.array(ids[start : start + 2048], "<u4")
            want[(row[0], start, len(own), zlib.crc32(own.tobytes()), len(ids))] += 1
    assert parts == want
    sequences = defaultdict(list)
    for r in pieces:
        sequences[r.sequence_id].append((r.offset, r.length))
    for own in sequences.values():
        at = 0
        for offset, length in sorted(own):
            assert offset == at
            at += length
        assert at <= 2048
    total = sum(map(len, coded))
    assert len(sequences) <= total / 2048 * 1.1 + 2
    assert packing.pack(nothing, TOKENIZER).count() == 0


def test_rare_languages_are_sampled_beside_many_big_ones(spark, monkeypatch):
    for name, value in {"WINDOWS": 40, "WINDOWS_PER_LANGUAGE": 10, "STEPS": 1, "EPOCHS": 1}.items():
        monkeypatch.setattr(byte_cnn, name, value)
    rows = [(k, f"text {k}", f"big{k % 8}") for k in range(3200)] + [(4000 + k, f"other {k}", f"rare{k % 2}") for k in range(12)]
    learned = []
    monkeypatch.setattr(byte_cnn, "train", lambda windows, labels, languages: learned.extend([languages, labels]))
    byte_cnn.learn(spark.createDataFrame(rows, "doc_id long, text string, lang string"))
    languages, labels = learned
    assert languages == [*[f"big{k}" for k in range(8)], "rare0", "rare1"]
    assert len(labels) <= 40 and max(Counter(labels.tolist()).values()) <= 4


@pytest.mark.parametrize("options", [{}, {"percent": 80, "size": 5}])
@pytest.mark.parametrize("hot", [2, 128])
def test_ngram_join(docs, nothing, monkeypatch, options, hot):
    monkeypatch.setattr(ngram_join, "HOT", hot)
    if hot == 2:
        monkeypatch.setattr(ngram_join, "BLOCK_SETS", 2)
    percent, size = options.get("percent", 90), options.get("size", 3)
    sets = []
    for row in ROWS:
        words = WORD.findall(_lower(row[1] or ""))
        sets.append({tuple(words[k : k + size]) for k in range(len(words) - size + 1)} if len(words) >= size else ({tuple(words)} if words else set()))
    label = list(range(len(ROWS)))
    changed = True
    while changed:
        changed = False
        for i in range(len(ROWS)):
            for j in range(i):
                common = len(sets[i] & sets[j])
                if common and 100 * common >= percent * len(sets[i] | sets[j]) and label[i] != label[j]:
                    label[i] = label[j] = min(label[i], label[j])
                    changed = True
    least = defaultdict(lambda: None)
    for row, own in zip(ROWS, label, strict=True):
        if row[0] is not None:
            least[own] = row[0] if least[own] is None else min(least[own], row[0])
    want = [(r[0], len(s), least[g] if s else r[0]) for r, s, g in zip(ROWS, sets, label, strict=True)]
    got = ngram_join.near_duplicates(docs, **options)
    assert _rows(got, "doc_id", "n_shingles", "component_id") == _want(want)
    if hot == 128 and not options:
        assert ngram_join.near_duplicates(nothing).count() == 0
        left = ngram_join.without_near_duplicates(docs)
        assert left.columns == docs.columns


@pytest.mark.parametrize("price", [ngram_join.VERIFY_COST, 0.0625])
def test_ngram_join_links_sets_of_unequal_needs(spark, monkeypatch, price):
    """Two near copies of 100 shingles, of which one has a member the sketch counts 20,000 times.

    At the higher price that one asks for 28 shared members and the other for 4.
    """
    monkeypatch.setattr(ngram_join, "VERIFY_COST", price)

    def members(words):
        return ngram_join.shingle_sets(*text_bytes(pa.array([" ".join(words)])))[0]

    def counter(values):
        return (values >> np.uint64(64 - ngram_join.SKETCH_BITS)).astype(np.int64)

    plain = [f"w{k}" for k in range(102)]
    for k in range(1000):
        other = [*plain[:50], f"own{k}", *plain[51:]]
        own = np.setdiff1d(members(other)[:11], members(plain))
        if len(own) and not np.isin(counter(own[:1]), counter(members(plain))).any():
            break
    counts = np.zeros(1 << ngram_join.SKETCH_BITS, np.int64)
    counts[counter(own[:1])] = 20_000
    monkeypatch.setattr(ngram_join, "sketch", lambda *_: counts)
    rows = [(1, " ".join(plain)), (2, " ".join(other)), (3, " ".join(f"x{k}" for k in range(102)))]
    got = ngram_join.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"))
    assert _rows(got, "doc_id", "n_shingles", "component_id") == _want([(1, 100, 1), (2, 100, 1), (3, 100, 3)])


def test_ngram_join_leaves_only_what_its_result_needs(spark, monkeypatch, tmp_path):
    monkeypatch.setattr(ngram_join, "fresh_path", lambda *_: f"{tmp_path}/join")
    dropped = []
    monkeypatch.setattr(ngram_join, "discard", lambda _, path: dropped.append(path.rsplit("/", 1)[1]))
    setting = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(setting)
    words = [f"w{k}" for k in range(40)]
    rows = [(k, " ".join([*words, f"end{k % 2}"])) for k in range(6)] + [(6, None), (7, "other words here")]
    got = ngram_join.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"))
    want = _rows(got, "doc_id", "component_id")
    assert spark.conf.get(setting) == before
    assert sorted(dropped) == ["chosen", "crowded", "first", "found", "met", "pairs", "signatures"]
    for name in dropped:
        (tmp_path / "join" / name).rename(tmp_path / name)
    assert _rows(got, "doc_id", "component_id") == want == _want([*((k, 0) for k in range(6)), (6, 6), (7, 7)])


def test_ngram_join_of_groups_larger_than_hot(spark, monkeypatch):
    """Groups of near copies beside texts that share a passage with them, held against all pairs."""
    monkeypatch.setattr(ngram_join, "HOT", 4)
    monkeypatch.setattr(ngram_join, "BLOCK_SETS", 4)
    rng = np.random.default_rng(5)
    passage, rows = [f"p{k}" for k in range(12)], []
    for group in range(4):
        base = [*passage, *(f"g{group}-{k}" for k in range(20 + 25 * group))]
        for copy in range(14):
            words = list(base)
            for at in rng.choice(len(words), copy % 4, replace=False):
                words[at] = f"e{rng.integers(3)}"
            rows.append((len(rows), " ".join(words)))
    rows += [(len(rows) + k, " ".join([*passage, *(f"s{k}-{j}" for j in range(k))])) for k in range(12)]
    sets = [{tuple(w[k : k + 3]) for k in range(len(w) - 2)} for w in (t.split() for _, t in rows)]
    label = list(range(len(rows)))
    for i in range(len(rows)):
        for j in range(i):
            if 100 * len(sets[i] & sets[j]) >= 90 * len(sets[i] | sets[j]) and label[i] != label[j]:
                low, high = sorted((label[i], label[j]))
                label = [low if x == high else x for x in label]
    assert 4 < len(set(label)) < len(rows)
    got = ngram_join.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"))
    assert _rows(got, "doc_id", "n_shingles", "component_id") == _want([(k, len(sets[k]), label[k]) for k in range(len(rows))])


def test_components_of_a_long_chain(spark, tmp_path):
    edges = spark.createDataFrame([(k, k + 1) for k in range(40)] + [(100, 101)], "a long, b long")
    roots = {r.v: r.root for r in ngram_join.components(edges, f"file://{tmp_path}/c").collect()}
    assert roots == {**{k: 0 for k in range(41)}, 100: 100, 101: 100}


def test_numbered_queries_keep_one_row_per_input_row(spark, small):
    known = llm_queries()
    assert sorted(int(re.match(r"op(\d+)_", k)[1]) for k in known) == list(range(1, 14))
    pages, docs = (spark.read.parquet(f"{small}/{t}.parquet").count() for t in ("pages", "documents"))
    for name in ("op2_suffix_automata", "op3_wu_manber", "op5_secret_crf", "op6_merkle", "op7_host_reputation"):
        assert known[name](spark, small).count() == (pages if name.startswith("op7") else docs)


def test_pipeline_keeps_clean_documents(spark, small):
    import corpus_pipeline as pipeline

    docs = spark.read.parquet(f"{small}/documents.parquet")
    columns, before = docs.columns, docs.count()
    stages = dict(pipeline.STAGES)
    for name in list(stages)[:-1]:
        docs = stages[name](spark, docs, small)
        assert docs.columns == columns
        left = docs.count()
        assert 0.8 * before <= left <= before
        before = left
    assert stages["packing"](spark, docs, small).agg(F.countDistinct("doc_id")).first()[0] == before
    assert stages["near_duplicates"](spark, docs, small).count() == before
