"""WARC archives: written from pages, resolved to one response per payload, read back.

Records are written by the text sink with ``\\r\\n\\r\\n`` between them, which is what ends a
WARC record, so task commits and retries are Spark's. Files are gzip-compressed and therefore
read by one task from start to end; the reader keeps no more than one record in memory.
"""

from __future__ import annotations

import base64
import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from plantwatch.session import fresh_path

MIN_PAYLOAD = 0
CRLF = "\r\n"
DATE = "2024-01-01T00:00:00Z"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
READ = "page_id long, url string, record_type string, payload_digest string, payload_bytes long, refers_to long, payload binary, sound boolean"
_DIGITS, _ALPHABET = "0123456789ABCDEFGHIJKLMNOPQRSTUV", "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"


def base32_sha1(payload: Column) -> Column:
    """Upper-case base32 of SHA-1: eight groups of five hex digits, four letters each."""
    digest = F.sha1(payload.cast("binary"))
    groups = [F.lpad(F.conv(F.substring(digest, 5 * i + 1, 5), 16, 32), 4, "0") for i in range(8)]
    return F.translate(F.concat(*groups), _DIGITS, _ALPHABET)


def _uri(page_id: Column) -> Column:
    return F.concat(F.lit("<urn:x-page:"), F.coalesce(page_id.cast("string"), F.lit("null")), F.lit(">"))


def _record(kind: str, block: Column, block_bytes: Column, more: list[Column]) -> Column:
    """One record without its end; header values hold no line ends."""
    target = F.regexp_replace("url", "[\\x00-\\x20]", "%20")
    lines = [
        F.lit("WARC/1.1"),
        F.lit(f"WARC-Type: {kind}"),
        F.concat(F.lit("WARC-Record-ID: "), _uri(F.col("page_id"))),
        F.lit(f"WARC-Date: {DATE}"),
        F.when(F.col("url").isNotNull(), F.concat(F.lit("WARC-Target-URI: "), target)),
        F.concat(F.lit("WARC-Payload-Digest: sha1:"), F.col("digest")),
        F.concat(F.lit("X-Payload-Length: "), F.col("size").cast("string")),
        F.lit("Content-Type: application/http; msgtype=response"),
        *more,
        F.concat(F.lit("Content-Length: "), block_bytes.cast("string")),
    ]
    return F.concat(F.concat_ws(CRLF, *lines), F.lit(2 * CRLF), block)


def _http(size: Column) -> Column:
    return F.concat(
        F.lit(f"HTTP/1.1 200 OK{CRLF}Content-Type: text/html; charset=utf-8{CRLF}Content-Length: "),
        size.cast("string"), F.lit(2 * CRLF),
    )


def write_archives(pages: DataFrame, folder: str, min_payload: int = MIN_PAYLOAD) -> None:
    """Archives of ``pages`` (page_id, url, html) in which each payload is stored once.

    Only headers (id, url, digest, size) are shuffled by the digest; a payload moves once, with
    its response, under a key no other page has. Of equal payloads of at least ``min_payload``
    bytes the one with the largest page_id is the response. A null html is an empty payload. A
    null page_id is smaller than all others, and is kept. Rows that repeat the winning page_id
    with the same payload are responses too.
    """
    lowest = F.lit(-(2**63))
    rows = pages.select(
        F.col("page_id").cast("long"), "url", F.coalesce("html", F.lit("")).alias("html")
    ).withColumn("digest", base32_sha1(F.col("html"))).withColumn("size", F.octet_length("html").cast("long"))
    headers = rows.select("page_id", "url", "digest", "size")
    winners = (
        headers.where(F.col("size") >= min_payload).groupBy("digest")
        .agg(F.max(F.coalesce("page_id", lowest)).alias("winner"))
    )
    judged = headers.join(winners, "digest", "left")
    revisits = judged.where(F.col("winner") != F.coalesce("page_id", lowest))
    referred = [
        F.lit(f"WARC-Profile: {PROFILE}"),
        F.concat(F.lit("WARC-Refers-To: "), _uri(F.col("winner"))),
    ]
    response = _record("response", F.concat(_http(F.col("size")), F.col("html")), F.octet_length(_http(F.col("size"))) + F.col("size"), [])
    revisit = _record("revisit", _http(F.col("size")), F.octet_length(_http(F.col("size"))), referred)
    won = winners.select("digest", F.when(F.col("winner") != lowest, F.col("winner")).alias("page_id"))
    first = rows.where(F.col("size") >= min_payload).join(
        won.select(F.col("digest").alias("d"), F.col("page_id").alias("p")),
        (F.col("digest") == F.col("d")) & F.col("page_id").eqNullSafe(F.col("p")), "left_semi",
    ).select(response.alias("value"))
    if min_payload > 0:
        first = first.unionAll(rows.where(F.col("size") < min_payload).select(response.alias("value")))
    (
        first.unionAll(revisits.select(revisit.alias("value")))
        .write.option("lineSep", 2 * CRLF).option("compression", "gzip").text(folder)
    )


def _parse(batches: Iterator[pa.RecordBatch], payloads: bool) -> Iterator[pa.RecordBatch]:
    """Pieces between blank lines, in file order, to records; a record may be many pieces."""
    gap = b"\r\n\r\n"
    rows: list[tuple] = []
    held = 0
    buffer = bytearray()
    fields: dict[bytes, bytes] | None = None
    schema = pa.schema([
        ("page_id", pa.int64()), ("url", pa.string()), ("record_type", pa.string()), ("payload_digest", pa.string()),
        ("payload_bytes", pa.int64()), ("refers_to", pa.int64()), ("payload", pa.binary()), ("sound", pa.bool_()),
    ])

    def page(value: bytes | None) -> int | None:
        found = re.fullmatch(rb"<urn:x-page:(-?\d+)>", value or b"")
        return int(found[1]) if found else None

    def flush() -> pa.RecordBatch:
        columns = list(zip(*rows, strict=True))
        return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema, strict=True)], schema=schema)

    for batch in batches:
        for piece in batch.column(0):
            buffer += piece.as_buffer().to_pybytes() + gap
            while True:
                if fields is None:
                    end = buffer.find(gap)
                    if end < 0:
                        break
                    head = bytes(buffer[:end]).split(b"\r\n")
                    del buffer[: end + 4]
                    if not end:
                        # A file whose last block ends in a bare line end gives one gap too many.
                        continue
                    if not head[0].startswith(b"WARC/"):
                        raise ValueError(f"not a WARC record: {head[0][:40]!r}")
                    fields = dict(line.split(b": ", 1) for line in head[1:])
                length = int(fields[b"Content-Length"])
                if len(buffer) < length + 4:
                    break
                block = bytes(buffer[:length])
                del buffer[: length + 4]
                kind = fields[b"WARC-Type"].decode()
                body = block[block.index(gap) + 4 :] if kind == "response" else None
                digest = fields[b"WARC-Payload-Digest"].removeprefix(b"sha1:")
                sound = body is None or base64.b32encode(hashlib.sha1(body).digest()) == digest
                url = fields.get(b"WARC-Target-URI")
                rows.append((
                    page(fields[b"WARC-Record-ID"]), url.decode() if url is not None else None, kind, digest.decode(),
                    int(fields[b"X-Payload-Length"]) if body is None else len(body),
                    page(fields.get(b"WARC-Refers-To")), body if payloads else None, sound,
                ))
                held += len(body or b"") if payloads else 0
                fields = None
                if len(rows) >= 5000 or held > 4 << 20:
                    yield flush()
                    rows, held = [], 0
    if rows:
        yield flush()


def read_archives(spark: SparkSession, folder: str, payloads: bool = True) -> DataFrame:
    """Records of the archives: ids, type, digest, reference, and payload of responses.

    ``sound`` tells whether a response's payload has the digest of its header.
    """
    pieces = spark.read.option("lineSep", 2 * CRLF).schema("value string").text(folder).select(F.col("value").cast("binary"))
    return pieces.mapInArrow(lambda batches: _parse(batches, payloads), READ)


def resolve(pages: DataFrame, min_payload: int = MIN_PAYLOAD) -> DataFrame:
    """Write the archives of ``pages`` to a fresh folder and read their headers back."""
    spark = pages.sparkSession
    folder = fresh_path(spark, "warc")
    write_archives(pages, folder, min_payload)
    records = read_archives(spark, folder, payloads=False)
    return records.select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "url", "sound"
    )
