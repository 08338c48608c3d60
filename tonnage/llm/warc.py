"""WARC archives of web pages, with payloads stored once.

Headers alone (page id, address, length, payload digest) are shuffled by digest; of pages with one
payload the largest id stays a ``response`` and the others become ``revisit`` records that refer to it.
A payload whose digest no other page has is written where it is read: a bitmap of fixed size says so of
nearly all, and only the rest, responses that share their payload, are joined with their headers.

Archives are written by Spark's text writer: a record is its header lines and block, and the writer's
line separator is the blank line that ends a record, so a task run again leaves no half-written archive.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from datetime import datetime, timezone

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tonnage.llm.common import scratch, staged

#: The digits of radix 32 and of RFC 4648's base32.
_RADIX, _BASE32 = "0123456789ABCDEFGHIJKLMNOPQRSTUV", "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"
_END = "\r\n\r\n"
#: Bits of the maps that keep payloads from being joined, and bytes that an archive is to have before compression.
_SLOTS = 1 << 23
_FILE_BYTES = 64 << 20


def base32_sha1(payload: Column) -> Column:
    """Bare upper-case base32 of the payload's SHA-1: 40 bits, eight digits, at a time."""
    digits = F.sha1(payload)
    parts = [F.lpad(F.conv(F.substring(digits, 1 + 10 * k, 10), 16, 32), 8, "0") for k in range(4)]
    return F.translate(F.concat(*parts), _RADIX, _BASE32)


def _slots(keys: DataFrame, *columns: str) -> DataFrame:
    """word, bits: the hash values that ``keys`` have; ``_SLOTS`` / 64 rows at most, however many keys there are."""
    at = F.xxhash64(*columns).bitwiseAND(_SLOTS - 1)
    bit = F.expr(f"shiftleft(1L, cast(xxhash64({', '.join(columns)}) & 63 as int))")
    return keys.select(F.shiftright(at, 6).alias("word"), bit.alias("bit")).groupBy("word").agg(F.bit_or("bit").alias("bits"))


def _marked(rows: DataFrame, slots: DataFrame, name: str, *columns: str) -> DataFrame:
    """``rows`` with ``name``: whether ``slots`` may have been made from the row's key."""
    at = F.xxhash64(*columns)
    known = slots.select(F.col("word").alias(f"__{name}"), F.col("bits").alias(f"__{name}_bits"))
    both = rows.join(F.broadcast(known), F.shiftright(at.bitwiseAND(_SLOTS - 1), 6) == F.col(f"__{name}"), "left")
    found = F.getbit(F.coalesce(F.col(f"__{name}_bits"), F.lit(0)), at.bitwiseAND(63).cast("int")) == 1
    return both.withColumn(name, found).drop(f"__{name}", f"__{name}_bits")


def resolved(pages: DataFrame, min_bytes: int = 0) -> DataFrame:
    """page_id, url, payload (null for revisits), payload_bytes, payload_digest, record_type, refers_to, refers_to_url of each page.

    Payloads of fewer than ``min_bytes`` are all responses.  A null html is an empty payload.  A null
    page_id is smaller than any other; pages without an id that share a payload are all responses,
    and so are those that share the largest id.
    """
    payload = F.coalesce(F.col("html").cast("binary"), F.lit(b""))
    rows = pages.select("page_id", F.col("url").cast("string").alias("url"), payload.alias("payload"))
    rows = rows.withColumns({"payload_bytes": F.length("payload").cast("long"), "payload_digest": base32_sha1(F.col("payload"))})
    heads = staged(rows.drop("payload"), "warc-heads")
    eligible = heads.where(F.col("payload_bytes") >= min_bytes)
    counted = eligible.groupBy("payload_digest").agg(F.max("page_id").alias("keeper"), F.max_by("url", "page_id").alias("refers_to_url"), F.count("*").alias("n"))
    shared = staged(counted.where("n > 1 and keeper is not null").drop("n"), "warc-shared")
    slots = staged(_slots(shared, "payload_digest"), "warc-slots")
    other = F.col("keeper").isNotNull() & (F.col("payload_bytes") >= min_bytes) & ~F.col("page_id").eqNullSafe(F.col("keeper"))
    some = _marked(heads, slots, "may_share", "payload_digest").where("may_share").join(shared, "payload_digest", "left").withColumn("revisit", other)
    some = staged(some, "warc-decided")
    names = ["page_id", "url", "payload", "payload_bytes", "payload_digest", "record_type", "refers_to", "refers_to_url"]
    revisits = some.where("revisit").withColumns({"payload": F.lit(None).cast("binary"), "record_type": F.lit("revisit"), "refers_to": F.col("keeper")}).select(names)
    answers = some.where("not revisit").select("payload_digest", "page_id").distinct()
    marked = _marked(_marked(rows, slots, "may_share", "payload_digest"), _slots(answers, "payload_digest", "page_id"), "may_answer", "payload_digest", "page_id")
    response = {"record_type": F.lit("response"), "refers_to": F.lit(None).cast(pages.schema["page_id"].dataType), "refers_to_url": F.lit(None).cast("string")}
    alone = marked.where("not may_share").withColumns(response).select(names)
    key = [F.col("r.payload_digest") == F.col("a.payload_digest"), F.col("r.page_id").eqNullSafe(F.col("a.page_id"))]
    sharing = marked.where("may_share and may_answer").alias("r").join(answers.alias("a"), key, "left_semi").withColumns(response).select(names)
    return alone.unionByName(sharing).unionByName(revisits)


def write_archives(records: DataFrame, path: str, *, records_per_file: int = 4_000, date: datetime | None = None) -> None:
    """Gzipped WARC files of ``records`` (as :func:`resolved` gives them) below ``path``, dated ``date`` (now)."""

    def name(column: str) -> Column:
        return F.concat(F.lit("<urn:page:"), F.coalesce(F.col(column).cast("string"), F.lit("none")), F.lit(">"))

    def address(column: str) -> Column:
        return F.regexp_replace(F.coalesce(column, F.lit("urn:unknown")), r"[\r\n]", "")

    stamp = (date or datetime.now(timezone.utc)).astimezone(timezone.utc).strftime("%Y-%m-%dT%H:%M:%SZ")
    revisit = F.col("record_type") == "revisit"
    http = F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n\r\n").cast("binary")
    block = F.concat(http, F.when(revisit, F.lit(b"")).otherwise(F.col("payload")))
    refers = [
        F.lit("\r\nWARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest\r\nWARC-Refers-To: "), name("refers_to"),
        F.lit("\r\nWARC-Refers-To-Target-URI: "), address("refers_to_url"), F.lit(f"\r\nWARC-Refers-To-Date: {stamp}"),
    ]
    lines = [
        F.lit("WARC/1.1\r\nWARC-Type: "), F.col("record_type"),
        F.lit("\r\nWARC-Record-ID: "), name("page_id"),
        F.lit("\r\nWARC-Target-URI: "), address("url"),
        F.lit(f"\r\nWARC-Date: {stamp}\r\nContent-Type: application/http; msgtype=response"),
        F.lit("\r\nWARC-Payload-Digest: sha1:"), F.col("payload_digest"),
        F.when(revisit, F.concat(*refers)).otherwise(""),
        F.lit("\r\nContent-Length: "), F.length(block).cast("string"), F.lit(_END),
    ]
    record = F.concat(F.concat(*lines).cast("binary"), block).cast("string")
    records.select(record.alias("value")).write.option("lineSep", _END).option("compression", "gzip").option("maxRecordsPerFile", records_per_file).text(path)


def inflated(packed: bytes, step: int = 1 << 20) -> Iterator[bytes]:
    """The content of a gzip file of one member or more, a piece at a time."""
    import zlib

    left = memoryview(packed)
    while left:
        member = zlib.decompressobj(31)
        while left and not member.eof:
            some = member.decompress(left, step)
            left = memoryview(member.unused_data or member.unconsumed_tail)
            if some:
                yield some
        if not member.eof:
            yield member.flush()


def parse(content: Iterable[bytes]) -> Iterator[tuple[dict[bytes, bytes], bytes]]:
    """(headers, block) of each record of an uncompressed archive that comes in pieces; blocks are found by their length."""
    pieces, held, at = iter(content), bytearray(), 0

    def more() -> bool:
        nonlocal held, at
        piece = next(pieces, None)
        if piece is None:
            return False
        held, at = held[at:] + piece, 0
        return True

    while at < len(held) or more():
        while (end := held.find(b"\r\n\r\n", at)) < 0:
            if not more():
                raise ValueError("an archive ends inside a header")
        version, *lines = bytes(held[at:end]).split(b"\r\n")
        if not version.startswith(b"WARC/"):
            raise ValueError("no record where one should begin")
        headers = {k.lower(): v.strip() for k, _, v in (x.partition(b":") for x in lines)}
        size, begin = int(headers[b"content-length"]), end + 4 - at
        while len(held) - at < begin + size + 4:
            if not more():
                raise ValueError("an archive ends inside a record")
        yield headers, bytes(held[at + begin : at + begin + size])
        at += begin + size + 4


def read_archives(spark: SparkSession, path: str) -> DataFrame:
    """page_id, url, payload, payload_digest, record_type, refers_to of each record, computed from the files."""

    def page(name: bytes | None) -> int | None:
        value = (name or b"").removeprefix(b"<urn:page:").removesuffix(b">")
        return int(value) if value not in (b"", b"none") else None

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import base64
        import hashlib

        kinds = (pa.int64(), pa.string(), pa.binary(), pa.string(), pa.string(), pa.int64())
        names = ["page_id", "url", "payload", "payload_digest", "record_type", "refers_to"]

        def out(rows: list[tuple]) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], t) for k, t in enumerate(kinds)], names=names)

        for batch in batches:
            for packed in batch.column(0).to_pylist():
                rows, held = [], 0
                for headers, block in parse(inflated(packed)):
                    kind = headers[b"warc-type"].decode()
                    payload = block.partition(b"\r\n\r\n")[2] if kind == "response" else None
                    digest = headers[b"warc-payload-digest"].decode().removeprefix("sha1:")
                    if payload is not None and base64.b32encode(hashlib.sha1(payload).digest()).decode() != digest:
                        raise ValueError(f"payload digest of {headers[b'warc-record-id']!r} does not match")
                    rows.append((page(headers[b"warc-record-id"]), headers[b"warc-target-uri"].decode("utf-8", "replace"), payload, digest, kind, page(headers.get(b"warc-refers-to"))))
                    held += len(block)
                    if held > 8 << 20:
                        yield out(rows)
                        rows, held = [], 0
                if rows:
                    yield out(rows)

    files = spark.read.format("binaryFile").load(path).where("length > 0").select("content")
    return files.mapInArrow(run, "page_id long, url string, payload binary, payload_digest string, record_type string, refers_to long")


def archived(pages: DataFrame, min_bytes: int = 0) -> DataFrame:
    """Writes the archives and reads them back: page_id, payload_bytes, payload_digest, record_type, refers_to.

    A revisit's length is that of the original response, found by the record it refers to and its
    digest.  Repeated rows are records of their own.  An empty table gives no rows.  Columns beside
    page_id, url and html are ignored.
    """
    spark = pages.sparkSession
    path = scratch(spark, "warc")
    mean = pages.agg(F.avg(F.coalesce(F.octet_length("html"), F.lit(0)))).first()[0] or 0
    write_archives(resolved(pages, min_bytes), path, records_per_file=max(1, min(4_000, _FILE_BYTES // int(mean + 512))))
    read = read_archives(spark, path).withColumn("payload_bytes", F.length("payload").cast("long")).drop("payload", "url")
    read = staged(read, "warc-index")
    full = read.where("record_type = 'response'").groupBy(F.col("page_id").alias("refers_to"), "payload_digest").agg(F.max("payload_bytes").alias("original"))
    full = full.where("refers_to is not null")
    out = read.join(full, ["refers_to", "payload_digest"], "left")
    return out.select("page_id", F.coalesce("payload_bytes", "original").alias("payload_bytes"), "payload_digest", "record_type", "refers_to")


ORACLE = """
WITH p AS (
  SELECT page_id, CAST(octet_length(encode(coalesce(html, ''))) AS BIGINT) AS payload_bytes, sha1(coalesce(html, '')) AS h FROM pages),
k AS (SELECT h, max(page_id) AS keeper FROM p GROUP BY h),
c AS (SELECT i, CAST(('0x' || substr(h, CAST(1 + 10 * i AS INTEGER), 10)) AS BIGINT) AS n, h FROM k, range(4) t(i)),
e AS (
  SELECT h, string_agg(substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', CAST(1 + ((n >> CAST(35 - 5 * j AS INTEGER)) & 31) AS INTEGER), 1), '' ORDER BY i, j) AS payload_digest
  FROM c, range(8) t(j) GROUP BY h)
SELECT page_id, payload_bytes, payload_digest,
  CASE WHEN page_id = keeper THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN page_id <> keeper THEN keeper END AS refers_to
FROM p JOIN k USING (h) JOIN e USING (h)
"""
