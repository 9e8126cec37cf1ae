"""Operator 2: WARC archives with segmented records, chunked transfer framing and revisits.

Writing. Each page becomes a record whose block is an HTTP response with the page's bytes; bodies of CHUNKED_FROM bytes
or more are framed in chunks. Blocks over SEGMENT bytes are cut: the first record carries segment number 1, the others
are continuation records that name its id (WARC-Segment-Origin-ID), and the last carries the total length. Of the
records with equal payloads (of at least ``revisit_from`` bytes) the one with the smallest page_id, nulls last, is the
response; the others are revisits without a body that refer to it. Archives are gzip files of at most FILE_RECORDS
rows, written by Spark's text writer, so a lost or repeated task leaves no partial archive.

Reading. Archives are inflated member by member through a moving offset and parsed record by record by Content-Length, in
one pass whose result is stored: whole records are decoded there, segments keep their blocks. Segments are grouped by
origin, put in the order of their numbers, joined and held against the total length. The HTTP head is split off, the
chunked framing decoded, and the payload's digest computed and held against the header's. An archive is one binary
value, so one over 2 GB has to be split at a record's start.

A null html is an empty payload. Rows that repeat page_id and html give equal records, and come back as often; those
with the smallest page_id of their payload are all responses. A null page_id is kept as null. Other columns are ignored.

Damage never fails a job. A record whose segments, length, framing or digest don't agree comes back with complete = false,
as does one whose Content-Length is missing, or whose archive ends before its block does. Bytes that can't be told as a
record (no WARC line, an archive that ends inside a header, segments without their first record) come back as one row of
record_type ``damaged`` for each stretch; reading goes on at the next WARC line or gzip member.
"""

from __future__ import annotations

import base64
import hashlib
import re
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from journeyline.llm import scratch

SEGMENT = 16 * 1024
CHUNK = 4096
CHUNKED_FROM = 2048
FILE_RECORDS = 1000
BATCH = 4 << 20
END = b"\r\n"
REVISIT = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"

STEP = 16 * 1024
PARSED = ("record_id string, type string, page_id long, origin string, segment int, total long, digest string, refers_id string, "
          "refers_to long, block binary, payload_bytes long, payload_digest string, complete boolean")
PAYLOAD = ("record_id string, type string, page_id long, refers_id string, refers_to long, digest string, payload binary, "
           "payload_bytes long, payload_digest string, complete boolean")


def base32_sha1(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def record_id(page_id: int | None, digest: str) -> str:
    h = hashlib.md5(f"{page_id} {digest}".encode()).hexdigest()
    return f"<urn:uuid:{h[:8]}-{h[8:12]}-{h[12:16]}-{h[16:20]}-{h[20:]}>"


def chunked(body: bytes, size: int = CHUNK) -> bytes:
    parts = [b"%x\r\n%b\r\n" % (len(body[i:i + size]), body[i:i + size]) for i in range(0, len(body), size)]
    return b"".join(parts) + b"0\r\n\r\n"


def unchunked(body: bytes) -> bytes:
    """Decode chunked framing (chunk extensions and trailers are skipped); ValueError if it breaks off."""
    out, at = [], 0
    while True:
        line = body.index(END, at)
        size = int(body[at:line].split(b";")[0], 16)
        at = line + 2
        if not size:
            return b"".join(out)
        if body[at + size:at + size + 2] != END:
            raise ValueError("chunk without an end")
        out.append(body[at:at + size])
        at += size + 2


def _record(fields: list[tuple[str, object]], block: bytes) -> bytes:
    head = "".join(f"{k}: {v}\r\n" for k, v in fields if v is not None)
    return b"WARC/1.1\r\n%bContent-Length: %d\r\n\r\n%b\r\n" % (head.encode(), len(block), block)


def records(page_id: int | None, url: str | None, body: bytes, refers_to: int | None, revisit: bool, segment: int = SEGMENT) -> Iterator[bytes]:
    """The records of one page; each lacks its last CRLF, which the writer adds as line end."""
    digest = base32_sha1(body)
    own = record_id(page_id, digest)
    uri = "".join(c for c in url or "" if c > " ") or None
    common = [("WARC-Target-URI", uri), ("WARC-Date", "1970-01-01T00:00:00Z"), ("X-Page-ID", page_id), ("WARC-Payload-Digest", f"sha1:{digest}")]
    if revisit:
        yield _record([("WARC-Type", "revisit"), ("WARC-Record-ID", own), *common, ("WARC-Profile", REVISIT),
                       ("WARC-Refers-To", record_id(refers_to, digest)), ("X-Refers-To-Page-ID", refers_to),
                       ("Content-Type", "application/http;msgtype=response")], b"HTTP/1.1 200 OK\r\n\r\n")
        return
    framed = len(body) >= CHUNKED_FROM
    head = b"Transfer-Encoding: chunked\r\n" if framed else b"Content-Length: %d\r\n" % len(body)
    block = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n" + head + END + (chunked(body) if framed else body)
    parts = [block[i:i + segment] for i in range(0, len(block), segment)]
    for k, part in enumerate(parts, 1):
        fields = [("WARC-Type", "response" if k == 1 else "continuation"),
                  ("WARC-Record-ID", own if k == 1 else f"{own[:-1]}/{k}>")]
        if k == 1:
            fields += [*common, ("Content-Type", "application/http;msgtype=response")]
        if len(parts) > 1:
            fields += [("WARC-Segment-Origin-ID", own if k > 1 else None), ("WARC-Segment-Number", k),
                       ("WARC-Segment-Total-Length", len(block) if k == len(parts) else None)]
        yield _record(fields, part)


def _written(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        out, size = [], 0
        for page_id, url, html, revisit, refers_to in zip(*(c.to_pylist() for c in batch.columns)):
            for r in records(page_id, url, (html or "").encode(), refers_to, revisit):
                out.append(r)
                size += len(r)
            if size > BATCH:
                yield pa.RecordBatch.from_arrays([pa.array(out, pa.binary())], ["record"])
                out, size = [], 0
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(out, pa.binary())], ["record"])


def write_warc(pages: DataFrame, path: str, revisit_from: int = 0, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> None:
    """Write one record for each page as WARC archives in the folder ``path``."""
    scratch.prepare(pages.sparkSession)
    html = F.col(html_col).cast("string")
    rows = pages.select(F.col(id_col).cast("long").alias("page_id"), F.col(url_col).cast("string").alias("url"), html.alias("html"))
    raw = F.coalesce("html", F.lit("")).cast("binary")
    keyed = rows.withColumn("sha", F.sha1(raw))
    # which payloads come more than once: narrow rows only; the table is small where few are repeated, and then broadcast
    narrow = keyed.where(F.octet_length(raw) >= revisit_from).select("sha", "page_id").distinct()
    several = narrow.groupBy("sha").agg(F.min("page_id").alias("first"), F.count(F.lit(1)).alias("n")).where("n > 1")
    again = scratch.save(narrow.join(several, "sha").where("not (page_id <=> first)").select(
        F.col("sha").alias("its_sha"), F.col("page_id").alias("its_page"), "first"), "revisits")
    marked = keyed.join(again, (F.col("sha") == F.col("its_sha")) & F.col("page_id").eqNullSafe(F.col("its_page")), "left")
    out = marked.select("page_id", "url", "html", F.col("its_sha").isNotNull().alias("revisit"), F.col("first").alias("refers_to"))
    (out.mapInArrow(_written, "record binary").select(F.col("record").cast("string").alias("value"))
     .write.option("lineSep", "\r\n").option("compression", "gzip").option("maxRecordsPerFile", FILE_RECORDS).text(path))


def _pieces(raw: bytes) -> Iterator[bytes | None]:
    """The inflated bytes of an archive in pieces, None where a gzip member breaks off; other bytes as they are."""
    at = 0
    if raw[:2] != b"\x1f\x8b":
        yield raw
        return
    while at < len(raw):
        start, d = at, zlib.decompressobj(31)
        try:
            while not d.eof and at < len(raw):
                fed = raw[at:at + STEP]
                yield d.decompress(fed)
                at += len(fed) - len(d.unused_data)
            if not d.eof:
                yield None
        except zlib.error:
            yield None
            at = raw.find(b"\x1f\x8b\x08", start + 1)
            if at < 0:
                return


class _Bytes:
    """What is inflated but not yet read; ends at a break until ``go_on``."""

    def __init__(self, raw: bytes):
        self.more, self.buffer, self.at, self.ended, self.broken = _pieces(raw), bytearray(), 0, False, False

    def _grow(self) -> bool:
        piece = None if self.ended or self.broken else next(self.more, b"")
        if piece:
            if self.at > 1 << 20:
                del self.buffer[:self.at]
                self.at = 0
            self.buffer += piece
            return True
        if piece is None:
            self.broken = not self.ended
            return False
        # an empty piece: a member without output, or the end
        piece = next(self.more, False)
        while piece == b"":
            piece = next(self.more, False)
        if piece:
            self.buffer += piece
            return True
        self.ended, self.broken = piece is False, piece is None
        return False

    def has(self, n: int) -> bool:
        while len(self.buffer) - self.at < n:
            if not self._grow():
                return False
        return True

    def take(self, n: int) -> bytes:
        self.has(n)
        out = bytes(self.buffer[self.at:self.at + n])
        self.at += len(out)
        return out

    def until(self, mark: bytes) -> int:
        """How many bytes stand before ``mark``; -1 if it doesn't come."""
        done = 0
        while True:
            found = self.buffer.find(mark, self.at + max(0, done - len(mark) + 1))
            if found >= 0:
                return found - self.at
            done = len(self.buffer) - self.at
            if not self._grow():
                return -1

    def go_on(self) -> bool:
        """Past a break; False at the end of the archive."""
        self.buffer, self.at, self.broken = bytearray(), 0, False
        return not self.ended


_NUMBER = re.compile(r"[0-9]{1,18}")


def _fields(h: dict[str, str], block: bytes | None, sound: bool) -> tuple:
    number = lambda k: int(h[k]) if _NUMBER.fullmatch(h.get(k, "").removeprefix("-")) else None
    digest = h.get("warc-payload-digest", "").removeprefix("sha1:") or None
    kind, own, origin, segment = h.get("warc-type"), h.get("warc-record-id"), h.get("warc-segment-origin-id"), number("warc-segment-number")
    if kind is None or own is None or (kind == "continuation" and (origin is None or segment is None)):
        kind, segment, sound = "damaged", None, False
    return (own, kind, number("x-page-id"), origin, segment if segment is None or segment < 1 << 31 else None, number("warc-segment-total-length"), digest,
            h.get("warc-refers-to"), number("x-refers-to-page-id"), block, sound)


def parse(raw: bytes) -> Iterator[tuple]:
    """Record id, type, page, origin, segment, total, digest, refers id, refers page, block, sound for each record of an archive."""
    b = _Bytes(raw)
    while True:
        if b.has(2) and b.buffer[b.at:b.at + 2] == END:
            b.at += 2
            continue
        if not b.has(1):
            if not b.broken or not b.go_on():
                return
            continue
        stop = b.until(END + END) if b.has(7) and b.buffer[b.at:b.at + 7] == b"WARC/1." else -1
        if stop < 0:  # no header: on to the next WARC line, or past the break
            yield _fields({}, None, False)
            b.at = min(b.at + 1, len(b.buffer))
            skip = b.until(b"\r\nWARC/1.")
            b.at = b.at + skip if skip >= 0 else len(b.buffer)
            continue
        lines = b.take(stop + 4).decode(errors="replace").split("\r\n")
        h = {k.strip().lower(): v.strip() for k, _, v in (x.partition(":") for x in lines[1:])}
        if not _NUMBER.fullmatch(h.get("content-length", "")):
            yield _fields(h, None, False)
            skip = b.until(b"\r\nWARC/1.")
            b.at = b.at + skip if skip >= 0 else len(b.buffer)
            continue
        size = int(h["content-length"])
        block = b.take(size)
        yield _fields(h, block, len(block) == size)


def _table(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), schema)], schema=schema)


_TYPES = {"string": pa.string(), "long": pa.int64(), "int": pa.int32(), "binary": pa.binary(), "boolean": pa.bool_()}


def _schema(ddl: str) -> pa.Schema:
    return pa.schema([(n, _TYPES[t]) for n, t in (x.split() for x in ddl.split(", "))])


def _flow(rows: Iterator[tuple], at: int, ddl: str) -> Iterator[pa.RecordBatch]:
    """Batches of about BATCH bytes, counting column ``at``."""
    schema, out, size = _schema(ddl), [], 0
    for r in rows:
        out.append(r)
        size += len(r[at] or b"")
        if size > BATCH:
            yield _table(out, schema)
            out, size = [], 0
    if out:
        yield _table(out, schema)


def payload_of(block: bytes) -> bytes:
    head, found, body = block.partition(END + END)
    if not found:
        raise ValueError("no HTTP head")
    return unchunked(body) if b"\r\ntransfer-encoding: chunked" in head.lower() else body


def _decoded(block: bytes | None, digest: str | None, sound: bool) -> tuple:
    """(payload, its bytes, its digest, complete) of a response's block."""
    try:
        body = payload_of(block or b"")
    except ValueError:
        return None, None, None, False
    got = base32_sha1(body)
    return body, len(body), got, sound and digest in (None, got)


def _parsed(with_payload: bool):
    """Batches of PARSED: whole records decoded, segments with their blocks."""
    def rows(raw: bytes) -> Iterator[tuple]:
        for *head, block, sound in parse(raw):
            kind, segment, digest = head[1], head[4], head[6]
            if segment is not None:
                yield *head, block, None, None, sound
            elif kind == "response":
                body, size, got, complete = _decoded(block, digest, sound)
                yield *head, body if with_payload else None, size, got, complete
            elif kind in ("revisit", "damaged"):
                yield *head, None, None, digest if kind == "revisit" else None, sound

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from _flow((r for b in batches for raw in b.column(0) for r in rows(raw.as_py())), 9, PARSED)

    return run


def _payloads(with_payload: bool):
    """Batches of PAYLOAD from the blocks of joined records."""
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        for b in batches:
            for k in range(b.num_rows):
                rid, kind, page, digest, refers_id, refers_to, blocks, sound = (c[k].as_py() for c in b.columns)
                body, size, got, complete = _decoded(b"".join(blocks), digest, sound)
                yield rid, kind, page, refers_id, refers_to, digest, body if with_payload else None, size, got, complete

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from _flow(rows(batches), 6, PAYLOAD)

    return run


def read_warc(spark: SparkSession, path: str, with_payload: bool = True) -> DataFrame:
    """One row for each response, revisit and damaged stretch: page_id, record_type, payload (null for revisits),
    payload_bytes, payload_digest, refers_to, complete."""
    scratch.prepare(spark)
    parsed = scratch.save(spark.read.format("binaryFile").load(path).select("content").mapInArrow(_parsed(with_payload), PARSED), "parsed")
    fields = ["record_id", "type", "page_id", "digest", "refers_id", "refers_to"]
    ends = ["payload_bytes", "payload_digest", "complete"]
    whole = parsed.where("segment is null").select("record_id", "type", "page_id", "refers_id", "refers_to", "digest", F.col("block").alias("payload"), *ends)
    first = F.struct(*fields)
    joined = (parsed.where("segment is not null").groupBy(F.coalesce("origin", "record_id").alias("group"))
              .agg(F.array_sort(F.collect_set(F.struct("segment", "block"))).alias("parts"), F.max("total").alias("total"),
                   F.max(F.when(F.col("segment") == 1, first)).alias("first"), F.count(F.when(F.col("segment") == 1, 1)).alias("copies"),
                   F.bool_and("complete").alias("sound")))
    numbered = F.forall(F.transform("parts", lambda x, i: x["segment"] == i + 1), lambda x: x)
    length = F.aggregate("parts", F.lit(0).cast("long"), lambda n, x: n + F.octet_length(x["block"]))
    joined = joined.select("first", "parts.block", (F.col("sound") & numbered & (length == F.coalesce("total", F.lit(-1)))).alias("sound"),
                           F.explode(F.sequence(F.lit(1).cast("long"), F.greatest("copies", F.lit(1)))).alias("copy"))
    typed = [F.coalesce("first.type", F.lit("damaged")).alias("type") if c == "type" else F.col(f"first.{c}") for c in fields]
    joined = joined.select(*typed, "block", "sound").mapInArrow(_payloads(with_payload), PAYLOAD)
    joined = joined.withColumn("complete", F.col("complete") & (F.col("type") != "damaged"))
    if not with_payload:
        whole, joined = whole.drop("payload"), joined.drop("payload")
    return _resolved(whole.unionByName(scratch.save(joined, "joined")))


def _resolved(rows: DataFrame) -> DataFrame:
    """Give revisits the length of the response that they refer to; those that refer to none are not complete."""
    names = [c for c in ("payload",) if c in rows.columns]
    target = (rows.where("type = 'response'").groupBy(F.col("record_id").alias("refers_id"))
              .agg(F.max("payload_bytes").alias("its_bytes"), F.max("payload_digest").alias("its_digest"), F.bool_and("complete").alias("its_state")))
    responses = rows.where("type in ('response', 'damaged')").select("page_id", F.col("type").alias("record_type"), *names, "payload_bytes", "payload_digest",
                                                       F.lit(None).cast("long").alias("refers_to"), "complete")
    revisits = rows.where("type = 'revisit'").join(target, "refers_id", "left").select(
        "page_id", F.col("type").alias("record_type"), *names, F.col("its_bytes").alias("payload_bytes"), "payload_digest", "refers_to",
        F.coalesce(F.col("complete") & F.col("its_state") & (F.col("digest") == F.col("its_digest")), F.lit(False)).alias("complete"))
    return responses.unionByName(revisits)
