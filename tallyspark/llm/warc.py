"""WARC archives: write pages as records, read them back by segment reassembly.

``write_archives`` turns every page into one WARC/1.1 record.  A record whose
block is longer than ``segment_bytes`` is split: the first segment keeps the
record's type and id, the others are ``continuation`` records naming the
first by ``WARC-Segment-Origin-ID``; the last one states
``WARC-Segment-Total-Length``.  Payloads travel in HTTP responses with chunked
transfer framing.  Each record is a gzip member of its own.  The files are
written by Spark's text writer (so to any store Spark can write), with an
empty gzip member between records as the line separator.

``read_archives`` parses archives and decodes unsegmented records where they
were read; only segments of split records are shuffled, by origin id, put in
the order of their numbers, checked against the stated total length and then
decoded.

Defined results: a null payload is the empty payload; rows that repeat the
largest page_id of a payload are all responses; a null page_id is kept and is
never the one referred to while another exists; a record with a missing
segment, a wrong total length or a broken digest comes back with
``complete = false`` and a null payload.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import uuid
import zlib
from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Fixed values of the format.
VERSION = b"WARC/1.1"
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
RECORD_DATE = "2024-01-01T00:00:00Z"
#: An empty gzip member; in ISO-8859-1 each of its bytes is one character.
EMPTY_MEMBER = bytes.fromhex("1f8b08000000000000030300" + "00" * 8).decode("latin-1")

#: Bytes of an archive given to the decompressor at once.
FEED = 4096

RECORD_FIELDS = """page_id long, url string, record_type string, refers_to long,
    payload_digest string, payload_bytes long, payload binary, complete boolean"""
_SEGMENT_FIELDS = """origin string, number int, total long, page_id long, url string,
    record_type string, refers_to long, digest string, block binary"""


# ------------------------------------------------------------------ records
def chunked(payload: bytes, chunk_bytes: int) -> bytes:
    """``payload`` in HTTP/1.1 chunked transfer framing."""
    parts = []
    for at in range(0, len(payload), chunk_bytes):
        piece = payload[at:at + chunk_bytes]
        parts += [b"%x\r\n" % len(piece), piece, b"\r\n"]
    return b"".join([*parts, b"0\r\n\r\n"])


def unchunked(body: bytes) -> bytes:
    """The payload inside chunked framing; ValueError if the framing is broken."""
    parts, at = [], 0
    while True:
        end = body.index(b"\r\n", at)
        size = int(body[at:end].split(b";")[0], 16)
        if not size:
            return b"".join(parts)
        parts.append(body[end + 2:end + 2 + size])
        at = end + 4 + size
        if len(parts[-1]) != size or body[at - 2:at] != b"\r\n":
            raise ValueError("broken chunk")


def _record(fields: dict, block: bytes) -> bytes:
    head = [VERSION, *(f"{k}: {v}".encode() for k, v in fields.items() if v is not None),
            b"Content-Length: %d" % len(block)]
    return gzip.compress(b"\r\n".join(head) + b"\r\n\r\n" + block + b"\r\n\r\n", 4, mtime=0)


def _clean(url: str | None) -> str | None:
    """A header value cannot hold line breaks."""
    return None if url is None else " ".join(url.split())


def page_records(page_id, url, payload: bytes, refers_to, name: str, segment_bytes: int,
                 chunk_bytes: int) -> Iterator[bytes]:
    """The gzip members of one page: a single record, or its segments."""
    digest = base64.b32encode(hashlib.sha1(payload).digest()).decode()
    http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"
    own = f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, name)}>"
    fields = {"WARC-Type": "response" if refers_to is None else "revisit", "WARC-Record-ID": own,
              "WARC-Date": RECORD_DATE, "WARC-Target-URI": _clean(url),
              "WARC-Payload-Digest": f"sha1:{digest}", "Page-ID": page_id,
              "Content-Type": "application/http; msgtype=response"}
    if refers_to is not None:
        yield _record(fields | {"WARC-Profile": REVISIT_PROFILE, "Refers-To-Page-ID": refers_to},
                      http + b"\r\n")
        return
    block = http + b"Transfer-Encoding: chunked\r\n\r\n" + chunked(payload, chunk_bytes)
    if len(block) <= segment_bytes:
        yield _record(fields, block)
        return
    last = (len(block) - 1) // segment_bytes
    for k in range(last + 1):
        part = block[k * segment_bytes:(k + 1) * segment_bytes]
        if not k:
            yield _record(fields | {"WARC-Segment-Number": 1}, part)
            continue
        yield _record({"WARC-Type": "continuation", "WARC-Date": RECORD_DATE,
                       "WARC-Record-ID": f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'{name}/{k}')}>",
                       "WARC-Segment-Origin-ID": own, "WARC-Segment-Number": k + 1,
                       "WARC-Segment-Total-Length": len(block) if k == last else None}, part)


def _members(content: bytes) -> Iterator[bytes]:
    """What each gzip member of an archive holds, empty members left out.

    Fed in small pieces, since what follows a member's end is copied."""
    view, at = memoryview(content), 0
    while at < len(view):
        inflate, parts = zlib.decompressobj(31), []
        while not inflate.eof:
            if at >= len(view):
                raise ValueError("the archive ends inside a record")
            piece = view[at:at + FEED]
            parts.append(inflate.decompress(piece))
            at += len(piece) - len(inflate.unused_data)
        if data := b"".join(parts):
            yield data


def _parse(member: bytes) -> tuple[dict, bytes]:
    head, _, rest = member.partition(b"\r\n\r\n")
    lines = head.split(b"\r\n")
    if not lines[0].startswith(b"WARC/"):
        raise ValueError("not a WARC record")
    fields = {k.lower().decode(): v.strip().decode() for k, _, v in (x.partition(b":") for x in lines[1:])}
    return fields, rest[:int(fields["content-length"])]


def _decoded(block: bytes, digest: str | None) -> tuple[bytes | None, bool]:
    """Payload of a response block, and whether framing and digest hold."""
    head, _, body = block.partition(b"\r\n\r\n")
    try:
        payload = unchunked(body) if b"transfer-encoding: chunked" in head.lower() else body
    except ValueError:
        return None, False
    return (payload, True) if hashlib.sha1(payload).hexdigest() == digest else (None, False)


def _int(value: str | None) -> int | None:
    return None if value is None else int(value)


# ------------------------------------------------------------------ writing
def revisit_targets(pages: DataFrame, min_bytes: int = 1000) -> DataFrame:
    """``pages`` (page_id, url, payload) with ``refers_to``: the largest
    page_id of the same payload, null where the page is itself that one or
    its payload is shorter than ``min_bytes``.

    Digests are counted with map-side combining; the join's page side is
    split by Spark where one payload holds many rows.
    """
    digested = pages.select("page_id", "url", "payload", F.sha1("payload").alias("digest"))
    repeated = (digested.where(F.octet_length("payload") >= min_bytes).groupBy("digest")
                .agg(F.max("page_id").alias("newest"), F.count(F.lit(1)).alias("n"))
                .where("n > 1").select("digest", "newest"))
    joined = digested.join(repeated, "digest", "left")
    return joined.select("page_id", "url", "payload",
                         F.when(~F.col("page_id").eqNullSafe(F.col("newest")), F.col("newest")).alias("refers_to"))


def write_archives(pages: DataFrame, path: str, segment_bytes: int = 32 << 10,
                   chunk_bytes: int = 8 << 10, records_per_file: int = 4096) -> None:
    """Write (page_id, url, payload, refers_to) rows as archives under ``path``.

    A file holds ``records_per_file`` records of at most ``segment_bytes``
    each, which bounds what reading one file takes."""
    def emit(batches):
        part, row = TaskContext.get().partitionId(), 0
        for batch in batches:
            cols = [batch.column(c) for c in ("page_id", "url", "payload", "refers_to")]
            out: list[bytes] = []
            for page_id, url, payload, refers_to in zip(*cols, strict=True):
                row += 1
                out += page_records(page_id.as_py(), url.as_py(), payload.as_py() or b"", refers_to.as_py(),
                                    f"{part}/{row}", segment_bytes, chunk_bytes)
            yield pa.record_batch([pa.array(out, pa.binary())], names=["value"])

    rows = pages.select("page_id", "url", "payload", "refers_to").mapInArrow(emit, "value binary")
    (rows.select(F.col("value").cast("string")).write.option("lineSep", EMPTY_MEMBER)
     .option("encoding", "ISO-8859-1").option("maxRecordsPerFile", records_per_file).text(path))


# ------------------------------------------------------------------ reading
def _records(content: bytes) -> Iterator[dict]:
    """The page records and segments of one archive."""
    for fields, block in map(_parse, _members(content)):
        digest = fields.get("warc-payload-digest", "").removeprefix("sha1:")
        yield {"origin": fields.get("warc-segment-origin-id", fields["warc-record-id"]),
               "number": _int(fields.get("warc-segment-number")),
               "total": _int(fields.get("warc-segment-total-length")),
               "page_id": _int(fields.get("page-id")), "url": fields.get("warc-target-uri"),
               "record_type": fields["warc-type"], "refers_to": _int(fields.get("refers-to-page-id")),
               "digest": base64.b32decode(digest).hex() if digest else None, "block": block}


def read_archives(spark: SparkSession, path: str, payloads: bool = True) -> DataFrame:
    """One row per page record of the archives under ``path``, decoded;
    without ``payloads`` that column is null."""
    schema = pa.schema([("origin", pa.string()), ("number", pa.int32()), ("total", pa.int64()),
                        ("page_id", pa.int64()), ("url", pa.string()), ("record_type", pa.string()),
                        ("refers_to", pa.int64()), ("digest", pa.string()), ("block", pa.binary())])

    def contents(batches):
        for batch in batches:
            for content in batch.column("content"):
                yield content.as_py()

    def single(batches):
        for content in contents(batches):
            yield _rows([r for r in _records(content) if r["number"] is None], payloads)

    def segments(batches):
        for content in contents(batches):
            yield pa.RecordBatch.from_pylist([r for r in _records(content) if r["number"] is not None], schema)

    def joined(rows: pd.DataFrame) -> pd.DataFrame:
        return reassembled(rows.sort_values("number").to_dict("records"), payloads)

    files = spark.read.format("binaryFile").load(path).select("content")
    whole = files.mapInArrow(single, RECORD_FIELDS)
    split = files.mapInArrow(segments, _SEGMENT_FIELDS).groupBy("origin").applyInPandas(joined, RECORD_FIELDS)
    return whole.unionByName(split)


def _rows(records: list[dict], payloads: bool) -> pa.RecordBatch:
    out = []
    for r in records:
        payload, good = (None, True) if r["record_type"] == "revisit" else _decoded(r["block"], r["digest"])
        out.append((r["page_id"], r["url"], r["record_type"], r["refers_to"], r["digest"],
                    None if payload is None else len(payload), payload if payloads else None, good))
    names = ["page_id", "url", "record_type", "refers_to", "payload_digest", "payload_bytes", "payload", "complete"]
    kinds = [pa.int64(), pa.string(), pa.string(), pa.int64(), pa.string(), pa.int64(), pa.binary(), pa.bool_()]
    return pa.record_batch([pa.array(c, t) for c, t in zip(zip(*out, strict=True) if out else [[]] * 8, kinds, strict=True)],
                           names=names)


def reassembled(parts: list[dict], payloads: bool = True) -> pd.DataFrame:
    """The record whose segments ``parts`` are, in the order of their numbers."""
    first, last = parts[0], parts[-1]
    block = b"".join(p["block"] for p in parts)
    numbers = [int(p["number"]) for p in parts]
    fine = numbers == list(range(1, len(parts) + 1)) and last["total"] == len(block)
    payload, good = _decoded(block, first["digest"]) if fine else (None, False)
    # objects, so that whole numbers stay whole beside nulls
    row = [first["page_id"], first["url"], first["record_type"], None, first["digest"],
           None if payload is None else len(payload), payload if payloads else None, good]
    row[0] = None if pd.isna(row[0]) else int(row[0])
    return pd.DataFrame([row], dtype=object, columns=["page_id", "url", "record_type", "refers_to",
                        "payload_digest", "payload_bytes", "payload", "complete"])


def resolved(records: DataFrame) -> DataFrame:
    """``records`` without payloads, revisits given the payload length of the
    response they refer to."""
    narrow = records.select("page_id", "url", "record_type", "refers_to", "payload_digest", "payload_bytes")
    responses = (narrow.where("record_type = 'response' AND payload_bytes IS NOT NULL")
                 .groupBy("payload_digest").agg(F.max("payload_bytes").alias("response_bytes")))
    joined = narrow.join(responses, "payload_digest", "left")
    return joined.select("page_id", F.coalesce("payload_bytes", "response_bytes").alias("payload_bytes"),
                         "payload_digest", "record_type", "refers_to")
