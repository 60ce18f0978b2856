"""WARC archives: writing pages with revisits and segments, reading them back.

Writing.  Pages with equal payloads form a group; the one with the largest
page_id becomes a ``response``, the others ``revisit`` records that refer to it
and carry no payload.  A response block is an HTTP message whose body is sent
in chunked transfer framing; a block longer than ``segment_bytes`` is split
into a first record and ``continuation`` records.  The archive is written by
Spark's text sink with CRLF CRLF as the line separator, which is exactly the
end of a WARC record, so task retries and commits are Spark's own.  (Chunks
and segments end between characters, as the sink takes text.)  No record holds
more than a segment, so a file holds at most ``RECORDS_PER_FILE`` segments (16 MiB),
however large a page is, and can be read whole.

Reading.  Files are parsed by Content-Length.  Whole records are decoded where
they are read; only segments are shuffled: grouped by origin identifier,
ordered by segment number, their length checked against the stated total, then
decoded from chunked framing.

Defined results: a null html is an empty payload; page_ids may repeat (records
have their own identifiers, and of equal rows one is the response); an empty table gives an archive without
records; other columns are ignored.  A missing segment, a wrong total length or
broken framing raises.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from reachlens.llm.common import salted_join

SEGMENT_BYTES = 1 << 14
CHUNK_BYTES = 1 << 12
RECORDS_PER_FILE = 1024
END = "\r\n\r\n"
RECORD_SCHEMA = ("record_id string, record_type string, page_id bigint, target_uri string, "
                 "refers_to string, digest string, payload binary")
_ARROW_RECORD = pa.schema([("record_id", pa.string()), ("record_type", pa.string()),
                           ("page_id", pa.int64()), ("target_uri", pa.string()),
                           ("refers_to", pa.string()), ("digest", pa.string()),
                           ("payload", pa.binary())])


def pieces(data: bytes, limit: int) -> Iterator[bytes]:
    """``data`` in parts of at most ``limit`` bytes that end between characters."""
    lo = 0
    while lo < len(data):
        hi = min(len(data), lo + limit)
        while hi < len(data) and data[hi] & 0xC0 == 0x80 and hi > lo + 1:
            hi -= 1
        if hi < len(data) and data[hi] & 0xC0 == 0x80:  # a limit under one character
            hi = lo + limit
            while hi < len(data) and data[hi] & 0xC0 == 0x80:
                hi += 1
        yield data[lo:hi]
        lo = hi


def chunked(payload: bytes, limit: int = CHUNK_BYTES) -> bytes:
    """``payload`` in chunked transfer framing."""
    framed = [b"%x\r\n%s\r\n" % (len(p), p) for p in pieces(payload, limit)]
    return b"".join([*framed, b"0\r\n\r\n"])


def unchunked(body: bytes) -> bytes:
    """The payload of a body in chunked transfer framing; extensions are skipped."""
    out, at = [], 0
    while True:
        line = body.index(b"\r\n", at)
        size = int(body[at:line].split(b";")[0], 16)
        at = line + 2
        if size == 0:
            return b"".join(out)
        if body[at + size:at + size + 2] != b"\r\n":
            raise ValueError("chunked framing: a chunk does not end where it says")
        out.append(body[at:at + size])
        at += size + 2


def digest32(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def _record(headers: list[tuple[str, object]], block: bytes) -> str:
    head = "".join(f"{k}: {v}\r\n" for k, v in [*headers, ("Content-Length", len(block))])
    return f"WARC/1.1\r\n{head}\r\n" + block.decode()


def _one_line(uri: str | None) -> str:
    return (uri or "").replace("%", "%25").replace("\r", "%0D").replace("\n", "%0A")


def _line_back(uri: str) -> str:
    return uri.replace("%0D", "\r").replace("%0A", "\n").replace("%25", "%")


def planned(pages: DataFrame) -> DataFrame:
    """page_id, url, html, record_id and refers_to (the response's record id;
    null for a response).  ``pages`` must be a stored table: its ids come from
    the place of a row in the scan, which a rerun of a task finds again."""
    rows = pages.select(
        "page_id", "url", F.coalesce("html", F.lit("")).alias("html")).select(
        "*", F.sha1(F.col("html").cast("binary")).alias("same"))
    keyed = rows.withColumn("record_id", F.concat_ws(
        "-", "page_id", F.monotonically_increasing_id()))
    first = keyed.groupBy("same").agg(
        F.max(F.struct(F.coalesce("page_id", F.lit(-(1 << 62))).alias("page"), "record_id")).alias("top"),
        F.count("*").alias("n")).where("n > 1")
    return (salted_join(keyed, first.select("same", F.col("top.record_id").alias("response")),
                        "same", "record_id")
            .select("page_id", "url", "html", "record_id",
                    F.when(F.col("response") != F.col("record_id"), F.col("response")).alias("refers_to")))


def write_archive(pages: DataFrame, path: str, segment_bytes: int = SEGMENT_BYTES,
                  chunk_bytes: int = CHUNK_BYTES, records_per_file: int = RECORDS_PER_FILE) -> None:
    """Write ``pages`` (page_id, url, html) as gzipped WARC files under ``path``."""

    def records(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list[str] = []
            size = 0
            for row in zip(*(batch.column(c) for c in (
                    "page_id", "url", "html", "record_id", "refers_to"))):
                page_id, url, html, record_id, refers_to = (x.as_py() for x in row)
                payload = html.encode()
                common = [("WARC-Target-URI", _one_line(url))] if url is not None else []
                common += [("WARC-Page-ID", page_id)] if page_id is not None else []
                identity = ("WARC-Record-ID", f"<urn:page:{record_id}>")
                headers = [identity, *common, ("WARC-Payload-Digest", f"sha1:{digest32(payload)}")]
                if refers_to is not None:
                    out.append(_record([("WARC-Type", "revisit"), *headers,
                                        ("WARC-Refers-To", f"<urn:page:{refers_to}>")],
                                       b"HTTP/1.1 200 OK\r\n\r\n"))
                    continue
                block = (b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"
                         b"Transfer-Encoding: chunked\r\n\r\n" + chunked(payload, chunk_bytes))
                parts = list(pieces(block, segment_bytes))
                if len(parts) == 1:
                    out.append(_record([("WARC-Type", "response"), *headers], block))
                for i, part in enumerate(parts if len(parts) > 1 else [], 1):
                    said = [("WARC-Type", "response"), *headers] if i == 1 else [
                        ("WARC-Type", "continuation"),
                        ("WARC-Record-ID", f"<urn:page:{record_id}:{i}>"),
                        ("WARC-Segment-Origin-ID", f"<urn:page:{record_id}>")]
                    if i == len(parts):
                        said.append(("WARC-Segment-Total-Length", len(block)))
                    out.append(_record([*said, ("WARC-Segment-Number", i)], part))
                size += len(block)
                if size > 1 << 22:
                    yield pa.RecordBatch.from_pydict({"value": out})
                    out, size = [], 0
            yield pa.RecordBatch.from_pydict({"value": pa.array(out, pa.string())})

    (planned(pages).mapInArrow(records, "value string").write
     .option("lineSep", END).option("compression", "gzip")
     .option("maxRecordsPerFile", records_per_file).text(path))


def _parsed(data: bytes) -> Iterator[tuple[dict[str, str], bytes]]:
    at = 0
    while at < len(data):
        top = data.index(END.encode(), at)
        head = data[at:top].decode().split("\r\n")
        if not head[0].startswith("WARC/"):
            raise ValueError("not a WARC record")
        fields = dict(line.split(": ", 1) for line in head[1:])
        lo = top + 4
        hi = lo + int(fields["Content-Length"])
        if data[hi:hi + 4] != END.encode():
            raise ValueError("a WARC record does not end where it says")
        yield fields, data[lo:hi]
        at = hi + 4


def _name(identifier: str | None) -> str | None:
    return identifier[len("<urn:page:"):-1] if identifier else None


def _decoded(fields: dict[str, str], block: bytes) -> dict:
    head, _, body = block.partition(END.encode())
    revisit = fields["WARC-Type"] == "revisit"
    if not revisit:
        body = unchunked(body) if b"\r\nTransfer-Encoding: chunked" in head else body
    digest = fields["WARC-Payload-Digest"].removeprefix("sha1:")
    if not revisit and digest32(body) != digest:
        raise ValueError(f"payload of {fields['WARC-Record-ID']} does not match its digest")
    page, uri = fields.get("WARC-Page-ID"), fields.get("WARC-Target-URI")
    return {"record_id": _name(fields["WARC-Record-ID"]), "record_type": fields["WARC-Type"],
            "page_id": None if page is None else int(page),
            "target_uri": None if uri is None else _line_back(uri),
            "refers_to": _name(fields.get("WARC-Refers-To")), "digest": digest,
            "payload": None if revisit else body}


def read_archive(spark: SparkSession, path: str) -> DataFrame:
    """One row a record: record_id, record_type, page_id, target_uri, refers_to
    (a record_id), digest, payload (null for revisits)."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(path).select("content")

    def whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for content in batch.column("content"):
                rows = [_decoded(f, b) for f, b in _parsed(gzip.decompress(content.as_py()))
                        if "WARC-Segment-Number" not in f]
                yield pa.RecordBatch.from_pylist(rows, schema=_ARROW_RECORD)

    segment = pa.schema([("origin", pa.string()), ("number", pa.int64()), ("total", pa.int64()),
                         ("headers", pa.string()), ("block", pa.binary())])

    def segments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for content in batch.column("content"):
                rows = [{"origin": f.get("WARC-Segment-Origin-ID", f["WARC-Record-ID"]),
                         "number": int(f["WARC-Segment-Number"]),
                         "total": int(f["WARC-Segment-Total-Length"])
                         if "WARC-Segment-Total-Length" in f else None,
                         "headers": "\r\n".join(f"{k}: {v}" for k, v in f.items()), "block": b}
                        for f, b in _parsed(gzip.decompress(content.as_py()))
                        if "WARC-Segment-Number" in f]
                yield pa.RecordBatch.from_pylist(rows, schema=segment)

    def joined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                row = batch.slice(i, 1).to_pylist()[0]
                parts, total = row["parts"], row["total"]
                block = b"".join(p["block"] for p in parts)
                if [p["number"] for p in parts] != list(range(1, len(parts) + 1)) or len(block) != total:
                    raise ValueError(f"segments of {row['origin']} are missing or do not add up")
                fields = dict(x.split(": ", 1) for x in parts[0]["headers"].split("\r\n"))
                yield pa.RecordBatch.from_pylist([_decoded(fields, block)], schema=_ARROW_RECORD)

    split = (files.mapInArrow(segments, "origin string, number bigint, total bigint, headers string, block binary")
             .groupBy("origin")
             .agg(F.sort_array(F.collect_list(F.struct("number", "headers", "block"))).alias("parts"),
                  F.max("total").alias("total")))
    return files.mapInArrow(whole, RECORD_SCHEMA).union(split.mapInArrow(joined, RECORD_SCHEMA))


def index(records: DataFrame) -> DataFrame:
    """The narrow columns of ``read_archive``, with the payload's length."""
    return records.select("record_id", "record_type", "page_id", "refers_to", "digest",
                          F.octet_length("payload").cast("bigint").alias("bytes"))


def resolved(said: DataFrame) -> DataFrame:
    """page_id, payload_bytes, payload_digest, record_type, refers_to (a page_id)
    of an ``index``: a revisit takes its length from the response it refers to,
    after the digests are found equal."""
    responses = (said.where("record_type = 'response'")
                 .select(F.col("record_id").alias("refers_to"), F.col("page_id").alias("to_page"),
                         F.col("digest").alias("to_digest"), F.col("bytes").alias("to_bytes")))
    visits = salted_join(said.where("record_type = 'revisit'"), responses, "refers_to", "record_id")
    wrong = F.raise_error(F.concat(F.lit("no equal response for "), "record_id"))
    return said.where("record_type = 'response'").select(
        "page_id", F.col("bytes").alias("payload_bytes"), F.col("digest").alias("payload_digest"),
        "record_type", F.lit(None).cast("bigint").alias("refers_to")).union(visits.select(
            "page_id", F.when(F.col("digest") == F.col("to_digest"), F.col("to_bytes"))
            .otherwise(wrong.cast("bigint")), "digest", "record_type", "to_page"))
