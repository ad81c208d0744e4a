"""WARC archives: writing, and reading back with segment reassembly.

Writing: each row is one ``response`` record (an HTTP message with a chunked
body) or, where another row holds an equal payload, a ``revisit``.  A block
longer than ``SEGMENT_BYTES`` is cut into a first record and ``continuation``
records.  Spark's text writer writes the records (gzip, one member per file),
so that archives can lie in any store and a task's file appears only when the
task commits.  Files hold at most ``RECORDS_PER_FILE`` records and so stay small.

Reading: archives come in through Spark's binary file source; each file is
parsed by content lengths.  Segments are grouped by the identifier of their
origin, put in order of their numbers, checked against the total length, and
their chunked framing is decoded.  Records in one piece skip that shuffle.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import re
import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

SEGMENT_BYTES = 32_768
RECORDS_PER_FILE = 256
CHUNK_BYTES = 8_192
#: Payloads of at least this many bytes are stored once.
REVISIT_BYTES = 0
CRAWL_DATE = "2024-01-01T00:00:00Z"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
_HTTP = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nTransfer-Encoding: chunked\r\n\r\n"

RECORD_SCHEMA = ("record_id string, warc_type string, target_uri string, row_id bigint, payload_length bigint, "
                 "digest string, segment int, origin_id string, total_length bigint, block binary")


def base32_sha1(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def chunked(payload: bytes, size: int = CHUNK_BYTES) -> bytes:
    """A body in HTTP/1.1 chunked transfer framing."""
    parts = []
    for at in range(0, len(payload), size):
        piece = payload[at: at + size]
        parts += [b"%x\r\n" % len(piece), piece, b"\r\n"]
    return b"".join([*parts, b"0\r\n\r\n"])


def unchunked(body: bytes) -> bytes:
    """The payload of a chunked body; extensions and trailers are passed over.

    Raises ``ValueError`` for broken framing.
    """
    parts, at = [], 0
    while True:
        end = body.find(b"\r\n", at)
        if end < 0:
            raise ValueError("no chunk size")
        size = int(body[at:end].split(b";")[0].strip(), 16)
        at = end + 2
        if size == 0:
            return b"".join(parts)
        piece = body[at: at + size]
        if len(piece) != size or body[at + size: at + size + 2] != b"\r\n":
            raise ValueError("chunk cut short")
        parts.append(piece)
        at += size + 2


def http_payload(block: bytes) -> bytes:
    """The decoded body of an HTTP message."""
    head, mark, body = block.partition(b"\r\n\r\n")
    if not mark:
        raise ValueError("no end of the HTTP header")
    return unchunked(body) if re.search(rb"(?im)^transfer-encoding:\s*chunked\s*$", head) else body


def _record(fields: list[tuple[str, object]], block: bytes) -> bytes:
    lines = ["WARC/1.1", *(f"{k}: {v}" for k, v in fields if v is not None), f"Content-Length: {len(block)}", "", ""]
    return "\r\n".join(lines).encode() + block


def _one_line(value: str | None) -> str | None:
    return None if value is None else re.sub(r"[\r\n]", lambda m: f"%{ord(m[0]):02X}", value)


def records_of(row_id, unique: int, url: str | None, payload: bytes, digest: str, head, segment_bytes: int):
    """The records of one row, in turn: one, or a first one and its continuations."""
    own = f"<urn:uuid:{uuid.UUID(bytes=hashlib.md5(f'{row_id}/{unique}/{digest}'.encode()).digest())}>"
    uri = _one_line(url) if url else f"urn:row:{row_id}"
    fields: list[tuple[str, object]] = [
        ("WARC-Record-ID", own), ("WARC-Date", CRAWL_DATE), ("WARC-Target-URI", uri),
        ("WARC-Payload-Digest", f"sha1:{digest}"), ("Row-ID", row_id), ("Payload-Length", len(payload))]
    if head is not None:
        yield _record([("WARC-Type", "revisit"), *fields, ("WARC-Profile", PROFILE), ("Refers-To-Row-ID", head),
                       ("Content-Type", "application/http;msgtype=response")], _HTTP)
        return
    block = _HTTP + chunked(payload)
    first = [("WARC-Type", "response"), *fields, ("Content-Type", "application/http;msgtype=response")]
    if len(block) <= segment_bytes:
        yield _record(first, block)
        return
    pieces = [block[at: at + segment_bytes] for at in range(0, len(block), segment_bytes)]
    yield _record([*first, ("WARC-Segment-Number", 1)], pieces[0])
    for k, piece in enumerate(pieces[1:], 2):
        part = f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'{own}/{k}')}>"
        yield _record([("WARC-Type", "continuation"), ("WARC-Record-ID", part), ("WARC-Date", CRAWL_DATE),
                       ("WARC-Target-URI", uri), ("WARC-Segment-Origin-ID", own), ("WARC-Segment-Number", k),
                       ("WARC-Segment-Total-Length", len(block) if k == len(pieces) else None)], piece)


def write_warc(rows: DataFrame, path: str, id_col: str, url_col: str, payload_col: str,
               segment_bytes: int = SEGMENT_BYTES, records_per_file: int = RECORDS_PER_FILE,
               revisit_bytes: int = REVISIT_BYTES) -> None:
    """Write one response or revisit record per row.

    Of rows with equal payloads of at least ``revisit_bytes`` bytes the one
    with the smallest id is the response (all rows with that id, if it
    repeats); a row without an id revisits a row that has one.
    """
    payload = F.coalesce(F.col(payload_col).cast("binary"), F.lit(b""))
    base = rows.select(F.col(id_col).cast("bigint").alias("row_id"), F.col(url_col).cast("string").alias("url"),
                       payload.alias("payload")).withColumn("sha1", F.sha1("payload"))
    heads = (rows.select(F.col(id_col).cast("bigint").alias("row_id"), F.sha1(payload).alias("sha1"))
             .groupBy("sha1").agg(F.min("row_id").alias("head"), F.count(F.lit(1)).alias("n"))
             .where("n > 1").select("sha1", "head"))
    revisits = F.when((F.octet_length("payload") >= revisit_bytes)
                      & F.coalesce(F.col("row_id") > F.col("head"), F.col("head").isNotNull()), F.col("head"))
    plan = (base.join(heads, "sha1", "left")
            .select("row_id", F.monotonically_increasing_id().alias("n"), "url", "payload", revisits.alias("head")))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out, size = [], 0
            for row_id, n, url, payload, head in zip(*(c.to_pylist() for c in batch.columns)):
                for record in records_of(row_id, n, url, payload, base32_sha1(payload), head, segment_bytes):
                    out.append(record)
                    size += len(record)
                if size > 4 << 20:
                    yield pa.RecordBatch.from_arrays([pa.array(out, pa.binary())], ["record"])
                    out, size = [], 0
            yield pa.RecordBatch.from_arrays([pa.array(out, pa.binary())], ["record"])

    (plan.mapInArrow(run, "record binary").select(F.col("record").cast("string"))
     .write.option("lineSep", "\r\n\r\n").option("compression", "gzip")
     .option("zlib.compress.level", "BEST_SPEED").option("maxRecordsPerFile", records_per_file).text(path))


def parse_warc(data: bytes) -> Iterator[tuple[dict[str, str], bytes]]:
    """(fields, block) of the records of an archive; field names in lower case."""
    at = 0
    while at < len(data):
        end = data.index(b"\r\n\r\n", at)
        lines = data[at:end].decode().split("\r\n")
        if not lines[0].startswith("WARC/"):
            raise ValueError(f"no record at byte {at}")
        fields = {k.strip().lower(): v.strip() for k, _, v in (x.partition(":") for x in lines[1:])}
        size = int(fields["content-length"])
        yield fields, data[end + 4: end + 4 + size]
        at = end + 4 + size + 4


def read_records(spark: SparkSession, path: str, blocks: bool = True) -> DataFrame:
    """All records of the archives under a folder, one row each; ``blocks=False`` leaves the blocks null."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = lambda fields, key: int(fields[key]) if key in fields else None
        for batch in batches:
            for content in batch.column(0):
                raw = content.as_py()
                data = gzip.decompress(raw) if raw[:2] == b"\x1f\x8b" else raw
                cols: tuple[list, ...] = tuple([] for _ in range(10))
                for f, block in parse_warc(data):
                    values = (f["warc-record-id"], f["warc-type"], f.get("warc-target-uri"), number(f, "row-id"),
                              number(f, "payload-length"), f.get("warc-payload-digest", "").removeprefix("sha1:"),
                              number(f, "warc-segment-number"), f.get("warc-segment-origin-id"),
                              number(f, "warc-segment-total-length"), block if blocks else None)
                    for col, value in zip(cols, values):
                        col.append(value)
                types = [pa.string(), pa.string(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.int32(),
                         pa.string(), pa.int64(), pa.binary()]
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, types)],
                                                 [x.split()[0] for x in RECORD_SCHEMA.split(", ")])

    return spark.read.format("binaryFile").load(path).select("content").mapInArrow(run, RECORD_SCHEMA)


def _decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        payloads, sizes, digests, errors = [], [], [], []
        for blocks, numbers, total, stated in zip(*(batch.column(k).to_pylist() for k in range(4, 8))):
            block = b"".join(blocks)
            payload, error = None, None
            try:
                if numbers != list(range(1, len(numbers) + 1)):
                    raise ValueError("a segment is missing")
                if total is not None and total != len(block) or total is None and len(numbers) > 1:
                    raise ValueError("total length differs")
                payload = http_payload(block)
                if base32_sha1(payload) != stated:
                    raise ValueError("digest differs")
            except ValueError as e:
                error = str(e)
            payloads.append(payload)
            sizes.append(None if payload is None else len(payload))
            digests.append(None if payload is None else base32_sha1(payload))
            errors.append(error)
        yield pa.RecordBatch.from_arrays(
            [*batch.columns[:4], pa.array(payloads, pa.binary()), pa.array(sizes, pa.int64()),
             pa.array(digests, pa.string()), pa.array(errors, pa.string())],
            ["record_id", "record_type", "target_uri", "row_id", "payload", "payload_bytes", "payload_digest", "error"])


def read_warc(spark: SparkSession, path: str) -> DataFrame:
    """Whole responses and revisits of the archives under a folder.

    ``record_id, record_type, target_uri, row_id, payload, payload_bytes,
    payload_digest, refers_to, error``.  A response whose segments are not all
    there, whose total length, framing or digest is wrong has a null payload
    and says so in ``error``.  A revisit's payload is null; its length and
    ``refers_to`` are those of the response record with its digest, and without
    such a response ``error`` says so.
    """
    records = read_records(spark, path)
    pieces = records.where("warc_type IN ('response', 'continuation')").withColumn(
        "key", F.coalesce("origin_id", "record_id"))
    facts = ["record_id", "warc_type", "target_uri", "row_id"]
    single = pieces.where("segment IS NULL").select(
        *facts, F.array("block").alias("blocks"), F.array(F.lit(1)).alias("numbers"), "total_length", "digest")
    # one group holds the segments of one record
    of_first = [F.max(F.when(F.col("origin_id").isNull(), F.col(c))).alias(c) for c in (*facts, "digest")]
    joined = (pieces.where("segment IS NOT NULL").groupBy("key")
              .agg(*of_first, F.max("total_length").alias("total_length"),
                   F.array_sort(F.collect_list(F.struct("segment", "block"))).alias("parts"))
              .select(*facts, F.col("parts.block").alias("blocks"), F.col("parts.segment").alias("numbers"),
                      "total_length", "digest"))
    responses = single.unionByName(joined).mapInArrow(
        _decode, "record_id string, record_type string, target_uri string, row_id bigint, payload binary, "
                 "payload_bytes bigint, payload_digest string, error string")
    heads = read_records(spark, path, blocks=False)
    known = (heads.where("warc_type = 'response'").groupBy("digest")
             .agg(F.min("row_id").alias("refers_to"), F.max("payload_length").alias("found_bytes")))
    revisits = (heads.where("warc_type = 'revisit'").select(
        *facts, "digest", F.col("payload_length").alias("said_bytes")).join(known, "digest", "left")
        .withColumnRenamed("digest", "payload_digest"))
    return responses.withColumn("refers_to", F.lit(None).cast("bigint")).unionByName(revisits.select(
        "record_id", F.col("warc_type").alias("record_type"), "target_uri", "row_id",
        F.lit(None).cast("binary").alias("payload"), F.coalesce("found_bytes", "said_bytes").alias("payload_bytes"),
        "payload_digest", F.when(F.col("found_bytes").isNull(), F.lit("no such response")).alias("error"),
        "refers_to"))
