"""WARC archives: records in segments with chunked payloads, and their reassembly.

Writing: a page becomes a response record, an HTTP message in chunked transfer coding;
a page whose payload an earlier one has becomes a revisit of that one.  A block beyond
``SEGMENT_BYTES`` is cut: the first record is segment 1, continuation records carry the
origin's record id and their number, the last one the total length.  Spark's text
writer, with a record's two closing line ends as its separator, puts the records into
gzip files, committed with their task.

Reading: files are parsed into records; those in one piece go on as they are, segments
are grouped by origin id and ordered by number, their total length is verified, and the
chunks of the payload are joined.  A group is one record's segments, so one page.

Defined cases: a null html is an empty payload; a null url is "about:blank", control
characters and spaces in a url are percent-encoded; rows that repeat a page with its
payload are each a response; of null page_ids with equal payloads none is preferred
over a number.  A record that is short of a segment, of another total length or digest
than it says has no payload, and its ``status`` says so.
"""

from __future__ import annotations

import base64
import hashlib
import re
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .shared import shared_path, written

SEGMENT_BYTES = 16 << 10
CHUNK_BYTES = 4 << 10
RECORDS_PER_FILE = 1000
LEAST_REVISIT = 0             # bytes from which equal payloads are stored once
DATE = "2020-01-01T00:00:00Z"
END = b"\r\n\r\n"
RECORD_SCHEMA = ("record_id string, type string, page_id long, origin_id string, segment int, total long, "
                 "digest string, refers_to long, payload_bytes long, block binary")


def digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def chunked(payload: bytes, size: int = CHUNK_BYTES) -> bytes:
    parts = [payload[i:i + size] for i in range(0, len(payload), size)]
    return b"".join(b"%X\r\n%s\r\n" % (len(p), p) for p in parts) + b"0\r\n\r\n"


def dechunked(body: bytes) -> bytes:
    at, parts = 0, []
    while True:
        line = body.index(b"\r\n", at)
        n = int(body[at:line].split(b";")[0], 16)
        if n == 0:
            return b"".join(parts)
        if body[line + 2 + n:line + 4 + n] != b"\r\n":
            raise ValueError("chunk without its end")
        parts.append(body[line + 2:line + 2 + n])
        at = line + 4 + n


def record(kind: str, record_id: str, block: bytes, **fields) -> bytes:
    head = [f"WARC/1.1\r\nWARC-Type: {kind}\r\nWARC-Record-ID: <{record_id}>\r\nWARC-Date: {DATE}"]
    head += [f"{k.replace('_', '-')}: {v}" for k, v in fields.items() if v is not None]
    return "\r\n".join([*head, f"Content-Length: {len(block)}"]).encode() + END + block


def records_of(page_id, url: str | None, payload: bytes, refers_to, revisit: bool, segment_bytes: int) -> Iterator[bytes]:
    """The records of one page, without their closing line ends.  The random part of
    the id keeps rows apart that repeat a page; all segments of a row share it."""
    name = f"urn:page:{'none' if page_id is None else page_id}:{uuid.uuid4().hex}"
    target = re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m[0]):02X}", url or "about:blank")
    http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nTransfer-Encoding: chunked\r\n\r\n"
    common = {"WARC_Target_URI": target, "Page_ID": page_id, "WARC_Payload_Digest": f"sha1:{digest(payload)}",
              "Payload_Length": len(payload), "Content_Type": "application/http; msgtype=response"}
    if revisit:
        yield record("revisit", name, http, **common, WARC_Refers_To=f"<urn:page:{refers_to}>",
                     WARC_Profile="http://netpreserve.org/warc/1.1/revisit/identical-payload-digest")
        return
    block = http + chunked(payload)
    parts = [block[i:i + segment_bytes] for i in range(0, len(block), segment_bytes)]
    yield record("response", name, parts[0], **common, WARC_Segment_Number=1 if len(parts) > 1 else None)
    for k, part in enumerate(parts[1:], 2):
        yield record("continuation", f"{name}:{k}", part, WARC_Segment_Number=k, WARC_Segment_Origin_ID=f"<{name}>",
                     WARC_Segment_Total_Length=len(block) if k == len(parts) else None)


def parsed(content: bytes) -> Iterator[dict]:
    at = 0
    while at < len(content):
        head = content.index(END, at)
        lines = content[at:head].decode().split("\r\n")
        if not lines[0].startswith("WARC/"):
            raise ValueError(f"no record at byte {at}")
        f = {k.lower(): v for k, v in (x.split(": ", 1) for x in lines[1:])}
        at = head + 4 + int(f["content-length"])
        yield f | {"block": content[head + 4:at]}
        if content[at:at + 4] != END:
            raise ValueError(f"record without its end at byte {at}")
        at += 4


def _row(f: dict) -> tuple:
    whole = lambda name: int(f[name]) if name in f else None
    name, refers = f["warc-record-id"][1:-1], f.get("warc-refers-to")
    return (name, f["warc-type"], whole("page-id"), f["warc-segment-origin-id"][1:-1] if "warc-segment-origin-id" in f else name,
            whole("warc-segment-number"), whole("warc-segment-total-length"),
            f["warc-payload-digest"].removeprefix("sha1:") if "warc-payload-digest" in f else None,
            int(refers[1:-1].split(":")[2]) if refers and refers[1:-1].split(":")[2] != "None" else None,
            whole("payload-length"), f["block"])


def write(pages: DataFrame, path: str | None = None, segment_bytes: int = SEGMENT_BYTES,
          least_revisit: int = LEAST_REVISIT) -> str:
    """Writes a record per page (columns page_id, url, html).  Returns the folder."""
    path = path or shared_path(pages.sparkSession, "warc")
    html = F.coalesce(F.encode("html", "UTF-8"), F.lit(b""))
    keyed = pages.select(F.col("page_id").cast("long").alias("page_id"), "url", html.alias("payload"), F.sha1(html).alias("sha"))
    # Payloads that occur again: one row each, written so that Spark knows their size
    # and can split a hot payload in the join.
    firsts = written(keyed.where(F.length("payload") >= least_revisit).groupBy(F.col("sha").alias("sha_f"))
                     .agg(F.min("page_id").alias("first_id"), F.count(F.lit(1)).alias("n")).where("n > 1"), "warc-firsts")

    def records(batches):
        for batch in batches:
            for page_id, url, payload, first_id, again in zip(*(c.to_pylist() for c in batch.columns)):
                out = list(records_of(page_id, url, payload, first_id, again, segment_bytes))
                yield pa.record_batch([pa.array(out, pa.binary())], ["record"])

    again = F.col("sha_f").isNotNull() & F.col("first_id").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("first_id"))
    (keyed.join(firsts, F.col("sha") == F.col("sha_f"), "left")
     .select("page_id", "url", "payload", "first_id", again.alias("again"))
     .mapInArrow(records, "record binary").select(F.col("record").cast("string").alias("value"))
     .write.option("lineSep", END.decode()).option("compression", "gzip")
     .option("maxRecordsPerFile", RECORDS_PER_FILE).text(path))
    return path


def read_records(spark: SparkSession, path: str, segmented: bool | None = None) -> DataFrame:
    """The records of the archives as they are: all, or only those (not) in segments."""
    names = [c.split()[0] for c in RECORD_SCHEMA.split(", ")]
    types = {"string": pa.string(), "long": pa.int64(), "int": pa.int32(), "binary": pa.binary()}
    kinds = [types[c.split()[1]] for c in RECORD_SCHEMA.split(", ")]

    def rows(batches):
        for batch in batches:
            for content in batch.column(0):
                found, held = [], 0
                for f in parsed(zlib.decompress(content.as_py(), 31)):
                    if segmented is None or segmented == ("warc-segment-number" in f):
                        found.append(_row(f))
                        held += len(f["block"])
                    if held > 4 << 20:
                        yield pa.record_batch([pa.array(c, t) for c, t in zip(zip(*found), kinds)], names)
                        found, held = [], 0
                if found:
                    yield pa.record_batch([pa.array(c, t) for c, t in zip(zip(*found), kinds)], names)

    return spark.read.format("binaryFile").load(path).select("content").mapInArrow(rows, RECORD_SCHEMA)


def read(spark: SparkSession, path: str) -> DataFrame:
    """One row per page: page_id, record_type, refers_to, payload_bytes,
    payload_digest, payload (null for a revisit), status."""
    whole = read_records(spark, path, segmented=False).select(
        "type", "page_id", "refers_to", "digest", "payload_bytes", F.array("block").alias("blocks"), F.lit("whole").alias("state"))
    pieces = F.array_sort(F.collect_list(F.struct("segment", "block")))
    length = F.aggregate("pieces", F.lit(0).cast("long"), lambda n, p: n + F.length(p["block"]))
    joined = (read_records(spark, path, segmented=True).groupBy("origin_id")
              .agg(pieces.alias("pieces"), F.max("total").alias("total"), F.max("page_id").alias("page_id"),
                   F.max("digest").alias("digest"), F.max("payload_bytes").alias("payload_bytes"))
              .withColumn("state", F.when(F.col("total").isNull()
                                          | (F.col("pieces.segment") != F.sequence(F.lit(1), F.size("pieces"))), "segment missing")
                          .when(length != F.col("total"), "other length").otherwise("whole"))
              .select(F.lit("response").alias("type"), "page_id", F.lit(None).cast("long").alias("refers_to"), "digest",
                      "payload_bytes", F.col("pieces.block").alias("blocks"), "state"))

    def payloads(types: pa.Array, pieces: pa.Array, states: pa.Array, digests: pa.Array) -> pa.Array:
        out = []
        for kind, blocks, state, said in zip(types.to_pylist(), pieces.to_pylist(), states.to_pylist(), digests.to_pylist()):
            payload, now, block = None, None, b"".join(blocks)
            if state == "whole" and kind == "response":
                head, _, body = block.partition(END)
                try:
                    payload = dechunked(body) if b"transfer-encoding: chunked" in head.lower() else body
                    now = digest(payload)
                    state = "ok" if now == said else "other digest"
                except ValueError:
                    payload, state = None, "broken chunks"
            elif state == "whole":
                state, now = "ok", said
            out.append({"payload": payload if state == "ok" else None, "digest": now, "status": state})
        return pa.array(out, pa.struct([("payload", pa.binary()), ("digest", pa.string()), ("status", pa.string())]))

    body = F.arrow_udf(payloads, "payload binary, digest string, status string")("type", "blocks", "state", "digest")
    return (whole.unionByName(joined).withColumn("body", body)
            .select("page_id", F.col("type").alias("record_type"), "refers_to",
                    F.coalesce(F.length("body.payload").cast("long"), F.when(F.col("type") == "revisit", F.col("payload_bytes"))).alias("payload_bytes"),
                    F.col("body.digest").alias("payload_digest"), F.col("body.payload").alias("payload"), F.col("body.status").alias("status")))
