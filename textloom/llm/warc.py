"""WARC archives: writing with revisits, chunked framing and continuation
records, and reading them back with segment reassembly.

Archives are written by Spark's text sink and read by its text source, so any
file system that Spark knows will do and a large archive is read in splits.  The
record separator is the blank line and version line that start the next record;
the writer never lets a block hold the version string in one piece (it cuts a
chunk inside it), and the reader glues a foreign record that does back together
by its Content-Length.  Hadoop's line reader misses a separator that follows a
block's own line ends over the edge of its buffer; such a line holds more than
one record, and all of them are read.

Only the records of segmented payloads are grouped, by their origin's id; whole
records never move.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from textloom.llm.common import checkpointed
from textloom.operators.bounded import skew_safe_lookup

SEGMENT_BYTES = 32_768
CHUNK_BYTES = 8_192
DATE = "2020-01-01T00:00:00Z"

# fixed values of the format
VERSION = b"WARC/1.1"
CRLF = b"\r\n"
END = b"\r\n\r\n"
MARK = END + VERSION + CRLF
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
_HTTP = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nTransfer-Encoding: chunked\r\n\r\n"
_URN = "urn:textloom:page:"

RECORD = ("record_id string, type string, url string, refers_to string, digest string, origin string, "
          "segment int, total long, block binary, ok boolean")


def base32_sha1(payload: Column) -> Column:
    """Upper-case base32 of the SHA-1: five hex digits make four base-32 ones."""
    hexed = F.sha1(payload)
    parts = [F.lpad(F.conv(F.substring(hexed, 1 + 5 * i, 5), 16, 32), 4, "0") for i in range(8)]
    return F.translate(F.concat(*parts), "0123456789ABCDEFGHIJKLMNOPQRSTUV", "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567")


def chunked(payload: bytes, chunk: int = CHUNK_BYTES) -> bytes:
    """Chunked transfer framing; no chunk holds the version string whole."""
    cuts = {0, len(payload), *range(0, len(payload), chunk),
            *(m.start() + 4 for m in re.finditer(re.escape(VERSION), payload))}
    cuts = sorted(cuts)
    out = [b"%x\r\n%b\r\n" % (b - a, payload[a:b]) for a, b in zip(cuts, cuts[1:])]
    return b"".join(out) + b"0\r\n\r\n"


def dechunk(body: bytes) -> tuple[bytes, bool]:
    """The payload of a chunked body, and whether its framing is complete.
    Chunk extensions and trailers are read over."""
    out, at = [], 0
    while True:
        end = body.find(CRLF, at)
        if end < 0:
            return b"".join(out), False
        size = body[at:end].split(b";")[0].strip()
        if not re.fullmatch(rb"[0-9A-Fa-f]+", size):
            return b"".join(out), False
        n, at = int(size, 16), end + 2
        if n == 0:
            return b"".join(out), body[at:at + 2] == CRLF or body.find(END, at) >= 0
        if at + n + 2 > len(body) or body[at + n:at + n + 2] != CRLF:
            return b"".join([*out, body[at:at + n]]), False
        out.append(body[at:at + n])
        at += n + 2


def _record(kind: str, rid: str, block: bytes, **fields) -> bytes:
    head = {"WARC-Type": kind, "WARC-Record-ID": f"<{rid}>", "WARC-Date": DATE,
            **{k.replace("_", "-"): v for k, v in fields.items() if v is not None},
            "Content-Length": len(block)}
    lines = "".join(f"{k}: {v}\r\n" for k, v in head.items())
    return VERSION + CRLF + lines.encode("utf-8", "surrogatepass") + CRLF + block


def page_records(page: str, row: int, url: str | None, payload: bytes, digest: str, refers: str | None,
                 segment_bytes: int = SEGMENT_BYTES, chunk_bytes: int = CHUNK_BYTES) -> Iterator[bytes]:
    """The record of one page, and its continuations if its block is longer
    than a segment.  A revisit has the response's header and no body."""
    rid = f"{_URN}{page}:{row}"
    if url is not None:
        url = re.sub("[\r\n]", lambda m: f"%{ord(m[0]):02X}", url)
    common = {"WARC_Target_URI": url, "WARC_Payload_Digest": f"sha1:{digest}",
              "Content_Type": "application/http;msgtype=response"}
    if refers is not None:
        yield _record("revisit", rid, _HTTP, **common, WARC_Profile=PROFILE, WARC_Refers_To=f"<{_URN}{refers}>")
        return
    block = _HTTP + chunked(payload, chunk_bytes)
    parts = [block[a:a + segment_bytes] for a in range(0, len(block), segment_bytes)]
    if len(parts) == 1:
        yield _record("response", rid, block, **common)
        return
    yield _record("response", rid, parts[0], **common, WARC_Segment_Number=1)
    for k, part in enumerate(parts[1:], 2):
        yield _record("continuation", f"{rid}:{k}", part, WARC_Segment_Origin_ID=f"<{rid}>", WARC_Segment_Number=k,
                      WARC_Segment_Total_Length=len(block) if k == len(parts) else None)


def write_warc(pages: DataFrame, path: str, id_col: str = "page_id", url_col: str = "url",
               payload_col: str = "html", segment_bytes: int = SEGMENT_BYTES,
               chunk_bytes: int = CHUNK_BYTES) -> None:
    """Write a record per row.  Null payloads are empty.  Of rows with equal
    payloads those with the largest id are responses (rows that repeat an id
    too), the others revisit it; null ids are smaller than any."""
    d = pages.select(F.col(id_col).cast("string").alias("_page"), F.col(id_col).alias("_id"),
                     F.col(url_col).alias("_url"),
                     F.coalesce(F.col(payload_col).cast("binary"), F.lit(b"")).alias("_payload"))
    d = d.withColumn("_digest", base32_sha1(F.col("_payload")))
    same = d.groupBy("_digest").agg(F.max("_id").alias("_keep"), F.count("*").alias("w")).filter("w > 1")
    same = checkpointed(same)
    d = skew_safe_lookup(d, same.select("_digest", "_keep"), ["_digest"], same.select("_digest", "w"),
                         salt_by=["_page", "_url"])
    refers = F.when(F.col("_keep").isNotNull() & ~F.col("_id").eqNullSafe(F.col("_keep")),
                    F.col("_keep").cast("string"))
    d = d.select(F.coalesce("_page", F.lit("")).alias("_page"), F.monotonically_increasing_id().alias("_row"),
                 "_url", "_payload", "_digest", refers.alias("_refers"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows = zip(*(b.column(i) for i in range(6)))
            out = [r for row in rows for r in page_records(*(x.as_py() for x in row), segment_bytes, chunk_bytes)]
            yield pa.RecordBatch.from_arrays([pa.array(out, pa.binary())], ["value"])

    records = d.mapInArrow(run, "value binary").select(F.col("value").cast("string"))
    records.write.option("lineSep", END.decode()).text(path)  # the sink writes the bytes as they are


def _parse(line: bytes) -> tuple[dict, bytes, int]:
    head, _, rest = line.partition(END)
    fields = {}
    for x in head.split(CRLF):
        k, sep, v = x.partition(b":")
        if sep:
            fields[k.strip().lower()] = v.strip().decode("utf-8", "replace")
    length = fields.get(b"content-length", "")
    return fields, rest, int(length) if length.isdigit() else -1


def records(spark: SparkSession, path: str) -> DataFrame:
    """Every record of the archives under ``path`` (columns ``RECORD``).  ``ok``
    is false when a block is shorter or longer than its Content-Length or has none."""
    lines = spark.read.option("lineSep", MARK.decode()).text(path).select(
        F.col("value").cast("binary").alias("value"), F.input_file_name().alias("file"))
    schema = pa.schema([("record_id", pa.string()), ("type", pa.string()), ("url", pa.string()),
                        ("refers_to", pa.string()), ("digest", pa.string()), ("origin", pa.string()),
                        ("segment", pa.int32()), ("total", pa.int64()), ("block", pa.binary()), ("ok", pa.bool_())])

    def row(fields: dict, block: bytes, ok: bool) -> dict:
        f = lambda k: fields.get(k)
        number = lambda k: int(f(k)) if (f(k) or "").isdigit() else None
        bare = lambda v: v[1:-1] if v and v[0] == "<" else v
        seg, rid = number(b"warc-segment-number"), bare(f(b"warc-record-id"))
        return {"record_id": rid, "type": f(b"warc-type"), "url": f(b"warc-target-uri"),
                "refers_to": bare(f(b"warc-refers-to")), "digest": f(b"warc-payload-digest"),
                "origin": None if seg is None else bare(f(b"warc-segment-origin-id")) or rid, "segment": seg,
                "total": number(b"warc-segment-total-length"), "block": block, "ok": ok}

    def cut(fields: dict, rest: bytes, n: int, out: list[dict]) -> tuple[dict, bytes, int] | None:
        """Append the record and those behind it in ``rest``; the last one is
        given back if its block is not complete."""
        while n <= len(rest):
            end = max(n, 0)
            at = rest.find(MARK, end)
            stray = rest[end:] if at < 0 else rest[end:at]
            out.append(row(fields, rest[:end], n >= 0 and not stray.strip()))
            if at < 0:
                return None
            fields, rest, n = _parse(rest[at + len(MARK):])
        return fields, rest, n

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        open_, file = None, None  # a record whose block goes on behind a separator
        short = lambda fields, rest, n: row(fields, rest, False)
        for b in batches:
            out = []
            for v, name in zip(b.column(0), b.column(1)):
                line = v.as_py()
                if open_ is not None:
                    fields, rest, n = open_
                    if name.as_py() == file and not line.startswith(VERSION + CRLF):
                        open_ = cut(fields, rest + MARK + line, n, out)
                        continue
                    out.append(short(*open_))
                    open_ = None
                file = name.as_py()
                if not line.strip():
                    continue
                open_ = cut(*_parse(line.removeprefix(VERSION + CRLF)), out)
            yield pa.RecordBatch.from_pylist(out, schema)
        if open_ is not None:
            yield pa.RecordBatch.from_pylist([short(*open_)], schema)

    return lines.mapInArrow(run, RECORD)


def reassemble(segments: list[dict]) -> tuple[bytes, bool]:
    """The block of segments in order, and whether they are 1, 2, ... with one
    total on the last that equals their length."""
    block = b"".join(s["block"] for s in segments)
    good = [s["segment"] for s in segments] == list(range(1, len(segments) + 1))
    totals = [s["total"] for s in segments]
    good = good and all(s["ok"] for s in segments) and totals[:-1] == [None] * (len(segments) - 1)
    return block, good and totals[-1] == len(block)


def payload_of(block: bytes) -> tuple[bytes, bool]:
    """Payload of an HTTP response block; chunked framing is decoded."""
    head, sep, body = block.partition(END)
    if not sep:
        return b"", False
    if re.search(rb"(?im)^transfer-encoding:[^\r\n]*\bchunked\b", head):
        return dechunk(body) if body else (b"", True)
    return body, True


def read_warc(spark: SparkSession, path: str) -> DataFrame:
    """``record_id, type, url, refers_to, digest, payload, ok`` of every response
    and revisit, continuations put back in.  ``ok`` is false where lengths,
    segment numbers or framing do not fit; such records are kept."""
    every = records(spark, path)
    out = "record_id string, type string, url string, refers_to string, digest string, payload binary, ok boolean"
    names = ["record_id", "type", "url", "refers_to", "digest"]

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            payloads, good = [], []
            for parts in b.column("parts"):
                block, fits = _block(parts.as_py())
                payload, framed = payload_of(block)
                payloads.append(payload)
                good.append(fits and framed)
            yield pa.RecordBatch.from_arrays(
                [*(b.column(n) for n in names), pa.array(payloads, pa.binary()), pa.array(good, pa.bool_())],
                [*names, "payload", "ok"])

    part = F.struct("segment", "total", "block", "ok")
    whole = every.filter("segment IS NULL").select(*names, F.array(part).alias("parts"))
    # the first segment's record names the origin; a group is one record's block
    first = lambda c: F.min_by(c, "segment").alias(c)
    grouped = (every.filter("segment IS NOT NULL").groupBy("origin")
               .agg(*(first(c) for c in names), F.sort_array(F.collect_list(part)).alias("parts"))
               .select(*names, "parts"))
    return whole.mapInArrow(decode, out).unionByName(grouped.mapInArrow(decode, out))


def _block(parts: list[dict]) -> tuple[bytes, bool]:
    if len(parts) == 1 and parts[0]["segment"] is None:
        return parts[0]["block"], parts[0]["ok"]
    return reassemble(parts)


def page_of(record_id: Column) -> Column:
    """The page id in a record id of this writer; null if the page had none."""
    return F.nullif(F.regexp_extract(record_id, f"^{_URN}([^:]*)", 1), F.lit(""))
