"""WARC archives: write, read, and reassemble segmented records.

Writing: a record is built inside its task and leaves through Spark's text
sink (each value is a record without its last line feed, which the sink adds),
so archives land wherever Spark can write; files are gzip members of a bounded
number of records. Blocks beyond ``segment_bytes`` become a first record and
*continuation* records. Of equal payloads, one is a response and the others
revisit it.

Reading: each file is one row of Spark's binary reader and is parsed as a
stream. Records in one piece are decoded on the spot. Segments are hash-dealt
by origin id, sorted by segment number inside the partitions, and folded as a
stream: numbers must run from 1 without gaps, the sum of lengths must equal
``WARC-Segment-Total-Length``, and HTTP chunked framing is undone piece by
piece. A task holds one segment at a time (plus one payload if payloads are
asked for), never the segments of a whole group.

Defined results: a null payload is empty; a null page id is written as
``null`` and read as null; of equal payloads, rows that tie for the largest
page id are all responses, as are rows of a payload that has no page id; empty
inputs give an empty archive; a record with a missing or repeated segment, a
wrong length or broken framing is returned with that ``status`` and no
payload; a record that the file's end cuts off comes with ``wrong length``,
whatever its type; segmented records of every type are reassembled, whole ones
of other types than response and revisit are not returned; extra columns are
ignored.
"""

from __future__ import annotations

import base64
import hashlib
import zlib
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerline.llm.common import Scratch, python_ready

SEGMENT_BYTES, CHUNK_BYTES, FILE_RECORDS = 32 * 1024, 8 * 1024, 4096
#: The record types whose block is no HTTP message.
UNFRAMED = ("resource", "conversion", "metadata", "warcinfo")
CRLF = b"\r\n"
DIGEST = "sha1:"


def base32_sha1(data: bytes) -> str:
    return base64.b32encode(hashlib.sha1(data).digest()).decode()


def chunked(body: bytes, size: int = CHUNK_BYTES) -> bytes:
    """The body in HTTP chunked transfer framing."""
    out = [b"%x\r\n%s\r\n" % (len(c), c) for c in (body[i: i + size] for i in range(0, len(body), size))]
    return b"".join(out) + b"0\r\n\r\n"


def record(headers: list[tuple[str, str]], block: bytes) -> bytes:
    head = "".join(f"{k}: {v}\r\n" for k, v in [*headers, ("Content-Length", str(len(block)))])
    return b"WARC/1.1\r\n" + head.encode() + CRLF + block + CRLF + CRLF


def page_records(page: str, position: str, url: str | None, payload: bytes, refers_to: str | None, digest: str,
                 length: int, segment_bytes: int) -> Iterator[bytes]:
    """The record of one page, segmented where its block is too long."""
    rid = f"<urn:page:{page}:{position}>"
    uri = "".join(c if " " < c else "%%%02X" % ord(c) for c in url or "")
    base = [("WARC-Record-ID", rid), ("WARC-Date", "2025-01-01T00:00:00Z"), ("WARC-Target-URI", uri or "urn:none")]
    about = [("WARC-Payload-Digest", f"{DIGEST}{digest}"), ("Content-Type", "application/http;msgtype=response")]
    head = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"
    if refers_to is not None:
        block = head + b"Content-Length: %d\r\n\r\n" % length
        yield record([("WARC-Type", "revisit"), *base, *about, ("WARC-Refers-To", f"<urn:page:{refers_to}>"), (
            "WARC-Profile", "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest")], block)
        return
    block = head + b"Transfer-Encoding: chunked\r\n\r\n" + chunked(payload)
    if len(block) <= segment_bytes:
        yield record([("WARC-Type", "response"), *base, *about], block)
        return
    yield record([("WARC-Type", "response"), *base, *about, ("WARC-Segment-Number", "1")], block[:segment_bytes])
    n = 1
    for i in range(segment_bytes, len(block), segment_bytes):
        n += 1
        last = [("WARC-Segment-Total-Length", str(len(block)))] * (i + segment_bytes >= len(block))
        yield record([("WARC-Type", "continuation"), ("WARC-Record-ID", f"{rid[:-1]}:{n}>"), *base[1:],
                      ("WARC-Segment-Origin-ID", rid), ("WARC-Segment-Number", str(n)), *last], block[i: i + segment_bytes])


def _writer(segment_bytes: int) -> Callable:
    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, i = TaskContext.get().partitionId(), 0
        for b in batches:
            out, size = [], 0
            for page, url, html, refers, hexed, n in zip(*(c.to_pylist() for c in b.columns)):
                digest = base64.b32encode(bytes.fromhex(hexed)).decode()
                i += 1
                for r in page_records(page, f"{part}-{i}", url, html or b"", refers, digest, n, segment_bytes):
                    out.append(r[:-1])
                    size += len(r)
                if size > 1 << 23:
                    yield pa.record_batch([pa.array(out, pa.binary())], ["value"])
                    out, size = [], 0
            if out:
                yield pa.record_batch([pa.array(out, pa.binary())], ["value"])
    return write


def write_archives(pages: DataFrame, path: str, id_col: str = "page_id", url_col: str = "url",
                   payload_col: str = "html", segment_bytes: int = SEGMENT_BYTES,
                   file_records: int = FILE_RECORDS) -> None:
    """One response or revisit record per row under ``path`` (gzip files)."""
    python_ready(pages.sparkSession)
    p = pages.select(F.col(id_col).alias("id"), F.col(url_col).alias("url"),
                     F.coalesce(F.col(payload_col).cast("binary"), F.lit("").cast("binary")).alias("payload"))
    p = p.withColumn("digest", F.sha1("payload"))
    last = p.groupBy("digest").agg(F.max("id").alias("last"), F.count(F.lit(1)).alias("n")).where("n > 1")
    ids = p.select(F.col("id").alias("r_id"), F.col("digest").alias("r_digest"))
    revisits = ids.join(last, F.col("r_digest") == F.col("digest")).where(
        F.col("last").isNotNull() & (F.col("r_id").isNull() | (F.col("r_id") < F.col("last"))))
    revisits = Scratch(pages.sparkSession, "revisits").table(revisits.select("r_id", "r_digest", "last").distinct(), "r")
    # only rows that revisit are joined: few of them travel as a broadcast, many by a shuffle (AQE decides)
    out = p.join(revisits, (F.col("digest") == F.col("r_digest")) & F.col("id").eqNullSafe(F.col("r_id")), "left")
    out = out.select(F.coalesce(F.col("id").cast("string"), F.lit("null")).alias("id"), "url",
                     F.when(F.col("last").isNull(), F.col("payload")).alias("payload"),
                     F.col("last").cast("string").alias("last"), "digest", F.length("payload").cast("long").alias("n"))
    rows = out.mapInArrow(_writer(segment_bytes), "value binary")
    (rows.select(F.col("value").cast("string").alias("value")).write.mode("overwrite")
     .option("lineSep", "\n").option("compression", "gzip").option("maxRecordsPerFile", file_records).text(path))


class Records:
    """Pulls WARC records off one file's bytes, gzip members or plain."""

    def __init__(self, data: bytes):
        self.plain = data[:2] != b"\x1f\x8b"
        self.data, self.at, self.buf = data, 0, bytearray()
        self.z = None if self.plain else zlib.decompressobj(31)
        self.cut = False  # whether the file ended inside the record that was yielded last

    def _more(self) -> bool:
        piece = self.data[self.at: self.at + (1 << 20)]
        if not piece:
            return False
        self.at += len(piece)
        while piece:
            if self.plain:
                self.buf += piece
                break
            self.buf += self.z.decompress(piece)
            piece = self.z.unused_data
            if self.z.eof:
                self.z = zlib.decompressobj(31)
        return True

    def _take(self, n: int) -> bytes | None:
        while len(self.buf) < n:
            if not self._more():
                return None
        out = bytes(self.buf[:n])
        del self.buf[:n]
        return out

    def __iter__(self) -> Iterator[tuple[dict[str, str], bytes]]:
        while True:
            while (end := self.buf.find(CRLF + CRLF)) < 0:
                if not self._more():
                    self.cut = bool(bytes(self.buf).strip())
                    end = len(self.buf)
                    break
            if end == len(self.buf) and not self.cut:
                return
            lines = bytes(self.buf[:end]).decode("utf-8", "replace").strip("\r\n").split("\r\n")
            del self.buf[: end + 4]
            headers = {k.strip().lower(): v.strip() for k, _, v in (x.partition(":") for x in lines[1:])}
            block = None if self.cut else self._take(_int(headers.get("content-length")) or 0)
            if block is None:
                self.cut = True
                yield headers, bytes(self.buf)
                return
            yield headers, block
            self._take(4)


class Payload:
    """Undoes HTTP framing piece by piece: feed() gives payload bytes."""

    def __init__(self):
        self.head, self.state, self.left, self.buf, self.length = None, "head", 0, b"", None

    def feed(self, piece: bytes) -> bytes:
        self.buf += piece
        out = []
        while True:
            if self.state == "head":
                end = self.buf.find(CRLF + CRLF)
                if end < 0:
                    break
                lines = self.buf[:end].decode("latin-1").split("\r\n")
                self.head = {k.strip().lower(): v.strip() for k, _, v in (x.partition(":") for x in lines[1:])}
                self.buf = self.buf[end + 4:]
                self.state = "size" if self.head.get("transfer-encoding", "").lower() == "chunked" else "plain"
            elif self.state == "plain":
                out.append(self.buf)
                self.buf = b""
                break
            elif self.state == "size":
                end = self.buf.find(CRLF)
                if end < 0:
                    break
                try:
                    self.left = int(self.buf[:end].split(b";")[0], 16)
                except ValueError:
                    self.state = "broken"
                    break
                self.buf = self.buf[end + 2:]
                self.state = "data" if self.left else "trailer"
            elif self.state == "data":
                if self.left:
                    got = self.buf[: self.left]
                    out.append(got)
                    self.left -= len(got)
                    self.buf = self.buf[len(got):]
                if self.left or len(self.buf) < 2:
                    break
                if self.buf[:2] != CRLF:
                    self.state = "broken"
                    break
                self.buf, self.state = self.buf[2:], "size"
            elif self.state == "trailer":  # optional header lines, then an empty line
                end = self.buf.find(CRLF)
                if end < 0:
                    break
                self.state = "trailer" if end else "done"
                self.buf = self.buf[end + 2:]
            else:
                break
        return b"".join(out)

    def ended(self) -> bool:
        return self.state == "done" or self.state == "plain"


class Fold:
    """One record, from its segments in order."""

    def __init__(self, keep: bool):
        self.keep, self.parts, self.payload = keep, [], Payload()
        self.sha, self.size, self.block, self.next, self.total, self.fault = hashlib.sha1(), 0, 0, 1, None, None

    def add(self, number: int, total: int | None, block: bytes) -> None:
        if number != self.next:
            self.fault = self.fault or ("repeated segment" if number < self.next else "missing segment")
            return
        self.next += 1
        self.block += len(block)
        self.total = total if total is not None else self.total
        got = self.payload.feed(block)
        self.sha.update(got)
        self.size += len(got)
        if self.keep:
            self.parts.append(got)

    def result(self, segmented: bool) -> tuple:
        status = self.fault
        if status is None and segmented and self.total is None:
            status = "missing segment"
        if status is None and segmented and self.total != self.block:
            status = "wrong length"
        if status is None and not self.payload.ended():
            status = "broken framing"
        if status is not None:
            return status, self.next - 1, None, None, None
        return "ok", self.next - 1, self.size, base64.b32encode(self.sha.digest()).decode(), b"".join(self.parts) if self.keep else None


RECORD = ("record_id string, record_type string, target_uri string, refers_to string, stated_digest string, "
          "status string, n_segments int, payload_bytes long, payload_digest string, payload binary")
_ARROW = pa.schema([("record_id", pa.string()), ("record_type", pa.string()), ("target_uri", pa.string()),
                    ("refers_to", pa.string()), ("stated_digest", pa.string()), ("status", pa.string()),
                    ("n_segments", pa.int32()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()),
                    ("payload", pa.binary())])
_PART = pa.schema([("origin", pa.string()), ("number", pa.int32()), ("total", pa.int64()), ("block", pa.binary())])


def _int(x: str | None) -> int | None:
    return int(x) if x is not None and x.isdigit() else None


def _revisit(h: dict[str, str], block: bytes) -> tuple:
    p = Payload()
    p.feed(block)
    return "ok", 1, _int((p.head or {}).get("content-length")), (h.get("warc-payload-digest") or "").removeprefix(DIGEST) or None, None


def _reader(keep: bool) -> Callable:
    """Files -> (record, part): a whole record, or one segment of a record."""
    def parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for i in range(b.num_rows):
                rows, size = [], 0
                records = Records(b.column(0)[i].as_py())
                for h, block in records:
                    kind = h.get("warc-type")
                    if kind not in ("response", "revisit", "continuation") and "warc-segment-number" not in h and not records.cut:
                        continue  # whole records of other types
                    own = (h.get("warc-record-id"), kind, h.get("warc-target-uri"), h.get("warc-refers-to"), h.get("warc-payload-digest"))
                    part = None
                    if "warc-segment-number" in h:
                        part = (h.get("warc-segment-origin-id") or own[0], _int(h["warc-segment-number"]) or 0,
                                _int(h.get("warc-segment-total-length")), block)
                        rest = (None,) * 5
                    elif records.cut:
                        rest = ("wrong length", 0, None, None, None)
                    elif kind == "revisit":
                        rest = _revisit(h, block)
                    else:
                        f = Fold(keep)
                        f.add(1, None, block)
                        rest = f.result(False)
                    rows.append((dict(zip(_ARROW.names, own + rest)), part and dict(zip(_PART.names, part))))
                    size += len(block)
                    if size > 1 << 23:
                        yield _batch(rows)
                        rows, size = [], 0
                if rows:
                    yield _batch(rows)
    return parse


def _batch(rows: list) -> pa.RecordBatch:
    return pa.record_batch([pa.array([r for r, _ in rows], pa.struct(_ARROW)), pa.array([p for _, p in rows], pa.struct(_PART))],
                           ["record", "part"])


def _folder(keep: bool) -> Callable:
    """Sorted segments -> one record per origin, streaming."""
    def fold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        origin = f = first = None

        def done() -> pa.RecordBatch:
            row = dict(first or {}) | {"record_id": origin} | dict(zip(_ARROW.names[5:], f.result(True)))
            return pa.RecordBatch.from_pylist([row], _ARROW)

        for b in batches:
            for own, part in zip(b.column(0).to_pylist(), b.column(1)):
                p = part.as_py()
                if f is None or p["origin"] != origin:
                    if f is not None:
                        yield done()
                    origin, f, first = p["origin"], Fold(keep), None
                if own["record_type"] != "continuation":
                    first = own
                    if own["record_type"] in UNFRAMED:
                        f.payload.state = "plain"  # the block is the payload
                f.add(p["number"], p["total"], p["block"])
        if f is not None:
            yield done()
    return fold


def read_records(spark: SparkSession, path: str, payloads: bool = True) -> DataFrame:
    """The records of all archives under ``path``, segments reassembled: see
    RECORD. With ``payloads=False`` sizes and digests only."""
    python_ready(spark)
    files = spark.read.format("binaryFile").load(path).select("content")
    return reassemble(files.mapInArrow(_reader(payloads), f"record struct<{_struct(RECORD)}>, part struct<origin:string,"
                                       "number:int,total:bigint,block:binary>"), payloads)


def _struct(ddl: str) -> str:
    return ",".join(":".join(x.split()) for x in ddl.split(","))


def reassemble(pieces: DataFrame, payloads: bool = True) -> DataFrame:
    """Whole records as they are; segments folded by origin in segment order."""
    whole = pieces.where(F.col("part").isNull()).select("record.*")
    parts = (pieces.where(F.col("part").isNotNull()).repartition("part.origin")
             .sortWithinPartitions("part.origin", "part.number"))
    return whole.unionByName(parts.mapInArrow(_folder(payloads), RECORD))
