"""WARC archives: a writer with revisit records and a splittable reader.

Writing. Every record is a gzip member of its own. The files go through Spark's text
writer, so they are committed like any Spark output and may lie in any store Spark writes
to: a row is a member without its last byte, and the line separator is that byte. The last
byte of a gzip member is the top byte of the length, 0 below 16 MiB; a longer record is
followed by an empty member, whose last byte is 0 too. The files are plain concatenations of gzip
members, which any gzip or WARC tool reads.

Deduplication. Of records with equal payloads of at least ``min_revisit`` bytes the one with the
smallest id is a ``response``, the others are ``revisit`` records without payload, which
name it in ``WARC-Refers-To``. Digests are grouped with map-side combination; the list of
revisits, (id, digest) pairs, is written out and counted, and broadcast to the payloads when it
has at most ``broadcast_ids`` rows; a longer one is joined.

Reading. A task gets a byte range of a file, scans it for the gzip magic, and checks each
candidate by decoding it: it must inflate to a WARC version line and a header block. A task
owns the records that start inside its range and reads the last one past its end. A magic
number inside of a record's compressed bytes is never tried, as the scan goes on behind the
record; one that is met first, at the start of a range, fails the check.

Damage. A file starts with a member, and where one ends the next begins, so a task knows where
to expect the next one: a member there that doesn't inflate to its check sum, is cut off, or
whose payload isn't that of its digest is damaged. A task also checks the member behind its last,
which belongs to another range, so each member is vouched for by the one before it. Damage fails
the job, or on demand gives a row of type ``damaged``, and the scan goes on at the next record.

Defined results: a null payload is an empty one; repeated ids are written once per row (equal
rows of the smallest id: all of them responses); a null id is written as ``null``, is always
a response, and no record refers to it; a whole member without a WARC record is passed over; an
empty table gives archives without records.
"""

from __future__ import annotations

import hashlib
import re
import zlib
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quirework.llm.common import materialize, sliced

MAGIC = b"\x1f\x8b\x08"
RECORD_ID = "urn:x-page:"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
#: The record type of rows that stand for damage.
DAMAGED = "damaged"
SCHEMA = "file string, offset long, record_type string, record_id string, target_uri string, payload_bytes long, payload_digest string, refers_to string, payload binary"


def gzip_member(data: bytes, level: int = 6) -> bytes:
    c = zlib.compressobj(level, zlib.DEFLATED, 31)
    return c.compress(data) + c.flush()


#: An empty gzip member; its last byte is 0.
EMPTY_MEMBER = gzip_member(b"")


def warc_record(key: int | None, url: str | None, payload: bytes, digest: str, refers_to: int | None) -> bytes:
    """The bytes of one uncompressed record: WARC headers, then an HTTP response."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    uri = re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m[0]):02X}", url or "")
    block = http + (payload if refers_to is None else b"")
    head = [
        "WARC/1.1",
        f"WARC-Type: {'response' if refers_to is None else 'revisit'}",
        f"WARC-Record-ID: <{RECORD_ID}{'null' if key is None else key}>",
        "WARC-Date: 1970-01-01T00:00:00Z",
        f"WARC-Target-URI: {uri}",
        f"WARC-Payload-Digest: sha256:{digest}",
        f"Content-Type: application/http; msgtype=response\r\nContent-Length: {len(block)}",
    ]
    if refers_to is not None:
        head += [f"WARC-Refers-To: <{RECORD_ID}{refers_to}>", f"WARC-Profile: {PROFILE}"]
    return "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def with_revisits(pages: DataFrame, min_revisit: int = 100, id_col: str = "page_id", url_col: str = "url", payload_col: str = "html", broadcast_ids: int = 500_000) -> DataFrame:
    """(id, url, payload, digest, refers_to): which record each one revisits, if any."""
    payload = F.coalesce(pages[payload_col].cast("string"), F.lit("")).cast("binary")
    rows = pages.select(pages[id_col].cast("long").alias("id"), pages[url_col].cast("string").alias("url"), payload.alias("payload"))
    rows = rows.withColumn("digest", F.sha2("payload", 256))
    large = rows.where(F.octet_length("payload") >= min_revisit)
    # only digests that occur more than once, as (later id, first id): payloads stay where they are
    first = large.groupBy("digest").agg(F.min("id").alias("first"), F.count(F.lit(1)).alias("n")).where("n > 1").select("digest", "first")
    later = large.select("id", "digest").join(first, "digest").where("id > first").select("id", "digest", F.col("first").alias("refers_to")).distinct()
    later = materialize(later, "revisits")
    return rows.join(F.broadcast(later) if later.count() <= broadcast_ids else later, ["id", "digest"], "left")


def write_archives(pages: DataFrame, path: str, min_revisit: int = 100, **cols: str) -> None:
    """Write one archive per task below ``path``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in sliced(batches, 64):
            out = []
            for key, url, payload, digest, refers in zip(*(b.column(c).to_pylist() for c in ("id", "url", "payload", "digest", "refers_to")), strict=True):
                member = gzip_member(warc_record(key, url, payload, digest, refers))
                if member[-1]:
                    member += EMPTY_MEMBER
                out.append(member[:-1])
            yield pa.RecordBatch.from_arrays([pa.array(out, pa.binary())], ["member"])

    members = with_revisits(pages, min_revisit, **cols).mapInArrow(run, "member binary")
    # a cast of binary to string keeps the bytes as they are, and the writer copies them
    members.select(F.col("member").cast("string").alias("value")).write.option("lineSep", "\u0000").text(path)


def archive_ranges(spark: SparkSession, path: str, range_bytes: int) -> DataFrame:
    """(file, start, end) rows that cover all bytes of the files below ``path``."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(path).select("path", "length")
    starts = F.explode(F.sequence(F.lit(0).cast("long"), F.greatest(F.col("length") - 1, F.lit(0)), F.lit(range_bytes).cast("long")))
    return files.where("length > 0").select(F.col("path").alias("file"), starts.alias("start")).withColumn("end", F.col("start") + range_bytes)


class Window:
    """Bytes of a file from some offset on, read in steps and dropped when passed."""

    def __init__(self, source: pa.NativeFile, at: int, step: int):
        self.source, self.at, self.step, self.data, self.ended = source, at, step, b"", False
        source.seek(at)

    def more(self) -> bool:
        got = b"" if self.ended else self.source.read(self.step)
        self.ended = not got
        self.data += got
        return bool(got)

    def drop(self, n: int) -> None:
        self.data, self.at = self.data[n:], self.at + n


def inflate(w: Window, known: bool) -> tuple[bytes, int] | None:
    """The member at the window's start and its length, or None if there is no whole one.

    Unless a member is ``known`` to start here, the first bytes are checked to be a record's
    before more is read: a false candidate costs little.
    """
    z, out, used, head = zlib.decompressobj(31), [], 0, b""
    try:
        while not z.eof:
            if used >= len(w.data) and not w.more():
                return None
            part = w.data[used : used + 65536]
            out.append(z.decompress(part))
            used += len(part) - len(z.unused_data)
            if not known and len(head) < 5:
                head += out[-1]
                if head[:5] != b"WARC/"[: len(head)]:
                    return None
    except zlib.error:
        return None
    return (b"".join(out), used) if known or len(head) >= 5 else None


def parse_record(data: bytes) -> dict | None:
    """Headers and payload of one record, or None if its header block isn't one."""
    head, sep, rest = data.partition(b"\r\n\r\n")
    lines = head.decode("utf-8", "replace").split("\r\n")
    fields = {k.strip().lower(): v.strip() for k, colon, v in (x.partition(":") for x in lines[1:]) if colon}
    if not sep or "warc-type" not in fields or not fields.get("content-length", "").isdigit():
        return None
    block = rest[: int(fields["content-length"])]
    http, _, payload = block.partition(b"\r\n\r\n")
    size = re.search(rb"(?im)^content-length:\s*(\d+)", http)
    kind = fields["warc-type"]
    stated = fields.get("warc-payload-digest", "").removeprefix("sha256:")
    digest = hashlib.sha256(payload).hexdigest() if kind == "response" else stated
    if len(block) < int(fields["content-length"]) or (stated and stated != digest):
        return {"record_type": DAMAGED}
    return {
        "record_type": kind,
        "record_id": fields.get("warc-record-id", "").strip("<>"),
        "target_uri": fields.get("warc-target-uri"),
        "payload": payload if kind == "response" else None,
        "payload_bytes": len(payload) if kind == "response" else int(size[1]) if size else None,
        "payload_digest": digest,
        "refers_to": fields["warc-refers-to"].strip("<>") if "warc-refers-to" in fields else None,
    }


def scan_range(source: pa.NativeFile, start: int, end: int, step: int = 1 << 18) -> Iterator[tuple[int, dict]]:
    """(offset, record) of the records that start in [start, end), and of damage behind one of
    them or at the file's start. ``known``: a member must start where the window stands."""
    w = Window(source, start, step)
    known = start == 0
    while w.at < end:
        if not known:
            i = w.data.find(MAGIC)
            if i < 0:
                w.drop(max(0, len(w.data) - len(MAGIC) + 1))
                if w.at >= end or not w.more():
                    return
                continue
            w.drop(i)
            if w.at >= end:
                return
        elif not w.data and not w.more():
            return  # the file's end
        found = inflate(w, known)
        record = parse_record(found[0]) if found else None
        if found and (known or record is not None):
            if record is not None:
                yield w.at, record
            w.drop(found[1])
            known = True
            continue
        if known:
            yield w.at, {"record_type": DAMAGED}
            known = False
        w.drop(1)
    # the next member is another range's, but only from here it is known to be there
    if known and (w.data or w.more()) and inflate(w, True) is None:
        yield w.at, {"record_type": DAMAGED}


def read_archives(spark: SparkSession, path: str, range_bytes: int = 8 << 20, with_payload: bool = True, keep_damaged: bool = False, max_tasks: int = 20_000) -> DataFrame:
    """All records of the archives below ``path``, each from the task that owns its start.

    Damage raises, or with ``keep_damaged`` gives a row of type ``damaged`` with its place; the
    ranges that it touches may both report it. At most ``max_tasks`` tasks take the ranges.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = [f.split()[0] for f in SCHEMA.split(", ")]
        for b in batches:
            for r in b.to_pylist():
                fs, name = pyarrow.fs.FileSystem.from_uri(r["file"])
                with fs.open_input_file(name) as source:
                    rows: list[dict] = []
                    size = 0
                    for at, record in scan_range(source, r["start"], r["end"]):
                        if record["record_type"] == DAMAGED and not keep_damaged:
                            raise ValueError(f"damaged record at byte {at} of {r['file']}")
                        if not with_payload:
                            record["payload"] = None
                        rows.append({"file": r["file"], "offset": at, **record})
                        size += len(record.get("payload") or b"") + 500
                        if size > 4 << 20:
                            yield to_batch(rows, names)
                            rows, size = [], 0
                    yield to_batch(rows, names)

    ranges = archive_ranges(spark, path, range_bytes)
    n = min(max(1, ranges.count()), max_tasks)
    return ranges.repartition(n).mapInArrow(run, SCHEMA)


def to_batch(rows: list[dict], names: list[str]) -> pa.RecordBatch:
    kinds = {"offset": pa.int64(), "payload_bytes": pa.int64(), "payload": pa.binary()}
    return pa.RecordBatch.from_arrays([pa.array([r.get(n) for r in rows], kinds.get(n, pa.string())) for n in names], names)
