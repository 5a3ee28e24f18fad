"""WARC archives of pages: a writer through Spark's own file commit, and a salvage reader.

Writing.  Of the pages with equal payloads (at least ``min_bytes`` long) the one with the
largest ``page_id`` becomes a ``response`` record, the others ``revisit`` records that refer
to it.  Each record is a gzip member of its own.  The members are written by Spark's text
writer, so files appear only when their task is committed, and a lost executor leaves
nothing half written.  That writer puts a separator after each row; a member's last byte
(the top byte of its length) is zero below 16 MB, so the separator is the zero byte and is
itself the member's end.  A longer record is followed by an empty member that ends in zero.
``compressed=False`` writes plain records; the separator is their last line feed.

Reading.  A file is read member by member (or record by record).  Each record has to parse,
be as long as it says, end in two line ends and agree with its block digest.  Where a check
fails, the reader looks for the next gzip magic or ``WARC/`` version line at which a whole
valid member or record starts, goes on there, and reports the bytes between as a gap with
file, offset, length and reason.  Nothing valid behind a damage is lost, no bytes vanish
unlogged.

Defined results: a null html is an empty payload, a null url is left out; a null page_id is
written as ``none`` and read back as null, and counts as the smallest; rows that share the
largest id and the payload are all responses; empty tables give no records; other columns
are ignored.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import re
import zlib
from collections.abc import Iterator
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import cut, scratch_path

FILE_BYTES = 64 << 20      # a file is closed when it holds that much, so a reader holds little more than one record beyond it
ID_PREFIX = "urn:assay:page:"
PROFILE = "http://netpreserve.org/warc/1.0/revisit/identical-payload-digest"   # fixed value
DATE = "2024-01-01T00:00:00Z"
MAGIC = b"\x1f\x8b\x08"
EMPTY_MEMBER = gzip.compress(b"", mtime=0)
VERSION = re.compile(rb"WARC/1\.[01]\r\n")


# --------------------------------------------------------------------------
# writing
# --------------------------------------------------------------------------

def base32_sha1(data: bytes) -> str:
    return base64.b32encode(hashlib.sha1(data).digest()).decode()


def _id(page_id: int | None) -> str:
    return f"<{ID_PREFIX}{'none' if page_id is None else page_id}>"


def encode_record(page_id: int | None, url: str | None, payload: bytes, refers_to: int | None) -> bytes:
    """One record; ``refers_to`` makes it a revisit, whose block is the HTTP head alone."""
    http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % len(payload)
    block = http if refers_to is not None else http + payload
    head = [("WARC-Type", "response" if refers_to is None else "revisit"), ("WARC-Record-ID", _id(page_id)),
            ("WARC-Date", DATE), ("Content-Type", "application/http; msgtype=response"),
            ("WARC-Payload-Digest", f"sha1:{base32_sha1(payload)}"), ("WARC-Block-Digest", f"sha1:{base32_sha1(block)}")]
    if url is not None:
        head.append(("WARC-Target-URI", re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m[0]):02X}", url)))
    if refers_to is not None:
        head += [("WARC-Refers-To", _id(refers_to)), ("WARC-Profile", PROFILE)]
    head.append(("Content-Length", str(len(block))))
    return b"WARC/1.0\r\n" + "".join(f"{k}: {v}\r\n" for k, v in head).encode() + b"\r\n" + block + b"\r\n\r\n"


def encode_member(record: bytes) -> bytes:
    """A gzip member that ends in a zero byte (see above)."""
    member = gzip.compress(record, 6, mtime=0)
    return member if member.endswith(b"\0") else member + EMPTY_MEMBER


def _encode(compressed: bool, file_bytes: int):
    """Records with the number of the task's file that they go to."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        volume, held = 0, 0
        for batch in batches:
            for start in range(0, batch.num_rows, 256):
                out, volumes = [], []
                for page_id, url, html, keeper in zip(*[c.to_pylist() for c in batch.slice(start, 256).columns], strict=True):
                    record = encode_record(page_id, url, (html or "").encode(), None if keeper == page_id else keeper)
                    out.append((encode_member(record) if compressed else record)[:-1])
                    if held and held + len(out[-1]) > file_bytes:
                        volume, held = volume + 1, 0
                    held += len(out[-1]) + 1
                    volumes.append(volume)
                yield pa.RecordBatch.from_arrays([pa.array(out, pa.binary()), pa.array(volumes, pa.int32())], names=["value", "volume"])
    return run


def write_archives(pages: DataFrame, path: str, min_bytes: int = 0, compressed: bool = True, file_bytes: int = FILE_BYTES) -> None:
    """Archives of ``pages(page_id, url, html)`` below ``path``; a file of several records has at most ``file_bytes``."""
    html = F.coalesce(F.col("html"), F.lit(""))
    known = pages.select(F.col("page_id").cast("long").alias("page_id"), "url", "html",
                         F.sha1(html.cast("binary")).alias("digest"), F.octet_length(html).alias("size"))
    # one row per payload, combined before the shuffle and written, so that the join can split a hot one
    keepers = cut(known.where(F.col("size") >= min_bytes).groupBy("digest").agg(F.max("page_id").alias("keeper")))
    rows = known.join(keepers, "digest", "left").select("page_id", "url", "html", "keeper")
    rows.mapInArrow(_encode(compressed, file_bytes), "value binary, volume int").select(F.col("value").cast("string"), "volume") \
        .write.option("lineSep", "\0" if compressed else "\n").option("compression", "none").partitionBy("volume").text(path)


# --------------------------------------------------------------------------
# reading
# --------------------------------------------------------------------------

class Damaged(ValueError):
    """A member or record that fails a check."""


class Record(NamedTuple):
    headers: dict[str, str]
    block: bytes
    length: int     # bytes it takes, version line to last line end


def parse_record(data: bytes, at: int) -> Record:
    """The record that starts at ``at``; raises ``Damaged``."""
    if not VERSION.match(data, at):
        raise Damaged("no version line")
    end = data.find(b"\r\n\r\n", at)
    if end < 0:
        raise Damaged("headers do not end")
    headers = {}
    for line in data[at:end].split(b"\r\n")[1:]:
        name, colon, value = line.partition(b":")
        if not colon:
            raise Damaged("bad header line")
        headers[name.decode("utf-8", "replace").lower()] = value.strip().decode("utf-8", "replace")
    length = headers.get("content-length", "")
    if not length.isascii() or not length.isdigit():
        raise Damaged("no content length")
    stop = end + 4 + int(length)
    if data[stop:stop + 4] != b"\r\n\r\n":
        raise Damaged("wrong length")
    block = data[end + 4:stop]
    if headers.get("warc-block-digest", "sha1:" + base32_sha1(block)) != "sha1:" + base32_sha1(block):
        raise Damaged("wrong block digest")
    return Record(headers, block, stop + 4 - at)


def read_member(data: bytes, at: int) -> tuple[bytes, int]:
    """The gzip member that starts at ``at``: its content and length; raises ``Damaged``."""
    if data[at:at + 3] != MAGIC:
        raise Damaged("no gzip magic")
    engine = zlib.decompressobj(31)
    content, step, here = [], 1 << 12, at
    try:
        while not engine.eof:
            part = data[here:here + step]
            if not part:
                raise Damaged("member is cut off")
            content.append(engine.decompress(part))
            here += len(part)
            step = min(2 * step, 1 << 20)   # what is copied beyond the member's end stays below its own size and 4 KB
    except zlib.error as error:
        raise Damaged(f"gzip: {error}") from error
    return b"".join(content), here - len(engine.unused_data) - at


class _Finder:
    """The next place of a mark; each stretch of the data is searched once."""

    def __init__(self, data: bytes, pattern: re.Pattern):
        self.data, self.pattern, self.at = data, pattern, -1

    def after(self, at: int) -> int:
        if self.at <= at:
            found = self.pattern.search(self.data, at + 1)
            self.at = found.start() if found else len(self.data)
        return self.at


def read_archive(data: bytes) -> Iterator[tuple[int, int, Record | str]]:
    """``(offset, length, record or reason of a gap)``: all of a file of gzip members or plain records, damaged or not.

    Records of one member share its place.  An empty member holds nothing.
    """
    members, records = _Finder(data, re.compile(re.escape(MAGIC))), _Finder(data, VERSION)
    at, bad, reason = 0, None, ""
    while at < len(data):
        try:
            if data.startswith(MAGIC, at):
                content, length = read_member(data, at)
                found = [x for _, _, x in read_archive(content)]
                if found and not any(isinstance(x, Record) for x in found):
                    raise Damaged(found[0])
            else:
                record = parse_record(data, at)
                length, found = record.length, [record]
        except Damaged as error:
            if bad is None:
                bad, reason = at, str(error)
            at = min(members.after(at), records.after(at))
            continue
        if bad is not None:
            yield bad, at - bad, reason
            bad = None
        for x in found:
            yield at, length, x
        at += length
    if bad is not None:
        yield bad, len(data) - bad, reason


ENTRIES = ("file string, offset long, length long, gap string, page_id long, url string, record_type string, "
           "refers_to long, payload_bytes long, payload_digest string, payload binary")
ARROW = pa.schema([("file", pa.string()), ("offset", pa.int64()), ("length", pa.int64()), ("gap", pa.string()),
                   ("page_id", pa.int64()), ("url", pa.string()), ("record_type", pa.string()), ("refers_to", pa.int64()),
                   ("payload_bytes", pa.int64()), ("payload_digest", pa.string()), ("payload", pa.binary())])


def _page(headers: dict[str, str], name: str) -> int | None:
    value = headers.get(name, "").strip("<>").removeprefix(ID_PREFIX)
    return int(value) if re.fullmatch(r"-?\d+", value) else None


def _entry(file: str, offset: int, length: int, found: Record | str, payloads: bool) -> tuple:
    if isinstance(found, str):
        return file, offset, length, found, None, None, None, None, None, None, None
    headers, block, _ = found
    head, _, payload = block.partition(b"\r\n\r\n")
    kind = headers.get("warc-type")
    if kind == "revisit":  # the payload is elsewhere; its size and digest are in the headers
        size = re.search(rb"(?im)^content-length:\s*(\d+)", head)
        n, digest, payload = int(size[1]) if size else None, headers.get("warc-payload-digest", "").removeprefix("sha1:"), None
    else:
        n, digest = len(payload), base32_sha1(payload)
    return (file, offset, length, None, _page(headers, "warc-record-id"), headers.get("warc-target-uri"), kind,
            _page(headers, "warc-refers-to"), n, digest, payload if payloads else None)


def _read(payloads: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                file, data = batch.column(0)[i].as_py(), batch.column(1)[i].as_py()
                rows: list[tuple] = []
                for offset, length, found in read_archive(data):
                    rows.append(_entry(file, offset, length, found, payloads))
                    if len(rows) == 256:
                        yield _to_batch(rows)
                        rows = []
                if rows:
                    yield _to_batch(rows)
    return run


def _to_batch(rows: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), ARROW, strict=True)], schema=ARROW)


def salvage(spark: SparkSession, path: str, payloads: bool = False) -> DataFrame:
    """A row per record, and one per gap (``gap`` is then the reason), of all archives below ``path``."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path)
    return files.select("path", "content").mapInArrow(_read(payloads), ENTRIES)


def read_archives(spark: SparkSession, path: str, gap_log: str | None = None, payloads: bool = False) -> DataFrame:
    """The records below ``path``; gaps are always appended to the Parquet log at ``gap_log`` (``<path>-gaps``, if not named).

    The archives are read once: what is found is written below the shared folder, and records and gaps are taken from there.
    """
    out = scratch_path(spark, "records")
    salvage(spark, path, payloads).withColumn("is_gap", F.col("gap").isNotNull()).write.partitionBy("is_gap").parquet(out)
    found = spark.read.schema(f"{ENTRIES}, is_gap boolean").parquet(out)
    found.where("is_gap").select("file", "offset", "length", "gap").write.mode("append").parquet(gap_log or f"{path}-gaps")
    return found.where("NOT is_gap").drop("gap", "is_gap")


def gaps(spark: SparkSession, path: str) -> DataFrame:
    """The log of gaps that ``read_archives(spark, path)`` wrote."""
    return spark.read.schema("file string, offset long, length long, gap string").parquet(f"{path}-gaps")
