"""Line dedup: range-partitioned line hashes, streamed in order, give a keep bitmap per document.

A line's key is the line without ``[\\x20\\x09-\\x0D]`` at both ends and with A-Z lower-cased.
Keys of at least ``min_chars`` code points found in at least ``min_docs`` documents stay in
the largest ``doc_id`` that holds them and go everywhere else.

1. Each text becomes rows (128-bit key hash, doc_id, line positions), one per key.
2. They are range-partitioned by (hash, doc_id) and sorted within the partitions, doc_id
   descending.  The range includes doc_id, so one line that a third of all documents share is
   spread over many partitions.
3. Each partition is streamed.  The first document of a run of one hash is where the line
   stays.  A run that began in the partition is decided there as soon as ``min_docs``
   documents were seen.  Only the first run of a partition, and its last one if still short,
   can belong to a run of the neighbours: its rows are put off, and one summary row per such
   run (two per partition at most) says how many documents it has and the largest.
4. The summaries, added up, decide the rows put off.
5. Dropped positions are packed into a zlib-compressed bitmap per document text.

Defined results: a null or empty text is one empty line; rows of a null doc_id take no part
and are kept whole; rows that share a doc_id count as one document; other columns are left
as they are.
"""

from __future__ import annotations

import hashlib
import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import cut

MIN_CHARS = 40
MIN_DOCS = 5
STRIP = " \t\n\x0b\x0c\r"
LOWER = {c: c + 32 for c in range(65, 91)}

KEYS = "h1 long, h2 long, doc_id long, text_hash long, n_lines int, at array<int>"
RUNS = "kind int, h1 long, h2 long, n_docs long, doc_id long, text_hash long, n_lines int, at array<int>"
DROP, PUT_OFF, SUMMARY = 0, 1, 2


def _line_keys(min_chars: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list[list] = [[] for _ in range(6)]
            for doc_id, text, text_hash in zip(*[c.to_pylist() for c in batch.columns], strict=True):
                lines = (text or "").split("\n")
                places: dict[bytes, list[int]] = {}
                for i, line in enumerate(lines):
                    if len(line) >= min_chars and len(key := line.strip(STRIP)) >= min_chars:
                        digest = hashlib.blake2b(key.translate(LOWER).encode("utf-8", "surrogatepass"), digest_size=16).digest()
                        places.setdefault(digest, []).append(i)
                for digest, at in places.items():
                    for column, x in zip(out, (*struct.unpack("<qq", digest), doc_id, text_hash, len(lines), at), strict=True):
                        column.append(x)
                if len(out[0]) >= 50_000:
                    yield _batch(out, KEYS_ARROW)
                    out = [[] for _ in range(6)]
            if out[0]:
                yield _batch(out, KEYS_ARROW)
    return run


KEYS_ARROW = pa.schema([("h1", pa.int64()), ("h2", pa.int64()), ("doc_id", pa.int64()), ("text_hash", pa.int64()),
                        ("n_lines", pa.int32()), ("at", pa.list_(pa.int32()))])
RUNS_ARROW = pa.schema([("kind", pa.int32()), ("h1", pa.int64()), ("h2", pa.int64()), ("n_docs", pa.int64()),
                        *list(KEYS_ARROW)[2:]])


def _batch(columns: list[list], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema, strict=True)], schema=schema)


def _stream_runs(min_docs: int):
    """One pass over a sorted partition; holds the rows of fewer than ``min_docs`` documents of the current run."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out: list[tuple] = []
        key, first_run = None, True
        n_docs, first_doc, last_doc, waiting = 0, None, None, []

        for batch in batches:
            n = batch.num_rows
            if not n:
                continue
            h1, h2, docs, hashes, lines = (batch.column(i).to_numpy(zero_copy_only=False) for i in range(5))
            starts = np.flatnonzero(np.r_[True, (h1[1:] != h1[:-1]) | (h2[1:] != h2[:-1])])
            for s, e in zip(starts.tolist(), [*starts[1:].tolist(), n], strict=True):
                k = (int(h1[s]), int(h2[s]))
                if k != key:
                    if key is not None and first_run:
                        out.append((SUMMARY, *key, n_docs, first_doc, 0, 0, []))
                    first_run, key = key is None, k
                    n_docs, first_doc, last_doc, waiting = 0, None, None, []
                    if not first_run and e < n and e - s < min_docs:
                        continue  # the whole run, and too few rows: nothing to drop
                for i in range(s, e):
                    doc = int(docs[i])
                    if doc != last_doc:
                        n_docs, last_doc = n_docs + 1, doc
                        first_doc = doc if first_doc is None else first_doc
                    row = (*key, 0, doc, int(hashes[i]), int(lines[i]), batch.column(5)[i].as_py())
                    if first_run:
                        out.append((PUT_OFF, *row))
                    else:
                        waiting.append(row)
                        if n_docs >= min_docs:
                            out.extend((DROP, *r) for r in waiting if r[3] != first_doc)
                            waiting = []
                    if len(out) >= 20_000:
                        yield _batch(list(zip(*out, strict=True)), RUNS_ARROW)
                        out = []
        if key is not None:  # the last run may go on in the next partition
            out.extend((PUT_OFF, *r) for r in waiting)
            out.append((SUMMARY, *key, n_docs, first_doc, 0, 0, []))
        if out:
            yield _batch(list(zip(*out, strict=True)), RUNS_ARROW)
    return run


def pack_bitmap(n_lines: int, dropped: np.ndarray) -> bytes:
    keep = np.ones(n_lines, dtype=bool)
    keep[dropped] = False
    return zlib.compress(np.packbits(keep).tobytes())


def unpack_bitmap(bitmap: bytes, n_lines: int) -> np.ndarray:
    return np.unpackbits(np.frombuffer(zlib.decompress(bitmap), np.uint8), count=n_lines).astype(bool)


def keep_bitmaps(docs: DataFrame, min_chars: int = MIN_CHARS, min_docs: int = MIN_DOCS) -> DataFrame:
    """``doc_id, text_hash, n_lines, n_dropped, bitmap`` of the document texts that lose a line."""
    # written once: the range partitioner samples its input, which would read and hash all texts twice
    keyed = cut(docs.where(F.col("doc_id").isNotNull())
                .select(F.col("doc_id").cast("long").alias("doc_id"), "text", F.xxhash64("text").alias("text_hash"))
                .mapInArrow(_line_keys(min_chars), KEYS))
    parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ordered = keyed.repartitionByRange(parts, "h1", "h2", F.col("doc_id").desc()) \
        .sortWithinPartitions("h1", "h2", F.col("doc_id").desc())
    runs = cut(ordered.mapInArrow(_stream_runs(min_docs), RUNS))
    # at most two summaries per partition, whatever the data: a proven bound
    whole = runs.where(F.col("kind") == SUMMARY).groupBy("h1", "h2") \
        .agg(F.sum("n_docs").alias("total"), F.max("doc_id").alias("keeper"))
    put_off = runs.where(F.col("kind") == PUT_OFF).join(F.broadcast(whole), ["h1", "h2"]) \
        .where((F.col("total") >= min_docs) & (F.col("doc_id") != F.col("keeper")))
    rows = ["doc_id", "text_hash", "n_lines", "at"]
    drops = runs.where(F.col("kind") == DROP).select(*rows).unionAll(put_off.select(*rows))
    return drops.groupBy("doc_id", "text_hash").agg(
        F.max("n_lines").alias("n_lines"), F.array_distinct(F.flatten(F.collect_list("at"))).alias("at")) \
        .mapInArrow(_pack, "doc_id long, text_hash long, n_lines int, n_dropped int, bitmap binary")


def _pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        docs, hashes, lines, at = batch.columns
        packed = [pack_bitmap(n, np.asarray(a, dtype=np.int64))
                  for n, a in zip(lines.to_pylist(), at.to_pylist(), strict=True)]
        yield pa.RecordBatch.from_arrays(
            [docs, hashes, lines, pa.array([len(a) for a in at.to_pylist()], pa.int32()), pa.array(packed, pa.binary())],
            names=["doc_id", "text_hash", "n_lines", "n_dropped", "bitmap"])


def apply_bitmap(text: str | None, bitmap: bytes | None) -> str | None:
    """The kept lines of a text, joined by newlines; without a bitmap the text as it is."""
    if bitmap is None:
        return text
    lines = (text or "").split("\n")
    keep = unpack_bitmap(bitmap, len(lines))
    return "\n".join(x for x, k in zip(lines, keep, strict=True) if k)


@F.pandas_udf(T.StringType())
def _kept(text: pd.Series, bitmap: pd.Series) -> pd.Series:
    return pd.Series([apply_bitmap(t, b) for t, b in zip(text, bitmap, strict=True)], dtype=object)


def with_kept_text(docs: DataFrame, bitmaps: DataFrame) -> DataFrame:
    """``row`` (all columns of ``docs``), ``kept`` (the text after dropping) and ``n_dropped``."""
    rows = docs.select(F.struct(*docs.columns).alias("row"))
    met = rows.join(bitmaps, (F.col("row.doc_id") == F.col("doc_id")) & (F.xxhash64("row.text") == F.col("text_hash")), "left")
    kept = F.when(F.col("bitmap").isNull(), F.col("row.text")).otherwise(_kept("row.text", "bitmap"))
    return met.select("row", kept.alias("kept"), F.coalesce("n_dropped", F.lit(0)).alias("n_dropped"))


def dedup_lines(docs: DataFrame) -> DataFrame:
    """``docs`` with the repeated lines gone from ``text`` (and ``n_chars``, if there, counted again)."""
    done = with_kept_text(docs, keep_bitmaps(docs))
    changed = F.col("n_dropped") > 0
    columns = {"text": F.when(changed, F.col("kept")).otherwise(F.col("row.text"))}
    if "n_chars" in docs.columns:
        kind = docs.schema["n_chars"].dataType
        columns["n_chars"] = F.when(changed, F.length("kept").cast(kind)).otherwise(F.col("row.n_chars"))
    return done.select(*[columns.get(c, F.col("row")[c]).alias(c) for c in docs.columns])
