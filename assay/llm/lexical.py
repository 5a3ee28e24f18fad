"""Ranked lexical search, reversed: the documents stream through an index of the items.

Items are few and documents many, so the items' terms are what is indexed and broadcast: the
terms' hashes in order, and for each the items that hold it.  A first pass over the documents
counts documents, terms, and the documents that hold each indexed term.  In the second pass a
task takes blocks of documents, looks their term counts up in the index, adds each
contribution to the scores of the term's items, and keeps the ``k`` best documents of each item in a
heap that never grows.  The tasks' heaps are merged in two rounds.

The index is built in packs of items, each of at most ``INDEX_BYTES`` (items are dealt over the
packs by their id; the number of packs comes from a count of the distinct terms of all items, so a broadcast
is bounded whatever the number of items).

Terms are compared by 64-bit hashes of their bytes and lengths.

Defined results: null and term-free documents count nowhere and are never returned; rows that share a
doc_id are documents of their own; a null doc_id ranks behind others of its score; rows that share an
item_id are one item with the terms of all; items without terms, or with no document above 0, have no rows; other
columns are ignored; empty tables give no rows.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .shingles import SLICE_BYTES, word_hashes

INDEX_BYTES = 32 << 20      # of a broadcast index
CELLS = 1 << 21             # scores (documents x items) held at a time

# ASCII letters and digits, and all bytes of longer code points
TERM_BYTES = np.zeros(256, bool)
TERM_BYTES[0x30:0x3A] = TERM_BYTES[0x41:0x5B] = TERM_BYTES[0x61:0x7B] = True
TERM_BYTES[0x80:] = True


def term_slices(texts: pa.Array) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(first row, terms' hashes, terms of each row) of runs of rows of about ``SLICE_BYTES``."""
    texts = texts.cast(pa.large_string())
    if not len(texts):
        return
    offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset:texts.offset + len(texts) + 1]
    data = np.frombuffer(texts.buffers()[2] or b"", np.uint8)
    start = 0
    while start < len(texts):
        stop = max(start + 1, int(np.searchsorted(offsets, offsets[start] + SLICE_BYTES, "right")) - 1)
        stop = min(stop, len(texts))
        base = offsets[start]
        at = offsets[start:stop + 1] - base
        hashes, places = word_hashes(data[base:offsets[stop]], at[:-1], TERM_BYTES)
        yield start, hashes, np.diff(np.searchsorted(places, at))
        start = stop


def _item_terms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for start, hashes, counts in term_slices(batch.column(1)):
            rows = start + np.repeat(np.arange(len(counts)), counts)
            yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(rows)), pa.array(hashes.view(np.int64))],
                                             names=["item_id", "term"])


@dataclass
class Index:
    """Of one pack of items: ``terms`` ascending, the items of term i at ``items[starts[i]:starts[i + 1]]``."""

    item_ids: list
    terms: np.ndarray
    starts: np.ndarray
    items: np.ndarray

    @staticmethod
    def build(rows: list) -> Index:
        """From distinct (item_id, term) rows."""
        ids = sorted({r[0] for r in rows}, key=lambda i: (i is None, i))
        place = {i: n for n, i in enumerate(ids)}
        item = np.array([place[r[0]] for r in rows], np.int64)
        term = np.array([r[1] for r in rows], np.int64).view(np.uint64)
        order = np.lexsort((item, term))
        item, term = item[order], term[order]
        first = np.flatnonzero(np.r_[True, term[1:] != term[:-1]])
        return Index(ids, term[first], np.r_[first, len(term)], item.astype(np.int32))

    def look_up(self, hashes: np.ndarray, doc: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Distinct (document, term) of the indexed terms, by document, with the occurrences."""
        at = np.searchsorted(self.terms, hashes)
        at[at == len(self.terms)] = 0
        known = self.terms[at] == hashes
        key, tf = np.unique(doc[known] * len(self.terms) + at[known], return_counts=True)
        return key // len(self.terms), key % len(self.terms), tf


def _statistics(index):
    """Rows (term, n): documents that hold each term; -1: documents with terms; -2: all terms."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ix = index.value
        df, docs, total = np.zeros(len(ix.terms), np.int64), 0, 0
        for batch in batches:
            for _, hashes, counts in term_slices(batch.column(0)):
                _, term, _ = ix.look_up(hashes, np.repeat(np.arange(len(counts)), counts))
                df += np.bincount(term, minlength=len(df))
                docs, total = docs + int((counts > 0).sum()), total + len(hashes)
        yield pa.RecordBatch.from_arrays([pa.array(np.r_[-1, -2, np.arange(len(df))]), pa.array(np.r_[docs, total, df])],
                                         names=["term", "n"])
    return run


def lengths_part(n: np.ndarray, docs: int, total: int) -> np.ndarray:
    """10 + (90 * n * docs) div total, in 64 bits or beyond."""
    if 90 * int(n.max(initial=0)) * docs < 2 ** 63:
        return 10 + 90 * n * docs // total
    return np.array([10 + 90 * int(x) * docs // total for x in n], np.int64)


class Heaps:
    """The ``k`` best (score, doc_id) of each item; equal scores by ascending doc_id, null last."""

    def __init__(self, items: int, k: int):
        self.k, self.items = k, items
        self.least = np.ones(items, np.int64)       # what a document needs to get in
        self.item = self.id = self.score = np.zeros(0, np.int64)
        self.null = np.zeros(0, bool)

    def update(self, scores: np.ndarray, ids: np.ndarray, null: np.ndarray) -> None:
        """``scores``: documents x items."""
        need = self.least
        if len(scores) > self.k:
            need = np.maximum(need, np.partition(scores, len(scores) - self.k, axis=0)[len(scores) - self.k])
        doc, item = np.nonzero(scores >= need)
        if not len(doc):
            return
        item, score = np.r_[self.item, item], np.r_[self.score, scores[doc, item]]
        doc_id, no_id = np.r_[self.id, ids[doc]], np.r_[self.null, null[doc]]
        order = np.lexsort((doc_id, no_id, -score, item))
        first = np.searchsorted(item[order], np.arange(self.items))
        sizes = np.diff(np.r_[first, len(order)])
        order = order[np.arange(len(order)) - np.repeat(first, sizes) < self.k]
        self.item, self.score, self.id, self.null = item[order], score[order], doc_id[order], no_id[order]
        full = np.flatnonzero(np.bincount(self.item, minlength=self.items) == self.k)
        self.least[full] = self.score[np.searchsorted(self.item, full, "right") - 1]


def _best(index, weights: np.ndarray, docs: int, total: int, k: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ix = index.value
        items = len(ix.item_ids)
        heaps, step = Heaps(items, k), max(k + 1, CELLS // items)
        most = np.zeros(items)
        np.add.at(most, ix.items, np.repeat(weights, np.diff(ix.starts)))
        in_float = most.max(initial=0) * 1e6 < 2 ** 53      # a contribution is below 1e6 times the weight
        for batch in batches:
            ids, null = batch.column(0).fill_null(0).to_numpy(), batch.column(0).is_null().to_numpy(zero_copy_only=False)
            for start, hashes, counts in term_slices(batch.column(1)):
                m = lengths_part(counts, docs, total)
                doc, term, tf = ix.look_up(hashes, np.repeat(np.arange(len(counts)), counts))
                gain = weights[term] * (1_000_000_000 * tf // (1000 * tf + 8 * m[doc]))
                for low in range(0, len(counts), step):
                    rows = min(step, len(counts) - low)
                    a, b = np.searchsorted(doc, (low, low + rows))
                    held = np.diff(ix.starts)[term[a:b]]
                    begin = np.cumsum(held) - held
                    item = ix.items[np.repeat(ix.starts[term[a:b]] - begin, held) + np.arange(int(held.sum()))]
                    cell = np.repeat((doc[a:b] - low) * items, held) + item
                    gains = np.repeat(gain[a:b], held)
                    if in_float:
                        scores = np.bincount(cell, gains, rows * items).astype(np.int64)
                    else:
                        scores = np.zeros(rows * items, np.int64)
                        np.add.at(scores, cell, gains)
                    at = slice(start + low, start + low + rows)
                    heaps.update(scores.reshape(rows, items), ids[at], null[at])
        part = np.full(len(heaps.item), TaskContext.get().partitionId())
        yield pa.RecordBatch.from_arrays([pa.array(heaps.item), pa.array(heaps.id, mask=heaps.null), pa.array(heaps.score), pa.array(part)],
                                         names=["item", "doc_id", "score", "part"])
    return run


def _search_pack(texts: DataFrame, rows: list, k: int) -> DataFrame:
    spark = texts.sparkSession
    index = spark.sparkContext.broadcast(Index.build(rows))
    ix = index.value
    counted = {r["term"]: r["n"] for r in texts.select("text").mapInArrow(_statistics(index), "term long, n long")
               .groupBy("term").agg(F.sum("n").alias("n")).collect()}      # one per indexed term
    docs, total = counted.get(-1, 0), counted.get(-2, 0)
    weights = np.array([math.floor(1000 * math.log((2 * docs + 2) / (2 * counted.get(t, 0) + 1))) for t in range(len(ix.terms))], np.int64)
    heaps = texts.mapInArrow(_best(index, weights, docs, max(total, 1), k), "item long, doc_id long, score long, part long")
    ids = spark.createDataFrame(list(enumerate(ix.item_ids)), "item long, item_id long")
    return heaps.join(ids, "item").select("item_id", "doc_id", "score", "part")


def search(docs: DataFrame, items: DataFrame, k: int = 10) -> DataFrame:
    """``item_id, rank, doc_id, score``: the ``k`` best documents (doc_id, text) of each item (item_id, text)."""
    terms = items.select(F.col("item_id").cast("long").alias("item_id"), "text").where("text IS NOT NULL") \
        .mapInArrow(_item_terms, "item_id long, term long").distinct()
    packs = max(1, -(-terms.count() * 24 // INDEX_BYTES))
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").where("text IS NOT NULL")
    found = None
    for p in range(packs):
        rows = terms.where(F.pmod(F.xxhash64("item_id"), F.lit(packs)) == p).collect()      # below INDEX_BYTES
        if rows:
            part = _search_pack(texts, rows, k)
            found = part if found is None else found.unionByName(part)
    if found is None:
        return items.where("false").select(*[F.lit(0).cast(t).alias(c) for c, t in (
            ("item_id", "long"), ("rank", "int"), ("doc_id", "long"), ("score", "long"))])
    order = [F.col("score").desc(), F.col("doc_id").asc_nulls_last()]
    spread = math.isqrt(int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))) + 1   # an item's heaps meet in so many groups first
    some = Window.partitionBy("item_id", "salt").orderBy(*order)
    merged = found.withColumn("salt", F.pmod("part", F.lit(spread))).withColumn("r", F.row_number().over(some)).where(F.col("r") <= k)
    every = Window.partitionBy("item_id").orderBy(*order)
    return merged.withColumn("rank", F.row_number().over(every)).where(F.col("rank") <= k).select("item_id", "rank", "doc_id", "score")
