"""N-gram Jaccard join: size-aware, with subsets for small sets and inverted lists for large ones.

Documents become sets of ``k``-word shingles.  Two link when their Jaccard similarity is at
least ``num / den``; components of the links are returned.

Small sets (fewer than a boundary ``x`` shingles) list their subsets of the sizes that a
partner can share: two small sets that link share one of them.  Beyond, the number of
subsets explodes, and sets meet in inverted lists of single shingles.  Two sets that share ``o``
shingles have one in common among the ``n - o + 1`` first of each, in any order of all shingles; the
order here is by rarity, so the lists that are scanned are short and a passage that thousands of documents
share stands last.  Sets of at least num/den of the boundary are in the lists too, since large ones look for
them there.  The boundary is the one with the lowest cost, weighted rows written, summed over the sizes of all sets
(``choose_boundary``).

Rarity comes from one pass that counts all shingles in ``2 ** RARITY_BITS`` counters (a byte each, on a
logarithmic scale, so a broadcast of one fixed size).  It only orders shingles: what shares a counter costs longer lists, never a link.

Lists are compared by stars and cells (``links``): no list gives all its pairs.  Before two texts are compared, a sketch has to
allow the link: shingle counts in hash buckets, whose sum of minima bounds the intersection from above.  Equal sets count as one.

Defined results: null, empty and word-free texts have an empty set, link with nothing and
are their own component; a null doc_id has a null component; rows that share a doc_id are
one node, linked by either text; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations
from math import comb

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import links
from .common import Tables, arrow_batches
from .shingles import mix, shingle_sets

MOST_SUBSET_SIZE = 64       # boundaries beyond this are hopeless: a set of 64 has millions of subsets
LIST_WEIGHT = 4             # a list entry against a subset: other sets meet in it too, and have to be compared
RARITY_BITS = 20
BATCH_ROWS = 2000           # texts that a Python worker gets at a time
SLICES = 64                 # in which the counters travel


class Rule:
    """Links sets A, B where den * |A & B| >= num * |A | B|."""

    def __init__(self, k: int, num: int, den: int):
        if not 0 < num <= den:
            raise ValueError("0 < num <= den")
        self.k, self.num, self.den = k, num, den

    def least_overlap(self, n: int, m: int) -> int:
        return -(-self.num * (n + m) // (self.num + self.den))

    def partners(self, n: int) -> range:
        """Sizes that a set of ``n`` can link with."""
        return range(-(-self.num * n // self.den), self.den * n // self.num + 1)

    def subset_sizes(self, n: int) -> list[int]:
        return sorted({self.least_overlap(n, m) for m in self.partners(n) if self.least_overlap(n, m) <= min(n, m)})

    def subset_rows(self, n: int) -> int:
        return sum(comb(n, s) for s in self.subset_sizes(n))

    def prefix(self, n: int) -> int:
        """How many of its rarest shingles a set of ``n`` lists: all but one fewer than it shares with any partner."""
        return n - self.least_overlap(n, self.partners(n)[0]) + 1


def choose_boundary(rule: Rule, histogram: dict[int, int]) -> int:
    """Sets below it list subsets; the boundary with the fewest rows.

    Sets of at least num/den of the boundary are in the lists too, since large
    ones look for them there.
    """
    def cost(x: int) -> int:
        low = -(-rule.num * x // rule.den)
        return sum(count * ((rule.subset_rows(n) if n < x else 0) + (LIST_WEIGHT * rule.prefix(n) if n >= low else 0))
                   for n, count in histogram.items())

    # what lies beyond the largest boundary costs the same for all
    return min(range(1, MOST_SUBSET_SIZE + 1), key=cost)


# --------------------------------------------------------------------------
# rarity
# --------------------------------------------------------------------------

U = np.uint64


def _counter(s: np.ndarray) -> np.ndarray:
    return (mix(s ^ U(0x9D8A7C6B5E4F3021)) >> U(64 - RARITY_BITS)).astype(np.int64)


def _to_byte(counts: np.ndarray) -> np.ndarray:
    return np.minimum(np.rint(6 * np.log2(1 + counts)), 255).astype(np.uint8)


def _from_byte(codes: np.ndarray) -> np.ndarray:
    return np.exp2(codes / 6.0) - 1


def _count(k: int):
    """Per task the counters of its shingles in slices, and (slice -1) its sets by size, those of up to twice the largest boundary."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts, sizes = np.zeros(1 << RARITY_BITS), np.zeros(2 * MOST_SUBSET_SIZE + 1, np.int64)
        for batch in batches:
            held, some = [], 0
            for s in shingle_sets(batch.column(0), k):
                held.append(s)
                some += len(s)
                if len(s) < len(sizes):
                    sizes[len(s)] += 1
                if some > 1 << 18:
                    counts += np.bincount(_counter(np.concatenate(held)), minlength=len(counts))
                    held, some = [], 0
            if held:
                counts += np.bincount(_counter(np.concatenate(held)), minlength=len(counts))
        parts = [(i, p.tobytes()) for i, p in enumerate(np.split(_to_byte(counts), SLICES)) if p.any()]
        if sizes.any():
            parts.append((-1, sizes.tobytes()))
        if parts:
            yield pa.RecordBatch.from_arrays([pa.array([i for i, _ in parts], pa.int32()), pa.array([b for _, b in parts], pa.binary())],
                                             names=["slice", "counts"])
    return run


def _add_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by slice to one row per slice."""
    at, total = None, None

    def row() -> pa.RecordBatch:
        out = total if at < 0 else _to_byte(total)
        return pa.RecordBatch.from_arrays([pa.array([at], pa.int32()), pa.array([out.tobytes()], pa.binary())], names=["slice", "counts"])

    for batch in batches:
        for i, data in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            if i != at:
                if at is not None:
                    yield row()
                at, total = i, 0
            total = total + (np.frombuffer(data, np.int64) if i < 0 else _from_byte(np.frombuffer(data, np.uint8)))
    if at is not None:
        yield row()


def survey(texts: DataFrame, k: int) -> tuple[np.ndarray, dict[int, int]]:
    """Rarity of each counter's shingles (bytes), and how many sets have each (small) size."""
    parts = int(texts.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    schema = "slice int, counts binary"
    rows = texts.select("text").mapInArrow(_count(k), schema).repartition(parts, "slice").sortWithinPartitions("slice") \
        .mapInArrow(_add_up, schema).collect()      # SLICES + 1 rows, 1 MB
    rarity, sizes = np.zeros(1 << RARITY_BITS, np.uint8), np.zeros(0, np.int64)
    width = len(rarity) // SLICES
    for r in rows:
        if r["slice"] < 0:
            sizes = np.frombuffer(bytes(r["counts"]), np.int64)
        else:
            rarity[r["slice"] * width:(r["slice"] + 1) * width] = np.frombuffer(bytes(r["counts"]), np.uint8)
    return rarity, {n: int(c) for n, c in enumerate(sizes.tolist()) if n and c}


# --------------------------------------------------------------------------
# entries
# --------------------------------------------------------------------------

def _subset_entries(rule: Rule, s: np.ndarray) -> np.ndarray:
    """Keys of all subsets of the sizes that count; a subset's hash is the sum of its shingles'."""
    n, values = len(s), mix(s + U(0x5851F42D4C957F2D))
    total = values.sum(dtype=np.uint64)
    out = []
    for size in rule.subset_sizes(n):
        gone = n - size
        if gone == 0:
            sums = np.array([total])
        elif gone == 1:
            sums = total - values
        else:
            sums = total - values[np.array(list(combinations(range(n), gone)))].sum(axis=1, dtype=np.uint64)
        out.append(mix(sums ^ U(size * 2 + 1)))
    return np.concatenate(out) if out else np.zeros(0, np.uint64)


def _list_entries(rule: Rule, s: np.ndarray, rarity: np.ndarray) -> np.ndarray:
    """Keys of the inverted lists of the set's rarest shingles; equally rare ones are ordered by hash."""
    order = np.lexsort((s, rarity[_counter(s)]))
    return mix(s[order[:rule.prefix(len(s))]] ^ U(0x3C79AC492BA7B653))


def entries(rule: Rule, s: np.ndarray, boundary: int, rarity: np.ndarray) -> np.ndarray:
    n, parts = len(s), [np.zeros(0, U)]
    if 0 < n < boundary:
        parts.append(_subset_entries(rule, s))
    if n and n >= -(-rule.num * boundary // rule.den):
        parts.append(_list_entries(rule, s, rarity))
    return np.concatenate(parts)


def may_link(rule: Rule):
    return links.counts_allow(rule.num, rule.den)


# --------------------------------------------------------------------------
# join
# --------------------------------------------------------------------------

SETS = "id long, n_shingles long, h1 long, h2 long, sketch binary, entries binary"


def _sets(rule: Rule, boundary: int, rarity):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, n, h1, h2, sketches, keys = batch.column(0), [], [], [], [], []
            for s in shingle_sets(batch.column(1), rule.k):
                n.append(len(s))
                h1.append(int(mix(s).sum(dtype=np.uint64).astype(np.int64)))
                h2.append(int(mix(s ^ U(0xA0761D6478BD642F)).sum(dtype=np.uint64).astype(np.int64)))
                sketches.append(links.pack(links.counts(s).tobytes()))
                keys.append(entries(rule, s, boundary, rarity.value).tobytes())
            yield pa.RecordBatch.from_arrays(
                [ids, pa.array(n, pa.int64()), pa.array(h1, pa.int64()), pa.array(h2, pa.int64()), pa.array(sketches, pa.binary()),
                 pa.array(keys, pa.binary())], names=["id", "n_shingles", "h1", "h2", "sketch", "entries"])
    return run


def _lists(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for at in range(0, batch.num_rows, 1024):
            part = batch.slice(at, 1024)
            keys = [np.frombuffer(k, np.int64) for k in part.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(keys)), pa.array(np.repeat(part.column(0).to_numpy(), [len(k) for k in keys]))],
                                             names=["key", "id"])


def components(docs: DataFrame, k: int = 3, num: int = 90, den: int = 100) -> DataFrame:
    """``doc_id, n_shingles, component_id`` of every row of ``docs(doc_id, text)``."""
    with arrow_batches(docs.sparkSession, BATCH_ROWS):
        return _components(docs, k, num, den)


def _components(docs: DataFrame, k: int, num: int, den: int) -> DataFrame:
    rule = Rule(k, num, den)
    texts = docs.select(F.col("doc_id").cast("long").alias("id"), "text")
    rarity, histogram = survey(texts, k)
    boundary = choose_boundary(rule, histogram)
    shared = docs.sparkSession.sparkContext.broadcast(rarity)      # 1 MB, whatever the corpus
    tables = Tables(docs.sparkSession)
    sets = tables.write(texts.mapInArrow(_sets(rule, boundary, shared), SETS))
    chosen, equal = links.representatives(sets.where("id IS NOT NULL AND n_shingles > 0"), tables)
    lists = chosen.select("id", "entries").mapInArrow(_lists, "key long, id long")
    groups = links.components(lists, chosen.drop("entries"), equal, texts.where("id IS NOT NULL AND text IS NOT NULL"),
                              k, num, den, may_link(rule))
    tables.drop(chosen, equal)
    return sets.select("id", "n_shingles").join(groups, sets["id"] == groups["node"], "left").select(
        F.col("id").alias("doc_id"), "n_shingles", F.coalesce("component", "id").alias("component_id"))


def one_per_group(docs: DataFrame, k: int = 5, num: int = 80, den: int = 100) -> DataFrame:
    """The rows of ``docs`` that stand for their group: those of the smallest doc_id; rows of a null doc_id stay."""
    gone = components(docs, k, num, den).where("doc_id != component_id").select("doc_id").distinct()
    return docs.join(gone, "doc_id", "left_anti").select(*docs.columns)
