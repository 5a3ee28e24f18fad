"""Exact top-k inner products by block-at-a-time pruning.

Vectors are turned into integers, floor(256 * x), and packed in order of ``vec_id`` into
blocks of ``BLOCK`` rows.  A block carries its forward index (ids and components) and, for
each dimension ("term"), the greatest and least component.  For a query, the sum over the
dimensions of component times greatest (or least, where the query's component is negative)
is a bound on every score in the block.  Each query takes the blocks of a pack in order of
falling bounds and scores whole blocks until the next bound is below its k-th best score; ties
go to the smaller ``vec_id``, so an equal bound is still scored.

Queries and blocks meet in cells of a grid (query pack x column of vectors), dealt by Spark.  A cell
gets its queries first, then its vectors pack by pack, and keeps k rows per query, so that the k-th
best score holds for all later packs; a window over the queries takes the best k of the cells' rows.
A cell holds ``CELL_BYTES`` of queries and as many of vectors at most, whatever the input; a vector is
shipped once per query pack, a query once per column.

Defined results: vectors that are null, or hold null or non-finite components, or whose id
is null take no part; shorter vectors count as padded with zeros; a query has all rows but
those of its own id as candidates (all, if fewer than k); repeated rows are repeated
candidates; no vectors, no rows.  Scores must fit into a long; beyond 2^53 they are computed
in exact integers, slower.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

BLOCK = 64              # rows of a block
PACK_BLOCKS = 32        # blocks of a pack, at most
PACK_BYTES = 1 << 18    # of a pack of two-byte components, about
CELL_ROWS = 2048        # vectors of a cell, at least about
CELL_BYTES = 1 << 23    # queries of a cell, and vectors, at most about
MOST_TASKS = 10_000     # that score, unless Spark is told to shuffle to more partitions

PACKS = "turn long, ids binary, vecs binary, dims int"


def quantize(vectors: DataFrame) -> DataFrame:
    """``vec_id, q`` (array<double>) of the rows that take part; ``_matrix`` makes whole numbers of them."""
    x = F.col("embedding")
    fine = F.col("vec_id").isNotNull() & x.isNotNull() & F.forall(
        x, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c.cast("double")) < float("inf")))
    return vectors.where(F.coalesce(fine, F.lit(False))).select(
        F.col("vec_id").cast("long").alias("vec_id"), F.transform(x, lambda c: c.cast("double")).alias("q"))


def _matrix(q: pa.Array) -> np.ndarray:
    """Rows of whole numbers, padded with zeros to one width; float64 holds them exactly below 2^53."""
    flat = q.flatten().to_numpy(zero_copy_only=False)
    sizes = np.diff(q.offsets.to_numpy())
    if len(sizes) and (sizes == sizes[0]).all():
        rows = flat.reshape(len(sizes), int(sizes[0]))
    else:
        rows = np.zeros((len(sizes), int(sizes.max(initial=0))))
        rows[np.arange(rows.shape[1]) < sizes[:, None]] = flat
    return np.floor(rows * 256.0)


def _narrow(rows: np.ndarray) -> np.ndarray:
    """The same whole numbers in two or four bytes each, if they fit."""
    top = np.abs(rows).max(initial=0)
    return rows.astype(np.int16 if top < 2 ** 15 else np.int32) if top < 2 ** 31 else rows


def _wide(vecs: pa.Buffer, n: int, dims: int) -> np.ndarray:
    """The matrix that ``_narrow`` made."""
    kind = {2: np.int16, 4: np.int32}.get(vecs.size // max(1, n * dims), np.float64)
    return np.frombuffer(vecs, kind).reshape(n, dims)


def _pack_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted rows (vec_id, q) to packs of BLOCK * PACK_BLOCKS rows, of fewer blocks if vectors are long."""
    from pyspark import TaskContext

    part, n = TaskContext.get().partitionId(), 0
    held: list[pa.RecordBatch] = []

    def packs(final: bool):
        nonlocal held, n
        whole = pa.Table.from_batches(held).combine_chunks() if held else None
        if whole is None:
            return
        at = 0
        while whole.num_rows - at >= (1 if final else BLOCK * PACK_BLOCKS):
            some = whole.slice(at, BLOCK * PACK_BLOCKS).combine_chunks()
            q = some.column(1).combine_chunks() if some.column(1).num_chunks != 1 else some.column(1).chunk(0)
            longest = int(np.diff(q.offsets.to_numpy()).max(initial=1))
            size = BLOCK * min(PACK_BLOCKS, max(1, PACK_BYTES // (BLOCK * 2 * max(1, longest))))
            rows = _narrow(_matrix(q[:size]))
            yield pa.RecordBatch.from_arrays([
                pa.array([part + n], pa.int64()), pa.array([some.column(0)[:size].to_numpy().tobytes()], pa.binary()),
                pa.array([rows.tobytes()], pa.binary()), pa.array([rows.shape[1]], pa.int32())],
                names=["turn", "ids", "vecs", "dims"])
            at, n = at + len(rows), n + 1
        held = whole.slice(at).to_batches()

    for batch in batches:
        held.append(batch)
        if sum(b.num_rows for b in held) >= BLOCK * PACK_BLOCKS:
            yield from packs(False)
    yield from packs(True)


def _score(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Inner products of whole numbers, exact in the type of ``a`` and ``b``."""
    return a.dot(b.T)


def _ints(a: np.ndarray) -> np.ndarray:
    return np.array([[int(x) for x in r] for r in a], dtype=object).reshape(a.shape)


class _Best:
    """The k best candidates so far of each of the queries of a cell."""

    def __init__(self, q_ids: np.ndarray, q: np.ndarray, k: int):
        self.q_ids, self.k, self.given = q_ids, k, q
        self.top, self.casts = float(np.abs(q).max(initial=0)), {}
        self.none = np.iinfo(np.int64).min + 1   # can be negated
        self.score = np.full((len(q), k), self.none, dtype=np.int64)
        self.ids = np.full((len(q), k), np.iinfo(np.int64).max, dtype=np.int64)

    def _queries(self, kind: type, width: int) -> tuple[np.ndarray, ...]:
        """Queries as ``kind``, cut to ``width``, and their positive and negative parts for the bounds."""
        if (kind, width) not in self.casts:
            q = self.given[:, :width]
            sums = q.astype(np.float32 if kind is np.float32 else np.float64)
            self.casts = {(kind, width): (_ints(q) if kind is object else sums, np.maximum(sums, 0), np.minimum(sums, 0))}
        return self.casts[kind, width]

    def add(self, ids: np.ndarray, vecs: np.ndarray) -> None:
        """Takes in a pack, by block bounds."""
        width = min(self.given.shape[1], vecs.shape[1])   # beyond it one factor is zero
        top = self.top * float(np.abs(vecs).max(initial=0)) * max(width, 1)
        kind = np.float32 if top < 2 ** 24 else np.float64 if top < 2 ** 53 else object   # sums of whole numbers are exact
        if kind is object and self.score.dtype != object:
            self.score = self.score.astype(object)   # what stays below the k-th need not fit into a long
        q, over, under = self._queries(kind, width)
        vecs = vecs[:, :width]
        sums = vecs.astype(over.dtype)
        vecs = _ints(vecs) if kind is object else sums
        edges = np.arange(0, len(ids), BLOCK)
        bounds = over @ np.maximum.reduceat(sums, edges, axis=0).T + under @ np.minimum.reduceat(sums, edges, axis=0).T
        if kind is object:   # one part in 2^40 covers rounding in the sums of the bounds
            bounds += np.abs(bounds) * 2.0 ** -40
        turn = np.argsort(np.argsort(-bounds, axis=1), axis=1)
        start = 0
        while start < len(edges):   # the next one, one, two, four ... blocks of each query
            end = max(1, 2 * start)
            going = bounds >= self.score[:, -1:].astype(bounds.dtype)   # falling bounds: a query that stops is done
            if not (going & (turn >= start)).any():
                break
            going &= (turn >= start) & (turn < end)
            found = [self._candidates(np.flatnonzero(going[:, b]), q, ids[b * BLOCK:(b + 1) * BLOCK], vecs[b * BLOCK:(b + 1) * BLOCK])
                     for b in np.flatnonzero(going.any(axis=0))]
            if found:
                self._merge(*(np.concatenate(x) for x in zip(*found, strict=True)))
            start = end

    def _candidates(self, rows: np.ndarray, q: np.ndarray, ids: np.ndarray, vecs: np.ndarray) -> tuple[np.ndarray, ...]:
        """(query's row, vec_id, score) of a block's rows that may come in."""
        scores = _score(q if len(rows) == len(q) else q[rows], vecs)
        last = self.score[rows, -1]
        least = last.astype(scores.dtype)
        fresh = np.flatnonzero(last == self.none)
        if len(fresh) and len(ids) > self.k:   # fewer than k so far: the block's own k-th best, without rows of the query's id
            others = np.where(self.q_ids[rows[fresh]][:, None] == ids, least[fresh][:, None], scores[fresh])
            least[fresh] = np.maximum(least[fresh], np.partition(others, -self.k, axis=1)[:, -self.k])
        at, col = np.divmod(np.flatnonzero(scores >= least[:, None]), max(1, len(ids)))
        score = scores[at, col].astype(scores.dtype if scores.dtype == object else np.int64)
        row, ids = rows[at], ids[col]
        fine = (ids != self.q_ids[row]) & ((score > last[at]) | (ids < self.ids[row, -1]))
        return row[fine], ids[fine], score[fine]

    def _merge(self, row: np.ndarray, ids: np.ndarray, score: np.ndarray) -> None:
        hit = np.unique(row)
        row = np.concatenate([np.repeat(hit, self.k), row])
        ids = np.concatenate([self.ids[hit].ravel(), ids])
        score = np.concatenate([self.score[hit].ravel(), score])
        if score.dtype == object:
            by = np.array(sorted(range(len(row)), key=lambda j: (row[j], -int(score[j]), ids[j])), dtype=np.int64)
        else:
            by = np.lexsort((ids, -score, row))
        row, ids, score = row[by], ids[by], score[by]
        rank = np.arange(len(row)) - np.searchsorted(row, row)
        keep = rank < self.k
        self.ids[row[keep], rank[keep]] = ids[keep]
        self.score[row[keep], rank[keep]] = score[keep]

    def rows(self) -> list[np.ndarray]:
        """(query_id, vec_id, score) arrays."""
        where = np.nonzero(self.score != self.none)
        return [self.q_ids[where[0]], self.ids[where], self.score[where].astype(np.int64)]


def best_of_pack(q_ids: np.ndarray, q: np.ndarray, ids: np.ndarray, vecs: np.ndarray, k: int) -> list[np.ndarray]:
    """(query_id, vec_id, score) arrays: each query's k best of a pack, by block bounds."""
    best = _Best(q_ids, q, k)
    best.add(ids, vecs)
    return best.rows()


def _queries_of(packs: list[tuple[np.ndarray, np.ndarray]], k: int) -> _Best:
    width = max(m.shape[1] for _, m in packs)
    return _Best(np.concatenate([i for i, _ in packs]), np.concatenate([np.pad(m, ((0, 0), (0, width - m.shape[1]))) for _, m in packs]), k)


def _search(k: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Packs sorted by cell, queries first, to each cell's best rows."""
        cell, asked, best = None, [], None

        def done():
            if best is not None:
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in best.rows()],
                                                 names=["query_id", "vec_id", "score"])

        for batch in batches:
            for at, kind, ids, vecs, dims in zip(*(batch.column(c) for c in ("cell", "kind", "ids", "vecs", "dims")), strict=True):
                if at.as_py() != cell:
                    yield from done()
                    cell, asked, best = at.as_py(), [], None
                ids = np.frombuffer(ids.as_buffer(), np.int64)
                vecs = _wide(vecs.as_buffer(), len(ids), dims.as_py())
                if kind.as_py() == 0:
                    asked.append((ids, vecs))
                    continue
                if asked:
                    best, asked = _queries_of(asked, k), []
                if best is not None:
                    best.add(ids, vecs)
        yield from done()
    return run


def _grid(n_ask: int, n_vecs: int, dims: int, parts: int) -> tuple[int, int]:
    """Query packs and columns: cells within ``CELL_BYTES``; about ``parts`` of them, as long as a cell has more vectors than queries."""
    room = max(BLOCK, CELL_BYTES // (2 * dims + 8))
    q_packs = max(1, -(-n_ask // room))
    least = max(CELL_ROWS, -(-n_ask // q_packs))
    return q_packs, max(1, -(-n_vecs // room), min(-(-parts // q_packs), -(-n_vecs // least)))


def search(vectors: DataFrame, queries: DataFrame, k: int) -> DataFrame:
    """``query_id, rank, vec_id, score``: the ``k`` best of ``vectors`` for each of ``queries`` (both vec_id, embedding)."""
    parts = int(vectors.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    packs = quantize(vectors).repartitionByRange(parts, "vec_id").sortWithinPartitions("vec_id") \
        .mapInArrow(_pack_rows, PACKS)
    asked = quantize(queries).dropDuplicates(["vec_id"]).sortWithinPartitions("vec_id").mapInArrow(_pack_rows, PACKS)
    n_vecs, entries = vectors.agg(F.count(F.lit(1)), F.sum(F.size("embedding").cast("long"))).first()
    q_packs, columns = _grid(queries.count(), n_vecs, max(1, -(-(entries or 0) // max(1, n_vecs))), parts)
    tasks = min(4 * q_packs * columns, max(parts, MOST_TASKS))   # four a cell: hashing puts few cells into one task

    def dealt(df: DataFrame, kind: int, col: Column, q_pack: Column) -> DataFrame:
        return df.withColumn("col", col).withColumn("q_pack", q_pack) \
            .select((F.col("q_pack") * columns + F.col("col")).alias("cell"), F.lit(kind).alias("kind"), "ids", "vecs", "dims")

    # the grid: every query pack once per column, every pack of vectors once per query pack
    each = lambda n: F.explode(F.sequence(F.lit(0).cast("long"), F.lit(n - 1).cast("long")))
    turn = lambda n: F.pmod("turn", F.lit(n).cast("long"))
    found = dealt(asked, 0, each(columns), turn(q_packs)).unionByName(dealt(packs, 1, turn(columns), each(q_packs))) \
        .repartition(tasks, "cell").sortWithinPartitions("cell", "kind") \
        .mapInArrow(_search(k), "query_id long, vec_id long, score long")
    by_score = Window.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id")
    return found.withColumn("rank", F.row_number().over(by_score)).where(F.col("rank") <= k) \
        .select("query_id", "rank", "vec_id", "score")
