"""Near-duplicate documents by SetSketch registers.

A set's sketch has ``REGISTERS`` registers.  Register i is the least of exponential variables, one per
shingle (drawn from the shingle's hash, rate ``RATE``), on an exponential scale: with h that minimum, the whole part of
1 - log_BASE(h), truncated to 0 ... 254.  Registers of a union are the maxima of the registers, so sketches
merge; and registers of two sets are equal with a probability that grows with their Jaccard similarity.

Candidates agree in a band of ``ROWS`` registers (at a similarity of 0.8 all ``REGISTERS // ROWS`` bands miss
with a probability of 5e-8).  A candidate pair is then judged by all registers together: how many are larger,
smaller and equal gives the likelihood of each similarity, the sizes being known.  Pairs for which a similarity of
the threshold or more is less likely than the best by a factor of e^``DOUBT`` are dropped (1e-9 at the
threshold), after those that an exact bound excludes (``links.counts``); the others are verified on their whole sets.  A probabilistic index, therefore, with a stated miss
rate and no caps.  Sets that are equal are grouped by their hash first and count as one.

Defined results: null, empty and word-free texts have an empty set, link with nothing and are kept; a null doc_id has
a null component and is kept; rows that share a doc_id are one node, linked by either text; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Tables, arrow_batches
from .links import components, counts, counts_allow, pack, representatives, unpack
from .shingles import mix, shingle_sets

REGISTERS, ROWS = 200, 5
BASE, RATE = 1.1, 20.0
DOUBT = 18.0
BATCH_ROWS = 2000                   # texts that a Python worker gets at a time
GRID = np.linspace(0, 1, 101)       # similarities whose likelihoods are compared

U = np.uint64
_rng = np.random.default_rng(12)
_SEEDS = _rng.integers(0, 2 ** 32, REGISTERS, dtype=np.uint32)
_ODD = _rng.integers(0, 2 ** 32, REGISTERS, dtype=np.uint32) | np.uint32(1)


def registers(sets: list[np.ndarray]) -> np.ndarray:
    """One row of registers per set; an empty set has zeros."""
    out = np.zeros((len(sets), REGISTERS), np.uint8)
    full = [i for i, s in enumerate(sets) if len(s)]
    if not full:
        return out
    values = mix(np.concatenate([sets[i] for i in full]))
    starts = np.cumsum([0, *[len(sets[i]) for i in full[:-1]]])
    low, high = values.astype(np.uint32), (values >> U(32)).astype(np.uint32)
    most = np.empty((len(full), REGISTERS), np.uint32)
    for r in range(REGISTERS):
        x = (low ^ _SEEDS[r]) * _ODD[r]
        x ^= x >> np.uint32(15)
        x *= np.uint32(0x2C1B3C6D)
        x += high
        x ^= x >> np.uint32(13)
        x *= np.uint32(0x297A2D39)
        most[:, r] = np.maximum.reduceat(x, starts)
    # the largest uniform number belongs to the least exponential one
    h = -np.log((most.astype(np.float64) + 0.5) / 2 ** 32) / RATE
    out[full] = np.clip(np.floor(1 - np.log(h) / np.log(BASE)), 0, 254)
    return out


def merge(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Registers of the union."""
    return np.maximum(a, b)


def log_likelihoods(larger: np.ndarray, smaller: np.ndarray, n_a: np.ndarray, n_b: np.ndarray) -> np.ndarray:
    """Pairs x GRID: of the similarity, by the numbers of registers that are larger and smaller in a than in b."""
    u = (n_a / (n_a + n_b))[:, None]
    v = 1 - u

    def p(x):   # that a register of one set is larger, if x is its share of the union outside the other
        return -np.log1p(-x * (BASE - 1) / BASE) / np.log(BASE)
    possible = GRID[None, :] <= np.minimum(u / v, v / u) + 1e-12
    more, less = (p(np.clip(x, 0, 1)) for x in (u - v * GRID, v - u * GRID))
    equal = np.clip(1 - more - less, 1e-12, 1)
    d_more, d_less = larger[:, None], smaller[:, None]
    out = d_more * np.log(np.maximum(more, 1e-12)) + d_less * np.log(np.maximum(less, 1e-12)) \
        + (REGISTERS - d_more - d_less) * np.log(equal)
    return np.where(possible, out, -np.inf)


def may_link(num: int, den: int):
    """The pairs that counts (exactly) and registers (by likelihood) allow to be as similar as num / den."""
    allowed = counts_allow(num, den)

    def test(n_a: np.ndarray, s_a: list, n_b: np.ndarray, s_b: list) -> np.ndarray:
        keep = allowed(n_a, [s[REGISTERS:] for s in s_a], n_b, [s[REGISTERS:] for s in s_b])
        for at in range(0, len(keep), 4096):
            some = at + np.flatnonzero(keep[at:at + 4096])
            if not len(some):
                continue
            a, b = (np.frombuffer(b"".join(s[i][:REGISTERS] for i in some), np.uint8).reshape(-1, REGISTERS) for s in (s_a, s_b))
            like = log_likelihoods((a > b).sum(axis=1), (a < b).sum(axis=1), n_a[some].astype(float), n_b[some].astype(float))
            # one step of the grid below the threshold counts too, so that rounding drops nothing
            linked = like[:, GRID >= num / den - 0.011].max(axis=1)
            keep[some] = linked >= like.max(axis=1) - DOUBT
        return keep
    return test


SETS = "id long, n_shingles long, h1 long, h2 long, sketch binary"


def sketch(s: np.ndarray, own: np.ndarray) -> bytes:
    """The registers, and behind them the counts by hash range that bound an intersection."""
    return own.tobytes() + counts(s).tobytes()


def _sketch(k: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, rest = batch.column(0), list(shingle_sets(batch.column(1), k))
            at = 0
            while at < len(rest):
                stop, held = at, 0
                while stop < len(rest) and (stop == at or held + len(rest[stop]) <= 1 << 18):
                    held += len(rest[stop])
                    stop += 1
                some = rest[at:stop]
                yield pa.RecordBatch.from_arrays([
                    ids.slice(at, stop - at), pa.array([len(s) for s in some], pa.int64()),
                    pa.array([int(mix(s).sum(dtype=U).astype(np.int64)) for s in some], pa.int64()),
                    pa.array([int(mix(s ^ U(0xA0761D6478BD642F)).sum(dtype=U).astype(np.int64)) for s in some], pa.int64()),
                    pa.array([pack(sketch(s, r)) for s, r in zip(some, registers(some), strict=True)], pa.binary())], names=["id", "n_shingles", "h1", "h2", "sketch"])
                at = stop
    return run


def bands(sketches: np.ndarray) -> np.ndarray:
    """Sets x bands: a key of each band's registers."""
    key = np.zeros((len(sketches), REGISTERS // ROWS), U)
    for r in range(ROWS):
        key = mix(key * U(0x9E3779B97F4A7C15) + sketches[:, r::ROWS].astype(U) + U(1))
    return mix(key + np.arange(REGISTERS // ROWS, dtype=U) * U(0xD1342543DE82EF95))


def _bands(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        if batch.num_rows:
            keys = bands(np.frombuffer(b"".join(s[:REGISTERS] for s in unpack(batch.column(1))), np.uint8).reshape(-1, REGISTERS))
            yield pa.RecordBatch.from_arrays([pa.array(keys.view(np.int64).ravel()), pa.array(np.repeat(batch.column(0).to_numpy(), keys.shape[1]))],
                                             names=["key", "id"])


def near_duplicates(docs: DataFrame, k: int = 2, num: int = 80, den: int = 100) -> DataFrame:
    """``doc_id, n_shingles, component_id, kept`` of every row of ``docs(doc_id, text)``."""
    with arrow_batches(docs.sparkSession, BATCH_ROWS):
        return _near_duplicates(docs, k, num, den)


def _near_duplicates(docs: DataFrame, k: int, num: int, den: int) -> DataFrame:
    texts = docs.select(F.col("doc_id").cast("long").alias("id"), "text")
    tables = Tables(docs.sparkSession)
    sets = tables.write(texts.mapInArrow(_sketch(k), SETS))
    chosen, equal = representatives(sets.where("id IS NOT NULL AND n_shingles > 0"), tables)
    lists = chosen.select("id", "sketch").mapInArrow(_bands, "key long, id long")
    groups = components(lists, chosen, equal, texts.where("id IS NOT NULL AND text IS NOT NULL"), k, num, den, may_link(num, den))
    tables.drop(chosen, equal)
    component = F.coalesce("component", "id")
    return sets.select("id", "n_shingles").join(groups, sets["id"] == groups["node"], "left").select(
        F.col("id").alias("doc_id"), "n_shingles", component.alias("component_id"),
        F.coalesce(F.col("id") == component, F.lit(True)).alias("kept"))
