"""From lists of sets that may link to the components of those that do, without all pairs of a list.

Two operators find candidates by keys (inverted lists, bands): sets that link share a key, sets that share a
key need not link.  A list of g near copies has g * g / 2 pairs, so pairs are made in steps:

1. *First star.*  A list's leader is the member with the most company, that is the largest sum of its lists' sizes: in a group of
   copies the one that the others were made from, or nearest to it.  A set is held against one leader only, the one that leads
   most of its lists.  A group of g copies costs g comparisons, and its components come from them.
2. *More stars.*  A list whose members are in one component is done.  In the others only pairs of different components are
   left.  While those are many for the lists' members, each list gets ``LEADERS`` leaders (the one in most lists, others drawn by
   hash) that meet all its members and leave it, as long as that at least halves the pairs.
3. *Rest.*  The pairs of different components that are left meet in cells of ``CELL`` x ``CELL`` members.

In stars and cells, pairs are first thinned out by what the caller knows of each set; a pair that meets in several lists
counts in the one with the smallest key (as far as ``KEYS`` keys of each set tell).

Every pair of a list ends up compared, excluded by the caller's bound, or in one component, so no link is lost.

Comparing means shingling both whole texts.  Pairs are grouped by their leader and a part of its pairs (``PART_PAIRS``
at most, about), so a leader with a third of all pairs is spread out, and a task holds one leader's sets and one batch.
"""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Tables, connected_components
from .shingles import mix, shingle_sets

PART_PAIRS = 256    # pairs of one leader in one group of rows, about
ID_BUCKETS = 1 << 19    # of the filter on texts that are in some pair
CELL = 2048         # members on a side of a cell, about
LEADERS = 8         # of each list in a later round
MOST_RANGE_BITS = 10    # at most 1,024 counts of a set
STAR = -1           # marks the cells of leaders and members
KEYS = 8            # of a set's keys, to tell that a pair meets elsewhere too; what more would tell is less than they take in each row
WORTH = 64          # pairs left for each member that make another round of stars worth its jobs

#: (sizes a, sketches a, sizes b, sketches b) to a mask of the pairs that may link; sketches are lists of bytes
Possible = Callable[[np.ndarray, list, np.ndarray, list], np.ndarray]


def counts(s: np.ndarray) -> np.ndarray:
    """Counts of a set's shingles in a power of 2 of hash ranges, about one shingle each; 255 means "that or more"."""
    bits = min(max(len(s), 1).bit_length(), MOST_RANGE_BITS)
    part = (mix(s ^ np.uint64(0x2545F4914F6CDD1D)) >> np.uint64(64 - bits)).astype(np.int64)
    return np.minimum(np.bincount(part, minlength=1 << bits), 255).astype(np.uint8)


def pack(sketch: bytes) -> bytes:
    """A sketch as it is kept and shuffled: small counts take some 1.5 bits each, which the shuffle's own compression doesn't see."""
    return zlib.compress(sketch, 1)


def unpack(sketches: pa.Array) -> list[bytes]:
    return [zlib.decompress(s) for s in sketches.to_pylist()]


def counts_allow(num: int, den: int) -> Possible:
    """The pairs whose counts allow an intersection that is large enough; never excludes a link."""
    def test(n_a: np.ndarray, s_a: list, n_b: np.ndarray, s_b: list) -> np.ndarray:
        keep = (num * np.maximum(n_a, n_b) <= den * np.minimum(n_a, n_b)) & (np.minimum(n_a, n_b) > 0)
        widths: dict[tuple[int, int], list[int]] = {}
        for i in np.flatnonzero(keep).tolist():
            widths.setdefault((len(s_a[i]), len(s_b[i])), []).append(i)
        for (w, v), rows in widths.items():
            step = max(1, (1 << 22) // max(w, v))
            for at in range(0, len(rows), step):
                some = rows[at:at + step]
                a = np.frombuffer(b"".join([s_a[i] for i in some]), np.uint8).reshape(-1, w)
                b = np.frombuffer(b"".join([s_b[i] for i in some]), np.uint8).reshape(-1, v)
                open_end = (a.max(axis=1) == 255) | (b.max(axis=1) == 255)
                low = min(w, v)     # ranges are halves of wider ones
                if w != v:
                    a, b = (x.reshape(len(some), low, -1).sum(axis=2, dtype=np.int64) for x in (a, b))
                most = np.minimum(a, b).sum(axis=1, dtype=np.int64)
                keep[some] = open_end | (den * most >= num * (n_a[some] + n_b[some] - most))
        return keep
    return test


def _sketched(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """Pairs (a, b) with what is known of both: n_a, s_a, n_b, s_b; a row per combination if an id has several sets."""
    side = lambda x: sets.select(F.col("id").alias(x), F.col("n_shingles").alias(f"n_{x}"), F.col("sketch").alias(f"s_{x}"))
    return pairs.join(side("a"), "a").join(side("b"), "b").select("a", "b", "n_a", "s_a", "n_b", "s_b")


def _pairs(a, b) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], names=["a", "b"])


def _thin(possible: Possible):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            a, b, n_a, s_a, n_b, s_b = batch.columns
            keep = possible(n_a.to_numpy(), unpack(s_a), n_b.to_numpy(), unpack(s_b))
            if keep.any():
                yield _pairs(a.to_numpy()[keep], b.to_numpy()[keep])
    return run


def _verify(k: int, num: int, den: int):
    """Rows (b, part, role, id, text) sorted by b, part, role; the leader's own rows have role 0."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        group, leaders = None, []
        for batch in batches:
            out = []
            for b, part, role, i, s in zip(*[batch.column(c).to_pylist() for c in range(4)], shingle_sets(batch.column(4), k), strict=True):
                if group != (b, part):
                    group, leaders = (b, part), []
                if role == 0:
                    leaders.append(s)
                    continue
                for t in leaders:
                    if len(s) and len(t) and num * max(len(s), len(t)) <= den * min(len(s), len(t)):
                        both = len(np.intersect1d(s, t, assume_unique=True))
                        if den * both >= num * (len(s) + len(t) - both):
                            out.append((i, b))
                            break
            if out:
                yield _pairs(*zip(*out, strict=True))
    return run


def verified(pairs: DataFrame, texts: DataFrame, k: int, num: int, den: int) -> DataFrame:
    """The pairs (a, b) of a written table whose texts (id, text) link by their whole sets of ``k``-word shingles."""
    parts = int(texts.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    shares = pairs.groupBy("b").agg(F.ceil(F.count(F.lit(1)) / PART_PAIRS).cast("int").alias("shares"))
    leaders = shares.select(F.col("b").alias("id"), "b", F.explode(F.sequence(F.lit(0), F.col("shares") - 1)).alias("part"), F.lit(0).alias("role"))
    members = pairs.join(shares, "b").select(F.col("a").alias("id"), "b", F.pmod(F.xxhash64("a"), F.col("shares")).cast("int").alias("part"),
                                             F.lit(1).alias("role"))
    wanted = leaders.unionByName(members)
    # most texts are in no pair: those whose id falls in no wanted bucket are not sent (ID_BUCKETS numbers at most are broadcast)
    bucket = F.pmod(F.xxhash64("id"), F.lit(ID_BUCKETS))
    buckets = pairs.select(F.explode(F.array("a", "b")).alias("id")).select(bucket.alias("bucket")).distinct()
    some = texts.withColumn("bucket", bucket).join(F.broadcast(buckets), "bucket", "left_semi").drop("bucket")
    rows = some.join(wanted, "id").select("b", "part", "role", "id", "text")
    return rows.repartition(parts, "b", "part").sortWithinPartitions("b", "part", "role") \
        .mapInArrow(_verify(k, num, den), "a long, b long").distinct()


def _cells(possible: Possible):
    """Rows (key, i, j, side, id, comp, n, keys, sketch) sorted by cell and side to the pairs of different components that may link.

    A cell (i = j) pairs its rows, another one those of side 0 with those of side 1.  Holds one cell.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cell, rows = None, []

        def pairs() -> pa.RecordBatch | None:
            left = [r for r in rows if r[0] == 0]
            right = left if cell[1] == cell[2] else [r for r in rows if r[0] == 1]
            key, out = cell[0], set()
            comp, n = np.array([r[2] for r in right]), np.array([r[3] for r in right])
            sketches, smaller = [r[5] for r in right], [{k for k in r[4] if k < key} for r in right]
            for at, (_, i, c, size, keys, s) in enumerate(left):
                other = np.flatnonzero(comp != c)
                if cell[1] == cell[2]:
                    other = other[other > at]
                if len(other):
                    other = other[possible(np.full(len(other), size), [s] * len(other), n[other], [sketches[x] for x in other])]
                    mine = {k for k in keys if k < key}
                    met = [right[x][1] for x in other.tolist() if mine.isdisjoint(smaller[x])]
                    out.update(((m, i) for m in met) if cell[1] == STAR else ((max(i, m), min(i, m)) for m in met))
            return _pairs(*zip(*out, strict=True)) if out else None

        for batch in batches:
            for key, i, j, *row in zip(*[c.to_pylist() for c in batch.columns[:-1]], unpack(batch.columns[-1]), strict=True):
                if cell != (key, i, j):
                    if rows and (out := pairs()) is not None:
                        yield out
                    cell, rows = (key, i, j), []
                rows.append(row)
        if rows and (out := pairs()) is not None:
            yield out
    return run


def _unfinished(members: DataFrame, comps: DataFrame, tables: Tables) -> DataFrame:
    """``key, id, comp`` of the lists whose members are in several components, and ``n``, ``pairs`` of each list."""
    left = members.join(comps, F.col("id") == F.col("node"), "left").select("key", "id", F.coalesce("component", "id").alias("comp"))
    of_comp = left.groupBy("key", "comp").agg(F.count(F.lit(1)).cast("double").alias("c"))
    lists = of_comp.groupBy("key").agg(F.sum("c").alias("n"), F.sum(F.col("c") * F.col("c")).alias("own"), F.count(F.lit(1)).alias("comps")) \
        .where("comps > 1").select("key", "n", ((F.col("n") * F.col("n") - F.col("own")) / 2).alias("pairs"))
    return tables.write(left.join(lists, "key"))


def _one_of_alike(lists: DataFrame) -> DataFrame:
    """Lists with the same members would give the same pairs: the rows of one of each."""
    alike = lists.groupBy("key").agg(F.sum(F.xxhash64("id").cast("decimal(38,0)")).alias("h"), F.count(F.lit(1)).alias("rows"),
                                     F.bit_xor(F.xxhash64("id", F.lit(7))).alias("x"))
    return lists.join(alike.groupBy("h", "rows", "x").agg(F.min("key").alias("key")).select("key"), "key")


def _in_cells(dealt: DataFrame, members: DataFrame, sets: DataFrame, possible: Possible) -> DataFrame:
    """The pairs of rows (key, i, j, side, id, comp) dealt to cells."""
    parts = int(members.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    keys = members.groupBy("id").agg(F.slice(F.array_sort(F.collect_list("key")), 1, KEYS).alias("keys"))
    known = sets.select("id", "n_shingles", "sketch").join(keys, "id")
    return dealt.join(known, "id").select("key", "i", "j", "side", "id", "comp", "n_shingles", "keys", "sketch") \
        .repartition(parts, "key", "i", "j").sortWithinPartitions("key", "i", "j", "side") \
        .mapInArrow(_cells(possible), "a long, b long").distinct()


def _part(size: int):
    return F.pmod(F.xxhash64("id", F.lit(1)), F.ceil(F.col("n") / size)).cast("int")


def _stars(members: DataFrame, seed: int, sets: DataFrame, possible: Possible, tables: Tables) -> tuple[DataFrame, DataFrame]:
    """Of each list some members as leaders, ``(key, id)``, and the pairs of members and leaders of other components."""
    counted = members.join(members.groupBy("id").agg(F.count(F.lit(1)).alias("lists")), "id")
    who = F.struct("id", "comp")
    drawn = [F.min_by(who, F.struct(-F.col("lists"), "id")), *[F.min_by(who, F.xxhash64("id", F.lit(seed + i))) for i in range(1, LEADERS)]]
    leaders = counted.groupBy("key").agg(F.array_distinct(F.array(*drawn)).alias("l"), F.max("n").alias("n"))
    leaders = tables.write(leaders.select("key", "n", F.explode("l").alias("l")).select("key", "n", "l.*"))
    parts = F.explode(F.sequence(F.lit(0), F.ceil(F.col("n") / CELL).cast("int") - 1))
    dealt = members.select("key", F.lit(STAR).alias("i"), _part(CELL).alias("j"), F.lit(1).alias("side"), "id", "comp").unionByName(
        leaders.select("key", F.lit(STAR).alias("i"), parts.alias("j"), F.lit(0).alias("side"), "id", "comp"))
    return leaders.select("key", "id"), _in_cells(dealt, members, sets, possible)


def _rest(members: DataFrame, sets: DataFrame, possible: Possible) -> DataFrame:
    """Pairs of different components in the lists that are left."""
    every = F.explode(F.sequence(F.lit(0), F.ceil(F.col("n") / CELL).cast("int") - 1))
    dealt = members.withColumn("own", _part(CELL)).withColumn("other", every) \
        .select("key", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"),
                (F.col("own") > F.col("other")).cast("int").alias("side"), "id", "comp")
    return _in_cells(dealt, members, sets, possible)


def representatives(sets: DataFrame, tables: Tables) -> tuple[DataFrame, DataFrame]:
    """One row per distinct set (the smallest id), and the links (a, b) of the others to it, as written tables.

    ``sets``: id, n_shingles, h1, h2 (128-bit hash of the set) and more.
    """
    key = ["h1", "h2", "n_shingles"]
    first = tables.write(sets.groupBy(*key).agg(F.min("id").alias("centre")))
    joined = sets.join(first, key)
    equal = joined.where("id != centre").select(F.col("id").alias("a"), F.col("centre").alias("b")).distinct()
    chosen = tables.write(joined.where("id = centre").dropDuplicates(["id", *key]).drop("centre"))
    equal = tables.write(equal)
    tables.drop(first)
    return chosen, equal


def components(lists: DataFrame, sets: DataFrame, equal: DataFrame, texts: DataFrame, k: int, num: int, den: int,
               possible: Possible) -> DataFrame:
    """``node, component`` of the sets that link with another.

    ``lists(key, id)``: sets that link share a key; ``sets(id, n_shingles, sketch)``, the sketch as ``pack`` gives it; ``equal(a, b)``: links known
    already; ``texts(id, text)``.
    """
    tables = Tables(texts.sparkSession)
    lists = lists.repartition("key")    # one shuffle of the lists, from which they are counted and joined with their counts
    shared = lists.groupBy("key").agg(F.min("id").alias("x"), F.max("id").alias("y"), F.count(F.lit(1)).alias("n")).where("x < y")
    met = tables.write(lists.join(shared.select("key", "n"), "key"))
    company = tables.write(met.groupBy("id").agg(F.sum("n").alias("company")))
    leaders = met.join(company, "id").groupBy("key").agg(F.min_by("id", F.struct(-F.col("company"), "id")).alias("leader"))
    led = met.join(tables.write(leaders), "key")

    def compare(pairs: DataFrame) -> DataFrame | None:
        """The links among pairs; None if there are no pairs."""
        pairs, n = tables.write_counted(pairs)
        return tables.write(verified(pairs, texts, k, num, den)) if n else None

    stars = led.where("id != leader").groupBy(F.col("id").alias("a"), F.col("leader").alias("b")).agg(F.count(F.lit(1)).alias("n"))
    first = stars.groupBy("a").agg(F.min_by("b", F.struct(-F.col("n"), "b")).alias("b"))
    links = compare(_sketched(first, sets).mapInArrow(_thin(possible), "a long, b long").distinct())
    if links is None:
        links = equal.where("false")
    comps = tables.write(connected_components(links))
    left = tables.write(_one_of_alike(_unfinished(met.select("key", "id").distinct(), comps, tables)))
    tables.drop_but(left, links, comps)
    before, seed = float("inf"), 0
    while True:
        n, pairs = left.agg(F.count(F.lit(1)), F.sum(F.col("pairs") / F.col("n"))).first()
        if not n or pairs <= WORTH * n or pairs > before / 2:
            break
        before, seed = pairs, seed + LEADERS
        leaders, tried = _stars(left, seed, sets, possible, tables)
        more = compare(tried)
        if more is not None:
            links = tables.write(links.union(more))
            comps = tables.write(connected_components(links))
        left = _unfinished(left.select("key", "id").join(leaders, ["key", "id"], "left_anti"), comps, tables)
        tables.drop_but(left, links, comps)
    if n:
        more = compare(_rest(left, sets, possible))
        links = links if more is None else links.union(more)
    out = connected_components(links.union(equal))
    tables.drop_but()
    return out
