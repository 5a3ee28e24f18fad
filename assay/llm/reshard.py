"""Resharding by minimum-cost flow: move the fewest bytes from old shards to new capacities.

The sizes of the old shards and the capacities of the new ones (one number per shard, so
small whatever the data) are a transport problem: a byte that stays in its shard costs 0, a
byte that moves costs 1.  Successive shortest paths solve it exactly.  Old shards are cut
into blocks by a hash; rows have a place in their shard (bytes before them: blocks before,
then rows before in the block), and the flow becomes ranges of places: what stays comes
first, then one range per target.  A row goes where its middle byte goes, so a new shard is
within half a row's size per range end of its capacity.

Only files of shards that give or get rows are rewritten (``rewrite``).

Defined results: null texts have size 1; a null old shard counts as shard 0; rows of equal
id and text are interchangeable; empty tables give no rows; other columns are kept by
``rewrite``.  The law is ``bytes``: new shard sizes are as near equal as whole rows allow.
"""

from __future__ import annotations

from collections import deque

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import cut

BLOCK_BYTES = 1 << 20   # least size of a block, about
MOST_BLOCKS = 200_000   # blocks grow with the table, so that sums along a shard stay short


def equal_capacities(total: int, shards: int) -> list[int]:
    return [total // shards + (i < total % shards) for i in range(shards)]


def min_cost_flow(sizes: list[int], capacities: list[int]) -> list[list[int]]:
    """``flow[i][j]`` bytes from old shard i to new shard j; as few as possible leave their shard.

    Successive shortest paths on the bipartite graph (Bellman-Ford by a queue,
    because used edges run backwards at negative cost).  Each round fills a
    shard or empties one, or undoes a flow, so rounds are few.
    """
    if sum(sizes) > sum(capacities):
        raise ValueError("the new shards are too small")
    n, m = len(sizes), len(capacities)
    left, room = list(sizes), list(capacities)
    flow = [[0] * m for _ in range(n)]
    cost = [[int(i != j) for j in range(m)] for i in range(n)]
    while any(left):
        source = next(i for i, x in enumerate(left) if x)
        best: dict[tuple[str, int], tuple[int, tuple | None]] = {("old", source): (0, None)}
        queue = deque([("old", source)])
        while queue:
            side, at = node = queue.popleft()
            far = best[node][0]
            steps = [(("new", j), cost[at][j]) for j in range(m)] if side == "old" else \
                [(("old", i), -cost[i][at]) for i in range(n) if flow[i][at]]
            for target, step in steps:
                if target not in best or far + step < best[target][0]:
                    best[target] = far + step, node
                    queue.append(target)
        end = min((j for j in range(m) if room[j]), key=lambda j: best["new", j][0])
        path, node = [], ("new", end)
        while node is not None:
            path.append(node)
            node = best[node][1]
        path.reverse()
        amount = min(left[source], room[end], *(flow[b[1]][a[1]] for a, b in zip(path, path[1:]) if a[0] == "new"))
        for a, b in zip(path, path[1:], strict=False):
            if a[0] == "old":
                flow[a[1]][b[1]] += amount
            else:
                flow[b[1]][a[1]] -= amount
        left[source] -= amount
        room[end] -= amount
    return flow


def size_of(text: Column) -> Column:
    """UTF-8 bytes plus 1."""
    return (F.coalesce(F.octet_length(text), F.lit(0)) + 1).cast("bigint")


def _located(docs: DataFrame, old: Column, block_bytes: int, sizes: dict[int, int], extra: list[Column]) -> DataFrame:
    """Rows with their old shard, block, and the rows and bytes before them in the block."""
    blocks = F.create_map(*[F.lit(x) for s, b in sizes.items() for x in (s, max(1, -(-b // block_bytes)))])
    crc = F.crc32(F.coalesce(F.col("text"), F.lit("")).cast("binary"))
    rows = docs.select("doc_id", *extra, size_of(F.col("text")).alias("_size"), crc.alias("_crc"),
                       F.coalesce(old, F.lit(0)).cast("int").alias("_old"))
    rows = rows.withColumn("_block", F.pmod(F.xxhash64("doc_id", "_crc"), F.element_at(blocks, F.col("_old"))).cast("int"))
    inside = Window.partitionBy("_old", "_block").orderBy("doc_id", "_crc", "_size")
    return rows.withColumn("_row", F.row_number().over(inside)).withColumn(
        "_before", F.sum("_size").over(inside.rowsBetween(Window.unboundedPreceding, 0)) - F.col("_size"))


def plan(docs: DataFrame, old: Column, shards: int, block_bytes: int = BLOCK_BYTES) -> "Plan":
    """Solves the transfers for ``docs(doc_id, text)`` whose old shard is ``old``, to ``shards`` equal ones."""
    sized = docs.select(F.coalesce(old, F.lit(0)).cast("int").alias("s"), size_of(F.col("text")).alias("b"))
    sizes = {r["s"]: r["b"] for r in sized.groupBy("s").agg(F.sum("b").alias("b")).collect()}  # a row per shard
    known = [sizes.get(i, 0) for i in range(max([*sizes, shards - 1]) + 1)]
    block_bytes = max(block_bytes, sum(known) // MOST_BLOCKS)
    flow = min_cost_flow(known, equal_capacities(sum(known), shards))
    return Plan(docs, old, shards, block_bytes, {i: b for i, b in enumerate(known)}, flow)


class Plan:
    """The flow, and the rows it moves."""

    def __init__(self, docs: DataFrame, old: Column, shards: int, block_bytes: int, sizes: dict[int, int],
                 flow: list[list[int]]):
        self.docs, self.old, self.shards, self.block_bytes, self.sizes, self.flow = docs, old, shards, block_bytes, sizes, flow

    @property
    def moved_bytes(self) -> int:
        return sum(x for i, row in enumerate(self.flow) for j, x in enumerate(row) if i != j)

    def affected(self) -> list[int]:
        """New shards whose files change; the others stay as they are."""
        moves = [(i, j) for i, row in enumerate(self.flow) for j, x in enumerate(row) if x and i != j]
        return sorted({x for m in moves for x in m if x < self.shards})

    def _target(self) -> Column:
        """New shard from the old one and the place in it: what stays first, then a range per target."""
        out = F.lit(None).cast("int")
        for i, row in enumerate(self.flow):
            ends, end = [], 0
            for j in sorted((j for j, x in enumerate(row) if x), key=lambda j: (j != i, j)):
                end += row[j]
                ends.append((end, j))
            if ends:
                chosen = F.lit(ends[-1][1])
                for end, j in reversed(ends[:-1]):
                    chosen = F.when(F.col("_place") < end, F.lit(j)).otherwise(chosen)
                out = F.when(F.col("_old") == i, chosen).otherwise(out)
        return out.cast("int")

    def assign(self, *extra: Column) -> DataFrame:
        """``doc_id``, the ``extra`` columns, ``size, text_crc32, shard, slot``; slots are gapless from 0 in each shard.

        The rows are dealt by block, each a few MB of rows; counts per block, not
        rows, are summed along the shards.
        """
        located = _located(self.docs, self.old, self.block_bytes, self.sizes, list(extra))
        names = [c for c in located.columns if not c.startswith("_")]
        light = _located(self.docs, self.old, self.block_bytes, self.sizes, [])
        along = Window.partitionBy("_old").orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
        starts = cut(light.groupBy("_old", "_block").agg(F.sum("_size").alias("bytes"))
                     .withColumn("_start", F.coalesce(F.sum("bytes").over(along), F.lit(0))).drop("bytes"))
        down = Window.partitionBy("shard").orderBy("_old", "_block").rowsBetween(Window.unboundedPreceding, -1)
        counts = self._placed(light, starts).groupBy("_old", "_block", "shard", "_start").agg(F.count(F.lit(1)).alias("n"))
        blocks = cut(counts.withColumn("first", F.coalesce(F.sum("n").over(down), F.lit(0)))
                     .groupBy("_old", "_block", "_start")
                     .agg(F.map_from_entries(F.collect_list(F.struct("shard", "first"))).alias("_first")))
        order = Window.partitionBy("_old", "_block", "shard").orderBy("_before", "_row")
        rows = self._placed(located, blocks).withColumn("_nth", F.row_number().over(order) - 1)
        return rows.select(*names, F.col("_size").alias("size"), F.col("_crc").alias("text_crc32"), "shard",
                           (F.element_at("_first", F.col("shard")) + F.col("_nth")).cast("bigint").alias("slot"))

    def _placed(self, rows: DataFrame, starts: DataFrame) -> DataFrame:
        met = rows.join(starts, ["_old", "_block"]) \
            .withColumn("_place", F.col("_start") + F.col("_before") + F.floor(F.col("_size") / 2))
        return met.withColumn("shard", self._target())


def rewrite(made: Plan, new_path: str) -> list[int]:
    """Writes the affected shards of a plan below ``new_path`` as ``shard=N`` folders; returns their numbers.

    All columns of the documents are kept, with ``slot`` beside them (a column
    of that name, or ``shard``, is replaced).  Old files of the shards not named
    stay valid.
    """
    names = [c for c in made.docs.columns if c not in ("doc_id", "shard", "slot")]
    rows = made.assign(F.struct(*names).alias("row"))
    changed = made.affected()
    rows.where(F.col("shard").isin(changed)).select("shard", "slot", "doc_id", "row.*") \
        .write.mode("overwrite").partitionBy("shard").parquet(new_path)
    return changed
