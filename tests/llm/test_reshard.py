import itertools
import random
import zlib

import pytest
from pyspark.sql import functions as F

from assay.llm import reshard

from .edge import EDGE, docs


def least_cost(sizes, capacities):
    """Bytes that have to leave, if shard i may keep up to capacity i (brute force over what is kept)."""
    best = None
    for kept in itertools.product(*[range(min(s, c) + 1) for s, c in itertools.zip_longest(sizes, capacities[:len(sizes)], fillvalue=0)]):
        moved = sum(sizes) - sum(kept)
        if best is None or moved < best:
            best = moved
    return best


def test_flow_is_feasible_and_cheapest():
    rnd = random.Random(1)
    for _ in range(60):
        sizes = [rnd.randrange(7) for _ in range(rnd.randrange(1, 5))]
        capacities = reshard.equal_capacities(sum(sizes), rnd.randrange(1, 5))
        flow = reshard.min_cost_flow(sizes, capacities)
        assert [sum(r) for r in flow] == sizes
        assert [sum(c) for c in zip(*flow)] == capacities
        assert all(x >= 0 for r in flow for x in r)
        moved = sum(x for i, r in enumerate(flow) for j, x in enumerate(r) if i != j)
        assert moved == least_cost(sizes, capacities)


def test_flow_needs_room():
    with pytest.raises(ValueError):
        reshard.min_cost_flow([5], [2, 2])


ROWS = [(i, "x" * (i * 37 % 400)) for i in range(600)] + EDGE + [(700, None)] * 3


def checked(rows, got, shards):
    want = sorted(((i, len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for i, t in rows), key=str)
    assert sorted(((r.doc_id, r["size"], r.text_crc32) for r in got), key=str) == want
    per = {s: [r for r in got if r.shard == s] for s in range(shards)}
    assert sum(map(len, per.values())) == len(got)
    for part in per.values():
        assert sorted(r.slot for r in part) == list(range(len(part)))
    sizes = [sum(r["size"] for r in part) for part in per.values()]
    return sizes, max(x[1] for x in want)


@pytest.mark.parametrize("block_bytes", [500, 1 << 20])
def test_shards_are_near_equal_and_gapless(spark, block_bytes):
    made = reshard.plan(docs(spark, ROWS), F.pmod(F.col("doc_id"), F.lit(3)), 5, block_bytes)
    sizes, most = checked(ROWS, made.assign().collect(), 5)
    assert max(sizes) - min(sizes) <= 2 * most


def test_equal_layout_moves_nothing(spark):
    rows = [(i, "abcd") for i in range(40)]
    made = reshard.plan(docs(spark, rows), (F.col("doc_id") % 4).cast("int"), 4)
    assert made.moved_bytes == 0 and made.affected() == []
    assert all(r.shard == r.doc_id % 4 for r in made.assign().collect())


def test_rewrite_touches_affected_shards_only(spark, scratch):
    rows = [(i, "abcd") for i in range(40)] + [(100 + i, "abcd") for i in range(20)]
    old = F.when(F.col("doc_id") >= 100, 0).otherwise(F.col("doc_id") % 4)      # shard 0 has 30, the others 10
    made = reshard.plan(docs(spark, rows), old, 4)
    assert made.moved_bytes == 15 * 5 and made.affected() == [0, 1, 2, 3]
    changed = reshard.rewrite(made, f"{scratch}/new")
    got = spark.read.parquet(f"{scratch}/new")
    assert changed == [0, 1, 2, 3] and got.count() == 60
    assert sorted(r.doc_id for r in got.collect()) == sorted(i for i, _ in rows)
    assert {r.shard: r["count"] for r in got.groupBy("shard").count().collect()} == dict.fromkeys(range(4), 15)
    stays = sum(r.shard == r.doc_id % 4 for r in got.where("doc_id < 100").collect())
    assert stays >= 30


def test_empty_table(spark, scratch):
    made = reshard.plan(docs(spark, []), F.col("doc_id"), 4)
    assert made.assign().collect() == [] and reshard.rewrite(made, f"{scratch}/new") == []
