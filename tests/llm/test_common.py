import random

import pytest
from pyspark.sql import functions as F

from assay.llm import common


@pytest.mark.parametrize("seed", range(3))
def test_connected_components(spark, seed):
    rnd = random.Random(seed)
    edges = [(rnd.randrange(200), rnd.randrange(200)) for _ in range(90)] + [(500 + i, 501 + i) for i in range(60)] + [(7, 7)]
    parent = list(range(1000))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for a, b in edges:
        x, y = sorted((root(a), root(b)))
        parent[y] = x
    want = {i: root(i) for e in edges if e[0] != e[1] for i in e}
    got = common.connected_components(spark.createDataFrame(edges, "a long, b long"))
    assert {r.node: r.component for r in got.collect()} == want


def test_no_edges(spark):
    assert common.connected_components(spark.createDataFrame([], "a long, b long")).collect() == []


def test_running_total(spark):
    rows = [[], [5], list(range(1000)), [0, 0, 3], None]
    got = spark.createDataFrame([(r,) for r in rows], "a array<int>").select(common.running_total(F.col("a")).alias("t")).collect()
    for r, g in zip(rows, got, strict=True):
        total, want = 0, []
        for x in r or []:
            total += x
            want.append(total)
        assert g.t == want or r is None
