import math
import random

import numpy as np
import pytest

from assay.llm import whiten

from .edge import table

SCHEMA = "vec_id long, embedding array<float>, label int, idx long, part int, x string, dev string, y string"


def vectors(spark, rows):
    return table(spark, [(i, v, 0, 1, 1, "x", "x", "x") for i, v in rows], SCHEMA)


def expected(rows, limit=32):
    fine = [(i, [math.floor(64 * float(np.float32(x))) + 1_000_000 for x in v]) for i, v in rows
            if v is not None and all(x is not None and math.isfinite(x) for x in v)]
    dims = max(len(v) for _, v in fine)
    x = [v + [1_000_000] * (dims - len(v)) for _, v in fine]
    n, sums = len(x), [sum(c) for c in zip(*x)]
    dev = [[n * a - s for a, s in zip(v, sums)] for v in x]
    centred = np.array(dev) / n
    cov = centred.T @ centred / n
    e, w = np.linalg.eigh(cov)
    e, w = e[::-1], w[:, ::-1]
    keep = e > e[0] * 1e-10
    e, w = e[keep][:limit], w[:, keep][:, :limit]
    return [i for i, _ in fine], n, [sum(d * d for d in r) for r in dev], centred @ w / np.sqrt(e), e / np.trace(cov)


def check(spark, rows, limit=32):
    got = whiten.whiten(vectors(spark, rows), limit).collect()
    ids, n, deviation, y, explained = expected(rows, limit)
    assert len(got) == y.size and {r.n for r in got} == {n}
    assert {(r.component, round(r.explained, 9)) for r in got} == {(j + 1, round(x, 9)) for j, x in enumerate(explained)}
    assert {r.identity_error for r in got} == {got[0].identity_error} and got[0].identity_error < 1e-6
    mine = np.array([sorted(abs(r.whitened) for r in got if r.component == j + 1) for j in range(y.shape[1])])
    assert np.allclose(mine, np.sort(np.abs(y.T), axis=1), atol=1e-6)
    assert sorted((str(r.vec_id), r.deviation) for r in got if r.component == 1) == sorted((str(i), d) for i, d in zip(ids, deviation))
    by_row = {}
    for r in got:
        by_row.setdefault((r.vec_id, r.deviation), {})[r.component] = r.whitened
    signs = np.sign([[by_row[i, d].get(j + 1, 0) for j in range(y.shape[1])] for i, d in zip(ids, deviation)]) * np.sign(y)
    clear = np.abs(y) > 1e-6
    for j in range(y.shape[1]):     # one sign for all rows
        assert len(set(signs[clear[:, j], j])) == 1


@pytest.fixture()
def rows():
    rnd = random.Random(4)
    mix = np.random.default_rng(4).normal(size=(6, 6))
    return [(i, (mix @ [rnd.gauss(0, 0.3 + j) for j in range(6)]).tolist()) for i in range(300)]


def test_equals_numpy(spark, rows, monkeypatch):
    monkeypatch.setattr(whiten, "BLOCK_ROWS", 16)       # 19 blocks, the last one short, on a grid
    monkeypatch.setattr(whiten, "GROUP_BLOCKS", 2)
    check(spark, rows)
    check(spark, rows, limit=2)


def test_odd_rows(spark, rows):
    odd = [(2000, None), (2050, [0.1, None]), (2100, [float("nan")] * 6), (2150, [float("inf")] * 6), (None, rows[0][1]),
           (2200, []), (2250, [0.5] * 3), (3, rows[3][1])]
    check(spark, rows + odd)


def test_fewer_rows_than_dimensions(spark, rows):
    check(spark, [(i, v * 3) for i, v in rows[:5]])
    check(spark, [(i, [1.0, v[0], 2.0]) for i, v in rows[:9]])      # constant dimensions


def test_nothing_to_whiten(spark, rows):
    for few in ([], [(1, None)], rows[:1], [(1, [0.5, 0.25])] * 4, [(1, [])]):
        got = whiten.whiten(vectors(spark, few))
        assert got.collect() == []
        assert got.columns == ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"]
