import math
import random

import numpy as np
import pyarrow as pa
from hypothesis import given, settings
from hypothesis import strategies as st

from assay.llm import topk

from .edge import table

SCHEMA = "vec_id long, embedding array<float>, label int, pack long, col int, q string, score string"


def vectors(spark, rows):
    return table(spark, [(i, v, 0, 1, 1, "x", "x") for i, v in rows], SCHEMA)


def expected(rows, k):
    fine = [(i, [math.floor(256 * float(np.float32(x))) for x in v]) for i, v in rows
            if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)]
    out, asked = [], {}
    for i, v in fine:
        if i % 50 == 0:
            asked.setdefault(i, v)
    for i, v in asked.items():
        scores = sorted((-sum(a * b for a, b in zip(v, w)), j) for j, w in fine if j != i)
        out += [(i, n + 1, j, -s) for n, (s, j) in enumerate(scores[:k])]
    return sorted(out)


def run(spark, rows, k=5):
    df = vectors(spark, rows)
    return sorted(map(tuple, topk.search(df, df.where("vec_id % 50 = 0"), k).collect()))


def test_equals_brute_force(spark):
    rnd = random.Random(1)
    rows = [(i, [rnd.gauss(0, 0.2) for _ in range(16)]) for i in range(700)]
    rows += [(1000 + i, rows[i % 7][1]) for i in range(60)]                   # ties
    rows += [(2000, None), (2050, [0.1, None]), (2100, [float("nan")] * 16), (2150, [float("inf")] * 16), (None, rows[0][1]),
             (2200, []), (2250, [0.5] * 3), (2300, [1e6] * 16), (3, rows[3][1])]
    assert run(spark, rows) == expected(rows, 5)


def test_fewer_than_k(spark):
    rows = [(0, [1.0, 2.0]), (50, [2.0, 1.0]), (7, [-1.0, 0.0])]
    assert run(spark, rows) == expected(rows, 5) and len(run(spark, rows)) == 4
    assert run(spark, []) == [] and run(spark, [(0, [1.0])]) == []


@settings(max_examples=60, deadline=None)
@given(st.integers(0, 2 ** 32), st.integers(1, 6), st.integers(1, 200), st.booleans())
def test_pack_keeps_the_best(seed, k, n, huge):
    rng = np.random.default_rng(seed)
    scale = 2 ** 27 if huge else 30
    vecs = rng.integers(-scale, scale, (n, 5)).astype(float) * rng.integers(0, 2, (n, 1))
    ids = np.arange(n, dtype=np.int64) * 3
    q_ids = np.array([0, 3, 10_000], np.int64)
    q = rng.integers(-scale, scale, (3, 5)).astype(float)
    got = sorted(zip(*(x.tolist() for x in topk.best_of_pack(q_ids, q, ids, vecs, k)), strict=True))
    want = []
    for i, v in zip(q_ids.tolist(), q.tolist(), strict=True):
        scores = sorted((-sum(int(a) * int(b) for a, b in zip(v, w)), j) for j, w in zip(ids.tolist(), vecs.tolist()) if j != i)
        want += [(i, j, -s) for s, j in scores[:k]]
    assert got == sorted(want)


def test_blocks_below_the_kth_are_not_scored(monkeypatch):
    rng = np.random.default_rng(0)
    vecs = np.floor(rng.normal(0, 40, (2048, 8)) * np.repeat(np.linspace(0.05, 3, 32), 64)[:, None])
    scored = []
    real = topk._score
    monkeypatch.setattr(topk, "_score", lambda a, b: scored.append(len(a) * len(b)) or real(a, b))
    topk.best_of_pack(np.array([-1]), vecs[-1:], np.arange(2048), vecs, 5)
    assert sum(scored) < 2048 * 0.75


def small_cells(monkeypatch):
    monkeypatch.setattr(topk, "CELL_BYTES", 64 * (2 * 16 + 8))
    monkeypatch.setattr(topk, "CELL_ROWS", 64)


def test_cells_of_the_grid_equal_brute_force(spark, monkeypatch):
    small_cells(monkeypatch)
    rnd = random.Random(2)
    rows = [(10 * i, [rnd.gauss(0, 0.2) for _ in range(16)]) for i in range(700)]
    rows += [(10 * i + 1, rows[i % 3][1]) for i in range(100)] + [(10 * i, rows[i][1]) for i in range(0, 100, 20)]
    grids = []
    real = topk._grid
    monkeypatch.setattr(topk, "_grid", lambda *a: grids.append(real(*a)) or grids[-1])
    assert run(spark, rows) == expected(rows, 5)
    assert grids[0][0] > 1 and grids[0][1] > 1


def test_nothing_is_broadcast(spark, monkeypatch):
    """Query packs dealt to every column are many times the queries; Spark took them for small and sent them through the driver."""
    small_cells(monkeypatch)
    rnd = random.Random(3)
    df = vectors(spark, [(i, [rnd.gauss(0, 0.2) for _ in range(16)]) for i in range(3000)])
    found = topk.search(df, df.where("vec_id % 50 = 0"), 5)
    assert len(found.collect()) == 300
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "isFinalPlan=true" in plan and "Broadcast" not in plan


def test_grid_stays_within_its_cells():
    for n, dims, parts in [(0, 1, 8), (1, 1, 200), (2000, 64, 8), (615_384, 64, 25), (615_384, 64, 600), (15_000_000, 64, 600), (10 ** 6, 4096, 200)]:
        asked = -(-n // 50)
        q_packs, columns = topk._grid(asked, n, dims, parts)
        row = 2 * dims + 8
        assert max(asked / q_packs, n / columns) * row <= topk.CELL_BYTES + row
        # shipped beyond the cells' bounds: no more queries to all columns than vectors to all query packs
        assert columns == -(-n * row // topk.CELL_BYTES) or (columns - 1) * asked <= n * q_packs


@settings(max_examples=60, deadline=None)
@given(st.integers(0, 2 ** 32), st.integers(1, 6), st.lists(st.tuples(st.integers(1, 150), st.sampled_from([3, 200, 2 ** 16, 2 ** 27])), min_size=1, max_size=5))
def test_packs_one_after_another(seed, k, sizes):
    """The k-th best score holds for the next pack; packs of other magnitudes and widths, rows of a query's own id in any of them."""
    rng = np.random.default_rng(seed)
    q_ids, q = np.array([1, 2, 500], np.int64), rng.integers(-3, 4, (3, 5)).astype(float) * rng.choice([1, 60, 2 ** 27])
    best, seen = topk._Best(q_ids, q, k), []
    for n, scale in sizes:
        ids = rng.integers(0, 40, n)
        vecs = rng.integers(-scale, scale, (n, rng.integers(0, 8))).astype(float)
        best.add(ids, topk._narrow(vecs))
        seen += [(i, [int(x) for x in v]) for i, v in zip(ids.tolist(), vecs)]
    want = []
    for i, v in zip(q_ids.tolist(), q):
        scores = sorted((-sum(int(a) * b for a, b in zip(v, w)), j) for j, w in seen if j != i)
        want += [(i, j, -s) for s, j in scores[:k]]
    assert sorted(zip(*(x.tolist() for x in best.rows()), strict=True)) == sorted(want)


def test_packed_numbers_come_back():
    for rows in ([[1, -2], [3, 159]], [[40_000, -1]], [[2.0 ** 40, -2.0 ** 31]], [[-2.0 ** 15]], np.zeros((3, 0)), np.zeros((0, 0))):
        rows = np.array(rows, dtype=float)
        narrow = topk._narrow(rows)
        assert (topk._wide(pa.py_buffer(narrow.tobytes()), *rows.shape) == rows).all()
