import random

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st

from assay.llm import links, setsketch

from .edge import EDGE, docs
from .test_jaccard import expected, near_copies


def run(spark, rows, **kw):
    return sorted(map(tuple, setsketch.near_duplicates(docs(spark, rows), **kw).collect()), key=str)


def wanted(rows, k=2, num=80, den=100):
    return sorted(((i, n, c, i == c) for i, n, c in expected(rows, k, num, den)), key=str)


def test_equals_brute_force(spark):
    rows = near_copies(3, 260) + EDGE
    assert run(spark, rows) == wanted(rows)


def test_other_shingles_and_shares(spark):
    rows = near_copies(4, 150)
    assert run(spark, rows, k=5, num=90) == wanted(rows, 5, 90)


def test_empty_table(spark):
    assert run(spark, []) == [] and run(spark, [(1, None), (2, "")]) == [(1, 0, 1, True), (2, 0, 2, True)]


def family(n, words, changed, seed=6):
    """Copies of one text with some words of each changed: some pairs link, some do not."""
    rnd = random.Random(seed)
    base = [f"b{i}" for i in range(words)]
    rows = []
    for i in range(n):
        text = list(base)
        for at in rnd.sample(range(words), rnd.choice(changed)):
            text[at] = f"c{i}x{at}"
        rows.append((i, " ".join(text)))
    return rows


def test_family_in_small_cells(spark, monkeypatch):
    monkeypatch.setattr(links, "CELL", 16)
    monkeypatch.setattr(links, "PART_PAIRS", 8)
    rows = family(160, 120, [2, 6, 9, 12])
    assert run(spark, rows) == wanted(rows)


def test_a_family_costs_comparisons_in_proportion(spark, monkeypatch):
    n = 400
    compared = []
    real = links.verified

    def counting(pairs, *args):
        compared.append(pairs.count())
        return real(pairs, *args)
    monkeypatch.setattr(links, "verified", counting)
    rows = family(n, 150, [1, 2, 3])
    got = run(spark, rows)
    assert {r[2] for r in got} == {0}
    assert sum(compared) < 2 * n


def random_sets(rng, n, shared):
    both = rng.integers(0, 2 ** 63, shared)
    return [np.unique(np.r_[both, rng.integers(0, 2 ** 63, m)].astype(np.uint64)) for m in n]


@settings(max_examples=40, deadline=None)
@given(st.integers(0, 2 ** 32), st.integers(0, 60), st.integers(0, 60), st.integers(0, 200))
def test_registers_merge(seed, x, y, shared):
    a, b = random_sets(np.random.default_rng(seed), (x, y), shared)
    ra, rb, union = setsketch.registers([a, b, np.union1d(a, b)])
    assert (setsketch.merge(ra, rb) == union).all()


def test_likelihood_finds_the_similarity():
    rng = np.random.default_rng(8)
    for shared, x, y in ((900, 50, 50), (500, 500, 100), (10, 400, 400), (300, 0, 300)):
        found = []
        for _ in range(20):
            a, b = random_sets(rng, (x, y), shared)
            ra, rb = setsketch.registers([a, b])
            like = setsketch.log_likelihoods(np.array([(ra > rb).sum()]), np.array([(ra < rb).sum()]), np.array([len(a)]), np.array([len(b)]))
            found.append(setsketch.GRID[like[0].argmax()])
        true = shared / (shared + x + y)
        assert abs(np.mean(found) - true) < 0.03


def test_linked_sets_share_a_band_and_pass():
    rng = np.random.default_rng(9)
    test = setsketch.may_link(80, 100)
    for n in (5, 10, 45, 90, 450, 3000):
        pairs = [random_sets(rng, (n // 10 if n >= 10 else 1, n // 10), n - 2 * (n // 10) if n >= 10 else 4) for _ in range(60)]
        pairs = [p for p in pairs if 100 * len(np.intersect1d(*p)) >= 80 * len(np.union1d(*p))]
        assert pairs
        for a, b in pairs:
            regs = setsketch.registers([a, b])
            keys = setsketch.bands(regs)
            assert (keys[0] == keys[1]).any()
            assert test(np.array([len(a)]), [setsketch.sketch(a, regs[0])], np.array([len(b)]), [setsketch.sketch(b, regs[1])])[0]


def test_unlike_sets_are_dropped():
    rng = np.random.default_rng(10)
    test = setsketch.may_link(80, 100)
    for _ in range(30):
        a, b = random_sets(rng, (200, 200), 300)        # 0.43
        regs = setsketch.registers([a, b])
        assert not test(np.array([len(a)]), [setsketch.sketch(a, regs[0])], np.array([len(b)]), [setsketch.sketch(b, regs[1])])[0]
