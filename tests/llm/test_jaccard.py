import itertools
import random
import re

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

import numpy as np
import pyarrow as pa

from assay.llm import jaccard, links
from assay.llm.shingles import shingle_sets

from .edge import EDGE, docs, lower

WORDS = re.compile(r"[^\x20\x09-\x0D]+")


def shingles(text, k):
    w = WORDS.findall(lower(text or ""))
    return frozenset(tuple(w[i:i + k]) for i in range(len(w) - k + 1)) if len(w) >= k else frozenset([tuple(w)] if w else [])


def expected(rows, k, num, den):
    sets = [(i, shingles(t, k)) for i, t in rows]
    parent = {i: i for i, _ in rows}

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for (i, a), (j, b) in itertools.combinations([x for x in sets if x[0] is not None and x[1]], 2):
        if den * len(a & b) >= num * len(a | b):
            x, y = sorted((root(i), root(j)))
            parent[y] = x
    return sorted(((i, len(s), None if i is None else root(i)) for i, s in sets), key=str)


def near_copies(seed, n, vocabulary=400):
    """Texts around a few bases, some words changed, added or cut; small and large, some equal."""
    rnd = random.Random(seed)
    bases = [[f"w{rnd.randrange(vocabulary)}" for _ in range(rnd.choice([3, 8, 12, 19, 21, 30, 45, 90, 200, 400]))] for _ in range(12)]
    rows = []
    for i in range(n):
        words = list(rnd.choice(bases))
        for _ in range(rnd.choice([0, 0, 1, 1, 2, 3, 6])):
            at = rnd.randrange(len(words))
            words[at:at + rnd.choice([0, 1, 1])] = [f"x{rnd.randrange(50)}"] * rnd.choice([0, 1, 1])
            words = words or ["x"]
        rows.append((i * 3, " ".join(words)))
    return rows


@pytest.mark.parametrize("k,num,den", [(3, 90, 100), (5, 80, 100), (2, 50, 100), (1, 100, 100)])
def test_components_equal_brute_force(spark, k, num, den):
    rows = near_copies(k, 220) + EDGE
    got = jaccard.components(docs(spark, rows), k, num, den).collect()
    assert sorted(map(tuple, got), key=str) == expected(rows, k, num, den)


def family(n, changed):
    rnd = random.Random(5)
    base = [f"b{i}" for i in range(150)]
    rows = []
    for i in range(n):
        words = list(base)
        for at in rnd.sample(range(150), rnd.randrange(changed)):
            words[at] = f"c{i}x{at}"
        rows.append((i, " ".join(words)))
    return rows


def test_large_family_is_compared_in_cells(spark, monkeypatch):
    monkeypatch.setattr(links, "CELL", 16)
    monkeypatch.setattr(links, "PART_PAIRS", 8)
    rows = family(150, 9)
    assert sorted(map(tuple, jaccard.components(docs(spark, rows)).collect()), key=str) == expected(rows, 3, 90, 100)


def test_a_family_costs_comparisons_in_proportion(spark, monkeypatch):
    n = 500
    compared = []
    real = links.verified

    def counting(pairs, *args):
        compared.append(pairs.count())
        return real(pairs, *args)
    monkeypatch.setattr(links, "verified", counting)
    got = jaccard.components(docs(spark, family(n, 3))).collect()       # two thirds of the pairs do not link
    assert {r.component_id for r in got} == {0} and sum(compared) < 60 * n     # all pairs: 250 * n


def test_a_shared_passage_is_not_scanned(spark):
    """Documents with a passage in common list their own shingles, not the passage's."""
    rnd = random.Random(8)
    passage = " ".join(f"p{i}" for i in range(60))
    rows = [(i, " ".join(f"w{rnd.randrange(10 ** 9)}" for _ in range(60)) + " " + passage) for i in range(300)]
    rarity, sizes = jaccard.survey(docs(spark, rows).select("text"), 3)
    rule, met = jaccard.Rule(3, 90, 100), set()
    own = next(shingle_sets(pa.array([passage]), 3))
    hidden = {int(x) for x in jaccard.mix(own ^ jaccard.U(0x3C79AC492BA7B653))}
    for s in shingle_sets(pa.array([t for _, t in rows]), 3):
        met |= {int(x) for x in jaccard._list_entries(rule, s, rarity)} & hidden
    assert not met and sizes == {118: 300}


def test_empty_table(spark):
    assert jaccard.components(docs(spark, [])).collect() == []
    assert jaccard.one_per_group(docs(spark, [])).collect() == []


def test_one_of_each_group_stays(spark):
    rows = near_copies(2, 60) + EDGE
    df = docs(spark, rows)
    got = jaccard.one_per_group(df)
    assert got.columns == df.columns
    want = sorted((i for i, _, c in expected(rows, 5, 80, 100) if i == c), key=str)
    assert sorted((r.doc_id for r in got.collect()), key=str) == want


texts = st.lists(st.text(alphabet="ab A\t\n\x0b é日Z", max_size=30) | st.none(), max_size=12)


@settings(max_examples=150, deadline=None)
@given(texts, st.integers(1, 4))
def test_shingle_sets_have_the_right_sizes_and_overlaps(rows, k):
    got = list(shingle_sets(pa.array(rows, pa.string()), k))
    want = [shingles(t, k) for t in rows]
    assert [len(s) for s in got] == [len(s) for s in want]
    for i, j in itertools.combinations(range(len(rows)), 2):
        assert len(np.intersect1d(got[i], got[j])) == len(want[i] & want[j])


@settings(max_examples=150, deadline=None)
@given(st.integers(0, 2 ** 32), st.sampled_from([(90, 100), (80, 100), (60, 100)]), st.integers(1, 120))
def test_linked_sets_share_an_entry(seed, share, n):
    """The guarantee behind the join: no linked pair without a common entry."""
    rng = np.random.default_rng(seed)
    rule = jaccard.Rule(3, *share)
    a = np.unique(rng.integers(0, 2 ** 63, n).astype(np.uint64))
    spare = rule.den * len(a) // rule.num - len(a)
    gone = rng.integers(0, len(a) - -(-rule.num * len(a) // rule.den) + 1)
    extra = rng.integers(0, spare + 1)
    b = np.unique(np.r_[a[gone:], rng.integers(0, 2 ** 63, extra).astype(np.uint64)])
    both, either = len(np.intersect1d(a, b)), len(np.union1d(a, b))
    if not len(b) or rule.den * both < rule.num * either:
        return
    rarity = rng.integers(0, 4, 1 << jaccard.RARITY_BITS).astype(np.uint8)
    assert np.intersect1d(jaccard._list_entries(rule, a, rarity), jaccard._list_entries(rule, b, rarity)).size
    if max(len(a), len(b)) < 16:
        assert np.intersect1d(jaccard._subset_entries(rule, a), jaccard._subset_entries(rule, b)).size
    for boundary in (1, 9, 13):
        assert np.intersect1d(jaccard.entries(rule, a, boundary, rarity), jaccard.entries(rule, b, boundary, rarity)).size


def test_rarity_adds_up_over_tasks(spark):
    texts = ["a b c d", "a b c", "x y z", None, "", "a b"] * 40
    df = docs(spark, list(enumerate(texts)), clash=False).select("text")
    rarity, sizes = jaccard.survey(df.repartition(7), 3)
    assert sizes == {2: 40, 1: 120}
    at = {name: jaccard._counter(next(shingle_sets(pa.array([name]), 3)))[0] for name in ("a b c", "b c d", "x y z", "q r s")}
    seen = {name: float(jaccard._from_byte(rarity[i:i + 1])[0]) for name, i in at.items()}
    assert abs(seen["a b c"] - 80) < 16 and abs(seen["b c d"] - 40) < 9 and abs(seen["x y z"] - 40) < 9 and seen["q r s"] == 0
    assert not jaccard.survey(df.where("false"), 3)[0].any()


@settings(max_examples=200, deadline=None)
@given(st.integers(0, 2 ** 32), st.integers(1, 300), st.integers(0, 60), st.integers(0, 60))
def test_sketch_never_rejects_a_link(seed, n, gone, extra):
    rng = np.random.default_rng(seed)
    rule = jaccard.Rule(3, 80, 100)
    a = np.unique(rng.integers(0, 2 ** 63, n).astype(np.uint64))
    b = np.unique(np.r_[a[gone:], rng.integers(0, 2 ** 63, extra).astype(np.uint64)])
    both, either = len(np.intersect1d(a, b)), len(np.union1d(a, b))
    test = jaccard.may_link(rule)

    def possible(x, y):
        return test(np.array([len(x)] * 2), [links.counts(x).tobytes()] * 2, np.array([len(y)] * 2), [links.counts(y).tobytes()] * 2).all()
    if len(b) and rule.den * both >= rule.num * either:
        assert possible(a, b)
    other = np.unique(rng.integers(0, 2 ** 63, n).astype(np.uint64))
    if n > 150:
        assert not possible(a, other)


def test_boundary_follows_cost():
    rule = jaccard.Rule(3, 90, 100)
    small = jaccard.choose_boundary(rule, {n: 100 for n in range(1, 15)})
    large = jaccard.choose_boundary(rule, {n: 100 for n in range(60, 128)})
    assert small >= 9 and large <= 60
    assert rule.subset_rows(9) <= 10 and rule.subset_rows(60) > 10_000 > rule.prefix(60)


def test_sketches_travel_packed():
    """A sketch goes to a cell with every list its set is in: it takes less than half its bytes, and comes back whole."""
    sketches = [links.counts(np.random.default_rng(n).integers(0, 1 << 63, n).astype(np.uint64)).tobytes() for n in (1, 30, 300, 900, 5000)]
    rows = [links.pack(s) for s in sketches]
    assert links.unpack(pa.array(rows, pa.binary())) == sketches
    assert all(2 * len(r) < len(s) for r, s in zip(rows[2:4], sketches[2:4], strict=True))
