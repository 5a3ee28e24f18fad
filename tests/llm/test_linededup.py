import collections
import random

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st

from assay.llm import linededup

from .edge import EDGE, docs, lower

STRIP = " \t\n\x0b\x0c\r"


def expected(rows, min_chars, min_docs):
    holders = collections.defaultdict(set)
    for i, t in rows:
        for line in (t or "").split("\n"):
            if i is not None and len(key := lower(line.strip(STRIP))) >= min_chars:
                holders[key].add(i)
    out = []
    for i, t in rows:
        keep = []
        for line in (t or "").split("\n"):
            at = holders.get(lower(line.strip(STRIP)), ())
            if i is None or len(at) < min_docs or max(at) == i:
                keep.append(line)
        out.append((i, None if t is None else "\n".join(keep), len((t or "").split("\n")) - len(keep)))
    return sorted(out, key=str)


def some_rows(seed, n, lines=40):
    rnd = random.Random(seed)
    pool = [f"line number {j} of the pool é {'X' * (j % 5)}" for j in range(lines)]
    rows = []
    for i in range(n):
        own = [f"only in document {i}, written here once"]
        text = [rnd.choice([str.upper, str.lower, lambda s: f" \t{s}\r"])(rnd.choice(pool)) for _ in range(rnd.randrange(9))]
        rows.append((rnd.randrange(n), "\n".join(text + own * rnd.randrange(3) + ["the line that all documents share, ever"])))
    return rows


def run(spark, rows, min_chars=10, min_docs=5):
    df = docs(spark, rows)
    done = linededup.with_kept_text(df, linededup.keep_bitmaps(df, min_chars, min_docs)).collect()
    return sorted(((r.row.doc_id, r.kept, r.n_dropped) for r in done), key=str)


def test_equals_brute_force(spark):
    for seed in range(2):
        rows = some_rows(seed, 150) + EDGE
        assert run(spark, rows) == expected(rows, 10, 5)


def test_long_runs_over_many_partitions(spark):
    """One line in every document, more partitions than distinct lines: runs straddle partitions."""
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "37")
    try:
        rows = [(i, "the same line in all of them\nand one more that they share") for i in range(400)]
        assert run(spark, rows) == expected(rows, 10, 5)
        rows = [(i, "the same line in all of them") for i in range(4)] + [(9, "another line that is alone")]
        assert run(spark, rows) == expected(rows, 10, 5)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)


def test_contract_limits(spark):
    at, below = "x" * 40, "y" * 39
    rows = [(i, f"{at}\n{below}\n{below} \nz") for i in range(5)] + [(9, "w" * 50)] * 6
    assert run(spark, rows, 40, 5) == expected(rows, 40, 5)


def test_documents_keep_their_columns(spark):
    df = docs(spark, some_rows(3, 80) + EDGE)
    got = linededup.dedup_lines(df)
    assert got.columns == df.columns and got.count() == df.count()
    for r in got.collect():
        assert r.n_chars == (None if r.text is None else len(r.text))
    assert linededup.dedup_lines(docs(spark, [])).collect() == []


@settings(max_examples=50, deadline=None)
@given(st.lists(st.booleans(), min_size=1, max_size=400))
def test_bitmap_round_trip(keep):
    dropped = np.flatnonzero(~np.array(keep))
    assert linededup.unpack_bitmap(linededup.pack_bitmap(len(keep), dropped), len(keep)).tolist() == keep
    text = "\n".join(map(str, range(len(keep))))
    assert linededup.apply_bitmap(text, linededup.pack_bitmap(len(keep), dropped)) == \
        "\n".join(str(i) for i, k in enumerate(keep) if k)
