import hashlib
import random
import re

from assay.llm import decontam

from .edge import EDGE, PROSE, docs, lower, table

WORDS = re.compile("[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words(text):
    return WORDS.findall(lower(text or ""))


def expected(rows, bench):
    windows = {}
    for item, text in bench:
        w = words(text)
        if item is None:
            continue
        for s in [tuple(w[i:i + 10]) for i in range(len(w) - 9)] if len(w) >= 10 else [tuple(w)] if w else []:
            windows.setdefault(s, set()).add(item)
    out = []
    for i, text in rows:
        w, hit, items = words(text), set(), set()
        for n in {len(s) for s in windows}:
            for at in range(len(w) - n + 1):
                if (s := tuple(w[at:at + n])) in windows:
                    hit.update(range(at, at + n))
                    items |= windows[s]
        names = ",".join(sorted(map(str, items)))
        out.append((i, len(w), len(hit), len(items), hashlib.sha256(names.encode()).hexdigest(), bool(hit)))
    return sorted(out, key=str)


def bench_table(spark, bench):
    return table(spark, [(i, t, "x", "x") for i, t in bench], "item_id long, text string, window string, items string")


def run(spark, rows, bench):
    got = decontam.find_overlaps(docs(spark, rows), bench_table(spark, bench)).drop("text_hash")
    return sorted(map(tuple, got.collect()), key=str)


def random_case(seed, vocabulary):
    rnd = random.Random(seed)
    say = lambda n: " ".join(rnd.choice(vocabulary) for _ in range(n))
    bench = [(i, say(rnd.choice([1, 3, 9, 10, 11, 25, 40]))) for i in range(25)] + [(3, say(12)), (None, say(12)), (90, None), (91, "!")]
    rows = []
    for i in range(60):
        parts = [say(rnd.randrange(30))]
        for _ in range(rnd.randrange(3)):
            w = words(rnd.choice(bench)[1])
            a = rnd.randrange(len(w) + 1)
            parts += [" ".join(w[a:a + rnd.choice([5, 9, 10, 12, 40])]).upper(), say(rnd.randrange(8))]
        rows.append((i, " - ".join(parts)))
    return rows, bench


def test_equals_brute_force(spark):
    for seed, vocabulary in ((1, [f"w{i}" for i in range(60)]), (2, ["a", "b", "é"]), (3, ["same"])):
        rows, bench = random_case(seed, vocabulary)
        rows += EDGE
        assert run(spark, rows, bench) == expected(rows, bench)


def test_shuffled_join_gives_the_same(spark, monkeypatch):
    monkeypatch.setattr(decontam, "BROADCAST_BYTES", 0)
    rows, bench = random_case(4, [f"w{i}" for i in range(40)])
    assert run(spark, rows + EDGE, bench) == expected(rows + EDGE, bench)


def test_empty_tables(spark):
    assert run(spark, [], [(1, PROSE)]) == []
    assert run(spark, EDGE, []) == expected(EDGE, [])


def test_only_clean_documents_stay(spark):
    bench = [(1, " ".join(PROSE.split()[4:20])), (2, None)]
    df = docs(spark, EDGE)
    got = decontam.decontaminate(df, bench_table(spark, bench))
    assert got.columns == df.columns
    clean = sorted(((i, t) for i, t in EDGE if not expected([(i, t)], bench)[0][-1]), key=str)
    assert sorted(((r.doc_id, r.text) for r in got.collect()), key=str) == clean


def test_main_path_is_native(spark):
    rows, bench = random_case(5, ["a", "b"])
    plan = decontam.find_overlaps(docs(spark, rows), bench_table(spark, bench))._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Pandas|Arrow|Cartesian", plan)
