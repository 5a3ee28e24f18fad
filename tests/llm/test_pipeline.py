"""The corpus pipeline, stage by stage on its own input, against brute force."""

import random

import pytest

import corpus_pipeline
from assay.llm import quality

from . import test_decontam, test_jaccard, test_linededup
from .edge import EDGE, docs

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def corpus(seed=3):
    """Prose, junk, near and exact copies, shared lines and benchmark passages, and the awkward rows."""
    rnd = random.Random(seed)
    word = lambda: "".join(rnd.choice(["th", "an", "re", "on", "er", "in"]) for _ in range(rnd.randrange(1, 4)))
    say = lambda n: [word() for _ in range(n)]
    bench = [(i, " ".join(say(18))) for i in range(8)]
    shared = [" ".join(say(12)) for _ in range(4)]
    rows, labels = [], []
    for i in range(240):
        kind = i % 8
        words = say(rnd.randrange(30, 120))
        if kind == 1:
            words = [w + "###" for w in words]
        if kind == 2 and rows:
            words = (rnd.choice(rows)[1] or "a").split(" ")
            words[rnd.randrange(len(words))] = "changed"
        text = " ".join(words)
        if kind == 3:
            text += "\n" + rnd.choice(shared) + "\n" + " ".join(say(9))
        if kind == 4:
            text += " " + " ".join(rnd.choice(bench)[1].split()[3:16]).upper()
        rows.append((i, text))
        labels.append((i, int(kind != 1), 0))
    return rows + [(1000 + (i or 0), t) if i is not None else (i, t) for i, t in EDGE], labels, bench


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("corpus"))
    rows, labels, bench = corpus()
    docs(spark, rows, clash=False).write.parquet(f"{path}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{path}/labels.parquet")
    spark.createDataFrame(bench, "item_id long, text string").write.parquet(f"{path}/benchmark.parquet")
    return path, bench


def pairs(df):
    return sorted(((r.doc_id, r.text) for r in df.collect()), key=str)


def test_every_stage_equals_brute_force(spark, folder, scratch):
    path, bench = folder
    stages = dict(corpus_pipeline.STAGES)
    assert list(stages) == ["quality", "lines", "near", "benchmark", "tokens"]
    table = spark.read.parquet(f"{path}/documents.parquet")

    def step(name, df):
        out = f"{scratch}/{name}"
        stages[name](spark, df, path).write.parquet(out)
        return spark.read.parquet(out)

    good = step("quality", table)
    model = quality.train(table, quality.training_labels(spark.read.parquet(f"{path}/labels.parquet")))
    scores = {(r.doc_id, r.text): quality.score_texts(model, [r.text])[0] for r in table.collect()}
    assert pairs(good) == sorted((k for r in table.collect() if scores[k := (r.doc_id, r.text)] >= 0.7), key=str)

    lines = step("lines", good)
    assert pairs(lines) == sorted(((i, t) for i, t, _ in test_linededup.expected(pairs(good), 40, 5)), key=str)

    near = step("near", lines)
    stay = {i for i, _, c in test_jaccard.expected(pairs(lines), 5, 80, 100) if i == c}
    assert pairs(near) == [x for x in pairs(lines) if x[0] in stay]
    assert len(pairs(near)) < len(pairs(lines))

    clean = step("benchmark", near)
    want = [x for x in pairs(near) if not test_decontam.expected([x], bench)[0][-1]]
    assert pairs(clean) == want and len(want) < len(pairs(near))
    for df in (good, lines, near, clean):
        assert df.columns == COLUMNS

    from tokenizers import Tokenizer
    library = Tokenizer.from_file(corpus_pipeline.TOKENIZER)
    tokens = step("tokens", clean)
    want = sorted(((i, tuple(library.encode(t or "", add_special_tokens=False).ids)) for i, t in want), key=str)
    assert sorted(((r.doc_id, tuple(r.token_ids)) for r in tokens.collect()), key=str) == want
    assert all(r.n_tokens == len(r.token_ids) for r in tokens.collect())

    whole = corpus_pipeline.run(spark, path)
    assert sorted(((r.doc_id, tuple(r.token_ids)) for r in whole.collect()), key=str) == want


def test_empty_tables(spark, scratch):
    docs(spark, [], clash=False).write.parquet(f"{scratch}/documents.parquet")
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(f"{scratch}/labels.parquet")
    spark.createDataFrame([], "item_id long, text string").write.parquet(f"{scratch}/benchmark.parquet")
    assert corpus_pipeline.run(spark, scratch).collect() == []


def test_registered():
    import __spark_entry__ as E
    names = E.queries()
    assert names["pipeline"] is corpus_pipeline.run
    for n in range(1, 14):
        assert sum(name.startswith(f"op{n}_") for name in names) == 1
