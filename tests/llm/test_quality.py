import random

import numpy as np

from assay.llm import quality

from .edge import EDGE, docs, table

LABELS = "doc_id long, quality int, toxic int, label int"


def corpus(n, seed=1):
    rnd = random.Random(seed)
    rows, labels = [], []
    for i in range(n):
        words = ["".join(rnd.choice(["th", "an", "re", "on", "er"]) for _ in range(rnd.randrange(1, 4)))
                 for _ in range(rnd.randrange(5, 250))]
        good = i % 3 != 0
        at = rnd.randrange(len(words))
        if not good:
            words[at:at + 20] = [w + "$$$" for w in words[at:at + 20]]
        rows.append((i, " ".join(words)))
        labels.append((i, int(good), 0, 5))
    return rows, labels


def test_learns_held_out_labels(spark):
    rows, labels = corpus(500)
    df, known = docs(spark, rows), table(spark, labels, LABELS)
    model = quality.train(df, quality.training_labels(known))
    got = {r.doc_id: r.score for r in quality.score(df, model).collect()}
    held = {r.doc_id for r in known.where(quality.held_out()).collect()}
    assert 60 < len(held) < 200
    right = [(got[i] >= quality.ACCEPT) == bool(q) for i, q, *_ in labels if i in held]
    assert sum(right) / len(right) > 0.95
    kept = quality.keep_good(df, model)
    assert kept.columns == df.columns
    assert {r.doc_id for r in kept.collect()} == {i for i, s in got.items() if s >= quality.ACCEPT}


def test_awkward_rows(spark):
    rows, labels = corpus(60)
    model = quality.train(docs(spark, rows), table(spark, [*[(i, q) for i, q, *_ in labels], (None, 1), (1, None), (999, 0)],
                                                   "doc_id long, label int"))
    got = quality.score(docs(spark, EDGE + [(300, "z" * 3_000_000)]), model).collect()
    assert len(got) == len(EDGE) + 1 and all(0 <= r.score <= 1 for r in got)
    by_id = {r.doc_id: r.score for r in got}
    assert by_id[1] == by_id[2]                     # null as empty
    assert len({r.score for r in got if r.doc_id == 5}) == 1
    assert quality.score(docs(spark, []), model).collect() == []


def test_without_labels(spark):
    rows, _ = corpus(10)
    for labels, share in ([], 0.5), ([(1, 1)], 1.0):
        model = quality.train(docs(spark, rows), table(spark, labels, "doc_id long, label int"))
        scores = {round(r.score, 2) for r in quality.score(docs(spark, rows), model).collect()}
        assert scores == {share}


def test_contradictory_labels_are_left_out(spark):
    rows, labels = corpus(90)
    pairs = [(i, q) for i, q, *_ in labels]
    clear, clash = pairs[:60], [(i, 1 - q) for i, q in pairs[60:]]
    plain, mixed = (quality.train(docs(spark, rows), table(spark, x, "doc_id long, label int"))
                    for x in (clear, clear + clear[:9] + pairs[60:] + clash))
    assert all(np.array_equal(plain[k], mixed[k]) for k in plain)


def test_draws_come_from_the_whole_text():
    data = b"".join(bytes([i]) * quality.STEP for i in range(200)) + b"z" * (quality.CHUNK - quality.STEP)
    rng = np.random.default_rng(3)
    seen = set()
    for _ in range(120):
        chunks, lengths = quality.draw_chunks(data, rng)
        assert chunks.shape == (quality.STEP_CHUNKS, quality.CHUNK) and (lengths == quality.CHUNK).all()
        first = chunks[:, 0].tolist()
        assert len(set(first)) == len(first)
        seen.update(first)
    assert seen == set(range(200))


def test_scores_equal_a_plain_forward_pass():
    rng = np.random.default_rng(5)
    model = quality.fit([], np.zeros(0), np.zeros(0))
    model = {k: rng.normal(0, 0.3, np.shape(v)).astype(np.float64) for k, v in model.items()}
    n = quality.FILTERS

    def plain(text):
        data = (text or "").encode()
        answers, start = [], 0
        while True:
            part = data[start:start + 512]
            best = [0.0] * n
            for at in range(0, 512 - 4, 4):
                if at >= len(part):
                    break
                window = [part[at + i] if at + i < len(part) else 0 for i in range(8)]
                vector = np.concatenate([model["embed"][b] for b in window])
                kernel = np.concatenate([model["filters"][:, :n], model["filters"][:, n:]])
                z = vector @ kernel + model["bias"]
                best = [max(b, v) for b, v in zip(best, z, strict=True)]
            answers.append(best)
            if start + 512 >= len(data):
                break
            start += 448
        pooled = np.array(answers)
        logit = float(np.r_[pooled.mean(axis=0), pooled.max(axis=0)] @ model["weights"] + model["offset"])
        return 1 / (1 + np.exp(-min(max(logit, -30), 30)))

    texts = [None, "", "a", "abcd", "é日本 \U0001f600" * 9, "x" * 511, "word " * 103, "q" * 512, "r" * 513, "some text " * 300]
    assert np.allclose(quality.score_texts(model, texts), [plain(t) for t in texts], rtol=1e-6)


def test_chunks_cover_every_byte():
    for n in [0, 1, 511, 512, 513, 959, 960, 961, 5000]:
        covered = np.zeros(n, bool)
        for s in quality.chunk_starts(n):
            covered[s:s + quality.CHUNK] = True
            assert s < max(n, 1)
        assert covered.all()


def test_gradients_are_right():
    rng = np.random.default_rng(0)
    model = quality.fit([], np.zeros(0), np.zeros(0))
    model = {k: rng.normal(0, 0.3, np.shape(v)).astype(np.float64) for k, v in model.items()}
    chunks = [rng.integers(0, 256, (n, quality.CHUNK), dtype=np.uint8) for n in (1, 3)]
    lengths = [np.full(len(c), quality.CHUNK) for c in chunks]
    labels, weights = np.array([1.0, 0.0]), np.array([1.0, 2.0])

    def loss(m):
        pooled = [quality.pool(m, c, n) for c, n in zip(chunks, lengths)]
        p = quality.probability(m, np.array([x.mean(0) for x in pooled]), np.array([x.max(0) for x in pooled]))
        return -np.mean(weights * (labels * np.log(p) + (1 - labels) * np.log(1 - p))) + 0.5e-4 * (m["weights"] ** 2).sum()

    grads = quality._gradients(model, chunks, lengths, labels, weights)
    for name in ("weights", "filters", "bias", "embed", "offset"):
        value = np.asarray(model[name])
        at = tuple(rng.integers(0, s) for s in value.shape) if name != "embed" else (int(chunks[1][0, 7]), 2)
        moved = {k: np.array(v) for k, v in model.items()}
        moved[name][at] += 1e-6
        slope = (loss(moved) - loss(model)) / 1e-6
        assert abs(slope - np.asarray(grads[name])[at]) < 1e-3 * max(1, abs(slope))
