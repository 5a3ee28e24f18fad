"""Quality classifier: a byte-level convolutional network in numpy.

A text is cut into chunks of ``CHUNK`` bytes that overlap by ``CHUNK - STEP`` and cover all
of it.  Bytes get learned vectors; filters of 8 bytes, 4 apart, run over each chunk; a
filter's answer in a chunk is its largest (max-pooling).  A document is the mean and the
maximum of its chunks' answers, combined by a logistic layer into one probability.

The model is fitted (Adam, gradients by hand) in one task on a bounded sample of labelled rows: about
``SAMPLE_PER_CLASS`` documents per class, chosen by a hash of the id, with their whole texts.  A step
that meets a text of more than ``STEP_CHUNKS`` chunks draws as many of them afresh, from the whole text, so steps
stay equally long and no part of a text is left out for good.  Class weights restore the true shares.
Scoring has no bounds: every chunk of every text counts, chunks are taken in groups, so a
text may be of any length.

Defined results: null and empty texts have one empty chunk and get the score that the model
gives to no evidence; labels that are null or of unknown documents are ignored, and so are all labels of a doc_id
that contradict each other (repeated equal ones count once); without
labels of both classes the score is the share of label 1 (0.5 without any); rows are scored
each on its own; other columns are ignored.
"""

from __future__ import annotations

import io
import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

CHUNK, STEP = 512, 448
EMBED, FILTERS = 8, 24
SAMPLE_PER_CLASS = 2500
STEP_CHUNKS = 24        # chunks of a text in one training step
STEPS, BATCH, RATE = 1500, 48, 0.01
SCORE_CHUNKS = 512      # chunks scored at once
ACCEPT = 0.7

Model = dict[str, np.ndarray]


def chunk_starts(n_bytes: int) -> range:
    """Where the chunks of a text start; the last one reaches its end."""
    return range(0, max(1, n_bytes - (CHUNK - STEP)), STEP)


def chunk_of(data: bytes, start: int) -> tuple[np.ndarray, int]:
    out = np.zeros(CHUNK, np.uint8)
    part = np.frombuffer(data, np.uint8, count=min(CHUNK, len(data) - start), offset=start)
    out[:len(part)] = part
    return out, len(part)


def _answers(model: Model, chunks: np.ndarray, lengths: np.ndarray):
    """Filter outputs before pooling; 0 at places past the end of the text."""
    # a product per chunk, all of one shape: a chunk's answers do not depend on where it stands among others
    quads = model["embed"][chunks].reshape(len(chunks), CHUNK // 4, 4 * EMBED)
    both = quads @ model["filters"]
    z = both[:, :-1, :FILTERS] + both[:, 1:, FILTERS:] + model["bias"]
    np.maximum(z, 0, out=z)
    z *= (np.arange(CHUNK // 4 - 1) * 4 < lengths[:, None])[:, :, None]
    return z, quads


def pool(model: Model, chunks: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    return _answers(model, chunks, lengths)[0].max(axis=1)


def probability(model: Model, mean: np.ndarray, most: np.ndarray) -> np.ndarray:
    logit = (np.concatenate([mean, most], axis=1) * model["weights"]).sum(axis=1) + model["offset"]
    return 1.0 / (1.0 + np.exp(-np.clip(logit, -30, 30)))


def draw_chunks(data: bytes, rng: np.random.Generator) -> tuple[np.ndarray, np.ndarray]:
    """The chunks of a text for one step (chunks x CHUNK) and their lengths: all, or ``STEP_CHUNKS`` drawn from all."""
    starts = chunk_starts(len(data))
    if len(starts) > STEP_CHUNKS:
        starts = [starts[int(i)] for i in rng.choice(len(starts), STEP_CHUNKS, replace=False, shuffle=False)]
    cut_ = [chunk_of(data, s) for s in starts]
    return np.stack([c for c, _ in cut_]), np.array([n for _, n in cut_], np.int64)


def fit(texts: list[bytes], labels: np.ndarray, weights: np.ndarray, seed: int = 7) -> Model:
    """Fits the network to whole texts."""
    rng = np.random.default_rng(seed)
    share = float(np.average(labels, weights=weights)) if len(labels) else 0.5
    model: Model = {
        "embed": rng.normal(0, 0.5, (256, EMBED)).astype(np.float32),
        "filters": rng.normal(0, 1 / math.sqrt(8 * EMBED), (4 * EMBED, 2 * FILTERS)).astype(np.float32),
        "bias": np.zeros(FILTERS, np.float32), "weights": np.zeros(2 * FILTERS, np.float32),
        "offset": np.float32(math.log(max(share, 1e-3) / max(1 - share, 1e-3)) if len(labels) else 0.0)}
    if not len(labels) or not 0 < share < 1:
        return model
    model["weights"] = rng.normal(0, 0.1, 2 * FILTERS).astype(np.float32)
    first = {k: np.zeros_like(v) for k, v in model.items()}
    second = {k: np.zeros_like(v) for k, v in model.items()}
    order = np.zeros(0, np.int64)
    whole = {i: draw_chunks(t, rng) for i, t in enumerate(texts) if len(chunk_starts(len(t))) <= STEP_CHUNKS}
    for step in range(1, STEPS + 1):
        if not len(order):
            order = rng.permutation(len(labels))
        some, order = order[:BATCH], order[BATCH:]
        drawn = [whole[i] if i in whole else draw_chunks(texts[i], rng) for i in some.tolist()]
        grads = _gradients(model, [c for c, _ in drawn], [n for _, n in drawn], labels[some], weights[some])
        rate = RATE * (1 - (step - 1) / STEPS)
        for k, g in grads.items():
            first[k] = 0.9 * first[k] + 0.1 * g
            second[k] = 0.999 * second[k] + 0.001 * g * g
            model[k] = (model[k] - rate * (first[k] / (1 - 0.9 ** step))
                        / (np.sqrt(second[k] / (1 - 0.999 ** step)) + 1e-8)).astype(np.float32)
    return model


def _gradients(model: Model, chunks: list, lengths: list, labels: np.ndarray, weights: np.ndarray) -> Model:
    counts = np.array([len(c) for c in chunks])
    starts = np.r_[0, np.cumsum(counts)[:-1]]
    flat, size = np.concatenate(chunks), np.concatenate(lengths)
    doc = np.repeat(np.arange(len(counts)), counts)
    z, quads = _answers(model, flat, size)
    quads = quads.reshape(-1, 4 * EMBED)
    place = z.argmax(axis=1)
    pooled = np.take_along_axis(z, place[:, None, :], axis=1)[:, 0, :]
    mean = np.add.reduceat(pooled, starts, axis=0) / counts[:, None]
    most = np.maximum.reduceat(pooled, starts, axis=0)
    p = probability(model, mean, most)
    error = ((p - labels) * weights / len(labels)).astype(np.float32)
    features = np.concatenate([mean, most], axis=1)
    grads = {"weights": features.T @ error + 1e-4 * model["weights"], "offset": error.sum()}
    back = error[:, None] * model["weights"][None, :]
    d_pooled = (back[:, :FILTERS] / counts[:, None].astype(np.float32))[doc]
    d_pooled = d_pooled + back[doc, FILTERS:] * (pooled == most[doc])
    d_pooled *= pooled > 0
    grads["bias"] = d_pooled.sum(axis=0)
    # only the places that won the pooling get a gradient
    c, f = np.nonzero(d_pooled)
    at = c * (CHUNK // 4) + place[c, f]
    by_filter = np.zeros((len(c), FILTERS), np.float32)
    by_filter[np.arange(len(c)), f] = d_pooled[c, f]
    quad_bytes = flat.reshape(-1, 4)
    grads["filters"], grads["embed"] = np.zeros_like(model["filters"]), np.zeros_like(model["embed"])
    for half, shift in ((slice(0, FILTERS), 0), (slice(FILTERS, 2 * FILTERS), 1)):
        grads["filters"][:, half] = quads[at + shift].T @ by_filter
        d_quads = (by_filter @ model["filters"][:, half].T).reshape(-1, EMBED)
        byte = quad_bytes[at + shift].ravel()
        for e in range(EMBED):
            grads["embed"][:, e] += np.bincount(byte, weights=d_quads[:, e], minlength=256)
    return grads


def score_texts(model: Model, texts: list[str | None]) -> np.ndarray:
    """Probability of label 1 for each whole text."""
    total = np.zeros((len(texts), FILTERS))
    most = np.zeros((len(texts), FILTERS), np.float32)
    count = np.zeros(len(texts))
    buffer, size, owner = np.zeros((SCORE_CHUNKS, CHUNK), np.uint8), np.zeros(SCORE_CHUNKS, np.int64), []

    def flush() -> None:
        n = len(owner)
        if n:
            pooled, doc = pool(model, buffer[:n], size[:n]), np.array(owner)
            np.add.at(total, doc, pooled)
            np.maximum.at(most, doc, pooled)
            np.add.at(count, doc, 1)
            owner.clear()

    for i, text in enumerate(texts):
        data = (text or "").encode("utf-8", "surrogatepass")
        for start in chunk_starts(len(data)):
            buffer[len(owner)], size[len(owner)] = chunk_of(data, start)
            owner.append(i)
            if len(owner) == SCORE_CHUNKS:
                flush()
    flush()
    return probability(model, total / count[:, None], most)


# --------------------------------------------------------------------------
# on tables
# --------------------------------------------------------------------------

def _fit_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    texts, labels, weights = [], [], []
    for batch in batches:
        for text, label, weight in zip(*[c.to_pylist() for c in batch.columns], strict=True):
            texts.append((text or "").encode("utf-8", "surrogatepass"))
            labels.append(label)
            weights.append(weight)
    model = fit(texts, np.array(labels, np.float64), np.array(weights, np.float64))
    out = io.BytesIO()
    np.savez(out, **model)
    yield pa.RecordBatch.from_arrays([pa.array([out.getvalue()], pa.binary())], names=["model"])


def train(docs: DataFrame, labels: DataFrame, per_class: int = SAMPLE_PER_CLASS) -> Model:
    """The network fitted to ``labels(doc_id, label 0/1)`` of ``docs(doc_id, text)``.

    About ``per_class`` labelled documents of each class are drawn by a hash of
    their id; only their ids are broadcast (twice that many at most, about).
    """
    known = labels.select("doc_id", F.col("label").cast("int").alias("label")) \
        .where(F.col("label").isin(0, 1) & F.col("doc_id").isNotNull()) \
        .groupBy("doc_id").agg(F.min("label").alias("label"), F.max("label").alias("most")).where("label = most").drop("most")
    n = {r["label"]: r["n"] for r in known.groupBy("label").agg(F.count(F.lit(1)).alias("n")).collect()}
    total = sum(n.values())
    draw, weight = F.lit(0), F.lit(0.0)
    for label, count in n.items():
        share = min(1.0, per_class / count)
        taken = min(count, per_class)
        draw = F.when(F.col("label") == label, math.ceil(1_000_000 * share)).otherwise(draw)
        # weighted so that each class counts as much as it does among all labels
        weight = F.when(F.col("label") == label, count / total / (taken / sum(min(c, per_class) for c in n.values()))).otherwise(weight)
    sample = known.where(F.pmod(F.xxhash64("doc_id"), F.lit(1_000_000)) < draw).withColumn("weight", weight)
    rows = docs.select("doc_id", "text").join(F.broadcast(sample), "doc_id").select("doc_id", "text", "label", "weight")
    found = rows.repartition(1).sortWithinPartitions("doc_id", "text").select("text", "label", "weight") \
        .mapInArrow(_fit_rows, "model binary").collect()
    if not found:
        return fit([], np.zeros(0), np.zeros(0))
    with np.load(io.BytesIO(bytes(found[0]["model"]))) as saved:
        return {k: saved[k] for k in saved.files}


def score(docs: DataFrame, model: Model) -> DataFrame:
    """``doc_id, score`` of every row."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array(score_texts(model, part.column(1).to_pylist()), pa.float64())],
                    names=["doc_id", "score"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id {kind}, score double")


def keep_good(docs: DataFrame, model: Model, accept: float = ACCEPT) -> DataFrame:
    """The rows of ``docs`` with a score of ``accept`` or more, unchanged."""
    @F.pandas_udf("double")
    def scores(text: pd.Series) -> pd.Series:
        return pd.Series([x for at in range(0, len(text), 256) for x in score_texts(model, list(text[at:at + 256]))],
                         dtype="float64")

    return docs.where(scores("text") >= accept)


def training_labels(labels: DataFrame) -> DataFrame:
    """Quality labels outside the held-out fold."""
    return labels.where(~held_out()).select("doc_id", F.col("quality").alias("label"))


def held_out():
    return F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4 == 2, F.lit(False))
