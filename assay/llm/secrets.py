"""Secret scans, in DataFrame functions only: base patterns plus character Markov models.

Base patterns (fixed by contract) find assignments, access keys and hex runs.  The method
adds tokens that look random: two first-order Markov models over the characters of
``ALPHABET``, one of random strings and one of ordinary identifiers, are trained from
labelled samples, and a token is reported where the log-likelihood ratio of the two,
summed over its characters, is at least ``threshold``.

Spans are code points, end exclusive, of the whole match.

Defined results: null and empty texts have no spans; every row is scanned on its own, so
repeated rows and ids give repeated results; other columns are ignored.  Without samples of
either label every token scores 0 and the models add nothing.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import running_total

# The base patterns.
ASSIGN = r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = "AKIA[A-Z0-9]+"
HEX = "[0-9a-f]+"
KINDS = ["assign", "access", "hex", "markov"]

ALPHABET = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_=-"
TOKEN_CHAR = "[A-Za-z0-9+/_=-]"
MIN_TOKEN = 16          # shortest token that the models judge
MIN_SAMPLE = 4          # shortest token that they learn from
THRESHOLD = 10.0        # nats in favour of "random"
SAMPLE_DOCS = 2000      # documents (about) that the query's training sample is drawn from

SPAN = "array<struct<start:bigint,end:bigint,kind:int>>"


def _empty() -> Column:
    return F.array().cast(SPAN)


def _located(text: str, pattern: str) -> list[Column]:
    """Lengths of the pieces between matches, and the matches; null where nothing matches."""
    has = F.col(text).rlike(pattern)
    pieces = F.when(has, F.transform(F.split(text, pattern, -1), lambda x: F.length(x)))
    return [pieces, F.when(has, F.regexp_extract_all(text, F.lit(pattern), F.lit(0)))]


def _spans(hits: str, kind: int) -> Column:
    """All matches as spans, from where they end."""
    return F.when(F.col(hits).isNull(), _empty()).otherwise(F.zip_with(
        f"{hits}_ends", hits, lambda e, h: F.struct(
            (e - F.length(h)).alias("start"), e.alias("end"), F.lit(kind).alias("kind")))).cast(SPAN)


def _ends(pieces: str, hits: str) -> Column:
    """Where the matches end, from the lengths of what lies between and within them."""
    steps = F.zip_with(F.slice(pieces, F.lit(1), F.size(hits)), hits, lambda p, h: p + F.length(h))
    return F.when(F.col(hits).isNotNull(), running_total(steps))


def _with_spans(df: DataFrame, name: str, pattern: str, kind: int) -> DataFrame:
    pieces, hits = _located("text", pattern)
    df = df.withColumns({f"{name}_pieces": pieces, f"{name}_hits": hits})
    df = df.withColumn(f"{name}_hits_ends", _ends(f"{name}_pieces", f"{name}_hits"))
    return df.withColumn(f"{name}_all", _spans(f"{name}_hits", kind))


# --------------------------------------------------------------------------
# models
# --------------------------------------------------------------------------

def _codes(token: Column) -> Column:
    """Places of a token's characters in ``ALPHABET``, from 0."""
    return F.transform(F.split(token, ""), lambda c: F.instr(F.lit(ALPHABET), c) - 1)


def _pairs(codes: Column) -> Column:
    k = len(ALPHABET)
    return F.zip_with(F.slice(codes, F.lit(1), F.size(codes) - 1), F.slice(codes, F.lit(2), F.size(codes) - 1),
                      lambda a, b: a * k + b)


def train(samples: DataFrame) -> list[float]:
    """Log-likelihood ratios of the character pairs, from ``samples(token, random boolean)``.

    Transition counts per label are one aggregate; at most 2 x |alphabet|^2 rows
    come back.  Add-one smoothing per preceding character.
    """
    k = len(ALPHABET)
    counts = samples.where(F.col("token").rlike(f"^{TOKEN_CHAR}{{2,}}$")) \
        .select("random", _codes(F.col("token")).alias("c")) \
        .select("random", F.explode_outer(_pairs(F.col("c"))).alias("pair")) \
        .groupBy("random", "pair").agg(F.count(F.lit(1)).alias("n")).collect()
    table = {True: [0] * (k * k), False: [0] * (k * k)}
    for r in counts:
        if r["random"] is not None:
            table[r["random"]][r["pair"]] = r["n"]
    if not any(table[True]) or not any(table[False]):
        return [0.0] * (k * k)
    out = []
    for a in range(k):
        rows = {label: t[a * k:(a + 1) * k] for label, t in table.items()}
        total = {label: sum(x) + k for label, x in rows.items()}
        out += [math.log((r + 1) / total[True]) - math.log((o + 1) / total[False])
                for r, o in zip(rows[True], rows[False], strict=True)]
    return out


def labelled_samples(docs: DataFrame, sample_docs: int = SAMPLE_DOCS) -> DataFrame:
    """``(token, random)`` from about ``sample_docs`` documents, chosen by the hash of their id.

    Random: values that the base patterns match, and digests of the ids in base
    64 and hex.  Ordinary: every other token of those texts.  The bound is a
    parameter; it limits training only, never what is scanned.
    """
    n = docs.count()
    share = math.ceil(1_000_000 * min(1.0, sample_docs / max(n, 1)))
    some = docs.where(F.pmod(F.xxhash64("doc_id"), F.lit(1_000_000)) < share) \
        .select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    digest = F.sha2(F.coalesce(F.col("doc_id").cast("string"), F.lit("")), 256)
    found = F.concat(
        F.filter(F.regexp_extract_all("text", F.lit(ASSIGN), F.lit(2)), lambda v: F.length(v) >= 12),
        F.regexp_extract_all("text", F.lit(f"{ACCESS}"), F.lit(0)),
        F.regexp_extract_all("text", F.lit("[0-9a-f]{16,}"), F.lit(0)),
        F.array(F.base64(F.unhex(digest)), digest))
    rest = F.regexp_replace(F.regexp_replace("text", ASSIGN, " "), f"{ACCESS}|[0-9a-f]{{16,}}", " ")
    ordinary = F.regexp_extract_all(rest, F.lit(f"{TOKEN_CHAR}{{{MIN_SAMPLE},}}"), F.lit(0))
    return some.select(F.explode_outer(found).alias("token"), F.lit(True).alias("random")).unionAll(
        some.select(F.explode_outer(ordinary).alias("token"), F.lit(False).alias("random"))) \
        .where(F.col("token").isNotNull())


def score(token: Column, ratios: list[float]) -> Column:
    """Log-likelihood ratio of a token: random against ordinary."""
    table = F.split(F.lit(",".join(f"{x:.6f}" for x in ratios)), ",").cast("array<double>")  # folded to one literal
    return F.aggregate(_pairs(_codes(token)), F.lit(0.0), lambda a, p: a + F.element_at(table, p + 1))


# --------------------------------------------------------------------------
# scan
# --------------------------------------------------------------------------

def scan(docs: DataFrame, ratios: list[float], threshold: float = THRESHOLD) -> DataFrame:
    """``doc_id, text, base, found``: arrays of ``(start, end, kind)`` of the base patterns and of everything.

    ``kind`` is a place in ``KINDS``.  A token that meets a base span is not
    added again.
    """
    df = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    df = _with_spans(df, "assign", ASSIGN, 0)
    # the length rule applies to group 2, after matching: a short match still uses up its text
    df = df.withColumn("assign_values", F.when(
        F.col("assign_hits").isNotNull(), F.regexp_extract_all("text", F.lit(ASSIGN), F.lit(2))))
    df = df.withColumn("assign", F.when(F.col("assign_hits").isNull(), _empty()).otherwise(
        F.filter("assign_all", lambda s, i: F.length(F.get("assign_values", i)) >= 12)).cast(SPAN))
    # a greedy run that is too short holds no longer one: the length rules can be part of these two patterns
    df = _with_spans(df, "access", "AKIA[A-Z0-9]{14,}", 1)
    df = _with_spans(df, "hex", "[0-9a-f]{16,}", 2)
    df = _with_spans(df, "markov", f"{TOKEN_CHAR}{{{MIN_TOKEN},}}", 3)
    known = "[0-9a-f]{16,}|AKIA[A-Z0-9]{14,}"
    taken = F.when(F.col("markov_hits").isNull(), _empty()).otherwise(F.filter("markov_all", lambda s, i: (
        ~F.get("markov_hits", i).rlike(known) & (score(F.get("markov_hits", i), ratios) >= threshold)))).cast(SPAN)
    df = df.withColumn("markov_taken", taken)
    df = df.withColumn("markov", F.when(F.size("markov_taken") == 0, _empty()).otherwise(F.filter(
        "markov_taken", lambda m: ~F.exists("assign", lambda a: (a["start"] < m["end"]) & (m["start"] < a["end"])))).cast(SPAN))
    base = F.concat("assign", "access_all", "hex_all")
    by_place = lambda spans: F.transform(
        F.sort_array(F.transform(spans, lambda s: F.struct(s["start"], s["kind"], s["end"]))),
        lambda s: F.struct(s["start"], s["end"], s["kind"]))
    return df.withColumn("base", by_place(base)) \
        .withColumn("found", F.when(F.size("markov") == 0, F.col("base")).otherwise(by_place(F.concat(base, "markov")))) \
        .select("doc_id", "text", "base", "found")


def spans_text(spans: str) -> Column:
    """``kind:start:end`` of each span, comma-joined."""
    names = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(
        ":", F.element_at(names, s["kind"] + 1), s["start"].cast("string"), s["end"].cast("string"))), ",")
