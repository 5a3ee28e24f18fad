"""Benchmark decontamination by winnowing, in DataFrame functions only.

Texts become words (A-Z lower-cased, then ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+``).  Of the
7 four-word grams in each 10-word window the one with the least hash (the leftmost on
ties) is kept as a fingerprint, on both sides.  Two texts that share 10 words share the
window and so its fingerprint: no shared span of 10 words or more can be missed.  Document
fingerprints are joined with those of the benchmark windows, and each meeting is extended
to the whole window and compared word by word, so that hash collisions count for nothing.

Items of fewer than 10 words are one window each and are compared as such.

Defined results: null and word-free texts have no words and no hits; benchmark rows with a
null ``item_id`` or no words take no part; documents are kept row by row (repeated rows come
back repeated); other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

WINDOW = 10
GRAM = 4
SEPARATORS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
PLACE = (1 << 30) - 1      # bits of a gram's place: more words than fit into one string
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"

#: Benchmark windows are broadcast up to this many bytes (counted first); beyond it the join shuffles.
BROADCAST_BYTES = 32 << 20


def words(text: Column) -> Column:
    lowered = F.translate(F.coalesce(text, F.lit("")), UPPER, UPPER.lower())
    return F.array_remove(F.split(lowered, SEPARATORS), "")


def _gram(w: Column, at: Column, size: int) -> Column:
    return F.xxhash64(F.slice(w, at, F.lit(size)))


def _ranked(w: Column) -> Column:
    """Each gram's rank in the winnowing: upper bits of its hash, then its place, so that the leftmost wins ties."""
    return F.when(F.size(w) >= WINDOW, F.transform(
        F.sequence(F.lit(1), F.size(w) - (GRAM - 1)),
        lambda i: _gram(w, i, GRAM).bitwiseAND(F.lit(~PLACE)).bitwiseOR(i.cast("bigint"))))


def _winnowed(ranked: Column, n_words: Column) -> Column:
    """Places (from 1) of the grams kept: the least rank in the grams of each window."""
    per = WINDOW - GRAM + 1
    least = F.transform(F.sequence(F.lit(1), n_words - (WINDOW - 1)),
                        lambda i: F.array_min(F.slice(ranked, i, F.lit(per))))
    return F.when(n_words >= WINDOW, F.transform(
        F.array_distinct(least), lambda x: x.bitwiseAND(F.lit(PLACE)).cast("int"))).otherwise(F.array().cast("array<int>"))


def benchmark_windows(benchmark: DataFrame) -> DataFrame:
    """Distinct windows: ``window`` (words joined by a space), ``len``, ``v`` (fingerprint), ``o`` (its offset), ``items``."""
    items = benchmark.where(F.col("item_id").isNotNull()) \
        .select("item_id", words(F.col("text")).alias("w")).where(F.size("w") > 0)
    spans = items.select("item_id", F.explode(F.when(
        F.size("w") >= WINDOW, F.transform(F.sequence(F.lit(1), F.size("w") - (WINDOW - 1)),
                                           lambda i: F.slice(F.col("w"), i, F.lit(WINDOW))))
        .otherwise(F.array("w"))).alias("s"))
    distinct = spans.groupBy("s").agg(F.collect_set("item_id").alias("items"))
    full = F.size("s") == WINDOW
    least = distinct.withColumn("at", F.when(full, F.array_min(_ranked(F.col("s"))).bitwiseAND(F.lit(PLACE)).cast("int"))
                                .otherwise(F.lit(1)))
    return least.select(F.array_join("s", " ").alias("window"), F.size("s").alias("len"),
                        F.when(full, _gram(F.col("s"), F.col("at"), GRAM)).otherwise(F.xxhash64("s")).alias("v"),
                        (F.col("at") - 1).alias("o"), "items")


def _fingerprints(docs: DataFrame, lengths: list[int]) -> DataFrame:
    """A row per fingerprint and document row, plus one with ``p`` = -1 that carries ``n_words``.

    ``explode_outer``, because for a plain explode the optimizer adds a filter on the
    array's size and computes the whole array again in it.

    ``lengths`` are the word counts of short items: for each, every gram of that
    many words is a fingerprint of its own (a window of one gram).
    """
    base = docs.select("doc_id", F.xxhash64("text").alias("text_hash"), words(F.col("text")).alias("w")) \
        .withColumn("n_words", F.size("w"))
    full = base.withColumn("g", _ranked(F.col("w"))) \
        .withColumn("at", F.concat(_winnowed(F.col("g"), F.col("n_words")), F.array(F.lit(-1)))) \
        .select("doc_id", "text_hash", "w", "n_words", F.explode_outer("at").alias("p"))
    reach = WINDOW - GRAM
    first = F.greatest(F.col("p") - reach, F.lit(1))
    rows = full.select(
        "doc_id", "text_hash", "n_words", "p", F.lit(WINDOW).alias("len"), first.alias("c"),
        F.when(F.col("p") > 0, _gram(F.col("w"), F.col("p"), GRAM)).alias("v"),
        F.when(F.col("p") > 0, F.slice("w", first, F.lit(WINDOW + reach))).alias("ctx"))
    for n in lengths:
        short = base.withColumn("g", F.when(F.size("w") >= n, F.transform(
            F.sequence(F.lit(1), F.size("w") - (n - 1)), lambda i: _gram(F.col("w"), i, n)))) \
            .select("doc_id", "text_hash", "w", "n_words", F.posexplode_outer("g").alias("i", "v")).where("i IS NOT NULL")
        rows = rows.unionByName(short.select(
            "doc_id", "text_hash", "n_words", (F.col("i") + 1).alias("p"), F.lit(n).alias("len"),
            (F.col("i") + 1).alias("c"), "v", F.slice("w", F.col("i") + 1, F.lit(n)).alias("ctx")))
    return rows


def find_overlaps(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """Per document row: ``doc_id, text_hash, n_words, n_hit, n_items, items_sha256, contaminated``."""
    windows = benchmark_windows(benchmark)
    seen = windows.groupBy("len").agg(F.count(F.lit(1)).alias("n"),
                                      F.sum(F.length("window") + 8 * F.size("items") + 64).alias("bytes")).collect()
    lengths = sorted(r["len"] for r in seen if r["len"] < WINDOW)     # at most 9 rows: one per window length
    right = windows.select(F.col("window"), F.col("len").alias("w_len"), F.col("v").alias("w_v"), "o", "items")
    if sum(r["bytes"] for r in seen) <= BROADCAST_BYTES:
        right = F.broadcast(right)
    start = F.col("p") - F.col("o")
    same = F.array_join(F.slice("ctx", F.greatest(start - F.col("c") + 1, F.lit(1)), F.col("w_len")), " ") == F.col("window")
    met = _fingerprints(docs, lengths).join(
        right, (F.col("v") == F.col("w_v")) & (F.col("len") == F.col("w_len")) & (start >= F.col("c")) & same, "left")
    kept = met.where((F.col("p") == -1) | F.col("window").isNotNull())
    hit = F.col("window").isNotNull()
    per_doc = kept.groupBy("doc_id", "text_hash").agg(
        F.max("n_words").alias("n_words"),
        F.count(F.when(F.col("p") == -1, 1)).alias("copies"),
        F.collect_set(F.when(hit, F.struct(start.alias("s"), (start + F.col("len")).alias("e")))).alias("spans"),
        F.array_distinct(F.flatten(F.collect_set(F.when(hit, F.col("items"))))).alias("items"))
    covered = F.aggregate(
        F.sort_array("spans"), F.struct(F.lit(0).alias("end"), F.lit(0).cast("bigint").alias("n")),
        lambda a, x: F.struct(
            F.greatest(a["end"], x["e"]).alias("end"),
            (a["n"] + F.greatest(x["e"] - F.greatest(a["end"], x["s"]), F.lit(0))).alias("n")))["n"]
    names = F.sort_array(F.transform("items", lambda i: i.cast("string")))
    return per_doc.withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("copies").cast("int")))).select(
        "doc_id", "text_hash", F.col("n_words").cast("bigint").alias("n_words"), covered.alias("n_hit"),
        F.size("items").cast("bigint").alias("n_items"),
        F.sha2(F.array_join(names, ","), 256).alias("items_sha256"),
        (F.size("spans") > 0).alias("contaminated"))


def decontaminate(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The rows of ``docs`` without any benchmark window, with all their columns."""
    bad = find_overlaps(docs, benchmark).where("contaminated") \
        .select(F.col("doc_id").alias("_id"), F.col("text_hash").alias("_hash")).distinct()
    same = docs["doc_id"].eqNullSafe(bad["_id"]) & (F.xxhash64(docs["text"]) == bad["_hash"])
    return docs.join(bad, same, "left_anti")
