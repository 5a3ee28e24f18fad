"""Corpus pipeline: documents to training tokens in five stages, each one of the operators.

``STAGES`` lists (name, function); a function takes (spark, docs, sf_dir) and returns a
DataFrame, which is written as Parquet and read again as the next stage's docs.  All but the
last stage return the columns of ``documents``.

1. quality     documents scored below 0.7 by the byte-level network go; it learns from the
               table's quality labels outside the held-out fold
2. lines       lines of 40 characters or more found in 5 documents or more stay in the
               largest doc_id only; ``n_chars`` is counted again
3. near        of documents linked by a Jaccard similarity of 0.8 or more on five-word
               shingles, the smallest doc_id of each group stays
4. benchmark   documents that hold a whole benchmark window (10 words) go
5. tokens      doc_id and the byte-level BPE ids of each text, with their count

Nulls, empty texts and tables, ties and repeated rows have the results that the operators
define: null or empty texts pass stages 2 to 4 unchanged and get no tokens.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from assay.llm import bpe, decontam, jaccard, linededup, quality
from assay.llm.common import scratch_path, table, workers_import

TOKENIZER = public_tokenizers.path("byte_bpe_50k.json")


def good_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    workers_import(spark)
    model = quality.train(docs, quality.training_labels(table(spark, sf_dir, "labels")))
    return quality.keep_good(docs, model)


def without_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    workers_import(spark)
    return linededup.dedup_lines(docs)


def one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    workers_import(spark)
    return jaccard.one_per_group(docs, k=5, num=80, den=100)


def without_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontam.decontaminate(docs, table(spark, sf_dir, "benchmark"))


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    workers_import(spark)
    encoded = bpe.encode_texts(docs.select("doc_id", "text"), TOKENIZER)
    return encoded.select("doc_id", F.size("token_ids").cast("bigint").alias("n_tokens"), "token_ids")


STAGES = [
    ("quality", good_documents),
    ("lines", without_repeated_lines),
    ("near", one_of_each_group),
    ("benchmark", without_benchmark),
    ("tokens", tokens),
]

#: The classifier and the component search have no SQL form; tests/llm holds run() against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages on ``documents``; every stage's rows are written below the shared folder and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        path = scratch_path(spark, f"pipeline-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
