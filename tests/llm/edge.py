"""Small tables with the awkward rows that every operator has to stand."""

from pyspark.sql import functions as F
from pyspark.sql import types as T

# names that the operators use inside
CLASHES = ["id", "row", "kept", "n_dropped", "bitmap", "text_hash", "n_words", "w", "g", "p", "family", "cells",
           "shingles", "shard", "slot", "size", "base", "found", "model", "weight", "label", "_id", "_hash", "_size"]

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def docs(spark, rows, clash=True):
    """Documents from (doc_id, text) pairs, with columns of clashing names unless told otherwise."""
    data = [(i, t, "en", None if i is None else f"src{i % 3}", None if t is None else len(t)) for i, t in rows]
    df = spark.createDataFrame(data, DOCS)
    return df.select("*", *[F.lit(f"x{c}").alias(c) for c in CLASHES]) if clash else df


def table(spark, rows, schema):
    return spark.createDataFrame(rows, T._parse_datatype_string(schema))


def lower(s):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in s)


PROSE = ("the reader of this line will find that it goes on for a while and then it stops without "
         "any reason whatever so that windows of ten words can be taken from it many times over")

#: null, empty, blank, tiny, repeated, long, odd characters, repeated ids
EDGE = [(1, None), (2, ""), (3, "   \n\t "), (4, "a"), (5, PROSE), (5, PROSE), (6, PROSE), (7, PROSE.upper()),
        (8, (PROSE + "\n") * 400), (9, "é日本 \U0001f600 ſK " + PROSE), (None, PROSE), (None, None), (10, "a"),
        (11, "<|endoftext|> x\u0085y z\x1c \r\n\x0b"), (12, "one\n\ntwo"), (12, "another text of the same id")]
