"""Chat formatting, in DataFrame functions only.

The turns of a conversation are collected as structs and sorted; neighbours of one role
are merged into one block (parts separated by ``<|im_sep|>``); the blocks are concatenated:

    <|im_start|>role NEWLINE part <|im_sep|> part <|im_end|> NEWLINE

Texts and roles are escaped so that no ``<|`` is left in them: ``\\`` becomes ``\\\\`` and
``<|`` becomes ``<\\|`` (and a newline in a role ``<\\n``).  The escaped form holds those
strings only where they were put in, so ``unescape`` gives back every text exactly.

The loss mask is a list of code point spans of the formatted string that cover the escaped
text of every assistant turn, nothing else.

Defined results: a null text or role is empty; turns of equal number are ordered by role,
then text; null turn numbers come first; repeated rows are repeated turns; rows of a null
conv_id form one conversation; other columns are ignored.  A conversation comes out as one
row, so its text has to fit into one (2 GB).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import bound, running_total

START, END, SEP = "<|im_start|>", "<|im_end|>", "<|im_sep|>"
LOSS_ROLE = "assistant"


def escape(text: Column) -> Column:
    return F.replace(F.replace(text, F.lit("\\"), F.lit("\\\\")), F.lit("<|"), F.lit("<\\|"))


def unescape(text: Column) -> Column:
    return F.replace(F.replace(text, F.lit("<\\|"), F.lit("<|")), F.lit("\\\\"), F.lit("\\"))


def escape_role(role: Column) -> Column:
    return F.replace(escape(role), F.lit("\n"), F.lit("<\\n"))


def unescape_role(role: Column) -> Column:
    return unescape(F.replace(role, F.lit("<\\n"), F.lit("\n")))


def format_conversations(rows: DataFrame) -> DataFrame:
    """``conv_id, formatted, mask`` from rows ``(conv_id, turn, role, text)``."""
    turns = rows.groupBy("conv_id").agg(F.sort_array(F.collect_list(F.struct(
        "turn", F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text")))).alias("t"))
    n = F.size("t")
    role_at = lambda i: F.get("t", i)["role"]
    opens = lambda t, i: (i == 0) | (role_at(i - 1) != t["role"])
    closes = lambda t, i: (i == n - 1) | (role_at(i + 1) != t["role"])
    # each turn as (before, text, after): merged neighbours share one start and one end mark
    parts = turns.withColumn("p", F.transform("t", lambda t, i: F.struct(
        F.when(opens(t, i), F.concat(F.lit(START), escape_role(t["role"]), F.lit("\n"))).otherwise(F.lit(SEP)).alias("before"),
        escape(t["text"]).alias("text"),
        F.when(closes(t, i), F.lit(END + "\n")).otherwise(F.lit("")).alias("after"),
        (t["role"] == LOSS_ROLE).alias("loss"))))
    placed = parts.withColumn("ends", running_total(F.transform("p", lambda p: (
        F.length(p["before"]) + F.length(p["text"]) + F.length(p["after"])))))
    spans = F.zip_with("p", "ends", lambda p, e: F.struct(
        (e - F.length(p["after"]) - F.length(p["text"])).alias("start"), (e - F.length(p["after"])).alias("end"),
        p["loss"].alias("loss")))
    return placed.select(
        "conv_id",
        F.array_join(F.transform("p", lambda p: F.concat(p["before"], p["text"], p["after"])), "").alias("formatted"),
        F.transform(F.filter(spans, lambda s: s["loss"]), lambda s: F.struct(s["start"], s["end"])).alias("mask"))


def covered(text: Column, spans: Column, width: int = 1024) -> Column:
    """The texts that ``spans`` (start, end in code points) cover.

    A place in a string is found by walking there from its start, so the text is cut into pieces of ``width`` code
    points once, and a span is taken from the pieces it touches: work linear in the text and what is covered.
    """
    def cut(pieces: Column) -> Column:
        def one(s: Column) -> Column:
            first, last = F.floor(s["start"] / width).cast("int"), F.floor((s["end"] - 1) / width).cast("int")
            near = F.array_join(F.slice(pieces, first + 1, last - first + 1), "")
            return F.when(s["end"] <= s["start"], F.lit("")).otherwise(
                F.substring(near, (s["start"] - first * width + 1).cast("int"), (s["end"] - s["start"]).cast("int")))
        return F.transform(spans, one)

    return bound(F.regexp_extract_all(text, F.lit(f"(?s).{{1,{width}}}"), F.lit(0)), cut)


def read_back(formatted: DataFrame) -> DataFrame:
    """Adds ``turns`` (role, text), parsed from ``formatted``, and ``loss_text``, what the mask covers, unescaped."""
    # what follows the last end mark is empty, every block begins with a start mark
    blocks = F.filter(F.split("formatted", r"\Q" + END + r"\E\n", -1), lambda b: F.startswith(b, F.lit(START)))

    def of_block(b: Column) -> Column:
        line = F.instr(b, "\n")
        body = F.split(F.substring(b, line + 1, F.length(b)), r"\Q" + SEP + r"\E", -1)
        return bound(unescape_role(F.substring(b, len(START) + 1, line - len(START) - 1)),
                     lambda role: F.transform(body, lambda x: F.struct(role.alias("role"), unescape(x).alias("text"))))

    loss = F.array_join(F.transform(covered(F.col("formatted"), F.col("mask")), unescape), "")
    return formatted.withColumn("turns", F.flatten(F.transform(blocks, of_block))).withColumn("loss_text", loss)
