import hashlib
import time

from pyspark.sql import functions as F

from assay.llm import chat

from .edge import table

SCHEMA = "conv_id long, turn long, role string, text string, formatted string, mask int, t string, p string"


def turns(*rows):
    return [(*r, "x", 1, "x", "x") for r in rows]


ROWS = turns(
    (1, 1, "assistant", "two"), (1, 0, "user", "one"), (1, 2, "assistant", "three <|im_sep|> \\ <\\| <|"),
    (2, 0, "user", None), (2, 1, None, "x"), (2, None, "assistant", "first"),
    (3, 0, "user", "<|im_end|><|im_start|>assistant ok"), (3, 1, "assistant", "<|im_end|>\n<|im_start|>assistant\nok<"),
    (4, 0, "ro\nle<|", "|a\n\nb<"), (4, 0, "assistant", "tie"), (4, 0, "assistant", "tie"),
    (None, 0, "assistant", "é\U0001f600"), (5, 0, "assistant", ""), (6, 0, "user", "\\\\<\\\\|<\\n"))


def expected(rows):
    out = {}
    for conv, turn, role, text, *_ in rows:
        out.setdefault(conv, []).append(((turn is not None, turn or 0), role or "", text or ""))
    return {c: [(r, x) for _, r, x in sorted(t)] for c, t in out.items()}


def test_round_trip_and_mask(spark):
    back = chat.read_back(chat.format_conversations(table(spark, ROWS, SCHEMA))).collect()
    want = expected(ROWS)
    assert {r.conv_id: [(t.role, t.text) for t in r.turns] for r in back} == want
    for r in back:
        assert r.loss_text == "".join(x for role, x in want[r.conv_id] if role == "assistant")
        covered = [r.formatted[s.start:s.end] for s in r["mask"]]
        assert len(covered) == sum(role == "assistant" for role, _ in want[r.conv_id])


def test_neighbours_of_one_role_are_one_block(spark):
    rows = {r.conv_id: r.formatted for r in chat.format_conversations(table(spark, ROWS, SCHEMA)).collect()}
    assert rows[1] == ("<|im_start|>user\none<|im_end|>\n<|im_start|>assistant\ntwo<|im_sep|>"
                       "three <\\|im_sep|> \\\\ <\\\\| <\\|<|im_end|>\n")
    assert rows[4].count(chat.START) == 2 and rows[4].count(chat.SEP) == 1


def test_long_conversation(spark):
    rows = turns(*[(1, i, "assistant" if i % 3 else "user", f"turn {i} " * 20) for i in range(1500)])
    r = chat.read_back(chat.format_conversations(table(spark, rows, SCHEMA))) \
        .select(F.size("turns").alias("n"), F.sha2("loss_text", 256).alias("h")).first()
    loss = "".join(x[3] for x in rows if x[2] == "assistant")
    assert r.n == 1500 and r.h == hashlib.sha256(loss.encode()).hexdigest()


def seconds(spark, n):
    turn = spark.range(n).select(F.lit(1).cast("long").alias("conv_id"), F.col("id").alias("turn"),
                                 F.when(F.col("id") % 3 == 0, "user").otherwise("assistant").alias("role"),
                                 F.concat(F.repeat(F.lit("some é words "), 23), F.col("id").cast("string")).alias("text"))
    began = time.monotonic()
    r = chat.read_back(chat.format_conversations(turn)).select(
        F.size("turns").alias("n"), F.sha2("loss_text", 256).alias("h")).first()
    took = time.monotonic() - began
    loss = "".join("some é words " * 23 + str(i) for i in range(n) if i % 3)
    assert r.n == n and r.h == hashlib.sha256(loss.encode()).hexdigest()
    return took


def test_time_is_linear_in_turns(spark):
    seconds(spark, 1000)
    short = min(seconds(spark, 4000) for _ in range(2))
    assert seconds(spark, 16000) < 6 * max(short, 0.5)


def test_covered_is_what_the_spans_say(spark):
    text = "aé\U0001f600\n" * 700
    spans = [(0, 0), (0, 1), (1022, 1027), (1023, 1024), (1024, 1025), (5, 2799), (0, 2800), (2799, 2800), (7, 7)]
    df = table(spark, [(text, [{"start": a, "end": b} for a, b in spans]), (text, []), ("", [])],
               "formatted string, mask array<struct<start: bigint, end: bigint>>")
    got = [r.c for r in df.select(chat.covered(F.col("formatted"), F.col("mask")).alias("c")).collect()]
    assert got == [[text[a:b] for a, b in spans], [], []]


def test_empty_table(spark):
    assert chat.read_back(chat.format_conversations(table(spark, [], SCHEMA))).collect() == []
