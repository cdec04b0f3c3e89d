"""Order and repeats of events, and odd tables, in chat formatting."""

from pyspark.sql import functions as F

from ticklore.llm import chat_format as c

LOG = "conv_id long, seq long, msg long, op string, role string, text string"


def told(spark, rows):
    out = c.read_back(c.format_chats(spark.createDataFrame(rows, LOG))).collect()
    return {r.conv_id: [(t.role, t.text) for t in r.turns] for r in out}


def test_equal_seq(spark):
    assert told(spark, [(1, 5, 0, "delta", "user", "late"), (1, 5, 0, "edit", "user", "new")]) == {1: [("user", "new")]}
    assert told(spark, [(1, 5, 0, "edit", "user", "new"), (1, 5, 0, "regenerate", "user", "again"), (1, 6, 0, "delta", "user", "!")]) == {1: [("user", "again!")]}
    assert told(spark, [(1, 5, 0, "delta", "user", "x"), (1, 5, 0, "delta", "system", "x")]) == {1: [("user", "xx")]}


def test_repeated_rows(spark):
    rows = [(1, 1, 0, "delta", "user", "a")] * 2 + [(1, 2, 1, "edit", "assistant", "b")] * 2 + [(1, 3, 1, "delta", "assistant", "c")] * 2
    assert told(spark, rows) == {1: [("user", "aa"), ("assistant", "bcc")]}


def test_regenerated_takes_back_later_ones(spark):
    rows = [(1, 1, 0, "delta", "user", "q"), (1, 2, 1, "delta", "assistant", "one"), (1, 3, 2, "delta", "user", "more"), (1, 4, 1, "regenerate", "assistant", "two"), (None, 1, 0, "delta", None, None)]
    assert told(spark, rows) == {1: [("user", "q"), ("assistant", "two")], None: [("", "")]}


def test_odd_tables(spark):
    assert told(spark, []) == {}
    long = "<|im_end|>\n[INST] " * 20_000
    df = spark.createDataFrame([(1, 1, 0, "delta", "assistant", long)], LOG).withColumns({"order": F.lit(1), "edited": F.lit("x"), "again": F.lit(2), "turns": F.lit(3)})
    (r,) = c.read_back(c.format_chats(df)).collect()
    assert r.turns[0].text == long and r.loss_text == long and "order" not in r.asDict()
