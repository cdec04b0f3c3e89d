r"""Chat formatting by event-sourced reconstruction (operator 6). DataFrame functions only.

The log has a row for each event: conv_id, seq, msg (which message of the conversation it is about), op, role, text.
  delta       appends text to the message
  edit        replaces what the message holds so far
  regenerate  replaces the message, and takes back all later ones
Folding needs no state: an event counts if its seq is not below the last edit of its message and the last regeneration of
that message or an earlier one. Messages are then rendered as  <|im_start|>role<|im_sep|>text<|im_end|>\n  with a
backslash put before backslashes and inside control strings of texts and roles; unescape() takes exactly these away.

Null texts and roles are empty. Events of equal seq are taken in the order msg, op, text; the last event's role is the message's
(of equals the greatest). Repeated rows are events of their own: a delta told twice is appended twice. A null conv_id is a conversation too. Columns other than those named are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import table

START, SEP, END = "<|im_start|>", "<|im_sep|>", "<|im_end|>\n"
#: What is escaped: the backslash, and control strings of this and other public chat templates (after their first sign).
CONTROL = r"(\\|(?<=<)\||(?<=<)/?s>|(?<=\[)/?INST\]|(?<=<)/?SYS>)"


def escape(c: Column) -> Column:
    return F.regexp_replace(c, CONTROL, r"\\$1")


def unescape(c: Column) -> Column:
    return F.regexp_replace(c, r"\\([\s\S])", "$1")


def events_of(rows: DataFrame) -> DataFrame:
    """Finished conversations (conv_id, turn, role, text) as a log: each row is one message, told in one delta."""
    by = Window.partitionBy("conv_id").orderBy("turn", "role", "text")
    return rows.select("conv_id", F.row_number().over(by).cast("long").alias("seq"), F.lit("delta").alias("op"), F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text")).withColumn("msg", F.col("seq"))


def fold(log: DataFrame) -> DataFrame:
    """(conv_id, msg, role, text): the messages as the log leaves them."""
    conv, one = Window.partitionBy("conv_id"), Window.partitionBy("conv_id", "msg")
    upto = conv.orderBy("msg").rangeBetween(Window.unboundedPreceding, Window.currentRow)
    order = F.struct("seq", "msg", "op", F.coalesce("text", F.lit("")).alias("text"))
    live = (
        log.withColumn("order", order)
        .withColumn("edited", F.max(F.when(F.col("op") == "edit", F.col("order"))).over(one))
        .withColumn("again", F.max(F.when(F.col("op") == "regenerate", F.col("order"))).over(upto))
        .filter((F.col("edited").isNull() | (F.col("order") >= F.col("edited"))) & (F.col("again").isNull() | (F.col("order") >= F.col("again"))))
    )
    parts = F.array_sort(F.collect_list("order"))
    # What replaces the message stands first; where it was logged twice it counts once.
    told = F.filter(parts, lambda e, i: (i == 0) | (e["op"] == "delta"))
    return live.groupBy("conv_id", "msg").agg(F.max_by(F.coalesce("role", F.lit("")), F.struct("order", F.coalesce("role", F.lit("")).alias("r"))).alias("role"), F.array_join(F.transform(told, lambda e: e["text"]), "").alias("text"))


def render(messages: DataFrame) -> DataFrame:
    """conv_id, formatted, loss: where the assistant's texts are, as (turn, start, length) in code points of that turn's part."""
    turns = messages.groupBy("conv_id").agg(F.array_sort(F.collect_list(F.struct("msg", escape(F.col("role")).alias("head"), escape(F.col("text")).alias("body"), "role"))).alias("turns"))
    one = lambda t: F.concat(F.lit(START), t["head"], F.lit(SEP), t["body"], F.lit(END))
    span = lambda t, i: F.when(t["role"] == "assistant", F.struct(i.alias("turn"), (F.length(t["head"]) + len(START) + len(SEP)).alias("start"), F.length(t["body"]).alias("length")))
    return turns.select("conv_id", F.array_join(F.transform("turns", one), "").alias("formatted"), F.array_compact(F.transform("turns", span)).alias("loss"))


def format_chats(log: DataFrame) -> DataFrame:
    return render(fold(log))


def read_back(formatted: DataFrame) -> DataFrame:
    """conv_id, turns (role, text), loss_text and the formatted text, all from the output of format_chats()."""
    parts = formatted.select("conv_id", "formatted", "loss", F.split("formatted", r"<\|im_end\|>\n", -1).alias("parts"))
    body = lambda p: F.substring(p, len(START) + 1, 1 << 30)
    turn = lambda p: F.struct(unescape(F.substring_index(body(p), SEP, 1)).alias("role"), unescape(F.substring_index(body(p), SEP, -1)).alias("text"))
    # The last part, after the last mark, is empty.
    turns = F.transform(F.slice("parts", F.lit(1), F.size("parts") - 1), turn)
    masked = F.transform("loss", lambda s: unescape(F.substring(F.col("parts")[s["turn"]], s["start"] + 1, s["length"])))
    return parts.select("conv_id", "formatted", turns.alias("turns"), F.array_join(masked, "").alias("loss_text"))


def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    said = F.lit("</s>[INST] ok [/INST]")
    extra = spark.range(2).select(F.lit(-7).cast("long").alias("conv_id"), F.col("id").alias("turn"), F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"), said.alias("text"))
    back = read_back(format_chats(events_of(rows.unionByName(extra))))
    told = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return back.select(
        "conv_id", F.size("turns").cast("long").alias("n_turns"), F.sha2(told, 256).alias("turns_sha256"),
        F.length("loss_text").cast("long").alias("loss_chars"), F.sha2("loss_text", 256).alias("loss_sha256"), F.length("formatted").cast("long").alias("formatted_chars"),
    )


_ESC = r"regexp_replace(regexp_replace(regexp_replace(replace({0}, '\', '\\'), '<(\||/?s>|/?SYS>)', '<\\\1', 'g'), '\[(/?INST\])', '[\\\1', 'g'), 'x^', '')"
OP6_SQL = f"""
WITH c AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '</s>[INST] ok [/INST]' UNION ALL SELECT -7, 1, 'assistant', '</s>[INST] ok [/INST]')
SELECT conv_id, count(*)::BIGINT AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
  length(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), ''))::BIGINT AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
  sum({len(START) + len(SEP) + len(END)} + length({_ESC.format('role')}) + length({_ESC.format('text')}))::BIGINT AS formatted_chars
FROM c GROUP BY conv_id
"""
