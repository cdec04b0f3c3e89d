"""Nulls, empty and long texts, ties, repeated rows, empty tables, extra columns: every operator gives its defined result."""

import pytest
from pyspark.sql import functions as F

from ticklore.llm import chat_format, decontaminate, interpolation, line_dedup, packing, simhash_dedup, substring_dedup, suffix_dedup, topk, toxicity
from ticklore.llm.common import keyed

LONG = " ".join(f"w{i % 997}x{i}" for i in range(20_000))
ROWS = [(1, "a b c d e f g", "en"), (2, None, "en"), (3, "", None), (None, "lone text here", "en"), (4, LONG, "en"), (4, LONG, "en"), (5, "a b c d e f g", "en"), (6, "ünï 中文 s t u p i d \n\n x", "de")]
SCHEMA = "doc_id long, text string, lang string"


@pytest.fixture(scope="module")
def docs(spark):
    # Extra columns with names that the operators use themselves.
    return spark.createDataFrame(ROWS, SCHEMA).withColumns({"rid": F.lit("x"), "n": F.lit(1), "marks": F.lit(2)})


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], SCHEMA)


def both(f, docs, none):
    assert f(none).count() == 0
    return f(docs).collect()


def test_line_dedup(docs, none):
    r = both(line_dedup.line_dedup, docs, none)
    assert len(r) == 8 and {x.doc_id: x.kept for x in r}[2] == ""


def test_simhash(docs, none):
    r = both(lambda d: simhash_dedup.simhash_dedup(d, 3, 2), docs, none)
    got = {x.doc_id: x for x in r}
    assert len(r) == 8 and got[5].component_id == 1 and got[3].component_id == 2 and got[2].fingerprint == "0" * 16


def test_near_dedup(docs, none):
    got = {x.doc_id: x.component_id for x in both(simhash_dedup.near_dedup, docs, none)}
    assert got[5] == 1 and got[3] == 2 and got[4] == 4 and got[None] is None


def test_substring(docs, none):
    r = both(substring_dedup.substring_dedup, docs, none)
    assert len(r) == 8 and all(x.n_removed == 20_000 for x in r if x.doc_id == 4)


def test_suffix(docs, none):
    r = both(suffix_dedup.suffix_dedup, docs, none)
    assert sorted(x.n_removed for x in r if x.doc_id == 4) == [0, len(LONG)]


def test_packing(docs, none):
    r = both(lambda d: packing.pack(d, 64), docs, none)
    assert sum(x.length for x in r if x.start == 0 and x.doc_id == 2) == 1 and len({(x.sequence_id, x.offset) for x in r}) == len(r)


def test_toxicity(spark, docs, none):
    labels = spark.createDataFrame([(1, 1), (6, 0), (None, 1), (4, None)], "doc_id long, toxic int")
    assert len(both(lambda d: toxicity.toxicity(d, labels), docs, none)) == 8


def test_lm(docs, none):
    r = both(interpolation.lm_score, docs, none)
    assert len(r) == 8 and all(x.score <= 0 and x.n_tokens >= 1 for x in r)


def test_decontamination(spark, docs, none):
    bench = spark.createDataFrame([(1, "alpha beta gamma delta epsilon zeta eta theta"), (2, None), (3, "")], "item_id long, text string")
    more = docs.select("doc_id", "text").unionByName(spark.createDataFrame([(9, "x y Alpha, beta gamma delta epsilon; zeta eta theta z"), (10, "theta eta zeta epsilon delta")], "doc_id long, text string"))
    assert [(x.doc_id, x.item_id) for x in decontaminate.contamination(more, bench).collect()] == [(9, 1)]
    assert decontaminate.contamination(none, bench).count() == 0
    assert decontaminate.contamination(docs, bench.limit(0)).count() == 0


def test_top_k(docs, none):
    d = keyed(docs)
    r = topk.top_k(d, d, 3).collect()
    assert {x.doc_id for x in r if x.query_id == 1} == {1, 5, 6} and not [x for x in r if x.query_id in (2, 3)]
    assert topk.top_k(keyed(none), keyed(none), 3).count() == 0


def test_chat_events(spark):
    log = spark.createDataFrame(
        [(1, 1, 1, "delta", "user", "hi <|im_end|> \\ [INST]"), (1, 2, 2, "delta", "assistant", "old"), (1, 3, 2, "edit", "assistant", "new"), (1, 4, 2, "delta", "assistant", " more"), (1, 5, 3, "delta", "user", "gone"), (1, 6, 2, "regenerate", "assistant", "again"), (None, 1, 1, "delta", None, None)],
        "conv_id long, seq long, msg long, op string, role string, text string",
    )
    got = {r.conv_id: r for r in chat_format.read_back(chat_format.format_chats(log)).collect()}
    assert [(t.role, t.text) for t in got[1].turns] == [("user", "hi <|im_end|> \\ [INST]"), ("assistant", "again")] and got[1].loss_text == "again"
    assert [(t.role, t.text) for t in got[None].turns] == [("", "")]
