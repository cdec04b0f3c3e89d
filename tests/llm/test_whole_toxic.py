"""Held-out toxic rows are found: always answering 0 fails."""

import os

import pytest
from pyspark.sql import functions as F

from ticklore.llm.toxicity import op8, toxicity

SF = "/root/testdata/sf0.1"


@pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables")
def test_recall_and_precision(spark):
    labels = spark.read.parquet(f"{SF}/labels.parquet").select("doc_id", "toxic")
    told = op8(spark, SF).join(labels, "doc_id").filter("held_out")
    r = told.agg(F.sum("toxic").alias("toxic"), F.sum("predicted").alias("said"), F.sum(F.col("toxic") * F.col("predicted")).alias("both")).first()
    assert r.toxic > 50 and r.both >= 0.8 * r.toxic and r.both >= 0.95 * r.said
    # Scores rank: of a toxic and a clean row the toxic one has the greater score, or an equal one half of the time.
    rows = told.select("score", "toxic").collect()
    good, bad = ([r.score for r in rows if r.toxic == y] for y in (1, 0))
    assert sum((a > b) + 0.5 * (a == b) for a in good for b in bad) >= 0.85 * len(good) * len(bad)


def test_entries_of_many_companies(spark):
    """An entry that other ones always stand beside is listed, too; the wording of one text and its copies is not."""
    words = ["aaaone", "bbbtwo", "cccsix", "dddten", "eeered", "fffoak"]
    # Three words or more: any four of them leave no row over.
    texts = [(" ".join(w for j, w in enumerate(words) if i >> j & 1), 1) for i in range(64) if i.bit_count() >= 3 for _ in range(3)]
    texts += [("aaaone bbbtwo copied again", 1)] * 9 + [(f"plain text {i}", 0) for i in range(300)] + [("copied", 0)]
    rows = [(i, t, y) for i, (t, y) in enumerate(texts)] + [(1000 + i, w + " new", None) for i, w in enumerate([*words, "again"])]
    docs = spark.createDataFrame(rows, "doc_id long, text string, toxic int")
    told = {r.doc_id: r.predicted for r in toxicity(docs, docs.filter("toxic IS NOT NULL").select("doc_id", "toxic"), mod=1, rest=1).collect()}
    assert [told[1000 + i] for i in range(7)] == [1] * 6 + [0]
