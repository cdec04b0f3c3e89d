"""No text goes through the driver, however small Spark takes it for."""

import pytest

from ticklore.operators import sentiment as S


@pytest.mark.parametrize("terms", [S.BROADCAST_TERMS, 0])
def test_texts_are_not_broadcast(spark, tmp_path, monkeypatch, terms):
    monkeypatch.setattr(S, "BROADCAST_TERMS", terms)
    texts = spark.range(2000).selectExpr("id", "repeat('a very good day (really), ', 50) AS text")
    texts.write.parquet(str(tmp_path / "texts"))
    lexicon = spark.range(3000).selectExpr("concat('w', id) AS token", "1.5D AS valence").unionAll(spark.sql("SELECT 'good', 1.9D"))
    out = S.sentiment(spark.read.parquet(str(tmp_path / "texts")), "text", lexicon, ["id"])
    plan = out._jdf.queryExecution().sparkPlan().toString()
    assert plan.count("BroadcastHashJoin") == (1 if terms else 0) and "BuildLeft" not in plan.replace("ShuffledHashJoin", "")
    assert out.count() == 2000 and out.select("compound").distinct().count() == 1


def test_marks_at_the_ends_of_words(spark):
    told = {"(good)": "good", ":)": ":)", "a.": "a.", "ab!": "ab!", "!!!": "!!!", "'a-b',": "a-b", "x...": "x...", "\"isn't\"": "isn't", "..ab..c..": "ab..c"}
    df = spark.createDataFrame([(" ".join(told),)], "text string")
    assert df.select(S._words(df["text"])).first()[0] == list(told.values())
