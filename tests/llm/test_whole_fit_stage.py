"""The pipeline's decontamination stage fits its latent space on all documents that reach it."""

import corpus_pipeline
from ticklore.llm import decontaminate


def test_stage_fits_on_all(spark, monkeypatch, tmp_path):
    spark.createDataFrame([(1, "one two three four five six seven eight")], "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    docs = spark.range(9_000).selectExpr("id AS doc_id", "IF(id % 1000 = 7, 'so one two three four five six seven eight it is', concat('one two words ', id)) AS text")
    seen, fit = [], decontaminate.fit
    monkeypatch.setattr(decontaminate, "fit", lambda rows, *a: seen.append(rows.count()) or fit(rows, *a))
    left = corpus_pipeline.drop_leaks(spark, docs, str(tmp_path))
    assert left.count() == 9_000 - 9 and left.filter("doc_id % 1000 = 7").count() == 0
    assert seen == [9_000]
