"""A short item that is quoted word for word is found, whatever stands around it."""

import random

from ticklore.llm import decontaminate


def test_quoted_short_item(spark):
    rng = random.Random(3)
    terms = [f"term{i}" for i in range(400)]
    items = [(i, " ".join(rng.sample(terms, 8))) for i in range(200)]
    # Prose of other items' terms, so that an item is a small share of its window.
    docs = [(i, " ".join(rng.choices(terms, k=60)) + " " + t.title() + ". " + " ".join(rng.choices(terms, k=60))) for i, t in items]
    bench = spark.createDataFrame(items, "item_id long, text string")
    got = {(r.doc_id, r.item_id) for r in decontaminate.contamination(spark.createDataFrame(docs, "doc_id long, text string"), bench).collect()}
    assert {(i, i) for i, _ in items} <= got
