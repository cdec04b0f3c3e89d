"""The latent space is that of every passage of every document and of the benchmark, whatever the number of documents."""

import numpy as np

from ticklore.llm import decontaminate


def test_space_of_all_documents(spark, monkeypatch):
    rng = np.random.default_rng(11)
    terms = np.array([f"term{i}" for i in range(12)])
    share = 0.8 ** np.arange(12)
    docs = [(i, " ".join(rng.choice(terms, 20, p=share / share.sum()))) for i in range(9_000)]
    items = [(i, " ".join(rng.permutation(terms)[:8])) for i in range(6)]
    seen, search = [], decontaminate.search
    monkeypatch.setattr(decontaminate, "STOP", 1.0)
    monkeypatch.setattr(decontaminate, "search", lambda rows, space, *a: seen.append((space, space.axes.copy())) or search(rows, space, *a))
    decontaminate.contamination(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string"), dims=5)
    [(space, axes)] = seen
    # Each document is one window, which both of its passages hold.
    gram, n = np.zeros((12, 12)), 0
    for _, text in docs:
        number, times = np.unique(space.numbers(decontaminate.words([text])[0]), return_counts=True)
        row = np.zeros(12)
        row[number] = (1 + np.log(times)) * space.idf[number]
        row /= np.linalg.norm(row)
        gram += 2 * np.outer(row, row)
        n += 2
    for item in space.items:
        row = np.zeros(12)
        row[space.numbers(item.words)] = space.idf[space.numbers(item.words)]
        row /= np.linalg.norm(row)
        gram += n / len(items) * np.outer(row, row)
    best = np.linalg.eigh(gram)[1][:, -5:]
    assert np.abs(axes @ axes.T - best @ best.T).max() < 1e-5
