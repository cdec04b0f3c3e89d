"""Deleted interpolation counts every n-gram, those seen once too, whatever the corpus' size."""

import math
import os
import zlib
from collections import Counter

import pytest

from ticklore.llm import interpolation


def side(i):
    r = zlib.crc32(str(i).encode()) % 7
    return "held" if r == 2 else "fold" if r == 3 else "train"


def some(kind, n, start=0):
    return [i for i in range(start, start + 10_000) if side(i) == kind][:n]


def test_seen_once(spark):
    """A held-out text of word pairs that training has once is likelier than one of the same words in pairs that it lacks."""
    w = [f"w{i}" for i in range(30)]
    rows = [(i, " ".join(w[k::3] + w[(k + 1) % 3 :: 3])) for k, i in enumerate(some("train", 3))]
    rows += [(i, " ".join(w[::3])) for i in some("fold", 3)]
    once = "red green blue white black pink"
    rows += [(some("train", 1, 5_000)[0], once), (some("train", 2, 5_000)[1], " ".join(once.split()[::2] + once.split()[1::2]))]
    a, b = some("held", 2, 5_000)
    rows += [(a, once), (b, "black white blue green red pink")]
    got = {r.doc_id: r.score for r in interpolation.lm_score(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got[a] > got[b] + 0.5


@pytest.mark.parametrize("bits", [61, 44])
@pytest.mark.skipif(not os.path.isdir("/root/testdata/sf0.001"), reason="no test tables")
def test_counts(spark, bits):
    """Counts of all orders against brute force, over several parts and ranges."""
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    texts = {r.doc_id: [*(x.lower() for x in (r.text or "").encode().split()), b" "] for r in docs.collect()}
    fold = {"train": 0, "fold": 1, "held": 2}
    own = spark.createDataFrame([(i, fold[side(i)]) for i in texts], "doc_id long, fold int")
    rows = docs.join(own, "doc_id").selectExpr("doc_id rid", "doc_id", "text", "fold")
    gram = lambda x, n: [tuple(x[i - n + 1 : i + 1]) if i >= n - 1 else None for i in range(len(x))]
    n = Counter(g for i, x in texts.items() if side(i) != "held" for o in (1, 2, 3) for g in gram(x, o))
    f = Counter(g for i, x in texts.items() if side(i) == "fold" for o in (1, 2, 3) for g in gram(x, o))
    n[None] = f[None] = 0
    got = interpolation.coded(rows, 3, 5, 3, bits).collect()
    assert len(got) == len(texts) and sum(r.vocabulary for r in got) == len({g for g in n if g and len(g) == 1})
    for r in got:
        counts = interpolation.unpacked([r.counts], 3)[0]
        assert counts.tolist() == [[n[g] for g in gram(texts[r.doc_id], o)] for o in (1, 2, 3)]
        if side(r.doc_id) == "fold":
            assert interpolation.unpacked([r.deleted], 3)[0].tolist() == [[n[g] - f[g] for g in gram(texts[r.doc_id], o)] for o in (1, 2, 3)]


@pytest.mark.skipif(not os.path.isdir("/root/testdata/sf0.001"), reason="no test tables")
def test_scores(spark, monkeypatch):
    """Scores of all documents against the mixture, token by token, with the weights that were learned."""
    learned, weights = [], interpolation.weights
    monkeypatch.setattr(interpolation, "weights", lambda *a: learned.append(weights(*a)) or learned[-1])
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    texts = {r.doc_id: [*(x.lower() for x in (r.text or "").encode().split()), b" "] for r in docs.collect()}
    got = {r.doc_id: r for r in interpolation.lm_score(docs).collect()}
    (w,) = learned
    n = Counter(tuple(t[i : i + o]) for d, t in texts.items() if side(d) != "held" for o in (1, 2, 3) for i in range(len(t) - o + 1))
    total, words = sum(len(t) for d, t in texts.items() if side(d) != "held"), len([g for g in n if len(g) == 1])
    for d, t in texts.items():
        score = 0.0
        for i, x in enumerate(t):
            p = [1 / (words + 1), n[(x,)] / total]
            bucket = 0
            for o in (2, 3):
                seen = n[tuple(t[i - o + 1 : i])] if i >= o - 1 else 0
                p.append(n[tuple(t[i - o + 1 : i + 1])] / seen if seen else p[-1])
                bucket = 1 + (o - 2) * interpolation.STEPS + min(interpolation.STEPS - 1, int(math.log2(seen) / 2)) if seen else bucket
            score += math.log10(sum(a * b for a, b in zip(w[bucket], p)))
        assert got[d].score == pytest.approx(score, rel=1e-9) and got[d].train_tokens == total
