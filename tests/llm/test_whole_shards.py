"""Shards by bytes: against the sorted order itself, with groups of copies, repeated rows and odd tables."""

import zlib

import pytest
from pyspark.sql import functions as F

from ticklore.llm import sharding

SF = "/root/testdata/sf0.001"


def told(df):
    return [r.asDict() for r in df.select("row.*", "size", "shard", "slot").collect()]


def check(rows, texts, shards, tolerance):
    """Nothing lost, slots gapless, every cut within the tolerance or next to the target, groups cut only where they have to be."""
    assert sorted((r["doc_id"] is None, r["doc_id"], r["text"] or "") for r in rows) == sorted((d is None, d, t or "") for d, t in texts)
    assert all(r["size"] == len((r["text"] or "").encode()) + 8 for r in rows)
    rows.sort(key=lambda r: (r["shard"], r["slot"]))
    for k in range(shards):
        assert [r["slot"] for r in rows if r["shard"] == k] == list(range(sum(r["shard"] == k for r in rows)))
    total, long = sum(r["size"] for r in rows), max(r["size"] for r in rows)
    ends, sums = [0], 0  # where each row ends in the order
    for r in rows:
        sums += r["size"]
        ends.append(sums)
    whole = {0, total} | {ends[i + 1] for i in range(len(rows) - 1) if (rows[i]["text"] or "") != (rows[i + 1]["text"] or "")}
    for k in range(1, shards):
        cut, aim, free = sum(r["size"] for r in rows if r["shard"] < k), total * k / shards, tolerance * total / shards
        assert abs(cut - aim) <= max(free, min(abs(e - aim) for e in ends) + 1e-6)
        if cut not in whole:
            assert min(abs(e - aim) for e in whole) > free
    # Of equal texts at most as many shards as their bytes fill, and one at either end.
    for t in {r["text"] or "" for r in rows}:
        own = [r for r in rows if (r["text"] or "") == t]
        assert len({r["shard"] for r in own}) <= sum(r["size"] for r in own) / (total / shards - long) + 2 if total / shards > long else True


@pytest.mark.parametrize(("shards", "tolerance"), [(24, 0.01), (7, 0.05), (5, 0.0), (1, 0.01)])
def test_documents(spark, shards, tolerance):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    check(told(sharding.sharded(docs, shards, tolerance)), [(r.doc_id, r.text) for r in docs.collect()], shards, tolerance)


def test_hot_groups(spark):
    """A third of the rows with one text, a third the same row over and over."""
    rows = [(i, f"text number {i} " * (i % 5)) for i in range(300)] + [(i, "the same text") for i in range(300)] + [(7, "the same row")] * 300
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    got = told(sharding.sharded(docs, 6, 0.01))
    check(got, rows, 6, 0.01)
    assert len({r["shard"] for r in got if r["text"] == "the same row"}) > 1


def test_odd_rows(spark):
    rows = [(1, None), (1, None), (None, "x"), (None, ""), (2, "ünï 中文"), (3, "word " * 200_000), (-(1 << 63), "y")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumns({c: F.lit(c) for c in ("row", "size", "shard", "h", "place", "a.b")})
    got = sharding.sharded(docs, 3).collect()
    assert sorted(r.row.text or "" for r in got) == sorted(t or "" for _, t in rows) and got[0].row["a.b"] == "a.b"
    assert sharding.sharded(docs.limit(0), 3).count() == 0


def test_query(spark):
    got = sharding.op13(spark, SF)
    assert got.columns == ["doc_id", "size", "text_crc32", "law", "shard", "slot", "grown_shard"]
    want = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    rows = got.collect()
    assert len(rows) == len(want) and all((r["size"], r["text_crc32"]) == (len(want[r["doc_id"]].encode()) + 8, zlib.crc32(want[r["doc_id"]].encode())) for r in rows)
    assert {r["law"] for r in rows} == {"bytes"} and {r["shard"] for r in rows} <= set(range(24)) and all(r["grown_shard"] is None for r in rows)
