"""Near copies are told by their sets of shingles, and meet in groups of bounded size."""

from itertools import combinations

from pyspark.sql import functions as F

from ticklore.llm import simhash_dedup as s


def test_repeated_phrase(spark):
    text = " ".join(f"c{i}" for i in range(200))
    phrase = " ".join(f"c{i}" for i in range(12))
    rows = [(1, text + " " + phrase + " " + phrase), (2, text + " " + " ".join([phrase] * 1000))]
    got = s.near_dedup(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert {r.component_id for r in got} == {1}


def test_groups(spark):
    met = spark.range(400).select(F.xxhash64("id").alias("node"), F.lit(1).alias("key"), F.lit(400).alias("weight"))
    groups = s.block_pairs(met, 100).groupBy("i", "j").agg(F.collect_list("node").alias("nodes"), F.count("*").alias("n")).collect()
    assert max(g.n for g in groups) <= 125
    assert len({frozenset(p) for g in groups for p in combinations(g.nodes, 2)}) == 400 * 399 // 2


def test_split_shards(spark):
    """The same components with and without split shards."""
    line = " ".join(f"c{i}" for i in range(30))
    # Groups of any size give the same.
    rows = [(d, line + " " + " ".join(f"x{d // 2}y{i}" for i in range(40)) + f" end{d}") for d in range(60)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    told = lambda n: {r.doc_id: r.component_id for r in s.near_dedup(docs, shard_rows=n).collect()}
    assert told(10) == told(1000) == {d: d // 2 * 2 for d in range(60)}


def test_whole_sets_decide(spark):
    """Pairs just above and just below the bound, of more shingles than any sketch would hold."""
    rows, want = [], {}
    for g, apart in enumerate((95, 105, 115, 125, 60, 140)):
        base = [f"g{g}w{i}" for i in range(1004)]
        other = base[: 1004 - apart] + [f"g{g}x{i}" for i in range(apart)]
        rows += [(2 * g, " ".join(base)), (2 * g + 1, " ".join(other))]
        sets = [{tuple(w[i : i + 5]) for i in range(1000)} for w in (base, other)]
        want[2 * g + 1] = 2 * g if len(sets[0] & sets[1]) >= 0.8 * len(sets[0] | sets[1]) else 2 * g + 1
    got = {r.doc_id: r.component_id for r in s.near_dedup(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert {d: got[d] for d in want} == want and len(set(want.values())) > 3


def test_edges(spark):
    rows = [(None, None), (1, ""), (2, " \n"), (3, "a b"), (3, "A  b"), (None, "a b"), (4, "a b c")]
    got = {(r.doc_id, r.component_id) for r in s.near_dedup(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == {(None, 1), (1, 1), (2, 1), (3, 3), (None, 3), (4, 4)}
    assert s.near_dedup(spark.createDataFrame([], "doc_id long, text string")).count() == 0
