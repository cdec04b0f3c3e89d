"""One session that holds nearly everything: same rows as the plain way, with bounded groups and few candidates."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from ticklore.operators import chat, intervals, joins

IV = "session_id long, {} string, start_tick long, end_tick long"


def spans(rng, n, length, at=1_000_000):
    starts = [rng.randrange(at) for _ in range(n)]
    return [(1, f"p{i % 7}", s, s + length(rng)) for i, s in enumerate(starts)]


def total(a, b):
    """Pairs that overlap and the ticks they share, by sorting."""
    ends, starts = np.sort([x[3] for x in b]), np.sort([x[2] for x in b])
    return sum(int(np.searchsorted(starts, e, "left") - np.searchsorted(ends, s, "right")) for _, _, s, e in a)


@pytest.mark.parametrize("length", [lambda r: r.randint(1, 60), lambda r: r.choice([3, 40, 3000, 200_000 if r.random() < 0.01 else 9])], ids=["short", "mixed"])
def test_overlaps_of_a_hot_session(spark, length):
    """100,000 intervals of one session: every pair once, at most twice as many candidates as pairs and interval ends."""
    rng = random.Random(1)
    rows_a, rows_b = spans(rng, 50_000, length), spans(rng, 50_000, length)
    a = spark.createDataFrame(rows_a, IV.format("player_key"))
    b = spark.createDataFrame(rows_b, IV.format("peer_key"))
    pairs = intervals.overlap_pairs(a, b, ["session_id"])
    plan = pairs._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "NestedLoop" not in plan
    assert pairs.count() == total(rows_a, rows_b)
    levels = sorted(r[0] for r in a.select(intervals._level(F.col("end_tick") - F.col("start_tick"))).distinct().collect())
    seen = intervals.starts_within(a.withColumnsRenamed({"start_tick": "lo", "end_tick": "hi"}), b.select("session_id", F.col("start_tick").alias("start")), ["session_id"], levels)
    assert seen.count() <= 2 * seen.filter("start >= lo AND start < hi").count()


def test_overlap_edges(spark):
    a = spark.createDataFrame([(1, "a", 0, 10), (1, "a", 10, 10), (1, "a", 20, 21), (2, "a", -9, -3)], IV.format("player_key"))
    b = spark.createDataFrame([(1, "b", 0, 10), (1, "b", 10, 20), (1, "b", 9, 30), (2, "b", -4, 5), (3, "b", 0, 9)], IV.format("peer_key"))
    got = intervals.overlap_ticks(a, b, ["session_id"], ["session_id"]).collect()
    assert {r.session_id: r.ticks for r in got} == {1: 10 + 1 + 1, 2: 1}
    assert intervals.overlap_ticks(a.limit(0), b, ["session_id"], ["session_id"]).count() == 0


@pytest.fixture(scope="module")
def busy(spark):
    rng = random.Random(4)
    users = [(s, u, f"n{u}", None, None, 100 + u, u % 5 == 0) for s in (1, 2) for u in range(12)]
    lines = [(1 if rng.random() < 0.95 else 2, i, rng.randrange(14), rng.choice(["a : hop", "b : no hops", "c : x"])) for i in range(600)]
    return spark.createDataFrame(lines, "session_id long, index int, from_user_id int, text string"), spark.createDataFrame(users, "session_id long, user_id int, name string, raw_id string, clean_id string, id64 long, is_bot boolean")


def test_neighbours_over_slices(busy):
    told = lambda rows: sorted(map(tuple, chat.chat_neighbours(*busy, 3, rows).collect()))
    assert told(2) == told(40) == told(10_000) and len(told(40)) > 20


def test_mentions_over_slices(busy):
    told = lambda rows: sorted(map(tuple, chat.export_mentions(*busy, "hop", 2, slice_rows=rows).collect()))
    assert told(30) == told(10_000) and told(30)


def test_block_pairs(spark):
    rows = spark.createDataFrame([(1, f"u{i}", i) for i in range(300)] + [(2, "u1", 5), (2, "u2", 6), (3, "u9", 7)], "session_id long, player_key string, seconds int")
    pairs = joins.block_pairs(rows, "session_id", "player_key", ["seconds"], 25)
    got = [tuple(r) for r in pairs.collect()]
    assert len(got) == len(set(got)) == 300 * 299 + 2 and (2, "u1", 5, "u2") in got
    # 12 parts by 12: no group of the join holds more than about two blocks.
    sizes = rows.filter("session_id = 1").groupBy(F.pmod(F.xxhash64("player_key"), F.lit(12))).count()
    assert sizes.agg(F.max("count")).first()[0] < 50
    assert [tuple(r) for r in joins.block_pairs(rows, "session_id", "player_key", ["seconds"], 1).filter("session_id = 2").collect()] and {t for t in got if t[0] == 2} == {(2, "u1", 5, "u2"), (2, "u2", 6, "u1")}


def test_no_window_over_a_whole_session(busy):
    plan = chat.chat_neighbours(*busy, 3, 40)._jdf.queryExecution().optimizedPlan().toString()
    windows = [x for x in plan.splitlines() if "Window [" in x]
    assert windows and all("slice" in x for x in windows)
