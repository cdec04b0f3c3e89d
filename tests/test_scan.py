"""Slices, halos and positions, and the record fold over slices against a plain loop."""

import random

import pytest
from pyspark.sql import functions as F

from ticklore.operators import records as R
from ticklore.operators import scan


@pytest.mark.parametrize("rows", [3, 10, 1000])
def test_slices_follow_the_order(spark, rows):
    rng = random.Random(rows)
    data = [(rng.choice("aab"), i) for i in rng.sample(range(1000), 60)]
    got = scan.sliced(spark.createDataFrame(data, "k string, i long"), ["k"], ["i"], rows).collect()
    assert sorted((r.k, r.i) for r in got) == sorted(data)
    order = sorted(got, key=lambda r: (r.k, r.i))
    assert [r.slice for r in order] == sorted(r.slice for r in order)
    if rows < 60:
        assert len({r.slice for r in got}) > 1


@pytest.mark.parametrize("rows", [2, 7, 1000])
def test_halo_and_positions(spark, rows):
    rng = random.Random(rows)
    data = sorted((rng.choice("aaab"), i, i * 10) for i in rng.sample(range(500), 50))
    s = scan.sliced(spark.createDataFrame(data, "k string, i long, v long"), ["k"], ["i"], rows)
    k, by = 3, {}
    for r in scan.halo(s, ["k"], ["i"], k, ["v"]).collect():
        by.setdefault((r.k, r.slice), []).append((r.i, r.v, r.own))
    for (key, _), got in by.items():
        group = [(i, v) for g, i, v in data if g == key]
        own = sorted((i, v) for i, v, mine in got if mine)
        if not own:
            continue
        at = group.index(own[0])
        assert sorted((i, v) for i, v, _ in got) == group[max(0, at - k) : at + len(own) + k]
    assert sum(mine for got in by.values() for *_, mine in got) == 50
    pos = {(r.k, r.i): r.pos for r in scan.positions(s, ["k"], ["i"]).collect()}
    for key in "ab":
        assert [pos[key, i] for g, i, _ in data if g == key] == list(range(1, sum(g == key for g, *_ in data) + 1))


def plain(rows, include_all):
    """The fold, row by row. rows: (cs, inferred, kind, how, number), in order."""
    cur, kept = None, []
    for cs, inferred, kind, how, n in rows:
        wipe = cur is not None and cs > cur and not inferred and (kind == "record" or how == "irc_set")
        if cur is None or cs < cur - inferred or wipe or (include_all and not inferred):
            cur, kept = cs, [*kept, n]
    return kept


@pytest.mark.parametrize("include_all", [False, True])
@pytest.mark.parametrize("slice_rows", [4, 25, 10_000])
def test_fold_over_slices(spark, slice_rows, include_all):
    """One hot segment and some small ones; long runs without anchors too."""
    rng = random.Random(slice_rows)
    rows = []
    for n in range(400):
        segment = rng.choice(["Map"] * 5 + ["Bonus 1", "bonus 1", "C2"])
        quiet = segment != "Map" or 100 < n < 330  # no anchors
        kind, how = rng.choice([("command", "rank_command"), ("announcement", "irc")] if quiet and rng.random() < 0.97 else [("record", "map_record"), ("announcement", "irc_set")])
        inferred = kind == "command" and rng.random() < 0.6
        rows.append((segment, 1000 - n // 3 + rng.randint(-4, 4), inferred, kind, how, n))
    df = spark.createDataFrame(rows, "seg string, cs int, inferred boolean, kind string, how string, n int").withColumns({"map": F.lit("m"), "class": F.lit("Demo"), "ord": F.struct("n", "cs")})
    got = sorted(r.n for r in R.fold_changes(df, ["map", "class"], include_all, slice_rows).collect())
    want = sorted(n for s in ("map", "bonus 1", "c2") for n in plain([r[1:] for r in rows if r[0].lower() == s], include_all))
    assert got == want


def test_no_window_over_a_whole_segment(spark):
    rows = spark.createDataFrame([("Map", i, False, "record", "map_record", i) for i in range(5000)], "seg string, cs int, inferred boolean, kind string, how string, n int").withColumns({"map": F.lit("m"), "class": F.lit("Demo"), "ord": F.struct("n", "cs")})
    s = scan.sliced(rows.withColumn("low", F.lower("seg")), ["map", "class", "low"], ["ord"], 500)
    assert s.groupBy("slice").count().agg(F.max("count")).first()[0] < 1500
    assert R.fold_changes(rows, ["map", "class"], False, 500).count() == 5000
