from ticklore.operators import intervals as I


def tables(spark, rows, ticks=50):
    ev = [(1, 7, t, k, i, c) for i, (t, k, c) in enumerate(rows)]
    events = spark.createDataFrame(ev, "session_id long, user_id long, tick long, kind int, index int, class string")
    ends = I.session_ends(spark.createDataFrame([(1, ticks, 1.0)], "session_id long, ticks int, interval_per_tick double"), events)
    return events, ends


def alive(spark, rows, ticks=50):
    return sorted((r.start_tick, r.end_tick, r["class"]) for r in I.alive_intervals(*tables(spark, rows, ticks)).collect())


def test_alive(spark):
    assert alive(spark, [(10, 2, "soldier"), (30, 0, None), (30, 2, "demoman")]) == [(10, 30, "soldier"), (30, 50, "demoman")]
    assert alive(spark, [(10, 2, "scout"), (20, 0, None)]) == []
    assert alive(spark, [(10, 2, "soldier"), (15, 2, "soldier")], 20) == [(10, 15, "soldier"), (15, 20, "soldier")]


def test_end_tick_without_header(spark):
    _, ends = tables(spark, [(10, 2, "soldier"), (40, 0, None)], None)
    assert ends.first().end_tick == 40


def spectating(spark, changes, spawns, end=30):
    c = spark.createDataFrame([(1, 7, t, i, "spectator", False) for i, t in enumerate(changes)], "session_id long, user_id long, tick long, index int, team string, disconnect boolean")
    s = spark.createDataFrame([(1, 7, t, 100 + i) for i, t in enumerate(spawns)], "session_id long, user_id long, tick long, index int")
    e = spark.createDataFrame([(1, end, 1.0)], "session_id long, end_tick long, interval_per_tick double")
    return sorted((r.start_tick, r.end_tick) for r in I.spectator_intervals(c, s, e).collect())


def test_spectating(spark):
    assert spectating(spark, [10, 12], [20]) == [(10, 20)]
    assert spectating(spark, [25], []) == [(25, 30)]


def test_merge_and_overlap(spark):
    iv = spark.createDataFrame([(1, 0, 5), (1, 5, 9), (1, 12, 13)], "k long, start_tick long, end_tick long")
    assert sorted(tuple(r) for r in I.merge_intervals(iv, ["k"]).collect()) == [(1, 0, 9), (1, 12, 13)]
    a, b = (spark.createDataFrame([x], "k long, start_tick long, end_tick long") for x in ((1, 0, 10), (1, 5, 20)))
    assert I.overlap_ticks(a, b, ["k"], ["k"]).first().ticks == 5
