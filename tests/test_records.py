import pytest
from pyspark.sql import functions as F

from ticklore.operators import records as R

# The wording of the messages is fixed; names, maps, times and numbers are our own.
CASES = [
    ("(Demoman) Ferro beat the map record: 00:58.40 (-00:00.10)", {"source": "MapRecord", "class": "Demo", "split": "-00:00.10", "inferred": False, "is_lookup": False}),
    ("(Soldier) Ferro beat the map record: 00:58.40!", {"source": "MapRecord", "class": "Solly", "split": None, "improvement": None}),
    ("(Demo) Ferro beat the map record: 00:58.40 (SR -00:00.10) | 00:00.10 improvement!", {"source": "MapRecord", "improvement": "00:00.10"}),
    ("(Demo) Ferro beat the map record: 00:58.40 (PR -00:00.10) | 00:00.10 improvement!", {"source": "MapRecord", "improvement": "00:00.10"}),
    ("(Demo) Ferro set the first map record: 00:58.40!", {"source": "FirstRecord"}),
    ("(Demo) Ferro broke Bonus 1 00:09.72 (WR -00:00.10) | 00:00.10 improvement!", {"source": "Bonus 1", "is_lookup": False}),
    ("(Demo) Ferro set Bonus 1 00:09.72!", {"source": "Bonus 1 First", "split": None}),
    ("(Demo) Ferro broke Course 2 00:14.05 (WR -00:00.25)", {"source": "Course 2"}),
    ("(Demo) Ferro broke C2 - Jump One 00:06.18 (WR -00:00.10)", {"source": "C2 - Jump One"}),
    ("(Demo) Ferro set C2 - Jump One 00:06.18!", {"source": "C2 - Jump One First"}),
    ("(Demo) Ferro map run 00:58.40 (WR -00:00.10)", {"source": "MapRun", "run_time": "00:58.40", "record_time": "00:58.40", "inferred": False}),
    ("(Demo) Ferro map run 00:58.40 (WR +00:00.10)", None),
    ("(Demo) Ferro is ranked 1/31 on hop_quarry Bonus 1 with time: 00:09.72", {"source": "Bonus 1", "inferred": True, "is_lookup": True, "map": "hop_quarry"}),
    ("(Demo) Ferro is ranked 2/31 on hop_quarry with time: 00:09.72", None),
    ("(Demo WR) hop_cinder/Bonus 1 :: 00:07.31 :: Quill Nine", {"source": "Bonus 1", "is_lookup": True, "player": "Quill Nine", "map": "hop_cinder"}),
    ("(Demo) marrow is ranked 1/57 on hop_lantern_b2 with time: 01:12.46", {"source": "Ranked", "inferred": True, "is_lookup": True}),
]


@pytest.fixture(scope="module")
def parsed(spark):
    df = spark.createDataFrame([(i, R.PREFIX + t) for i, (t, _) in enumerate(CASES)], "i int, text string")
    return {r.i: r.e for r in df.select("i", R.parse_record(F.col("text"), F.lit("hop_quarry")).alias("e")).collect()}


@pytest.mark.parametrize("i", range(len(CASES)))
def test_forms(parsed, i):
    want = CASES[i][1]
    if want is None:
        assert parsed[i] is None
    else:
        assert parsed[i].record_type == "WR" and {k: parsed[i][k] for k in want} == want


def test_relay(spark):
    df = spark.createDataFrame([(":: (Demo) Ferro broke hop_quarry WR: 00:58.40 (WR -00:00.10)!",), ("x\n:: (Demo) Ferro set hop_quarry WR: 00:58.40!",)], "text string")
    a, b = (r.e for r in df.select(R.parse_relay(F.col("text")).alias("e")).collect())
    assert (a.source, a.map, a.split) == ("IRC", "hop_quarry", "-00:00.10") and (b.source, b.split) == ("IRCSet", None)


DAY = 86400.0
SCHEMA = "player string, class string, map string, record_type string, source string, record_time string, run_time string, split string, improvement string, inferred boolean, date double, session_id long, id64 string, clean_id string, candidates string, is_lookup boolean, chat_index int, chat_tick int"


def row(source, time, date, session=None, inferred=False, lookup=False, player="Player", id64=None):
    return (player, "Demo", "m", "WR", source, time, None, None, None, inferred, date, session, id64, None, None, lookup, 0, None)


def history(spark, rows):
    h = R.record_history(spark.createDataFrame(rows, SCHEMA))
    return [r.asDict() for r in h.orderBy("ord").collect()]


def test_order_within_a_day(spark):
    h = history(spark, [row("MapRecord", "00:51.27", DAY, 902), row("MapRecord", "00:52.90", DAY, 417)])
    assert [x["record_time"] for x in h] == ["00:52.90", "00:51.27"]


def test_observed_holder(spark):
    seen = row("MapRun", "00:58.15", DAY, 5, inferred=True, id64="123")
    (h,) = history(spark, [seen])
    assert (h["source"], h["player"], h["session_id"], h["id64"]) == ("ObservedWR", "unknown", None, None)
    (h,) = history(spark, [seen, row("Compact", "00:58.15", 2 * DAY, 9, lookup=True, player="Tansy", id64="456")])
    assert (h["player"], h["id64"], h["session_id"]) == ("Tansy", "456", None)


def test_command_suppressed(spark):
    (h,) = history(spark, [row("MapRecord", "00:58.40", DAY, 1), row("Compact", "00:58.40", 2 * DAY, 2, lookup=True)])
    assert h["source"] == "MapRecord"


def test_wipe_kept(spark):
    h = history(spark, [row("IRCSet", "00:14.05", DAY, 1), row("MapRecord", "00:24.60", 2 * DAY, 2), row("MapRecord", "00:19.35", 3 * DAY, 3)])
    assert [x["record_time"] for x in h] == ["00:14.05", "00:24.60", "00:19.35"]


def test_fold_margin(spark):
    h = history(spark, [row("MapRecord", "00:19.35", DAY, 1), row("Ranked", "00:19.34", 2 * DAY, 2, inferred=True, lookup=True), row("Ranked", "00:19.33", 3 * DAY, 3, inferred=True, lookup=True)])
    assert [x["record_time"] for x in h] == ["00:19.35", "00:19.33"]


def test_identity(spark):
    users = spark.createDataFrame([(1, 1, "Wren", None, None, 11), (1, 2, "Wrex", None, None, 12), (1, 3, "Ivo", None, None, 13)], "session_id long, user_id int, name string, raw_id string, clean_id string, id64 long")
    df = spark.createDataFrame([(1, None, "Wre..."), (1, None, "ivo"), (1, 2, "whoever")], "session_id long, from_user_id int, player string")
    got = {r.player: r for r in R.resolve_identity(df, users).collect()}
    assert got["Wre..."].id64 is None and got["Wre..."].candidates.count(";") == 1
    assert got["ivo"].id64 == "13" and got["whoever"].id64 == "12"


def test_cut_names_by_their_beginnings(spark):
    """Blank stems match nothing, long ones are compared whole, and no session's names meet all of its cut names."""
    long = "n" * 80
    names = ["Wren", "wrex", long + "a", long + "b", "n", None, " "]
    users = spark.createDataFrame([(s, i, n, None, None, 10 * s + i) for s in (1, 2) for i, n in enumerate(names)], "session_id long, user_id int, name string, raw_id string, clean_id string, id64 long")
    asked = ["Wr...", "wren...", "...", " ...", long + "B...", long + "...", "x...", "wren x..."]
    df = spark.createDataFrame([(1, None, a) for a in asked] + [(3, None, "Wr...")], "session_id long, from_user_id int, player string")
    got = {(r.session_id, r.player): (r.id64, (r.candidates or "").count(";") + bool(r.candidates)) for r in R.resolve_identity(df, users).collect()}
    assert got == {(1, "Wr..."): (None, 2), (1, "wren..."): ("10", 0), (1, "..."): (None, 0), (1, " ..."): (None, 0), (1, long + "B..."): ("13", 0), (1, long + "..."): (None, 2), (1, "x..."): (None, 0), (1, "wren x..."): (None, 0), (3, "Wr..."): (None, 0)}


def test_history_takes_records_of_two_classes(spark):
    rows = [row("MapRecord", "00:50.00", DAY, 1), row("MapRecord", "00:40.00", DAY, 2), row("MapRecord", "00:30.00", DAY, 3), row("Compact", "00:20.00", DAY, 4, lookup=True)]
    rows[1], rows[2] = (*rows[1][:1], "Scout", *rows[1][2:]), (*rows[2][:1], "demo", *rows[2][2:])
    rows[3] = (*rows[3][:3], "SR", *rows[3][4:])
    df = spark.createDataFrame(rows, SCHEMA).withColumn("text", F.lit("x"))
    assert [r.record_time for r in R.record_history(df).collect()] == ["00:50.00"] and R.audit_records(df).count() == 0
    assert R.record_history(df, any_kind=True).count() == 4


def test_lines_are_parsed_once(spark):
    t = __import__("ticklore.plans.inputs", fromlist=["x"])
    plan = R.record_history(t.records_of(t.event_tables(spark, "/root/testdata/sf0.001")))._jdf.queryExecution().optimizedPlan().toString()
    assert "regexp" not in plan.lower().replace("regexp_replace(source", "")


def test_runs_keep_their_label(spark):
    lines = ["(Demo) Ferro map run 00:58.40 (PR +00:00.10) | 00:00.30 improvement!", "(Demo) Ferro map run 00:58.40 (WR -00:00.10)", "(Soldier) Ferro map run 00:75.40 (PR 00:00.10)", "(Demo) Ferro is ranked 1/31 on hop_quarry with time: 00:09.72"]
    chats = spark.createDataFrame([(1, i, 7, R.PREFIX + t) for i, t in enumerate(lines)], "session_id long, index int, from_user_id long, text string")
    sessions = spark.createDataFrame([(1, "hop_quarry")], "session_id long, map string")
    index = spark.createDataFrame([(1, 5.0)], "id long, date double")
    users = spark.createDataFrame([(1, 7, "Ferro", None, None, 11)], "session_id long, user_id long, name string, raw_id string, clean_id string, id64 long")
    runs = lambda **more: [(r.label, r["class"], r.run_time, r.split, r.improvement) for r in R.map_runs(chats, sessions, index, users, **more).orderBy("chat_index").collect()]
    assert runs() == [("PR", "Demo", "00:58.40", "+00:00.10", "00:00.30"), ("PR", "Solly", "01:15.40", "00:00.10", None)]
    assert len(runs(include_record=True)) == 3 and runs(player="12") == [] and len(runs(player="11", class_="S")) == 1 and len(runs(only_map="hop")) == 2


def test_time_by_places(spark):
    from ticklore.functions.scalars import normalize_signed_time, normalize_time

    times = ["00:58.40", "5:07.01", "99:99.99", "1:02:03.42", "01:00:00.00"]
    df = spark.createDataFrame([(t,) for t in times], "t string").select(R._time(F.col("t")).alias("a"), normalize_time(F.col("t")).alias("b"), R._signed(F.concat(F.lit("-"), "t")).alias("c"), normalize_signed_time(F.concat(F.lit("-"), "t")).alias("d"))
    assert all(r.a == r.b and r.c == r.d for r in df.collect())
