"""Files of a review's chat, its long table, and masks in what is shown."""

import os

from pyspark.sql import functions as F

from ticklore.operators import chat, review
from ticklore.sources import sinks
from ticklore.sources.shared import shared_path

SCHEMA = "player_key string, ts string, map string, server string, session_id bigint, tick int, index int, text string"
ODD = ['say "hi", then \\"', " blanks ", "two\nlines\r\nthree", "back\\slash,\\", '"', "a;b|c", "ünïcode"]


def test_texts_come_back_and_a_busy_player_is_split(spark):
    rows = [("64:1", "2024-01-01 00:00:00", "m", "s", i // 100, i, i, ODD[i % len(ODD)]) for i in range(3000)] + [("id:X/Y", "2024-01-02 00:00:00", "m", "s", 1, None, 0, None)]
    df = spark.createDataFrame(rows, SCHEMA)
    path = shared_path(spark, "chat-test")
    join_small = "spark.sql.adaptive.coalescePartitions.enabled"
    spark.conf.set(join_small, "false")
    try:
        sinks.write_chat(df.repartition(4), path, ["player_key"], ["ts", "session_id", "index"])
    finally:
        spark.conf.unset(join_small)
    back = sinks.read_chat(spark, path, SCHEMA)
    assert sorted(map(tuple, back.collect()), key=str) == sorted(rows, key=str)
    local = path.removeprefix("file://")
    files = {d: [f for f in os.listdir(f"{local}/csv/{d}") if f.startswith("part")] for d in os.listdir(f"{local}/csv") if d.startswith("p_")}
    assert len(files) == 2 and max(map(len, files.values())) > 1
    lines = spark.read.text(f"{local}/lines").select("value").collect()
    assert len(lines) == len(rows)


def test_files_of_a_player_are_in_order(spark):
    df = spark.createDataFrame([("p", f"2024-01-01 00:{i // 60:02}:{i % 60:02}", "m", "s", 1, i, i, str(i)) for i in range(2000)], SCHEMA)
    path = shared_path(spark, "chat-test")
    sinks.write_chat(df.repartition(4), path, ["player_key"], ["ts", "session_id", "index"])
    folder = f"{path.removeprefix('file://')}/lines/p_player_key=p"
    told = [line.rstrip("\n").split(" | ")[-1] for f in sorted(os.listdir(folder)) if f.startswith("part") for line in open(f"{folder}/{f}")]
    assert told == [str(i) for i in range(2000)]


def _tables(spark):
    chats = spark.createDataFrame([(1, 0, "Ann : darn the darnest", 10, 1, "Ann"), (1, 1, "Bob : DARN lol", 20, 2, "Bob"), (2, 0, "Ann : darn", 5, 1, "Ann"), (3, 0, "Ann : old darn", 5, 1, "Ann"), (1, 2, None, 30, 9, None)], "session_id bigint, index int, text string, tick int, from_user_id int, from_name string")
    users = spark.createDataFrame([(s, u, n, None, None, u + 100, False) for s in (1, 2, 3) for u, n in ((1, "Ann"), (2, "Bob"))], "session_id bigint, user_id int, name string, raw_id string, clean_id string, id64 bigint, is_bot boolean")
    sessions = spark.createDataFrame([(1, "m1", "s1"), (2, "m2", None), (3, "m1", "s1")], "session_id bigint, map string, server string")
    index = spark.createDataFrame([(1, "u1", 1704067200.0), (2, "u2", 1706745600.0), (3, "u1", 1600000000.0)], "id bigint, url string, date double")
    return {"chats": chats, "users": users, "sessions": sessions, "index": index}


def test_masks_are_over_what_is_shown_only(spark):
    plain, starred = (review.year_review(_tables(spark), 2024, 5, masked=m) for m in (None, ("darn", "first")))
    said = {(r.player_key, r.session_id, r["index"]): (r.ts, r.server, r.text) for r in starred["chat"].collect()}
    assert said == {
        ("64:101", 1, 0): ("2024-01-01 00:00:00", "s1", "Ann : d*** the darnest"), ("64:102", 1, 1): ("2024-01-01 00:00:00", "s1", "Bob : D*** lol"),
        ("64:101", 2, 0): ("2024-02-01 00:00:00", "unknown", "Ann : d***"),
    }
    words = {(r.player_key, r.word): (r.n, r.rank) for r in starred["top_words"].collect()}
    assert words[("64:101", "d***")] == (2, 1) and ("64:101", "darn") not in words
    assert {tuple(r) for r in starred["style"].collect()} == {tuple(r) for r in plain["style"].collect()}


def test_long_table_holds_each_part(spark):
    parts = review.year_review(_tables(spark), 2024, 5)
    long = review.year_sheet(parts)
    assert long.columns == ["player_key", "part", "key", "metric", "value"]
    assert {r.part for r in long.select("part").distinct().collect()} == set(parts) - {"chat"}
    got = {(r.key, r.metric): r.value for r in long.filter((F.col("player_key") == "64:101") & F.col("part").isin("top_words", "messages")).collect()}
    assert got[("darn", "n")] == 2 and got[("", "last_message")] == 1706745600.0


def test_lines_of_urls(spark):
    t = _tables(spark)
    urls = spark.createDataFrame([("u1",), ("u1",), ("none",)], "url string")
    rows = chat.export_url_chat(t["chats"], urls, t["sessions"], t["index"]).collect()
    assert [(r.session_id, r.url, r.date, r.map, r.tick, r.from_name, r.text) for r in rows] == [
        (1, "u1", "2024-01-01", "m1", 10, "Ann", "Ann : darn the darnest"), (1, "u1", "2024-01-01", "m1", 20, "Bob", "Bob : DARN lol"), (1, "u1", "2024-01-01", "m1", 30, "", ""),
    ]
