"""Queries of the sources and sinks: what is landed, written and read back, each with SQL from the raw tables on."""

from __future__ import annotations

from pyspark.sql import functions as F

from ticklore.operators import chat, joins, records
from ticklore.plans.inputs import chat_tables, event_tables, records_of
from ticklore.plans.sql import CV, EV, REC, SAID, days, fold
from ticklore.sources import adapters as ad
from ticklore.sources import ingest, schemas, sinks
from ticklore.sources.shared import shared_path
from ticklore.sources.store import SessionStore
from ticklore.streaming.landing import landed_index, reland, start_landing


def record_pages(spark, d):
    o = ad.table(spark, d, "orders")
    url = F.when(F.col("o_orderkey") % 9 == 0, " ").otherwise(F.col("o_orderpriority"))
    run = F.struct(F.col("o_orderkey").alias("id"), F.col("o_orderkey").cast("double").alias("date"), F.struct(F.col("o_custkey").alias("id"), url.alias("url")).alias("demo_info"))
    side = lambda odd: F.array_sort(F.collect_list(F.when(F.col("o_orderkey") % 2 == odd, run)))
    pages = o.groupBy(F.floor(F.col("o_orderkey") / 50).alias("page_no")).agg(side(0).alias("soldier"), side(1).alias("demoman"))
    known = o.filter("o_custkey % 4 = 0").select(F.col("o_custkey").alias("id"))
    return ingest.ingest_record_pages(pages, known).select("id", "url", "date", "processed")


def zones(spark, d):
    p = ad.table(spark, d, "part")
    zone = F.struct((F.col("p_partkey") % 700).alias("id"))
    lists = [F.array_compact(F.collect_list(F.when(F.col("p_partkey") % len(schemas.ZONE_LISTS) == i, zone))).alias(z) for i, z in enumerate(schemas.ZONE_LISTS)]
    return ingest.enumerate_zones(p.groupBy(F.col("p_size").cast("bigint").alias("map_id")).agg(*lists))


def landed(name, *cols):
    return lambda spark, d: ingest.land_sessions(event_tables(spark, d).documents())[name].withColumnRenamed("map", "map_name").select(*cols)


def quarantined_index(spark, d):
    t = event_tables(spark, d)
    return ingest.quarantine(t.index(), ingest.land_sessions(t.documents())["quarantine"])


def relanded_spawns(spark, d):
    """Every third session is landed again, with another class; a few of those documents cannot be read and change nothing."""
    docs = event_tables(spark, d).documents()
    store = SessionStore(spark, shared_path(spark, "store"), 8)
    store.put(docs, "first")
    cut = F.col("session_id") % 4 == 0
    again = docs.withColumn("body", F.when(cut, F.substring("body", 1, 30)).otherwise(F.regexp_replace("body", '"class":"soldier"', '"class":"scout"')))
    reland(store, again, docs.filter("session_id % 3 = 0").select(F.col("session_id").alias("id")))
    return store.read("spawns").select("session_id", "index", "tick", "user_id", "class")


def redelivered_spawns(spark, d):
    """Sessions that come in several files: twice in the first batch, and again in a second one. The last readable document of each counts."""
    docs = event_tables(spark, d).documents()
    into, out, mark = (shared_path(spark, f"landing-{x}") for x in ("in", "out", "mark"))
    called = lambda name: F.regexp_replace("body", '"class":"soldier"', f'"class":"{name}"')
    docs.withColumn("sent", F.lit(1)).write.mode("append").json(into)
    docs.filter("session_id % 3 = 0").select("session_id", called("scout").alias("body"), F.lit(2).alias("sent")).write.mode("append").json(into)
    start_landing(spark, into, out, mark, 8).awaitTermination()
    docs.filter("session_id % 5 = 0").select("session_id", called("pyro").alias("body"), F.lit(1).alias("sent")).write.mode("append").json(into)
    docs.filter("session_id % 7 = 0").select("session_id", F.lit("{").alias("body"), F.lit(9).alias("sent")).write.mode("append").json(into)
    start_landing(spark, into, out, mark, 8).awaitTermination()
    return SessionStore(spark, out).read("spawns").select("session_id", "index", "tick", "user_id", "class")


def reland_list(spark, d):
    return ingest.to_reland(event_tables(spark, d).index(), 3, 20)


def incremental_landing(spark, d):
    """The documents as JSON lines, landed file by file; the second start finds nothing new but what was added."""
    docs = event_tables(spark, d).documents()
    into, out, mark = (shared_path(spark, f"landing-{x}") for x in ("in", "out", "mark"))
    for part in (0, 1):
        docs.filter(F.col("session_id") % 2 == part).write.mode("append").json(into)
        start_landing(spark, into, out, mark, 8).awaitTermination()
    return SessionStore(spark, out).read("spawns").select("session_id", "index", "tick", "user_id", "class")


def landed_flags(spark, d):
    t = event_tables(spark, d)
    into, out, mark = (shared_path(spark, f"landing-{x}") for x in ("in", "out", "mark"))
    t.documents().write.json(into)
    start_landing(spark, into, out, mark, 8).awaitTermination()
    return landed_index(t.index(), SessionStore(spark, out).read("outcome"))


def csv_round_trip(spark, d):
    chats, _, sessions, index = chat_tables(spark, d)
    path = shared_path(spark, "csv")
    sinks.write_csv(joins.with_session(chats, sessions, index).select("session_id", "index", "map", F.when(F.col("index") > 0, F.col("from_name")).alias("from_name")), path)
    return sinks.read_csv(spark, path, "session_id bigint, index bigint, map string, from_name string")


def history_files(spark, d):
    """The export with a file for each map and class, read back."""
    h = records.export_history(records.record_history(records_of(event_tables(spark, d))))
    path = shared_path(spark, "history")
    sinks.write_partitioned(h, path, ["map", "class"], ["date"])
    back = sinks.read_csv(spark, path, ", ".join(f"{c} string" for c in schemas.EXPORT))
    return back.select([F.col(c).alias("map_name" if c == "map" else c) for c in schemas.EXPORT])


def chat_log(spark, d):
    chats, _, sessions, index = chat_tables(spark, d)
    rows = joins.with_session(chats, sessions, index).withColumn("ts", F.date_format(F.timestamp_seconds("date"), "yyyy-MM-dd HH:mm:ss"))
    path = shared_path(spark, "log")
    sinks.write_lines(rows, path)
    return spark.read.text(path).select(F.col("value").alias("line"))


def names_read(spark, d):
    path = shared_path(spark, "names")
    ad.table(spark, d, "customer").select(F.concat_ws(" ", "c_mktsegment", "c_name")).write.text(path)
    return sinks.read_names(spark, path)


def user_chat(spark, d):
    chats, users, sessions, index = chat_tables(spark, d)
    return chat.export_user_chat(chats, users, sessions, index, str(76561197960265728 + 2 + 1))


def server_records(spark, d):
    t = event_tables(spark, d)
    return chat.server_records(t.record_chat(), t.sessions, "v 1").withColumnRenamed("map", "map_name")


_SPAWN = landed("spawns", "session_id", "index", "tick", "user_id", "class")
QUERIES = {
    "record_pages": record_pages, "zones": zones, "landed_spawns": _SPAWN,
    "landed_sessions": landed("sessions", "session_id", "map_name", "server", "ticks", "start_tick", "interval_per_tick"),
    "landed_users": landed("users", "session_id", "user_id", "name", "clean_id", "id64", "id_kind", "is_bot", "entity_id"),
    "landed_chats": landed("chats", "session_id", "index", "from_name", "text", "tick", "client_entity_id", "from_user_id"),
    "landed_changes": landed("team_changes", "session_id", "index", "tick", "user_id", "team", "disconnect"),
    "landed_deaths": landed("deaths", "session_id", "index", "tick", "weapon", "victim_user_id", "killer_user_id"),
    "landed_pauses": landed("pauses", "session_id", "index", "from_tick", "to_tick"),
    "quarantined_index": quarantined_index, "relanded_spawns": relanded_spawns, "redelivered_spawns": redelivered_spawns, "reland_list": reland_list, "incremental_landing": incremental_landing, "landed_flags": landed_flags,
    "csv_round_trip": csv_round_trip, "history_files": history_files, "chat_log": chat_log, "names_read": names_read, "user_chat": user_chat, "server_records": server_records,
}

#: Events of the sessions whose documents can be read, as they stand in the documents.
_DOC = f"""{EV}, g AS (SELECT *, tick % 1000000 AS tk, user_id % 50 AS entity FROM e WHERE session_id % 11 NOT IN (0, 5)),
b AS (SELECT session_id, row_number() OVER (PARTITION BY session_id ORDER BY idx) - 1 AS "index", tk AS tick, user_id, CASE event_type WHEN 'signup' THEN 'soldier' ELSE 'demoman' END AS class FROM g WHERE event_type IN ('signup', 'click')),
ei AS (SELECT session_id AS id, 'http://x/' || session_id AS url, 1704067200.0::DOUBLE + (session_id // 8) * 86400 AS date, session_id % 4 = 0 AS processed, session_id % 4 = 1 AS failed, CASE WHEN session_id % 4 = 1 THEN 'gone' END AS failure_reason, session_id % 11 IN (0, 5) AS bad FROM s)"""


def _each(kinds, cols):
    return f"""WITH {_DOC} SELECT session_id, row_number() OVER (PARTITION BY session_id ORDER BY idx) - 1 AS "index", {cols} FROM g WHERE {kinds}"""


_SPAWNS = f"WITH {_DOC} SELECT * FROM b"
ORACLES = {
    "record_pages": """SELECT id, url, date, false AS processed FROM (SELECT o_custkey AS id, o_orderpriority AS url, o_orderkey::DOUBLE AS date FROM orders WHERE o_orderkey % 9 <> 0 AND o_custkey % 4 <> 0
      QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey // 50, o_orderkey % 2, o_orderkey) = 1)""",
    "zones": "SELECT min(p_size)::BIGINT AS map_id, p_partkey % 700 AS zone_id FROM part GROUP BY 2",
    "landed_spawns": _SPAWNS,
    "landed_sessions": f"WITH {_DOC} SELECT DISTINCT session_id, 'map_' || (session_id % 7) AS map_name, 'srv ' || (session_id % 3) AS server, 1000000 AS ticks, 3 AS start_tick, 0.015::DOUBLE AS interval_per_tick FROM g",
    "landed_users": f"""WITH {_DOC} SELECT DISTINCT session_id, user_id, 'user_' || user_id AS name, CASE user_id % 4 WHEN 0 THEN 'STEAM_0:1:' || user_id WHEN 1 THEN '[U:1:' || user_id || ']' WHEN 2 THEN 'BOT' ELSE 'weird' END AS clean_id,
      CASE user_id % 4 WHEN 0 THEN 76561197960265728 + 2 * user_id + 1 WHEN 1 THEN 76561197960265728 + user_id END AS id64, CASE user_id % 4 WHEN 0 THEN 'steam2' WHEN 1 THEN 'steam3' WHEN 2 THEN 'bot' ELSE 'unknown' END AS id_kind, user_id % 4 = 2 AS is_bot, entity AS entity_id FROM g""",
    "landed_chats": f"""WITH {_DOC}, m AS (SELECT session_id, entity, max(user_id) AS who FROM (SELECT DISTINCT session_id, entity, user_id FROM g) GROUP BY 1, 2 HAVING count(*) = 1)
      SELECT c.*, who AS from_user_id FROM (SELECT session_id, row_number() OVER (PARTITION BY session_id ORDER BY idx) - 1 AS "index", 'user_' || user_id AS from_name, 'line ' || idx AS text, tk AS tick, entity AS client_entity_id FROM g WHERE idx % 10 > 1) c LEFT JOIN m ON m.session_id = c.session_id AND m.entity = c.client_entity_id""",
    "landed_changes": _each("event_type IN ('view', 'purchase')", "tk AS tick, user_id, CASE event_type WHEN 'view' THEN 'spectator' ELSE 'red' END AS team, event_type = 'purchase' AS disconnect"),
    "landed_deaths": _each("event_type = 'error'", "tk AS tick, 'rocket' AS weapon, user_id AS victim_user_id, user_id + 1 AS killer_user_id"),
    "landed_pauses": _each("idx % 7 = 0", "tk AS from_tick, tk + 5 AS to_tick"),
    "quarantined_index": f"WITH {_DOC} SELECT id, url, date, processed, failed OR (bad AND NOT processed) AS failed, CASE WHEN bad AND NOT processed THEN 'invalid_stv' ELSE failure_reason END AS failure_reason FROM ei",
    "relanded_spawns": f"""WITH {_DOC} SELECT session_id, "index", tick, user_id, CASE WHEN session_id % 3 = 0 AND session_id % 4 <> 0 AND class = 'soldier' THEN 'scout' ELSE class END AS class FROM b""",
    "redelivered_spawns": f"""WITH {_DOC} SELECT session_id, "index", tick, user_id, CASE WHEN class = 'soldier' AND session_id % 5 = 0 THEN 'pyro' WHEN class = 'soldier' AND session_id % 3 = 0 THEN 'scout' ELSE class END AS class FROM b""",
    "reland_list": f"WITH {_DOC} SELECT id FROM ei WHERE processed ORDER BY id LIMIT 20 OFFSET 3",
    "incremental_landing": _SPAWNS,
    "landed_flags": f"""WITH {_DOC} SELECT id, url, date, processed OR NOT bad AS processed, CASE WHEN NOT bad AND NOT processed THEN false WHEN bad AND NOT processed THEN true ELSE failed END AS failed,
      CASE WHEN bad AND NOT processed THEN 'invalid_stv' WHEN NOT bad AND NOT processed THEN NULL ELSE failure_reason END AS failure_reason FROM ei""",
    "csv_round_trip": f"""WITH {CV} SELECT session_id, "index", map, CASE WHEN "index" > 0 THEN from_name END AS from_name FROM ch JOIN ss USING (session_id)""",
    "history_files": f"""WITH RECURSIVE {EV}, {REC}, {fold('map_name, class, seg')}, {days('map_name, class, seg')}
      SELECT strftime(make_timestamp((date * 1000000)::BIGINT), '%Y-%m-%d') AS date, map_name, class, seg AS segment, 'WR' AS record_type, kind AS evidence, {SAID}, player, player_id, NULL::VARCHAR AS candidates, CASE WHEN kind = 'record' THEN session_id END::VARCHAR AS session_id FROM hd""",
    "chat_log": f"""WITH {CV} SELECT strftime(make_timestamp((date * 1000000)::BIGINT), '%Y-%m-%d %H:%M:%S') || ' | ' || map || ' | ' || server || ' | ' || regexp_replace(text, '[\\r\\n]+', ' ', 'g') AS line FROM ch JOIN ss USING (session_id) JOIN ix ON id = session_id""",
    "names_read": "SELECT lower(c_name) AS name FROM customer",
    "user_chat": f"""WITH {CV} SELECT date, c.session_id, "index", map, text FROM ch c JOIN us USING (session_id, uid) JOIN ss USING (session_id) JOIN ix ON id = c.session_id WHERE id64 = 76561197960265728 + 3""",
    "server_records": f"""WITH {EV}, {REC} SELECT session_id, chat_index AS "index", 'map_' || (session_id % 7) AS map_name, 'srv 1' AS server, 'SRV | (' || CASE class WHEN 'Solly' THEN 'Soldier' WHEN 'Demo' THEN 'Demoman' ELSE class END || ') ' || player || ' broke ' ||
      CASE chat_index % 12 WHEN 3 THEN 'Bonus 1 ' || tm || ' (WR -00:00.10) | 00:00.10 improvement!' WHEN 5 THEN 'Course 2 ' || tm || ' (WR -00:00.25)' ELSE 'C2 - Jump One ' || tm || ' (WR -00:00.10)' END AS text FROM r WHERE chat_index % 12 IN (3, 5, 6) AND session_id % 3 = 1""",
}
