"""Queries over the archive-shaped tables, and DuckDB SQL that says the same, from the raw tables on."""

from __future__ import annotations

from pyspark.sql import functions as F

from ticklore.operators import chat, intervals, joins, playtime, records, review
from ticklore.operators.filters import class_matches
from ticklore.plans import landing_queries, review_queries
from ticklore.plans.inputs import alive_of, chat_tables, event_tables, per_session_of, records_of, records_plan, watching_of
from ticklore.plans.sql import COUNTS, CV, EV, MG, PER, REC, SAID, SIX, STOP, TOK, days, fold
from ticklore.sources import adapters as ad
from ticklore.sources import ingest
from ticklore.sources.layout import located
from ticklore.sources.shared import stored


def alive(spark, d):
    return alive_of(event_tables(spark, d)).select("session_id", "user_id", "class", "start_tick", "end_tick")


def watching(spark, d):
    return watching_of(event_tables(spark, d)).select("session_id", "user_id", "start_tick", "end_tick")


def map_playtime(spark, d):
    t = event_tables(spark, d)
    return playtime.map_playtime(per_session_of(t), t.sessions)


def map_spectating(spark, d):
    t = event_tables(spark, d)
    return playtime.map_spectating(watching_of(t), t.users, t.sessions)


def merged(spark, d):
    t = event_tables(spark, d)
    return intervals.merge_intervals(alive_of(t).join(t.users, ["session_id", "user_id"]), ["session_id", "player_key"])


def peers(spark, d):
    t = event_tables(spark, d)
    return playtime.spectator_peers(alive_of(t), watching_of(t), t.users)


def playtime_counts(spark, d):
    t = event_tables(spark, d)
    return review.playtime_counts(per_session_of(t), t.sessions, t.index())


def keyword_rank(spark, d):
    chats, users, _, _ = chat_tables(spark, d)
    return chat.keyword_rank(chats, users, ["the", "onth"])


def located_chat(spark, d):
    """Chat lines with their users, map and date, from tables bucketed by session."""
    chats, users, sessions, index = chat_tables(spark, d)
    t = located({"chats": chats, "users": users, "sessions": sessions}, 4, {"chats": ["index"]})
    return joins.with_session(joins.chats_with_users(t["chats"], t["users"]), t["sessions"], index).select("session_id", "index", "name", "id64", F.col("map").alias("map_name"), "date")


def speakers(spark, d):
    chats, users, _, _ = chat_tables(spark, d)
    return joins.resolve_speakers(chats, users).withColumn("candidates", F.array_join("candidates", ","))


def stats(spark, d):
    _, _, sessions, index = chat_tables(spark, d)
    return review.archive_stats(index, sessions)


def maps(spark, d):
    return review.map_names(chat_tables(spark, d)[2])


def pending(spark, d):
    return ingest.pending(chat_tables(spark, d)[3], include_failed=True)


def repaired(spark, d):
    _, _, sessions, index = chat_tables(spark, d)
    return joins.repair_flags(index, sessions)


def search(spark, d):
    chats, _, sessions, index = chat_tables(spark, d)
    return chat.search_messages(chats, sessions, index, "onth")


def map_chat(spark, d):
    chats, _, sessions, _ = chat_tables(spark, d)
    return chat.export_map_chat(chats, sessions, "map_3")


def mention_context(spark, d):
    chats, users, _, _ = chat_tables(spark, d)
    return chat.export_mentions(chats, users, "tion", 1)


def chat_counts(spark, d):
    chats, _, sessions, index = chat_tables(spark, d)
    return chat.chat_counts(chats, sessions, index)


def chat_peaks(spark, d):
    return chat.peaks(chat_counts(spark, d))


def style(spark, d):
    return chat.message_style(chat_tables(spark, d)[0])


def words(spark, d):
    return chat.word_counts(ad.table(spark, d, "documents"))


def bigrams(spark, d):
    return chat.bigram_counts(ad.table(spark, d, "documents"))


def neighbours(spark, d):
    chats, users, _, _ = chat_tables(spark, d)
    return chat.chat_neighbours(chats, users)


def record_rows(spark, d):
    return records_plan(event_tables(spark, d)).select("session_id", "chat_index", "player", "class", F.col("map").alias("map_name"), "record_type", "source", "record_time", "run_time", "split", "improvement", "inferred", "is_lookup")


def record_fold(spark, d):
    m = records.suppress_duplicates(records.marked(records.of_history(records_of(event_tables(spark, d)))), ["map", "class"])
    return records.fold_changes(m, ["map", "class"]).select(F.col("map").alias("map_name"), "class", "seg", "chat_index", "cs")


def record_history(spark, d):
    return records.export_history(records.record_history(records_of(event_tables(spark, d)))).withColumnRenamed("map", "map_name")


def one_map_history(spark, d):
    """The history of one map's family and one class, all its maps folded together."""
    t = event_tables(spark, d)
    told = stored(records.extract_records(t.record_chat(), t.sessions, t.index(), t.named_users(), only_map="map_3"), "records").filter(class_matches(F.col("class"), "S"))
    return records.export_history(records.record_history(told, ["class"])).withColumnRenamed("map", "map_name")


def record_audit(spark, d):
    return records.audit_records(records_of(event_tables(spark, d))).select("session_id", "chat_index", F.col("map").alias("map_name"), "class", "seg", "kind", "cs", "best", "line")


def runs(spark, d):
    t = event_tables(spark, d)
    return records.map_runs(t.record_chat(), t.sessions, t.index(), t.named_users(), include_record=True).withColumnRenamed("map", "map_name")


def personal_runs(spark, d):
    t = event_tables(spark, d)
    return records.map_runs(t.record_chat(), t.sessions, t.index(), t.named_users(), only_map="map_3", class_="S").withColumnRenamed("map", "map_name")


def index_lines(spark, d):
    o = ad.table(spark, d, "orders")
    line = F.concat_ws(" | ", F.col("o_orderkey").cast("string"), F.when(F.col("o_orderkey") % 9 == 0, "x").otherwise((F.col("o_custkey") * 10).cast("string")), F.col("o_orderpriority"))
    known = o.filter("o_orderkey % 4 = 0").select(F.col("o_orderkey").alias("id"))
    return ingest.ingest_index(o.select(line.alias("value"), F.col("o_orderkey").alias("line_no")), known).select("id", "url", "date")


QUERIES = {
    "alive_intervals": alive, "spectator_intervals": watching, "map_playtime": map_playtime, "map_spectating": map_spectating, "merged_intervals": merged, "spectator_peers": peers,
    "playtime_counts": playtime_counts, "keyword_rank": keyword_rank, "located_chat": located_chat, "speaker_resolution": speakers, "archive_stats": stats, "map_names": maps, "pending_sessions": pending, "repair_flags": repaired,
    "search_chat": search, "map_chat": map_chat, "mention_context": mention_context, "chat_counts": chat_counts, "chat_peaks": chat_peaks, "message_style": style, "word_counts": words, "bigram_counts": bigrams,
    "chat_neighbours": neighbours, "record_rows": record_rows, "record_fold": record_fold,
    "record_history": record_history, "one_map_history": one_map_history, "record_audit": record_audit, "map_runs": runs, "personal_runs": personal_runs, "ingest_index": index_lines,
    **landing_queries.QUERIES, **review_queries.QUERIES,
}

ORACLES = {
    "alive_intervals": f"WITH {EV} SELECT session_id, user_id, class, start_tick, end_tick FROM al",
    "spectator_intervals": f"WITH {EV} SELECT session_id, user_id, start_tick, end_tick FROM sp",
    "map_playtime": f"""WITH {EV}, {PER}
      SELECT player_key, map, round(sum(so)::BIGINT * 1e-6, 6) AS soldier_seconds, round(sum(de)::BIGINT * 1e-6, 6) AS demoman_seconds, round(sum(so + de)::BIGINT * 1e-6, 6) AS total_seconds, count(*) FILTER (so + de > 0) AS sessions FROM q JOIN s USING (session_id) GROUP BY ALL""",
    "map_spectating": f"WITH {EV} SELECT player_key, map, round(sum(end_tick - start_tick)::BIGINT * 1e-6, 6) AS seconds, count(DISTINCT session_id) AS sessions FROM sp JOIN s USING (session_id) GROUP BY ALL",
    "merged_intervals": f"WITH {EV}, {MG.format('al')} SELECT * FROM alm",
    "spectator_peers": f"""WITH {EV}, {MG.format('al')}, {MG.format('sp')},
      o AS (SELECT session_id, a.player_key AS p, b.player_key AS q, sum(least(a.end_tick, b.end_tick) - greatest(a.start_tick, b.start_tick)) AS t FROM alm a JOIN spm b USING (session_id)
        WHERE a.player_key <> b.player_key AND a.start_tick < b.end_tick AND b.start_tick < a.end_tick GROUP BY ALL),
      u AS (SELECT p AS player_key, q AS peer_key, t AS a, 0 AS b FROM o UNION ALL SELECT q, p, 0, t FROM o)
      SELECT player_key, peer_key, round(sum(a)::BIGINT * 1e-6, 6) AS watched_by_seconds, count(*) FILTER (a > 0) AS watched_by_sessions, round(sum(b)::BIGINT * 1e-6, 6) AS watching_seconds, count(*) FILTER (b > 0) AS watching_sessions FROM u GROUP BY ALL""",
    "playtime_counts": f"""WITH {EV}, {PER}, w AS (SELECT player_key, map, server, make_timestamp((1704067200 + (session_id // 8) * 86400) * 1000000) AS t, (so + de) * 1e-6 AS v FROM q JOIN s USING (session_id) WHERE so + de > 0)
      SELECT grouping, key, round(sum(v::DECIMAL(28, 9)), 4)::DOUBLE AS value FROM ({SIX}) GROUP BY ALL""",
    "keyword_rank": f"WITH {CV} SELECT id64, NULL::VARCHAR AS id, name, count(*) AS n FROM ch JOIN us USING (session_id, uid) WHERE text ILIKE '%the%' OR text ILIKE '%onth%' GROUP BY ALL",
    "located_chat": f"""WITH {CV} SELECT c.session_id, "index", name, id64, map AS map_name, date FROM ch c JOIN us USING (session_id, uid) JOIN ss USING (session_id) JOIN ix ON id = c.session_id""",
    "speaker_resolution": f"""WITH {CV} SELECT c.session_id, c."index", count(u.uid) AS candidate_count, coalesce(string_agg(u.uid::VARCHAR, ',' ORDER BY u.uid), '') AS candidates, CASE WHEN count(u.uid) = 1 THEN max(u.uid) END AS resolved_user_id
      FROM ch c LEFT JOIN us u ON c.session_id = u.session_id AND c.uid % 2 = u.entity GROUP BY c.session_id, c."index" """,
    "archive_stats": f"WITH {CV} SELECT count(*) FILTER (processed) AS processed, count(*) FILTER (failed) AS failed, count(*) FILTER (NOT processed AND NOT failed) AS neither, count(*) AS total, (SELECT sum(session_id * 10 + 3) FROM ss)::BIGINT AS download_size, (SELECT sum(session_id * 30 + 7) FROM ss)::BIGINT AS extracted_size FROM ix",
    "map_names": f"WITH {CV} SELECT DISTINCT map FROM ss",
    "pending_sessions": f"WITH {CV} SELECT * FROM ix WHERE NOT processed",
    "repair_flags": f"WITH {CV} SELECT id, url, date, true AS processed, failed AND processed AS failed, CASE WHEN processed THEN failure_reason END AS failure_reason FROM ix",
    "search_chat": f"""WITH {CV} SELECT c.session_id, "index", map, server, date, text FROM ch c JOIN ss USING (session_id) JOIN ix ON id = c.session_id WHERE text ILIKE '%onth%'""",
    "map_chat": f"""WITH {CV} SELECT c.session_id, "index", from_name, text FROM ch c JOIN ss USING (session_id) WHERE map = 'map_3'""",
    "mention_context": f"""WITH {CV}, n AS (SELECT *, row_number() OVER (PARTITION BY session_id ORDER BY "index") AS pos, regexp_matches(body, '(?i)(^|[^\\p{{L}}\\p{{N}}_])tion(s|[''’]s|s[''’])?([^\\p{{L}}\\p{{N}}_]|$)') AS hit FROM ch),
      w AS (SELECT session_id, min(pos) - 1 AS lo, max(pos) + 1 AS hi FROM n WHERE hit GROUP BY 1) SELECT n.session_id, "index", text, hit FROM n JOIN w USING (session_id) WHERE pos BETWEEN lo AND hi""",
    "chat_counts": f"WITH {CV}, {COUNTS} SELECT * FROM ct",
    "chat_peaks": f"WITH {CV}, {COUNTS} SELECT grouping, key, value FROM ct QUALIFY row_number() OVER (PARTITION BY grouping ORDER BY value DESC, key) = 1",
    "message_style": f"""WITH {CV}, t AS (SELECT body, {TOK.format('body')} AS t FROM ch) SELECT count(*) AS messages, round(avg(length(body)), 6) AS mean_length, quantile_cont(length(body), 0.5)::DOUBLE AS median_length,
      sum(length(body) - length(replace(body, '!', '')))::BIGINT AS exclamations, sum(length(body) - length(replace(body, '?', '')))::BIGINT AS questions,
      count(*) FILTER (list_has_any(t, ['lol', 'lmao', 'rofl', 'haha'])) AS laughter, count(*) FILTER (list_has_any(t, ['ty', 'thanks', 'thx'])) AS thanks, count(*) FILTER (list_has_any(t, ['sorry', 'sry'])) AS sorry FROM t""",
    "word_counts": f"SELECT word, count(*) AS n FROM (SELECT unnest({TOK.format('text')}) AS word FROM documents) WHERE word NOT IN ({STOP}) GROUP BY 1",
    "bigram_counts": f"SELECT a || ' ' || b AS phrase, count(*) AS n FROM (SELECT unnest(t[:-2]) AS a, unnest(t[2:]) AS b FROM (SELECT {TOK.format('text')} AS t FROM documents) WHERE len(t) > 1) WHERE a NOT IN ({STOP}) AND b NOT IN ({STOP}) GROUP BY 1",
    "chat_neighbours": f"""WITH {CV}, l AS (SELECT session_id, CASE WHEN NOT is_bot THEN '64:' || id64 END AS who, row_number() OVER (PARTITION BY session_id ORDER BY "index") AS pos FROM ch JOIN us USING (session_id, uid)),
      p AS (SELECT DISTINCT a.session_id, a.pos, a.pos > b.pos AS side, a.who AS player_key, b.who AS peer_key FROM l a JOIN l b ON a.session_id = b.session_id AND abs(a.pos - b.pos) BETWEEN 1 AND 3 AND a.who <> b.who) SELECT player_key, peer_key, count(*) AS n FROM p GROUP BY 1, 2""",
    "record_rows": f"""WITH {EV}, {REC} SELECT session_id, chat_index, player, class, map_name, record_type, source, tm AS record_time, CASE WHEN k = 7 THEN tm END AS run_time,
      CASE WHEN k IN (0, 3, 6, 7) THEN '-00:00.10' WHEN k = 5 THEN '-00:00.25' END AS split, CASE WHEN k = 3 THEN '00:00.10' END AS improvement, inferred, is_lookup FROM rr""",
    "record_fold": f"WITH RECURSIVE {EV}, {REC}, {fold('map_name, class, seg')} SELECT map_name, class, seg, chat_index, cs FROM f WHERE kept",
    "record_history": f"""WITH RECURSIVE {EV}, {REC}, {fold('map_name, class, seg')}, {days('map_name, class, seg')}
      SELECT strftime(make_timestamp((date * 1000000)::BIGINT), '%Y-%m-%d') AS date, map_name, class, seg AS segment, 'WR' AS record_type, kind AS evidence, {SAID}, player, player_id, NULL::VARCHAR AS candidates, CASE WHEN kind = 'record' THEN session_id END AS session_id FROM hd""",
    "one_map_history": f"""WITH RECURSIVE {EV}, {REC}, own AS (SELECT * FROM ok WHERE class = 'Solly' AND map_name = 'map_3' AND (k = 9 OR session_id % 7 = 3)), {fold('class, seg', 'own')}, {days('map_name, class, seg')}
      SELECT strftime(make_timestamp((date * 1000000)::BIGINT), '%Y-%m-%d') AS date, map_name, class, seg AS segment, 'WR' AS record_type, kind AS evidence, {SAID}, player, player_id, NULL::VARCHAR AS candidates, CASE WHEN kind = 'record' THEN session_id END AS session_id FROM hd""",
    "record_audit": f"""WITH {EV}, {REC}, b AS (SELECT *, min(cs) FILTER (kind = 'record') OVER (PARTITION BY map_name, class, seg) AS best FROM ok) SELECT session_id, chat_index, map_name, class, seg, kind, cs, best, CASE k WHEN 9 THEN ':: (' || long || ') ' || player || ' set ' || map_name || ' WR: ' || tm || '!' WHEN 10 THEN 'SRV | (' || long || ') ' || player || ' is ranked 1/12 on ' || map_name || ' with time: ' || tm
        ELSE 'SRV | (' || long || ' WR) ' || map_name || ' :: ' || tm || ' :: ' || player END AS line FROM (SELECT *, CASE class WHEN 'Solly' THEN 'Soldier' ELSE 'Demoman' END AS long FROM b) WHERE kind <> 'record' AND cs < best""",
    "map_runs": f"""WITH {EV}, {REC} SELECT date, session_id, chat_index, 'map_' || (session_id % 7) AS map_name, class, CASE WHEN k0 = 8 AND user_id % 3 = 0 THEN 'PR' ELSE 'WR' END AS label, tm AS run_time, CASE WHEN k0 = 8 THEN '+00:00.10' ELSE '-00:00.10' END AS split,
      CASE WHEN k0 = 8 AND user_id % 3 = 0 THEN '00:00.05' END AS improvement, player_id FROM (SELECT *, chat_index % 12 AS k0 FROM r) WHERE k0 IN (7, 8)""",
    "personal_runs": f"""WITH {EV}, {REC} SELECT date, session_id, chat_index, 'map_' || (session_id % 7) AS map_name, class, 'PR' AS label, tm AS run_time, '+00:00.10' AS split, '00:00.05' AS improvement, player_id
      FROM r WHERE chat_index % 12 = 8 AND user_id % 3 = 0 AND class = 'Solly' AND session_id % 7 = 3""",
    "ingest_index": "SELECT o_orderkey AS id, o_orderpriority AS url, (o_custkey * 10)::DOUBLE AS date FROM orders WHERE o_orderkey % 9 <> 0 AND o_orderkey % 4 <> 0",
    **landing_queries.ORACLES, **review_queries.ORACLES,
}
