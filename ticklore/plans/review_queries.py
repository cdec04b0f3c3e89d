"""Queries of filters, identities, sentiment and the year in review, each with SQL from the raw tables on."""

from __future__ import annotations

from pyspark.sql import functions as F

from ticklore.functions import scalars
from ticklore.operators import chat, filters, joins, playtime, records, review, sentiment
from ticklore.operators.records import PREFIX
from ticklore.plans.inputs import alive_of, chat_tables, event_tables, per_session_of, records_of, watching_of
from ticklore.plans.sql import CV, EV, MG, PER, REC, SCORED, SIX, STOP, SWAPPED, TOK, days, fold
from ticklore.sources import adapters as ad
from ticklore.sources import sinks
from ticklore.sources.shared import shared_path

BASE = scalars.ID_BASE


def map_families(spark, d):
    """Parts as maps: which filter of the family `small` takes a name."""
    p = ad.table(spark, d, "part").select("p_partkey", F.when(F.col("p_partkey") % 3 == 0, F.regexp_replace("p_name", " ", "_")).when(F.col("p_partkey") % 3 == 1, F.upper("p_name")).otherwise(F.split("p_name", " ")[0]).alias("map_name"))
    c = F.col("map_name")
    return p.select("p_partkey", (c == "small").alias("same"), filters.map_family_like(c, "small").alias("wide"), filters.map_family(c, "small").alias("strict"), c.contains("small").alias("holds"))


def candidate_lines(spark, d):
    """How many lines each cheap test lets through to the patterns."""
    c = event_tables(spark, d).record_chat()
    t = F.col("text")
    return c.agg(*(F.count_if(test(t, PREFIX)).alias(n) for n, test in (("n_record", filters.likely_record), ("n_relay", filters.likely_relay), ("n_run", filters.likely_run))), F.count("*").alias("n"))


def year_sessions(spark, d):
    index = chat_tables(spark, d)[3]
    return index.filter(filters.in_year(F.col("date") + F.col("id") * 3600, 2024)).select("id", "date")


def one_player(spark, d):
    users = chat_tables(spark, d)[1].withColumns({"raw_id": F.concat(F.lit("r"), F.col("session_id") % 5), "clean_id": F.concat(F.lit("c"), F.col("session_id") % 7)})
    some = [users.filter(filters.is_player(v)).withColumn("asked", F.lit(v)) for v in ("r3", "c2", str(BASE + 4))]
    return some[0].unionByName(some[1]).unionByName(some[2]).select("asked", "session_id", "user_id")


def other_mentions(spark, d):
    """Mentions, but those of one player and of one speaker's name."""
    chats, users, _, _ = chat_tables(spark, d)
    return chat.export_mentions(chats, users.filter("user_id <> 3"), "tion", 1, BASE + 2, ["Assistant"])


def kept_records(spark, d):
    h = records.record_history(records_of(event_tables(spark, d)))
    return records.include_counts(h, ["class"])


def shown_records(spark, d):
    h = records.record_history(records_of(event_tables(spark, d)))
    return records.include(h.filter(filters.class_matches(F.col("class"), "S")), inferred=False, lookups=False).select("chat_index", "cs")


def every_record(spark, d):
    """With include_all, each row that is not inferred stays; inferred ones go first, so that none stands for another of its day and time."""
    return records.record_history(records.include(records_of(event_tables(spark, d)), inferred=False), include_all=True).select("chat_index", "cs")


def latest(spark, d):
    return records.latest_records(records.record_history(records_of(event_tables(spark, d))), 2).select(F.col("map").alias("map_name"), "class", "seg", "chat_index", "rank")


def observed_holders(spark, d):
    """Runs taken as observed times: who holds them, by the other rows of that time."""
    r = records_of(event_tables(spark, d)).withColumn("inferred", (F.col("source") == "MapRun") | F.col("inferred"))
    r = r.withColumn("record_time", scalars.format_time(scalars.parse_time(F.col("record_time")) % 20 + 100))
    m = records.marked(r)
    o = records.attribute_observed(m.filter("kind = 'observed'"), m)
    return o.select("chat_index", "player", "id64", "source", "how")


def player_records(spark, d):
    t = event_tables(spark, d)
    named = t.named_users().join(t.users, ["session_id", "user_id"])
    h = records.record_history(records.player_records(records_of(t), named), ["player_key", "map", "class"], any_kind=True)
    return h.select("player_key", F.col("map").alias("map_name"), "class", "seg", "chat_index", "cs")


def held_names(spark, d):
    """Whose record a name is, where it is cut to `abc...` too."""
    c = ad.table(spark, d, "customer")
    users = c.select(F.col("c_nationkey").alias("session_id"), F.concat(F.lit("k"), F.col("c_custkey") % 9).alias("player_key"), F.concat(F.lit("Player"), F.col("c_custkey") % 30).alias("name"))
    names = c.filter("c_custkey % 10 = 0").select("c_custkey", F.col("c_nationkey").alias("session_id"), F.when(F.col("c_custkey") % 20 == 0, F.concat(F.lit("PLAYER"), F.floor(F.col("c_custkey") / 10) % 30)).otherwise(F.concat(F.lit("player"), F.col("c_custkey") % 3, F.lit("..."))).alias("player"))
    return records.player_records(names, users).select("c_custkey", "player_key")


def entities(spark, d):
    c = ad.table(spark, d, "customer")
    return joins.entity_map(c.select(F.col("c_nationkey").alias("session_id"), (F.col("c_custkey") % 40).alias("entity_id"), F.col("c_custkey").alias("user_id")))


def url_sessions(spark, d):
    """Sessions of the urls on a list; orders stand for sessions, three of them to a url."""
    o = ad.table(spark, d, "orders")
    index = o.select(F.col("o_orderkey").alias("id"), F.concat(F.lit("u"), F.floor(F.col("o_orderkey") / 3)).alias("url"))
    landed = o.filter("o_orderkey % 5 <> 0").select(F.col("o_orderkey").alias("session_id"))
    return joins.sessions_of_urls(index.filter("id % 2 = 0").select("url"), index, landed)


def known_customers(spark, d):
    c = ad.table(spark, d, "customer").select("c_custkey", F.concat(F.lit(" "), F.upper("c_name")).alias("name"))
    return joins.known_only(c, c.filter("c_custkey % 3 = 0").select(F.lower("name").alias("name"))).select("c_custkey")


def identities(spark, d):
    """Customers as users of a session (their nation): lines resolve by user, name, or beginning of a name."""
    c, none = ad.table(spark, d, "customer"), F.lit(None).cast("string")
    k = F.col("c_custkey")
    users = c.select(F.col("c_nationkey").alias("session_id"), k.alias("user_id"), F.concat(F.lit("Name"), k % 60).alias("name"), none.alias("raw_id"), none.alias("clean_id"), (k % 13).alias("id64"))
    said = F.when(k % 3 == 1, F.concat(F.lit("NAME"), k % 60)).otherwise(F.concat(F.lit("name"), k % 5, F.lit("...")))
    lines = c.select(F.col("c_nationkey").alias("session_id"), k.alias("line"), F.when(k % 3 == 0, k).alias("from_user_id"), said.alias("player"))
    return records.resolve_identity(lines, users).select("line", "id64", "candidates")


def scalar_values(spark, d):
    """Column functions over customers and parts of documents."""
    k, c = F.col("c_custkey"), ad.table(spark, d, "customer")
    raw = F.element_at(F.array(F.concat(F.lit("STEAM_0:1:"), k), F.concat(F.lit("[U:1:"), k, F.lit("]\x00x")), F.lit("bot"), F.concat(F.lit("?"), k)), (k % 4 + 1).cast("int"))
    p = scalars.normalize_player_id(raw)
    line = F.concat(F.lit("*DEAD* [t] Bob"), k, F.lit(" : hi : "), k)
    return c.select(
        "c_custkey", p["clean"].alias("clean"), p["id64"].alias("id64"), p["kind"].alias("kind"), p["is_bot"].alias("is_bot"), scalars.player_key(F.when(k % 2 == 0, k), F.concat(F.lit(" ab"), k)).alias("player_key"),
        scalars.speaker_name(line).alias("speaker"), scalars.message_body(line).alias("body"), scalars.format_hours(k * 36).alias("hours"), scalars.date_text(F.when(k % 7 > 0, k * 86400.5)).alias("day"),
        F.array_join(scalars.parse_id_csv(F.concat(k, F.lit(", x,"), k + 1)), ";").alias("ids"), scalars.audit_text(F.concat(F.lit("a\n b"), k, F.lit("\r "))).alias("audit"),
        scalars.serialize_candidates(F.array(F.struct(F.concat(F.lit("n|"), k).alias("name"), k.alias("id64"), F.lit(None).cast("string").alias("clean_id")))).alias("candidate"),
        scalars.mask_words(F.concat(F.lit("Bad"), k, F.lit(" bad, BADLY abad")), "bad(?:ly)?", "first").alias("masked"), scalars.mask_words(F.concat(F.lit("bad-"), k), "bad", "full").alias("starred"),
    )


def _lexicon(spark, d):
    """A table that grows with the texts: the commonest words of the conversations, with a valence from their length."""
    w = chat.word_counts(ad.table(spark, d, "conversations")).filter("n >= 5")
    return w.select(F.col("word").alias("token"), ((F.length("word") % 7 - 3) / 2.0).alias("valence")).filter("valence <> 0")


def _scored(spark, d):
    chats, users, _, index = chat_tables(spark, d)
    s = sentiment.sentiment(chats.withColumn("body", scalars.message_body(F.col("text"))), "body", _lexicon(spark, d), ["session_id", "index"])
    return joins.chats_with_users(s, users).join(index.select(F.col("id").alias("session_id"), "date"), "session_id").withColumn("player_key", scalars.player_key(F.col("id64"), F.lit(None)))


def message_sentiment(spark, d):
    return _scored(spark, d).select("session_id", "index", "compound")


def sentiment_rules(spark, d):
    """Scores of messages whose common words are told as boosters, negations and phrases, so that every rule meets every text."""
    chats = chat_tables(spark, d)[0]
    swap = F.create_map(*[F.lit(x) for kv in SWAPPED.items() for x in kv])
    body = F.array_join(F.transform(F.split(scalars.message_body(F.col("text")), " "), lambda w: F.coalesce(F.try_element_at(swap, F.lower(w)), w)), " ")
    phrases = _lexicon(spark, d).filter("valence < 0").select(F.concat(F.lit("very "), "token").alias("phrase"), "valence")
    told = spark.createDataFrame(list(sentiment.PHRASES.items()), "phrase string, valence double").unionByName(phrases)
    return sentiment.sentiment(chats.withColumn("body", body), "body", _lexicon(spark, d), ["session_id", "index"], told).select("session_id", "index", "compound")


def user_sentiment(spark, d):
    return sentiment.user_sentiment(_scored(spark, d))


def known_sentiment(spark, d):
    s = sentiment.user_sentiment(_scored(spark, d)).withColumn("id", F.col("id64").cast("string"))
    return sentiment.known_sentiment(s, s.filter("name <> 'system'").select(F.upper("name").alias("name")))


def timeline(spark, d):
    return sentiment.sentiment_timeline(_scored(spark, d))


def overall(spark, d):
    return sentiment.sentiment_overall(_scored(spark, d), ["player_key"])


def lowest(spark, d):
    return sentiment.lowest_messages(_scored(spark, d)).select("session_id", "index", "compound")


def extremes(spark, d):
    return sentiment.extreme_messages(_scored(spark, d).withColumn("text", F.col("body")), ["player_key"]).select("player_key", "session_id", "index", "up", "down")


def superlatives(spark, d):
    return _flat(sentiment.superlatives(_scored(spark, d), ["player_key"]))


def _friends(spark, d):
    t = event_tables(spark, d)
    return review.friends(t.record_chat(), t.named_users(), per_session_of(t))


def friends(spark, d):
    return _friends(spark, d)


def chat_friends(spark, d):
    chats, users, _, _ = chat_tables(spark, d)
    return review.friends(chats, users)


def friends_by(order):
    return lambda spark, d: review.friend_lists(_friends(spark, d), 5)[order].select("player_key", "rank", "peer_key")


def peers_by(order):
    def run(spark, d):
        t = event_tables(spark, d)
        return playtime.peer_lists(playtime.spectator_peers(alive_of(t), watching_of(t), t.users), 5)[order].select("player_key", "rank", "peer_key", order)

    return run


def review_part(part, *cols):
    """Of the year in review over the conversations."""

    def run(spark, d):
        chats, users, sessions, index = chat_tables(spark, d)
        out = review.year_review({"chats": chats, "users": users, "sessions": sessions, "index": index, "lexicon": _lexicon(spark, d)}, 2024, 5)[part]
        return out.select(*cols) if cols else out

    return run


def _flat(df):
    return df.select("player_key", *[F.col(f"{w}.{c}").alias(f"{w}_{c}") for w in ("funniest", "rudest") for c in ("session_id", "index")])


def record_part(part, *cols):
    """Of the year in review over the events, with their records."""

    def run(spark, d):
        t = event_tables(spark, d)
        out = review.year_review({"chats": t.record_chat(), "users": t.named_users(), "sessions": t.sessions, "index": t.index(), "records": records_of(t)}, 2024, 3)[part]
        return out.withColumnRenamed("map", "map_name").select(*cols) if cols else out

    return run


def play_part(part, *cols):
    """Of the year in review over the events."""

    def run(spark, d):
        t = event_tables(spark, d)
        out = review.year_review({"chats": t.record_chat(), "users": t.named_users(), "sessions": t.sessions, "index": t.index(), "per_session": per_session_of(t)}, 2024, 3)[part]
        return out.select(*cols) if cols else out

    return run


#: Words that the shown chat of the year stars.
MASKED = ("the|that", "first")


def url_chat(spark, d):
    chats, _, sessions, index = chat_tables(spark, d)
    return chat.export_url_chat(chats, index.filter("id % 3 = 0").select("url"), sessions, index)


def _year_files(spark, d):
    """The year's chat of each player, written as CSV and as lines."""
    chats, users, sessions, index = chat_tables(spark, d)
    said = review.year_review({"chats": chats, "users": users, "sessions": sessions, "index": index}, 2024, masked=MASKED)["chat"]
    path = shared_path(spark, "year-chat")
    sinks.write_chat(said, path, ["player_key"], ["ts", "session_id", "index"])
    return path


def year_chat(spark, d):
    return sinks.read_chat(spark, _year_files(spark, d), "player_key string, ts string, map string, server string, session_id bigint, tick int, index int, text string").withColumnRenamed("map", "map_name")


def year_lines(spark, d):
    return spark.read.text(f"{_year_files(spark, d)}/lines").select(F.col("p_player_key").alias("player_key"), F.col("value").alias("line"))


def year_long(spark, d):
    """The whole review of the conversations as one long table."""
    chats, users, sessions, index = chat_tables(spark, d)
    return review.year_sheet(review.year_review({"chats": chats, "users": users, "sessions": sessions, "index": index, "lexicon": _lexicon(spark, d)}, 2024, 5))


def year_long_play(spark, d):
    """Time, friends and records of the review of the events as one long table."""
    t = event_tables(spark, d)
    parts = review.year_review({"chats": t.record_chat(), "users": t.named_users(), "sessions": t.sessions, "index": t.index(), "per_session": per_session_of(t), "records": records_of(t)}, 2024, 3)
    return review.year_sheet({k: parts[k] for k in ("counts", "class", "playtime_counts", "playtime_peaks", "playtime_top", "friends_by_playtime", "records", "record_counts")})


_YEAR_SUPER = review_part("superlatives")
QUERIES = {
    "url_chat": url_chat, "year_review_chat": year_chat, "year_review_lines": year_lines, "year_review_long": year_long, "year_review_long_play": year_long_play,
    "year_review_records": record_part("records", "player_key", "map_name", "class", "seg", "chat_index", "cs"), "year_review_record_counts": record_part("record_counts"), "year_review_sentiment": review_part("sentiment"),
    "year_review_extremes": review_part("extremes", "player_key", "session_id", "index", "up", "down"), "year_review_superlatives": lambda spark, d: _flat(_YEAR_SUPER(spark, d)),
    "year_review_friends": review_part("friends_by_sessions", "player_key", "rank", "peer_key"), "year_review_replies": review_part("friends_by_interactions", "player_key", "rank", "peer_key"), "year_review_company": play_part("friends_by_playtime", "player_key", "rank", "peer_key"),
    "map_families": map_families, "candidate_lines": candidate_lines, "year_sessions": year_sessions, "one_player": one_player, "other_mentions": other_mentions, "kept_records": kept_records, "shown_records": shown_records,
    "every_record": every_record, "latest_records": latest, "observed_holders": observed_holders, "player_records": player_records, "held_names": held_names, "entity_map": entities, "url_sessions": url_sessions,
    "known_customers": known_customers, "identities": identities, "scalar_values": scalar_values, "message_sentiment": message_sentiment, "sentiment_rules": sentiment_rules, "user_sentiment": user_sentiment, "known_sentiment": known_sentiment,
    "sentiment_timeline": timeline, "sentiment_overall": overall, "lowest_messages": lowest, "extreme_messages": extremes, "superlatives": superlatives, "friends": chat_friends, "friends_with_time": friends,
    "friends_by_playtime": friends_by("by_playtime"), "friends_by_sessions": friends_by("by_sessions"), "friends_by_interactions": friends_by("by_interactions"),
    "watched_by_list": peers_by("watched_by_seconds"), "watching_list": peers_by("watching_seconds"),
    "year_review_peaks": review_part("chat_peaks"), "year_review_words": review_part("top_words"), "year_review_phrases": review_part("top_phrases"), "year_review_style": review_part("style"),
    "year_review_activity": review_part("activity"), "year_review_messages": review_part("messages"), "year_review_sheet": play_part("counts"), "year_review_class": play_part("class"), "year_review_time": play_part("playtime_peaks"), "year_review_top": play_part("playtime_top", "player_key", "grouping", "key", "rank"),
}

_NEAR = "p AS (SELECT DISTINCT a.session_id, a.pos, a.pos > b.pos AS side, a.who AS x, b.who AS y FROM l a JOIN l b ON a.session_id = b.session_id AND abs(a.pos - b.pos) BETWEEN 1 AND 3 AND a.who <> b.who), r3 AS (SELECT x, y, count(*) AS n FROM p GROUP BY 1, 2)"
_FRIENDS = f"""{EV}, {PER}, us AS (SELECT DISTINCT session_id, user_id, '64:' || (user_id % 40) AS k, user_id % 11 = 0 AS is_bot FROM e), u AS (SELECT DISTINCT session_id, k FROM us WHERE NOT is_bot),
  c AS (SELECT session_id, idx, CASE WHEN idx % 5 <> 0 THEN user_id END AS uid FROM e), n AS (SELECT c.session_id, k, count(*) AS c FROM c JOIN us ON us.session_id = c.session_id AND us.user_id = c.uid GROUP BY 1, 2),
  l AS (SELECT c.session_id, CASE WHEN NOT is_bot THEN k END AS who, row_number() OVER (PARTITION BY c.session_id ORDER BY idx) AS pos FROM c JOIN us ON us.session_id = c.session_id AND us.user_id = c.uid), {_NEAR},
  fr AS (SELECT a.k AS player_key, b.k AS peer_key, count(*) AS shared_sessions, round(sum(coalesce((so + de) * 1e-6, 0)::DECIMAL(28, 9)), 4)::DOUBLE AS shared_seconds, sum(coalesce(c, 0))::BIGINT AS chat_lines, coalesce(any_value(r3.n), 0) AS replies
    FROM u a JOIN u b ON a.session_id = b.session_id AND a.k <> b.k LEFT JOIN q ON q.session_id = a.session_id AND q.player_key = a.k LEFT JOIN n ON n.session_id = b.session_id AND n.k = b.k LEFT JOIN r3 ON r3.x = a.k AND r3.y = b.k GROUP BY 1, 2)"""
_PEERS = f"""{EV}, {MG.format('al')}, {MG.format('sp')},
  o AS (SELECT session_id, a.player_key AS p, b.player_key AS q, sum(least(a.end_tick, b.end_tick) - greatest(a.start_tick, b.start_tick)) AS t FROM alm a JOIN spm b USING (session_id)
    WHERE a.player_key <> b.player_key AND a.start_tick < b.end_tick AND b.start_tick < a.end_tick GROUP BY ALL),
  u AS (SELECT p AS player_key, q AS peer_key, t AS a, 0 AS b FROM o UNION ALL SELECT q, p, 0, t FROM o),
  g AS (SELECT player_key, peer_key, round(sum(a)::BIGINT * 1e-6, 6) AS watched_by_seconds, round(sum(b)::BIGINT * 1e-6, 6) AS watching_seconds FROM u GROUP BY ALL)"""


def _first(cte, table, order, n, cols="player_key, rank, peer_key"):
    return f"WITH {cte} SELECT {cols} FROM (SELECT *, row_number() OVER (PARTITION BY player_key ORDER BY {order}) AS rank FROM {table}) WHERE rank <= {n}"


_KEPT = f"WITH RECURSIVE {EV}, {REC}, {fold('map_name, class, seg')}, {days('map_name, class, seg')}"
_CHAT = f"{CV}, yc AS (SELECT c.session_id, \"index\", text, body, '64:' || id64 AS player_key, date, map, server, make_timestamp((date * 1000000)::BIGINT) AS t FROM ch c JOIN us USING (session_id, uid) JOIN ss USING (session_id) JOIN ix ON id = c.session_id WHERE date >= 1704067200 AND date < 1735689600)"
_YEAR = f"{EV}, {PER}, yq AS (SELECT * FROM q WHERE session_id // 8 < 366), w AS (SELECT player_key, map, server, make_timestamp((1704067200 + (session_id // 8) * 86400) * 1000000) AS t, (so + de) * 1e-6 AS v FROM yq JOIN s USING (session_id) WHERE so + de > 0), y AS (SELECT player_key, grouping, key, round(sum(v::DECIMAL(28, 9)), 4)::DOUBLE AS value FROM ({SIX}) GROUP BY ALL)"
_SC = f"WITH {CV}, {SCORED}"
#: The same of messages with swapped words, and phrases from the lexicon besides the published ones.
_SWAP = "(SELECT * REPLACE (array_to_string(list_transform(string_split(body, ' '), lambda w: coalesce(element_at(MAP {" + ", ".join("'" + k + "': '" + v.replace("'", "''") + "'" for k, v in SWAPPED.items()) + "}, lower(w))[1], w)), ' ') AS body) FROM ch)"
_SCR = f"WITH {CV}, {SCORED}".replace("FROM ch)", f"FROM {_SWAP})").replace("FROM ch LEFT", f"FROM {_SWAP} AS ch LEFT").replace("AS p(phrase, v))", "AS p(phrase, v) UNION ALL SELECT 'very ' || token, valence FROM lx WHERE valence < 0)")
#: The same tables, of the year's sessions only.
_CVY = CV.replace("FROM conversations", "FROM conversations WHERE conv_id < 366")
_RECY = f"WITH RECURSIVE {EV}, {REC}, ry AS (SELECT * FROM rr WHERE record_type = 'WR' AND session_id // 8 < 366), {fold('record_key, map_name, class, seg', 'ry')}, {days('record_key, map_name, class, seg')}"
ORACLES = {
    "map_families": """SELECT p_partkey, m = 'small' AS same, m = 'small' OR m ILIKE 'small_%' AS wide, lower(m) = 'small' OR starts_with(lower(m), 'small_') AS strict, contains(m, 'small') AS holds
      FROM (SELECT p_partkey, CASE p_partkey % 3 WHEN 0 THEN replace(p_name, ' ', '_') WHEN 1 THEN upper(p_name) ELSE string_split(p_name, ' ')[1] END AS m FROM part)""",
    "candidate_lines": f"WITH {EV} SELECT count(*) FILTER (idx % 12 <> 9) - count(*) FILTER (idx % 12 = 8 AND user_id % 3 = 0) AS n_record, count(*) FILTER (idx % 12 = 9) AS n_relay, count(*) FILTER (idx % 12 IN (7, 8)) AS n_run, count(*) AS n FROM e",
    "year_sessions": f"WITH {CV} SELECT id, date FROM ix WHERE date + id * 3600 >= 1704067200 AND date + id * 3600 < 1735689600",
    "one_player": f"WITH {CV} SELECT 'r3' AS asked, session_id, uid AS user_id FROM us WHERE session_id % 5 = 3 UNION ALL SELECT 'c2', session_id, uid FROM us WHERE session_id % 7 = 2 UNION ALL SELECT '{BASE + 4}', session_id, uid FROM us WHERE id64 = {BASE + 4}",
    "other_mentions": f"""WITH {CV}, n AS (SELECT ch.*, row_number() OVER (PARTITION BY ch.session_id ORDER BY "index") AS pos, regexp_matches(body, '(?i)(^|[^\\p{{L}}\\p{{N}}_])tion(s|[''’]s|s[''’])?([^\\p{{L}}\\p{{N}}_]|$)')
        AND id64 IS DISTINCT FROM {BASE + 2} AND lower(from_name) <> 'assistant' AS hit FROM ch LEFT JOIN (SELECT * FROM us WHERE uid <> 3) us ON us.session_id = ch.session_id AND us.uid = ch.uid),
      w AS (SELECT session_id, min(pos) - 1 AS lo, max(pos) + 1 AS hi FROM n WHERE hit GROUP BY 1) SELECT n.session_id, "index", text, hit FROM n JOIN w USING (session_id) WHERE pos BETWEEN lo AND hi""",
    "kept_records": f"{_KEPT} SELECT class, count(*) AS n, count(*) FILTER (inferred) AS n_inferred, count(*) FILTER (is_lookup) AS n_lookup, count(*) FILTER (NOT inferred AND NOT is_lookup) AS n_plain FROM hd GROUP BY 1",
    "shown_records": f"{_KEPT} SELECT chat_index, cs FROM hd WHERE class = 'Solly' AND NOT inferred AND NOT is_lookup",
    "every_record": f"""WITH {EV}, {REC}, a AS (SELECT *, max(kind = 'record') OVER (PARTITION BY map_name, class, seg, cs) AS sure FROM ok), h AS (SELECT * FROM a WHERE (kind = 'record' OR NOT sure) AND NOT inferred)
      SELECT chat_index, cs FROM h QUALIFY row_number() OVER (PARTITION BY map_name, class, seg, date // 86400, cs ORDER BY CASE kind WHEN 'record' THEN 0 WHEN 'announcement' THEN 1 ELSE 2 END, session_id, chat_index) = 1""",
    "latest_records": f"""{_KEPT}, ho AS (SELECT *, min(struct_pack(a := date, b := session_id, c := chat_index)) OVER (PARTITION BY map_name, class, seg, date // 86400, cs) AS ord FROM h),
      hr AS (SELECT * FROM ho WHERE chat_index IN (SELECT chat_index FROM hd)) SELECT map_name, class, seg, chat_index, rank FROM (SELECT *, row_number() OVER (PARTITION BY map_name, class, seg ORDER BY ord DESC) AS rank FROM hr) WHERE rank <= 2""",
    "observed_holders": f"""WITH {EV}, {REC}, z AS (SELECT * REPLACE (cs % 20 + 100 AS cs) FROM rr), h AS (SELECT map_name, class, seg, cs, player, player_id FROM z WHERE k <> 7
        QUALIFY row_number() OVER (PARTITION BY map_name, class, seg, cs ORDER BY CASE WHEN NOT is_lookup AND NOT inferred THEN 0 WHEN NOT is_lookup THEN 1 WHEN NOT inferred THEN 2 ELSE 3 END, session_id, chat_index) = 1)
      SELECT z.chat_index, coalesce(h.player, 'unknown') AS player, h.player_id AS id64, 'ObservedWR' AS source, 'wr_split' AS how FROM z LEFT JOIN h USING (map_name, class, seg, cs) WHERE k = 7""",
    "player_records": f"WITH RECURSIVE {EV}, {REC}, {fold('record_key, map_name, class, seg', "(SELECT * FROM rr WHERE record_type = 'WR')")}, {days('record_key, map_name, class, seg')} SELECT record_key AS player_key, map_name, class, seg, chat_index, cs FROM hd",
    "held_names": """WITH u AS (SELECT c_nationkey AS s, 'k' || (c_custkey % 9) AS player_key, 'player' || (c_custkey % 30) AS name FROM customer),
      n AS (SELECT c_custkey, c_nationkey AS s, CASE WHEN c_custkey % 20 = 0 THEN 'player' || ((c_custkey // 10) % 30) END AS whole, 'player' || (c_custkey % 3) AS stem FROM customer WHERE c_custkey % 10 = 0)
      SELECT DISTINCT c_custkey, player_key FROM n JOIN u USING (s) WHERE CASE WHEN whole IS NOT NULL THEN name = whole ELSE starts_with(name, stem) END""",
    "entity_map": "SELECT c_nationkey AS session_id, c_custkey % 40 AS entity_id, max(c_custkey) AS user_id FROM customer GROUP BY 1, 2 HAVING count(*) = 1",
    "url_sessions": "WITH i AS (SELECT o_orderkey AS id, 'u' || (o_orderkey // 3) AS url FROM orders) SELECT url, min(id) AS session_id FROM i WHERE id % 5 <> 0 AND url IN (SELECT url FROM i WHERE id % 2 = 0) GROUP BY 1",
    "known_customers": "SELECT c_custkey FROM customer WHERE c_custkey % 3 = 0",
    "identities": """WITH u AS (SELECT c_nationkey AS s, 'Name' || (c_custkey % 60) AS name, c_custkey % 13 AS id FROM customer), l AS (SELECT c_nationkey AS s, c_custkey AS line, c_custkey % 3 = 0 AS own, CASE WHEN c_custkey % 3 = 1 THEN 'name' || (c_custkey % 60) END AS whole, 'name' || (c_custkey % 5) AS stem FROM customer),
      m AS (SELECT DISTINCT line, own, name, id FROM l LEFT JOIN u ON u.s = l.s AND CASE WHEN whole IS NOT NULL THEN lower(name) = whole ELSE starts_with(lower(name), stem) END),
      g AS (SELECT line, own, count(DISTINCT id) AS n, any_value(id) AS one, string_agg(name || '|' || id || '|', ';' ORDER BY name, id::VARCHAR) AS c FROM m GROUP BY 1, 2)
      SELECT line, CASE WHEN own THEN (line % 13)::VARCHAR WHEN n = 1 THEN one::VARCHAR END AS id64, CASE WHEN NOT own AND n > 1 THEN c END AS candidates FROM g""",
    "scalar_values": f"""SELECT c_custkey, CASE k WHEN 0 THEN 'STEAM_0:1:' || c_custkey WHEN 1 THEN '[U:1:' || c_custkey || ']' WHEN 2 THEN 'bot' ELSE '?' || c_custkey END AS clean, CASE k WHEN 0 THEN {BASE} + 2 * c_custkey + 1 WHEN 1 THEN {BASE} + c_custkey END AS id64,
      CASE k WHEN 0 THEN 'steam2' WHEN 1 THEN 'steam3' WHEN 2 THEN 'bot' ELSE 'unknown' END AS kind, k = 2 AS is_bot, CASE WHEN c_custkey % 2 = 0 THEN '64:' || c_custkey ELSE 'id:AB' || c_custkey END AS player_key, 'Bob' || c_custkey AS speaker, 'hi : ' || c_custkey AS body,
      regexp_replace(printf('%.2f', c_custkey / 100), '\\.?0+$', '') || 'h' AS hours, CASE WHEN c_custkey % 7 > 0 THEN strftime(make_timestamp((c_custkey * 86400500000)::BIGINT), '%Y-%m-%d') ELSE 'unknown' END AS day, c_custkey || ';' || (c_custkey + 1) AS ids, 'b' || c_custkey AS audit,
      'n ' || c_custkey || '|' || c_custkey || '|' AS candidate, 'Bad' || c_custkey || ' b**, B**** abad' AS masked, '***-' || c_custkey AS starred FROM (SELECT *, c_custkey % 4 AS k FROM customer)""",
    "message_sentiment": f'{_SC} SELECT session_id, "index", compound FROM sd',
    "sentiment_rules": f"{_SCR} SELECT session_id, \"index\", round(coalesce(z, 0) / sqrt(coalesce(z, 0) * coalesce(z, 0) + 15), 4) AS compound FROM am",
    "user_sentiment": f"{_SC} SELECT id64, 'unknown' AS id, round(avg(compound::DECIMAL(10, 4)), 6)::DOUBLE AS mean, count(*) AS n, any_value(nm) AS name FROM (SELECT *, first_value(name) OVER (PARTITION BY id64 ORDER BY c DESC, f, name) AS nm FROM (SELECT *, count(*) OVER (PARTITION BY id64, name) AS c, min(session_id) OVER (PARTITION BY id64, name) AS f FROM sd)) GROUP BY 1",
    "known_sentiment": f"""{_SC}, nm AS (SELECT id64, name, count(*) AS c, min(session_id) AS f FROM sd GROUP BY 1, 2 QUALIFY row_number() OVER (PARTITION BY id64 ORDER BY count(*) DESC, min(session_id), name) = 1),
      um AS (SELECT id64, round(avg(compound::DECIMAL(10, 4)), 6)::DOUBLE AS mean, count(*) AS n FROM sd GROUP BY 1) SELECT name AS known, round(avg(mean), 6) AS mean, sum(n)::BIGINT AS n, min(id64::VARCHAR) AS id FROM um JOIN nm USING (id64) WHERE name <> 'system' GROUP BY 1""",
    "sentiment_timeline": f"{_SC} SELECT strftime(make_timestamp((date * 1000000)::BIGINT), '%Y-%m') AS bucket, round(avg(compound::DECIMAL(10, 4)), 6)::DOUBLE AS mean, count(*) AS n FROM sd GROUP BY 1",
    "sentiment_overall": f"{_SC} SELECT player_key, month, round(avg(compound::DECIMAL(10, 4)), 6)::DOUBLE AS mean, count(*) AS n FROM (SELECT *, strftime(make_timestamp((date * 1000000)::BIGINT), '%Y-%m') AS month FROM sd) GROUP BY GROUPING SETS ((player_key, month), (player_key))",
    "lowest_messages": f'{_SC} SELECT session_id, "index", compound FROM sd ORDER BY compound, session_id, "index" LIMIT 200',
    "extreme_messages": f"""{_SC} SELECT player_key, session_id, "index", up, down FROM (SELECT *, row_number() OVER (PARTITION BY player_key ORDER BY compound DESC, length(body) DESC, session_id, "index") AS up, row_number() OVER (PARTITION BY player_key ORDER BY compound, length(body) DESC, session_id, "index") AS down FROM sd) WHERE up <= 5 OR down <= 5""",
    "superlatives": f"""{_SC}, o AS (SELECT *, NOT list_has_any(regexp_extract_all(lower(body), '[a-z0-9'']+'), ['lol', 'lmao', 'rofl', 'haha']) AS dull FROM sd),
      a AS (SELECT * FROM o QUALIFY row_number() OVER (PARTITION BY player_key ORDER BY dull, compound DESC, date, session_id, "index") = 1), b AS (SELECT * FROM o QUALIFY row_number() OVER (PARTITION BY player_key ORDER BY compound, date, session_id, "index") = 1)
      SELECT player_key, a.session_id AS funniest_session_id, a."index" AS funniest_index, b.session_id AS rudest_session_id, b."index" AS rudest_index FROM a JOIN b USING (player_key)""",
    "friends": f"""WITH {CV}, u AS (SELECT DISTINCT session_id, '64:' || id64 AS k FROM us WHERE NOT is_bot), n AS (SELECT session_id, '64:' || id64 AS k, count(*) AS c FROM ch JOIN us USING (session_id, uid) GROUP BY 1, 2),
      l AS (SELECT session_id, CASE WHEN NOT is_bot THEN '64:' || id64 END AS who, row_number() OVER (PARTITION BY session_id ORDER BY "index") AS pos FROM ch JOIN us USING (session_id, uid)), {_NEAR}
      SELECT a.k AS player_key, b.k AS peer_key, count(*) AS shared_sessions, 0.0::DOUBLE AS shared_seconds, sum(coalesce(c, 0))::BIGINT AS chat_lines, coalesce(any_value(r3.n), 0) AS replies
      FROM u a JOIN u b ON a.session_id = b.session_id AND a.k <> b.k LEFT JOIN n ON n.session_id = b.session_id AND n.k = b.k LEFT JOIN r3 ON r3.x = a.k AND r3.y = b.k GROUP BY 1, 2""",
    "friends_with_time": f"WITH {_FRIENDS} SELECT * FROM fr",
    "friends_by_playtime": _first(_FRIENDS, "fr", "shared_seconds DESC, shared_sessions DESC, peer_key", 5),
    "friends_by_sessions": _first(_FRIENDS, "fr", "shared_sessions DESC, shared_seconds DESC, peer_key", 5),
    "friends_by_interactions": _first(_FRIENDS, "fr", "replies DESC, chat_lines DESC, peer_key", 5),
    "watched_by_list": _first(_PEERS, "g WHERE watched_by_seconds > 0", "watched_by_seconds DESC, peer_key", 5, "player_key, rank, peer_key, watched_by_seconds"),
    "watching_list": _first(_PEERS, "g WHERE watching_seconds > 0", "watching_seconds DESC, peer_key", 5, "player_key, rank, peer_key, watching_seconds"),
    "year_review_peaks": f"""WITH {_CHAT}, w AS (SELECT player_key, map, server, t, 1 AS v FROM yc), k AS (SELECT player_key, grouping, key, sum(v)::BIGINT AS value FROM ({SIX}) GROUP BY ALL)
      SELECT player_key, grouping, key, value FROM k QUALIFY row_number() OVER (PARTITION BY player_key, grouping ORDER BY value DESC, key) = 1""",
    "year_review_words": f"WITH {_CHAT}, k AS (SELECT player_key, word, count(*) AS n FROM (SELECT player_key, unnest({TOK.format('body')}) AS word FROM yc) WHERE word NOT IN ({STOP}) GROUP BY 1, 2) SELECT player_key, word, n, rank FROM (SELECT *, row_number() OVER (PARTITION BY player_key ORDER BY n DESC, word) AS rank FROM k) WHERE rank <= 5",
    "year_review_phrases": f"""WITH {_CHAT}, k AS (SELECT player_key, a || ' ' || b AS phrase, count(*) AS n FROM (SELECT player_key, unnest(t[:-2]) AS a, unnest(t[2:]) AS b FROM (SELECT player_key, {TOK.format('body')} AS t FROM yc) WHERE len(t) > 1) WHERE a NOT IN ({STOP}) AND b NOT IN ({STOP}) GROUP BY 1, 2)
      SELECT player_key, phrase, n, rank FROM (SELECT *, row_number() OVER (PARTITION BY player_key ORDER BY n DESC, phrase) AS rank FROM k) WHERE rank <= 5""",
    "year_review_style": f"""WITH {_CHAT}, k AS (SELECT player_key, body, {TOK.format('body')} AS t FROM yc) SELECT player_key, count(*) AS messages, round(avg(length(body)), 6) AS mean_length, quantile_cont(length(body), 0.5)::DOUBLE AS median_length,
      sum(length(body) - length(replace(body, '!', '')))::BIGINT AS exclamations, sum(length(body) - length(replace(body, '?', '')))::BIGINT AS questions,
      count(*) FILTER (list_has_any(t, ['lol', 'lmao', 'rofl', 'haha'])) AS laughter, count(*) FILTER (list_has_any(t, ['ty', 'thanks', 'thx'])) AS thanks, count(*) FILTER (list_has_any(t, ['sorry', 'sry'])) AS sorry FROM k GROUP BY 1""",
    "year_review_activity": f"WITH {CV} SELECT '64:' || id64 AS player_key, min(date) AS first_date, max(date) AS last_date, count(*) AS sessions FROM (SELECT DISTINCT session_id, id64 FROM us) JOIN ix ON id = session_id WHERE date < 1735689600 GROUP BY 1",
    "year_review_messages": f"WITH {_CHAT} SELECT player_key, min(date) AS first_message, max(date) AS last_message FROM yc GROUP BY 1",
    "year_review_sheet": f"""WITH {_YEAR}, a AS (SELECT player_key, count(DISTINCT session_id) AS sessions FROM e WHERE session_id // 8 < 366 GROUP BY 1), b AS (SELECT player_key, count(*) AS messages FROM e WHERE idx % 5 <> 0 AND session_id // 8 < 366 GROUP BY 1),
      c AS (SELECT player_key, count(*) AS sessions_with_time, count(DISTINCT map) AS maps, count(DISTINCT server) AS servers FROM w2 GROUP BY 1)
      SELECT player_key, sessions, coalesce(sessions_with_time, 0) AS sessions_with_time, coalesce(messages, 0) AS messages, coalesce(maps, 0) AS maps, coalesce(servers, 0) AS servers FROM a LEFT JOIN b USING (player_key) LEFT JOIN c USING (player_key)""".replace("w2", "w"),
    "year_review_class": f"WITH {_YEAR} SELECT player_key, CASE WHEN sum(so) >= sum(de) THEN 'soldier' ELSE 'demoman' END AS class FROM yq GROUP BY 1",
    "year_review_time": f"WITH {_YEAR} SELECT player_key, grouping, key, value FROM y QUALIFY row_number() OVER (PARTITION BY player_key, grouping ORDER BY value DESC, key) = 1",
    "year_review_top": f"WITH {_YEAR} SELECT player_key, grouping, key, rank FROM (SELECT *, row_number() OVER (PARTITION BY player_key, grouping ORDER BY value DESC, key) AS rank FROM y) WHERE rank <= 3",
    "year_review_records": f"{_RECY} SELECT record_key AS player_key, map_name, class, seg, chat_index, cs FROM hd",
    "year_review_record_counts": f"{_RECY} SELECT record_key AS player_key, count(*) AS n, count(*) FILTER (inferred) AS n_inferred, count(*) FILTER (is_lookup) AS n_lookup, count(*) FILTER (NOT inferred AND NOT is_lookup) AS n_plain FROM hd GROUP BY 1",
}
ORACLES |= {
    "year_review_sentiment": ORACLES["sentiment_overall"].replace(CV, _CVY), "year_review_superlatives": ORACLES["superlatives"].replace(CV, _CVY),
    "year_review_extremes": ORACLES["extreme_messages"].replace(CV, _CVY).replace("length(body) DESC", "length(text) DESC"),
    "year_review_friends": _first(ORACLES["friends"].replace(CV, _CVY).replace("WITH ", "", 1).replace("SELECT a.k AS player_key", ", fr AS (SELECT a.k AS player_key") + ")", "fr", "shared_sessions DESC, shared_seconds DESC, peer_key", 5),
    "year_review_replies": _first(ORACLES["friends"].replace(CV, _CVY).replace("WITH ", "", 1).replace("SELECT a.k AS player_key", ", fr AS (SELECT a.k AS player_key") + ")", "fr", "replies DESC, chat_lines DESC, peer_key", 5),
    "year_review_company": _first(_FRIENDS.replace("FROM e)", "FROM e WHERE session_id // 8 < 366)"), "fr", "shared_seconds DESC, shared_sessions DESC, peer_key", 3),
}


def _starred(c):
    """Each word is looked for twice, as neighbours share the sign between them."""
    for word, stars in (("t)(he", "**"), ("t)(hat", "***")) * 2:
        c = f"regexp_replace({c}, '(?i)(^|[^\\p{{L}}\\p{{N}}_])({word})([^\\p{{L}}\\p{{N}}_]|$)', '\\1\\2{stars}\\4', 'g')"
    return c


_SHOWN = f"WITH {CV} SELECT '64:' || id64 AS player_key, strftime(make_timestamp((date * 1000000)::BIGINT), '%Y-%m-%d %H:%M:%S') AS ts, map AS map_name, server, c.session_id, \"index\" * 1000 AS tick, \"index\", {_starred('text')} AS text FROM ch c JOIN us USING (session_id, uid) JOIN ss USING (session_id) JOIN ix ON id = c.session_id WHERE date < 1735689600"


def _long(part, sql, key, *metrics):
    """The same long rows from the SQL of one part; key is an expression over its columns, a metric a name or (name, expression)."""
    pairs = [m if isinstance(m, tuple) else (m, m) for m in metrics]
    told = ", ".join(f"{{'metric': '{m}', 'value': ({e})::DOUBLE}}" for m, e in pairs)
    return f"SELECT player_key, '{part}' AS part, key, m.metric AS metric, m.value AS value FROM (SELECT player_key, {key} AS key, unnest([{told}]) AS m FROM ({sql})) WHERE m.value IS NOT NULL"


_GK, _ST, _FR = "grouping || '|' || key", ["messages", "mean_length", "median_length", "exclamations", "questions", "laughter", "thanks", "sorry"], ["rank", "shared_sessions", "shared_seconds", "chat_lines", "replies"]
_COUNTED = ORACLES["year_review_peaks"].split("SELECT player_key, grouping, key, value FROM k")[0] + "SELECT * FROM k"
_FRY = ORACLES["friends"].replace(CV, _CVY).replace("WITH ", "", 1).replace("SELECT a.k AS player_key", ", fr AS (SELECT a.k AS player_key") + ")"
_ORDERS = {"playtime": "shared_seconds DESC, shared_sessions DESC, peer_key", "sessions": "shared_sessions DESC, shared_seconds DESC, peer_key", "interactions": "replies DESC, chat_lines DESC, peer_key"}
_SUP = ORACLES["year_review_superlatives"].replace("SELECT player_key, a.session_id", "SELECT player_key, a.compound AS funniest_compound, b.compound AS rudest_compound, a.session_id")
ORACLES |= {
    "url_chat": f"WITH {CV} SELECT c.session_id, url, strftime(make_timestamp((date * 1000000)::BIGINT), '%Y-%m-%d') AS date, map, \"index\" * 1000 AS tick, \"index\", coalesce(from_name, '') AS from_name, coalesce(text, '') AS text FROM ch c JOIN ss USING (session_id) JOIN ix ON id = c.session_id WHERE id % 3 = 0",
    "year_review_chat": _SHOWN, "year_review_lines": f"SELECT player_key, ts || ' | ' || map_name || ' | ' || server || ' | ' || regexp_replace(text, '[\\r\\n]+', ' ', 'g') AS line FROM ({_SHOWN})",
    "year_review_long": " UNION ALL ".join([
        _long("activity", ORACLES["year_review_activity"], "''", "first_date", "last_date", "sessions"), _long("messages", ORACLES["year_review_messages"], "''", "first_message", "last_message"),
        _long("chat_counts", _COUNTED, _GK, "value"), _long("chat_peaks", ORACLES["year_review_peaks"], _GK, "value"), _long("style", ORACLES["year_review_style"], "''", *_ST),
        _long("top_words", ORACLES["year_review_words"], "word", "n", "rank"), _long("top_phrases", ORACLES["year_review_phrases"], "phrase", "n", "rank"),
        *[_long(f"friends_by_{k}", _first(_FRY, "fr", o, 5, "*"), "peer_key", *_FR) for k, o in _ORDERS.items()],
        _long("sentiment", ORACLES["year_review_sentiment"], "coalesce(month, '')", "mean", "n"),
        _long("extremes", ORACLES["year_review_extremes"].replace("SELECT player_key, session_id", "SELECT compound, player_key, session_id"), "session_id || '|' || \"index\"", "compound", "up", "down"),
        _long("superlatives", _SUP, "''", *[(f"{w}.{c}", f"{w}_{c}") for w in ("funniest", "rudest") for c in ("session_id", "index", "compound")]),
    ]),
    "year_review_long_play": " UNION ALL ".join([
        _long("counts", ORACLES["year_review_sheet"], "''", "sessions", "sessions_with_time", "messages", "maps", "servers"), _long("class", ORACLES["year_review_class"], "class", ("one", "1")),
        _long("playtime_counts", f"WITH {_YEAR} SELECT * FROM y", _GK, "value"), _long("playtime_peaks", ORACLES["year_review_time"], _GK, "value"),
        _long("playtime_top", ORACLES["year_review_top"].replace("grouping, key, rank", "grouping, key, rank, value"), _GK, "value", "rank"),
        _long("friends_by_playtime", _first(_FRIENDS.replace("FROM e)", "FROM e WHERE session_id // 8 < 366)"), "fr", _ORDERS["playtime"], 3, "*"), "peer_key", *_FR),
        _long("records", ORACLES["year_review_records"].replace("map_name, class, seg, chat_index", "map_name, class, seg, session_id, chat_index"), "concat_ws('|', map_name, class, seg, session_id, chat_index)", "cs"),
        _long("record_counts", ORACLES["year_review_record_counts"], "''", "n", "n_inferred", "n_lookup", "n_plain"),
    ]),
}
