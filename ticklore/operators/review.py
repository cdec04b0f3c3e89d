"""Archive statistics, friends, and the year in review as a set of DataFrames."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ticklore.functions.scalars import calendar_keys, epoch_timestamp, mask_words, message_body, player_key
from ticklore.operators.chat import bigram_counts, by_each, chat_counts, chat_neighbours, message_style, peaks, word_counts
from ticklore.operators.filters import in_year
from ticklore.operators.joins import block_pairs, chats_of, with_session
from ticklore.operators.playtime import map_playtime, top_n
from ticklore.operators.records import include, include_counts, player_records, record_history
from ticklore.operators.sentiment import extreme_messages, sentiment, sentiment_overall, superlatives
from ticklore.sources.shared import stored


def rounded_sum(seconds: Column) -> Column:
    """A sum of seconds to four places, added as decimals: the order in which rows come cannot tip a half."""
    return F.round(F.sum(seconds.cast("decimal(28,9)")), 4).cast("double")


def archive_stats(index: DataFrame, sessions: DataFrame | None = None) -> DataFrame:
    a = index.agg(F.count_if("processed").alias("processed"), F.count_if("failed").alias("failed"), F.count_if(~F.col("processed") & ~F.col("failed")).alias("neither"), F.count("*").alias("total"))
    if sessions is None or "download_size" not in sessions.columns:
        return a
    return a.crossJoin(sessions.agg(F.sum("download_size").alias("download_size"), F.sum("extracted_size").alias("extracted_size")))  # one row by one row


def map_names(sessions: DataFrame, like: str | None = None) -> DataFrame:
    s = sessions if like is None else sessions.filter(F.col("map").contains(like))
    return s.select("map").distinct().orderBy("map")


def playtime_counts(per_session: DataFrame, sessions: DataFrame, index: DataFrame, keep: list[str] | None = None) -> DataFrame:
    """Seconds by map, server, weekday, month, day and hour. per_session: as session_playtime() gives it."""
    p = with_session(per_session, sessions, index).withColumns(calendar_keys(F.col("date")))
    p = p.withColumn("weight", (F.col("soldier") + F.col("demoman")) * F.col("interval_per_tick")).filter("weight > 0")
    return by_each(p, ["map", "server", "weekday", "month", "day", "hour"], rounded_sum(F.col("weight")), keep)


def favourite_class(per_map: DataFrame) -> DataFrame:
    t = per_map.groupBy("player_key").agg(F.sum("soldier_seconds").alias("s"), F.sum("demoman_seconds").alias("d"))
    return t.select("player_key", F.when(F.col("s") >= F.col("d"), "soldier").otherwise("demoman").alias("class"))


def activity(users: DataFrame, index: DataFrame) -> DataFrame:
    u = users.select("session_id", "player_key").distinct().join(index.select(F.col("id").alias("session_id"), "date"), "session_id")
    return u.groupBy("player_key").agg(F.min("date").alias("first_date"), F.max("date").alias("last_date"), F.count("*").alias("sessions"))


def friends(chats: DataFrame, users: DataFrame, per_session: DataFrame | None = None, k: int = 3) -> DataFrame:
    """player, peer, shared sessions, shared playtime (the player's own), the peer's lines there, and replies."""
    u = users.filter(~F.coalesce("is_bot", F.lit(False))).select("session_id", player_key(F.col("id64"), F.col("clean_id")).alias("player_key")).filter("player_key IS NOT NULL").distinct()
    if per_session is not None:
        u = u.join(per_session.groupBy("session_id", "player_key").agg(F.sum((F.col("soldier") + F.col("demoman")) * F.col("interval_per_tick")).alias("seconds")), ["session_id", "player_key"], "left")
    else:
        u = u.withColumn("seconds", F.lit(0.0))
    lines = chats_of(chats, users).groupBy("session_id", F.col("player_key").alias("peer_key")).agg(F.count("*").alias("lines"))
    pairs = block_pairs(u, "session_id", "player_key", ["seconds"]).withColumnRenamed("peer", "peer_key").join(lines, ["session_id", "peer_key"], "left")
    shared = pairs.groupBy("player_key", "peer_key").agg(F.count("*").alias("shared_sessions"), rounded_sum(F.coalesce("seconds", F.lit(0.0))).alias("shared_seconds"), F.sum(F.coalesce("lines", F.lit(0))).alias("chat_lines"))
    near = chat_neighbours(chats, users, k).withColumnRenamed("n", "replies")
    return shared.join(near, ["player_key", "peer_key"], "left").withColumn("replies", F.coalesce("replies", F.lit(0)))


def friend_lists(f: DataFrame, n: int = 10) -> dict[str, DataFrame]:
    order = {"by_playtime": [F.desc("shared_seconds"), F.desc("shared_sessions"), "peer_key"], "by_sessions": [F.desc("shared_sessions"), F.desc("shared_seconds"), "peer_key"], "by_interactions": [F.desc("replies"), F.desc("chat_lines"), "peer_key"]}
    return {k: top_n(f, ["player_key"], v, n) for k, v in order.items()}


def message_span(chats: DataFrame, index: DataFrame, keys: list[str]) -> DataFrame:
    """The first and the last date with a message."""
    dated = chats.join(index.select(F.col("id").alias("session_id"), "date"), "session_id")
    return dated.groupBy(*keys).agg(F.min("date").alias("first_message"), F.max("date").alias("last_message"))


def counts_sheet(users: DataFrame, chats: DataFrame, per_session: DataFrame, sessions: DataFrame) -> DataFrame:
    """Of each player: sessions, those with time alive, messages, and maps and servers played on."""
    seen = users.groupBy("player_key").agg(F.count_distinct("session_id").alias("sessions"))
    said = chats.groupBy("player_key").agg(F.count("*").alias("messages"))
    played = per_session.groupBy("session_id", "player_key").agg(F.sum(F.col("soldier") + F.col("demoman")).alias("t")).filter("t > 0")
    where = played.join(sessions.select("session_id", "map", "server"), "session_id", "left")
    time = where.groupBy("player_key").agg(F.count("*").alias("sessions_with_time"), F.count_distinct("map").alias("maps"), F.count_distinct("server").alias("servers"))
    both = seen.join(said, "player_key", "left").join(time, "player_key", "left")
    return both.select("player_key", *[F.coalesce(c, F.lit(0)).alias(c) for c in ("sessions", "sessions_with_time", "messages", "maps", "servers")])


def top_words(chats: DataFrame, n: int) -> DataFrame:
    return top_n(word_counts(chats, by=["player_key"]), ["player_key"], [F.desc("n"), "word"], n)


def top_phrases(chats: DataFrame, n: int) -> DataFrame:
    return top_n(bigram_counts(chats, by=["player_key"]), ["player_key"], [F.desc("n"), "phrase"], n)


def year_chat(chats: DataFrame, sessions: DataFrame, index: DataFrame, mask=None) -> DataFrame:
    """Each player's lines as they are shown: player_key, ts, map, server, session_id, tick, index, text. mask: what is put over a text."""
    lines = with_session(chats, sessions, index).withColumn("ts", F.date_format(epoch_timestamp(F.col("date")), "yyyy-MM-dd HH:mm:ss"))
    return lines.select("player_key", "ts", "map", F.coalesce("server", F.lit("unknown")).alias("server"), "session_id", "tick", "index", (mask(F.col("text")) if mask else F.col("text")).alias("text"))


#: Of each part of a review, what its rows are named by, and what they tell in numbers.
SHEET: dict[str, tuple[list[str], list[str]]] = {
    "activity": ([], ["first_date", "last_date", "sessions"]), "messages": ([], ["first_message", "last_message"]),
    "counts": ([], ["sessions", "sessions_with_time", "messages", "maps", "servers"]),
    "style": ([], ["messages", "mean_length", "median_length", "exclamations", "questions", "laughter", "thanks", "sorry"]),
    **{k: (["grouping", "key"], ["value"]) for k in ("chat_counts", "chat_peaks", "playtime_counts", "playtime_peaks")}, "playtime_top": (["grouping", "key"], ["value", "rank"]),
    "class": (["class"], ["one"]), "top_words": (["word"], ["n", "rank"]), "top_phrases": (["phrase"], ["n", "rank"]),
    **{f"friends_by_{k}": (["peer_key"], ["rank", "shared_sessions", "shared_seconds", "chat_lines", "replies"]) for k in ("playtime", "sessions", "interactions")},
    "records": (["map", "class", "seg", "session_id", "chat_index"], ["cs"]), "record_counts": ([], ["n", "n_inferred", "n_lookup", "n_plain"]),
    "sentiment": (["month"], ["mean", "n"]), "extremes": (["session_id", "index"], ["compound", "up", "down"]),
    "superlatives": ([], [f"{w}.{c}" for w in ("funniest", "rudest") for c in ("session_id", "index", "compound")]),
}


def year_sheet(parts: dict[str, DataFrame]) -> DataFrame:
    """The parts of a review as one long table: player_key, part, key, metric, value. Keys of several columns are joined by |; absent values have no row."""

    def long(part: str) -> DataFrame:
        keys, metrics = SHEET[part]
        told = F.array(*[F.struct(F.lit(m).alias("metric"), (F.lit(1.0) if m == "one" else F.col(m).cast("double")).alias("value")) for m in metrics])
        key = F.concat_ws("|", *[F.coalesce(F.col(k).cast("string"), F.lit("")) for k in keys]) if keys else F.lit("")
        return parts[part].select("player_key", F.lit(part).alias("part"), key.alias("key"), F.explode(told).alias("m")).select("player_key", "part", "key", "m.*").filter("value IS NOT NULL")

    return reduce(DataFrame.unionByName, [long(part) for part in parts if part in SHEET])


def year_review(tables: dict[str, DataFrame], year: int, n: int = 10, masked: tuple[str, str] | None = None) -> dict[str, DataFrame]:
    """A DataFrame for each part of the review, with every player in it at once. The year's rows are read once, and stored for all parts.

    tables: chats, users, sessions, index; with per_session the parts on time, with records (as extract_records() gives them)
    those on records, with lexicon those on sentiment. masked: a pattern of words and how they are starred, as mask_words() takes
    them, in what is shown of texts (lines, words, phrases, extremes); counts and scores are of the words as they were said.
    """

    def mask(c: Column) -> Column:
        return mask_words(c, *masked) if masked else c

    index = tables["index"].filter(in_year(F.col("date"), year))
    own = index.select(F.col("id").alias("session_id"))
    here = {k: tables[k].join(own, "session_id", "left_semi") for k in ("chats", "users", "per_session", "records") if k in tables}
    # One scan of each for all parts: the year's rows, stored.
    here = {k: stored(v, f"year-{k}") for k, v in here.items()}
    chats, sessions = stored(chats_of(here["chats"], here["users"]).withColumn("body", message_body(F.col("text"))), "year-lines"), tables["sessions"]
    named = here["users"].withColumn("player_key", player_key(F.col("id64"), F.col("clean_id"))).filter("player_key IS NOT NULL")
    counts = chat_counts(chats, sessions, index, ["player_key"])
    f = friends(here["chats"], here["users"], here.get("per_session"))
    out = {
        "activity": activity(named, index), "messages": message_span(chats, index, ["player_key"]),
        "chat_counts": counts, "chat_peaks": peaks(counts, ["player_key"]), "style": message_style(chats, ["player_key"]),
        "top_words": top_words(chats.withColumn("text", F.col("body")), n).withColumn("word", mask(F.col("word"))),
        "top_phrases": top_phrases(chats.withColumn("text", F.col("body")), n).withColumn("phrase", mask(F.col("phrase"))),
        "chat": year_chat(chats, sessions, index, mask),
        **{f"friends_{k}": v for k, v in friend_lists(f, n).items()},
    }
    if "per_session" in tables:
        p = playtime_counts(here["per_session"], sessions, index, ["player_key"])
        out |= {"counts": counts_sheet(named, chats, here["per_session"], sessions), "playtime_counts": p, "playtime_peaks": peaks(p, ["player_key"]), "playtime_top": top_n(p, ["player_key", "grouping"], [F.desc("value"), "key"], n)}
        out["class"] = favourite_class(map_playtime(here["per_session"], sessions))
    if "records" in tables:
        h = record_history(player_records(here["records"], named), ["player_key", "map", "class"], any_kind=True)
        out |= {"records": include(h), "record_counts": include_counts(h, ["player_key"])}
    if "lexicon" in tables:
        scored = stored(sentiment(chats, "body", tables["lexicon"], ["session_id", "index"]).join(index.select(F.col("id").alias("session_id"), "date"), "session_id"), "year-scored")
        out |= {"sentiment": sentiment_overall(scored, ["player_key"]), "extremes": extreme_messages(scored, ["player_key"]).withColumns({c: mask(F.col(c)) for c in ("text", "body")}), "superlatives": superlatives(scored, ["player_key"])}
    return out
