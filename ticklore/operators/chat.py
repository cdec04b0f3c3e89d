"""Chat search, export, ranking and word counts."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ticklore.functions.scalars import calendar_keys, count_char, date_text, message_body, speaker_name, tokens
from ticklore.operators.filters import any_keyword, contains_ci, is_player_chat, mentions
from ticklore.operators.joins import chats_of, chats_with_users, sessions_of_urls, with_session
from ticklore.operators.scan import SLICE_ROWS, halo, positions, sliced

# Words that tell a kind of message.
LAUGHTER, THANKS, SORRY = ("lol", "lmao", "rofl", "haha"), ("ty", "thanks", "thx"), ("sorry", "sry")
# Words that word and phrase counts leave out.
STOP_WORDS = """
a an and are as at be but by for from has have he her
hers him his i im in is it its ive just like me my no
not of oh ok okay on or our out so that the their them
then there they this to u uh ur us was we were what when
who why with ya ye you your yours rt gg wp
""".split()


def search_messages(chats: DataFrame, sessions: DataFrame, index: DataFrame, phrase: str) -> DataFrame:
    return with_session(chats.filter(contains_ci(F.col("text"), phrase)), sessions, index).select("session_id", "index", "map", "server", "date", "text")


def export_map_chat(chats: DataFrame, sessions: DataFrame, map_name: str) -> DataFrame:
    own = sessions.filter(F.col("map") == map_name).select("session_id")
    return chats.join(own, "session_id", "left_semi").select("session_id", "index", "from_name", "text").orderBy("session_id", "index")


def export_user_chat(chats: DataFrame, users: DataFrame, sessions: DataFrame, index: DataFrame, player: str) -> DataFrame:
    return with_session(chats_of(chats, users, player), sessions, index).select("date", "session_id", "index", "map", "text").orderBy("date", "session_id", "index")


def export_url_chat(chats: DataFrame, urls: DataFrame, sessions: DataFrame, index: DataFrame) -> DataFrame:
    """All lines of the sessions that a list of urls names: session_id, url, date, map, tick, index, from_name, text."""
    asked = sessions_of_urls(urls, index, sessions)
    lines = with_session(chats.join(asked, "session_id"), sessions, index).withColumn("date", date_text(F.col("date")))
    return lines.select("session_id", "url", "date", "map", "tick", "index", F.coalesce("from_name", F.lit("")).alias("from_name"), F.coalesce("text", F.lit("")).alias("text")).orderBy("url", "index")


def export_mentions(chats: DataFrame, users: DataFrame, term: str, n: int = 5, exclude_id64: int | None = None, exclude_names: list[str] | None = None, slice_rows: int = SLICE_ROWS) -> DataFrame:
    """Player lines that mention the term, and those up to n lines around the first and last of each session."""
    u = users.select("session_id", F.col("user_id").alias("from_user_id"), "id64")
    lines = chats.filter(is_player_chat(F.col("text"))).join(u, ["session_id", "from_user_id"], "left")
    keep = mentions(message_body(F.col("text")), term) & ~F.col("id64").eqNullSafe(F.lit(exclude_id64)) if exclude_id64 is not None else mentions(message_body(F.col("text")), term)
    if exclude_names:
        keep = keep & ~F.coalesce(F.lower(speaker_name(F.col("text"))).isin([x.lower() for x in exclude_names]), F.lit(False))
    told = sliced(lines.select("session_id", "index", "text", keep.alias("hit")), ["session_id"], ["index"], slice_rows)
    return context_window(positions(told, ["session_id"], ["index"]), n)


def context_window(numbered: DataFrame, n: int) -> DataFrame:
    """numbered: lines with session_id, pos, hit. One span a session, from the first hit less n to the last and n."""
    span = numbered.filter("hit").groupBy("session_id").agg((F.min("pos") - n).alias("lo"), (F.max("pos") + n).alias("hi"))
    return numbered.join(span, "session_id").filter("pos BETWEEN lo AND hi").select("session_id", "index", "text", "hit")


def keyword_rank(chats: DataFrame, users: DataFrame, words: list[str]) -> DataFrame:
    hits = chats_with_users(chats.filter(any_keyword(F.col("text"), words)), users)
    return hits.groupBy("id64", "id", "name").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "id64", "name")


def server_records(chats: DataFrame, sessions: DataFrame, like: str) -> DataFrame:
    own = sessions.filter(F.col("server").contains(like)).select("session_id", "map", "server")
    return chats.filter(F.col("text").contains("broke")).join(own, "session_id").select("session_id", "index", "map", "server", "text")


def word_counts(texts: DataFrame, stop: list[str] = STOP_WORDS, text: str = "text", by: list[str] | None = None) -> DataFrame:
    by = by or []
    w = texts.select(*by, F.explode(tokens(F.col(text))).alias("word")).filter(~F.col("word").isin(stop))
    return w.groupBy(*by, "word").agg(F.count("*").alias("n"))


def bigram_counts(texts: DataFrame, stop: list[str] = STOP_WORDS, text: str = "text", by: list[str] | None = None) -> DataFrame:
    """Neighbouring tokens, neither of which is a stop word."""
    by = by or []
    t = texts.select(*by, tokens(F.col(text)).alias("t"))
    pair = F.arrays_zip(F.slice("t", F.lit(1), F.greatest(F.size("t") - 1, F.lit(0))).alias("a"), F.slice("t", 2, F.greatest(F.size("t") - 1, F.lit(0))).alias("b"))
    p = t.select(*by, F.explode(pair).alias("p")).select(*by, F.col("p")["a"].alias("a"), F.col("p")["b"].alias("b"))
    return p.filter(~F.col("a").isin(stop) & ~F.col("b").isin(stop)).groupBy(*by, F.concat_ws(" ", "a", "b").alias("phrase")).agg(F.count("*").alias("n"))


def message_style(chats: DataFrame, by: list[str] | None = None) -> DataFrame:
    """Lengths in code points; the median averages the middle two."""
    body = message_body(F.col("text"))
    b = chats.select(*(by or []), body.alias("body")).withColumn("t", tokens(F.col("body")))
    some = lambda words: F.count_if(F.arrays_overlap("t", F.array(*[F.lit(w) for w in words])))
    g = b.groupBy(*by) if by else b.groupBy()
    return g.agg(
        F.count("*").alias("messages"), F.round(F.avg(F.length("body")), 6).alias("mean_length"), F.percentile(F.length("body"), F.lit(0.5)).alias("median_length"),
        F.sum(count_char(F.col("body"), "!")).alias("exclamations"), F.sum(count_char(F.col("body"), "?")).alias("questions"),
        some(LAUGHTER).alias("laughter"), some(THANKS).alias("thanks"), some(SORRY).alias("sorry"),
    )


def by_each(df: DataFrame, sets: list[str], measure, keep: list[str] | None = None) -> DataFrame:
    """One scan, grouped by each of the sets on its own: (keep.., grouping, key, value)."""
    keep = keep or []
    # One row for each of the few sets before aggregation; partial sums follow at once.
    pairs = F.explode(F.array(*[F.struct(F.lit(s).alias("grouping"), F.col(s).cast("string").alias("key")) for s in sets])).alias("p")
    return df.select(*keep, "weight", pairs).select(*keep, "weight", "p.*").filter("key IS NOT NULL AND trim(key) <> ''").groupBy(*keep, "grouping", "key").agg(measure.alias("value"))


def chat_counts(chats: DataFrame, sessions: DataFrame, index: DataFrame, keep: list[str] | None = None) -> DataFrame:
    """Lines by map, server, month, day, hour and weekday (UTC)."""
    c = with_session(chats, sessions, index)
    c = c.withColumns(calendar_keys(F.col("date"))).withColumn("weight", F.lit(1))
    return by_each(c, ["map", "server", "month", "day", "hour", "weekday"], F.sum("weight"), keep)


def peaks(counts: DataFrame, keep: list[str] | None = None) -> DataFrame:
    """The top entry of each grouping; ties go to the least key."""
    w = Window.partitionBy(*(keep or []), "grouping").orderBy(F.desc("value"), "key")
    return counts.withColumn("rn", F.row_number().over(w)).filter("rn = 1").drop("rn")


def chat_neighbours(chats: DataFrame, users: DataFrame, k: int = 3, slice_rows: int = SLICE_ROWS) -> DataFrame:
    """For each line of a player, the distinct other players among the k lines before and the k after: how often each.

    Sessions are dealt in slices, and each slice gets the k lines on either side of it.
    """
    c = chats_of(chats, users).select("session_id", "index", F.when(~F.coalesce("is_bot", F.lit(False)), F.col("player_key")).alias("who"))
    own = halo(sliced(c, ["session_id"], ["index"], slice_rows), ["session_id"], ["index"], k, ["who"])
    w = Window.partitionBy("session_id", "slice").orderBy("index")
    side = lambda f: F.array(*[f("who", i).over(w) for i in range(1, k + 1)])
    sides = own.select("who", "own", side(F.lead).alias("ahead"), side(F.lag).alias("behind")).filter("own")
    near = sides.select("who", F.explode(F.array("ahead", "behind")).alias("near")).filter("who IS NOT NULL")
    return near.select("who", F.explode(F.array_distinct(F.array_compact("near"))).alias("other")).filter("who <> other").groupBy(F.col("who").alias("player_key"), F.col("other").alias("peer_key")).agg(F.count("*").alias("n"))
