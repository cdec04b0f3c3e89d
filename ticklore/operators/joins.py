"""Joins of chats, users, sessions and the index."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ticklore.functions.scalars import player_key
from ticklore.operators.filters import is_player


def chats_with_users(chats: DataFrame, users: DataFrame) -> DataFrame:
    """Chat lines with their known speaker; lines without one drop."""
    u = users.select("session_id", F.col("user_id").alias("from_user_id"), "name", "id64", F.coalesce("clean_id", "raw_id").alias("id"), "is_bot")
    return chats.join(u, ["session_id", "from_user_id"])


def chats_of(chats: DataFrame, users: DataFrame, player: str | None = None) -> DataFrame:
    """Lines of one player, or of all with their player_key. The key of users is unique, so nothing fans out."""
    who = users.filter(is_player(player)) if player else users
    u = who.select("session_id", F.col("user_id").alias("from_user_id"), player_key(F.col("id64"), F.col("clean_id")).alias("player_key"), "name", "is_bot")
    return chats.join(u, ["session_id", "from_user_id"])


def resolve_speakers(chats: DataFrame, users: DataFrame) -> DataFrame:
    """For each line, the users with its entity id: how many, which, and the id only if it is the only one."""
    u = users.filter("user_id IS NOT NULL AND entity_id IS NOT NULL").groupBy("session_id", F.col("entity_id").alias("client_entity_id")).agg(F.count("*").alias("n"), F.sort_array(F.collect_list("user_id")).alias("candidates"), F.max("user_id").alias("one"))
    return chats.join(u, ["session_id", "client_entity_id"], "left").select("session_id", "index", F.coalesce("n", F.lit(0).cast("bigint")).alias("candidate_count"), F.coalesce("candidates", F.array().cast("array<int>")).alias("candidates"), F.when(F.col("n") == 1, F.col("one")).alias("resolved_user_id"))


def entity_map(users: DataFrame) -> DataFrame:
    """Entities that one user of the session has."""
    return users.filter("entity_id IS NOT NULL AND user_id IS NOT NULL").groupBy("session_id", "entity_id").agg(F.count("*").alias("n"), F.max("user_id").alias("user_id")).filter("n = 1").drop("n")


def with_session(df: DataFrame, sessions: DataFrame, index: DataFrame, missing: str = "unknown") -> DataFrame:
    """Adds map, server and date; a missing session's map is `missing`."""
    s = sessions.select("session_id", "map", "server")
    i = index.select(F.col("id").alias("session_id"), "date")
    return df.join(s, "session_id", "left").join(i, "session_id", "left").withColumn("map", F.coalesce("map", F.lit(missing)))


def sessions_of_urls(urls: DataFrame, index: DataFrame, sessions: DataFrame) -> DataFrame:
    """Landed sessions of a list of urls; of several with one url the least id."""
    both = urls.select("url").distinct().join(index.select("url", F.col("id").alias("session_id")), "url").join(sessions.select("session_id"), "session_id", "left_semi")
    return both.withColumn("rn", F.row_number().over(Window.partitionBy("url").orderBy("session_id"))).filter("rn = 1").drop("rn")


def block_pairs(rows: DataFrame, key: str, node: str, others: list[str], block: int = 2000) -> DataFrame:
    """Ordered pairs of different nodes of a key: key, node, the left row's `others`, and the right row's node as `peer`.

    A key of n rows is split into n / block parts; each pair of parts is a group of its own, so none holds more than about two blocks of rows.
    """
    sizes = rows.groupBy(key).agg(F.ceil(F.count("*") / block).cast("int").alias("parts"))
    dealt = rows.join(sizes, key).withColumns({"part": F.pmod(F.xxhash64(node), F.col("parts")).cast("int"), "meets": F.explode(F.sequence(F.lit(0), F.col("parts") - 1))})
    left = dealt.select(key, node, *others, F.col("part").alias("i"), F.col("meets").alias("j"))
    right = dealt.select(key, F.col(node).alias("peer"), F.col("meets").alias("i"), F.col("part").alias("j"))
    return left.join(right, [key, "i", "j"]).filter(F.col(node) != F.col("peer")).drop("i", "j")


def known_only(df: DataFrame, names: DataFrame, column: str = "name") -> DataFrame:
    """Rows whose trimmed lower-case name is on a list. The list is joined by what it is, broadcast only if Spark finds it small."""
    return df.withColumn("known", F.lower(F.trim(column))).join(names.select(F.lower(F.trim("name")).alias("known")).distinct(), "known", "left_semi").drop("known")


def unseen(df: DataFrame, existing: DataFrame, key: str = "id") -> DataFrame:
    return df.join(existing.select(key).distinct(), key, "left_anti")


def repair_flags(index: DataFrame, sessions: DataFrame) -> DataFrame:
    """Unprocessed index rows whose session is landed become processed."""
    landed = sessions.select(F.col("session_id").alias("id"), F.lit(True).alias("landed")).distinct()
    fix = ~F.col("processed") & F.coalesce("landed", F.lit(False))
    both = index.join(landed, "id", "left").withColumn("fix", fix)
    return both.select("id", "url", "date", (F.col("processed") | F.col("fix")).alias("processed"), (F.col("failed") & ~F.col("fix")).alias("failed"), F.when(~F.col("fix"), F.col("failure_reason")).alias("failure_reason"))
