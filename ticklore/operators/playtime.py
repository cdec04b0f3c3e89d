"""Seconds alive and spectating by player and map, and who watches whom."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ticklore.operators.intervals import merge_intervals, overlap_ticks
from ticklore.sources.shared import stored


def common_name(df: DataFrame, keys: list[str], name: str = "name", order: str = "session_id") -> DataFrame:
    """The commonest name of each key, without case; ties go to the first seen, blanks do not count."""
    n = df.filter(F.trim(name) != "").groupBy(*keys, F.lower(name).alias("low")).agg(F.count("*").alias("n"), F.min(F.struct(order, name)).alias("first"))
    return n.groupBy(*keys).agg(F.max_by(F.col("first")[name], F.struct("n", (-F.col("first")[order]).alias("o"))).alias("name"))


def session_playtime(alive: DataFrame, visits: DataFrame) -> DataFrame:
    """visits: session_id, player_key, user_id, interval_per_tick. Ticks by class for each player and session."""
    t = alive.groupBy("session_id", "user_id").agg(*(F.sum(F.when(F.col("class") == c, F.col("end_tick") - F.col("start_tick")).otherwise(0)).alias(c) for c in ("soldier", "demoman")))
    both = visits.join(t, ["session_id", "user_id"], "left")
    return both.groupBy("session_id", "player_key", "interval_per_tick").agg(F.sum(F.coalesce("soldier", F.lit(0))).alias("soldier"), F.sum(F.coalesce("demoman", F.lit(0))).alias("demoman"))


def map_playtime(per_session: DataFrame, sessions: DataFrame) -> DataFrame:
    """Seconds by player and map (without case); maps visited for no time appear with zero sessions."""
    m = per_session.join(sessions.select("session_id", F.lower("map").alias("map")), "session_id")
    a = m.groupBy("player_key", "map", "interval_per_tick").agg(F.sum("soldier").alias("s"), F.sum("demoman").alias("d"), F.count_if(F.col("soldier") + F.col("demoman") > 0).alias("n"))
    rate = F.col("interval_per_tick")
    return a.groupBy("player_key", "map").agg(F.round(F.sum(F.col("s") * rate), 6).alias("soldier_seconds"), F.round(F.sum(F.col("d") * rate), 6).alias("demoman_seconds"), F.round(F.sum((F.col("s") + F.col("d")) * rate), 6).alias("total_seconds"), F.sum("n").alias("sessions"))


def map_spectating(iv: DataFrame, users: DataFrame, sessions: DataFrame) -> DataFrame:
    """Spectator seconds by player and map; several user ids of a player are not merged; no rows of zero."""
    j = iv.join(users.select("session_id", "user_id", "player_key"), ["session_id", "user_id"]).join(sessions.select("session_id", F.lower("map").alias("map")), "session_id")
    a = j.groupBy("player_key", "map", "interval_per_tick").agg(F.sum(F.col("end_tick") - F.col("start_tick")).alias("t"), F.count_distinct("session_id").alias("n"))
    return a.groupBy("player_key", "map").agg(F.round(F.sum(F.col("t") * F.col("interval_per_tick")), 6).alias("seconds"), F.sum("n").alias("sessions")).filter("seconds > 0")


def spectator_peers(alive: DataFrame, spectating: DataFrame, users: DataFrame) -> DataFrame:
    """For each ordered pair of players: seconds that the peer watched while the player was alive, and the other way round."""
    who = users.select("session_id", "user_id", "player_key")
    rate = alive.select("session_id", "interval_per_tick").unionByName(spectating.select("session_id", "interval_per_tick")).distinct()
    a = stored(merge_intervals(alive.join(who, ["session_id", "user_id"]), ["session_id", "player_key"]), "alive")
    s = stored(merge_intervals(spectating.join(who, ["session_id", "user_id"]), ["session_id", "player_key"]), "spectating").withColumnRenamed("player_key", "peer_key")
    t = overlap_ticks(a, s, ["session_id"], ["session_id", "player_key", "peer_key"]).filter("player_key <> peer_key AND ticks > 0").join(rate, "session_id")
    one = t.select("player_key", "peer_key", "interval_per_tick", F.col("ticks").alias("them"), F.lit(0).alias("me"))
    two = t.select(F.col("peer_key").alias("player_key"), F.col("player_key").alias("peer_key"), "interval_per_tick", F.lit(0).alias("them"), F.col("ticks").alias("me"))
    g = one.unionByName(two).groupBy("player_key", "peer_key", "interval_per_tick").agg(F.sum("them").alias("them"), F.count_if(F.col("them") > 0).alias("them_n"), F.sum("me").alias("me"), F.count_if(F.col("me") > 0).alias("me_n"))
    r = F.col("interval_per_tick")
    return g.groupBy("player_key", "peer_key").agg(F.round(F.sum(F.col("them") * r), 6).alias("watched_by_seconds"), F.sum("them_n").alias("watched_by_sessions"), F.round(F.sum(F.col("me") * r), 6).alias("watching_seconds"), F.sum("me_n").alias("watching_sessions"))


def top_n(df: DataFrame, keys: list[str], order: list, n: int) -> DataFrame:
    """The first n rows of each key; without keys, a limit."""
    if not keys:
        return df.orderBy(*order).limit(n)
    return df.withColumn("rank", F.row_number().over(Window.partitionBy(*keys).orderBy(*order))).filter(F.col("rank") <= n)


def peer_lists(peers: DataFrame, n: int = 20) -> dict[str, DataFrame]:
    """For each player the peers that watch them longest, and those that they watch longest."""
    return {by: top_n(peers.filter(F.col(by) > 0), ["player_key"], [F.desc(by), "peer_key"], n) for by in ("watched_by_seconds", "watching_seconds")}
