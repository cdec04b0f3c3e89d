"""Archive-shaped tables from the given star-schema, event and conversation tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ticklore.functions.scalars import ID_BASE, format_time
from ticklore.operators.records import PREFIX

DAY = 86_400_000_000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def chat_index(c: DataFrame) -> DataFrame:
    i = c.select(F.col("conv_id").alias("id")).distinct()
    return i.select("id", F.concat(F.lit("http://x/"), "id").alias("url"), (F.lit(1704067200.0) + F.col("id") * 86400).alias("date"), (F.col("id") % 5 != 0).alias("processed"), (F.col("id") % 10 == 0).alias("failed"), F.when(F.col("id") % 10 == 0, "invalid").alias("failure_reason"))


def chat_sessions(c: DataFrame) -> DataFrame:
    return c.select(F.col("conv_id").alias("session_id")).distinct().select("session_id", F.concat(F.lit("map_"), F.col("session_id") % 7).alias("map"), F.concat(F.lit("srv "), F.col("session_id") % 3).alias("server"), F.lit(None).cast("int").alias("ticks"), F.lit(0.015).alias("interval_per_tick"), (F.col("session_id") * 10 + 3).alias("download_size"), (F.col("session_id") * 30 + 7).alias("extracted_size"))


def _uid(role):
    return F.when(role == "user", 1).when(role == "assistant", 2).otherwise(3)


def chat_users(c: DataFrame) -> DataFrame:
    u = c.select(F.col("conv_id").alias("session_id"), "role").distinct().withColumn("user_id", _uid(F.col("role")))
    none = F.lit(None).cast("string")
    return u.select("session_id", "user_id", F.col("role").alias("name"), none.alias("raw_id"), none.alias("clean_id"), (F.lit(ID_BASE) + 2 * F.col("user_id") + F.col("session_id") % 4).alias("id64"), (F.col("role") == "system").alias("is_bot"), (F.col("user_id") % 2).alias("entity_id"))


def chat_lines(c: DataFrame) -> DataFrame:
    return c.select(F.col("conv_id").alias("session_id"), F.col("turn").alias("index"), F.concat("role", F.lit(" : "), "text").alias("text"), (F.col("turn") * 1000).alias("tick"), _uid(F.col("role")).alias("from_user_id"), (_uid(F.col("role")) % 2).alias("client_entity_id"), F.col("role").alias("from_name"))


class EventTables:
    """sessions, users, spawns, deaths, changes and record chat from `events`. A session is a day and user_id % 8."""

    def __init__(self, events: DataFrame):
        since = F.expr("timestampdiff(MICROSECOND, timestamp_ntz'2024-01-01 00:00:00', cast(ts as timestamp_ntz))")
        e = events.withColumn("us", since)
        session = (F.floor(F.col("us") / DAY) * 8 + F.col("user_id") % 8).cast("bigint")
        e = e.select(session.alias("session_id"), "user_id", F.col("event_id").alias("index"), (F.col("us") % DAY).alias("tick"), "event_type", "value")
        self.events = e
        t = lambda *kinds: e.filter(F.col("event_type").isin(*kinds))
        self.spawns = t("signup", "click").select("session_id", "index", "tick", "user_id", F.when(F.col("event_type") == "signup", "soldier").otherwise("demoman").alias("class"))
        self.deaths = t("error").select("session_id", "index", "tick", F.col("user_id").alias("victim_user_id"))
        self.changes = t("view", "purchase").select("session_id", "index", "tick", "user_id", F.when(F.col("event_type") == "view", "spectator").otherwise("red").alias("team"), (F.col("event_type") == "purchase").alias("disconnect"))
        self.sessions = e.select("session_id").distinct().select("session_id", F.concat(F.lit("map_"), F.col("session_id") % 7).alias("map"), F.concat(F.lit("srv "), F.col("session_id") % 3).alias("server"), F.when(F.col("session_id") % 5 != 0, F.lit(DAY)).alias("ticks"), F.lit(1e-6).alias("interval_per_tick"))
        self.users = e.select("session_id", "user_id").distinct().withColumn("player_key", F.concat(F.lit("64:"), (F.col("user_id") % 40).cast("string")))

    def index(self) -> DataFrame:
        return self.sessions.select(F.col("session_id").alias("id"), (F.lit(1704067200.0) + F.floor(F.col("session_id") / 8) * 86400).alias("date"), F.concat(F.lit("http://x/"), "session_id").alias("url"), (F.col("session_id") % 4 == 0).alias("processed"), (F.col("session_id") % 4 == 1).alias("failed"), F.when(F.col("session_id") % 4 == 1, "gone").alias("failure_reason"))

    def record_chat(self) -> DataFrame:
        e = self.events.withColumn("cs", F.round(F.col("value") * 100).cast("int") + 1)
        m = F.concat(F.lit("map_"), F.col("user_id") % 5)
        say = PREFIX + "({class}) {user} "
        forms = [
            say + "beat the map record: {time} (-00:00.10)", say + "beat the map record: {time}!", say + "set the first map record: {time}!",
            say + "broke Bonus 1 {time} (WR -00:00.10) | 00:00.10 improvement!", say + "set Bonus 1 {time}!", say + "broke Course 2 {time} (WR -00:00.25)", say + "broke C2 - Jump One {time} (WR -00:00.10)",
            say + "map run {time} (WR -00:00.10)", say + "map run {time} ({label}", ":: ({class}) {user} set {map} WR: {time}!", say + "is ranked 1/12 on {map} with time: {time}", PREFIX + "({class} {kind}) {map} :: {time} :: {user}{note}",
        ]
        text = F.element_at(F.array(*[F.lit(f) for f in forms]), (F.col("index") % 12 + 1).cast("int"))
        label = F.when(F.col("user_id") % 3 == 0, "PR +00:00.10) | 00:00.05 improvement!").otherwise("WR +00:00.10)")
        words = {"time": format_time(F.col("cs")), "user": F.concat(F.lit("user_"), "user_id"), "class": F.when(F.col("user_id") % 13 == 5, "Scout").when(F.col("user_id") % 13 == 7, "demo").when(F.col("user_id") % 2 == 0, "Soldier").otherwise("Demoman"), "map": m, "label": label}
        # Some lookups are of another kind than WR, but pass the cheap test all the same.
        other = F.col("user_id") % 9 == 4
        words |= {"kind": F.when(other, "SR").otherwise("WR"), "note": F.when(other, " (no WR)").otherwise("")}
        for name, word in words.items():
            text = F.replace(text, F.lit("{" + name + "}"), word)
        said_by = F.when(F.col("index") % 5 != 0, F.col("user_id"))
        return e.select("session_id", F.col("index").cast("int").alias("index"), text.alias("text"), "tick", said_by.alias("from_user_id"))

    def named_users(self) -> DataFrame:
        none = F.lit(None).cast("string")
        u = self.users.select("session_id", "user_id", F.concat(F.lit("user_"), "user_id").alias("name"), none.alias("raw_id"), none.alias("clean_id"), (F.col("user_id") % 40).alias("id64"))
        return u.withColumn("is_bot", F.col("user_id") % 11 == 0)

    def documents(self) -> DataFrame:
        """session_id, body: the sessions as JSON documents. Of some the JSON is cut, others have no header."""
        e = self.events.withColumn("tick", (F.col("tick") % 1000000).cast("int")).withColumn("who", F.col("user_id").cast("int"))
        num, kind = F.col("index"), F.col("event_type")
        side = F.when(kind == "view", "spectator").otherwise("red")
        raw = F.when(num >= 0, F.element_at(F.array(F.concat(F.lit("STEAM_0:1:"), "user_id"), F.concat(F.lit("[U:1:"), "user_id", F.lit("]")), F.lit("BOT"), F.lit("weird")), (F.col("user_id") % 4 + 1).cast("int")))
        each = F.struct(
            "index", "tick", "who", kind.alias("kind"), F.when(kind == "signup", "soldier").otherwise("demoman").alias("class"), side.alias("team"),
            F.when(num % 10 == 0, "").when(num % 10 == 1, "0").otherwise(F.concat(F.lit("line "), num)).alias("text"), raw.alias("raw"),
        )
        s = e.groupBy("session_id").agg(F.array_sort(F.collect_list(each)).alias("all"))
        some = lambda test: F.filter("all", test)
        ids = F.array_distinct(F.transform("all", lambda x: F.struct(x["who"].alias("who"), x["raw"].alias("raw"))))
        entry = lambda x: F.struct(x["who"].cast("string").alias("key"), F.struct(F.concat(F.lit("user_"), x["who"]).alias("name"), x["who"].alias("userId"), x["raw"].alias("steamId"), (x["who"] % 50).alias("entityId"), F.lit("red").alias("team")).alias("value"))
        header = F.struct(F.concat(F.lit("map_"), F.col("session_id") % 7).alias("map"), F.concat(F.lit("srv "), F.col("session_id") % 3).alias("server"), F.lit(1000000).alias("ticks"))
        body = F.to_json(F.struct(
            F.when(F.col("session_id") % 11 != 5, header).alias("header"), F.map_from_entries(F.transform(ids, entry)).alias("users"),
            F.transform("all", lambda x: F.struct(F.lit("say").alias("kind"), F.concat(F.lit("user_"), x["who"]).alias("from"), x["text"].alias("text"), x["tick"].alias("tick"), (x["who"] % 50).alias("client"))).alias("chat"),
            F.transform(some(lambda x: x["kind"].isin("signup", "click")), lambda x: F.struct(x["who"].alias("user"), x["class"].alias("class"), x["team"].alias("team"), x["tick"].alias("tick"))).alias("spawns"),
            F.transform(some(lambda x: x["kind"].isin("view", "purchase")), lambda x: F.struct(x["who"].alias("user"), x["team"].alias("team"), (x["kind"] == "purchase").alias("disconnect"), x["tick"].alias("tick"))).alias("teamChanges"),
            F.transform(some(lambda x: x["kind"] == "error"), lambda x: F.struct(F.lit("rocket").alias("weapon"), x["who"].alias("victim"), (x["who"] + 1).alias("killer"), x["tick"].alias("tick"))).alias("deaths"),
            F.transform(some(lambda x: x["index"] % 7 == 0), lambda x: F.struct(x["tick"].alias("from"), (x["tick"] + 5).alias("to"))).alias("pauses"),
            F.lit(3).alias("startTick"), F.lit(0.015).alias("intervalPerTick"),
        ))
        return s.select("session_id", F.when(F.col("session_id") % 11 == 0, F.substring(body, 1, 40)).otherwise(body).alias("body"))
