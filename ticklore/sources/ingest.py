"""From index lists, record pages and session documents to typed tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ticklore.functions.scalars import normalize_player_id
from ticklore.operators.joins import entity_map, unseen
from ticklore.sources import schemas


def _new_index(df: DataFrame) -> DataFrame:
    return df.select("id", "url", "date", F.lit(False).alias("processed"), F.lit(False).alias("failed"), F.lit(None).cast("string").alias("failure_reason"))


def ingest_index(lines: DataFrame, existing: DataFrame) -> DataFrame:
    """lines: value, line_no. `id | date | url`; others drop, so do known ids; the first good line of an id wins."""
    p = F.split("value", r"\|")
    told = lines.filter(F.size(p) >= 3).select(F.trim(p[0]).try_cast("bigint").alias("id"), F.trim(p[1]).try_cast("double").alias("date"), F.trim(p[2]).alias("url"), "line_no")
    good = told.filter("id IS NOT NULL AND date IS NOT NULL")
    first = good.groupBy("id").agg(F.min_by(F.struct("date", "url"), "line_no").alias("f")).select("id", "f.date", "f.url")
    return _new_index(unseen(first, existing))


def ingest_record_pages(pages: DataFrame, existing: DataFrame) -> DataFrame:
    """pages: page_no, soldier, demoman. Soldier runs come first; runs without a session or url drop."""
    none = F.array().cast(schemas.RUN)
    runs = pages.select("page_no", F.posexplode(F.concat(F.coalesce("soldier", none), F.coalesce("demoman", none))).alias("pos", "run"))
    told = runs.select(F.col("run.demo_info.id").alias("id"), F.col("run.demo_info.url").alias("url"), F.col("run.date").alias("date"), "page_no", "pos").filter("id IS NOT NULL AND trim(url) <> ''")
    first = told.groupBy("id").agg(F.min_by(F.struct("url", "date"), F.struct("page_no", "pos")).alias("f")).select("id", "f.url", "f.date")
    return _new_index(unseen(first, existing))


def enumerate_zones(overviews: DataFrame) -> DataFrame:
    """(map_id, zone_id), each zone once; a zone of several maps goes to the least."""
    none = F.array().cast("array<struct<id:bigint>>")
    z = overviews.select("map_id", F.explode(F.concat(*[F.coalesce(c, none) for c in schemas.ZONE_LISTS])).alias("z"))
    return z.select("map_id", F.col("z.id").alias("zone_id")).groupBy("zone_id").agg(F.min("map_id").alias("map_id"))


def read_documents(docs: DataFrame, keep: list[str] | None = None) -> DataFrame:
    """docs: session_id, body (JSON). session_id, d, bad (it cannot be read), and the columns to keep."""
    # As a generator, so that a document is parsed once, not again for each test and field of it.
    read = docs.select("session_id", *(keep or []), F.explode(F.array(F.from_json("body", schemas.DOCUMENT, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_corrupt"}))).alias("d"))
    return read.withColumn("bad", F.col("d").isNull() | F.col("d._corrupt").isNotNull() | F.col("d.header").isNull())


def land_sessions(docs: DataFrame) -> dict[str, DataFrame]:
    """docs: session_id, body (JSON). Seven tables, and those documents that could not be read."""
    return session_tables(read_documents(docs))


def session_tables(read: DataFrame) -> dict[str, DataFrame]:
    """Of documents as read_documents() gives them."""
    good, bad = read.filter("NOT bad"), read.filter("bad")
    z = lambda c: F.coalesce(c, F.lit(0))

    def each(name, *cols, keep=None):
        items = F.col(f"d.{name}") if keep is None else F.filter(f"d.{name}", keep)
        return good.select("session_id", F.posexplode(items).alias("index", "x")).select("session_id", "index", *cols)

    sessions = good.select("session_id", *[F.col(f"d.header.{c}").alias(c) for c in ("map", "server", "demo_type", "nick", "game", "version", "protocol", "ticks", "frames", "signon", "duration")], F.col("d.startTick").alias("start_tick"), F.col("d.intervalPerTick").alias("interval_per_tick"))
    u = good.select("session_id", F.explode("d.users").alias("k", "x")).withColumn("p", normalize_player_id(F.col("x.steamId")))
    users = u.select("session_id", F.col("x.userId").alias("user_id"), F.col("x.name").alias("name"), F.col("x.steamId").alias("raw_id"), F.col("p.clean").alias("clean_id"), F.col("p.id64").alias("id64"), F.col("p.kind").alias("id_kind"), F.col("p.is_bot").alias("is_bot"), F.col("x.entityId").alias("entity_id"), F.col("x.team").alias("team")).filter("user_id IS NOT NULL")
    chats = each("chat", F.col("x.kind").alias("kind"), F.col("x.from").alias("from_name"), F.col("x.text").alias("text"), F.col("x.tick").alias("tick"), F.col("x.client").alias("client_entity_id"), keep=lambda x: ~F.coalesce(x["text"], F.lit("")).isin("", "0"))
    speakers = entity_map(users).select("session_id", F.col("entity_id").alias("client_entity_id"), F.col("user_id").alias("from_user_id"))
    return {
        "sessions": sessions,
        "users": users,
        "chats": chats.join(speakers, ["session_id", "client_entity_id"], "left").select("session_id", "index", "kind", "from_name", "text", "tick", "client_entity_id", "from_user_id"),
        "spawns": each("spawns", z(F.col("x.tick")).alias("tick"), F.col("x.user").alias("user_id"), F.col("x.class").alias("class"), F.col("x.team").alias("team")),
        "team_changes": each("teamChanges", z(F.col("x.tick")).alias("tick"), F.col("x.user").alias("user_id"), F.col("x.team").alias("team"), F.col("x.oldTeam").alias("old_team"), F.col("x.disconnect").alias("disconnect"), F.col("x.autoTeam").alias("auto_team"), F.col("x.silent").alias("silent"), F.col("x.name").alias("name")),
        "deaths": each("deaths", z(F.col("x.tick")).alias("tick"), F.col("x.weapon").alias("weapon"), z(F.col("x.victim")).alias("victim_user_id"), z(F.col("x.killer")).alias("killer_user_id"), F.col("x.assister").alias("assister_user_id")),
        "pauses": each("pauses", F.col("x.from").alias("from_tick"), F.col("x.to").alias("to_tick")),
        "quarantine": bad.select("session_id", F.lit("invalid_stv").alias("failure_reason")),
    }


def quarantine(index: DataFrame, bad: DataFrame) -> DataFrame:
    """Marks sessions that could not be read as failed; processed ones stay as they are."""
    b = bad.select(F.col("session_id").alias("id"), F.col("failure_reason").alias("why")).dropDuplicates(["id"])
    hit = F.col("why").isNotNull() & ~F.col("processed")
    return index.join(b, "id", "left").select("id", "url", "date", "processed", (F.col("failed") | hit).alias("failed"), F.when(hit, F.col("why")).otherwise(F.col("failure_reason")).alias("failure_reason"))


def pending(index: DataFrame, include_failed: bool = False, limit: int | None = None) -> DataFrame:
    p = index.filter(~F.col("processed") & (F.lit(include_failed) | ~F.col("failed"))).orderBy("date", "id")
    return p if limit is None else p.limit(limit)


def to_reland(index: DataFrame, offset: int = 0, limit: int | None = None) -> DataFrame:
    done = index.filter("processed").orderBy("id").offset(offset).select("id")
    return done if limit is None else done.limit(limit)


__all__ = ["enumerate_zones", "ingest_index", "ingest_record_pages", "land_sessions", "pending", "quarantine", "read_documents", "session_tables", "to_reland"]
