"""Tick intervals from event logs, as windows."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

USER = ["session_id", "user_id"]
PLAYABLE = ("soldier", "demoman")
#: At equal ticks what ends an interval comes before what starts one.
DEATH, SPECTATE, SPAWN = 0, 1, 2


def player_events(spawns: DataFrame, deaths: DataFrame, changes: DataFrame) -> DataFrame:
    """session_id, user_id, tick, kind, index, class: spawns, deaths of the victim, and turns to spectator or away."""
    none = F.lit(None).cast("string")
    one = spawns.select(*USER, "tick", F.lit(SPAWN).alias("kind"), "index", F.lower("class").alias("class"))
    two = deaths.select("session_id", F.col("victim_user_id").alias("user_id"), "tick", F.lit(DEATH).alias("kind"), "index", none.alias("class"))
    away = changes.filter((F.lower("team") == "spectator") | F.col("disconnect"))
    return one.unionByName(two).unionByName(away.select(*USER, "tick", F.lit(SPECTATE).alias("kind"), "index", none.alias("class")))


def session_ends(sessions: DataFrame, events: DataFrame, scope: list[str] | None = None) -> DataFrame:
    """end_tick of each session (and scope): the header's ticks if over 0, else the last tick of the events given."""
    keys = ["session_id", *(scope or [])]
    last = events.groupBy(*keys).agg(F.max("tick").alias("last_tick"))
    both = last.join(sessions.filter("interval_per_tick > 0").select("session_id", "ticks", "interval_per_tick"), "session_id")
    return both.select(*keys, F.when(F.col("ticks") > 0, F.col("ticks")).otherwise(F.col("last_tick")).cast("bigint").alias("end_tick"), "interval_per_tick").filter("end_tick > 0")


def alive_intervals(events: DataFrame, ends: DataFrame, classes: tuple[str, ...] = PLAYABLE) -> DataFrame:
    """Each spawn of a playable class to the next event of any kind, or the session's end."""
    w = Window.partitionBy(*USER).orderBy("tick", "kind", "index")
    keys = [k for k in USER if k in ends.columns]
    nxt = events.withColumn("next_tick", F.lead("tick").over(w)).filter((F.col("kind") == SPAWN) & F.col("class").isin(*classes))
    return nxt.join(ends, keys).select(*USER, "class", F.col("tick").alias("start_tick"), F.coalesce("next_tick", "end_tick").alias("end_tick"), "interval_per_tick").filter("end_tick > start_tick")


def spectator_intervals(changes: DataFrame, spawns: DataFrame, ends: DataFrame) -> DataFrame:
    """From each turn to spectator to the next other turn or spawn; repeated turns are one."""
    start = F.coalesce((F.lower("team") == "spectator") & ~F.col("disconnect"), F.lit(False))
    log = changes.select(*USER, "tick", F.when(start, 0).otherwise(1).alias("kind"), "index").unionByName(spawns.select(*USER, "tick", F.lit(1).alias("kind"), "index"))
    w = Window.partitionBy(*USER).orderBy("tick", "kind", "index")
    ahead = w.rowsBetween(1, Window.unboundedFollowing)
    told = log.withColumn("before", F.lag("kind").over(w)).withColumn("stop", F.first(F.when(F.col("kind") == 1, F.col("tick")), ignorenulls=True).over(ahead))
    keys = [k for k in USER if k in ends.columns]
    return told.filter("kind = 0 AND (before IS NULL OR before = 1)").join(ends, keys).select(*USER, F.col("tick").alias("start_tick"), F.coalesce("stop", "end_tick").alias("end_tick"), "interval_per_tick").filter("end_tick > start_tick")


def merge_intervals(iv: DataFrame, keys: list[str]) -> DataFrame:
    """Touching and overlapping intervals of one key as one."""
    w = Window.partitionBy(*keys).orderBy("start_tick", "end_tick")
    far = F.max("end_tick").over(w.rowsBetween(Window.unboundedPreceding, -1))
    new = F.when(far.isNull() | (F.col("start_tick") > far), 1).otherwise(0)
    island = iv.select(*keys, "start_tick", "end_tick").withColumn("new", new).withColumn("island", F.sum("new").over(w.rowsBetween(Window.unboundedPreceding, 0)))
    return island.groupBy(*keys, "island").agg(F.min("start_tick").alias("start_tick"), F.max("end_tick").alias("end_tick")).drop("island")


def _level(length):
    """Bins of 2**level ticks: an eighth to a quarter of the interval, so it lies in nine of them at most."""
    return F.greatest(F.floor(F.log2(length)) - 2, F.lit(0)).cast("int")


def starts_within(whole: DataFrame, starts: DataFrame, on: list[str], levels: list[int]) -> DataFrame:
    """Candidates for pairs whose `start` lies in [lo, hi): an equi-join on `on`, the level of the interval and the bin. Both sides' columns differ but for `on`.

    An interval is looked for in bins of its own size, whatever other sizes there are: candidates are half as many again as pairs at most, but for
    intervals of under four ticks. A start is looked up once for each level in use.
    """
    w = whole.withColumn("level", _level(F.col("hi") - F.col("lo")))
    bins = F.explode(F.sequence(F.expr("shiftright(lo, level)"), F.expr("shiftright(hi - 1, level)")))
    s = starts.withColumn("level", F.explode(F.array(*[F.lit(x) for x in levels]))).withColumn("bin", F.expr("shiftright(start, level)"))
    return w.withColumn("bin", bins).join(s, [*on, "level", "bin"]).drop("level", "bin")


def overlap_pairs(a: DataFrame, b: DataFrame, on: list[str]) -> DataFrame:
    """Each overlapping pair once: the columns of a, and those of b with b_start and b_end. Both are read several times: give stored tables.

    Of an overlapping pair one interval holds the start of the other; where both start together, that of a holds it.
    """
    a, b = (x.filter("end_tick > start_tick").withColumns({c: F.col(c).cast("bigint") for c in ("start_tick", "end_tick")}) for x in (a, b))
    b = b.withColumnsRenamed({"start_tick": "b_start", "end_tick": "b_end"})

    def arm(x, lo, hi, y, start, test):
        levels = sorted(r[0] for r in x.select(_level(F.col(hi) - F.col(lo))).distinct().collect())  # 63 at most
        both = starts_within(x.withColumns({"lo": F.col(lo), "hi": F.col(hi)}), y.withColumn("start", F.col(start)), on, levels or [0])
        return both.filter(test).drop("lo", "hi", "start")

    one = arm(a, "start_tick", "end_tick", b, "b_start", "start >= lo AND start < hi")
    return one.unionByName(arm(b, "b_start", "b_end", a, "start_tick", "start > lo AND start < hi"))


def overlap_ticks(a: DataFrame, b: DataFrame, on: list[str], keys: list[str]) -> DataFrame:
    """Ticks that intervals of a and b share, summed by the keys."""
    return overlap_pairs(a, b, on).groupBy(*keys).agg(F.sum(F.least("end_tick", "b_end") - F.greatest("start_tick", "b_start")).alias("ticks"))
