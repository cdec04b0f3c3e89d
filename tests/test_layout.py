"""Tables bucketed by session: joins on the session, and on its users, shuffle neither side."""

from pyspark.sql import functions as F

from ticklore.operators import joins
from ticklore.sources.layout import join_in_place, located


def test_joins_in_place(spark):
    chats = spark.range(2000).select((F.col("id") % 50).alias("session_id"), F.col("id").cast("int").alias("index"), (F.col("id") % 7).cast("int").alias("from_user_id"), F.concat(F.lit("a : "), "id").alias("text"))
    users = spark.range(350).select((F.col("id") % 50).alias("session_id"), F.floor(F.col("id") / 50).cast("int").alias("user_id"), F.lit("n").alias("name"), F.lit("r").alias("raw_id"), F.lit(None).cast("string").alias("clean_id"), F.col("id").alias("id64"), F.lit(False).alias("is_bot"), F.lit(1).alias("entity_id"))
    sessions = spark.range(50).select(F.col("id").alias("session_id"), F.lit("m").alias("map"), F.lit("s").alias("server"))
    t = located({"chats": chats, "users": users, "sessions": sessions}, 4, {"chats": ["index"]})
    held = {c: spark.conf.get(c) for c in ("spark.sql.requireAllClusterKeysForCoPartition", "spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.enabled")}
    try:
        join_in_place(spark)
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        spark.conf.set("spark.sql.adaptive.enabled", "false")
        both = joins.chats_with_users(t["chats"], t["users"]).join(t["sessions"], "session_id")
        assert "Exchange" not in both._jdf.queryExecution().executedPlan().toString()
        got = both.count()
    finally:
        for c, v in held.items():
            spark.conf.set(c, v)
    assert got == joins.chats_with_users(chats, users).count() == 2000
