"""Records meet the names of their session by joins, not every name in turn."""

from pyspark.sql import functions as F

from ticklore.operators import filters
from ticklore.operators.records import player_records

USERS = [(1, "a", "Ferro"), (1, "a", "ferro two"), (1, "b", "FERRO"), (1, "b", " "), (2, "a", "Ferro"), (1, "c", "x..."), (1, None, "Ferro"), (1, "d", "L" * 70 + "x"), (1, "d", None), (None, "e", "Ferro")]
ASKED = ["ferro", "FER...", "ferro t...", "...", "x...", "L" * 66 + "...", "L" * 69 + "y...", "nobody", "", None]


def test_same_as_every_name_in_turn(spark):
    users = spark.createDataFrame(USERS, "session_id long, player_key string, name string")
    records = spark.createDataFrame([(i, s, p) for i, (s, p) in enumerate((s, p) for s in (1, 2, 3, None) for p in ASKED)], "n int, session_id long, player string")
    names = users.filter("trim(name) <> ''").groupBy("session_id", "player_key").agg(F.collect_set("name").alias("names"))
    want = records.join(names, "session_id").filter(filters.name_matches(F.col("player"), F.col("names"))).select("n", "player_key")
    got = player_records(records, users)
    assert got.columns == ["n", "session_id", "player", "player_key"]
    pairs = lambda df: sorted((r.n, r.player_key or "") for r in df.collect())
    assert pairs(got) == pairs(want) != []


def test_work_grows_with_the_names_not_their_square(spark):
    """Of 30,000 names and as many records of one session no row meets all names: nothing is gathered into an array."""
    users = spark.range(30000).selectExpr("1L AS session_id", "concat('p', id % 5) AS player_key", "concat('user_', id) AS name")
    got = player_records(users.selectExpr("session_id", "name AS player"), users)
    assert "collect_set" not in got._jdf.queryExecution().optimizedPlan().toString()
    assert got.count() == 30000
