"""An inferred row of the same day and time, of a lower session, does not push out one that is not inferred."""

import datetime

import duckdb

from ticklore.plans.queries import ORACLES, QUERIES


def test_inferred_rows_displace_none(spark, tmp_path):
    at = datetime.datetime(2024, 1, 3, 5)
    rows = [(10, at, 0, "click", 9.85, "{}"), (11, at, 10, "click", 9.85, "{}"), (22, at, 0, "click", 7.5, "{}")]
    spark.createDataFrame(rows, "event_id long, ts timestamp_ntz, user_id long, event_type string, value double, properties string").coalesce(1).write.parquet(str(tmp_path / "events.parquet"))
    con = duckdb.connect()
    con.execute(f"CREATE VIEW events AS SELECT * FROM '{tmp_path}/events.parquet/*.parquet'")
    want = con.execute(ORACLES["every_record"]).fetchall()
    assert want == [(11, 986)]
    assert [tuple(r) for r in QUERIES["every_record"](spark, str(tmp_path)).collect()] == want
