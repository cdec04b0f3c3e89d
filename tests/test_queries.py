"""Each query against its SQL, at sf0.001."""

import os

import duckdb
import pandas as pd
import pytest

from ticklore.plans.queries import ORACLES, QUERIES

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables")
QUICK = [
    "alive_intervals", "map_playtime", "spectator_peers", "speaker_resolution", "chat_counts", "bigram_counts", "chat_neighbours", "ingest_index", "landed_spawns", "landed_users", "landed_chats", "record_pages", "zones",
    "quarantined_index", "incremental_landing", "landed_flags", "csv_round_trip", "history_files", "chat_log", "map_runs", "identities", "held_names", "scalar_values", "map_families", "other_mentions", "message_sentiment", "sentiment_rules",
    "superlatives", "friends_with_time", "player_records", "observed_holders", "year_review_words", "year_review_sheet",
    "one_map_history", "record_history", "redelivered_spawns", "relanded_spawns", "located_chat", "year_review_records", "year_review_extremes", "year_review_friends", "url_chat", "year_review_chat", "year_review_lines", "year_review_long", "year_review_long_play",
]


def norm(df):
    one = lambda x: "~" if pd.isna(x) else f"{float(x):.6f}" if isinstance(x, (int, float)) and not isinstance(x, bool) else str(x)
    return sorted(tuple(one(x) for x in r) for r in df[sorted(df.columns)].astype(object).values.tolist())


@pytest.mark.parametrize("name", QUICK)
def test_oracle(spark, name):
    con = duckdb.connect()
    for t in os.listdir(SF):
        con.execute(f"CREATE VIEW {t.split('.')[0]} AS SELECT * FROM '{SF}/{t}'")
    got, want = QUERIES[name](spark, SF).toPandas(), con.execute(ORACLES[name]).fetch_df()
    assert sorted(got.columns) == sorted(want.columns) and norm(got) == norm(want)
