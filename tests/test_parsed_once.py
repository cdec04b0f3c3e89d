"""A document is parsed once for each table that is made of it, not again for each test and field."""

import pytest

from ticklore.sources.ingest import land_sessions

GOOD = '{"header": {"map": "m"}, "users": {"1": {"name": "a", "userId": 1, "entityId": 4}}, "chat": [{"text": "hi", "client": 4}], "spawns": [{"user": 1, "tick": 5}]}'


@pytest.mark.parametrize("name,times", [("sessions", 1), ("spawns", 1), ("users", 1), ("chats", 2), ("quarantine", 1)])
def test_parsed_once(spark, name, times):
    rows = [(1, GOOD), (2, GOOD[:30]), (3, None), (4, '{"users": {}}')]
    made = land_sessions(spark.createDataFrame(rows, "session_id long, body string"))[name]
    assert made._jdf.queryExecution().optimizedPlan().toString().count("from_json(") == times
    assert sorted(r.session_id for r in made.collect()) == ([2, 3, 4] if name == "quarantine" else [1])
