"""The archive-shaped tables that the queries start from, and the steps that several of them share."""

from __future__ import annotations

from ticklore.operators import intervals, playtime, records
from ticklore.sources import adapters as ad
from ticklore.sources.shared import stored


def chat_tables(spark, d):
    c = ad.table(spark, d, "conversations")
    return ad.chat_lines(c), ad.chat_users(c), ad.chat_sessions(c), ad.chat_index(c)


def event_tables(spark, d):
    return ad.EventTables(ad.table(spark, d, "events"))


def alive_of(t):
    e = intervals.player_events(t.spawns, t.deaths, t.changes)
    return intervals.alive_intervals(e, intervals.session_ends(t.sessions, e, ["user_id"]))


def watching_of(t):
    own = t.spawns.select("session_id", "user_id", "tick").unionByName(t.changes.select("session_id", "user_id", "tick"))
    return intervals.spectator_intervals(t.changes, t.spawns, intervals.session_ends(t.sessions, own, ["user_id"]))


def per_session_of(t):
    return playtime.session_playtime(alive_of(t), t.users.join(t.sessions.select("session_id", "interval_per_tick"), "session_id"))


def records_plan(t):
    return records.extract_records(t.record_chat(), t.sessions, t.index(), t.named_users())


def records_of(t):
    """The records as a table of their own: lines are parsed once, whatever reads them."""
    return stored(records_plan(t), "records")
