"""Record history: parse announcements, order them, fold state changes, attribute and dedupe."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ticklore.functions.scalars import SIGNED_TIME, TIME, audit_text, format_time, let, normalize_class, parse_time, serialize_candidates
from ticklore.operators.filters import class_matches, likely_record, likely_relay, likely_run, map_family, map_family_like
from ticklore.operators.playtime import top_n
from ticklore.operators.scan import SLICE_ROWS, sliced
from ticklore.sources.shared import stored

#: What messages of the server begin with.
PREFIX = "SRV | "
#: Characters of a cut name that are looked up at once; the rest of a longer one is compared.
STEM = 64
FIELDS = ("player", "class", "map", "record_type", "source", "record_time", "run_time", "split", "improvement", "inferred", "is_lookup")
SPLIT = rf" \((?:(WR|SR|PR)\s*)?({SIGNED_TIME})\)(?: \| ({TIME}) improvement!?)?!?$"
#: After the head of a message: time, label, split, improvement.
RUN = rf"map run ({TIME}){SPLIT}"
MARKS = r"\s+(?:~[^~]+~\s*)*"
#: Stands between the groups of a match; taken out of texts before.
CUT = "\x01"


def _entry(**v: Column) -> Column:
    kinds = {"inferred": "boolean", "is_lookup": "boolean"}
    return F.struct(*[v.get(f, F.lit(None)).cast(kinds.get(f, "string")).alias(f) for f in FIELDS])


def _form(text: Column, key: Column, pattern: str, make) -> Column:
    """Null unless the pattern matches and the entry is valid. make gets a function from group number to text (null if empty).

    key: a cheap test that all matches pass. The pattern then runs once: its groups come out of one replacement, split at a sign that texts do not hold.
    """
    n = re.compile(pattern).groups
    told = F.split(F.regexp_replace(text, "(?id)" + pattern, CUT + CUT.join(f"${i}" for i in range(1, n + 1)) + CUT), CUT, -1)

    def read(g):
        entry, valid = make(lambda i: F.nullif(F.get(g, F.lit(i)), F.lit("")))
        return F.when((F.size(g) == n + 2) & valid, entry)

    return F.when(key, let(told, read))


def _time(t: Column) -> Column:
    """A time that TIME matches, written as normalize_time() does; by fixed places, which costs the planner far less than its parts do."""
    p = F.lpad(t, 11, "0")
    two = lambda at: F.substring(p, at, 2).cast("bigint")
    return F.when(t.isNotNull(), format_time(((two(1) * 60 + two(-8)) * 60 + two(-5)) * 100 + two(-2)))


def _signed(t: Column) -> Column:
    return F.when(t.rlike("^[+-]"), F.concat(F.substring(t, 1, 1), _time(F.substring(t, 2, 20)))).otherwise(t)


def _tidy(e: Column) -> Column:
    """The entry with its times written out; null where its time is zero. One pass after the forms, so that they hold no times' arithmetic each."""
    times = {"record_time": _time, "run_time": _time, "split": _signed, "improvement": _time}
    return let(e, lambda x: F.when(x["record_time"].rlike("[1-9]"), F.struct(*[(times[f](x[f]) if f in times else x[f]).alias(f) for f in FIELDS])))


def head_of(prefix: str) -> str:
    return "^" + re.escape(prefix).replace("\\ ", " ") + r"\(([^)]+)\) (.*?) "


def parse_record(text: Column, map_: Column, prefix: str = PREFIX, only_map: str | None = None) -> Column:
    """The first of eleven message forms that fits; null if none does. only_map: forms that name a map must name one of that family."""
    head = head_of(prefix)
    yes, no, true = F.lit(True), F.lit(False), F.lit(True)
    family = (lambda m: map_family(m, only_map)) if only_map else (lambda m: true)
    base = lambda g: {"class": normalize_class(g(1)), "player": F.trim(F.coalesce(g(2), F.lit(""))), "map": map_, "record_type": F.lit("WR"), "inferred": no, "is_lookup": no}

    def plain(source, time_group, split=None, first=False):
        def make(g):
            more = {"split": g(split), "improvement": g(split + 1)} if split else {}
            return _entry(**base(g), source=F.concat(source(g), F.lit(" First" if first else "")), record_time=g(time_group), **more), true

        return make

    def compact(g):
        raw = F.trim(g(3))
        cut = r"(?i)^([^/]+)/(Bonus|Course)\s*#?(\d+)?$"
        part = raw.rlike(cut)
        name = F.when(part, F.regexp_extract(raw, cut, 1)).otherwise(raw)
        source = F.when(part, F.trim(F.concat_ws(" ", F.regexp_extract(raw, cut, 2), F.regexp_extract(raw, cut, 3)))).otherwise("Compact")
        e = _entry(**{"class": normalize_class(g(1)), "player": F.trim(g(5)), "map": name, "record_type": F.upper(g(2)), "source": source, "record_time": g(4), "inferred": no, "is_lookup": yes})
        return e, F.upper(g(2)).isin("WR", "SR") & family(name)

    def run(g):
        # A split below zero makes the run the record (implied_record()); with others the record is only implied.
        e = _entry(**base(g), source=F.lit("MapRun"), record_time=g(3), run_time=g(3), split=g(5), improvement=g(6))
        return e, F.coalesce(F.upper(g(4)).isin("WR", "SR") & g(5).startswith("-"), no)

    def ranked(g):
        source = F.when(g(6).isNotNull(), F.concat_ws(" ", g(6), g(7))).otherwise("Ranked")
        e = _entry(**(base(g) | {"map": g(5), "inferred": yes, "is_lookup": yes}), source=source, record_time=g(8))
        return e, (F.regexp_replace(g(3), "^0+", "") == "1") & family(g(5))

    fixed = lambda s: lambda g: F.lit(s)
    zone = lambda kind: lambda g: F.concat(F.lit(kind + " "), g(3))
    part = lambda g: F.concat(F.lit("C"), g(3), F.lit(" - "), F.trim(g(4)))
    t = f"({TIME})"
    # The wording of the server's messages.
    forms = [
        (" :: ", "^" + re.escape(prefix).replace("\\ ", " ") + rf"\(([^)]+?) (WR|SR|PR)\) (.+?) :: {t} :: (.+)$", compact),
        ("set the first map record", head + rf"set the first map record: {t}!?$", plain(fixed("FirstRecord"), 3)),
        ("beat the map record", head + rf"beat the map record: {t}{SPLIT}", plain(fixed("MapRecord"), 3, 5)),
        ("beat the map record", head + rf"beat the map record: {t}!?$", plain(fixed("MapRecord"), 3)),
        ("set bonus", head + rf"set Bonus\s*#?(\d+) {t}!?$", plain(zone("Bonus"), 4, first=True)),
        ("set course", head + rf"set Course\s*#?(\d+) {t}!?$", plain(zone("Course"), 4, first=True)),
        ("set", head + rf"set{MARKS}C(\d+)\s*-\s*(.+?) {t}!?$", plain(part, 5, first=True)),
        ("broke", head + rf"broke{MARKS}Bonus\s*#?(\d+) {t}{SPLIT}", plain(zone("Bonus"), 4, 6)),
        ("broke", head + rf"broke{MARKS}Course\s*#?(\d+) {t}{SPLIT}", plain(zone("Course"), 4, 6)),
        ("broke", head + rf"broke{MARKS}C(\d+)\s*-\s*(.+?) {t}{SPLIT}", plain(part, 5, 7)),
        ("map run", head + RUN, run),
        ("is ranked", head + rf"is ranked (\d+)/(\d+) on ([^ ]+)(?:\s+(Bonus|Course)\s+(\d+))? with time: {t}!?$", ranked),
    ]
    clean, low = F.translate(text, CUT, " "), F.lower(text)
    return _tidy(F.coalesce(*[_form(clean, low.contains(key), p, make) for key, p, make in forms]))


def parse_run(text: Column, map_: Column, prefix: str = PREFIX) -> Column:
    """A map run of any label and split: struct(player, class, map, label, run_time, split, improvement); null for other lines."""
    n = re.compile(head_of(prefix) + RUN).groups
    told = F.split(F.regexp_replace(F.translate(text, CUT, " "), "(?id)" + head_of(prefix) + RUN, CUT + CUT.join(f"${i}" for i in range(1, n + 1)) + CUT), CUT, -1)
    g = lambda x, i: F.nullif(F.get(x, F.lit(i)), F.lit(""))
    entry = lambda x: F.struct(
        F.trim(F.coalesce(g(x, 2), F.lit(""))).alias("player"), normalize_class(g(x, 1)).alias("class"), map_.alias("map"), F.upper(g(x, 4)).alias("label"),
        _time(g(x, 3)).alias("run_time"), _signed(g(x, 5)).alias("split"), _time(g(x, 6)).alias("improvement"),
    )
    return F.when(likely_run(text, prefix), let(told, lambda x: F.when(F.size(x) == n + 2, entry(x))))


def parse_relay(text: Column, only_map: str | None = None) -> Column:
    """Relayed announcements: the last line of the text."""
    line = F.element_at(F.split(text, "\n"), -1)

    def make(source, split):
        def entry(g):
            more = {"split": g(6)} if split else {}
            e = _entry(**{"class": normalize_class(g(1)), "player": F.trim(g(2)), "map": g(3), "record_type": F.lit("WR"), "source": F.lit(source), "record_time": g(4), "inferred": F.lit(False), "is_lookup": F.lit(False)}, **more)
            return e, map_family(g(3), only_map) if only_map else F.lit(True)

        return entry

    head = r"^:: \(([^)]+)\) (.+?) "
    broke, put = head + rf"broke ([^ ]+) WR: ({TIME}) \((?:(WR|SR|PR)\s*)?({SIGNED_TIME})\)!?$", head + rf"set ([^ ]+) WR: ({TIME})!?$"
    clean, key = F.translate(line, CUT, " "), F.lower(line).contains(" wr: ")
    return _tidy(F.coalesce(_form(clean, key, broke, make("IRC", True)), _form(clean, key, put, make("IRCSet", False))))


def parsed(e: Column) -> Column:
    """One row for a line that parses, none for others. As a generator, so that the long expression stands in the plan once."""
    return F.explode(F.array_compact(F.array(e)))


def beginnings(names: DataFrame) -> DataFrame:
    """names (session_id, full, and others) with a row for each beginning of a name, of up to STEM characters."""
    return names.withColumn("begin", F.explode(F.transform(F.sequence(F.lit(1), F.least(F.length("full"), F.lit(STEM))), lambda n: F.substring(F.col("full"), F.lit(1), n))))


def resolve_identity(df: DataFrame, users: DataFrame) -> DataFrame:
    """Adds id64, clean_id, candidates: by the line's user, else by exact name, else by the beginning of a name cut to `abc...`.

    One identity resolves; several become candidates. df: session_id, from_user_id, player, and key columns.
    """
    who = F.struct(F.col("name"), F.col("id64").cast("string").alias("id64"), F.coalesce("clean_id", "raw_id").alias("clean_id"))
    direct = users.select("session_id", F.col("user_id").alias("from_user_id"), F.col("id64").cast("string").alias("d64"), F.coalesce("clean_id", "raw_id").alias("did"))
    named = users.filter("trim(name) <> ''").select("session_id", F.lower(F.trim("name")).alias("low"), who.alias("who")).groupBy("session_id", "low").agg(F.sort_array(F.collect_set("who")).alias("same"))
    rows = df.withColumn("low", F.lower(F.trim("player"))).join(direct, ["session_id", "from_user_id"], "left").join(named, ["session_id", "low"], "left")
    # A cut name's stem is looked up among the beginnings of the names of its session: an equi-join on session and beginning.
    stem = F.trim(F.expr("substring(low, 1, length(low) - 3)"))
    rows = rows.withColumn("stem", F.when(F.col("same").isNull() & F.col("low").endswith("...") & (stem != ""), stem))
    cut = rows.filter("stem IS NOT NULL").select("session_id", "stem", F.substring("stem", 1, STEM).alias("begin")).distinct()
    full = named.join(cut.select("session_id").distinct(), "session_id", "left_semi").select("session_id", F.col("low").alias("full"), F.col("same").alias("some"))
    begun = cut.join(beginnings(full), ["session_id", "begin"]).filter("startswith(full, stem)").groupBy("session_id", "stem").agg(F.array_sort(F.array_distinct(F.flatten(F.collect_list("some")))).alias("begun"))
    rows = rows.join(begun, ["session_id", "stem"], "left").withColumn("found", F.coalesce("same", "begun"))
    known = F.col("d64").isNotNull() | F.col("did").isNotNull()
    # Identities, not names, tell whether it is one.
    ids = F.array_distinct(F.transform("found", lambda x: F.coalesce(x["id64"], x["clean_id"])))
    one = F.when(F.size(ids) == 1, F.get("found", F.lit(0)))
    return rows.withColumns({"id64": F.when(known, F.col("d64")).otherwise(one["id64"]), "clean_id": F.when(known, F.col("did")).otherwise(one["clean_id"]), "candidates": F.when(~known & (F.size(ids) > 1), serialize_candidates(F.col("found")))}).drop("stem", "low", "d64", "did", "same", "begun", "found")


def extract_records(chats: DataFrame, sessions: DataFrame, index: DataFrame, users: DataFrame, prefix: str = PREFIX, only_map: str | None = None) -> DataFrame:
    """Cheap prefilter, then the patterns, then dates and identities. With only_map: the server's lines of sessions on that family, and relayed ones that name it."""
    s = sessions.select("session_id", F.col("map").alias("session_map"))
    lines = chats.filter(likely_record(F.col("text"), prefix) | likely_relay(F.col("text"), prefix)).join(s, "session_id", "left")
    if only_map:
        lines = lines.filter(map_family_like(F.col("session_map"), only_map) | likely_relay(F.col("text"), prefix))
    e = F.coalesce(F.when(likely_record(F.col("text"), prefix), parse_record(F.col("text"), F.col("session_map"), prefix, only_map)), F.when(likely_relay(F.col("text"), prefix), parse_relay(F.col("text"), only_map)))
    # The candidates' table: the long expression is planned and run once, and what follows starts from its rows.
    told = stored(lines.select("session_id", F.col("index").alias("chat_index"), F.col("tick").alias("chat_tick"), "from_user_id", "text", parsed(e).alias("e")), "candidates").select("*", "e.*").drop("e")
    dated = told.join(index.select(F.col("id").alias("session_id"), "date"), "session_id", "left")
    return resolve_identity(dated, users)


def segment(source: Column) -> Column:
    zone = source.rlike(r"(?i)^(Bonus|Course|C\d)")
    return F.when(~zone | source.isNull(), "Map").otherwise(F.regexp_replace(source, "(?i) First$", ""))


def evidence(source: Column, is_lookup: Column, inferred: Column, run_time: Column) -> Column:
    observed = ((F.lower(source) == "maprun") & inferred) | (F.lower(source) == "observedwr")
    return F.when(observed, "observed").when(is_lookup, "command").when(F.lower(source).startswith("irc"), "announcement").otherwise("record")


def evidence_source(source: Column, is_lookup: Column, inferred: Column) -> Column:
    s = F.lower(source)
    named = F.when(s == "observedwr", "wr_split").when(is_lookup, F.when(inferred, "rank_command").otherwise("wr_command"))
    named = named.when(s == "ircset", "irc_set").when(s.startswith("irc"), "irc").when(s == "maprecord", "map_record").when(s == "firstrecord", "first_record").when(s == "maprun", "map_run")
    return named.when(segment(source) != "Map", F.when(s.endswith(" first"), "zone_first").otherwise("zone_record")).otherwise("unknown")


def priority(source: Column, inferred: Column) -> Column:
    s = F.lower(source)
    return F.when(inferred, 100).when(s == "maprecord", 1).when(s == "firstrecord", 2).when(s == "compact", 3).when(s.startswith("irc"), 4).when(s == "maprun", 5).when(s == "ranked", 6).otherwise(50)


def marked(records: DataFrame) -> DataFrame:
    """Adds seg, kind, how, cs and the timeline's order; rows without a date or a time drop."""
    r = records.withColumns({"seg": segment(F.col("source")), "kind": evidence(F.col("source"), F.col("is_lookup"), F.col("inferred"), F.col("run_time")), "how": evidence_source(F.col("source"), F.col("is_lookup"), F.col("inferred")), "cs": parse_time(F.col("record_time"))})
    order = F.struct("date", F.col("session_id").isNull().alias("none"), "session_id", "chat_index", priority(F.col("source"), F.col("inferred")).alias("p"), "cs", "player")
    return r.filter("date IS NOT NULL AND cs IS NOT NULL").withColumn("ord", order)


def of_history(records: DataFrame) -> DataFrame:
    """What a history or an audit takes in: records of the type WR by soldiers and demomen. Class names count as they are spelt."""
    return records.filter((F.upper("record_type") == "WR") & F.col("class").isin("Solly", "Demo"))


def suppress_duplicates(m: DataFrame, group_cols: list[str]) -> DataFrame:
    """What is not a record goes where a record of the same segment has the same time."""
    keys = [*group_cols, "low", "cs"]
    m = m.withColumn("low", F.lower("seg"))
    sure = m.filter("kind = 'record'").select(*[F.col(c).alias(f"s_{c}") for c in keys]).distinct()
    same = [F.col(c).eqNullSafe(F.col(f"s_{c}")) for c in keys]
    rest = m.filter("kind <> 'record'").join(sure, same, "left_anti")
    return m.filter("kind = 'record'").unionByName(rest).drop("low")


def _better(r: Column, cur: Column) -> Column:
    """A better time: by over a hundredth where it is only inferred."""
    return cur.isNull() | (r["cs"] < cur - F.when(r["inferred"], 1).otherwise(0))


def _starts(rows: Column) -> Column:
    """What rows without an anchor make of any time before them: (below, cur), below falling. The first entry whose `below` is less than that time tells the time after; of none, it stays."""
    kind = "array<struct<below:int,cur:int>>"

    def step(acc, r):
        on = F.transform(acc, lambda s: F.struct(s["below"].alias("below"), F.when(_better(r, s["cur"]), r["cs"]).otherwise(s["cur"]).alias("cur")))
        below = r["cs"] + F.when(r["inferred"], 1).otherwise(0)
        new = F.struct(below.cast("int").alias("below"), r["cs"].cast("int").alias("cur"))
        return F.when((F.size(acc) == 0) | (below < F.element_at(acc, -1)["below"]), F.concat(on, F.array(new))).otherwise(on).cast(kind)

    return F.aggregate(rows, F.array().cast(kind), step)


def _carried(s: Column) -> Column:
    """Of a segment's slices in order (slice, end, starts): the time that each of them begins with."""
    after = lambda cur, x: F.coalesce(x["end"], F.when(cur.isNull(), F.get(x["starts"], F.lit(0))["cur"]).otherwise(F.coalesce(F.get(F.filter(x["starts"], lambda y: y["below"] < cur), F.lit(0))["cur"], cur)))
    start = F.struct(F.lit(None).cast("int").alias("cur"), F.array().cast("array<struct<slice:int,carry:int>>").alias("out"))
    return F.aggregate(s, start, lambda a, x: F.struct(after(a["cur"], x).alias("cur"), F.concat(a["out"], F.array(F.struct(x["slice"].alias("slice"), a["cur"].alias("carry")))).alias("out")))["out"]


def fold_changes(m: DataFrame, group_cols: list[str], include_all: bool = False, slice_rows: int = SLICE_ROWS) -> DataFrame:
    """State changes of each segment in order: better times (by over 1 where inferred), and wipes by records.

    Rows that may wipe are anchors: after one, the current time is its own. A segment is dealt into slices of bounded size, and a slice folds
    in groups that begin with an anchor. What stands before its first anchor depends on the slices before: a first pass tells of each
    slice the time it ends with, or, without an anchor, what it makes of any time; those lines, chained in order, give each slice the time it begins with.
    """
    keys = [*group_cols, "low"]
    wipes = ~F.col("inferred") & (F.lit(include_all) | (F.col("kind") == "record") | (F.col("how") == "irc_set"))
    m = sliced(m.withColumns({"low": F.lower("seg"), "anchor": wipes}), keys, ["ord"], slice_rows)
    part = [*keys, "slice"]
    w = Window.partitionBy(*part).orderBy("ord")
    told = m.select(*part, "ord", "cs", "inferred", "anchor", F.sum(F.col("anchor").cast("int")).over(w.rowsBetween(Window.unboundedPreceding, 0)).alias("g"))
    g = told.groupBy(*part, "g").agg(F.array_sort(F.collect_list(F.struct("ord", "cs", "inferred", "anchor"))).alias("rows"))
    kept_kind = "array<" + m.schema["ord"].dataType.simpleString() + ">"

    def fold(rows, cur):
        def take(acc, r):
            ok = _better(r, acc["cur"]) | r["anchor"]
            return F.struct(F.when(ok, r["cs"]).otherwise(acc["cur"]).alias("cur"), F.when(ok, F.concat(acc["kept"], F.array(r["ord"]))).otherwise(acc["kept"]).alias("kept"))

        return F.aggregate(rows, F.struct(cur.cast("int").alias("cur"), F.array().cast(kept_kind).alias("kept")), take)

    end = g.groupBy(*part).agg(F.max_by("rows", "g").alias("rows"), F.max("g").alias("g"))
    end = end.select(*part, F.when(F.col("g") > 0, fold(F.col("rows"), F.lit(None))["cur"]).alias("end"), F.when(F.col("g") == 0, _starts(F.col("rows"))).alias("starts"))
    lines = end.groupBy(*keys).agg(F.array_sort(F.collect_list(F.struct("slice", "end", "starts"))).alias("s"))
    carry = lines.select(*keys, F.explode(_carried(F.col("s"))).alias("c")).select(*keys, "c.*")
    folded = g.join(carry, part).withColumn("f", fold(F.col("rows"), F.when(F.col("g") == 0, F.col("carry"))))
    folded = folded.withColumn("last", F.coalesce(F.lag("f.cur").over(Window.partitionBy(*part).orderBy("g")), "carry"))
    first = F.get("rows", F.lit(0))
    # An anchor that repeats the time before it is no change, and stays out.
    same = first["anchor"] & F.col("last").isNotNull() & (first["cs"] == F.col("last")) & F.lit(not include_all)
    kept = folded.select(*part, F.explode(F.when(same, F.slice("f.kept", 2, F.greatest(F.size("f.kept") - 1, F.lit(0)))).otherwise(F.col("f.kept"))).alias("ord"))
    return m.join(kept, [*part, "ord"], "left_semi").drop("low", "anchor", "slice")


def attribute_observed(kept: DataFrame, all_rows: DataFrame, extra: list[str] | None = None) -> DataFrame:
    """Observed rows take their holder from the best other row of the same map, class, segment and time (and the extra columns)."""
    keys = [*(extra or []), "map", "class", "seg", "cs"]
    rank = F.when(~F.col("is_lookup") & ~F.col("inferred"), 0).when(~F.col("is_lookup"), 1).when(~F.col("inferred"), 2).otherwise(3)
    named = all_rows.filter("kind <> 'observed' AND trim(player) <> ''")
    best = named.groupBy(*keys).agg(F.min_by(F.struct("player", "id64", "clean_id", "candidates"), F.struct(rank.alias("r"), F.coalesce("id64", "clean_id").isNull().alias("n"), F.col("session_id").isNull().alias("s"), "session_id", "chat_index")).alias("h"))
    o = F.col("kind") == "observed"
    both = kept.join(best, keys, "left")
    put = {"player": F.when(o, F.coalesce("h.player", F.lit("unknown"))).otherwise(F.col("player")), "source": F.when(o, "ObservedWR").otherwise(F.col("source"))}
    put |= {c: F.when(o, F.col(f"h.{c}")).otherwise(F.col(c)) for c in ("id64", "clean_id", "candidates")}
    put |= {c: F.when(~o, F.col(c)) for c in ("session_id", "run_time", "split", "improvement", "chat_tick")}
    return both.withColumns(put).withColumn("how", F.when(o, "wr_split").otherwise(F.col("how"))).drop("h")


def dedupe_days(h: DataFrame, extra: list[str] | None = None) -> DataFrame:
    """One row for each map, class, type, segment, day and time (and the extra columns): the best one, at the earliest one's place."""
    keys = [*(extra or []), "map", "class", "record_type", "seg", F.floor(F.col("date") / 86400).alias("on"), "cs"]
    rank = F.when(F.col("kind") == "record", 0).when(F.col("kind") == "announcement", 1).when(F.col("kind") == "command", 2).otherwise(3)
    quality = [rank, F.lower("player") == "unknown", F.coalesce("id64", "clean_id").isNull(), F.col("candidates").isNull(), F.col("session_id").isNull(), F.col("session_id"), F.col("chat_index")]
    rest = [c for c in h.columns if c != "ord"]
    best = h.groupBy(*keys).agg(F.min("ord").alias("first"), F.min_by(F.struct(*rest), F.struct(*[c.alias(f"q{i}") for i, c in enumerate(quality)])).alias("best"))
    return best.select("best.*", F.col("first").alias("ord")).select(h.columns)


def record_history(records: DataFrame, group_cols: list[str] | None = None, include_all: bool = False, any_kind: bool = False) -> DataFrame:
    """Of records of the history (of_history()), or with any_kind of all. group_cols: what is folded as one; ["class"] takes all maps of one extraction together."""
    group_cols = group_cols if group_cols is not None else ["map", "class"]
    m = stored(marked(records if any_kind else of_history(records)), "marked")  # read four times from here on
    kept = fold_changes(suppress_duplicates(m, group_cols), group_cols, include_all)
    extra = [c for c in group_cols if c not in ("map", "class")]
    return dedupe_days(attribute_observed(kept, m, extra), extra)


def export_history(h: DataFrame) -> DataFrame:
    """The fifteen columns of the export; the session only where the row is a record."""
    return h.select(F.from_unixtime(F.col("date").cast("bigint"), "yyyy-MM-dd").alias("date"), "map", "class", F.col("seg").alias("segment"), "record_type", F.col("kind").alias("evidence"), F.col("how").alias("evidence_source"), "record_time", "run_time", "split", "improvement", "player", F.coalesce("id64", "clean_id").alias("player_id"), "candidates", F.when(F.col("kind") == "record", F.col("session_id")).alias("session_id"))


def faster_than_record(records: DataFrame, group_cols: list[str] | None = None) -> DataFrame:
    """Audit: rows that are no records and faster than the best record of their segment."""
    keys = [*(group_cols or ["map", "class"]), "low"]
    m = marked(of_history(records)).withColumn("low", F.lower("seg"))
    best = m.filter("kind = 'record'").groupBy(*keys).agg(F.min("cs").alias("best"))  # a line for each segment
    return m.filter("kind <> 'record'").join(best, keys).filter("cs < best").drop("low")


def audit_records(records: DataFrame) -> DataFrame:
    return faster_than_record(records).withColumn("line", audit_text(F.col("text"))).select("session_id", "chat_index", "map", "class", "seg", "kind", "cs", "best", "line")


def map_runs(chats: DataFrame, sessions: DataFrame, index: DataFrame, users: DataFrame, player: str | None = None, only_map: str | None = None, class_: str | None = None, include_record: bool = False, prefix: str = PREFIX) -> DataFrame:
    """Runs labelled PR (with include_record: WR too) of a player, or of all whose identity is known, in order of date and session."""
    s = sessions.select("session_id", "map")
    s = s.filter(map_family_like(F.col("map"), only_map)) if only_map else s
    told = chats.filter(likely_run(F.col("text"), prefix)).select("session_id", F.col("index").alias("chat_index"), "from_user_id", "text").join(s, "session_id")
    runs = told.select("session_id", "chat_index", "from_user_id", parsed(parse_run(F.col("text"), F.col("map"), prefix)).alias("e")).select("*", "e.*").drop("e")
    runs = runs.filter(F.col("label").isin(["PR", "WR"] if include_record else ["PR"]))
    runs = runs.filter(class_matches(F.col("class"), class_)) if class_ else runs
    known = resolve_identity(runs.join(index.select(F.col("id").alias("session_id"), "date"), "session_id", "left"), users).filter("id64 IS NOT NULL OR trim(clean_id) <> ''")
    if player:
        by_id = F.lower("clean_id") == player.lower()
        known = known.filter(F.when(F.col("id64").isNotNull(), F.col("id64") == player).otherwise(by_id) if player.isdigit() else by_id)
    return known.select("date", "session_id", "chat_index", "map", "class", "label", "run_time", "split", "improvement", F.coalesce("id64", "clean_id").alias("player_id")).orderBy("date", "session_id", "chat_index")


def player_records(records: DataFrame, users: DataFrame) -> DataFrame:
    """Records by those who hold them: adds player_key where the record's name is one of the player's names in that session, or its beginning.

    users: session_id, player_key, name.
    """
    names = users.filter("trim(name) <> ''").select("session_id", "player_key", F.lower("name").alias("full")).distinct()
    asked = records.select("session_id", "player").distinct()
    whole = asked.withColumn("full", F.lower("player")).join(names, ["session_id", "full"]).select("session_id", "player", "player_key")
    # Of a cut name the beginning is looked up among the beginnings of the session's names: no row meets all of them.
    cut = asked.filter(F.col("player").endswith("...") & (F.length("player") > 3)).withColumn("stem", F.lower(F.expr("substring(player, 1, length(player) - 3)"))).withColumn("begin", F.substring("stem", 1, STEM))
    begun = cut.join(beginnings(names.join(cut.select("session_id").distinct(), "session_id", "left_semi")), ["session_id", "begin"]).filter("startswith(full, stem)").select("session_id", "player", "player_key")
    held = whole.unionByName(begun).distinct()
    return records.join(held, ["session_id", "player"]).select(*records.columns, "player_key")


def include_counts(records: DataFrame, keys: list[str] | None = None) -> DataFrame:
    """How many rows include() leaves out for each reason, and how many stay with both."""
    return records.groupBy(*(keys or [])).agg(F.count("*").alias("n"), F.count_if("inferred").alias("n_inferred"), F.count_if("is_lookup").alias("n_lookup"), F.count_if(~F.col("inferred") & ~F.col("is_lookup")).alias("n_plain"))


def include(records: DataFrame, inferred: bool = True, lookups: bool = True) -> DataFrame:
    return records.filter((F.lit(inferred) | ~F.col("inferred")) & (F.lit(lookups) | ~F.col("is_lookup")))


def latest_records(h: DataFrame, n: int) -> DataFrame:
    return top_n(h, ["map", "class", "seg"], [F.desc("ord")], n)
