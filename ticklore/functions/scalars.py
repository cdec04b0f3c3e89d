"""Column expressions: race times, player ids, chat lines, calendar keys."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: 64-bit ids of players start here (public id format).
ID_BASE = 76561197960265728
TIME = r"\d{1,2}:\d{2}(?::\d{2})?\.\d{2}"
SIGNED_TIME = r"[+-]?" + TIME


def let(c: Column, f) -> Column:
    """f(c) with c evaluated, and written in the plan, once."""
    return F.get(F.transform(F.array(c), f), F.lit(0))


def try_int(c: Column, kind: str = "bigint") -> Column:
    """Whole numbers only; else null."""
    return F.when(c.rlike(r"^\d+$"), c.try_cast(kind))


def parse_time(c: Column) -> Column:
    """mm:ss.cc or h:mm:ss.cc as centiseconds, else null."""

    def of(parts):
        n = F.size(parts)
        h = F.when(n == 3, try_int(F.get(parts, F.lit(0)))).otherwise(F.lit(0).cast("bigint"))
        m = F.when(n == 3, try_int(F.get(parts, F.lit(1)))).otherwise(try_int(F.get(parts, F.lit(0))))

        def tail(last):
            s, cc = try_int(F.get(last, F.lit(0))), try_int(F.get(last, F.lit(1)))
            return F.when(n.isin(2, 3) & (F.size(last) == 2) & (cc <= 99), ((h * 60 + m) * 60 + s) * 100 + cc).cast("int")

        return let(F.split(F.element_at(parts, -1), r"\."), tail)

    return let(F.split(F.trim(c), ":"), of)


def parse_signed_time(c: Column) -> Column:
    """struct(cs, sign); null without a sign."""

    def of(t):
        sign = F.when(t.startswith("-"), -1).when(t.startswith("+"), 1)
        return let(parse_time(F.substring(t, 2, 1 << 30)), lambda cs: F.when(sign.isNotNull() & cs.isNotNull(), F.struct(cs.alias("cs"), sign.alias("sign"))))

    return let(F.trim(c), of)


def format_time(cs: Column) -> Column:
    """mm:ss.cc, hours only if there are any; below zero as zero."""

    def of(c):
        h, m, s, cc = F.floor(c / 360000), F.floor(c / 6000) % 60, F.floor(c / 100) % 60, c % 100
        return F.when(h > 0, F.format_string("%d:%02d:%02d.%02d", h, m, s, cc)).when(c.isNotNull(), F.format_string("%02d:%02d.%02d", m, s, cc))

    return let(F.when(cs < 0, F.lit(0).cast("bigint")).otherwise(cs.cast("bigint")), of)


def normalize_time(c: Column) -> Column:
    return let(c, lambda x: F.coalesce(format_time(parse_time(x)), x))


def normalize_signed_time(c: Column) -> Column:
    one = lambda x: let(parse_signed_time(x), lambda p: F.coalesce(F.concat(F.when(p["sign"] < 0, "-").otherwise("+"), format_time(p["cs"])), x))
    return let(c, one)


def implied_record(run: Column, split: Column) -> Column:
    """struct(cs, inferred) from a run and its split to the record: a split below zero makes the run the record."""
    of = lambda r, s: F.when(s["sign"] < 0, F.struct(r.alias("cs"), F.lit(False).alias("inferred"))).when((s["sign"] > 0) & (r > s["cs"]), F.struct((r - s["cs"]).alias("cs"), F.lit(True).alias("inferred")))
    return let(parse_time(run), lambda r: let(parse_signed_time(split), lambda s: of(r, s)))


def normalize_class(c: Column) -> Column:
    t = F.trim(c)
    return F.when(F.lower(t).isin("soldier", "solly"), "Solly").when(F.lower(t) == "demoman", "Demo").otherwise(t)


def normalize_player_id(c: Column) -> Column:
    """struct(clean, id64, kind, is_bot) of a raw player id."""
    clean = F.split(c, "\x00")[0]
    y, z = (F.regexp_extract(clean, r"(?i)^STEAM_\d+:(\d+):(\d+)$", g).try_cast("bigint") for g in (1, 2))
    u = F.regexp_extract(clean, r"^\[U:.*:(\d+)\]$", 1).try_cast("bigint")
    id64 = F.coalesce(F.lit(ID_BASE) + 2 * z + y, F.lit(ID_BASE) + u)
    kind = F.when(F.upper(clean) == "BOT", "bot").when(z.isNotNull(), "steam2").when(u.isNotNull(), "steam3").otherwise("unknown")
    return F.struct(clean.alias("clean"), id64.alias("id64"), kind.alias("kind"), (kind == "bot").alias("is_bot"))


def message_body(c: Column) -> Column:
    at = F.instr(c, " : ")
    return F.when(at > 0, F.substring(c, at + 3, F.lit(1 << 30))).otherwise(c)


def speaker_name(c: Column) -> Column:
    """Who speaks in `*DEAD* [tag] Name : text`; null without a name."""
    at = F.instr(c, " : ")
    head = F.trim(F.regexp_replace(F.substring(c, F.lit(1), at - 1), r"\*[A-Za-z]+\*", ""))
    name = F.trim(F.replace(F.element_at(F.split(head, r"\]"), -1), F.lit("*"), F.lit("")))
    return F.when((at > 1) & (name != ""), name)


def epoch_timestamp(seconds: Column) -> Column:
    return F.timestamp_millis((seconds * 1000).cast("bigint"))


def date_text(seconds: Column) -> Column:
    return F.coalesce(F.date_format(epoch_timestamp(seconds), "yyyy-MM-dd"), F.lit("unknown"))


def calendar_keys(seconds: Column) -> dict[str, Column]:
    t = epoch_timestamp(seconds)
    return {"month": F.date_format(t, "yyyy-MM"), "day": F.date_format(t, "yyyy-MM-dd"), "hour": F.date_format(t, "HH"), "weekday": F.date_format(t, "EEEE")}


def format_hours(seconds: Column) -> Column:
    return F.concat(F.regexp_replace(F.format_string("%.2f", seconds / 3600), r"\.?0+$", ""), F.lit("h"))


def mask_words(c: Column, words: str, mode: str) -> Column:
    """Stars over the whole words that the pattern `words` matches. mode: off, first (first letter stays), full."""
    if mode == "off":
        return c
    p = rf"(?i)(?<![\p{{L}}\p{{N}}_])(?:{words})(?![\p{{L}}\p{{N}}_])"
    star = lambda w: F.repeat(F.lit("*"), F.length(w)) if mode == "full" else F.concat(F.substring(w, 1, 1), F.repeat(F.lit("*"), F.length(w) - 1))
    found = F.transform(F.regexp_extract_all(c, F.lit(p), F.lit(0)), star)
    return F.array_join(F.flatten(F.zip_with(F.split(c, p, -1), found, lambda a, b: F.array_compact(F.array(a, b)))), "")


def player_key(id64: Column, clean_id: Column) -> Column:
    return F.coalesce(F.concat(F.lit("64:"), id64.cast("string")), F.when(F.trim(clean_id) != "", F.concat(F.lit("id:"), F.upper(F.trim(clean_id)))))


def count_char(c: Column, char: str) -> Column:
    return F.length(c) - F.length(F.replace(c, F.lit(char), F.lit("")))


def sanitize_candidate(c: Column) -> Column:
    return F.trim(F.translate(c, ",|;", "   "))


def serialize_candidates(c: Column) -> Column:
    """array<struct<name, id64, clean_id>> as name|id64|id;..."""
    one = lambda x: F.concat_ws("|", *(F.coalesce(sanitize_candidate(x[f].cast("string")), F.lit("")) for f in ("name", "id64", "clean_id")))
    return F.array_join(F.transform(c, one), ";")


def parse_id_csv(c: Column) -> Column:
    return F.filter(F.transform(F.split(c, ","), lambda x: F.trim(x).try_cast("int")), lambda x: x.isNotNull())


def audit_text(c: Column) -> Column:
    return F.substring(F.trim(F.replace(F.element_at(F.split(c, "\n"), -1), F.lit("\r"), F.lit(""))), 1, 500)


def tokens(c: Column) -> Column:
    return F.filter(F.regexp_extract_all(F.lower(c), F.lit("[a-z0-9']+"), F.lit(0)), lambda x: F.length(x) >= 2)
