"""Predicates as column builders."""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import Column
from pyspark.sql import functions as F


def contains_ci(c: Column, v: str) -> Column:
    """LIKE '%v%' without case; % and _ in v stay wildcards."""
    return c.ilike(f"%{v}%")


def any_keyword(c: Column, words: list[str]) -> Column:
    return reduce(or_, [contains_ci(c, w.strip().lower()) for w in words if w.strip()], F.lit(False))


def map_family_like(c: Column, m: str) -> Column:
    return (c == m) | c.ilike(m + "_%")


def map_family(c: Column, m: str) -> Column:
    return (F.lower(c) == m.lower()) | F.lower(c).startswith(m.lower() + "_")


def likely_record(c: Column, prefix: str) -> Column:
    """Cheap test before the patterns of parse_record()."""
    # The wording of the server's messages.
    forms = ["%beat the map record%", "%set the first map record%", "%is ranked%with time%", "%set Bonus%", "%set Course%", "%set C%", "%broke%Bonus%", "%broke%Course%", "%broke C%", "% WR)%"]
    return c.ilike(f"{prefix}(%") & reduce(or_, [c.ilike(f) for f in forms], c.ilike("%map run%") & c.ilike("%WR%"))


def likely_relay(c: Column, prefix: str) -> Column:
    name = prefix.split(" ")[0]
    return (c.ilike(f":: {name} -%") | c.ilike(":: (%")) & c.contains(" WR: ") & (c.contains(" broke ") | c.contains(" set "))


def likely_run(c: Column, prefix: str) -> Column:
    return c.startswith(prefix) & c.contains(" map run ")


def is_player(v: str, raw: str = "raw_id", clean: str = "clean_id", id64: str = "id64") -> Column:
    same = (F.col(raw) == v) | (F.col(clean) == v)
    return F.col("user_id").isNotNull() & (same | (F.col(id64) == int(v)) if v.isdigit() else same)


def is_player_chat(c: Column) -> Column:
    return c.contains(" : ")


def mentions(c: Column, term: str) -> Column:
    """The term as a word, or with a plural or possessive s."""
    return c.rlike(rf"(?i)(^|[^\p{{L}}\p{{N}}_])\Q{term}\E(?:s|['’]s|s['’])?(?=[^\p{{L}}\p{{N}}_]|$)")


def name_matches(c: Column, names: Column) -> Column:
    """A name is one of an array, or begins one where it was cut to `abc...`."""
    cut = c.endswith("...") & (F.length(c) > 3)
    stem = F.lower(F.substring(c, F.lit(1), F.length(c) - 3))
    return F.exists(names, lambda n: (F.lower(n) == F.lower(c)) | (cut & F.lower(n).startswith(stem)))


def in_year(c: Column, year: int) -> Column:
    """Epoch seconds within the UTC year; a plain range, so it reaches the scan."""
    import datetime as dt

    lo, hi = (dt.datetime(y, 1, 1, tzinfo=dt.timezone.utc).timestamp() for y in (year, year + 1))
    return (c >= lo) & (c < hi)


def class_matches(c: Column, letter: str) -> Column:
    """S for soldiers, anything else for demomen; class names as normalize_class() gives them."""
    return F.lower(c) == ("solly" if letter == "S" else "demo")
