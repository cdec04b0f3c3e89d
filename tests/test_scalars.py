import pytest
from pyspark.sql import functions as F

from ticklore.functions import scalars as S


def one(spark, value, expr):
    return spark.createDataFrame([(value,)], "x string").select(expr(F.col("x")).alias("y")).first().y


@pytest.mark.parametrize("text,cs", [("00:27.14", 2714), ("03:48.06", 22806), ("2:11:09.75", 786975)])
def test_times(spark, text, cs):
    assert one(spark, text, S.parse_time) == cs
    assert one(spark, text, lambda c: S.format_time(S.parse_time(c))) == text


@pytest.mark.parametrize("text", ["+00:31.58", "-00:02.91", "00:31.58"])
def test_signed(spark, text):
    assert one(spark, text, S.normalize_signed_time) == text


@pytest.mark.parametrize("raw,kind,off", [("STEAM_0:1:8", "steam2", 17), ("[U:1:17]", "steam3", 17), ("BOT", "bot", None), ("x", "unknown", None)])
def test_player_id(spark, raw, kind, off):
    r = one(spark, raw, S.normalize_player_id)
    assert r.kind == kind and r.id64 == (None if off is None else S.ID_BASE + off)


def test_speaker_and_body(spark):
    assert one(spark, "*DEAD* [tag] Wren : hi : you", S.speaker_name) == "Wren"
    assert one(spark, "Wren : hi : you", S.message_body) == "hi : you"


def test_mask(spark):
    assert one(spark, "a bad Badly word", lambda c: S.mask_words(c, "bad[a-z]*", "first")) == "a b** B**** word"
    assert one(spark, "bad", lambda c: S.mask_words(c, "bad[a-z]*", "full")) == "***"
