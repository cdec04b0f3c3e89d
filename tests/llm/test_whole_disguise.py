"""Disguised words are found wherever they stand, however long the passage or the token."""

import pytest

from ticklore.llm import toxicity

PROSE = "you are an idiot and a stupid ass they say that you are not an idiot we say the day is long and the night is short " * 50


@pytest.fixture(scope="module")
def find(spark):
    return toxicity.Finder(toxicity.char_model(spark.createDataFrame([(PROSE,)], "text string")), lambda w: [w])


@pytest.mark.parametrize(
    "text, word",
    [
        ("y o u i d i o t", "idiot"),
        (" ".join("they say that you are not an " * 5).replace("   ", " ") + "i d i o t", "idiot"),
        (" ".join(("theysaythatyouarenotan" * 20) + "idiot" + "wesaythedayislong" * 20), "idiot"),
        ("st" + "u" * 90 + "pid", "stupid"),
        ("i.d.i.o.t", "idiot"),
        ("id.i.ot", "idiot"),
        ("a55", "ass"),
        ("idi07", "idiot"),
        ("!diot", "idiot"),
        ("you  s  t  u  p  i  d  man", "stupid"),
        ("$ t u p ! d", "stupid"),
        ("s,t,u,p,i,d", "stupid"),
        ("so (s,t,u,p,i,d).", "stupid"),
        ("st-upid", "stupid"),
        ("s-tupid", "stupid"),
        ("stu.pid!", "stupid"),
        ("stuupid", "stupid"),
        ("iddiott", "idiot"),
        ("asss", "ass"),
        ("aass", "ass"),
    ],
)
def test_found(find, text, word):
    assert word in find(text)


def test_plain_words_keep_their_own_spelling(find):
    assert {"letter", "well", "known"} <= find("letter well-known")
    assert "stupid" not in find("st upid") and "idiot" not in find("id, iot")


def test_addresses_stay(find):
    assert "idiot" not in find("http://i.d.i.o.t") and "idiot" not in find("www.i.d.i.o.t")
