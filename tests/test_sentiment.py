"""Published examples of the sentiment rules, with the valences of their words, and cases of each rule by hand."""

import pytest

from ticklore.operators.sentiment import sentiment

# Valences of the published lexicon that the examples need.
LEXICON = {"smart": 1.7, "handsome": 2.2, "funny": 1.9, "good": 1.9, "horrible": -2.5, "great": 3.1, "sux": -1.5, "bad": -2.5, "bomb": -2.2, "no": -1.2, "yeah": 1.2, ":)": 2.0, "doubt": -1.5, "fun": 2.3}
# Compound scores of the published examples.
PUBLISHED = [
    ("VADER is smart, handsome, and funny.", 0.8316),
    ("VADER is smart, handsome, and funny!", 0.8439),
    ("VADER is very smart, handsome, and funny.", 0.8545),
    ("VADER is VERY SMART, handsome, and FUNNY.", 0.9227),
    ("VADER is VERY SMART, handsome, and FUNNY!!!", 0.9342),
    ("VADER is VERY SMART, uber handsome, and FRIGGIN FUNNY!!!", 0.9469),
    ("VADER is not smart, handsome, nor funny.", -0.7424),
    ("The book was good.", 0.4404),
    ("At least it isn't a horrible book.", 0.431),
    ("The book was only kind of good.", 0.3832),
    ("Today SUX!", -0.5461),
    ("Not bad at all", 0.431),
]


def by_hand(s):
    return round(s / (s * s + 15) ** 0.5, 4)


CASES = [
    ("that party was the bomb", by_hand(3.0)),
    ("the bomb", by_hand(-2.2)),  # phrases need three words before
    ("he is all yeah right now", by_hand(-2.0)),
    ("least good", by_hand(1.9 * -0.74)),
    ("the least good", by_hand(1.9 * -0.74)),
    ("at least good", by_hand(1.9)),
    ("it was never so good", by_hand((1.9 + 0.293) * 1.25)),
    ("never a good", by_hand(1.9 * -0.74)),
    ("we say without any good", by_hand(1.9 * -0.74)),
    ("no good", by_hand(1.9 * -0.74)),
    ("no", by_hand(-1.2)),
    ("very", 0.0),
    ("see :) there", by_hand(2.0)),
    ("very old good", by_hand(1.9 + 0.293 * 0.95)),
    ("great good", by_hand(5.0)),
    ("Today only kinda sux! But we are good", by_hand((-1.5 + 0.293) * 0.5 + 1.9 * 1.5 + 0.292)),
    ("The plot was good, but the dialog is not great.", by_hand(1.9 * 0.5 - 3.1 * 0.74 * 1.5)),
    ("fun but bad", by_hand(2.3 * 0.5 - 2.5 * 1.5)),
    ("good??", by_hand(1.9 + 0.36)),
    ("", 0.0),
    (None, 0.0),
    (" \n ", 0.0),
]


def test_vectors(spark):
    rows = [(i, t) for i, (t, _) in enumerate(PUBLISHED + CASES)]
    lexicon = spark.createDataFrame(list(LEXICON.items()), "token string, valence double")
    got = {r.id: r.compound for r in sentiment(spark.createDataFrame(rows, "id int, t string"), "t", lexicon, ["id"]).collect()}
    want = {i: c for i, (_, c) in enumerate(PUBLISHED + CASES)}
    assert {rows[i][1]: (got[i], want[i]) for i in want if abs(got[i] - want[i]) > 1e-9} == {}


def test_own_phrases_and_long_texts(spark):
    """Phrases are a table; repeated tokens count as their mean; a long text is one row, whatever it holds."""
    lexicon = spark.createDataFrame([("Good", 1.0), ("good", 3.0), (None, 1.0), ("odd one", 4.0), ("dull", None)], "token string, valence double")
    phrases = spark.createDataFrame([("so much good", -1.0), ("word", 3.0)], "phrase string, valence double")
    rows = [(1, "we had so much good"), (2, "much good"), (3, "odd one dull word"), (4, "x " * 50_000 + "good " * 50_000)]
    got = {r.id: r.compound for r in sentiment(spark.createDataFrame(rows, "id int, t string"), "t", lexicon, ["id"], phrases).collect()}
    assert got == {1: by_hand(-1.0), 2: by_hand(2.0), 3: 0.0, 4: 1.0}


@pytest.mark.parametrize("schema", ["id int, t string"])
def test_empty(spark, schema):
    lexicon = spark.createDataFrame([], "token string, valence double")
    assert sentiment(spark.createDataFrame([], schema), "t", lexicon, ["id"]).count() == 0
    assert sentiment(spark.createDataFrame([(1, "good")], schema), "t", lexicon, ["id"]).first().compound == 0.0
