"""Lexicon sentiment after Hutto and Gilbert (2014), as joins and windows. The lexicon is a table (token, valence)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ticklore.functions.scalars import count_char, epoch_timestamp, tokens
from ticklore.operators.chat import LAUGHTER
from ticklore.operators.playtime import common_name
from ticklore.sources.shared import stored

# Negations, boosters, phrases and constants of the published rules.
NEGATIONS = """
aint arent cannot cant couldnt darent didnt doesnt dont hadnt hasnt havent isnt mightnt mustnt neednt oughtnt shant shouldnt wasnt werent wont wouldnt
neither never none nope nor not nothing nowhere uhuh uh-uh without rarely seldom despite
""".split()
RAISING = """
absolutely amazingly awfully completely considerable considerably decidedly deeply effing enormous enormously entirely especially exceptional exceptionally extreme extremely
fabulously flipping flippin frackin fracking fricking frickin frigging friggin fully fuckin fucking fuggin fugging greatly hella highly hugely incredible incredibly intensely
major majorly more most particularly purely quite really remarkably so substantially thoroughly total totally tremendous tremendously uber unbelievably unusually utter utterly very
""".split()
LOWERING = """
almost barely hardly kinda kindof kind-of less little marginal marginally occasional occasionally partly scarce scarcely slight slightly somewhat sorta sortof sort-of
""".split()
LOWERING_PAIRS = ["just enough", "kind of", "sort of"]
PHRASES = {"the shit": 3.0, "the bomb": 3.0, "bad ass": 1.5, "bus stop": 0.0, "yeah right": -2.0, "kiss of death": -1.5, "to die for": 3.0, "beating heart": 3.1, "broken heart": -2.9}
BOOSTED, NEGATED, CAPITALS, EXCLAIMED, EMPHATIC, ALPHA = 0.293, -0.74, 0.733, 0.292, 1.25, 15.0
DAMPING = [1.0, 0.95, 0.9]
#: Words and phrases that are sent to every task at once; more of them are dealt by a shuffle.
BROADCAST_TERMS = 100_000
BOOSTERS = {**dict.fromkeys(RAISING, BOOSTED), **dict.fromkeys(LOWERING, -BOOSTED)}


def _shouts(x: Column) -> Column:
    return (x == F.upper(x)) & (x != F.lower(x))


def _words(text: Column) -> Column:
    """Split at blanks. Marks at both ends go, unless that would leave two characters or fewer: those may be an emoticon."""
    bare = F.regexp_replace(text, r"(?<!\S)\p{Punct}*([^\s\p{Punct}]\S+[^\s\p{Punct}])\p{Punct}*(?!\S)", "$1")
    return F.filter(F.split(bare, r"\s+"), lambda w: w != "")


def _spans(low: Column) -> Column:
    """Of an array of words: struct(pos, n, token) of each one, two and three words in a row (a null token beyond the end)."""

    def one(w, i):
        pair = F.concat(w, F.lit(" "), F.get(low, i + 1))
        return F.array(*(F.struct(i.alias("pos"), F.lit(n).alias("n"), t.alias("token")) for n, t in ((1, w), (2, pair), (3, F.concat(pair, F.lit(" "), F.get(low, i + 2))))))

    return F.flatten(F.transform(low, one))


#: Finds of a text are in order of place and length, three to a place at most: so many before one and after it hold all from three places before to one after.
BEFORE, AFTER = 9, 5


def _value(near: Column) -> Column:
    """What the find at BEFORE in near (struct(pos, n, valence), n words each) counts, from the columns words, low, mixed and but. Work does not grow with the text."""
    low, mixed, own_find = F.col("low"), F.col("mixed"), F.get(near, BEFORE)
    i, valence = own_find["pos"], own_find["valence"]
    known = lambda j: F.exists(near, lambda x: F.coalesce((x["pos"] == i - j) & (x["n"] == 1), F.lit(False)))
    boost = F.create_map(*[F.lit(x) for kv in BOOSTERS.items() for x in kv])
    at = lambda j: F.get(low, i - j)
    among = lambda x, *some: F.coalesce(x.isin(*some), F.lit(False))
    stressed = lambda j, v: F.when(mixed & _shouts(F.get(F.col("words"), i - j)), F.when(v > 0, CAPITALS).otherwise(-CAPITALS)).otherwise(0.0)
    phrase = lambda back, n: F.get(F.filter(near, lambda x: (x["pos"] == i - back) & (x["n"] == n)), 0)["valence"]

    # "no" before a lexicon word negates that word, and is none itself.
    refused = among(at(1), "no") | among(at(2), "no") | (among(at(3), "no") & among(at(1), "or", "nor"))
    first = F.when(refused, valence * NEGATED).when((at(0) == "no") & known(-1), 0.0).otherwise(valence)
    # Bound as an element, so that what follows names it without repeating it.
    first = F.aggregate(F.array(first), F.lit(0.0), lambda _, v: v + stressed(0, v))

    def look_back(v, j):
        """One of the three words before, of those that are not in the lexicon."""
        w = at(j)
        between = lambda *some: ((j == 2) & among(at(1), *some)) | ((j == 3) & (among(at(2), *some) | among(at(1), *some)))
        up = F.try_element_at(boost, w)
        moved = F.when(up.isNull(), 0.0).otherwise(F.when(v < 0, -up).otherwise(up) + stressed(j, v))
        turned = F.when((w == "never") & between("so", "this"), EMPHATIC).when((w == "without") & between("doubt"), 1.0).when(w.isin(NEGATIONS) | w.contains("n't"), NEGATED).otherwise(1.0)
        own = (v + moved * F.element_at(F.array(*map(F.lit, DAMPING)), j)) * turned
        # Phrases that the word begins or ends, or that end before it, count instead of it; then pairs that lower it.
        told = F.coalesce(phrase(0, 3), phrase(0, 2), phrase(1, 2), phrase(2, 3), phrase(2, 2), phrase(3, 3), phrase(3, 2), own)
        pair = lambda a, b: F.when(among(F.concat(at(a), F.lit(" "), at(b)), *LOWERING_PAIRS), -BOOSTED).otherwise(0.0)
        return F.when((i < j) | known(j), v).when(j == 3, told + pair(3, 2) + pair(2, 1)).otherwise(own)

    value = F.aggregate(F.array(*map(F.lit, (1, 2, 3))), first, look_back)
    least = among(at(1), "least") & ~known(1) & ~among(at(2), "at", "very")
    part = F.when((F.col("but") < 0) | (i == F.col("but")), 1.0).when(i < F.col("but"), 0.5).otherwise(1.5)
    idle = F.coalesce(at(0).isin(list(BOOSTERS)) | ((at(0) == "kind") & among(at(-1), "of")), F.lit(False))
    return F.when(idle | (own_find["n"] > 1), 0.0).otherwise(value * F.when(least, NEGATED).otherwise(1.0) * part)


def sentiment(df: DataFrame, text_col: str, lexicon: DataFrame, keys: list[str], phrases: DataFrame | None = None) -> DataFrame:
    """keys identify a row. Adds compound (-1 to 1): the summed valence s as s / sqrt(s^2 + 15).

    lexicon: token (one word or emoticon, any case), valence; phrases: phrase (two or three words), valence, PHRASES if not given. Of
    repeated tokens the mean counts. Texts meet both tables in one join of their runs of one to three words, and only what was found is
    grouped; the rules then look at the places around each find, in its row. They are: boosters and negations among the three words before,
    by distance; "never so", "without doubt", "no", "least", "kind of"; phrases instead of their words; capitals among others; what
    stands before or after the first "but" (by 0.5 and 1.5); exclamation marks (up to four) and question marks. Null and empty texts score 0.
    """
    text = F.col(text_col)
    if phrases is None:
        phrases = df.sparkSession.createDataFrame(list(PHRASES.items()), "phrase string, valence double")
    terms = lexicon.select(F.lower("token").alias("token"), "valence").filter(~F.col("token").rlike(r"\s")).unionByName(phrases.select(F.lower("phrase").alias("token"), "valence").filter(F.col("token").contains(" ")))
    terms = terms.filter("valence IS NOT NULL").groupBy("token").agg(F.avg(F.col("valence").cast("double")).alias("valence"))
    terms = stored(terms, "terms")
    # Spark takes exploded texts for as small as their compressed files, and would broadcast them. So the side that may go through the driver is told.
    few = terms.limit(BROADCAST_TERMS + 1).count() <= BROADCAST_TERMS
    told = df.select(*keys, F.struct("*").alias("row"), text.alias("text"))
    low = told.select(*keys, F.transform(_words(F.col("text")), F.lower).alias("low"))
    found = low.select(*keys, F.explode(_spans(F.col("low"))).alias("w")).select(*keys, "w.*").join(terms.hint("broadcast" if few else "shuffle_hash"), "token")
    found = found.groupBy(*keys).agg(F.array_sort(F.collect_list(F.struct("pos", "n", "valence"))).alias("finds"))
    at = told.hint("merge").join(found, keys, "left").withColumn("words", F.when(F.col("finds").isNotNull(), _words(F.col("text")))).withColumn("low", F.transform("words", F.lower))
    at = at.withColumn("loud", F.size(F.filter("words", _shouts))).withColumn("mixed", (F.col("loud") > 0) & (F.col("loud") < F.size("words"))).withColumn("but", F.array_position("low", "but").cast("int") - 1)
    value = lambda e: F.aggregate(F.array(F.array(*(F.get("finds", e + k) for k in range(-BEFORE, AFTER + 1)))), F.lit(0.0), lambda _, near: _value(near))
    total = F.aggregate(F.sequence(F.lit(0), F.size("finds") - 1), F.lit(0).cast("decimal(28,6)"), lambda s, e: (s + value(e).cast("decimal(18,6)")).cast("decimal(28,6)"))
    loud, asks = count_char(F.col("text"), "!"), count_char(F.col("text"), "?")
    marks = F.least(loud, F.lit(4)) * EXCLAIMED + F.when(asks > 3, 0.96).when(asks > 1, asks * 0.18).otherwise(0.0)
    scored = at.select("row", "text", F.when(F.col("finds").isNotNull(), total).cast("double").alias("s"))
    scored = scored.select("row", F.coalesce(F.col("s") + F.signum("s") * marks, F.lit(0.0)).alias("s"))
    return scored.select("row.*", F.round(F.col("s") / F.sqrt(F.col("s") * F.col("s") + ALPHA), 4).alias("compound"))


def user_sentiment(scored: DataFrame) -> DataFrame:
    """scored: id64, id, name, compound, session_id."""
    keyed = scored.withColumn("id", F.coalesce("id", F.lit("unknown")))
    a = keyed.groupBy("id64", "id").agg(F.round(F.avg(F.col("compound").cast("decimal(10,4)")), 6).cast("double").alias("mean"), F.count("*").alias("n"))
    return a.join(common_name(keyed, ["id64", "id"]), ["id64", "id"], "left")


def known_sentiment(users: DataFrame, names: DataFrame) -> DataFrame:
    """Unweighted mean of user means for each known name; the first id stays."""
    u = users.withColumn("known", F.lower(F.trim("name"))).join(names.select(F.lower(F.trim("name")).alias("known")).distinct(), "known", "left_semi")
    return u.groupBy("known").agg(F.round(F.avg("mean"), 6).alias("mean"), F.sum("n").alias("n"), F.min("id").alias("id"))


def sentiment_timeline(scored: DataFrame, bucket: str = "month") -> DataFrame:
    t = F.date_trunc(bucket, epoch_timestamp(F.col("date")))
    return scored.groupBy(F.date_format(t, "yyyy-MM").alias("bucket")).agg(F.round(F.avg(F.col("compound").cast("decimal(10,4)")), 6).cast("double").alias("mean"), F.count("*").alias("n")).orderBy("bucket")


def lowest_messages(scored: DataFrame, n: int = 200) -> DataFrame:
    return scored.orderBy("compound", "session_id", "index").limit(n)


def extreme_messages(scored: DataFrame, keys: list[str], n: int = 5) -> DataFrame:
    """The n most positive and n most negative messages of each key; longer ones first."""
    tail = [F.desc(F.length("text")), "session_id", "index"]
    up, down = (F.row_number().over(Window.partitionBy(*keys).orderBy(o, *tail)) for o in (F.desc("compound"), F.asc("compound")))
    return scored.withColumn("up", up).withColumn("down", down).filter((F.col("up") <= n) | (F.col("down") <= n))


def sentiment_overall(scored: DataFrame, keys: list[str]) -> DataFrame:
    """Mean and number for each key, over all months (null month) and by month."""
    month = F.date_format(epoch_timestamp(F.col("date")), "yyyy-MM")
    c = F.col("compound").cast("decimal(10,4)")
    both = scored.select(*keys, month.alias("month"), c.alias("c"))
    grouped = both.groupingSets([[*[F.col(k) for k in keys], F.col("month")], [F.col(k) for k in keys]], *[F.col(k) for k in keys], F.col("month"))
    return grouped.agg(F.round(F.avg("c"), 6).cast("double").alias("mean"), F.count("*").alias("n"))


def superlatives(scored: DataFrame, keys: list[str]) -> DataFrame:
    """funniest: of the most positive message with laughter (without any, the most positive); rudest: the most negative. The first wins ties.

    Each as struct(session_id, index, compound); scored has `body`.
    """
    laughs = F.arrays_overlap(tokens(F.col("body")), F.array(*[F.lit(w) for w in LAUGHTER]))
    told = F.struct("session_id", "index", "compound")
    first = F.struct("date", "session_id", "index")
    up = scored.withColumn("laughs", laughs).withColumn("told", told).withColumn("up", F.struct((~laughs).alias("l"), (-F.col("compound")).alias("c"), first.alias("f"))).withColumn("low", F.struct(F.col("compound").alias("c"), first.alias("f")))
    return up.groupBy(*keys).agg(F.min_by("told", "up").alias("funniest"), F.min_by("told", "low").alias("rudest"))
