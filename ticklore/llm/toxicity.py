"""Toxicity with noisy-channel deobfuscation (operator 8).

A character trigram model is counted over all documents. Tokens that look disguised (digits or signs for letters,
letters set apart, letters repeated) become lattices of what each sign may stand for, and Viterbi finds the likeliest
spellings. A plain word with doubled letters, or cut by one sign, has one other spelling, which needs no lattice. Gaps may be word breaks in the lattice; long passages and tokens are decoded in overlapping windows. Texts are then scored by a list of telling word beginnings, in the text as it stands and in what was restored.

The list is learned from all labelled rows that are not held out: beginnings that toxic rows share are counted over
them, and taken greedily while they explain toxic rows that no other one explains. Then those come in that no row needs, if they stand among many different sets of the ones taken: a
phrase of one text and its copies always has the same company. The score is the list's highest precision in the text, or the rate of what stays unexplained.

Null and empty texts score that rate. Null doc_ids are not held out and have no label. Labels that are null, or of no
document, are not used; of several labels the greatest counts. Without labels the score is 0. Repeated rows score alike.
Columns other than doc_id, text, and the labels' doc_id and toxic are not read.
"""

from __future__ import annotations

import heapq
import re
from collections import Counter
from functools import lru_cache
from hashlib import blake2b

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import columns, small_batches, table, written

#: A candidate stands in so many toxic rows; a list entry explains so many on its own, with so little error.
LEAST, ERROR = 4, 0.02
#: Different companies in which an entry is seen that explains no row on its own.
COMPANIES = 2 * LEAST
SHORTEST, LONGEST = 3, 9
#: Beginnings that a task counts before it passes the counts on, or that are sent to all executors; words that it remembers.
TALLIED = 1 << 18
#: Signs and the letters that they may stand for.
STANDS_FOR = {"0": "o", "1": "il", "3": "e", "4": "a", "5": "s", "6": "g", "7": "t", "8": "b", "9": "g", "@": "a", "$": "s", "!": "i", "|": "il", "+": "t"}
GAPS = " .-_*,"
EDGES = ".,;:?!\"'()[]{}<>#%*-_"
#: In a token: signs between, before or after letters, a letter three times in a row, or short parts set apart by signs.
DISGUISED = re.compile(r"[^\W\d_][0-9@$!|+*]+[^\W\d_]|(?:^|[^\w@.])[0-9@$!|+]+[^\W\d_]|[^\W\d_][0-9@$!|+]+(?:$|[^\w@.])|([^\W\d_])\1\1|[^\W\d_]{1,4}(?:[.\-_*][^\W\d_]{1,4}){2,}|(?:^|\W)[^\W\d_](?:,[^\W\d_]){3,}(?:$|\W)")
TRIPLE = re.compile(r"(\w)\1\1")
#: Over tokens: single letters, or signs for them, each on its own, up to three blanks apart.
SPACED = re.compile(r"(?<!\S)[\w@$!|+](?: {1,3}[\w@$!|+]){3,}(?!\S)")
#: A word with doubled letters; a word of letters with one sign inside it.
DOUBLE, CUT = re.compile(r"(\w)\1+"), re.compile(r"[^\W\d_]+[.\-_*][^\W\d_]+")
#: Dots set apart a word's letters where its parts are short, or one letter repeated; longer parts are those of an address.
ADDRESS = re.compile(r"\w@\w+\.|://|^www\.|(?:^|\.)(?!(\w)\1*\.)\w{5,}\.\w+\.\w|\.(?!(\w)\2*\.)\w{5,}\.\w")
#: Tokens longer than that are decoded each time that they come, not remembered.
REMEMBERED = 48
#: Runs of equal signs by which a window moves on; it holds twice as many.
WINDOW_STEP = 64
WORD = re.compile(r"[^\W\d_]+")
ALPHABET = 28  # 0 other, 1-26 letters, 27 letters beyond ASCII


def held_out(doc_id: Column, mod: int, rest: int) -> Column:
    return F.coalesce(F.pmod(F.crc32(doc_id.cast("string").cast("binary")), F.lit(mod)) == rest, F.lit(False))


@lru_cache(maxsize=1)
def classes() -> np.ndarray:
    c = np.zeros(256, np.uint16)
    for i in range(26):
        c[65 + i] = c[97 + i] = i + 1
    c[128:] = 27
    return c


def char_model(docs: DataFrame) -> np.ndarray:
    """Costs (-log10) of a letter after two, from counts over all texts: 28 ** 3 numbers, whatever the corpus' size."""

    def run(batches):
        n = np.zeros(ALPHABET**3, np.int64)
        for batch in batches:
            text = b"  ".join(batch.column(0).cast(pa.binary()).drop_null().to_pylist())
            for i in range(0, len(text), 1 << 17):
                c = classes()[np.frombuffer(text[i : i + (1 << 17) + 2], np.uint8)]
                n += np.bincount((c[:-2] * np.uint16(ALPHABET) + c[1:-1]) * np.uint16(ALPHABET) + c[2:], minlength=ALPHABET**3)
        at = np.flatnonzero(n)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(n[at])], names=["gram", "n"])

    rows = docs.select("text").mapInArrow(run, "gram long, n long").groupBy("gram").agg(F.sum("n").alias("n")).collect()
    n = np.ones(ALPHABET**3)
    for r in rows:
        n[r.gram] += r.n
    n = n.reshape(-1, ALPHABET)
    return -np.log10(n / n.sum(axis=1, keepdims=True)).ravel()


def restore(token: str, cost: np.ndarray, best: int = 4) -> list[str]:
    """Words of the likeliest plain spellings of a disguised token or passage: with gaps as nothing (its beginning), and as breaks or nothing."""
    runs: list[tuple[str, int]] = []
    for ch in token.lower():
        if runs and runs[-1][0] == ch:
            runs[-1] = ch, runs[-1][1] + 1
        else:
            runs.append((ch, 1))
    out = decode(runs[: 2 * WINDOW_STEP], cost, best, False)
    for lo in range(0, max(1, len(runs) - WINDOW_STEP), WINDOW_STEP):
        window = runs[lo : lo + 2 * WINDOW_STEP]
        # Without a break, a window says no more than the beginning did.
        if any(breaks(ch) for ch, _ in window):
            # Words that the window's ends may have cut stand whole in the next one.
            cut = slice(1 if lo else 0, None if lo + 2 * WINDOW_STEP >= len(runs) else -1)
            for s in decode(window, cost, best, True):
                out += s.split(" ")[cut]
    return out


def singled(word: str) -> set[str]:
    """The word with all doubles as single letters, and with each double alone so; what is longer than any word only the first way."""
    each = DOUBLE.finditer(word) if len(word) <= REMEMBERED else ()
    return {DOUBLE.sub(r"\1", word), *(word[: m.start()] + m[1] + word[m.end() :] for m in each)}


def breaks(ch: str) -> bool:
    return ch in GAPS or not (ch.isalnum() or ch in STANDS_FOR)


def decode(runs: list[tuple[str, int]], cost: np.ndarray, best: int, split: bool) -> list[str]:
    """The likeliest spellings, by Viterbi over (last two letters) with a few paths each; with split, a gap may be a space."""
    beams = {(0, 0): [(0.0, "")]}
    for ch, n in runs:
        options = []
        if ch in GAPS:
            options.append((0.0, ""))
        for c in STANDS_FOR.get(ch, ch if ch.isalpha() else ""):
            # One letter for a run is likely, two less so.
            options += [(0.3 if c != ch else 0.0, c), (1.0 + abs(n - 2) if n != 2 else 0.3, c + c)]
        if not options:
            options.append((2.0, ""))
        if split and breaks(ch):
            options.append((0.0, " "))
        found: dict = {}
        for (a, b), paths in beams.items():
            for price, out in options:
                x, y, more = a, b, price
                for c in out:
                    k = ord(c) - 96 if "a" <= c <= "z" else 0 if c == " " else 27
                    more += cost[(x * ALPHABET + y) * ALPHABET + k]
                    x, y = y, k
                found.setdefault((x, y), []).extend((p + more, s + out) for p, s in paths)
        kept = {k: heapq.nsmallest(best, v) for k, v in found.items()}
        beams = dict(heapq.nsmallest(24, kept.items(), key=lambda e: e[1][0]))
    ends = [(p + cost[(a * ALPHABET + b) * ALPHABET], s) for (a, b), paths in beams.items() for p, s in paths]
    return [s for _, s in heapq.nsmallest(best, ends)]


class Finder:
    """What a text says, in plain and restored words: for each token `what` of all its spellings, remembered."""

    def __init__(self, cost: np.ndarray, what):
        self.cost, self.what, self.seen = cost, what, {}

    def token(self, token: str):
        found = self.seen.get(token)
        if found is None:
            if len(self.seen) > 400_000:
                self.seen.clear()
            core = token.strip(EDGES)
            # A mark of exclamation ends a word, but begins none.
            if core and token.lstrip(EDGES.replace("!", "")).startswith("!"):
                core = "!" + core
            plain = core.isalpha()
            words = [core] if plain else WORD.findall(core)
            if (TRIPLE if plain else DISGUISED).search(core) and not ADDRESS.search(core):
                words += restore(core, self.cost)
            elif plain and DOUBLE.search(core):
                words += singled(core)
            elif CUT.fullmatch(core) and not ADDRESS.search(core):
                words.append("".join(words))
            found = tuple({x for w in words for x in self.what(w)})
            if len(token) <= REMEMBERED:
                self.seen[token] = found
        return found

    def __call__(self, text: str) -> set:
        text = text.lower()
        out: set = set()
        out.update(*map(self.token, set(text.split())))
        for m in SPACED.finditer(text):
            out.update(x for w in restore(m.group(), self.cost) for x in self.what(w))
        return out


def beginnings(word: str) -> list[str]:
    """A word's beginnings, and the word itself with its end marked."""
    return [word[:n] for n in range(SHORTEST, min(LONGEST, len(word)) + 1)] + ([word + "$"] if len(word) >= SHORTEST else [])


def said(docs: DataFrame, cost: np.ndarray) -> DataFrame:
    """doc_id, rid, words: the different words of every row, plain and restored, with a blank between. Texts are read and restored once, here."""
    shared = docs.sparkSession.sparkContext.broadcast(cost)

    def run(batches):
        find = Finder(shared.value, lambda w: [w] if len(w) >= SHORTEST else [])
        for batch in batches:
            out = [" ".join(find(t or "")) for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(2), pa.array(out, pa.string())], names=["doc_id", "rid", "words"])

    return written(docs.select("doc_id", "text", "rid").mapInArrow(run, "doc_id long, rid long, words string"), "said")


def held(words: DataFrame, labels: DataFrame) -> DataFrame:
    """key, n: each beginning in the labelled rows, and how many of them hold it."""

    def run(batches):
        n: Counter = Counter()
        for batch in batches:
            for text in batch.column(0).to_pylist():
                n.update({k for w in text.split() for k in beginnings(w)})
                if len(n) > TALLIED:
                    yield pa.RecordBatch.from_arrays([pa.array(list(n), pa.string()), pa.array(list(n.values()), pa.int64())], names=["key", "n"])
                    n.clear()
        yield pa.RecordBatch.from_arrays([pa.array(list(n), pa.string()), pa.array(list(n.values()), pa.int64())], names=["key", "n"])

    return words.join(labels, "doc_id").select("words").mapInArrow(run, "key string, n long").groupBy("key").agg(F.sum("n").alias("n"))


def clean_counts(words: DataFrame, labels: DataFrame, keys: list[str], most: np.ndarray) -> np.ndarray:
    """How many clean rows hold each key. A task counts a key no further once it has seen more than `most` for it, so that counts above `most` are lower bounds."""
    shared = words.sparkSession.sparkContext.broadcast(({k: i for i, k in enumerate(keys)}, most.tolist()))

    def run(batches):
        number, bound = shared.value
        left, n, nothing = dict(number), np.zeros(len(bound), np.int64), set()
        for batch in batches:
            for text in batch.column(0).to_pylist():
                own = set()
                for w in set(text.split()) - nothing:
                    found = [b for b in beginnings(w) if b in left]
                    if found:
                        own.update(found)
                    else:
                        nothing.add(w)
                for k in own:
                    i = left[k]
                    n[i] += 1
                    if n[i] > bound[i]:
                        del left[k]
                if len(nothing) > TALLIED:
                    nothing.clear()
        at = np.flatnonzero(n)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(n[at])], names=["key", "n"])

    each = words.join(labels.filter("toxic = 0"), "doc_id").select("words").mapInArrow(run, "key long, n long")
    out = np.zeros(len(keys), np.int64)
    key, n = columns(each.groupBy("key").agg(F.sum("n").alias("n")))
    out[key] = n
    return out


def candidates(words: DataFrame, labels: DataFrame) -> tuple[list[str], np.ndarray, np.ndarray]:
    """Beginnings that LEAST toxic rows share and clean rows nearly lack, and how many rows of either kind hold each. Counts are over all labelled rows.

    Counts only grow, so what an eighth of the clean rows rules out is out whatever the others hold, and is not sent to them. What
    stays open is counted over all clean rows, in blocks of about TALLIED beginnings, each of which is broadcast.
    """
    toxic = held(words, labels.filter("toxic = 1")).filter(F.col("n") >= LEAST).withColumnRenamed("n", "t")
    eighth = held(words, labels.filter("toxic = 0 AND pmod(xxhash64(doc_id), 8) = 0"))
    shared = written(toxic.join(eighth, "key", "left").filter(F.coalesce("n", F.lit(0)) <= ERROR * F.col("t")).select("key", "t"), "shared")
    blocks = -(-shared.count() // TALLIED)
    out = []
    for b in range(blocks):
        key, t = columns(shared.filter(F.pmod(F.xxhash64("key"), F.lit(blocks)) == b))
        c = clean_counts(words, labels, key.tolist(), ERROR * t)
        out += [x for x in zip(key.tolist(), t.tolist(), c.tolist()) if x[2] <= ERROR * x[1]]
    out.sort()
    return [k for k, _, _ in out], np.array([t for _, t, _ in out], np.int64), np.array([c for _, _, c in out], np.int64)


def holding(entries: dict[str, int | float]):
    """Words of some text -> what stands for the entries that begin one of them."""
    heads = {k[:SHORTEST] for k in entries}
    return lambda text: {entries[b] for w in text.split() if w[:SHORTEST] in heads for b in beginnings(w) if b in entries}


def patterns(words: DataFrame, labels: DataFrame, keys: list[str]) -> DataFrame:
    """hits (which candidates a row holds, sorted), n: each different set of candidates of the toxic rows, and how many rows have it."""
    shared = words.sparkSession.sparkContext.broadcast({k: i for i, k in enumerate(keys)})

    def run(batches):
        find = holding(shared.value)
        for batch in batches:
            out = [sorted(find(text)) for text in batch.column(0).to_pylist()]
            yield pa.RecordBatch.from_arrays([pa.array(out, pa.list_(pa.int32()))], names=["hits"])

    own = words.join(labels.filter("toxic = 1"), "doc_id").select("words").mapInArrow(run, "hits array<int>").filter("size(hits) > 0")
    return written(own.groupBy("hits").agg(F.count("*").alias("n")), "patterns")


def tallied(sets: DataFrame, chosen: np.ndarray, order: np.ndarray | None = None) -> np.ndarray:
    """Over the rows without a chosen entry: how many hold each candidate; with an order of the candidates, of how many it is the last."""
    rank = None if order is None else np.argsort(order)

    def run(batches):
        n = np.zeros(len(chosen), np.int64)
        for batch in batches:
            hits, times, own = batch.column(0), batch.column(1).to_numpy(), batch.column(0).flatten().to_numpy()
            size = np.diff(hits.offsets.to_numpy())
            begin = np.cumsum(size) - size
            times = np.where(np.logical_or.reduceat(chosen[own], begin), 0, times) if len(own) else times
            if rank is None:
                np.add.at(n, own, np.repeat(times, size))
            elif len(own):
                np.add.at(n, order[np.maximum.reduceat(rank[own], begin)], times)
        at = np.flatnonzero(n)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(n[at])], names=["key", "n"])

    out = np.zeros(len(chosen), np.int64)
    for r in sets.mapInArrow(run, "key long, n long").groupBy("key").agg(F.sum("n").alias("n")).collect():
        out[r.key] = r.n
    return out


def cover(sets: DataFrame, t: np.ndarray) -> np.ndarray:
    """Which candidates a greedy cover of all toxic rows takes, each for at least LEAST rows that no other one explains.

    Of equals, the one that stands in most rows goes first. A round takes every candidate that comes before all others in each of its
    open rows: nothing can change its count before its turn, so these are the ones that the greedy cover takes one by one.
    """
    chosen = np.zeros(len(t), bool)
    while True:
        left = tallied(sets, chosen)
        if left.max(initial=0) < LEAST:
            return chosen
        leads = tallied(sets, chosen, np.lexsort((-np.arange(len(t)), t, left)))
        chosen |= (left >= LEAST) & (leads == left)


def companies(sets: DataFrame, chosen: np.ndarray) -> list[int]:
    """Candidates not chosen that are seen among at least COMPANIES different sets of chosen ones."""

    def run(batches):
        seen: dict[int, set[bytes]] = {}
        for batch in batches:
            for own in batch.column(0).to_pylist():
                own = np.array(own)
                with_ = blake2b(own[chosen[own]].tobytes(), digest_size=16).digest()
                for k in own[~chosen[own]].tolist():
                    found = seen.setdefault(k, set())
                    if len(found) < COMPANIES:  # that many are enough, wherever else it stands
                        found.add(with_)
        key = [k for k, found in seen.items() for _ in found]
        yield pa.RecordBatch.from_arrays([pa.array(key, pa.int64()), pa.array([x for found in seen.values() for x in found], pa.binary())], names=["key", "company"])

    told = sets.mapInArrow(run, "key long, company binary").groupBy("key").agg(F.count_distinct("company").alias("n"))
    return [r.key for r in told.filter(F.col("n") >= COMPANIES).select("key").collect()]


def learn(words: DataFrame, labels: DataFrame) -> dict[str, float]:
    """Precision of each list entry. All labelled rows teach it: counts, cover and companies are over every one."""
    keys, t, c = candidates(words, labels)
    if not keys:
        return {}
    sets = patterns(words, labels, keys)
    chosen = cover(sets, t)
    listed = {*np.flatnonzero(chosen).tolist(), *companies(sets, chosen)}
    return {keys[k]: float((t[k] + 1) / (t[k] + c[k] + 1.02)) for k in sorted(listed)}


def looked_up(words: DataFrame, entries: dict[str, float]) -> DataFrame:
    """doc_id, rid, best: the highest precision of an entry that begins a word of the row; null where none does."""
    shared = words.sparkSession.sparkContext.broadcast(entries)

    def run(batches):
        find = holding(shared.value)
        for batch in batches:
            best = [max(find(text), default=None) for text in batch.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(best, pa.float64())], names=["doc_id", "rid", "best"])

    return written(words.select("doc_id", "rid", "words").mapInArrow(run, "doc_id long, rid long, best double"), "best")


def toxicity(docs: DataFrame, labels: DataFrame, mod: int = 5, rest: int = 0, key: str | None = None) -> DataFrame:
    """doc_id, held_out, score, predicted for each row. mod, rest: which rows are held out of learning. key: a column of longs that comes along as rid."""
    small_batches(docs.sparkSession)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"), (F.col(key) if key else F.lit(None)).cast("long").alias("rid"))
    known = written(labels.filter("doc_id IS NOT NULL AND toxic IS NOT NULL").groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(F.max(F.col("toxic").cast("int")).alias("toxic")).filter(~held_out(F.col("doc_id"), mod, rest)), "labels")
    words = said(rows, char_model(rows))
    found = looked_up(words, learn(words, known))
    # The rate of the labelled rows that no entry explains.
    r = found.filter("best IS NULL").join(known, "doc_id").agg(F.sum("toxic").alias("t"), F.count("*").alias("n")).first()
    none = ((r.t or 0) + 0.5) / (r.n + 1) if r.n else 0.0
    score = F.greatest(F.coalesce("best", F.lit(none)), F.lit(none))
    scored = found.select("doc_id", held_out(F.col("doc_id"), mod, rest).alias("held_out"), score.alias("score"), (score >= 0.5).cast("int").alias("predicted"), "rid")
    return scored if key else scored.drop("rid")


def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
