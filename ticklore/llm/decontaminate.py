"""Benchmark decontamination by latent semantic retrieval (operator 1).

Terms are those of the benchmark that are not stop-like in the corpus; a passage is a window of words with TF-IDF
weights, from passage counts over all documents. A randomised SVD, whose products with the passage matrix Spark sums over
all documents and the benchmark, gives the latent space; the matrix is stored once, packed, for the counts and both products.
Every passage of every document is projected, and compared with every benchmark segment by cosine; candidates are verified on the words themselves: longest common
subsequence near the place they share, and for paraphrases that the answer (the last sentence, or a column `answer`) is
there too. Items that stand word for word in a text are found exactly as well, by the likely rarest few words of each.

The benchmark is taken in blocks of at most BLOCK_BYTES, each of which is broadcast. Null and empty texts hold nothing;
items without words match nothing. Rows that share a doc_id are told as one document, repeated items once for each
item_id. Columns other than doc_id, text, item_id and answer are not read.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import Poly, made, mix, release, small_batches, table, word_bounds, written

BLOCK_BYTES = 4 << 20
WIDTH, STEP = 64, 32
#: Terms in more than this share of all passages are stop-like.
STOP = 0.05
#: Passages that are multiplied as one dense matrix over the terms that they have.
FEW = 64
#: Words by which items are looked up for the exact comparison.
ANCHOR = 4
_HASH = Poly(41)
SENTENCE = re.compile(r"(?<=[.!?])\s+")


def _folded() -> np.ndarray:
    t = np.arange(256, dtype=np.uint8)
    t[65:91] += 32
    for i in range(128):
        if not chr(i).isalnum():
            t[i] = 32
    return t


FOLD = _folded()


def words(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the lower-case words of some texts, without ASCII punctuation, and where each text's words end among them."""
    raw = [(t or "").lower().encode() for t in texts]
    ends = np.cumsum([len(r) + 1 for r in raw])
    buf = FOLD[np.frombuffer(b" ".join(raw), np.uint8)]
    lo, hi = word_bounds(buf)
    return _HASH.spans(_HASH.sums(_HASH.bytes[buf]), lo, hi), np.searchsorted(lo, ends)


def some_texts(batch: pa.RecordBatch, name: str = "text") -> list[tuple[int, list[str]]]:
    """A batch's texts in groups of about 256 KB, each with the number of its first."""
    out, size = [], 1 << 30
    for i, t in enumerate(batch.column(batch.schema.get_field_index(name)).to_pylist()):
        if size > 1 << 18:
            out.append((i, []))
            size = 0
        out[-1][1].append(t)
        size += len(t or "")
    return out


@dataclass
class Item:
    item_id: int
    words: np.ndarray
    answer: np.ndarray


def lcs(a: np.ndarray, b: np.ndarray) -> int:
    """Length of the longest common subsequence, a bit for each word of a."""
    masks: dict[int, int] = {}
    for i, w in enumerate(a.tolist()):
        masks[w] = masks.get(w, 0) | 1 << i
    full = (1 << len(a)) - 1
    v = full
    for w in b.tolist():
        m = masks.get(w, 0)
        if m:
            u = v & m
            v = ((v + u) | (v - u)) & full
    return len(a) - v.bit_count()


class Space:
    """Vocabulary, weights and latent directions for one block of the benchmark."""

    def __init__(self, items: list[Item]):
        self.items = items
        self.terms = np.unique(np.concatenate([i.words for i in items])) if items else np.zeros(0, np.uint64)
        self.idf = np.ones(len(self.terms))
        self.axes = np.eye(len(self.terms), 0)

    def numbers(self, w: np.ndarray) -> np.ndarray:
        if not len(self.terms):
            return np.full(len(w), -1)
        i = np.minimum(np.searchsorted(self.terms, w), len(self.terms) - 1)
        return np.where(self.terms[i] == w, i, -1)

    def passages(self, w: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """(passage, term, times) of all windows of WIDTH words at every STEP in some texts, and each text's first passage.

        A text's p-th passage starts at its word (p - 1) * STEP.
        """
        number = self.numbers(w)
        at = np.flatnonzero(number >= 0)
        begins = np.append(0, ends[:-1])
        first = np.append(0, np.cumsum((ends - begins) // STEP + 2))
        text = np.searchsorted(ends, at, side="right")
        p = first[text] + (at - begins[text]) // STEP
        key = np.concatenate([p + 1, p]) * max(1, len(self.terms)) + np.tile(number[at], 2)
        key.sort()
        head = np.flatnonzero(np.append(True, key[1:] != key[:-1])) if len(key) else np.zeros(0, np.int64)
        n = np.diff(np.append(head, len(key)))
        return *np.divmod(key[head], max(1, len(self.terms))), n, first

    def weighed(self, passage: np.ndarray, term: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """The passages that have weight; and for each entry its row among them, its term, and its weight (rows have length 1)."""
        w = (1 + np.log(n)) * self.idf[term]
        keep = w > 0
        passage, term, w = passage[keep], term[keep], w[keep]
        head = np.append(True, passage[1:] != passage[:-1]) if len(passage) else np.zeros(0, bool)
        which, row = passage[head], np.cumsum(head) - 1
        if len(w):
            w = w / np.sqrt(np.bincount(row, w * w))[row]
        return which, row, term, w

    def item_rows(self) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """The benchmark's segments of at most WIDTH words as rows: item of each, and entries as in weighed()."""
        owner, keys = [], []
        for i, item in enumerate(self.items):
            for lo in range(0, max(1, len(item.words) - STEP // 2), WIDTH):
                keys.append(len(owner) * len(self.terms) + self.numbers(item.words[lo : lo + WIDTH]))
                owner.append(i)
        key, n = np.unique(np.concatenate(keys), return_counts=True) if keys else (np.zeros(0, np.int64),) * 2
        which, row, term, w = self.weighed(key // max(1, len(self.terms)), key % max(1, len(self.terms)), n)
        return np.array(owner, np.int64)[which], which, row, term, w


def times(row: np.ndarray, term: np.ndarray, w: np.ndarray, axes: np.ndarray, n: int) -> np.ndarray:
    """(n rows, dims): the entries' matrix by axes; entries are sorted by row, and every row has one."""
    return np.add.reduceat(axes[term] * w[:, None], np.searchsorted(row, np.arange(n)), axis=0) if n else np.zeros((0, axes.shape[1]))


def squared(row: np.ndarray, term: np.ndarray, w: np.ndarray, axes: np.ndarray, n: int, out: np.ndarray, times_: float = 1.0) -> None:
    """Adds A.T @ (A @ axes) to out; A is the entries' matrix of n rows, sorted by row."""
    for lo in range(0, n, FEW):
        a, b = np.searchsorted(row, [lo, lo + FEW])
        own, at = np.unique(term[a:b], return_inverse=True)
        part = np.zeros((min(FEW, n - lo), len(own)), axes.dtype)
        part[row[a:b] - lo, at] = w[a:b]
        out[own] += times_ * (part.T @ (part @ axes[own]))


def stored(docs: DataFrame, space: Space) -> DataFrame:
    """The passage matrix of all documents: for some texts each, the number of terms of every passage, the terms, and how often each stands there."""
    shared = docs.sparkSession.sparkContext.broadcast(space)

    def run(batches):
        for batch in batches:
            for _, texts in some_texts(batch):
                passage, term, n, first = shared.value.passages(*words(texts))
                # A passage has at most WIDTH words.
                packed = np.bincount(passage, minlength=int(first[-1])).astype(np.uint8), term.astype("<i4"), n.astype(np.uint8)
                yield pa.RecordBatch.from_arrays([pa.array([x.tobytes()], pa.binary()) for x in packed], names=["sizes", "term", "n"])

    return written(docs.select("text").mapInArrow(run, "sizes binary, term binary, n binary"), "passages")


def unpacked(batch: pa.RecordBatch):
    """(sizes, term, n) of each row of stored()."""
    for sizes, term, n in zip(*(c.to_pylist() for c in batch.columns)):
        yield np.frombuffer(sizes, np.uint8), np.frombuffer(term, "<i4"), np.frombuffer(n, np.uint8)


def counted(matrix: DataFrame, space: Space) -> None:
    """Sets idf, from passage counts over all documents; stop-like terms weigh nothing unless an item has few others."""
    size = len(space.terms)

    def run(batches):
        df, passages = np.zeros(size, np.int64), 0
        for batch in batches:
            for sizes, term, _ in unpacked(batch):
                df += np.bincount(term, minlength=size)
                passages += len(sizes)
        at = np.flatnonzero(df)
        yield pa.RecordBatch.from_arrays([pa.array(np.append(-1, at)), pa.array(np.append(passages, df[at]))], names=["term", "n"])

    rows = matrix.mapInArrow(run, "term long, n long").groupBy("term").agg(F.sum("n").alias("n")).collect()  # a row for each benchmark term of the block
    df, passages = np.zeros(size), 1
    for r in rows:
        if r.term < 0:
            passages = max(1, r.n)
        else:
            df[r.term] = r.n
    idf = np.log((passages + 1) / (df + 1)) + 1
    stop = df > STOP * passages
    for item in space.items:
        own = np.unique(space.numbers(item.words))
        if (~stop[own]).sum() < 4:
            stop[own[np.argsort(df[own])][:4]] = False
    space.idf = np.where(stop, 0, idf)


def product(matrix: DataFrame, space: Space, axes: np.ndarray) -> np.ndarray:
    """A.T @ (A @ axes), over the passages of all documents (summed by Spark for each block of terms) and the benchmark.

    The benchmark's rows together weigh as much as the documents': else common prose would take all dimensions.
    Terms are multiplied in single precision and added in double.
    """
    block = 512
    shared = matrix.sparkSession.sparkContext.broadcast((space, axes.astype(np.float32)))

    def run(batches):
        own, q = shared.value
        out, rows = np.zeros(q.shape), 0
        for batch in batches:
            for sizes, term, n in unpacked(batch):
                which, row, term, w = own.weighed(np.repeat(np.arange(len(sizes)), sizes), term, n.astype(np.int64))
                squared(row, term, w, q, len(which), out)
                rows += len(which)
        yield pa.RecordBatch.from_arrays([pa.array([-1]), pa.array([np.array([float(rows)]).tobytes()], pa.binary())], names=["b", "m"])
        for b in range(0, len(out), block):
            yield pa.RecordBatch.from_arrays([pa.array([b]), pa.array([out[b : b + block].tobytes()], pa.binary())], names=["b", "m"])

    def add(pdf: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame({"b": pdf["b"][:1], "m": [sum(np.frombuffer(m) for m in pdf["m"]).tobytes()]})

    out, rows = np.zeros((len(space.terms), axes.shape[1])), 0.0
    for r in matrix.mapInArrow(run, "b long, m binary").groupBy("b").applyInPandas(add, "b long, m binary").collect():  # terms of the block x dims
        if r.b < 0:
            rows = float(np.frombuffer(r.m)[0])
        else:
            out[r.b : r.b + block] = np.frombuffer(r.m).reshape(-1, axes.shape[1])
    owner, which, row, term, w = space.item_rows()
    squared(row, term, w, axes, len(which), out, max(1.0, rows / max(1, len(which))))
    return out


def fit(docs: DataFrame, space: Space, dims: int) -> None:
    """Sets idf and the axes: right singular vectors of the passage matrix, from two products with it (Halko et al. 2011)."""
    since = made()
    matrix = stored(docs, space)
    counted(matrix, space)
    dims = min(dims, len(space.terms))
    start = np.random.default_rng(5).standard_normal((len(space.terms), min(dims + 8, len(space.terms))))
    q, _ = np.linalg.qr(product(matrix, space, start))
    y = product(matrix, space, q)
    values, vectors = np.linalg.eigh(q.T @ y)
    space.axes = q @ vectors[:, np.argsort(-values)[:dims]]
    release(docs.sparkSession, since)


def verify(item: Item, doc: np.ndarray, at: int, near: float, strict: float, loose: float) -> tuple[float, bool]:
    """Share of the item's words in the longest common subsequence around `at`, and whether that and the answer suffice."""
    n = len(item.words)
    lo, hi = max(0, at - n), at + WIDTH + n
    region = doc[lo:hi]
    place = {w: i for i, w in enumerate(item.words.tolist())}
    shift = [i - place[w] for i, w in enumerate(region.tolist()) if w in place]
    if len(shift) < loose * n:
        return len(shift) / n, False
    slack = int(near * n) + 4
    # Words that lie as in the item have like shifts: the densest stretch of shifts tells where it begins.
    shift = np.sort(np.array(shift))
    dense = np.searchsorted(shift, shift + slack, side="right") - np.arange(len(shift))
    begin = int(shift[np.argmax(dense)])
    part = region[max(0, begin) : max(0, begin + n + slack)]
    share = lcs(item.words, part) / n
    answered = share >= loose and lcs(item.answer, part) >= strict * len(item.answer)
    return share, share >= strict or answered


def runs_of(w: np.ndarray, k: int) -> np.ndarray:
    """Hashes of all k words in a row."""
    n = max(0, len(w) - k + 1)
    h = np.zeros(n, np.uint64)
    for j in range(k):
        h = mix(h * np.uint64(0x9E3779B97F4A7C15) + w[j : j + n])
    return h


def anchors(space: Space) -> dict[int, tuple[np.ndarray, dict[int, list[tuple[int, int]]]]]:
    """By number of words: the sorted hashes of the anchors of that many, and which items have each, at which word."""
    out: dict[int, dict[int, list[tuple[int, int]]]] = {}
    for i, item in enumerate(space.items):
        k = min(ANCHOR, len(item.words))
        at = int(np.argmax(np.convolve(space.idf[space.numbers(item.words)], np.ones(k), "valid")))
        out.setdefault(k, {}).setdefault(int(runs_of(item.words[at : at + k], k)[0]), []).append((i, at))
    return {k: (np.sort(np.array(list(own), np.uint64)), own) for k, own in out.items()}


def verbatim(space: Space, found: dict, w: np.ndarray, ends: np.ndarray) -> set[tuple[int, int]]:
    """(text, item) for each item whose words stand in a row in a text."""
    out = set()
    for k, (hashes, own) in found.items():
        h = runs_of(w, k)
        near = np.minimum(np.searchsorted(hashes, h), len(hashes) - 1)
        for p in np.flatnonzero(hashes[near] == h).tolist():
            text = int(np.searchsorted(ends, p, side="right"))
            for i, at in own[int(h[p])]:
                lo, words_ = p - at, space.items[i].words
                if (text, i) not in out and lo >= (ends[text - 1] if text else 0) and lo + len(words_) <= ends[text] and np.array_equal(w[lo : lo + len(words_)], words_):
                    out.add((text, i))
    return out


def blocks_of(benchmark: DataFrame) -> list[list[Item]]:
    """The benchmark in blocks of bounded size, each collected on its own."""
    answer = F.col("answer").cast("string") if "answer" in benchmark.columns else F.lit(None).cast("string")
    rows = benchmark.select(F.col("item_id").cast("long").alias("item_id"), F.col("text").cast("string").alias("text"), answer.alias("answer")).filter("text IS NOT NULL").dropDuplicates()
    total = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    n = -(-total // BLOCK_BYTES)
    for b in range(n):
        items = []
        for r in rows.filter(F.pmod(F.xxhash64("item_id", "text"), F.lit(n)) == b).collect():
            w = words([r.text])[0]
            last = words([r.answer or SENTENCE.split(r.text.strip())[-1]])[0]
            if len(w):
                items.append(Item(r.item_id, w, last if len(last) >= 3 else w[-8:]))
        yield items


FOUND = "doc_id long, item_id long, cosine double, lcs double"


def contamination(docs: DataFrame, benchmark: DataFrame, dims: int = 96, cosine: float = 0.5, strict: float = 0.8, loose: float = 0.6) -> DataFrame:
    """doc_id, item_id, cosine and lcs (share of the item's words) for each document that holds an item.

    cosine is 1 for items that only the exact comparison finds.

    strict: share of words in common order that tells an item on its own; from loose on, the answer must be there as well.
    """
    spark = docs.sparkSession
    small_batches(spark)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    parts = []
    for items in blocks_of(benchmark):
        space = Space(items)
        fit(rows, space, dims)
        parts.append(search(rows, space, cosine, strict, loose))
    if not parts:
        return spark.createDataFrame([], FOUND)
    found = parts[0]
    for p in parts[1:]:
        found = found.unionByName(p)
    return found.groupBy("doc_id", "item_id").agg(F.max("cosine").alias("cosine"), F.max("lcs").alias("lcs"))


def search(rows: DataFrame, space: Space, cosine: float, strict: float, loose: float) -> DataFrame:
    owner, which, row, term, w = space.item_rows()
    targets = times(row, term, w, space.axes, len(which))
    targets = (targets / np.maximum(np.linalg.norm(targets, axis=1, keepdims=True), 1e-12)).astype(np.float32)
    space.axes = space.axes.astype(np.float32)
    shared = rows.sparkSession.sparkContext.broadcast((space, owner, targets, anchors(space)))

    def run(batches):
        own, of, goal, anchored = shared.value
        for batch in batches:
            ids, best = batch.column(0).to_pylist(), {}
            for start, texts in some_texts(batch):
                all_words, ends = words(texts)
                *entries, first = own.passages(all_words, ends)
                passage, r, t, weight = own.weighed(*entries)
                weight = weight.astype(np.float32)
                for lo in range(0, len(passage), 4096):
                    n = min(4096, len(passage) - lo)
                    a, b = np.searchsorted(r, [lo, lo + n])
                    z = times(r[a:b] - lo, t[a:b], weight[a:b], own.axes, n)
                    z /= np.maximum(np.linalg.norm(z, axis=1, keepdims=True), 1e-12)
                    close = z @ goal.T
                    for p, k in zip(*(x.tolist() for x in np.nonzero(close >= cosine))):
                        text = int(np.searchsorted(first, passage[lo + p], side="right")) - 1
                        key = start + text, of[k]
                        if best.get(key, (0, 0))[1] == 1:
                            continue
                        doc = all_words[ends[text - 1] if text else 0 : ends[text]]
                        share, told = verify(own.items[of[k]], doc, int(passage[lo + p] - first[text] - 1) * STEP, 0.2, strict, loose)
                        if told and share > best.get(key, (0, 0))[1]:
                            best[key] = float(close[p, k]), share
                for text, i in verbatim(own, anchored, all_words, ends):
                    if best.get((start + text, i), (0, 0))[1] < 1:
                        best[start + text, i] = 1.0, 1.0
            out = [(ids[i], own.items[k].item_id, c, s) for (i, k), (c, s) in best.items()]
            if out:
                d, i, c, s = zip(*out)
                yield pa.RecordBatch.from_arrays([pa.array(d, pa.int64()), pa.array(i, pa.int64()), pa.array(c, pa.float64()), pa.array(s, pa.float64())], names=["doc_id", "item_id", "cosine", "lcs"])

    return rows.mapInArrow(run, FOUND)


def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
