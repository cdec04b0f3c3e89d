"""Repeated windows of K symbols in a corpus, without a row for every window.

Neighbouring windows that share their minimiser (the least hash among their m-grams) form one path; in the De Bruijn
graph whose edges are the windows of K symbols, such a path has no branch inside its own document. Equal windows have
equal minimisers, so only paths with the same minimiser can share windows. Paths are compared as wholes first (keys:
minimiser and path text, 128 bits); single windows are compared only under minimisers whose paths differ.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import CHUNK_BYTES, Poly, mix, sliding_min, word_bounds

LOW = np.uint64((1 << 24) - 1)
#: Symbols that are looked at together, so that arrays stay in the processor's cache; longer documents are cut into pieces that overlap by K - 1.
PIECE = 1 << 18
_ONE, _TWO, _WORD = Poly(11), Poly(23), Poly(37)


def byte_symbols(buf: np.ndarray) -> np.ndarray:
    return _WORD.bytes[buf]


def word_symbols(buf: np.ndarray) -> np.ndarray:
    lo, hi = word_bounds(buf)
    return _WORD.spans(_WORD.sums(_WORD.bytes[buf]), lo, hi)


def second(values: np.ndarray) -> np.ndarray:
    return mix(values + np.uint64(0x632BE59BD9B4E019))


def as_long(h: np.ndarray) -> np.ndarray:
    return h.view(np.int64)


class Chunk:
    """Some documents' symbols side by side. row, base: which row a piece is from, and where it starts there."""

    def __init__(self, pieces: list[tuple[int, int, np.ndarray]]):
        self.row = np.array([p[0] for p in pieces], np.int64)
        self.base = np.array([p[1] for p in pieces], np.int64)
        lens = np.array([len(p[2]) for p in pieces], np.int64)
        self.values = np.concatenate([p[2] for p in pieces]) if pieces else np.zeros(0, np.uint64)
        self.lo = np.concatenate([[0], np.cumsum(lens)[:-1]]).astype(np.int64)
        self.hi = self.lo + lens

    def where(self, i: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Row and place in it, of places in the chunk."""
        k = np.searchsorted(self.hi, i, side="right")
        return self.row[k], i - self.lo[k] + self.base[k]


def chunks(texts: list[bytes], symbols: Callable, k: int) -> Iterator[Chunk]:
    some, size = [], 0
    for row, text in enumerate(texts):
        v = symbols(np.frombuffer(text, np.uint8)) if text else np.zeros(0, np.uint64)
        for base in range(0, max(1, len(v) - k + 1), PIECE - k + 1):
            piece = v[base : base + PIECE]
            if len(piece) < k:
                continue
            if some and size + len(piece) > PIECE:
                yield Chunk(some)
                some, size = [], 0
            some.append((row, base, piece))
            size += len(piece)
    if some:
        yield Chunk(some)


def paths(c: Chunk, k: int, m: int) -> tuple[np.ndarray, ...]:
    """Minimiser, text hash, first window and number of windows of each path in the chunk."""
    v = c.values
    sums = _ONE.sums(v)
    grams = _ONE.windows(sums, m, mixed=False)
    least = sliding_min((grams & ~LOW) | np.arange(len(grams), dtype=np.uint64), k - m + 1)
    at = (least & LOW).astype(np.int64)
    i = np.arange(len(at))
    inside = np.zeros(len(at), bool)
    for lo, hi in zip(c.lo, c.hi):
        inside[lo : hi - k + 1] = True
    new = np.ones(len(at), bool)
    new[1:] = (at[1:] != at[:-1]) | (inside[1:] != inside[:-1])
    cut = np.flatnonzero(new)
    lens = np.diff(np.append(cut, len(at)))
    keep = inside[cut]
    first, lens = i[cut][keep], lens[keep]
    anchor = at[first]
    text = _ONE.spans(sums, first, first + lens - 1 + k)
    return grams[anchor], mix(text + (anchor - first).astype(np.uint64)), first, lens


def texts_of(batch: pa.RecordBatch, name: str = "text") -> list[bytes]:
    col = batch.column(batch.schema.get_field_index(name))
    return [b"" if x is None else x for x in col.cast(pa.binary()).to_pylist()]


FOUND = T.StructType([T.StructField(n, t) for n, t in (("a", T.LongType()), ("g", T.LongType()), ("rid", T.LongType()), ("spot", T.LongType()))])
#: A spot is start, length and number in one long, of so many bits: a number is at most PIECE, so shuffled rows stay short.
LEN_BITS, NUMBER_BITS = 13, 19


class Filter:
    """A Bloom filter over pairs of numbers, in blocks that Spark builds apart. Its size is bounded: beyond it only more passes."""

    BLOCK, MOST, PER_KEY = 1 << 19, 2048, 12

    def __init__(self, pairs: DataFrame):
        """pairs: two columns of longs."""
        a, b = pairs.columns
        self.blocks = min(self.MOST, max(1, -(-pairs.count() * self.PER_KEY // self.BLOCK)))

        def place(batches):
            for batch in batches:
                block, key = self.split(batch.column(0).to_numpy(), batch.column(1).to_numpy())
                yield pa.RecordBatch.from_arrays([pa.array(block), pa.array(key.view(np.int64))], names=["block", "key"])

        def fill(pdf):
            bits = np.zeros(self.BLOCK, bool)
            for probe in self.probes(pdf["key"].to_numpy().view(np.uint64)):
                bits[probe] = True
            return pd.DataFrame({"block": pdf["block"][:1], "bits": [np.packbits(bits, bitorder="little").tobytes()]})

        self.bits = np.zeros(self.blocks * self.BLOCK // 8, np.uint8)
        told = pairs.select(F.col(a).cast("long"), F.col(b).cast("long")).mapInArrow(place, "block long, key long")
        for r in told.groupBy("block").applyInPandas(fill, "block long, bits binary").collect():  # MOST blocks of 64 KB
            self.bits[r.block * self.BLOCK // 8 : (r.block + 1) * self.BLOCK // 8] = np.frombuffer(r.bits, np.uint8)

    def split(self, x: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        key = mix(mix(x.astype(np.int64).view(np.uint64)) + y.astype(np.int64).view(np.uint64))
        return ((key >> np.uint64(1)) % np.uint64(self.blocks)).astype(np.int64), key

    def probes(self, key: np.ndarray) -> list[np.ndarray]:
        h = mix(key)
        return [((h >> np.uint64(s)) & np.uint64(self.BLOCK - 1)).astype(np.int64) for s in (0, 20, 40)]

    def may_have(self, x: np.ndarray, y: np.ndarray) -> np.ndarray:
        block, key = self.split(x, y)
        out = np.ones(len(key), bool)
        for probe in self.probes(key):
            at = block * self.BLOCK + probe
            out &= (self.bits[at >> 3] >> (at & 7).astype(np.uint8)) & 1 == 1
        return out


def found(docs: DataFrame, symbols: Callable, k: int, m: int, only: Filter | None = None) -> DataFrame:
    """A row for each path (its spot as start, length, number): of those whose key `only` may hold; or without it, equal paths of one batch as one row, with their number and the first place (least rid, then start)."""
    if k - m + 1 >= 1 << LEN_BITS:
        raise ValueError("gram is too short for such a window")
    combine = only is None
    shared = docs.sparkSession.sparkContext.broadcast(only)

    def run(batches):
        for batch in batches:
            rids = batch.column(0).to_numpy()
            for c in chunks(texts_of(batch), symbols, k):
                a, g, first, lens = paths(c, k, m)
                row, start = c.where(first)
                rid, n = rids[row], np.ones(len(a), np.int64)
                if not combine:
                    ok = shared.value.may_have(a.view(np.int64), g.view(np.int64))
                    a, g, n, rid, start, lens = a[ok], g[ok], n[ok], rid[ok], start[ok], lens[ok]
                elif len(a):
                    order = np.lexsort((start, rid, g, a))
                    a, g, rid, start, lens = a[order], g[order], rid[order], start[order], lens[order]
                    head = np.flatnonzero(np.append(True, (a[1:] != a[:-1]) | (g[1:] != g[:-1])))
                    n = np.diff(np.append(head, len(a)))
                    a, g, rid, start, lens = a[head], g[head], rid[head], start[head], lens[head]
                yield pa.RecordBatch.from_arrays([pa.array(as_long(a)), pa.array(as_long(g)), pa.array(rid), pa.array(start.astype(np.int64) << (LEN_BITS + NUMBER_BITS) | lens.astype(np.int64) << NUMBER_BITS | n)], names=FOUND.names)

    return docs.select("rid", "text").mapInArrow(run, FOUND)


def unspot(spot):
    """Start, length and number of a spot."""
    return F.shiftright(spot, LEN_BITS + NUMBER_BITS), F.shiftright(spot, NUMBER_BITS).bitwiseAND((1 << LEN_BITS) - 1), spot.bitwiseAND((1 << NUMBER_BITS) - 1)


def packed(start, length):
    """A place and a number of windows in one long."""
    return F.shiftleft(start.cast("long"), 32) + length.cast("long")


WINDOW = T.StructType([T.StructField(n, t) for n, t in (("h1", T.LongType()), ("h2", T.LongType()), ("n", T.IntegerType()), ("rid", T.LongType()), ("mark", T.LongType()))])


def windows(docs: DataFrame, symbols: Callable, k: int, m: int, of: Filter, keep_first: bool) -> DataFrame:
    """The windows of the paths whose place (rid, start) `of` may hold: with a hash of 128 bits each.

    What one batch settles is combined in it. keep_first: a window that stands earlier in the batch is removed. Else, all
    equal windows of a batch are removed, and one row carries their number on. Removed neighbours are one row, with
    another hash of their own and the number 0. mark: packed start and number of windows.
    """
    shared = docs.sparkSession.sparkContext.broadcast(of)

    def run(batches):
        for batch in batches:
            rids = batch.column(0).to_numpy()
            out = []
            for c in chunks(texts_of(batch), symbols, k):
                _, _, first, lens = paths(c, k, m)
                row, start = c.where(first)
                own = shared.value.may_have(rids[row], start)
                if own.any():
                    lo, ln = first[own], lens[own]
                    i = np.repeat(lo - np.append(0, np.cumsum(ln)[:-1]), ln) + np.arange(ln.sum())
                    out.append((_ONE.spans(_ONE.sums(c.values), i, i + k), _TWO.spans(_TWO.sums(second(c.values)), i, i + k), np.repeat(rids[row[own]], ln), i - np.repeat(lo - start[own], ln)))
            if not out:
                continue
            h1, h2, rid, start = (np.concatenate(x) for x in zip(*out))
            order = np.lexsort((start, rid, h2, h1))
            h1, h2, rid, start = h1[order], h2[order], rid[order], start[order]
            head = np.append(True, (h1[1:] != h1[:-1]) | (h2[1:] != h2[:-1]))
            times = np.diff(np.append(np.flatnonzero(head), len(h1)))
            gone = ~head if keep_first else np.repeat(times, times) > 1
            yield pa.RecordBatch.from_arrays([pa.array(as_long(h1[head])), pa.array(as_long(h2[head])), pa.array(times.astype(np.int32)), pa.array(rid[head]), pa.array(start[head].astype(np.int64) << 32 | 1)], names=WINDOW.names)
            rid, start = rid[gone], start[gone]
            if len(rid):
                order = np.lexsort((start, rid))
                rid, start = rid[order], start[order]
                cut = np.flatnonzero(np.append(True, (rid[1:] != rid[:-1]) | (start[1:] != start[:-1] + 1)))
                n = np.diff(np.append(cut, len(rid)))
                rid, start = rid[cut], start[cut]
                key = as_long(mix(rid.view(np.uint64) * np.uint64(31) + start.astype(np.uint64)))
                yield pa.RecordBatch.from_arrays([pa.array(key), pa.array(~key), pa.array(np.zeros(len(n), np.int32)), pa.array(rid), pa.array(start.astype(np.int64) << 32 | n)], names=WINDOW.names)

    return docs.select("rid", "text").mapInArrow(run, WINDOW)


def covered(n: int, marks: np.ndarray, k: int) -> np.ndarray:
    """Which of n symbols the marked windows cover. marks: packed places."""
    diff = np.zeros(n + 1, np.int64)
    start = marks >> 32
    np.add.at(diff, start, 1)
    np.add.at(diff, np.minimum(start + (marks & 0xFFFFFFFF) - 1 + k, n), -1)
    return np.cumsum(diff[:-1]) > 0
