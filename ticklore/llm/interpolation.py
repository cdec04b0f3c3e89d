"""LM scoring by deleted interpolation (operator 9).

Word n-grams (n up to `order`) are counted over all training texts, and mixed:
    P(w | h) = sum over n of weight[bucket of h][n] * P_n(w | h) + weight[..][0] / (V + 1)
P_n is the maximum-likelihood estimate, or that of the next lower order where the context was never seen. The buckets are
by the length of the longest context that was seen, and how often it was. The weights come from expectation-maximisation
on the held-out counts of one fold of the training texts, with that fold's counts deleted from the estimates.

All n-grams of all orders are counted, those seen once too, by a partitioned join: each part of the corpus asks for the
n-grams it holds, the ranges of their hashes add up what the parts have, and each part gets its counts. Requests and
answers travel as packed arrays, a row for each part and range; nothing that grows with the corpus is broadcast or
collected. Words are told apart by hashes of 61 bits, longer n-grams by hashes of SPARE bits more than it takes to number
the corpus' tokens (40 at least, 61 at most): of a hundred thousand of them a few are taken for another, whatever the size.

Null and empty texts are the end token alone. Each row is a document. Null doc_ids are trained on. Empty tables give no
rows. Columns other than doc_id and text are not read.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import LOWER_BYTES, Poly, keyed, mix, small_batches, table, word_bounds, written
from .toxicity import held_out

#: Bytes of text in a part; a part is one group of one task.
PART_BYTES = 12 << 20
#: N-grams, repeats in a part included, that a range of hashes holds in the mean; a range is one group of one task.
RANGE_GRAMS = 4_000_000
#: Buckets of each order of context, a factor of four in counts each.
STEPS = 8
TRAIN, FOLD, HELD = 0, 1, 2
#: Texts are hashed together up to so many bytes, and looked up together up to so many tokens; arrays then stay in the processor's cache.
HASHED, TOGETHER = 1 << 18, 1 << 16
_WORD = Poly(71)
#: Hash of the end token: no word has a blank in it.
END = _WORD.spans(_WORD.sums(_WORD.bytes[[32]]), np.array([0]), np.array([1])).view(np.int64)
#: Of a key, the two bits for TRAIN, FOLD or HELD, and the bit that tells single words.
SIDE, SINGLE = np.uint64(3), np.uint64(4)
#: Bits of an n-gram's hash beyond those that number all tokens of the corpus.
SPARE = 16


def sizes(docs: DataFrame) -> tuple[int, int, int, int]:
    """Bytes and tokens of all texts, and tokens of the training texts and of the fold among them."""

    def run(batches):
        for batch in batches:
            n_bytes, tokens = 0, [0, 0, 0]
            for text, fold in zip(batch.column(0).cast(pa.binary()).to_pylist(), batch.column(1).to_pylist()):
                n_bytes += len(text or b"")
                tokens[fold] += 1 + (len(word_bounds(np.frombuffer(text, np.uint8))[0]) if text else 0)
            yield pa.RecordBatch.from_arrays([pa.array([x]) for x in (n_bytes, sum(tokens), tokens[TRAIN] + tokens[FOLD], tokens[FOLD])], names=["b", "a", "t", "f"])

    r = docs.select("text", "fold").mapInArrow(run, "b long, a long, t long, f long").agg(*(F.sum(x).alias(x) for x in "batf")).first()
    return r.b or 0, r.a or 0, r.t or 0, r.f or 0


def words(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all tokens, the end of each text included; and how many each text has."""
    hashes, sizes, some, size = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)], [], 0
    for i, text in enumerate(texts):
        some.append(text)
        size += len(text)
        if size >= HASHED or i == len(texts) - 1:
            buf = LOWER_BYTES[np.frombuffer(b"\n".join(some), np.uint8)]
            lo, hi = word_bounds(buf)
            ends = np.searchsorted(lo, np.cumsum([len(t) + 1 for t in some]))
            hashes.append(np.insert(_WORD.spans(_WORD.sums(_WORD.bytes[buf]), lo, hi).view(np.int64), ends, END))
            sizes.append(np.diff(ends, prepend=0) + 1)
            some, size = [], 0
    return np.concatenate(hashes), np.concatenate(sizes)


def grams(hashes: np.ndarray, sizes: np.ndarray, order: int, bits: int = 61) -> np.ndarray:
    """(order, tokens) keys of the n-grams that end at each token, 0 where the text is too short; the SIDE bits are free.

    bits: of the keys of more than one word the highest so many are used, the others are 0.
    """
    cut = ~np.uint64((1 << (64 - bits)) - 1) & ~(SIDE | SINGLE)
    place = np.arange(len(hashes)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    word = hashes.view(np.uint64) & ~(SIDE | SINGLE) | SINGLE
    keys = [word]
    for n in range(2, order + 1):
        before = np.append(np.uint64(0), keys[-1][:-1])
        key = mix(before * np.uint64(0x9E3779B97F4A7C15) + word + np.uint64(n)) & ~(SIDE | SINGLE)
        keys.append(np.where(place >= n - 1, key, np.uint64(0)))
    return np.stack([word, *(k & cut for k in keys[1:])])


def heads(keys: np.ndarray) -> np.ndarray:
    """Where each run of equals begins."""
    return np.flatnonzero(np.append(True, keys[1:] != keys[:-1])) if len(keys) else np.zeros(0, np.int64)


def pack(a: np.ndarray) -> bytes:
    """Numbers not below 0, compressed byte plane by byte plane."""
    width = max(1, -(-int(a.max()).bit_length() // 8)) if len(a) else 1
    planes = np.ascontiguousarray(a.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :width].T)
    return bytes([width]) + zstandard.ZstdCompressor(level=3).compress(planes.tobytes())


def unpack(packed: bytes) -> np.ndarray:
    planes = np.frombuffer(zstandard.ZstdDecompressor().decompress(packed[1:]), np.uint8).reshape(packed[0], -1)
    out = np.zeros((planes.shape[1], 8), np.uint8)
    out[:, : packed[0]] = planes.T
    return out.view("<u8").ravel()


def gaps(keys: np.ndarray, free: int) -> bytes:
    """Sorted keys whose lowest `free` bits are 0."""
    return pack(np.diff(keys >> np.uint64(free), prepend=np.uint64(0)))


def summed(packed: bytes, free: int) -> np.ndarray:
    return np.cumsum(unpack(packed), dtype=np.uint64) << np.uint64(free)


def opened(texts) -> list[bytes]:
    press = zstandard.ZstdDecompressor()
    return [press.decompress(t) if t else b"" for t in texts]


def parted(docs: DataFrame, parts: int) -> DataFrame:
    """part, rid, fold, doc_id, text (compressed: this is what the one shuffle of the texts writes)."""

    def run(batches):
        press = zstandard.ZstdCompressor(level=6)
        for batch in batches:
            text = [press.compress(t) if t else None for t in batch.column(4).cast(pa.binary()).to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns[:4], pa.array(text, pa.binary())], names=["part", "rid", "fold", "doc_id", "text"])

    part = F.pmod(F.xxhash64("rid"), F.lit(parts)).cast("int").alias("part")
    return docs.select(part, "rid", "fold", "doc_id", "text").mapInArrow(run, "part int, rid long, fold int, doc_id long, text binary").repartition(parts, "part")


def bounds(ranges: int) -> np.ndarray:
    """The least key of each range but the first."""
    return np.array([(i << 64) // ranges for i in range(1, ranges)], np.uint64)


def asked(parted: DataFrame, order: int, ranges: int, bits: int) -> DataFrame:
    """part, range, words and keys (single words and longer n-grams, each sorted, as differences), n, fold_n (of words, then keys): which n-grams a part holds, and how often its training texts (and its fold texts) have them."""

    def ask(pdf: pd.DataFrame) -> pd.DataFrame:
        hashes, sizes = words(opened(pdf["text"]))
        keys = grams(hashes, sizes, order, bits)
        keys = np.where(keys > 0, keys | np.repeat(pdf["fold"].to_numpy(np.uint64), sizes), np.uint64(0)).ravel()
        keys = np.sort(keys[keys > 0])
        own, side = keys & ~SIDE, keys & SIDE
        head = heads(own)
        n, fold_n = (np.add.reduceat(x, head, dtype=np.int64) for x in (side != HELD, side == FOLD))
        own, out = own[head], []
        cut = np.concatenate([[0], np.searchsorted(own, bounds(ranges)), [len(own)]])
        for r, (a, b) in enumerate(zip(cut[:-1], cut[1:])):
            if a < b:
                single = own[a:b] & SINGLE > 0
                side = np.argsort(~single, kind="stable")
                out.append((pdf["part"].iloc[0], r, gaps(own[a:b][single], 0), gaps(own[a:b][~single], 64 - bits), pack(n[a:b][side]), pack(fold_n[a:b][side])))
        return pd.DataFrame(out, columns=["part", "range", "words", "keys", "n", "fold_n"])

    return parted.groupBy("part").applyInPandas(ask, "part int, range int, words binary, keys binary, n binary, fold_n binary")


def answered(want: DataFrame, bits: int) -> DataFrame:
    """part, range, n, fold_n: for each request, its n-grams' counts over all parts, in the order of all keys; vocabulary: in one row of each range, its words seen in training."""

    def add(pdf: pd.DataFrame) -> pd.DataFrame:
        each = [np.concatenate([summed(w, 0), summed(k, 64 - bits)]) for w, k in zip(pdf["words"], pdf["keys"])]
        keys = np.concatenate(each)
        order = np.argsort(keys)
        keys = keys[order]
        head = heads(keys)
        times = np.diff(np.append(head, len(keys)))
        cut, out = np.cumsum([len(k) for k in each])[:-1], {"part": pdf["part"], "range": pdf["range"]}
        for c in ("n", "fold_n"):
            sums = np.add.reduceat(np.concatenate([unpack(x) for x in pdf[c]]).astype(np.int64)[order], head)
            if c == "n":
                vocabulary = int(((keys[head] & SINGLE > 0) & (sums > 0)).sum())
            own = np.empty(len(keys), np.int64)
            own[order] = np.repeat(sums, times)
            if c == "fold_n":
                # Asked for by fold texts only; those hold the n-gram themselves.
                own[np.concatenate([unpack(x) for x in pdf[c]]) == 0] = 0
            out[c] = [pack(x[np.argsort(k)]) for x, k in zip(np.split(own, cut), each)]
        return pd.DataFrame({**out, "vocabulary": [vocabulary] + [0] * (len(pdf) - 1)})

    return want.groupBy("range").applyInPandas(add, "part int, range int, n binary, fold_n binary, vocabulary long")


CODED = "rid long, doc_id long, fold int, n_tokens long, n_known long, log_c double, counts binary, deleted binary, vocabulary long"


def coded(docs: DataFrame, parts: int, ranges: int, order: int, bits: int = 61) -> DataFrame:
    """Each text as counts (order, tokens) of the n-grams that end at its tokens. deleted (fold texts only): counts without the fold.

    vocabulary: sums up to the number of words seen in training.
    The texts are shuffled once: the same partitions ask for counts and get the answers.
    """
    own_part = parted(docs, parts)
    answer = answered(asked(own_part, order, ranges, bits).repartition(ranges, "range"), bits)

    def code(key, own: pd.DataFrame, got: pd.DataFrame) -> pd.DataFrame:
        hashes, sizes = words(opened(own["text"]))
        keys = grams(hashes, sizes, order, bits)
        got = got.sort_values("range")
        at = np.flatnonzero(keys)
        by = np.argsort(keys.ravel()[at])
        at = at[by]
        times = np.diff(np.append(heads(keys.ravel()[at]), len(at)))
        n, fold_n = np.zeros((2, keys.size), np.int64)
        for to, c in ((n, "n"), (fold_n, "fold_n")):
            to[at] = np.repeat(np.concatenate([unpack(x) for x in got[c]]).astype(np.int64), times)
        n, fold_n = n.reshape(keys.shape), fold_n.reshape(keys.shape)
        ends = np.cumsum(sizes)
        begin = ends - sizes
        known, base = np.add.reduceat(n[0] > 0, begin, dtype=np.int64), np.add.reduceat(np.log10(n[0] + 1), begin)
        out = []
        for i, (rid, doc_id, fold) in enumerate(zip(own["rid"], own["doc_id"], own["fold"])):
            s = slice(begin[i], ends[i])
            out.append((rid, doc_id, fold, int(sizes[i]), int(known[i]), float(base[i]), pack(n[:, s].ravel()), pack((n[:, s] - fold_n[:, s]).ravel()) if fold == FOLD else None, 0))
        df = pd.DataFrame(out, columns=[x.split()[0] for x in CODED.split(", ")])
        df["doc_id"] = df["doc_id"].astype("Int64")
        df["vocabulary"] = [int(got["vocabulary"].sum())] + [0] * (len(df) - 1)
        return df

    return own_part.groupBy("part").cogroup(answer.groupBy("part")).applyInPandas(code, CODED)


def unpacked(packed: list[bytes], order: int) -> tuple[np.ndarray, np.ndarray]:
    """Counts (order, tokens) of some texts side by side, and where each begins."""
    each = [unpack(x).astype(np.int64).reshape(order, -1) for x in packed]
    return np.concatenate(each, axis=1), np.cumsum([0, *(x.shape[1] for x in each[:-1])])


def estimates(counts: np.ndarray, first: np.ndarray, total: int, vocabulary: int) -> tuple[np.ndarray, np.ndarray]:
    """(orders + 1, tokens) estimates P_0 to P_n, and each token's bucket. first: where texts begin."""
    p = [np.full(counts.shape[1], 1 / (vocabulary + 1)), counts[0] / max(1, total)]
    bucket = np.zeros(counts.shape[1], np.int64)
    for n in range(2, len(counts) + 1):
        # An n-gram's context is the (n-1)-gram that ends at the token before, in the same text.
        whole = np.append(0, counts[n - 2][:-1])
        whole[first] = 0
        has = whole > 0
        whole = np.where(has, whole, 1)
        p.append(np.where(has, counts[n - 1] / whole, p[-1]))
        bucket = np.where(has, 1 + (n - 2) * STEPS + np.minimum(STEPS - 1, np.log2(whole) / 2).astype(np.int64), bucket)
    return np.stack(p), bucket


def together(n_tokens: np.ndarray) -> list[slice]:
    """Rows of a batch, so many at a time as have TOGETHER tokens, a longer one alone."""
    cut = np.flatnonzero(np.diff(np.cumsum(n_tokens) // TOGETHER)) + 1
    return [slice(a, b) for a, b in zip(np.append(0, cut), np.append(cut, len(n_tokens))) if a < b]


def weights(coded_: DataFrame, order: int, total: int, vocabulary: int, rounds: int = 40) -> np.ndarray:
    """(buckets, orders + 1), by EM on the fold's tokens: a histogram of their estimates, in steps of a third of a power of two.

    total: training tokens without the fold's.
    """
    names = ["bucket", *(f"p{i}" for i in range(1, order + 1))]

    def run(batches):
        for batch in batches:
            rows = []
            gone = batch.column(0).to_pylist()
            for s in together(batch.column(1).to_numpy()):
                p, bucket = estimates(*unpacked(gone[s], order), total, vocabulary)
                rows.append(np.vstack([bucket, np.where(p[1:] > 0, np.round(3 * np.log2(np.maximum(p[1:], 1e-30))), -999)]))
            if rows:
                bins, n = np.unique(np.concatenate(rows, axis=1).astype(np.int32), axis=1, return_counts=True)
                yield pa.RecordBatch.from_arrays([*(pa.array(b) for b in bins), pa.array(n, pa.int64())], names=[*names, "n"])

    bins = coded_.filter(F.col("fold") == FOLD).select("deleted", "n_tokens").mapInArrow(run, ", ".join(f"{x} int" for x in names) + ", n long").groupBy(*names).agg(F.sum("n").alias("n")).toPandas()  # bounded by the number of bins
    buckets = 1 + (order - 1) * STEPS
    w = np.full((buckets, order + 1), 1 / (order + 1))
    if len(bins):
        p = np.vstack([np.full(len(bins), 1 / (vocabulary + 1)), *(np.where(bins[f"p{i}"] == -999, 0, 2.0 ** (bins[f"p{i}"] / 3)) for i in range(1, order + 1))])
        b, n = bins["bucket"].to_numpy(), bins["n"].to_numpy(float)
        for _ in range(rounds):
            part = w[b].T * p
            part *= n / part.sum(axis=0)
            # One more token than seen for each weight: none becomes 0.
            sums = np.stack([np.bincount(b, x, buckets) for x in part], axis=1) + 1
            w = sums / sums.sum(axis=1, keepdims=True)
    return w


SCORED = "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"


def lm_score(docs: DataFrame, order: int = 3, mod: int = 7, rest: int = 2, part_bytes: int = PART_BYTES) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score (add-one unigrams) and score (log10) for each row.

    mod, rest: which rows are held out of learning; the rows of the next remainder are the fold that the weights are learned on.
    """
    small_batches(docs.sparkSession)
    rows = keyed(docs)
    fold = F.when(held_out(F.col("doc_id"), mod, rest), HELD).when(held_out(F.col("doc_id"), mod, (rest + 1) % mod), FOLD).otherwise(TRAIN)
    rows = rows.withColumn("fold", fold)
    n_bytes, tokens, total, fold_total = sizes(rows)
    bits = min(61, max(24, tokens.bit_length()) + SPARE)
    told = written(coded(rows, max(1, -(-n_bytes // part_bytes)), max(8, -(-order * tokens // RANGE_GRAMS)), order, bits), "coded")
    vocabulary = told.agg(F.sum("vocabulary")).first()[0] or 0
    w = weights(told, order, total - fold_total, vocabulary)
    base = np.log10(total + vocabulary + 1)

    def run(batches):
        for batch in batches:
            score, packed, n = [np.zeros(0)], batch.column(5).to_pylist(), batch.column(2).to_numpy()
            for s in together(n):
                counts, first = unpacked(packed[s], order)
                p, bucket = estimates(counts, first, total, vocabulary)
                score.append(np.add.reduceat(np.log10((w[bucket].T * p).sum(axis=0)), first))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), batch.column(2), batch.column(3), pa.array(np.full(len(n), total, np.int64)), pa.array(batch.column(4).to_numpy() - n * base), pa.array(np.concatenate(score))], names=[x.split()[0] for x in SCORED.split(", ")])

    return told.select("doc_id", (F.col("fold") == HELD).alias("held_out"), "n_tokens", "n_known", "log_c", "counts").mapInArrow(run, SCORED)


def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm_score(table(spark, sf_dir, "documents"))
