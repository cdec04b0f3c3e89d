"""SimHash near-dedup with vantage-point trees (operator 4).

The upper levels of one tree are built from a bounded sample of the distinct fingerprints; its leaves are the shards.
Every distinct fingerprint lives in one shard and is also sent to those shards that its ball of radius `bits` overlaps by
the triangle inequality. Inside a shard a smaller tree prunes in the same way, and what is left is compared bit by bit.
So the links are exact; the samples only decide how even the shards are. Leaves of over `shard_rows` grow trees of their own,
from a sample of each, as long as a vantage point splits them. A leaf that none splits is cut into parts, and each two of its
parts meet in a group. No group exceeds `shard_rows` rows by much. Each returns a spanning forest of its links, never all pairs.

Null and empty texts have fingerprint zero and are linked like any other. Rows that share a text share a fingerprint. Null doc_ids never
name a component (a component of none but null doc_ids has a null name). Columns other than doc_id and text are not read.
"""

from __future__ import annotations

import itertools
import pickle

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import LOWER_BYTES, Poly, among, columns, keyed, mix, small_batches, table, word_bounds, written
from .graph import components
from .spans import texts_of

#: Fingerprints that the driver builds the tree from.
SAMPLE = 65_536
LEAF_ROWS, SHARD_ROWS, BRUTE = 8_192, 32_768, 1_024
#: Fingerprints that a leaf's own tree is built from, about; how often leaves grow; inner nodes that the tree may have before leaves are cut instead.
LEAF_SAMPLE, GROWTHS, TREE_NODES = 1_024, 4, 1 << 18


def shingle_hashes(text: bytes, words: int) -> np.ndarray:
    """XXH64 (seed 42) of each word shingle; of the whole word sequence where it is shorter."""
    w = text.lower().split()  # bytes: A-Z, and ASCII white space
    if not w:
        return np.zeros(0, np.uint64)
    joined = b" ".join(w)
    ends = np.cumsum([len(x) + 1 for x in w])
    lo = np.append(0, ends[:-1])[: max(1, len(w) - words + 1)]
    hi = ends[words - 1 :] - 1 if len(w) >= words else ends[-1:] - 1
    return np.fromiter((xxhash.xxh64_intdigest(joined[a:b], 42) for a, b in zip(lo.tolist(), hi.tolist())), np.uint64, len(lo))


def simhash(h: np.ndarray) -> int:
    """A bit is set if it is in over half of the hashes; zero without any."""
    ones = np.zeros(64, np.int64)
    for i in range(0, len(h), 1 << 16):
        ones += np.unpackbits(h[i : i + (1 << 16)].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > len(h), bitorder="little").view(np.uint64)[0])


def fingerprint(texts: list[bytes], words: int) -> np.ndarray:
    """64-bit SimHash of each text's word shingles, repeats included."""
    return np.array([simhash(shingle_hashes(t, words)) for t in texts], np.uint64)


def fingerprints(docs: DataFrame, words: int) -> DataFrame:
    """doc_id, fp (a signed long) for each row."""
    small_batches(docs.sparkSession)

    def run(batches):
        for batch in batches:
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(fingerprint(texts_of(batch), words).view(np.int64))], names=["doc_id", "fp"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInArrow(run, "doc_id long, fp long")


def apart(a: np.ndarray, b) -> np.ndarray:
    return np.bitwise_count(a ^ b).astype(np.int64)


def vantage(points: np.ndarray) -> tuple[np.uint64, int]:
    """Of a few candidates, the point and the radius that split best without many points near the radius."""
    best = None
    for vp in points[:: max(1, len(points) // 8)][:8]:
        d = apart(points, vp)
        for mu in {int(np.median(d)), int(np.median(d)) - 1, *np.quantile(d, (0.3, 0.7)).astype(int).tolist()}:
            inner = (d <= mu).mean()
            cost = max(inner, 1 - inner) + ((d > mu - 2) & (d <= mu + 2)).mean()
            if 0 < inner < 1 and (best is None or cost < best[0]):
                best = cost, vp, mu
    return (points[0], -1) if best is None else best[1:]


def build(points: np.ndarray, depth: int):
    """Nested (vantage point, radius, inner, outer); leaves are None."""
    if depth == 0 or len(points) < 16:
        return None
    vp, mu = vantage(points)
    if mu < 0:
        return None
    inner = apart(points, vp) <= mu
    return int(vp), mu, build(points[inner], depth - 1), build(points[~inner], depth - 1)


def routes(tree, fps: np.ndarray, bits: int) -> list[tuple[int, np.ndarray, np.ndarray]]:
    """(leaf, which of fps live there, which others look in there). A pair meets once: the inner one of a split looks outward."""
    out, todo, leaf = [], [(tree, np.arange(len(fps)), np.ones(len(fps), bool))], 0
    while todo:
        node, at, home = todo.pop()
        if node is None:
            out.append((leaf, at[home], at[~home]))
            leaf += 1
            continue
        vp, mu, left, right = node
        d = apart(fps[at], np.uint64(vp))
        inner = d <= mu
        to_left = np.where(home, inner, d - bits <= mu)
        to_right = np.where(home, ~inner | (d + bits > mu), d + bits > mu)
        todo.append((right, at[to_right], (home & ~inner)[to_right]))
        todo.append((left, at[to_left], home[to_left]))
    return out


class Forest:
    """Union by least index, on arrays of links."""

    def __init__(self, n: int):
        self.top = np.arange(n)

    def roots(self) -> np.ndarray:
        while True:
            up = self.top[self.top]
            if (up == self.top).all():
                return up
            self.top = up

    def link(self, a: np.ndarray, b: np.ndarray) -> None:
        while len(a):
            top = self.roots()
            ra, rb = top[a], top[b]
            open_ = ra != rb
            a, b, ra, rb = a[open_], b[open_], ra[open_], rb[open_]
            np.minimum.at(self.top, np.maximum(ra, rb), np.minimum(ra, rb))


def close_pairs(forest: Forest, values: np.ndarray, members: np.ndarray, askers: np.ndarray, bits: int) -> None:
    """Links all members and askers (indexes into values) that are at most `bits` apart."""
    if not len(members) or not len(askers):
        return
    if len(members) > BRUTE:
        vp, mu = vantage(values[members])
        if mu >= 0:
            dm, da = apart(values[members], vp), apart(values[askers], vp)
            close_pairs(forest, values, members[dm <= mu], askers[da - bits <= mu], bits)
            close_pairs(forest, values, members[dm > mu], askers[da + bits > mu], bits)
            return
    step = max(1, (1 << 20) // len(members))
    for i in range(0, len(askers), step):
        a, m = np.nonzero(np.bitwise_count(values[askers[i : i + step], None] ^ values[None, members]) <= bits)
        forest.link(askers[i + a], members[m])


def shard_links(pdf: pd.DataFrame, bits: int) -> pd.DataFrame:
    """A spanning forest (u, v) of the links between the members of a group and all that look in; of two parts, between one and the other only."""
    values, at = np.unique(pdf["fp"].to_numpy().view(np.uint64), return_inverse=True)
    member, first = np.zeros(len(values), bool), np.zeros(len(values), bool)
    member[at[pdf["member"].to_numpy()]] = True
    first[at[pdf["first"].to_numpy()]] = True
    forest = Forest(len(values))
    if pdf["i"].iloc[0] == pdf["j"].iloc[0]:
        close_pairs(forest, values, np.flatnonzero(member), np.arange(len(values)), bits)
    else:
        for side in (first, ~first):
            close_pairs(forest, values, np.flatnonzero(member & side), np.flatnonzero(~side), bits)
    top = forest.roots()
    own = np.flatnonzero(top != np.arange(len(top)))
    return pd.DataFrame({"u": values[own].view(np.int64), "v": values[top[own]].view(np.int64)})


def spread(fps: np.ndarray) -> np.ndarray:
    """31 bits of each fingerprint's hash."""
    return (fps * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(33)).astype(np.int64)


def grafted(tree, grown: dict, count):
    """The tree with subtrees in place of some leaves, which are numbered as routes() does."""
    if tree is None:
        return grown.get(next(count))
    vp, mu, left, right = tree
    left = grafted(left, grown, count)
    return vp, mu, left, grafted(right, grown, count)


def inner_nodes(tree) -> int:
    return 0 if tree is None else 1 + inner_nodes(tree[2]) + inner_nodes(tree[3])


def leaf_sizes(nodes: DataFrame, tree, bits: int) -> dict[int, tuple[int, int]]:
    """Rows that live in each leaf, and rows that look in: a row for each leaf, whose number TREE_NODES bounds."""

    def run(batches):
        for batch in batches:
            told = [(leaf, len(home), len(guest)) for leaf, home, guest in routes(tree, batch.column(0).to_numpy().view(np.uint64), bits) if len(home) or len(guest)]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*told) if told else ((),) * 3, (pa.int32(), pa.int64(), pa.int64()))], names=["leaf", "home", "guest"])

    return {r.leaf: (r.home, r.guest) for r in nodes.mapInArrow(run, "leaf int, home long, guest long").groupBy("leaf").agg(F.sum("home").alias("home"), F.sum("guest").alias("guest")).collect()}


def grow(nodes: DataFrame, tree, large: dict[int, int], bits: int, leaf_rows: int):
    """The tree with one of its own for each leaf of `large` (leaf: rows), from about LEAF_SAMPLE of the leaf's rows by hash, built a leaf a task."""
    share = {leaf: min(1.0, LEAF_SAMPLE / n) * 2**31 for leaf, n in large.items()}

    def pick(batches):
        for batch in batches:
            fps = batch.column(0).to_numpy().view(np.uint64)
            for leaf, home, _ in routes(tree, fps, bits):
                some = fps[home][spread(fps[home]) < share.get(leaf, 0)]
                if len(some):
                    yield pa.RecordBatch.from_arrays([pa.array(np.full(len(some), leaf, np.int32)), pa.array(some.view(np.int64))], names=["leaf", "fp"])

    def own(pdf):
        leaf = int(pdf["leaf"].iloc[0])
        sub = build(np.sort(pdf["fp"].to_numpy().view(np.uint64)), int(np.ceil(np.log2(large[leaf] / leaf_rows))))
        return pd.DataFrame({"leaf": [leaf], "tree": [pickle.dumps(sub)]})

    found = nodes.mapInArrow(pick, "leaf int, fp long").groupBy("leaf").applyInPandas(own, "leaf int, tree binary").collect()
    return grafted(tree, {r.leaf: pickle.loads(r.tree) for r in found}, itertools.count())


def shards(nodes: DataFrame, bits: int, leaf_rows: int = LEAF_ROWS, shard_rows: int = SHARD_ROWS) -> DataFrame:
    """nodes: distinct fp. leaf, i, j, fp, member, first: the groups whose rows are compared. first: of part i, where i and j differ."""
    n = nodes.count()
    some = nodes.orderBy(F.xxhash64("fp")).limit(SAMPLE).toPandas()["fp"].to_numpy().view(np.uint64)
    tree = build(some, max(0, int(np.ceil(np.log2(max(1, n / leaf_rows))))))
    sizes = leaf_sizes(nodes, tree, bits)
    for _ in range(GROWTHS):
        large = {leaf: home for leaf, (home, _) in sizes.items() if home > shard_rows}
        grown = grow(nodes, tree, large, bits, leaf_rows) if large else tree
        if not inner_nodes(tree) < inner_nodes(grown) <= TREE_NODES:
            break
        tree, sizes = grown, leaf_sizes(nodes, grown, bits)
    parts = {leaf: int(np.ceil(2.2 * (home + guest) / shard_rows)) for leaf, (home, guest) in sizes.items() if home and home + guest > shard_rows}
    lived = {leaf for leaf, (home, _) in sizes.items() if home}

    def place(batches):
        for batch in batches:
            fps = batch.column(0).to_numpy().view(np.uint64)
            for leaf, home, guest in routes(tree, fps, bits):
                fp, member, k = np.concatenate([fps[home], fps[guest]]), np.arange(len(home) + len(guest)) < len(home), parts.get(leaf, 1)
                if not len(fp) or leaf not in lived:
                    continue
                own = (spread(fp) % k).astype(np.int32)
                for other in range(k):
                    i, j = np.minimum(own, other).astype(np.int32), np.maximum(own, other).astype(np.int32)
                    yield pa.RecordBatch.from_arrays([pa.array(np.full(len(fp), leaf, np.int32)), pa.array(i), pa.array(j), pa.array(fp.view(np.int64)), pa.array(member), pa.array(own == i)], names=["leaf", "i", "j", "fp", "member", "first"])

    return nodes.mapInArrow(place, "leaf int, i int, j int, fp long, member boolean, first boolean")


def close_links(nodes: DataFrame, bits: int, leaf_rows: int = LEAF_ROWS, shard_rows: int = SHARD_ROWS) -> DataFrame:
    """nodes: distinct fp. Edges (u, v) whose components are those of all pairs at most `bits` apart."""
    return shards(nodes, bits, leaf_rows, shard_rows).groupBy("leaf", "i", "j").applyInPandas(lambda pdf: shard_links(pdf, bits), "u long, v long")


def simhash_dedup(docs: DataFrame, words: int = 5, bits: int = 3, leaf_rows: int = LEAF_ROWS, shard_rows: int = SHARD_ROWS) -> DataFrame:
    """doc_id, fingerprint (16 hex digits), component_id (the least doc_id that links reach) for each row."""
    each = written(fingerprints(docs, words), "fingerprints")
    nodes = written(each.groupBy("fp").agg(F.min("doc_id").alias("least")), "nodes")
    links = components(close_links(nodes.select("fp"), bits, leaf_rows, shard_rows))
    named = nodes.join(links, nodes["fp"] == links["node"], "left").select("fp", "least", F.coalesce("component", "fp").alias("component"))
    least = named.groupBy("component").agg(F.min("least").alias("component_id"))
    classes = written(named.join(least, "component").select("fp", "component_id"), "classes")
    return each.join(classes, "fp").select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


#: Least shingle hashes by which documents are first brought together: of documents of a similarity of 0.8, all but 3 in a million share one of eight. The rest is found by rest_links().
KEYS = 8
#: Bits by which the fingerprints and the sign bits of such documents differ at most: five standard deviations above the mean of each.
WIDE, SIGNS = 26, 19
#: Rows of a group, and shingles of a row, that block_pairs() reckons with.
GROUP_ROWS, ROW_SHINGLES = 4_096, 1_000
#: Documents that tell which shingles are common, about, and how many of those are told; ranges of hashes whose parities a sketch holds; rows of a part of a key.
COMMON_ROWS, COMMON, PARITIES, PART_ROWS = 8_192, 1 << 18, 512, 2_000
_WORD, _RUN = Poly(83), Poly(97)


def shingle_set(text: bytes, words: int) -> np.ndarray:
    """Sorted hashes of the distinct word shingles; of the whole word sequence where it is shorter."""
    buf = LOWER_BYTES[np.frombuffer(text, np.uint8)]
    lo, hi = word_bounds(buf)
    if not len(lo):
        return np.zeros(0, np.uint64)
    sums = _RUN.sums(_WORD.spans(_WORD.sums(_WORD.bytes[buf]), lo, hi))
    if len(lo) < words:
        return _RUN.spans(sums, np.array([0]), np.array([len(lo)]))
    return np.unique(_RUN.windows(sums, words))


def sign_bits(h: np.ndarray) -> int:
    """A bit for each of 64 ranges of sorted hashes: the last one of the least hash there, 0 where there is none."""
    at, first = np.unique(h >> np.uint64(58), return_index=True)
    return int(np.bitwise_or.reduce((h[first] & np.uint64(1)) << at, initial=np.uint64(0)))


def least_common(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The least key that rows of a and b share (0 is none)."""
    both = (a[:, :, None] == b[:, None, :]).any(axis=2) & (a != 0)
    return np.where(both, a, np.iinfo(np.int64).max).min(axis=1)


def close_marks(pdf: pd.DataFrame, similarity: float) -> pd.DataFrame:
    """Of the rows of a key's two parts those that may have a similar partner among the others. A pair is looked at under its least common key only."""
    pdf = pdf.sort_values("member", ascending=False).drop_duplicates("node")
    fps, signs = (pdf[c].to_numpy().view(np.uint64) for c in ("fp", "signs"))
    n, key, member = pdf["n"].to_numpy(), pdf["key"].iloc[0], np.flatnonzero(pdf["member"].to_numpy())
    keys = np.zeros((len(pdf), KEYS), np.int64)
    for i, k in enumerate(pdf["keys"]):
        keys[i, : len(k)] = k
    others = np.arange(len(member), len(pdf)) if len(member) < len(pdf) else member  # members come first
    told = np.zeros(len(pdf), bool)
    step = max(1, (1 << 20) // max(1, len(member)))
    for i in range(0, len(others), step):
        own = others[i : i + step, None]
        a, b = np.nonzero((np.bitwise_count(fps[own] ^ fps[None, member]) <= WIDE) & (np.bitwise_count(signs[own] ^ signs[None, member]) <= SIGNS))
        a, b = own[a, 0], member[b]
        keep = (a != b) & ~(told[a] & told[b]) & (np.minimum(n[a], n[b]) >= similarity * np.maximum(n[a], n[b]) - 1e-9)
        a, b = a[keep], b[keep]
        for j in range(0, len(a), 1 << 15):
            x, y = a[j : j + (1 << 15)], b[j : j + (1 << 15)]
            ok = least_common(keys[x], keys[y]) == key
            told[x[ok]] = told[y[ok]] = True
    out = pdf.loc[told, ["key", "i", "j", "node"]]
    return out


def alike_links(pdf: pd.DataFrame, similarity: float) -> pd.DataFrame:
    """A spanning forest (u, v) of the pairs of a group whose whole sets of shingles are at least so similar."""
    pdf = pdf.drop_duplicates("node")
    nodes, sets = pdf["node"].to_numpy(), [np.frombuffer(x, np.uint64) for x in pdf["shingles"]]
    size = np.array([len(x) for x in sets])
    all_, number = np.unique(np.concatenate(sets), return_inverse=True)
    order = np.argsort(number, kind="stable")
    owner, times = np.repeat(np.arange(len(sets)), size)[order], np.bincount(number, minlength=len(all_))
    begin, at, forest = np.cumsum(times) - times, np.append(0, np.cumsum(size)), Forest(len(sets))
    for a in range(len(sets)):
        top = forest.roots()
        if (top == top[0]).all():
            break
        t = number[at[a] : at[a + 1]]
        t = t[times[t] > 1]
        where = np.repeat(begin[t] - np.append(0, np.cumsum(times[t])[:-1]), times[t]) + np.arange(times[t].sum()) if len(t) else np.zeros(0, np.int64)
        both = np.bincount(owner[where], minlength=len(sets))
        ok = np.flatnonzero((both >= similarity * (size[a] + size - both) - 1e-9) & (both > 0) & (top != top[a]))
        forest.link(np.full(len(ok), a), ok)
    top = forest.roots()
    own = np.flatnonzero(top != np.arange(len(top)))
    return pd.DataFrame({"u": nodes[own], "v": nodes[top[own]]})


def block_pairs(met: DataFrame, shard_rows: int) -> DataFrame:
    """met: node, key, weight (rows of the key), and others. Adds i, j, member: the rows of parts i and j of a key meet, about shard_rows at most.

    Of the two parts, that of i are the members; each pair of parts meets once.
    """
    parts = F.when(F.col("weight") > shard_rows, F.ceil(F.col("weight") * 2.2 / shard_rows)).otherwise(1).cast("int")
    own = met.withColumn("parts", parts).withColumn("own", F.pmod(F.xxhash64("node"), F.col("parts")).cast("int")).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
    return own.withColumn("i", F.least("own", "other")).withColumn("j", F.greatest("own", "other")).withColumn("member", F.col("own") == F.col("i")).drop("parts", "own", "other", "weight")


def parities(h: np.ndarray, ranges: int = PARITIES) -> np.ndarray:
    """A bit for each of so many ranges of hashes: whether it holds an odd number of them. As bytes. Sets differ by at least as many hashes as bits."""
    return np.packbits((np.bincount((h % np.uint64(ranges)).astype(np.int64), minlength=ranges) & 1).astype(np.uint8))


def bits_apart(a: np.ndarray, b: np.ndarray) -> int:
    """By how many bits parities() differ, those of more ranges folded to those of fewer; the ranges are powers of two."""
    while len(a) != len(b):
        a, b = sorted((a, b), key=len)
        b = b[: len(b) // 2] ^ b[len(b) // 2 :]
    return int(np.bitwise_count(a ^ b).sum())


def common_shingles(rows: DataFrame, words: int, n: int) -> np.ndarray:
    """Shingles that several of about COMMON_ROWS rows hold, sorted. They come last in the order of prefixes: which they are changes the work, not the pairs."""

    def run(batches):
        for batch in batches:
            for text in texts_of(batch):
                yield pa.RecordBatch.from_arrays([pa.array(shingle_set(text, words).view(np.int64))], names=["h"])

    some = rows.filter(F.pmod(F.xxhash64("rid"), F.lit(1 << 31)) < int(min(1.0, COMMON_ROWS / max(1, n)) * (1 << 31))).select("rid", "text")
    told = some.mapInArrow(run, "h long").groupBy("h").count().filter("count > 1").orderBy(F.desc("count"), "h").limit(COMMON).select("h")
    return np.sort(columns(told)[0].view(np.uint64))


def rest_links(rows: DataFrame, named: DataFrame, n: int, words: int, similarity: float) -> DataFrame:
    """named: node, component. Links (u, v) of similar sets that lie in different components, all of them.

    Sets that are similar share a shingle among the first (1 - similarity) n + 1 of each, in any order that is one for all. Pairs that do are
    left out only where their sizes, or the parities of their hashes, say that they differ by too much; the others are decided on the whole sets.
    """
    common = rows.sparkSession.sparkContext.broadcast(common_shingles(rows, words, n))
    longs = PARITIES // 64

    def run(batches):
        for batch in batches:
            sizes, keys, bits = [], [], []
            for text in texts_of(batch):
                h = shingle_set(text, words)
                at = np.minimum(np.searchsorted(common.value, h), max(0, len(common.value) - 1))
                often = common.value[at] == h if len(common.value) else np.zeros(len(h), bool)
                first = len(h) - int(np.ceil(similarity * len(h) - 1e-9)) + 1 if len(h) else 0
                sizes.append(len(h))
                keys.append(np.concatenate([h[~often], h[often]])[:first].view(np.int64))
                bits.append(parities(h).view(np.int64))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(sizes, pa.int32()), pa.array(keys, pa.list_(pa.int64())), pa.array(bits, pa.list_(pa.int64()))], names=["node", "n", "keys", "bits"])

    told = rows.select("rid", "text").mapInArrow(run, "node long, n int, keys array<long>, bits array<long>")
    told = written(told.join(named, "node").select("node", "component", "n", "keys", *[F.get("bits", F.lit(i)).alias(f"b{i}") for i in range(longs)]), "prefixes")
    keys = told.select("node", "component", F.explode("keys").alias("key"))
    # A key whose rows are of one component has nothing more to tell.
    shared = keys.groupBy("key").agg(F.count("*").alias("times"), F.min("component").alias("a"), F.max("component").alias("b")).filter("a <> b").select("key", F.ceil(F.col("times") / PART_ROWS).cast("int").alias("parts"))
    met = written(keys.select("node", "key").join(shared, "key"), "shared").join(told.drop("keys"), "node")
    # Each two parts of a key meet, so that none of its groups has more than about PART_ROWS rows a side.
    dealt = met.withColumn("part", F.pmod(F.xxhash64("node"), F.col("parts")).cast("int")).withColumn("meets", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
    info = ["node", "component", "n", *[f"b{i}" for i in range(longs)]]
    left = dealt.select("key", F.col("part").alias("i"), F.col("meets").alias("j"), *[F.col(c).alias(f"u_{c}") for c in info])
    right = dealt.select("key", F.col("meets").alias("i"), F.col("part").alias("j"), *[F.col(c).alias(f"v_{c}") for c in info])
    apart = sum((F.bit_count(F.col(f"u_b{i}").bitwiseXOR(F.col(f"v_b{i}"))) for i in range(longs)), F.lit(0))
    least, most = F.least("u_n", "v_n"), F.greatest("u_n", "v_n")
    may = (F.col("u_node") < F.col("v_node")) & (F.col("u_component") != F.col("v_component")) & (least >= most * similarity - 1e-9) & (apart <= (F.col("u_n") + F.col("v_n")) * ((1 - similarity) / (1 + similarity)) + 1e-6)
    pairs = written(left.join(right, ["key", "i", "j"]).filter(may).select(F.col("u_node").alias("u"), F.col("v_node").alias("v")).distinct(), "pairs")

    def wide(h):
        return parities(h, 1 << max(9, (2 * len(h)).bit_length()))

    def told_by(tell):
        def run(batches):
            for batch in batches:
                each = [shingle_set(t, words) for t in texts_of(batch)]
                yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([len(h) for h in each], pa.int32()), pa.array([tell(h).tobytes() for h in each], pa.binary())], names=["node", "n", "told"])

        return run

    def decided(pairs, tell, test, name):
        """The pairs whose two sets, each told as tell() says, pass test(n, told of one, n, told of the other)."""
        asked = among(rows, pairs.select(F.col("u").alias("rid")).unionByName(pairs.select(F.col("v").alias("rid"))), "rid").select("rid", "text")
        asked = written(asked.mapInArrow(told_by(tell), "node long, n int, told binary"), name)
        side = lambda c: asked.select(F.col("node").alias(c), F.col("n").alias(f"{c}_n"), F.col("told").alias(f"{c}_told"))

        def decide(batches):
            for batch in batches:
                one = [[(n.as_py(), x.as_buffer()) for n, x in zip(batch.column(i), batch.column(i + 1))] for i in (2, 4)]
                yield batch.select(["u", "v"]).filter(pa.array([test(*x, *y) for x, y in zip(*one)], pa.bool_()))

        return pairs.join(side("u"), "u").join(side("v"), "v").select("u", "v", "u_n", "u_told", "v_n", "v_told").mapInArrow(decide, "u long, v long")

    def may_be(n, x, m, y):
        return bits_apart(np.frombuffer(x, np.uint8), np.frombuffer(y, np.uint8)) <= (n + m) * (1 - similarity) / (1 + similarity) + 1e-6

    def alike(n, x, m, y):
        both = len(np.intersect1d(np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64), assume_unique=True))
        return both >= similarity * (n + m - both) - 1e-9

    # Of long sets as many parities as they need: a thirtieth of the sets. Few pairs are left for the sets themselves.
    close = written(decided(pairs, wide, may_be, "wide"), "close")
    return decided(close, lambda h: h, alike, "asked")


def near_dedup(docs: DataFrame, words: int = 5, similarity: float = 0.8, shard_rows: int = GROUP_ROWS, unique: bool = False) -> DataFrame:
    """doc_id, component_id for each row: components of documents whose sets of word shingles are at least so similar.

    At that similarity fingerprints differ by 10 bits in the mean, where no ball is smaller than the space and no tree can prune.
    So documents meet by their KEYS least shingle hashes first; within a key, SimHash fingerprints and sign bits of the sets leave out
    what is far off, and what stays is decided on the whole sets. That joins nearly all that belongs together; what it may have missed,
    rest_links() finds between the components: no pair is lost. Groups are of bounded size: a key of many rows is split, and all
    pairs of its parts meet. Equal sets are one node throughout. Documents without words are copies of each other; rows that share
    a doc_id are documents of their own; null doc_ids never name a component. unique: as in keyed().
    """
    small_batches(docs.sparkSession)
    rows = keyed(docs, unique)

    def run(batches):
        for batch in batches:
            out = []
            for text in texts_of(batch):
                h = shingle_set(text, words)
                out.append((int(h.sum(dtype=np.uint64)), int(mix(h).sum(dtype=np.uint64)), len(h), simhash(h), sign_bits(h), h[:KEYS].view(np.int64).tolist()))
            h1, h2, n, fp, signs, keys = zip(*out) if out else ((),) * 6
            long = lambda x: pa.array(np.array(x, np.uint64).view(np.int64))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), long(h1), long(h2), pa.array(n, pa.int32()), long(fp), long(signs), pa.array(keys, pa.list_(pa.int64()))], names=["rid", "doc_id", "h1", "h2", "n", "fp", "signs", "keys"])

    same = ["h1", "h2", "n"]
    each = written(rows.select("rid", "doc_id", "text").mapInArrow(run, "rid long, doc_id long, h1 long, h2 long, n int, fp long, signs long, keys array<long>"), "shingled")
    nodes = written(each.groupBy(*same).agg(F.min("rid").alias("node"), F.min("doc_id").alias("least"), F.first("fp").alias("fp"), F.first("signs").alias("signs"), F.first("keys").alias("keys")), "nodes")
    weight = F.greatest(F.count("*"), (F.sum("n") / ROW_SHINGLES).cast("long"))
    sizes = nodes.select("n", F.explode("keys").alias("key")).groupBy("key").agg(weight.alias("weight"), F.count("*").alias("times")).filter("times > 1").drop("times")
    met = nodes.select("node", "n", "fp", "signs", "keys", F.explode("keys").alias("key")).join(sizes, "key")
    marks = written(block_pairs(met, shard_rows).groupBy("key", "i", "j").applyInPandas(lambda pdf: close_marks(pdf, similarity), "key long, i int, j int, node long"), "marks")

    def sets(batches):
        for batch in batches:
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([shingle_set(t, words).tobytes() for t in texts_of(batch)], pa.binary())], names=["node", "shingles"])

    asked = among(rows, marks.select(F.col("node").alias("rid")), "rid").select("rid", "text").mapInArrow(sets, "node long, shingles binary")
    links = marks.join(asked, "node").groupBy("key", "i", "j").applyInPandas(lambda pdf: alike_links(pdf, similarity), "u long, v long")
    near = components(links)
    first = written(nodes.select("node").join(near, "node", "left").select("node", F.coalesce("component", "node").alias("component")), "first")
    rest = written(rest_links(rows, first, each.count(), words, similarity), "rest")
    if rest.limit(1).count():
        near = components(near.select(F.col("node").alias("u"), F.col("component").alias("v")).unionByName(rest))
    named = nodes.select(*same, "node", "least").join(near.withColumnRenamed("component", "c"), "node", "left").select(*same, "least", F.coalesce("c", "node").alias("component"))
    least = named.groupBy("component").agg(F.min("least").alias("component_id"))
    classes = written(named.join(least, "component").select(*same, "component_id"), "classes")
    return each.select("doc_id", *same).join(classes, same).select("doc_id", "component_id")


def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash_dedup(table(spark, sf_dir, "documents"), words=3, bits=2)
