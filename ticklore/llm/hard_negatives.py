"""Hard-negative mining with an STR-packed R-tree (operator 11).

Rows are tiled over all tasks by range: into slabs by label and the coordinate that varies most, then by the next one, so that neighbours
share a task; a task packs runs of at most TREE_ROWS rows into trees: sort-tile-recursive leaves of LEAF rows, FAN nodes under each node above.
A node keeps the minimum bounding box of its rows, label included. With q an anchor's vector, a coordinate's products lie between the lesser
and the greater of q * lo and q * hi, and their sums bound all inner products in the box.

A search takes a chunk of like queries through a tree by a best-first queue: the box with the greatest upper bound comes next, for those queries
of the chunk that it may still serve. A query leaves a box out if its labels cannot fit, if the interval lies outside the query's window of scores,
or if the upper bound is strictly below the query's k-th score so far. First pass: each anchor's best rows of its own label (positives). Second
pass: for each anchor and positive, the best rows of other labels in the positive's window. Both passes see every row; results are exact.

Queries are taken in blocks of about BLOCK anchors, each broadcast and searched against all trees; a task gives k rows for a query at most, and
the best k of all tasks are ranked in groups of that size. The work is queries times what pruning leaves; in many dimensions that is most rows.

Scores are whole: products are added up in double precision where every sum stays below 2**53, else as 64-bit integers, without bounds. Ties go by
vec_id, then by row. Rows without label, vector or vec_id, with a null, NaN or infinite entry, or an empty vector take no part; neither do rows with an entry whose
square times the dimensions exceeds a long, or with another length than most vectors (of two lengths equally common, the greater).
Rows with one vec_id are rows of their own, and may be each other's positives. A positive below zero has an empty window. An empty table gives no rows. Other columns are not read.
"""

from __future__ import annotations

import heapq

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import columns, table, written

SCALE = 256
POSITIVES, NEGATIVES = 5, 3
#: A negative's score lies between these hundredths of the positive's.
LOW, HIGH = 50, 95
#: Rows of a tree, of a leaf; nodes under a node.
TREE_ROWS, LEAF, FAN = 4096, 128, 8
#: Anchors that a block holds, about; queries that go through a tree together.
BLOCK, CHUNK = 8192, 64
#: Coordinates that rows are tiled by.
TILED = 3
TREE = "n int, d int, x binary, ids binary, rids binary, labels binary, edges binary"
FOUND = "q int, score long, vec_id long, rid long"


def prepared(vectors: DataFrame, vector: str = "embedding") -> DataFrame:
    """rid, vec_id, label, x: the rows that take part, entries as whole numbers; written once."""
    v = F.col(vector)
    # The limit follows from the length: d squares have to fit a long.
    limit = F.floor(F.sqrt(F.lit(float(1 << 62)) / F.size(v)) / SCALE)
    sound = v.isNotNull() & (F.size(v) > 0) & F.forall(v, lambda c: F.coalesce(F.abs(c.cast("double")) < limit, F.lit(False)))
    rows = vectors.filter(sound & F.col("label").isNotNull() & F.col("vec_id").isNotNull())
    rows = rows.select(F.monotonically_increasing_id().alias("rid"), F.col("vec_id").cast("long").alias("vec_id"), F.col("label").cast("long").alias("label"), F.transform(v, lambda c: F.floor(c.cast("double") * SCALE).cast("long")).alias("x"))
    done = written(rows, "vectors")
    most = done.groupBy(F.size("x").alias("d")).count().orderBy(F.desc("count"), F.desc("d")).first()
    return done.filter(F.size("x") == (most["d"] if most else 0))


def tiles(keys: list[np.ndarray], rows: np.ndarray, leaf: int) -> list[np.ndarray]:
    """Sort-tile-recursive: rows cut into slabs by the first key, those by the next, down to leaves."""
    if len(rows) <= leaf:
        return [rows]
    rows = rows[np.argsort(keys[0][rows], kind="stable")]
    pages = -(-len(rows) // leaf)
    each = leaf * -(-pages // round(np.ceil(pages ** (1 / len(keys))))) if len(keys) > 1 else leaf
    return [t for at in range(0, len(rows), each) for t in tiles(keys[1:] or keys, rows[at : at + each], leaf)]


def pack(rows: list[np.ndarray], axes: list[int]) -> tuple:
    """A tree of rid, vec_id, label, x: rows in the order of the leaves, and where the leaves begin. Large labels have leaves of their own."""
    rids, ids, labels, x = rows
    keys = [x[:, a] for a in axes]
    own, n = np.unique(labels, return_counts=True)
    parts = [tiles(keys, np.flatnonzero(labels == v), LEAF) for v in own[n >= LEAF]]
    if len(few := np.flatnonzero(~np.isin(labels, own[n >= LEAF]))):
        parts.append(tiles([labels, *keys], few, LEAF))
    leaves = [t for p in parts for t in p]
    order, edges = np.concatenate(leaves), np.cumsum([0, *map(len, leaves)])
    return len(order), x.shape[1], x[order].tobytes(), ids[order].tobytes(), rids[order].tobytes(), labels[order].tobytes(), edges.astype(np.int64).tobytes()


def build(rows: DataFrame) -> DataFrame:
    """A row for each tree."""
    spread = rows.select(F.posexplode("x").alias("i", "c")).groupBy("i").agg(F.var_pop("c").alias("v")).orderBy(F.desc("v"), "i").limit(TILED)
    axes = [r.i for r in spread.collect()]
    n = rows.count()
    trees = max(1, -(-n // TREE_ROWS))
    slabs = max(1, round(trees**0.5))
    at = lambda i: F.get("x", F.lit(axes[i % len(axes)])) if axes else F.lit(0)
    # rid ends both orders, so rows with one vector are dealt like any others.
    slab = written(rows.repartitionByRange(slabs, "label", at(0), "rid").withColumn("slab", F.spark_partition_id()), "slabs")
    tiled = slab.repartitionByRange(trees, "slab", "label", at(1), "rid")

    def packed(batches):
        held, size = [], 0
        for b in batches:
            for at in range(0, b.num_rows, TREE_ROWS // 4):
                part = b.slice(at, TREE_ROWS // 4)
                held.append([*(part.column(i).to_numpy() for i in range(3)), part.column(3).flatten().to_numpy().reshape(part.num_rows, -1)])
                size += part.num_rows
                if size > TREE_ROWS * 3 // 4:
                    yield one(held)
                    held, size = [], 0
        if held:
            yield one(held)

    def one(held):
        tree = pack([np.concatenate(c) for c in zip(*held)], axes)
        return pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip(tree, (pa.int32(), pa.int32(), *[pa.binary()] * 5))], [c.split()[0] for c in TREE.split(", ")])

    return written(tiled.select("rid", "vec_id", "label", "x").mapInArrow(packed, TREE), "trees", 16)


class Tree:
    """Rows in the order of the leaves; levels of boxes from the leaves up. A node of a level has FAN nodes of the one below."""

    def __init__(self, n, d, x, ids, rids, labels, edges):
        whole = lambda b: np.frombuffer(b, np.int64)
        self.x, self.ids, self.rids, self.labels, self.edges = whole(x).reshape(n, d), whole(ids), whole(rids), whole(labels), whole(edges)
        begin = self.edges[:-1]
        box = [f.reduceat(a, begin, axis=0) for a in (self.x, self.labels) for f in (np.minimum, np.maximum)]
        self.levels = [box]
        while len(box[0]) > 1:
            begin = np.arange(0, len(box[0]), FAN)
            box = [f.reduceat(a, begin, axis=0) for f, a in zip((np.minimum, np.maximum) * 2, box)]
            self.levels.append(box)
        self.most = int(np.abs(self.x).max())
        self.real = self.x.astype(float)

    def bounds(self, q: np.ndarray, level: int, nodes: slice) -> tuple[np.ndarray, np.ndarray]:
        """Least and greatest inner product of each query with each box."""
        lo, hi = (b[nodes].astype(float).T for b in self.levels[level][:2])
        up, down = np.maximum(q, 0), np.minimum(q, 0)
        return up @ lo + down @ hi, up @ hi + down @ lo


class Queries:
    """Vectors, own labels and rows, windows of scores; whether rows of the same label are asked, or of others; how many."""

    def __init__(self, x, labels, rids, low, high, same: bool, k: int):
        self.x, self.labels, self.rids, self.low, self.high, self.same, self.k = x, labels, rids, low, high, same, k
        self.real, self.most = x.astype(float), int(np.abs(x).max(initial=0))
        self.best: list[list[tuple[int, int, int]]] = [[] for _ in x]  # (-score, vec_id, rid), the best first
        self.kth = np.full(len(x), -(1 << 63), np.int64)

    def take(self, i: int, score: np.ndarray, ids: np.ndarray, rids: np.ndarray) -> None:
        self.best[i] = heapq.nsmallest(self.k, self.best[i] + list(zip((-score).tolist(), ids.tolist(), rids.tolist())))
        if len(self.best[i]) == self.k:
            self.kth[i] = -self.best[i][-1][0]


def through(tree: Tree, asked: Queries, chunk: np.ndarray) -> None:
    """One chunk of queries through one tree, best box first."""
    exact = asked.x.shape[1] * asked.most * tree.most < 1 << 53
    q, own = asked.real[chunk], asked.labels[chunk]
    queue: list[tuple[float, int, int, np.ndarray]] = []

    def offer(level: int, first: int, last: int, who: np.ndarray) -> None:
        nodes = slice(first, min(last, len(tree.levels[level][0])))
        least, most = (b[nodes] for b in tree.levels[level][2:])
        mine = own[who][:, None]
        fits = (least <= mine) & (mine <= most) if asked.same else (least != mine) | (most != mine)
        lo, hi = tree.bounds(q[who], level, nodes) if exact else (np.full(fits.shape, -np.inf), np.full(fits.shape, np.inf))
        fits = fits & (hi >= asked.low[chunk[who]][:, None]) & (lo <= asked.high[chunk[who]][:, None])
        for j in np.flatnonzero(fits.any(axis=0)):
            some = fits[:, j]
            heapq.heappush(queue, (-hi[some, j].max(), level, nodes.start + int(j), who[some], hi[some, j]))

    offer(len(tree.levels) - 1, 0, 1, np.arange(len(chunk)))
    while queue:
        _, level, node, who, most = heapq.heappop(queue)
        who = who[most >= asked.kth[chunk[who]]]
        if not len(who):
            continue
        if level:
            offer(level - 1, node * FAN, (node + 1) * FAN, who)
            continue
        rows, at = slice(tree.edges[node], tree.edges[node + 1]), chunk[who]
        score = (q[who] @ tree.real[rows].T).astype(np.int64) if exact else asked.x[at] @ tree.x[rows].T
        match = (tree.labels[rows] == own[who][:, None]) == asked.same
        match &= (score >= np.maximum(asked.low[at], asked.kth[at])[:, None]) & (score <= asked.high[at][:, None])
        match &= tree.rids[rows] != asked.rids[at][:, None]
        for i in np.flatnonzero(match.any(axis=1)):
            asked.take(at[i], score[i, match[i]], tree.ids[rows][match[i]], tree.rids[rows][match[i]])


def search(trees: DataFrame, x: np.ndarray, labels: np.ndarray, rids: np.ndarray, low: np.ndarray, high: np.ndarray, same: bool, k: int) -> DataFrame:
    """q (place of the query), rank, score, vec_id, rid: the best k rows of all trees for each query."""
    sent = trees.sparkSession.sparkContext.broadcast((x, labels, rids, low, high))
    order = np.lexsort((x[:, np.argmax(x.var(axis=0))], labels)) if len(x) else np.arange(0)

    def task(batches):
        asked = Queries(*sent.value, same, k)
        for b in batches:
            for row in b.to_pylist():
                tree = Tree(**row)
                for at in range(0, len(order), CHUNK):
                    through(tree, asked, order[at : at + CHUNK])
        q = np.repeat(np.arange(len(asked.best)), [len(r) for r in asked.best])
        flat = np.array([r for own in asked.best for r in own], np.int64).reshape(-1, 3)
        yield pa.RecordBatch.from_arrays([pa.array(q, pa.int32()), pa.array(-flat[:, 0]), pa.array(flat[:, 1]), pa.array(flat[:, 2])], ["q", "score", "vec_id", "rid"])

    w = Window.partitionBy("q").orderBy(F.desc("score"), "vec_id", "rid")  # k rows of each task at most
    return trees.mapInArrow(task, FOUND).withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= k)


def mine(rows: DataFrame, anchors: Column, positives: int = POSITIVES, negatives: int = NEGATIVES) -> DataFrame:
    """rows: as prepared() gives them. anchor_id, positive_id, rank, negative_id, positive_score, negative_score."""
    trees = build(rows)
    asked = rows.filter(anchors)
    blocks = max(1, -(-asked.count() // BLOCK))
    found = [_block(trees, asked.filter(F.pmod(F.xxhash64("rid"), F.lit(blocks)) == b), positives, negatives) for b in range(blocks)]
    for more in found[1:]:
        found[0] = found[0].unionByName(more)
    return found[0]


def _block(trees: DataFrame, asked: DataFrame, positives: int, negatives: int) -> DataFrame:
    """Of about BLOCK anchors, whose vectors and positives the driver holds meanwhile."""
    spark = trees.sparkSession
    anchors = asked.toArrow()
    rids, ids, labels = (anchors[c].to_numpy().astype(np.int64) for c in ("rid", "vec_id", "label"))
    x = np.array(anchors["x"].to_pylist(), np.int64).reshape(len(rids), -1 if len(rids) else 0)
    most = np.full(len(rids), (1 << 63) - 1)
    q, score, positive = columns(search(trees, x, labels, rids, -most, most, True, positives).select("q", "score", "vec_id").filter("score >= 0"))
    low = -(-LOW * score.astype(object) // 100).astype(np.int64)
    high = (HIGH * score.astype(object) // 100).astype(np.int64)
    told = search(trees, x[q], labels[q], rids[q], low, high, False, negatives)
    units = spark.createDataFrame(pd.DataFrame({"q": np.arange(len(q), dtype=np.int32), "anchor_id": ids[q], "positive_id": positive, "positive_score": score}), "q int, anchor_id long, positive_id long, positive_score long")
    # As many rows as the block has anchors and positives.
    return written(told.join(F.broadcast(units), "q").select("anchor_id", "positive_id", "rank", F.col("vec_id").alias("negative_id"), "positive_score", F.col("score").alias("negative_score")), "negatives")


def relabelled(vectors: DataFrame) -> DataFrame:
    """Where vec_id is divisible by 7, the next of ten labels."""
    return vectors.withColumn("label", F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label")))


def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hard negatives of every fiftieth embedding, among all."""
    return mine(prepared(relabelled(table(spark, sf_dir, "embeddings").select("vec_id", "embedding", "label"))), F.col("vec_id") % 50 == 0)


OP11_SQL = f"""WITH v AS (SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label, list_transform(embedding, lambda c: floor(256 * c::DOUBLE)::BIGINT) AS x FROM embeddings
    WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda c: c IS NULL OR NOT isfinite(c))) = 0),
  s AS (SELECT a.vec_id AS anchor_id, b.vec_id AS other_id, a.label = b.label AS same, list_sum(list_transform(list_zip(a.x, b.x), lambda z: z[1] * z[2]))::BIGINT AS score FROM v a JOIN v b ON a.vec_id <> b.vec_id WHERE a.vec_id % 50 = 0),
  p AS (SELECT * FROM s WHERE same QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, other_id) <= {POSITIVES})
  SELECT p.anchor_id, p.other_id AS positive_id, row_number() OVER (PARTITION BY p.anchor_id, p.other_id ORDER BY n.score DESC, n.other_id)::INT AS rank, n.other_id AS negative_id, p.score AS positive_score, n.score AS negative_score
  FROM p JOIN s n ON n.anchor_id = p.anchor_id AND NOT n.same AND {LOW} * p.score <= 100 * n.score AND 100 * n.score <= {HIGH} * p.score QUALIFY rank <= {NEGATIVES}"""
