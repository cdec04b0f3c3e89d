"""Shards of near equal bytes by histogram sort (operator 13). Law: `bytes`.

Rows are ordered by the hash of their text, then doc_id (nulls first), then a row number, so equal texts are neighbours and no
two keys are equal. The splitters that cut this order into shards are found by rounds of counting: each round counts, over all
rows, the exact bytes and rows below a few candidate keys (probes) in each open interval, and keeps of each interval what holds its target.
A splitter is done once its bytes are within the tolerance (a share of a mean shard) of the target; or when one row is
left in its interval, whose nearer side it takes. Probes lie between texts first, so a group of equal texts is cut only where
no side of it is within the tolerance: a group of a third of all rows is dealt over as many shards as its bytes ask for.
Then whole rows move once, by range of (shard, key), to a folder for each shard, in the order of their slots.

Sizes are UTF-8 bytes of the text plus 8; a null text has none. Two shards differ by no more than the tolerance and one row on either side,
whatever that row's length. An empty table gives no rows; with fewer rows than shards some shards stay empty. Repeated rows, null
and repeated doc_ids are rows as any other. Other columns come through unread, whatever their names.

What the driver holds: a few counts for each probe, PROBES for each splitter, at any size of input.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, LongType, StructField, StructType

from .common import columns, made, release, scratch, table, written

SHARDS, TOLERANCE = 24, 0.01
#: Candidate keys that a round counts in each open interval.
PROBES = 48
#: Bytes of text that a task of the exchange takes.
TASK_BYTES = 64 << 20
LEAST = -(1 << 63)
KEY = ("h", "d", "t")


@dataclass(frozen=True)
class Cut:
    """A place in the order: all rows with lesser keys stand below it, with so many bytes and rows."""

    key: tuple[int, int, int]
    size: int
    rows: int


def numbered(docs: DataFrame) -> DataFrame:
    """The key, the size and the whole row, written once: rounds and exchange see the same numbers, lost executors or not."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    d = F.coalesce(F.col("doc_id").cast("long"), F.lit(LEAST))
    return written(docs.select(F.xxhash64(text).alias("h"), d.alias("d"), F.monotonically_increasing_id().alias("t"), (F.octet_length(text) + 8).cast("long").alias("size"), F.struct("*").alias("row")), "sharding")


def below(rows: DataFrame, probes: list[tuple[int, int, int]]) -> list[tuple[int, int]]:
    """Exact bytes and rows below each of the sorted keys. Every task adds up its rows between neighbouring keys and gives a line for each."""
    cuts = np.array(probes, np.int64).reshape(-1, 3)
    k = len(cuts)

    def count(batches):
        size, n = np.zeros(k + 1, np.int64), np.zeros(k + 1, np.int64)
        for b in batches:
            key = [np.concatenate([cuts[:, i], b.column(i).to_numpy()]) for i in range(3)]
            order = np.lexsort(key[::-1])  # stable: a probe stands before a row of its own key
            place = np.empty(len(order), np.int64)
            place[order] = np.cumsum(order < k)
            place = place[k:]
            n += np.bincount(place, minlength=k + 1)
            got = np.zeros(k + 1, np.int64)
            np.add.at(got, place, b.column(3).to_numpy())
            size += got
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(k + 1, dtype=np.int32)), pa.array(size), pa.array(n)], ["slot", "size", "n"])

    told = rows.select(*KEY, "size").mapInArrow(count, "slot int, size long, n long").groupBy("slot").agg(F.sum("size"), F.sum("n"))
    sums = np.zeros((k + 1, 2), np.int64)
    slot, size, n = columns(told)
    sums[slot] = np.stack([size, n], axis=1)
    return [(int(a), int(b)) for a, b in np.cumsum(sums, axis=0)[:k]]


def candidates(lo: tuple[int, int, int], hi: tuple[int, int, int], least: tuple, most: tuple, want: int = PROBES) -> list[tuple[int, int, int]]:
    """Keys inside an interval, evenly spaced: between texts while it holds several, then between ids of one text, then between rows of one id."""
    for i in range(3):
        a, b = (lo[i], hi[i]) if lo[i] != hi[i] else (lo[i], lo[i] + 1)
        if b - a > 1:
            n = min(want, b - a - 1)
            steps = sorted({a + (b - a) * j // (n + 1) for j in range(1, n + 1)} - {a})
            return [(*lo[:i], s, *least[i + 1 :]) for s in steps]
        # One value of this column is left: what is open lies between two of the next column.
        hi = hi if hi[i] == lo[i] else (*lo[: i + 1], *most[i + 1 :])
    return []


def splitters(rows: DataFrame, shards: int = SHARDS, tolerance: float = TOLERANCE) -> list[Cut]:
    """The cuts between shards, in order."""
    ends = [f(c) for c in KEY for f in (F.min, F.max)]
    (*span, size, n) = rows.agg(*ends, F.sum("size"), F.count("*")).first()
    if not n:
        return []
    least, most = tuple(span[::2]), tuple(x + 1 for x in span[1::2])
    start, end = Cut(least, 0, 0), Cut((most[0], *least[1:]), size, n)
    # size * k / shards, in whole numbers: all is compared times shards.
    open_, done, free = {k: (start, end) for k in range(1, shards)}, {}, tolerance * size / shards
    while open_:
        asked = {k: candidates(lo.key, hi.key, least, most) for k, (lo, hi) in open_.items()}
        keys = sorted({p for some in asked.values() for p in some})
        known = {p: Cut(p, *got) for p, got in zip(keys, below(rows, keys))} if keys else {}
        for k, (lo, hi) in list(open_.items()):
            told = [lo, *(known[p] for p in asked[k]), hi]
            at = max(i for i, c in enumerate(told) if c.size * shards <= size * k and i < len(told) - 1)
            lo, hi = told[at], told[at + 1]
            near = min(lo, hi, key=lambda c: abs(c.size * shards - size * k))
            if abs(near.size - size * k / shards) <= free or hi.rows - lo.rows <= 1 or not asked[k]:
                done[k] = near
                del open_[k]
            else:
                open_[k] = (lo, hi)
    return [done[k] for k in sorted(done)]


def shard_of(cuts: list[Cut]) -> Column:
    """How many cuts stand at or before the row's key."""
    h, d, t = (F.col(c) for c in KEY)
    at = lambda c: (h > c[0]) | ((h == c[0]) & ((d > c[1]) | ((d == c[1]) & (t >= c[2]))))
    return sum((at(c.key).cast("int") for c in cuts), F.lit(0))


def sharded(docs: DataFrame, shards: int = SHARDS, tolerance: float = TOLERANCE) -> DataFrame:
    """row (the whole input row), size, shard, slot: read back from a folder for each shard, where rows lie in the order of their slots."""
    spark, since = docs.sparkSession, made()
    rows = numbered(docs)
    cuts = splitters(rows, shards, tolerance)
    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), shards, -(-2 * shards * cuts[-1].size // max(1, TASK_BYTES * (shards - 1))) if cuts else 1)
    order = ["shard", *KEY]
    moved = rows.withColumn("shard", shard_of(cuts)).repartitionByRange(parts, *order).sortWithinPartitions(*order)
    path = scratch(spark, "shards")
    # place: the task's number and the row's number in it, so files tell the order without a further sort.
    moved.select("row", "size", F.monotonically_increasing_id().alias("place"), "shard").write.option("compression", "zstd").partitionBy("shard").parquet(path)
    release(spark, since, but=path)
    kinds = StructType([rows.schema["row"], rows.schema["size"], StructField("place", LongType()), StructField("shard", IntegerType())])
    return slotted(spark.read.schema(kinds).parquet(path))


def slotted(told: DataFrame) -> DataFrame:
    """Slots from places: rows of a shard in earlier tasks, counted, and those before it in its own. A line for each task and shard is all that is ranked."""
    task = F.shiftright("place", 33)
    each = told.groupBy("shard", task.alias("task")).agg(F.min("place").alias("first"), F.count("*").alias("n"))
    before = F.sum("n").over(Window.partitionBy("shard").orderBy("task")) - F.col("n")
    starts = each.select("shard", "task", (before - F.col("first")).alias("shift"))
    # As many lines as there were tasks, and one more for each shard.
    return told.withColumn("task", task).join(F.broadcast(starts), ["shard", "task"]).select("row", "size", "shard", (F.col("place") + F.col("shift")).alias("slot"))


def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in 24 shards of near equal bytes."""
    text = F.coalesce(F.col("row.text"), F.lit(""))
    return sharded(table(spark, sf_dir, "documents")).select(
        F.col("row.doc_id").alias("doc_id"), (F.octet_length(text) + 8).cast("long").alias("size"), F.crc32(text.cast("binary")).alias("text_crc32"),
        F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"),
    )
