"""Helpers that the corpus operators share: scratch tables, row keys, batch sizes, tokenless hashing."""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ticklore.sources.shared import shared_path

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Bytes, A-Z lower-cased.
_BYTES = np.arange(256, dtype=np.uint8)
LOWER_BYTES = np.where((_BYTES >= 65) & (_BYTES <= 90), _BYTES + np.uint8(32), _BYTES)
#: Rows that one Arrow batch holds; documents are long, so this is far below Spark's default.
BATCH_ROWS = 256
#: Bytes of text that are hashed at once inside a task.
CHUNK_BYTES = 4 << 20

#: Ids that a list sent to all executors may have: 16 MB of them.
LISTED = 2_000_000

_made: list[str] = []


def scratch(spark: SparkSession, name: str) -> str:
    """A new path in the folder that all executors share."""
    _made.append(shared_path(spark, name))
    return _made[-1]


def made() -> int:
    """How many paths scratch() has given so far, for release()."""
    return len(_made)


def release(spark: SparkSession, since: int, but: str = "") -> None:
    """Deletes the tables in the paths given since then, but one. Only for what no DataFrame in use reads any more."""
    own, _made[since:] = _made[since:], [but] if but in _made[since:] else []
    for path in own:
        if path != but:
            at = spark._jvm.org.apache.hadoop.fs.Path(path)
            at.getFileSystem(spark._jsc.hadoopConfiguration()).delete(at, True)


def _listed(ids: DataFrame, key: str) -> DataFrame:
    told = written(ids.select(key).distinct(), "ids")
    return F.broadcast(told) if told.count() <= LISTED else told


def without(rows: DataFrame, ids: DataFrame, key: str) -> DataFrame:
    """Rows whose key is not among the ids. Up to LISTED ids are sent to all executors, more are joined by a shuffle."""
    return rows.join(_listed(ids, key), key, "left_anti")


def among(rows: DataFrame, ids: DataFrame, key: str) -> DataFrame:
    """Rows whose key is among the ids; as without()."""
    return rows.join(_listed(ids, key), key, "left_semi")


def written(df: DataFrame, name: str, file_rows: int = 0) -> DataFrame:
    """The same rows, read back from a table in the shared folder: cuts the lineage, and survives lost executors.

    file_rows: rows that a file holds at most, where each is large; 0 for no bound.
    """
    path = scratch(df.sparkSession, name)
    df.write.option("compression", "zstd").option("maxRecordsPerFile", file_rows).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def columns(df: DataFrame) -> list[np.ndarray]:
    """The columns of a bounded result as arrays. By Arrow: rows as Python objects would take ten times the driver's memory."""
    told = df.toArrow()
    return [c.to_numpy() for c in told.columns]


def small_batches(spark: SparkSession) -> None:
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def keyed(docs: DataFrame, unique: bool = False) -> DataFrame:
    """(rid, doc_id, text): rid is a non-null long, unique for each row, and ordered as doc_id.

    Unique non-null doc_ids serve as they are. Else rows are numbered once, in a written table, in the order doc_id
    (nulls last), then text: every row counts as a document of its own, repeated rows included. unique: the caller
    knows that they are unique and not null, so they need not be counted.
    """
    narrow = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    if unique or not narrow.groupBy("doc_id").count().filter("count > 1 OR doc_id IS NULL").limit(1).count():
        return narrow.select(F.col("doc_id").alias("rid"), "doc_id", "text")
    ordered = narrow.repartitionByRange(F.col("doc_id").asc_nulls_last(), F.xxhash64("text")).sortWithinPartitions(F.col("doc_id").asc_nulls_last(), F.xxhash64("text"), "text")
    return written(ordered.select(F.monotonically_increasing_id().alias("rid"), "doc_id", "text"), "keyed")


def ascii_lower(c: Column) -> Column:
    """A-Z to a-z and nothing else."""
    return F.when(F.octet_length(c) == F.length(c), F.lower(c)).otherwise(F.translate(c, UPPER, LOWER))


class Poly:
    """Polynomial hashes mod 2**64 of many spans at once, from prefix sums. Every symbol value is a random 64-bit number."""

    def __init__(self, seed: int):
        rng = np.random.default_rng(seed)
        self.base = int(rng.integers(1 << 62, 1 << 63)) | 5
        self.inverse = pow(self.base, -1, 1 << 64)
        self.bytes = rng.integers(0, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
        self._up = self._down = np.ones(0, np.uint64)

    def _powers(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(self._up) < n:
            size = max(n, 1 << 19)
            for name, b in (("_up", self.base), ("_down", self.inverse)):
                p = np.full(size, b, np.uint64)
                p[0] = 1
                setattr(self, name, np.cumprod(p, dtype=np.uint64))
        return self._up, self._down

    def sums(self, values: np.ndarray) -> np.ndarray:
        up, _ = self._powers(len(values) + 1)
        out = np.zeros(len(values) + 1, np.uint64)
        np.cumsum(values * up[: len(values)], out=out[1:])
        return out

    def spans(self, sums: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> np.ndarray:
        _, down = self._powers(len(sums))
        return mix((sums[hi] - sums[lo]) * down[lo] + (hi - lo).astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))

    def windows(self, sums: np.ndarray, size: int, mixed: bool = True) -> np.ndarray:
        """Of all spans of that many symbols."""
        _, down = self._powers(len(sums))
        n = max(0, len(sums) - size)
        h = sums[size:] - sums[:n]
        h *= down[:n]
        return mix(h) if mixed else h


def mix(h: np.ndarray) -> np.ndarray:
    h = h ^ (h >> np.uint64(32))
    h = h * np.uint64(0xD6E8FEB86659FD93)
    h ^= h >> np.uint64(29)
    h *= np.uint64(0xC2B2AE3D27D4EB4F)
    h ^= h >> np.uint64(32)
    return h


def word_bounds(buf: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the words [^\\x20\\x09-\\x0D]+ in UTF-8 bytes."""
    gap = np.ones(len(buf) + 2, bool)
    gap[1:-1] = (buf == 32) | ((buf >= 9) & (buf <= 13))
    edge = np.flatnonzero(gap[1:] != gap[:-1])
    return edge[::2], edge[1::2]


def sliding_min(a: np.ndarray, w: int) -> np.ndarray:
    """Minimum of each w neighbours, by running minima of blocks from either side."""
    n = len(a)
    if n < w:
        return a[:0]
    pad = -n % w
    b = np.concatenate([a, np.full(pad, np.iinfo(a.dtype).max, a.dtype)]).reshape(-1, w)
    left = np.minimum.accumulate(b, axis=1).ravel()
    right = np.minimum.accumulate(b[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(right[: n - w + 1], left[w - 1 : n])
