"""Line dedup over levelled sorted runs of line hashes (operator 3). DataFrame functions only.

A run is a table (h1, h2, n) in buckets of its key, sorted: in how many documents of its batch a line key stands. A new
batch is put in buckets once, and merge-anti-joins the settled keys (those known to be frequent) and then every run, which
are read in their order, so that nothing else is shuffled or sorted. What no run holds is added as a run of level 0; what
one does is a tally beside it. When a level holds `fanout` runs, they and their tallies are merged into one run of the next
level, and keys that reach `min_docs` move to the settled ones.

Null and empty texts are one empty line. Keys shorter than `min_chars` are never counted, so blank lines stay. Each row
is a document: repeated rows count again. Empty tables give no rows. Columns other than doc_id and text are not read.
"""

from __future__ import annotations

import uuid
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import ascii_lower, keyed, scratch, table, written

BLANKS = " \t\n\x0b\f\r"
KEY = ["h1", "h2"]
#: Rows of a batch that a bucket holds, as long as that takes no more buckets than Spark allows; then more.
BUCKET_ROWS, MOST_BUCKETS = 250_000, 100_000


def lines_of(text: Column) -> Column:
    return F.split(F.coalesce(text, F.lit("")), "\n", -1)


def key_of(line: Column) -> Column:
    return ascii_lower(F.btrim(line, F.lit(BLANKS)))


def hashes(key: Column) -> Column:
    """128 bits from two seeds."""
    return F.struct(F.xxhash64(key).alias("h1"), F.xxhash64(F.lit(1), key).alias("h2"))


def in_buckets(rows: DataFrame, name: str, buckets: int) -> DataFrame:
    """The same rows, read back from buckets by KEY in the shared folder: one sorted file each where rows come in that many parts by KEY."""
    spark = rows.sparkSession
    called = f"{name}_{uuid.uuid4().hex}".replace("-", "_")
    rows.write.option("path", scratch(spark, name)).option("compression", "zstd").bucketBy(buckets, *KEY).sortBy(*KEY).saveAsTable(called)
    told = spark.table(called)
    spark.sql(f"DROP TABLE {called}")  # the name only: the files lie in the folder given
    return told


def merge_anti(rows: DataFrame, run: DataFrame) -> DataFrame:
    return rows.join(run.select(*KEY).hint("merge"), KEY, "left_anti")


class LineRuns:
    """The levels. Each add() takes (h1, h2, n) of one batch."""

    def __init__(self, spark: SparkSession, min_docs: int = 10, fanout: int = 4, batch_rows: int = 1_000_000):
        """batch_rows: rows of a batch, about; they tell the number of buckets."""
        # Buckets of one file each are read in their order only if this is set.
        spark.conf.set("spark.sql.legacy.bucketedTableScan.outputOrdering", "true")
        self.buckets = max(1, min(MOST_BUCKETS, -(-batch_rows // BUCKET_ROWS)))
        self.min_docs, self.fanout = min_docs, fanout
        self.levels: list[list[DataFrame]] = []
        #: What batches told of keys that a run held already, by level.
        self.tallies: list[list[DataFrame]] = []
        self.settled: list[DataFrame] = []

    def add(self, batch: DataFrame) -> None:
        own = in_buckets(batch.repartition(self.buckets, *KEY), "lines-batch", self.buckets)
        left = reduce(merge_anti, self.settled, own)
        older = [r for level in self.levels for r in level]
        fresh = in_buckets(reduce(merge_anti, older, left), "lines-0", self.buckets)
        again = in_buckets(merge_anti(left, fresh), "lines-again", self.buckets) if older else None
        self._put(0, fresh, again)

    def _put(self, level: int, run: DataFrame, tally: DataFrame | None = None) -> None:
        if level == len(self.levels):
            self.levels.append([])
            self.tallies.append([])
        self.levels[level].append(run)
        if tally is not None:
            self.tallies[level].append(tally)
        if len(self.levels[level]) >= self.fanout:
            self._compact(level)

    def _compact(self, level: int) -> None:
        merged = in_buckets(summed(self.levels[level] + self.tallies[level]), f"lines-merged-{level}", self.buckets)
        self.levels[level], self.tallies[level] = [], []
        self.settled.append(in_buckets(merged.filter(F.col("n") >= self.min_docs), "lines-settled", self.buckets))
        self._put(level + 1, merged.filter(F.col("n") < self.min_docs))

    def frequent(self) -> DataFrame | None:
        """Keys of at least min_docs documents in all batches so far."""
        parts = [r for level in self.levels + self.tallies for r in level]
        found = [r.select(*KEY) for r in self.settled]
        if parts:
            found.append(summed(parts).filter(F.col("n") >= self.min_docs).select(*KEY))
        return reduce(DataFrame.unionByName, found).distinct() if found else None


def summed(parts: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, parts).groupBy(*KEY).agg(F.sum("n").alias("n"))


def dropped(rows: DataFrame, min_docs: int = 10, min_chars: int = 1, batches: int = 4, fanout: int = 2) -> DataFrame:
    """rid, drops: the numbers of the lines that go, for each document that loses any. rows: rid, text."""
    keys = F.transform(lines_of(F.col("text")), lambda x: key_of(x))
    long_enough = rows.select("rid", F.filter(F.array_distinct(keys), lambda k: F.length(k) >= min_chars).alias("keys"))
    each = long_enough.select(F.pmod(F.xxhash64("rid"), F.lit(batches)).alias("batch"), F.explode("keys").alias("key")).select("batch", hashes(F.col("key")).alias("h")).select("batch", "h.*")
    # One pass over the texts; the batches are then folders of one table.
    counted = written(each.groupBy("batch", *KEY).agg(F.count("*").alias("n")), "lines-batches")
    runs = LineRuns(rows.sparkSession, min_docs, fanout, counted.count() // batches)
    for b in range(batches):
        runs.add(counted.filter(F.col("batch") == b).select(*KEY, "n"))
    frequent = written(runs.frequent(), "lines-frequent")
    at = rows.select("rid", F.posexplode(keys).alias("pos", "key")).filter(F.length("key") >= min_chars)
    return at.select("rid", "pos", hashes(F.col("key")).alias("h")).select("rid", "pos", "h.*").join(frequent, KEY, "left_semi").groupBy("rid").agg(F.collect_list("pos").alias("drops"))


def line_dedup(docs: DataFrame, min_docs: int = 10, min_chars: int = 1, batches: int = 4, fanout: int = 2) -> DataFrame:
    """rid, doc_id, n_lines, n_dropped, kept: lines whose key stands in at least min_docs documents go from every document.

    batches: as which the table is added to the runs, by a hash of the row key.
    """
    return told_lines(keyed(docs), min_docs, min_chars, batches, fanout).drop("text")


def told_lines(rows: DataFrame, min_docs: int = 10, min_chars: int = 1, batches: int = 4, fanout: int = 2) -> DataFrame:
    """rows (rid, text, and columns that come along) with n_lines, n_dropped and kept. The texts are shuffled once, by rid."""
    drops = dropped(rows.select("rid", "text"), min_docs, min_chars, batches, fanout)
    both = rows.join(drops.hint("shuffle_hash"), "rid", "left").withColumn("lines", lines_of(F.col("text"))).withColumn("drops", F.coalesce("drops", F.array().cast("array<int>")))
    stay = F.array_except(F.sequence(F.lit(0), F.size("lines") - 1), F.col("drops"))
    kept = F.when(F.size("drops") == 0, F.col("lines")).otherwise(F.transform(stay, lambda i: F.col("lines")[i]))
    return both.select(*rows.columns, F.size("lines").cast("long").alias("n_lines"), F.size("drops").cast("long").alias("n_dropped"), F.array_join(kept, "\n").alias("kept"))


def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup(table(spark, sf_dir, "documents")).select("doc_id", "n_lines", "n_dropped", F.sha2("kept", 256).alias("kept_sha256"))


_BLANK = "' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"
OP3_SQL = rf"""
WITH l AS (SELECT doc_id, row_number() OVER () AS r, unnest(string_split(coalesce(text, ''), chr(10))) AS line, generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS pos FROM documents),
k AS (SELECT *, translate(trim(line, {_BLANK}), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key FROM l),
f AS (SELECT key FROM k WHERE length(key) >= 1 GROUP BY key HAVING count(DISTINCT doc_id) >= 10)
SELECT doc_id, count(*)::BIGINT AS n_lines, count(f.key)::BIGINT AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (f.key IS NULL), '')) AS kept_sha256
FROM k LEFT JOIN f ON k.key = f.key GROUP BY doc_id
"""
