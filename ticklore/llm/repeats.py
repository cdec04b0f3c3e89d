"""Marks on the documents' repeated windows: the Spark plan that op 5 and op 10 share."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import small_batches, written
from .spans import Filter, found, packed, unspot, windows


def repeated_paths(docs: DataFrame, symbols: Callable, k: int, m: int) -> DataFrame:
    """Paths whose minimiser stands in the corpus more than once: key, number, first place, length, and paths of that minimiser.

    Equal paths are combined in each batch before the one shuffle by minimiser, which serves both aggregations.
    """
    each = found(docs, symbols, k, m).repartition("a")
    start, length, number = unspot(F.col("spot"))
    path = each.groupBy("a", "g").agg(F.sum(number).alias("n"), F.min(F.struct("rid", start.alias("start"))).alias("first"), F.max(length).alias("len"))
    same = Window.partitionBy("a")
    return path.withColumn("total", F.sum("n").over(same)).withColumn("kinds", F.count("*").over(same)).filter("total > 1").select("a", "g", "n", "first.rid", "first.start", "len", "kinds")


def marks(docs: DataFrame, symbols: Callable, k: int, m: int, keep_first: bool) -> DataFrame:
    """(rid, marks): for each document, the windows to remove, as packed (start, number of windows).

    docs: rid, text. keep_first: windows that also start earlier (by rid, then place); else those that start anywhere else.
    """
    small_batches(docs.sparkSession)
    path = written(repeated_paths(docs, symbols, k, m), "paths")
    many = path.filter("n > 1").select("a", "g", F.col("rid").alias("rid0"), F.col("start").alias("start0"))
    whole = found(docs, symbols, k, m, Filter(many.select("a", "g"))).select("a", "g", "rid", "spot").join(many, ["a", "g"])
    start, length, _ = unspot(F.col("spot"))
    whole = whole.select("rid", start.alias("start"), length.alias("len"), "rid0", "start0")
    if keep_first:
        whole = whole.filter("rid > rid0 OR (rid = rid0 AND start > start0)")

    # One of all equal paths stands for them: its windows are compared with those of other paths.
    each = windows(docs, symbols, k, m, Filter(path.filter("kinds > 1").select("rid", "start")), keep_first)
    same = Window.partitionBy("h1", "h2")
    if keep_first:
        # In suffix order, cut at k symbols, equal windows stand together; lag() is the previous smaller position among them.
        gone = each.withColumn("psv", F.lag("rid").over(same.orderBy("rid", "mark"))).filter("n = 0 OR psv IS NOT NULL")
    else:
        gone = each.withColumn("total", F.sum("n").over(same)).filter("n = 0 OR total > 1")
    all_ = whole.select("rid", packed(F.col("start"), F.col("len")).alias("mark")).unionByName(gone.select("rid", "mark"))
    return all_.groupBy("rid").agg(F.collect_list("mark").alias("marks"))
