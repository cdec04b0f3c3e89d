"""Ordered work over groups of any size: rows dealt by range into slices of bounded size, and what a slice has to know of its neighbours.

A slice is what one task holds of one group, in order. Windows run within a slice; what crosses its border is passed on as a line for each slice.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ticklore.sources.shared import stored

SLICE_ROWS = 50_000


def sliced(df: DataFrame, keys: list[str], order: list[str], rows: int = SLICE_ROWS) -> DataFrame:
    """df with `slice`: rows of a group in slices that follow each other in its order, about `rows` in a slice at most. Written once, as ranges are drawn from samples.

    The order has to be unique within a group, or rows of equal order are dealt together.
    """
    kept = stored(df, "unsliced")
    parts = max(1, -(-kept.count() // rows))
    if parts == 1:
        return kept.withColumn("slice", F.lit(0))
    return stored(kept.repartitionByRange(parts, *keys, *order).withColumn("slice", F.spark_partition_id()), "sliced")


def halo(slices: DataFrame, keys: list[str], order: list[str], k: int, cols: list[str]) -> DataFrame:
    """The rows (order and cols), with `own`: true for a slice's own rows, false for the k rows before and the k after it in its group.

    A slice of fewer than k rows hands on what it got itself, so neighbours further off count too.
    """
    part = [*keys, "slice"]
    row = F.struct(*order, *cols)
    at = Window.partitionBy(*part)
    near = slices.select(*part, row.alias("r"), F.row_number().over(at.orderBy(*order)).alias("up"), F.row_number().over(at.orderBy(*[F.desc(c) for c in order])).alias("down"))
    ends = near.filter((F.col("up") <= k) | (F.col("down") <= k)).groupBy(*part).agg(*[F.array_sort(F.collect_list(F.when(F.col(c) <= k, F.col("r")))).alias(n) for c, n in (("up", "head"), ("down", "tail"))])
    # A line for each slice of a group, none larger than 2 k rows.
    lines = ends.groupBy(*keys).agg(F.array_sort(F.collect_list(F.struct("slice", "head", "tail"))).alias("s"))
    kind = slices.select(F.array(row).alias("r")).schema["r"].dataType.simpleString()
    none = F.array().cast(kind)

    def walk(s: Column, field: str, keep) -> Column:
        start = F.struct(none.alias("held"), F.array().cast(f"array<struct<slice:int,got:{kind}>>").alias("out"))
        step = lambda a, x: F.struct(keep(a["held"], x[field]).alias("held"), F.concat(a["out"], F.array(F.struct(x["slice"].alias("slice"), a["held"].alias("got")))).alias("out"))
        return F.aggregate(s, start, step)["out"]

    last = lambda held, new: F.slice(F.concat(held, new), F.greatest(F.size(held) + F.size(new) - k + 1, F.lit(1)), k)
    first = lambda held, new: F.slice(F.concat(new, held), 1, k)
    got = lines.select(*keys, F.explode(F.concat(walk(F.col("s"), "tail", last), walk(F.reverse("s"), "head", first))).alias("g")).select(*keys, "g.slice", F.explode("g.got").alias("r"))
    own = slices.select(*part, *order, *cols, F.lit(True).alias("own"))
    return own.unionByName(got.select(*part, "r.*", F.lit(False).alias("own")))


def positions(slices: DataFrame, keys: list[str], order: list[str], name: str = "pos") -> DataFrame:
    """Rows numbered from 1 within their group: the number within the slice, and the rows of the slices before."""
    part = [*keys, "slice"]
    n = slices.groupBy(*part).agg(F.count("*").alias("n"))
    before = n.select(*part, (F.sum("n").over(Window.partitionBy(*keys).orderBy("slice")) - F.col("n")).alias("before"))  # a line for each slice
    local = slices.withColumn(name, F.row_number().over(Window.partitionBy(*part).orderBy(*order)))
    return local.join(before, part).withColumn(name, F.col(name) + F.col("before")).drop("before")
