"""Archive tables bucketed and sorted by session, so that joins on a session find both sides in place."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from ticklore.sources.shared import shared_path


def located(tables: dict[str, DataFrame], buckets: int, order: dict[str, list[str]] | None = None, key: str = "session_id") -> dict[str, DataFrame]:
    """The same tables, as tables of the catalog with files in the shared folder: one sorted file for each bucket of the key.

    order: further columns that a table is sorted by within a session. A session that holds much of a table makes its bucket large; Spark
    splits that where a join finds it skewed. The names stay in the catalog as long as the session.
    """
    out = {}
    for name, rows in tables.items():
        called = f"{name}_{uuid.uuid4().hex[:12]}"
        sort = [key, *(order or {}).get(name, [])]
        rows.repartition(buckets, key).write.option("path", shared_path(rows.sparkSession, called)).bucketBy(buckets, key).sortBy(*sort).saveAsTable(called)
        out[name] = rows.sparkSession.table(called)
    return out


def join_in_place(spark: SparkSession) -> None:
    """Lets joins on a session and more (its user, its entity) use tables dealt by the session alone. For the whole Spark session, so it is left to the caller."""
    spark.conf.set("spark.sql.requireAllClusterKeysForCoPartition", "false")
