"""Text and CSV sinks, and reading them back."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def write_csv(df: DataFrame, path: str) -> None:
    df.write.options(header=True, nullValue="", emptyValue="", encoding="UTF-8").csv(path)


def read_csv(spark: SparkSession, path: str, schema: str) -> DataFrame:
    return spark.read.schema(schema).options(header=True).csv(path)


def write_partitioned(df: DataFrame, path: str, keys: list[str], order: list[str] | None = None) -> None:
    """A folder, and in it one file, for each key; the keys stay in the file as well."""
    copies = {f"p_{k}": F.col(k) for k in keys}
    df.withColumns(copies).repartition(*copies).sortWithinPartitions(*copies, *(order or [])).write.partitionBy(*copies).options(header=True, nullValue="", emptyValue="").csv(path)


#: Quotes doubled as RFC 4180 has them, blanks kept: texts with quotes, line ends and backslashes come back as they were.
TEXTS = {"header": True, "nullValue": "", "emptyValue": "", "encoding": "UTF-8", "escape": '"', "ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False}


def write_chat(df: DataFrame, path: str, keys: list[str], order: list[str]) -> None:
    """path/csv and path/lines: a folder for each key, its rows in order over as many files as range parts hold it, so no key is one task."""
    copies = {f"p_{k}": F.col(k) for k in keys}
    dealt = df.withColumns(copies).repartitionByRange(*copies, *order).sortWithinPartitions(*copies, *order)
    dealt.write.partitionBy(*copies).options(**TEXTS).csv(f"{path}/csv")
    dealt.select(*copies, as_line().alias("value")).write.partitionBy(*copies).text(f"{path}/lines")


def read_chat(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """What write_chat() wrote; the keys are columns of the files too."""
    return spark.read.schema(schema).options(**TEXTS, multiLine=True, recursiveFileLookup=True).csv(f"{path}/csv")


def as_line() -> Column:
    return F.concat_ws(" | ", "ts", "map", "server", F.regexp_replace("text", r"[\r\n]+", " "))


def write_lines(df: DataFrame, path: str) -> None:
    """One line for each chat: time | map | server | text."""
    df.select(as_line().alias("value")).write.text(path)


def read_names(spark: SparkSession, path: str) -> DataFrame:
    """The last token of each line, lower-cased."""
    return spark.read.text(path).select(F.lower(F.element_at(F.split(F.trim("value"), " "), -1)).alias("name")).filter("name <> ''")
