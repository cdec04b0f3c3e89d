"""Substring dedup by De Bruijn compaction (operator 5).

The edges of the graph are the windows of `window` words. Neighbouring edges are compacted into paths without branches,
equal paths are joined and counted by Spark, and only where the paths under one minimiser differ (the branches of the
graph) are single edges joined. What is found is carried back to source coordinates, and removed from the texts there.

Null texts have no words. Each row is a document: repeated rows, and rows that share a doc_id, are copies of each other.
Documents shorter than the window keep all words. Columns other than doc_id and text are not read.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from .common import keyed, table
from .repeats import marks
from .spans import covered, texts_of, word_symbols

SCHEMA = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("n_words", T.LongType()), T.StructField("n_removed", T.LongType()), T.StructField("kept", T.StringType())])
DIGEST = T.StructType([*SCHEMA.fields[:3], T.StructField("kept_sha256", T.StringType())])


def substring_dedup(docs: DataFrame, window: int = 35, gram: int = 14, digest: bool = False) -> DataFrame:
    """doc_id, n_words, n_removed, and the kept words joined by a space (with digest: their SHA-256).

    Removed are all words under a window whose words also start anywhere else. gram: words of a minimiser.
    """
    rows = keyed(docs)
    schema = DIGEST if digest else SCHEMA

    def run(batches):
        for batch in batches:
            ids, texts, lists, out = batch.column(0), texts_of(batch), batch.column(2).to_pylist(), []
            for text, own in zip(texts, lists):
                words = text.split()  # ASCII white space, as bytes
                gone = covered(len(words), np.array(own, np.int64), window) if own else np.zeros(len(words), bool)
                kept = b" ".join([w for w, g in zip(words, gone.tolist()) if not g] if own else words)
                out.append((len(words), int(gone.sum()), hashlib.sha256(kept).hexdigest() if digest else kept.decode()))
            n, r, s = zip(*out) if out else ((), (), ())
            yield pa.RecordBatch.from_arrays([ids, pa.array(n, pa.int64()), pa.array(r, pa.int64()), pa.array(s, pa.string())], names=schema.names)

    found = marks(rows, word_symbols, window, gram, keep_first=False)
    return rows.join(found.hint("shuffle_hash"), "rid", "left").select("doc_id", "text", "marks").mapInArrow(run, schema)


def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring_dedup(table(spark, sf_dir, "documents"), digest=True)
