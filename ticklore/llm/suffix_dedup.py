"""Suffix-array dedup (operator 10): later copies of long byte strings go, the first copy stays.

Suffixes are put in order by what they begin with, as far as the threshold. The longest previous factor of a place is at
least the threshold if, in that order, a suffix with a smaller position stands before it (PSV) or after it (NSV) among
those that share the first `length` bytes; among equals sorted by position, that is the neighbour before. Runs of places
that share a minimiser are settled as wholes first, so that only places at the ends of a repeat are sorted one by one.

Null texts are empty. Each row is a document; rows that share a doc_id follow each other by text. Columns other than
doc_id and text are not read. A cut inside a character leaves its other bytes: `kept` is binary.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from .common import keyed, table
from .repeats import marks
from .spans import byte_symbols, covered, texts_of

SCHEMA = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("n_bytes", T.LongType()), T.StructField("n_removed", T.LongType()), T.StructField("n_spans", T.LongType()), T.StructField("kept", T.BinaryType())])
DIGEST = T.StructType([*SCHEMA.fields[:4], T.StructField("kept_sha256", T.StringType())])


def suffix_dedup(docs: DataFrame, length: int = 100, gram: int = 58, digest: bool = False) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans (maximal removed runs), and the kept bytes (with digest: their SHA-256).

    Removed is each byte under a string of `length` bytes that also starts earlier. gram: bytes of a minimiser.
    """
    rows = keyed(docs)
    schema = DIGEST if digest else SCHEMA

    def run(batches):
        for batch in batches:
            ids, texts, lists, out = batch.column(0), texts_of(batch), batch.column(2).to_pylist(), []
            for text, own in zip(texts, lists):
                removed = spans = 0
                kept = text
                if own:
                    gone = covered(len(text), np.array(own, np.int64), length)
                    kept = np.frombuffer(text, np.uint8)[~gone].tobytes()
                    removed, spans = int(gone.sum()), int((gone[1:] & ~gone[:-1]).sum() + gone[0])
                out.append((len(text), removed, spans, hashlib.sha256(kept).hexdigest() if digest else kept))
            cols = list(zip(*out)) or [()] * 4
            yield pa.RecordBatch.from_arrays([ids, *(pa.array(c, pa.int64()) for c in cols[:3]), pa.array(cols[3], pa.string() if digest else pa.binary())], names=schema.names)

    found = marks(rows, byte_symbols, length, gram, keep_first=True)
    return rows.join(found.hint("shuffle_hash"), "rid", "left").select("doc_id", "text", "marks").mapInArrow(run, schema)


def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup(table(spark, sf_dir, "documents"), digest=True)
