"""Packing in space-filling-curve order (operator 7).

A document's vector is the sum of hashed token signs, projected to a few dimensions; its place on a Hilbert curve is the
sort key. Documents are range-sorted by (key, row), laid end to end along the curve and cut every `length` tokens, so
neighbours on the curve share sequences and only the last sequence is padded. Token ids travel once, compressed, by row.

Null and empty texts are the end id alone. Ties of the key go by row. Each row is a document, repeated rows and rows that share a
doc_id included. An empty table gives no rows. Columns other than doc_id and text are not read.
"""

from __future__ import annotations

import array
import base64
import json
import os
import re
import zlib
from functools import lru_cache

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import keyed, mix, small_batches, table, written

#: The end of the vocabulary's pattern of pieces, and what it comes to where no two blanks meet; without the look ahead it is found much faster.
BLANKS, ONE_BLANK = r"\s+(?!\S)|\s+", r"\s"
RUN = re.compile(r"\s\s")
DIMS, BITS = 4, 12
END = 0


class Encoder:
    """Text -> its ids as bytes of uint16. added: tokens taken out of the text before it is cut into pieces, and their ids."""

    def __init__(self, path: str, pattern: str, added: dict[str, int]):
        import tiktoken

        with open(path, "rb") as f:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        make = lambda name, p: tiktoken.Encoding(name, pat_str=p, mergeable_ranks=ranks, special_tokens={})
        self.full = make("byte_bpe", pattern)
        self.fast = make("byte_bpe_one_blank", pattern.replace(BLANKS, ONE_BLANK)) if pattern.endswith(BLANKS) else self.full

        self.added = added
        # The first that begins, and of those the longest.
        self.cut = re.compile("(" + "|".join(map(re.escape, sorted(added, key=len, reverse=True))) + ")") if added else None

    def ids(self, text: str) -> bytes:
        out = array.array("H")
        for i, part in enumerate(self.cut.split(text) if self.cut else [text]):
            way = self.full if RUN.search(part) else self.fast
            out.extend([self.added[part]] if i % 2 else way.encode_ordinary(part))
        return out.tobytes()


def added_tokens(path: str) -> dict[str, int]:
    """The added tokens of the tokenizers file beside a rank file; none where there is no such file."""
    path = os.path.splitext(path)[0] + ".json"
    if not os.path.exists(path):
        return {}
    with open(path, encoding="utf-8") as f:
        tokens = json.load(f)["added_tokens"]
    if any(t["lstrip"] or t["rstrip"] or t["single_word"] for t in tokens):
        raise ValueError(f"{path}: added tokens that depend on what stands around them")
    return {t["content"]: t["id"] for t in tokens}


@lru_cache(maxsize=2)
def encoder(path: str | None) -> Encoder:
    """path: a tiktoken rank file of under 65,536 ids; by default the byte-level BPE of 50k, whose ids the tokenizers file of that name gives too."""
    import public_tokenizers

    path = str(path or public_tokenizers.path("byte_bpe_50k.tiktoken"))
    return Encoder(path, public_tokenizers.PATTERN, added_tokens(path))


@lru_cache(maxsize=1)
def signs() -> np.ndarray:
    """For each token id, DIMS hashed bits, 16 places apart in one long, so that a sum counts all of them at once."""
    h = mix(np.arange(1 << 16, dtype=np.uint64) + np.uint64(1))
    return sum((((h >> np.uint64(11 * d + 7)) & np.uint64(1)) << np.uint64(16 * d) for d in range(DIMS)), np.zeros(1 << 16, np.uint64))


def project(ids: np.ndarray) -> np.ndarray:
    """The mean of the tokens' +-1 vectors."""
    ones = np.zeros(DIMS)
    for i in range(0, len(ids), 1 << 15):
        n = int(signs()[ids[i : i + (1 << 15)]].sum())
        ones += [(n >> (16 * d)) & 0xFFFF for d in range(DIMS)]
    return 2 * ones / max(1, len(ids)) - 1


def hilbert(points: np.ndarray, bits: int) -> np.ndarray:
    """Places on the Hilbert curve of points (n, dims) with coordinates below 2**bits (Skilling 2004, in array form)."""
    x = [points[:, i].astype(np.int64) for i in range(points.shape[1])]
    n = len(x)
    for q in (1 << b for b in range(bits - 1, 0, -1)):
        low = q - 1
        for i in range(n):
            turn = (x[i] & q) != 0
            swap = np.where(turn, 0, (x[0] ^ x[i]) & low)
            x[0] = np.where(turn, x[0] ^ low, x[0]) ^ swap
            if i:
                x[i] = x[i] ^ swap
    for i in range(1, n):
        x[i] = x[i] ^ x[i - 1]
    flip = np.zeros_like(x[0])
    for q in (1 << b for b in range(bits - 1, 0, -1)):
        flip = np.where(x[-1] & q, flip ^ (q - 1), flip)
    key = np.zeros_like(x[0])
    for b in range(bits - 1, -1, -1):
        for i in range(n):
            key = (key << 1) | (((x[i] ^ flip) >> b) & 1)
    return key


def curve_keys(vectors: np.ndarray) -> np.ndarray:
    """Means of many signs are small; tanh spreads them over the grid."""
    top = (1 << BITS) - 1
    return hilbert(np.round((np.tanh(vectors * 4) + 1) / 2 * top), BITS)


def tokens(rows: DataFrame, path: str | None) -> DataFrame:
    """rid, doc_id, key, n (ids with the end id), ids (zstd of little-endian uint16)."""
    small_batches(rows.sparkSession)

    def run(batches):
        enc, press = encoder(path), zstandard.ZstdCompressor(level=1)
        for batch in batches:
            texts = batch.column(2).to_pylist()
            ids = [enc.ids(t or "") + b"\0\0" for t in texts]
            vectors = np.array([project(np.frombuffer(i, np.uint16)) for i in ids], np.float32).reshape(-1, DIMS)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(curve_keys(vectors)), pa.array([len(i) // 2 for i in ids], pa.int64()), pa.array([press.compress(i) for i in ids], pa.binary())], names=["rid", "doc_id", "key", "n", "ids"])

    return rows.select("rid", "doc_id", "text").mapInArrow(run, "rid long, doc_id long, key long, n long, ids binary")


def places(told: DataFrame) -> DataFrame:
    """rid, begin: how many ids stand before the document on the curve. Only the narrow columns are sorted."""
    part = F.spark_partition_id().alias("part")
    sorted_ = written(told.select("rid", "key", "n").repartitionByRange("key", "rid").sortWithinPartitions("key", "rid").select("rid", "key", "n", part), "curve")
    # One row for each partition.
    sums = sorted(sorted_.groupBy("part").agg(F.sum("n").alias("n")).collect())
    before, bases = 0, []
    for r in sums:
        bases.append((r.part, before))
        before += r.n
    base = told.sparkSession.createDataFrame(bases, "part int, base long")
    inside = F.coalesce(F.sum("n").over(Window.partitionBy("part").orderBy("key", "rid").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    return sorted_.withColumn("inside", inside).join(F.broadcast(base), "part").select("rid", (F.col("base") + F.col("inside")).alias("begin"))


PIECE = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"


def pack(docs: DataFrame, length: int = 1024, tokenizer: str | None = None, with_ids: bool = False) -> DataFrame:
    """A row for each piece of a document in a sequence; with_ids adds the piece's ids."""
    told = written(tokens(keyed(docs), tokenizer), "tokens")
    placed = told.join(places(told).hint("shuffle_hash"), "rid").select("doc_id", "begin", "ids")
    schema = PIECE + (", ids array<int>" if with_ids else "")

    def run(batches):
        for batch in batches:
            out, unpress = [], zstandard.ZstdDecompressor()
            for doc, begin, packed in zip(*(c.to_pylist() for c in batch.columns)):
                ids = np.frombuffer(unpress.decompress(packed), "<u2").astype("<u4")
                at = 0
                while at < len(ids):
                    seq, off = divmod(begin + at, length)
                    take = min(length - off, len(ids) - at)
                    piece = ids[at : at + take]
                    out.append((doc, at, take, zlib.crc32(piece.tobytes()), len(ids), seq, off, *([piece.astype(int).tolist()] if with_ids else [])))
                    at += take
            if out:
                kinds = [pa.int64()] * 7 + [pa.list_(pa.int32())]
                names = [x.split()[0] for x in schema.split(", ")]
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out), kinds)], names=names)

    return placed.mapInArrow(run, schema)


def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(table(spark, sf_dir, "documents"))
