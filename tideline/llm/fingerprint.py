"""Document fingerprints: quartile digests of hashed byte triplets.

Three triplets of every four-byte window are hashed into ``BUCKETS`` counters;
the digest holds two bits a bucket (which quarter of all counters it is in)
and the length on a logarithmic scale.  Digests compare by a bounded
difference score, so likeness is 1 for equal digests and 0 at or beyond what
unrelated ones differ by."""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from .common import text_of

BUCKETS = 2048
TRIPLETS = ((0, 1, 2), (0, 1, 3), (0, 2, 3))
CHUNK = 1 << 20
#: Text bytes of a bucket of consecutive documents, and the most buckets there are; a bucket is sorted on disk
#: and streamed, so larger ones take longer, not more memory.
PART_BYTES, MAX_PARTS = 8 << 20, 20_000
_SHIFT = np.uint32(32 - BUCKETS.bit_length() + 1)
#: Mean difference of independent codes (1.25 a bucket) bounds the score.
MAX_DIFFERENCE = 1.25 * BUCKETS
LENGTH_WEIGHT, LENGTH_CAP = 20, 640


def bucket_counts(data: bytes) -> np.ndarray:
    """Counts of the hashed triplets of all bytes."""
    total = np.zeros(BUCKETS, np.int64)
    for lo in range(0, max(0, len(data) - 3), CHUNK):
        b = np.frombuffer(data[lo:lo + CHUNK + 3], np.uint8).astype(np.uint32)
        n = len(b) - 3
        for k, (x, y, z) in enumerate(TRIPLETS):
            word = b[x:x + n] | (b[y:y + n] << np.uint32(8)) | (b[z:z + n] << np.uint32(16)) | np.uint32((k + 1) << 24)
            word = word * np.uint32(0x9E3779B1)
            word ^= word >> np.uint32(15)
            total += np.bincount((word * np.uint32(0x85EBCA77)) >> _SHIFT, minlength=BUCKETS)
    return total


def _length_code(n: int) -> int:
    return min(255, round(math.log(n + 1, 1.1)))


def digest(data: bytes) -> bytes:
    """Length byte and two bits a bucket.  Texts under four bytes have no
    triplet; their digest is the length and a hash-placed bucket per byte."""
    counts = bucket_counts(data)
    if len(data) < 4:
        for k, byte in enumerate(data):
            counts[(byte * 37 + k * 131) % BUCKETS] += 1
    q1, q2, q3 = np.sort(counts)[[BUCKETS // 4 - 1, BUCKETS // 2 - 1, 3 * BUCKETS // 4 - 1]]
    codes = ((counts > q1).astype(np.uint8) + (counts > q2) + (counts > q3)).reshape(-1, 4)
    packed = codes[:, 0] | codes[:, 1] << 2 | codes[:, 2] << 4 | codes[:, 3] << 6
    return bytes([_length_code(len(data))]) + packed.astype(np.uint8).tobytes()


def _codes(d: bytes) -> np.ndarray:
    packed = np.frombuffer(d, np.uint8, offset=1)
    return np.stack([packed >> s & 3 for s in (0, 2, 4, 6)], 1).reshape(-1).astype(np.int16)


def likeness(a: bytes, b: bytes) -> float:
    """1 - difference / bound, within [0, 1].  Where two digests of short texts
    hold less than the bound, all they hold is the bound."""
    if a == b:
        return 1.0
    x, y = _codes(a), _codes(b)
    diff = float(np.abs(x - y).sum()) / max(1.0, min(MAX_DIFFERENCE, float(x.sum() + y.sum())))
    return max(0.0, 1.0 - diff - min(LENGTH_CAP, LENGTH_WEIGHT * abs(a[0] - b[0])) / MAX_DIFFERENCE)


def edited(text: str, following: str) -> str:
    """``text`` with its last floor(n/2) code points replaced by the first as
    many (or all) of ``following``."""
    half = len(text) // 2
    return text[:len(text) - half] + following[:half]


def fingerprint_with_edits(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: ``doc_id, n_chars, edited_sha256, fingerprint,
    edited_fingerprint, near_edited, near_next``; the next document follows in
    descending id, and the first follows the last.

    Null text is empty; null ids come after all others; rows of one id follow
    in descending text; an empty table gives an empty result; other columns
    are ignored.  Documents are dealt to buckets of consecutive ids, so the
    text is shuffled once; each bucket also gets the first document of the
    next one.  The driver sees one id a bucket (``MAX_PARTS`` at most).  Ids are
    whole numbers; others raise an error."""
    kind = docs.schema[id_col].dataType
    if kind.typeName() not in ("long", "integer", "short", "byte"):
        raise ValueError(f"{id_col}: documents follow each other by whole numbers, not {kind.simpleString()}")
    rows = docs.select(docs[id_col].alias("doc_id"), text_of(docs, text_col).alias("text"))
    rows = rows.withColumn("_k", F.coalesce(F.col("doc_id").cast("long"), F.lit(-(1 << 63)).cast("long")))
    size = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    parts = min(MAX_PARTS, max(1, -(-size // PART_BYTES)))
    cuts = np.unique(np.array(rows.approxQuantile("_k", [k / parts for k in range(1, parts)], 0.25 / parts)
                              if parts > 1 else [], np.float64))

    @F.pandas_udf(T.IntegerType())
    def bucket_of(keys: pd.Series) -> pd.Series:
        return pd.Series(np.searchsorted(cuts, keys.to_numpy().astype(np.float64), side="right").astype(np.int32))

    rows = rows.withColumn("_b", bucket_of("_k"))
    heads = sorted((r["_b"], r["head"]) for r in rows.groupBy("_b").agg(F.max("_k").alias("head")).collect())
    # the head of each bucket follows the last document of the next higher one; the highest head follows the end
    after = [(head, heads[(k + 1) % len(heads)][0]) for k, (_, head) in enumerate(heads)]
    spark = docs.sparkSession
    guests = spark.createDataFrame(after, "_k long, _to int")                   # one row a bucket, MAX_PARTS at most
    guests = (rows.select("_k", "text").join(F.broadcast(guests), "_k")      # MAX_PARTS rows at most
             .groupBy("_to").agg(F.max("text").alias("text"))
              .select(F.lit(None).cast(kind).alias("doc_id"), "text", F.lit(None).cast("long").alias("_k"),
                      F.col("_to").alias("_b"), F.lit(True).alias("_guest")))
    dealt = (rows.withColumn("_guest", F.lit(False)).unionByName(guests).repartition(parts, "_b")
             .sortWithinPartitions("_b", "_guest", F.desc("_k"), F.desc("text")))

    def one(doc, text: str, own: bytes, following: str, other: bytes):
        new = edited(text, following).encode("utf-8", "surrogatepass")
        d = digest(new)
        return (doc, len(text), hashlib.sha256(new).hexdigest(), own.hex(), d.hex(), likeness(own, d),
                likeness(own, other))

    def run(batches) -> Iterator[pa.RecordBatch]:
        held = None                                   # (bucket, doc, text, digest)
        names = ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"]
        for batch in batches:
            out = []
            for doc, text, bucket, guest in zip(*(batch.column(c).to_pylist() for c in ("doc_id", "text", "_b", "_guest"))):
                d = digest(text.encode("utf-8", "surrogatepass"))
                if held is not None and held[0] == bucket:
                    out.append(one(held[1], held[2], held[3], text, d))
                held = None if guest else (bucket, doc, text, d)
            yield pa.RecordBatch.from_pylist([dict(zip(names, row)) for row in out], schema)
    schema = to_arrow_schema(T.StructType([T.StructField("doc_id", kind), T.StructField("n_chars", T.LongType()), *[
        T.StructField(n, T.StringType()) for n in ("edited_sha256", "fingerprint", "edited_fingerprint")], *[
        T.StructField(n, T.DoubleType()) for n in ("near_edited", "near_next")]]))
    return dealt.select("doc_id", "text", "_b", "_guest").mapInArrow(
        run, f"doc_id {kind.simpleString()}, n_chars long, edited_sha256 string, fingerprint string, "
             "edited_fingerprint string, near_edited double, near_next double")
