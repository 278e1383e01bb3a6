"""Importance resampling towards a target set.

A text's words come from an untrained pre-tokenizer (``Split`` on a regular
expression) over the ASCII-lowered text, with their offsets; windows of
consecutive offset pairs are the features, and the CRC of a feature's bytes
picks its bucket.  Documents are tokenised once: their bucket numbers are
written, counted for the histogram, and read again to sum the gains.  Keyed
Gumbel noise turns the weights into scores, and the highest scores are drawn by
their place in one distributed order."""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from functools import lru_cache
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from ..operators.ids import surrogate_ids
from ..session import fresh_path
from .common import materialize, text_of

WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
BUCKETS = 10_000
#: Characters handed to the pre-tokenizer at once; a piece ends where a word cannot go on.
PIECE = 1 << 18
_GAP = re.compile(r"[\x00-\x2F\x3A-\x60\x7B-\x7F]")


@lru_cache(maxsize=1)
def _splitter():
    from tokenizers import Regex
    from tokenizers.pre_tokenizers import Split
    return Split(Regex(WORD), behavior="removed", invert=True)


def lowered(text: str) -> str:
    """A-Z in lower case; every other character as it is."""
    return text.encode("utf-8", "surrogatepass").lower().decode("utf-8", "surrogatepass")


def pieces_of(text: str) -> Iterator[str]:
    """The text in pieces that no word crosses."""
    at = 0
    while len(text) - at > PIECE:
        gap = _GAP.search(text, at + PIECE)
        stop = gap.end() if gap else len(text)
        yield text[at:stop]
        at = stop
    yield text[at:]


def words_of(text: str) -> list[bytes]:
    """Words of a text in order, as UTF-8 bytes."""
    out: list[bytes] = []
    for piece in pieces_of(lowered(text)):
        out += [piece[a:b].encode("utf-8", "surrogatepass") for _, (a, b) in _splitter().pre_tokenize_str(piece)]
    return out


def feature_buckets(words: list[bytes], width: int = 2, buckets: int = BUCKETS) -> np.ndarray:
    """Bucket of every run of 1 to ``width`` consecutive words.  The CRC of a
    run goes on from the CRC of the run without its last word."""
    last = [crc32(w) for w in words]
    out = [np.array(last, np.uint32)]
    for n in range(1, width):
        last = [crc32(w, crc32(b" ", c)) for w, c in zip(words[n:], last)]
        out.append(np.array(last, np.uint32))
    return (np.concatenate(out) % buckets).astype(np.uint16)


def tokenised(docs: DataFrame, width: int, buckets: int, id_col: str | None, text_col: str) -> DataFrame:
    """``doc_id, words, found``: number of words, and the features' buckets as
    little-endian 16-bit numbers."""
    if buckets > 1 << 16:
        raise ValueError("bucket numbers are kept in 16 bits")
    key = docs[id_col] if id_col else F.lit(None).cast("long")
    rows = docs.select(key.alias("doc_id"), text_of(docs, text_col).alias("text"))
    schema = T.StructType([rows.schema["doc_id"], T.StructField("words", T.LongType()),
                           T.StructField("found", T.BinaryType())])
    arrow = to_arrow_schema(schema)

    def run(batches):
        for batch in batches:
            for lo in range(0, len(batch), 256):      # small output batches: long texts give long rows
                part = batch.slice(lo, 256)
                words, found = [], []
                for text in part.column("text"):
                    w = words_of(text.as_py())
                    words.append(len(w))
                    found.append(feature_buckets(w, width, buckets).astype("<u2").tobytes())
                yield pa.RecordBatch.from_arrays([part.column("doc_id").cast(arrow.field(0).type),
                                                  pa.array(words, pa.int64()), pa.array(found, pa.binary())], schema=arrow)
    return rows.mapInArrow(run, schema)


def histogram(rows: DataFrame, buckets: int) -> np.ndarray:
    """Features per bucket; a task sends one row a bucket, the driver gets ``buckets`` rows."""
    def count(batches):
        total = np.zeros(buckets, np.int64)
        for batch in batches:
            for found in batch.column("found"):
                total += np.bincount(np.frombuffer(found.as_buffer(), "<u2"), minlength=buckets)
        hit = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(hit, pa.int32()), pa.array(total[hit], pa.int64())], ["bucket", "n"])
    counts = rows.select("found").mapInArrow(count, "bucket int, n long").groupBy("bucket").agg(F.sum("n").alias("n"))
    out = np.zeros(buckets, np.int64)
    for r in counts.collect():
        out[r["bucket"]] = r["n"]
    return out


def bucket_gains(source: np.ndarray, target: np.ndarray) -> np.ndarray:
    """Thousandths of the log ratio of the add-one shares of target and source, floored."""
    s_all, t_all, k = int(source.sum()), int(target.sum()), len(source)
    return np.array([math.floor(1000 * math.log((t + 1.0) * (s_all + k) / ((s + 1.0) * (t_all + k))))
                     for s, t in zip(source.tolist(), target.tolist())], np.int64)


def with_weights(rows: DataFrame, gains: np.ndarray) -> DataFrame:
    """``doc_id, words, n_features, weight``: the floored mean gain, 0 without a feature."""
    schema = T.StructType([rows.schema["doc_id"], T.StructField("words", T.LongType()),
                           T.StructField("n_features", T.LongType()), T.StructField("weight", T.LongType())])
    arrow = to_arrow_schema(schema)

    def run(batches):
        for batch in batches:
            sizes, weights = [], []
            for found in batch.column("found"):
                b = np.frombuffer(found.as_buffer(), "<u2")
                sizes.append(len(b))
                weights.append(int(gains[b].sum()) // len(b) if len(b) else 0)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id").cast(arrow.field(0).type), batch.column("words").cast(pa.int64()),
                 pa.array(sizes, pa.int64()), pa.array(weights, pa.int64())], schema=arrow)
    return rows.mapInArrow(run, schema)


def noise(key: Column) -> Column:
    """Gumbel noise in thousandths, floored, from the first 32 bits of the key's SHA-256."""
    h = F.conv(F.substring(F.sha2(key.cast("binary"), 256), 1, 8), 16, 10).cast("double")
    return F.floor(-1000 * F.log(-F.log((h + 0.5) / 4294967296.0)))


def resample(docs: DataFrame, target: DataFrame, percent: int = 25, min_words: int = 20, seed: int = 7, width: int = 2,
             buckets: int = BUCKETS, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: ``doc_id, n_features, weight, score, rank``.

    Of the rows with at least ``min_words`` words, floor(``percent`` * n / 100)
    get a rank: those of the highest scores, ties to the smaller id (null
    first; rows that share id and score by weight and features).  Null texts
    have no words; a text without a feature has weight 0; a null id counts as
    the empty text in the noise, and repeated rows share their score.  An empty
    table or target gives an empty result or gains of the smoothing alone;
    other columns are ignored."""
    rows = materialize(tokenised(docs, width, buckets, id_col, text_col), "resample-buckets")
    aim = histogram(tokenised(target, width, buckets, None, text_col), buckets)
    gains = bucket_gains(histogram(rows, buckets), aim)
    key = F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit("")))
    scored = materialize(with_weights(rows, gains).withColumn("score", (F.col("weight") + noise(key)).cast("long")),
                         "resample-scores")
    fit = scored.where(F.col("words") >= min_words)
    drawn = percent * fit.count() // 100
    placed = surrogate_ids(fit.withColumn("_down", -F.col("score")), fresh_path(docs.sparkSession, "llm", "resample-order"),
                           order_by=["_down", "doc_id", "weight", "n_features"], id_col="_place")
    out = placed.withColumn("rank", F.when(F.col("_place") <= drawn, F.col("_place"))).unionByName(
        scored.where(F.col("words") < min_words).withColumn("rank", F.lit(None).cast("long")), allowMissingColumns=True)
    return out.select("doc_id", "n_features", "weight", "score", F.col("rank").cast("long").alias("rank"))


#: The query over ``documents`` and ``benchmark`` in SQL; crc32 from its table of 256 steps, once a distinct feature.
ORACLE = r"""
WITH steps AS (
  SELECT list_transform(range(256), lambda x: list_reduce([x] || range(8), lambda a, b:
           CASE WHEN a % 2 = 1 THEN xor(a >> 1, 3988292384) ELSE a >> 1 END)) AS tab),
texts AS (
  SELECT row_number() OVER () AS rn, doc_id, text, true AS own FROM documents
  UNION ALL SELECT -row_number() OVER (), NULL, text, false FROM benchmark),
split AS (
  SELECT rn, own, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
         'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM texts),
feats AS (
  SELECT rn, own, unnest(w || list_transform(range(1, len(w)), lambda k: w[k] || ' ' || w[k + 1])) AS f FROM split),
known AS (
  SELECT f, xor(list_reduce([4294967295::BIGINT] || list_transform(range(1, 2 * strlen(f), 2),
           lambda k: ('0x' || hex(f)[k:k + 1])::BIGINT), lambda a, c: xor(a >> 8, tab[xor(a, c) % 256 + 1])),
         4294967295) % 10000 AS b
  FROM (SELECT DISTINCT f FROM feats), steps),
counts AS (SELECT rn, own, b, count(*) AS n FROM feats JOIN known USING (f) GROUP BY rn, own, b),
hist AS (SELECT b, coalesce(sum(n) FILTER (own), 0) AS s, coalesce(sum(n) FILTER (NOT own), 0) AS t FROM counts GROUP BY b),
totals AS (SELECT coalesce(sum(s), 0) AS s_all, coalesce(sum(t), 0) AS t_all FROM hist),
gains AS (
  SELECT b, floor(1000 * ln((t + 1)::DOUBLE * (s_all + 10000)::DOUBLE / ((s + 1)::DOUBLE * (t_all + 10000)::DOUBLE))) AS gain
  FROM hist, totals),
weights AS (
  SELECT rn, sum(n)::BIGINT AS n_features, floor(sum(n * gain) / sum(n))::BIGINT AS weight
  FROM counts JOIN gains USING (b) WHERE own GROUP BY rn),
scored AS (
  SELECT rn, t.doc_id, coalesce(n_features, 0) AS n_features, coalesce(weight, 0) AS weight, len(w) AS words,
         coalesce(weight, 0) + floor(-1000 * ln(-ln((('0x' || sha256('7:' || coalesce(t.doc_id::VARCHAR, ''))[1:8])::BIGINT
           + 0.5::DOUBLE) / 4294967296)))::BIGINT AS score
  FROM texts t JOIN split USING (rn) LEFT JOIN weights USING (rn) WHERE t.own),
placed AS (
  SELECT rn, row_number() OVER (ORDER BY score DESC, doc_id NULLS FIRST, weight, n_features) AS place,
         count(*) OVER () * 25 // 100 AS drawn FROM scored WHERE words >= 20)
SELECT doc_id, n_features, weight, score, CASE WHEN place <= drawn THEN place END AS rank
FROM scored LEFT JOIN placed USING (rn)
"""
