"""SimHash near-duplicates by meet-in-the-middle ball hashing.

Two fingerprints within ``distance`` bits share a point half way: when each
emits every variant within half the radius, near ones collide on a variant.
The ball of a whole 64-bit fingerprint (radius 2) has 2,081 variants.  With
``blocks`` = 2 the bits are cut in two halves: one half holds at most
``distance // 2`` of the differing bits, so the balls of the halves (33
variants each) meet as well; collisions are verified on all 64 bits.

The work is done on distinct fingerprints, so copies cost nothing.  A bucket
of more than ``bucket`` fingerprints is never paired: its members emit the
whole 64-bit ball, where everything in a bucket is within the distance and a
star to the smallest member links it in linear size."""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import connected_components, materialize, text_of, unused_name

#: See ``join_by_key``.
HOT_SHARE = 1000
CHUNK = 1 << 15          # shingles counted at a time, so long texts stay bounded


def _bit_counts(hashes: np.ndarray) -> np.ndarray:
    whole = len(hashes) // 128 * 128
    total = np.zeros(64, np.int64)
    for part, shape in ((hashes[:whole], (-1, 128, 64)), (hashes[whole:], (-1, 1, 64))):
        if len(part):
            bits = np.unpackbits(part.view(np.uint8), bitorder="little").reshape(shape)
            total += np.add.reduce(bits, axis=1, dtype=np.uint8).sum(0, dtype=np.int64)
    return total


def simhash(text: str, shingle: int = 4) -> int:
    """Unsigned 64-bit fingerprint of one text (contract in ``fingerprints``)."""
    # bytes: A-Z and ASCII blanks only; of the words only their places are kept
    joined = b" ".join(text.encode("utf-8", "surrogatepass").lower().split())
    if not joined:
        return 0
    ends = np.append(np.flatnonzero(np.frombuffer(joined, np.uint8) == 32), len(joined))
    starts, stops = np.r_[0, ends[:-1] + 1], ends[shingle - 1:] if len(ends) > shingle else ends[-1:]
    digest, n, counts = xxhash.xxh64_intdigest, len(stops), np.zeros(64, np.int64)
    for lo in range(0, n, CHUNK):
        hashes = [digest(joined[i:j], 42) for i, j in zip(starts[lo:min(lo + CHUNK, n)].tolist(), stops[lo:lo + CHUNK].tolist())]
        counts += _bit_counts(np.array(hashes, dtype="<u8"))
    return int(np.packbits(counts * 2 > n, bitorder="little").view("<u8")[0])


def fingerprint_column(text: Column, shingle: int = 4) -> Column:
    @F.pandas_udf(T.LongType())
    def fp(texts: pd.Series) -> pd.Series:
        values = np.array([simhash(t, shingle) for t in texts], dtype=np.uint64)
        return pd.Series(values.view(np.int64))
    return fp(text)


def ball(bits: int, radius: int) -> list[int]:
    """XOR masks of every variant of a ``bits``-bit word within ``radius``."""
    return [sum(1 << p for p in c) for r in range(radius + 1) for c in combinations(range(bits), r)]


def _signed(mask: int) -> int:
    return mask - (1 << 64) if mask >> 63 else mask


def _variants(fps: DataFrame, blocks: int, distance: int) -> DataFrame:
    """``(fp, block, key)``: every variant of every block of every fingerprint."""
    width = 64 // blocks
    masks = ball(width, -(-(distance // blocks) // 2))
    arrays = []
    for b in range(blocks):
        word = F.shiftrightunsigned("fp", b * width)
        if blocks > 1:
            word = word.bitwiseAND(F.lit((1 << width) - 1))
        arrays.append(F.struct(F.lit(b).cast("byte").alias("block"), word.alias("word")))
    each = fps.select("fp", F.explode(F.array(*arrays)).alias("w")).select("fp", "w.block", "w.word")
    table = F.array(*[F.lit(_signed(m)).cast("long") for m in masks])
    return each.select("fp", "block", F.explode(
        F.transform(table, lambda m: F.col("word").bitwiseXOR(m))).alias("key"))


def _star(fps: DataFrame, distance: int) -> DataFrame:
    """Edges of the whole-word ball: each bucket's members to its smallest."""
    v = _variants(fps, 1, distance)
    low = materialize(v.groupBy("key").agg(F.min("fp").alias("low"), F.count("*").alias("n")).where("n > 1"),
                      "simhash-stars")
    return (join_by_key(v, low, "key", "n", fps.count() * len(ball(64, -(-distance // 2)))).where("fp <> low")
            .where(F.bit_count(F.col("fp").bitwiseXOR(F.col("low"))) <= distance)
            .select(F.col("fp").alias("a"), F.col("low").alias("b")).distinct())


def near_edges(fps: DataFrame, distance: int = 4, blocks: int = 2, bucket: int = 256) -> DataFrame:
    """Edges ``(a, b)`` whose components are those of the relation "at most
    ``distance`` bits differ" on the distinct fingerprints ``fps(fp)``."""
    if blocks == 1:
        return _star(fps, distance)
    v = _variants(fps, blocks, distance)
    width = 64 // blocks
    emitted = fps.count() * blocks * len(ball(width, -(-(distance // blocks) // 2)))
    sizes = v.groupBy("block", "key").agg(F.count("*").alias("n")).where("n > 1")
    sizes = materialize(sizes.withColumn("held", F.col("n")), "simhash-buckets")
    sized = materialize(join_by_key(v, sizes, ["block", "key"], "held", emitted), "simhash-sized")
    word = F.expr(f"shiftrightunsigned(fp, block * {width}) & {(1 << width) - 1}")
    small = sized.where(F.col("n") <= bucket).select("block", "key", "fp", word.alias("w"))
    a = small.withColumnsRenamed({"fp": "a", "w": "wa"})
    b = small.withColumnsRenamed({"fp": "b", "w": "wb"})
    pairs = a.join(b, ["block", "key"]).where("a < b").where(
        F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= distance)
    if distance // blocks <= 2:
        # a pair meets on up to 33 variants of a block; it counts on the one nearest to a
        pairs = pairs.where("key = CASE WHEN bit_count(wa ^ wb) < 2 THEN wa ELSE wa ^ ((wa ^ wb) & -(wa ^ wb)) END")
    pairs = pairs.select("a", "b").distinct()
    crowded = materialize(sized.where(F.col("n") > bucket).select("fp").distinct(), "simhash-crowded")
    if not crowded.isEmpty():
        pairs = pairs.unionByName(_star(crowded, distance))
    return pairs


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                 shingle: int = 4) -> DataFrame:
    """``(_id, _h, fp)`` per row, written once.  Words are runs of non-blank
    ASCII after lowering A-Z; repeats of a shingle count; fewer words than a
    shingle give one shingle; no word (null or blank text) gives zero."""
    t = text_of(docs, text_col)
    return materialize(docs.select(docs[id_col].alias("_id"), F.md5(t.cast("binary")).alias("_h"),
                                   fingerprint_column(t, shingle).alias("fp")), "simhash-fingerprints")


def _labelled(fps: DataFrame, pick: Column, distance: int, blocks: int) -> DataFrame:
    """Per distinct fingerprint: its number of rows ``n``, the least ``pick``
    of them, and ``cid``, the smallest fingerprint of its component."""
    each = materialize(fps.groupBy("fp").agg(F.min(pick).alias("pick"), F.count("*").alias("n")), "simhash-distinct")
    comp = connected_components(near_edges(each.select("fp"), distance, blocks), "simhash-components")
    return materialize(each.join(comp.withColumnRenamed("node", "fp"), "fp", "left").select(
        "fp", "n", "pick", F.coalesce("component", "fp").alias("cid")), "simhash-labelled")


def join_by_key(rows: DataFrame, table: DataFrame, key: str | list[str], held: str, total: int) -> DataFrame:
    """``rows`` joined with ``table``, which has one row a key and says how many
    of the ``total`` rows hold it.  Keys that more than one row in ``HOT_SHARE``
    holds, of which there are fewer than ``HOT_SHARE`` at any size, are joined by
    broadcast, so no group of rows meets in one task; the others by a merge join
    at every size."""
    keys, hot = [key] if isinstance(key, str) else key, F.col(held) * HOT_SHARE > total
    rest = rows.join(F.broadcast(table.where(hot).select(*keys)), keys, "left_anti")
    return rows.join(F.broadcast(table.where(hot).drop(held)), keys).unionByName(
        rest.join(table.where(~hot).drop(held).hint("merge"), keys))


def near_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 4,
                distance: int = 4, blocks: int = 2) -> DataFrame:
    """One row per input row: ``doc_id, fingerprint`` (16 hex digits) and
    ``component_id``, the smallest id reachable over links of at most
    ``distance`` differing bits.  Null ids never name a component unless it
    holds nothing else; an empty table gives an empty result."""
    fps = fingerprints(docs, id_col, text_col, shingle)
    each = _labelled(fps, F.col("_id"), distance, blocks)
    total = each.agg(F.count("*").alias("fps"), F.coalesce(F.sum("n"), F.lit(0)).alias("rows")).first()
    names = materialize(each.groupBy("cid").agg(F.min("pick").alias("component_id"), F.count("*").alias("members")),
                        "simhash-names")
    named = materialize(join_by_key(each.select("fp", "n", "cid"), names, "cid", "members", total["fps"])
                        .select("fp", "n", "component_id"), "simhash-named")
    return join_by_key(fps.select("_id", "fp"), named, "fp", "n", total["rows"]).select(
        F.col("_id").alias("doc_id"), F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def drop_near_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 4,
                     distance: int = 4, blocks: int = 2) -> DataFrame:
    """``docs`` with one row per component: the smallest id, ties broken by
    the text's hash; columns unchanged."""
    fps = fingerprints(docs, id_col, text_col, shingle)
    key = F.struct(F.col("_id").isNull().alias("none"), F.col("_id").alias("id"), F.col("_h").alias("h"))
    kept = materialize(_labelled(fps, key, distance, blocks).groupBy("cid").agg(F.min("pick").alias("k"))
                       .select("k.id", "k.h"), "simhash-kept")
    own_id, own_h = unused_name(docs, "_tl_id"), unused_name(docs, "_tl_h")
    tagged = docs.withColumn(own_id, docs[id_col]).withColumn(
        own_h, F.md5(text_of(docs, text_col).cast("binary")))
    kept = kept.toDF(*[unused_name(tagged, f"_tl_kept_{c}") for c in kept.columns])
    out = tagged.join(kept, tagged[own_id].eqNullSafe(kept[kept.columns[0]]) & (tagged[own_h] == kept[kept.columns[1]]),
                      "left_semi")
    repeated = fps.groupBy("_id", "_h").agg(F.count("*").alias("n")).where("n > 1")
    if not repeated.isEmpty():                         # rows equal in id and text: one stays
        out = out.dropDuplicates([own_id, own_h])
    return out.select(*docs.columns)
