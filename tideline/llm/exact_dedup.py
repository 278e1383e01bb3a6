"""Exact deduplication on DataFrame functions alone.

Rows are grouped by a 128-bit content hash *and* the text, so the grouping
itself compares the bytes inside each hash group; copies collapse in the map
tasks, and a group holding a third of all rows shuffles one row per task."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import materialize, text_of, unused_name


def content_hash(text: Column) -> Column:
    return F.md5(text.cast("binary"))


def exact_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                 keep: str = "min", hash_fn=content_hash) -> DataFrame:
    """One row per input row: ``doc_id, keep_id, group_size, kept, text_sha256``.

    ``keep`` ("min" or "max") picks the id that stays among equal texts.
    Null text counts as empty.  Null ids lose to any id; a group with null ids
    only has a null ``keep_id`` and counts as kept.  Repeated rows (same id
    and text) all count in ``group_size`` and share their flags.  An empty
    table gives an empty result; other columns are ignored."""
    pick = {"min": F.min, "max": F.max}[keep]
    rows = docs.select(docs[id_col].alias("_id"), text_of(docs, text_col).alias("_t")) \
        .withColumn("_h", hash_fn(F.col("_t")))
    by_text = rows.groupBy("_h", "_t").agg(pick("_id").alias("_keep"), F.count("*").alias("_n"))
    by_hash = (by_text.groupBy("_h").agg(pick("_keep").alias("_keep"), F.sum("_n").alias("_n"),
                                         F.count("*").alias("_texts")).where("_n > 1"))
    by_hash = materialize(by_hash, "exact-groups")     # only hashes of more than one row

    slim = rows.select("_id", "_h", F.sha2(F.col("_t").cast("binary"), 256).alias("_sha"))
    sound = by_hash.where("_texts = 1")
    out = _join_groups(slim, sound, docs.count()).select("_id", "_keep", "_n", "_sha")
    collided = by_hash.where("_texts > 1").select("_h")
    if not collided.isEmpty():                         # different bytes under one hash
        out = _join_groups(slim.join(collided, "_h", "left_anti"), sound, docs.count()).select("_id", "_keep", "_n", "_sha")
        bad = rows.join(collided, "_h", "left_semi")
        exact = bad.groupBy("_h", "_t").agg(pick("_id").alias("_keep"), F.count("*").alias("_n"))
        out = out.unionByName(bad.join(exact, ["_h", "_t"]).select(
            "_id", "_keep", "_n", F.sha2(F.col("_t").cast("binary"), 256).alias("_sha")))
    keep_id = F.when(F.col("_n").isNull(), F.col("_id")).otherwise(F.col("_keep"))
    return out.select(F.col("_id").alias("doc_id"), keep_id.alias("keep_id"),
                      F.coalesce("_n", F.lit(1).cast("long")).alias("group_size"),
                      F.col("_id").eqNullSafe(keep_id).alias("kept"), F.col("_sha").alias("text_sha256"))


#: A group of more than one row in this many is joined by broadcast; there are fewer of them than that.
HOT_SHARE = 1000


def _join_groups(slim: DataFrame, groups: DataFrame, total: int) -> DataFrame:
    """``slim`` left-joined with its groups on the hash.  Rows of large groups meet
    them in a broadcast and then carry a key of their own, so they are spread in
    the join of the others instead of meeting in one task."""
    hot = groups.where(F.col("_n") * HOT_SHARE > total).select("_h", F.struct("_keep", "_n").alias("_hot"))
    rest = groups.where(F.col("_n") * HOT_SHARE <= total).select(F.col("_h").alias("_key"), F.struct("_keep", "_n").alias("_own"))
    key = F.when(F.col("_hot").isNull(), F.col("_h")).otherwise(F.concat(F.lit("-"), F.xxhash64("_id").cast("string")))
    both = slim.join(F.broadcast(hot), "_h", "left").withColumn("_key", key).join(rest, "_key", "left")
    g = F.coalesce("_hot", "_own")
    return both.select("_id", "_h", "_sha", g.getField("_keep").alias("_keep"), g.getField("_n").alias("_n"))


def drop_exact_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                      keep: str = "min") -> DataFrame:
    """``docs`` with one row per distinct text; columns unchanged.  Of repeated
    rows with the kept id, one stays."""
    kept = exact_groups(docs.select(F.col(id_col), F.col(text_col)), id_col, text_col, keep).where("kept")
    # sha256 of the text stands for the group, which exact_groups has compared byte by byte
    per_key = kept.groupBy("doc_id", "text_sha256").agg(F.count("*").alias("_rows"))
    own_id, own_sha = unused_name(docs, "_tl_id"), unused_name(docs, "_tl_sha")
    tagged = docs.withColumn(own_id, docs[id_col]).withColumn(
        own_sha, F.sha2(text_of(docs, text_col).cast("binary"), 256))
    per_key = per_key.toDF(*[unused_name(tagged, f"_tl_{c}") for c in per_key.columns])
    key_id, key_sha, key_rows = per_key.columns

    def of(part):
        return tagged.join(part, tagged[own_id].eqNullSafe(part[key_id])
                           & (tagged[own_sha] == part[key_sha]), "left_semi")
    per_key = materialize(per_key, "exact-kept")
    once = of(per_key.where(F.col(key_rows) == 1))
    again = of(per_key.where(F.col(key_rows) > 1))
    if per_key.where(F.col(key_rows) > 1).isEmpty():
        return once.select(*docs.columns)
    return once.unionByName(again.dropDuplicates([own_id, own_sha])).select(*docs.columns)
