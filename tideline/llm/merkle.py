"""Merkle manifest of a dataset.

Every row is a leaf; the leaves of a group (a source) form one tree, and the
roots of the groups form another one over it.  A level is built by equijoins of
its nodes with themselves on computed sibling indices; the rows in slot zero
then emit the parents.  Proofs go the other way: the siblings of a node are put
before the path of its parent.  Every node is one row under its own key, so a
group that holds a third of the table is spread like any other."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators.ids import surrogate_ids
from ..session import fresh_path
from .common import materialize

#: Positions that share one row of the group table, so that a large group meets many rows.
BLOCK = 1 << 20
#: Levels of the proof pass between two written tables.
WRITE_EVERY = 4
_PATH = "array<struct<before:binary,after:binary>>"


def digest(text: Column) -> Column:
    """Lower-case hex SHA-256 of a text's UTF-8 bytes."""
    return F.sha2(text.cast("binary"), 256)


def framed(value: Column) -> Column:
    """``-`` for null, else the UTF-8 byte count, a colon and the value."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf_digest(*values: Column) -> Column:
    return digest(F.concat(*map(framed, values)))


def _hex(raw: Column) -> Column:
    return F.lower(F.hex(raw))


def _node(raw: Column) -> Column:
    """Raw digest of a run of nodes, whose digests are joined as hex text."""
    return F.unhex(digest(_hex(raw)))


def with_siblings(nodes: DataFrame, arity: int) -> DataFrame:
    """``nodes(tree, idx, n, h, ...)`` with ``slot`` and the digests ``before``
    and ``after`` it in its run, from one equijoin per other slot."""
    out = nodes.withColumn("slot", F.col("idx") % arity)
    for shift in range(1, arity):
        at = (F.col("idx").bitwiseXOR(F.lit(1)) if arity == 2
              else F.col("idx") - F.col("slot") + (F.col("slot") + shift) % arity)
        other = nodes.select("tree", F.col("idx").alias("_at"), F.col("h").alias(f"_h{shift}"))
        out = out.withColumn("_at", at).join(other, ["tree", "_at"], "left").drop("_at")
    none = F.lit(b"")

    def in_slot(s):                                   # digest of the sibling in slot s, if there is one
        pick = none
        for shift in range(1, arity):
            pick = F.when((F.col("slot") + shift) % arity == s, F.coalesce(f"_h{shift}", none)).otherwise(pick)
        return pick
    before = [F.when(F.col("slot") > s, in_slot(s)).otherwise(none) for s in range(arity - 1)]
    after = [F.when(F.col("slot") < s, in_slot(s)).otherwise(none) for s in range(1, arity)]
    return (out.withColumn("before", F.concat(*before)).withColumn("after", F.concat(*after))
            .drop(*[f"_h{shift}" for shift in range(1, arity)]))


def build_levels(leaves: DataFrame, arity: int, name: str) -> tuple[list[DataFrame], list[DataFrame]]:
    """Written levels of all trees of ``leaves(tree, idx, n, h, ...)``, and for
    each height the ``(tree, idx, h)`` of the trees that end there.  A tree
    whose level holds one node has ended; ``n`` counts the nodes of a level."""
    levels, tops, nodes = [], [], leaves
    while True:
        tops.append(nodes.where("n = 1").select("tree", "idx", "h"))
        open_nodes = nodes.where("n > 1")
        if open_nodes.isEmpty():
            return levels, tops
        levels.append(materialize(with_siblings(open_nodes, arity), f"merkle-{name}-{len(levels)}"))
        nodes = levels[-1].where("slot = 0").select(
            "tree", F.expr(f"idx div {arity}").alias("idx"), F.expr(f"(n + {arity - 1}) div {arity}").alias("n"),
            _node(F.concat("h", "after")).alias("h"))


def paths(levels: list[DataFrame], tops: list[DataFrame], above: DataFrame, arity: int, name: str) -> DataFrame:
    """Leaves of trees with their ``path`` (siblings before and after, from the leaf up) and
    ``subroot``; ``above(tree, path)`` holds what follows the top of each tree."""
    def ended(k):
        return tops[k].join(above, "tree").select("tree", "idx", "path", F.col("h").alias("subroot"))
    found = ended(len(levels))
    for k in range(len(levels) - 1, -1, -1):
        up = found.select("tree", F.col("idx").alias("_up"), F.col("path").alias("_path"), "subroot")
        own = F.array(F.struct("before", "after"))
        joined = (levels[k].withColumn("_up", F.expr(f"idx div {arity}")).join(up, ["tree", "_up"])
                  .withColumn("path", F.concat(own, F.col("_path"))).drop("_up", "_path", "before", "after", "slot", "n", "h"))
        if k == 0:
            return joined
        found = joined.select("tree", "idx", "path", "subroot").unionByName(ended(k))
        if k % WRITE_EVERY == 1:
            found = materialize(found, f"merkle-{name}-paths-{k}")
    return found


def fold(leaf: Column, path: Column) -> Column:
    """Root that a leaf (hex) and a path lead to."""
    return F.aggregate(path, leaf, lambda h, s: digest(F.concat(_hex(s["before"]), h, _hex(s["after"]))))


def proof_text(path: Column) -> Column:
    """Digests of the path as hex text, left to right, level by level."""
    return F.array_join(F.transform(path, lambda s: F.concat(_hex(s["before"]), _hex(s["after"]))), "")


def place_leaves(rows: DataFrame, group: str, order: list[str], carry: list[str]) -> DataFrame:
    """``tree, idx, n`` and ``carry``: position of each row in its group by
    ``order``, and the group's size; groups ascend with ``tree``."""
    spark = rows.sparkSession
    placed = surrogate_ids(rows, fresh_path(spark, "llm", "merkle-order"), order_by=[group, *order], id_col="_pos")
    placed = placed.withColumn("_block", F.expr(f"_pos div {BLOCK}"))
    blocks = materialize(placed.groupBy(F.col(group).alias("_g"), F.col("_block").alias("_b")).agg(
        F.min("_pos").alias("_lo"), F.count("*").alias("_rows")), "merkle-blocks")
    groups = blocks.groupBy(F.col("_g").alias("_name")).agg(F.min("_lo").alias("tree"), F.sum("_rows").alias("n"))
    blocks = blocks.join(groups, F.col("_g").eqNullSafe(F.col("_name"))).select("_g", "_b", "tree", "n")
    return placed.join(blocks, placed[group].eqNullSafe(blocks["_g"]) & (placed["_block"] == blocks["_b"])).select(
        "tree", (F.col("_pos") - F.col("tree")).alias("idx"), "n", *carry)


def manifest(docs: DataFrame, fields: list[str], group: str = "source", order: str = "doc_id", arity: int = 3,
             carry: dict[str, Column] | None = None) -> DataFrame:
    """One row per input row: its ``order`` column, ``leaf``, ``subroot``, ``root`` (hex) and
    ``path``, with the columns of ``carry``.

    A leaf is the digest of ``fields``, each framed by its byte count (null: ``-``).
    Leaves of a group ascend by ``order`` (null first), rows that share a value
    by their digest, so repeated rows have a place each; groups ascend by name, null
    first.  An empty table gives an empty result; other columns are ignored, and
    the internal names of this function cannot clash with them."""
    carry = carry or {}
    names = [f"c{i}" for i in range(len(carry))]
    rows = docs.select(docs[group].alias("g"), docs[order].alias("o"),
                       F.unhex(leaf_digest(*[docs[f] for f in fields])).alias("h"),
                       *[c.alias(n) for n, c in zip(names, carry.values())])
    leaves = materialize(place_leaves(rows, "g", ["o", "h"], ["h", "o", *names]), "merkle-leaves")
    levels, tops = build_levels(leaves, arity, "rows")
    ends = tops[0]
    for t in tops[1:]:
        ends = ends.unionByName(t)
    # groups are numbered in the order of their first rows, which is the order of their names
    roots = materialize(surrogate_ids(ends.select(F.col("tree").alias("_tree"), "h"),
                                      fresh_path(docs.sparkSession, "llm", "merkle-groups"), order_by=["_tree"],
                                      id_col="_pos"), "merkle-subroots")
    size = roots.count()
    above_leaves = roots.select(F.lit(0).cast("long").alias("tree"), (F.col("_pos") - 1).alias("idx"),
                                F.lit(size).cast("long").alias("n"), "h", "_tree")
    levels2, tops2 = build_levels(above_leaves, arity, "groups")
    top = tops2[-1].first()                            # one row, none for an empty table
    none = docs.sparkSession.range(1).select(F.col("id").alias("tree"), F.array().cast(_PATH).alias("path"))
    if levels2:
        above = paths(levels2, tops2, none, arity, "groups").select(F.col("_tree").alias("tree"), "path")
    else:
        above = above_leaves.select(F.col("_tree").alias("tree"), F.array().cast(_PATH).alias("path"))
    above = materialize(above, "merkle-above")
    # leaf digests travel beside the node digests of the lowest level
    alone = (leaves.where("n = 1").join(above, "tree").withColumn("subroot", F.col("h"))
             .select("o", F.col("h").alias("leaf"), "subroot", "path", *names))
    out = alone
    if levels:
        low = [levels[0].withColumn("leaf", F.col("h")), *levels[1:]]
        out = paths(low, tops, above, arity, "rows").select("o", "leaf", "subroot", "path", *names).unionByName(alone)
    return out.select(F.col("o").alias(order), _hex(F.col("leaf")).alias("leaf"), _hex(F.col("subroot")).alias("subroot"),
                      F.lit(bytes(top["h"]).hex() if top else None).cast("string").alias("root"), "path",
                      *[F.col(n).alias(c) for n, c in zip(names, carry)])


def verify(rows: DataFrame, leaf: str) -> DataFrame:
    """``rows`` of :func:`manifest` with ``proof_sha256``, ``folded_root`` (from the
    column ``leaf`` and the path) and ``verified``."""
    return (rows.withColumn("proof_sha256", digest(proof_text(F.col("path"))))
            .withColumn("folded_root", fold(F.col(leaf), F.col("path")))
            .withColumn("verified", F.col("folded_root") == F.col("root")))


_FRAMED = "coalesce(strlen({0}::VARCHAR) || ':' || {0}::VARCHAR, '-')"
_HEAD = " || ".join(_FRAMED.format(c) for c in ("doc_id", "source", "lang", "n_chars"))

#: The query over ``documents`` in SQL: three nodes a run; crc32 of the id from its table of 256 steps.
ORACLE = f"""
WITH RECURSIVE steps AS (
  SELECT list_transform(range(256), lambda x: list_reduce([x] || range(8), lambda a, b:
           CASE WHEN a % 2 = 1 THEN xor(a >> 1, 3988292384) ELSE a >> 1 END)) AS tab),
crc AS (
  SELECT k, xor(list_reduce([4294967295::BIGINT] || list_transform(string_split(k::VARCHAR, ''), lambda c: ascii(c)::BIGINT),
           lambda a, c: xor(a >> 8, tab[xor(a, c) % 256 + 1])), 4294967295) % 2 = 0 AS even
  FROM (SELECT DISTINCT doc_id AS k FROM documents WHERE doc_id IS NOT NULL), steps),
hashed AS (
  SELECT doc_id, source, sha256({_HEAD} || {_FRAMED.format("text")}) AS leaf,
         sha256({_HEAD} || {_FRAMED.format("CASE WHEN even THEN replace(text, chr(10), '') ELSE text END")}) AS tampered
  FROM documents LEFT JOIN crc ON doc_id = k),
leaves AS (
  SELECT row_number() OVER () AS rn, doc_id, leaf, tampered, dense_rank() OVER (ORDER BY source NULLS FIRST) AS g,
         row_number() OVER (PARTITION BY source ORDER BY doc_id NULLS FIRST, leaf) - 1 AS idx,
         count(*) OVER (PARTITION BY source) AS n FROM hashed),
up AS (
  SELECT 0 AS level, g, idx, n, leaf AS h FROM leaves
  UNION ALL SELECT level + 1, g, idx // 3, (any_value(n) + 2) // 3, sha256(string_agg(h, '' ORDER BY idx))
  FROM up WHERE n > 1 GROUP BY level, g, idx // 3),
subroots AS (SELECT g, h FROM up WHERE n = 1),
up2 AS (
  SELECT 0 AS level, g - 1 AS idx, (SELECT count(*) FROM subroots) AS n, h FROM subroots
  UNION ALL SELECT level + 1, idx // 3, (any_value(n) + 2) // 3, sha256(string_agg(h, '' ORDER BY idx))
  FROM up2 WHERE n > 1 GROUP BY level, idx // 3),
beside AS (
  SELECT rn, level, u.idx AS spot, l.idx // pow(3, level)::BIGINT AS own, h
  FROM leaves l JOIN up u ON u.g = l.g AND u.n > 1 AND u.idx // 3 = l.idx // pow(3, level + 1)::BIGINT
  UNION ALL SELECT rn, 100 + level, u.idx, (l.g - 1) // pow(3, level)::BIGINT, h
  FROM leaves l JOIN up2 u ON u.n > 1 AND u.idx // 3 = (l.g - 1) // pow(3, level + 1)::BIGINT),
runs AS (
  SELECT rn, level, coalesce(string_agg(h, '' ORDER BY spot) FILTER (spot < own), '') AS bef,
         coalesce(string_agg(h, '' ORDER BY spot) FILTER (spot > own), '') AS aft FROM beside GROUP BY rn, level),
proofs AS (
  SELECT rn, string_agg(bef || aft, '' ORDER BY level) AS proof, list(bef || '|' || aft ORDER BY level) AS path
  FROM runs GROUP BY rn),
folded AS (
  SELECT doc_id, leaf, s.h AS subroot, (SELECT h FROM up2 WHERE n = 1) AS root, sha256(coalesce(proof, '')) AS proof_sha256,
         list_reduce([tampered] || coalesce(path, []),
           lambda a, s: sha256(split_part(s, '|', 1) || a || split_part(s, '|', 2))) AS folded_root
  FROM leaves l JOIN subroots s USING (g) LEFT JOIN proofs USING (rn))
SELECT *, folded_root = root AS verified FROM folded
"""
