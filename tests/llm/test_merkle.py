"""Merkle manifest against a plain recursive computation, with edge cases."""

import hashlib
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from tideline.llm import merkle

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
FIELDS = ["doc_id", "source", "lang", "n_chars", "text"]
ROWS = [(1, None, "en", "s", 1), (2, "", "en", None, 2), (3, " \t\n", None, "s", 3), (4, "a", "en", "Z", 4),
        (7, "twice", "en", "s", 8), (7, "twice", "en", "s", 8), (7, "tie", "en", "s", 8), (None, "no id", "en", "s", 8),
        (None, None, None, None, None), (8, "z" * 200_000, "de", "é", 9), (9, "日本\nx", "fr", "a", 10),
        *[(100 + k, f"text {k}", "en", "hot", k) for k in range(29)]]


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def leaf_of(row):
    doc, text, lang, source, n = row
    return sha("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in (doc, source, lang, n, text)))


def climb(level, arity):
    """All levels of a tree, leaves first."""
    levels = [level]
    while len(levels[-1]) > 1:
        last = levels[-1]
        levels.append([sha("".join(last[k:k + arity])) for k in range(0, len(last), arity)])
    return levels


def beside(levels, idx, arity):
    out = []
    for level in levels[:-1]:
        lo = idx - idx % arity
        out.append(("".join(level[lo:idx]), "".join(level[idx + 1:lo + arity])))
        idx //= arity
    return out


def brute(rows, arity):
    by = defaultdict(list)
    for r in rows:
        by[r[3]].append((r[0] is not None, r[0] or 0, leaf_of(r)))
    names = sorted(by, key=lambda s: (s is not None, (s or "").encode()))
    trees = [climb([leaf for *_, leaf in sorted(by[s])], arity) for s in names]
    top = climb([t[-1][0] for t in trees], arity)
    out = []
    for g, s in enumerate(names):
        for idx, (has, doc, leaf) in enumerate(sorted(by[s])):
            path = beside(trees[g], idx, arity) + beside(top, g, arity)
            out.append((doc if has else None, leaf, trees[g][-1][0], top[-1][0], tuple(path)))
    return sorted(out, key=str)


def found(df):
    return sorted(((r.doc_id, r.leaf, r.subroot, r.root, tuple((s.before.hex(), s.after.hex()) for s in r.path))
                   for r in df.collect()), key=str)


@pytest.fixture(scope="module")
def edge(spark):
    df = spark.createDataFrame(ROWS, SCHEMA)
    for c in ("tree", "idx", "h", "leaf", "path", "_g", "c0", "root"):
        df = df.withColumn(c, F.lit("clash"))
    return df


@pytest.mark.parametrize("arity", [2, 3, 4])
def test_equals_brute_force(edge, arity):
    assert found(merkle.manifest(edge, FIELDS, arity=arity)) == brute(ROWS, arity)


def test_every_proof_verifies_and_changed_leaves_do_not(edge):
    changed = merkle.leaf_digest(*[edge[f] for f in FIELDS[:-1]], F.concat(edge["text"], F.lit("!")))
    rows = merkle.manifest(edge, FIELDS, carry={"other": F.unhex(changed)}).withColumn("other", F.lower(F.hex("other")))
    assert merkle.verify(rows, "leaf").where("not verified").count() == 0
    bad = merkle.verify(rows, "other").select("leaf", "other", "verified").collect()
    assert all(r.verified == (r.leaf == r.other) for r in bad) and not all(r.verified for r in bad)


def test_one_row_one_group_and_none(spark):
    one = spark.createDataFrame(ROWS[3:4], SCHEMA)
    got = merkle.verify(merkle.manifest(one, FIELDS), "leaf").first()
    assert got.leaf == got.subroot == got.root == got.folded_root == leaf_of(ROWS[3])
    assert got.proof_sha256 == sha("") and got.verified
    rows = ROWS[-10:]
    assert found(merkle.manifest(spark.createDataFrame(rows, SCHEMA), FIELDS)) == brute(rows, 3)
    assert merkle.manifest(spark.createDataFrame([], SCHEMA), FIELDS).count() == 0


def test_positions_of_a_group_do_not_depend_on_the_block_size(edge, monkeypatch):
    monkeypatch.setattr(merkle, "BLOCK", 4)
    assert found(merkle.manifest(edge, FIELDS)) == brute(ROWS, 3)
