"""Importance resampling against a plain computation, with edge cases."""

import hashlib
import math
import re
from collections import Counter
from zlib import crc32

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tideline.llm import resample

SCHEMA = "doc_id long, text string, extra string"
PROSE = "The quick brown fox, über 42 Hügel; JUMPS_over the lazy dog\x00and\x7fruns "
ROWS = [(1, None, "x"), (2, "", "x"), (3, " \t\n", None), (4, "a", "x"), (5, PROSE * 4, "x"), (6, PROSE * 4, "x"),
        (7, PROSE * 3, "x"), (7, PROSE * 3, "x"), (None, "no id " * 60, "x"), (None, None, None), (8, "z" * 300_000, "x"),
        (9, "日本 Ä " * 100, "x"), (10, PROSE * 9000, "x"), (1 << 60 | 1, "wide id " * 20, "x"),
        *[(100 + k, f"word{k} and some more words {'the lazy dog ' * k}" * 3, "x") for k in range(40)]]
TARGET = [("the lazy dog runs",), (None,), ("Some MORE words and",)]


def plain_words(text):
    low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low)


def plain_buckets(text):
    w = plain_words(text)
    return [crc32(f.encode()) % 10000 for f in w + [f"{a} {b}" for a, b in zip(w, w[1:])]]


def brute(rows, target, percent=25):
    s, t = Counter(), Counter()
    for _, text, _ in rows:
        s.update(plain_buckets(text))
    for text, in target:
        t.update(plain_buckets(text))
    big_s, big_t = sum(s.values()), sum(t.values())
    out = []
    for doc, text, _ in rows:
        b = plain_buckets(text)
        gain = sum(math.floor(1000 * math.log((t[k] + 1) * (big_s + 10000) / ((s[k] + 1) * (big_t + 10000))))
                   for k in b)
        weight = gain // len(b) if b else 0
        h = int(hashlib.sha256(f"7:{'' if doc is None else doc}".encode()).hexdigest()[:8], 16)
        score = weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))
        out.append([doc, len(b), weight, score, len(plain_words(text))])
    fit = sorted((r for r in out if r[4] >= 20), key=lambda r: (-r[3], r[0] is not None, r[0] or 0, r[2], r[1]))
    place = {id(r): k + 1 for k, r in enumerate(fit)}
    drawn = percent * len(fit) // 100
    return Counter((*r[:4], place[id(r)] if place.get(id(r), drawn + 1) <= drawn else None) for r in out)


def found(df):
    return Counter(tuple(r) for r in df.select("doc_id", "n_features", "weight", "score", "rank").collect())


@pytest.mark.parametrize("percent", [25, 100])
def test_equals_brute_force(spark, percent):
    docs = spark.createDataFrame(ROWS, SCHEMA)
    for c in ("words", "found", "weight", "score", "rank", "_place"):
        docs = docs.withColumn(c, F.lit("clash"))
    got = found(resample.resample(docs, spark.createDataFrame(TARGET, "text string"), percent=percent))
    assert got == brute(ROWS, TARGET, percent)


def test_empty_table_and_empty_target(spark):
    none = spark.createDataFrame([], SCHEMA)
    docs, target = spark.createDataFrame(ROWS[:14], SCHEMA), spark.createDataFrame(TARGET, "text string")
    assert resample.resample(none, target).count() == 0
    assert found(resample.resample(docs, none)) == brute(ROWS[:14], [])


@settings(max_examples=60, deadline=None)
@given(st.text(alphabet=st.sampled_from(list("aZ09 _-/:@`{\x00\x7f\néß日́𝔘")), max_size=60), st.integers(1, 9))
def test_words_equal_the_pattern_at_any_piece_size(text, piece):
    whole = resample.words_of(text)
    assert whole == [w.encode() for w in plain_words(text)]
    kept, resample.PIECE = resample.PIECE, piece
    try:
        assert resample.words_of(text) == whole
    finally:
        resample.PIECE = kept


def test_features_longer_than_two_words():
    words = [b"a", b"bc", b"d", b"e"]
    got = resample.feature_buckets(words, width=3).tolist()
    runs = [b" ".join(words[k:k + n]) for n in (1, 2, 3) for k in range(5 - n)]
    assert got == [crc32(r) % 10000 for r in runs]
