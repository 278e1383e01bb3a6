"""Very long runs, wide and null ids, texts without letters, every turn of a
conversation, clashing names."""

import hashlib
import json
from collections import Counter

import numpy as np
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from conftest import SF_SMALL
from tideline.llm import bpe, chat, exact_dedup, fingerprint, langid, licences, packing, queries, simhash
from tideline.llm.common import read_table
from tideline.llm.tokens import tokenizer_encode, vocabulary_path

WIDE = [(1 << 60) + 1, None, (1 << 60) + 3, -(1 << 61) - 1, None]
RUNS = [" " * 2_000_000, "\n" * 2_000_000, "a" + " " * 1_100_000 + "b", "z" * 300_000, "word <|endoftext|> " * 9000]


def test_runs_of_millions_equal_the_tokenizer_file():
    path = vocabulary_path("byte_bpe_50k.tiktoken")
    ours, theirs = tokenizer_encode(path), Tokenizer.from_file(path.removesuffix(".tiktoken") + ".json")
    for text in RUNS:
        assert ours(text) == theirs.encode(text, add_special_tokens=False).ids


def test_packing_and_bpe_take_long_runs_and_keep_ids(spark):
    rows = [(WIDE[k % 5], t) for k, t in enumerate(RUNS + ["x", "y"])]
    docs = spark.createDataFrame(rows, "doc_id long, text string").coalesce(1)
    got = packing.pack(docs).collect()
    encode = tokenizer_encode(vocabulary_path("byte_bpe_50k.tiktoken"))
    want = Counter()
    for doc, text in rows:
        want[doc] += len(encode(text)) + 1
    have = Counter()
    for r in got:
        have[r.doc_id] += r.length
    assert have == want
    decoded = Counter((r.doc_id, r.decoded_sha256) for r in bpe.encode_and_decode(docs).collect())
    assert decoded == Counter((d, hashlib.sha256(t.encode()).hexdigest()) for d, t in rows)


def test_fingerprints_keep_wide_and_null_ids(spark):
    docs = spark.createDataFrame([(d, f"text {k}") for k, d in enumerate(WIDE)], "doc_id long, text string").coalesce(1)
    got = [r.doc_id for r in fingerprint.fingerprint_with_edits(docs).collect()]
    assert Counter(got) == Counter(WIDE)


def test_word_blocks_grow_with_the_parts(spark, monkeypatch):
    docs = read_table(spark, SF_SMALL, "documents")
    size = docs.agg(F.sum(F.octet_length("text"))).first()[0]
    blocks = []
    for parts in (8, 32):
        monkeypatch.setattr(bpe, "PART_BYTES", -(-size // parts))
        rows = docs.select("doc_id", F.pmod(F.xxhash64("doc_id"), F.lit(parts)).cast("int").alias("_sfx_part"), "text")
        packed = rows.mapInArrow(bpe._pack_docs, "part int, block binary")
        blocks.append(packed.groupBy("part").applyInArrow(
            bpe._distinct_words(bpe.BUCKETS), "bucket int, part int, words binary").count())
    assert blocks[1] <= 4 * blocks[0]


def test_texts_without_a_letter_are_undetermined(spark):
    rng = np.random.default_rng(0)
    langs = ["de", "fr"]
    net = langid.train(rng.integers(0, 256, (8, langid.WINDOW)).astype(np.int16), np.arange(8) % 2, langs)
    texts = ["½ ² ①", "²", "123", "", None, "Ⅷ ٣", "a", "ß", "日"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r.doc_id: r.lang_pred for r in langid.identify(docs, net).collect()}
    assert [got[k] == "und" for k in range(9)] == [True] * 6 + [False] * 3
    named = spark.createDataFrame([(f"id{k}", "some words", "en") for k in range(9)], "doc_id string, text string, lang string")
    assert langid.fit_language_model(named).langs == ["en"]


def test_every_turn_is_in_a_row(spark):
    turns = read_table(spark, SF_SMALL, "conversations")
    assert queries.op5_chat_formatting(spark, SF_SMALL).agg(F.sum("turns")).first()[0] == turns.count()
    rows = [(1, 0, "system", "be kind"), (1, 1, "user", "hi"), (1, 2, "assistant", "ho"), (1, 1, "user", "hi again"),
            (None, 3, "user", "x"), (1, None, "assistant", None), (2, 0, None, "y"), (2, 1, "tool", "z"),
            (3, 0, "user", '{"name":"answer","arguments":{"turn":"one","extra":1}}'), (3, 2, "user", '{"name":"nothing","arguments":[1]}'),
            (3, 4, "user", "{not json")]
    messages = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").withColumn("json", F.lit("clash"))
    schemas = spark.createDataFrame(chat.TOOLS, "name string, field string, kind string, required boolean")
    out = chat.link_calls(*chat.conversation_calls(messages), schemas).unionByName(chat.plain_turns(messages)).collect()
    assert sum(r.turns for r in out) == len(rows)
    by = {r.call_id: r for r in out if r.call_id}
    assert by["1:0"].status == "message" and json.loads(by["1:0"].json) == {"content": "be kind", "id": "1:0", "role": "system"}
    assert by["1:1"].turns == 3 and by["1:1"].status == "linked" and by["2:0"].status == by["2:1"].status == "message"
    assert Counter(r.status for r in out)["no_id"] == 2
    assert by["3:0"].errors == "extra: unknown,prompt: missing,turn: not integer"
    assert by["3:2"].errors == "arguments: not an object" and by["3:4"].errors == ""


def test_internal_names_of_the_caller_come_back_unchanged(spark):
    names = ["_tl_id", "_TL_SHA", "_tl_h", "_tl_kept_id", "_tl_text_sha256", "_tl__rows", "id", "h", "doc_id_"]
    docs = spark.createDataFrame([(k, "same text here and there " * 3) for k in range(3)] + [(9, None)], "doc_id long, text string")
    for n in names:
        docs = docs.withColumn(n, F.concat(F.lit(n), F.col("doc_id").cast("string")))
    for out in (exact_dedup.drop_exact_copies(docs), simhash.drop_near_copies(docs)):
        assert out.columns == docs.columns
        for r in out.collect():
            assert all(r[n] == f"{n}{r.doc_id}" for n in names)
        assert out.count() == 2


def test_licence_lines_by_lookup_and_by_join(spark, monkeypatch):
    texts = ["MIT License", "x\nSPDX-License-Identifier: GPL-3.0-or-later\ny", "SPDX-License-Identifier: MIT OR Apache-2.0\n",
             'Licensed under the Apache License, Version 2.0 (the "License");\nyou may not', "plain", None, "", "a\nMIT License\nb"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").withColumn("license", F.lit("clash"))
    rows = licences.scan_licences(docs).collect()
    got = {r.doc_id: (r.license, r.line_licenses) for r in rows}
    assert len(rows) == len(texts)
    assert [got[k][1] for k in range(8)] == ["MIT", "GPL-3.0", "MIT OR Apache-2.0", "Apache-2.0", "", "", "", "MIT"]
    assert got[0][0] == "MIT" and got[7][0] is None
    known = licences.known_digests(spark).select("digest", "license")
    known = known.unionByName(known.where("license = 'MIT'").withColumn("license", F.lit("Expat")))
    looked = Counter(map(tuple, licences.scan_licences(docs, known=known).collect()))
    assert sum(looked.values()) == len(texts) and any("Expat,MIT" in r for r in looked)
    monkeypatch.setattr(licences, "BROADCAST_ROWS", 3)
    assert Counter(map(tuple, licences.scan_licences(docs, known=known).collect())) == looked


def test_large_groups_of_copies_are_joined_by_broadcast(spark, monkeypatch):
    rows = [(k, "hot" if k % 3 == 0 else f"pair {k // 2}") for k in range(300)] + [(None, "hot"), (None, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    want = Counter(map(tuple, exact_dedup.exact_groups(docs).collect()))
    monkeypatch.setattr(exact_dedup, "HOT_SHARE", 4)
    assert Counter(map(tuple, exact_dedup.exact_groups(docs).collect())) == want


def test_both_splitters_find_the_same_words():
    from tideline.llm.tokens import split_words, splitter
    latin = [chr(k) for k in range(256)]
    rng = np.random.default_rng(3)
    texts = ["".join(x) for a in latin for x in ((a, b) for b in latin)]
    picks = latin + list(" \n\t'aZ09.") * 30
    texts += ["".join(rng.choice(picks, rng.integers(1, 12))) for _ in range(20_000)]
    texts += ["日本 " + t for t in texts[-50:]] + ["it's 'll", " " * 1_200_000 + "x", "\n" * 1_200_000]
    assert [t for t in texts if split_words(t) != splitter().findall(t)] == []
