"""Training-data operators against brute force, exact round trips, held-out
accuracy and the defined results of edge cases."""

import hashlib
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from conftest import SF_SMALL
from oracle_harness import compare, duck
from tideline.llm import bpe, chat, exact_dedup, fingerprint, langid, licences, packing, queries, simhash, suffix_dedup
from tideline.llm import toxicity
from tideline.llm.common import connected_components, read_table
from tideline.llm.tokens import encoding, vocabulary_path

SF = "/root/testdata/sf0.01"
PROSE = "the quick brown fox jumps over the lazy dog and runs along the river bank until night falls "
#: nulls, empty, blanks, repeated rows, ties, a very long text, and columns that clash with internal names
EDGE_ROWS = [
    (1, None, "en", "s", 1), (2, "", "en", None, 2), (3, " \t\n", None, "s", 3), (4, "a", "en", "s", 4),
    (5, PROSE * 4, "en", "s", 5), (6, PROSE * 4, "fr", "s", 6), (7, PROSE * 3 + "x", "en", "s", 7),
    (7, PROSE * 3 + "x", "en", "s", 7), (None, "no id " * 60, "en", "s", 8), (None, None, None, None, None),
    (8, "z" * 5000, "de", "s", 9), (9, "é" * 150 + "日本" * 100, "fr", "s", 10), (10, PROSE * 900, "en", "s", 11),
]
EDGE_SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="module")
def edge(spark):
    df = spark.createDataFrame(EDGE_ROWS, EDGE_SCHEMA)
    for c in ("fp", "part", "_h", "component_id", "score", "length"):
        df = df.withColumn(c, F.lit("clash"))
    return df


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], EDGE_SCHEMA)


@pytest.fixture(scope="module")
def docs(spark):
    rows = read_table(spark, SF_SMALL, "documents").collect()
    return {r.doc_id: r.text or "" for r in rows}


def letters(rng, n, end=123):
    return rng.integers(97, end, n).astype(np.uint8).tobytes()


def rows_of(df):
    return [tuple(r) for r in df.collect()]


# --- 1 exact dedup ---------------------------------------------------------------------------

@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_sql_queries_match(spark, name):
    got = compare(spark, name, SF_SMALL, queries.QUERIES[name], queries.ORACLES[name], duck(SF_SMALL))
    assert got["ok"], got


def test_exact_groups_edge_cases(edge, none):
    for keep, best in (("max", max), ("min", min)):
        got = exact_dedup.exact_groups(edge, keep=keep).collect()
        assert len(got) == len(EDGE_ROWS)
        groups = defaultdict(list)
        for i, t, *_ in EDGE_ROWS:
            groups[t or ""].append(i)
        sha = {hashlib.sha256(t.encode()).hexdigest(): g for t, g in groups.items()}
        for r in got:
            g = sha[r.text_sha256]
            assert r.group_size == len(g)
            assert r.keep_id == best((i for i in g if i is not None), default=None)
            assert r.kept == (r.doc_id == r.keep_id)
    assert rows_of(exact_dedup.exact_groups(none)) == []


def test_exact_dedup_compares_bytes_in_a_hash_group(edge):
    weak = exact_dedup.exact_groups(edge, keep="max", hash_fn=lambda t: F.lit("same hash"))
    assert Counter(rows_of(weak)) == Counter(rows_of(exact_dedup.exact_groups(edge, keep="max")))


def test_drop_exact_copies_keeps_one_row_and_all_columns(edge):
    out = exact_dedup.drop_exact_copies(edge, keep="max")
    assert out.columns == edge.columns
    texts = [r.text or "" for r in out.collect()]
    assert sorted(texts) == sorted({t or "" for _, t, *_ in EDGE_ROWS})


# --- 2 toxicity ---------------------------------------------------------------------------------

def test_toxicity_held_out(spark):
    docs, labels = read_table(spark, SF, "documents"), read_table(spark, SF, "labels")
    got = toxicity.score_documents(docs, toxicity.fit_toxicity(docs, labels)).join(labels, "doc_id").where("held_out")
    table = {(r.toxic, r.predicted): r.n for r in got.groupBy("toxic", "predicted").agg(F.count("*").alias("n")).collect()}
    assert table.get((0, 1), 0) <= 0.02 * (table.get((0, 0), 0) + table.get((0, 1), 0))
    assert table.get((1, 1), 0) >= 0.7 * (table.get((1, 1), 0) + table.get((1, 0), 0))


def test_toxicity_never_learns_from_held_out_labels(spark):
    docs = spark.createDataFrame([(i, "plain words here" + (" glorp" if i % 2 else "")) for i in range(60)],
                                 "doc_id long, text string")
    labels = spark.createDataFrame([(i, i % 2 if zlib.crc32(str(i).encode()) % 3 == 1 else 0) for i in range(60)],
                                   "doc_id long, toxic int")
    assert "=glorp" not in toxicity.fit_toxicity(docs, labels).weights


def test_toxicity_without_labels_and_on_edges(spark, edge, none):
    labels = spark.createDataFrame([], "doc_id long, toxic int")
    model = toxicity.fit_toxicity(edge, labels)
    got = toxicity.score_documents(edge, model).collect()
    assert len(got) == len(EDGE_ROWS) and all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.7) for r in got)
    assert not any(r.held_out for r in got if r.doc_id is None)
    assert rows_of(toxicity.score_documents(none, model)) == []
    out = toxicity.drop_toxic(edge, labels)
    assert out.columns == edge.columns and out.count() == len(EDGE_ROWS)
    bad = spark.createDataFrame([(1, "You IDIOT!", "en", "s", 1)], EDGE_SCHEMA)
    assert toxicity.drop_toxic(bad, labels).count() == 0


def test_label_model_discounts_voters_that_fire_together():
    rng = np.random.default_rng(1)
    y = (rng.random(2000) < 0.2).astype(int)
    a = (rng.random(2000) < np.where(y, 0.6, 0.02))
    b = (rng.random(2000) < np.where(y, 0.6, 0.02))
    model = toxicity.fit_label_model(np.stack([a, a, a, b], 1), y)
    assert model.share[0] < 0.5 and model.share[3] > 0.9
    assert abs(model.fire_toxic[3] - 0.6) < 0.1 and model.fire_clean[3] < 0.06


def test_samples_keep_their_expected_size_at_any_number_of_rows(spark):
    from tideline.llm.common import sample_bound, sampled
    for size in (3000, 20_000):
        for n in (size + 1, 10 ** 6, 3 * 10 ** 9, 4 * 10 ** 9, 3 * 10 ** 10, 10 ** 14):
            assert abs(sample_bound(size, n) / 2 ** 63 * n / size - 1) < 1e-9
    n = 1 << 24                                        # a share below 1 in 2**20
    assert 4 <= sampled(spark.range(n), "id", 15, n).count() <= 30


def test_an_empty_sample_of_labelled_rows_is_an_error(spark, monkeypatch):
    docs = spark.createDataFrame([(i, f"some words {i}", "en") for i in range(40)], "doc_id long, text string, lang string")
    labels = docs.select("doc_id", (F.col("doc_id") % 2).cast("int").alias("toxic"))
    monkeypatch.setattr(langid, "SAMPLE_DOCS", 0)
    monkeypatch.setattr(toxicity, "SAMPLE_ROWS", 0)
    with pytest.raises(RuntimeError, match="sample"):
        langid.fit_language_model(docs)
    assert langid.fit_language_model(docs.withColumn("text", F.lit("12 34"))) is None
    with pytest.raises(RuntimeError, match="sample"):
        toxicity.fit_toxicity(docs, labels)
    assert len(toxicity.fit_toxicity(docs, labels.withColumn("toxic", F.lit(0))).weights) == len(toxicity.SEED_LEXICON)


# --- 3 SimHash -----------------------------------------------------------------------------------

def _components(fps):
    """Smallest index reachable at 4 bits or fewer, by all pairs."""
    parent = list(range(len(fps)))

    def find(x):
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x
    f = np.array(fps, dtype=np.uint64)
    for i in range(len(f)):
        for j in np.flatnonzero(np.bitwise_count(f[i] ^ f) <= 4).tolist():
            a, b = find(i), find(j)
            parent[max(a, b)] = min(a, b)
    return [find(i) for i in range(len(f))]


def test_simhash_follows_its_definition(docs):
    import xxhash
    for t in [*list(docs.values())[:40], "", " ", "A b", "One two THREE four five", "é Ü x y z " * 3]:
        words = "".join(c.lower() if "A" <= c <= "Z" else c for c in t)
        words = [w for w in __import__("re").split(r"[\x20\x09-\x0D]+", words) if w]
        grams = [" ".join(words[i:i + 4]) for i in range(max(1, len(words) - 3))] if words else []
        hs = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
        want = sum(1 << b for b in range(64) if sum(h >> b & 1 for h in hs) * 2 > len(hs)) if hs else 0
        assert simhash.simhash(t) == want


def test_simhash_groups_match_all_pairs(spark):
    got = {r.doc_id: r for r in simhash.near_groups(read_table(spark, SF_SMALL, "documents")).collect()}
    ids = sorted(got)
    roots = _components([int(got[i].fingerprint, 16) for i in ids])
    assert [got[i].component_id for i in ids] == [ids[k] for k in roots]


@pytest.mark.parametrize("blocks,bucket", [(1, 256), (2, 256), (2, 4), (4, 256)])
def test_near_edges_give_the_components_of_all_pairs(spark, blocks, bucket):
    rng = np.random.default_rng(3)
    fps = []
    for _ in range(12):                                # chains and crowds of near fingerprints
        base = int(rng.integers(0, 1 << 63))
        for _ in range(int(rng.integers(1, 14))):
            fps.append(base)
            for b in rng.integers(0, 64, int(rng.integers(0, 4))):
                base ^= 1 << int(b)
    fps = sorted(set(fps))
    signed = [f - (1 << 64) if f >> 63 else f for f in fps]
    edges = simhash.near_edges(spark.createDataFrame([(f,) for f in signed], "fp long"), blocks=blocks, bucket=bucket)
    comp = {r.node: r.component for r in connected_components(edges).collect()}
    roots = _components(fps)
    same = defaultdict(set)
    for f, r in zip(signed, roots):
        same[r].add(f)
    mine = defaultdict(set)
    for f in signed:
        mine[comp.get(f, f)].add(f)
    assert sorted(map(sorted, mine.values())) == sorted(map(sorted, same.values()))


def test_hot_and_other_keys_join_alike(spark):
    rows = spark.range(6000).select(F.when(F.col("id") % 3 == 0, -1).otherwise(F.col("id") % 2500).alias("k"), "id")
    table = rows.groupBy("k").agg(F.min("id").alias("low"), F.count("*").alias("n"))
    got = simhash.join_by_key(rows, table, "k", "n", 6000)
    plain = rows.join(table.drop("n"), "k")
    assert got.count() == 6000 and got.exceptAll(plain).count() == 0


def test_simhash_edge_cases(edge, none):
    got = simhash.near_groups(edge).collect()
    assert len(got) == len(EDGE_ROWS)
    blank = [r for r in got if r.fingerprint == "0" * 16]
    assert len(blank) == 4 and {r.component_id for r in blank} == {1}
    assert rows_of(simhash.near_groups(none)) == []
    out = simhash.drop_near_copies(edge)
    assert out.columns == edge.columns
    kept = {r.component_id for r in got}
    assert out.count() == len(kept) and {r.doc_id for r in out.collect()} == kept
    assert simhash.drop_near_copies(none).count() == 0


def test_components_of_a_long_chain_and_a_hub(spark):
    edges = [(i, i + 1) for i in range(200)] + [(1000, 1000 + k) for k in range(1, 200)] + [(5, 5)]
    comp = {r.node: r.component for r in connected_components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert {comp[i] for i in range(201)} == {0} and {comp[1000 + k] for k in range(200)} == {1000}
    empty = spark.createDataFrame([], "a long, b long")
    assert connected_components(empty).count() == 0


# --- 4 suffix dedup --------------------------------------------------------------------------------

def _cut_repeats(texts, window):
    """(kept, removed, spans) of every text, by a table of all windows."""
    places = defaultdict(list)
    for d, t in enumerate(texts):
        for p in range(len(t) - window + 1):
            places[t[p:p + window]].append((d, p))
    marks = [bytearray(len(t)) for t in texts]
    for at in places.values():
        if len(at) > 1:
            for d, p in at:
                marks[d][p:p + window] = b"\1" * window
    out = []
    for t, m in zip(texts, marks):
        spans = sum(1 for k in range(len(m)) if m[k] and (k == 0 or not m[k - 1]))
        out.append((bytes(c for c, x in zip(t, m) if not x), sum(m), spans))
    return out


@pytest.mark.parametrize("part_bytes, hot, flush", [(1 << 14, 1 << 16, 1 << 17), (1 << 22, 1 << 16, 1 << 17),
                                                    (1 << 14, 4, 50), (1 << 14, 1, 1 << 17)])
def test_suffix_dedup_matches_brute_force(spark, monkeypatch, part_bytes, hot, flush):
    monkeypatch.setattr(suffix_dedup, "PART_BYTES", part_bytes)
    monkeypatch.setattr(suffix_dedup, "HOT_ITEMS", hot)
    monkeypatch.setattr(suffix_dedup, "FLUSH", flush)
    rng = np.random.default_rng(5)
    passage = letters(rng, 700).decode()
    rows = [(r.doc_id, r.text) for r in read_table(spark, SF_SMALL, "documents").limit(60).collect()]
    rows += [(1000 + k, letters(rng, 90).decode() + passage[k * 7:500 + k * 7]
              + letters(rng, 90).decode()) for k in range(12)]
    rows += [(2000, "ab" * 400), (2001, "x" * 199), (2002, "x" * 200), (2003, "y" * 201), (2004, None), (2005, ""),
             (2006, passage), (2006, passage), (2007, "ß" * 120 + passage[:210] + "日" * 90)]
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumn("part", F.lit("clash"))
    texts = [(t or "").encode() for _, t in rows]
    want = Counter((i, len(t), gone, spans, hashlib.sha256(kept).hexdigest())
                   for (i, _), t, (kept, gone, spans) in zip(rows, texts, _cut_repeats(texts, 200)))
    got = suffix_dedup.remove_repeats(df).select("doc_id", "_sfx_n_bytes", "_sfx_n_removed", "_sfx_n_spans",
                                                 F.sha2("_sfx_kept", 256))
    assert Counter(rows_of(got)) == want


def test_suffix_dedup_cuts_long_texts_into_pieces(monkeypatch):
    monkeypatch.setattr(suffix_dedup, "PIECE", 1000)
    rng = np.random.default_rng(9)
    text = letters(rng, 5000)
    starts = set()
    for _, a, _, r0, r1 in suffix_dedup.text_anchors([text, b"", text[:150]], 200):
        for at, lo, hi in zip(a.tolist(), r0.tolist(), r1.tolist()):
            found = set(range(at - hi, at - lo + 1))
            assert not found & starts
            starts |= found
    assert starts == set(range(5000 - 200 + 1))


def test_loser_tree_merges_with_right_prefix_lengths():
    rng = np.random.default_rng(2)
    for n_runs in (1, 2, 3, 7, 16):
        runs = []
        for _ in range(n_runs):
            items = sorted(letters(rng, rng.integers(0, 12), 99) for _ in range(rng.integers(0, 30)))
            blob = suffix_dedup.pack_run([(r, r[::-1], 1, 2, 1) for r in items]) if items else None
            runs.append(suffix_dedup.unpack_run(blob)[:2] if blob else ([], []))
        merged = [(runs[r][0][k], n) for r, k, n in suffix_dedup.LoserTree(runs)]
        assert [m[0] for m in merged] == sorted(x for r in runs for x in r[0])
        for (a, _), (b, n) in zip(merged, merged[1:]):
            assert n == suffix_dedup.common_prefix(a, b, 0)


def test_drop_repeats_edge_cases(edge, none):
    out = suffix_dedup.drop_repeats(edge)
    assert out.columns == edge.columns and out.schema.simpleString() == edge.schema.simpleString()
    rows = out.collect()
    assert len(rows) == len(EDGE_ROWS)
    assert [r.text for r in rows if r.doc_id == 1] == [None] and [r.text for r in rows if r.doc_id == 5] == [""]
    assert all(r.n_chars == 0 for r in rows if r.doc_id == 5)
    assert suffix_dedup.drop_repeats(none).count() == 0


# --- 5 chat ----------------------------------------------------------------------------------------

def test_link_calls(spark):
    calls = spark.createDataFrame([
        ("a", None, "add", '{"y":2, "x":1}'), ("b", "a", "add", '{"x":"1","z":0}'), ("c", "b", "nope", "{}"),
        ("d", "e", "add", "[1]"), ("e", "d", "add", "not json"), ("f", "gone", "add", None), (None, None, "add", "{}"),
        ("a", None, "add", '{"y":9, "x":1}')], "call_id string, after_id string, name string, arguments string")
    results = spark.createDataFrame([("a", 'say "3"\n'), ("a", "zz"), ("q", "lost"), ("b", None)],
                                    "call_id string, content string")
    schemas = spark.createDataFrame([("add", "x", "integer", True), ("add", "y", "number", True)],
                                    "name string, field string, kind string, required boolean")
    got = {r.call_id: r for r in chat.link_calls(calls, results, schemas).collect()}
    assert {k: (r.level, r.status, r.errors) for k, r in got.items()} == {
        "a": (0, "linked", ""), "b": (1, "linked", "x: not integer,y: missing,z: unknown"),
        "c": (2, "no_result", "tool: unknown"), "d": (-1, "no_result", "arguments: not an object"),
        "e": (-1, "no_result", "arguments: not an object"), "f": (0, "no_result", "arguments: not an object"),
        "q": (None, "no_call", "")}
    assert got["a"].json == '{"arguments":{"x":1,"y":2},"id":"a","level":0,"name":"add","result":"say \\"3\\"\\n"}'
    assert got["b"].json.endswith('"result":null}') and '"arguments":"not json"' in got["e"].json
    assert chat.link_calls(calls.limit(0), results.limit(0), schemas).count() == 0


def test_lookup_tables_join_alike_below_and_beyond_the_bound(spark):
    from tideline.llm.common import lookup
    table = spark.range(50).select("id", (F.col("id") * 2).alias("twice"))
    rows = spark.range(500).select((F.col("id") % 70).alias("id"))
    small, large = rows.join(lookup(table, 50), "id"), rows.join(lookup(table, 49), "id")
    assert lookup(table, 49) is table and lookup(table, 50) is not table
    assert small.count() == large.count() and small.exceptAll(large).count() == 0


def test_call_levels_of_a_long_chain(spark):
    rows = [(str(i), str(i - 1) if i else None) for i in range(100)]
    got = {r.call_id: r.level for r in chat.call_levels(
        spark.createDataFrame(rows, "call_id string, after_id string")).collect()}
    assert got == {str(i): i for i in range(100)}


# --- 6 fingerprints ------------------------------------------------------------------------------------

@pytest.mark.parametrize("part_bytes", [20_000, 1 << 23])
def test_fingerprints_match_brute_force(spark, docs, monkeypatch, part_bytes):
    monkeypatch.setattr(fingerprint, "PART_BYTES", part_bytes)
    got = {r.doc_id: r for r in queries.op6_document_fingerprints(spark, SF_SMALL).collect()}
    order = sorted(docs, reverse=True)
    assert sorted(got) == sorted(docs)
    for i, n in zip(order, [*order[1:], order[0]]):
        t, half = docs[i], len(docs[i]) // 2
        new = t[:len(t) - half] + docs[n][:half]
        own, other, after = (fingerprint.digest(x.encode()) for x in (t, docs[n], new))
        assert tuple(got[i])[1:5] == (len(t), hashlib.sha256(new.encode()).hexdigest(), own.hex(), after.hex())
        assert got[i].near_edited == fingerprint.likeness(own, after)
        assert got[i].near_next == fingerprint.likeness(own, other)
    assert np.mean([r.near_edited > r.near_next for r in got.values()]) > 0.95


def test_fingerprint_edge_cases(spark, edge, none):
    got = fingerprint.fingerprint_with_edits(edge).collect()
    assert len(got) == len(EDGE_ROWS) and all(0 <= r.near_edited <= 1 and 0 <= r.near_next <= 1 for r in got)
    by_text = defaultdict(set)
    for (i, t, *_) in EDGE_ROWS:
        by_text[t or ""].add(fingerprint.digest((t or "").encode()).hex())
    assert all(len(v) == 1 for v in by_text.values())
    assert rows_of(fingerprint.fingerprint_with_edits(none)) == []
    one = spark.createDataFrame([(1, "abcdef")], "doc_id long, text string")
    assert fingerprint.fingerprint_with_edits(one).first().edited_sha256 == hashlib.sha256(b"abcabc").hexdigest()


# --- 7 packing ----------------------------------------------------------------------------------------

def _check_packing(rows, capacity):
    """Gapless sequences within the capacity; returns their number."""
    by = defaultdict(list)
    for r in rows:
        by[r.sequence_id].append((r.offset, r.length))
    for parts in by.values():
        at = 0
        for off, length in sorted(parts):
            assert off == at
            at += length
        assert at <= capacity
    return len(by)


def test_packing_pieces_and_sequences(spark, docs):
    rows = queries.op7_best_fit_packing(spark, SF_SMALL).collect()
    n = _check_packing(rows, 2048)
    assert n == packing.lower_bound(Counter(r.length for r in rows), 2048)
    encode = encoding(vocabulary_path("byte_bpe_50k.tiktoken")).encode_ordinary
    by = defaultdict(list)
    for r in rows:
        by[r.doc_id].append(r)
    assert set(by) == set(docs)
    for i, parts in by.items():
        ids, at = np.array([*encode(docs[i]), 0], "<u4"), 0
        for k, r in enumerate(sorted(parts, key=lambda r: r.piece)):
            assert (r.piece, r.start) == (k, at)
            assert r.ids_crc32 == zlib.crc32(ids[at:at + r.length].tobytes())
            assert r.length <= 2048 and (k == 0 or r.length == 2048)
            at += r.length
        assert at == len(ids)


def test_rank_file_gives_the_tokenizer_files_ids(docs):
    from tokenizers import Tokenizer
    one = Tokenizer.from_file(vocabulary_path("byte_bpe_50k.json"))
    one.encode_special_tokens = True
    encode = encoding(vocabulary_path("byte_bpe_50k.tiktoken")).encode_ordinary
    for t in [*list(docs.values())[:50], "", " ", "\n\n a  b\t", "it's 12 ÀÉ 日本 🙂\r\n", "<|endoftext|>"]:
        assert one.encode(t, add_special_tokens=False).ids == encode(t)


def test_packed_ids_are_those_of_the_unmodified_tokenizer_file(spark):
    from tokenizers import Tokenizer
    one = Tokenizer.from_file(vocabulary_path("byte_bpe_50k.json"))
    end = "<|endoftext|>"
    texts = [f"page{end}next", end, end * 3, f" a {end} b\n\n {end}\n", f"<|{end}|>", end[:-1] + " " + end[1:],
             end.upper(), "word " * 3000 + end + " tail" * 3000, "plain"]
    want = {}
    for i, t in enumerate(texts):
        ids = np.array([*one.encode(t, add_special_tokens=False).ids, 0], "<u4")
        cuts = [0, *range(len(ids) % 2048 or 2048, len(ids) + 1, 2048)]
        want |= {(i, a): (b - a, zlib.crc32(ids[a:b].tobytes())) for a, b in zip(cuts, cuts[1:])}
    rows = packing.pack(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).collect()
    assert {(r.doc_id, r.start): (r.length, r.ids_crc32) for r in rows} == want


def test_packing_edge_cases(edge, none):
    rows = packing.pack(edge).collect()
    _check_packing(rows, 2048)
    assert sorted((r.doc_id or 0) for r in rows if r.piece == 0) == sorted((i or 0) for i, *_ in EDGE_ROWS)
    assert rows_of(packing.pack(none)) == []


def _fewest(items, capacity):
    items, best = sorted(items, reverse=True), [len(items)]

    def go(k, rooms):
        if len(rooms) >= best[0]:
            return
        if k == len(items):
            best[0] = len(rooms)
            return
        for j in sorted({r: j for j, r in enumerate(rooms) if r >= items[k]}.values()):
            go(k + 1, rooms[:j] + [rooms[j] - items[k]] + rooms[j + 1:])
        go(k + 1, rooms + [capacity - items[k]])
    go(0, [])
    return best[0]


def test_bin_completion_is_optimal_on_small_cases():
    rng = np.random.default_rng(4)
    for _ in range(60):
        items = rng.integers(1, 21, rng.integers(1, 11)).tolist()
        bins = packing.complete_bins(dict(Counter(items)), 20)
        assert Counter(l for p, n in bins for l in p * n) == Counter(items) and all(sum(p) <= 20 for p, _ in bins)
        assert sum(n for _, n in bins) == _fewest(items, 20)


def test_bin_completion_reaches_the_bound_on_coarse_histograms():
    for k in (10, 1000, 100_000):
        for hist in ({1000: k, 262: 4 * k}, {1048: k, 250: 4 * k, 400: 5}, {1048: k, 250: 4 * k, 400: 50}):
            bins = packing.complete_bins(hist, 2048)
            assert sum(n for _, n in bins) == packing.lower_bound(hist, 2048)
            assert sum((Counter({l: c * n for l, c in Counter(p).items()}) for p, n in bins), Counter()) == hist
            assert all(sum(p) <= 2048 for p, _ in bins)


def test_all_fillings_are_the_undominated_sets():
    from itertools import product
    rng = np.random.default_rng(6)
    for _ in range(100):
        room, counts = int(rng.integers(1, 25)), np.zeros(40, np.int64)
        for l in rng.integers(1, 25, rng.integers(1, 6)):
            counts[l] += rng.integers(1, 4)
        have = [l for l in range(1, room + 1) if counts[l]]
        want = set()
        for ks in product(*[range(counts[l] + 1) for l in have]):
            waste = room - sum(l * k for l, k in zip(have, ks))
            if waste < 0:
                continue
            parts = [(sum(l * k for l, k in zip(have, js)), sum(js)) for js in product(*[range(k + 1) for k in ks])]
            unused = [l for l, k in zip(have, ks) if counts[l] > k]
            if not any(s <= x <= s + waste and (m != 1 or s < x) for x in unused for s, m in parts):
                want.add(tuple(sorted((l for l, k in zip(have, ks) for _ in range(k)), reverse=True)))
        got = [p for p in packing.all_fillings(counts, room) if p is not None]
        assert len(got) == len(set(got)) and set(got) == want


def test_best_fit_and_completion_keep_every_item():
    rng = np.random.default_rng(8)
    for _ in range(20):
        hist = {int(l): int(rng.integers(1, 400)) for l in rng.integers(1, 2049, rng.integers(1, 200))}
        for bins in (packing.best_fit(hist, 2048), packing.complete_bins(hist, 2048)):
            got = Counter()
            for p, n in bins:
                assert sum(p) <= 2048
                for l in p:
                    got[l] += n
            assert got == Counter(hist)


# --- 8 language ---------------------------------------------------------------------------------------

def test_language_held_out(spark, edge, none):
    docs = read_table(spark, SF, "documents")
    net = langid.fit_language_model(docs)
    got = langid.identify(docs, net).join(docs.select("doc_id", "lang"), "doc_id").where("held_out and lang is not null")
    right = got.select(F.avg((F.col("lang") == F.col("lang_pred")).cast("int"))).first()[0]
    assert right >= 0.97
    rows = langid.identify(edge, net).collect()
    assert len(rows) == len(EDGE_ROWS) and all(0 <= r.score <= 1 for r in rows)
    assert sum(r.lang_pred == "und" for r in rows) == 4
    assert rows_of(langid.identify(none, net)) == []
    assert langid.fit_language_model(none) is None
    assert {r.lang_pred for r in langid.identify(edge, None).collect()} == {"und"}


def test_byte_net_gradients():
    rng = np.random.default_rng(0)
    x, y = rng.integers(0, 257, (3, langid.WINDOW)).astype(np.int16), np.array([0, 1, 1])
    net = langid.train(x, y, ["a", "b"])
    for p in net.params():
        assert np.isfinite(p).all()
    net = langid.ByteNet(["a", "b"], net.embed.astype(float), [(w.astype(float), b.astype(float)) for w, b in net.banks],
                         (rng.normal(size=net.out[0].shape) * 0.05, np.zeros(2)))
    for p, g in zip(net.params(), net.gradients(x, y)):
        k = tuple(int(i) for i in np.unravel_index(np.abs(g).argmax(), g.shape))
        old, losses = p[k], []
        for d in (1e-6, -1e-6):
            p[k] = old + d
            losses.append(-net.forward(x)[0][np.arange(3), y].mean())
        p[k] = old
        assert abs((losses[0] - losses[1]) / 2e-6 - g[k]) < 1e-4


def test_tabulated_network_agrees():
    rng = np.random.default_rng(5)
    x, y = rng.integers(0, 257, (70, langid.WINDOW)).astype(np.int16), rng.integers(0, 3, 70)
    net = langid.train(x, y, ["a", "b", "c"])
    assert np.allclose(net.predictor(batch=32)(x), net.forward(x)[0], atol=1e-3)


# --- 9 licences ----------------------------------------------------------------------------------------

def test_licence_scan(spark, edge, none):
    mit = dict(licences.KNOWN[:1])["MIT"]
    rows = [(1, mit.upper().replace(",", " ,")), (2, "Copyright (c) 2020 X\nAll rights reserved.\n" + mit),
            (3, "prose\nreleased under the mit licence!\nmore"), (4, mit + " extra"), (5, None), (6, ""),
            (7, "Licensed under the Apache Licence, Version 2.0\nSPDX-License-Identifier: MIT"), (1, mit.upper())]
    got = sorted((r.doc_id, r.license, r.line_licenses) for r in licences.scan_licences(
        spark.createDataFrame(rows, "doc_id long, text string")).collect() if r.doc_id != 1)
    assert got == [(2, "MIT", "MIT"), (3, None, "MIT"), (4, None, "MIT"), (5, None, ""), (6, None, ""),
                   (7, None, "Apache-2.0,MIT")]
    assert licences.scan_licences(edge).count() == len(EDGE_ROWS) and licences.scan_licences(none).count() == 0


#: The MIT text in its published layout, typed here and not taken from KNOWN.
MIT_PUBLISHED = """MIT License

Copyright (c) 2024 Jane Doe

Permission is hereby granted, free of charge, to any person obtaining a copy
of this software and associated documentation files (the "Software"), to deal
in the Software without restriction, including without limitation the rights
to use, copy, modify, merge, publish, distribute, sublicense, and/or sell
copies of the Software, and to permit persons to whom the Software is
furnished to do so, subject to the following conditions:

The above copyright notice and this permission notice shall be included in all
copies or substantial portions of the Software.

THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR
IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY,
FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE
AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER
LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM,
OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE
SOFTWARE.
"""
NOTICES = ["", "Copyright (c) 2020 Jane Doe\nAll rights reserved.\n", "Copyright 2019-2021, A; B\n(c) 2022 C\n© D\n",
           "Copyright (C) <year> <owner>\n\n", "Copyright Foundation and other contributors\n\n", "Copyright © 2020 X\r\n"]


def test_whole_licences_match_in_any_wrapping(spark):
    import textwrap
    rows, want = [], {}
    texts = [("MIT", MIT_PUBLISHED), ("MIT", MIT_PUBLISHED.split("Doe\n\n")[1])]
    texts += [(k, t) for k, t in licences.KNOWN if len(t) > 500]
    assert {k for k, _ in texts} == {"MIT", "ISC", "Zlib", "BSD-2-Clause", "BSD-3-Clause"}
    for k, text in texts:
        body = [" ".join(p.split()) for p in text.split("\n\n") if not p.startswith("Copyright")]
        shapes = [text, " ".join(body), "\n".join(" ".join(body).split()), "\n\n".join(" ".join(body).split()),
                  text.replace("\n", "\r\n")]
        shapes += ["\n\n".join(textwrap.fill(p, w) for p in body) for w in range(30, 131)]
        shapes += [n + s for n in NOTICES for s in shapes[:1] + shapes[30:33]]
        for t in shapes:
            want[len(rows)] = k
            rows.append((len(rows), t))
    got = licences.scan_licences(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert len(got) == len(rows) and {r.doc_id: r.license for r in got} == want


def test_known_digests_are_of_one_licence_and_hold_the_notices_of_the_documents(spark):
    known = licences.known_digests(spark)
    assert known.groupBy("digest").count().where("count > 1").count() == 0
    lines = ["Licensed under CC BY-NC 4.0.", "licensed under CC-BY-NC 4.0", "SPDX-License-Identifier: CC-BY-NC-4.0",
             "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License."]
    rows = spark.createDataFrame([(i, f"prose\n{t}\nmore") for i, t in enumerate(lines)], "doc_id long, text string")
    assert [r.line_licenses for r in licences.scan_licences(rows).collect()] == ["CC-BY-NC-4.0"] * len(lines)
    docs = read_table(spark, SF, "documents")
    named = docs.where("text like '%icensed under CC BY-NC 4.0.%'")
    assert named.count() == 4
    assert {r.line_licenses for r in licences.scan_licences(named).collect()} == {"CC-BY-NC-4.0"}


# --- 10 BPE --------------------------------------------------------------------------------------------

@pytest.mark.parametrize("part_bytes", [30_000, 1 << 23])
def test_bpe_round_trip(spark, docs, edge, none, monkeypatch, part_bytes):
    monkeypatch.setattr(bpe, "PART_BYTES", part_bytes)
    encode = encoding(vocabulary_path("byte_bpe_multi_50k.tiktoken")).encode_ordinary

    def want(i, t):
        ids = np.array(encode(t), "<u4")
        return i, len(ids), hashlib.sha256(ids.tobytes()).hexdigest(), hashlib.sha256(t.encode()).hexdigest()
    got = queries.op10_byte_bpe(spark, SF_SMALL)
    assert Counter(rows_of(got)) == Counter(want(i, t) for i, t in docs.items())
    assert Counter(rows_of(bpe.encode_and_decode(edge))) == Counter(want(i, t or "") for i, t, *_ in EDGE_ROWS)
    assert rows_of(bpe.encode_and_decode(none)) == []


# --- pipeline ---------------------------------------------------------------------------------------------

def test_pipeline_stages_match_brute_force(spark):
    docs = read_table(spark, SF_SMALL, "documents")
    seen = {}
    for name, stage in corpus_pipeline.STAGES:
        before = docs
        path = f"{spark.conf.get('spark.checkpoint.dir', None) or queries_scratch(spark)}/stage-test-{name}"
        stage(spark, before, SF_SMALL).write.mode("overwrite").parquet(path)
        docs = spark.read.parquet(path)
        seen[name] = ([tuple(r) for r in before.select("doc_id", "text").collect()], docs)
        if name != "best_fit_packing":
            assert docs.columns == before.columns
    rows, out = seen["exact_dedup"]
    last = {}
    for i, t in rows:
        last[t] = max(i, last.get(t, i))
    assert sorted(r.doc_id for r in out.collect()) == sorted(last.values())
    rows, out = seen["simhash_near_dedup"]
    rows.sort()
    roots = _components([simhash.simhash(t or "") for _, t in rows])
    assert sorted(r.doc_id for r in out.collect()) == sorted({rows[k][0] for k in roots})
    rows, out = seen["suffix_array_dedup"]
    want = {i: kept.decode("utf-8", "ignore") for (i, _), (kept, _, _) in
            zip(rows, _cut_repeats([(t or "").encode() for _, t in rows], 200))}
    assert {r.doc_id: r.text for r in out.collect()} == want
    _check_packing(docs.collect(), 2048)


def queries_scratch(spark):
    from tideline.session import scratch_root
    return scratch_root(spark)


def test_pipeline_runs_on_an_empty_table(spark, none):
    docs = none
    labels_dir = SF_SMALL
    for name, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, labels_dir)
    assert docs.count() == 0


def test_suffix_dedup_tasks_follow_the_number_of_parts(spark, monkeypatch):
    monkeypatch.setattr(suffix_dedup, "PART_BYTES", 1 << 12)
    docs = read_table(spark, SF_SMALL, "documents")
    size = docs.agg(F.sum(F.octet_length("text"))).first()[0]
    tasks = -(-size // (1 << 12)) // suffix_dedup.PARTS_PER_TASK
    assert tasks > int(spark.conf.get("spark.sql.shuffle.partitions"))
    plan = suffix_dedup.remove_repeats(docs)._jdf.queryExecution().executedPlan().toString()
    by_part = re.findall(r"Exchange hashpartitioning\(part#\d+, (\d+)\)", plan)
    assert by_part and set(by_part) == {str(tasks)}
