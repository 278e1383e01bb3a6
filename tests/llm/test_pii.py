"""Personal data: base spans against the plain patterns, added spans on planted
cases, very long texts and edge cases."""

import random
import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL
from tideline.llm import pii, queries
from tideline.llm.common import read_table

SCHEMA = "doc_id long, text string"
PLAIN = (("email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+"), ("ip", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)"),
         ("card", r"[0-9]([\x20-]?[0-9])+"), ("phone", r"\+[0-9][\x20().0-9-]+[0-9]"))


def luhn(digits):
    total = 0
    for k, c in enumerate(reversed(digits)):
        v = int(c) * (1 + k % 2)
        total += v - 9 if v > 9 else v
    return total % 10 == 0


def plain_base(text):
    out = []
    for k, (kind, pattern) in enumerate(PLAIN):
        for m in re.finditer(pattern, text or ""):
            d = re.sub(r"[^0-9]", "", m.group())
            if (kind == "ip" and any(int(x) > 255 for x in m.group().split("."))
                    or kind == "card" and not (14 <= len(d) <= 19 and luhn(d))
                    or kind == "phone" and not 10 <= len(d) <= 15):
                continue
            out.append((m.start(), k, m.end()))
    return sorted(out)


def found(df):
    return [(r.doc_id, [tuple(s) for s in r.base], [tuple(s) for s in r.spans])
            for r in pii.find_personal_data(df).collect()]


@pytest.fixture(scope="module")
def fuzz():
    rng = random.Random(5)
    parts = ["@", ".", "a", "b.c", "-", "_", "%", "+", "+1", " ", "(", ")", "1", "23", "255", "256", "007", "x@y.z", "1.2.3.4",
             "4111 1111 1111 1111", "4111111111111111", "é", "日", "\n", "+1 (017) 555-7713", "..", "@@", "0", "𝔘"]
    return [(k, "".join(rng.choice(parts) for _ in range(rng.randint(0, 14)))) for k in range(4000)]


def test_base_spans_equal_the_plain_patterns(spark, fuzz):
    docs = spark.createDataFrame(fuzz, SCHEMA)
    for _, base, spans in (rows := found(docs)):
        assert set(base) <= set(spans)
        added = set(spans) - set(base)
        assert not any(a[0] < b[2] and b[0] < a[2] for a in added for b in base)
    text = dict(fuzz)
    assert [d for d, base, _ in rows if base != plain_base(text[d])] == []


def test_given_tables(spark):
    docs = read_table(spark, SF_SMALL, "documents")
    text = {r.doc_id: r.text for r in docs.collect()}
    rows = queries.op12_personal_data(spark, SF_SMALL).collect()
    assert len(rows) == len(text)
    for r in rows:
        want = plain_base(text[r.doc_id])
        assert [r.n_email, r.n_ip, r.n_card, r.n_phone] == [sum(s[1] == k for s in want) for k in range(4)]
        assert {f"{pii.KINDS[k]}:{a}:{b}" for a, k, b in want} <= set(r.spans.split(","))


def test_the_method_adds_spans_and_leaves_decoys(spark):
    plain = "and so the river runs along the bank. "
    given = [f"{plain}Mail a{k}.b@site{k}.com or +1 (2{k % 10}7) 555-71{k % 90 + 10} from 10.{k % 200}.3.4. {plain}" for k in range(120)]
    hidden = ["please e-mail john.doe [at] example [dot] com soon", "phone: (217) 555-7713, thanks", "tel. 217-555-7713.",
              "the server 10[.]20[.]30[.]41 is up", "+1 (826) 555-4081 190.137.223.204 du", "+1 (826) 555-4081 4111111111111111 du"]
    decoys = ["on 2024-01-10 we met", "version 4.0.1 of it", "ref 9807915762804490 here", "ISBN 978-0-306-40615-7.",
              "token = \"85687d33eeaaf9ac699e1188f962\"", "from 1990-2001 and 12 345 678 people", "mail at noon"]
    rows = [(k, t) for k, t in enumerate(given + hidden + decoys)]
    got = {d: (base, spans) for d, base, spans in found(spark.createDataFrame(rows, SCHEMA))}
    text = dict(rows)
    for d in range(len(given), len(given) + len(hidden)):
        base, spans = got[d]
        assert set(spans) - set(base), text[d]
    for d in range(len(given) + len(hidden), len(rows)):
        assert got[d][1] == got[d][0] == [], (text[d], got[d])
    both = [text[len(given) + 4][a:b] for a, k, b in got[len(given) + 4][1]]
    assert both == ["+1 (826) 555-4081", "190.137.223.204"]


def test_very_long_texts_and_edge_cases(spark):
    n = 240_000                                         # too long for the quadratic patterns of plain_base
    long = [("a" * n, []), ("1." * (n // 2), [(8 * k, 1, 8 * k + 7) for k in range(n // 8)]), ("1 2" * (n // 3), []),
            ("+1" + "(" * n, []), ("a@" * (n // 2), []), ("a@b" + ".c" * n, [(0, 0, 2 * n + 3)]), (" " * n, []),
            ("1" * n, []), ("a@b.c " * 20_000, [(6 * k, 0, 6 * k + 5) for k in range(20_000)]),
            ("1.2.3.4 x " * 9000, [(10 * k, 1, 10 * k + 7) for k in range(9000)]), ("john (at) " * 20_000, []),
            ("1-" * (n // 2), [])]
    rows = [(1, None), (2, ""), (None, "x@y.z"), (None, None), (3, "x@y.z"), (3, "x@y.z"), ((1 << 60) + 1, "é x@y.z 日 1.2.3.4"),
            *[(100 + k, t) for k, (t, _) in enumerate(long)]]
    docs = spark.createDataFrame(rows, SCHEMA).repartition(8)
    for c in ("base", "cands", "c", "b_email", "c_m", "spans"):
        docs = docs.withColumn(c, F.lit("clash"))
    got = Counter((d, tuple(base)) for d, base, _ in found(docs))
    assert got == Counter((d, tuple(long[d - 100][1] if d and 100 <= d < 200 else plain_base(t))) for d, t in rows)
    assert found(spark.createDataFrame([], SCHEMA)) == []
    assert sorted(found(spark.createDataFrame([(1, "nothing here"), (2, None)], SCHEMA))) == [(1, [], []), (2, [], [])]


def test_label_model_learns_which_labelers_to_trust(spark):
    names = [x.name for x in pii.LABELERS]
    good, bad = 1 << names.index("base_regex"), 1 << names.index("counter_context")
    cue = 1 << names.index("context")
    rows = [(3, good | cue, 400), (3, bad, 300), (3, bad | cue, 2), (3, good, 100)]
    rates = pii.label_reliability(spark.createDataFrame(rows, "kind int, bits int, n long"))
    assert rates[3][names.index("context")] > 0.95 and rates[3][names.index("counter_context")] > 0.9
    assert rates[0] == [x.reliability for x in pii.LABELERS]        # a kind without candidates keeps the first guess


def test_main_path_is_native(spark):
    docs = read_table(spark, SF_SMALL, "documents")
    plan = pii.base_and_candidates(docs, "doc_id", "text")._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Exchange" not in plan
