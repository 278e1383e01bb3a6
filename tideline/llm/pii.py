"""Personal data by weak supervision, on DataFrame functions alone.

Strict patterns give the base spans.  A wider search collects candidate spans
with the text beside them; regex, gazetteer and context labelers vote on each
or abstain.  Expectation maximisation over the distinct vote patterns estimates
how reliable every labeler is, and a linear classifier trained on the posterior
labels decides which candidates join the base spans.  A text's spans stay in
its own row: the texts are read once and never shuffled, and what the model is
fitted on is one row per distinct vote pattern."""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import materialize, text_of

KINDS = ("email", "ip", "card", "phone")
#: The base patterns in a form that takes linear time and constant stack: repeats that nothing can shorten are
#: possessive, and a match starts where a run of its first characters starts or the last match ended.
BASE = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[ -]?[0-9])++",
    "phone": r"\+[0-9][ ().0-9-]+[0-9]",
}
_OCTETS = r"^(?:0*(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[0-9]?[0-9])(?:\.|$)){4}$"
#: Candidate forms, tried in this order: written-out addresses, spaced or bracketed addresses, colon addresses, numbers.
CANDIDATES = "|".join((
    BASE["email"],
    r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]{1,64}+ ?(?:[\[({<] ?(?:at|AT|@) ?[\])}>]| (?:at|AT) ) ?[A-Za-z0-9-]{1,63}+"
    r"(?: ?(?:[\[({<] ?(?:dot|DOT|\.) ?[\])}>]|(?:dot|DOT) |\.) ?[A-Za-z0-9-]{1,63}+){1,6}+",
    r"(?<![0-9A-Za-z.])[0-9]{1,3}+(?:(?:\.|\[\.\]|\(\.\)| \. )[0-9]{1,3}+){3}(?!\.?[0-9A-Za-z])",
    r"(?<![0-9A-Za-z:.])(?:[0-9A-Fa-f]{1,4}:){7}[0-9A-Fa-f]{1,4}(?![0-9A-Za-z:])",
    r"\+[0-9]{1,3}[ .-]?(?:\([0-9]{1,5}\)|[0-9]{1,5})(?:[ .-]?[0-9]{2,5}){1,4}(?!\.?[0-9])",
    r"(?<![0-9A-Za-z])[0-9](?:[ .-]?[0-9]){12,18}(?![0-9A-Za-z])",
    r"(?<![0-9A-Za-z+(])(?:\([0-9]{2,5}\) ?|[0-9]{2,5}[ .-])[0-9]{2,4}[ .-][0-9]{2,4}(?:[ .-][0-9]{2,4})?(?![0-9A-Za-z])",
))
#: Characters of context kept before and after a candidate.
LEFT, RIGHT = 32, 8
#: Prefix sums run over blocks of this many matches, so a text with very many of them stays near linear.
SCAN_BLOCK = 256

# --- fixed gazetteers and cue words ------------------------------------------------------------
ENDINGS = "com org net edu gov mil int info biz io co me app dev ai eu de fr es it nl uk us ca au ch at be pl se jp cn in br"
CARD_PREFIX = r"^(?:4|5[1-5]|2[2-7]|3[47]|6011|65|64[4-9]|35|30[0-5]|36|38)"
RESERVED_IP = r"^0*(?:0|127|255)\."
CUES = {
    "email": "e-?mail|mail|courriel|correo|contact|kontakt|write|reach",
    "ip": "ip|host|server|address|adresse|login|client|peer",
    "card": "card|karte|carte|tarjeta|visa|mastercard|amex|credit|debit|payment|cc",
    "phone": "tel|telephone|telefon|phone|call|fax|mobile|mobil|cell|dial|ring|whatsapp|sms",
}
COUNTER_CUES = ("version|v|isbn|issn|doi|order|invoice|sku|serial|page|vol|volume|section|chapter|token|sha|sha1|sha256|hash|"
                "commit|build|part|item|ref|article|license|lines|total|sum|price|eur|usd")


def running_totals(sizes: Column) -> Column:
    """Sum of all earlier items, for each item of an array of long."""
    def scan(items, first):
        start = F.struct(first.alias("s"), F.array().cast("array<bigint>").alias("o"))
        return F.aggregate(items, start, lambda acc, x: F.struct(
            (acc["s"] + x).alias("s"), F.array_append(acc["o"], acc["s"]).alias("o")), lambda acc: acc["o"])
    last = F.floor((F.size(sizes) - 1) / SCAN_BLOCK).cast("int")
    blocks = F.transform(F.sequence(F.lit(0), last), lambda b: F.slice(sizes, b * SCAN_BLOCK + 1, F.lit(SCAN_BLOCK)))
    zero = F.lit(0).cast("long")
    totals = scan(F.transform(blocks, lambda b: F.aggregate(b, zero, lambda a, x: a + x)), zero)
    return F.flatten(F.zip_with(blocks, totals, scan))


def with_matches(df: DataFrame, text: str, pattern: str, out: str) -> DataFrame:
    """Adds ``out``: the leftmost non-overlapping matches of a text as
    ``array<struct<t, l, r, start, end>>`` (match, context, code point offsets)."""
    m, p, w, s, empty = f"{out}_m", f"{out}_p", f"{out}_w", f"{out}_s", F.lit(None)
    df = df.withColumn(m, F.regexp_extract_all(text, F.lit(pattern), F.lit(0)))
    some = F.size(m) > 0
    df = df.withColumn(p, F.when(some, F.split(text, pattern, -1)))
    df = df.withColumn(w, F.when(some, F.zip_with(
        F.slice(p, 1, F.size(m)), m, lambda a, b: (F.length(a) + F.length(b)).cast("long"))))
    df = df.withColumn(s, F.when(some, running_totals(F.col(w))))

    def at(i):
        start = F.get(s, i) + F.length(F.get(p, i))
        return F.struct(F.get(m, i).alias("t"), F.right(F.get(p, i), F.lit(LEFT)).alias("l"),
                        F.left(F.get(p, i + 1), F.lit(RIGHT)).alias("r"), start.alias("start"),
                        (start + F.length(F.get(m, i))).alias("end"))
    kind = "array<struct<t:string,l:string,r:string,start:bigint,end:bigint>>"
    found = F.transform(F.sequence(F.lit(0), F.size(m) - 1), at)
    return df.withColumn(out, F.when(some, found).otherwise(empty.cast(kind))).drop(m, p, w, s)


def _digits(t: Column) -> Column:
    return F.regexp_replace(t, "[^0-9]", "")


def base_ok(kind: str, t: Column) -> Column:
    """The check that a match of a base pattern must pass."""
    if kind == "ip":
        return t.rlike(_OCTETS)
    if kind == "card":
        return F.length(_digits(t)).between(14, 19) & F.when(F.length(_digits(t)) <= 19, F.call_function("luhn_check", _digits(t)))
    if kind == "phone":
        return F.length(_digits(t)).between(10, 15)
    return F.lit(True)


def kind_of(t: Column) -> Column:
    """Number of the kind that a candidate's form stands for."""
    return (F.when(t.rlike(r"@|\b(?:at|AT)\b"), 0)
            .when(t.rlike(r"^[0-9]+(?:(?:\.|\[\.\]|\(\.\)| \. )[0-9]+){3}$|^(?:[0-9A-Fa-f]+:){7}"), 1)
            .when(t.startswith("+"), 3).when(F.length(_digits(t)) >= 13, 2).otherwise(3))


@dataclass(frozen=True)
class Labeler:
    """A voter: what it says when it fires, and how often it is taken to be right at first."""
    name: str
    says: int
    reliability: float
    fires: object                                      # (kind, t, l, r) -> Column


def _by_kind(kind: Column, **conditions) -> Column:
    out = F.lit(False)
    for name, cond in conditions.items():
        out = F.when(kind == KINDS.index(name), cond).otherwise(out)
    return out


def _cue(left: Column, words: str) -> Column:
    return left.rlike(rf"(?i)(?:^|[^a-z])(?:{words})(?:[^a-z0-9][^0-9]{{0,12}})?$")


def _base_regex(kind, t, l, r):
    return _by_kind(kind, **{k: t.rlike(f"^(?:{BASE[k]})$") & F.coalesce(base_ok(k, t), F.lit(False)) for k in KINDS})


def _shape(kind, t, l, r):
    n = F.length(_digits(t))
    return _by_kind(kind, email=t.rlike(r"[. ][A-Za-z]{2,12}$|\][A-Za-z ]{2,13}$|\)[A-Za-z ]{2,13}$"),
                    ip=F.regexp_replace(t, r"[\[\]() ]", "").rlike(_OCTETS) | t.contains(":"),
                    card=n.between(13, 19) & F.when(n <= 19, F.call_function("luhn_check", _digits(t))),
                    phone=n.between(9, 15) & t.rlike(r"^\+|\(|^0|^[0-9]{3}[ .-][0-9]{3}[ .-][0-9]{4}$"))


def _gazetteer(kind, t, l, r):
    ends = "|".join(ENDINGS.split())
    return _by_kind(kind, email=t.rlike(rf"(?i)[^a-z](?:{ends})$"), card=_digits(t).rlike(CARD_PREFIX),
                    ip=t.rlike(r"^[0-9]") & ~t.rlike(RESERVED_IP), phone=t.rlike(r"^(?:\+[1-9]|00[1-9]|\(?0?[1-9])"))


def _odd_value(kind, t, l, r):
    same = _digits(t).rlike(r"^([0-9])\1+$")
    date = t.rlike(r"^(?:19|20)[0-9]{2}[ .-][01]?[0-9][ .-][0-3]?[0-9]|^[0-3]?[0-9][ .-][01]?[0-9][ .-](?:19|20)[0-9]{2}$")
    return _by_kind(kind, email=F.lit(False), ip=t.rlike(RESERVED_IP), card=same, phone=same | date)


def _check_fails(kind, t, l, r):
    n = F.length(_digits(t))
    return _by_kind(kind, email=F.lit(False), phone=~n.between(9, 15),
                    ip=~t.contains(":") & ~F.regexp_replace(t, r"[\[\]() ]", "").rlike(_OCTETS),
                    card=~F.coalesce(n.between(13, 19) & F.when(n <= 19, F.call_function("luhn_check", _digits(t))), F.lit(False)))


LABELERS = (
    Labeler("base_regex", 1, 0.97, _base_regex),
    Labeler("shape_regex", 1, 0.75, _shape),
    Labeler("gazetteer", 1, 0.6, _gazetteer),
    Labeler("context", 1, 0.85, lambda k, t, l, r: _by_kind(k, **{n: _cue(l, CUES[n]) for n in KINDS})),
    Labeler("odd_value", 0, 0.85, _odd_value),
    Labeler("check_fails", 0, 0.9, _check_fails),
    Labeler("counter_context", 0, 0.85, lambda k, t, l, r: _cue(l, COUNTER_CUES) | l.rlike(r"[$€£#§] ?$")),
    Labeler("inside_token", 0, 0.85, lambda k, t, l, r: l.rlike(r"[A-Za-z0-9_/=]$") | r.rlike(r"^[A-Za-z0-9_/]")),
)
#: What the classifier sees beside the votes (all but the base pattern's own, so that it has to generalise).
FEATURES = (
    lambda k, t, l, r: t.rlike(r"[ .()\[\]-]"),
    lambda k, t, l, r: t.rlike(r"[()\[\]]"),
    lambda k, t, l, r: F.length(_digits(t)) >= 10,
    lambda k, t, l, r: r.rlike(r"^(?:$|[\s.,;:!?)])"),
)
BITS = len(LABELERS) + len(FEATURES)
#: Share of candidates taken to be personal data before any vote, and the weight of each labeler's first reliability.
PRIOR, PRIOR_VOTES = 0.2, 20.0
ROUNDS, THRESHOLD = 15, 0.9


def base_and_candidates(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """``doc_id, base, cands``: base spans ``(start, kind, end)`` in order, and
    candidates ``(start, kind, end, bits)``; a bit is a labeler that fired or a feature."""
    df = docs.select(docs[id_col].alias("doc_id"), text_of(docs, text_col).alias("text"))
    for kind in KINDS:
        df = with_matches(df, "text", BASE[kind], f"b_{kind}")
    df = with_matches(df, "text", CANDIDATES, "c")
    none = "array<struct<start:bigint,kind:int,end:bigint>>"

    def kept(k, kind):
        good = F.filter(f"b_{kind}", lambda s: base_ok(kind, s["t"]))
        return F.coalesce(F.transform(good, lambda s: F.struct(
            s["start"].alias("start"), F.lit(k).alias("kind"), s["end"].alias("end"))), F.array().cast(none))
    base = F.array_sort(F.concat(*[kept(k, kind) for k, kind in enumerate(KINDS)]))

    typed = F.transform("c", lambda s: F.struct(s["t"].alias("t"), s["l"].alias("l"), s["r"].alias("r"),
                                                s["start"].alias("start"), s["end"].alias("end"),
                                                kind_of(s["t"]).alias("kind")))

    def judged(s):
        tests = [x.fires for x in LABELERS] + list(FEATURES)
        bits = sum((F.when(F.coalesce(f(s["kind"], s["t"], s["l"], s["r"]), F.lit(False)), 1 << j).otherwise(0)
                    for j, f in enumerate(tests)), F.lit(0))
        return F.struct(s["start"].alias("start"), s["kind"].alias("kind"), s["end"].alias("end"), bits.alias("bits"))
    df = df.select("doc_id", base.alias("base"), typed.alias("c"))
    return df.select("doc_id", "base", F.transform("c", judged).alias("cands"))


def _bit(j: int) -> Column:
    return F.col("bits").bitwiseAND(F.lit(1 << j)) != 0


def _posterior(reliability: dict[int, list[float]]) -> Column:
    """Probability of personal data given the votes; a silent labeler says nothing."""
    def logit(rates):
        return sum((F.when(_bit(j), (1 if x.says else -1) * math.log(r / (1 - r))).otherwise(0.0)
                    for j, (x, r) in enumerate(zip(LABELERS, rates))), F.lit(math.log(PRIOR / (1 - PRIOR))))
    z = F.lit(0.0)
    for k, rates in reliability.items():
        z = F.when(F.col("kind") == k, logit(rates)).otherwise(z)
    return 1 / (1 + F.exp(-z))


def label_reliability(patterns: DataFrame, rounds: int = ROUNDS) -> dict[int, list[float]]:
    """Reliability of each labeler for each kind, from ``patterns(kind, bits, n)``
    by expectation maximisation; a round brings one row a kind to the driver."""
    first = [x.reliability for x in LABELERS]
    now = {k: list(first) for k in range(len(KINDS))}
    for _ in range(rounds):
        p = patterns.withColumn("p", _posterior(now))
        sums = [F.sum(F.when(_bit(j), F.col("n") * (F.col("p") if x.says else 1 - F.col("p"))).otherwise(0.0)).alias(f"r{j}")
                for j, x in enumerate(LABELERS)]
        fired = [F.sum(F.when(_bit(j), F.col("n")).otherwise(0)).alias(f"f{j}") for j in range(len(LABELERS))]
        new = dict(now)
        for row in p.groupBy("kind").agg(*sums, *fired).collect():
            new[row["kind"]] = [min(0.995, max(0.5, (row[f"r{j}"] + PRIOR_VOTES * first[j]) / (row[f"f{j}"] + PRIOR_VOTES)))
                                for j in range(len(LABELERS))]
        moved = max(abs(a - b) for k in now for a, b in zip(now[k], new[k]))
        now = new
        if moved < 1e-3:
            break
    return now


@dataclass(frozen=True)
class SpanModel:
    """Weights of the span classifier by kind, one a bit, and its bias."""
    weights: dict[int, list[float]]
    bias: float
    reliability: dict[int, list[float]]

    def accepts(self, s: Column) -> Column:
        z = F.lit(0.0)
        for k, w in self.weights.items():
            score = sum((F.when(s["bits"].bitwiseAND(F.lit(1 << j)) != 0, x).otherwise(0.0) for j, x in enumerate(w) if x),
                        F.lit(self.bias))
            z = F.when(s["kind"] == k, score).otherwise(z)
        return z >= math.log(THRESHOLD / (1 - THRESHOLD))


def fit_span_model(found: DataFrame) -> SpanModel | None:
    """Fits on the candidates of ``base_and_candidates``; None without a candidate."""
    from pyspark.ml.classification import LogisticRegression
    from pyspark.ml.feature import VectorAssembler
    patterns = materialize(found.select(F.explode("cands").alias("c")).groupBy("c.kind", "c.bits").agg(
        F.count("*").alias("n")), "pii-patterns")      # at most 4 * 2**BITS rows, however many texts
    if patterns.isEmpty():
        return None
    rates = label_reliability(patterns)
    p = patterns.withColumn("p", _posterior(rates))
    # every pattern once a class, weighted by its posterior; patterns weigh by the logarithm of their count, so
    # that a frequent form does not drown a rare one
    size = F.log1p(F.col("n").cast("double"))
    rows = p.select("kind", "bits", F.explode(F.array(
        F.struct(F.lit(1.0).alias("label"), (size * F.col("p")).alias("weight")),
        F.struct(F.lit(0.0).alias("label"), (size * (1 - F.col("p"))).alias("weight")))).alias("y"))
    used = range(1, BITS)
    names = [(k, j) for k in range(len(KINDS)) for j in used]
    rows = rows.select("y.label", "y.weight", *[
        F.when((F.col("kind") == k) & _bit(j), 1.0).otherwise(0.0).alias(f"x{k}_{j}") for k, j in names])
    rows = VectorAssembler(inputCols=[f"x{k}_{j}" for k, j in names], outputCol="features").transform(rows)
    fitted = LogisticRegression(weightCol="weight", regParam=0.002, standardization=False, maxIter=60).fit(rows)
    weights = {k: [0.0] * BITS for k in range(len(KINDS))}
    for (k, j), w in zip(names, fitted.coefficients.toArray().tolist()):
        weights[k][j] = w
    return SpanModel(weights, float(fitted.intercept), rates)


def _written(spans: Column) -> Column:
    names = F.array(*map(F.lit, KINDS))
    return F.transform(spans, lambda s: F.concat_ws(":", F.get(names, s["kind"]), s["start"].cast("string"),
                                                    s["end"].cast("string")))


def find_personal_data(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: ``doc_id``, ``base`` and ``spans``, both
    ``array<struct<start, kind, end>>`` in order of start, then kind (a number
    in ``KINDS``); offsets are code points, ``end`` exclusive.

    ``spans`` holds every base span and the accepted candidates that overlap
    none.  Null texts are empty and have no span; repeated rows and null ids are
    treated like any others; an empty table gives an empty result; other
    columns are ignored."""
    found = materialize(base_and_candidates(docs, id_col, text_col), "pii-candidates")
    model = fit_span_model(found)
    if model is None:
        return found.select("doc_id", "base", F.col("base").alias("spans"))
    picked = F.coalesce(F.transform(F.filter("cands", model.accepts), lambda s: F.struct(
        s["start"].alias("start"), s["kind"].alias("kind"), s["end"].alias("end"))),
        F.array().cast("array<struct<start:bigint,kind:int,end:bigint>>"))
    # candidates that are base spans go by a set difference of their keys; only the others are compared with base spans
    key = lambda s: F.concat_ws(":", s["start"].cast("string"), s["kind"].cast("string"), s["end"].cast("string"))
    df = found.select("doc_id", "base", picked.alias("picked")).withColumn(
        "new", F.array_except(F.transform("picked", key), F.transform("base", key)))

    def parsed(x):
        part = F.split(x, ":")
        return F.struct(F.get(part, F.lit(0)).cast("long").alias("start"), F.get(part, F.lit(1)).cast("int").alias("kind"),
                        F.get(part, F.lit(2)).cast("long").alias("end"))
    free = F.filter(F.transform("new", parsed), lambda s: ~F.exists(
        "base", lambda b: (b["start"] < s["end"]) & (s["start"] < b["end"])))
    return df.select("doc_id", "base", F.array_sort(F.concat("base", free)).alias("spans"))


def span_text(spans: Column) -> Column:
    """``kind:start:end`` of every span, joined by commas."""
    return F.array_join(_written(spans), ",")


def count_kind(spans: Column, kind: str) -> Column:
    return F.size(F.filter(spans, lambda s: s["kind"] == KINDS.index(kind))).cast("long")
