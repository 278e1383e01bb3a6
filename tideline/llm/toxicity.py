"""Toxicity by weak supervision.

Many voters (lexicon words and word-prefix patterns) say "toxic" or abstain.
A generative label model estimates by expectation maximisation how often each
voter fires in either class, and how voters correlate within a class; voters
that fire together share their evidence.  A linear classifier is then trained
on the posterior labels and scores whole texts.

Fitting reads a bounded sample of labelled rows (``SAMPLE_ROWS``, expected
size); mining counts and the vote matrix of that sample come from Spark jobs.
Scoring reads every text in full."""

from __future__ import annotations

import math
import re
from collections import Counter
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import crc_fold, materialize, sampled, text_of

#: Labelled rows the fit samples, by a hash of the id.
SAMPLE_ROWS = 20_000
#: Voters of the label model and features of the classifier, at most.
MAX_VOTERS, MAX_FEATURES = 512, 4096
PREFIXES = (3, 4, 5, 6)
#: Multiple of ln(number of patterns) that a pattern's log-likelihood ratio must pass.
CHANCE = 2.0
#: Share of toxic rows among the sampled rows that hold a pattern, at least.
PRECISION = 0.7
#: A word is looked up once per Python worker while the table is below this size.
CACHE_WORDS = 200_000
#: General-purpose insults that vote even where no label supports them.
SEED_LEXICON = ("asshole bastard clown creep disgusting dumb fool garbage idiot idiots imbecile jerk loser losers "
                "moron morons pathetic scum stupid trash ugly vermin worthless").split()

_WORD = re.compile(r"[^\W\d_]+")


def words_of(text: str) -> set[str]:
    """Distinct lower-case letter runs of a whole text."""
    return {m.group() for m in _WORD.finditer(text.lower())}


def patterns_of(word: str) -> list[str]:
    """What a word can match: itself (``=word``) and its proper prefixes (``^pre``)."""
    return ["=" + word, *("^" + word[:n] for n in PREFIXES if len(word) > n)]


def text_patterns(text: str) -> set[str]:
    return {p for w in words_of(text) for p in patterns_of(w)}


@dataclass
class LabelModel:
    """Class-conditional firing rates, correlation discounts and the prior."""
    fire_toxic: np.ndarray
    fire_clean: np.ndarray
    share: np.ndarray          # of a voter's evidence that counts, after correlated voters
    prior: float
    label_accuracy: float

    @property
    def evidence(self) -> np.ndarray:
        return self.share * np.log(self.fire_toxic / self.fire_clean)

    def posterior(self, votes: np.ndarray, labels: np.ndarray | None = None) -> np.ndarray:
        """P(toxic | votes); abstaining carries no evidence, and no vote at all
        is strong evidence for clean.  A given label is one more noisy voter."""
        z = np.where(votes.any(axis=1), _logit(self.prior) + votes @ self.evidence, _logit(0.01))
        if labels is not None:
            z = z + np.where(labels == 1, 1.0, -1.0) * _logit(self.label_accuracy)
        return _sigmoid(z)


def _logit(p):
    return np.log(p / (1 - p))


def _sigmoid(z):
    return 1 / (1 + np.exp(-np.clip(z, -40, 40)))


def fit_label_model(votes: np.ndarray, labels: np.ndarray, rounds: int = 15) -> LabelModel:
    """EM over a bool matrix (rows, voters), started from the given labels."""
    votes = votes.astype(np.float64)
    post = np.where(labels == 1, 0.95, 0.05)
    model = None
    for _ in range(rounds):
        toxic, clean = post.sum(), (1 - post).sum()
        fire_toxic = (post @ votes + 0.1) / (toxic + 1)
        fire_clean = ((1 - post) @ votes + 0.1) / (clean + 1)
        # correlation of the votes within the toxic class, where they fire at all
        centred = (votes - fire_toxic) * np.sqrt(post)[:, None]
        cov = centred.T @ centred
        sd = np.sqrt(np.diag(cov)) + 1e-9
        corr = np.clip(cov / sd[:, None] / sd[None, :], 0, 1)
        corr[corr < 0.2] = 0
        np.fill_diagonal(corr, 1)
        agree = post @ (labels == 1) + (1 - post) @ (labels != 1)
        model = LabelModel(fire_toxic, fire_clean, 1 / corr.sum(axis=1), float(np.clip(toxic / len(post), 0.01, 0.5)),
                           float(np.clip((agree + 1) / (len(post) + 2), 0.6, 0.99)))
        new = model.posterior(votes, labels)
        if np.abs(new - post).max() < 1e-4:
            break
        post = new
    return model


def train_linear(rows: np.ndarray, cols: np.ndarray, n_rows: int, n_cols: int, target: np.ndarray,
                 weight: np.ndarray, steps: int = 400, l2: float = 1e-4) -> tuple[np.ndarray, float]:
    """Logistic regression on sparse 0/1 features and soft targets (Adam)."""
    w, b = np.zeros(n_cols + 1), 0.0
    m, v = np.zeros(n_cols + 1), np.zeros(n_cols + 1)
    total = weight.sum()
    for t in range(1, steps + 1):
        z = np.bincount(rows, weights=w[cols], minlength=n_rows) + w[n_cols]
        err = (_sigmoid(z) - target) * weight / total
        g = np.r_[np.bincount(cols, weights=err[rows], minlength=n_cols) + l2 * w[:n_cols] / 10, err.sum()]
        m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
        w -= 0.1 * (m / (1 - 0.9 ** t)) / (np.sqrt(v / (1 - 0.999 ** t)) + 1e-8)
    return w[:n_cols], float(w[n_cols])


@dataclass
class ToxicityModel:
    weights: dict[str, float]
    bias: float

    def scorer(self):
        weights, bias, known = self.weights, self.bias, {}

        def score(text: str) -> float:
            hits: set[str] = set()
            for word in words_of(text):
                found = known.get(word)
                if found is None:
                    found = tuple(p for p in patterns_of(word) if p in weights)
                    if len(known) < CACHE_WORDS:
                        known[word] = found
                hits.update(found)
            return float(_sigmoid(bias + sum(weights[p] for p in sorted(hits))))
        return score


def _labelled(docs: DataFrame, labels: DataFrame, id_col: str,
              text_col: str) -> tuple[DataFrame, DataFrame | None]:
    """Sampled labelled rows ``(text, toxic)`` outside the held-out fold, and
    ``(toxic)`` of all of them where the sample leaves some out."""
    own = (labels.select(F.col("doc_id").alias("_id"), F.col("toxic").cast("int").alias("_toxic"))
           .where(F.col("_toxic").isNotNull() & (crc_fold(F.col("_id"), 3) != 1))
           .groupBy("_id").agg(F.max("_toxic").alias("_toxic")))
    n = own.count()
    rows = docs.select(docs[id_col].alias("_id"), text_of(docs, text_col).alias("text"))
    few = F.broadcast(sampled(own, "_id", SAMPLE_ROWS, n))                        # SAMPLE_ROWS bounds it
    every = rows.select("_id").join(own, "_id").select(F.col("_toxic").alias("toxic")) if n > SAMPLE_ROWS else None
    return rows.join(few, "_id").select("text", F.col("_toxic").alias("toxic")), every


def _count_patterns(batches):
    for pdf in batches:
        toxic, clean = Counter(), Counter()
        for text, label in zip(pdf["text"], pdf["toxic"]):
            (toxic if label == 1 else clean).update(text_patterns(text))
        names = list(toxic.keys() | clean.keys())
        yield pd.DataFrame({"pattern": names, "t": [toxic[p] for p in names], "c": [clean[p] for p in names]})


def _mine(sample: DataFrame, toxic: int, clean: int) -> list[str]:
    """Patterns that mark the toxic rows, strongest first (at most MAX_FEATURES).

    Of many patterns some mark toxic rows by chance, so the log-likelihood
    ratio must pass a bound that grows with the logarithm of their number."""
    counts = sample.mapInPandas(_count_patterns, "pattern string, t long, c long").groupBy("pattern").agg(
        F.sum("t").alias("t"), F.sum("c").alias("c"))
    base = toxic / (toxic + clean)

    def term(k, expected):
        return F.when(k > 0, k * F.log(k / expected)).otherwise(0.0)
    n = F.col("t") + F.col("c")
    gain = 2 * (term(F.col("t"), n * base) + term(F.col("c"), n * (1 - base))
                + term(toxic - F.col("t"), toxic - n * base) + term(clean - F.col("c"), clean - n * (1 - base)))
    rate_t, rate_c = (F.col("t") + 0.1) / (toxic + 1), (F.col("c") + 0.1) / (clean + 1)
    counts = materialize(counts.where("t >= 3").withColumn("gain", gain).withColumn("lift", rate_t / rate_c),
                         "toxicity-patterns")
    precise = F.col("t") >= PRECISION * (F.col("t") + F.col("c"))
    found = (counts.where(precise & (F.col("lift") > 5) & (F.col("gain") > CHANCE * math.log(max(2, counts.count()))))
             .orderBy(F.desc("gain"), "pattern").limit(MAX_FEATURES).select("pattern").collect())
    return [r["pattern"] for r in found]


def fit_toxicity(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> ToxicityModel:
    """Fits on labelled rows outside the fold crc32(id) mod 3 = 1.  Without a
    labelled row of either class the seed lexicon alone decides; a sample that
    misses a class which the labelled rows hold is an error."""
    sample, every = _labelled(docs, labels, id_col, text_col)
    seed = ["=" + w for w in SEED_LEXICON]
    by_class = {r["toxic"]: r["count"] for r in sample.groupBy("toxic").count().collect()}
    toxic, clean = by_class.get(1, 0), sum(by_class.values()) - by_class.get(1, 0)
    if not toxic or not clean:
        if every is not None and every.select(F.col("toxic") == 1).distinct().count() == 2:
            raise RuntimeError(f"the sample of the labels holds {toxic} toxic and {clean} other rows")
        return ToxicityModel({p: 6.0 for p in seed}, -4.0)
    mined = _mine(sample, toxic, clean)
    features = list(dict.fromkeys([*mined, *seed]))
    voters = list(dict.fromkeys([*mined[:MAX_VOTERS], *seed]))
    index = {p: k for k, p in enumerate(features)}

    def hits(batches):
        for pdf in batches:
            yield pd.DataFrame({"hits": [sorted(index[p] for p in text_patterns(t) if p in index) for t in pdf["text"]],
                                "toxic": pdf["toxic"].astype("int32")})
    rows = sample.mapInPandas(hits, "hits array<int>, toxic int").toPandas()      # SAMPLE_ROWS bounds it
    given = rows["toxic"].to_numpy()
    where = np.repeat(np.arange(len(rows)), rows["hits"].map(len).to_numpy())
    cols = np.concatenate([np.asarray(h, np.int64) for h in rows["hits"]]) if len(where) else np.zeros(0, np.int64)

    slot = np.full(len(features), -1)
    slot[[index[p] for p in voters]] = np.arange(len(voters))
    votes = np.zeros((len(rows), len(voters)), bool)
    fired = slot[cols] >= 0
    votes[where[fired], slot[cols[fired]]] = True
    model = fit_label_model(votes, given)
    target = model.posterior(votes.astype(np.float64), given)

    # views in which only one voter's evidence is left, labelled by the label model
    single = np.flatnonzero((votes & (target > 0.5)[:, None]).any(axis=0))
    alone = np.zeros((len(single), len(voters)))
    alone[np.arange(len(single)), single] = 1
    view_target = model.posterior(alone)
    view_cols = np.array([index[voters[k]] for k in single], np.int64)
    n = len(rows) + len(single)
    weight = np.r_[np.where(target > 0.5, 0.5 * len(rows) / max(1, (target > 0.5).sum()),
                            0.5 * len(rows) / max(1, (target <= 0.5).sum())), np.full(len(single), 5.0)]
    w, b = train_linear(np.r_[where, len(rows) + np.arange(len(single))], np.r_[cols, view_cols], n, len(features),
                        np.r_[target, view_target], weight)
    # a seed word no text of the sample holds keeps a weight of its own
    seen = np.bincount(cols, minlength=len(features)) > 0
    weights = {p: float(w[k]) if seen[k] else 6.0 for p, k in index.items()}
    return ToxicityModel({p: x for p, x in weights.items() if abs(x) > 1e-3}, b)


def toxicity_score(text: Column, model: ToxicityModel) -> Column:
    """Score in [0, 1] of a text column; null counts as empty."""
    @F.pandas_udf(T.DoubleType())
    def score(texts: pd.Series) -> pd.Series:
        one = model.scorer()
        return pd.Series([one(t) for t in texts], dtype="float64")
    return score(F.coalesce(text, F.lit("")))


def score_documents(docs: DataFrame, model: ToxicityModel, threshold: float = 0.7, id_col: str = "doc_id",
                    text_col: str = "text") -> DataFrame:
    """``doc_id, held_out, score, predicted`` per row.  Empty and null texts get
    the score of no evidence; a null id is not held out; repeated rows score
    alike; an empty table gives an empty result."""
    out = docs.select(docs[id_col].alias("doc_id"), toxicity_score(text_of(docs, text_col), model).alias("score"))
    return out.select("doc_id", F.coalesce(crc_fold(F.col("doc_id"), 3) == 1, F.lit(False)).alias("held_out"),
                      "score", (F.col("score") >= threshold).cast("int").alias("predicted"))


def drop_toxic(docs: DataFrame, labels: DataFrame, threshold: float = 0.7, id_col: str = "doc_id",
               text_col: str = "text") -> DataFrame:
    """Rows scoring below ``threshold``; columns unchanged."""
    model = fit_toxicity(docs, labels, id_col, text_col)
    return docs.where(toxicity_score(text_of(docs, text_col), model) < threshold)
