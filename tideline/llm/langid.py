"""Language identification with a byte convolutional network.

Bytes are embedded, convolved with filters of several widths, max-pooled over
fixed-length windows and classified by softmax.  The network is trained in
numpy on windows of a bounded sample of labelled texts (``SAMPLE_DOCS``,
expected size) and applied to every window of every text; a text's language is
the one its windows give the highest mean log-probability."""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import crc_fold, sampled, text_of

WINDOW = 256
WIDTHS, FILTERS, DEPTH = (2, 3, 4), 16, 6
#: Labelled texts the fit samples, by a hash of the id, and windows of each.
SAMPLE_DOCS, WINDOWS_PER_DOC = 3000, 4
EPOCHS, BATCH, RATE = 8, 64, 0.01
_LETTER = regex.compile(r"\p{L}")


@dataclass
class ByteNet:
    """Embedding, one filter bank a width, and the softmax layer."""
    langs: list[str]
    embed: np.ndarray                    # 257 x DEPTH; row 256 pads
    banks: list[tuple[np.ndarray, np.ndarray]]
    out: tuple[np.ndarray, np.ndarray]

    def params(self) -> list[np.ndarray]:
        return [self.embed, *(p for bank in self.banks for p in bank), *self.out]

    def forward(self, x: np.ndarray):
        """Log-probabilities of windows ``x`` (n, WINDOW) of byte codes, with
        the pooled features and what the gradients need of each bank."""
        e = self.embed[x]
        n = len(x)
        pooled, saved = [], []
        for width, (w, b) in zip(WIDTHS, self.banks):
            # a window of `width` embeddings is contiguous in memory
            flat = np.lib.stride_tricks.as_strided(
                e, (n, WINDOW - width + 1, width * DEPTH), (e.strides[0], e.strides[1], e.strides[2]))
            conv = flat.reshape(-1, width * DEPTH) @ w
            conv = conv.reshape(n, -1, FILTERS)
            arg = conv.argmax(axis=1)
            pooled.append(np.maximum(np.take_along_axis(conv, arg[:, None], 1)[:, 0] + b, 0))
            saved.append((arg, flat))
        h = np.concatenate(pooled, axis=1)
        return self.softmax(h), h, saved

    def softmax(self, h: np.ndarray) -> np.ndarray:
        z = h @ self.out[0] + self.out[1]
        z -= z.max(axis=1, keepdims=True)
        return z - np.log(np.exp(z).sum(axis=1, keepdims=True))

    def predictor(self, batch: int = 32):
        """Log-probabilities as ``forward`` gives them, for many windows: what
        a filter gives for a byte pair is tabulated once (17 MB), so that a
        convolution is a sum of looked-up rows and needs no matrix product."""
        taps = [[self.embed @ w[j * DEPTH:(j + 1) * DEPTH] for j in range(width)]
                for width, (w, _) in zip(WIDTHS, self.banks)]
        codes = len(self.embed)
        pairs = [(k, j, taps[k][j][:, None] + taps[k][j + 1][None]) for k, width in enumerate(WIDTHS)
                 for j in range(0, width - 1, 2)]
        table = np.concatenate([t.reshape(codes * codes, FILTERS) for _, _, t in pairs], axis=1)

        def few(x: np.ndarray) -> np.ndarray:
            got = table.take(x[:, :-1] * np.int32(codes) + x[:, 1:], axis=0)
            pooled = []
            for k, (width, (_, b)) in enumerate(zip(WIDTHS, self.banks)):
                n = WINDOW - width + 1
                terms = [got[:, j:j + n, c * FILTERS:(c + 1) * FILTERS]
                         for c, (bank, j, _) in enumerate(pairs) if bank == k]
                if width % 2:
                    terms.append(taps[k][-1].take(x[:, width - 1:], axis=0))
                pooled.append(np.maximum(sum(terms[1:], terms[0]).max(axis=1) + b, 0))
            return self.softmax(np.concatenate(pooled, axis=1))

        def predict(x: np.ndarray) -> np.ndarray:
            return np.concatenate([few(x[k:k + batch].astype(np.int32)) for k in range(0, len(x), batch)])
        return predict

    def gradients(self, x: np.ndarray, y: np.ndarray) -> list[np.ndarray]:
        logp, h, saved = self.forward(x)
        n = len(x)
        dz = np.exp(logp)
        dz[np.arange(n), y] -= 1
        dz /= n
        dh = (dz @ self.out[0].T) * (h > 0)
        d_embed, d_banks = np.zeros_like(self.embed), []
        rows = np.arange(n)[:, None]
        for k, (width, (w, _)) in enumerate(zip(WIDTHS, self.banks)):
            g = dh[:, k * FILTERS:(k + 1) * FILTERS]
            arg, flat = saved[k]
            patch = flat[rows, arg]                                   # (n, FILTERS, width*DEPTH)
            d_banks += [np.einsum("nf,nfd->df", g, patch), g.sum(axis=0)]
            back = (g[:, :, None] * w.T[None]).reshape(n, FILTERS, width, DEPTH)
            for j in range(width):
                np.add.at(d_embed, x[rows, arg + j].reshape(-1), back[:, :, j].reshape(-1, DEPTH))
        return [d_embed, *d_banks, h.T @ dz, dz.sum(axis=0)]


def windows_of(data: bytes) -> np.ndarray:
    """All windows of a text; the last one is padded (an empty text has one)."""
    n = max(1, -(-len(data) // WINDOW))
    x = np.full(n * WINDOW, 256, np.int16)
    x[:len(data)] = np.frombuffer(data, np.uint8)
    return x.reshape(n, WINDOW)


def train(windows: np.ndarray, labels: np.ndarray, langs: list[str], seed: int = 7) -> ByteNet:
    """Adam on class-balanced batches; some windows are cut short, so that the
    network also knows short texts."""
    rng = np.random.default_rng(seed)
    net = ByteNet(langs, (rng.normal(size=(257, DEPTH)) * 0.3).astype(np.float32),
                  [((rng.normal(size=(w * DEPTH, FILTERS)) / np.sqrt(w * DEPTH)).astype(np.float32),
                    np.zeros(FILTERS, np.float32)) for w in WIDTHS],
                  ((rng.normal(size=(len(WIDTHS) * FILTERS, len(langs))) * 0.1).astype(np.float32),
                   np.zeros(len(langs), np.float32)))
    m = [np.zeros_like(p) for p in net.params()]
    v = [np.zeros_like(p) for p in net.params()]
    by_class = [np.flatnonzero(labels == k) for k in range(len(langs))]
    steps = max(150, EPOCHS * len(windows) // BATCH)
    for t in range(1, steps + 1):
        pick = np.concatenate([rng.choice(c, BATCH // len(langs) + 1) for c in by_class])
        x = windows[pick].copy()
        for k in np.flatnonzero(rng.random(len(x)) < 0.3):
            x[k, rng.integers(12, WINDOW):] = 256
        for p, g, a, b in zip(net.params(), net.gradients(x, labels[pick]), m, v):
            a += 0.1 * (g - a)
            b += 0.001 * (g * g - b)
            p -= RATE * (1 - t / (steps + 1)) * (a / (1 - 0.9 ** t)) / (np.sqrt(b / (1 - 0.999 ** t)) + 1e-8)
    return net


def fit_language_model(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                       lang_col: str = "lang") -> ByteNet | None:
    """Fits on rows with a language outside the fold crc32(id) mod 4 = 2; None
    where no such row has a letter."""
    labelled = (docs.where(docs[lang_col].isNotNull() & (crc_fold(docs[id_col], 4) != 2))
                .select(docs[id_col].alias("_id"), text_of(docs, text_col).alias("text"), docs[lang_col].alias("lang")))
    n = labelled.count()
    rows = sampled(labelled, "_id", SAMPLE_DOCS, n)

    def cut(batches):
        for pdf in batches:
            out = []
            for doc, text, lang in zip(pdf["_id"], pdf["text"], pdf["lang"]):
                if not _LETTER.search(text):
                    continue
                w = windows_of(text.encode("utf-8", "surrogatepass"))
                rng = np.random.default_rng(
                    int(doc) & 0xFFFFFFFF if isinstance(doc, (int, float, np.integer)) else zlib.crc32(str(doc).encode()))
                for k in rng.choice(len(w), min(len(w), WINDOWS_PER_DOC), replace=False):
                    out.append((w[k].tobytes(), lang))
            yield pd.DataFrame(out, columns=["window", "lang"])
    # SAMPLE_DOCS * WINDOWS_PER_DOC windows of 512 bytes bound what comes to the driver
    got = rows.mapInPandas(cut, "window binary, lang string").orderBy("lang", "window").toPandas()
    if not len(got):
        if n > SAMPLE_DOCS and labelled.mapInPandas(cut, "window binary, lang string").limit(1).count():
            raise RuntimeError(f"the sample of {n} labelled texts is empty")
        return None
    langs = sorted(got["lang"].unique())
    x = np.frombuffer(b"".join(map(bytes, got["window"])), np.int16).reshape(-1, WINDOW)
    return train(x, got["lang"].map({l: k for k, l in enumerate(langs)}).to_numpy(), langs)


def language_column(text: Column, net: ByteNet | None) -> Column:
    """``struct<lang_pred, score>`` of a text column; ``und`` with score 0 where
    the text is null or has no letter, or nothing was learned."""
    def batches(parts: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        log_probabilities = net.predictor() if net else None
        for texts in parts:
            yield of_batch(texts, log_probabilities)

    def of_batch(texts: pd.Series, log_probabilities) -> pd.DataFrame:
        lang, score = ["und"] * len(texts), [0.0] * len(texts)
        held, sizes, where = [], [], []

        def flush():
            if not held:
                return
            x = np.concatenate(held)
            logp = log_probabilities(x)
            # a padded window counts by its share of bytes
            w = np.maximum((x != 256).sum(axis=1), 1)[:, None]
            starts = np.cumsum([0, *sizes[:-1]])
            mean = np.add.reduceat(logp * w, starts) / np.add.reduceat(w, starts)
            p = np.exp(mean - mean.max(axis=1, keepdims=True))
            p /= p.sum(axis=1, keepdims=True)
            for k, row in zip(where, p):
                lang[k], score[k] = net.langs[int(row.argmax())], float(row.max())
            held.clear(), sizes.clear(), where.clear()
        total = 0
        for k, t in enumerate(texts):
            if net is None or t is None or not _LETTER.search(t):
                continue
            w = windows_of(t.encode("utf-8", "surrogatepass"))
            held.append(w), sizes.append(len(w)), where.append(k)
            total += len(w)
            if total >= 4096:
                flush()
                total = 0
        flush()
        return pd.DataFrame({"lang_pred": lang, "score": score})
    return F.pandas_udf(batches, "lang_pred string, score double")(text)


def identify(docs: DataFrame, net: ByteNet | None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, held_out, lang_pred, score`` per row.  A null id is not held
    out; repeated rows are predicted alike; an empty table gives an empty
    result; other columns are ignored."""
    out = docs.select(docs[id_col].alias("doc_id"), language_column(docs[text_col].cast("string"), net).alias("p"))
    return out.select("doc_id", F.coalesce(crc_fold(F.col("doc_id"), 4) == 2, F.lit(False)).alias("held_out"),
                      "p.lang_pred", "p.score")
