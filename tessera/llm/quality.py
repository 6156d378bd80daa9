"""Operator 10: document quality by attention-based multiple-instance learning, trained in numpy.

A document is a bag of passages of ``PASSAGE`` words. Every passage is encoded from what it looks like: shares of each
ASCII mark, of capitals, digits, spaces and other bytes, word lengths, the share of distinct words and of words that repeat
one of the two before them, and a hashed bag of its words; a learned layer maps that to a vector h. Gated attention weighs the
passages, a_k ~ exp(w . (tanh(V h_k) * sigmoid(U h_k))), and a logistic unit scores the weighted sum of h_k, so labels of
documents teach which passages matter. A text of n characters moves the score n / (n + ``EVIDENCE``) of the way (in log
odds) from the labelled share, so a few words alone seldom decide.

The model is fitted on the driver on at most ``TRAIN_DOCS`` labelled texts of at most ``TRAIN_CHARS`` characters; scoring
reads every passage of every whole text in one pass without a shuffle.

Defined results: a null or empty text has nothing to judge and gets the labelled share of 1 (0.5 without labels), as all do
without labels of both kinds; repeated rows and null ids each get a row; an empty table gives
none; other columns are ignored (and kept by ``keep_good``). Labels, lang, source and doc_id are never inputs.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.llm.common import bounded_batches, fold, fresh, read
from tessera.llm.hashing import Words, groups
from tessera.llm.learning import Adam, labelled_sample, learns, sigmoid

PASSAGE = 64
WORD_FEATURES = 32
ENCODED, ATTENTION = 16, 8
TRAIN_DOCS, TRAIN_CHARS, EPOCHS, RATE = 4000, 40_000, 60, 0.02
THRESHOLD = 0.3
#: Characters of text that weigh as much as the labelled share does.
EVIDENCE = 20

#: Class of each byte: every ASCII mark its own, then capitals, small letters, digits, space, line feed, other
#: control bytes, and bytes of non-ASCII characters.
MARKS = [b for b in range(33, 127) if not chr(b).isalnum()]
CLASSES = len(MARKS) + 7


def byte_classes() -> np.ndarray:
    out = np.full(256, CLASSES - 2)
    out[MARKS] = np.arange(len(MARKS))
    for k, some in enumerate((range(65, 91), range(97, 123), range(48, 58), [32], [10])):
        out[list(some)] = len(MARKS) + k
    out[128:] = CLASSES - 1
    return out


BYTE_CLASS = byte_classes()
FEATURES = CLASSES + 4 + WORD_FEATURES


def passages(texts: list) -> tuple[np.ndarray, np.ndarray]:
    """(features, document) of every passage; each document has one at least."""
    found = Words(texts)
    raw = np.frombuffer(b"\n".join(b"" if t is None else t.encode("utf-8", "surrogatepass") for t in texts), np.uint8)
    n = np.maximum(1, -(-found.counts // PASSAGE))
    doc = np.repeat(np.arange(len(n)), n)
    k = np.arange(len(doc)) - np.repeat(np.cumsum(n) - n, n)
    # Passages cut the bytes at word starts; a document's first takes what precedes its first word.
    sizes = np.array([0 if t is None else len(t.encode("utf-8", "surrogatepass")) for t in texts], np.int64)
    offset = np.cumsum(sizes + 1) - sizes - 1
    first_word = found.first[:-1][doc] + k * PASSAGE
    begin = np.where(k > 0, np.append(found.starts, 0)[np.minimum(first_word, len(found.starts))], offset[doc])
    which = np.repeat(np.arange(len(doc)), np.diff(np.append(begin, len(raw))))
    kind = BYTE_CLASS[raw]
    kind[offset[1:] - 1] = CLASSES  # what joins the texts belongs to none
    shares = np.bincount(which * (CLASSES + 1) + kind, minlength=len(doc) * (CLASSES + 1))
    shares = shares.reshape(-1, CLASSES + 1)[:, :CLASSES].astype(np.float32)
    shares /= np.maximum(shares.sum(1, keepdims=True), 1)
    words = np.minimum(found.counts[doc] - k * PASSAGE, PASSAGE).clip(0)
    passage = np.repeat(np.arange(len(doc)), words)
    size = np.maximum(words, 1).astype(np.float32)
    h = found.hashes
    same = lambda lag: np.concatenate([np.zeros(min(lag, len(h)), bool), (h[lag:] == h[:-lag]) & (passage[lag:] == passage[:-lag])])
    again = np.bincount(passage, weights=same(1) | same(2), minlength=len(doc))
    order = np.lexsort((h, passage))
    fresh = np.ones(len(h), bool)
    fresh[1:] = (h[order][1:] != h[order][:-1]) | (passage[order][1:] != passage[order][:-1])
    distinct = np.bincount(passage[order], weights=fresh, minlength=len(doc))
    length = np.bincount(passage, weights=found.ends - found.starts, minlength=len(doc))
    bag = np.bincount(passage * WORD_FEATURES + (h >> np.uint64(59)).astype(np.int64), minlength=len(doc) * WORD_FEATURES)
    bag = np.sqrt(bag.reshape(-1, WORD_FEATURES).astype(np.float32) / size[:, None])
    rest = np.column_stack([words / PASSAGE, again / size, distinct / size, length / size / 10]).astype(np.float32)
    return np.concatenate([np.sqrt(shares), rest, bag], 1), doc


class BagModel:
    """Encoder, gated attention and score; ``constant`` without labels of both kinds."""

    def __init__(self, seed: int = 5):
        rng = np.random.default_rng(seed)
        draw = lambda *s: (rng.standard_normal(s) / np.sqrt(s[0])).astype(np.float32)
        self.p = {"enc": draw(FEATURES, ENCODED), "enc_b": np.zeros(ENCODED, np.float32), "v": draw(ENCODED, ATTENTION),
                  "u": draw(ENCODED, ATTENTION), "w": draw(ATTENTION), "out": draw(ENCODED), "out_b": np.zeros(1, np.float32)}
        self.mean, self.scale = np.zeros(FEATURES, np.float32), np.ones(FEATURES, np.float32)
        self.prior, self.constant = 0.5, False

    def forward(self, x: np.ndarray, firsts: np.ndarray, bag: np.ndarray):
        """Logit of each bag; ``firsts`` are its first passages, ``bag`` numbers the bag of each passage."""
        p = self.p
        h = np.tanh(((x - self.mean) / self.scale) @ p["enc"] + p["enc_b"])
        t, g = np.tanh(h @ p["v"]), sigmoid(h @ p["u"])
        e = (t * g) @ p["w"]
        a = np.exp(e - np.maximum.reduceat(e, firsts)[bag])
        a /= np.add.reduceat(a, firsts)[bag]
        z = np.add.reduceat(a[:, None] * h, firsts, axis=0)
        return z @ p["out"] + p["out_b"][0], (h, t, g, a, z)

    def gradients(self, x, firsts, bag, y):
        p = self.p
        logit, (h, t, g, a, z) = self.forward(x, firsts, bag)
        d = ((sigmoid(logit) - y) / len(y)).astype(np.float32)
        out = {"out": z.T @ d, "out_b": np.array([d.sum()], np.float32)}
        d_z = d[:, None] * p["out"]
        d_h = a[:, None] * d_z[bag]
        d_a = (h * d_z[bag]).sum(1)
        d_e = a * (d_a - np.add.reduceat(a * d_a, firsts)[bag])
        out["w"] = (t * g).T @ d_e
        d_t, d_g = d_e[:, None] * p["w"] * g * (1 - t ** 2), d_e[:, None] * p["w"] * t * g * (1 - g)
        out["v"], out["u"] = h.T @ d_t, h.T @ d_g
        d_pre = (d_h + d_t @ p["v"].T + d_g @ p["u"].T) * (1 - h ** 2)
        out["enc"], out["enc_b"] = ((x - self.mean) / self.scale).T @ d_pre, d_pre.sum(0)
        return out

    def scores(self, texts: list) -> np.ndarray:
        if self.constant:
            return np.full(len(texts), self.prior)
        x, doc = passages(texts)
        logit, _ = self.forward(x, np.flatnonzero(np.diff(doc, prepend=-1)), doc)
        size = np.array([len(t or "") for t in texts], np.float64)
        known = np.log(self.prior / (1 - self.prior))
        return sigmoid(known + (logit.astype(np.float64) - known) * size / (size + EVIDENCE))


def train(sample: pd.DataFrame, epochs: int = EPOCHS, rate: float = RATE, seed: int = 5) -> BagModel:
    model = BagModel(seed)
    y = sample["y"].to_numpy(np.float32)
    model.prior = float((y.sum() + 1) / (len(y) + 2))
    if len(np.unique(y)) < 2:
        model.constant = True
        return model
    parts = [passages(list(part["text"])) for part in groups(sample, limit=1 << 20)]
    counts = [int(doc.max()) + 1 for _, doc in parts]
    x = np.concatenate([part for part, _ in parts])
    doc = np.concatenate([own + before for (_, own), before in zip(parts, np.cumsum([0, *counts[:-1]]))])
    model.mean, model.scale = x.mean(0), x.std(0) + np.float32(0.02)
    firsts = np.append(np.flatnonzero(np.diff(doc, prepend=-1)), len(doc))
    adam, rng = Adam(model.p, rate), np.random.default_rng(seed)
    for _ in range(epochs):
        order = rng.permutation(len(y))
        for k in range(0, len(order), 256):
            bags = np.sort(order[k: k + 256])
            sizes = firsts[bags + 1] - firsts[bags]
            begin = np.cumsum(sizes) - sizes
            rows = np.arange(int(sizes.sum())) + np.repeat(firsts[bags] - begin, sizes)
            grads = model.gradients(x[rows], begin, np.repeat(np.arange(len(bags)), sizes), y[bags])
            for name in ("enc", "out", "v", "u", "w"):
                grads[name] += 3e-4 * model.p[name]
            adam.update(grads)
    return model


def fit_quality(docs: DataFrame, labels: DataFrame, rows: int = TRAIN_DOCS) -> BagModel:
    """Fit on labelled rows whose crc32(doc_id as text) mod 5 is not 0."""
    return train(labelled_sample(docs, labels, "quality", learns(5, 0), rows, TRAIN_CHARS))


def score_column(sent):
    """Column of scores of the ``text`` column under a broadcast model."""
    def score(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for part in texts:
            frame = pd.DataFrame({"text": part})
            got = [sent.value.scores(list(g["text"])) for g in groups(frame, limit=1 << 20)]
            yield pd.Series(np.concatenate(got) if got else np.empty(0), dtype="float64")

    return F.pandas_udf(score, "double")("text")


def quality_scores(docs: DataFrame, model: BagModel, name: str) -> DataFrame:
    """``docs`` with the score in column ``name``."""
    bounded_batches(docs.sparkSession)
    return docs.withColumn(name, score_column(docs.sparkSession.sparkContext.broadcast(model)))  # a few KB


def keep_good(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """``docs`` (all columns) without the rows whose score is below the threshold."""
    score = fresh(docs, "_score")
    return quality_scores(docs, fit_quality(docs, labels), score).filter(F.col(score) >= threshold).drop(score)


def op10_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality of every document; predicted at 0.3."""
    docs = read(spark, sf_dir, "documents", "doc_id", "text")
    model = fit_quality(docs, read(spark, sf_dir, "labels", "doc_id", "quality"))
    return quality_scores(docs, model, "score").select(
        "doc_id", (fold(F.col("doc_id"), 5) == 0).alias("held_out"), "score",
        (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))
