"""Operator 1: toxicity by a bidirectional gated recurrent network with attention pooling, trained in numpy.

A word enters as two inputs: an embedding of the word (by a hash) and the mean embedding of its character trigrams.
Windows of ``WINDOW`` words, one every ``STRIDE`` words, are read by a GRU in both directions; attention pools the states
of a window into one vector and a logistic unit scores it. A document's score is its highest window's, so one passage of
a long text is enough. Training backpropagates through the window that now scores highest in each document.

The network is fitted on the driver on at most ``TRAIN_DOCS`` labelled texts of at most ``TRAIN_CHARS`` characters; scoring
reads every window of every whole text in one pass without a shuffle.

Defined results: a null, empty or wordless text has no window and gets the labelled share of 1 (0.5 without labels);
one kind of label alone gives that share to all; repeated rows and null ids each get a row; an empty table gives none;
other columns are ignored. Labels, lang, source and doc_id are never inputs.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.llm.common import bounded_batches, fold, read
from tessera.llm.hashing import Words, groups, mix
from tessera.llm.learning import Adam, labelled_sample, learns, sigmoid

WINDOW, STRIDE = 64, 48
HIDDEN, ATTENTION = 8, 8
WORD_ROWS, CHAR_ROWS, WORD_DIM, CHAR_DIM = 1 << 15, 1 << 13, 8, 6
TRAIN_DOCS, TRAIN_CHARS, EPOCHS, RATE = 3000, 20_000, 12, 0.02
MIN_DOCS, CHANCE, DECAY = 8, 3.0, 3e-3
BLOCK = 2048


class Inputs:
    """Distinct words of some texts: rows of the two embedding tables; and the windows over the texts."""

    def __init__(self, texts: list):
        found = Words(texts)
        distinct, first, self.word = np.unique(found.hashes, return_index=True, return_inverse=True)
        self.rows = (distinct >> np.uint64(40)).astype(np.int64) & (WORD_ROWS - 1)
        self.hashes = distinct
        # Trigrams over each distinct word's bytes with a space at both ends.
        starts, ends = found.starts[first] - 1, found.ends[first] + 1
        sizes = ends - starts - 2
        self.tri_first = np.cumsum(sizes) - sizes
        at = np.arange(int(sizes.sum())) + np.repeat(starts - self.tri_first, sizes)
        buf = np.frombuffer(b" " + found.blob + b" ", np.uint8).astype(np.uint64)
        tri = (buf[at + 1] << np.uint64(16)) | (buf[at + 2] << np.uint64(8)) | buf[at + 3]
        self.tri, self.tri_sizes = (mix(tri) >> np.uint64(33)).astype(np.int64) & (CHAR_ROWS - 1), sizes
        # Windows: one at each STRIDE words, up to the one that reaches the text's end.
        n = np.where(found.counts > 0, 1 + np.maximum(0, -(-(found.counts - WINDOW) // STRIDE)), 0)
        self.doc = np.repeat(np.arange(len(n)), n)
        k = np.arange(int(n.sum())) - np.repeat(np.cumsum(n) - n, n)
        self.start = found.first[:-1][self.doc] + k * STRIDE
        self.size = np.minimum(found.first[1:][self.doc] - self.start, WINDOW)

    def trigrams(self, words: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(trigram rows, first, number) of some distinct words."""
        sizes = self.tri_sizes[words]
        first = np.cumsum(sizes) - sizes
        at = np.arange(int(sizes.sum())) + np.repeat(self.tri_first[words] - first, sizes)
        return self.tri[at], first, sizes

    def vectors(self, p: dict, words: np.ndarray) -> np.ndarray:
        """Inputs of some distinct words."""
        if not len(words):
            return np.zeros((0, WORD_DIM + CHAR_DIM), np.float32)
        tri, first, sizes = self.trigrams(words)
        chars = np.add.reduceat(p["char"][tri], first, axis=0) / sizes[:, None].astype(np.float32)
        return np.concatenate([p["word"][self.rows[words]], chars], 1)


class Network:
    """Parameters ``p``; ``gates`` are ordered update, reset, new state."""

    def __init__(self, seed: int = 11):
        rng = np.random.default_rng(seed)
        d, h = WORD_DIM + CHAR_DIM, HIDDEN
        draw = lambda *s, scale: (rng.standard_normal(s) * scale).astype(np.float32)
        self.p = {"word": draw(WORD_ROWS, WORD_DIM, scale=0.1), "char": draw(CHAR_ROWS, CHAR_DIM, scale=0.1),
                  "in_f": draw(d, 3 * h, scale=0.3), "in_b": draw(d, 3 * h, scale=0.3),
                  "bias_f": np.zeros(3 * h, np.float32), "bias_b": np.zeros(3 * h, np.float32),
                  "rec_f": draw(h, 3 * h, scale=0.3), "rec_b": draw(h, 3 * h, scale=0.3),
                  "att": draw(2 * h, ATTENTION, scale=0.3), "att_v": draw(ATTENTION, scale=0.5),
                  "out": draw(2 * h, scale=0.5), "out_b": np.zeros(1, np.float32)}
        self.prior = 0.5
        self.constant = False

    # One direction over a block of windows; time-major arrays (time, window, ...).
    def _gru(self, x: np.ndarray, rec: np.ndarray, mask: np.ndarray | None, order: range, keep: bool):
        steps, n, _ = x.shape
        h = HIDDEN
        state = np.zeros((n, h), np.float32)
        out = np.empty((steps, n, h), np.float32)
        tape = []
        for t in order:
            zr = x[t, :, : 2 * h] + state @ rec[:, : 2 * h]
            zr *= 0.5
            np.tanh(zr, out=zr)
            zr *= 0.5
            zr += 0.5
            z, r = zr[:, :h], zr[:, h:]
            gated = r * state
            new = np.tanh(x[t, :, 2 * h:] + gated @ rec[:, 2 * h:])
            nxt = state + z * (new - state)
            if mask is not None:
                nxt = np.where(mask[t, :, None], nxt, state)
            if keep:
                tape.append((t, state, z, r, gated, new))
            state = nxt
            out[t] = state
        return out, tape

    def forward(self, tables: tuple, word: np.ndarray, size: np.ndarray, keep: bool = False):
        """Logits of windows given as (window, time) rows of the input tables; ``size`` words of each count."""
        p = self.p
        steps = int(size.max())
        word = word[:, :steps].T
        mask = None if int(size.min()) == steps else np.arange(steps)[:, None] < size
        xf, xb = tables[0][word], tables[1][word]
        hf, tape_f = self._gru(xf, p["rec_f"], mask, range(steps), keep)
        hb, tape_b = self._gru(xb, p["rec_b"], mask, range(steps - 1, -1, -1), keep)
        states = np.concatenate([hf, hb], 2)
        hidden = np.tanh(states @ p["att"])
        e = hidden @ p["att_v"]
        if mask is not None:
            e = np.where(mask, e, -1e9)
        a = np.exp(e - e.max(0))
        a /= a.sum(0)
        pooled = np.einsum("tn,tnh->nh", a, states)
        logit = pooled @ p["out"] + p["out_b"][0]
        return logit, (word, mask, states, hidden, a, pooled, tape_f, tape_b) if keep else None

    def tables(self, x: np.ndarray) -> tuple:
        p = self.p
        return x @ p["in_f"] + p["bias_f"], x @ p["in_b"] + p["bias_b"]

    def backward(self, d_logit: np.ndarray, kept, x: np.ndarray, inputs: Inputs, words: np.ndarray) -> dict:
        p, h = self.p, HIDDEN
        word, mask, states, hidden, a, pooled, tape_f, tape_b = kept
        g = {"out": pooled.T @ d_logit, "out_b": np.array([d_logit.sum()], np.float32)}
        d_pooled = d_logit[:, None] * p["out"]
        d_states = a[..., None] * d_pooled[None]
        d_a = np.einsum("tnh,nh->tn", states, d_pooled)
        d_e = a * (d_a - (a * d_a).sum(0))
        g["att_v"] = np.einsum("tnk,tn->k", hidden, d_e)
        d_hidden = d_e[..., None] * p["att_v"] * (1 - hidden ** 2)
        g["att"] = np.einsum("tnh,tnk->hk", states, d_hidden)
        d_states += d_hidden @ p["att"].T
        d_x = np.zeros_like(x)
        for side, tape, part in (("f", tape_f, d_states[..., :h]), ("b", tape_b, d_states[..., h:])):
            rec = p[f"rec_{side}"]
            g_rec = np.zeros_like(rec)
            d_table = np.zeros((len(x), 3 * h), np.float32)
            carry = np.zeros((len(d_logit), h), np.float32)
            for t, state, z, r, gated, new in reversed(tape):
                d = part[t] + carry
                on = mask[t, :, None] if mask is not None else True
                live = np.where(on, d, 0)
                d_new = live * z * (1 - new ** 2)
                d_z = live * (new - state) * z * (1 - z)
                d_gated = d_new @ rec[:, 2 * h:].T
                d_r = d_gated * state * r * (1 - r)
                d_zr = np.concatenate([d_z, d_r], 1)
                carry = np.where(on, live * (1 - z), d) + d_gated * r + d_zr @ rec[:, : 2 * h].T
                g_rec[:, 2 * h:] += gated.T @ d_new
                g_rec[:, : 2 * h] += state.T @ d_zr
                np.add.at(d_table, word[t], np.concatenate([d_zr, d_new], 1))
            g[f"rec_{side}"], g[f"in_{side}"] = g_rec, x.T @ d_table
            g[f"bias_{side}"] = d_table.sum(0)
            d_x += d_table @ p[f"in_{side}"].T
        g["word"], g["char"] = np.zeros_like(p["word"]), np.zeros_like(p["char"])
        tri, _, sizes = inputs.trigrams(words)
        np.add.at(g["word"], inputs.rows[words], d_x[:, :WORD_DIM])
        np.add.at(g["char"], tri, np.repeat(d_x[:, WORD_DIM:] / sizes[:, None], sizes, axis=0))
        return g

    def window_logits(self, inputs: Inputs) -> np.ndarray:
        """Logits of all windows, full ones in blocks without a mask."""
        logits = np.empty(len(inputs.start), np.float32)
        tables = self.tables(inputs.vectors(self.p, np.arange(len(inputs.rows))))
        for full in (True, False):
            some = np.flatnonzero((inputs.size == WINDOW) == full)
            for k in range(0, len(some), BLOCK):
                at = some[k: k + BLOCK]
                logits[at] = self.forward(tables, inputs.word[window_words(inputs, at)], inputs.size[at])[0]
        return logits

    def document_scores(self, texts: list) -> np.ndarray:
        out = np.full(len(texts), self.prior)
        inputs = Inputs(texts)
        if self.constant or not len(inputs.start):
            return out
        logits = self.window_logits(inputs).astype(np.float64)
        firsts = np.flatnonzero(np.diff(inputs.doc, prepend=-1))
        out[inputs.doc[firsts]] = sigmoid(np.maximum.reduceat(logits, firsts))
        return out


def window_words(inputs: Inputs, at: np.ndarray) -> np.ndarray:
    """Places of the words of windows (window, time); beyond a window's size its last word repeats."""
    return inputs.start[at][:, None] + np.minimum(np.arange(WINDOW), inputs.size[at][:, None] - 1)


def train(sample: pd.DataFrame, epochs: int = EPOCHS, rate: float = RATE, seed: int = 11) -> Network:
    """Fit the network on (text, y). The word table's first channel is the word's
    association with the label in the sample (by documents), which also tells early epochs which window to learn from."""
    net = Network(seed)
    sample = sample.drop_duplicates()  # copies of a text would make all its words look telling
    y = sample["y"].to_numpy(np.float32)
    net.prior = float((y.sum() + 1) / (len(y) + 2)) if len(y) else 0.5
    if len(np.unique(y)) < 2:
        net.constant = True
        return net
    inputs = Inputs(list(sample["text"]))
    x_rows = inputs.rows
    doc_of_word = np.repeat(np.arange(len(y)), word_counts(inputs, len(y)))
    pairs = np.unique(doc_of_word * np.int64(WORD_ROWS) + x_rows[inputs.word])
    docs, rows = pairs // WORD_ROWS, pairs % WORD_ROWS
    pos = np.bincount(rows, weights=y[docs], minlength=WORD_ROWS)
    neg = np.bincount(rows, minlength=WORD_ROWS) - pos
    # A word must be in MIN_DOCS texts to have a vector of its own; what is rarer, or new, is read by its characters alone.
    known = (pos + neg >= MIN_DOCS).astype(np.float32)[:, None]
    net.p["word"] *= known
    net.p["word"][:, 0] = association(pos, neg, y.sum(), len(y) - y.sum()) * known[:, 0]
    adam = Adam(net.p, rate)
    rng = np.random.default_rng(seed)
    firsts = np.flatnonzero(np.diff(inputs.doc, prepend=-1))
    owners = inputs.doc[firsts]
    lasts = np.append(firsts[1:], len(inputs.doc))
    strength = net.p["word"][x_rows, 0][inputs.word]
    logits = np.array([strength[s: s + n].max() for s, n in zip(inputs.start, inputs.size)])
    for epoch in range(epochs):
        if epoch and epoch % 6 == 0:
            logits = net.window_logits(inputs)
        chosen = np.array([a + int(np.argmax(logits[a:b])) for a, b in zip(firsts, lasts)])
        order = rng.permutation(len(chosen))
        for k in range(0, len(order), 128):
            at, doc = chosen[order[k: k + 128]], owners[order[k: k + 128]]
            words, place = np.unique(inputs.word[window_words(inputs, at)], return_inverse=True)
            x = inputs.vectors(net.p, words)
            logit, kept = net.forward(net.tables(x), place.reshape(len(at), WINDOW), inputs.size[at], keep=True)
            grads = net.backward((sigmoid(logit) - y[doc]) / len(at), kept, x, inputs, words)
            grads["word"] *= known
            grads["word"][:, 0] = 0  # fixed: else one noisy label makes any word of its text telling
            grads["char"] += DECAY * net.p["char"]
            grads["word"][:, 1:] += DECAY * net.p["word"][:, 1:]
            for name in ("in_f", "in_b", "rec_f", "rec_b", "att", "out"):
                grads[name] += 1e-4 * net.p[name]
            adam.update(grads)
    return net


def association(pos: np.ndarray, neg: np.ndarray, positives: float, negatives: float) -> np.ndarray:
    """Signed root of the log-likelihood ratio of a word with the label, less what chance often gives."""
    share = (pos + neg) / (positives + negatives)
    root = np.zeros(len(pos))
    for seen, whole in ((pos, positives), (neg, negatives)):
        for count, expected in ((seen, whole * share), (whole - seen, whole * (1 - share))):
            root += np.where(count > 0, count * np.log(np.maximum(count, 1e-9) / np.maximum(expected, 1e-9)), 0)
    root = np.sqrt(np.maximum(2 * root, 0))
    sign = np.sign(pos * negatives - neg * positives)
    return np.clip(sign * np.maximum(root - CHANCE, 0) / 2, -4, 4)


def word_counts(inputs: Inputs, docs: int) -> np.ndarray:
    """Words of each text, from its windows."""
    out = np.zeros(docs, np.int64)
    if len(inputs.doc):
        firsts = np.flatnonzero(np.diff(inputs.doc, prepend=-1))
        lasts = np.append(firsts[1:], len(inputs.doc)) - 1
        out[inputs.doc[firsts]] = inputs.start[lasts] + inputs.size[lasts] - inputs.start[firsts]
    return out


def fit_toxicity(docs: DataFrame, labels: DataFrame, rows: int = TRAIN_DOCS) -> Network:
    """Fit on labelled rows whose crc32(doc_id as text) mod 3 is not 1."""
    return train(labelled_sample(docs, labels, "toxic", learns(3, 1), rows, TRAIN_CHARS))


def toxicity_scores(docs: DataFrame, net: Network) -> DataFrame:
    """(doc_id, score) of every document."""
    bounded_batches(docs.sparkSession)
    sent = docs.sparkSession.sparkContext.broadcast(net)  # 1.3 MB of weights

    def score(texts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in texts:
            for part in groups(pdf, limit=1 << 20):
                yield pd.DataFrame({"doc_id": part["doc_id"], "score": sent.value.document_scores(list(part["text"]))})

    return docs.select(F.col("doc_id").cast("string"), "text").mapInPandas(score, "doc_id string, score double").withColumn(
        "doc_id", F.col("doc_id").cast("long"))


def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity of every document; predicted at 0.7."""
    docs = read(spark, sf_dir, "documents", "doc_id", "text")
    net = fit_toxicity(docs, read(spark, sf_dir, "labels", "doc_id", "toxic"))
    return toxicity_scores(docs, net).select(
        "doc_id", (fold(F.col("doc_id"), 3) == 1).alias("held_out"), "score",
        (F.col("score") >= 0.7).cast("int").alias("predicted"))
