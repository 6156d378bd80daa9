"""Operator 5: language identification by segmentation-marginalised unigrams over a fixed public vocabulary.

The vocabulary is that of a public sentence-piece file (only its pieces are used, never its own scores). Each language has a
probability for every piece; the probability of a word (lower-cased, with the word mark in front) is the sum over all its
segmentations into pieces of the product of their probabilities, by the forward algorithm. Words are runs of letters. A
text's score is the sum of its words' log-probabilities plus the language's share of all training documents, and the answer
the language with the highest posterior. A character that is no piece is spelt by its byte pieces. Pieces and words of any
length count; a word of over ``LONG`` letters is scored from left to right with the sums of its last places, so its memory
doesn't grow with its length (in training alone, it teaches in parts of ``LONG`` letters).

Training: words are counted by language over at most ``TRAIN_DOCS`` documents of each language, those first by a hash of
doc_id (partial counts before the shuffle); piece probabilities are then estimated by ``ROUNDS`` rounds of expectation-maximisation: forward-backward gives each
word's expected pieces, Spark sums them by (language, piece), and at most vocabulary x languages numbers reach the driver.
Scoring: one pass without a shuffle; a worker keeps the log-probabilities of words it has met (bounded).

Defined results: ``und`` with score 0 if the text is null or has no letter, or if there was nothing to learn from;
ties go to the language that sorts first; the score is the posterior; rows with a null lang don't teach; repeated rows
and null ids each get a row; an empty table gives none; other columns are ignored.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tessera.llm.common import bounded_batches, fold, read, written
from tessera.llm.learning import learns

ROUNDS = 2
MARK = "▁"
LETTERS = re.compile(r"[^\W\d_]+")
TRAIN_DOCS = 5000
CACHE_WORDS, CACHE_NUMBERS = 600_000, 8_000_000
KEPT_WORD = 64  # longer words aren't kept between batches
LONG = 2000
LATTICE_CHARS, LATTICE_NUMBERS = 256_000, 8_000_000
ORDER_BUCKETS = 1 << 14
FLOOR = 1e-9


def default_path() -> str:
    import public_tokenizers
    return public_tokenizers.path("piece_bpe_32k.model")


class Vocabulary:
    """Pieces by a 64-bit hash of their characters, the length of the longest, and the byte pieces."""

    def __init__(self, path: str):
        import sentencepiece
        model = sentencepiece.SentencePieceProcessor(model_file=path)
        self.size = model.get_piece_size()
        self.bytes = np.zeros(256, np.int64)
        pieces, number = [], []
        for i in range(self.size):
            piece = model.id_to_piece(i)
            if model.is_byte(i):
                self.bytes[int(piece[1:-1], 16)] = i
            elif not (model.is_control(i) or model.is_unknown(i) or model.is_unused(i)):
                pieces.append(piece)
                number.append(i)
        self.longest = max(map(len, pieces))
        hashes = np.empty(len(pieces), np.uint64)
        for k, piece in enumerate(pieces):
            h = np.zeros(1, np.uint64)
            for c in code_points(piece):
                h = step(h, c)
            hashes[k] = h[0]
        order = np.argsort(hashes)
        self.hashes, self.number = hashes[order], np.array(number, np.int64)[order]
        self.maybe = np.zeros(1 << 20, bool)
        self.maybe[(hashes >> np.uint64(44)).astype(np.int64)] = True

    def find(self, hashes: np.ndarray) -> np.ndarray:
        """Piece number of each hash, -1 if none."""
        out = np.full(len(hashes), -1, np.int64)
        some = np.flatnonzero(self.maybe[(hashes >> np.uint64(44)).astype(np.int64)])
        at = np.minimum(np.searchsorted(self.hashes, hashes[some]), len(self.hashes) - 1)
        hit = self.hashes[at] == hashes[some]
        out[some[hit]] = self.number[at[hit]]
        return out


def code_points(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "<u4").astype(np.uint64)


def step(h: np.ndarray, c) -> np.ndarray:
    """Hash of a string and one more character."""
    h = (h ^ (c + np.uint64(0x9E3779B97F4A7C15))) * np.uint64(0xBF58476D1CE4E5B9)
    return h ^ (h >> np.uint64(29))


_VOCABULARIES: dict[str, Vocabulary] = {}


def vocabulary(path: str) -> Vocabulary:
    if path not in _VOCABULARIES:
        _VOCABULARIES[path] = Vocabulary(path)
    return _VOCABULARIES[path]


def text_words(text: str) -> list[str]:
    """Lower-cased runs of letters."""
    return LETTERS.findall(text.lower())


class Lattice:
    """All segmentations of some words into pieces, as arcs (word, from, to, piece). A character without a piece gives one
    arc that stands for its byte pieces: piece -1 - k for ``spelt[k]``."""

    def __init__(self, words: list[str], vocab: Vocabulary):
        self.n = len(words)
        self.length = np.array([len(w) + 1 for w in words], np.int64)
        chars = code_points("".join(MARK + w for w in words))
        first = np.cumsum(self.length) - self.length
        word = np.repeat(np.arange(self.n), self.length)
        place = np.arange(len(chars)) - first[word]
        room = self.length[word] - place  # characters from here to the word's end
        h, parts = np.zeros(len(chars), np.uint64), []
        at = np.arange(len(chars))
        for size in range(1, vocab.longest + 1):
            at = at[room[at] >= size]
            if not len(at) and size > 1:
                break
            h[at] = step(h[at], chars[at + size - 1])
            piece = vocab.find(h[at])
            if size == 1:
                odd, which = np.unique(chars[at[piece < 0]], return_inverse=True)
                self.spelt = [vocab.bytes[list(chr(int(c)).encode("utf-8", "surrogatepass"))] for c in odd]
                piece[piece < 0] = -1 - which
                keep = slice(None)
            else:
                keep = piece >= 0
            parts.append(np.column_stack([word[at[keep]], place[at[keep]], place[at[keep]] + size, piece[keep]]))
        arcs = np.concatenate(parts)
        self.arcs = arcs[np.lexsort((arcs[:, 0], arcs[:, 2]))]  # by end, then word
        self.top = int(self.length.max()) if self.n else 0

    def arc_scores(self, log_p: np.ndarray) -> np.ndarray:
        """(arc, language) log-probabilities; ``log_p`` is (language, piece)."""
        piece = self.arcs[:, 3]
        out = log_p.T[np.maximum(piece, 0)]
        if self.spelt:
            odd = np.flatnonzero(piece < 0)
            sums = np.array([log_p[:, ids].sum(1) for ids in self.spelt])
            out[odd] = sums[-1 - piece[odd]]
        return out

    def forward(self, scores: np.ndarray) -> np.ndarray:
        """(word, place, language): log-sum over segmentations of the word up to each place."""
        alpha = np.full((self.n, self.top + 1, scores.shape[1]), -np.inf)
        alpha[:, 0] = 0
        cut = np.searchsorted(self.arcs[:, 2], np.arange(self.top + 2))
        for b in range(1, self.top + 1):
            rows = slice(cut[b], cut[b + 1])
            word, a = self.arcs[rows, 0], self.arcs[rows, 1]
            if len(word):
                some, sums = log_sums(alpha[word, a] + scores[rows], word)
                alpha[some, b] = sums
        return alpha

    def totals(self, log_p: np.ndarray) -> np.ndarray:
        """(word, language) log-probability of each word over all its segmentations."""
        if not self.n:
            return np.zeros((0, len(log_p)))
        return self.forward(self.arc_scores(log_p))[np.arange(self.n), self.length]

    def expected(self, log_p: np.ndarray) -> np.ndarray:
        """(arc, language): posterior probability that a word's segmentation uses the arc."""
        scores = self.arc_scores(log_p)
        alpha = self.forward(scores)
        total = alpha[np.arange(self.n), self.length]
        beta = np.full_like(alpha, -np.inf)
        beta[np.arange(self.n), self.length] = 0
        back = np.lexsort((self.arcs[:, 0], self.arcs[:, 1]))
        cut = np.searchsorted(self.arcs[back, 1], np.arange(self.top + 2))
        for a in range(self.top - 1, -1, -1):
            rows = back[cut[a]: cut[a + 1]]
            if len(rows):
                word, b = self.arcs[rows, 0], self.arcs[rows, 2]
                some, sums = log_sums(beta[word, b] + scores[rows], word)
                beta[some, a] = sums
        word = self.arcs[:, 0]
        return np.exp(alpha[word, self.arcs[:, 1]] + scores + beta[word, self.arcs[:, 2]] - total[word])


def log_sums(values: np.ndarray, group: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(groups, log(sum(exp)) of their rows) of rows sorted by group; every place of a word is reached by some arc, so
    all values are finite."""
    first = np.flatnonzero(np.diff(group, prepend=-1))
    most = np.maximum.reduceat(values, first, axis=0)
    part = np.diff(np.append(first, len(group)))
    sums = np.add.reduceat(np.exp(values - np.repeat(most, part, axis=0)), first, axis=0)
    return group[first], np.log(sums) + most


def word_groups(words: list[str], languages: int) -> Iterator[list[int]]:
    """Places of the words, shortest first, in groups whose lattices are of bounded size."""
    group, order = [], sorted(range(len(words)), key=lambda k: len(words[k]))
    for k in order:
        chars = (len(group) + 1) * (len(words[k]) + 2)
        if group and (chars > LATTICE_CHARS or chars * languages > LATTICE_NUMBERS):
            yield group
            group = []
        group.append(k)
    if group:
        yield group


def long_total(word: str, vocab: Vocabulary, log_p: np.ndarray, chunk: int = LONG) -> np.ndarray:
    """(language) log-probability of one word, ``chunk`` start places at a time; the sums of the places that later pieces
    start from, at most a longest piece away, go from one chunk to the next."""
    chars = code_points(MARK + word)
    sums = np.full((vocab.longest, len(log_p)), -np.inf)
    sums[0] = 0
    for first in range(0, len(chars), chunk):
        n = min(chunk, len(chars) - first)
        sums = np.concatenate([sums, np.full((n, len(log_p)), -np.inf)])
        h, found = np.zeros(n, np.uint64), np.full((vocab.longest, n), -1, np.int64)
        for size in range(1, vocab.longest + 1):
            at = np.arange(min(n, len(chars) - first - size + 1))
            h[at] = step(h[at], chars[first + at + size - 1])
            found[size - 1, at] = vocab.find(h[at])
        for a in range(n):
            sizes = np.flatnonzero(found[:, a] >= 0)
            sums[a + 1 + sizes] = np.logaddexp(sums[a + 1 + sizes], sums[a] + log_p[:, found[sizes, a]].T)
            if found[0, a] < 0:
                spelt = vocab.bytes[list(chr(int(chars[first + a])).encode("utf-8", "surrogatepass"))]
                sums[a + 1] = np.logaddexp(sums[a + 1], sums[a] + log_p[:, spelt].sum(1))
        sums = sums[n:]
    return sums[0]


def word_totals(words: list[str], vocab: Vocabulary, log_p: np.ndarray) -> np.ndarray:
    """(word, language) log-probability of words of any length."""
    out = np.empty((len(words), len(log_p)))
    short = [k for k, w in enumerate(words) if len(w) <= LONG]
    for k, w in enumerate(words):
        if len(w) > LONG:
            out[k] = long_total(w, vocab, log_p)
    for group in word_groups([words[k] for k in short], len(log_p)):
        at = [short[k] for k in group]
        out[at] = Lattice([words[k] for k in at], vocab).totals(log_p)
    return out


class Model:
    """Languages (sorted), log prior of each, and log-probabilities (language, piece)."""

    def __init__(self, languages: list[str], prior: np.ndarray, log_p: np.ndarray, path: str):
        self.languages, self.prior, self.log_p, self.path = languages, prior, log_p, path


def word_counts(docs: DataFrame) -> DataFrame:
    """(lang, word, n) over all training rows."""
    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total: dict[str, Counter] = {}
        for pdf in batches:
            for lang, text in zip(pdf["lang"], pdf["text"]):
                total.setdefault(lang, Counter()).update(text_words(text))
            if sum(map(len, total.values())) > CACHE_WORDS:
                yield from (counted(lang, c) for lang, c in total.items())
                total = {}
        yield from (counted(lang, c) for lang, c in total.items())

    def counted(lang: str, c: Counter) -> pd.DataFrame:
        return pd.DataFrame({"lang": lang, "word": list(c), "n": list(c.values())})

    return docs.select("lang", "text").mapInPandas(count, "lang string, word string, n long").groupBy("lang", "word").agg(F.sum("n").alias("n"))


def fit_languages(docs: DataFrame, path: str | None = None, rounds: int = ROUNDS, train_docs: int = TRAIN_DOCS) -> Model:
    """Fit on the rows of ``docs`` (doc_id, text, lang)."""
    path = path or default_path()
    spark = docs.sparkSession
    known = docs.filter("text is not null and lang is not null").withColumn("_order", F.xxhash64("doc_id"))
    # Per language, the bucket of hashes that its last training row lies in: counts are summed before the shuffle, and only
    # the rows of that one bucket are ranked.
    bucket = F.shiftright("_order", 64 - ORDER_BUCKETS.bit_length() + 1).alias("_bucket")
    upto = F.sum("_n").over(W.partitionBy("lang").orderBy("_bucket"))
    cut = (known.groupBy("lang", bucket).agg(F.count(F.lit(1)).alias("_n")).withColumn("_upto", upto)
           .filter(F.col("_upto") - F.col("_n") < train_docs).groupBy("lang").agg(
               F.max("_bucket").alias("_cut"), F.max(F.col("_upto") - F.col("_n")).alias("_before")))
    hashes = known.select("lang", "_order", bucket).join(F.broadcast(cut), "lang").filter("_bucket = _cut")  # a row a language
    nth = F.row_number().over(W.partitionBy("lang").orderBy("_order"))
    last = hashes.withColumn("_n", nth + F.col("_before")).filter(F.col("_n") <= train_docs).groupBy("lang").agg(F.max("_order").alias("_last"))
    sample = known.join(F.broadcast(last), "lang").filter("_order <= _last")
    counts = written(word_counts(sample), "word-counts")
    shares = known.groupBy("lang").count().toPandas().sort_values("lang")
    languages = shares["lang"].tolist()  # a row a language
    size = vocabulary(path).size
    if not languages:
        return Model([], np.zeros(0), np.zeros((0, size)), path)
    prior = np.log(shares["count"].to_numpy() / shares["count"].sum())
    # Start: all pieces alike, longer ones less so than their spelling in characters.
    log_p = np.full((len(languages), size), -np.log(size))
    for _ in range(rounds):
        sent = spark.sparkContext.broadcast((languages, log_p))  # languages x vocabulary

        def expect(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            names, current = sent.value
            vocab, sums = vocabulary(path), np.zeros((len(names), size))
            number = {x: k for k, x in enumerate(names)}
            for pdf in batches:
                rows = [(w[k: k + LONG], number[lang], n) for w, lang, n in zip(pdf["word"], pdf["lang"], pdf["n"])
                        for k in range(0, len(w), LONG)]
                words, langs, ns = zip(*rows) if rows else ((), (), ())
                for group in word_groups(words, len(names)):
                    lattice = Lattice([words[k] for k in group], vocab)
                    lang, n = np.array(langs)[group], np.array(ns, np.float64)[group]
                    word, piece = lattice.arcs[:, 0], lattice.arcs[:, 3]
                    use = lattice.expected(current)[np.arange(len(word)), lang[word]] * n[word]
                    known = piece >= 0
                    np.add.at(sums, (lang[word[known]], piece[known]), use[known])
                    for k in np.flatnonzero(~known):
                        np.add.at(sums, (lang[word[k]], lattice.spelt[-1 - piece[k]]), use[k])
            at = np.nonzero(sums)
            yield pd.DataFrame({"lang": at[0], "piece": at[1], "use": sums[at]})

        got = (counts.mapInPandas(expect, "lang int, piece int, use double").groupBy("lang", "piece")
               .agg(F.sum("use").alias("use")).toPandas())  # languages x vocabulary rows at most
        uses = np.zeros_like(log_p)
        uses[got["lang"], got["piece"]] = got["use"]
        uses += 0.01
        log_p = np.log(np.maximum(uses / uses.sum(1, keepdims=True), FLOOR))
    return Model(languages, prior, log_p, path)


class Scorer:
    """Scores texts; keeps the log-probabilities of words (a number a language) up to ``CACHE_WORDS``."""

    def __init__(self, model: Model):
        self.model, self.vocab = model, vocabulary(model.path)
        self.place: dict[str, int] = {}
        self.table = np.zeros((0, len(model.languages)), np.float32)
        self.limit = min(CACHE_WORDS, CACHE_NUMBERS // max(1, len(model.languages)))

    def learn(self, words: set[str]) -> None:
        new = [w for w in words if w not in self.place]
        if not new:
            return
        if len(self.place) + len(new) > self.limit:
            self.place, self.table = {}, self.table[:0]
            new = list(words)
        part = word_totals(new, self.vocab, self.model.log_p)
        for w in new:
            self.place[w] = len(self.place)
        self.table = np.concatenate([self.table, part]).astype(np.float32)

    def posteriors(self, texts: list[str]) -> np.ndarray:
        """(text, language)."""
        lists = [text_words(t) for t in texts]
        rare = sorted({w for words in lists for w in words if len(w) > KEPT_WORD})
        self.learn({w for words in lists for w in words if len(w) <= KEPT_WORD})
        totals = dict(zip(rare, word_totals(rare, self.vocab, self.model.log_p)))
        logs = np.tile(self.model.prior, (len(texts), 1))
        for k, words in enumerate(lists):
            kept = [self.place[w] for w in words if len(w) <= KEPT_WORD]
            if kept:
                logs[k] += self.table[kept].sum(0, dtype=np.float64)
            if len(kept) < len(words):
                logs[k] += sum(totals[w] for w in words if len(w) > KEPT_WORD)
        logs -= logs.max(1, keepdims=True)
        p = np.exp(logs)
        return p / p.sum(1, keepdims=True)


def predict_languages(docs: DataFrame, model: Model) -> DataFrame:
    """(doc_id, lang_pred, score) of every document."""
    bounded_batches(docs.sparkSession)
    sent = docs.sparkSession.sparkContext.broadcast(model)  # languages x vocabulary

    def predict(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        model = sent.value
        scorer = Scorer(model)
        for pdf in batches:
            lang, score = np.full(len(pdf), "und", object), np.zeros(len(pdf))
            some = [k for k, t in enumerate(pdf["text"]) if model.languages and t and LETTERS.search(t)]
            for k in range(0, len(some), 250):
                at = some[k: k + 250]
                p = scorer.posteriors([pdf["text"].iloc[i] for i in at])
                best = p.argmax(1)
                lang[at], score[at] = np.array(model.languages, object)[best], p[np.arange(len(at)), best]
            yield pd.DataFrame({"doc_id": pdf["doc_id"], "lang_pred": lang, "score": score})

    return docs.select(F.col("doc_id").cast("string"), "text").mapInPandas(
        predict, "doc_id string, lang_pred string, score double").withColumn("doc_id", F.col("doc_id").cast("long"))


def op5_langid(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of every document, learnt from those whose crc32(doc_id as text) mod 3 is not 1."""
    docs = read(spark, sf_dir, "documents", "doc_id", "text", "lang")
    model = fit_languages(docs.filter(learns(3, 1)))
    return predict_languages(docs.select("doc_id", "text"), model).select(
        "doc_id", (fold(F.col("doc_id"), 3) == 1).alias("held_out"), "lang_pred", "score")
