"""Operator 9: personal data by a linear-chain conditional random field, beside fixed base patterns.

Base spans come from four patterns (email, ip, card, phone). A linear-chain CRF over word-shape features adds spans that
the patterns miss (obfuscated emails, local phone numbers, grouped cards, IPv6). It is trained by exact
gradients (forward-backward in numpy) on a small labelled table written out from the templates below, and decoded by
Viterbi over batches of texts.

Decoding is exact and skips most words: labels are O and the four kinds without forbidden transitions, so a word whose
O score leads every other by at least the most that two transitions can give is O on some best path. Such words
are fixed as O, and only the runs between them are decoded.

Scale: one pass without a shuffle; texts are processed whole, a bounded batch at a time.

Defined results: null counts as empty; empty texts have no spans; base spans always stay, an added span that touches
one is dropped; kinds are listed as email, ip, card, phone, then by start; positions are code points, end exclusive;
repeated rows and null ids each give a row; an empty table gives none; other columns are ignored (and kept by
``redact``, which replaces each span by its kind in brackets and sets ``n_chars`` anew).
"""

from __future__ import annotations

import functools
import ipaddress
import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.llm.common import bounded_batches, read

# Kinds and base patterns.
KINDS = ["email", "ip", "card", "phone"]
IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
EMAIL_DOMAIN = re.compile(r"@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
EMAIL_NAME = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")


def luhn(digits: str) -> bool:
    total = 0
    for k, d in enumerate(reversed(digits)):
        x = ord(d) - 48
        if k % 2:
            x = 2 * x - 9 if x > 4 else 2 * x
        total += x
    return total % 10 == 0


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(kind, start, end) of the base patterns, leftmost and without overlap in each kind.

    Emails are found from their "@": the name is the run of name characters before it, back to the last match. An ip
    can only start where no digit precedes, so runs of digits are read once."""
    out = []
    if "@" in text:
        last = 0
        for m in EMAIL_DOMAIN.finditer(text):
            a = m.start()
            while a > last and text[a - 1] in EMAIL_NAME:
                a -= 1
            if a < m.start():
                out.append((0, a, m.end()))
                last = m.end()
    for m in IP.finditer(text):
        if all(len(p) < 3 or (len(p) == 3 and p <= "255") for p in (x.lstrip("0") for x in m[0].split("."))):
            out.append((1, m.start(), m.end()))
    for m in CARD.finditer(text):
        digits = m[0].replace(" ", "").replace("-", "")
        if 13 <= len(digits) <= 19 and luhn(digits):
            out.append((2, m.start(), m.end()))
    if "+" in text:
        for m in PHONE.finditer(text):
            if 9 <= sum(c in "0123456789" for c in m[0]) <= 15:
                out.append((3, m.start(), m.end()))
    return out


# The labelled table: templates with slots; {kind:...} is labelled, the rest is not.
POSITIVE = {
    "phone": ["(555) 010-9932", "555-010-4821", "555.010.7733", "(020) 7946 0018", "0171 555 0199", "1-800-555-0147",
              "(0301) 555-7134", "212-555-0186", "(415) 555 0132"],
    "email": ["jane.doe [at] mail [dot] org", "sam (at) example (dot) com", "kim_lee[at]host.example.net",
              "ana@localhost", "joe.b(at)example.org", "max [at] example.com", "lea.k (at) mail.example.org"],
    "card": ["4111.1111.1111.1111", "5500/0000/0000/0004", "4000_1234_5678_9010", "3782.822463.10005"],
    "ip": ["2001:db8::8a2e:370:7334", "fe80::1ff:fe23:4567:890a", "2001:db8:0:1:1:1:1:1", "::ffff:a00:1",
           "2001:db8::1", "fe80::1", "fd00:12::ab:1"],
}
BEFORE = {
    "phone": ["call", "phone", "tel:", "fax", "mobile", "reach me on", "dial", "number is", "and", "the"],
    "email": ["mail", "write to", "email:", "contact", "send it to", "from", "the"],
    "card": ["card", "visa", "paid with", "card number", "charged to", "the"],
    "ip": ["host", "address", "server", "from", "ip", "at"],
}
PLAIN_LINES = [
    "the report of 2024-01-05 lists 12 items at 12:30 and 14:45.", "version 3.11.2 costs $12.99 or 10,50 EUR today",
    "see pages 12-15 and 130-142 (chapter 4) of volume 2", "ISBN 978-3-16-148410-0 was printed in 1998",
    "a total of 1,234,567 rows (45%) and 3.14159 of 2,000.50", 'token = "77bbad26ca7ed0a1736a7470461894fd3b9ac859"',
    "password=323f6934733ace8eca or secret: 9f8e7d6c5b4a", "order 4821-77 shipped on 05/11/2023 at noon",
    "look at the dot on the map, it is at (or near) the top", "der Bericht vom 12.03.2021 hat 17 Seiten und 3 Tabellen",
    "el 15 de mayo de 1999, a las 10:30, salieron 200 personas", "le 14 juillet 1789, 25 % des gens; 3 fois",
    "a[i] = b(j) + c[0]; x->y :: z", "item*** other### third$$$ more%%% any&&&", "one | two | three | 44 | 55-66 |",
    "LOUD!! WORDS!! HERE!! 99!! TIMES!!", "room 404, floor 7, seat 12A, row 33-34", "std::vector and a::b::c in code",
    "ratio 16:9 at 60 fps, 1080p, 4:3, key=value", "born 1970 (aged 53), call the number three men to the host",
    "mail the card at once and phone the server", "see http://example.com/a/b?c=1 and file_12.txt, v2.0-beta3",
    "(a) first (b) second [c] third {d} fourth <e>", "No. 12345 of 67890, lot 555 of 010, code 9932",
]
EDGE = " .,;:!?\"'<>{}|"


def labelled_table() -> list[tuple[list[str], list[int]]]:
    """(words, labels) of each line; label 0 is O, then the kinds."""
    lines = [(line.split(), [0] * len(line.split())) for line in PLAIN_LINES] * 3
    tails = ["today", "or later.", "and wait", "in the house,", "."]
    for kind, values in POSITIVE.items():
        label = KINDS.index(kind) + 1
        for k, value in enumerate(values):
            for n, head in enumerate(BEFORE[kind]):
                tail = tails[(k + n) % len(tails)]
                filler = PLAIN_LINES[(3 * k + n) % len(PLAIN_LINES)].split()[:4]
                inside = (value + (tail if tail == "." else "")).split()
                after = [] if tail == "." else tail.split()
                words = [*filler, *head.split(), *inside, *after]
                labels = [0] * (len(filler) + len(head.split())) + [label] * len(inside) + [0] * len(after)
                lines.append((words, labels))
    return lines


RUN = re.compile(r"[0-9]+|[^\W\d_]+")


def shape(word: str) -> str:
    """Digits as d and their number (9 at most), letter runs as a (h if all are hex digits and some digit is near)."""
    return RUN.sub(lambda m: f"d{min(len(m[0]), 9)}" if m[0][0].isdigit() else "a", word)


def features(word: str) -> list[str]:
    core = word.strip(EDGE)
    if core.isalpha():
        low = core.lower()
        return ["alpha", f"word={low}"] if low in TRIGGERS else ["alpha"]
    s = shape(core)
    digits = sum(c.isdigit() for c in core)
    out = ["other", f"shape={s[:24]}", f"digits={min(digits, 20)}", f"kinds={''.join(sorted(set(re.sub('[da0-9]', '', s))))[:6]}"]
    out += [f"open={core[0] if core and not core[0].isalnum() else 'x'}", f"close={core[-1] if core and not core[-1].isalnum() else 'x'}"]
    if "@" in core or re.search(r"[\[(](at|dot)[\])]", core.lower()):
        out.append("at")
    if core.count(":") > 1 and re.fullmatch("[0-9A-Fa-f:]+", core):
        out.append("colons")
    return out


TRIGGERS = frozenset("call phone tel fax mobile dial number mail email contact write card visa host address server ip at dot".split())
LABELS = 1 + len(KINDS)


class Field:
    """The trained CRF: scores of a word's features for itself and for its neighbours, and transitions."""

    def __init__(self, steps: int = 300, rate: float = 0.1, decay: float = 2e-4, move_decay: float = 2e-2):
        lines = labelled_table()
        names = sorted({f for words, _ in lines for w in words for f in features(w)})
        self.names = {f: k for k, f in enumerate(names)}
        x = [[[self.names[f] for f in features(w)] for w in words] for words, _ in lines]
        length = max(map(len, x))
        n, v = len(x), len(names)
        on = np.zeros((n, length, v))
        y = np.zeros((n, length), int)
        mask = np.zeros((n, length), bool)
        for i, (rows, (_, labels)) in enumerate(zip(x, lines)):
            y[i, : len(labels)], mask[i, : len(labels)] = labels, True
            for t, row in enumerate(rows):
                on[i, t, row] = 1
        before, after = np.zeros_like(on), np.zeros_like(on)
        before[:, 1:], after[:, :-1] = on[:, :-1], on[:, 1:]
        on = np.concatenate([on, before, after], 2)
        weights, move = np.zeros((3 * v, LABELS)), np.zeros((LABELS, LABELS))
        state = [np.zeros_like(weights), np.zeros_like(weights), np.zeros_like(move), np.zeros_like(move)]
        flat, gold = on.reshape(-1, 3 * v), np.eye(LABELS)[y] * mask[..., None]
        pairs = np.zeros((LABELS, LABELS))
        for i in range(n):
            path = [0, *y[i][mask[i]], 0]
            np.add.at(pairs, (path[:-1], path[1:]), 1)
        for step in range(1, steps + 1):
            unary = (flat @ weights).reshape(n, length, LABELS)
            node, edge = marginals(unary, move, mask)
            gw = flat.T @ (gold - node).reshape(-1, LABELS) / n - decay * weights
            gm = (pairs - edge) / n - move_decay * move
            for k, (p, g) in enumerate(((weights, gw), (move, gm))):
                m, s = state[2 * k], state[2 * k + 1]
                m += 0.1 * (g - m)
                s += 0.01 * (g * g - s)
                p += rate * (m / (1 - 0.9 ** step)) / (np.sqrt(s / (1 - 0.99 ** step)) + 1e-8)
        self.own, self.before, self.after = weights[:v], weights[v: 2 * v], weights[2 * v:]
        self.move = move
        # The most that two transitions can gain by a label other than O, whatever the neighbours.
        gain = move[:, 1:, None] + move[None, 1:, :] - move[:, :1, None] - move[None, :1, :]
        self.bound = float(gain.max())


def marginals(unary: np.ndarray, move: np.ndarray, mask: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Node marginals (0 outside the mask) and summed edge marginals, both ends of a line bordered by O."""
    n, length, labels = unary.shape
    scale = np.exp(move)
    e = np.exp(unary - unary.max(2, keepdims=True))
    alpha, beta = np.zeros_like(e), np.zeros_like(e)
    edge = np.zeros((labels, labels))
    prev = np.tile(np.eye(labels)[0], (n, 1))
    for t in range(length):
        now = (prev @ scale) * e[:, t]
        now /= now.sum(1, keepdims=True)
        prev = np.where(mask[:, t, None], now, prev)
        alpha[:, t] = prev
    last = mask.sum(1) - 1
    nxt = np.zeros((n, labels))
    for t in range(length - 1, -1, -1):
        end = (last == t)[:, None]
        nxt = np.where(end, scale[:, 0][None], nxt)
        beta[:, t] = nxt
        here = e[:, t] * nxt
        here = here / np.maximum(here.sum(1, keepdims=True), 1e-300)
        pre = alpha[:, t - 1] if t else np.tile(np.eye(labels)[0], (n, 1))
        joint = pre[:, :, None] * scale[None] * here[:, None, :] * mask[:, t, None, None]
        edge += (joint / np.maximum(joint.sum((1, 2), keepdims=True), 1e-300)).sum(0)
        nxt = np.where(mask[:, t, None], here @ scale.T, nxt)
    node = alpha * beta
    node /= np.maximum(node.sum(2, keepdims=True), 1e-300)
    close = np.zeros((labels, labels))
    close[:, 0] = node[np.arange(n), last].sum(0)
    return node * mask[..., None], edge + close


@functools.lru_cache(1)
def field() -> Field:
    return Field()


class Tagger:
    """Decodes batches of word lists; words map to profiles (sets of known features), of which there are few."""

    CACHE_WORDS = 500_000

    def __init__(self, crf: Field):
        self.crf, self.words, self.profiles = crf, {}, {}
        self.tables = np.zeros((1, 3, LABELS))  # profile 0: outside the text
        self.plain = self._profile(("alpha",))

    def _profile(self, names: tuple[str, ...]) -> int:
        known = tuple(sorted(k for f in names if (k := self.crf.names.get(f)) is not None))
        if known not in self.profiles:
            c, at = self.crf, list(known)
            row = np.stack([c.own[at].sum(0), c.before[at].sum(0), c.after[at].sum(0)])
            self.profiles[known] = len(self.tables)
            self.tables = np.concatenate([self.tables, row[None]])
        return self.profiles[known]

    def profile(self, word: str) -> int:
        got = self.words.get(word)
        if got is None:
            if len(self.words) > self.CACHE_WORDS:
                self.words.clear()
            core = word.strip(EDGE)
            plain = core.isalpha() and core.lower() not in TRIGGERS
            got = self.words[word] = self.plain if plain else self._profile(tuple(features(word)))
        return got

    def tag(self, lists: list[list[str]]) -> list[dict[int, int]]:
        """Word index -> label (not O) for each list of words."""
        find, get = self.words.get, self.profile
        flat = [0]
        for words in lists:
            got = list(map(find, words))
            if None in got:
                got = [get(w) if p is None else p for w, p in zip(words, got)]
            flat += got
            flat.append(0)
        flat = np.array(flat)
        starts = np.cumsum([1] + [len(w) + 1 for w in lists])[:-1]
        lead = self.tables[..., 0] - self.tables[..., 1:].max(2)  # by profile: own, to the next word, to the word before
        # A sum of leads bounds the lead of the sum from below: most words are settled by three numbers each.
        settled = np.ones(len(flat), bool)
        settled[1:-1] = lead[flat[1:-1], 0] + lead[flat[:-2], 1] + lead[flat[2:], 2] >= self.crf.bound
        work = np.flatnonzero(~settled & (flat > 0))
        unary = self.tables[flat[work], 0] + self.tables[flat[work - 1], 1] + self.tables[flat[work + 1], 2]
        live = unary[:, 0] - unary[:, 1:].max(1) < self.crf.bound
        work, unary = work[live], unary[live]
        out: list[dict[int, int]] = [{} for _ in lists]
        if not len(work):
            return out
        cut = np.flatnonzero(np.diff(work) > 1) + 1
        firsts, sizes = np.concatenate([[0], cut]), np.diff(np.concatenate([[0], cut, [len(work)]]))
        labels = np.zeros(len(work), np.int64)
        order = np.argsort(sizes, kind="stable")
        k = 0
        while k < len(order):  # batches of runs of like length
            size = int(sizes[order[k]])
            stop = int(np.searchsorted(sizes[order], max(size, int(size * 1.25)), side="right"))
            stop = min(stop, k + max(1, 200_000 // size))
            batch = order[k:stop]
            width = int(sizes[batch].max())
            at = firsts[batch][:, None] + np.minimum(np.arange(width), sizes[batch][:, None] - 1)
            best = viterbi(unary[at], sizes[batch], self.crf.move)
            inside = np.arange(width) < sizes[batch][:, None]
            labels[at[inside]] = best[inside]
            k = stop
        found = np.flatnonzero(labels)
        text = np.searchsorted(starts, work[found], side="right") - 1
        for t, w, label in zip(text.tolist(), work[found].tolist(), labels[found].tolist()):
            out[t][w - int(starts[t])] = label
        return out


def viterbi(unary: np.ndarray, sizes: np.ndarray, move: np.ndarray) -> np.ndarray:
    """Best label paths of a batch (runs, words, labels), each bordered by O at both ends."""
    n, width, labels = unary.shape
    back = np.zeros((n, width, labels), np.int64)
    score = move[0] + unary[:, 0]
    final = score.copy()
    for t in range(1, width):
        via = score[:, :, None] + move
        back[:, t] = via.argmax(1)
        score = via.max(1) + unary[:, t]
        final = np.where((sizes > t)[:, None], score, final)
    path = np.zeros((n, width), np.int64)
    label = (final + move[:, 0]).argmax(1)
    row = np.arange(n)
    for t in range(width - 1, -1, -1):
        path[:, t] = label
        label = np.where(t < sizes, back[row, t, label], label) if t else label
        # Beyond a run's end the label waits for its last word.
    return path


def plausible(kind: int, value: str) -> bool:
    """Whether a decoded span can hold such data at all."""
    digits = sum(c.isdigit() for c in value)
    if kind == 0:
        return "@" in value or bool(re.search(r"[\[(]\s?at\s?[\])]", value.lower()))
    if kind == 1:
        try:
            return ":" in value and bool(ipaddress.ip_address(value))
        except ValueError:
            return False
    return 13 <= digits <= 19 and luhn(re.sub("[^0-9]", "", value)) if kind == 2 else 9 <= digits <= 15


def all_spans(texts: list[str], tagger: Tagger) -> list[tuple[list, list]]:
    """(base spans, all spans) of each text, both sorted by kind and start."""
    lists = [t.split() for t in texts]
    out = []
    for text, tags in zip(texts, tagger.tag(lists)):
        base = base_spans(text)
        spans = list(base)
        if tags:
            places = [(m.start(), m.end()) for m in re.finditer(r"\S+", text)]
            k, last = 0, max(tags)
            while k <= last:
                label = tags.get(k, 0)
                stop = k + 1
                while label and tags.get(stop, 0) == label:
                    stop += 1
                if label:
                    a, b = places[k][0], places[stop - 1][1]
                    while b > a and text[b - 1] in EDGE:
                        b -= 1
                    while a < b and text[a] in EDGE:
                        a += 1
                    if plausible(label - 1, text[a:b]) and all(b <= s or a >= e for _, s, e in base):
                        spans.append((label - 1, a, b))
                k = stop
        out.append((sorted(base), sorted(spans)))
    return out


def personal_spans(docs: DataFrame) -> DataFrame:
    """(doc_id, base, spans, text): spans as arrays of (kind, start, end); see the module's text."""
    bounded_batches(docs.sparkSession)
    sent = docs.sparkSession.sparkContext.broadcast(field())  # a few hundred features

    def find(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        tagger = Tagger(sent.value)
        named = lambda spans: [{"kind": KINDS[k], "start": a, "end": b} for k, a, b in spans]
        for pdf in batches:
            found = all_spans([t or "" for t in pdf["text"]], tagger)
            yield pd.DataFrame({"doc_id": pdf["doc_id"], "base": [named(b) for b, _ in found],
                                "spans": [named(s) for _, s in found]})

    span = "array<struct<kind: string, start: long, `end`: long>>"
    return docs.select(F.col("doc_id").cast("string"), "text").mapInPandas(
        find, f"doc_id string, base {span}, spans {span}").withColumn("doc_id", F.col("doc_id").cast("long"))


def listed(spans: str):
    """``kind:start:end`` of each span, comma-joined."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def op9_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts of base spans, their digest, and all spans, of every document."""
    found = personal_spans(read(spark, sf_dir, "documents", "doc_id", "text"))
    def count(kind: str):
        return F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    return found.select("doc_id", *map(count, KINDS), F.sha2(listed("base"), 256).alias("base_sha256"), listed("spans").alias("spans"))


def redact(docs: DataFrame) -> DataFrame:
    """``docs`` with every span of ``text`` replaced by its kind in brackets; overlapping spans become one, named by
    the first. Columns and their order stay; ``n_chars``, where there is one, is the new length."""
    bounded_batches(docs.sparkSession)
    sent = docs.sparkSession.sparkContext.broadcast(field())

    def cover(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        tagger = Tagger(sent.value)
        for part in texts:
            found = all_spans([t or "" for t in part], tagger)
            yield pd.Series([t if t is None else covered(t, spans) for t, (_, spans) in zip(part, found)])

    text = F.pandas_udf(cover, "string")("text")
    out = docs.withColumn("text", text)
    return out.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)) if "n_chars" in docs.columns else out


def covered(text: str, spans: list[tuple[int, int, int]]) -> str:
    out, at = [], 0
    for kind, a, b in sorted(spans, key=lambda s: (s[1], s[2])):
        if a >= at:
            out += [text[at:a], f"[{KINDS[kind]}]"]
        at = max(at, b)
    return "".join([*out, text[at:]])
