"""Operator 12: repeated passages by recompression.

A text is a sequence of words, each named by a fingerprint. A round of recompression replaces every run of one symbol by a
symbol for (symbol, length), then splits all symbols into left and right ones by a bit of their names and replaces every
left symbol that meets a right one by a symbol for the pair. A name is a fingerprint of the rule that made it, so all tasks
name equal runs and pairs alike without a dictionary. What becomes of a symbol depends on itself and its neighbours only:
every symbol carries the range of words that decided it, and a symbol whose range lies inside a window of ``window`` words
is the same wherever these words occur. So equal windows hold equal symbols at equal places, and the one of the smallest
hash among their highest symbols, the window's anchor, is shared by all of its copies.

1. Spark counts anchors by name over all texts. A window with an anchor that occurs once is no copy.
2. Windows with shared anchors are counted by a 128-bit fingerprint of their words: the exact table of repeated windows.
3. Every text claims a few windows that cover all words which it takes for repeated (windows of one stretch ``window`` words
   apart), found by filters of both tables; Spark checks the claims against the exact table.
4. Texts whose claims all hold are cut as claimed. The few others (a filter errs to one side only) have all their
   candidates joined with the exact table and are cut by that.

The filters are 16 and 32 MB at most, whatever the input; they only spare work. Where they fill up, more windows are counted
and more texts go by step 4's join, in proportion to the input. Counts combine before every shuffle, so a window that a
third of all texts hold is one row a task. No text is shuffled but those of step 4.

Defined results: null texts have no words; texts of fewer than ``window`` words keep all; equal texts are copies of each
other and both lose everything; a passage that overlaps its own copy (a long run) counts as repeated; row order, ids and
other columns are kept, whatever their names; an empty table gives no rows. A symbol longer than a window (a run) decides
nothing: its windows fall back to lower symbols, at last to single words, so very long runs are only slower.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import compress

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.llm.common import bounded_batches, fresh, read, written
from tessera.llm.dedup import sized
from tessera.llm.hashing import Words, _powers, groups, mix

WINDOW, ROUNDS = 35, 5
#: Bits that an entry of a filter sets, and the filters' sizes at most (2^27 and 2^28 bits are 16 and 32 MB).
PROBES, ANCHOR_BITS, WINDOW_BITS = 7, 27, 28
RUN, LENGTH, LEFT, SIDE = (np.uint64(x) for x in (0xD6E8FEB86659FD93, 0xA0761D6478BD642F, 0xE7037ED1A0B428DB, 0x8EBC6AF09C88C6E3))


class RawWords(Words):
    """Words ``[^\\x20\\x09-\\x0D]+``, unchanged."""

    TABLE = bytes(32 if 9 <= b <= 13 else b for b in range(256))


class Level:
    """Symbols of one round: name, words [start, end), the words [left, right) that decided it, its first and last word, and
    whether it is the first of its text."""

    FIELDS = ("name", "start", "end", "left", "right", "head", "tail", "new")

    def __init__(self, *values: np.ndarray):
        for field, value in zip(self.FIELDS, values):
            setattr(self, field, value)

    def at(self, places: np.ndarray) -> list[np.ndarray]:
        return [getattr(self, field).take(places) for field in self.FIELDS]


def levels(words: Words, rounds: int = ROUNDS) -> list[Level]:
    """The words and what each round of recompression makes of them. ``left`` and ``right`` never fall from one symbol to
    the next; a symbol that a text's border decided has a range beyond the text, so no window holds it."""
    h, n = words.hashes, len(words.hashes)
    place, new = np.arange(n, dtype=np.int32), np.zeros(n + 1, bool)
    new[words.first] = True
    now = Level(h, place, place + 1, place, place + 1, h, h, new[:n])
    out = [now]
    for r in range(rounds if n else 0):
        now = _pairs(_runs(now), np.uint64(int(SIDE) * (r + 1) % (1 << 64)))
        out.append(now)
    return out


def _runs(s: Level) -> Level:
    """Runs become one symbol. That a neighbour differs is seen from one word of it where its last (first) word differs; at a
    text's border, too, one word beyond has to be known."""
    same = ~s.new[1:]
    equal = same & (s.name[1:] == s.name[:-1])
    left, right = s.start - 1, s.end + 1
    like = same & (s.tail[1:] == s.tail[:-1])
    left[1:][like] = s.left[:-1][like]
    like = same & (s.head[1:] == s.head[:-1])
    right[:-1][like] = s.right[1:][like]
    left, right = np.minimum(left, s.left), np.maximum(right, s.right)
    if not equal.any():
        return Level(s.name, s.start, s.end, left, right, s.head, s.tail, s.new)
    first = np.flatnonzero(np.concatenate([[True], ~equal]))
    last = np.append(first[1:], len(s.name)) - 1
    name, many = s.name.take(first), np.flatnonzero(last > first)
    name[many] = mix(name[many] * RUN + (last - first + 1)[many].astype(np.uint64) * LENGTH)
    return Level(name, s.start.take(first), s.end.take(last), left.take(first), right.take(last), s.head.take(first), s.tail.take(last),
                 s.new.take(first))


def _pairs(s: Level, salt: np.uint64) -> Level:
    """A left symbol and a right one behind it become one symbol; one that found no partner was decided by its neighbour."""
    is_left = mix(s.name ^ salt) & np.uint64(1) == 1
    same = np.append(~s.new[1:], False)
    joins = is_left & same
    joins[:-1] &= ~is_left[1:]
    keep = np.flatnonzero(np.concatenate([[True], ~joins[:-1]]))
    name, start, end, left, right, head, tail, new = s.at(keep)
    joins, is_left, same = joins.take(keep), is_left.take(keep), same.take(keep)
    behind, before = keep + 1, keep - 1
    here = np.flatnonzero(joins)
    name[here] = mix(mix(name[here] + SIDE) * LEFT + s.name[behind[here]])
    end[here], right[here], tail[here] = s.end[behind[here]], s.right[behind[here]], s.tail[behind[here]]
    here = np.flatnonzero(is_left & ~joins)
    right[here] = np.where(same[here], np.maximum(right[here], s.right[np.minimum(behind[here], len(s.right) - 1)]), end[here] + 1)
    here = np.flatnonzero(~is_left)
    left[here] = np.where(new[here], start[here] - 1, np.minimum(left[here], s.left[before[here]]))
    return Level(name, start, end, left, right, head, tail, new)


def window_starts(words: Words, window: int) -> np.ndarray:
    """First words of all windows inside one text."""
    n = len(words.hashes) - window + 1
    if n <= 0:
        return np.empty(0, np.int64)
    text = np.repeat(np.arange(len(words.counts)), words.counts)
    return np.flatnonzero(text[:n] == text[window - 1:])


def _below(x: np.ndarray, n: int) -> np.ndarray:
    """For every p up to n, how many of ``x`` are below p."""
    return np.concatenate([[0], np.cumsum(np.bincount(np.clip(x, 0, n), minlength=n + 1))])


def anchors(parse: list[Level], starts: np.ndarray, window: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(name, level, symbol) of each window's anchor: of the highest level with symbols that the window alone decides,
    the one of the smallest hash, the leftmost if equal."""
    names, level, symbol = np.empty(len(starts), np.uint64), np.empty(len(starts), np.int8), np.empty(len(starts), np.int64)
    left_over, n = np.arange(len(starts)), len(parse[0].name)
    for k in range(len(parse) - 1, -1, -1):
        s = parse[k]
        if not len(left_over):
            break
        p = starts[left_over]
        a, b = _below(s.left, n)[p], _below(s.right, n + 1)[p + window + 1]  # symbols a to b - 1 lie in the window
        a += (p == 0) * int((s.left < 0).sum())
        some = a < b
        at, a, b = left_over[some], a[some], b[some]
        left_over = left_over[~some]
        if not len(at):
            continue
        each = np.flatnonzero(np.concatenate([[True], (a[1:] != a[:-1]) | (b[1:] != b[:-1])]))  # windows in a row share it
        pick = _smallest(mix(s.name), a[each], b[each])
        times = np.diff(np.append(each, len(at)))
        names[at] = np.repeat(mix(s.name[pick] + np.uint64(k)), times)
        level[at], symbol[at] = k, np.repeat(pick, times)
    return names, level, symbol


def _smallest(key: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Place of the smallest key in each [a, b), the leftmost if equal, by tables of the smallest in 1, 2, 4, ... places."""
    best, which, pick = np.arange(len(key)), np.frexp(b - a)[1] - 1, np.empty(len(a), np.int64)
    for j in range(int(which.max()) + 1):
        if j:
            x, y = best[: len(best) - (1 << j - 1)], best[1 << j - 1:]
            best = np.where(key[x] <= key[y], x, y)
        m = np.flatnonzero(which == j)
        x, y = best[a[m]], best[b[m] - (1 << j)]
        pick[m] = np.where(key[x] <= key[y], x, y)
    return pick


def window_names(words: Words, starts: np.ndarray, window: int) -> tuple[np.ndarray, np.ndarray]:
    """Two 64-bit fingerprints of the words of each window, by sums of prefixes."""
    out = []
    for salt in (np.uint64(1), SIDE):
        _powers.to(len(words.hashes) + 1)
        sums = np.zeros(len(words.hashes) + 1, np.uint64)
        np.cumsum(mix(words.hashes * salt + LENGTH) * _powers.up[: len(words.hashes)], out=sums[1:])
        out.append(mix((sums[starts + window] - sums[starts]) * _powers.down[starts]))
    return out[0], out[1]


class Filter:
    """A filter of pairs of 64-bit values with 2^bits bits: a pair sets ``PROBES`` of the 512 bits of one block. It holds all
    that were put in, and few others while there are 16 bits or more a pair."""

    def __init__(self, packed: np.ndarray, bits: int):
        self.packed, self.bits = packed, bits

    @staticmethod
    def places(one: np.ndarray, two: np.ndarray, bits: int) -> Iterator[np.ndarray]:
        block, inside = (one >> np.uint64(64 - (bits - 9))) << np.uint64(9), mix(two + SIDE)
        for k in range(PROBES):
            yield (block | ((inside >> np.uint64(9 * k)) & np.uint64(511))).astype(np.int64)

    def holds(self, one: np.ndarray, two: np.ndarray) -> np.ndarray:
        hit = np.ones(len(one), bool)
        for p in self.places(one, two, self.bits):
            hit &= (self.packed[p >> 3] >> (p & 7).astype(np.uint8)) & 1 == 1
        return hit

    @classmethod
    def of(cls, table: DataFrame, most: int) -> Filter:
        """Filter of the columns one and two, sized by the rows but of 2^most bits at most; chunks of 2^20 bits are filled on
        the executors and put together on the driver."""
        bits = int(min(most, max(16, np.ceil(np.log2(max(table.count(), 1))) + 5)))
        wide = max(bits - 20, 0)

        def fill(pdf: pd.DataFrame) -> pd.DataFrame:
            flags = np.zeros(1 << 20, np.uint8)
            one, two = pdf["one"].to_numpy(np.int64).view(np.uint64), pdf["two"].to_numpy(np.int64).view(np.uint64)
            for p in cls.places(one, two, bits):
                flags[p & ((1 << 20) - 1)] = 1
            chunk = int(one[0] >> np.uint64(64 - wide)) if wide else 0
            return pd.DataFrame({"chunk": [chunk], "bits": [np.packbits(flags, bitorder="little").tobytes()]})

        chunk = F.shiftrightunsigned("one", 64 - wide) if wide else F.pmod(F.col("one"), F.lit(1))
        out = np.zeros(max(1 << bits, 1 << 20) >> 3, np.uint8)
        for r in table.select("one", "two").groupBy(chunk.alias("c")).applyInPandas(fill, "chunk int, bits binary").collect():
            out[r["chunk"] << 17: (r["chunk"] + 1) << 17] = np.frombuffer(r["bits"], np.uint8)  # 2^(most - 20) rows of 128 KB
        return cls(out, bits)


def _each(batches: Iterator[pd.DataFrame]) -> Iterator[tuple[pd.DataFrame, RawWords]]:
    for pdf in batches:
        for part in groups(pdf):
            yield part, RawWords(part["text"].tolist())


def _signed(x: np.ndarray) -> np.ndarray:
    return x.view(np.int64)


def shared_anchors(docs: DataFrame, window: int, rounds: int) -> DataFrame:
    """(one, two): names of anchors that occur more than once, in one text or several; both columns hold the name."""
    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for _, words in _each(batches):
            names, level, symbol = anchors(levels(words, rounds), window_starts(words, window), window)
            _, one = np.unique(symbol * 64 + level, return_index=True)  # an anchor serves many windows
            names, n = np.unique(names[one], return_counts=True)
            yield pd.DataFrame({"one": _signed(names), "n": np.minimum(n, 2)})

    found = docs.select("text").mapInPandas(count, "one long, n long")
    shared = found.groupBy("one").agg(F.sum("n").alias("n")).filter("n > 1")
    return written(shared.select("one", F.col("one").alias("two")), "anchors")


class Shared:
    """What is sent to the tasks: filters of shared anchors and of repeated windows."""

    def __init__(self, window: int, rounds: int, names: Filter, windows: Filter | None = None):
        self.window, self.rounds, self.names, self.windows = window, rounds, names, windows

    def candidates(self, words: Words) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(start, fingerprint, fingerprint) of windows that can be repeated, as far as the filters tell."""
        starts = window_starts(words, self.window)
        if len(starts):
            names = anchors(levels(words, self.rounds), starts, self.window)[0]
            starts = starts[self.names.holds(names, names)]
        one, two = window_names(words, starts, self.window)
        if self.windows is not None:
            hit = self.windows.holds(one, two)
            starts, one, two = starts[hit], one[hit], two[hit]
        return starts, one, two

    def claims(self, words: Words, starts: np.ndarray) -> np.ndarray:
        """Places in ``starts`` of windows that cover all words which the candidates cover: the first and last of every
        stretch of candidates in a row, and every ``window``-th between them."""
        if not len(starts):
            return np.empty(0, np.int64)
        text = np.searchsorted(words.first, starts, side="right")
        new = np.concatenate([[True], (np.diff(starts) != 1) | (np.diff(text) != 0)])
        begin = np.flatnonzero(new)
        since = np.arange(len(starts)) - np.repeat(begin, np.diff(np.append(begin, len(starts))))
        return np.flatnonzero((since % self.window == 0) | np.append(new[1:], True))


def repeated_windows(docs: DataFrame, sent) -> DataFrame:
    """(one, two): fingerprints of windows whose words start at two places or more, exactly."""
    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for _, words in _each(batches):
            _, one, two = sent.value.candidates(words)
            order = np.lexsort((two, one))
            one, two = one[order], two[order]
            at = np.flatnonzero(np.concatenate([[True], (one[1:] != one[:-1]) | (two[1:] != two[:-1])])) if len(one) else order
            yield pd.DataFrame({"one": _signed(one[at]), "two": _signed(two[at]),
                                "n": np.minimum(np.diff(np.append(at, len(one))), 2)})

    found = docs.select("text").mapInPandas(count, "one long, two long, n long")
    return written(found.groupBy("one", "two").agg(F.sum("n").alias("n")).filter("n > 1").select("one", "two"), "windows")


def _cut(words: Words, k: int, starts: np.ndarray, window: int) -> tuple[int, int, str]:
    """(words, removed words, kept words) of text ``k`` when the windows at ``starts`` go."""
    a, b = words.first[k], words.first[k + 1]
    own = words.blob[words.starts[a]: words.ends[b - 1]].split() if b > a else []
    gone = 0
    if len(starts):
        edges = np.bincount(starts - a, minlength=b - a + 1) - np.bincount(starts - a + window, minlength=b - a + 1)
        keep = np.cumsum(edges[:-1]) == 0
        own, gone = compress(own, keep.tolist()), int((~keep).sum())
    return b - a, gone, b" ".join(own).decode("utf-8", "surrogatepass")


RESULT = "n_words long, n_removed long, kept string"


def drop_repeats(docs: DataFrame, window: int = WINDOW, rounds: int = ROUNDS, window_bits: int = WINDOW_BITS) -> DataFrame:
    """``docs`` (with a column text) and, in a column ``repeats``, (n_words, n_removed, kept): words of the text, words
    covered by windows of ``window`` words that also start anywhere else, and the other words joined by single spaces."""
    spark = docs.sparkSession
    bounded_batches(spark)
    names = shared_anchors(docs, window, rounds)
    first = spark.sparkContext.broadcast(Shared(window, rounds, Filter.of(names, ANCHOR_BITS)))  # 16 MB at most
    exact = repeated_windows(docs, first)
    sent = spark.sparkContext.broadcast(Shared(window, rounds, first.value.names, Filter.of(exact, window_bits)))  # and 32 MB
    key, result = fresh(docs, "_key"), fresh(docs, "repeats")
    refuted = _refuted(docs.select(F.md5(F.col("text").cast("binary")).alias("key"), "text"), exact, sent)

    @F.pandas_udf(RESULT)
    def as_claimed(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for texts in batches:
            rows = []
            for part in groups(pd.DataFrame({"text": texts})):
                words = RawWords(part["text"].tolist())
                starts, _, _ = sent.value.candidates(words)
                text = np.searchsorted(starts, words.first)
                rows += [_cut(words, k, starts[text[k]: text[k + 1]], window) for k in range(len(part))]
            yield pd.DataFrame(rows, columns=["n_words", "n_removed", "kept"])

    if refuted.isEmpty():
        return docs.withColumn(result, as_claimed("text"))
    keyed, small = docs.withColumn(key, F.md5(F.col("text").cast("binary"))), sized(refuted)
    good = keyed.join(small, keyed[key].eqNullSafe(small["key"]), "left_anti").withColumn(result, as_claimed("text"))
    bad = keyed.join(small, keyed[key] == small["key"], "left_semi")
    places = written(_held(bad.select(F.col(key).alias("key"), "text").dropDuplicates(["key"]), exact, sent), "places")

    @F.pandas_udf(RESULT)
    def as_joined(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.DataFrame]:
        for texts, held in batches:
            rows = []
            for t, starts in zip(texts, held):
                rows.append(_cut(RawWords([t]), 0, np.array([] if starts is None else starts, np.int64), window))
            yield pd.DataFrame(rows, columns=["n_words", "n_removed", "kept"])

    at = fresh(docs, "_at")
    places = places.select(F.col("key").alias(key), F.col("places").alias(at))
    cut = bad.join(places, key, "left").withColumn(result, as_joined("text", F.col(at)))
    return good.select(*docs.columns, result).union(cut.select(*docs.columns, result))


def _refuted(docs: DataFrame, exact: DataFrame, sent) -> DataFrame:
    """(key) of texts with a claim that isn't in the exact table."""
    def claim(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part, words in _each(batches):
            starts, one, two = sent.value.candidates(words)
            at = sent.value.claims(words, starts)
            text = np.searchsorted(words.first, starts[at], side="right") - 1
            yield pd.DataFrame({"key": part["key"].to_numpy()[text], "one": _signed(one[at]), "two": _signed(two[at])})

    claims = written(docs.filter("text is not null").mapInPandas(claim, "key string, one long, two long"), "claims")
    wrong = claims.select("one", "two").distinct().join(exact, ["one", "two"], "left_anti")
    wrong = written(wrong, "refuted")
    return written(claims.join(sized(wrong), ["one", "two"], "left_semi").select("key").distinct(), "refuted")


def _held(texts: DataFrame, exact: DataFrame, sent) -> DataFrame:
    """(key, places): first words of each text's candidates that are in the exact table; a text's own list is as long as it."""
    def every(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part, words in _each(batches):
            starts, one, two = sent.value.candidates(words)
            text = np.searchsorted(words.first, starts, side="right") - 1
            yield pd.DataFrame({"key": part["key"].to_numpy()[text], "place": starts - words.first[text],
                                "one": _signed(one), "two": _signed(two)})

    found = texts.mapInPandas(every, "key string, place long, one long, two long").join(exact, ["one", "two"], "left_semi")
    return found.groupBy("key").agg(F.collect_list("place").alias("places"))


def digest(text: Column) -> Column:
    return F.sha2(text, 256)


def op12_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words of every document that windows of 35 words found elsewhere cover, and a digest of the others."""
    cut = drop_repeats(read(spark, sf_dir, "documents", "doc_id", "text"))
    return cut.select("doc_id", "repeats.n_words", "repeats.n_removed", digest(F.col("repeats.kept")).alias("kept_sha256"))


OP12_SQL = """
WITH d AS MATERIALIZED (SELECT row_number() OVER () AS row, doc_id, regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') AS w FROM documents),
x AS MATERIALIZED (SELECT row, unnest(range(1, len(w) - 33)) AS p, w FROM d WHERE len(w) >= 35),
s AS MATERIALIZED (SELECT row, p, array_to_string(w[p : p + 34], ' ') AS t FROM x),
r AS MATERIALIZED (SELECT row, p FROM s SEMI JOIN (SELECT t FROM s GROUP BY t HAVING count(*) > 1) AS m ON s.t = m.t),
g AS MATERIALIZED (SELECT DISTINCT row, i FROM (SELECT row, unnest(range(p, p + 35)) AS i FROM r)),
e AS (SELECT row, doc_id, unnest(w) AS word, unnest(range(1, len(w) + 1)) AS i FROM d),
k AS (SELECT e.row, string_agg(word, ' ' ORDER BY e.i) AS kept, count(*) AS n FROM e ANTI JOIN g ON e.row = g.row AND e.i = g.i GROUP BY e.row)
SELECT d.doc_id, CAST(len(d.w) AS BIGINT) AS n_words, CAST(len(d.w) - coalesce(k.n, 0) AS BIGINT) AS n_removed,
  sha256(coalesce(k.kept, '')) AS kept_sha256 FROM d LEFT JOIN k ON d.row = k.row
"""
