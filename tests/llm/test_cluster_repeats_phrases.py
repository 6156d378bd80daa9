"""Shallot clustering, repeated passages and collocations against plain versions."""

import hashlib
import re
import tracemalloc
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from tessera.llm import cluster, phrases, repeats


def clashing(df):
    for name in ("row", "key", "_key", "repeats", "kept", "cluster", "n", "group", "phrase", "rank", "places", "part"):
        df = df.withColumn(name, F.lit("clash"))
    return df


# Clustering -------------------------------------------------------------------------------

def plain_kmeans(rows, k, rounds, seed=1):
    key = lambda r: (r[0] is None, hashlib.sha256(f"{seed}:{r[0]}".encode()).hexdigest() if r[0] is not None else "", r[1])
    centroids = [list(r[1]) for r in sorted(rows, key=key)[:k]]
    near = lambda v: min((sum((a - b) ** 2 for a, b in zip(v, c)), j) for j, c in enumerate(centroids))
    for _ in range(rounds):
        own = defaultdict(list)
        for _, v in rows:
            own[near(v)[1]].append(v)
        for j, vs in own.items():
            centroids[j] = [sum(x) // len(vs) for x in zip(*vs)]
    return sorted(((i, near(v)[1], near(v)[0]) for i, v in rows), key=str), centroids


@pytest.mark.parametrize("dim, k, spread", [(2, 16, 3), (3, 5, 40), (8, 16, 1000), (4, 7, 1 << 26), (3, 1, 9)])
def test_clusters_equal_plain_kmeans(spark, dim, k, spread):
    rng = np.random.default_rng(dim * k)
    rows = [(int(i), [int(x) for x in rng.integers(-spread, spread, dim)]) for i in range(300)]
    rows += [(7, rows[7][1]), (7, rows[8][1]), (None, rows[3][1]), (None, rows[4][1])]  # repeated and null ids
    df = clashing(spark.createDataFrame(rows, "vec_id long, v array<long>")).repartition(4)
    got, stats = cluster.shallot(df, dim, k, 3)
    want, centroids = plain_kmeans(rows, k, 3)
    assert sorted(((r.vec_id, r.cluster, r.distance) for r in got.collect()), key=str) == want
    for r in stats.collect():
        assert r.centroid == centroids[r.cluster]
        assert (r.n, r.distance) == (sum(w[1] == r.cluster for w in want), sum(w[2] for w in want if w[1] == r.cluster))


def test_bounds_spare_distances():
    rng = np.random.default_rng(5)
    middle = rng.integers(-1000, 1000, (40, 6))
    x = (middle[rng.integers(0, 40, 5000)] + rng.integers(-20, 20, (5000, 6))).astype(np.int32)
    first, second = cluster.Search(middle), cluster.Search(middle + 1, middle)
    near = first.start(len(x))
    assert first.assign(x, near) <= 5000 * 41  # nothing is known yet
    assert second.assign(x, near) < 500  # bounds alone decide
    near["upper"], near["lower"] = np.inf, 0
    assert cluster.Search(middle + 1).assign(x, near) < 5000 * 40 / 3  # the ball leaves most centroids out
    assert (near["a"] == ((x[:, None, :].astype(np.int64) - (middle + 1)) ** 2).sum(2).argmin(1)).all()


def test_odd_vectors(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(1, [0.5, 0.25]), (2, None), (3, [1.0, nan]), (4, [inf, 0.0]), (5, [None, 1.0]), (6, [1.0]), (7, []), (8, [-0.1, 3.0])]
    df = spark.createDataFrame(rows, "vec_id long, e array<double>")
    assert sorted(r.vec_id for r in df.filter(cluster.usable("e", 2)).collect()) == [1, 8]
    empty = spark.createDataFrame([], "vec_id long, v array<long>")
    got, stats = cluster.shallot(empty, 2)
    assert got.count() == 0 and stats.count() == 0
    few, stats = cluster.shallot(spark.createDataFrame([(1, [0, 0]), (2, [5, 5])], "vec_id long, v array<long>"), 2)
    assert few.count() == 2 and stats.count() == 2
    with pytest.raises(Exception, match="below"):
        cluster.shallot(spark.createDataFrame([(1, [1 << 30, 0])], "vec_id long, v array<long>"), 2)


# Repeated passages --------------------------------------------------------------------------

def plain_repeats(texts, window):
    every = [re.findall(r"[^\x20\x09-\x0D]+", t or "") for t in texts]
    count = Counter(tuple(w[i: i + window]) for w in every for i in range(len(w) - window + 1))
    out = []
    for w in every:
        gone = {j for i in range(len(w) - window + 1) if count[tuple(w[i: i + window])] > 1 for j in range(i, i + window)}
        out.append((len(w), len(gone), " ".join(x for j, x in enumerate(w) if j not in gone)))
    return out


def corpus(seed, window):
    """Texts of few words with planted passages, runs, periods, copies, nulls and odd spaces."""
    rng = np.random.default_rng(seed)
    some = lambda n, v=30: " ".join(f"w{x}" for x in rng.integers(0, v, n))
    passages = [some(n) for n in (window - 1, window, window + 1, window + 7, 4 * window)]
    texts = [some(40) + " " + passages[k % 5] + " " + some(int(rng.integers(0, 30))) for k in range(30)]
    texts += [passages[4], passages[4] + " end", "x " * (3 * window), "x " * window, "x " * (window - 1) + "y", "a b " * (2 * window),
              "a b c d " * (window // 4 + 1), "a b a b a b " + some(2 * window, 2), some(5 * window, 2), None, None, "", " \t\n ",
              "É é " * window, texts[0], texts[0], texts[1].replace(" ", " \r\n\x0b"), "Ab aB AB", some(3000, 4)]
    return texts


@pytest.mark.parametrize("window, rounds, bits", [(5, 5, 28), (12, 3, 28), (35, 5, 28), (5, 5, 9), (12, 6, 9)])
def test_repeats_equal_plain_version(spark, window, rounds, bits):
    """Small filters are full, so that every claim is doubtful and the exact join decides."""
    texts = corpus(window, window)
    df = clashing(spark.createDataFrame([(k, t) for k, t in enumerate(texts)], "doc_id long, text string")).repartition(5)
    got = repeats.drop_repeats(df, window, rounds, bits)
    assert got.columns[: len(df.columns)] == df.columns
    new = got.columns[-1]
    rows = {r.doc_id: (r[new].n_words, r[new].n_removed, r[new].kept) for r in got.collect()}
    assert [rows[k] for k in range(len(texts))] == plain_repeats(texts, window)


def test_full_filters_refute_claims(spark, monkeypatch):
    joined, held = [], repeats._held
    monkeypatch.setattr(repeats, "_held", lambda *a: joined.append(1) or held(*a))
    rng = np.random.default_rng(8)
    texts = [" ".join(f"w{x}" for x in rng.integers(0, 9, 60)) for _ in range(40)]
    df = spark.createDataFrame([(k, t) for k, t in enumerate(texts)], "doc_id long, text string")
    got = {r.doc_id: tuple(r.repeats) for r in repeats.drop_repeats(df, 4, 2, 9).collect()}
    assert joined and [got[k] for k in range(40)] == plain_repeats(texts, 4)


def test_equal_windows_have_equal_anchors():
    rng = np.random.default_rng(3)
    for window, rounds, vocab in ((8, 4, 2), (20, 5, 5), (35, 5, 40), (35, 6, 2)):
        shared = " ".join(f"w{x}" for x in rng.integers(0, vocab, 3 * window))
        texts = [" ".join(f"w{x}" for x in rng.integers(0, vocab, int(rng.integers(0, 50)))) + " " + shared + " "
                 + " ".join(f"w{x}" for x in rng.integers(0, vocab, int(rng.integers(0, 50)))) for _ in range(12)]
        words = repeats.RawWords(texts)
        parse, starts = repeats.levels(words, rounds), repeats.window_starts(words, window)
        assert all((np.diff(s.left) >= 0).all() and (np.diff(s.right) >= 0).all() for s in parse)
        names, level, symbol = repeats.anchors(parse, starts, window)
        at = np.array([parse[k].start[j] for k, j in zip(level, symbol)]) - starts
        seen = {}
        for p, *found in zip(starts.tolist(), names.tolist(), level.tolist(), at.tolist()):
            assert seen.setdefault(tuple(words.hashes[p: p + window].tolist()), found) == found
        assert level.max() > 1


def test_repeats_of_nothing(spark):
    df = spark.createDataFrame([], "doc_id long, text string, key int")
    assert repeats.drop_repeats(df).count() == 0
    got = repeats.drop_repeats(spark.createDataFrame([(1, None), (1, None)], "doc_id long, text string")).collect()
    assert [tuple(r.repeats) for r in got] == [(0, 0, ""), (0, 0, "")]


# Collocations -------------------------------------------------------------------------------

def plain_phrases(rows, depth, least, first, share=50):
    count, total = defaultdict(Counter), Counter()
    for text, lang in rows:
        lang = "und" if lang is None else lang
        low = re.sub("[A-Z]", lambda m: m.group().lower(), text or "")
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", low):
            w = re.findall(r"[^\x20\x09]+", piece)
            total[lang] += len(w)
            for n in range(1, depth + 1):
                count[lang].update(tuple(w[i: i + n]) for i in range(len(w) - n + 1))
    out = []
    for lang, f in count.items():
        cands = {p: a for p, a in f.items() if len(p) > 1 and a >= least}
        held = defaultdict(int)
        for p, a in cands.items():
            for n in range(2, len(p)):
                for i in range(len(p) - n + 1):
                    held[p[i: i + n]] = max(held[p[i: i + n]], a)
        own = []
        for p, a in cands.items():
            if 100 * held[p] >= share * a:
                continue
            score, _, left, right = min((1_000_000 * a * a // (f[p[:k]] * f[p[k:]]), k, f[p[:k]], f[p[k:]]) for k in range(1, len(p)))
            own.append((score, a, " ".join(p), left, right))
        own.sort(key=lambda x: (-x[0], -x[1], x[2].encode()))
        out += [(lang, k, p, a, le, ri, total[lang], s) for k, (s, a, p, le, ri) in enumerate(own[:first], 1)]
    return sorted(out)


@pytest.mark.parametrize("depth, least, first, limit", [(3, 3, 2000, 1 << 23), (2, 2, 5, 200), (4, 3, 50, 200), (5, 2, 2000, 64)])
def test_collocations_equal_plain_version(spark, monkeypatch, depth, least, first, limit):
    monkeypatch.setattr(phrases, "SHARD_BYTES", limit)
    monkeypatch.setattr(phrases.index_shards, "__defaults__", (limit,))
    rng = np.random.default_rng(depth)
    marks = [" ", " ", " ", " ", "  ", "\t", ". ", ",", "\n", "\x0b", "! ", ".;"]
    word = lambda: rng.choice(["a", "b", "B", "é", "É", "New", "york", "c-d", "日本", " x"])
    text = lambda n: "".join(word() + marks[int(rng.integers(0, len(marks)))] for _ in range(n))
    rows = [(text(int(rng.integers(0, 60))), ["en", "fr", None, "und"][int(rng.integers(0, 4))]) for _ in range(60)]
    rows += [(None, "en"), ("", "en"), (" . \t", "fr"), (rows[0][0], rows[0][1]), ("new york " * 200, "en"), (None, None)]
    df = spark.createDataFrame(rows, "text string, lang string").withColumn("group", F.lit(1)).withColumn("phrase", F.lit(2))
    got = phrases.collocations(df.repartition(3), depth=depth, least=least, first=first)
    assert sorted(tuple(r) for r in got.collect()) == plain_phrases(rows, depth, least, first)


def test_intervals_count_every_phrase():
    """Extending in front and behind, in any order, gives each phrase its count, and both of its intervals."""
    rng = np.random.default_rng(9)
    t = np.append(rng.integers(0, 6, 400), 0).astype(np.int32)
    t = t[~((t == 0) & np.concatenate([[True], t[:-1] == 0]))]
    index = phrases.Index.of(t, 6, 4)
    for steps in ("", "b", "f", "bb", "ff", "bf", "fb", "bfb", "fbf", "ffb"):
        p = index.words()
        for s in steps:
            p, of = (index.at_end if s == "b" else index.in_front)(p)
            assert len(of) == len(p[0])
        n = len(steps) + 1
        want = Counter(tuple(t[i: i + n].tolist()) for i in range(len(t) - n + 1) if (t[i: i + n] > 0).all())
        assert {tuple(w): c for w, c in zip(p[0].tolist(), p[3].tolist())} == dict(want)
        firsts = lambda side: np.repeat(np.arange(6), np.diff(side.begin))
        assert (firsts(index.before)[p[1]] == p[0][:, 0]).all() and (firsts(index.behind)[p[2]] == p[0][:, -1]).all()


def test_suffixes_are_sorted_once(monkeypatch):
    """Symbols that fit one number are sorted in one go; too many kinds for that are ranked by doubling; both order alike."""
    rng = np.random.default_rng(4)
    t = np.append(rng.integers(0, 5, 300), 0).astype(np.int32)
    cut = lambda x, a: next((tuple(x[a: a + k].tolist()) for k in (1, 2) if x[a + k - 1] == 0), tuple(x[a: a + 3].tolist()))
    inner = np.array([k for k in range(300) if t[k] > 0])
    sorts, own = [], np.unique
    monkeypatch.setattr(phrases.np, "unique", lambda *a, **k: sorts.append(1) or own(*a, **k))
    few = phrases.transform(t, 3)
    assert not sorts
    many = phrases.transform(t * (1 << 22), 3)  # 3 symbols of 25 bits
    assert sorts and sorted(few.tolist()) == sorted(t.tolist()) and sorted((many >> 22).tolist()) == sorted(t.tolist())
    firsts = sorted(cut(t, int(a)) for a in range(301))  # suffixes by their first 3 symbols, in order
    for got in (few, many >> 22):
        for first in {cut(t, int(a)) for a in inner}:
            low, n = firsts.index(first), firsts.count(first)
            assert sorted(got[low: low + n].tolist()) == sorted(int(t[a - 1]) for a in range(301) if cut(t, a) == first)
    assert phrases.transform(np.zeros(0, np.int32), 3).size == 0


def test_extensions_of_one_side_leave_the_other():
    index = phrases.Index.of(np.array([1, 2, 1, 2, 0], np.int32), 3, 3)
    index.at_end(index.words())
    assert "longer" in vars(index.behind) and "longer" not in vars(index.before)


def test_shards_take_little_memory(monkeypatch):
    """Words are numbered a text at a time and intervals extended in slices: building a shard and counting its phrases each stay
    under 14 times its bytes (19 and 24 times on English texts before); slices of any size give the same phrases."""
    rng = np.random.default_rng(5)
    parts = [b". ".join(b" ".join(b"w%d" % w for w in rng.zipf(1.3, 12) % 20_000) for _ in range(40)) for _ in range(500)]
    most = 14 * sum(map(len, parts))
    tracemalloc.start()
    words, before, behind = phrases.shard(parts, 3)
    assert tracemalloc.get_traced_memory()[1] < most
    words = words.split(b"\n")
    everything = (np.full(1 << 13, 255, np.uint8), 16)

    def found(rows):
        monkeypatch.setattr(phrases, "STEP_ROWS", rows)
        index = phrases.Index(np.frombuffer(before, np.int32), np.frombuffer(behind, np.int32), len(words) + 1)
        return phrases.grown(index, phrases.prints(words, "g"), [everything] * 2)

    tracemalloc.reset_peak()
    held = tracemalloc.get_traced_memory()[0]
    counts = sum(int(p[3].sum()) for p in found(1 << 15))
    assert tracemalloc.get_traced_memory()[1] - held < most
    tracemalloc.stop()
    want = Counter(tuple(s[k: k + 3]) for part in parts for s in (piece.split() for piece in part.split(b".")) for k in range(len(s) - 2))
    assert counts == sum(want.values())
    for rows in (1000, 1 << 30):
        got = [(tuple(words[j - 1] for j in w), c) for p in found(rows) for w, c in zip(p[0].tolist(), p[3].tolist())]
        assert len(got) == len(want) and dict(got) == dict(want)


def test_scores_of_large_counts_are_exact(spark):
    big = 3_000_000_017
    words = spark.createDataFrame([("g", "a", big + 2), ("g", "b", big + 5)], "group string, phrase string, f long")
    pairs = spark.createDataFrame([("g", "a b", big)], "group string, phrase string, f long")
    got = phrases.scored([words, pairs], 2).first()
    assert got.score == 1_000_000 * big * big // ((big + 2) * (big + 5)) and (got.l, got.r) == (big + 2, big + 5)


def test_collocations_of_nothing(spark):
    assert phrases.collocations(spark.createDataFrame([], "text string, lang string")).count() == 0
    assert phrases.collocations(spark.createDataFrame([(None, None), ("", "en")], "text string, lang string")).count() == 0


def test_an_index_takes_few_bytes_a_word():
    """Each row's suffix took 24 bytes a word, in shards of 6 MB; workers went over their memory on a large table."""
    symbols = np.random.default_rng(0).integers(0, 5000, 200_000).astype(np.int32)
    side = phrases.Side(symbols, 5000)
    tracemalloc.start()
    longer = side.longer
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak * phrases.SHARD_BYTES <= 18 * len(symbols) * (4 << 20)
    assert longer.tolist() == np.argsort(np.argsort(symbols, kind="stable"), kind="stable").tolist()
