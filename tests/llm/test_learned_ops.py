"""Learned operators: exact parts against plain versions, held-out accuracy, and edge cases."""

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from tessera.llm import chat, dedup, graph, langid, quality, toxicity
from tessera.llm.common import fold, read

EDGE = [(None, "plain words here and there"), (3, None), (3, None), (1, ""), (1, ""), (4, "?!"), (2**60 + 1, "x" * 3000), (9, "a b c " * 4000)]


@pytest.fixture(scope="module")
def edge(spark):
    df = spark.createDataFrame(EDGE, "doc_id long, text string").repartition(2)
    for name in ("_score", "_key", "row", "class", "keep", "_order", "y"):
        df = df.withColumn(name, F.lit("clash"))
    return df


def test_words_and_folds(spark):
    row = spark.sql("select cast(null as bigint) as n, 7L as k").select(fold(F.col("n"), 3).alias("n"), fold(F.col("k"), 3).alias("k")).first()
    import zlib
    assert row.n == 0 and row.k == zlib.crc32(b"7") % 3


def numeric_gradient(f, x, at, step=1e-3):
    old = x[at]
    x[at] = old + step
    up = f()
    x[at] = old - step
    down = f()
    x[at] = old
    return (up - down) / (2 * step)


def test_gru_gradients():
    rng = np.random.default_rng(0)
    texts = [" ".join(rng.choice(["ab", "cde", "f", "ghij"], n)) for n in (5, 70, 30)]
    inputs, net = toxicity.Inputs(texts), toxicity.Network()
    for k in net.p:
        net.p[k] = net.p[k].astype(np.float64)
    y = rng.integers(0, 2, len(inputs.start)).astype(float)
    words = np.arange(len(inputs.rows))
    at = np.arange(len(inputs.start))

    def loss():
        x = inputs.vectors(net.p, words)
        logit, _ = net.forward(net.tables(x), inputs.word[toxicity.window_words(inputs, at)], inputs.size[at])
        return float((np.logaddexp(0, logit) - y * logit).sum())

    x = inputs.vectors(net.p, words)
    logit, kept = net.forward(net.tables(x), inputs.word[toxicity.window_words(inputs, at)], inputs.size[at], keep=True)
    grads = net.backward(1 / (1 + np.exp(-logit)) - y, kept, x, inputs, words)
    for name in ("in_f", "in_b", "rec_f", "rec_b", "bias_f", "att", "att_v", "out"):
        for _ in range(3):
            place = tuple(rng.integers(0, n) for n in net.p[name].shape)
            assert grads[name][place] == pytest.approx(numeric_gradient(loss, net.p[name], place), rel=0.05, abs=3e-3), name
    place = (inputs.rows[0], 2)
    assert grads["word"][place] == pytest.approx(numeric_gradient(loss, net.p["word"], place), rel=0.05, abs=3e-3)


def test_windows_cover_all_words():
    for n in (1, 63, 64, 65, 112, 113, 500):
        inputs = toxicity.Inputs([" ".join(["w"] * n)])
        covered = set()
        for s, size in zip(inputs.start, inputs.size):
            covered |= set(range(s, s + size))
        assert covered == set(range(n))


def test_toxicity_held_out(spark):
    d = "/root/testdata/sf0.1"  # the smaller tables have some 30 toxic texts to learn from
    rows = toxicity.op1_toxicity(spark, d).join(
        read(spark, d, "labels", "doc_id", "toxic"), "doc_id").filter("held_out").toPandas()
    right = (rows["predicted"] == rows["toxic"]).mean()
    assert rows["score"].between(0, 1).all() and right > 0.95
    assert (rows.loc[rows["predicted"] == 1, "toxic"] == 1).mean() > 0.9


def test_toxicity_edges(spark, edge):
    labels = spark.createDataFrame([(9, 1)], "doc_id long, toxic int")
    net = toxicity.fit_toxicity(edge, labels)
    got = toxicity.toxicity_scores(edge, net).collect()
    assert len(got) == len(EDGE) and all(0 <= r.score <= 1 for r in got) and sorted(str(r.doc_id) for r in got) == sorted(str(i) for i, _ in EDGE)
    assert toxicity.toxicity_scores(edge.limit(0), net).count() == 0
    taught = toxicity.train(pd.DataFrame({"text": ["good day friend"] * 30 + ["bad foul word here"] * 30, "y": [0] * 30 + [1] * 30}), epochs=8)
    scores = taught.document_scores(["good day friend", "bad foul word here", "", None, "?!"])
    assert scores[0] < 0.3 < 0.7 < scores[1] and scores[2] == scores[3] == scores[4] == taught.prior


def test_bag_gradients():
    rng = np.random.default_rng(1)
    model = quality.BagModel()
    for k in model.p:
        model.p[k] = model.p[k].astype(np.float64)
    x = rng.standard_normal((7, quality.FEATURES))
    firsts, bag, y = np.array([0, 3, 4]), np.array([0, 0, 0, 1, 2, 2, 2]), np.array([1.0, 0.0, 1.0])

    def loss():
        logit, _ = model.forward(x, firsts, bag)
        return float((np.logaddexp(0, logit) - y * logit).mean())

    grads = model.gradients(x, firsts, bag, y)
    for name in model.p:
        place = tuple(rng.integers(0, n) for n in model.p[name].shape)
        assert grads[name][place] == pytest.approx(numeric_gradient(loss, model.p[name], place, 1e-5), rel=1e-2, abs=1e-5), name


def test_passages_of_edge_texts():
    x, doc = quality.passages([None, "", "one", "w " * 64, "w " * 65, "é!"])
    assert doc.tolist() == [0, 1, 2, 3, 4, 4, 5] and np.isfinite(x).all() and not x[0].any() and not x[1].any()
    alone, _ = quality.passages(["w " * 65])  # what stands beside a text changes nothing
    assert np.allclose(alone, x[4:6])


def test_quality_held_out_and_edges(spark, edge):
    d = "/root/testdata/sf0.01"
    rows = quality.op10_quality(spark, d).join(
        read(spark, d, "labels", "doc_id", "quality"), "doc_id").filter("held_out").toPandas()
    assert rows["score"].between(0, 1).all() and (rows["predicted"] == rows["quality"]).mean() > 0.95
    labels = read(spark, d, "labels", "doc_id", "quality")
    docs = read(spark, d, "documents", "doc_id", "text")
    kept = quality.keep_good(docs, labels)
    assert kept.columns == docs.columns and 0.7 < kept.count() / docs.count() < 1
    alone = quality.keep_good(edge, labels.limit(0))
    assert alone.columns == edge.columns and alone.count() == len(EDGE)
    assert quality.keep_good(edge.limit(0), labels).count() == 0


def test_components(spark):
    edges = [(1, 2), (2, 3), (9, 8), (8, 7), (7, 10), (5, 5), (3, 1), (20, 21), (21, 22), (22, 23), (23, 24)]
    got = {r.node: r.component for r in graph.components(spark.createDataFrame(edges, "a long, b long"), "a", "b").collect()}
    assert got == {1: 1, 2: 1, 3: 1, 7: 7, 8: 7, 9: 7, 10: 7, **dict.fromkeys(range(20, 25), 20)}
    assert graph.components(spark.createDataFrame([], "a long, b long"), "a", "b").count() == 0


def test_samples_collide_as_often_as_weighted_jaccard():
    rng = np.random.default_rng(2)
    a = np.unique(rng.integers(0, 1 << 63, 400, dtype=np.uint64))
    b = np.unique(np.concatenate([a[:300], rng.integers(0, 1 << 63, 100, dtype=np.uint64)]))
    wa, wb = rng.uniform(1, 3, len(a)).astype(np.float32), np.empty(len(b), np.float32)
    weight = dict(zip(a.tolist(), wa.tolist()))
    wb[:] = [weight.get(x, 1.5) * (1 if k % 3 else 1.5) for k, x in enumerate(b.tolist())]
    want = dedup.weighted_jaccard((a, wa), (b, wb))
    sampler = dedup.Sampler(samples=3000)
    got = (sampler.samples(a, wa) == sampler.samples(b, wb)).mean()
    assert got == pytest.approx(want, abs=0.04)


def brute_classes(rows):
    """Classes by weighted Jaccard over all pairs of distinct texts."""
    texts = sorted({t for _, t in rows if t is not None})
    lists = list(dedup.document_shingles([t for _, t in rows]))
    df = np.zeros(dedup.DF_BUCKETS)
    for s in lists:
        df += np.bincount(np.unique(dedup.bucket(s)), minlength=dedup.DF_BUCKETS)
    n = len(rows)
    idf = (1 + dedup.IDF_SPAN * np.log((n + 1) / (df + 1)) / max(np.log(n + 1), 1)).astype(np.float32)
    sets = [dedup.weighted(s, idf) for s in dedup.document_shingles(texts)]
    parent = list(range(len(texts)))

    def root(k):
        while parent[k] != k:
            k = parent[k]
        return k

    for i in range(len(texts)):
        for j in range(i):
            if dedup.weighted_jaccard(sets[i], sets[j]) >= dedup.SIMILARITY:
                parent[root(i)] = root(j)
    place = {t: k for k, t in enumerate(texts)}
    return [("null", k) if t is None else root(place[t]) for k, (_, t) in enumerate(rows)]


def test_classes_against_brute_force(spark, monkeypatch):
    monkeypatch.setattr(dedup, "BLOCK_DOCS", 12)  # cut the large cluster into blocks
    rng = np.random.default_rng(3)
    vocab = [f"w{k}" for k in range(3000)]
    base = rng.choice(vocab, 120)
    rows, k = [], 0

    def add(text):
        nonlocal k
        rows.append((k, text))
        k += 1

    for _ in range(40):  # a crowd of near copies, each a few words off
        own = base.copy()
        at = rng.integers(0, 120, rng.integers(0, 7))
        own[at] = rng.choice(vocab, len(at))
        add(" ".join(own))
    for _ in range(40):
        add(" ".join(rng.choice(vocab, rng.integers(3, 90))))
    passage = " ".join(rng.choice(vocab, 30))
    for _ in range(20):
        add(" ".join(rng.choice(vocab, 40)) + " " + passage)
    add(rows[50][1]); add(rows[50][1].upper()); add(""); add(""); add("a b"); add("A  b!"); add("?!"); add("?!"); add("??")  # noqa: E702
    rows += [(None, rows[51][1]), (None, None), (None, None), (7, rows[7][1])]
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumn("_key", F.lit(1)).withColumn("node", F.lit(2))
    got = dedup.near_duplicate_classes(df).collect()
    want = brute_classes(rows)
    sizes, least = pd.Series([str(c) for c in want]).value_counts(), {}
    for (doc, _), c in zip(rows, want):
        if doc is not None:
            least[str(c)] = min(least.get(str(c), doc), doc)
    expected = sorted((str(d), str(least.get(str(c))), int(sizes[str(c)])) for (d, _), c in zip(rows, want))
    assert sorted((str(r.doc_id), str(r.class_id), r.class_size) for r in got) == expected
    kept = dedup.drop_near_duplicates(df)
    assert kept.columns == df.columns and kept.count() == len(sizes) == sum(r.keep for r in got)
    assert dedup.near_duplicate_classes(df.limit(0)).count() == 0 and dedup.drop_near_duplicates(df.limit(0)).count() == 0


def test_lattice_against_plain_forward():
    import sentencepiece
    path = langid.default_path()
    vocab = langid.vocabulary(path)
    model = sentencepiece.SentencePieceProcessor(model_file=path)
    pieces = {model.id_to_piece(i): i for i in range(model.get_piece_size())
              if not (model.is_byte(i) or model.is_control(i) or model.is_unknown(i) or model.is_unused(i))}
    assert vocab.longest == max(map(len, pieces)) > 12
    log_p = np.log(np.random.default_rng(0).dirichlet(np.ones(vocab.size), 3))
    words = ["hello", "ungeheuer", "ñandú", "日本", "x", "straße", "a🙂b", "relationship", "relationships" * 30]

    def plain(word):
        marked = langid.MARK + word
        alpha = [np.zeros(3)]
        for b in range(1, len(marked) + 1):
            ways = []
            for a in range(b):
                if marked[a:b] in pieces:
                    ways.append(alpha[a] + log_p[:, pieces[marked[a:b]]])
                elif b == a + 1:
                    ways.append(alpha[a] + log_p[:, vocab.bytes[list(marked[a].encode())]].sum(1))
            alpha.append(np.logaddexp.reduce(ways, 0))
        return alpha[-1]

    lattice = langid.Lattice(words, vocab)
    assert np.allclose(lattice.totals(log_p), [plain(w) for w in words])
    assert np.allclose(langid.word_totals(words, vocab, log_p), [plain(w) for w in words])
    for chunk in (1, 7, 2000):
        assert np.allclose([langid.long_total(w, vocab, log_p, chunk) for w in words], [plain(w) for w in words])
    endless = "relationship日" * 200
    assert len(endless) > langid.LONG and np.allclose(langid.word_totals(["a", endless], vocab, log_p)[1], plain(endless))
    use = lattice.expected(log_p)  # every character of a word is used once
    covered = np.zeros((len(words), 3))
    np.add.at(covered, lattice.arcs[:, 0], use * (lattice.arcs[:, 2] - lattice.arcs[:, 1])[:, None])
    assert np.allclose(covered, lattice.length[:, None])


def test_training_rows_are_the_first_by_hash(spark):
    """One language holds most rows; the model of a bounded sample equals that of exactly these rows."""
    rows = [(i, f"{'abcdefghijkl'[i % 12] * 3} {'xyz'[i % 3] * 4}", "big" if i % 7 else "small") for i in range(300)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    order = {r.doc_id: r.h for r in docs.select("doc_id", F.xxhash64("doc_id").alias("h")).collect()}
    first = {i for lang in ("big", "small") for i in sorted((r[0] for r in rows if r[2] == lang), key=order.get)[:40]}
    some = langid.fit_languages(docs, train_docs=40)
    same = langid.fit_languages(spark.createDataFrame([r for r in rows if r[0] in first], docs.schema), train_docs=1000)
    assert some.languages == same.languages == ["big", "small"] and np.allclose(some.log_p, same.log_p)


def test_language_held_out_and_edges(spark, edge):
    d = "/root/testdata/sf0.001"
    docs = read(spark, d, "documents", "doc_id", "lang")
    rows = langid.op5_langid(spark, d).join(docs, "doc_id").filter("held_out").toPandas()
    assert (rows["lang"] == rows["lang_pred"]).mean() > 0.97 and rows["score"].between(0, 1).all()
    model = langid.fit_languages(spark.createDataFrame([(1, "hello there world", "en"), (2, "guten tag welt", "de"), (3, "x", None), (4, None, "fr")],
                                                       "doc_id long, text string, lang string"))
    assert model.languages == ["de", "en"]
    got = [(r.doc_id, r.lang_pred) for r in langid.predict_languages(edge, model).collect()]
    assert len(got) == len(EDGE) and all((p == "und") == (i in (3, 1, 4)) for i, p in got)
    runs = spark.createDataFrame([(1, "hello" * 2000), (2, "welt" * 2000), (3, "hello" * 2000)], "doc_id long, text string")
    assert [r.lang_pred for r in langid.predict_languages(runs, model).orderBy("doc_id").collect()] == ["en", "de", "en"]
    none = langid.fit_languages(spark.createDataFrame([], "doc_id long, text string, lang string"))
    assert {r.lang_pred for r in langid.predict_languages(edge, none).collect()} == {"und"}


def test_chunked_viterbi_equals_whole(spark, monkeypatch):
    rng = np.random.default_rng(4)
    messages = [(c, t, ["user", "assistant", "system"][(t + c) % 2], "\n".join(["User: hi?", "Assistant: yes it is so", "plain line", ""][rng.integers(0, 4)]
                                                                                for _ in range(rng.integers(1, 4))))
                for c in range(6) for t in range(25)]
    messages += [(None, 1, "user", None), (None, 1, "user", None), (3, 5, "user", "again"), (4, None, None, "Q: who?")]
    df = spark.createDataFrame(messages, "id long, place long, role string, text string").withColumn("tie", F.lit("clash"))
    chain = chat.fit_chain(df)
    whole = chat.parse_transcripts(df, chain).collect()
    lines = sum(len((t or "").split("\n")) for *_, t in messages)
    assert len(whole) == lines
    monkeypatch.setattr(chat, "CHUNK", 7)
    key = lambda rows: sorted(tuple(map(str, r)) for r in rows)
    assert key(chat.parse_transcripts(df, chain).collect()) == key(whole)
    assert chat.parse_transcripts(df.limit(0), chain).count() == 0
    assert np.isfinite(chat.fit_chain(df.limit(0)).emit).all()


def test_roles_are_recovered_and_rendered(spark):
    d = "/root/testdata/sf0.001"
    rows = chat.op7_chat(spark, d)
    true = read(spark, d, "conversations", "conv_id", "turn", "role").withColumnRenamed("role", "said")
    got = rows.join(true, ["conv_id", "turn"]).filter("held_out").toPandas()
    assert (got["role"] == got["said"]).mean() > 0.8
    out = chat.rendered(spark.createDataFrame([("User: hi", "user", True, False), ("go on", "user", False, False), ("[AI] yes", "assistant", True, True)],
                                              "line string, role string, opens boolean, closes boolean")).collect()
    assert [r.text for r in out] == ["<|user|>\nhi", "go on", "<|end|>\n<|assistant|>\nyes"]


def test_labelled_samples_depend_on_the_rows_alone(spark):
    """Repeated ids give one row each, and any partitioning the same rows in the same order."""
    from tessera.llm.learning import labelled_sample
    rows = [(k % 5000, f"text {k % 7000}") for k in range(9000)] + [(3, None), (None, "no id")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    labels = spark.createDataFrame([(k, k % 2) for k in range(5000)] + [(7, 0), (8, None)], "doc_id long, toxic int")
    for count in (40, 400, 9000):
        got = [labelled_sample(docs.repartition(p), labels.repartition(p), "toxic", F.lit(True), count, 100).values.tolist()
               for p in (1, 7)]
        assert got[0] == got[1] and len(got[0]) == min(count, 5001)


@pytest.mark.parametrize("fit, target", [(toxicity.fit_toxicity, "toxic"), (quality.fit_quality, "quality")])
def test_scores_do_not_depend_on_the_partitioning(spark, fit, target):
    docs = read(spark, "/root/testdata/sf0.01", "documents", "doc_id", "text")
    labels = read(spark, "/root/testdata/sf0.01", "labels", "doc_id", target)
    texts = [r.text for r in docs.limit(50).collect()]
    score = (lambda m: m.document_scores(texts)) if target == "toxic" else (lambda m: m.scores(texts))
    got = [score(fit(docs.repartition(p), labels.repartition(p))) for p in (1, 7)]
    assert np.allclose(got[0], got[1], atol=1e-6)


def test_few_words_stay_near_the_labelled_share():
    model = quality.BagModel()
    model.prior = 0.8
    model.p["out_b"][:] = -4  # all texts look bad
    short, long = model.scores(["", "Too short."]), model.scores(["Too short. " * 50])
    assert short[0] == pytest.approx(0.8) and 0.3 < short[1] < 0.8 and long[0] < 0.05
