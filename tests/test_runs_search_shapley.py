"""Run log and registry under failures and races, the parameter search, Shapley values, learning-curve prefixes."""

import itertools
import math
from concurrent.futures import ThreadPoolExecutor

import numpy as np
import pytest
from pyspark.sql import functions as F

from tessera.functions.features import feature_frame
from tessera.operators import explain as H
from tessera.operators import prep as I
from tessera.operators import registry as R
from tessera.operators import search as G
from tessera.operators import split as T
from tessera.operators import train as M
from tessera.session import names_in, new_scratch_path, put_new
from tessera.sources import fixtures
from tessera.sources.runlog import LOG_TABLES, RunLog
from tessera.spec import PRESET_A

NUM, CAT = list(PRESET_A.numeric), list(PRESET_A.categorical)
SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def frames(spark):
    path = new_scratch_path(spark, "test-folds")
    fs = feature_frame(fixtures.subjects(spark, SF), PRESET_A)
    T.stratified_folds(fs, k=3).write.parquet(path)
    split = T.stratified_split(fs)
    return spark.read.parquet(path), split.filter("split = 'test'")


def test_a_failed_or_killed_writer_leaves_no_run(spark):
    log = RunLog(spark, new_scratch_path(spark, "log"))
    assert all(log.read(t).count() == 0 for t in LOG_TABLES)
    with pytest.raises(ValueError):
        with log.run("broken") as run:
            run.params(a=1)
            raise ValueError
    # killed between the rows and the commit: the rows are there, and unread
    spark.createDataFrame([("x", "half", "e", None, 1)], LOG_TABLES["runs"]).write.parquet(f"{log.root}/data/0-x/runs")
    with log.run("whole", "e") as run:
        run.params(a=1, b="two")
        with run.timed():
            pass
        run.metrics(roc_auc=0.5)
        with log.run("child", "e", parent=run.run_id) as child:
            child.metrics(roc_auc=0.75)
    assert {r.run_name for r in log.read("runs").collect()} == {"whole", "child"}
    assert {(r.key, r.value) for r in log.read("run_params").collect()} == {("a", "1"), ("b", "two")}
    assert {r.metric for r in log.read("run_metrics").collect()} == {"roc_auc", "train_time_s"}
    assert log.read("run_artifacts").count() == 0


def test_a_file_is_put_once(spark):
    path = new_scratch_path(spark, "put") + "/one"
    with ThreadPoolExecutor(8) as pool:
        won = list(pool.map(lambda k: put_new(spark, path, str(k)), range(8)))
    assert sum(won) == 1 and names_in(spark, path.rsplit("/", 1)[0]) == ["one"]


def test_concurrent_promotions_follow_each_other(spark):
    root = new_scratch_path(spark, "registry")
    with ThreadPoolExecutor(6) as pool:
        versions = list(pool.map(lambda k: R.Registry(spark, root).promote(f"run{k}"), range(6)))
    number, table = R.Registry(spark, root).read()
    rows = table.orderBy("version").collect()
    assert sorted(versions) == [1, 2, 3, 4, 5, 6] == [r.version for r in rows] and number == 6
    assert [r.stage for r in rows] == ["Archived"] * 5 + ["Production"]
    assert rows[-1].run_id == f"run{versions.index(6)}"


def test_serving_falls_back_to_the_best_run(spark, frames):
    train, test = frames
    log = RunLog(spark, new_scratch_path(spark, "log"))
    with pytest.raises(LookupError):
        R.load_production(spark.createDataFrame([], R.Registry.SCHEMA), log)
    model = M.fit(train, NUM, CAT, M.logistic(100, max_iter=3))
    with log.run("one") as run:
        run.metrics(roc_auc=0.6)
        run.save(model, "baseline_model")
    with log.run("two") as other:
        other.metrics(roc_auc=0.7)
    with pytest.raises(LookupError, match="no model"):
        R.load_production(spark.createDataFrame([], R.Registry.SCHEMA), log)
    registry = R.Registry(spark, new_scratch_path(spark, "registry"))
    registry.promote(run.run_id)
    loaded, found = R.load_production(registry.read()[1], log)
    assert found["source"] == "registry" and loaded.transform(test).count() == test.count()


def test_search_refits_the_best_and_goes_on_after_a_stop(spark, frames, monkeypatch):
    folds, test = frames
    log = RunLog(spark, new_scratch_path(spark, "log"))
    cands = [G.Candidate(f"n{n}_d{d}", {"n": n, "d": d}, lambda _r, n=n, d=d: M.boosted(n, 0.3, d, 1.0), rounds=n, shares=d)
             for n in (1, 3) for d in (1, 2)]
    search = G.ParamSearch(cands, NUM, CAT, log, "s", k=3, holdout=test, parallelism=2)
    fits, own = [], G.ParamSearch._fit_one

    def stops(self, some, fold, have):
        if len(fits) == 4:
            raise KeyError("stopped")
        fits.append(1)
        own(self, some, fold, have)

    monkeypatch.setattr(G.ParamSearch, "_fit_one", stops)
    with pytest.raises(KeyError):
        search.fit(folds)
    kept = search.results().count()
    assert 0 < kept < 12
    monkeypatch.setattr(G.ParamSearch, "_fit_one", lambda *a: fits.append(2) or own(*a))
    model = search.fit(folds)
    assert fits.count(2) * 2 + kept == 12  # two candidates share a fit; none is made again
    rows = {r.candidate: r for r in model.results.collect()}
    assert len(rows) == 4 and all(r.n_folds == 3 and r.n_scored == folds.count() for r in rows.values())
    assert rows[model.candidate]["rank"] == 1 == min(r["rank"] for r in rows.values())
    # each score is that of a fit of its own
    fold = G.written_folds(folds, NUM, CAT, 3)[1]
    alone = next(c for c in cands if c.name == "n1_d2").make(0).fit(fold.train).transform(fold.valid)
    logged = search.results().filter("run_name = 'n1_d2' AND fold = 1").first()
    assert logged.f1_macro == G.MacroF1().evaluate(alone) and logged.roc_auc == pytest.approx(G.metrics_of(alone)["roc_auc"])
    assert logged.train_time_s is None  # measured for the longer fit only
    metrics = {r.metric for r in log.read("run_metrics").filter("run_id = 's'").collect()}
    assert {f"val_{m}" for m in G.METRICS} <= metrics and "best_cv_f1_macro" in metrics
    path = new_scratch_path(spark, "search-model")
    model.write().save(path)
    again = G.SearchModel.read().load(path)
    assert again.candidate == model.candidate and again.results.count() == 4
    probability = lambda m: [r.probability for r in m.transform(test).orderBy("subject_id").collect()]
    assert probability(again) == probability(model)


def plain_shapley(x, t):
    """By all subsets of features; an unknown feature sends the row down both branches by their covers."""
    used = sorted(set(t["feat"][t["left"] >= 0].tolist()))

    def value(node, known):
        if t["left"][node] < 0:
            return t["pred"][node]
        a, b = t["left"][node], t["right"][node]
        f = t["feat"][node]
        if f in known:
            left = x[f] in t["cats"][node] if t["is_cat"][node] else x[f] <= t["thr"][node]
            return value(a if left else b, known)
        return (t["cover"][a] * value(a, known) + t["cover"][b] * value(b, known)) / (t["cover"][a] + t["cover"][b])

    out, m = np.zeros(len(x)), len(used)
    worth = {k: value(0, set(k)) for n in range(m + 1) for k in itertools.combinations(used, n)}
    for k, v in worth.items():
        for f in set(used) - set(k):
            weight = math.factorial(len(k)) * math.factorial(m - 1 - len(k)) / math.factorial(m)
            out[f] += weight * (worth[tuple(sorted({*k, f}))] - v)
    return out, worth[()], m


@pytest.mark.parametrize("forest", [False, True])
def test_tree_shapley_values_equal_enumeration(spark, frames, forest):
    folds, test = frames
    clf = M.forest(3, 3, 3) if forest else M.boosted(3, 0.5, 3, 0.8)
    model = M.fit(folds, NUM, CAT, clf)
    prep = model.stages[:-1]
    from pyspark.ml import PipelineModel
    prep = PipelineModel(stages=prep)
    vectors = prep.transform(test.orderBy("subject_id").limit(12))
    names = I.encoded_names(prep, NUM, CAT)
    trees, weights = H.tree_tables(spark, model.stages[-1])
    X = np.array([r.features.toArray() for r in vectors.orderBy("subject_id").collect()])
    want, base, most = np.zeros(X.shape), 0.0, 0
    for (_, t), w in zip(sorted(trees.items()), weights):
        for k, x in enumerate(X):
            phi, empty, used = plain_shapley(x, t)
            want[k] += w * phi
            most = max(most, used)
        base += w * empty
    assert most >= 3
    got = H.tree_attributions(vectors, "subject_id", "features", model.stages[-1], names).toPandas()
    wide = got.pivot(index="subject_id", columns="feature", values="attribution")[names].to_numpy()
    assert np.allclose(wide, want, atol=1e-12) and np.allclose(got["base"], base)
    values = got.pivot(index="subject_id", columns="feature", values="value")[names].to_numpy()
    assert np.array_equal(values, X)
    scored = M.predict(model, test.orderBy("subject_id").limit(12), ["subject_id"]).orderBy("subject_id").toPandas()
    margin = got.groupby("subject_id")["margin"].first().to_numpy()
    assert np.allclose(margin if forest else 1 / (1 + np.exp(-2 * margin)), scored["score"])
    assert np.allclose(wide.sum(1) + base, margin)


def test_curve_prefixes_are_those_of_the_order(spark):
    rows = [(k, int(k % 7 == 0)) for k in range(230)]
    folds = T.stratified_folds(spark.createDataFrame(rows, "subject_id long, label int"), k=3)
    order = folds.withColumn("h", T.order_hash("subject_id", 42)).orderBy("h", "subject_id").collect()
    n = sum(r.fold != 0 for r in order)
    want = {}
    for f in range(3):
        own = [r.label for r in order if r.fold != f]
        want |= {(f, s): (len(own[: s * n // 7]), sum(own[: s * n // 7])) for s in range(1, 8)}
    got = {(r.fold, r.step): (r.n_rows, r.n_pos) for r in T.learning_curve_sizes(folds, k=3, steps=7).collect()}
    assert got == want


def test_learning_curve_fits_each_prefix(spark, frames):
    path = new_scratch_path(spark, "placed")
    T.fold_places(frames[0], 3).write.parquet(path)
    placed = spark.read.parquet(path)
    rows = M.learning_curve(placed, NUM, CAT, lambda n: M.logistic(n, max_iter=5), 3, steps=2, parallelism=4).orderBy("step").collect()
    n = placed.filter("fold <> 0").count()
    assert [(r.step, r.train_size) for r in rows] == [(1, n // 2), (2, n)]
    assert all(0 <= r.train_f1_macro <= 1 and 0 <= r.cv_f1_macro <= 1 for r in rows)
