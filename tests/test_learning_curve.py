"""Learning curves of logistic models: the joint fit of all prefixes is that of Spark's separate fits."""

import numpy as np
import pytest
from pyspark.ml.feature import StringIndexerModel
from pyspark.sql import functions as F

from tessera.operators import curve as C
from tessera.operators import evaluate as V
from tessera.operators import split as T
from tessera.operators import train as M
from tessera.session import new_scratch_path

NUM, CAT = ["a", "b", "whole", "same"], ["c", "code"]
TIGHT = dict(max_iter=500, tol=1e-11)


@pytest.fixture(scope="module")
def placed(spark):
    g = np.random.default_rng(3)
    rows = []
    for i in range(420):
        a, b = float(g.normal()), float(np.exp(g.normal()) * 1000)
        y = int(a + 0.001 * b + 0.8 * (i % 4) + 2 * g.normal() > 3)
        rows.append((i // 2 if i < 6 else i, y, None if i % 6 == 0 else float("nan") if i % 35 == 1 else a, None if i % 11 == 0 else b, i % 5,
                     None if i % 9 == 0 else "rare" if i == 7 else "wxyz"[i % 4], None if i % 13 == 0 else i % 3))
    df = spark.createDataFrame(rows, "subject_id long, label int, a double, b double, whole int, c string, code int")
    df = df.withColumn("same", F.when(F.col("subject_id") % 3 != 0, 2.0))
    path = new_scratch_path(spark, "placed")
    T.fold_places(T.stratified_folds(df, k=2), 2).write.parquet(path)
    return spark.read.parquet(path)


def test_joint_fit_is_that_of_separate_fits(placed):
    k, steps = 2, 3
    n = placed.filter("fold <> 0").count()
    make = lambda m: M.logistic(m, **TIGHT)
    scores, parts, w = C.joint_scores(placed, NUM, CAT, make, k, steps, n)
    got = {(r["fold"], r["step"], r["part"]): r["f1_macro"] for r in scores.collect()}
    every = sorted(r[0] for r in placed.select("c").distinct().collect() if r[0]), ["0", "1", "2"]
    for f in range(k):
        for s in range(1, steps + 1):
            within = (F.col("fold") != f) & (F.col(f"place_{f}") <= s * n // steps)
            sub = placed.filter(within)
            model = M.fit(sub, NUM, CAT, make(sub.count()))
            labels = next(x for x in model.stages if isinstance(x, StringIndexerModel)).labelsArray
            own = [np.array([v in seen for v in vs]) for vs, seen in zip(every, labels)]
            own = np.r_[np.full(1 + len(NUM), True), np.concatenate(own)]
            want = np.r_[model.stages[-1].intercept, model.stages[-1].coefficients.toArray()]
            assert np.allclose(w[f, s][own], want, atol=2e-4) and not np.abs(w[f, s][~own]).any()
            assert (parts[f, s].n, parts[f, s].n_pos) == (sub.count(), sub.filter("label = 1").count())
            for part, rows in (("train", sub), ("valid", placed.filter(F.col("fold") == f))):
                out = model.transform(rows).select(F.lit(1).alias("m"), "label", F.col("prediction").cast("int").alias("pred"))
                assert V.binary_metrics(out, ["m"]).first()["f1_macro"] == got[f, s, part]


def test_curve_of_logistic_models_makes_no_fit_a_prefix(placed, monkeypatch):
    """The query took a preprocessing, a fit and a scoring job for each of 50 prefixes."""
    def fit(*_):
        raise AssertionError("fitted one by one")
    passes, own = [], C.loss_sums
    monkeypatch.setattr(M, "fit", fit)
    monkeypatch.setattr(C, "loss_sums", lambda *a, **b: passes.append(len(a[1])) or own(*a, **b))
    rows = M.learning_curve(placed, NUM, CAT, lambda m: M.logistic(m), 2, steps=6).orderBy("step").collect()
    n = placed.filter("fold <> 0").count()
    assert [(r.step, r.train_size) for r in rows] == [(s, s * n // 6) for s in range(1, 7)]
    assert all(0 < r.train_f1_macro <= 1 and 0 < r.cv_f1_macro <= 1 for r in rows)
    assert len(passes) <= 30 and max(passes) == 12


def test_other_classifiers_and_wide_features_are_fitted_one_by_one(placed, monkeypatch):
    n = placed.filter("fold <> 0").count()
    assert C.joint_scores(placed, NUM, CAT, lambda _: M.forest(num_trees=2), 2, 1, n) is None
    assert C.joint_scores(placed, NUM, CAT, lambda m: M.logistic(m).setThreshold(0.3), 2, 1, n) is None
    assert C.joint_scores(placed.withColumn("label", F.col("label") + 1), NUM, CAT, M.logistic, 2, 1, n) is None
    monkeypatch.setattr(C, "MOST_CATEGORIES", 6)
    assert C.joint_scores(placed, NUM, CAT, M.logistic, 2, 1, n) is None
    row = M.learning_curve(placed, NUM, CAT, lambda m: M.logistic(m, max_iter=3), 2, steps=1).first()
    assert row.train_size == n and 0 < row.cv_f1_macro <= 1


def test_parts_of_one_class_predict_it(spark, placed):
    ones = placed.withColumn("label", F.when(F.col("fold") == 0, F.col("label")).otherwise(1))
    scores, parts, _ = C.joint_scores(ones, NUM, CAT, M.logistic, 2, 1, ones.filter("fold <> 0").count())
    got = {(r["fold"], r["part"]): r for r in scores.collect()}
    assert parts[0, 1].n == parts[0, 1].n_pos and got[0, "train"]["accuracy"] == 1.0
    assert got[0, "valid"]["accuracy"] == ones.filter("fold = 0 AND label = 1").count() / ones.filter("fold = 0").count()


def test_newton_halves_steps_and_ends_at_the_minimum():
    g = np.random.default_rng(1)
    x = np.c_[np.ones(200), g.normal(size=(200, 3))]
    y = (x @ [0.5, 4.0, -3.0, 0.0] + g.normal(size=200) > 0).astype(float)
    part = C.Part(0, 1, 200, int(y.sum()), 1e-3, 1e-6, 100, np.eye(4))

    def evaluate(ws, hess):
        out = {}
        for key, w in ws.items():
            m = x @ w
            p = 0.5 * (1 + np.tanh(0.5 * m))
            out[key] = (np.logaddexp(0, m).sum() - y @ m, x.T @ (p - y), x.T @ (x * (p * (1 - p))[:, None]) if key in hess else None)
        return out

    for start, shared in ((np.zeros(4), None), (np.array([3.0, -9.0, 9.0, 5.0]), None), (np.zeros(4), {(0, 1): np.eye(4) * 1e-3})):
        w = C.newton(evaluate, {(0, 1): part}, {(0, 1): start}, shared)[0, 1]
        grad = evaluate({0: w}, set())[0][1] / 200 + part.reg * np.r_[0, w[1:]]
        assert np.abs(grad).max() < 1e-5
