"""Boosted trees on binned rows against Spark's own fit."""

import numpy as np
import pytest
from pyspark.ml.linalg import Vectors
from pyspark.sql import functions as F

from tessera.operators import boost as B
from tessera.operators import train as M


def frame(spark, n, seed=3):
    """Assembled rows of numbers, gaps and two one-hot columns."""
    rng = np.random.default_rng(seed)
    x, z, a, b = rng.normal(size=n), rng.integers(0, 5, n), rng.integers(0, 4, n), rng.integers(0, 2, n)
    y = (x + (a == 2) + 0.4 * z * b + rng.normal(size=n) > 1).astype(int)
    df = spark.createDataFrame([(int(i), int(y[i]), None if i % 11 == 0 else float(x[i]), int(z[i]), "pqrs"[a[i]], "uv"[b[i]]) for i in range(n)],
                               "subject_id long, label int, x double, z int, a string, b string")
    prep = M.preprocessor(["x", "z"], ["a", "b"]).fit(df)
    return prep.transform(df).select(F.col("label").cast("double").alias("label"), "features").coalesce(1).localCheckpoint()


def shape(model):
    """Trees as (split feature and threshold or leaf value), one-hot splits without their side."""
    out = []
    for line in model.toDebugString.split("\n")[1:]:
        if "Predict" in line:
            out.append(round(float(line.split(":")[1]), 9))
        elif "If" in line and "Else" not in line and "<=" in line:
            out.append(line.strip())
    return out


@pytest.mark.parametrize("share", [0.8, 1.0])
def test_trees_are_those_of_spark(spark, share):
    rows = frame(spark, 700)
    clf = M.boosted(max_iter=6, step=0.1, max_depth=3, subsample=share)
    own, plain = M.fit_classifier(clf, rows, few=True), clf.fit(rows)
    assert shape(own) == shape(plain)
    assert np.allclose(own.evaluateEachIteration(rows), plain.evaluateEachIteration(rows), atol=1e-12)
    assert np.allclose(own.featureImportances.toArray(), plain.featureImportances.toArray(), atol=1e-9)
    assert (own.getMaxIter(), own.getStepSize(), own.getSubsamplingRate(), own.getNumTrees, own.numFeatures) == (6, 0.1, share, 6, 8)
    assert own.treeWeights == plain.treeWeights and M.leading_trees(own, 4).getNumTrees == 4


def test_boosting_needs_no_job_a_round(spark):
    """Each level of each tree was a Spark job: 40 rounds were some 200."""
    rows = frame(spark, 300)
    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("boosting", "", False)
    try:
        M.fit_classifier(M.boosted(max_iter=40, max_depth=3), rows, few=True)
        assert len(tracker.getJobIdsForGroup("boosting")) < 30
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)


def test_parts_give_the_trees_of_one_task(spark, monkeypatch):
    rows = frame(spark, 600)
    clf = M.boosted(max_iter=5, step=0.1, max_depth=3, subsample=1.0, checkpoint_interval=2)
    whole = B.fit(clf, rows)
    monkeypatch.setattr(B, "ROWS_IN_A_TASK", 100)
    parts = B.fit(clf, rows.repartition(5))
    assert np.allclose(whole.evaluateEachIteration(rows), parts.evaluateEachIteration(rows), atol=1e-9)
    half = B.fit(M.boosted(max_iter=5, step=0.1, max_depth=3, subsample=0.5), rows.repartition(5))
    assert half.getNumTrees == 5 and half.evaluateEachIteration(rows)[-1] < 1.3


def test_random_numbers_are_those_of_spark(spark):
    rng = spark.sparkContext._jvm.org.apache.spark.util.random.XORShiftRandom(0)
    for seed in (0, 42, -7):
        rng.setSeed(seed)
        assert B.uniforms(seed, 300).tolist() == [rng.nextDouble() for _ in range(300)]


def test_odd_rows(spark):
    one = spark.createDataFrame([(float(i % 2), Vectors.dense(1.0, 2.0)) for i in range(20)], ["label", "features"])
    clf = M.boosted(max_iter=3, max_depth=2, subsample=1.0)
    assert B.fit(clf, one).evaluateEachIteration(one) == pytest.approx(clf.fit(one).evaluateEachIteration(one))
    bad = spark.createDataFrame([(float(i % 3), Vectors.dense(float(i))) for i in range(20)], ["label", "features"])
    with pytest.raises(Exception):
        B.fit(clf, bad)


def test_slots_that_are_set_together_are_split_alone(spark, monkeypatch):
    """Slots that exclude each other in the sample share a unit; where other rows set both, each is a unit of its own."""
    rows = frame(spark, 400)
    meta = rows.schema["features"].metadata
    both = spark.createDataFrame([(1.0, Vectors.dense(0, 0, 1, 1, 0, 0, 1, 0))] * 5, ["label", "features"])
    both = rows.union(both.select("label", F.col("features").alias("features", metadata=meta))).select("label", F.col("features").alias("features", metadata=meta))
    own = B.learned_coding
    monkeypatch.setattr(B, "learned_coding", lambda _rows, n, *a: own(rows, 400, *a))
    clf = M.boosted(max_iter=3, max_depth=3, subsample=1.0)
    got = B.fit(clf, both.coalesce(1))
    monkeypatch.setattr(B, "learned_coding", lambda _rows, n, bins, seed, binary, grouped: own(rows, 400, bins, seed, binary, False))
    assert shape(got) == shape(B.fit(clf, both.coalesce(1)))
