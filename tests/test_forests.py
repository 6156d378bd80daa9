"""Forests on coded rows against Spark's trees."""

import numpy as np
import pytest
from pyspark.ml.classification import DecisionTreeClassifier
from pyspark.ml.evaluation import BinaryClassificationEvaluator

from tessera.operators import boost as B
from tessera.operators import explain as H
from tessera.operators import forests as R
from tessera.operators import train as M
from test_boost import frame


class Every:
    """Random numbers that draw every row once."""

    def poisson(self, number):
        return number

    def random(self, shape, kind):
        return np.zeros(shape, kind)


def test_a_tree_is_that_of_spark(spark):
    rows = frame(spark, 800)
    clf = DecisionTreeClassifier(maxDepth=5, minInstancesPerNode=3, seed=42)
    plain = clf.fit(rows)
    coding = B.learned_coding(rows, 800, 32, 42, set(B.binary_slots(rows)))
    (made, wrong), = B.packed(rows, coding, 42, 1).collect()
    tree = R.grown(made.codes, made.y > 0, np.ones(800), coding, B.Rules(5, 3, 0.0), 8, 1.0, Every())
    own = R.node_batch(tree, coding, 0).to_pandas()["nodeData"]
    path = H.new_scratch_path(spark, "tree")
    plain.write().save(path)
    theirs = spark.read.parquet(f"{path}/data").orderBy("id").collect()
    twice = spark.sparkContext.parallelize([(made, wrong), (made, wrong), (None, wrong)], 3)
    held = [x for _, x in R.distinct(twice, coding, 4).collect()]
    codes, y, n = (np.concatenate([x[k] for x in held], -1) for k in range(3))
    assert n.sum() == 1600 and len(n) == len(set(map(bytes, np.vstack([codes, y]).T))) < 800
    again = R.node_batch(R.grown(codes, y, n / 2, coding, B.Rules(5, 3, 0.0), 8, 1.0, Every()), coding, 0)
    assert again.to_pandas()["nodeData"].map(str).tolist() == own.map(str).tolist()  # rows of equal codes as one
    assert not wrong and len(own) == len(theirs) == plain.numNodes
    for a, b in zip(own, theirs):
        split = b["split"]
        assert (a["id"], a["leftChild"], a["rightChild"], a["prediction"], a["rawCount"]) == (b["id"], b["leftChild"], b["rightChild"], b["prediction"], b["rawCount"])
        assert list(a["impurityStats"]) == list(b["impurityStats"]) and a["impurity"] == pytest.approx(b["impurity"]) and a["gain"] == pytest.approx(b["gain"])
        assert (a["split"]["featureIndex"], a["split"]["numCategories"]) == (split["featureIndex"], split["numCategories"])
        assert list(a["split"]["leftCategoriesOrThreshold"]) == list(split["leftCategoriesOrThreshold"])


def test_forest_is_like_sparks_and_needs_few_jobs(spark, monkeypatch):
    """A level of the trees was a job of every part of a forest."""
    rows = frame(spark, 1500)
    train, test = rows.randomSplit([0.7, 0.3], 1)
    clf = M.forest(num_trees=24, max_depth=7)
    plain = clf.fit(train)
    monkeypatch.setattr(R, "LEAST_ROWS", 100)
    tracker, group = spark.sparkContext.statusTracker(), "forest"
    spark.sparkContext.setJobGroup(group, "", False)
    try:
        own = M.fit_classifier(clf, train)
        assert len(tracker.getJobIdsForGroup(group)) < 30
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    again = M.fit_classifier(clf, train.repartition(3))
    area = BinaryClassificationEvaluator().evaluate
    assert abs(area(own.transform(test)) - area(plain.transform(test))) < 0.03
    assert np.abs(own.featureImportances.toArray() - plain.featureImportances.toArray()).max() < 0.08
    assert 0.8 < own.totalNumNodes / plain.totalNumNodes < 1.25
    assert (own.getNumTrees, own.numFeatures, own.numClasses, own.getMaxDepth(), len(own.trees)) == (24, 8, 2, 7, 24)
    assert max(t.depth for t in own.trees) <= 7 and len({t.toDebugString.split("\n", 1)[1] for t in own.trees}) == 24
    assert again.getNumTrees == 24
    trees, weights = H.tree_tables(spark, own)
    assert len(trees) == 24 and sum(weights) == pytest.approx(1)
    for t in trees.values():
        leaves = t["left"] < 0
        assert t["cover"][leaves].min() >= 3 and t["cover"][leaves].sum() == t["cover"][0]


def test_rows_beyond_a_task_and_odd_labels_are_sparks(spark, monkeypatch):
    rows = frame(spark, 300)
    clf = M.forest(num_trees=3, max_depth=3)
    monkeypatch.setattr(R, "LEAST_ROWS", 100)
    assert R.supported(clf, rows) and not R.supported(clf, rows.filter("label = 1"))
    monkeypatch.setattr(R, "ROWS_IN_A_TASK", 20)
    assert R.fit(clf, rows) is None and M.fit_classifier(clf, rows).getNumTrees == 3
