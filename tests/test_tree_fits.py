"""Tree fits on rows in few partitions; forests grown in parts; predictions over all cores."""

from pyspark.ml import PipelineModel
from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.linalg import Vectors
from pyspark.sql import functions as F

from tessera.operators import train as M


def _rows(spark, n, partitions):
    rows = [(float(i % 3 == 0), Vectors.dense(float(i % 3), float(i % 7))) for i in range(n)]
    return spark.createDataFrame(rows, ["label", "features"]).repartition(partitions)


def test_partitions_follow_rows(spark, monkeypatch):
    rows = _rows(spark, 120, 6)
    assert M.sized(rows, 120).rdd.getNumPartitions() == 1
    monkeypatch.setattr(M, "ROWS_A_PARTITION", 10)
    more = M.sized(rows, 120)
    assert more.rdd.getNumPartitions() == 12 and more.count() == 120
    few = M.spread(rows.coalesce(1))
    assert few.rdd.getNumPartitions() == spark.sparkContext.defaultParallelism and few.count() == 120


def test_many_rows_come_in_even_waves(spark, monkeypatch):
    """One partition more than the cores made a second wave of tasks, and their number followed the rows."""
    monkeypatch.setattr(M, "ROWS_A_PARTITION", 10)
    monkeypatch.setattr(M, "MOST_A_PARTITION", 50)
    cores = spark.sparkContext.defaultParallelism
    for n, parts in ((10 * cores, cores), (10 * cores + 1, cores), (50 * cores, cores), (50 * cores + 1, 2 * cores)):
        got = M.in_waves(_rows(spark, n, 3), n)
        sizes = got.rdd.glom().map(len).collect()
        assert len(sizes) == parts and sum(sizes) == n
        assert n <= 10 * cores or max(sizes) <= 2 * n / parts
    few = spark.range(20).select(F.col("id").alias("subject_id"), (F.col("id") % 2).cast("int").alias("label"), F.lit(1.0).alias("x"),
                                 F.lit("a").alias("c"))
    prep = M.preprocessor(["x"], ["c"]).fit(few)
    rows, n = M.assembled(prep, few)
    assert (rows.rdd.getNumPartitions(), n) == (2, 20)
    many = spark.range(10 * cores + 1).select(F.col("id").alias("subject_id"), F.lit(1).alias("label"), F.lit(1.0).alias("x"), F.lit("a").alias("c"))
    rows, n = M.assembled(prep, many)
    assert (rows.rdd.getNumPartitions(), n) == (cores, 10 * cores + 1)


def test_trees_are_fitted_on_sized_rows(spark, monkeypatch):
    seen, own = [], M.fit_classifier
    monkeypatch.setattr(M, "fit_classifier", lambda clf, rows: seen.append(rows.rdd.getNumPartitions()) or own(clf, rows))
    df = spark.range(90).select(F.col("id").alias("subject_id"), (F.col("id") % 2).cast("int").alias("label"),
                                (F.col("id") % 2 + F.col("id") % 5).cast("double").alias("x"), (F.col("id") % 3).cast("string").alias("c"))
    for clf in (M.forest(num_trees=17, max_depth=3), M.boosted(max_iter=2, max_depth=2)):
        model = M.fit(df.repartition(8), ["x"], ["c"], clf)
        assert M.predict(model, df, ["subject_id"]).count() == 90
    assert seen == [1, 1]


def test_forest_in_parts_is_whole(spark, tmp_path):
    rows = _rows(spark, 300, 2).withColumn("label", F.when(F.rand(5) < 0.3, 1 - F.col("label")).otherwise(F.col("label"))).localCheckpoint()
    model = M.fit_classifier(M.forest(num_trees=20, max_depth=4, min_leaf=1), rows)
    assert len(model.trees) == model.getNumTrees == 20 and model.numFeatures == 2 and model.numClasses == 2
    assert len({t.toDebugString.split("\n", 1)[1] for t in model.trees}) > 1  # parts are not copies of each other
    assert (model.getMaxDepth(), model.getOrDefault("seed"), model.getOrDefault("numTrees")) == (4, 42, 20)
    assert abs(sum(model.featureImportances.toArray()) - 1) < 1e-9
    path = str(tmp_path / "forest")
    PipelineModel(stages=[model]).write().save(path)
    scores = [[r["probability"] for r in m.transform(rows.orderBy("label", "features")).collect()] for m in (model, PipelineModel.load(path))]
    assert scores[0] == scores[1]
    assert model.transform(rows).filter("prediction = label").count() > 150
    again = M.fit_classifier(M.forest(num_trees=20, max_depth=4, min_leaf=1), rows)
    assert again.toDebugString.split("\n", 1)[1] == model.toDebugString.split("\n", 1)[1]
    plain = M.fit_classifier(RandomForestClassifier(numTrees=3, seed=1), rows)  # too few for parts
    assert plain.getNumTrees == 3
