"""Model training around Spark ML: the three families, learning curves, staged loss and importances.

Training itself is Spark ML (distributed tree/gradient aggregation). What is added here is the parameter mapping from the
modelled project's conventions; the search over parameters and folds is in :mod:`tessera.operators.search`.
"""

from __future__ import annotations

import math
from concurrent.futures import ThreadPoolExecutor
from functools import partial

from pyspark import SparkContext
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import (
    GBTClassifier,
    LogisticRegression,
    RandomForestClassificationModel,
    RandomForestClassifier,
)
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.operators import boost, curve, forests
from tessera.operators import evaluate as V
from tessera.operators.prep import encoded_names, preprocessor
from tessera.session import new_scratch_path, scratch_dir

ROWS_A_PARTITION = 50_000
MOST_A_PARTITION = 250_000
FOREST_PARTS = 8


# Classifier factories with the modelled project's parameter meaning -------------------

def logistic(n_train: int, C: float = 1.0, max_iter: int = 1000, tol: float = 1e-4) -> LogisticRegression:
    """L2 logistic regression. The modelled objective is 1/2|w|^2 + C * sum(loss); Spark
    minimises mean(loss) + lambda/2 |w|^2, so lambda = 1 / (C * n_train)."""
    return LogisticRegression(regParam=1.0 / (C * max(1, n_train)), elasticNetParam=0.0, standardization=False,
                              maxIter=max_iter, tol=tol, featuresCol="features", labelCol="label")


def forest(num_trees: int = 200, max_depth: int = 15, min_leaf: int = 3, seed: int = 42) -> RandomForestClassifier:
    """Nodes are kept beside the rows, so a pass needs no trees sent to it, and a pass grows as many nodes as fit."""
    return RandomForestClassifier(numTrees=num_trees, maxDepth=max_depth, minInstancesPerNode=min_leaf, seed=seed,
                                  cacheNodeIds=True, checkpointInterval=10, maxMemoryInMB=1500, featuresCol="features", labelCol="label")


def boosted(max_iter: int = 300, step: float = 0.05, max_depth: int = 4, subsample: float = 0.8,
            seed: int = 42, checkpoint_interval: int = 10) -> GBTClassifier:
    """Gradient-boosted trees; long runs cut lineage every ``checkpoint_interval`` rounds
    into the session's shared checkpoint folder."""
    return GBTClassifier(maxIter=max_iter, stepSize=step, maxDepth=max_depth, subsamplingRate=subsample, seed=seed,
                         checkpointInterval=checkpoint_interval, featuresCol="features", labelCol="label")


# Parameters of the modelled project
PRESETS = {
    "logistic": dict(C=1.0, max_iter=1000),
    "forest": dict(num_trees=200, max_depth=15, min_leaf=3),
    "boosted": dict(max_iter=300, step=0.05, max_depth=4, subsample=0.8),
    "boosted_tuned": dict(max_iter=200, step=0.1, max_depth=3, subsample=0.8),
    # dashboard variants: 100-tree forest and 100-round boosted trees
    "forest_dashboard": dict(num_trees=100, max_depth=15, min_leaf=3),
    "boosted_dashboard": dict(max_iter=100, step=0.1, max_depth=3, subsample=1.0),
}


GRID_ROUNDS, GRID_RATES, GRID_DEPTHS = (200, 300), (0.05, 0.10), (3, 4)


def training_rows(train: DataFrame) -> int:
    """Rows of the training part, one aggregation over a single column."""
    return train.select("label").count()


def sized(df: DataFrame, rows: int) -> DataFrame:
    """``df`` in one partition for every ``ROWS_A_PARTITION`` rows."""
    have, want = df.rdd.getNumPartitions(), max(1, math.ceil(rows / ROWS_A_PARTITION))
    return df.coalesce(want) if have >= want else df.repartition(want)


def in_waves(df: DataFrame, rows: int) -> DataFrame:
    """``df`` as :func:`sized` has it while that gives no more partitions than cores; beyond, in even parts, as many as cores or a
    multiple of them that leaves ``MOST_A_PARTITION`` rows a part. A level of a tree is two stages of a task a partition each, so
    many small parts cost more in tasks than in rows, and one part more than the cores doubles the time of a stage."""
    cores = df.sparkSession.sparkContext.defaultParallelism
    if math.ceil(rows / ROWS_A_PARTITION) <= cores:
        return sized(df, rows)
    return df.repartition(cores * math.ceil(rows / (cores * MOST_A_PARTITION)))


def spread(df: DataFrame) -> DataFrame:
    """``df`` over all cores: few rows come in one partition, but a row goes through every tree of a model."""
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df if df.rdd.getNumPartitions() >= cores else df.repartition(cores)


def assembled(prep: PipelineModel, df: DataFrame, name: str = "assembled", label: str = "label") -> tuple[DataFrame, int]:
    """(label, features) of ``df``, written to the shared folder and read in partitions for tree fits; their number."""
    path = new_scratch_path(df.sparkSession, name)
    prep.transform(df).select(F.col(label).alias("label"), "features").write.parquet(path)
    rows = df.sparkSession.read.parquet(path)
    n = rows.count()
    return in_waves(rows, n), n


def fit(train: DataFrame, numeric: list[str], categorical: list[str], classifier, few: bool = False) -> PipelineModel:
    """Preprocessing + classifier as one fitted unit (persistable). Trees are grown on assembled rows in few partitions: every
    level of them is a job, and every partition sends the statistics of all open nodes, however few its rows. ``few`` as in
    :func:`fit_classifier`."""
    scratch_dir(train.sparkSession)  # GBT checkpoints its lineage there
    prep = preprocessor(numeric, categorical)
    if not isinstance(classifier, (GBTClassifier, RandomForestClassifier)):
        return Pipeline(stages=prep.getStages() + [classifier]).fit(train)
    prep = prep.fit(train)
    grow = partial(fit_classifier, few=True) if few else fit_classifier
    return PipelineModel(stages=prep.stages + [grow(classifier, assembled(prep, train)[0])])


def fit_classifier(classifier, rows: DataFrame, few: bool = False):
    """The classifier fitted on assembled rows: boosted trees on coded rows (:mod:`tessera.operators.boost`), forests on many rows
    too (:mod:`tessera.operators.forests`); another large forest in ``FOREST_PARTS`` parts of its trees, which are independent of
    each other, as many at once as keep the cores busy. Boosted trees on ``ROWS_A_PARTITION`` rows or fewer are Spark's own fit, which
    breaks ties of equal splits by rounding, unless ``few`` says that they aren't: a search has many such fits."""
    if boost.supported(classifier, rows) and (few or rows.count() > ROWS_A_PARTITION):
        return boost.fit(classifier, rows)
    grown = forests.fit(classifier, rows) if forests.supported(classifier, rows) else None
    if grown is not None:
        return grown
    trees = classifier.getNumTrees() if isinstance(classifier, RandomForestClassifier) else 0
    if trees < 2 * FOREST_PARTS:  # a part of one tree would be grown without resampling
        return classifier.fit(rows)
    sizes = [trees // FOREST_PARTS + (i < trees % FOREST_PARTS) for i in range(FOREST_PARTS)]
    seed = classifier.getSeed()

    def part(i):  # far apart: a partition's sample is seeded with the seed plus its number
        return classifier.copy({classifier.numTrees: sizes[i], classifier.seed: seed + 1_000_003 * i}).fit(rows)

    at_once = 2 * rows.sparkSession.sparkContext.defaultParallelism // max(1, rows.rdd.getNumPartitions())
    with ThreadPoolExecutor(max_workers=max(1, min(FOREST_PARTS, at_once))) as pool:
        return joined_forest(list(pool.map(part, range(FOREST_PARTS))), trees, seed)


def joined_forest(parts: list, n: int, seed: int) -> RandomForestClassificationModel:
    """The forest of all ``n`` trees of ``parts``."""
    sc = SparkContext.getOrCreate()  # threads of a search have no active session
    trees = sc._gateway.new_array(sc._jvm.org.apache.spark.ml.classification.DecisionTreeClassificationModel, n)
    for k, tree in enumerate(t for p in parts for t in p._java_obj.trees()):
        trees[k] = tree
    first = parts[0]
    java = sc._jvm.org.apache.spark.ml.classification.RandomForestClassificationModel(
        first._java_obj.uid(), trees, first.numFeatures, first.numClasses)
    out = RandomForestClassificationModel(java)
    out._set(**{p.name: v for p, v in first.extractParamMap().items() if out.hasParam(p.name)} | {"numTrees": n, "seed": seed})
    out._transfer_params_to_java()
    return out


def predict(model: PipelineModel, df: DataFrame, keep: list[str]) -> DataFrame:
    """(keep..., score = P(class 1), pred)."""
    out = model.transform(df)
    return out.select(*keep, vector_to_array("probability")[1].alias("score"), F.col("prediction").cast("int").alias("pred"))


def leading_trees(model, n: int):
    """The boosted model of the first ``n`` trees."""
    from pyspark.ml.classification import GBTClassificationModel
    if n >= model.getNumTrees:
        return model
    java = model._java_obj
    sc = SparkContext.getOrCreate()  # threads of a search have no active session
    trees = sc._gateway.new_array(sc._jvm.org.apache.spark.ml.regression.DecisionTreeRegressionModel, n)
    weights = sc._gateway.new_array(sc._jvm.double, n)
    for k in range(n):
        trees[k], weights[k] = java.trees()[k], float(model.treeWeights[k])
    part = sc._jvm.org.apache.spark.ml.classification.GBTClassificationModel(java.uid(), trees, weights)
    out = GBTClassificationModel(part)
    for name in ("featuresCol", "labelCol", "predictionCol", "probabilityCol", "rawPredictionCol"):
        out._set(**{name: model.getOrDefault(name)})
    out._transfer_params_to_java()
    return out


def staged_loss(model: PipelineModel, df: DataFrame) -> DataFrame:
    """Training loss after each boosting round (Spark's log-loss form: 2 log(1 + exp(-2yF)))."""
    gbt = model.stages[-1]
    prep = PipelineModel(stages=model.stages[:-1])
    losses = gbt.evaluateEachIteration(prep.transform(df).select("features", "label"))
    rows = [(i + 1, float(v)) for i, v in enumerate(losses)]
    return df.sparkSession.createDataFrame(rows, "iteration int, loss double")


def importances(model: PipelineModel, numeric: list[str], categorical: list[str]) -> DataFrame:
    """(feature, importance): tree importances, or |coefficient| for a linear model."""
    clf = model.stages[-1]
    names = encoded_names(PipelineModel(stages=model.stages[:-1]), numeric, categorical)
    if hasattr(clf, "featureImportances"):
        vals = clf.featureImportances.toArray().tolist()
    else:
        vals = [abs(x) for x in clf.coefficients.toArray().tolist()]
    names = names + [f"Feature_{i}" for i in range(len(names), len(vals))]
    rows = list(zip(names[: len(vals)], [float(v) for v in vals]))
    spark = SparkSession.getActiveSession()
    return spark.createDataFrame(rows, "feature string, importance double")


def learning_curve(placed: DataFrame, numeric: list[str], categorical: list[str], make_clf, k: int, steps: int = 10,
                   parallelism: int = 4, label: str = "label", fold_col: str = "fold") -> DataFrame:
    """Train and validation macro F1 per (step, fold) for growing subsets of each fold's training rows: the prefixes of
    :func:`tessera.operators.split.learning_curve_sizes`, with preprocessing and classifier fitted anew on every one.

    ``placed`` comes from :func:`tessera.operators.split.fold_places`, written once. L2 logistic models are fitted together
    (:mod:`tessera.operators.curve`); with other classifiers a fit reads its rows and columns by a filter on the place, and its
    train and validation predictions are scored in one aggregation."""
    n = placed.filter(F.col(fold_col) != 0).count()
    joint = curve.joint_scores(placed, numeric, categorical, make_clf, k, steps, n, label, fold_col)
    if joint is not None:
        scores, parts, _ = joint
        f1 = {(r["fold"], r["step"], r["part"]): r["f1_macro"] for r in scores.collect()}  # two rows a fit
        return curve_means(placed.sparkSession, [(s, f, p.n, f1.get((f, s, "train")), f1.get((f, s, "valid"))) for (f, s), p in parts.items()])

    def run(job):
        f, s = job
        sub = placed.filter((F.col(fold_col) != f) & (F.col(f"place_{f}") <= s * n // steps))
        n_sub = sub.count()
        model = fit(sub, numeric, categorical, make_clf(max(1, n_sub)))
        part = F.when(F.col(fold_col) == f, "valid").otherwise("train").alias("_part")
        both = placed.filter((F.col(fold_col) == f) | (F.col(f"place_{f}") <= s * n // steps))
        out = model.transform(both).select(part, label, F.col("prediction").cast("int").alias("pred"))
        bm = {r["_part"]: r["f1_macro"] for r in V.binary_metrics(out, ["_part"]).collect()}  # two rows
        return (s, f, n_sub, bm.get("train"), bm.get("valid"))

    jobs = [(f, s) for f in range(k) for s in range(1, steps + 1)]
    with ThreadPoolExecutor(max_workers=max(1, parallelism)) as ex:
        rows = list(ex.map(run, jobs))
    return curve_means(placed.sparkSession, rows)


def curve_means(spark: SparkSession, rows: list[tuple]) -> DataFrame:
    """Means over folds of (step, fold, n_train, train F1, validation F1)."""
    lc = spark.createDataFrame(rows, "step int, fold int, n_train long, train_f1_macro double, cv_f1_macro double")
    return lc.groupBy("step").agg(F.max("n_train").alias("train_size"), F.round(F.avg("train_f1_macro"), 6).alias("train_f1_macro"),
                                  F.round(F.avg("cv_f1_macro"), 6).alias("cv_f1_macro"))
