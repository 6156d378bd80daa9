"""Additive attributions and their summaries (H1-H7).

* Linear models: attribution_j = w_j * (x_j - mean_j), closed form, pure column arithmetic.
* Trees: Shapley values of the tree's expectation, where a feature that isn't known sends a row down both branches by
  their shares of the training rows. A leaf counts for a set of features as the product, over the features on its path, of
  1 or 0 (known: the row passes its splits or not) or of the shares (unknown); the sum over all sets is a polynomial's
  coefficients weighed by their sizes, so a leaf takes depth^2 steps in place of 2^depth. base + sum(attributions) = raw
  margin (boosted) or probability (forest). The tree tables come from the saved model (a Parquet table of nodes, sized by
  the model, not the data), are broadcast once, and rows are processed in Arrow batches by ``mapInPandas``.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.ml.classification import RandomForestClassificationModel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tessera.session import new_scratch_path


# Linear ------------------------------------------------------------------------------

def linear_attributions(df: DataFrame, id_col: str, weights: dict[str, float], means: dict[str, float],
                        digits: int = 6) -> DataFrame:
    """Long table (id, feature, value, attribution) for a linear score."""
    recs = [F.struct(F.lit(f).alias("feature"), F.col(f).cast("double").alias("value"),
                     F.round(F.lit(w) * (F.col(f).cast("double") - F.lit(means[f])), digits).alias("attribution"))
            for f, w in weights.items()]
    return df.select(id_col, F.inline(F.array(*recs)))


def logistic_attributions(df: DataFrame, id_col: str, features_col: str, lr_model, train_vectors: DataFrame,
                          names: list[str]) -> DataFrame:
    """Attributions of a fitted logistic model over its input vector:
    coef_j * (x_j - mean_j), with the means of the training vectors (one distributed
    ``Summarizer`` pass, a model-sized result). base = intercept + coef . mean, so
    base + sum(attributions) = the model's raw margin. Array arithmetic stays in the JVM."""
    from pyspark.ml.stat import Summarizer
    mean = train_vectors.select(Summarizer.mean(F.col(features_col)).alias("m")).first()["m"].toArray().tolist()
    coef = lr_model.coefficients.toArray().tolist()
    base = float(lr_model.intercept + sum(c * m for c, m in zip(coef, mean)))
    mu = F.array(*[F.lit(float(m)) for m in mean])
    w = F.array(*[F.lit(float(c)) for c in coef])
    x = vector_to_array(features_col)
    contrib = F.zip_with(F.zip_with(x, mu, lambda a, b: a - b), w, lambda d, c: d * c)
    name_arr = F.array(*[F.lit(n) for n in names])
    margin = F.aggregate(F.zip_with(x, w, lambda a, c: a * c), F.lit(float(lr_model.intercept)), lambda acc, v: acc + v)
    return df.select(id_col, margin.alias("margin"), x.alias("_x"), F.posexplode(contrib).alias("pos", "attribution")) \
        .select(id_col, F.element_at(name_arr, F.col("pos") + 1).alias("feature"),
                F.element_at("_x", F.col("pos") + 1).alias("value"), "attribution", F.lit(base).alias("base"), "margin")


# Trees -------------------------------------------------------------------------------

def tree_tables(spark: SparkSession, ensemble_model) -> tuple[dict, list[float]]:
    """Node arrays per tree from the saved ensemble (model-sized, gathered once)."""
    if not hasattr(ensemble_model, "treeWeights"):
        raise TypeError(f"no tree ensemble: {type(ensemble_model).__name__}")
    path = new_scratch_path(spark, "trees")
    ensemble_model.write().overwrite().save(path)
    nodes = spark.read.parquet(path + "/data").select(
        "treeID", F.col("nodeData.id").alias("id"), F.col("nodeData.prediction").alias("prediction"),
        F.col("nodeData.leftChild").alias("left"), F.col("nodeData.rightChild").alias("right"),
        F.col("nodeData.split.featureIndex").alias("feature"),
        F.col("nodeData.split.leftCategoriesOrThreshold").alias("cats"),
        F.col("nodeData.split.numCategories").alias("ncat"), F.col("nodeData.rawCount").cast("double").alias("cover"),
        F.col("nodeData.impurityStats").alias("stats")).toPandas()
    shares = isinstance(ensemble_model, RandomForestClassificationModel)  # its leaves vote by class shares
    trees = {}
    for tid, g in nodes.groupby("treeID"):
        g = g.sort_values("id")
        n = int(g["id"].max()) + 1
        pred = np.zeros(n)
        left = -np.ones(n, dtype=np.int64)
        right = -np.ones(n, dtype=np.int64)
        feat = -np.ones(n, dtype=np.int64)
        thr = np.zeros(n)
        cats = [None] * n
        cover = np.ones(n)
        for r in g.itertuples(index=False):
            i = int(r.id)
            pred[i], left[i], right[i], feat[i] = r.prediction, r.left, r.right, r.feature
            stats = np.asarray(r.stats, float)
            cover[i] = max(stats.sum() if shares else r.cover, 1e-9)
            if shares:
                pred[i] = stats[1] / stats.sum()
            if r.left >= 0:
                if r.ncat is not None and r.ncat >= 0:
                    cats[i] = np.array([float(x) for x in r.cats])
                else:
                    thr[i] = float(r.cats[0])
        is_cat = np.array([c is not None for c in cats])
        trees[int(tid)] = dict(pred=pred, left=left, right=right, feat=feat, thr=thr, cats=cats, is_cat=is_cat, cover=cover)
    weights = list(ensemble_model.treeWeights)
    return trees, [w / sum(weights) for w in weights] if shares else weights


def leaf_paths(t: dict) -> dict:
    """Per leaf: its path's nodes, directions and places of their features among the path's own; those features; and the
    product of the shares of training rows that each feature's splits let through (1 for places that aren't used)."""
    found, stack = [], [(0, [])]
    while stack:
        node, path = stack.pop()
        if t["left"][node] < 0:
            found.append((node, path))
            continue
        stack += [(t["left"][node], [*path, (node, True)]), (t["right"][node], [*path, (node, False)])]
    depth = max(1, max(len(p) for _, p in found))
    shape = (len(found), depth)
    nodes, goes, place = np.zeros(shape, np.int32), np.zeros(shape, bool), np.full(shape, -1, np.int16)
    feature, share = np.full(shape, -1, np.int32), np.ones(shape)
    for k, (_, path) in enumerate(found):
        own: dict[int, int] = {}
        for j, (node, to_left) in enumerate(path):
            i = own.setdefault(int(t["feat"][node]), len(own))
            nodes[k, j], goes[k, j], place[k, j], feature[k, i] = node, to_left, i, t["feat"][node]
            below = t["left"][node] if to_left else t["right"][node]
            share[k, i] *= t["cover"][below] / (t["cover"][t["left"][node]] + t["cover"][t["right"][node]])
    value = t["pred"][[leaf for leaf, _ in found]]
    return dict(nodes=nodes, goes=goes, place=place, feature=feature, share=share, value=value,
                base=float((value * share.prod(1)).sum()))


def _goes_left(X: np.ndarray, t: dict) -> np.ndarray:
    """(node, row): whether the row goes left at the node."""
    out = np.zeros((len(t["left"]), len(X)), bool)
    for node in np.flatnonzero(t["left"] >= 0):
        x = X[:, t["feat"][node]]
        out[node] = np.isin(x, t["cats"][node]) if t["is_cat"][node] else x <= t["thr"][node]
    return out


def shapley_batch(X: np.ndarray, t: dict, paths: dict, cells: int = 4_000_000) -> np.ndarray:
    """(row, feature): Shapley values of one tree, for as many rows at once as fit ``cells`` numbers."""
    out = np.zeros((X.shape[1], len(X)))
    leaves, depth = paths["share"].shape
    sizes = np.arange(depth)
    weight = np.array([math.factorial(k) * math.factorial(depth - 1 - k) / math.factorial(depth) for k in sizes])
    step = max(1, cells // (leaves * (depth + 1)))
    for at in range(0, len(X), step):
        left = _goes_left(X[at: at + step], t)
        n = left.shape[1]
        passes = np.ones((depth, leaves, n), bool)
        for j in range(depth):
            k = np.flatnonzero(paths["place"][:, j] >= 0)
            passes[paths["place"][k, j], k] &= left[paths["nodes"][k, j]] == paths["goes"][k, j][:, None]
        product = np.zeros((depth + 1, leaves, n))
        product[0] = 1
        for i in range(depth):  # times (share + passes * x)
            z = paths["share"][:, i, None]
            product[1:] = z * product[1:] + np.where(passes[i], product[:-1], 0)
            product[0] *= z
        for i in range(depth):  # without feature i: divided by its factor, from the highest power where the row passes
            z, o = paths["share"][:, i, None], passes[i]
            total, higher = np.zeros((leaves, n)), np.zeros((leaves, n))
            for k in range(depth - 1, -1, -1):
                higher = np.where(o, product[k + 1] - z * higher, product[k] / z)
                total += weight[k] * higher
            k = np.flatnonzero(paths["feature"][:, i] >= 0)
            part = paths["value"][:, None] * (o - z) * total
            np.add.at(out[:, at: at + step], paths["feature"][k, i], part[k])
    return out.T


def _leaf_values(X: np.ndarray, t: dict) -> np.ndarray:
    left, node, rows = _goes_left(X, t), np.zeros(len(X), np.int64), np.arange(len(X))
    while (t["left"][node] >= 0).any():
        below = np.where(left[node, rows], t["left"][node], t["right"][node])
        node = np.where(t["left"][node] >= 0, below, node)
    return t["pred"][node]


def tree_attributions(df: DataFrame, id_col: str, features_col: str, ensemble_model, names: list[str]) -> DataFrame:
    """Long table (id, feature, value, attribution) of every vector slot, with (base, margin) repeated per row; the margin is
    the raw one of boosted trees, the probability of class 1 of a forest."""
    spark = df.sparkSession
    trees, weights = tree_tables(spark, ensemble_model)
    model = [(trees[k], leaf_paths(trees[k]), w) for k, w in zip(sorted(trees), weights)]
    base = float(sum(w * paths["base"] for _, paths, w in model))
    bc = spark.sparkContext.broadcast(model)

    def run(batches):
        for pdf in batches:
            if len(pdf) == 0:
                continue
            X = np.stack(pdf["x"].to_numpy())
            contrib, margin = np.zeros(X.shape), np.zeros(len(X))
            for t, paths, w in bc.value:
                contrib += w * shapley_batch(X, t, paths)
                margin += w * _leaf_values(X, t)
            yield pd.DataFrame({id_col: pdf[id_col].to_numpy(), "base": base, "margin": margin, "x": list(X), "contrib": list(contrib)})

    arr = df.select(id_col, vector_to_array(features_col).alias("x"))
    wide = arr.mapInPandas(run, f"{id_col} long, base double, margin double, x array<double>, contrib array<double>")
    name_arr = F.array(*[F.lit(n) for n in names])
    return wide.select(id_col, "base", "margin", "x", F.posexplode("contrib").alias("pos", "attribution")).select(
        id_col, F.element_at(name_arr, F.col("pos") + 1).alias("feature"), F.element_at("x", F.col("pos") + 1).alias("value"),
        "attribution", "base", "margin")


# Summaries ---------------------------------------------------------------------------

def ranking(attr: DataFrame, digits: int = 6) -> DataFrame:
    """Mean |attribution| per feature, largest first."""
    return attr.groupBy("feature").agg(F.round(F.avg(F.abs("attribution")), digits).alias("mean_abs")) \
        .orderBy(F.desc("mean_abs"), "feature")


def rank_of(rank_table: DataFrame, feature: str, top: int = 3) -> DataFrame:
    """True 1-based rank of every feature (the table has one row per feature); keep the
    top ``top`` and the named feature, with top-3 / top-5 flags."""
    r = rank_table.withColumn("rank", F.row_number().over(Window.orderBy(F.desc("mean_abs"), "feature")))
    return r.filter((F.col("rank") <= top) | (F.col("feature") == feature)) \
        .withColumn("in_top3", F.col("rank") <= 3).withColumn("in_top5", F.col("rank") <= 5)


def notable(rank_table: DataFrame, among: list[str], threshold: float = 0.1) -> DataFrame:
    return rank_table.filter(F.col("feature").isin(*among) & (F.col("mean_abs") > threshold))


def breakdown(attr: DataFrame, id_col: str, score: DataFrame, n: int = 15, digits: int = 6) -> DataFrame:
    """Parts of the most confident row: its ``n`` largest |attributions| and the rest summed.

    ``score`` is (id, score); the row is picked with a partial aggregation (``max_by``,
    ties to the smallest id) and reaches the attribution table as a scalar subquery.
    """
    top_id = score.agg(F.min_by(id_col, F.struct((-F.col("score")).alias("s"), F.col(id_col).alias("i")))).scalar()
    rows = attr.filter(F.col(id_col) == top_id)
    w = Window.partitionBy(id_col).orderBy(F.desc(F.abs("attribution")), "feature")
    ranked = rows.withColumn("k", F.row_number().over(w))
    head = ranked.filter(F.col("k") <= n).select(id_col, "feature", "attribution")
    rest = ranked.filter(F.col("k") > n).groupBy(id_col).agg(F.round(F.sum("attribution"), digits).alias("attribution")) \
        .select(id_col, F.lit("rest").alias("feature"), "attribution")
    return head.unionByName(rest)
