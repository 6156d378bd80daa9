"""Random forests on coded rows: every tree grown whole in one task.

Trees are grown as ``RandomForestClassifier`` grows them (at most ``maxBins`` bins a feature, rows drawn with replacement by a Poisson
number each, a random choice of features a node, Gini gain, leaves of one class joined), but a task has all rows as codes of
:mod:`tessera.operators.boost` (a byte a code) and grows a share of the trees a level at a time: one count a code and level
gives all splits of all nodes. Rows of equal codes and label are one row with a number: drawing each a Poisson number of times is
drawing their number times that. Nothing but these rows is sent, once a task, and the trees go from the tasks to the model's file.
The random numbers are others than Spark's. Up to ``ROWS_IN_A_TASK`` distinct rows; beyond, a fit is Spark's own.
"""

from __future__ import annotations

import json
import math
import time
import uuid

import numpy as np
import pyarrow as pa
from pyspark import StorageLevel
from pyspark.ml.classification import RandomForestClassificationModel, RandomForestClassifier
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.operators.boost import CODES, NODE, Coding, Rules, binary_slots, learned_coding, packed
from tessera.session import new_scratch_path, scratch_dir

#: Fewer rows are Spark's; growing a tree takes some 50 bytes a distinct row.
LEAST_ROWS = 50_000
ROWS_IN_A_TASK = 8_000_000
ROWS_A_PART = 2_000_000
DEEPEST = 20
SUBSETS = {"all": lambda n, trees: n, "sqrt": lambda n, trees: math.ceil(math.sqrt(n)), "log2": lambda n, trees: max(1, math.ceil(math.log2(n))),
           "onethird": lambda n, trees: math.ceil(n / 3), "auto": lambda n, trees: n if trees == 1 else math.ceil(math.sqrt(n))}


def distinct(made, coding: Coding, parts: int):
    """RDD of (bucket, (codes, whether of class 1, number of rows)) of the distinct coded rows; every such row is in one bucket."""
    width = len(coding.codes)

    def counted(keys, n):
        keys, at = np.unique(keys, return_inverse=True)
        return keys, np.bincount(at, n, len(keys))

    def dealt(x):
        rows = x[0]
        if width > 7:  # no room in a key: every row by itself
            return [(x[0].seed % parts, (rows.codes, rows.y > 0, np.ones(len(rows.y))))]
        keys = (rows.y > 0).astype(np.uint64)
        for c in rows.codes:
            keys = keys << np.uint64(8) | c
        keys, n = counted(keys, None)
        to = (keys * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(40)) % np.uint64(parts)
        return [(k, (keys[to == k], n[to == k])) for k in range(parts)]

    def joined(number, found):
        if width > 7:
            return found
        found = [x for _, x in found]
        if not found:
            return []
        keys, n = counted(np.concatenate([k for k, _ in found]), np.concatenate([n for _, n in found]))
        codes = [(keys >> np.uint64(8 * (width - 1 - c))).astype(np.uint8) for c in range(width)]
        return [(number, (np.array(codes), keys >> np.uint64(8 * width) > 0, n))]

    return made.filter(lambda x: x[0] is not None).flatMap(dealt).partitionBy(parts, int).mapPartitionsWithIndex(joined)


def grown(codes: np.ndarray, y: np.ndarray, times: np.ndarray, coding: Coding, rules: Rules, some: int, share: float,
          rng: np.random.Generator) -> dict:
    """One tree on rows that count ``times``: per node (level by level) its counts of both classes, its split's column or -1, its
    gain, its children."""
    w = rng.poisson(share * times).astype(np.float64)
    rows = np.flatnonzero(w)
    codes, y, w = codes[:, rows], y[rows].astype(np.int64), w[rows]
    stats, column, gains, left, right = [], [], [], [], []
    here = np.array([[w[y == 0].sum(), w[y == 1].sum()]])  # counts of the level's nodes that may be split
    ids, total, node = np.array([0]), 1, np.zeros(len(y), np.int32)
    stats.append(here)
    exact = np.float32 if w.sum() < 1 << 24 else np.float64
    low = coding.low.astype(exact)
    columns = [np.flatnonzero(coding.code == c) for c in range(len(coding.codes))]
    for level in range(rules.depth):
        m = len(ids)
        if not m or not len(coding.feature):
            break
        allowed = np.zeros((m, len(coding.splits)), bool)
        np.put_along_axis(allowed, rng.random(allowed.shape, np.float32).argpartition(some - 1, 1)[:, :some], True, 1)
        l0, l1 = np.empty((m, len(coding.feature))), np.empty((m, len(coding.feature)))
        base = node.astype(np.int64) * (2 * CODES) + y * CODES
        for c, ks in enumerate(columns):
            if len(ks):
                both = np.bincount(base + codes[c], w, m * 2 * CODES).astype(exact).reshape(m, 2, CODES) @ low[ks].T
                l0[:, ks], l1[:, ks] = both[:, 0], both[:, 1]
        t0, t1 = here[:, :1], here[:, 1:]
        n, ln = t0 + t1, l0 + l1
        rn = n - ln
        fits = (ln >= rules.least) & (rn >= rules.least) & (ln > 0) & (rn > 0) & allowed[:, coding.feature]
        score = (l0 * l0 + l1 * l1) / np.maximum(ln, 1) + ((t0 - l0) ** 2 + (t1 - l1) ** 2) / np.maximum(rn, 1)
        score[~fits] = -1
        best, each = score.argmax(1), np.arange(m)
        gain = (score[each, best] - ((t0 * t0 + t1 * t1) / np.maximum(n, 1))[:, 0]) / np.maximum(n[:, 0], 1)
        made = np.flatnonzero(fits[each, best] & (gain > 1e-12) & (gain >= rules.gain))
        best = best[made]
        one = np.stack([l0[made, best], l1[made, best]], 1)
        two = here[made] - one
        binary = np.array([s is None for s in coding.splits])[coding.feature[best]]
        swapped = binary & (one[:, 1] > two[:, 1])  # categories in order of their rows of class 1
        one[swapped], two[swapped] = two[swapped], one[swapped].copy()
        column.append((ids[made], best, swapped))
        gains.append(gain[made])
        below = np.stack([one, two], 1).reshape(-1, 2)
        new = total + np.arange(len(below))
        left.append(new[::2])
        right.append(new[1::2])
        stats.append(below)
        total += len(below)
        going = (below > 0).all(1) & (level + 1 < rules.depth)  # a pure node is a leaf
        number = np.full((m, 2), -1, np.int32)
        number[made] = np.where(going, np.cumsum(going) - 1, -1).reshape(-1, 2)
        split, swap = np.full(m, -1), np.zeros(m, bool)
        split[made], swap[made] = best, swapped
        to_right = np.zeros(len(node), bool)
        code_of = np.where(split >= 0, coding.code[split], -1)[node]
        for c in range(len(coding.codes)):
            at = np.flatnonzero(code_of == c)
            to_right[at] = ~coding.low[split[node[at]], codes[c, at]]
        to_right ^= swap[node]
        node = number[node, to_right.astype(np.int8)]
        keep = np.flatnonzero(node >= 0)
        if len(keep) < len(node):
            codes, y, w, node = codes[:, keep], y[keep], w[keep], node[keep]
        ids, here = new[going], below[going]
    return dict(stats=stats, column=column, gain=gains, left=left, right=right, total=total)


def node_batch(t: dict, coding: Coding, tree: int) -> pa.RecordBatch:
    """The tree as Spark saves it: nodes in preorder, leaves of one class below a node joined."""
    stats, total = np.concatenate(t["stats"]), t["total"]
    split, left, right, gain, swapped = (np.full(total, -1), np.full(total, -1), np.full(total, -1), np.full(total, -1.0), np.zeros(total, bool))
    for (ids, best, swap), g, a, b in zip(t["column"], t["gain"], t["left"], t["right"]):
        split[ids], swapped[ids], gain[ids], left[ids], right[ids] = best, swap, g, a, b
    predicted, size, leaf = (stats[:, 1] > stats[:, 0]).astype(float), np.ones(total, np.int64), split < 0
    for ids, _, _ in reversed(t["column"]):
        a, b = left[ids], right[ids]
        joined = leaf[a] & leaf[b] & (predicted[a] == predicted[b])
        leaf[ids[joined]] = True
        rest = ids[~joined]
        size[rest] = 1 + size[left[rest]] + size[right[rest]]
    place, kept = np.full(total, -1, np.int64), [np.array([0])]
    place[0] = 0
    for ids, _, _ in t["column"]:
        ids = ids[(place[ids] >= 0) & ~leaf[ids]]
        place[left[ids]], place[right[ids]] = place[ids] + 1, place[ids] + 1 + size[left[ids]]
        kept += [left[ids], right[ids]]
    at = np.concatenate(kept)
    at = at[np.argsort(place[at])]
    inner, n = ~leaf[at], stats[at].sum(1)
    j = np.where(inner, split[at], 0)
    feature = coding.feature[j] if len(coding.feature) else np.zeros(len(at), int)
    value, arity = np.zeros(len(at)), np.full(len(at), -1)
    for k in np.flatnonzero(inner):
        s = coding.splits[feature[k]]
        value[k], arity[k] = (float(swapped[at[k]]), 2) if s is None else (s[coding.rank[j[k]]], -1)
    share = stats[at] / np.maximum(n, 1)[:, None]
    i32 = pa.int32()
    cut = pa.StructArray.from_arrays([pa.array(np.where(inner, feature, -1), i32), pa.ListArray.from_arrays(
        pa.array(np.concatenate([[0], np.cumsum(inner)]), i32), pa.array(value[inner])), pa.array(np.where(inner, arity, -1), i32)],
        ["featureIndex", "leftCategoriesOrThreshold", "numCategories"])
    child = lambda side: pa.array(np.where(inner, place[side[at]], -1), i32)
    data = pa.StructArray.from_arrays(
        [pa.array(np.arange(len(at)), i32), pa.array(predicted[at]), pa.array(1 - (share * share).sum(1)),
         pa.ListArray.from_arrays(pa.array(np.arange(0, 2 * len(at) + 1, 2), i32), pa.array(stats[at].ravel())), pa.array(n.astype(np.int64)),
         pa.array(np.where(inner, gain[at], -1.0)), child(left), child(right), cut],
        ["id", "prediction", "impurity", "impurityStats", "rawCount", "gain", "leftChild", "rightChild", "split"])
    return pa.RecordBatch.from_arrays([pa.array(np.full(len(at), tree), i32), data], ["treeID", "nodeData"])


def supported(clf, rows: DataFrame) -> bool:
    """Whether ``clf`` is the plain binary forest that is fitted here."""
    if not isinstance(clf, RandomForestClassifier) or any(clf.isSet(p) for p in ("weightCol", "thresholds", "leafCol")):
        return False
    return (clf.getImpurity() == "gini" and 0 < clf.getMaxDepth() <= DEEPEST and clf.getFeatureSubsetStrategy() in SUBSETS and clf.getNumTrees() > 1
            and clf.getBootstrap() and clf.getMinWeightFractionPerNode() == 0 and clf.getMaxBins() <= CODES
            and rows.count() > LEAST_ROWS and set(binary_slots(rows).values()) <= {2}
            and rows.filter(F.col("label").isin(0, 1)).select("label").distinct().count() == 2)


def fit(clf: RandomForestClassifier, rows: DataFrame) -> RandomForestClassificationModel | None:
    """``clf`` fitted on (label, features); None if too many rows differ."""
    spark = rows.sparkSession
    scratch_dir(spark)
    n, seed, binary, trees = rows.count(), clf.getSeed(), set(binary_slots(rows)), clf.getNumTrees()
    cores = spark.sparkContext.defaultParallelism
    rules, share = Rules(clf.getMaxDepth(), clf.getMinInstancesPerNode(), clf.getMinInfoGain()), clf.getSubsamplingRate()
    for grouped in (True, False):
        coding = learned_coding(rows, n, clf.getMaxBins(), seed, binary, grouped)
        parts = cores * math.ceil(n / (cores * ROWS_A_PART))
        made = packed(rows, coding, seed, parts).persist(StorageLevel.MEMORY_AND_DISK)
        wrong = set().union(*made.map(lambda x: x[1]).collect())
        if "labels" in wrong:
            made.unpersist()
            return clf.fit(rows)  # raises as Spark does
        if not wrong:
            break
        made.unpersist()
    held = distinct(made, coding, parts).persist(StorageLevel.MEMORY_AND_DISK)
    different = sum(held.map(lambda x: len(x[1][1])).collect())
    made.unpersist()
    if different > ROWS_IN_A_TASK:
        held.unpersist()
        return None
    some, tasks = SUBSETS[clf.getFeatureSubsetStrategy()](len(coding.splits), trees), min(trees, cores)

    def grow(parts):
        parts = sorted(parts, key=lambda p: p[1][0])  # the same rows in the same order at every run
        if not parts:
            return
        task = parts[0][0]
        codes = np.concatenate([x[0] for _, (_, x) in parts], 1)
        y, times = (np.concatenate([x[k] for _, (_, x) in parts]) for k in (1, 2))
        del parts
        for tree in range(task, trees, tasks):
            batch = node_batch(grown(codes, y, times, coding, rules, some, share, np.random.default_rng([seed & 0xFFFFFFFF, tree])), coding, tree)
            sink = pa.BufferOutputStream()
            with pa.ipc.new_stream(sink, batch.schema) as writer:
                writer.write_batch(batch)
            yield (bytearray(sink.getvalue().to_pybytes()),)

    def decoded(batches):
        for batch in batches:
            for one in batch.column(0):
                yield from pa.ipc.open_stream(one.as_buffer())

    grown_trees = held.flatMap(lambda x: [(t, x) for t in range(tasks)]).partitionBy(tasks, int).mapPartitions(grow)
    path = new_scratch_path(spark, "forest")
    spark.createDataFrame(grown_trees, "ipc binary").mapInArrow(decoded, NODE).write.parquet(f"{path}/data")
    held.unpersist()
    mine = {p.name: v for p, v in clf.extractParamMap().items() if clf.isSet(p)}
    mine |= {"featuresCol": clf.getFeaturesCol(), "labelCol": clf.getLabelCol(), "seed": seed}
    every = {p.name: clf.getOrDefault(p) for p in clf.params if clf.hasDefault(p)}
    of_trees = ("checkpointInterval", "featuresCol", "labelCol", "cacheNodeIds", "maxDepth", "maxBins", "maxMemoryInMB", "minInstancesPerNode", "seed")
    about = lambda name, uid, a, b: {"class": f"org.apache.spark.ml.classification.{name}", "timestamp": int(time.time() * 1000),
                                     "sparkVersion": spark.version, "uid": uid, "paramMap": a, "defaultParamMap": b}
    head = about("RandomForestClassificationModel", clf.uid, mine, every) | {"numFeatures": len(coding.splits), "numClasses": 2, "numTrees": trees}
    own, rest = ({k: v for k, v in x.items() if k in of_trees} for x in (mine, every))
    tree = lambda: json.dumps(about("DecisionTreeClassificationModel", f"dtc_{uuid.uuid4().hex[:12]}", own, rest)
                              | {"numFeatures": len(coding.splits), "numClasses": 2})
    spark.createDataFrame([(json.dumps(head),)], "value string").coalesce(1).write.text(f"{path}/metadata")
    spark.createDataFrame([(k, tree(), 1.0) for k in range(trees)], "_1 int, _2 string, _3 double").coalesce(1).write.parquet(f"{path}/treesMetadata")
    return RandomForestClassificationModel.load(path)
