"""Boosted trees on binned rows: Spark's gradient boosting with the rows of a task held as arrays.

The trees are those of ``GBTClassifier``: splits from a sample of rows, at most ``maxBins`` bins a feature, a tree of the variance
criterion a round, the sample of a round drawn as Spark draws it. What differs is how a level is summed. Features of few bins share a
code of one byte (slots of a one-hot column exclude each other), so a row has a few codes in place of a bin a slot, and one count a code
gives every candidate split by a product with a fixed matrix. Up to ``ROWS_IN_A_TASK`` rows a fit is one task; beyond, a level is one
job over parts of the rows, which only sends sums. The parts are cached, and checkpointed every ``checkpointInterval`` rounds.
"""

from __future__ import annotations

import json
import math
import pickle
import struct
import time
import uuid
from dataclasses import dataclass, field
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import StorageLevel
from pyspark.ml.classification import GBTClassificationModel, GBTClassifier
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.session import _file_system, new_scratch_path, scratch_dir

#: A row takes some 25 bytes.
ROWS_IN_A_TASK = 2_000_000
DEEPEST = 7
CODES = 256
CHUNK = 1 << 16
NODE = ("treeID int, nodeData struct<id: int, prediction: double, impurity: double, impurityStats: array<double>, rawCount: long, gain: double, "
        "leftChild: int, rightChild: int, split: struct<featureIndex: int, leftCategoriesOrThreshold: array<double>, numCategories: int>>")


# Spark's random numbers -------------------------------------------------------------------

def murmur(data: bytes, seed: int) -> int:
    h = seed
    for (k,) in struct.iter_unpack("<I", data):
        k = k * 0xCC9E2D51 & 0xFFFFFFFF
        k = (k << 15 | k >> 17) * 0x1B873593 & 0xFFFFFFFF
        h ^= k
        h = ((h << 13 | h >> 19) & 0xFFFFFFFF) * 5 + 0xE6546B64 & 0xFFFFFFFF
    h ^= len(data)
    h = (h ^ h >> 16) * 0x85EBCA6B & 0xFFFFFFFF
    h = (h ^ h >> 13) * 0xC2B2AE35 & 0xFFFFFFFF
    return h ^ h >> 16


def hashed_seed(seed: int) -> int:
    data = struct.pack(">q", seed)
    low = murmur(data, 0x3C074A61)
    return murmur(data, low) << 32 | low


def _step(s: np.ndarray) -> np.ndarray:
    s = s ^ s << np.uint64(21)
    s ^= s >> np.uint64(35)
    return s ^ s << np.uint64(4)


def _through(columns: np.ndarray, s: np.ndarray) -> np.ndarray:
    """States ``s`` after the linear map whose images of single bits are ``columns``."""
    out = np.zeros_like(s)
    for i in range(64):
        out ^= columns[i] * (s >> np.uint64(i) & np.uint64(1))
    return out


@lru_cache
def _powers(k: int) -> np.ndarray:
    """Images of single bits after 2^k steps."""
    return _step(np.uint64(1) << np.arange(64, dtype=np.uint64)) if k == 0 else _through(_powers(k - 1), _powers(k - 1))


def uniforms(seed: int, n: int) -> np.ndarray:
    """The first ``n`` doubles of Spark's XORShiftRandom: lanes of some steps each, whose first states come by squaring the step."""
    bits = max(1, (2 * n).bit_length() // 2 - 2)
    s, steps, k = np.array([hashed_seed(seed)], np.uint64), 1 << bits, bits
    while len(s) * steps < 2 * n:
        s = np.concatenate([s, _through(_powers(k), s)])
        k += 1
    s = s[: -(-2 * n // steps)]
    out = np.empty((len(s), steps // 2))
    for k in range(steps // 2):
        s = _step(s)
        high = (s & np.uint64((1 << 26) - 1)) << np.uint64(27)
        s = _step(s)
        out[:, k] = (high + (s & np.uint64((1 << 27) - 1))).astype(np.float64)
    return out.ravel()[:n] * 2.0 ** -53


# Bins and codes ---------------------------------------------------------------------------

def thresholds(values: np.ndarray, most: int, total: float) -> np.ndarray:
    """Spark's splits of a continuous feature from sampled values: the middles between neighbours, or ``most`` of them about evenly
    spread over ``total`` rows."""
    v, n = np.unique(values, return_counts=True)
    if len(v) - 1 <= most:
        return (v[:-1] + v[1:]) / 2.0
    stride = total / (most + 1)
    out, seen, target = [], int(n[0]), stride
    for i in range(1, len(v)):
        before, seen = seen, seen + int(n[i])
        if abs(before - target) < abs(seen - target):
            out.append((v[i - 1] + v[i]) / 2.0)
            target += stride
    return np.array(out)


@dataclass
class Coding:
    """How a row becomes codes, and what splits the codes allow. A unit is a continuous slot or a run of binary ones that exclude
    each other; units whose bins multiply to ``CODES`` or less share a code."""
    splits: list  # per slot: thresholds, or None for a binary one
    units: list  # (slots, bins)
    codes: list = field(default_factory=list)  # per code: [(unit, radix)]

    def __post_init__(self):
        sizes = []
        for u in sorted(range(len(self.units)), key=lambda u: -self.units[u][1]):
            bins = self.units[u][1]
            if bins < 2:
                continue
            for c, size in enumerate(sizes):
                if size * bins <= CODES:
                    self.codes[c].append((u, size))
                    sizes[c] *= bins
                    break
            else:
                self.codes.append([(u, 1)])
                sizes.append(bins)
        code = np.arange(CODES)
        found = []
        for c, members in enumerate(self.codes):
            for u, radix in members:
                slots, bins = self.units[u]
                at = code // radix % bins
                for i, j in enumerate(slots):
                    if self.splits[j] is None:
                        found.append((j, 0, c, at != i + 1))
                    else:
                        found += [(j, k, c, at <= k) for k in range(bins - 1)]
        found.sort(key=lambda x: x[:2])
        self.codes = self.codes or [[]]  # no feature varies: all rows in one code
        self.feature = np.array([x[0] for x in found], int)
        self.rank = np.array([x[1] for x in found], int)
        self.code = np.array([x[2] for x in found], int)
        self.low = np.array([x[3] for x in found], bool).reshape(len(found), CODES)  # codes on the low side of a split
        #: (all codes, splits): rows on the low side from counts of codes.
        self.sums = np.zeros((len(self.codes) * CODES, len(found)))
        for k, c in enumerate(self.code):
            self.sums[c * CODES: (c + 1) * CODES, k] = self.low[k]

    def of(self, x: np.ndarray) -> np.ndarray | None:
        """(code, row) of rows of features; None if slots of a unit don't exclude each other here."""
        out = np.zeros((len(self.codes), len(x)), np.uint8)
        for c, members in enumerate(self.codes):
            for u, radix in members:
                slots, _ = self.units[u]
                if self.splits[slots[0]] is None:
                    on = x[:, slots] != 0
                    if len(slots) > 1 and (on.sum(1) > 1).any():
                        return None
                    at = on @ np.arange(1, len(slots) + 1)
                else:
                    at = np.searchsorted(self.splits[slots[0]], x[:, slots[0]], side="left")
                out[c] += (at * radix).astype(np.uint8)
        return out


def binary_slots(rows: DataFrame) -> dict[int, int]:
    """Arity of the nominal slots of ``features`` by its metadata."""
    sc = rows.sparkSession.sparkContext
    found = sc._jvm.org.apache.spark.ml.util.MetadataUtils.getCategoricalFeatures(rows._jdf.schema().apply("features"))
    out, it = {}, found.iterator()
    while it.hasNext():
        pair = it.next()
        out[int(pair._1())] = int(pair._2())
    return out


def learned_coding(rows: DataFrame, n: int, bins: int, seed: int, binary: set, grouped: bool = True) -> Coding:
    """Splits from a sample of some 10,000 rows, as Spark has them; binary slots that exclude each other there form units."""
    wanted = max(bins * bins, 10_000)
    share = wanted / n if wanted < n else 1.0
    some = rows
    if share < 1:  # the rows that Spark draws
        spark = rows.sparkSession
        jvm = spark.sparkContext._jvm
        drawn = rows._jdf.rdd().sample(False, share, jvm.org.apache.spark.util.random.XORShiftRandom(seed).nextInt())
        some = DataFrame(spark._jsparkSession.createDataFrame(drawn, rows._jdf.schema()), spark)
    x = np.array([r[0].toArray() for r in some.select("features").collect()])
    if not len(x):
        raise ValueError("no rows to fit on")
    most = min(bins, n) - 1  # fewer rows than bins: as many bins as rows
    splits = [None if j in binary else thresholds(x[:, j], most, share * n if share < 1 else len(x)) for j in range(x.shape[1])]
    units, on = [], x != 0
    for j in range(x.shape[1]):
        if splits[j] is not None:
            units.append(([j], len(splits[j]) + 1))
        elif grouped and units and splits[units[-1][0][0]] is None and units[-1][1] < 32 and not (on[:, units[-1][0]].any(1) & on[:, j]).any():
            units[-1] = (units[-1][0] + [j], units[-1][1] + 1)
        else:
            units.append(([j], 2))
    return Coding(splits, units)


# Rows of a task ---------------------------------------------------------------------------

@dataclass
class Boosted:
    """Rows with their margins, and the round under way: what its tree is fitted to and which rows are in its sample."""
    codes: np.ndarray
    y: np.ndarray  # -1 or 1
    seed: int  # of the first round
    margin: np.ndarray
    target: np.ndarray | None = None
    drawn: np.ndarray | None = None
    node: np.ndarray | None = None
    number: int = 0

    def chunks(self):
        for a in range(0, len(self.y), CHUNK):
            yield slice(a, min(a + CHUNK, len(self.y)))

    def begin(self, number: int, share: float) -> None:
        self.number = number
        self.drawn = uniforms(self.seed + number, len(self.y)) < share if share < 1 else np.ones(len(self.y), bool)
        self.restart()

    def restart(self) -> None:
        """All rows at the root; what the round's tree is fitted to."""
        self.node = np.zeros(len(self.y), np.uint8)
        if self.target is not None:
            return
        self.target = np.empty(len(self.y))
        for c in self.chunks():
            y = self.y[c].astype(np.float64)
            with np.errstate(over="ignore"):
                self.target[c] = y if self.number == 0 else 4.0 * y / (1.0 + np.exp(2.0 * y * self.margin[c]))

    def descend(self, level: list) -> None:
        """One level down; ``level`` has (code, whether its codes go right) per node, or None for a leaf (left)."""
        tables = {}
        for k, split in enumerate(level):
            if split is not None:
                tables.setdefault(split[0], np.zeros((len(level), CODES), bool))[k] = split[1]
        for c in self.chunks():
            at, right = self.node[c].astype(np.int64) << 8, np.zeros(c.stop - c.start, bool)
            for code, table in tables.items():
                right |= table.ravel()[at + self.codes[code, c]]
            self.node[c] = self.node[c] * 2 + right

    def sums(self, nodes: int) -> np.ndarray:
        """(count or sum, node, code): of the sampled rows."""
        width = (nodes + 1) * CODES
        out = np.zeros((2, len(self.codes), width))
        for c in self.chunks():
            at, t = np.where(self.drawn[c], self.node[c], nodes).astype(np.int64) << 8, self.target[c]
            for b in range(len(self.codes)):
                k = at + self.codes[b, c]
                out[0, b] += np.bincount(k, minlength=width)
                out[1, b] += np.bincount(k, t, width)
        return out.reshape(2, len(self.codes), nodes + 1, CODES)[:, :, :nodes].transpose(0, 2, 1, 3).reshape(2, nodes, -1)

    def finish(self, value: np.ndarray, weight: float) -> np.ndarray:
        """Adds the tree to the margins; (count, sum, sum of squares) of the sampled rows per leaf."""
        out = np.zeros((3, len(value) + 1))
        for c in self.chunks():
            self.margin[c] += weight * value[self.node[c]]
            at, t = np.where(self.drawn[c], self.node[c], len(value)), self.target[c]
            out += np.array([np.bincount(at, x, len(value) + 1) for x in (None, t, t * t)])
        self.target = None
        return out[:, :-1]


    def below(self, levels: list) -> np.ndarray:
        """Sums of the nodes below some levels, from the root on."""
        self.restart()
        for level in levels:
            self.descend(level)
        return self.sums(1 << len(levels))

    def passed(self, tree: tuple) -> np.ndarray:
        """:meth:`finish` with a tree (values, levels, weight), from the root on."""
        self.restart()
        for level in tree[1]:
            self.descend(level)
        return self.finish(tree[0], tree[2])


# Trees ------------------------------------------------------------------------------------

@dataclass
class Rules:
    depth: int
    least: int
    gain: float


def best_splits(sums: np.ndarray, coding: Coding, rules: Rules, dead: list) -> list:
    """Per node its best split (column of the coding's splits, gain, whether the low side goes left, sums of both sides) or None."""
    out = []
    if not len(coding.feature):
        return [None] * len(dead)
    n, s = sums[0][:, :CODES].sum(1), sums[1][:, :CODES].sum(1)
    low_n, low_s = sums[0] @ coding.sums, sums[1] @ coding.sums
    for k in range(len(dead)):
        if dead[k] or not n[k]:
            out.append(None)
            continue
        ln, ls = low_n[k], low_s[k]
        rn, rs = n[k] - ln, s[k] - ls
        ok = (ln >= rules.least) & (rn >= rules.least) & (ln > 0) & (rn > 0)
        both = ls * ls / np.maximum(ln, 1) + rs * rs / np.maximum(rn, 1)
        gain = np.where(ok, both - s[k] * s[k] / n[k], -1.0) / n[k]
        rounding = 1e-13 * np.where(ok, both, 0).max() / n[k]
        j = int((gain >= gain.max() - rounding).argmax())  # the first of equal ones
        if not ok[j] or gain[j] <= rounding or gain[j] < rules.gain:
            out.append(None)
            continue
        binary = coding.splits[coding.feature[j]] is None
        out.append((j, float(gain[j]), not binary or ls[j] / ln[j] <= rs[j] / rn[j], (ln[j], ls[j], rn[j], rs[j])))
    return out


def grown(step, coding: Coding, rules: Rules) -> tuple[list, np.ndarray]:
    """(per level its nodes' splits, value per leaf of the full tree). ``step(levels)`` gives the sums below the levels so far, which
    are as :meth:`Boosted.descend` takes them."""
    splits, levels, dead, value = [], [], [False], None
    for _ in range(rules.depth):
        sums = step(levels)
        if value is None:
            value = [sums[1][0][:CODES].sum() / max(1.0, sums[0][0][:CODES].sum())]
        found = best_splits(sums, coding, rules, dead)
        level, below, values = [], [], []
        for k, f in enumerate(found):
            if f is None:
                level.append(None)
                below += [True, True]
                values += [value[k], value[k]]
                continue
            j, _, low_left, (ln, ls, rn, rs) = f
            low = coding.low[j]
            level.append((int(coding.code[j]), ~low if low_left else low))
            below += [False, False]
            values += [ls / ln, rs / rn] if low_left else [rs / rn, ls / ln]
        splits.append(found)
        levels.append(level)
        dead, value = below, values
    return splits, levels, np.array(value)


def node_rows(splits: list, leaves: np.ndarray, value: np.ndarray, coding: Coding, tree: int) -> list[tuple]:
    """The tree as Spark saves it, from the sampled rows' (count, sum, sum of squares) per leaf; leaves of equal values are joined."""
    stats = [leaves]
    while stats[-1].shape[1] > 1:
        stats.append(stats[-1][:, ::2] + stats[-1][:, 1::2])
    stats.reverse()
    rows = []

    def made(level, k):
        """('leaf', stats, value) or ('node', ..., left, right)."""
        n, s, q = stats[level][:, k]
        here = s / n if n else 0.0
        f = splits[level][k] if level < len(splits) else None
        if f is None:
            return ("leaf", (n, s, q), here if n else float(value[k << (len(splits) - level)]))
        left, right = made(level + 1, 2 * k), made(level + 1, 2 * k + 1)
        if left[0] == right[0] == "leaf" and left[2] == right[2]:
            return ("leaf", (n, s, q), here)
        return ("node", (n, s, q), here, f, left, right)

    def put(node):
        i = len(rows)
        rows.append(None)
        n, s, q = node[1]
        impurity = (q - s * s / n) / n if n else 0.0
        left = right = -1
        gain, split = -1.0, (-1, [], -1)
        if node[0] == "node":
            j, gain, low_left, _ = node[3]
            feature = int(coding.feature[j])
            if coding.splits[feature] is None:
                split = (feature, [0.0] if low_left else [1.0], 2)
            else:
                split = (feature, [float(coding.splits[feature][coding.rank[j]])], -1)
            left = put(node[4])
            right = put(node[5])
        rows[i] = (tree, (i, float(node[2]), float(impurity), [float(n), float(s), float(q)], int(n), float(gain), left, right, split))
        return i

    put(made(0, 0))
    return rows


@dataclass
class Task:
    """A whole fit's parameters, for the task or the driver that runs it."""
    coding: Coding
    rules: Rules
    rounds: int
    rate: float
    share: float

    def in_task(self, rows: Boosted) -> list[tuple]:
        out = []
        for number in range(self.rounds):
            rows.begin(number, self.share)
            done = 0

            def step(levels):
                nonlocal done
                for level in levels[done:]:
                    rows.descend(level)
                done = len(levels)
                return rows.sums(1 << len(levels))

            splits, levels, value = grown(step, self.coding, self.rules)
            for level in levels[done:]:
                rows.descend(level)
            leaves = rows.finish(value, 1.0 if number == 0 else self.rate)
            out += node_rows(splits, leaves, value, self.coding, number)
        return out

    def over_parts(self, parts, every: int) -> list[tuple]:
        """A job a level over an RDD of :class:`Boosted`, one a partition. The rows with their margins are kept for the jobs of a
        round; every ``every`` rounds they are checkpointed, so that jobs don't carry the rounds before."""
        out, last, held, kept, mark = [], None, parts, None, None
        for number in range(self.rounds):
            state = held.map(_Advance(self, number, last)).persist(StorageLevel.MEMORY_AND_DISK)
            if number % every == 0:
                state.checkpoint()
            found = state.map(lambda x: x[:2]).collect()  # sums of each part
            if last is not None:
                out += node_rows(splits, sum(x[0] for x in found), last[0], self.coding, number - 1)  # noqa: F821
            if kept is not None:
                kept.unpersist()
            if number % every == 0:
                mark = _forgotten(mark, state)
            held, kept = state.map(lambda x: x[2]), state
            first = sum(x[1] for x in found)

            def step(levels, held=held, first=first):
                return sum(held.map(lambda rows: rows.below(levels)).collect()) if levels else first

            splits, levels, value = grown(step, self.coding, self.rules)
            last = (value, levels, 1.0 if number == 0 else self.rate)
        out += node_rows(splits, sum(held.map(lambda rows: rows.passed(last)).collect()), last[0], self.coding, self.rounds - 1)
        kept.unpersist()
        _forgotten(mark, None)
        return out


@dataclass
class _Advance:
    """The last tree added to the margins and round ``number`` begun: (its rows by leaf, sums of the root, the rows)."""
    task: Task
    number: int
    last: tuple | None

    def __call__(self, rows: Boosted) -> tuple:
        leaves = None if self.last is None else rows.passed(self.last)
        rows.begin(self.number, self.task.share)
        sums = rows.sums(1)
        rows.node = rows.target = None  # made again, rather than kept
        return leaves, sums, rows


def _forgotten(mark, state):
    """Removes the files of the checkpoint before; the new one."""
    if mark is not None and mark.getCheckpointFile():
        path, fs = _file_system(SparkSession.builder.getOrCreate(), mark.getCheckpointFile())
        fs.delete(path, True)
    return state


# Fits -------------------------------------------------------------------------------------

def supported(clf, rows: DataFrame) -> bool:
    """Whether ``clf`` is the plain binary boosting that is fitted here."""
    if not isinstance(clf, GBTClassifier) or any(clf.isSet(p) for p in ("weightCol", "validationIndicatorCol", "thresholds", "leafCol")):
        return False
    return (0 < clf.getMaxDepth() <= DEEPEST and clf.getFeatureSubsetStrategy() == "all" and clf.getMinWeightFractionPerNode() == 0
            and clf.getMaxBins() <= CODES and set(binary_slots(rows).values()) <= {2})


def packed(rows: DataFrame, coding: Coding, seed: int, parts: int):
    """RDD of (:class:`Boosted` or None, what is wrong): a partition each, ``parts`` of them at most."""
    def code(batches):
        for batch in batches:
            y = batch.column(0).to_numpy(zero_copy_only=False)
            x = batch.column(1)
            x = x.flatten().to_numpy(zero_copy_only=False).reshape(len(y), -1)
            codes, labels = coding.of(x), np.isin(y, (0.0, 1.0)).all()
            wrong = "labels" if not labels else "units" if codes is None else ""
            row = pickle.dumps((None, None) if wrong else (codes, (2 * y - 1).astype(np.int8)), 5)
            yield pa.RecordBatch.from_pydict({"rows": pa.array([row], pa.binary()), "wrong": [wrong]})

    def whole(number, records):
        codes, labels, wrong = [], [], set()
        for r in records:
            wrong.add(r["wrong"])
            c, y = pickle.loads(r["rows"])
            codes.append(c)
            labels.append(y)
        wrong.discard("")
        if wrong or not codes:
            return [(None, wrong)]
        y = np.concatenate(labels)
        return [(Boosted(np.concatenate(codes, 1), y, seed + number + 1, np.zeros(len(y))), wrong)]

    vectors = rows.select(F.col("label").cast("double").alias("label"), vector_to_array("features").alias("x"))
    return vectors.mapInArrow(code, "rows binary, wrong string").rdd.coalesce(parts).mapPartitionsWithIndex(whole)


def fit(clf: GBTClassifier, rows: DataFrame) -> GBTClassificationModel:
    """``clf`` fitted on (label, features)."""
    scratch_dir(rows.sparkSession)
    n, seed, binary = rows.count(), clf.getSeed(), set(binary_slots(rows))
    rules = Rules(clf.getMaxDepth(), clf.getMinInstancesPerNode(), clf.getMinInfoGain())
    cores = rows.sparkSession.sparkContext.defaultParallelism
    parts = 1 if n <= ROWS_IN_A_TASK else cores * math.ceil(n / (cores * ROWS_IN_A_TASK))
    for grouped in (True, False):
        coding = learned_coding(rows, n, clf.getMaxBins(), seed, binary, grouped)
        task = Task(coding, rules, clf.getMaxIter(), clf.getStepSize(), clf.getSubsamplingRate())
        made = packed(rows, coding, seed, parts)
        if parts == 1:
            (found, wrong), = made.map(lambda x: (None if x[0] is None else task.in_task(x[0]), x[1])).collect()
        else:
            made = made.persist(StorageLevel.MEMORY_AND_DISK)
            wrong = set().union(*made.map(lambda x: x[1]).collect())
            held = made.filter(lambda x: x[0] is not None).map(lambda x: x[0])
            every = clf.getCheckpointInterval()
            found = None if wrong else task.over_parts(held, every if every > 0 else clf.getMaxIter())
            made.unpersist()
        if "labels" in wrong:
            return clf.fit(rows)  # raises as Spark does
        if not wrong:
            return saved_model(clf, rows, found, len(coding.splits))
    raise AssertionError("single slots exclude each other")


def saved_model(clf: GBTClassifier, rows: DataFrame, nodes: list[tuple], n_features: int) -> GBTClassificationModel:
    """Spark's model of the trees, made by writing it as Spark does and loading it."""
    spark, rounds = rows.sparkSession, clf.getMaxIter()
    path = new_scratch_path(spark, "boosted")
    mine = {p.name: v for p, v in clf.extractParamMap().items() if clf.isSet(p)}
    mine |= {"featuresCol": clf.getFeaturesCol(), "labelCol": clf.getLabelCol(), "seed": clf.getSeed()}
    every = {p.name: clf.getOrDefault(p) for p in clf.params if clf.hasDefault(p)}
    about = lambda kind, name, uid, params, default: {
        "class": f"org.apache.spark.ml.{kind}.{name}", "timestamp": int(time.time() * 1000), "sparkVersion": spark.version, "uid": uid,
        "paramMap": params, "defaultParamMap": default}
    head = about("classification", "GBTClassificationModel", clf.uid, mine, every) | {"numFeatures": n_features, "numTrees": rounds}
    of_trees = ("checkpointInterval", "featuresCol", "labelCol", "maxDepth", "maxBins", "minInstancesPerNode", "minInfoGain", "seed")
    own = {k: v for k, v in mine.items() if k in of_trees}
    trees = []
    for k in range(rounds):
        tree = about("regression", "DecisionTreeRegressionModel", f"dtr_{uuid.uuid4().hex[:12]}", own, {k: every[k] for k in of_trees if k in every})
        trees.append((k, json.dumps(tree), 1.0 if k == 0 else clf.getStepSize()))
    spark.createDataFrame([(json.dumps(head),)], "value string").coalesce(1).write.text(f"{path}/metadata")
    spark.createDataFrame(trees, "_1 int, _2 string, _3 double").coalesce(1).write.parquet(f"{path}/treesMetadata")
    spark.createDataFrame(nodes, NODE).coalesce(1).write.parquet(f"{path}/data")
    return GBTClassificationModel.load(path)
