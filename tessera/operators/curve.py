"""Learning curves of L2 logistic models, all prefixes of all folds fitted together.

The ``k * steps`` training parts of a curve are prefixes of ``k`` orders over the same rows, so what a fit needs is a sum over rows
that says which prefixes a row is in. Medians, modes, means and deviations of all parts come from counts per fold and first prefix;
the coefficients by Newton steps, where one pass over the rows gives the sums of all fits that are still under way. The number of
passes doesn't follow the number of fits. Standardising and filling are linear in (value, is missing, 1), so one set of coded rows
serves every part: ``Part.to_base`` takes coefficients on a part's own features to coefficients on the coded rows.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import Bucketizer
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.operators import evaluate as V
from tessera.operators.prep import present
from tessera.operators.ranks import quantile_edges
from tessera.session import checkpointed, new_scratch_path

#: More category values than this and the fits run one by one: a Newton step holds a square matrix of the features.
MOST_CATEGORIES = 200
MEDIAN_BUCKETS = 1024
ROWS_A_TASK = 250_000
#: Steps on the Hessians of the first fit before a fit gets its own.
SHARED_STEPS = 4


@dataclass
class Part:
    """A training part: validation fold, step, rows, positives, and its classifier's parameters."""
    fold: int
    step: int
    n: int = 0
    n_pos: int = 0
    reg: float = 0.0
    tol: float = 1e-4
    max_iter: int = 100
    to_base: np.ndarray | None = None


def plain_logistic(clf) -> bool:
    """Whether ``clf`` is the binomial L2 model with an intercept on features as they are, which the joint fit solves."""
    if not isinstance(clf, LogisticRegression) or clf.isSet("weightCol") or clf.isSet("thresholds"):
        return False
    bounds = ("lowerBoundsOnCoefficients", "upperBoundsOnCoefficients", "lowerBoundsOnIntercepts", "upperBoundsOnIntercepts")
    return (not any(clf.isSet(b) for b in bounds) and clf.getElasticNetParam() == 0 and not clf.getStandardization() and clf.getFitIntercept()
            and clf.getRegParam() > 0 and clf.getFamily() in ("auto", "binomial") and clf.getThreshold() == 0.5 and clf.getMaxIter() > 0)


def entered(placed: DataFrame, numeric: list[str], categorical: list[str], k: int, steps: int, n: int, label: str, fold_col: str) -> DataFrame:
    """(label, e0.., x0.., c0..): ``e<f>`` is the first step whose part of fold f has the row (0: the row is in f, steps + 1: none),
    ``x<i>`` and ``c<j>`` the features with missing values as nulls."""
    types = dict(placed.dtypes)

    def entry(f):  # floor(s * n / steps) >= place from s = ceil(place * steps / n) on
        s = F.least(F.lit(steps + 1), F.expr(f"(place_{f} * {steps}L + {n - 1}L) div {n}L")).cast("int")
        return F.when(F.col(fold_col) == f, F.lit(0)).otherwise(s).alias(f"e{f}")

    return placed.filter(F.col(fold_col).isNotNull()).select(
        F.col(label).alias("label"), *[entry(f) for f in range(k)],
        *[present(c, types[c]).cast("double").alias(f"x{i}") for i, c in enumerate(numeric)],
        *[F.col(c).cast("string").alias(f"c{j}") for j, c in enumerate(categorical)])


def per_entry(cells: DataFrame, keys: list[str], k: int, steps: int) -> pd.DataFrame:
    """Counts ``n`` of cells (rows of equal e0..) summed by fold and first step: at most k * steps rows a key."""
    at = F.explode(F.array(*[F.struct(F.lit(f).alias("f"), F.col(f"e{f}").alias("e")) for f in range(k)])).alias("_at")
    long = cells.select(*keys, "n", at).filter(F.col("_at.e").between(1, steps))
    return long.groupBy(*keys, F.col("_at.f").alias("f"), F.col("_at.e").alias("e")).agg(F.sum("n").alias("n")).toPandas()


def medians(rows: DataFrame, n_numeric: int, k: int, steps: int) -> np.ndarray:
    """Exact medians [fold, step, column] (NaN: no value) as :func:`tessera.operators.ranks.exact_quantiles` has them: counts per
    bucket of values give the buckets that hold a part's middle values, and only rows of those are ranked."""
    if not n_numeric:
        return np.zeros((k, steps, 0))
    es, xs = [f"e{f}" for f in range(k)], [f"x{i}" for i in range(n_numeric)]
    edges = quantile_edges(rows, xs, MEDIAN_BUCKETS)
    splits = [[-np.inf] + (edges[x] or [0.0]) + [np.inf] for x in xs]
    width = max(map(len, splits))
    placed = Bucketizer(splitsArray=splits, inputCols=xs, outputCols=[f"b{i}" for i in range(n_numeric)], handleInvalid="keep").transform(rows)
    values = F.inline(F.array(*[F.struct(F.lit(i).alias("i"), F.col(f"b{i}").cast("int").alias("b"), F.col(x).alias("v")) for i, x in enumerate(xs)]))
    long = placed.select(*es, values).filter("v IS NOT NULL")
    found = per_entry(long.groupBy(*es, "i", "b").agg(F.count(F.lit(1)).alias("n")), ["i", "b"], k, steps)
    counts = np.zeros((k, steps, n_numeric, width), dtype=np.int64)
    counts[found["f"], found["e"] - 1, found["i"], found["b"]] = found["n"]
    upto = counts.cumsum(axis=1).cumsum(axis=3)
    total = upto[..., -1]
    wanted: dict = {}
    for f, s, i in np.ndindex(total.shape):
        for side, rank in enumerate(((total[f, s, i] - 1) // 2, total[f, s, i] // 2) if total[f, s, i] else ()):
            b = int(np.searchsorted(upto[f, s, i], rank, side="right"))
            before = int(upto[f, s, i, b - 1]) if b else 0
            wanted.setdefault((i, b, f), []).append((s, side, int(rank) - before))

    def ranked(key, pdf):
        pdf = pdf.sort_values("v")
        v, e, c = (pdf[x].to_numpy() for x in ("v", "e", "n"))
        out = []
        for s, side, rank in wanted[tuple(int(x) for x in key)]:
            out.append((int(key[2]), s, int(key[0]), side, float(v[np.searchsorted(np.where(e <= s + 1, c, 0).cumsum(), rank, side="right")])))
        return pd.DataFrame(out, columns=["f", "s", "i", "side", "v"])

    out = np.full((k, steps, n_numeric, 2), np.nan)
    if wanted:
        held = {}
        for i, b, _ in wanted:
            held.setdefault(i, set()).add(b)
        near = F.lit(False)
        for i, bs in held.items():
            near = near | ((F.col("i") == i) & F.col("b").isin(sorted(bs)))
        at = F.explode(F.array(*[F.struct(F.lit(f).alias("f"), F.col(f"e{f}").alias("e")) for f in range(k)])).alias("_at")
        per = long.filter(near).groupBy(*es, "i", "b", "v").agg(F.count(F.lit(1)).alias("n")).select("i", "b", "v", "n", at)
        per = per.select("i", "b", F.col("_at.f").alias("f"), F.col("_at.e").alias("e"), "v", "n").filter(F.col("e").between(1, steps))
        needed = F.array(*[F.lit(f"{i},{b},{f}") for i, b, f in sorted(wanted)])
        per = per.filter(F.array_contains(needed, F.concat_ws(",", "i", "b", "f")))
        got = per.groupBy("i", "b", "f").applyInPandas(ranked, "f int, s int, i int, side int, v double").toPandas()
        out[got["f"], got["s"], got["i"], got["side"]] = got["v"]
    return out[..., 0] + (out[..., 1] - out[..., 0]) * 0.5


def moments(cells: pd.DataFrame, take: np.ndarray, i: int) -> tuple[float, float, float]:
    """(present values, mean, sum of squares around it) of column i over the cells taken."""
    n = np.where(take, cells[f"n{i}"], 0).astype(float)
    total = n.sum()
    if not total:
        return 0.0, 0.0, 0.0
    m, var = (np.where(n > 0, cells[f"{x}{i}"].to_numpy(dtype=float), 0.0) for x in "mv")
    mean = (n * m).sum() / total
    return total, mean, (n * (var + (m - mean) ** 2)).sum()


def design(batch: pa.RecordBatch, k: int, sizes: list[int], n_numeric: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(coded features, entries, labels) of a batch: 1, then (value or 0, is missing) a column, then one-hot with missing first."""
    col = lambda name: batch.column(batch.schema.get_field_index(name)).to_numpy(zero_copy_only=False)
    z = np.zeros((batch.num_rows, 1 + 2 * n_numeric + sum(c + 1 for c in sizes)))
    z[:, 0] = 1
    for i in range(n_numeric):
        u = col(f"x{i}")
        miss = np.isnan(u)
        z[:, 1 + 2 * i], z[:, 2 + 2 * i] = np.where(miss, 0, u), miss
    base, at = 1 + 2 * n_numeric, np.arange(batch.num_rows)
    for j, c in enumerate(sizes):
        z[at, base + col(f"c{j}")] = 1
        base += c + 1
    return z, np.column_stack([col(f"e{f}") for f in range(k)]), col("label").astype(float)


def ordered(z, e, y, f: int, steps: int):
    """Rows of fold f's training parts by first step, and where each step ends."""
    order = np.argsort(e[:, f], kind="stable")
    ends = np.searchsorted(e[order, f], np.arange(steps + 1), side="right")
    own = order[ends[0]:ends[-1]]
    return z[own], y[own], ends - ends[0]


def loss_sums(rows: DataFrame, theta: dict, hess: set, k: int, steps: int, sizes: list[int], n_numeric: int, shared: bool = False) -> dict:
    """{(f, s): (loss, gradient, Hessian or None)} on coded features, summed over the rows of each part, at ``theta[(f, s)]``.
    ``shared``: all thetas are equal, so a row is looked at once a fold and the sums run over the steps."""
    width = 1 + 2 * n_numeric + sum(c + 1 for c in sizes)

    def partial(batches):
        acc = {key: np.zeros(1 + width + (width * width if key in hess else 0)) for key in theta}
        for batch in batches:
            z_all, e, y_all = design(batch, k, sizes, n_numeric)
            for f in {f for f, _ in theta}:
                zf, yf, ends = ordered(z_all, e, y_all, f, steps)
                for s in range(1, steps + 1):
                    if (f, s) not in theta:
                        continue
                    a = acc[f, s]
                    z, y = zf[ends[s - 1] if shared else 0:ends[s]], yf[ends[s - 1] if shared else 0:ends[s]]
                    m = z @ theta[f, s]
                    p = 0.5 * (1 + np.tanh(0.5 * m))
                    a[0] += np.logaddexp(0, m).sum() - y @ m
                    a[1:1 + width] += (p - y) @ z
                    if (f, s) in hess:
                        a[1 + width:] += (z.T @ (z * (p * (1 - p))[:, None])).ravel()
        keys = sorted(acc)
        yield pa.RecordBatch.from_arrays([pa.array([f * (steps + 1) + s for f, s in keys], pa.int32()),
                                          pa.array([acc[x] for x in keys], pa.list_(pa.float64()))], names=["part", "sums"])

    def total(pdf):
        return pd.DataFrame({"part": pdf["part"].iloc[:1], "sums": [np.sum(np.stack(pdf["sums"].to_list()), axis=0)]})

    schema = "part int, sums array<double>"
    got = rows.mapInArrow(partial, schema).groupBy("part").applyInPandas(total, schema).collect()  # a row a part
    found = {divmod(r["part"], steps + 1): np.array(r["sums"]) for r in got}
    if shared:
        for f, s in sorted(found):
            if (f, s - 1) in found:
                found[f, s] = found[f, s] + found[f, s - 1]
    return {key: (a[0], a[1:1 + width], a[1 + width:].reshape(width, width) if key in hess else None) for key, a in found.items()}


def newton(evaluate, parts: dict, start: dict, shared: dict | None = None) -> dict:
    """Coefficients of each part by Newton steps on its mean loss + reg / 2 |w|^2 (intercept free): on the Hessian given in
    ``shared`` for ``SHARED_STEPS`` steps, else on its own. A step that doesn't lower the loss enough is halved."""
    w, at, hessian = dict(start), {}, dict(shared or {})
    own, used, left = {key: key not in hessian for key in start}, dict.fromkeys(start, 0), set(start)
    for _ in range(max((parts[key].max_iter for key in start), default=0)):
        found = evaluate({key: w[key] for key in left}, {key for key in left if own[key]})
        for key in sorted(left):
            part, (loss, g, h) = parts[key], found[key]
            free = np.r_[0.0, np.full(len(w[key]) - 1, part.reg)]
            loss = loss / part.n + 0.5 * (free * w[key] ** 2).sum()
            used[key] += 1
            if not np.isfinite(loss) and key not in at:
                raise ValueError(f"learning curve: features of fold {part.fold}, step {part.step} aren't finite")
            if key in at and not loss <= at[key][1] + 1e-4 * at[key][3] * at[key][4] + 1e-14 * abs(at[key][1]):
                w0, _, d, t, _ = at[key]
                if not own[key]:  # back to where it was, with its own Hessian
                    own[key], w[key] = True, w0
                    del at[key]
                elif t < 1e-9:
                    w[key] = w0
                    left.discard(key)
                else:
                    at[key] = (*at[key][:3], t / 2, at[key][4])
                    w[key] = w0 + t / 2 * d
            else:
                g = part.to_base.T @ g / part.n + free * w[key]
                if h is not None:
                    hessian[key] = part.to_base.T @ h @ part.to_base / part.n + np.diag(free)
                d = -np.linalg.lstsq(hessian[key], g, rcond=None)[0]
                slope = float(g @ d)
                at[key] = (w[key], loss, d, 1.0, slope)
                if -slope / 2 <= max(1e-6 * part.tol * abs(loss), 1e-15):
                    left.discard(key)
                elif not own[key] and used[key] >= SHARED_STEPS:
                    own[key] = True
                    w[key] = w[key] + d
                    del at[key]
                else:
                    w[key] = w[key] + d
            if used[key] >= part.max_iter:
                left.discard(key)
        if not left:
            break
    return w


def confusion(rows: DataFrame, theta: dict, k: int, steps: int, sizes: list[int], n_numeric: int) -> DataFrame:
    """(fold, step, part, tp, fp, fn, tn) of the models at ``theta`` on the rows of their training part and of their fold."""
    def partial(batches):
        acc = np.zeros((k, steps, 2, 2, 2), dtype=np.int64)  # label, prediction
        for batch in batches:
            z_all, e, y_all = design(batch, k, sizes, n_numeric)
            for f in range(k):
                zf, yf, ends = ordered(z_all, e, y_all, f, steps)
                held = e[:, f] == 0
                zv, yv = z_all[held], y_all[held] == 1
                for s in range(1, steps + 1):
                    for v, y, z in ((0, yf[:ends[s]] == 1, zf[:ends[s]]), (1, yv, zv)):
                        pos = z @ theta[f, s] > 0
                        tp, p, t = np.count_nonzero(pos & y), np.count_nonzero(pos), np.count_nonzero(y)
                        acc[f, s - 1, v] += np.array([[len(y) - t - p + tp, p - tp], [t - tp, tp]])
        keys = list(np.ndindex(k, steps, 2))
        cols = [[f for f, _, _ in keys], [s + 1 for _, s, _ in keys], [("train", "valid")[v] for _, _, v in keys]]
        cells = [[int(acc[x][a, b]) for x in keys] for a, b in ((1, 1), (0, 1), (1, 0), (0, 0))]
        yield pa.RecordBatch.from_arrays([pa.array(cols[0], pa.int32()), pa.array(cols[1], pa.int32()), pa.array(cols[2]),
                                          *[pa.array(c, pa.int64()) for c in cells]], names=["fold", "step", "part", "tp", "fp", "fn", "tn"])

    out = rows.mapInArrow(partial, "fold int, step int, part string, tp long, fp long, fn long, tn long")
    return out.groupBy("fold", "step", "part").agg(*[F.sum(c).alias(c) for c in ("tp", "fp", "fn", "tn")]).filter("tp + fp + fn + tn > 0")


def joint_scores(placed: DataFrame, numeric: list[str], categorical: list[str], make_clf, k: int, steps: int, n: int,
                 label: str = "label", fold_col: str = "fold") -> tuple[DataFrame, dict, dict] | None:
    """(metrics by fold, step and part; parts; coefficients on each part's own features), or None where the joint fit doesn't apply:
    another classifier, labels other than 0 and 1, or more category values than ``MOST_CATEGORIES``."""
    if n < steps or not plain_logistic(make_clf(n)):
        return None
    rows = entered(placed, numeric, categorical, k, steps, n, label, fold_col)
    es = [f"e{f}" for f in range(k)]
    xs = [f"x{i}" for i in range(len(numeric))]
    cells = rows.groupBy(*es).agg(
        F.count(F.lit(1)).alias("n"), F.sum(F.col("label").cast("long")).alias("pos"), F.count_if(F.col("label").isin(0, 1)).alias("binary"),
        *[a for i, x in enumerate(xs) for a in (F.count(x).alias(f"n{i}"), F.avg(x).alias(f"m{i}"), F.var_pop(x).alias(f"v{i}"),
                                               F.min(x).alias(f"lo{i}"), F.max(x).alias(f"hi{i}"))]).toPandas()
    if int(cells["binary"].sum()) != int(cells["n"].sum()):
        return None
    long = F.inline(F.array(*[F.struct(F.lit(j).alias("j"), F.col(f"c{j}").alias("v")) for j in range(len(categorical))]))
    values, modes = [[] for _ in categorical], np.full((k, steps, len(categorical)), -1)
    if categorical:
        per = checkpointed(rows.select(*es, long).filter("v IS NOT NULL").groupBy(*es, "j", "v").agg(F.count(F.lit(1)).alias("n")))
        seen = per.select("j", "v").distinct().limit(MOST_CATEGORIES + 1).collect()
        if len(seen) > MOST_CATEGORIES:
            return None
        for j, v in sorted(((r["j"], r["v"]) for r in seen), key=lambda x: (x[0], x[1].encode())):
            values[j].append(v)
        found = per_entry(per, ["j", "v"], k, steps)
        for j, own in enumerate(values):
            place = {v: i for i, v in enumerate(own)}
            count = np.zeros((k, steps, len(own) + 1), dtype=np.int64)
            part = found[found["j"] == j]
            count[part["f"], part["e"] - 1, part["v"].map(place).astype(int)] = part["n"]
            count = count.cumsum(axis=1)
            modes[:, :, j] = np.where(count.max(axis=2) > 0, count.argmax(axis=2), -1)  # ties: the smallest value

    med = medians(rows, len(numeric), k, steps)
    sizes, everywhere = [len(v) for v in values], np.full(len(cells), True)
    scale = []
    for i in range(len(numeric)):
        m, mean, square = moments(cells, everywhere, i)
        if not np.isfinite([mean, square]).all():
            raise ValueError(f"learning curve: {numeric[i]} has values that aren't finite")
        scale.append((mean, (square / m) ** 0.5 if square > 0 else 1.0))
    parts = {(f, s): part_of(cells, f, s, make_clf, med[f, s - 1], modes[f, s - 1], scale, sizes) for f in range(k) for s in range(1, steps + 1)}

    code = [F.coalesce(F.array_position(F.array(*[F.lit(v) for v in own]), F.col(f"c{j}")), F.lit(0)).cast("int") if own else F.lit(0)
            for j, own in enumerate(values)]
    coded = rows.select(F.col("label").cast("int").alias("label"), *es, *[((F.col(x) - m) / d).alias(x) for x, (m, d) in zip(xs, scale)],
                        *[c.alias(f"c{j}") for j, c in enumerate(code)])
    cores, total = placed.sparkSession.sparkContext.defaultParallelism, int(cells["n"].sum())
    path = new_scratch_path(placed.sparkSession, "coded")
    coded.repartition(cores * max(1, -(-total // (cores * ROWS_A_TASK)))).write.parquet(path)
    coded = placed.sparkSession.read.parquet(path)

    def at(w):
        return {key: parts[key].to_base @ v for key, v in w.items()}

    def evaluate(w, hess):
        return loss_sums(coded, at(w), hess, k, steps, sizes, len(numeric))

    zero = np.zeros(1 + len(numeric) + sum(sizes))
    w = {key: np.r_[np.inf if p.n_pos else -np.inf, zero[1:]] for key, p in parts.items() if p.n_pos in (0, p.n)}  # one class only
    mixed = [key for key in parts if key not in w]
    if mixed:
        first = max(mixed, key=lambda key: (key[1], -key[0]))
        lead = newton(evaluate, parts, {first: zero})[first]
        theta = parts[first].to_base @ lead
        sums = loss_sums(coded, dict.fromkeys([(f, s) for f in range(k) for s in range(1, steps + 1)], theta), set(parts), k, steps, sizes, len(numeric), shared=True)
        hessians = {key: parts[key].to_base.T @ sums[key][2] @ parts[key].to_base / parts[key].n
                    + np.diag(np.r_[0.0, np.full(len(zero) - 1, parts[key].reg)]) for key in mixed}
        w |= newton(evaluate, parts, dict.fromkeys(mixed, lead), hessians)
    sure = {key: np.r_[np.sign(v[0]), zero[1:]] if np.isinf(v[0]) else v for key, v in w.items()}
    out = confusion(coded, at(sure), k, steps, sizes, len(numeric))
    return out.select("fold", "step", "part", *V.metric_columns()), parts, w


def part_of(cells: pd.DataFrame, f: int, s: int, make_clf, med, modes, scale, sizes: list[int]) -> Part:
    """Sizes, parameters and preprocessing of one training part."""
    take = cells[f"e{f}"].between(1, s).to_numpy()
    n, pos = int(cells["n"][take].sum()), int(cells["pos"][take].sum())
    clf = make_clf(max(1, n))
    part = Part(f, s, n, pos, clf.getRegParam(), clf.getTol(), clf.getMaxIter())
    to = np.zeros((1 + 2 * len(scale) + sum(c + 1 for c in sizes), 1 + len(scale) + sum(sizes)))
    to[0, 0] = 1
    for i, (centre, spread) in enumerate(scale):
        m, mean, square = moments(cells, take, i)
        if not m:
            raise ValueError(f"learning curve: numeric column {i} has no value in fold {f}, step {s}")
        miss = n - m
        whole = (m * mean + miss * med[i]) / n
        std = ((square + m * (mean - whole) ** 2 + miss * (med[i] - whole) ** 2) / n) ** 0.5
        if std == 0 or cells[f"lo{i}"][take].min() == cells[f"hi{i}"][take].max():  # a constant column is divided by 1
            whole, std = med[i], 1.0
        to[0, 1 + i], to[1 + 2 * i, 1 + i], to[2 + 2 * i, 1 + i] = (centre - whole) / std, spread / std, (med[i] - centre) / std
    row, col = 1 + 2 * len(scale), 1 + len(scale)
    for j, c in enumerate(sizes):
        to[row + 1:row + 1 + c, col:col + c] = np.eye(c)
        if modes[j] >= 0:
            to[row, col + modes[j]] = 1
        row, col = row + c + 1, col + c
    part.to_base = to
    return part
