"""Evaluation of a scored table (keys..., label, score, pred): all pure aggregations.

Counts-based metrics are one conditional aggregation per key. Curve metrics (ROC, PR,
AUC, AP) first collapse rows to distinct scores per key — a map-side-combined
aggregation, so a score shared by a third of the rows is one row — and then take exact
running totals with :func:`tessera.operators.ranks.running_totals` (no global window).
Ratios of integer counts are left unrounded: they are the same double in every engine.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.operators.ranks import parallel_buckets, running_totals, value_buckets
from tessera.session import checkpointed


def default_buckets(spark) -> int:
    return parallel_buckets(spark)


def _ratio(a: Column, b: Column) -> Column:
    """a / b, 0 when b is 0 (the zero-division convention of the modelled reports)."""
    return F.coalesce(F.try_divide(a.cast("double"), b.cast("double")), F.lit(0.0))


def counts(df: DataFrame, keys: list[str], label: str = "label", pred: str = "pred") -> DataFrame:
    y, p = F.col(label), F.col(pred)
    return df.groupBy(*keys).agg(
        F.count_if((y == 1) & (p == 1)).alias("tp"), F.count_if((y == 0) & (p == 1)).alias("fp"),
        F.count_if((y == 1) & (p == 0)).alias("fn"), F.count_if((y == 0) & (p == 0)).alias("tn"))


def confusion_counts(df: DataFrame, keys: list[str], label: str = "label", pred: str = "pred") -> DataFrame:
    """Full 2x2 grid per key: (keys, label, pred, n), zero cells included."""
    c = counts(df, keys, label, pred)
    cells = [(0, 0, "tn"), (0, 1, "fp"), (1, 0, "fn"), (1, 1, "tp")]
    recs = F.array(*[F.struct(F.lit(a).alias(label), F.lit(b).alias(pred), F.col(n).alias("n")) for a, b, n in cells])
    return c.select(*keys, F.inline(recs))


def confusion_normalised(df: DataFrame, keys: list[str], label: str = "label", pred: str = "pred") -> DataFrame:
    """Confusion matrix divided by the true-class row total (null for an empty row)."""
    c = counts(df, keys, label, pred)
    neg, pos = F.col("tn") + F.col("fp"), F.col("fn") + F.col("tp")
    cells = [(0, 0, F.col("tn"), neg), (0, 1, F.col("fp"), neg), (1, 0, F.col("fn"), pos), (1, 1, F.col("tp"), pos)]
    recs = F.array(*[F.struct(F.lit(a).alias(label), F.lit(b).alias(pred),
                              F.try_divide(n.cast("double"), d.cast("double")).alias("rate")) for a, b, n, d in cells])
    return c.select(*keys, F.inline(recs))


def metric_columns(digits: int = 6) -> list[Column]:
    tp, fp, fn, tn = (F.col(x) for x in ("tp", "fp", "fn", "tn"))
    n = tp + fp + fn + tn
    f1_1 = _ratio(2 * tp, 2 * tp + fp + fn)
    f1_0 = _ratio(2 * tn, 2 * tn + fn + fp)
    return [
        n.alias("n"),
        _ratio(tp + tn, n).alias("accuracy"),
        _ratio(tp, tp + fp).alias("precision"),
        _ratio(tp, tp + fn).alias("recall"),
        F.round(f1_1, digits).alias("f1"),
        F.round((f1_0 + f1_1) / 2, digits).alias("f1_macro"),
    ]


def binary_metrics(df: DataFrame, keys: list[str], label: str = "label", pred: str = "pred") -> DataFrame:
    c = counts(df, keys, label, pred)
    return c.select(*keys, "tp", "fp", "fn", "tn", *metric_columns())


def classification_report(df: DataFrame, keys: list[str], label: str = "label", pred: str = "pred",
                          digits: int = 6) -> DataFrame:
    """Per-class precision/recall/F1/support, then accuracy, macro and weighted averages."""
    c = counts(df, keys, label, pred)
    tp, fp, fn, tn = (F.col(x) for x in ("tp", "fp", "fn", "tn"))
    n = tp + fp + fn + tn
    p1, r1, f1 = _ratio(tp, tp + fp), _ratio(tp, tp + fn), _ratio(2 * tp, 2 * tp + fp + fn)
    p0, r0, f0 = _ratio(tn, tn + fn), _ratio(tn, tn + fp), _ratio(2 * tn, 2 * tn + fn + fp)
    s1, s0 = tp + fn, tn + fp
    acc = _ratio(tp + tn, n)

    def w(a, b):
        return _ratio(a * s0 + b * s1, n)

    def rec(name, p, r, f, s):
        r_ = (lambda x: F.round(x, digits).cast("double") if x is not None else F.lit(None).cast("double"))
        return F.struct(F.lit(name).alias("class"), r_(p).alias("precision"), r_(r).alias("recall"),
                        r_(f).alias("f1"), s.cast("bigint").alias("support"))
    rows = F.array(
        rec("0", p0, r0, f0, s0), rec("1", p1, r1, f1, s1), rec("accuracy", None, None, acc, n),
        rec("macro avg", (p0 + p1) / 2, (r0 + r1) / 2, (f0 + f1) / 2, n),
        rec("weighted avg", w(p0, p1), w(r0, r1), w(f0, f1), n))
    return c.select(*keys, F.inline(rows))


def score_totals(df: DataFrame, keys: list[str], label: str = "label", score: str = "score",
                 n_buckets: int | None = None, with_next: bool = False) -> DataFrame:
    """Distinct scores per key with positives/negatives and running totals in descending score.

    Columns: keys, score, pos, neg, cum_pos, cum_neg (inclusive, from the top), tot_pos, tot_neg;
    ``with_next`` adds next_pos, next_neg (counts at the next lower score, null at the last).
    A row without a label, or whose score is null or NaN, can't be ranked and takes no part.
    """
    n_buckets = n_buckets or default_buckets(df.sparkSession)
    ranked = F.col(score).isNotNull() & ~F.isnan(F.col(score).cast("double")) & F.col(label).isNotNull()
    src = df.filter(ranked).select(*keys, (-F.col(score)).alias("_neg_score"), F.col(label).cast("long").alias("_y"))
    # one shuffle to distinct scores per key; checkpointed (the sketch and the running
    # totals read it, not the source)
    d = checkpointed(
        src.groupBy(*keys, "_neg_score").agg(F.sum("_y").alias("pos"), F.sum(1 - F.col("_y")).alias("neg"))
        .withColumn("score", F.when(F.col("_neg_score") == 0, F.lit(0.0)).otherwise(-F.col("_neg_score"))))
    d = value_buckets(d, "_neg_score", n_buckets, out="_bucket")
    r = running_totals(d, keys, "_bucket", [F.col("_neg_score")], ["pos", "neg"],
                       next_cols=["pos", "neg"] if with_next else ())
    return r.drop("_neg_score", "_bucket")


def roc_curve(df: DataFrame, keys: list[str], label: str = "label", score: str = "score",
              drop_intermediate: bool = True) -> DataFrame:
    """One point per distinct score (descending) plus the (0, 0) start at threshold +inf.

    ``drop_intermediate`` (the modelled library's default) keeps the first and last point
    and every corner: an inner point stays when the step to the next point differs from
    the step into it, i.e. when the next score's (pos, neg) counts differ from its own.
    Collinear points go; the area is unchanged.
    """
    t = score_totals(df, keys, label, score, with_next=drop_intermediate)
    if drop_intermediate:
        first = (F.col("cum_pos") == F.col("pos")) & (F.col("cum_neg") == F.col("neg"))
        corner = (F.col("next_pos") != F.col("pos")) | (F.col("next_neg") != F.col("neg"))
        t = t.filter(first | F.col("next_pos").isNull() | corner)
    pts = t.select(*keys, F.col("score").alias("threshold"),
                   F.try_divide(F.col("cum_neg").cast("double"), F.col("tot_neg").cast("double")).alias("fpr"),
                   F.try_divide(F.col("cum_pos").cast("double"), F.col("tot_pos").cast("double")).alias("tpr"))
    # keys from the checkpointed distinct-score table: no second pass over the source
    start = t.select(*keys).distinct().select(*keys, F.lit(float("inf")).alias("threshold"),
                                               F.lit(0.0).alias("fpr"), F.lit(0.0).alias("tpr"))
    return pts.unionByName(start)


def roc_auc(df: DataFrame, keys: list[str], label: str = "label", score: str = "score", digits: int = 6) -> DataFrame:
    """Area under ROC, ties counted half: sum over distinct scores of neg * (pos above + pos/2) / (P*N).

    Kept in integers until one final division: 2*sum(neg*(cum_pos - pos) ) + sum(neg*pos) over 2PN.
    """
    t = score_totals(df, keys, label, score)
    num = F.sum(F.col("neg") * (2 * (F.col("cum_pos") - F.col("pos")) + F.col("pos")))
    den = 2 * F.max("tot_pos") * F.max("tot_neg")
    return t.groupBy(*keys).agg(F.round(F.try_divide(num.cast("double"), den.cast("double")), digits).alias("roc_auc"))


def pr_curve(df: DataFrame, keys: list[str], label: str = "label", score: str = "score") -> DataFrame:
    """Precision/recall per distinct score (descending) plus the closing point (recall 0, precision 1)."""
    t = score_totals(df, keys, label, score)
    pts = t.select(*keys, F.col("score").alias("threshold"),
                   _ratio(F.col("cum_pos"), F.col("cum_pos") + F.col("cum_neg")).alias("precision"),
                   F.coalesce(F.try_divide(F.col("cum_pos").cast("double"), F.col("tot_pos").cast("double")),
                              F.lit(1.0)).alias("recall"))
    close = t.select(*keys).distinct().select(*keys, F.lit(None).cast("double").alias("threshold"),
                                               F.lit(1.0).alias("precision"), F.lit(0.0).alias("recall"))
    return pts.unionByName(close)


def average_precision(df: DataFrame, keys: list[str], label: str = "label", score: str = "score",
                      digits: int = 6) -> DataFrame:
    """AP = sum over thresholds of (R_i - R_{i-1}) * P_i = sum(pos/P * precision)."""
    t = score_totals(df, keys, label, score)
    term = F.col("pos").cast("double") / F.col("tot_pos") * (F.col("cum_pos") / (F.col("cum_pos") + F.col("cum_neg")))
    return t.groupBy(*keys).agg(F.round(F.sum(term), digits).alias("average_precision"))


def calibration_table(df: DataFrame, keys: list[str], label: str = "label", score: str = "score", bins: int = 10,
                      digits: int = 6) -> DataFrame:
    """Equal-width bins on [0, 1]; an inner edge belongs to the lower bin; empty bins absent."""
    s = F.col(score)
    b = sum((s > F.lit(k / bins)).cast("int") for k in range(1, bins))
    return df.groupBy(*keys, b.alias("bin")).agg(
        F.round(F.avg(s), digits).alias("mean_score"), F.round(F.avg(F.col(label).cast("double")), digits).alias("frac_pos"),
        F.count(F.lit(1)).alias("n"))


def fairness_audit(df: DataFrame, keys: list[str], groups: list[str], label: str = "label", pred: str = "pred",
                   digits: int = 6) -> DataFrame:
    """Accuracy, F1 and count per value of each group column, in one GROUPING SETS pass."""
    y, p = F.col(label), F.col(pred)
    gs = [[*[F.col(k) for k in keys], F.col(g)] for g in groups]
    agg = df.groupingSets(gs, *[F.col(k) for k in keys], *[F.col(g) for g in groups]).agg(
        *[F.grouping(g).alias("_g_" + g) for g in groups],
        F.count_if((y == 1) & (p == 1)).alias("tp"), F.count_if((y == 0) & (p == 1)).alias("fp"),
        F.count_if((y == 1) & (p == 0)).alias("fn"), F.count_if((y == 0) & (p == 0)).alias("tn"))
    name = None
    for g in groups:
        e = F.concat(F.lit(g + "_"), F.col(g).cast("string"))
        name = F.when(F.col("_g_" + g) == 0, e) if name is None else name.when(F.col("_g_" + g) == 0, e)
    tp, fp, fn, tn = (F.col(x) for x in ("tp", "fp", "fn", "tn"))
    n = tp + fp + fn + tn
    return agg.select(*keys, name.alias("group"), _ratio(tp + tn, n).alias("accuracy"),
                      F.round(_ratio(2 * tp, 2 * tp + fp + fn), digits).alias("f1"), n.alias("n"))


def subgroup_f1(df: DataFrame, keys: list[str], label: str = "label", pred: str = "pred", digits: int = 6) -> DataFrame:
    c = counts(df, keys, label, pred)
    tp, fp, fn = F.col("tp"), F.col("fp"), F.col("fn")
    return c.select(*keys, F.round(_ratio(2 * tp, 2 * tp + fp + fn), digits).alias("f1"),
                    (F.col("tp") + F.col("fp") + F.col("fn") + F.col("tn")).alias("n"))


def model_comparison(df: DataFrame, model: str = "model", label: str = "label", pred: str = "pred",
                     score: str = "score") -> DataFrame:
    """Accuracy, macro F1 and ROC-AUC per model (models are few: the join is on a tiny key)."""
    m = binary_metrics(df, [model], label, pred).select(model, F.round("accuracy", 6).alias("accuracy"), "f1_macro")
    a = roc_auc(df, [model], label, score).withColumnRenamed(model, "_model")
    return m.join(a, F.col(model).eqNullSafe(F.col("_model")), "left").drop("_model")


def best_by(df: DataFrame, name_col: str, metric: str) -> DataFrame:
    """Row with the highest metric (ties: smallest name) via a partial aggregation."""
    key = F.struct((-F.col(metric)).alias("m"), F.col(name_col).alias("n"))
    return df.filter(F.col(metric).isNotNull()).agg(F.min_by(F.struct(name_col, metric), key).alias("b")) \
        .select(F.col("b")[name_col].alias(name_col), F.col("b")[metric].alias(metric))
