"""Evaluation queries (V1-V17, A2-A3, O2-O3, J2) over the scored table."""

from __future__ import annotations

from pyspark.sql import functions as F

from tessera.operators import evaluate as V
from tessera.plans.catalog import features, query, scored
from tessera.plans.views import with_views

W = with_views("scored")
MODELS = ["logistic", "forest", "boosted"]

# Shared oracle fragments.
_COUNTS = """c AS (SELECT model, CAST(count_if(label = 1 AND pred = 1) AS BIGINT) AS tp,
  CAST(count_if(label = 0 AND pred = 1) AS BIGINT) AS fp, CAST(count_if(label = 1 AND pred = 0) AS BIGINT) AS fn,
  CAST(count_if(label = 0 AND pred = 0) AS BIGINT) AS tn FROM scored GROUP BY model)"""


def _r(a: str, b: str) -> str:
    return f"(CASE WHEN ({b}) = 0 THEN 0.0 ELSE CAST({a} AS DOUBLE) / CAST({b} AS DOUBLE) END)"


_METRICS = (f"tp + fp + fn + tn AS n, {_r('tp + tn', 'tp + fp + fn + tn')} AS accuracy, {_r('tp', 'tp + fp')} AS precision, "
            f"{_r('tp', 'tp + fn')} AS recall, round({_r('2 * tp', '2 * tp + fp + fn')}, 6) AS f1, "
            f"round(({_r('2 * tn', '2 * tn + fn + fp')} + {_r('2 * tp', '2 * tp + fp + fn')}) / 2, 6) AS f1_macro")

_TOTALS = """d AS (SELECT model, score, CAST(sum(label) AS BIGINT) AS pos, CAST(sum(1 - label) AS BIGINT) AS neg
  FROM scored GROUP BY model, score),
t AS (SELECT model, score, pos, neg,
  sum(pos) OVER (PARTITION BY model ORDER BY score DESC ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS cum_pos,
  sum(neg) OVER (PARTITION BY model ORDER BY score DESC ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS cum_neg,
  sum(pos) OVER (PARTITION BY model) AS tot_pos, sum(neg) OVER (PARTITION BY model) AS tot_neg FROM d)"""

_AUC = "a AS (SELECT model, round(CAST(sum(neg * (2 * (cum_pos - pos) + pos)) AS DOUBLE) / " \
       "CAST(2 * max(tot_pos) * max(tot_neg) AS DOUBLE), 6) AS roc_auc FROM t GROUP BY model)"


def _w(*ctes: str) -> str:
    return W.rstrip() + ",\n" + ",\n".join(ctes) + "\n"


@query("confusion_counts", _w(_COUNTS) + " UNION ALL ".join(
    f"SELECT model, {a} AS label, {b} AS pred, {n} AS n FROM c" for a, b, n in
    [(0, 0, "tn"), (0, 1, "fp"), (1, 0, "fn"), (1, 1, "tp")]))
def q_confusion(spark, sf):
    return V.confusion_counts(scored(spark, sf), ["model"])


@query("confusion_normalised", _w(_COUNTS) + " UNION ALL ".join(
    f"SELECT model, {a} AS label, {b} AS pred, CAST({n} AS DOUBLE) / nullif({d}, 0) AS rate FROM c" for a, b, n, d in
    [(0, 0, "tn", "tn + fp"), (0, 1, "fp", "tn + fp"), (1, 0, "fn", "fn + tp"), (1, 1, "tp", "fn + tp")]))
def q_confusion_norm(spark, sf):
    return V.confusion_normalised(scored(spark, sf), ["model"])


@query("binary_metrics", _w(_COUNTS) + f"SELECT model, tp, fp, fn, tn, {_METRICS} FROM c")
def q_binary_metrics(spark, sf):
    return V.binary_metrics(scored(spark, sf), ["model"])


def _report_sql() -> str:
    p1, r1, f1 = _r("tp", "tp + fp"), _r("tp", "tp + fn"), _r("2 * tp", "2 * tp + fp + fn")
    p0, r0, f0 = _r("tn", "tn + fn"), _r("tn", "tn + fp"), _r("2 * tn", "2 * tn + fn + fp")
    n = "(tp + fp + fn + tn)"

    def w(a, b):
        return f"(CASE WHEN {n} = 0 THEN 0.0 ELSE ({a} * (tn + fp) + {b} * (tp + fn)) / CAST({n} AS DOUBLE) END)"

    rows = [("'0'", p0, r0, f0, "tn + fp"), ("'1'", p1, r1, f1, "tp + fn"),
            ("'accuracy'", "NULL", "NULL", _r("tp + tn", n), n),
            ("'macro avg'", f"({p0} + {p1}) / 2", f"({r0} + {r1}) / 2", f"({f0} + {f1}) / 2", n),
            ("'weighted avg'", w(p0, p1), w(r0, r1), w(f0, f1), n)]
    return _w(_COUNTS) + "\nUNION ALL\n".join(
        f"SELECT model, {c} AS class, round(CAST({p} AS DOUBLE), 6) AS precision, round(CAST({r} AS DOUBLE), 6) AS recall, "
        f"round(CAST({f} AS DOUBLE), 6) AS f1, CAST({s} AS BIGINT) AS support FROM c" for c, p, r, f, s in rows)


@query("classification_report", _report_sql())
def q_report(spark, sf):
    return V.classification_report(scored(spark, sf), ["model"])


@query("roc_curve", _w(_TOTALS) + """, n AS (SELECT t.*,
  lead(pos) OVER (PARTITION BY model ORDER BY score DESC) AS next_pos,
  lead(neg) OVER (PARTITION BY model ORDER BY score DESC) AS next_neg FROM t)
SELECT model, score AS threshold, CAST(cum_neg AS DOUBLE) / tot_neg AS fpr,
  CAST(cum_pos AS DOUBLE) / tot_pos AS tpr FROM n
WHERE (cum_pos = pos AND cum_neg = neg) OR next_pos IS NULL OR next_pos <> pos OR next_neg <> neg
UNION ALL SELECT DISTINCT model, CAST('infinity' AS DOUBLE), CAST(0 AS DOUBLE), CAST(0 AS DOUBLE) FROM scored""")
def q_roc_curve(spark, sf):
    return V.roc_curve(scored(spark, sf), ["model"])


@query("roc_auc", _w(_TOTALS, _AUC) + "SELECT model, roc_auc FROM a")
def q_roc_auc(spark, sf):
    return V.roc_auc(scored(spark, sf), ["model"])


@query("pr_curve", _w(_TOTALS) + """SELECT model, score AS threshold, CAST(cum_pos AS DOUBLE) / (cum_pos + cum_neg) AS precision,
  coalesce(CAST(cum_pos AS DOUBLE) / nullif(tot_pos, 0), 1.0) AS recall FROM t
UNION ALL SELECT DISTINCT model, CAST(NULL AS DOUBLE), CAST(1 AS DOUBLE), CAST(0 AS DOUBLE) FROM scored""")
def q_pr_curve(spark, sf):
    return V.pr_curve(scored(spark, sf), ["model"])


@query("average_precision", _w(_TOTALS) + "SELECT model, round(sum(CAST(pos AS DOUBLE) / tot_pos * "
       "(CAST(cum_pos AS DOUBLE) / (cum_pos + cum_neg))), 6) AS average_precision FROM t GROUP BY model")
def q_ap(spark, sf):
    return V.average_precision(scored(spark, sf), ["model"])


_BIN_SQL = " + ".join(f"(CASE WHEN score > CAST({k / 10} AS DOUBLE) THEN 1 ELSE 0 END)" for k in range(1, 10))


@query("calibration_table", W + f"SELECT model, CAST({_BIN_SQL} AS INT) AS bin, round(avg(score), 6) AS mean_score, "
       "round(avg(CAST(label AS DOUBLE)), 6) AS frac_pos, count(*) AS n FROM scored GROUP BY model, 2")
def q_calibration(spark, sf):
    return V.calibration_table(scored(spark, sf), ["model"])


@query("fairness_audit", W + f"""SELECT model, CASE WHEN grouping(grp) = 0 THEN concat('grp_', grp)
  ELSE concat('tier_', CAST(tier AS VARCHAR)) END AS subgroup,
  {_r('count_if(label = pred)', 'count(*)')} AS accuracy,
  round({_r('2 * count_if(label = 1 AND pred = 1)', '2 * count_if(label = 1 AND pred = 1) + count_if(label <> pred)')}, 6) AS f1,
  count(*) AS n FROM scored GROUP BY GROUPING SETS ((model, grp), (model, tier))""")
def q_fairness(spark, sf):
    return V.fairness_audit(scored(spark, sf), ["model"], ["grp", "tier"]).withColumnRenamed("group", "subgroup")


_SUB = f"""s AS (SELECT model, grp, tier, round({_r('2 * count_if(label = 1 AND pred = 1)',
                                                   '2 * count_if(label = 1 AND pred = 1) + count_if(label <> pred)')}, 6) AS f1,
  count(*) AS n FROM scored GROUP BY model, grp, tier)"""


@query("subgroup_f1", _w(_SUB) + "SELECT model, grp, tier, f1, n FROM s")
def q_subgroup_f1(spark, sf):
    return V.subgroup_f1(scored(spark, sf), ["model", "grp", "tier"])


@query("subgroup_f1_pivot", _w(_SUB) + "SELECT model, grp, max(CASE WHEN tier = 1 THEN f1 END) AS tier_1, "
       "max(CASE WHEN tier = 2 THEN f1 END) AS tier_2, max(CASE WHEN tier = 3 THEN f1 END) AS tier_3 FROM s GROUP BY model, grp")
def q_subgroup_pivot(spark, sf):
    s = V.subgroup_f1(scored(spark, sf), ["model", "grp", "tier"])
    p = s.groupBy("model", "grp").pivot("tier", [1, 2, 3]).agg(F.first("f1"))
    return p.select("model", "grp", *[F.col(str(t)).alias(f"tier_{t}") for t in (1, 2, 3)])


_MC = "mc AS (SELECT c.model, round(" + _r("tp + tn", "tp + fp + fn + tn") + ", 6) AS accuracy, " \
      "round((" + _r("2 * tn", "2 * tn + fn + fp") + " + " + _r("2 * tp", "2 * tp + fp + fn") + ") / 2, 6) AS f1_macro, " \
      "a.roc_auc FROM c JOIN a ON c.model = a.model)"


@query("model_comparison", _w(_COUNTS, _TOTALS, _AUC, _MC) + "SELECT model, accuracy, f1_macro, roc_auc FROM mc")
def q_model_comparison(spark, sf):
    return V.model_comparison(scored(spark, sf))


@query("model_comparison_wide", _w(_COUNTS, _TOTALS, _AUC, _MC) + " UNION ALL ".join(
    f"SELECT '{m}' AS metric, max(CASE WHEN model = 'logistic' THEN {m} END) AS logistic, "
    f"max(CASE WHEN model = 'forest' THEN {m} END) AS forest, max(CASE WHEN model = 'boosted' THEN {m} END) AS boosted FROM mc"
    for m in ("accuracy", "f1_macro", "roc_auc")))
def q_model_comparison_wide(spark, sf):
    mc = V.model_comparison(scored(spark, sf))
    long = mc.unpivot(["model"], ["accuracy", "f1_macro", "roc_auc"], "metric", "value")
    return long.groupBy("metric").pivot("model", MODELS).agg(F.first("value"))


@query("best_model", _w(_COUNTS, _TOTALS, _AUC, _MC) + "SELECT model, roc_auc FROM mc ORDER BY roc_auc DESC, model LIMIT 1")
def q_best_model(spark, sf):
    return V.best_by(V.model_comparison(scored(spark, sf)), "model", "roc_auc")


_IMP_METRICS = ["accuracy", "precision", "recall", "f1", "f1_macro", "roc_auc"]


@query("metric_improvement", _w(_COUNTS, _TOTALS, _AUC, f"bm AS (SELECT c.model, {_METRICS}, a.roc_auc FROM c JOIN a ON c.model = a.model)")
       + " UNION ALL ".join(
    f"SELECT '{m}' AS metric, max(CASE WHEN model = 'logistic' THEN {m} END) AS logistic, "
    f"max(CASE WHEN model = 'forest' THEN {m} END) AS forest, round(max(CASE WHEN model = 'forest' THEN {m} END) - "
    f"max(CASE WHEN model = 'logistic' THEN {m} END), 6) AS improvement FROM bm" for m in _IMP_METRICS))
def q_improvement(spark, sf):
    s = scored(spark, sf).filter(F.col("model").isin("logistic", "forest"))
    bm = V.binary_metrics(s, ["model"]).join(V.roc_auc(s, ["model"]), "model")
    long = bm.unpivot(["model"], _IMP_METRICS, "metric", "value")
    w = long.groupBy("metric").pivot("model", ["logistic", "forest"]).agg(F.first("value"))
    return w.withColumn("improvement", F.round(F.col("forest") - F.col("logistic"), 6))


@query("topk_scores", W + "SELECT model, subject_id, score FROM (SELECT model, subject_id, score, row_number() OVER "
       "(PARTITION BY model ORDER BY score DESC, subject_id) AS rk FROM scored) x WHERE rk <= 5")
def q_topk_scores(spark, sf):
    """Top 5 rows per model by score: a per-group top-k that stays partitioned by model."""
    from pyspark.sql import Window
    s = scored(spark, sf)
    w = Window.partitionBy("model").orderBy(F.desc("score"), "subject_id")
    return s.withColumn("rk", F.row_number().over(w)).filter(F.col("rk") <= 5).select("model", "subject_id", "score")


@query("attach_predictions", with_views("features", "scored") +
       "SELECT f.subject_id, f.label, f.grp, f.tier, f.title, s.score, s.pred FROM features f "
       "JOIN scored s ON f.subject_id = s.subject_id WHERE s.model = 'logistic'")
def q_attach(spark, sf):
    f = features(spark, sf).select("subject_id", "label", "grp", "tier", "title")
    s = scored(spark, sf).filter(F.col("model") == "logistic").select("subject_id", "score", "pred")
    return f.join(s, "subject_id")
