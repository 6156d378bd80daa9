"""Evaluation and explanation of fitted models on the hold-out rows (V1-V17, H3-H7 beyond the stand-in scores).

The logistic preset is fitted on the training rows of the split; its hold-out scores go through the same operators as the
stand-in scores of :mod:`tessera.plans.q_eval`. Rows-only: a fitted model has no SQL form.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from tessera.operators import evaluate as V
from tessera.operators import explain as H
from tessera.operators import train as M
from tessera.plans.catalog import query
from tessera.plans.q_explain import q_attr_logistic
from tessera.plans.q_train import CATEGORICAL, NUMERIC, split_frames

KEEP = ["subject_id", "label", "grp", "tier"]


def holdout_scores(spark, sf, families=("logistic",)):
    """Hold-out rows scored by each family, fitted with its preset: (subject_id, label, grp, tier, score, pred, model)."""
    train, test, _ = split_frames(spark, sf)
    makers = {"logistic": lambda p: M.logistic(M.training_rows(train), **p), "forest": lambda p: M.forest(**p),
              "boosted": lambda p: M.boosted(**p)}
    out = None
    for name in families:
        model = M.fit(train, NUMERIC, CATEGORICAL, makers[name](M.PRESETS[name]))
        scored = M.predict(model, M.spread(test) if name == "forest" else test, KEEP).withColumn("model", F.lit(name))
        out = scored if out is None else out.unionByName(scored)
    return out


@query("holdout_comparison")
def q_holdout_comparison(spark, sf):
    """Accuracy, macro F1 and ROC-AUC of the three fitted families on the hold-out rows."""
    return V.model_comparison(holdout_scores(spark, sf, ("logistic", "forest", "boosted")))


@query("holdout_roc_curve")
def q_holdout_roc(spark, sf):
    return V.roc_curve(holdout_scores(spark, sf), ["model"])


@query("holdout_pr_curve")
def q_holdout_pr(spark, sf):
    return V.pr_curve(holdout_scores(spark, sf), ["model"])


@query("holdout_calibration")
def q_holdout_calibration(spark, sf):
    return V.calibration_table(holdout_scores(spark, sf), ["model"])


@query("holdout_fairness")
def q_holdout_fairness(spark, sf):
    return V.fairness_audit(holdout_scores(spark, sf), ["model"], ["grp", "tier"])


@query("attribution_model_ranking")
def q_model_ranking(spark, sf):
    """Mean |attribution| of every encoded feature of the fitted logistic model."""
    return H.ranking(q_attr_logistic(spark, sf))


@query("attribution_model_rank_of")
def q_model_rank_of(spark, sf):
    return H.rank_of(H.ranking(q_attr_logistic(spark, sf)), "fare", top=3)


@query("attribution_model_notable")
def q_model_notable(spark, sf):
    """Fare and the derived features (title, family size, alone, deck) over the threshold."""
    table = H.ranking(q_attr_logistic(spark, sf))
    among = [r["feature"] for r in table.select("feature").collect()  # a row an encoded feature
             if r["feature"] in ("fare", "family_size") or r["feature"].startswith(("title", "is_alone", "deck"))]
    return H.notable(table, among, 0.1)


@query("attribution_model_breakdown")
def q_model_breakdown(spark, sf):
    """The 15 largest parts, and the rest, of the hold-out row with the highest predicted probability."""
    attr = q_attr_logistic(spark, sf)
    score = attr.select("subject_id", F.col("margin").alias("score")).distinct()  # the probability ascends with the margin
    return H.breakdown(attr, "subject_id", score, n=15)
