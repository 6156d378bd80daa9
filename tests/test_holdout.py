"""Fitted-model evaluation: hold-out results agree with each other and with the model's own report."""

from pyspark.sql import functions as F

import __spark_entry__ as entry


def test_holdout_curves_calibration_and_groups(spark, sf_small):
    q = entry.queries()
    from tessera.plans.q_train import logistic_report
    assert all(r.metrics_ok and r.scores_ok for r in q["train_logistic"](spark, sf_small).collect())
    report = {r["class"]: r for r in logistic_report(spark, sf_small).collect()}
    n = report["accuracy"]["support"]
    roc = q["holdout_roc_curve"](spark, sf_small).orderBy("fpr", "tpr").collect()
    assert (roc[0].fpr, roc[0].tpr) == (0.0, 0.0) and (roc[-1].fpr, roc[-1].tpr) == (1.0, 1.0)
    assert q["holdout_calibration"](spark, sf_small).agg(F.sum("n")).first()[0] == n
    fair = q["holdout_fairness"](spark, sf_small)
    assert fair.filter(F.col("group").startswith("grp_")).agg(F.sum("n")).first()[0] == n


def test_breakdown_of_the_most_confident_row(spark, sf_small):
    q = entry.queries()
    from tessera.plans.q_explain import q_attr_logistic
    parts = q["attribution_model_breakdown"](spark, sf_small).collect()
    assert len(parts) == 16 and len({r.subject_id for r in parts}) == 1 and "rest" in {r.feature for r in parts}
    attr = q_attr_logistic(spark, sf_small).filter(F.col("subject_id") == parts[0].subject_id)
    row = attr.agg(F.sum("attribution").alias("s"), F.max("margin").alias("m"), F.max("base").alias("b")).first()
    assert abs(row.m - row.b - sum(r.attribution for r in parts)) < 1e-5
    ranks = q["attribution_model_rank_of"](spark, sf_small).collect()
    assert {1, 2, 3} <= {r["rank"] for r in ranks} and "fare" in {r.feature for r in ranks}
