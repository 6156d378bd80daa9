"""Stand-in views over the driver tables, built with the DataFrame API.

``subjects`` is the labelled table (orders joined to customer), ``scored`` the evaluation
input of three stand-in models, and ``runs`` / ``run_metrics`` / ``run_artifacts`` the run
log. Their SQL twins live in :mod:`tessera.plans.views`; both give equal rows.

Scale notes: ``subjects`` is a shuffle (sort-merge) join on the customer key, left to AQE,
whose skew-join split handles a customer that owns a large share of the orders. The
model / metric / artifact fan-outs are ``inline`` generators over literal arrays (no join).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.sources.tables import read_table


def _case(key: Column, mapping: list[tuple[int, str]], default: str) -> Column:
    expr = None
    for k, v in mapping:
        expr = F.when(key == k, F.lit(v)) if expr is None else expr.when(key == k, F.lit(v))
    return expr.otherwise(F.lit(default))


ORDER_COLS = ["o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderpriority"]
ORDER_SCHEMA = "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, o_orderpriority string"


def subjects(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = read_table(spark, sf_dir, "orders", ORDER_COLS)
    c = read_table(spark, sf_dir, "customer", ["c_custkey", "c_mktsegment"])
    return subjects_from(o, c)


def subjects_from(o: DataFrame, c: DataFrame) -> DataFrame:
    """The labelled table from an orders frame (batch or stream) and the customer table."""
    j = o.join(c, o.o_custkey == c.c_custkey, "inner")
    k, ck = F.col("o_orderkey"), F.col("o_custkey")
    prio = F.substring("o_orderpriority", 1, 1)
    title_tok = _case((k % 12).cast("int"),
                      [(0, "Miss"), (1, "Mrs"), (2, "Master"), (3, "Ms"), (4, "Mlle"), (5, "Dr"), (6, "Prof")], "Mr")
    return j.select(
        k.alias("subject_id"),
        F.when(F.col("o_orderstatus") == "F", 1).otherwise(0).alias("label"),
        F.when(prio == "1", 1).when(prio.isin("2", "3"), 2).otherwise(3).alias("tier"),
        F.col("c_mktsegment").alias("grp"),
        F.concat(F.lit("Doe"), ck.cast("string"), F.lit(", "), title_tok,
                 F.when(k % 50 == 7, F.lit(" Pat")).otherwise(F.lit(". Pat"))).alias("full_name"),
        F.when(k % 5 == 0, F.lit(None).cast("double")).otherwise((ck % 101).cast("double")).alias("age"),
        (k % 4).cast("int").alias("sibsp"),
        (ck % 3).cast("int").alias("parch"),
        F.when(k % 891 == 0, F.lit(None).cast("double")).otherwise(F.col("o_totalprice")).alias("fare"),
        F.when(k % 4 != 0, F.lit(None).cast("string")).otherwise(
            F.concat(F.substr(F.lit("ABCDEFGT"), (1 + ck % 8).cast("int"), F.lit(1)), ck.cast("string"))
        ).alias("cabin"),
        F.when(k % 445 == 0, F.lit(None).cast("string")).when(k % 10 < 7, F.lit("S"))
        .when(k % 10 < 9, F.lit("C")).otherwise(F.lit("Q")).alias("port"),
    )


# Fixed values of the stand-in models: (name, multiplier, lift).
STANDIN_MODELS = [("logistic", 7919, 30), ("forest", 6101, 20), ("boosted", 5003, 10)]


def scored_from(subj: DataFrame) -> DataFrame:
    models = F.array(*[F.struct(F.lit(m).alias("model"), F.lit(k).alias("k"), F.lit(lift).alias("lift"))
                       for m, k, lift in STANDIN_MODELS])
    s = subj.select("subject_id", "label", "tier", "grp", F.inline(models))
    score = ((F.col("subject_id") * F.col("k")) % (101 - F.col("lift")) + F.col("lift") * F.col("label")) \
        .cast("double") / 100
    s = s.select("model", "subject_id", "label", "tier", "grp", score.alias("score"))
    return s.withColumn("pred", F.when(F.col("score") >= 0.5, 1).otherwise(0))


def scored(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scored_from(subjects(spark, sf_dir))


def runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = read_table(spark, sf_dir, "supplier", ["s_suppkey"])
    k = F.col("s_suppkey")
    return s.select(
        k.alias("run_id"),
        F.concat(F.lit("run_"), k.cast("string")).alias("run_name"),
        F.when(k % 4 == 0, F.lit(None).cast("bigint")).otherwise(k - k % 4).alias("parent_run_id"),
    )


# Fixed values of the stand-in run log: metric name and multiplier.
RUN_METRIC_MULTIPLIERS = [("accuracy", 37), ("f1_macro", 53), ("roc_auc", 71), ("train_time_s", 29)]
RUN_ARTIFACT_PATHS = ["baseline_model", "random_forest_model", "gradient_boosting_model", "GradientBoosting_Best",
                      "other/model.pkl", "plots/curve.png"]


def run_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = read_table(spark, sf_dir, "supplier", ["s_suppkey"])
    pairs = F.array(*[F.struct(F.lit(m).alias("metric"), F.lit(a).alias("a"), F.lit(t).alias("ts"))
                      for m, a in RUN_METRIC_MULTIPLIERS for t in (0, 1)])
    x = s.select("s_suppkey", F.inline(pairs))
    k = F.col("s_suppkey")
    x = x.filter(~((k % 20 == 8) & (F.col("metric") == "roc_auc")) & ~((F.col("ts") == 1) & (k % 3 != 0)))
    value = ((k * F.col("a") + 13 * F.col("ts")) % 1009).cast("double") / 1009
    return x.select(k.alias("run_id"), "metric", "ts", value.alias("value"))


# Grid parameters of the child runs (long, string-valued like a run tracker's params).
RUN_PARAMS_SQL = """SELECT r.run_id, p.key, CASE p.key
    WHEN 'classifier__n_estimators' THEN CASE WHEN r.run_id % 2 = 0 THEN '200' ELSE '300' END
    WHEN 'classifier__learning_rate' THEN CASE WHEN r.run_id % 8 < 4 THEN '0.05' ELSE '0.1' END
    ELSE CASE WHEN r.run_id % 16 < 8 THEN '3' ELSE '4' END END AS value
FROM runs r CROSS JOIN (SELECT 'classifier__n_estimators' AS key UNION ALL SELECT 'classifier__learning_rate'
  UNION ALL SELECT 'classifier__max_depth') p
WHERE r.parent_run_id IS NOT NULL"""

RUN_PARAM_KEYS = ["classifier__n_estimators", "classifier__learning_rate", "classifier__max_depth"]


def run_params(spark: SparkSession, sf_dir: str) -> DataFrame:
    r = runs(spark, sf_dir).filter(F.col("parent_run_id").isNotNull())
    k = F.col("run_id")
    x = r.select("run_id", F.explode(F.array(*[F.lit(p) for p in RUN_PARAM_KEYS])).alias("key"))
    value = (F.when(F.col("key") == RUN_PARAM_KEYS[0], F.when(k % 2 == 0, "200").otherwise("300"))
             .when(F.col("key") == RUN_PARAM_KEYS[1], F.when(k % 8 < 4, "0.05").otherwise("0.1"))
             .otherwise(F.when(k % 16 < 8, "3").otherwise("4")))
    return x.select("run_id", "key", value.alias("value"))


def run_artifacts(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = read_table(spark, sf_dir, "supplier", ["s_suppkey"])
    paths = F.array(*[F.struct(F.lit(i).alias("i"), F.lit(p).alias("path")) for i, p in enumerate(RUN_ARTIFACT_PATHS)])
    x = s.select("s_suppkey", F.inline(paths))
    x = x.filter((F.col("i") == F.col("s_suppkey") % 6) | (F.col("i") == 5))
    return x.select(F.col("s_suppkey").alias("run_id"), "path")


# Stand-in model registry: one version per top-level run.
MODEL_VERSIONS_SQL = """SELECT CAST(run_id / 4 AS INT) AS version, run_id,
  CASE WHEN run_id % 100 = 12 THEN 'Production' WHEN run_id % 8 = 0 THEN 'Archived' ELSE 'None' END AS stage
FROM runs WHERE parent_run_id IS NULL"""


def model_versions(spark: SparkSession, sf_dir: str) -> DataFrame:
    r = runs(spark, sf_dir).filter(F.col("parent_run_id").isNull())
    k = F.col("run_id")
    stage = F.when(k % 100 == 12, "Production").when(k % 8 == 0, "Archived").otherwise("None")
    return r.select((k / 4).cast("int").alias("version"), "run_id", stage.alias("stage"))
