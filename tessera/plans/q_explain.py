"""Explanation queries (H1-H7)."""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.sql import functions as F

from tessera.operators import explain as H
from tessera.operators import prep as I
from tessera.operators import split as T
from tessera.operators import train as M
from tessera.plans.catalog import query, split_table
from tessera.plans.views import with_views
from tessera.session import checkpointed
from tessera.spec import PRESET_A

NUMERIC = list(PRESET_A.numeric)
CATEGORICAL = list(PRESET_A.categorical)

# Fixed weights of the closed-form linear explainer used by the exact queries.
LINEAR_WEIGHTS = {"age": -0.03, "fare": 0.000004, "sibsp": -0.2, "parch": 0.15, "family_size": -0.05}
NOTABLE_AMONG = ["age", "fare", "family_size"]

_X = with_views("features", "split", extra=[
    ("fs", "SELECT f.*, s.split FROM features f JOIN split s ON f.subject_id = s.subject_id"),
    ("m", "SELECT quantile_cont(age, 0.5) AS am, quantile_cont(fare, 0.5) AS fm FROM fs WHERE split = 'train'"),
    ("x", "SELECT subject_id, split, coalesce(age, am) AS age, coalesce(fare, fm) AS fare, CAST(sibsp AS DOUBLE) AS sibsp, "
          "CAST(parch AS DOUBLE) AS parch, CAST(family_size AS DOUBLE) AS family_size FROM fs CROSS JOIN m"),
    ("mu", "SELECT " + ", ".join(f"avg({c}) AS mu_{c}" for c in LINEAR_WEIGHTS) + " FROM x WHERE split = 'train'"),
    ("attr", " UNION ALL ".join(
        f"SELECT subject_id, '{c}' AS feature, {c} AS value, round(CAST({w!r} AS DOUBLE) * ({c} - mu_{c}), 6) AS attribution "
        f"FROM x CROSS JOIN mu WHERE split = 'test'" for c, w in LINEAR_WEIGHTS.items())),
    ("rk", "SELECT feature, round(avg(abs(attribution)), 6) AS mean_abs FROM attr GROUP BY feature"),
])


def linear_attr(spark, sf):
    fs = split_table(spark, sf)
    filled = I.fill(fs, I.fit_medians(fs.filter(F.col("split") == "train"), ["age", "fare"]))
    row = filled.filter(F.col("split") == "train").agg(*[F.avg(c).alias(c) for c in LINEAR_WEIGHTS]).first()
    means = {c: row[c] for c in LINEAR_WEIGHTS}
    return H.linear_attributions(filled.filter(F.col("split") == "test"), "subject_id", LINEAR_WEIGHTS, means)


@query("attribution_linear", _X + "SELECT subject_id, feature, value, attribution FROM attr")
def q_attr_linear(spark, sf):
    return linear_attr(spark, sf)


@query("attribution_ranking", _X + "SELECT feature, mean_abs FROM rk")
def q_attr_ranking(spark, sf):
    return H.ranking(linear_attr(spark, sf))


@query("attribution_rank_of", _X + """SELECT feature, mean_abs, rank, rank <= 3 AS in_top3, rank <= 5 AS in_top5 FROM (
  SELECT feature, mean_abs, CAST(row_number() OVER (ORDER BY mean_abs DESC, feature) AS INT) AS rank FROM rk) r
WHERE rank <= 3 OR feature = 'fare'""")
def q_attr_rank_of(spark, sf):
    return H.rank_of(H.ranking(linear_attr(spark, sf)), "fare", top=3)


@query("attribution_notable", _X + "SELECT feature, mean_abs FROM rk WHERE feature IN (" +
       ", ".join(f"'{c}'" for c in NOTABLE_AMONG) + ") AND mean_abs > 0.1")
def q_attr_notable(spark, sf):
    return H.notable(H.ranking(linear_attr(spark, sf)), NOTABLE_AMONG, 0.1)


@query("attribution_breakdown", _X + """, sc AS (SELECT subject_id, sum(attribution) AS score FROM attr GROUP BY subject_id),
top AS (SELECT subject_id FROM sc ORDER BY score DESC, subject_id LIMIT 1),
r AS (SELECT a.subject_id, a.feature, a.attribution, row_number() OVER (ORDER BY abs(a.attribution) DESC, a.feature) AS k
      FROM attr a JOIN top t ON a.subject_id = t.subject_id)
SELECT subject_id, feature, attribution FROM r WHERE k <= 3
UNION ALL SELECT subject_id, 'rest', round(sum(attribution), 6) FROM r WHERE k > 3 GROUP BY subject_id""")
def q_attr_breakdown(spark, sf):
    attr = linear_attr(spark, sf)
    score = attr.groupBy("subject_id").agg(F.sum("attribution").alias("score"))
    return H.breakdown(attr, "subject_id", score, n=3)


#: Attributions of a fitted model have no SQL form; what holds of them for every row has.
SUMS_SQL = with_views("split") + "SELECT subject_id, true AS sums_ok, true AS score_ok, true AS features_ok FROM split WHERE split = 'test'"


def checked(attr, scores, probability, names):
    """Per row: base and attributions add up to the margin; the margin gives the model's own probability; one part a feature."""
    per = attr.groupBy("subject_id").agg(F.sum("attribution").alias("s"), F.first("base").alias("b"), F.first("margin").alias("m"),
                                         F.count_distinct("feature").alias("n"), F.count(F.lit(1)).alias("k"))
    same = F.abs(probability(F.col("m")) - F.col("score")) < 1e-9
    return per.join(scores, "subject_id").select(
        "subject_id", (F.abs(F.col("b") + F.col("s") - F.col("m")) < 1e-9).alias("sums_ok"), same.alias("score_ok"),
        ((F.col("n") == len(names)) & (F.col("k") == len(names))).alias("features_ok"))


def _tree_attr(spark, sf, classifier, first=None):
    fs = split_table(spark, sf)
    train, test = fs.filter(F.col("split") == "train"), fs.filter(F.col("split") == "test")
    model = M.fit(train, NUMERIC, CATEGORICAL, classifier)
    if first is not None:
        test = checkpointed(test.orderBy(T.order_hash("subject_id", 42), "subject_id").limit(first))
    test = M.spread(test)
    prep = PipelineModel(stages=model.stages[:-1])
    names = I.encoded_names(prep, NUMERIC, CATEGORICAL)
    attr = H.tree_attributions(prep.transform(test), "subject_id", "features", model.stages[-1], names)
    return attr, M.predict(model, test, ["subject_id"]).select("subject_id", "score"), names


@query("attribution_trees", SUMS_SQL)
def q_attr_trees(spark, sf):
    """Shapley values of the tuned boosted trees for every hold-out row, checked row by row."""
    attr, scores, names = _tree_attr(spark, sf, M.boosted(**M.PRESETS["boosted_tuned"]))
    return checked(attr, scores, lambda m: 1 / (1 + F.exp(-2 * m)), names)


@query("attribution_forest", with_views("split") + """SELECT subject_id, true AS sums_ok, true AS score_ok, true AS features_ok FROM (
  SELECT subject_id FROM split WHERE split = 'test' ORDER BY md5(concat('42-', CAST(subject_id AS VARCHAR(20)))), subject_id LIMIT 300)""")
def q_attr_forest(spark, sf):
    """Shapley values of the dashboard's forest for the explanation sample (the first 300 hold-out rows), checked row by row."""
    attr, scores, names = _tree_attr(spark, sf, M.forest(**M.PRESETS["forest_dashboard"]), first=300)
    return checked(attr, scores, lambda m: m, names)


@query("attribution_logistic", SUMS_SQL)
def q_attr_logistic_checked(spark, sf):
    """Attributions of a fitted logistic model for every hold-out row, checked row by row."""
    attr, scores, names = _logistic_attr(spark, sf)
    return checked(attr, scores, lambda m: 1 / (1 + F.exp(-m)), names)


def q_attr_logistic(spark, sf):
    return _logistic_attr(spark, sf)[0]


def _logistic_attr(spark, sf):
    fs = split_table(spark, sf)
    train, test = fs.filter(F.col("split") == "train"), fs.filter(F.col("split") == "test")
    model = M.fit(train, NUMERIC, CATEGORICAL, M.logistic(M.training_rows(train), **M.PRESETS["logistic"]))
    prep = PipelineModel(stages=model.stages[:-1])
    names = I.encoded_names(prep, NUMERIC, CATEGORICAL)
    attr = H.logistic_attributions(prep.transform(test), "subject_id", "features", model.stages[-1], prep.transform(train), names)
    return attr, M.predict(model, test, ["subject_id"]).select("subject_id", "score"), names
