"""Split and resampling queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from tessera.operators import profile as P
from tessera.operators import split as T
from tessera.plans.catalog import query, subjects
from tessera.plans.views import with_views

W_SPLIT = with_views("split")


@query("stratified_split", W_SPLIT + "SELECT subject_id, label, split FROM split")
def q_split(spark, sf):
    return T.stratified_split(subjects(spark, sf).select("subject_id", "label"))


@query("split_balance", W_SPLIT + "SELECT split, label, count(*) AS n, "
       "round(count(*) / sum(count(*)) OVER (PARTITION BY split), 6) AS share FROM split GROUP BY split, label")
def q_split_balance(spark, sf):
    s = T.stratified_split(subjects(spark, sf).select("subject_id", "label"))
    return P.normalised_counts(s, "label", keys=["split"])


_FOLDS_SQL = "SELECT subject_id, label, rn - quota AS train_rank, CAST((rn - quota - 1) % 5 AS INT) AS fold " \
             "FROM split WHERE split = 'train'"


@query("stratified_kfold", W_SPLIT + "SELECT subject_id, label, fold FROM (" + _FOLDS_SQL + ") f")
def q_kfold(spark, sf):
    f = T.stratified_folds(subjects(spark, sf).select("subject_id", "label"), k=5)
    return f.select("subject_id", "label", "fold")


# The rule of the modelled library: sizes are shares of the first fold's training rows, the same in every fold, and a subset
# is a prefix of the fold's training rows in their order (here that of the hash, over all classes).
CURVE_SQL = W_SPLIT.rstrip() + f""", f AS ({_FOLDS_SQL}),
o AS (SELECT g.v AS fold, f.subject_id, f.label, row_number() OVER (PARTITION BY g.v
  ORDER BY md5(concat('42-', CAST(f.subject_id AS VARCHAR(20)))), f.subject_id) AS place FROM range(0, 5) g(v) JOIN f ON f.fold <> g.v),
m AS (SELECT count(*) AS n FROM f WHERE fold <> 0)
"""


@query("learning_curve_sizes", CURVE_SQL + "SELECT CAST(o.fold AS INT) AS fold, CAST(b.step AS INT) AS step, count(*) AS n_rows, "
       "CAST(sum(CASE WHEN o.label = 1 THEN 1 ELSE 0 END) AS BIGINT) AS n_pos "
       "FROM o CROSS JOIN m JOIN range(1, 11) b(step) ON o.place <= (b.step * m.n) // 10 GROUP BY o.fold, b.step")
def q_learning_sizes(spark, sf):
    f = T.stratified_folds(subjects(spark, sf).select("subject_id", "label"), k=5)
    return T.learning_curve_sizes(f, k=5, steps=10)


@query("explain_sample", W_SPLIT + "SELECT subject_id, label FROM split WHERE split = 'test' "
       "ORDER BY md5(concat('42-', CAST(subject_id AS VARCHAR(20)))), subject_id LIMIT 300")
def q_explain_sample(spark, sf):
    s = T.stratified_split(subjects(spark, sf).select("subject_id", "label"))
    test = s.filter(F.col("split") == "test")
    return test.orderBy(T.order_hash("subject_id", 42), "subject_id").limit(300).select("subject_id", "label")
