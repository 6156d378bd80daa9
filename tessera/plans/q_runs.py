"""Run-log, leaderboard and registry queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from tessera.operators import evaluate as V
from tessera.operators import registry as L
from tessera.operators import select as S
from tessera.plans.catalog import query, scored
from tessera.plans.views import with_views
from tessera.session import new_scratch_path
from tessera.sources import fixtures, runlog
from tessera.spec import CORE_METRICS, KNOWN_METRICS

_LATEST = "lm AS (SELECT run_id, metric, arg_max(value, ts) AS value FROM run_metrics GROUP BY run_id, metric)"
_WIDE = "wide AS (SELECT r.run_id, r.run_name, r.parent_run_id, " + ", ".join(
    f"max(CASE WHEN lm.metric = '{m}' THEN lm.value END) AS {m}" for m in KNOWN_METRICS) + \
    " FROM runs r LEFT JOIN lm ON r.run_id = lm.run_id GROUP BY r.run_id, r.run_name, r.parent_run_id)"
_LB = "lb AS (SELECT run_id, run_name, " + ", ".join(KNOWN_METRICS) + " FROM wide WHERE parent_run_id IS NULL AND " + \
      " AND ".join(f"{m} IS NOT NULL" for m in CORE_METRICS) + ")"
W_RUNS = with_views("runs", "run_metrics", extra=[("lm", _LATEST.split(" AS (", 1)[1][:-1]),
                                                   ("wide", _WIDE.split(" AS (", 1)[1][:-1]),
                                                   ("lb", _LB.split(" AS (", 1)[1][:-1])])


def _runs(spark, sf):
    return fixtures.runs(spark, sf), fixtures.run_metrics(spark, sf)


@query("run_search_wide", W_RUNS + "SELECT run_id, run_name, CAST(parent_run_id AS VARCHAR) AS parent_run_id, "
       + ", ".join(KNOWN_METRICS) + " FROM wide")
def q_search_wide(spark, sf):
    r, m = _runs(spark, sf)
    w = runlog.search_runs(r, m)
    return w.withColumn("parent_run_id", F.col("parent_run_id").cast("string"))


@query("leaderboard", W_RUNS + "SELECT lb.*, lb.run_id = (SELECT run_id FROM lb ORDER BY roc_auc DESC, run_id LIMIT 1) "
       "AS selected FROM lb ORDER BY roc_auc DESC, run_id")
def q_leaderboard(spark, sf):
    r, m = _runs(spark, sf)
    return L.leaderboard(r, m)


@query("champion_gap", W_RUNS + """, o AS (SELECT run_id, run_name, roc_auc, row_number() OVER (ORDER BY roc_auc DESC, run_id) AS k FROM lb)
SELECT a.run_id, a.run_name, a.roc_auc, b.run_id AS runner_up_id, round(a.roc_auc - b.roc_auc, 6) AS gap
FROM o a LEFT JOIN o b ON b.k = 2 WHERE a.k = 1""")
def q_champion_gap(spark, sf):
    r, m = _runs(spark, sf)
    return L.champion_gap(L.leaderboard(r, m))


@query("grid_rank", W_RUNS + "SELECT run_id, parent_run_id, f1_macro, CAST(rank() OVER (PARTITION BY parent_run_id "
       "ORDER BY f1_macro DESC) AS INT) AS rank FROM wide WHERE parent_run_id IS NOT NULL AND f1_macro IS NOT NULL")
def q_grid_rank(spark, sf):
    r, m = _runs(spark, sf)
    w = runlog.search_runs(r.filter(F.col("parent_run_id").isNotNull()), m).filter(F.col("f1_macro").isNotNull())
    return L.grid_rank(w, "f1_macro").select("run_id", "parent_run_id", "f1_macro", "rank")


_ART = with_views("run_artifacts")


# A known folder is found whether the artifact is the folder itself or lies anywhere below it; else any folder with an
# artifact below it whose whole path says "model".
@query("artifact_resolve", _ART + """, c AS (SELECT run_id, split_part(path, '/', 1) AS path,
  CASE split_part(path, '/', 1) WHEN 'baseline_model' THEN 0 WHEN 'random_forest_model' THEN 1
       WHEN 'gradient_boosting_model' THEN 2 WHEN 'GradientBoosting_Best' THEN 3
       ELSE CASE WHEN path LIKE '%/%' AND path LIKE '%model%' THEN 4 END END AS priority FROM run_artifacts),
r AS (SELECT run_id, path, row_number() OVER (PARTITION BY run_id ORDER BY priority, path) AS k FROM c WHERE priority IS NOT NULL)
SELECT run_id, path FROM r WHERE k = 1""")
def q_artifact_resolve(spark, sf):
    return L.resolve_artifacts(fixtures.run_artifacts(spark, sf))


_REG = W_RUNS.rstrip() + f",\nreg AS ({fixtures.MODEL_VERSIONS_SQL}),\n" \
    "champ AS (SELECT run_id FROM lb ORDER BY roc_auc DESC, run_id LIMIT 1),\n" \
    "promoted AS (SELECT version, run_id, CASE WHEN stage = 'Production' THEN 'Archived' ELSE stage END AS stage FROM reg\n" \
    "  UNION ALL SELECT CAST((SELECT coalesce(max(version), 0) + 1 FROM reg) AS INT), (SELECT run_id FROM champ), 'Production')\n"


@query("registry_promote", _REG + "SELECT version, run_id, stage FROM promoted")
def q_registry_promote(spark, sf):
    r, m = _runs(spark, sf)
    lb = L.leaderboard(r, m)
    champ = lb.agg(F.min_by("run_id", F.struct((-F.col("roc_auc")).alias("a"), F.col("run_id").alias("b")))).scalar()
    return L.promote(fixtures.model_versions(spark, sf), champ)


@query("registry_resolve", W_RUNS.rstrip() + f",\nreg AS ({fixtures.MODEL_VERSIONS_SQL})\n"
       "SELECT (SELECT max(version) FROM reg WHERE stage = 'Production') AS version,\n"
       "  coalesce((SELECT arg_max(run_id, version) FROM reg WHERE stage = 'Production'),\n"
       "           (SELECT run_id FROM wide WHERE roc_auc IS NOT NULL ORDER BY roc_auc DESC, run_id LIMIT 1)) AS run_id,\n"
       "  CASE WHEN EXISTS (SELECT 1 FROM reg WHERE stage = 'Production') THEN 'registry' ELSE 'leaderboard' END AS source")
def q_registry_resolve(spark, sf):
    r, m = _runs(spark, sf)
    # the fallback wants the ROC-AUC alone, not every metric of the leaderboard
    return L.resolve_production(fixtures.model_versions(spark, sf), runlog.search_runs(r, m))


_GB = with_views("runs", "run_metrics", extra=[("lm", _LATEST.split(" AS (", 1)[1][:-1]),
                                                ("wide", _WIDE.split(" AS (", 1)[1][:-1]),
                                                ("run_params", fixtures.RUN_PARAMS_SQL)])


@query("grid_best_by_parent", _GB + """, p AS (SELECT run_id,
  max(CASE WHEN key = 'classifier__n_estimators' THEN value END) AS n_estimators,
  max(CASE WHEN key = 'classifier__learning_rate' THEN value END) AS learning_rate,
  max(CASE WHEN key = 'classifier__max_depth' THEN value END) AS max_depth FROM run_params GROUP BY run_id),
c AS (SELECT w.run_id, w.parent_run_id, w.f1_macro, p.n_estimators, p.learning_rate, p.max_depth,
  row_number() OVER (PARTITION BY w.parent_run_id ORDER BY w.f1_macro DESC, w.run_id) AS k
  FROM wide w JOIN p ON w.run_id = p.run_id WHERE w.parent_run_id IS NOT NULL AND w.f1_macro IS NOT NULL)
SELECT parent_run_id, run_id AS best_run_id, f1_macro AS best_f1_macro, n_estimators, learning_rate, max_depth FROM c WHERE k = 1""")
def q_grid_best(spark, sf):
    r, m = _runs(spark, sf)
    kids = runlog.search_runs(r.filter(F.col("parent_run_id").isNotNull()), m)
    p = fixtures.run_params(spark, sf).select("run_id", S.strip_prefix("key", "classifier__").alias("key"), "value")
    pw = p.groupBy("run_id").pivot("key", ["n_estimators", "learning_rate", "max_depth"]).agg(F.first("value"))
    kids = kids.join(pw, "run_id")
    return L.best_child_per_parent(kids, "f1_macro", ["n_estimators", "learning_rate", "max_depth"])


# New runs logged by the append query: one per stand-in model, ids after the existing ones.
_APPEND_SQL = with_views("scored", "run_metrics").rstrip() + """,
c AS (SELECT model, CAST(count_if(label = 1 AND pred = 1) AS BIGINT) AS tp, CAST(count_if(label = 0 AND pred = 1) AS BIGINT) AS fp,
  CAST(count_if(label = 1 AND pred = 0) AS BIGINT) AS fn, CAST(count_if(label = 0 AND pred = 0) AS BIGINT) AS tn
  FROM scored GROUP BY model),
base AS (SELECT max(run_id) AS m FROM run_metrics),
nr AS (SELECT CAST(base.m + CASE model WHEN 'logistic' THEN 1 WHEN 'forest' THEN 2 ELSE 3 END AS BIGINT) AS run_id,
  CAST(tp + tn AS DOUBLE) / (tp + fp + fn + tn) AS accuracy FROM c CROSS JOIN base)
SELECT run_id, metric, ts, value FROM run_metrics
UNION ALL SELECT run_id, 'accuracy', 0, accuracy FROM nr"""


@query("run_log_append", _APPEND_SQL)
def q_run_log_append(spark, sf):
    """Snapshot the run log to a fresh table under the shared folder, append one run per
    model with its accuracy, read the table back."""
    path = new_scratch_path(spark, "run_metrics")
    m = fixtures.run_metrics(spark, sf)
    runlog.append_metrics(m, path)
    bm = V.binary_metrics(scored(spark, sf), ["model"])
    base = m.agg(F.max("run_id")).scalar()
    order = F.create_map(*[F.lit(x) for i, (n, _, _) in enumerate(fixtures.STANDIN_MODELS) for x in (n, i + 1)])
    new = bm.select((base + F.element_at(order, F.col("model"))).alias("run_id"), "accuracy")
    runlog.append_metrics(runlog.metrics_long(new, "run_id", ["accuracy"]), path)
    return runlog.read_metrics(spark, path)
