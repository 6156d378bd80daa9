"""Training queries (M1-M10, S5/S6, V12, X3 batch): rows-only checks plus pytest invariants.

Every query trains with the parameters of ``PRESETS`` (tessera.operators.train).
"""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.sql import functions as F

from tessera.operators import evaluate as V
from tessera.operators import guard as N
from tessera.operators import registry as R
from tessera.operators import score as X
from tessera.operators import search as G
from tessera.operators import split as T
from tessera.operators import train as M
from tessera.plans import q_score
from tessera.plans.catalog import features, features_b, query, split_table
from tessera.plans.q_split import CURVE_SQL
from tessera.plans.views import with_views
from tessera.session import checkpointed, new_scratch_path
from tessera.sources.runlog import RunLog
from tessera.spec import PRESET_A, fingerprint
from tessera.streaming import score_stream

NUMERIC = list(PRESET_A.numeric)
CATEGORICAL = list(PRESET_A.categorical)


def split_frames(spark, sf):
    fs = split_table(spark, sf)
    return fs.filter(F.col("split") == "train"), fs.filter(F.col("split") == "test"), fs


def fit_on_split(spark, sf, classifier_fn):
    """Fit on the training rows of the checkpointed split frame."""
    train, test, fs = split_frames(spark, sf)
    model = M.fit(train, NUMERIC, CATEGORICAL, classifier_fn(train))
    return model, train, test


def report(model, test, name):
    p = M.predict(model, test, ["subject_id", "label"])
    return V.classification_report(p.withColumn("model", F.lit(name)), ["model"])


#: A fitted model's scores have no SQL form; supports have, and all else is checked against the returned rows.
REPORT_SQL = with_views("split") + """, t AS (SELECT label FROM split WHERE split = 'test')
SELECT '{name}' AS model, CAST(label AS VARCHAR) AS class, count(*) AS support, true AS metrics_ok, true AS scores_ok FROM t GROUP BY label"""


def _report(model, test, name):
    """Per class of the hold-out rows: support; whether the report's precision, recall and F1 are those of the scored rows,
    counted class by class; whether every score is a probability that agrees with its prediction."""
    p = checkpointed(M.predict(model, M.spread(test), ["subject_id", "label"]))  # read twice
    rep = V.classification_report(p.withColumn("model", F.lit(name)), ["model"]).filter(F.col("class").isin("0", "1"))
    both = p.select(F.explode(F.array(F.lit(0), F.lit(1))).alias("c"), "label", "pred", "score")
    hit = (F.col("label") == F.col("c")) & (F.col("pred") == F.col("c"))
    own = both.groupBy(F.col("c").cast("string").alias("class")).agg(
        F.avg(F.when(F.col("pred") == F.col("c"), hit.cast("int"))).alias("p"), F.avg(F.when(F.col("label") == F.col("c"), hit.cast("int"))).alias("r"),
        F.bool_and(F.col("score").between(0, 1) & ((F.col("score") > 0.5) == (F.col("pred") == 1)) | (F.col("score") == 0.5)).alias("scores_ok"))
    p_, r_ = F.coalesce("p", F.lit(0.0)), F.coalesce("r", F.lit(0.0))
    near = lambda a, b: F.abs(F.col(a) - b) < 1e-6
    ok = near("precision", p_) & near("recall", r_) & near("f1", F.coalesce(F.try_divide(2 * p_ * r_, p_ + r_), F.lit(0.0)))
    return rep.join(own, "class").select("model", "class", "support", ok.alias("metrics_ok"), "scores_ok")


def fit_logistic(spark, sf):
    return fit_on_split(spark, sf, lambda train: M.logistic(M.training_rows(train), **M.PRESETS["logistic"]))


def logistic_report(spark, sf):
    """The classification report itself."""
    model, _, test = fit_logistic(spark, sf)
    return report(model, test, "logistic")


@query("train_logistic", REPORT_SQL.replace("{name}", "logistic"))
def q_train_logistic(spark, sf):
    model, _, test = fit_logistic(spark, sf)
    return _report(model, test, "logistic")


@query("train_forest", REPORT_SQL.replace("{name}", "forest"))
def q_train_forest(spark, sf):
    model, _, test = fit_on_split(spark, sf, lambda _t: M.forest(**M.PRESETS["forest"]))
    return _report(model, test, "forest")


@query("train_gbt", REPORT_SQL.replace("{name}", "boosted"))
def q_train_gbt(spark, sf):
    model, _, test = fit_on_split(spark, sf, lambda _t: M.boosted(**M.PRESETS["boosted"]))
    return _report(model, test, "boosted")


@query("train_boosted_tuned", REPORT_SQL.replace("{name}", "boosted_tuned"))
def q_train_boosted_tuned(spark, sf):
    model, _, test = fit_on_split(spark, sf, lambda _t: M.boosted(**M.PRESETS["boosted_tuned"]))
    return _report(model, test, "boosted_tuned")


@query("train_forest_dashboard", REPORT_SQL.replace("{name}", "forest_dashboard"))
def q_train_forest_dashboard(spark, sf):
    model, _, test = fit_on_split(spark, sf, lambda _t: M.forest(**M.PRESETS["forest_dashboard"]))
    return _report(model, test, "forest_dashboard")


@query("train_boosted_dashboard", REPORT_SQL.replace("{name}", "boosted_dashboard"))
def q_train_boosted_dashboard(spark, sf):
    model, _, test = fit_on_split(spark, sf, lambda _t: M.boosted(**M.PRESETS["boosted_dashboard"]))
    return _report(model, test, "boosted_dashboard")


def new_log(spark):
    return RunLog(spark, new_scratch_path(spark, "run-log"))


def boosted_candidates():
    """The grid: runs of 200 and 300 rounds of one rate and depth are one fit."""
    return [G.Candidate(f"GB_n{n}_lr{lr}_d{d}", {"n_estimators": n, "learning_rate": lr, "max_depth": d},
                        lambda _rows, n=n, lr=lr, d=d: M.boosted(max_iter=n, step=lr, max_depth=d, subsample=0.8, checkpoint_interval=100),
                        rounds=n, shares=(lr, d)) for n in M.GRID_ROUNDS for lr in M.GRID_RATES for d in M.GRID_DEPTHS]


def ranked(table, score):
    """Whether every rank is one more than the number of better means; the means come as one array (a row a candidate)."""
    every = table.agg(F.collect_list(f"mean_{score}")).scalar()
    return table.withColumn("every", every).withColumn("m", F.col(f"mean_{score}")).withColumn(
        "rank_ok", F.col("rank") == 1 + F.expr("size(filter(every, x -> x > m))"))


_GRID_SQL = with_views("split") + """, s AS (SELECT CAST(count_if(split = 'train') AS BIGINT) AS a, CAST(count_if(split = 'test') AS BIGINT) AS b FROM split)
SELECT 'GB_n' || n || '_lr' || lr || '_d' || d AS candidate, n AS n_estimators, CAST(lr AS DOUBLE) AS learning_rate, d AS max_depth,
  CAST(5 AS BIGINT) AS n_folds, s.a AS n_scored, true AS scores_ok, true AS rank_ok, s.b AS val_rows, true AS val_ok
FROM (SELECT unnest([200, 300]) AS n), (SELECT unnest(['0.05', '0.1']) AS lr), (SELECT unnest([3, 4]) AS d), s"""


@query("grid_search", _GRID_SQL)
def q_grid_search(spark, sf):
    """8 combinations x 5 folds by macro F1, the best one refitted, logged and saved. Per candidate: folds and scored rows;
    whether all its scores lie in [0, 1] and its rank follows from the means; hold-out rows, and whether the five logged
    hold-out metrics are those of the saved model, loaded and scored anew."""
    train, test, fs = split_frames(spark, sf)
    log = new_log(spark)
    folds = checkpointed(T.stratified_folds(features(spark, sf), k=5))  # read by every fold's fits
    search = G.ParamSearch(boosted_candidates(), NUMERIC, CATEGORICAL, log, "grid", holdout=test, parallelism=20)
    table = search.fit(folds).results
    uri = log.read("run_artifacts").filter("run_id = 'grid'").first()["uri"]
    scored = M.predict(PipelineModel.load(uri), test, ["label"])
    own = G.metrics_of(scored)
    kept = {r["metric"]: r["value"] for r in log.read("run_metrics").filter("run_id = 'grid'").collect()}  # a few of one run
    val_ok = all(abs(kept[f"val_{m}"] - v) < 1e-9 for m, v in own.items())
    unit = [F.col(f"mean_{m}").between(0, 1) for m in G.METRICS]
    params = spark.createDataFrame([(c.name, *c.params.values()) for c in search.candidates],
                                   "candidate string, n_estimators int, learning_rate double, max_depth int")
    n_val = scored.agg(F.count(F.lit(1))).scalar()
    out = ranked(table, "f1_macro").join(params, "candidate")
    return out.select("candidate", "n_estimators", "learning_rate", "max_depth", "n_folds", "n_scored",
                      (unit[0] & unit[1] & unit[2] & unit[3] & unit[4]).alias("scores_ok"), "rank_ok", n_val.alias("val_rows"),
                      F.lit(val_ok).alias("val_ok"))


_COMPARE_SQL = with_views("split") + """, s AS (SELECT CAST(count_if(split = 'train') AS BIGINT) AS a FROM split)
SELECT unnest(['logistic', 'forest', 'boosted']) AS candidate, CAST(5 AS BIGINT) AS n_folds, s.a AS n_scored, true AS scores_ok, true AS rank_ok FROM s"""


@query("cv_compare_models", _COMPARE_SQL)
def q_cv_compare(spark, sf):
    """Three families x 5 folds by ROC-AUC, without a refit."""
    P = M.PRESETS
    cands = [G.Candidate("logistic", P["logistic"], lambda rows: M.logistic(rows, **P["logistic"])),
             G.Candidate("forest", P["forest"], lambda _rows: M.forest(**P["forest"])),
             G.Candidate("boosted", P["boosted"], lambda _rows: M.boosted(checkpoint_interval=100, **P["boosted"]))]
    search = G.ParamSearch(cands, NUMERIC, CATEGORICAL, new_log(spark), "families", score="roc_auc")
    table = G.summary(search.run(checkpointed(T.stratified_folds(features(spark, sf), k=5))), "roc_auc")
    unit = F.col("mean_accuracy").between(0, 1) & F.col("mean_f1_macro").between(0, 1) & F.col("mean_roc_auc").between(0, 1)
    return ranked(table, "roc_auc").select("candidate", "n_folds", "n_scored", unit.alias("scores_ok"), "rank_ok")


_LC_SQL = CURVE_SQL + """SELECT CAST(step AS INT) AS step, CAST(least((step * m.n) // 10, (SELECT max(c) FROM (SELECT count(*) AS c FROM o GROUP BY fold)))
  AS BIGINT) AS train_size, true AS scores_ok FROM range(1, 11) b(step) CROSS JOIN m"""


@query("learning_curve", _LC_SQL)
def q_learning_curve(spark, sf, steps=10, k=5):
    """Train and validation macro F1 for growing prefixes of each fold's training rows, preprocessing fitted on each: sizes,
    and whether all means lie in [0, 1]."""
    path = new_scratch_path(spark, "placed")
    T.fold_places(T.stratified_folds(features(spark, sf), k=k), k).write.parquet(path)
    out = M.learning_curve(spark.read.parquet(path), NUMERIC, CATEGORICAL, lambda n: M.logistic(n, **M.PRESETS["logistic"]), k, steps, parallelism=8)
    unit = F.col("train_f1_macro").between(0, 1) & F.col("cv_f1_macro").between(0, 1)
    return out.select("step", "train_size", unit.alias("scores_ok"))


@query("staged_loss")
def q_staged_loss(spark, sf):
    model, train, _ = fit_on_split(spark, sf, lambda _t: M.boosted(**M.PRESETS["boosted"]))
    return M.staged_loss(model, train)


def _forest_model(spark, sf):
    return fit_on_split(spark, sf, lambda _t: M.forest(**M.PRESETS["forest"]))[0]


@query("feature_importance")
def q_importance(spark, sf):
    return M.importances(_forest_model(spark, sf), NUMERIC, CATEGORICAL).orderBy(F.desc("importance"), "feature")


@query("topk_importance")
def q_topk_importance(spark, sf):
    imp = M.importances(_forest_model(spark, sf), NUMERIC, CATEGORICAL)
    return imp.orderBy(F.desc("importance"), "feature").limit(15)


@query("model_roundtrip", with_views("split") + "SELECT subject_id, true AS same FROM split WHERE split = 'test'")
def q_roundtrip(spark, sf):
    """Save the fitted pipeline to the shared folder, load it, score again: every hold-out row keeps its score."""
    model, _, test = fit_logistic(spark, sf)
    path = new_scratch_path(spark, "model")
    model.write().overwrite().save(path)
    loaded = PipelineModel.load(path)
    a = M.predict(model, test, ["subject_id"]).withColumnRenamed("score", "p_before").drop("pred")
    b = M.predict(loaded, test, ["subject_id"]).withColumnRenamed("score", "p_after").drop("pred")
    same = F.abs(F.col("p_before") - F.col("p_after")) < 1e-12
    return a.join(b, "subject_id").select("subject_id", same.alias("same"))


@query("spec_guard", with_views("split") + "SELECT subject_id, true AS same, true AS kept, true AS refused FROM split WHERE split = 'test'")
def q_spec_guard(spark, sf):
    """A pipeline saved with its feature spec and loaded: it scores rows of its spec as before and refuses those of the other."""
    model, _, test = fit_logistic(spark, sf)
    path = new_scratch_path(spark, "guarded")
    N.guarded(model, PRESET_A).write().save(path)
    loaded = PipelineModel.load(path)
    try:
        loaded.transform(features_b(spark, sf))
        refused = False
    except N.SpecMismatch:
        refused = True
    kept = N.spec_guard(loaded).kept()["fingerprint"] == fingerprint(PRESET_A)
    a = M.predict(model, test, ["subject_id"]).select("subject_id", F.col("score").alias("direct"))
    b = M.predict(loaded, test, ["subject_id"])
    return a.join(b, "subject_id").select("subject_id", (F.abs(F.col("score") - F.col("direct")) < 1e-12).alias("same"),
                                          F.lit(kept).alias("kept"), F.lit(refused).alias("refused"))


@query("batch_score")
def q_batch_score(spark, sf):
    model, _, test = fit_logistic(spark, sf)
    return X.score_with_model(model, test)


@query("stream_score_model", with_views("subjects") + "SELECT subject_id, true AS same, true AS pred_ok FROM subjects WHERE "
       + q_score.VALID_WHERE)
def q_stream_score_model(spark, sf):
    """Orders streamed through validation, defaults and a fitted pipeline, against scoring the same rows directly."""
    model, _, _ = fit_logistic(spark, sf)
    streamed = score_stream.score_orders_stream(spark, sf, model, q_score.rules())
    direct = X.score_with_model(model, X.apply_defaults(features(spark, sf), PRESET_A, mode="derive"))
    direct = direct.select("subject_id", F.col("probability").alias("direct"))
    return streamed.join(direct, "subject_id").select(
        "subject_id", (F.col("probability") == F.col("direct")).alias("same"),
        (F.col("pred") == (F.col("probability") >= 0.5).cast("int")).alias("pred_ok"))


# Run log and serving (S7, L5) -------------------------------------------------------------

def logged_logistic(log, train, test, name, c, experiment="logistic"):
    """Fit one logistic model as a run: parameters, its own time, sizes, hold-out metrics and the saved pipeline."""
    rows = M.training_rows(train)
    with log.run(name, experiment) as run:
        run.params(C=c, max_iter=M.PRESETS["logistic"]["max_iter"])
        with run.timed():
            model = M.fit(train, NUMERIC, CATEGORICAL, M.logistic(rows, C=c, max_iter=M.PRESETS["logistic"]["max_iter"]))
        scored = M.predict(model, test, ["label"])
        run.metrics(n_train=rows, n_val=scored.count(), **G.metrics_of(scored))
        run.save(model, "baseline_model")
        with log.run(f"{name}_report", experiment, parent=run.run_id) as child:
            child.params(of=name)
    return model, run.run_id


_LOG_SQL = with_views("split") + """, s AS (SELECT CAST(count_if(split = 'train') AS VARCHAR) AS a, CAST(count_if(split = 'test') AS VARCHAR) AS b FROM split),
r AS (SELECT 'baseline' AS run_name, CAST(NULL AS VARCHAR) AS parent UNION ALL SELECT 'baseline_report', 'baseline'),
k AS (SELECT 'baseline' AS run_name, 'param' AS kind, 'C' AS key, '1.0' AS value UNION ALL SELECT 'baseline', 'param', 'max_iter', '1000'
  UNION ALL SELECT 'baseline_report', 'param', 'of', 'baseline' UNION ALL SELECT 'baseline', 'artifact', 'baseline_model', 'saved'
  UNION ALL SELECT 'baseline', 'metric', 'n_train', a FROM s UNION ALL SELECT 'baseline', 'metric', 'n_val', b FROM s
  UNION ALL SELECT 'baseline', 'metric', unnest(['accuracy', 'precision', 'recall', 'f1_macro', 'roc_auc', 'train_time_s']), 'recorded')
SELECT r.run_name, parent, kind, key, value FROM r JOIN k ON r.run_name = k.run_name"""


@query("run_log_training", _LOG_SQL)
def q_run_log_training(spark, sf):
    """A training run in the log, with a nested run, read back: parameters, metrics (sizes by value, learned ones and times
    as recorded when they are in their range) and artifacts; a run that fails beside it leaves no row."""
    train, test, _ = split_frames(spark, sf)
    log = new_log(spark)
    try:
        with log.run("broken", "logistic") as run:
            run.params(C=-1)
            raise ValueError("no such model")
    except ValueError:
        pass
    logged_logistic(log, train, test, "baseline", 1.0)
    runs = log.read("runs")
    names = runs.join(runs.select(F.col("run_id").alias("parent_run_id"), F.col("run_name").alias("parent")), "parent_run_id", "left")
    top = F.when(F.col("metric") == "train_time_s", 1e9).otherwise(1.0)
    value = F.when(F.col("metric").startswith("n_"), F.col("value").cast("long").cast("string")).when(F.col("value").between(0, top), F.lit("recorded"))
    rows = log.read("run_params").select("run_id", F.lit("param").alias("kind"), "key", "value").union(
        log.read("run_metrics").select("run_id", F.lit("metric"), "metric", value)).union(
        log.read("run_artifacts").select("run_id", F.lit("artifact"), "path", F.when(F.col("uri").endswith("/baseline_model"), F.lit("saved"))))
    return names.join(rows, "run_id").select("run_name", "parent", "kind", "key", "value")


_SERVE_SQL = with_views("split") + """SELECT subject_id, CAST(2 AS INT) AS version, 'registry' AS source, true AS best, true AS same
FROM split WHERE split = 'test'"""


@query("registry_serve", _SERVE_SQL)
def q_registry_serve(spark, sf):
    """Two logged models; a weaker one is promoted first, the leaderboard's best one after it; the Production version is
    resolved to its artifact, loaded and scores the hold-out rows as the model in memory does."""
    train, test, _ = split_frames(spark, sf)
    log, registry = new_log(spark), R.Registry(spark, new_scratch_path(spark, "registry"))
    fitted = {}
    for name, c in (("baseline", 1.0), ("strict", 0.0001)):
        model, run_id = logged_logistic(log, train, test, name, c)
        fitted[run_id] = model
    board = R.leaderboard(log.read("runs"), log.read("run_metrics")).collect()  # two rows
    for row in reversed(board):
        registry.promote(row["run_id"])
    model, found = R.load_production(registry.read()[1], log)
    a = M.predict(fitted[board[0]["run_id"]], test, ["subject_id"]).select("subject_id", F.col("score").alias("direct"))
    b = M.predict(model, test, ["subject_id"])
    return a.join(b, "subject_id").select("subject_id", F.lit(found["version"]).alias("version"), F.lit(found["source"]).alias("source"),
                                          F.lit(found["run_id"] == board[0]["run_id"]).alias("best"),
                                          (F.abs(F.col("score") - F.col("direct")) < 1e-12).alias("same"))
