"""Leaderboard, champion choice, artifact lookup and model registry as table operators.

Run logs hold one row per run or per (run, metric): they grow with experiments, not with
data. Even so, nothing here orders a whole table in one task: the champion is a
``min_by`` (partial aggregation) that reaches other rows as a scalar subquery, and
top-2 is a distributed ``orderBy().limit()``.
"""

from __future__ import annotations

import uuid

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tessera.operators.select import existing
from tessera.session import get_text, names_in, put_new
from tessera.sources.runlog import RunLog, latest_wide, search_runs
from tessera.spec import ARTIFACT_CANDIDATES, CORE_METRICS, KNOWN_METRICS


def _best_key(metric: str, id_col: str):
    return F.struct((-F.col(metric)).alias("m"), F.col(id_col).alias("i"))


def leaderboard(runs: DataFrame, run_metrics: DataFrame, sort_metric: str = "roc_auc",
                core: list[str] | None = None, display: dict[str, str] | None = None) -> DataFrame:
    """Top-level runs with all core metrics, sorted by ``sort_metric`` desc; ``selected`` marks the first.

    Only metric columns that exist are kept; ``display`` optionally renames columns
    (e.g. ``{"roc_auc": "ROC-AUC"}``) after the ordering is fixed."""
    core = core or CORE_METRICS
    wide = search_runs(runs.filter(F.col("parent_run_id").isNull()), run_metrics)
    base = existing(wide, ["run_id", "run_name", "experiment_id"])
    metrics = existing(wide, KNOWN_METRICS)
    lb = wide.select(*base, *metrics).dropna(subset=[c for c in core if c in metrics])
    champ = lb.agg(F.min_by("run_id", _best_key(sort_metric, "run_id"))).scalar()
    out = lb.withColumn("selected", F.col("run_id") == champ).orderBy(F.desc(sort_metric), "run_id")
    return out.withColumnsRenamed(display) if display else out


def champion_gap(lb: DataFrame, metric: str = "roc_auc", digits: int = 6) -> DataFrame:
    """Champion, runner-up and the metric gap between them (top-2 by a distributed limit)."""
    top2 = lb.orderBy(F.desc(metric), "run_id").limit(2)
    key = _best_key(metric, "run_id")
    s = top2.agg(F.min_by(F.struct("run_id", "run_name", metric), key).alias("a"),
                 F.max_by(F.struct("run_id", metric), key).alias("b"), F.count(F.lit(1)).alias("k"))
    second = F.when(F.col("k") > 1, F.col("b")[metric])
    return s.select(F.col("a.run_id").alias("run_id"), F.col("a.run_name").alias("run_name"),
                    F.col("a")[metric].alias(metric),
                    F.when(F.col("k") > 1, F.col("b.run_id")).alias("runner_up_id"),
                    F.round(F.col("a")[metric] - second, digits).alias("gap"))


def grid_rank(children: DataFrame, score: str, parent: str = "parent_run_id", out: str = "rank") -> DataFrame:
    """Rank of each child run's score within its parent (ties share the lowest rank)."""
    w = Window.partitionBy(parent).orderBy(F.desc(score))
    return children.withColumn(out, F.rank().over(w))


def resolve_artifacts(artifacts: DataFrame, candidates: list[str] | None = None) -> DataFrame:
    """Per run: the first known model folder present (alone or with anything inside), else a folder holding an
    artifact whose whole path has "model" in it."""
    candidates = candidates or ARTIFACT_CANDIDATES
    pri = F.create_map(*[F.lit(x) for i, c in enumerate(candidates) for x in (c, i)])
    folder = F.split_part(F.col("path"), F.lit("/"), F.lit(1))
    known = F.try_element_at(pri, folder)
    nested = F.col("path").contains("/") & F.col("path").contains("model")
    cand = artifacts.select(
        "run_id",
        F.when(known.isNotNull() | nested, folder).alias("path"),
        F.coalesce(known, F.when(nested, F.lit(len(candidates)))).alias("priority"))
    cand = cand.filter(F.col("priority").isNotNull())
    return cand.groupBy("run_id").agg(F.min_by("path", F.struct("priority", "path")).alias("path"))


def promote(registry: DataFrame, run_id_value) -> DataFrame:
    """Register ``run_id_value`` (a Column, e.g. a scalar subquery) as version max+1 in
    stage Production; the previous Production version becomes Archived."""
    new_version = registry.agg(F.coalesce(F.max("version"), F.lit(0)) + 1).scalar()
    new_row = registry.sparkSession.range(1).select(new_version.cast("int").alias("version"),
                                                    run_id_value.cast(registry.schema["run_id"].dataType).alias("run_id"),
                                                    F.lit("Production").alias("stage"))
    old = registry.withColumn("stage", F.when(F.col("stage") == "Production", F.lit("Archived"))
                              .otherwise(F.col("stage")))
    return old.unionByName(new_row)


def resolve_production(registry: DataFrame, lb: DataFrame, metric: str = "roc_auc") -> DataFrame:
    """The Production version's run, else the best run of the leaderboard (one row)."""
    lb = lb.filter(F.col(metric).isNotNull())
    prod = registry.filter(F.col("stage") == "Production").agg(
        F.max_by(F.struct("version", "run_id"), "version").alias("p"))
    best = lb.agg(F.min_by("run_id", _best_key(metric, "run_id")).alias("b"))
    return prod.select(F.col("p.version").alias("version"),
                       F.coalesce(F.col("p.run_id"), best.scalar()).alias("run_id"),
                       F.when(F.col("p").isNotNull(), F.lit("registry")).otherwise(F.lit("leaderboard")).alias("source"))


def best_child_per_parent(children: DataFrame, score: str, payload: list[str], parent: str = "parent_run_id") -> DataFrame:
    """Per parent: the child with the highest score (ties: smallest run id), with its payload."""
    key = _best_key(score, "run_id")
    return children.filter(F.col(score).isNotNull()).groupBy(parent).agg(
        F.min_by(F.struct("run_id", score, *payload), key).alias("b")) \
        .select(parent, F.col("b.run_id").alias("best_run_id"), F.col("b")[score].alias("best_" + score),
                *[F.col("b")[p].alias(p) for p in payload])


# A shared registry ------------------------------------------------------------------------

class Registry:
    """Model versions (version, run_id, stage) in a shared folder. Every state is a Parquet table of its own, and a numbered
    commit names it: who commits a number first has promoted, everyone else reads that state and tries the next number. So
    each promotion sees all before it, and one version at most is in Production."""

    SCHEMA = "version int, run_id string, stage string"

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")

    def read(self) -> tuple[int, DataFrame]:
        """Number of the last commit, and its table."""
        names = names_in(self.spark, f"{self.root}/commits")
        if not names:
            return 0, self.spark.createDataFrame([], self.SCHEMA)
        path = get_text(self.spark, f"{self.root}/commits/{names[-1]}")
        return int(names[-1]), self.spark.read.schema(self.SCHEMA).parquet(path)

    def promote(self, run_id: str, attempts: int = 100) -> int:
        """Register the run as the next version, in Production, and archive the one before; the version's number."""
        for _ in range(attempts):
            number, table = self.read()
            path = f"{self.root}/states/{uuid.uuid4().hex}"
            promote(table, F.lit(run_id)).coalesce(1).write.parquet(path)
            if put_new(self.spark, f"{self.root}/commits/{number + 1:012d}", path):
                return self.spark.read.schema(self.SCHEMA).parquet(path).agg(F.max("version")).first()[0]
        raise RuntimeError(f"no commit in {attempts} attempts")


def load_production(registry: DataFrame, log: RunLog, metric: str = "roc_auc") -> tuple[PipelineModel, dict]:
    """The model to serve: the Production version's run, else the log's best top-level run by ``metric`` (sub-runs of a search
    aren't served); of its artifacts the one that :func:`resolve_artifacts` picks, loaded; and where it came from."""
    runs = log.read("runs").filter(F.col("parent_run_id").isNull()).select("run_id")
    best = runs.join(latest_wide(log.read("run_metrics"), [metric]), "run_id", "left")
    row = resolve_production(registry, best, metric).first()  # one row
    if row["run_id"] is None:
        raise LookupError("no version in Production and no run with a " + metric)
    own = log.read("run_artifacts").filter(F.col("run_id") == row["run_id"])
    folder = F.split_part(F.col("path"), F.lit("/"), F.lit(1)).alias("folder")
    found = own.select("run_id", folder, "uri").join(
        resolve_artifacts(own).select("run_id", F.col("path").alias("folder")), ["run_id", "folder"]).agg(F.min("uri").alias("uri")).first()
    if found["uri"] is None:
        raise LookupError(f"run {row['run_id']} has no model among its artifacts")
    return PipelineModel.load(found["uri"]), {**row.asDict(), "uri": found["uri"]}
