"""Answers on inputs that the stand-in tables avoid: integer medians, NaN, null keys, null scores, forests, CSV oddities."""

import math
import types

import pytest
from pyspark.sql import functions as F

from tessera import session
from tessera.operators import evaluate as V
from tessera.operators import explain as H
from tessera.operators import prep as I
from tessera.operators import registry as L
from tessera.session import new_scratch_path
from tessera.sources.csv import read_csv


def test_integer_column_takes_a_fractional_median(spark):
    df = spark.createDataFrame([(1,), (2,), (None,)], "x int")
    out = I.fill(df, I.fit_medians(df, ["x"]))
    assert sorted(r.x for r in out.collect()) == [1.0, 1.5, 2.0]
    model = I.ExactImputer(inputCols=["x"], outputCols=["y"], strategy="median").fit(df)
    assert sorted(r.y for r in model.transform(df).collect()) == [1.0, 1.5, 2.0]


def test_nan_is_filled_and_moments_stay_finite(spark):
    df = spark.createDataFrame([(1.0, "a"), (3.0, "a"), (math.nan, "a")], "x double, g string")
    for exact in (True, False):
        med = I.fit_medians(df, ["x"], exact=exact)["x"]
        assert med == (2.0 if exact else 1.0)
    out = I.fill(df, {"x": 2.0})
    assert sorted(r.x for r in out.collect()) == [1.0, 2.0, 3.0]
    mean, std = I.standardise_fit(out, ["x"])["x"]
    assert mean == 2.0 and not math.isnan(std)
    assert sorted(r.x for r in I.group_median_fill(df, "x", ["g"]).collect()) == [1.0, 2.0, 3.0]


def test_null_key_is_a_group(spark):
    rows = [("a", 1, 0.9, 1), ("a", 0, 0.1, 0), (None, 1, 0.2, 0), (None, 0, 0.8, 1)]
    df = spark.createDataFrame(rows, "model string, label int, score double, pred int")
    assert {r.model: r.roc_auc for r in V.roc_auc(df, ["model"]).collect()} == {"a": 1.0, None: 0.0}
    assert {r.model for r in V.model_comparison(df).collect()} == {"a", None}


def test_null_and_nan_scores_are_not_ranked(spark):
    df = spark.createDataFrame([("m", 1, 0.9), ("m", 0, 0.1), ("m", 0, None), ("m", 0, math.nan), ("m", None, 0.95)],
                               "model string, label int, score double")
    assert V.roc_auc(df, ["model"]).first().roc_auc == 1.0
    assert V.roc_curve(df, ["model"]).filter("threshold is null or isnan(threshold)").count() == 0


def test_tree_attributions_refuse_a_forest(spark):
    with pytest.raises(TypeError):
        H.tree_attributions(spark.range(1), "id", "features", object(), [])


def test_csv_line_feeds_header_order_and_bad_values(spark):
    path = new_scratch_path(spark, "csv")
    lines = ['name,id,age', '"Doe, ""J""\nJr",1,30', 'Ann,2,NA']
    spark.createDataFrame([("\n".join(lines),)], "value string").coalesce(1).write.text(path)
    rows = {r.id: r for r in read_csv(spark, path, "id int, name string, age double", multi_line=True).collect()}
    assert rows[1].name == 'Doe, "J"\nJr' and rows[1].age == 30.0 and rows[2].age is None
    with pytest.raises(Exception):
        read_csv(spark, path, "id int, age date", multi_line=True).collect()
    with pytest.raises(ValueError):
        read_csv(spark, path, "id int, other string")


def test_artifacts_are_matched_by_folder_first(spark):
    rows = [(1, "baseline_model/MLmodel"), (1, "gradient_boosting_model"), (2, "my_model/data.bin"), (3, "plots/roc.png"), (4, "x/model.pkl")]
    got = {r.run_id: r.path for r in L.resolve_artifacts(spark.createDataFrame(rows, "run_id long, path string")).collect()}
    assert got == {1: "baseline_model", 2: "my_model", 4: "x"}


def test_fallback_run_needs_the_metric_alone(spark):
    none = spark.createDataFrame([], "version int, run_id long, stage string")
    runs = spark.createDataFrame([(1, 0.8, None), (2, 0.9, None), (3, None, 1.0)], "run_id long, roc_auc double, accuracy double")
    assert L.resolve_production(none, runs).first().run_id == 2


def test_a_cluster_needs_a_shared_folder():
    conf = types.SimpleNamespace(get=lambda *_: None)
    context = types.SimpleNamespace(master="spark://host:7077", getCheckpointDir=lambda: None)
    with pytest.raises(RuntimeError):
        session.scratch_dir(types.SimpleNamespace(sparkContext=context, conf=conf))


def test_hot_keys_are_broadcast(spark):
    df = spark.range(20).select(F.col("id").cast("double").alias("x"), (F.col("id") % 2).cast("string").alias("g"))
    plan = I.group_median_fill(df, "x", ["g"])._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan
