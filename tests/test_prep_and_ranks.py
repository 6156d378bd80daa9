import numpy as np
import pandas as pd
from pyspark.sql import functions as F

from tessera.operators import prep as I
from tessera.operators.ranks import BUCKET, exact_quantiles, running_totals, value_buckets, with_quantile_buckets


def test_exact_median_even_count_and_all_null(spark):
    df = spark.createDataFrame([(1.0, None), (2.0, None), (6.5, None), (8.0, None)], "a double, b double")
    med = I.fit_medians(df, ["a", "b"])
    assert med["a"] == 4.25
    assert med["b"] is None


def test_exact_quantiles_match_numpy_with_hot_value(spark):
    rng = np.random.default_rng(7)
    vals = np.concatenate([rng.normal(size=3000), np.full(1500, 0.25), rng.integers(0, 5, 500).astype(float)])
    df = spark.createDataFrame(pd.DataFrame({"g": rng.integers(0, 3, len(vals)), "v": vals}))
    probs = [0.0, 0.1, 0.25, 0.5, 0.75, 0.9, 1.0]
    q = {(r["g"], r["p"]): r["value"] for r in exact_quantiles(df, ["v"], probs, keys=["g"], n_buckets=16).collect()}
    pdf = df.toPandas()
    for g, sub in pdf.groupby("g"):
        for p in probs:
            assert abs(q[(g, p)] - np.quantile(sub["v"].to_numpy(), p)) < 1e-12


def test_exact_quantiles_columns_of_different_scale_nan_and_null(spark):
    # per-column bucket edges: one column in [0, 1e6] with a hot value, one tiny, one with NaN/null
    rng = np.random.default_rng(11)
    n = 4000
    a = np.where(rng.random(n) < 0.35, 123456.0, rng.uniform(0, 1e6, n))
    b = rng.normal(scale=1e-3, size=n)
    c = rng.integers(-3, 3, n).astype(float)
    c[rng.random(n) < 0.1] = np.nan
    pdf = pd.DataFrame({"a": a, "b": b, "c": c})
    df = spark.createDataFrame(pdf).withColumn("c", F.when(F.col("c") == -3, None).otherwise(F.col("c")))
    probs = [0.0, 0.2, 0.5, 0.8, 1.0]
    q = {(r["col_name"], r["p"]): r["value"] for r in exact_quantiles(df, ["a", "b", "c"], probs, n_buckets=7).collect()}
    cc = pdf["c"].to_numpy()
    cc = cc[~np.isnan(cc) & (cc != -3)]
    for name, arr in (("a", a), ("b", b), ("c", cc)):
        for p in probs:
            assert abs(q[(name, p)] - np.quantile(arr, p)) <= 1e-9 * max(1.0, abs(np.quantile(arr, p)))


def test_value_buckets_monotone_within_group(spark):
    pdf = pd.DataFrame({"g": ["x"] * 500 + ["y"] * 500,
                        "v": np.concatenate([np.arange(500) * 1000.0, np.arange(500) / 1000.0])})
    out = value_buckets(spark.createDataFrame(pdf), "v", 5, by="g").toPandas().sort_values(["g", "v"])
    for _g, sub in out.groupby("g"):
        b = sub[BUCKET].to_numpy()
        assert (np.diff(b) >= 0).all() and b.max() - b.min() >= 3  # spread over the buckets


def test_running_totals_equal_cumsum(spark):
    rng = np.random.default_rng(3)
    pdf = pd.DataFrame({"k": rng.integers(0, 2, 2000), "x": rng.permutation(2000).astype(float), "w": rng.integers(1, 5, 2000)})
    df = with_quantile_buckets(spark.createDataFrame(pdf), ["x"], 10).withColumnRenamed("x__b", "_bucket")
    out = running_totals(df, ["k"], "_bucket", [F.col("x")], ["w"]).toPandas().sort_values(["k", "x"])
    exp = pdf.sort_values(["k", "x"]).groupby("k")["w"].cumsum()
    assert (out["cum_w"].to_numpy() == exp.to_numpy()).all()


def test_running_totals_plan_has_no_single_partition_window(spark):
    df = with_quantile_buckets(spark.range(1000).withColumn("x", F.rand(1)).withColumn("k", F.col("id") % 2)
                               .withColumn("w", F.lit(1)), ["x"], 8).withColumnRenamed("x__b", "_bucket")
    plan = running_totals(df, ["k"], "_bucket", [F.col("x")], ["w"])._jdf.queryExecution().executedPlan().toString()
    # the only windows are partitioned by key (small table) or (key, bucket)
    assert "Window" in plan


def test_mode_ties_smallest_and_constant_std(spark):
    df = spark.createDataFrame([("b", 1.0), ("a", 1.0), ("b", 1.0), ("a", 1.0), (None, 1.0)], "c string, x double")
    assert I.fit_modes(df, ["c"])["c"] == "a"
    st = I.standardise_fit(df, ["x"])
    assert st["x"] == (1.0, 1.0)  # std 0 -> divide by 1


def test_population_scaler_and_unknown_category(spark):
    train = spark.createDataFrame([(1.0, "x"), (2.0, "y"), (3.0, "x")], "v double, c string")
    m = I.preprocessor(["v"], ["c"]).fit(train)
    test = spark.createDataFrame([(2.0, "z")], "v double, c string")
    from pyspark.ml.functions import vector_to_array
    row = m.transform(train.union(test)).select(vector_to_array("features").alias("f")).collect()
    std = np.std([1.0, 2.0, 3.0])
    assert abs(row[0]["f"][0] - (1.0 - 2.0) / std) < 1e-12
    assert row[0]["f"][1:] == [1.0, 0.0]
    assert row[3]["f"][1:] == [0.0, 0.0]  # unknown category -> all zeros
    assert I.encoded_names(m, ["v"], ["c"]) == ["v", "c_x", "c_y"]


def test_describe_exact_vs_sketch(spark, sf_small):
    from tessera.operators import profile as P
    from tessera.sources import fixtures
    s = fixtures.subjects(spark, sf_small)
    ex = {r["col_name"]: r for r in P.describe(s, ["age", "fare"]).collect()}
    ap = {r["col_name"]: r for r in P.describe(s, ["age", "fare"], exact=False).collect()}
    for c in ("age", "fare"):
        assert ex[c]["count"] == ap[c]["count"] and ex[c]["mean"] == ap[c]["mean"]
        spread = ex[c]["max"] - ex[c]["min"]
        for q in ("q25", "q50", "q75"):
            assert abs(ex[c][q] - ap[c][q]) <= 0.01 * spread


def test_describe_matches_pandas_edge_columns(spark):
    from tessera.operators import profile as P
    rng = np.random.default_rng(21)
    n = 3000
    pdf = pd.DataFrame({
        "hot": np.where(rng.random(n) < 0.4, 7.5, rng.normal(100.0, 30.0, n)),
        "gaps": np.where(rng.random(n) < 0.2, np.nan, rng.integers(0, 9, n).astype(float)),
        "one": np.where(np.arange(n) == 5, 42.0, np.nan),
        "none": np.full(n, np.nan),
    })
    df = spark.createDataFrame(pdf)
    got = {r["col_name"]: r for r in P.describe(df, list(pdf.columns)).collect()}
    exp = pdf.describe()
    for c in pdf.columns:
        e = exp[c]
        assert got[c]["count"] == int(e["count"])
        for k, name in (("mean", "mean"), ("std", "std"), ("min", "min"), ("q25", "25%"), ("q50", "50%"),
                        ("q75", "75%"), ("max", "max")):
            if np.isnan(e[name]):
                assert got[c][k] is None, (c, k)
            else:
                assert abs(got[c][k] - round(e[name], 6)) <= 1e-6 * max(1.0, abs(e[name])), (c, k)


def test_group_median_fill_fallbacks(spark):
    rows = [("a", 1.0), ("a", 3.0), ("a", None), ("b", 10.0), ("b", 20.0), ("b", 40.0), ("b", None),
            ("c", None), (None, 100.0), (None, None), ("d", None)]
    df = spark.createDataFrame(rows, "g string, v double")
    fit_on = df.filter(F.col("g").isNull() | (F.col("g") != "d"))  # group d unseen when fitting
    out = I.group_median_fill(df, "v", ["g"], fit_on=fit_on).collect()
    glob = float(np.median([1.0, 3.0, 10.0, 20.0, 40.0, 100.0]))
    filled = [(r["g"], r["v"]) for r in out]
    assert filled.count(("a", 2.0)) == 1 and filled.count(("b", 20.0)) == 2
    # all-null group c, unseen group d and the null key take the global median
    assert ("c", glob) in filled and ("d", glob) in filled and (None, glob) in filled


def test_one_scan_fit_equals_separate_fits(spark):
    rows = [(1.0, "b", 3, None), (2.0, "a", 3, None), (float("nan"), "b", 1, None), (None, "a", 1, None),
            (8.0, None, 1, None), (4.0, "c", None, None)]
    df = spark.createDataFrame(rows, "x double, s string, k int, z double")
    both = I.fit_medians_and_modes(df, ["x", "z"], ["s", "k", "z"])
    assert both == {**I.fit_medians(df, ["x", "z"]), **I.fit_modes(df, ["s", "k", "z"])}
    assert both["x"] == 3.0 and both["s"] == "a" and both["k"] == 1 and both["z"] is None
    # NaN is missing for modes too: 2.0 (twice) beats NaN (three times)
    nan = spark.createDataFrame([(float("nan"),)] * 3 + [(2.0,), (2.0,), (5.0,)], "w double")
    assert I.fit_modes(nan, ["w"]) == I.fit_medians_and_modes(nan, [], ["w"]) == {"w": 2.0}


def test_empty_input_gives_empty_fits(spark):
    from tessera.operators import profile as P
    e = spark.createDataFrame([], "a double, b string")
    assert I.fit_medians(e, ["a"]) == {}
    assert P.describe(e, ["a"]).count() == 0
    assert I.fit_medians_and_modes(e, ["a"], ["b"]) == {"b": None}


def test_exact_quantiles_with_capped_sketch_accuracy(spark):
    from tessera.operators.ranks import MAX_SKETCH_ACCURACY, sketch_accuracy
    assert sketch_accuracy(3000) == MAX_SKETCH_ACCURACY  # 50 per bucket would exceed the cap
    vals = np.random.default_rng(4).lognormal(size=5000)
    df = spark.createDataFrame(pd.DataFrame({"v": vals}))
    probs = [0.0, 0.33, 0.5, 0.99, 1.0]
    q = {r["p"]: r["value"] for r in exact_quantiles(df, ["v"], probs, n_buckets=3000).collect()}
    for p in probs:
        assert abs(q[p] - np.quantile(vals, p)) <= 1e-12 * max(1.0, abs(np.quantile(vals, p)))
