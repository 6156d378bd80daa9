import pandas as pd

from tessera.operators import evaluate as V
from tessera.operators import split as T


def test_quota_golden_891():
    assert T.class_quotas({0: 549, 1: 342}, 0.2) == {0: 110, 1: 69}


def test_null_label_is_rejected():
    import pytest
    with pytest.raises(ValueError):
        T.class_quotas({0: 5, None: 2}, 0.2)


def test_split_exact_sizes_and_folds(spark):
    rows = [(i, 1 if i % 3 == 0 else 0) for i in range(1, 892)]
    df = spark.createDataFrame(rows, "subject_id long, label int")
    s = T.stratified_split(df)
    got = {(r["split"], r["label"]): r["count"] for r in s.groupBy("split", "label").count().collect()}
    n1 = sum(1 for _, y in rows if y == 1)
    q = T.class_quotas({0: 891 - n1, 1: n1}, 0.2)
    assert got[("test", 0)] == q[0] and got[("test", 1)] == q[1]
    assert sum(q.values()) == 179
    folds = T.stratified_folds(df, k=5).groupBy("label", "fold").count().toPandas()
    for _, g in folds.groupby("label"):
        assert g["count"].max() - g["count"].min() <= 1


def _scored(spark, rows):
    return spark.createDataFrame(rows, "model string, label int, score double, pred int")


def test_classification_report_golden(spark):
    # counts implied by the modelled report: TP 52, FN 17, TN 99, FP 11
    rows = [("m", 1, 0.9, 1)] * 52 + [("m", 1, 0.1, 0)] * 17 + [("m", 0, 0.1, 0)] * 99 + [("m", 0, 0.9, 1)] * 11
    rep = {r["class"]: r for r in V.classification_report(_scored(spark, rows), ["model"]).collect()}
    assert round(rep["1"]["recall"], 2) == 0.75 and round(rep["0"]["recall"], 2) == 0.90
    assert round(rep["1"]["precision"], 2) == 0.83 and round(rep["0"]["precision"], 2) == 0.85
    assert round(rep["accuracy"]["f1"], 2) == 0.84 and rep["accuracy"]["support"] == 179
    assert round(rep["1"]["f1"], 2) == 0.79 and round(rep["0"]["f1"], 2) == 0.88
    assert round(rep["macro avg"]["f1"], 2) == 0.83


def test_auc_edges_and_ap_example(spark):
    perfect = _scored(spark, [("m", 1, 0.9, 1), ("m", 1, 0.8, 1), ("m", 0, 0.2, 0), ("m", 0, 0.1, 0)])
    tied = _scored(spark, [("m", 1, 0.5, 1), ("m", 0, 0.5, 1), ("m", 1, 0.5, 1), ("m", 0, 0.5, 1)])
    assert V.roc_auc(perfect, ["model"]).first()["roc_auc"] == 1.0
    assert V.roc_auc(tied, ["model"]).first()["roc_auc"] == 0.5
    six = _scored(spark, [("m", 1, 0.9, 1), ("m", 0, 0.8, 1), ("m", 1, 0.7, 1), ("m", 1, 0.6, 1), ("m", 0, 0.5, 1),
                          ("m", 0, 0.4, 0)])
    # sum (R_i - R_{i-1}) P_i = 1/3*1 + 1/3*2/3 + 1/3*3/4
    exp = (1 + 2 / 3 + 3 / 4) / 3
    assert abs(V.average_precision(six, ["model"]).first()["average_precision"] - round(exp, 6)) < 1e-9


def test_calibration_edges_and_zero_denominators(spark):
    df = _scored(spark, [("m", 0, 0.1, 0), ("m", 1, 0.5, 1), ("m", 1, 0.11, 0), ("m", 0, 1.0, 1), ("m", 0, 0.0, 0)])
    bins = {r["bin"]: r["n"] for r in V.calibration_table(df, ["model"]).collect()}
    assert bins == {0: 2, 1: 1, 4: 1, 9: 1}
    nopos = _scored(spark, [("m", 0, 0.1, 0), ("m", 1, 0.2, 0)])
    m = V.binary_metrics(nopos, ["model"]).first()
    assert m["precision"] == 0.0 and m["recall"] == 0.0 and m["f1"] == 0.0


def test_roc_curve_matches_bruteforce(spark):
    import numpy as np
    rng = np.random.default_rng(5)
    pdf = pd.DataFrame({"model": "m", "label": rng.integers(0, 2, 500), "score": rng.integers(0, 40, 500) / 40.0})
    pdf["pred"] = (pdf["score"] >= 0.5).astype(int)
    curve = V.roc_curve(spark.createDataFrame(pdf), ["model"], drop_intermediate=False).toPandas()
    P, N = pdf["label"].sum(), (1 - pdf["label"]).sum()
    for s in sorted(pdf["score"].unique()):
        sel = pdf[pdf["score"] >= s]
        row = curve[curve["threshold"] == s].iloc[0]
        assert row["tpr"] == sel["label"].sum() / P and row["fpr"] == (1 - sel["label"]).sum() / N


def _roc_drop_intermediate(y, s):
    """Reference rule: points at distinct scores (descending); keep first, last and every
    point where the second difference of fps or tps is non-zero; prepend (inf, 0, 0)."""
    import numpy as np
    o = np.argsort(-s, kind="mergesort")
    s, y = s[o], y[o]
    idx = np.r_[np.where(np.diff(s))[0], len(y) - 1]
    tps = np.cumsum(y)[idx]
    fps = 1 + idx - tps
    thr = s[idx]
    if len(fps) > 2:
        keep = np.where(np.r_[True, np.logical_or(np.diff(fps, 2), np.diff(tps, 2)), True])[0]
        fps, tps, thr = fps[keep], tps[keep], thr[keep]
    return np.r_[np.inf, thr], np.r_[0, fps] / fps[-1], np.r_[0, tps] / tps[-1]


def test_roc_curve_drops_collinear_points_like_reference(spark):
    import numpy as np
    rng = np.random.default_rng(9)
    parts = []
    for m, n in (("a", 700), ("b", 300)):
        # mostly unique scores (runs of one label are collinear) plus a block of ties
        sc = np.r_[rng.permutation(n) / n, rng.integers(0, 5, 60) / 5.0]
        y = (rng.random(len(sc)) < sc).astype(int)
        parts.append(pd.DataFrame({"model": m, "label": y, "score": sc}))
    pdf = pd.concat(parts, ignore_index=True)
    pdf["pred"] = (pdf["score"] >= 0.5).astype(int)
    curve = V.roc_curve(spark.createDataFrame(pdf), ["model"]).toPandas()
    full = V.roc_curve(spark.createDataFrame(pdf), ["model"], drop_intermediate=False).count()
    assert len(curve) < full
    for m, sub in pdf.groupby("model"):
        thr, fpr, tpr = _roc_drop_intermediate(sub["label"].to_numpy(), sub["score"].to_numpy())
        got = curve[curve["model"] == m].sort_values("threshold", ascending=False)
        assert len(got) == len(thr)
        assert np.allclose(got["threshold"].to_numpy(), thr) and np.allclose(got["fpr"].to_numpy(), fpr)
        assert np.allclose(got["tpr"].to_numpy(), tpr)
