import math

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from ebbtide.operators import drift, evaluate, fairness, profile


def auc_brute(y, s):
    pos, neg = s[y == 1], s[y == 0]
    return np.mean([(p > n) + 0.5 * (p == n) for p in pos for n in neg])


def scored(spark, n=400, seed=3):
    rng = np.random.default_rng(seed)
    y = rng.integers(0, 2, n)
    s = np.round(0.3 * y + 0.7 * rng.random(n), 2)
    s[: n // 3] = 0.5
    pdf = pd.DataFrame({"id": np.arange(n), "y": y, "s": s, "yhat": (s >= 0.5).astype(int), "g": rng.integers(0, 2, n)})
    return pdf, spark.createDataFrame(pdf)


def test_auc_with_ties(spark):
    pdf, df = scored(spark)
    assert abs(evaluate.roc_auc(df, "y", "s").first().roc_auc - auc_brute(pdf.y, pdf.s)) < 1e-12


def test_auc_degenerate(spark):
    one = spark.createDataFrame([(1, 0.1), (1, 0.9)], "y int, s double")
    assert evaluate.roc_auc(one, "y", "s").first().roc_auc is None
    tied = spark.createDataFrame([(1, 0.5), (0, 0.5), (0, 0.5)], "y int, s double")
    assert evaluate.roc_auc(tied, "y", "s").first().roc_auc == 0.5


def test_roc_trapezoid_equals_auc(spark):
    _, df = scored(spark)
    p = evaluate.roc_points(df, "y", "s").orderBy("fpr", "tpr").toPandas()
    area = np.trapezoid(p.tpr, p.fpr)
    assert p.iloc[0].fpr == 0 and p.iloc[-1].tpr == 1 and abs(area - evaluate.roc_auc(df, "y", "s").first().roc_auc) < 1e-12


def test_pr_area_equals_trapezoid_over_points(spark):
    _, df = scored(spark)
    p = evaluate.pr_points(df, "y", "s").orderBy(F.col("threshold").desc_nulls_first()).toPandas()
    area = sum((b.recall - a.recall) * (a.precision + b.precision) / 2 for a, b in zip(p.iloc[:-1].itertuples(), p.iloc[1:].itertuples()))
    assert abs(area - evaluate.pr_auc(df, "y", "s").first().pr_auc) < 1e-12


def test_no_predicted_positive(spark):
    df = spark.createDataFrame([(1, 0), (0, 0)], "y int, yhat int")
    r = evaluate.core_metrics(df, "y", "yhat").first()
    assert (r.precision, r.recall, r.f1, r.accuracy) == (0, 0, 0, 0.5)


def test_calibration_edges(spark):
    df = spark.createDataFrame([(0.0, 0), (0.1, 0), (0.10001, 1), (1.0, 1)], "p double, y int")
    assert [(r.bin, r.n_rows) for r in evaluate.calibration(df, "y", "p").orderBy("bin").collect()] == [(0, 2), (1, 1), (9, 1)]


def test_leakage_needs_rows(spark):
    df = spark.createDataFrame([(float(i), i % 2, float(i % 2)) for i in range(60)], "ok double, y int, leak double")
    got = {r.feature: r.leaks for r in evaluate.leakage_auc(df, ["ok", "leak"], "y").collect()}
    assert got == {"ok": False, "leak": True}
    assert evaluate.leakage_auc(df.limit(10), ["ok"], "y").count() == 0


def test_top_decile(spark):
    pdf, df = scored(spark)
    top = pdf.sort_values(["s", "id"], ascending=[False, True]).head(40)
    r = evaluate.top_decile_capture(df, "id", "y", "s").first()
    assert r.n_top == 40 and r.captured == top.y.sum() and abs(r.capture_rate - top.y.sum() / pdf.y.sum()) < 1e-12


def test_fairness_by_hand_and_empty_group(spark):
    pdf, df = scored(spark)
    u, p = pdf[pdf.g == 0], pdf[pdf.g == 1]
    r = fairness.fairness_metrics(df, "y", "yhat", "g").first()
    tpr = lambda d: d[d.y == 1].yhat.mean()
    fpr = lambda d: d[d.y == 0].yhat.mean()
    assert abs(r.demographic_parity_diff - (u.yhat.mean() - p.yhat.mean())) < 1e-12
    assert abs(r.equalized_odds_diff - 0.5 * ((fpr(u) - fpr(p)) + (tpr(u) - tpr(p)))) < 1e-12
    alone = fairness.fairness_metrics(df.where("g = 1"), "y", "yhat", "g")
    assert alone.first().demographic_parity_diff is None
    assert fairness.fairness_verdict(alone).first().is_fair is False


def test_reweighing_makes_independent(spark):
    _, df = scored(spark)
    w = fairness.reweighing(df, "g", "y")
    t = {(r.g, r.y): r.w for r in w.groupBy("g", "y").agg(F.sum("weight").alias("w")).collect()}
    assert abs(t[(0, 1)] / (t[(0, 0)] + t[(0, 1)]) - t[(1, 1)] / (t[(1, 0)] + t[(1, 1)])) < 1e-12
    assert w.count() == df.count()


def test_ks_against_brute_force(spark):
    pdf, df = scored(spark)
    a, b = np.sort(pdf.s[pdf.g == 0]), np.sort(pdf.s[pdf.g == 1])
    grid = np.unique(pdf.s)
    want = np.max(np.abs(np.searchsorted(a, grid, "right") / len(a) - np.searchsorted(b, grid, "right") / len(b)))
    r = evaluate.ks_two_sample(df, "s", "g").first()
    assert abs(r.ks - want) < 1e-12 and 0 <= r.p_value <= 1
    lam = want * math.sqrt(len(a) * len(b) / (len(a) + len(b)))
    series = 2 * sum((-1) ** (k - 1) * math.exp(-2 * k * k * lam * lam) for k in range(1, 101))
    assert lam < 0.2 or abs(r.p_value - min(1, max(0, series))) < 1e-9


def psi_numpy(base, cur):
    e = np.unique(np.percentile(base, np.linspace(0, 100, 11)))
    b, c = np.histogram(base, e)[0] + 1, np.histogram(cur, e)[0] + 1
    b, c = b / b.sum(), c / c.sum()
    return float(((c - b) * np.log(c / b)).sum())


@pytest.mark.parametrize("shift", [0.0, 0.7, 50.0])
def test_psi_matches_definition(spark, shift):
    rng = np.random.default_rng(8)
    base, cur = rng.normal(size=500).round(1), (rng.normal(size=300) + shift).round(1)
    a = spark.createDataFrame(pd.DataFrame({"x": base, "same": 1.0}))
    b = spark.createDataFrame(pd.DataFrame({"x": cur, "same": 1.0}))
    got = {r.feature: r for r in drift.psi(a, b).collect()}
    assert got["same"].psi == 0.0
    if shift < 50:
        assert abs(got["x"].psi - psi_numpy(base, cur)) < 1e-9
    else:
        assert abs(got["x"].psi - psi_numpy(base, cur)) < 1e-9 and got["x"].outside_share == 1.0
        assert drift.psi(a, b, ["x"], open_ends=True).first().psi > 1


def test_drift_columns(spark):
    a = spark.createDataFrame([(1, "t", 1.0)], "b int, s string, only double")
    c = spark.createDataFrame([(1.0, 1)], "b double, s int")
    assert drift.common_numeric(a, c) == ["b"]


def test_correlation_with_constant(spark):
    df = spark.createDataFrame([(1.0, 5.0, 2.0), (2.0, 5.0, 4.0), (3.0, 5.0, None)], "a double, k double, b double")
    r = {(x.feature_a, x.feature_b): x.r for x in profile.correlation_matrix(df, ["a", "k", "b"]).collect()}
    assert r[("k", "a")] is None and abs(r[("b", "a")] - 1) < 1e-12


def test_profile_skew_and_histogram(spark):
    x = [1.0, 2.0, 2.0, 3.0, 10.0]
    df = spark.createDataFrame([(v, 7.0) for v in x], "x double, c double")
    r = profile.univariate_profile(df, ["x"]).first()
    assert abs(r.skew - pd.Series(x).skew()) < 1e-9 and r.shape == "right-skewed" and r.median == 2.0
    h = {(q.feature, q.bin): q.n_rows for q in profile.histogram(df, ["x", "c"], 3).collect()}
    assert h == {("x", 0): 4, ("x", 2): 1, ("c", 1): 5}


def test_signals_and_gates(spark):
    df = spark.createDataFrame([(1, 0.9, -0.2, 0.6, 0.0)], "id int, a double, b double, c double, d double")
    got = [(r.position, r.feature, r.impact, r.strength) for r in evaluate.top_signals(df, "id", ["a", "b", "c", "d"]).orderBy("position").collect()]
    assert got == [(1, "a", "INCREASES_CHURN", "HIGH"), (2, "c", "INCREASES_CHURN", "HIGH"), (3, "b", "DECREASES_CHURN", "MEDIUM")]
    m = spark.createDataFrame([(0.9, 0.5, None)], "roc_auc double, recall double, f1 double")
    assert {r.metric: r.passed for r in evaluate.quality_gates(m).collect()} == {"roc_auc": True, "recall": False, "f1": False}
