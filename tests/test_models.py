import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from ebbtide.operators import attribution, encode, evaluate, models, sampling

FEATURES = ["feature_1", "feature_2", "feature_3"]


@pytest.fixture(scope="module")
def data(spark):
    rng = np.random.default_rng(42)
    n = 300
    f1, f2, f3 = rng.normal(size=n), rng.normal(size=n), rng.random(n)
    y = (f1 + 0.5 * f2 + rng.normal(scale=0.7, size=n) > 0.6).astype(int)
    return spark.createDataFrame(pd.DataFrame({"id": np.arange(n), "feature_1": f1, "feature_2": f2, "feature_3": f3, "y": y})).cache()


def test_split_is_stratified_and_disjoint(data):
    s = sampling.stratified_split(data, "id", "y", 0.2, 0.15).toPandas()
    assert len(s) == 300 and s.id.is_unique
    share = s.split.value_counts(normalize=True)
    assert abs(share["test"] - 0.2) < 0.01 and abs(share["val"] - 0.12) < 0.01
    rates = s.groupby("split").y.mean()
    assert (abs(rates - s.y.mean()) < 0.025).all()


def test_folds_are_balanced(data):
    f = sampling.stratified_folds(data, "id", "y", 5).toPandas()
    table = f.groupby(["y", "fold"]).size().unstack()
    assert (table.max(axis=1) - table.min(axis=1) <= 1).all()


@pytest.fixture(scope="module")
def fitted(data):
    s = sampling.stratified_split(data, "id", "y")
    train, test = s.where("split = 'train'"), s.where("split = 'test'")
    scale = encode.standardize_fit(train, FEATURES)
    return encode.standardize_apply(train, scale).cache(), encode.standardize_apply(test, scale).cache()


def test_logistic_beats_baseline(fitted):
    train, test = fitted
    scored = models.score(test, models.fit_logistic(train, FEATURES, "y"))
    m = evaluate.core_metrics(scored, "y", "prediction", "probability").first()
    base = models.majority_baseline(train, test, "y")
    b = evaluate.core_metrics(base, "y", "prediction", "probability").first()
    assert m.roc_auc > 0.8 and b.roc_auc == 0.5 and b.recall == 0.0
    assert scored.where("probability < 0 or probability > 1 or risk_tier is null").count() == 0


def test_logistic_penalty_matches_summed_loss(fitted):
    """The optimum of 0.5 |w|^2 + C * sum(loss), found here by Newton steps."""
    train, _ = fitted
    lr = models.fit_logistic(train, FEATURES, "y").stages[-1]
    pdf = train.toPandas()
    x = np.c_[np.ones(len(pdf)), pdf[FEATURES]]
    w, ridge = np.zeros(4), np.diag([0.0, 1, 1, 1])
    for _ in range(30):
        p = 1 / (1 + np.exp(-x @ w))
        w -= np.linalg.solve(x.T @ (x * (p * (1 - p))[:, None]) + ridge, x.T @ (p - pdf.y) + ridge @ w)
    assert np.allclose([lr.intercept, *lr.coefficients], w, atol=1e-3)


def test_save_and_load(spark, fitted, tmp_path):
    train, test = fitted
    model = models.fit_forest(train, FEATURES, "y", trees=5, depth=3)
    path = models.save_model(model, str(tmp_path), "forest", "1.2.0")
    a = models.score(test, model, keep=["id"]).select("id", "probability").orderBy("id").collect()
    b = models.score(test, models.load_model(path), keep=["id"]).select("id", "probability").orderBy("id").collect()
    assert a == b and path.endswith("forest_v1.2.0")


@pytest.mark.parametrize("kind", ["forest", "boosting"])
def test_tree_attribution_adds_up(spark, fitted, kind):
    train, test = fitted
    model = models.fit_forest(train, FEATURES, "y", trees=4, depth=4) if kind == "forest" else models.fit_boosting(train, FEATURES, "y", rounds=4, depth=3)
    wide = attribution.attribute_trees(test, "id", FEATURES, attribution.tree_arrays(model))
    both = wide.join(models.raw_score(test, model).select("id", "probability"), "id").toPandas()
    assert len(both) == test.count()
    assert np.allclose(both[FEATURES].sum(axis=1) + both.base, both.margin)
    p = both.margin if kind == "forest" else 1 / (1 + np.exp(-2 * both.margin))
    assert np.allclose(p, both.probability)
    ranked = attribution.mean_attribution(attribution.attribution_rows(wide, "id", FEATURES)).collect()
    assert ranked[0].feature == "feature_1"


def test_search_and_importances(spark, fitted):
    train, _ = fitted
    cv = models.search(train, models.forest("y", trees=5, depth=3), FEATURES, "y", "id", {"maxDepth": [1, 3], "numTrees": [3, 5]}, "roc_auc", folds=3, draw=2)
    got = models.search_results(spark, cv).collect()
    assert len(got) == 2 and all(0.5 < r.mean_metric <= 1 for r in got)
    imp = models.importances(spark, models.fit_forest(train, FEATURES, "y", trees=5, depth=3), FEATURES).collect()
    assert abs(sum(r.importance for r in imp) - 1) < 1e-9


def test_calibration_is_monotone_and_helps(fitted):
    train, test = fitted
    est = models.logistic(train, "y")
    oof = models.out_of_fold(train, est, FEATURES, "y", "id")
    assert oof.count() == train.count() and oof.select("id").distinct().count() == train.count()
    skewed = oof.withColumn("probability", F.pow("probability", F.lit(3.0)))
    iso = models.calibrate_isotonic(skewed, "y")
    steps = [r.value for r in iso.orderBy("lo").collect()]
    assert all(a < b for a, b in zip(steps, steps[1:]))
    out = models.apply_isotonic(skewed, iso).select(F.avg((F.col("probability") - F.col("y")) ** 2).alias("a"), F.avg((F.col("calibrated") - F.col("y")) ** 2).alias("b")).first()
    assert out.b <= out.a


def test_alignment_before_scoring(fitted):
    train, test = fitted
    model = models.fit_logistic(train, FEATURES, "y")
    thin = test.drop("feature_3").withColumn("surplus", F.lit("x"))
    out = models.score(thin, model, FEATURES, keep=["id"])
    assert out.count() == test.count() and "surplus" not in out.columns


def test_vif(spark):
    rng = np.random.default_rng(0)
    a, b = rng.normal(size=400), rng.normal(size=400)
    df = spark.createDataFrame(pd.DataFrame({"a": a, "b": b, "c": a + 0.1 * rng.normal(size=400)}))
    v = {r.feature: r.vif for r in models.vif(df, ["a", "b", "c"]).collect()}
    assert v["a"] > 50 and v["c"] > 50 and v["b"] < 1.1


def test_linear_attribution(spark):
    df = spark.createDataFrame([(1, 1.0), (2, 3.0)], "id int, x double")
    got = {r.id: r.phi for r in attribution.attribute_linear(df, "id", {"x": 2.0}).collect()}
    assert got == {1: -2.0, 2: 2.0}
