import math

import pytest

from ebbtide.operators import evaluate, models, neighbors
from ebbtide.streaming import audit


def test_absent_metrics_fail_their_gates(spark):
    got = {r.metric: (r.value, r.passed) for r in evaluate.quality_gates(spark.createDataFrame([(0.8,)], "recall double"), evaluate.TARGET_GATES).collect()}
    assert got == {"recall": (0.8, True), "pr_auc": (None, False), "brier": (None, False)}


def test_factors_of_determined_and_constant_features(spark):
    df = spark.range(40).selectExpr("cast(id as double) as a", "2D * id as b", "cast(id * id % 7 as double) as c", "1D as d")
    got = {r.feature: r.vif for r in models.vif(df, ["a", "b", "c", "d"]).collect()}
    assert math.isinf(got["a"]) and math.isinf(got["b"]) and 1 <= got["c"] < 2 and got["d"] is None


def test_update_mode_is_refused(spark):
    with pytest.raises(ValueError):
        audit.drain(None, "", "", mode="update")


def test_rows_with_missing_features_are_set_aside(spark):
    df = spark.createDataFrame([(1, 0.0, None), (2, 0.0, 1.0)], "id long, x double, y double")
    assert [r.key for r in neighbors._vectors(df, "id", ["x", "y"]).collect()] == [2]
