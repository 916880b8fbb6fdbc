import pytest
from pyspark.sql import functions as F

from conftest import rows
from ebbtide.functions import elapsed_days
from ebbtide.operators import encode, features


def test_bins_are_right_closed(spark):
    df = spark.createDataFrame([(float(x),) for x in (0, 0.1, 3, 3.01, 6, 12, 12.5)], "m double")
    got = [r.b for r in features.bucketize(df, "m", features.TENURE_EDGES, features.TENURE_LABELS, "b").orderBy("m").collect()]
    assert got == [None, "0-3", "0-3", "3-6", "3-6", "6-12", "12+"]


def test_tiers_on_their_edges(spark):
    df = spark.createDataFrame([(x,) for x in (0.0, 0.25, 0.4, 0.5, 0.7, 0.75, 1.0)], "p double")
    out = features.risk_tier(df, "p").withColumn("a", features.audit_tier("p")).orderBy("p").collect()
    assert [r.risk_tier for r in out] == ["Low", "Low", "Medium", "Medium", "High", "High", "Critical"]
    assert [r.a for r in out] == ["LOW", "LOW", "MEDIUM", "MEDIUM", "HIGH", "HIGH", "HIGH"]


def test_elapsed_days_floor(spark):
    df = spark.sql("select timestamp_ntz'2024-01-01 23:00:00' a, timestamp_ntz'2024-01-02 01:00:00' b, timestamp_ntz'2024-01-03 00:00:00' c")
    r = df.select(elapsed_days("b", "a").alias("x"), elapsed_days("c", "a").alias("y"), elapsed_days("a", "b").alias("z")).first()
    assert (r.x, r.y, r.z) == (0, 1, -1)


def test_tenure_floor_and_usage_bounds(spark):
    df = spark.sql("select timestamp'2024-01-01' s, timestamp'2024-01-01' r, 5 total, 9 days, 4 l30, 1 p30")
    out = features.usage_features(features.tenure_features(df, "s", "r"), "total", "days", "l30", "p30").first()
    assert out.tenure_months == 0.1 and out.usage_intensity == 50.0 and out.active_day_ratio == 1.0 and out.usage_trend_30d == 1.5


def test_renewal(spark):
    df = spark.createDataFrame([(-3,), (29,), (30,), (None,)], "d int")
    assert [r.near_renewal for r in features.near_renewal(df, "d").collect()] == [1, 1, 0, 0]


def test_segments_and_rank_fallback(spark):
    df = spark.createDataFrame([(i, float(v)) for i, v in enumerate([0, 0, 0, 0, 0, 0, 1, 2, 3])], "id int, v double")
    with pytest.raises(ValueError):
        features.quantile_segment(df, "v")
    out = features.quantile_segment(df, "v", key="id").orderBy("id").collect()
    assert [r.mrr_segment for r in out] == ["low"] * 3 + ["medium"] * 3 + ["high"] * 3


def test_weights_and_ratios(spark):
    df = spark.createDataFrame([(1, 0, 1, None, 1, 3.0, 0.0)], "a int, b int, c int, d int, e int, x double, y double")
    r = features.safe_ratio(features.weighted_flags(df, list("abcde")), "x", "y", "r").first()
    assert abs(r.module_adoption_score - 0.65) < 1e-12 and r.r == 3.0


def test_protected_tokens_are_literal(spark):
    df = spark.createDataFrame([("50+",), ("500",), ("APAC-1",), (None,)], "v string")
    assert [r.g for r in df.select(encode.encode_protected("v", "50+|APAC").alias("g")).collect()] == [0, 1, 0, 1]


def test_unseen_category(spark):
    train = spark.createDataFrame([("b",), ("a",), ("b",)], "c string")
    new = spark.createDataFrame([("a",), ("z",), (None,)], "c string")
    fitted = encode.levels(train, ["c"])
    assert rows(encode.one_hot_apply(new, fitted)) == [(1, 0), (0, 0), (0, 0)]
    codes = {r.c: r.c_code for r in encode.label_encode_apply(new, encode.label_encode_fit(train, ["c"]), ["c"]).collect()}
    assert codes == {"a": 0, "z": None, None: None}


def test_column_transform_is_complete_and_numeric(spark):
    train = spark.createDataFrame([(1.0, "x", True, "drop"), (3.0, "y", False, "drop")], "n double, c string, f boolean, other string")
    t = encode.ColumnTransform(["n"], ["c"], ["f"]).fit(train)
    new = spark.createDataFrame([(2.0, "q", True, "u")], "n double, c string, f boolean, other string")
    out = t.apply(new)
    assert out.columns == ["n", "c_x", "c_y", "f"] and tuple(out.first()) == (0.0, 0.0, 0.0, 1.0)


def test_constant_column_scaling(spark):
    df = spark.createDataFrame([(4.0,), (4.0,)], "x double")
    assert [r.x for r in encode.standardize_apply(df, encode.standardize_fit(df, ["x"])).collect()] == [0.0, 0.0]


def test_alerts(spark):
    df = spark.createDataFrame([(1, -0.5, 3, 10.0, None, 9, 400), (2, 0.1, 30, 2.0, 2.0, 1, 5)],
                               "id int, usage_trend double, days_since_last_activity int, tenure_months double, avg_satisfaction double, unique_features_used int, days_to_renewal int")
    got = {(r.id, r.alert) for r in features.alert_rules(df, "id").collect()}
    assert got == {(1, "usage_drop"), (2, "inactive"), (2, "short_tenure"), (2, "low_satisfaction"), (2, "low_adoption"), (2, "near_renewal")}


def test_name_lookup(spark):
    df = spark.createDataFrame([("num__mrr",), ("cat__sub__plan",), ("plain",)], "f string")
    out = features.clean_feature_names(df, "f", {"mrr": "revenue"}).collect()
    assert [(r.label, r.description) for r in out] == [("mrr", "revenue"), ("plan", features.DEFAULT_DESCRIPTION), ("plain", features.DEFAULT_DESCRIPTION)]


def test_renewal_from_billing_cycle(spark):
    df = spark.sql("select timestamp'2024-01-01' s, 'annual' b union all select timestamp'2023-01-10', 'annual' union all select timestamp'2023-12-20', 'monthly'")
    out = features.renewal_from_cycle(df, "s", "b", F.lit("2024-01-05").cast("timestamp"))
    assert [r.near_renewal for r in out.collect()] == [0, 1, 1]
