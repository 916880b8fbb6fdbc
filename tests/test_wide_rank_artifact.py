"""Wide correlations, selection of ranks, level codes, sparse vectors and whole artifacts against plain computation."""

import math
import random
import tempfile

import numpy as np
import pandas as pd
import pytest
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from ebbtide.operators import artifact, encode, evaluate, features, models, ordering, profile, quality


def test_gram_correlations_equal_pairwise_ones_with_holes(spark):
    rng = np.random.default_rng(4)
    n, k = 700, 40
    x = rng.normal(1e6, 3, (n, k)) + rng.normal(0, 2, (n, 1))
    x[rng.random((n, k)) < 0.2] = np.nan
    x[:, 7], x[:, 9] = 5.25, np.nan
    x[:, 11] = -x[:, 10]
    cols = [f"f{i}" for i in range(k)]
    df = spark.createDataFrame(pd.DataFrame(x, columns=cols)).repartition(5)
    got = {(r.feature_a, r.feature_b): r.r for r in profile.correlation_matrix(df, cols, block=16).collect()}
    want = pd.DataFrame(x, columns=cols).corr(min_periods=1)
    assert len(got) == k * (k - 1) // 2
    for (a, b), r in got.items():
        w = want.loc[a, b]
        if {"f7", "f9"} & {a, b}:
            assert r is None
        else:
            assert r == pytest.approx(w, abs=1e-7)


def test_four_hundred_columns_in_one_scan(spark):
    cols = [f"c{i}" for i in range(400)]
    df = spark.range(500).select(*[((F.col("id") * (i + 3) * 7919) % 1009).cast("double").alias(c) for i, c in enumerate(cols)])
    out = profile.correlation_matrix(df, cols)
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert plan.count("MapInArrow") == 2 * plan.count("== Final Plan ==") or plan.count("MapInArrow") <= 4
    few = profile.correlation_matrix(df.select(*cols[:5]), cols[:5]).collect()
    got = {(r.feature_a, r.feature_b): r.r for r in out.collect()}
    assert len(got) == 400 * 399 // 2 and all(got[(r.feature_a, r.feature_b)] == pytest.approx(r.r) for r in few)
    none = profile.correlation_matrix(df.where("false"), cols[:20]).collect()
    assert none == []


@pytest.mark.parametrize("kind", ["double", "string", "date", "decimal(20,3)"])
def test_value_at_every_rank(spark, kind):
    rng = random.Random(kind)
    raw = [rng.choice([3, 3, 3, 8, 8]) if rng.random() < 0.4 else rng.randrange(500) for _ in range(600)]
    expr = {"double": "x / 7.0D", "string": "concat('k', x)", "date": "date_add(date'2020-01-01', x)", "decimal(20,3)": "cast(x as decimal(20,3))"}[kind]
    df = spark.createDataFrame([(x,) for x in raw], "x int").select(F.expr(expr).alias("v")).repartition(3)
    values = sorted(r.v for r in df.collect())
    for rank in (0, 1, 150, 299, 450, 598, 599):
        assert ordering.value_at(df, "v", rank, rows=9) == (values[rank], sum(v < values[rank] for v in values))
    with pytest.raises(ValueError):
        ordering.value_at(df, "v", 600, rows=9)


def test_rank_cuts_divide_ties_nulls_and_repeated_rows(spark):
    rng = random.Random(9)
    rows = [(rng.choice([1.0, 2.0, 2.0, 3.0, None]), rng.choice(["a", "b", "b", "c", None, f"k{i}"])) for i in range(200)]
    df = spark.createDataFrame(rows, "x double, k string")
    order = sorted((r for r in rows if r[0] is not None), key=lambda r: (r[0], r[1] is not None, r[1] or ""))
    for rank in (1, 17, 60, 90, len(order)):
        cut = ordering.rank_cut(df, "x", "k", rank, rows=5)
        inside = df.where(cut.within(F.col("x"), F.col("k"))).count()
        same = sum(r == order[rank - 1] for r in order)
        assert (cut.value, cut.key) == order[rank - 1] and inside - cut.short == rank and 0 <= cut.short < same
        assert df.where(cut.at(F.col("x"), F.col("k"))).count() == same


def test_top_share_is_exact_and_leaves_the_table_in_place(spark):
    rows = [(i, int(i % 3 == 0), [0.9, 0.5, 0.5, 0.1][i % 4]) for i in range(97)]
    df = spark.createDataFrame(rows, "k int, y int, p double")
    r = evaluate.top_decile_capture(df, "k", "y", "p", 0.4).first()
    top = sorted(rows, key=lambda x: (-x[2], x[0]))[:math.ceil(97 * 0.4)]
    assert (r.n_top, r.captured) == (len(top), sum(x[1] for x in top))
    copies = spark.createDataFrame([(1, 1, 0.5)] * 6 + [(1, 0, 0.5)] * 4, "k int, y int, p double")
    assert [evaluate.top_decile_capture(copies, "k", "y", "p", s).first().captured for s in (0.3, 0.4, 0.5, 1.0)] == [0, 0, 1, 6]
    out = features.rank_segment(df, "p", "k", ["lo", "mid", "hi"], "seg")
    assert "hashpartitioning" not in out._jdf.queryExecution().executedPlan().toString()
    assert sorted(r["count"] for r in out.groupBy("seg").count().collect()) == [32, 32, 33]
    assert evaluate.top_decile_capture(df.where("false"), "k", "y", "p").first().n_top == 0


def test_codes_of_many_levels_follow_their_order(spark):
    n = 60_000
    df = spark.range(n).select(F.format_string("v%07d", (F.col("id") * 7919) % n).alias("v"), (F.col("id") % 2).cast("string").alias("g"))
    codes = encode.label_encode_fit(df, ["v", "g"])
    bad = codes.where("feature = 'v'").where(F.expr("int(substring(value, 2)) <> code")).count()
    assert codes.count() == n + 2 and bad == 0 and [tuple(r) for r in codes.where("feature = 'g'").orderBy("code").collect()] == [("g", "0", 0), ("g", "1", 1)]
    with pytest.raises(ValueError):
        encode.levels(df, ["v", "g"])


def test_one_hot_vector_is_sparse_and_keeps_unseen_levels_out(spark):
    df = spark.createDataFrame([(1, "b", 5), (2, "a", None), (3, None, 7), (4, "c", 5)], "id int, x string, y int")
    out, codes = encode.one_hot_vector(df, ["x", "y"])
    got = {r.id: r.one_hot for r in out.collect()}
    assert out.columns == ["id", "x", "y", "one_hot"] and codes.count() == 5
    assert {i: v.toArray().tolist() for i, v in got.items()} == {1: [0, 1, 0, 1, 0], 2: [1, 0, 0, 0, 0], 3: [0, 0, 0, 0, 1], 4: [0, 0, 1, 1, 0]}
    later, _ = encode.one_hot_vector(spark.createDataFrame([(9, "zz", 7)], "id int, x string, y int"), ["x", "y"], codes)
    assert later.first().one_hot.toArray().tolist() == [0, 0, 0, 0, 1]
    wide, _ = encode.one_hot_vector(spark.range(5000).select(F.col("id"), F.concat(F.lit("u"), "id").alias("u")), ["u"])
    v = wide.where("id = 17").first().one_hot
    assert len(v) == 5000 and len(v.indices) == 1


def churners(spark):
    rng = random.Random(12)
    rows = [(i, rng.gauss(10, 3) if rng.random() < 0.9 else None, rng.choice(["it's", "b\\c", "plain", None]), rng.choice([0, 1, None])) for i in range(400)]
    rows = [(*r, int((r[1] or 10) + 4 * (r[2] == "plain") + rng.gauss(0, 2) > 12)) for r in rows]
    return spark.createDataFrame(rows, "id int, spend double, plan string, trial int, y int")


def test_reloaded_artifact_scores_raw_rows(spark):
    df = churners(spark)
    made = artifact.fit_artifact(df, ["spend"], ["plan"], ["trial"], models.logistic(df, "y"), ["region"], best_params={"c": 1.0})
    path = artifact.save_artifact(made, tempfile.mkdtemp(prefix="run-", dir="/tmp"), "churn", "2")
    path = artifact.save_artifact(made, path.rsplit("/", 1)[0], "churn", "2")
    again = artifact.load_artifact(path)
    assert again.features == ["spend", "plan_b\\c", "plan_it's", "plan_plain", "trial"] and again.info == {"best_params": {"c": 1.0}}
    strange = df.unionByName(spark.createDataFrame([(900, None, "unseen", None, 0)], df.schema))
    a, b = (artifact.score_raw(strange, x, ["id"]).orderBy("id").collect() for x in (made, again))
    assert a == b and len(a) == 401
    # The same numbers as one expression over raw columns, and through the column transform.
    t = encode.ColumnTransform(["spend"], ["plan"], ["trial"]).fit(df)
    weights, intercept = artifact.weights_of(again)
    plain = strange.select("id", F.expr(artifact.linear_sql(t, weights, intercept)).alias("p")).orderBy("id").collect()
    assert all(x.probability == pytest.approx(y.p, abs=1e-12) for x, y in zip(b, plain))
    wide = t.apply(strange, ["id"])
    z = sum((F.lit(weights[c]) * F.col(f"`{c}`") for c in t.features), F.lit(intercept))
    through = wide.select("id", (1 / (1 + F.exp(-z))).alias("p")).orderBy("id").collect()
    assert all(x.probability == pytest.approx(y.p, abs=1e-12) for x, y in zip(b, through))
    # The fit is at its optimum: the penalised gradient vanishes.
    held = made.model.transform(df).select(vector_to_array("features").alias("v"), vector_to_array("probability")[1].alias("p"), "y").collect()
    error = np.array([r.p - r.y for r in held])
    x = np.array([r.v for r in held])
    gradient = x.T @ error + np.array([weights[c] for c in made.features])
    assert np.abs(gradient).max() < 1e-2 and abs(error.sum()) < 1e-2


def test_given_weights_and_protected_names(spark):
    df = churners(spark)
    t = encode.ColumnTransform(["spend"], ["plan"], []).fit(df)
    made = artifact.linear_artifact(t, {"spend": 2.0, "plan_it's": -1.0}, 0.5)
    path = artifact.save_artifact(made, tempfile.mkdtemp(prefix="run-", dir="/tmp"), "given", "1")
    mean, spread = t.scale["spend"]
    for r in artifact.score_raw(df, artifact.load_artifact(path), ["id", "spend", "plan"]).collect():
        z = 0.5 + (2.0 * (r.spend - mean) / spread if r.spend is not None else 0) - (r.plan == "it's")
        assert r.probability == pytest.approx(1 / (1 + math.exp(-z)))
    with pytest.raises(ValueError):
        artifact.weights_of(made)
    for names in (["spend", "region"], ["region_EU"]):
        with pytest.raises(ValueError):
            artifact.audit_names(names, ["region"])
    artifact.audit_names(["regional_spend"], ["region"])


def test_summaries_cover_all_types_and_count_capped_columns(spark):
    df = spark.createDataFrame([(1, True, "a", None), (2, False, "b", None)], "i int, b boolean, s string, t timestamp")
    assert [tuple(r) for r in quality.type_histogram(df).orderBy("dtype").collect()] == [("boolean", 1), ("int", 1), ("string", 1), ("timestamp", 1)]
    from ebbtide.operators import clean

    x = spark.createDataFrame([(float(i), 1.0, 1000.0 if i == 5 else float(i)) for i in range(40)], "a double, flat double, b double")
    assert tuple(quality.outlier_columns(clean.iqr_report(x, ["a", "flat", "b"])).first()) == (3, 1, 1)
