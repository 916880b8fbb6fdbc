"""Exactness of the distributed order statistics, with a value that holds a third of the rows."""

import math
import random

import numpy as np
import pandas as pd
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from ebbtide.operators import ordering as o


def frame(spark, n=3000, seed=1):
    rng = np.random.default_rng(seed)
    x = np.round(rng.lognormal(3, 2, n), 3)
    x[: n // 3] = 7.0
    pdf = pd.DataFrame({"id": np.arange(n), "x": x, "z": rng.normal(size=n), "g": rng.integers(0, 3, n)})
    pdf.loc[5, "z"] = np.nan
    return pdf, spark.createDataFrame(pdf)


def test_quantiles_without_small_table_shortcut(spark):
    pdf, df = frame(spark)
    probs = [0.0, 0.1, 1 / 3, 0.5, 0.9, 0.99, 1.0]
    got = {(r.feature, r.prob): r.value for r in o.quantiles(df, ["x", "z"], probs).collect()}
    for c in ("x", "z"):
        want = np.percentile(pdf[c].dropna(), [p * 100 for p in probs])
        assert np.allclose([got[(c, p)] for p in probs], want)


def test_quantiles_by_group_match_shortcut(spark):
    _, df = frame(spark)
    key = ("g", "feature", "prob")
    far = [tuple(r) for r in o.quantiles(df, ["x"], [0.25, 0.5], by=["g"]).select(*key, "value").orderBy(*key).collect()]
    near = [tuple(r) for r in o.quantiles(df, ["x"], [0.25, 0.5], by=["g"]).select(*key, "value").orderBy(*key).collect()]
    assert np.allclose([r[3] for r in far], [r[3] for r in near]) and [r[:3] for r in far] == [r[:3] for r in near]


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.floats(-1e6, 1e6, allow_nan=False).map(lambda v: round(v, 2)), min_size=1, max_size=40), st.sampled_from([0.0, 0.2, 0.5, 0.77, 1.0]))
def test_quantiles_property(spark, values, p):
    df = spark.createDataFrame([(v,) for v in values], "x double")
    got = o.quantiles(df, ["x"], [p]).first().value
    assert np.isclose(got, np.percentile(values, p * 100))


def test_bucket_index_many_borders(spark):
    borders = sorted(np.random.default_rng(3).normal(size=500).tolist())
    x = np.random.default_rng(4).normal(size=400).tolist() + borders[:50]
    df = spark.createDataFrame([(v,) for v in x], "x double").withColumn("b", o.bucket_index(F.col("x"), borders))
    assert all(r.b == int(np.searchsorted(borders, r.x, "left")) for r in df.collect())


def test_value_ranks_with_hot_value(spark):
    pdf, df = frame(spark)
    got = {r.id: r["rank"] for r in o.value_ranks(df, "x", "id").collect()}
    want = pdf.sort_values(["x", "id"]).reset_index(drop=True)
    assert all(got[i] == k + 1 for k, i in enumerate(want["id"]))


def test_running_sums_both_directions(spark):
    pdf, df = frame(spark)
    grouped = df.groupBy("g", "x").agg(F.count(F.lit(1)).alias("n"))
    borders = o.range_borders(df, ["x"], buckets=16)["x"]
    for desc in (False, True):
        out = o.running_sums(grouped, "x", {"n": "upto"}, borders, by=["g"], descending=desc).toPandas()
        for g, part in pdf.groupby("g"):
            c = part.groupby("x").size().sort_index(ascending=not desc).cumsum()
            mine = out[out.g == g].set_index("x")["upto"]
            assert (mine.sort_index() == c.sort_index()).all()


def test_hash_ranks_cover_each_class(spark):
    _, df = frame(spark)
    r = o.hash_ranks(df, "id", 42, by=["g"]).toPandas()
    for _, part in r.groupby("g"):
        assert sorted(part["rank"]) == list(range(1, len(part) + 1)) and set(part["n"]) == {len(part)}


def test_sorted_codes(spark):
    words = [f"Customer#{i:05d}" for i in range(700)]
    df = spark.createDataFrame([(w,) for w in reversed(words)], "v string")
    got = {r.v: r.code for r in o.sorted_codes(df, "v").collect()}
    assert all(got[w] == i for i, w in enumerate(words))


def test_cuts_weigh_repeated_keys(spark):
    pdf = pd.DataFrame({"k": [5] * 1000 + list(range(100, 2100)), "g": [0, 1] * 1500})
    df = spark.createDataFrame(pdf)
    ranks = {"first": 1, "mid": 600, "late": 1400, "last": 1500}
    found = o.hash_cuts(df, "k", 3, "g", {n: (lambda size, r=r: F.lit(r)) for n, r in ranks.items()})
    rows = df.select("g", "k", o.hash_order("k", 3).alias("h")).collect()
    got = {r["__by"]: {n: tuple(r[n]) for n in ranks} for r in found.collect()}
    for g in (0, 1):
        mine = sorted((r.h, r.k) for r in rows if r.g == g)
        hot = [i + 1 for i, x in enumerate(mine) if x[1] == 5]
        assert got[g] == {n: mine[r - 1] for n, r in ranks.items()}
        inside = o.hash_cuts(df.where(F.col("g") == g), "k", 3, "g", {"a": lambda s, r=hot[0]: F.lit(r), "b": lambda s, r=hot[-1]: F.lit(r), "c": lambda s, r=hot[-1] + 1: F.lit(r)}).first()
        assert inside.a.k == inside.b.k == 5 and tuple(inside.c) == mine[hot[-1]]
    # The window's rows are counts of keys.
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert "row_number" not in plan and "__to" in plan


def exact_quantile(values, p):
    values = sorted(values)
    at = p * (len(values) - 1)
    lo, hi = values[math.floor(at)], values[math.ceil(at)]
    return lo + (hi - lo) * (at - math.floor(at))


@pytest.mark.parametrize("margin,rows", [(o.MARGIN, o.ROWS_PER_BUCKET), (1e-9, 7), (0.2, 5), (1.0, 3)])
@pytest.mark.parametrize("by", [[], ["g"]])
def test_quantiles_hold_whatever_the_sketch_and_the_parts(spark, margin, rows, by):
    """A margin that misses ranks is widened, intervals are cut into parts; ties, single values, NULL, NaN and empty columns."""
    rng = random.Random(7)
    data = [(rng.choice(["a", "b", "b", "b", None]), rng.gauss(0, 1), float(rng.choice([1, 1, 1, 2, 5])), 3.5, rng.choice([None, float("nan"), rng.random()]), None, i) for i in range(900)]
    df = spark.createDataFrame(data, "g string, x double, ties double, one double, holes double, none double, whole long").repartition(4)
    cols, probs = ["x", "ties", "one", "holes", "none", "whole"], [0.0, 0.01, 0.1, 0.5, 0.77, 1.0]
    got = {(*(r[c] for c in by), r.feature, r.prob): r.value for r in o.quantiles(df, cols, probs, by, margin=margin, rows=rows).collect()}
    want = {}
    for group in ([("a",), ("b",)] if by else [()]):
        for i, c in enumerate(cols):
            values = [float(r[i + 1]) for r in data if r[i + 1] is not None and r[i + 1] == r[i + 1] and (not by or r[0] == group[0])]
            want |= {(*group, c, p): exact_quantile(values, p) for p in probs if values}
    assert got.keys() == want.keys()
    assert all(got[k] == pytest.approx(want[k], abs=1e-12) for k in want)


def test_quantiles_of_nothing(spark):
    none = spark.createDataFrame([], "g string, x double")
    assert o.quantiles(none, ["x"], [0.5]).count() == 0 and o.quantiles(none, ["x"], [0.5], ["g"]).count() == 0
    assert o.quantile_values(none, ["x"], [0.5, 1.0]) == {"x": [None, None]}
    assert o.quantile_values(none, [], [0.5]) == {}


def test_quantile_plan_keeps_the_table_in_place(spark):
    """What leaves the scans of a continuous column is its intervals' values, a small share of the rows."""
    df = spark.range(200_000).select(((F.col("id") * 7919) % 200_003).cast("double").alias("x"))
    sketched = df.agg(F.kll_sketch_agg_double("x", F.lit(o.SKETCH_SIZE)).alias("__s0"))
    slots, inside = o._intervals(df, sketched, [F.col("x")], [0.25, 0.5], [], o.MARGIN)
    assert inside.count() < 200_000 * 2 * 4 * o.MARGIN and slots.where("rank_low < below or rank_high >= upto").count() == 0
