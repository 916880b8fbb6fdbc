"""Windowed drift, merged results of update streams, isotonic regression: against batch runs and brute force."""

import datetime as dt
import os
import random
import tempfile

import pytest
from pyspark.sql import functions as F

from ebbtide.operators import drift, isotonic
from ebbtide.streaming import audit as st
from ebbtide.streaming import drift as sd
from ebbtide.streaming import upsert

from test_streaming import line, write


@pytest.fixture
def dirs():
    return [tempfile.mkdtemp(prefix="run-", dir="/tmp") for _ in range(3)]


def observed(spark, seed=1, n=3000):
    rng = random.Random(seed)
    start = dt.datetime(2024, 1, 4)
    rows = [(start + dt.timedelta(minutes=20 * i), rng.gauss(0, 1) + i / 900, rng.choice([1.0, 2.0, None, float("nan"), 3.0]), 7.0) for i in range(n)]
    return spark.createDataFrame(rows, "timestamp timestamp, x double, steps double, flat double")


def test_windowed_psi_stream_equals_batch_psi_of_each_week(spark, dirs):
    src, out, state = dirs
    rows = observed(spark)
    base = rows.where("timestamp < '2024-01-12'")
    fitted = sd.baseline_bins(base, ["x", "steps", "flat"])
    assert set(fitted.edges) == {"x", "steps"}  # without spread there are no bins
    for lo in ("2024-01-01", "2024-01-20", "2024-02-05"):
        part = rows.where(F.col("timestamp") >= F.lit(lo).cast("timestamp"))
        hi = {"2024-01-01": "2024-01-20", "2024-01-20": "2024-02-05"}.get(lo)
        (part.where(F.col("timestamp") < F.lit(hi).cast("timestamp")) if hi else part).coalesce(1).write.mode("append").parquet(src)
    stream = spark.readStream.schema(rows.schema).option("maxFilesPerTrigger", 1).parquet(src)
    st.drain(sd.windowed_psi(stream, fitted, retention="1 day"), f"{out}/p", f"{state}/p")
    got = {(r.window_start, r.feature): r for r in spark.read.parquet(f"{out}/p").collect()}
    weeks = sorted({w for w, _ in got})
    assert len(weeks) >= 5
    for week in weeks:
        current = rows.where((F.col("timestamp") >= F.lit(week)) & (F.col("timestamp") < F.lit(week + dt.timedelta(days=7))))
        for r in drift.psi(base, current, ["x", "steps"]).collect():
            mine = got[(week, r.feature)]
            assert mine.psi == pytest.approx(r.psi, abs=1e-12) and mine.outside_share == pytest.approx(r.outside_share)
            assert mine.status == ("DRIFT" if r.psi > 0.2 else "OK")
    assert {r.status for r in got.values()} == {"DRIFT", "OK"}
    last = max(r.timestamp for r in rows.collect())
    assert max(weeks) + dt.timedelta(days=7) <= last  # the open week stays in the state


def test_windowed_psi_of_a_table_and_without_features(spark):
    rows = observed(spark, 2, 600)
    fitted = sd.baseline_bins(rows, ["x"], open_ends=True)
    got = sd.windowed_psi(rows, fitted).collect()
    assert sum(r.n_current for r in got) == 600 and len(got) == 2 and all(r.outside_share == 0 for r in got)
    with pytest.raises(ValueError):
        sd.windowed_psi(rows, sd.baseline_bins(rows, ["flat"]))


def stats(spark, src, files=1):
    groups = ["protected_attributes.region"]
    return st.running_stats(st.readable(st.audit_stream(spark, src, files)), st.near_miss("protected_attributes.region", "EU", 0.7), groups)


def batch(spark, src):
    rows = spark.read.schema(st.AUDIT).json(src).where("timestamp is not null")
    return sorted(map(tuple, st.running_stats(rows, st.near_miss("protected_attributes.region", "EU", 0.7), ["protected_attributes.region"]).collect()), key=str)


def test_update_stream_is_merged_and_a_replayed_batch_changes_nothing(spark, dirs):
    src, out, state = dirs
    for i, name in enumerate("abc"):
        write(src, name, [line(f"2024-05-0{i + 1}T10:00:00", p, reg, "HIGH" if p >= 0.7 else "LOW") for p, reg in [(0.71, "EU"), (0.2, None), (0.72, ["APAC", "EU", "MEA"][i]), (0.9, "EU")]])
        os.utime(f"{src}/{name}.json", (1_700_000_000 + i, 1_700_000_000 + i))
    st.drain(stats(spark, src), out, state, "update", keys=["region"])
    got = lambda: sorted(map(tuple, upsert.read_latest(spark, out).collect()), key=str)
    want = batch(spark, src)
    assert got() == want and len(want) == 4 and sum(r[4] for r in want) == 4
    # The last batch's commit is lost, as if the driver had died before writing it: the same batch runs again.
    last = max(int(f) for f in os.listdir(f"{state}/commits") if f.isdigit())
    for name in (f"{last}", f".{last}.crc"):
        os.replace(f"{state}/commits/{name}", f"{state}/lost-{name}")
    st.drain(stats(spark, src), out, state, "update", keys=["region"])
    assert got() == want
    write(src, "d", [line("2024-05-09T10:00:00", 0.74, "MEA", "HIGH"), line("2024-05-09T10:00:00", 0.74, "NEW", "HIGH"), "{broken"])
    st.drain(stats(spark, src), out, state, "update", keys=["region"])
    assert got() == batch(spark, src) and len(got()) == 5


def test_upsert_of_repeated_batches_nulls_and_no_keys(spark, dirs):
    out = dirs[1]
    rows = lambda *r: spark.createDataFrame(list(r), "k string, n int")
    save = upsert.upsert(f"{out}/keyed", ["k"], buckets=2)
    save(rows(("a", 1), ("b", 1), (None, 1)), 0)
    save(rows(("a", 2), ("c", 2)), 1)
    save(rows(("a", 2), ("c", 2)), 1)
    save(rows((None, 3)), 3)
    save(rows((None, 3)), 3)
    save(rows(), 4)
    assert sorted(map(str, map(tuple, upsert.read_latest(spark, f"{out}/keyed").collect()))) == ["('a', 2)", "('b', 1)", "('c', 2)", "(None, 3)"]
    assert len([f for f in os.listdir(f"{out}/keyed/commits") if f.startswith("version=")]) == 2
    total = upsert.upsert(f"{out}/total")
    for i in range(4):
        total(rows(("sum", i)), i)
    assert [tuple(r) for r in upsert.read_latest(spark, f"{out}/total").collect()] == [("sum", 3)]
    assert sorted(f for f in os.listdir(f"{out}/total/data") if f.startswith("version=") and os.listdir(f"{out}/total/data/{f}") != []) == ["version=2", "version=3"]


# ---- isotonic regression ----------------------------------------------------------------------------------------

def max_min(points):
    """Fitted value of each distinct score: the largest, over starts, of the least mean, over ends."""
    xs = sorted({x for x, _, _ in points})
    s = [sum(y * w for a, y, w in points if a == x) for x in xs]
    w = [sum(v for a, _, v in points if a == x) for x in xs]
    n = len(xs)
    mean = lambda j, k: sum(s[j:k + 1]) / sum(w[j:k + 1])
    return {xs[i]: max(min(mean(j, k) for k in range(i, n)) for j in range(i + 1)) for i in range(n)}


@pytest.mark.parametrize("kind", ["noisy", "falling", "rising", "weighted"])
def test_isotonic_equals_max_min_with_tiny_buckets(spark, kind):
    rng = random.Random(kind)
    xs = [rng.randrange(60) / 7 for _ in range(150)]
    truth = {"noisy": lambda x: rng.random() < x / 9, "falling": lambda x: x < 4, "rising": lambda x: x, "weighted": lambda x: rng.random() + x / 20}[kind]
    points = [(x, float(truth(x)), float(rng.randint(1, 5)) if kind == "weighted" else 1.0) for x in xs]
    df = spark.createDataFrame([*points, (None, 1.0, 1.0), (float("nan"), 1.0, 1.0), (1.0, None, 1.0)], "x double, y double, w double")
    blocks = isotonic.fit(df, "y", "x", "w", rows=7).collect()
    want = max_min(points)
    for x, value in want.items():
        assert [b.value for b in blocks if b.lo <= x <= b.hi] == [pytest.approx(value)]
    assert sorted(b.weight for b in blocks) and sum(b.weight for b in blocks) == pytest.approx(sum(w for _, _, w in points))
    table = isotonic.fit(df, "y", "x", "w", rows=7)
    assert isotonic.falls(table) == 0
    asked = [-5.0, 99.0, *[i / 10 for i in range(0, 90, 3)], *xs, None, float("nan")]
    got = isotonic.apply(spark.createDataFrame([(x,) for x in asked], "x double"), table, "x", "c", rows=7).collect()
    ends = sorted({(e, b.value) for b in blocks for e in (b.lo, b.hi)})
    assert len(got) == len(asked)
    for r in got:
        if r.x is None or r.x != r.x:
            assert r.c is None
        else:
            import numpy as np

            assert r.c == pytest.approx(float(np.interp(r.x, [e for e, _ in ends], [c for _, c in ends])))


def test_isotonic_without_rows(spark):
    none = spark.createDataFrame([], "x double, y double")
    blocks = isotonic.fit(none, "y", "x")
    assert blocks.count() == 0
    assert isotonic.apply(spark.createDataFrame([(1.0, 2.0)], "x double, y double"), blocks, "x").first().calibrated is None


def test_isotonic_values_are_carried_in_frames_that_only_grow(spark):
    """A frame from a row to the end of its bucket is summed up again at every row: quadratic in a bucket's rows."""
    df = spark.range(200).select(F.col("id").cast("double").alias("x"), (F.col("id") % 3).cast("double").alias("y"))
    blocks = isotonic.fit(df, "y", "x")
    asked = spark.createDataFrame([(-1.0,), (0.5,), (100.25,), (300.0,)], "x double")
    out = isotonic.apply(asked, blocks, "x", "c")
    plan = out._jdf.queryExecution().analyzed().toString().lower()
    assert "unboundedpreceding" in plan and "unboundedfollowing" not in plan
    ends = sorted({(e, b.value) for b in blocks.collect() for e in (b.lo, b.hi)})
    for r in out.collect():
        below, above = [e for e in ends if e[0] <= r.x][-1:], [e for e in ends if e[0] >= r.x][:1]
        (a, va), (b, vb) = (below or above)[0], (above or below)[0]
        assert r.c == pytest.approx(va if a == b else va + (vb - va) * (r.x - a) / (b - a))
