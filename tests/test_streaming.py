"""Streams over JSON-lines files: broken lines, late rows, equality with the batch run."""

import json
import tempfile

import pytest
from pyspark.sql import functions as F

from ebbtide.sources import tables as io
from ebbtide.sources.schemas import AUDIT
from ebbtide.streaming import audit as st


def line(ts, p, region, tier, cid="c"):
    return json.dumps({"timestamp": ts, "customer_id": cid, "probability": p, "protected_attributes": {"age_group": "50+", "region": region}, "risk_tier": tier})


def write(folder, name, lines):
    with open(f"{folder}/{name}.json", "w") as f:
        f.write("\n".join(lines) + "\n")


@pytest.fixture
def dirs():
    return [tempfile.mkdtemp(prefix="run-", dir="/tmp") for _ in range(3)]


def test_broken_lines_are_quarantined(spark, dirs):
    src, out, state = dirs
    write(src, "a", [line("2024-05-01T10:00:00", 0.8, "EU", "HIGH"), "{broken", line("2024-05-02T10:00:00", 0.1, "EU", "LOW")])
    st.drain(st.readable(st.audit_stream(spark, src)), f"{out}/ok", f"{state}/ok")
    st.drain(st.unreadable(st.audit_stream(spark, src)), f"{out}/bad", f"{state}/bad")
    assert spark.read.parquet(f"{out}/ok").count() == 2 and spark.read.parquet(f"{out}/bad").count() == 1


def test_running_totals_continue_after_restart(spark, dirs):
    src, out, state = dirs
    write(src, "a", [line("2024-05-01T10:00:00", 0.8, "EU", "HIGH"), line("2024-05-01T11:00:00", 0.2, "EU", "LOW")])
    st.drain(st.running_stats(st.audit_stream(spark, src)), f"{out}/r", f"{state}/r", "complete")
    write(src, "b", [line("2024-05-03T10:00:00", 0.9, "APAC", "HIGH")])
    st.drain(st.running_stats(st.audit_stream(spark, src)), f"{out}/r", f"{state}/r", "complete")
    r = spark.read.parquet(f"{out}/r").first()
    assert (r.prediction_count, r.avg_probability, r.high_risk_count, r.fairness_flags_triggered) == (3, 0.6333, 2, 0)


def test_rows_beyond_retention_are_dropped(spark, dirs):
    src, out, state = dirs
    stream = lambda: st.windowed_stats(st.audit_stream(spark, src), "7 days", "10 days")
    write(src, "a", [line("2024-01-03T00:00:00", 0.5, "EU", "LOW"), line("2024-06-05T00:00:00", 0.5, "EU", "HIGH")])
    st.drain(stream(), f"{out}/w", f"{state}/w")
    write(src, "b", [line("2024-01-04T00:00:00", 0.9, "EU", "HIGH"), line("2024-08-01T00:00:00", 0.5, "EU", "LOW")])
    st.drain(stream(), f"{out}/w", f"{state}/w")
    got = {r.window_start.strftime("%Y-%m-%d"): r.prediction_count for r in spark.read.parquet(f"{out}/w").collect()}
    assert got["2023-12-28"] == 1 and got["2024-05-30"] == 1


def test_fairness_alert_stream_equals_batch(spark, dirs):
    src, out, state = dirs
    early = [line(f"2024-05-0{d}T0{h}:00:00", 0.5, reg, tier) for d in (2, 3) for h, (reg, tier) in enumerate([("EU", "HIGH"), ("EU", "LOW"), ("APAC", "LOW"), ("APAC", "LOW")])]
    late = [line("2024-05-10T00:00:00", 0.5, "EU", "LOW"), line("2024-05-10T01:00:00", 0.5, "APAC", "LOW")]
    write(src, "a", early + late)
    write(src, "z", [line("2024-12-01T00:00:00", 0.5, "EU", "LOW")])
    attr = "protected_attributes.region"
    st.drain(st.fairness_alerts(st.audit_stream(spark, src, 1), attr, 0.1, "7 days", "1 day"), f"{out}/f", f"{state}/f")
    cols = ["window_start", "n_groups", "n_rows", "gap", "alert"]
    streamed = spark.read.parquet(f"{out}/f").select(*cols).orderBy("window_start").collect()
    batch = st.fairness_alerts(io.read_audit_log(spark, src), attr, 0.1, "7 days", "1 day").select(*cols).where("window_start < '2024-11-01'").orderBy("window_start").collect()
    assert streamed == batch and [r.alert for r in batch] == [True, False] and batch[0].gap == 0.5


def test_audit_rows_schema(spark):
    df = spark.createDataFrame([(1, 0.5, "a", "b", "LOW")], "id int, p double, age_group string, region string, risk_tier string")
    out = io.audit_rows(df, "id", "p", ["age_group", "region"])
    assert [f.name for f in out.schema] == [f.name for f in AUDIT] and out.select(F.col("protected_attributes.region")).first()[0] == "b"
