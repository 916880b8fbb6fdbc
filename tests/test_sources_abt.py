"""The five-table set written as CSV, read, validated, merged and cleaned."""

import datetime as dt
import random
import tempfile

import pytest
from pyspark.sql import functions as F

from ebbtide.operators import quality, rollups
from ebbtide.plans.abt import build_abt, clean_abt
from ebbtide.sources import schemas
from ebbtide.sources import tables as io

ACCOUNTS = [(f"A00{i}", f"Co {i}", "Tech", "US", f"2023-0{i}-01", "web", "Pro", 5 * i, 0, int(i in (2, 4))) for i in range(1, 6)]
SUBS = [(f"S00{i}", f"A00{i}", f"2023-0{i}-05", "2024-01-01" if i in (2, 4) else None, "Pro", 5, 100.0 * i, 1200.0 * i, 0, 0, 0, 0, "monthly", 1) for i in range(1, 6)]
SUBS.append(("S000", "A001", "2022-01-01", None, "Basic", 1, 10.0, 120.0, 1, 0, 0, 0, "annual", 0))
USAGE = [(f"U{i}{j}", f"S00{i}", f"2023-09-0{j}", "f1" if j % 2 else "f2", j, 60.0 * j, 0, int(j == 1)) for i in range(1, 6) for j in range(1, 6)]
TICKETS = [("T1", "A001", "2023-05-01", "2023-05-02", 5.0, "High", 30.0, 4.0, 0), ("T2", "A002", "2023-05-01", None, 9.0, "Low", 10.0, 2.0, 1),
           ("T3", "A002", "2023-06-01", None, 3.0, "Low", 20.0, 3.0, 0), ("T4", "A004", "bad date", None, 1.0, "Low", None, None, 0)]
EVENTS = [(f"C{i}", f"A00{i}", "2024-01-01", "price", 0.0, 0, 0, 0, "left") for i in (2, 4)]


@pytest.fixture(scope="module")
def raw(spark):
    folder = tempfile.mkdtemp(prefix="run-", dir="/tmp")
    for name, data in (("accounts", ACCOUNTS), ("subscriptions", SUBS), ("feature_usage", USAGE), ("support_tickets", TICKETS), ("churn_events", EVENTS)):
        io.write_table(spark.createDataFrame(data, schemas.TABLES[name]), f"{folder}/{name}.csv", "csv")
    return folder


def test_missing_table_is_reported_before_reading(spark, raw):
    with pytest.raises(FileNotFoundError) as e:
        io.read_table_set(spark, raw, {**schemas.TABLES, "nope": schemas.ACCOUNTS, "nada": schemas.ACCOUNTS})
    assert "nope.csv" in str(e.value) and "nada.csv" in str(e.value)
    with pytest.raises(FileNotFoundError):
        io.first_existing(spark, [f"{raw}/x", f"{raw}/y"])


def test_registry_checks(spark, raw):
    t = io.read_table_set(spark, raw)
    for name, df in t.items():
        assert quality.check_columns(df.columns, schemas.TABLES[name].fieldNames()) == {"missing": [], "extra": []}
        bad = {r.column_name for r in quality.check_types(df, schemas.TYPE_RULES[name]).where("not passed").collect()}
        assert bad == ({"submitted_at"} if name == "support_tickets" else set())
        assert quality.key_profile(df, schemas.JOIN_KEYS[name]).first().n_null == 0


def test_base_table(spark, raw):
    t = io.read_table_set(spark, raw)
    abt = build_abt(t["accounts"], t["subscriptions"], t["feature_usage"], t["support_tickets"])
    got = {r.account_id: r for r in abt.collect()}
    assert len(got) == 5 and not set(abt.columns) & {"end_date", "closed_at"}
    assert got["A001"].subscription_id == "S001" and got["A001"].sub_plan_tier == "Pro" and got["A001"].plan_tier == "Pro"
    assert got["A002"].ticket_count == 2 and got["A003"].ticket_count is None
    assert got["A001"].total_events == 15 and got["A001"].active_days == 5 and got["A001"].unique_features_used == 2
    assert {a for a, r in got.items() if r.churn_flag == 1} == {"A002", "A004"}
    by_event = build_abt(t["accounts"], t["subscriptions"], t["feature_usage"], t["support_tickets"], churn_events=t["churn_events"])
    assert {r.account_id for r in by_event.where("churn_flag = 1").collect()} == {"A002", "A004"}


def test_cleaned_base_table_has_no_gaps(spark, raw):
    t = io.read_table_set(spark, raw)
    out = clean_abt(build_abt(t["accounts"], t["subscriptions"], t["feature_usage"], t["support_tickets"]), flags=("is_trial", "sub_is_trial"))
    nulls = out.select([F.count_if(F.col(c).isNull()).alias(c) for c in out.columns]).first().asDict()
    assert out.count() == 5 and {c for c, n in nulls.items() if n} <= {"last_ticket_date"}
    zero = clean_abt(build_abt(t["accounts"], t["subscriptions"], t["feature_usage"], t["support_tickets"]), zero_fill=("ticket_count",))
    assert zero.where("account_id = 'A003'").first().ticket_count == 0


def test_fingerprint_and_version_log(spark, raw):
    a = io.file_fingerprint(spark, f"{raw}/accounts.csv").where("file like 'part%'").collect()
    b = io.file_fingerprint(spark, f"{raw}/accounts.csv").where("file like 'part%'").collect()
    assert sorted(a) == sorted(b) and all(r.content_hash for r in a if r.size_bytes)
    io.write_table(spark.range(7), f"{raw}/hashed.parquet")
    io.write_table(spark.range(8), f"{raw}/other.parquet")
    one, two = (io.file_fingerprint(spark, f"{raw}/{n}.parquet").where("file like 'part%'") for n in ("hashed", "other"))
    assert sum(r.n_rows for r in one.collect()) == 7
    assert {r.content_hash for r in one.collect()} != {r.content_hash for r in two.collect()}
    log = f"{raw}/versions"
    io.append_version_log(spark, {"accounts": f"{raw}/accounts.csv"}, log)
    n = io.append_version_log(spark, {"accounts": f"{raw}/accounts.csv"}, log).count()
    assert n == 2 * len(io.file_fingerprint(spark, f"{raw}/accounts.csv").collect())


def test_baseline_snapshot(spark, raw):
    src = io.write_table(spark.range(5), f"{raw}/src")
    assert io.load_baseline(spark, f"{raw}/base", [f"{raw}/none", src]).count() == 5
    assert io.path_exists(spark, f"{raw}/base") and io.load_baseline(spark, f"{raw}/base", []).count() == 5


def test_audit_log_skips_broken_lines(spark, raw):
    good = '{"timestamp": "2024-05-01T10:00:00", "customer_id": "c1", "probability": 0.8, "protected_attributes": {"age_group": "50+", "region": "EU"}, "risk_tier": "HIGH"}'
    path = f"{raw}/audit"
    spark.createDataFrame([(good,), ('{"timestamp": ',), ("rubbish",)], "value string").coalesce(1).write.text(path)
    out = io.read_audit_log(spark, path).collect()
    assert len(out) == 1 and out[0].protected_attributes.region == "EU"


def test_staging_uses_the_configured_folder(spark, raw):
    from ebbtide import session

    class Conf:
        def get(self, key, default=None):
            return f"{raw}/shared" if key == "spark.checkpoint.dir" else default

    class Session:
        conf = Conf()

    assert session.shared_dir(Session()) == f"{raw}/shared"
    assert sorted(r.id for r in session.staged(spark.range(3)).collect()) == [0, 1, 2]


def test_usage_rollup_counts_without_multiplying_rows(spark):
    """A subscription with most facts, one without an account, repeated map rows, facts without values: as counted one by one."""
    rng = random.Random(3)
    facts = [(rng.choice([1] * 20 + [2, 3, 4, 5, None]), dt.date(2024, 1, 1 + rng.randrange(20)) if rng.random() < 0.9 else None, rng.choice(["a", "b", "c", None]),
              rng.choice([1.0, 2.5, None]), 2.0, None, rng.choice([0, 1, None])) for _ in range(500)]
    owners = [(1, 10), (1, 10), (2, 10), (3, 20), (4, None), (6, 30)]
    use = spark.createDataFrame(facts, "subscription_id int, usage_date date, feature_name string, usage_count double, usage_duration_secs double, error_count double, is_beta_feature int")
    got = rollups.usage_rollup(use, "account_id", spark.createDataFrame(owners, "subscription_id int, account_id int"))
    assert "Expand" not in got._jdf.queryExecution().executedPlan().toString()
    rows = {r.account_id: r for r in got.collect()}
    assert set(rows) == {10, 20}
    for account, subs in ((10, {1, 2}), (20, {3})):
        mine = [f for f in facts if f[0] in subs]
        r, counts = rows[account], [f[3] for f in mine if f[3] is not None]
        assert (r.active_days, r.unique_features_used) == (len({f[1] for f in mine} - {None}), len({f[2] for f in mine} - {None}))
        assert r.total_events == sum(counts) and r.avg_daily_usage == pytest.approx(sum(counts) / len(counts)) and r.total_duration_secs == 2.0 * len(mine)
        assert r.total_errors == 0 and r.avg_errors is None and r.beta_feature_usage == sum(f[6] or 0 for f in mine)
        assert (r.first_activity_date, r.last_activity_date) == (min(f[1] for f in mine if f[1]), max(f[1] for f in mine if f[1]))
    direct = rollups.usage_rollup(use.withColumn("account_id", F.col("subscription_id"))).collect()
    assert {r.account_id for r in direct} == {1, 2, 3, 4, 5}


def test_one_call_from_raw_tables_to_saved_base_table(spark, raw):
    from ebbtide.plans.endtoend import build_base_table

    out = tempfile.mkdtemp(prefix="run-", dir="/tmp")
    run = build_base_table(spark, raw, out)
    nulls = run.table.select([F.count_if(F.col(c).isNull()).alias(c) for c in run.table.columns]).first().asDict()
    assert run.table.count() == 5 and {c for c, n in nulls.items() if n} <= {"last_ticket_date"}
    assert spark.read.parquet(f"{out}/abt").count() == 5
    f = run.findings
    assert set(f) == {"columns", "types", "keys", "missing", "imputed", "outliers", "versions", "summary"}
    assert f["columns"].count() == 0 and [r.column_name for r in f["types"].where("not passed").collect()] == ["submitted_at"]
    assert {r.table_name: r.n_rows for r in f["keys"].collect()} == {"accounts": 5, "subscriptions": 6, "feature_usage": 25, "support_tickets": 4, "churn_events": 2}
    filled = {r.column_name: r for r in f["imputed"].collect()}
    assert filled["ticket_count"].rows_filled == 2 and filled["ticket_count"].strategy == "median"
    assert {r.table_name for r in f["versions"].select("table_name").distinct().collect()} == set(schemas.TABLES)
    s = f["summary"].first()
    assert (s.n_rows, s.copies_dropped) == (5, 0) and s.outliers_capped == f["outliers"].where("n_below + n_above > 0").count() and s.label_rate == 0.4
    # The same table as by the separate steps.
    t = io.read_table_set(spark, raw)
    again = clean_abt(build_abt(t["accounts"], t["subscriptions"], t["feature_usage"], t["support_tickets"]), flags=("is_trial", "sub_is_trial"))
    assert sorted(map(str, run.table.select(*again.columns).collect())) == sorted(map(str, again.collect()))
    with pytest.raises(FileNotFoundError):
        build_base_table(spark, f"{raw}/nowhere", out)


def test_training_features_are_audited_and_their_preprocessing_is_saved(spark):
    from ebbtide.operators import artifact
    from ebbtide.plans.endtoend import training_features

    rows = [(i, i % 2, "train" if i % 3 else "test", float(i), "x" if i % 4 else "y", "EU" if i % 5 else "US") for i in range(60)]
    df = spark.createDataFrame(rows, "id int, y int, split string, spend double, plan string, region string")
    made = training_features(df, "id", "y", "split", ["spend", "twice"], ["plan"], [], ["region"], lambda d: d.withColumn("twice", F.col("spend") * 2))
    assert made.features == ["spend", "twice", "plan_x", "plan_y"] and made.matrix.columns == ["id", "y", "split", *made.features]
    train = made.matrix.where("split = 'train'").agg(F.avg("spend"), F.stddev_pop("spend")).first()
    assert train[0] == pytest.approx(0, abs=1e-9) and train[1] == pytest.approx(1) and made.matrix.count() == 60
    assert made.protected.columns == ["id", "region"]
    path = made.save(tempfile.mkdtemp(prefix="run-", dir="/tmp"), "prep", "1")
    again = artifact.load_artifact(path)
    vectors = {r.id: r.features.toArray().tolist() for r in again.model.transform(df.withColumn("twice", F.col("spend") * 2)).collect()}
    assert all(vectors[r.id] == pytest.approx([r[c] for c in made.features]) for r in made.matrix.collect())
    for wrong in (["region"], ["plan"]):
        with pytest.raises(ValueError):
            training_features(df, "id", "y", "split", ["spend"], [*wrong], [], ["region", "plan"])
