"""Registered queries: training, calibration, scoring, attribution, streams."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import artifact, attribution, encode, evaluate, fairness, isotonic, models
from ..operators.features import audit_tier, risk_tier
from ..session import staged
from ..sources import tables as io
from ..streaming import audit as st
from ..streaming import drift as stream_drift
from ..streaming import upsert
from . import endtoend, training
from . import views as v
from .queries_tables import AUDIT_CTE, PAYLOAD_CTE, SPLIT_CTE, _payload, audit_table, scratch, three_way
from .registry import query

FEATURES = ["balance", "n_orders", "max_spend", "avg_spend", "country"]
LABEL, KEY = "churn_flag", "account_id"


def accounts_split(spark, d):
    """All accounts with the features as they come (missing ones are 0) and their split."""
    return three_way(spark, d).select(KEY, LABEL, "industry", "split", *[F.coalesce(F.col(f).cast("double"), F.lit(0.0)).alias(f) for f in FEATURES])


def prepared(spark, d):
    """(train, test): features scaled by the training rows' statistics, the training rows with class weights; written once."""
    s = staged(accounts_split(spark, d))
    train = s.where(F.col("split") == "train")
    s = encode.standardize_apply(s, encode.standardize_fit(train, FEATURES))
    train = staged(fairness.class_weights(s.where(F.col("split") == "train"), LABEL))
    return train, s.where(F.col("split") == "test")


def judged(model, test, name):
    """Test metrics of one fitted model. The scored rows are written once, as the metrics read them twice."""
    scored = staged(models.score(test, model, keep=[KEY]).select(LABEL, "prediction", "probability"))
    return evaluate.core_metrics(scored, LABEL, "prediction", "probability").select(
        F.lit(name).alias("model"), (F.col("tp") + F.col("fn") + F.col("tn") + F.col("fp")).alias("n_rows"),
        "accuracy", "precision", "recall", "f1", "roc_auc", "brier")


@query("fit_logistic")
def _(spark, d):
    train, test = prepared(spark, d)
    return judged(models.fit_logistic(train, FEATURES, LABEL, "weight"), test, "logistic")


@query("fit_forest")
def _(spark, d):
    train, test = prepared(spark, d)
    return judged(models.fit_forest(train, FEATURES, LABEL, "weight", trees=20, depth=8), test, "forest")


@query("fit_boosting")
def _(spark, d):
    train, test = prepared(spark, d)
    return judged(models.fit_boosting(train, FEATURES, LABEL, "weight", rounds=10, depth=4), test, "boosting")


@query("fit_mitigated")
def _(spark, d):
    """Plain and fairness-weighted training side by side: accuracy, AUC, parity difference."""
    train, test = prepared(spark, d)
    group = encode.encode_protected("industry", "BUILD|HOUSE")
    weighted = fairness.reweighing(train.withColumn("grp", group), "grp", LABEL, "fair_weight")
    out = None
    for name, model in (("plain", models.fit_logistic(train, FEATURES, LABEL)),
                        ("mitigated", models.fit_mitigated(weighted, FEATURES, LABEL, "fair_weight", "logistic"))):
        scored = staged(models.score(test, model).withColumn("grp", group).select(LABEL, "prediction", "probability", "grp"))
        m = evaluate.core_metrics(scored, LABEL, "prediction", "probability")
        f = fairness.fairness_metrics(scored, LABEL, "prediction", "grp")
        row = m.select(F.lit(name).alias("model"), "accuracy", "roc_auc", f.select("demographic_parity_diff").scalar().alias("demographic_parity_diff"))
        out = row if out is None else out.unionByName(row)
    return out


@query("search")
def _(spark, d):
    """Seeded random half of a small grid on stratified folds."""
    train, _ = prepared(spark, d)
    est = models.forest(LABEL, "weight", trees=5, depth=4)
    cv = models.search(train, est, FEATURES, LABEL, KEY, {"maxDepth": [2, 4], "minInstancesPerNode": [2, 5]}, "f1", folds=3, draw=2)
    return models.search_results(spark, cv)


@query("cross_validate")
def _(spark, d):
    train, _ = prepared(spark, d)
    got = models.cross_validate(train, models.logistic(train, LABEL, "weight"), FEATURES, LABEL, KEY, folds=3)
    return spark.createDataFrame(list(got.items()), "metric string, mean_score double")


@query("calibrate_isotonic")
def _(spark, d):
    """Brier score before and after calibration on out-of-fold scores, and whether the map is monotone."""
    train, test = prepared(spark, d)
    est = models.logistic(train, LABEL, "weight")
    iso = models.calibrate_isotonic(models.out_of_fold(train, est, FEATURES, LABEL, KEY), LABEL)
    scored = models.raw_score(test, models.fit_logistic(train, FEATURES, LABEL, "weight"))
    both = models.apply_isotonic(scored, iso)
    sq = lambda c: F.avg((F.col(c) - F.col(LABEL)) * (F.col(c) - F.col(LABEL)))
    return both.agg(F.count(F.lit(1)).alias("n_rows"), sq("probability").alias("brier_raw"), sq("calibrated").alias("brier_calibrated"),
                    F.lit(isotonic.falls(iso) == 0).alias("monotone"))


@query("isotonic_map", """select round(p, 6) p, count(*) n_rows, round(max(c), 6) calibrated from scored join (
  select k, max(least_after) c from (
    select j, k, min(v) over (partition by j order by k desc) least_after from (
      select a.i j, b.i k, (b.cs - a.cs + a.s) / (b.cw - a.cw + a.w)::double v from merged a join merged b on b.i >= a.i)) group by k) on k = (select i from merged where merged.p = scored.p)
  group by scored.p""", """
  merged as (select p, sum(y)::double s, count(*)::double w, row_number() over (order by p) i, sum(sum(y)::double) over (order by p) cs, sum(count(*)::double) over (order by p) cw from scored group by p)""")
def _(spark, d):
    """Calibrated value of every distinct score of all accounts; in SQL the largest, over starts, of the least mean, over ends."""
    rows = v.scored(spark, d)
    return isotonic.apply(rows, isotonic.fit(rows, "y", "p"), "p").groupBy("p").agg(F.count(F.lit(1)).alias("n_rows"), F.max("calibrated").alias("calibrated"))


CATEGORIES = ["industry"]


@query("score")
def _(spark, d):
    """A whole artifact (scaling, levels, names, model), saved and reloaded, over the raw rows of all accounts: rows and range of the scores per tier."""
    rows = staged(accounts_split(spark, d))
    train = staged(fairness.class_weights(rows.where(F.col("split") == "train"), LABEL))
    made = artifact.fit_artifact(train, FEATURES, CATEGORIES, [], models.logistic(train, LABEL, "weight"))
    path = artifact.save_artifact(made, scratch(spark, "models"), "churn", "1.0.0")
    scored = risk_tier(artifact.score_raw(rows, artifact.load_artifact(path), [KEY]), "probability")
    return scored.groupBy("risk_tier").agg(F.count(F.lit(1)).alias("n_rows"), F.min("probability").alias("min_probability"), F.max("probability").alias("max_probability"))


GIVEN = {"balance": -0.4, "n_orders": 1.25, "max_spend": 0.3, "industry_BUILDING": 0.7, "industry_MACHINERY": -0.2}


GIVEN_SQL = "1 / (1 + exp(-(0.1::double" + "".join(
    f" + {w}::double * coalesce(({c} - (select avg({c}) from accounts)) / (select stddev_pop({c}) from accounts), 0)" for c, w in GIVEN.items() if not c.startswith("industry")) + "".join(
    f" + case when industry = '{c.split('_')[1]}' then {w}::double else 0 end" for c, w in GIVEN.items() if c.startswith("industry")) + ")))"


@query("artifact_scores", f"select account_id, round({GIVEN_SQL}, 6) probability from accounts")
def _(spark, d):
    """Given weights behind scaling and levels fitted on all accounts, saved, reloaded, and applied to their raw rows."""
    rows = v.accounts(spark, d)
    t = encode.ColumnTransform(["balance", "n_orders", "max_spend"], CATEGORIES, []).fit(rows)
    path = artifact.save_artifact(artifact.linear_artifact(t, GIVEN, 0.1), scratch(spark, "models"), "given", "1")
    return artifact.score_raw(rows, artifact.load_artifact(path), [KEY])


INDUSTRIES = ["AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY"]


@query("training_features", "select account_id, churn_flag, split, " + ", ".join(
    f"round(coalesce(({c} - (select avg({c}) from split3 where split = 'train')) / (select stddev_pop({c}) from split3 where split = 'train'), 0), 6) {c}" for c in ("balance", "n_orders", "avg_spend"))
    + ", " + ", ".join(f"(coalesce(industry = '{i}', false))::double \"industry_{i}\"" for i in INDUSTRIES)
    + ", (n_orders > 10)::double is_frequent from split3", SPLIT_CTE)
def _(spark, d):
    """Encoded and audited features of all accounts, fitted on the training split; the country is protected."""
    made = endtoend.training_features(three_way(spark, d), KEY, LABEL, "split", ["balance", "n_orders", "avg_spend"], CATEGORIES, ["is_frequent"], ["country"],
                                      lambda df: df.withColumn("is_frequent", (F.col("n_orders") > 10).cast("int")))
    return made.matrix


@query("score_stream_given", f"""select risk_tier, industry, count(*) n_rows, round(max(p), 6) max_probability from (
  select industry, {GIVEN_SQL} p, case when {GIVEN_SQL} >= 0.7 then 'HIGH' when {GIVEN_SQL} >= 0.4 then 'MEDIUM' else 'LOW' end risk_tier from accounts) group by 1, 2""")
def _(spark, d):
    """All accounts arriving raw as a stream, scored by a reloaded artifact of given weights, written as audit rows and read back."""
    rows = v.accounts(spark, d).select(KEY, "industry", "balance", "n_orders", "max_spend")
    t = encode.ColumnTransform(["balance", "n_orders", "max_spend"], CATEGORIES, []).fit(rows)
    path = artifact.save_artifact(artifact.linear_artifact(t, GIVEN, 0.1), scratch(spark, "models"), "given", "1")
    src, out, state = scratch(spark, "raw-arrivals"), scratch(spark, "given-scored"), scratch(spark, "given-state")
    io.write_table(rows, src)
    stream = artifact.score_raw(spark.readStream.schema(rows.schema).parquet(src), artifact.load_artifact(path), [KEY, "industry"])
    st.drain(io.audit_rows(stream.withColumn("risk_tier", audit_tier("probability")), KEY, "probability", ["industry"]), out, state, fmt="json")
    back = spark.read.schema("probability double, risk_tier string, protected_attributes struct<industry: string>").json(out)
    return back.groupBy("risk_tier", F.col("protected_attributes.industry").alias("industry")).agg(F.count(F.lit(1)).alias("n_rows"), F.max("probability").alias("max_probability"))


SMALL = {"forest": {"trees": 10, "depth": 5}, "boosting": {"rounds": 5, "depth": 3}}


@query("train_and_compare")
def _(spark, d):
    """Three fitted models and the majority baseline on the test split, by recall."""
    train, test = prepared(spark, d)
    train = train.drop("weight")
    return training.compare(training.fit_all(train, FEATURES, LABEL, **SMALL), train, test, KEY, LABEL)


@query("balancing_effect")
def _(spark, d):
    train, test = prepared(spark, d)
    return training.balancing_effect(train.drop("weight"), test, FEATURES, KEY, LABEL, **SMALL)


@query("score_batch", """select count(*) n_audit, (select count(*) from payload) - (select count(*) from valid_payload) n_quarantined, count(distinct industry) n_groups from valid_payload join accounts using (account_id)""", PAYLOAD_CTE)
def _(spark, d):
    """Column gate, row rules, scoring without protected columns, audit rows with them."""
    train, _ = prepared(spark, d)
    payload = _payload(spark, d).join(v.accounts(spark, d).select(KEY, "industry", *FEATURES), KEY)
    model = models.fit_logistic(train, FEATURES, LABEL, "weight")
    scored, audit, bad = training.score_batch(payload, model, FEATURES, KEY, ["mrr", "tenure_months"], ["industry"], prepare=lambda df: df.fillna(0.0, FEATURES))
    n_bad = bad.agg(F.count(F.lit(1)).alias("n")).scalar()
    return audit.agg(F.count(F.lit(1)).alias("n_audit"), n_bad.alias("n_quarantined"), F.count_distinct("protected_attributes.industry").alias("n_groups"))


@query("importances")
def _(spark, d):
    train, _ = prepared(spark, d)
    model = models.fit_forest(train, FEATURES, LABEL, "weight", trees=10, depth=5)
    return evaluate.rank_importance(models.importances(spark, model, FEATURES), 20)


WEIGHTS = {"balance": -0.4, "n_orders": 1.25, "country": 0.05}


@query("attribute_linear", " union all ".join(
    f"select account_id, '{c}' feature, round({w}::double * ({c} - (select avg({c}) from accounts)), 4) phi from accounts" for c, w in WEIGHTS.items()), digits=4)
def _(spark, d):
    return attribution.attribute_linear(v.accounts(spark, d), KEY, WEIGHTS)


@query("attribute_trees")
def _(spark, d):
    """Mean absolute attribution per feature of a boosted model, and the largest additivity error (0 after rounding)."""
    train, test = prepared(spark, d)
    model = models.fit_boosting(train, FEATURES, LABEL, "weight", rounds=5, depth=3)
    wide = attribution.attribute_trees(test, KEY, FEATURES, attribution.tree_arrays(model))
    p = models.raw_score(test, model).select(KEY, "probability")
    checked = wide.join(p, KEY)
    total = sum((F.col(f) for f in FEATURES), F.col("base"))
    error = F.greatest(F.abs(total - F.col("margin")), F.abs(1 / (1 + F.exp(-2 * F.col("margin"))) - F.col("probability")))
    return checked.agg(F.count(F.lit(1)).alias("n_rows"), F.max(error).alias("max_error"), *[F.avg(F.abs(f)).alias(f) for f in FEATURES])


@query("explain_highest_risk", """select account_id, feature, round(phi, 4) phi, round(p, 4) p from (""" + " union all ".join(
    f"select account_id, '{c}' feature, {w}::double * ({c} - (select avg({c}) from accounts)) phi from accounts" for c, w in WEIGHTS.items())
    + ") join (select account_id, p from scored order by p desc, account_id limit 1) using (account_id)", digits=4)
def _(spark, d):
    rows = attribution.attribute_linear(v.accounts(spark, d), KEY, WEIGHTS)
    return attribution.explain_highest_risk(v.scored(spark, d), rows, KEY, "p")


# ---- streams: the audit rows derived from the events, written as JSON lines and read as a stream ---------------

def streamed(spark, d, name):
    """(stream over the JSON lines of the audit rows, output folder, checkpoint folder)."""
    src = io.append_audit(audit_table(spark, d), scratch(spark, f"{name}-log"))
    return st.readable(st.audit_stream(spark, src)), scratch(spark, f"{name}-out"), scratch(spark, f"{name}-state")


@query("audit_stream", "select risk_tier, region, count(*) n_rows, round(avg(probability), 6) avg_probability from audit group by 1, 2", AUDIT_CTE)
def _(spark, d):
    stream, out, state = streamed(spark, d, "ingest")
    st.drain(stream, out, state)
    return spark.read.parquet(out).groupBy("risk_tier", F.col("protected_attributes.region").alias("region")).agg(
        F.count(F.lit(1)).alias("n_rows"), F.avg("probability").alias("avg_probability"))


@query("running_stats", """select count(*) prediction_count, round(avg(probability), 4) avg_probability, count(*) filter (risk_tier = 'HIGH') high_risk_count,
  0 fairness_flags_triggered from audit""", AUDIT_CTE)
def _(spark, d):
    stream, out, state = streamed(spark, d, "running")
    st.drain(st.running_stats(stream), out, state, "complete")
    return spark.read.parquet(out)


FLAG_SQL = "region = 'APAC' and probability - 0.7::double >= 0 and probability - 0.7::double < 0.05::double"


def by_day(rows, spark, name, folder_of=io.append_audit):
    """Rows appended in five parts in the order of time, so that a stream meets them as several files."""
    src = scratch(spark, name)
    for lo, hi in zip(DAYS, [*DAYS[1:], None]):
        part = rows.where(F.col("timestamp") >= F.lit(lo).cast("timestamp"))
        folder_of(part if hi is None else part.where(F.col("timestamp") < F.lit(hi).cast("timestamp")), src)
    return src


DAYS = ["1970-01-01", "2024-01-07", "2024-01-13", "2024-01-19", "2024-01-25"]


@query("running_stats_update", f"""select age_group, region, count(*) prediction_count, round(avg(probability), 4) avg_probability, count(*) filter (risk_tier = 'HIGH') high_risk_count,
  count(*) filter ({FLAG_SQL}) fairness_flags_triggered from audit group by 1, 2""", AUDIT_CTE)
def _(spark, d):
    """Counters per protected group in update mode: files arrive in turn, changed groups are merged into the result."""
    src, out, state = by_day(audit_table(spark, d), spark, "updates-log"), scratch(spark, "updates-out"), scratch(spark, "updates-state")
    groups = ["protected_attributes.age_group", "protected_attributes.region"]
    stats = st.running_stats(st.readable(st.audit_stream(spark, src, 4)), st.near_miss("protected_attributes.region", "APAC", 0.7), groups)
    st.drain(stats, out, state, "update", keys=["age_group", "region"])
    return upsert.read_latest(spark, out)


@query("unreadable_lines", "select count(*) n_lines from audit", AUDIT_CTE)
def _(spark, d):
    """A broken copy of every audit row, set aside by the stream."""
    src, out, state = scratch(spark, "broken-log"), scratch(spark, "broken-out"), scratch(spark, "broken-state")
    rows = audit_table(spark, d)
    io.append_audit(rows, src)
    rows.select(F.concat(F.lit('{"timestamp": '), F.to_json(F.struct("*"))).alias("value")).write.mode("append").text(src)
    st.drain(st.unreadable(st.audit_stream(spark, src)), out, state)
    return spark.read.parquet(out).agg(F.count(F.lit(1)).alias("n_lines"))


WEEK_SQL = "strftime(time_bucket(interval '7 days', ts, timestamp '1970-01-01'), '%Y-%m-%d')"


@query("windowed_stats", f"""select {WEEK_SQL} window_start, count(*) prediction_count, round(avg(probability), 6) avg_probability, count(*) filter (risk_tier = 'HIGH') high_risk_count
  from audit group by 1""", AUDIT_CTE)
def _(spark, d):
    stream, out, state = streamed(spark, d, "weekly")
    st.drain(st.windowed_stats(stream), out, state, "complete")
    return spark.read.parquet(out).select(F.date_format("window_start", "yyyy-MM-dd").alias("window_start"), "prediction_count", "avg_probability", "high_risk_count")


@query("fairness_alerts", f"""select window_start, count(*) n_groups, sum(n)::bigint n_rows, round(min(r), 6) min_rate, round(max(r), 6) max_rate, round(max(r) - min(r), 6) gap, max(r) - min(r) > 0.01 alert
  from (select {WEEK_SQL} window_start, region, count(*) n, (count(*) filter (risk_tier = 'HIGH'))::double / count(*) r from audit group by 1, 2) group by 1""", AUDIT_CTE)
def _(spark, d):
    """The batch run of the streaming plan."""
    return st.fairness_alerts(audit_table(spark, d), "protected_attributes.region", 0.01).withColumn("window_start", F.date_format("window_start", "yyyy-MM-dd"))


CLOSED = "time_bucket(interval '7 days', ts, timestamp '1970-01-01') + interval '7 days' <= (select max(ts) from audit) - interval '7 days'"


@query("retention", f"""select {WEEK_SQL} window_start, count(*) prediction_count, count(*) filter (risk_tier = 'HIGH') high_risk_count from audit where {CLOSED} group by 1""", AUDIT_CTE)
def _(spark, d):
    """Append mode: a week is final, and leaves the state, once the retention has passed it."""
    stream, out, state = streamed(spark, d, "retained")
    st.drain(st.windowed_stats(stream, retention="7 days"), out, state)
    return spark.read.parquet(out).select(F.date_format("window_start", "yyyy-MM-dd").alias("window_start"), "prediction_count", "high_risk_count")


@query("fairness_alert_stream", f"""select window_start, count(*) n_groups, sum(n)::bigint n_rows, round(max(r) - min(r), 6) gap, max(r) - min(r) > 0.01 alert
  from (select {WEEK_SQL} window_start, region, count(*) n, (count(*) filter (risk_tier = 'HIGH'))::double / count(*) r from audit where {CLOSED} group by 1, 2) group by 1""", AUDIT_CTE)
def _(spark, d):
    """Closed weeks of the alert stream: two chained stateful aggregations in append mode."""
    stream, out, state = streamed(spark, d, "alerts")
    st.drain(st.fairness_alerts(stream, "protected_attributes.region", 0.01, retention="7 days"), out, state)
    return spark.read.parquet(out).select(F.date_format("window_start", "yyyy-MM-dd").alias("window_start"), "n_groups", "n_rows", "gap", "alert")


# Features of the events; the first week is the baseline, and one feature wanders off with the days.
SIGNAL_CTE = """
  signals as (select ts, value amount, ((event_id * 7919) % 1000) / 1000::double probability, value + 3 * extract(day from ts) wandering from events),
  week0 as (select * from signals where ts < timestamp '2024-01-08')"""
SIGNALS = ["amount", "probability", "wandering"]


def signals(spark, d):
    e = v.table(spark, d, "events")
    return e.select(F.col("ts").cast("timestamp").alias("timestamp"), F.col("value").alias("amount"), ((F.col("event_id") * 7919) % 1000 / F.lit(1000.0)).alias("probability"),
                    (F.col("value") + 3 * F.dayofmonth("ts")).alias("wandering"))


def weekly_psi_sql(col: str) -> str:
    """PSI of one column per week against the baseline's edges, straight from its definition."""
    raw = f"len(list_filter(e, lambda z: z <= {col}))"
    spot = f"case when {col} < e[1] or {col} > e[len(e)] then 0 else greatest(least({raw}, len(e) - 1), 1) end"
    edges = f"(select list_sort(list_distinct(quantile_cont({col}, [0, 0.1, 0.2, 0.3, 0.4, 0.5, 0.6, 0.7, 0.8, 0.9, 1]))) e from week0)"
    return f"""select window_start, '{col}' feature, max(inside)::bigint n_current, sum((pc - pe) * ln(pc / pe)) psi, max(outside / (inside + outside)::double) outside_share from (
      select window_start, inside, outside, (e1 + 1) / (sum(e1) over w + count(*) over w)::double pe, (a1 + 1) / (inside + count(*) over w)::double pc from (
        select window_start, b, coalesce(e1, 0) e1, coalesce(a1, 0) a1, inside, outside
        from (select distinct {WEEK_SQL} window_start from signals where {CLOSED.replace('from audit', 'from signals')}) weeks
        cross join (select unnest(range(1, len(e))) b from {edges})
        left join (select {spot} b, count(*) e1 from week0, {edges} group by 1) using (b)
        left join (select {WEEK_SQL} window_start, {spot} b, count(*) a1 from signals, {edges} group by 1, 2) using (window_start, b)
        join (select {WEEK_SQL} window_start, count(*) filter ({spot} > 0) inside, count(*) filter ({spot} = 0) outside from signals, {edges} group by 1) using (window_start))
      window w as (partition by window_start)) group by 1"""


@query("windowed_psi", "select window_start, feature, n_current, round(psi, 6) psi, round(outside_share, 6) outside_share, case when psi > 0.2 then 'DRIFT' else 'OK' end status from ("
       + " union all ".join(weekly_psi_sql(c) for c in SIGNALS) + ")", SIGNAL_CTE)
def _(spark, d):
    """Weekly drift of the stream against the first week: a window's index leaves the state when the watermark has passed it."""
    rows = signals(spark, d)
    baseline = stream_drift.baseline_bins(rows.where(F.col("timestamp") < F.lit("2024-01-08").cast("timestamp")), SIGNALS)
    src, out, state = by_day(rows, spark, "signals", io.append_table), scratch(spark, "psi-out"), scratch(spark, "psi-state")
    stream = spark.readStream.schema(rows.schema).parquet(src)
    st.drain(stream_drift.windowed_psi(stream, baseline, retention="7 days"), out, state)
    return spark.read.parquet(out).withColumn("window_start", F.date_format("window_start", "yyyy-MM-dd"))


@query("score_stream")
def _(spark, d):
    """Test accounts arriving as a stream, scored row by row, written as audit rows."""
    train, test = prepared(spark, d)
    model = models.fit_logistic(train, FEATURES, LABEL, "weight")
    src, out, state = scratch(spark, "arrivals"), scratch(spark, "scored"), scratch(spark, "scored-state")
    io.write_table(test, src)
    stream = st.score_stream(spark.readStream.schema(test.schema).parquet(src), model).withColumn("risk_tier", audit_tier("probability"))
    st.drain(io.audit_rows(stream, KEY, "probability", ["industry"]), out, state, fmt="json")
    return spark.read.json(out).groupBy("risk_tier").agg(F.count(F.lit(1)).alias("n_rows"), F.max("probability").alias("max_probability"))
