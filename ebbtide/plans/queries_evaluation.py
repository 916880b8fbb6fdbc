"""Registered queries: evaluation, fairness, splits and sampling, sorts, neighbours."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import encode, evaluate, fairness, features, neighbors, profile, sampling
from ..session import staged
from . import views as v
from .queries_tables import SPLIT_CTE, three_way
from .registry import query

CONF = "count(*) filter (y = 0 and yhat = 0) tn, count(*) filter (y = 0 and yhat = 1) fp, count(*) filter (y = 1 and yhat = 0) fn, count(*) filter (y = 1 and yhat = 1) tp"
RATES = """tn, fp, fn, tp, (tp + tn)::double / (tp + tn + fp + fn) accuracy, coalesce(tp::double / nullif(tp + fp, 0), 0) as precision,
  coalesce(tp::double / nullif(tp + fn, 0), 0) recall, coalesce(2 * tp::double / nullif(2 * tp + fp + fn, 0), 0) f1"""

# Pairs of a positive and a negative, counted through the distinct scores.
AUC_CTE = """
  score_counts as (select model, p, (count(*) filter (y = 1))::double pos, (count(*) filter (y = 0))::double neg from scored_models group by 1, 2),
  aucs as (select model, sum(pos * (below + neg / 2)) / (sum(pos) * sum(neg)) roc_auc, sum(pos)::bigint n_pos, sum(neg)::bigint n_neg from (
      select *, sum(neg) over (partition by model order by p) - neg below from score_counts) group by 1),
  confs as (select model, """ + CONF + """, avg((p - y) * (p - y)) brier from scored_models group by 1),
  model_metrics as (select model, """ + RATES + """, brier, roc_auc from confs join aucs using (model))"""

CURVE_CTE = """
  pts as (select p, sum(pos) over w tp, sum(neg) over w fp, pos, neg, sum(pos) over () n_pos, sum(neg) over () n_neg from (
      select p, (count(*) filter (y = 1))::double pos, (count(*) filter (y = 0))::double neg from scored group by 1) window w as (order by p desc))"""


@query("confusion", "select " + CONF + " from scored")
def _(spark, d):
    return evaluate.confusion(v.scored(spark, d), "y", "yhat")


@query("core_metrics", """select tn, fp, fn, tp, round(accuracy, 6) accuracy, round(precision, 6) as precision, round(recall, 6) recall, round(f1, 6) f1, round(brier, 6) brier,
  round(roc_auc, 6) roc_auc from model_metrics where model = 'model_a'""", AUC_CTE)
def _(spark, d):
    return evaluate.core_metrics(v.scored(spark, d), "y", "yhat", "p")


@query("compare_models", """select model, tn, fp, fn, tp, round(accuracy, 6) accuracy, round(precision, 6) as precision, round(recall, 6) recall, round(f1, 6) f1,
  round(brier, 6) brier, round(roc_auc, 6) roc_auc from model_metrics""", AUC_CTE)
def _(spark, d):
    return evaluate.compare_models(v.scored_models(spark, d), "model", "y", "yhat", "p")


@query("classification_report", """select "class", round(precision, 6) as precision, round(recall, 6) recall, round(f1, 6) f1, support from (
  select '0' "class", tn::double / (tn + fn) as precision, tn::double / (tn + fp) recall, 2 * tn::double / (2 * tn + fn + fp) f1, tn + fp support from c
  union all select '1', tp::double / (tp + fp), tp::double / (tp + fn), 2 * tp::double / (2 * tp + fn + fp), tp + fn from c
  union all select 'accuracy', null, null, (tp + tn)::double / (tp + tn + fp + fn), tp + tn + fp + fn from c
  union all select 'macro avg', (tn::double / (tn + fn) + tp::double / (tp + fp)) / 2, (tn::double / (tn + fp) + tp::double / (tp + fn)) / 2,
    (2 * tn::double / (2 * tn + fn + fp) + 2 * tp::double / (2 * tp + fn + fp)) / 2, tp + tn + fp + fn from c
  union all select 'weighted avg', (tn::double / (tn + fn) * (tn + fp) + tp::double / (tp + fp) * (tp + fn)) / (tp + tn + fp + fn),
    (tn::double / (tn + fp) * (tn + fp) + tp::double / (tp + fn) * (tp + fn)) / (tp + tn + fp + fn),
    (2 * tn::double / (2 * tn + fn + fp) * (tn + fp) + 2 * tp::double / (2 * tp + fn + fp) * (tp + fn)) / (tp + tn + fp + fn), tp + tn + fp + fn from c)""",
       "\n  c as (select " + CONF + " from scored)")
def _(spark, d):
    return evaluate.classification_report(v.scored(spark, d), "y", "yhat")


@query("roc_points", """select round(p, 6) threshold, round(fp / n_neg, 6) fpr, round(tp / n_pos, 6) tpr from pts union all select null, 0, 0""", CURVE_CTE)
def _(spark, d):
    return evaluate.roc_points(v.scored(spark, d), "y", "p")


@query("roc_auc", "select model, n_pos, n_neg, round(roc_auc, 6) roc_auc from aucs", AUC_CTE)
def _(spark, d):
    return evaluate.roc_auc(v.scored_models(spark, d), "y", "p", by=["model"])


@query("roc_auc_large", """select round(sum(pos * (below + neg / 2)) / (sum(pos) * sum(neg)), 6) roc_auc, sum(pos)::bigint n_pos, sum(neg)::bigint n_neg from (
  select *, sum(neg) over (order by s) - neg below from (select l_extendedprice s, (count(*) filter (l_quantity > 25))::double pos,
    (count(*) filter (l_quantity <= 25))::double neg from lineitem group by 1))""")
def _(spark, d):
    """Near-distinct scores: one line item each."""
    li = v.table(spark, d, "lineitem").select(F.col("l_extendedprice").alias("s"), (F.col("l_quantity") > 25).cast("int").alias("y"))
    return evaluate.roc_auc(li, "y", "s")


@query("pr_points", """select round(p, 6) threshold, round(tp / (tp + fp), 6) as precision, round(tp / n_pos, 6) recall from pts union all select null, 1, 0""", CURVE_CTE)
def _(spark, d):
    return evaluate.pr_points(v.scored(spark, d), "y", "p")


@query("pr_auc", """select round(sum(pos / n_pos * (tp / (tp + fp) + coalesce((tp - pos) / nullif(tp - pos + fp - neg, 0), 1)) / 2), 6) pr_auc,
  round(max(n_pos) / max(n_pos + n_neg), 6) prevalence from pts""", CURVE_CTE)
def _(spark, d):
    return evaluate.pr_auc(v.scored(spark, d), "y", "p")


@query("calibration", """select greatest(ceil(p * 10) - 1, 0)::bigint bin, count(*) n_rows, round(avg(p), 9) mean_score, round(avg(y), 9) fraction_positive from scored group by 1""", digits=9)
def _(spark, d):
    return evaluate.calibration(v.scored(spark, d), "y", "p")


LEAK = ["balance", "n_orders", "max_spend", "neg_recency"]


@query("leakage_auc", "select feature, n_rows, round(greatest(a, 1 - a), 6) auc, greatest(a, 1 - a) > 0.95 leaks from (" + " union all ".join(f"""
  select '{c}' feature, sum(pos * (below + neg / 2)) / (sum(pos) * sum(neg)) a, (sum(pos) + sum(neg))::bigint n_rows from (select *, sum(neg) over (order by x) - neg below from (
    select {c} x, (count(*) filter (churn_flag = 1))::double pos, (count(*) filter (churn_flag = 0))::double neg from lk where {c} is not null group by 1))""" for c in LEAK) + ")",
       "\n  lk as (select *, epoch_us(last_order) / 1000000::double neg_recency from accounts)")
def _(spark, d):
    """The last order date decides the label here, so it must be found."""
    from ..functions import epoch_seconds
    a = v.accounts(spark, d).withColumn("neg_recency", epoch_seconds("last_order"))
    return evaluate.leakage_auc(a, LEAK, "churn_flag")


def variant_metrics(spark, d):
    """Two models, each with a plain and a lowered (balanced) threshold."""
    cells = F.array(F.struct(F.lit("unbalanced").alias("variant"), (F.col("p") >= 0.5).cast("int").alias("yhat")),
                    F.struct(F.lit("balanced").alias("variant"), (F.col("p") >= 0.35).cast("int").alias("yhat")))
    s = v.scored_models(spark, d).drop("yhat").select("model", "y", F.explode(cells).alias("e")).select("model", "y", "e.*")
    return evaluate.core_metrics(s, "y", "yhat", by=["model", "variant"])


@query("balancing_delta", """select model, round(max(recall) filter (variant = 'balanced') - max(recall) filter (variant = 'unbalanced'), 6) delta_recall,
  round(max(f1) filter (variant = 'balanced') - max(f1) filter (variant = 'unbalanced'), 6) delta_f1 from (select model, variant, """ + RATES + """ from (
    select model, variant, count(*) filter (y = 0 and p < t) tn, count(*) filter (y = 0 and p >= t) fp, count(*) filter (y = 1 and p < t) fn, count(*) filter (y = 1 and p >= t) tp
    from scored_models, (values ('balanced', 0.35::double), ('unbalanced', 0.5::double)) x(variant, t) group by 1, 2)) group by 1""")
def _(spark, d):
    return evaluate.balancing_delta(variant_metrics(spark, d))


@query("business_capture", """select model, tp + fn n_positive, tp detected, fp false_alarms, fn undetected from confs""", AUC_CTE)
def _(spark, d):
    m = evaluate.core_metrics(v.scored_models(spark, d), "y", "yhat", by=["model"])
    return evaluate.business_capture(m).select("model", "n_positive", "detected", "false_alarms", "undetected")


@query("top_decile_capture", """select count(*) filter (rk <= ceil(n * 0.1::double)) n_top, count(*) filter (rk <= ceil(n * 0.1::double) and y = 1) captured, count(*) filter (y = 1) n_positive,
  round((count(*) filter (rk <= ceil(n * 0.1::double) and y = 1))::double / count(*) filter (y = 1), 6) capture_rate,
  (count(*) filter (rk <= ceil(n * 0.1::double) and y = 1))::double / count(*) filter (y = 1) >= 0.7 meets_target
  from (select *, row_number() over (order by p desc, account_id) rk, count(*) over () n from scored)""")
def _(spark, d):
    return evaluate.top_decile_capture(v.scored(spark, d), "account_id", "y", "p")


@query("accuracy_cost", """select model, round(accuracy, 6) accuracy, round((select accuracy from model_metrics where model = 'model_a') - accuracy, 6) accuracy_cost
  from model_metrics where model <> 'model_a'""", AUC_CTE)
def _(spark, d):
    return evaluate.accuracy_cost(evaluate.core_metrics(v.scored_models(spark, d), "y", "yhat", by=["model"]), "model_a")


@query("quality_gates", """select model, metric, '>=' direction, gate, round(value, 6) as value, value >= gate passed from (
  select model, 'roc_auc' metric, 0.8::double gate, roc_auc as value from model_metrics union all select model, 'recall', 0.65, recall from model_metrics
  union all select model, 'f1', 0.6, f1 from model_metrics)""", AUC_CTE)
def _(spark, d):
    return evaluate.quality_gates(evaluate.core_metrics(v.scored_models(spark, d), "y", "yhat", "p", by=["model"]), keep=["model"])


@query("target_gates", """select model, metric, direction, gate, round(value, 6) as value, case direction when '>=' then value >= gate else value <= gate end passed from (
  select model, unnest([{'metric': 'recall', 'direction': '>=', 'gate': 0.75::double, 'value': recall}, {'metric': 'f1', 'direction': '>=', 'gate': 0.65, 'value': f1},
    {'metric': 'roc_auc', 'direction': '>=', 'gate': 0.8, 'value': roc_auc}, {'metric': 'pr_auc', 'direction': '>=', 'gate': 0.6, 'value': pr_auc},
    {'metric': 'brier', 'direction': '<=', 'gate': 0.15, 'value': brier}], recursive := true) from model_metrics join pr_aucs using (model))""", AUC_CTE, """
  pr_aucs as (select model, sum(pos / n_pos * (tp / (tp + fp) + coalesce((tp - pos) / nullif(tp - pos + fp - neg, 0), 1)) / 2) pr_auc from (
      select model, pos, neg, sum(pos) over w tp, sum(neg) over w fp, sum(pos) over (partition by model) n_pos from score_counts window w as (partition by model order by p desc)) group by 1)""")
def _(spark, d):
    """All documented targets of both models, the area under the precision-recall curve among them."""
    metrics = evaluate.core_metrics(v.scored_models(spark, d), "y", "yhat", "p", by=["model"], curve=True)
    return evaluate.quality_gates(metrics, evaluate.DOCUMENTED_GATES, keep=["model"])


@query("scoring_stats", """select count(*) prediction_count, round(avg(p), 4) avg_probability, count(*) filter (p >= 0.7::double) high_risk_count from scored""")
def _(spark, d):
    return evaluate.scoring_stats(v.scored(spark, d).withColumn("risk_tier", features.audit_tier("p")), "p")


@query("tier_counts", """select position, tier, count(p) n_rows, round(100::double * count(p) / (select count(*) from scored), 6) pct from
  (values (0, 'Critical', 0.75::double, 9), (1, 'High', 0.5, 0.75), (2, 'Medium', 0.25, 0.5), (3, 'Low', -1, 0.25)) t(position, tier, lo, hi)
  left join scored on p > lo and p <= hi group by 1, 2""")
def _(spark, d):
    return evaluate.tier_counts(features.risk_tier(v.scored(spark, d), "p"))


@query("scored_summary", "select count(*) n_scored, count(*) filter (yhat = 1) n_predicted, round(100::double * count(*) filter (yhat = 1) / count(*), 6) pct_predicted from scored")
def _(spark, d):
    return evaluate.scored_summary(v.scored(spark, d), "yhat")


@query("risk_report", "select account_id, round(p, 6) p, yhat from scored")
def _(spark, d):
    return evaluate.risk_report(v.scored(spark, d), "account_id", "p", ["yhat"])


@query("top_n", "select l_orderkey * 8 + l_linenumber row_key, l_extendedprice from lineitem order by l_extendedprice desc, 1 limit 20")
def _(spark, d):
    li = v.table(spark, d, "lineitem").select((F.col("l_orderkey") * 8 + F.col("l_linenumber")).alias("row_key"), "l_extendedprice")
    return evaluate.top_n(li, "l_extendedprice", 20, "row_key")


@query("highest_risk", "select account_id, round(p, 6) p, industry from scored order by p desc, account_id limit 1")
def _(spark, d):
    return evaluate.highest_risk(v.scored(spark, d).select("account_id", "p", "industry"), "account_id", "p")


@query("top_signals", """select event_id, position, feature, round(value, 6) as value, case when value > 0 then 'INCREASES_CHURN' else 'DECREASES_CHURN' end impact,
  case when abs(value) > 0.5 then 'HIGH' else 'MEDIUM' end strength from (select *, row_number() over (partition by event_id order by abs(value) desc, i) position from (
    select event_id, unnest(['value', 'user', 'step', 'slot']) feature, unnest([0, 1, 2, 3]) i,
      unnest([(value - 10) / 10::double, (user_id % 11 - 5) / 7::double, (event_id % 7 - 3) / 5::double, (event_id % 13 - 6) / 10::double]) as value from events)) where position <= 3""")
def _(spark, d):
    return evaluate.top_signals(v.table(spark, d, "events"), "event_id", {
        "value": (F.col("value") - 10) / F.lit(10.0), "user": (F.col("user_id") % 11 - 5) / F.lit(7.0), "step": (F.col("event_id") % 7 - 3) / F.lit(5.0),
        "slot": (F.col("event_id") % 13 - 6) / F.lit(10.0)})


@query("rank_importance", """select feature, round(abs(r), 6) importance, feature = 'n_orders' is_proxy from (select 'balance' feature, corr(balance, churn_flag) r from accounts
  union all select 'n_orders', corr(n_orders, churn_flag) from accounts union all select 'max_spend', corr(max_spend, churn_flag) from accounts) order by 2 desc limit 2""")
def _(spark, d):
    r = profile.correlate_with(v.accounts(spark, d), ["balance", "n_orders", "max_spend"], "churn_flag")
    return evaluate.rank_importance(r.select("feature", F.abs("r").alias("importance")), 2, ["n_orders"])


@query("best_run", "select model, round(roc_auc, 6) roc_auc, variant from (select model, roc_auc, 'run_' || model variant from model_metrics) where model = 'model_b' order by roc_auc desc limit 1", AUC_CTE)
def _(spark, d):
    from ..operators.models import best_run
    m = evaluate.core_metrics(v.scored_models(spark, d), "y", "yhat", "p", by=["model"]).withColumn("variant", F.concat(F.lit("run_"), F.col("model")))
    return best_run(m, "model_b", run="variant").select("model", "roc_auc", "variant")


@query("majority_baseline", """select split, count(*) n_rows, count(*) filter (churn_flag = (select churn_flag from split3 where split = 'train' group by 1 order by count(*) desc, 1 limit 1)) n_correct,
  max((select churn_flag from split3 where split = 'train' group by 1 order by count(*) desc, 1 limit 1)) prediction from split3 group by 1""", SPLIT_CTE)
def _(spark, d):
    from ..operators.models import majority_baseline
    s = three_way(spark, d)
    out = majority_baseline(s.where(F.col("split") == "train"), s, "churn_flag")
    return out.groupBy("split").agg(F.count(F.lit(1)).alias("n_rows"), F.count_if(F.col("prediction") == F.col("churn_flag")).alias("n_correct"),
                                    F.max("prediction").alias("prediction"))


# ---- fairness --------------------------------------------------------------------------------------------------

def fair_sql(src: str, group: str = "grp", attr: str = "'industry'") -> str:
    return f"""select {attr} attribute, n_u n_unprivileged, n_p n_privileged, su rate_unprivileged, sp rate_privileged, su - sp demographic_parity_diff, su / sp disparate_impact,
      ((fpr_u - fpr_p) + (tpr_u - tpr_p)) / 2 equalized_odds_diff, ((ppv_u - ppv_p) + (for_u - for_p)) / 2 predictive_parity_diff from (select count(*) filter ({group} = 0) n_u,
      count(*) filter ({group} = 1) n_p, avg(yhat) filter ({group} = 0) su, avg(yhat) filter ({group} = 1) sp, avg(yhat) filter ({group} = 0 and y = 0) fpr_u, avg(yhat) filter ({group} = 1 and y = 0) fpr_p,
      avg(yhat) filter ({group} = 0 and y = 1) tpr_u, avg(yhat) filter ({group} = 1 and y = 1) tpr_p, avg(y) filter ({group} = 0 and yhat = 1) ppv_u, avg(y) filter ({group} = 1 and yhat = 1) ppv_p,
      avg(y) filter ({group} = 0 and yhat = 0) for_u, avg(y) filter ({group} = 1 and yhat = 0) for_p from {src})"""


FAIR_COLS = """n_unprivileged, n_privileged, round(rate_unprivileged, 6) rate_unprivileged, round(rate_privileged, 6) rate_privileged, round(demographic_parity_diff, 6) demographic_parity_diff,
  round(disparate_impact, 6) disparate_impact, round(equalized_odds_diff, 6) equalized_odds_diff, round(predictive_parity_diff, 6) predictive_parity_diff"""
UNFAIR_CTE = """
  unfair as (select account_id, industry, y, grp, p + 0.3::double * (1 - (industry like '%BUILD%')::int) q, (p + 0.3::double * (1 - (industry like '%BUILD%')::int) >= 0.5)::int yhat,
      (industry <> 'BUILDING')::int grp_b, (industry not like '%MACHINE%')::int grp_m from scored)"""


def unfair(spark, d):
    """The score is raised for every industry but one, which harms exactly that group's rate."""
    s = v.scored(spark, d)
    q = F.col("p") + F.lit(0.3) * (1 - F.col("industry").contains("BUILD").cast("int"))
    return s.select("account_id", "industry", "y", "grp", q.alias("q"), (q >= 0.5).cast("int").alias("yhat"))


@query("fairness_metrics", "select " + FAIR_COLS + " from (" + fair_sql("scored") + ")")
def _(spark, d):
    return fairness.fairness_metrics(v.scored(spark, d), "y", "yhat", "grp")


@query("fairness_verdict", "select attribute, " + FAIR_COLS + """, abs(demographic_parity_diff) <= 0.1 demographic_parity_ok, abs(equalized_odds_diff) <= 0.1 equalized_odds_ok,
  abs(predictive_parity_diff) <= 0.1 predictive_parity_ok, abs(demographic_parity_diff) <= 0.1 and abs(equalized_odds_diff) <= 0.1 and abs(predictive_parity_diff) <= 0.1 is_fair,
  abs(demographic_parity_diff) < 0.1 parity_only_ok from (""" + fair_sql("unfair", "grp_b", "'building'") + " union all " + fair_sql("unfair", "grp_m", "'machinery'") + ")", UNFAIR_CTE)
def _(spark, d):
    m = fairness.fairness_by_attribute(unfair(spark, d), "y", "yhat", {
        "building": encode.encode_protected("industry", "BUILDING"), "machinery": encode.encode_protected("industry", "MACHINE")})
    return fairness.fairness_verdict(m)


@query("proxy_features", "select * from (select 'q' feature, round(corr(q, grp_b), 6) r from unfair union all select 'yhat', round(corr(yhat, grp_b), 6) from unfair union all select 'account_id', round(corr(account_id, grp_b), 6) from unfair) where abs(r) > 0.3", UNFAIR_CTE)
def _(spark, d):
    u = unfair(spark, d).withColumn("g", encode.encode_protected("industry", "BUILDING"))
    return fairness.proxy_features(u, ["q", "yhat", "account_id"], "g")


@query("class_weights", "select account_id, round(n / (2::double * c), 6) weight from (select account_id, count(*) over () n, count(*) over (partition by churn_flag) c from accounts)")
def _(spark, d):
    return fairness.class_weights(v.accounts(spark, d).select("account_id", "churn_flag"), "churn_flag").select("account_id", "weight")


@query("class_weight_table", "select churn_flag, count(*) n_rows, round((select count(*) from accounts) / (2::double * count(*)), 6) weight from accounts group by 1")
def _(spark, d):
    return fairness.class_weight_table(v.accounts(spark, d), "churn_flag")


@query("reweighing", "select account_id, round(ng::double * ny / (n::double * ngy), 6) weight from (select account_id, count(*) over (partition by grp) ng, count(*) over (partition by y) ny, count(*) over (partition by grp, y) ngy, count(*) over () n from scored)")
def _(spark, d):
    return fairness.reweighing(v.scored(spark, d), "grp", "y").select("account_id", "weight")


@query("reweighing_table", "select grp, y, ngy n_gy, round(ng::double * ny / (n::double * ngy), 6) weight from (select distinct grp, y, count(*) over (partition by grp) ng, count(*) over (partition by y) ny, count(*) over (partition by grp, y) ngy, count(*) over () n from scored)")
def _(spark, d):
    return fairness.reweighing_table(v.scored(spark, d), "grp", "y")


# ---- splits and samples ----------------------------------------------------------------------------------------

@query("stratified_split", "select account_id, churn_flag, split from split3", SPLIT_CTE)
def _(spark, d):
    return three_way(spark, d).select("account_id", "churn_flag", "split")


@query("stratified_folds", "select account_id, ((rk - 1) % 5)::int fold from ranked", SPLIT_CTE)
def _(spark, d):
    return sampling.stratified_folds(v.accounts(spark, d), "account_id", "churn_flag").select("account_id", "fold")


@query("seeded_sample", "select o_orderkey, o_totalprice from orders order by md5(o_orderkey || ':7'), o_orderkey limit 200")
def _(spark, d):
    return sampling.seeded_sample(v.table(spark, d, "orders"), "o_orderkey", 200, 7).select("o_orderkey", "o_totalprice")


@query("shuffled", "select account_id, industry from accounts")
def _(spark, d):
    return sampling.shuffled(v.accounts(spark, d), "account_id").select("account_id", "industry")


@query("union_segments", "select account_id, case when n_orders > 9 then 'large' else 'small' end segment from accounts")
def _(spark, d):
    a = v.accounts(spark, d).select("account_id", "n_orders")
    return sampling.union_segments({"large": a.where(F.col("n_orders") > 9), "small": a.where(F.col("n_orders") <= 9)}).select("account_id", "segment")


# ---- neighbours and oversampling -------------------------------------------------------------------------------

EMB = """
  emb as (select vec_id, embedding::double[] v, label from embeddings),
  pairs as (select a.vec_id as "key", b.vec_id neighbor, a.label ya, b.label yb, list_distance(a.v, b.v) distance from emb a join emb b on a.vec_id <> b.vec_id),
  nn as (select *, row_number() over (partition by "key" order by distance, neighbor) position from pairs)"""


@query("nearest_neighbors", 'select "key", neighbor, round(distance, 6) distance, position from nn where position <= 5', EMB)
def _(spark, d):
    e = v.table(spark, d, "embeddings")
    return neighbors.nearest_neighbors(e, e, "vec_id", "embedding", 5)


@query("tomek_links", """select a."key" key_a, a.neighbor key_b, round(a.distance, 6) distance from nn a join nn b on a.neighbor = b."key" and b.neighbor = a."key"
  where a.position = 1 and b.position = 1 and a."key" < a.neighbor and (a.ya = 0) <> (a.yb = 0)""", EMB)
def _(spark, d):
    e = v.table(spark, d, "embeddings").withColumn("y", (F.col("label") == 0).cast("int"))
    return neighbors.tomek_links(e, "vec_id", "y", "embedding")


@query("transfer_attribute", """select a.vec_id, arg_min(b.vec_id, (list_distance(a.v, b.v), b.vec_id)) neighbor, round(min(list_distance(a.v, b.v)), 6) distance,
  arg_min(b.label, (list_distance(a.v, b.v), b.vec_id)) as label from (select * from emb where label >= 5) a, (select * from emb where label < 5) b group by 1""", EMB)
def _(spark, d):
    e = v.table(spark, d, "embeddings")
    return neighbors.transfer_attribute(e.where(F.col("label") >= 5).drop("label"), e.where(F.col("label") < 5), "vec_id", "vec_id", "embedding", "label")


SMOTE_FEATURES = ["balance", "n_orders"]


def scaled(spark, d):
    a = v.accounts(spark, d).select("account_id", "churn_flag", *SMOTE_FEATURES)
    return encode.standardize_apply(a, encode.standardize_fit(a, SMOTE_FEATURES))


@query("smote", """select (select count(*) from accounts where churn_flag = 0) - (select count(*) from accounts where churn_flag = 1) n_synthetic, (select count(*) from accounts where churn_flag = 1) n_parents, true on_segment""")
def _(spark, d):
    """How many synthetic rows, from how many parents, and whether all lie between parent and neighbour."""
    base = staged(scaled(spark, d))
    s = sampling.smote(base, "account_id", "churn_flag", SMOTE_FEATURES)
    src = base.select("account_id", *SMOTE_FEATURES)
    a = src.withColumnsRenamed({"account_id": "parent", **{f: f"a_{f}" for f in SMOTE_FEATURES}})
    b = src.withColumnsRenamed({"account_id": "neighbor", **{f: f"b_{f}" for f in SMOTE_FEATURES}})
    ok = None
    for f in SMOTE_FEATURES:
        between = (F.col(f) >= F.least(f"a_{f}", f"b_{f}") - 1e-9) & (F.col(f) <= F.greatest(f"a_{f}", f"b_{f}") + 1e-9)
        ok = between if ok is None else ok & between
    return s.join(a, "parent").join(b, "neighbor").agg(F.count(F.lit(1)).alias("n_synthetic"), F.count_distinct("parent").alias("n_parents"), F.every(ok).alias("on_segment"))


UNIT = "(('0x' || substr(md5(concat_ws(':', parent, round, '{tag}')), 1, 8))::bigint / 4294967296::double)"
SMOTE_CTE = f"""
  scl as (select account_id, churn_flag, (balance - (select avg(balance) from accounts)) / (select stddev_pop(balance) from accounts) balance,
      (n_orders - (select avg(n_orders) from accounts)) / (select stddev_pop(n_orders) from accounts) n_orders from accounts),
  small as (select account_id parent, balance, n_orders, row_number() over (order by md5(account_id || ':42'), account_id) rk, count(*) over () n,
      (select count(*) filter (churn_flag = 0) - count(*) filter (churn_flag = 1) from scl) need from scl where churn_flag = 1),
  near as (select parent, neighbor, row_number() over (partition by parent order by dist, neighbor) pos from (
      select a.parent, b.parent neighbor, sqrt((a.balance - b.balance) ** 2 + (a.n_orders - b.n_orders) ** 2) dist from small a join small b on a.parent <> b.parent)),
  drawn as (select *, {UNIT.format(tag='g42')} gap, floor({UNIT.format(tag='n42')} * 5)::bigint + 1 pick
      from (select *, unnest(range((need - rk) // n + 1)) round from small where rk <= need)),
  made as (select d.parent, x.neighbor, d.round, d.gap, d.balance + d.gap * (o.balance - d.balance) balance, d.n_orders + d.gap * (o.n_orders - d.n_orders) n_orders
      from drawn d join near x on x.parent = d.parent and x.pos = d.pick join small o on o.parent = x.neighbor),
  grown as (select 'r:' || account_id row_id, balance, n_orders, churn_flag from scl union all select 's:' || parent || ':' || round, balance, n_orders, 1 from made),
  nearest as (select a.row_id, a.churn_flag, arg_min(b.row_id, ((a.balance - b.balance) ** 2 + (a.n_orders - b.n_orders) ** 2, b.row_id)) nb
      from grown a join grown b on a.row_id <> b.row_id group by 1, 2),
  linked as (select a.row_id from nearest a join nearest b on a.nb = b.row_id and b.nb = a.row_id where a.churn_flag <> b.churn_flag)"""


@query("smote_rows", "select parent, neighbor, round, round(gap, 6) gap, round(balance, 6) balance, round(n_orders, 6) n_orders, 1 churn_flag from made", SMOTE_CTE)
def _(spark, d):
    """The synthetic rows themselves."""
    return sampling.smote(staged(scaled(spark, d)), "account_id", "churn_flag", SMOTE_FEATURES)


@query("smote_tomek", """select churn_flag, count(*) n_rows, count(*) filter (row_id like 's:%') n_synthetic from grown
  where row_id not in (select row_id from linked) group by 1""", SMOTE_CTE)
def _(spark, d):
    """Rows left per class after oversampling and removing Tomek links."""
    out = sampling.smote_tomek(staged(scaled(spark, d)), "account_id", "churn_flag", SMOTE_FEATURES, stage=staged)
    return out.groupBy("churn_flag").agg(F.count(F.lit(1)).alias("n_rows"), F.count_if(F.col("row_id").startswith("s:")).alias("n_synthetic"))
