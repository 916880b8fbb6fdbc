"""Registered queries: base table, roll-ups, derived features, encodings."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import elapsed_days
from ..operators import encode, features, rollups
from ..operators.models import vif
from ..session import staged
from . import abt, churn
from . import views as v
from .queries_tables import PAYLOAD_CTE, SPLIT_CTE, _payload, three_way
from .registry import as_text, query

DAY = "86400::double"
REF_SQL = f"timestamp '{v.REF}'"


def days_sql(later: str, earlier: str) -> str:
    return f"floor((epoch_us({later}) / 1000000::double - epoch_us({earlier}) / 1000000::double) / {DAY})"


def build(spark, d):
    return abt.build_abt(v.accounts(spark, d), v.subscriptions(spark, d), v.feature_usage(spark, d), v.support_tickets(spark, d))


# ---- base table ------------------------------------------------------------------------------------------------

ABT_SQL = """select a.account_id, industry, country, balance, churn_flag, subscription_id, mrr_amount, plan_tier sub_plan_tier,
  billing_frequency, round(total_events, 4) total_events, round(avg_daily_usage, 4) avg_daily_usage, round(total_duration_secs, 4) total_duration_secs,
  round(avg_duration_secs, 4) avg_duration_secs, round(total_errors, 4) total_errors, round(avg_errors, 4) avg_errors, active_days,
  strftime(last_activity_date, '%Y-%m-%d %H:%M:%S') last_activity_date, strftime(first_activity_date, '%Y-%m-%d %H:%M:%S') first_activity_date,
  unique_features_used, beta_feature_usage, ticket_count, round(avg_satisfaction, 4) avg_satisfaction, min_satisfaction,
  round(avg_resolution_hours, 4) avg_resolution_hours, escalation_count, strftime(last_ticket_date, '%Y-%m-%d %H:%M:%S') last_ticket_date
  from accounts a left join latest_sub s using (account_id) left join usage_agg u using (account_id) left join ticket_agg t using (account_id)"""


@query("build_abt", ABT_SQL, digits=4)
def _(spark, d):
    """One row per account with its latest subscription, usage and ticket measures, and the label."""
    return as_text(build(spark, d), "last_activity_date", "first_activity_date", "last_ticket_date").drop(
        "account_name", "signup_date", "last_order", "n_orders", "avg_spend", "max_spend", "start_date", "avg_first_response_min")


@query("build_abt_event_label", """select account_id, (account_id in (select user_id from events where event_type = 'error'))::int churn_flag,
  count(o_orderkey) n_subs from accounts left join orders on o_custkey = account_id group by 1, 2""")
def _(spark, d):
    """Label taken from membership in an event table instead of the account's flag."""
    lost = v.table(spark, d, "events").where(F.col("event_type") == "error").select(F.col("user_id").alias("account_id"))
    out = abt.build_abt(v.accounts(spark, d), v.subscriptions(spark, d), v.feature_usage(spark, d), v.support_tickets(spark, d), churn_events=lost)
    return out.select("account_id", "churn_flag", F.col("n_orders").alias("n_subs"))


@query("clean_abt", """select account_id, industry, churn_flag, round(least(greatest(coalesce(balance, 0), b.lo), b.hi), 4) balance,
  round(least(greatest(coalesce(mrr_amount, m.med), m.lo), m.hi), 4) mrr_amount, coalesce(round(avg_satisfaction, 4), round(st.med, 4)) avg_satisfaction
  from abt, bq b, mq m, stq st""", """
  abt as (select a.*, mrr_amount, plan_tier, t.avg_satisfaction from accounts a left join latest_sub using (account_id) left join ticket_agg t using (account_id)),
  bq as (select q1 - 1.5::double * (q3 - q1) lo, q3 + 1.5::double * (q3 - q1) hi from (select quantile_cont(balance, 0.25) q1, quantile_cont(balance, 0.75) q3 from abt)),
  mq0 as (select median(mrr_amount) med from abt),
  mq as (select med, q1 - 1.5::double * (q3 - q1) lo, q3 + 1.5::double * (q3 - q1) hi from (select med, quantile_cont(coalesce(mrr_amount, med), 0.25) q1,
    quantile_cont(coalesce(mrr_amount, med), 0.75) q3 from abt, mq0 group by med)),
  stq as (select median(avg_satisfaction) med from abt)""", digits=4)
def _(spark, d):
    """Base table staged once, then imputed and capped from fitted constants."""
    out = abt.clean_abt(build(spark, d).drop("last_order", "signup_date", "avg_first_response_min"))
    return out.select("account_id", "industry", "churn_flag", "balance", "mrr_amount", "avg_satisfaction")


# ---- roll-ups and joins ----------------------------------------------------------------------------------------

@query("latest_per_key", "select account_id, subscription_id, mrr_amount, plan_tier from latest_sub")
def _(spark, d):
    return rollups.latest_per_key(v.subscriptions(spark, d), "account_id", "start_date", "subscription_id").select(
        "account_id", "subscription_id", "mrr_amount", "plan_tier")


@query("latest_per_key_stitched", """select account_id, max_by(tier, (start_date, subscription_id)) filter (tier is not null) tier,
  max_by(amount, (start_date, subscription_id)) filter (amount is not null) amount from (
  select *, case when subscription_id % 3 <> 0 then plan_tier end tier, case when subscription_id % 4 <> 1 then mrr_amount end amount from subscriptions) group by 1""")
def _(spark, d):
    s = v.subscriptions(spark, d).select(
        "account_id", "subscription_id", "start_date", F.when(F.col("subscription_id") % 3 != 0, F.col("plan_tier")).alias("tier"),
        F.when(F.col("subscription_id") % 4 != 1, F.col("mrr_amount")).alias("amount"))
    return rollups.latest_per_key(s, "account_id", "start_date", "subscription_id", stitch=True).select("account_id", "tier", "amount")


@query("two_hop", """select s.account_id, count(*) n_facts, round(sum(usage_count), 4) total from feature_usage left join
  (select distinct subscription_id, account_id from subscriptions) s using (subscription_id) group by 1""", digits=4)
def _(spark, d):
    t = rollups.two_hop(v.feature_usage(spark, d), v.subscriptions(spark, d), "subscription_id", "account_id")
    return t.groupBy("account_id").agg(F.count(F.lit(1)).alias("n_facts"), F.sum("usage_count").alias("total"))


@query("usage_rollup", """select account_id, round(total_events, 4) total_events, round(avg_daily_usage, 4) avg_daily_usage,
  round(total_duration_secs, 4) total_duration_secs, round(avg_duration_secs, 4) avg_duration_secs, round(total_errors, 4) total_errors,
  round(avg_errors, 4) avg_errors, active_days, strftime(last_activity_date, '%Y-%m-%d %H:%M:%S') last_activity_date,
  strftime(first_activity_date, '%Y-%m-%d %H:%M:%S') first_activity_date, unique_features_used, beta_feature_usage from usage_agg""", digits=4)
def _(spark, d):
    return as_text(rollups.usage_rollup(v.feature_usage(spark, d), "account_id", v.subscriptions(spark, d)), "last_activity_date", "first_activity_date")


@query("generic_rollup", """select l_suppkey, count(*) n_rows, round(avg(l_quantity), 4) usage_l_quantity_mean, round(sum(l_quantity), 4) usage_l_quantity_sum,
  round(stddev_samp(l_quantity), 4) usage_l_quantity_std, round(avg(l_discount), 4) usage_l_discount_mean, round(sum(l_discount), 4) usage_l_discount_sum,
  round(stddev_samp(l_discount), 4) usage_l_discount_std from lineitem group by 1""", digits=4)
def _(spark, d):
    return rollups.generic_rollup(v.table(spark, d, "lineitem").select("l_suppkey", "l_quantity", "l_discount"), "l_suppkey", count_as="n_rows")


@query("generic_means", """select account_id, count(*) ticket_count, round(avg(resolution_time_hours), 4) ticket_resolution_time_hours_mean,
  round(avg(satisfaction_score), 4) ticket_satisfaction_score_mean from support_tickets group by 1""", digits=4)
def _(spark, d):
    t = v.support_tickets(spark, d).select("account_id", "resolution_time_hours", "satisfaction_score")
    return rollups.generic_rollup(t, "account_id", ["mean"], "ticket_", count_as="ticket_count")


@query("ticket_rollup", """select account_id, ticket_count, round(avg_satisfaction, 4) avg_satisfaction, min_satisfaction, round(avg_resolution_hours, 4) avg_resolution_hours,
  escalation_count, strftime(last_ticket_date, '%Y-%m-%d %H:%M:%S') last_ticket_date from ticket_agg""", digits=4)
def _(spark, d):
    return as_text(rollups.ticket_rollup(v.support_tickets(spark, d)), "last_ticket_date").drop("avg_first_response_min")


# ---- derived features ------------------------------------------------------------------------------------------

@query("tenure_features", f"""select account_id, round(m, 6) tenure_months, case when m <= 3 then '0-3' when m <= 6 then '3-6' when m <= 12 then '6-12' when m > 12 then '12+' end tenure_bucket
  from (select account_id, greatest({days_sql(REF_SQL, 'signup_date')} / 30.4::double, 0.1::double) m from accounts)""")
def _(spark, d):
    a = v.accounts(spark, d)
    return features.tenure_features(a, "signup_date", v.ntz(v.REF)).select("account_id", "tenure_months", "tenure_bucket")


@query("signup_tenure", f"""select account_id, round({days_sql('(select max(signup_date) from accounts)', 'signup_date')} / 30.44::double, 1) tenure_months from accounts""")
def _(spark, d):
    return features.signup_tenure(v.accounts(spark, d), "signup_date").select("account_id", "tenure_months")


@query("bucketize", """select l_orderkey, l_linenumber, case when l_quantity <= 10 then 'a' when l_quantity <= 25 then 'b' when l_quantity <= 40 then 'c' end bucket from lineitem""")
def _(spark, d):
    return features.bucketize(v.table(spark, d, "lineitem"), "l_quantity", [0, 10, 25, 40], ["a", "b", "c"], "bucket").select(
        "l_orderkey", "l_linenumber", "bucket")


@query("recency_days", f"select account_id, {days_sql(REF_SQL, 'last_order')}::bigint days_since_last_activity from accounts")
def _(spark, d):
    return features.recency_days(v.accounts(spark, d), "last_order", v.ntz(v.REF)).select("account_id", "days_since_last_activity")


@query("near_renewal", f"select account_id, (coalesce(365 - {days_sql(REF_SQL, 'last_order')}, 9999) < 30)::int near_renewal from accounts")
def _(spark, d):
    left = F.lit(365) - elapsed_days(v.ntz(v.REF), "last_order")
    return features.near_renewal(v.accounts(spark, d), left).select("account_id", "near_renewal")


@query("renewal_from_cycle", f"""select subscription_id, (cycle - ({days_sql(REF_SQL, 'start_date')}::bigint % cycle) < 30)::int near_renewal
  from (select *, case when billing_frequency = 'F' then 365 else 30 end cycle from subscriptions)""")
def _(spark, d):
    return features.renewal_from_cycle(v.subscriptions(spark, d), "start_date", "billing_frequency", v.ntz(v.REF), annual_values=["f"]).select(
        "subscription_id", "near_renewal")


def usage_base(spark, d):
    """Accounts with tenure, ticket and order counts."""
    t = features.tenure_features(v.accounts(spark, d), "signup_date", v.ntz(v.REF))
    return rollups.attach(t, rollups.ticket_rollup(v.support_tickets(spark, d)))


USAGE_CTE = f"""
  usage_base as (select *, greatest({days_sql(REF_SQL, 'signup_date')} / 30.4::double, 0.1::double) tenure_months
    from accounts left join ticket_agg using (account_id))"""


@query("usage_features", """select account_id, round(n_orders / tenure_months, 6) usage_intensity,
  round(least(greatest(n_orders / (tenure_months * 30.4::double), 0), 1), 6) active_day_ratio from usage_base""", USAGE_CTE)
def _(spark, d):
    return features.usage_features(usage_base(spark, d), "n_orders", "n_orders").select("account_id", "usage_intensity", "active_day_ratio")


TREND_SQL = f"""select account_id, round(usage_last, 6) usage_last, round(usage_prev, 6) usage_prev, round((usage_last - usage_prev) / (usage_prev + 1), 6) usage_trend from trend"""
TREND_CTE = """
  trend as (select user_id account_id, coalesce(sum(1) filter (age >= 0 and age < 10), 0)::double usage_last,
    coalesce(sum(1) filter (age >= 10 and age < 20), 0)::double usage_prev
    from (select user_id, """ + days_sql("timestamp '2024-01-31'", "ts") + """ age from events) group by 1)"""


def event_trend(spark, d):
    e = v.table(spark, d, "events").select(F.col("user_id").alias("account_id"), "ts")
    return features.usage_trend(e, "account_id", "ts", v.ntz("2024-01-31"), days=10)


@query("usage_trend", TREND_SQL, TREND_CTE)
def _(spark, d):
    return event_trend(spark, d)


@query("safe_ratio", """select account_id, round(escalation_count::double / case when ticket_count is not null then greatest(ticket_count, 1) end, 6) escalation_ratio,
  round(balance / greatest(n_orders, 1), 6) balance_per_order from usage_base""", USAGE_CTE)
def _(spark, d):
    out = features.safe_ratio(usage_base(spark, d), "escalation_count", "ticket_count", "escalation_ratio")
    return features.safe_ratio(out, "balance", "n_orders", "balance_per_order").select("account_id", "escalation_ratio", "balance_per_order")


@query("weighted_flags", """select l_orderkey, l_linenumber, round((l_quantity > 10)::int * 0.1::double + (l_quantity > 20)::int * 0.15::double + (l_quantity > 30)::int * 0.25::double
  + (l_discount > 0.05)::int * 0.2::double + (l_tax > 0.04)::int * 0.3::double, 6) module_adoption_score from lineitem""")
def _(spark, d):
    q, c = F.col("l_quantity"), F.col
    li = v.table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", *[x.cast("int").alias(f"f{i}") for i, x in enumerate(
        [q > 10, q > 20, q > 30, c("l_discount") > 0.05, c("l_tax") > 0.04])])
    return features.weighted_flags(li, [f"f{i}" for i in range(5)]).select("l_orderkey", "l_linenumber", "module_adoption_score")


@query("support_rate", "select account_id, round(ticket_count / tenure_months, 6) support_ticket_rate from usage_base", USAGE_CTE)
def _(spark, d):
    return features.support_rate(usage_base(spark, d), "ticket_count").select("account_id", "support_ticket_rate")


@query("quantile_segment", """select subscription_id, case when mrr_amount <= (select quantile_cont(mrr_amount, 1/3::double) from subscriptions) then 'low'
  when mrr_amount <= (select quantile_cont(mrr_amount, 2/3::double) from subscriptions) then 'medium' else 'high' end mrr_segment from subscriptions""")
def _(spark, d):
    return features.quantile_segment(v.subscriptions(spark, d), "mrr_amount").select("subscription_id", "mrr_segment")


@query("rank_segment", """select event_id, case when rk <= 1 + (n - 1) * (1/3::double) then 'low' when rk <= 1 + (n - 1) * (2/3::double) then 'medium' else 'high' end segment
  from (select event_id, row_number() over (order by zeroed, event_id) rk, count(*) over () n from (select event_id, case when event_id % 2 = 0 then 0 else value end zeroed from events))""")
def _(spark, d):
    """Half of the values are zero: quantile edges repeat, so rows are segmented by rank."""
    e = v.table(spark, d, "events").select("event_id", F.when(F.col("event_id") % 2 == 0, 0.0).otherwise(F.col("value")).alias("zeroed"))
    return features.quantile_segment(e, "zeroed", name="segment", key="event_id").select("event_id", "segment")


@query("rank_segment_text_key", """select c_name, case when rk <= 1 + (n - 1) * (1/3::double) then 'low' when rk <= 1 + (n - 1) * (2/3::double) then 'medium' else 'high' end segment
  from (select c_name, row_number() over (order by greatest(c_acctbal, 0), c_name) rk, count(*) over () n from customer)""")
def _(spark, d):
    """Text keys break the ties of the floored balances."""
    c = v.table(spark, d, "customer").select("c_name", F.greatest("c_acctbal", F.lit(0.0)).alias("floored"))
    return features.rank_segment(c, "floored", "c_name", name="segment").select("c_name", "segment")


@query("rank_first", "select l_orderkey * 8 + l_linenumber row_key, row_number() over (order by l_quantity, l_orderkey * 8 + l_linenumber) rank from lineitem")
def _(spark, d):
    from ..operators.ordering import value_ranks
    li = v.table(spark, d, "lineitem").select((F.col("l_orderkey") * 8 + F.col("l_linenumber")).alias("row_key"), "l_quantity")
    return value_ranks(li, "l_quantity", "row_key").select("row_key", "rank")


@query("revenue_segment", """select subscription_id, case when mrr_amount / 100 <= 500 then 'SMB' when mrr_amount / 100 <= 2000 then 'Mid-Market'
  when mrr_amount / 100 <= 5000 then 'Enterprise' else 'Strategic' end revenue_segment from subscriptions""")
def _(spark, d):
    s = v.subscriptions(spark, d).select("subscription_id", (F.col("mrr_amount") / 100).alias("mrr"))
    return features.revenue_segment(s, "mrr").select("subscription_id", "revenue_segment")


@query("map_features", "select account_id, country * 12 tenure_months, (balance > 0)::int usage_intensity, 0 near_renewal from accounts")
def _(spark, d):
    """A second domain's proxies: years to months, an activity flag as usage, constant renewal flag."""
    out = features.map_features(v.accounts(spark, d), {"tenure_months": F.col("country") * 12, "usage_intensity": (F.col("balance") > 0).cast("int"),
                                                        "near_renewal": F.lit(0)})
    return out.select("account_id", "tenure_months", "usage_intensity", "near_renewal")


@query("payload_backfill", """select account_id, case when seats <= 10 then 'medium' when seats <= 30 then 'large' else 'enterprise' end company_size,
  case when tenure_months > 12 then 'annual' else 'monthly' end contract_type, round(mrr / greatest(seats, 1), 6) arpu, seats_active, active_days, total_events,
  usage_last_30d, usage_prev_30d, features_used, (a > 0.2::double)::int + (a > 0.4::double)::int + (a > 0.6::double)::int + (a > 0.8::double)::int + (a > 0.9::double)::int modules, open_tickets,
  case when tenure_months <= 3 then '0-3m' when tenure_months <= 6 then '3-6m' when tenure_months <= 12 then '6-12m' else '12+m' end tenure_bucket,
  case when mrr < 200 then 'low' when mrr < 1000 then 'medium' else 'high' end mrr_segment,
  round(total_events / greatest(active_days, 1)::double, 6) usage_intensity, round(least(active_days / greatest(tenure_months * 30.4::double, 1), 1), 6) active_day_ratio,
  round((usage_last_30d - usage_prev_30d) / greatest(usage_prev_30d, 1)::double, 6) usage_trend_30d, round(seats_active / greatest(seats, 1)::double, 6) seat_utilization,
  round(support_tickets_count / greatest(tenure_months, 1), 6) support_ticket_rate, round(open_tickets / greatest(support_tickets_count, 1)::double, 6) unresolved_ticket_ratio
  from (select *, greatest(trunc(active_days * 8 * a), 1)::bigint total_events from (
    select *, seats_purchased seats, feature_adoption_rate a, greatest(trunc(seats_purchased * least(feature_adoption_rate + 0.3::double, 1)), 1)::bigint seats_active,
      greatest(trunc(tenure_months * 22 * least(feature_adoption_rate + 0.2::double, 1)), 1)::bigint active_days,
      greatest(trunc(feature_adoption_rate * 200), 1)::bigint usage_last_30d, greatest(trunc(feature_adoption_rate * 180), 1)::bigint usage_prev_30d,
      greatest(trunc(feature_adoption_rate * 20), 1)::bigint features_used, trunc(support_tickets_count * 0.3::double)::bigint open_tickets from payload))""", PAYLOAD_CTE)
def _(spark, d):
    out = features.payload_backfill(_payload(spark, d))
    modules = sum((F.col(f"module_{i}_active") for i in range(2, 6)), F.col("module_1_active"))
    return out.select("account_id", "company_size", "contract_type", "arpu", "seats_active", "active_days", "total_events", "usage_last_30d", "usage_prev_30d",
                      "features_used", modules.alias("modules"), "open_tickets", "tenure_bucket", "mrr_segment", "usage_intensity", "active_day_ratio",
                      "usage_trend_30d", "seat_utilization", "support_ticket_rate", "unresolved_ticket_ratio")


@query("risk_tier", """select account_id, case when p <= 0.25 then 'Low' when p <= 0.5 then 'Medium' when p <= 0.75 then 'High' else 'Critical' end risk_tier,
  case when p >= 0.7::double then 'HIGH' when p >= 0.4::double then 'MEDIUM' else 'LOW' end audit_tier, (p >= 0.5)::int prediction from scored""")
def _(spark, d):
    s = features.decide(features.risk_tier(v.scored(spark, d), "p"), "p")
    return s.select("account_id", "risk_tier", features.audit_tier("p").alias("audit_tier"), "prediction")


@query("tier_actions", """select account_id, case when p <= 0.25 then 'none' when p <= 0.5 then 'monitor' when p <= 0.75 then 'outreach within 1 week' else 'escalate' end action from scored""")
def _(spark, d):
    return features.tier_actions(features.risk_tier(v.scored(spark, d), "p")).select("account_id", "action")


@query("clean_feature_names", """select distinct 'cat__' || p_brand raw_name, p_brand as label, case when p_brand = 'Brand#11' then 'first brand' else 'No description on file' end description from part""")
def _(spark, d):
    names = v.table(spark, d, "part").select(F.concat(F.lit("cat__"), F.col("p_brand")).alias("raw_name")).distinct()
    return features.clean_feature_names(names, "raw_name", {"Brand#11": "first brand"})


@query("account_age", f"""select account_id, age account_age_days, {days_sql(REF_SQL, 'last_order')}::bigint subscription_tenure_days, (age < 30)::int is_new_account,
  case when age < 30 then '<30' when age <= 90 then '30-90' when age > 90 then '>90' end cohort, (age >= 14)::int observable
  from (select *, {days_sql(REF_SQL, 'signup_date')}::bigint age from accounts)""")
def _(spark, d):
    return features.account_age(v.accounts(spark, d), "signup_date", "last_order", v.ntz(v.REF)).select(
        "account_id", "account_age_days", "subscription_tenure_days", "is_new_account", "cohort", "observable")


@query("engagement", """select l_suppkey, round(mq + md, 4) engagement_score, round((sq + sd) / 2, 4) usage_variability,
  (mq + md < (select quantile_cont(mq + md, 0.25) from eng))::int is_low_usage from eng""", """
  eng as (select l_suppkey, avg(l_quantity) mq, avg(l_discount) md, stddev_samp(l_quantity) sq, stddev_samp(l_discount) sd from lineitem group by 1)""", digits=4)
def _(spark, d):
    r = rollups.generic_rollup(v.table(spark, d, "lineitem").select("l_suppkey", "l_quantity", "l_discount"), "l_suppkey", ["mean", "std"])
    return features.engagement(r, ["usage_l_quantity_mean", "usage_l_discount_mean"], ["usage_l_quantity_std", "usage_l_discount_std"]).select(
        "l_suppkey", "engagement_score", "usage_variability", "is_low_usage")


@query("support_flags", """select account_id, coalesce(ticket_count > 0, false)::int has_support_tickets,
  coalesce(ticket_count > (select median(ticket_count) from usage_base), false)::int is_high_ticket_volume,
  coalesce(avg_satisfaction < (select quantile_cont(avg_satisfaction, 0.25) from usage_base), false)::int is_low_satisfaction from usage_base""", USAGE_CTE)
def _(spark, d):
    return features.support_flags(usage_base(spark, d)).select("account_id", "has_support_tickets", "is_high_ticket_volume", "is_low_satisfaction")


@query("value_flags", """select subscription_id, case when mrr_amount <= q[1] then 'low' when mrr_amount <= q[2] then 'mid' when mrr_amount <= q[3] then 'high' else 'enterprise' end revenue_band,
  (mrr_amount > q[3])::int is_high_value from subscriptions, (select quantile_cont(mrr_amount, [0.25, 0.5, 0.75]) q from subscriptions)""")
def _(spark, d):
    return features.value_flags(v.subscriptions(spark, d), "mrr_amount").select("subscription_id", "revenue_band", "is_high_value")


@query("relative_usage", "select account_id, round(n_orders / avg(n_orders) over (partition by industry), 6) relative_usage from accounts")
def _(spark, d):
    return features.relative_usage(v.accounts(spark, d), "n_orders", "industry").select("account_id", "relative_usage")


@query("interactions", """select account_id, round(n_orders * tenure_months, 4) usage_x_tenure, round(ticket_count * avg_satisfaction, 4) tickets_x_satisfaction,
  round(n_orders / nullif(ticket_count, 0), 4) orders_per_ticket from usage_base""", USAGE_CTE, digits=4)
def _(spark, d):
    out = features.interactions(usage_base(spark, d), {"usage_x_tenure": ("n_orders", "tenure_months"), "tickets_x_satisfaction": ("ticket_count", "avg_satisfaction")},
                                {"orders_per_ticket": ("n_orders", "ticket_count")})
    return out.select("account_id", "usage_x_tenure", "tickets_x_satisfaction", "orders_per_ticket")


ALERT_CTE = f"""
  alert_base as (select u.*, {days_sql(REF_SQL, 'last_order')} days_since_last_activity,
    (t.usage_last - t.usage_prev) / (t.usage_prev + 1) usage_trend from usage_base u left join trend t using (account_id))"""


@query("alert_rules", """select account_id, 'usage_drop' alert from alert_base where usage_trend < -0.3
  union all select account_id, 'inactive' from alert_base where days_since_last_activity > 14
  union all select account_id, 'short_tenure' from alert_base where tenure_months <= 3
  union all select account_id, 'low_satisfaction' from alert_base where avg_satisfaction < 3
  union all select account_id, 'low_adoption' from alert_base where n_orders < 3
  union all select account_id, 'near_renewal' from alert_base where 365 - days_since_last_activity < 30""", USAGE_CTE, TREND_CTE, ALERT_CTE)
def _(spark, d):
    base = features.recency_days(usage_base(spark, d), "last_order", v.ntz(v.REF)).withColumn("unique_features_used", F.col("n_orders"))
    base = rollups.attach(base, event_trend(spark, d)).withColumn("days_to_renewal", 365 - F.col("days_since_last_activity"))
    return features.alert_rules(base, "account_id")


@query("heuristic_baseline", """select account_id, coalesce(usage_last > 3 and -(usage_last - usage_prev) / (usage_prev + 1) > 0.5::double, false)::int prediction from trend""", TREND_CTE)
def _(spark, d):
    t = event_trend(spark, d).withColumn("drop", -F.col("usage_trend"))
    return features.heuristic_baseline(t, "usage_last", "drop").select("account_id", "prediction")


@query("monthly_trend", """select strftime(m, '%Y-%m') as month, coalesce(signups, 0) signups, coalesce(active_accounts, 0) active_accounts, round(label_rate, 6) label_rate from (
  select date_trunc('month', signup_date) m, count(*) signups, avg(churn_flag) label_rate from accounts where signup_date is not null group by 1) full join
  (select date_trunc('month', start_date) m, count(distinct account_id) active_accounts from subscriptions group by 1) using (m)""")
def _(spark, d):
    return features.monthly_trend(v.accounts(spark, d), v.subscriptions(spark, d), "account_id", "signup_date", "churn_flag", "start_date").withColumn(
        "month", F.date_format("month", "yyyy-MM"))


VIF_COLS = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]


def _determinant(cols):
    """The determinant of the correlation matrix of some columns, written out by its first row; the correlations are columns of ``corrs``."""
    def expand(rows, at):
        if not rows:
            return "1::double"
        first, rest = rows[0], rows[1:]
        terms = []
        for j, c in enumerate(at):
            r = "1::double" if c == first else f"r_{min(VIF_COLS.index(first), VIF_COLS.index(c))}{max(VIF_COLS.index(first), VIF_COLS.index(c))}"
            terms.append(f"{'-' if j % 2 else '+'} {r} * ({expand(rest, at[:j] + at[j + 1:])})")
        return " ".join(terms)

    return expand(list(cols), list(cols))


@query("vif", " union all ".join(f"select '{c}' feature, round(({_determinant([x for x in VIF_COLS if x != c])}) / ({_determinant(VIF_COLS)}), 6) vif from corrs" for c in VIF_COLS),
       "\n  corrs as (select " + ", ".join(f"corr({a}, {b}) r_{i}{j}" for i, a in enumerate(VIF_COLS) for j, b in enumerate(VIF_COLS) if i < j) + " from lineitem)")
def _(spark, d):
    """In SQL by determinants: that of the other features' correlations over that of all."""
    return vif(v.table(spark, d, "lineitem"), VIF_COLS)


FLAT_COLS = """account_id, timestamp '2001-09-01' reference_date, signup_date subscription_start_date, last_order last_activity_date, n_orders * 9 total_events,
      n_orders active_days, n_orders % 5 usage_last_30d, n_orders % 3 usage_prev_30d, country seats_purchased, country // 2 seats_active, 20 features_available,
      n_orders % 20 features_used, account_id % 9 total_tickets, account_id % 4 open_tickets, balance mrr, account_id % 90 - 10 contract_renewal_days,
      (account_id % 2)::int m1, (account_id % 3 = 0)::int m2, (account_id % 5 = 0)::int m3"""


@query("engineer_features", f"""select account_id, round(tm, 6) tenure_months, case when tm <= 3 then '0-3' when tm <= 6 then '3-6' when tm <= 12 then '6-12' else '12+' end tenure_bucket,
  {days_sql('reference_date', 'last_activity_date')}::bigint days_since_last_activity, (contract_renewal_days < 30)::int near_renewal, round(total_events / tm, 6) usage_intensity,
  round(least(greatest(active_days / (tm * 30.4::double), 0), 1), 6) active_day_ratio, round((usage_last_30d - usage_prev_30d) / (usage_prev_30d + 1.0::double), 6) usage_trend_30d,
  round(seats_active / greatest(seats_purchased, 1)::double, 6) seat_utilization, round(features_used / 20::double, 6) feature_adoption_rate,
  round(m1 * 0.1::double + m2 * 0.15::double + m3 * 0.25::double, 6) module_adoption_score, round(total_tickets / tm, 6) support_ticket_rate,
  round(open_tickets / greatest(total_tickets, 1)::double, 6) unresolved_ticket_ratio, round(mrr / greatest(seats_purchased, 1), 6) revenue_per_seat,
  case when mrr <= q[1] then 'low' when mrr <= q[2] then 'medium' else 'high' end mrr_segment from flat, (select quantile_cont(mrr, [1/3::double, 2/3::double]) q from flat)""", f"""
  flat as (select {FLAT_COLS}, greatest({days_sql("timestamp '2001-09-01'", "signup_date")} / 30.4::double, 0.1::double) tm from accounts)""")
def _(spark, d):
    """The whole feature set of a flat customer table from its role mapping."""
    k, n = F.col("account_id"), F.col("n_orders")
    flat = v.accounts(spark, d).select(
        "account_id", v.ntz(v.REF).alias("reference_date"), F.col("signup_date").alias("subscription_start_date"), F.col("last_order").alias("last_activity_date"),
        (n * 9).alias("total_events"), n.alias("active_days"), (n % 5).alias("usage_last_30d"), (n % 3).alias("usage_prev_30d"), F.col("country").alias("seats_purchased"),
        F.floor(F.col("country") / 2).alias("seats_active"), F.lit(20).alias("features_available"), (n % 20).alias("features_used"), (k % 9).alias("total_tickets"),
        (k % 4).alias("open_tickets"), F.col("balance").alias("mrr"), (k % 90 - 10).alias("contract_renewal_days"), (k % 2).alias("module_1_active"),
        (k % 3 == 0).cast("int").alias("module_2_active"), (k % 5 == 0).cast("int").alias("module_3_active"), F.lit(0).alias("module_4_active"), F.lit(0).alias("module_5_active"))
    raw = set(flat.columns) - {"account_id"}
    return churn.engineer_features(flat).drop(*raw)


@query("engineer_bank", """select account_id, country * 12 tenure_months, active usage_intensity, 0 near_renewal, case when rk <= 1 + (n - 1) * (1/3::double) then 'low'
  when rk <= 1 + (n - 1) * (2/3::double) then 'medium' else 'high' end mrr_segment from (select *, row_number() over (order by money, account_id) rk, count(*) over () n from (
    select account_id, country, (n_orders > 9)::int active, case when account_id % 2 = 0 then 0 else abs(balance) end money from accounts))""")
def _(spark, d):
    """The second domain, with half of the balances at zero."""
    a = v.accounts(spark, d).select("account_id", F.col("country").alias("Tenure"), (F.col("n_orders") > 9).cast("int").alias("IsActiveMember"),
                                    F.when(F.col("account_id") % 2 == 0, 0.0).otherwise(F.abs("balance")).alias("Balance"))
    return churn.engineer_bank(a, "account_id").select("account_id", "tenure_months", "usage_intensity", "near_renewal", "mrr_segment")


@query("abt_features", f"""select account_id, round(tm, 6) tenure_months, case when tm <= 3 then '0-3m' when tm <= 6 then '3-6m' when tm <= 12 then '6-12m' else '12+m' end tenure_bucket,
  round(total_events / tm, 4) usage_intensity, round(least(active_days / (tm * 30.4::double), 1), 6) active_day_ratio, {days_sql('ref', 'last_activity_date')}::bigint days_since_last_activity,
  (cycle - ({days_sql('ref', 'start_date')}::bigint % cycle) < 30)::int near_renewal, case when mrr_amount <= q[1] then 'low' when mrr_amount <= q[2] then 'medium' else 'high' end mrr_segment
  from abt, (select quantile_cont(mrr_amount, [1/3::double, 2/3::double]) q from abt)""", f"""
  ref as (select greatest((select max(last_activity_date) from usage_agg), (select max(o_orderdate) from orders)) ref),
  abt as (select *, greatest({days_sql('ref', 'signup_date')} / 30.4::double, 0.1::double) tm, case when billing_frequency = 'F' then 365 else 30 end cycle
    from accounts left join latest_sub using (account_id) left join usage_agg using (account_id), ref)""")
def _(spark, d):
    """Features derived from the staged base table, for every account; without a subscription or usage they are missing."""
    out = churn.abt_features(staged(build(spark, d)), annual_values=["f"])
    return out.select("account_id", "tenure_months", "tenure_bucket", F.round("usage_intensity", 4).alias("usage_intensity"), "active_day_ratio", "days_since_last_activity", "near_renewal", "mrr_segment")


# ---- encodings -------------------------------------------------------------------------------------------------

@query("label_encode_fit", """select 'p_brand' feature, p_brand as value, (row_number() over (order by p_brand) - 1) code from (select distinct p_brand from part)
  union all select 'p_type', p_type, row_number() over (order by p_type) - 1 from (select distinct p_type from part)""")
def _(spark, d):
    return encode.label_encode_fit(v.table(spark, d, "part"), ["p_brand", "p_type"])


@query("label_encode_apply", "select p_partkey, dense_rank() over (order by p_brand) - 1 p_brand_code from part")
def _(spark, d):
    p = v.table(spark, d, "part").select("p_partkey", "p_brand")
    return encode.label_encode_apply(p, encode.label_encode_fit(p, ["p_brand"]), ["p_brand"]).select("p_partkey", "p_brand_code")


@query("one_hot", """select l_orderkey, l_linenumber, (l_returnflag = 'A')::int "l_returnflag_A", (l_returnflag = 'N')::int "l_returnflag_N", (l_returnflag = 'R')::int "l_returnflag_R" from lineitem""")
def _(spark, d):
    return encode.one_hot(v.table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_returnflag"), ["l_returnflag"])


@query("one_hot_slots", """select l_orderkey, l_linenumber, f.slot || ',' || s.slot slots from lineitem
    join levels f on f.feature = 'l_returnflag' and f.value = l_returnflag join levels s on s.feature = 'l_linestatus' and s.value = l_linestatus""", """
  levels as (
    select 'l_returnflag' feature, l_returnflag as value, row_number() over (order by l_returnflag) - 1 slot from lineitem group by l_returnflag
    union all select 'l_linestatus', l_linestatus, (select count(distinct l_returnflag) from lineitem) + row_number() over (order by l_linestatus) - 1 from lineitem group by l_linestatus)""")
def _(spark, d):
    rows = v.table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_returnflag", "l_linestatus")
    return encode.one_hot_slots(rows, ["l_returnflag", "l_linestatus"]).select("l_orderkey", "l_linenumber", F.concat_ws(",", F.col("slots").cast("array<string>")).alias("slots"))


@query("standardize", """select account_id, round((balance - m) / s, 6) balance from split3, (select avg(balance) m, stddev_pop(balance) s from split3 where split = 'train')""", SPLIT_CTE)
def _(spark, d):
    """Fitted on the training split, applied to all rows."""
    s = three_way(spark, d)
    fit = encode.standardize_fit(s.where(F.col("split") == "train"), ["balance"])
    return encode.standardize_apply(s, fit).select("account_id", "balance")


@query("column_transform", """select account_id, round((balance - m) / s, 6) balance, (industry = 'AUTOMOBILE')::int::double "industry_AUTOMOBILE", (industry = 'BUILDING')::int::double "industry_BUILDING",
  (industry = 'FURNITURE')::int::double "industry_FURNITURE", (industry = 'HOUSEHOLD')::int::double "industry_HOUSEHOLD", (industry = 'MACHINERY')::int::double "industry_MACHINERY", (n_orders > 9)::int::double busy
  from accounts, (select avg(balance) m, stddev_pop(balance) s from accounts)""")
def _(spark, d):
    a = v.accounts(spark, d).withColumn("busy", (F.col("n_orders") > 9).cast("int"))
    return encode.column_transform(a, ["balance"], ["industry"], ["busy"], keep=["account_id"])


@query("encode_by_cardinality", """select p_partkey, dense_rank() over (order by p_brand) - 1 p_brand_code, (p_type = 'ECONOMY')::int "p_type_ECONOMY", (p_type = 'LARGE')::int "p_type_LARGE",
  (p_type = 'MEDIUM')::int "p_type_MEDIUM", (p_type = 'PROMO')::int "p_type_PROMO", (p_type = 'SMALL')::int "p_type_SMALL", (p_type = 'STANDARD')::int "p_type_STANDARD" from part""")
def _(spark, d):
    """Six types become 0/1 columns, 25 brands become codes."""
    return encode.encode_by_cardinality(v.table(spark, d, "part").select("p_partkey", "p_type", "p_brand"), ["p_type", "p_brand"])


@query("encode_protected", "select account_id, industry, case when industry like '%BUILD%' or industry like '%HOUSE%' then 0 else 1 end grp from accounts")
def _(spark, d):
    return v.accounts(spark, d).select("account_id", "industry", encode.encode_protected("industry", "BUILD|HOUSE").alias("grp"))
