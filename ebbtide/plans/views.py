"""Subscription-churn roles mapped onto the driver's tables, as DataFrames and as SQL.

usage -> subscription -> account exists as lineitem -> orders -> customer; tickets are events.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import dbl
from ..operators.encode import encode_protected

REF = "2001-09-01"
CUT = "1998-07-01"


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def ntz(text: str):
    return F.lit(text).cast("timestamp_ntz")


def accounts(spark: SparkSession, d: str) -> DataFrame:
    """Orders are reduced to one row per customer before the join."""
    per = table(spark, d, "orders").groupBy("o_custkey").agg(
        F.min("o_orderdate").alias("signup_date"), F.max("o_orderdate").alias("last_order"),
        F.count(F.lit(1)).alias("n_orders"), F.avg("o_totalprice").alias("__avg"), F.max("o_totalprice").alias("max_spend"))
    c = table(spark, d, "customer")
    churned = F.coalesce("last_order", ntz("1900-01-01")) < ntz("2000-10-01")
    return c.join(per, c.c_custkey == per.o_custkey, "left").select(
        F.col("c_custkey").alias("account_id"), F.col("c_name").alias("account_name"), F.col("c_mktsegment").alias("industry"),
        F.col("c_nationkey").alias("country"), F.col("c_acctbal").alias("balance"), churned.cast("int").alias("churn_flag"),
        "signup_date", "last_order", F.coalesce("n_orders", F.lit(0)).alias("n_orders"), F.col("__avg").alias("avg_spend"), "max_spend")


def subscriptions(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "orders").select(
        F.col("o_orderkey").alias("subscription_id"), F.col("o_custkey").alias("account_id"), F.col("o_orderdate").alias("start_date"),
        F.col("o_totalprice").alias("mrr_amount"), F.col("o_orderpriority").alias("plan_tier"), F.col("o_orderstatus").alias("billing_frequency"))


def feature_usage(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "lineitem").select(
        F.col("l_orderkey").alias("subscription_id"), F.col("l_shipdate").alias("usage_date"), F.col("l_partkey").alias("feature_name"),
        F.col("l_quantity").alias("usage_count"), F.col("l_extendedprice").alias("usage_duration_secs"),
        F.round(F.col("l_discount") * 100).alias("error_count"), (F.col("l_returnflag") == "R").cast("int").alias("is_beta_feature"))


def support_tickets(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "events").select(
        F.col("event_id").alias("ticket_id"), F.col("user_id").alias("account_id"), F.col("ts").alias("submitted_at"),
        F.col("value").alias("resolution_time_hours"), F.col("event_type").alias("priority"),
        (F.lit(1) + F.col("event_id") % 5).cast("double").alias("satisfaction_score"),
        (F.col("event_type") == "error").cast("int").alias("escalation_flag"))


def score_expr(multiplier: int = 7919):
    return F.lit(0.3) * F.col("churn_flag") + F.lit(0.7) * ((F.col("account_id") * multiplier) % 1000) / F.lit(1000.0)


def scored(spark: SparkSession, d: str) -> DataFrame:
    """A deterministic score with ties, its prediction, and the protected group (0 for BUILD or HOUSE industries)."""
    return accounts(spark, d).select(
        "account_id", "industry", F.col("churn_flag").alias("y"), score_expr().alias("p")).withColumns({
            "yhat": (F.col("p") >= 0.5).cast("int"), "grp": encode_protected("industry", "BUILD|HOUSE")})


def scored_models(spark: SparkSession, d: str) -> DataFrame:
    """Two models over the same accounts in long form; one scan, no union."""
    models = F.array(F.struct(F.lit("model_a").alias("model"), score_expr(7919).alias("p")),
                     F.struct(F.lit("model_b").alias("model"), score_expr(104729).alias("p")))
    return accounts(spark, d).select("account_id", F.col("churn_flag").alias("y"), F.explode(models).alias("m")).select(
        "account_id", "y", "m.*").withColumn("yhat", (F.col("p") >= 0.5).cast("int"))


def holey(spark: SparkSession, d: str) -> DataFrame:
    """Line items with missing values: 6 % of the tax, a third of the flags."""
    return table(spark, d, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_quantity", "l_extendedprice",
        F.when(F.col("l_tax") != 0, F.col("l_tax")).alias("tax"), F.when(F.col("l_returnflag") != "A", F.col("l_returnflag")).alias("flag"),
        "l_linestatus")


def price_halves(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    """Baseline and current half of the line items; in the current half one column is distorted."""
    li = table(spark, d, "lineitem").select("l_shipdate", "l_extendedprice", "l_quantity", "l_discount")
    cut = ntz(CUT)
    price = dbl("l_extendedprice")

    def shape(df: DataFrame, warped) -> DataFrame:
        return df.select(price.alias("price"), F.col("l_quantity").alias("quantity"), F.col("l_discount").alias("discount"), warped.alias("warped"))

    return (shape(li.where(F.col("l_shipdate") < cut), price),
            shape(li.where(F.col("l_shipdate") >= cut), price * price / F.lit(105000.0)))


# The same views in SQL, to be put in front of a query.
CTES = {
    "accounts": """
  accounts as (select c_custkey account_id, c_name account_name, c_mktsegment industry, c_nationkey country, c_acctbal balance,
      (coalesce(max(o_orderdate), timestamp '1900-01-01') < timestamp '2000-10-01')::int churn_flag,
      min(o_orderdate) signup_date, max(o_orderdate) last_order, count(o_orderkey) n_orders,
      avg(o_totalprice) avg_spend, max(o_totalprice) max_spend
    from customer left join orders on c_custkey = o_custkey group by all)""",
    "subscriptions": """
  subscriptions as (select o_orderkey subscription_id, o_custkey account_id, o_orderdate start_date, o_totalprice mrr_amount,
      o_orderpriority plan_tier, o_orderstatus billing_frequency from orders)""",
    "feature_usage": """
  feature_usage as (select l_orderkey subscription_id, l_shipdate usage_date, l_partkey feature_name, l_quantity usage_count,
      l_extendedprice usage_duration_secs, round(l_discount * 100) error_count, (l_returnflag = 'R')::int is_beta_feature from lineitem)""",
    "support_tickets": """
  support_tickets as (select event_id ticket_id, user_id account_id, ts submitted_at, value resolution_time_hours, event_type priority,
      (1 + event_id % 5)::double satisfaction_score, (event_type = 'error')::int escalation_flag from events)""",
    "latest_sub": """
  latest_sub as (select * exclude (rn) from (select *, row_number() over (partition by account_id
      order by start_date desc nulls last, subscription_id desc) rn from subscriptions) where rn = 1)""",
    "usage_agg": """
  usage_agg as (select s.account_id, sum(usage_count) total_events, avg(usage_count) avg_daily_usage,
      sum(usage_duration_secs) total_duration_secs, avg(usage_duration_secs) avg_duration_secs, sum(error_count) total_errors,
      avg(error_count) avg_errors, count(distinct usage_date) active_days, max(usage_date) last_activity_date,
      min(usage_date) first_activity_date, count(distinct feature_name) unique_features_used, sum(is_beta_feature)::bigint beta_feature_usage
    from feature_usage u join (select distinct subscription_id, account_id from subscriptions) s using (subscription_id)
    where s.account_id is not null group by 1)""",
    "ticket_agg": """
  ticket_agg as (select account_id, count(ticket_id) ticket_count, avg(satisfaction_score) avg_satisfaction,
      min(satisfaction_score) min_satisfaction, avg(resolution_time_hours) avg_resolution_hours,
      sum(escalation_flag)::bigint escalation_count, max(submitted_at) last_ticket_date
    from support_tickets where account_id is not null group by 1)""",
    "scored0": """
  scored0 as (select account_id, industry, churn_flag y,
      0.3::double * churn_flag + 0.7::double * ((account_id * 7919) % 1000) / 1000::double p from accounts)""",
    "scored": """
  scored as (select *, (p >= 0.5)::int yhat,
      case when industry like '%BUILD%' or industry like '%HOUSE%' then 0 else 1 end grp from scored0)""",
    "scored_models": """
  scored_models as (select *, (p >= 0.5)::int yhat from (
      select account_id, churn_flag y, 'model_a' model,
        0.3::double * churn_flag + 0.7::double * ((account_id * 7919) % 1000) / 1000::double p from accounts
      union all select account_id, churn_flag y, 'model_b' model,
        0.3::double * churn_flag + 0.7::double * ((account_id * 104729) % 1000) / 1000::double p from accounts))""",
    "holey": """
  holey as (select l_orderkey, l_linenumber, l_quantity, l_extendedprice, nullif(l_tax, 0) tax, nullif(l_returnflag, 'A') flag,
      l_linestatus from lineitem)""",
    "halves": """
  base_half as (select l_extendedprice price, l_quantity quantity, l_discount discount, l_extendedprice warped
      from lineitem where l_shipdate < timestamp '1998-07-01'),
  cur_half as (select l_extendedprice price, l_quantity quantity, l_discount discount,
      l_extendedprice * l_extendedprice / 105000::double warped from lineitem where l_shipdate >= timestamp '1998-07-01')""",
}


def with_views(body: str, *extra: str) -> str:
    """The query with the view definitions it can see; DuckDB evaluates only those it uses."""
    return "with" + ",".join([*CTES.values(), *extra]) + "\n" + body.strip()
