"""Registered queries: sources and sinks, quality checks, cleaning."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from ..operators import clean, quality, sampling
from ..session import shared_dir
from ..sources import tables as io
from . import views as v
from .registry import as_text, query


def scratch(spark, name: str) -> str:
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"


# ---- sources and sinks -----------------------------------------------------------------------------------------

@query("read_table", "select * from orders_txt", """
  orders_txt as (select o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderpriority from orders)""")
def _(spark, d):
    """CSV sink and scan with a declared schema."""
    src = v.table(spark, d, "orders").select("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderpriority")
    return io.read_table(spark, io.write_table(src, scratch(spark, "orders"), "csv"), src.schema)


@query("read_table_set", """select 'customer' table_name, count(*) n_rows, count(distinct c_custkey) n_keys from customer
  union all select 'orders', count(*), count(distinct o_orderkey) from orders
  union all select 'events', count(*), count(distinct event_id) from events""")
def _(spark, d):
    keys = {"customer": "c_custkey", "orders": "o_orderkey", "events": "event_id"}
    tables = io.read_table_set(spark, d, {n: v.table(spark, d, n).schema for n in keys}, "parquet")
    out = None
    for n, k in keys.items():
        part = tables[n].agg(F.lit(n).alias("table_name"), F.count(F.lit(1)).alias("n_rows"), F.count_distinct(k).alias("n_keys"))
        out = part if out is None else out.unionByName(part)
    return out


def _audit(spark, d):
    """Audit rows derived from the events: customer, score, nested protected attributes, tier."""
    from ..operators.features import audit_tier
    e = v.table(spark, d, "events")
    p = (F.col("event_id") * 7919 % 1000) / F.lit(1000.0)
    return e.select(F.col("ts").alias("ts"), F.col("user_id").alias("customer"), p.alias("probability"),
                    F.when(F.col("user_id") % 3 == 0, "50+").otherwise("18-49").alias("age_group"),
                    F.when(F.col("user_id") % 2 == 0, "APAC").otherwise("EU").alias("region")).withColumn("risk_tier", audit_tier("probability"))


AUDIT_CTE = """
  audit as (select ts, user_id customer, ((event_id * 7919) % 1000) / 1000::double probability,
      case when user_id % 3 = 0 then '50+' else '18-49' end age_group, case when user_id % 2 = 0 then 'APAC' else 'EU' end region,
      case when ((event_id * 7919) % 1000) / 1000::double >= 0.7::double then 'HIGH'
           when ((event_id * 7919) % 1000) / 1000::double >= 0.4::double then 'MEDIUM' else 'LOW' end risk_tier from events)"""


def audit_table(spark, d):
    return io.audit_rows(_audit(spark, d), "customer", "probability", ["age_group", "region"], timestamp=F.col("ts"))


@query("read_audit_log", """select customer::varchar customer_id, probability, age_group, region, risk_tier,
  strftime(ts, '%Y-%m-%d %H:%M:%S') at_time from audit""", AUDIT_CTE)
def _(spark, d):
    """Append-only JSON lines written, a broken copy of every line added, read back without the broken ones."""
    path = scratch(spark, "audit")
    rows = audit_table(spark, d)
    io.append_audit(rows, path)
    rows.select(F.concat(F.lit('{"timestamp": '), F.to_json(F.struct("*"))).alias("value")).write.mode("append").text(path)
    back = io.read_audit_log(spark, path)
    return back.select("customer_id", "probability", "protected_attributes.age_group", "protected_attributes.region", "risk_tier",
                       F.date_format("timestamp", "yyyy-MM-dd HH:mm:ss").alias("at_time"))


@query("write_split", """select split, count(*) n_rows, sum(churn_flag)::bigint n_positive from (
  select *, case when rk <= ceil(n::double * 0.2::double) then 'test'
    when rk <= ceil(n::double * 0.2::double) + ceil((n - ceil(n::double * 0.2::double))::double * 0.15::double) then 'val' else 'train' end split
  from (select *, row_number() over (partition by churn_flag order by md5(account_id || ':42'), account_id) rk,
    count(*) over (partition by churn_flag) n from accounts)) group by 1""")
def _(spark, d):
    """Splits stored as partitions and read back."""
    s = sampling.stratified_split(v.accounts(spark, d), "account_id", "churn_flag", 0.2, 0.15)
    path = io.write_table(s, scratch(spark, "splits"), "parquet", partition_by=["split"])
    return spark.read.parquet(path).groupBy("split").agg(F.count(F.lit(1)).alias("n_rows"), F.sum(F.col("churn_flag").cast("long")).alias("n_positive"))


@query("file_fingerprint")
def _(spark, d):
    """Size, rows and content hash of the raw files, appended to a version log."""
    log = io.append_version_log(spark, {n: f"{d}/{n}.parquet" for n in ("customer", "orders", "lineitem", "events")}, scratch(spark, "versions"))
    return log.select("table_name", "file", "size_bytes", "n_rows", "content_hash")


@query("version_log", " union all ".join(f"select '{t}' table_name, count(*) n_rows, 2 n_entries, true same_content from {t}" for t in ("customer", "orders", "lineitem", "events")))
def _(spark, d):
    """Two versions of the same files: rows of each table, log entries, and whether the content was found unchanged."""
    log, sources = scratch(spark, "versions"), {n: f"{d}/{n}.parquet" for n in ("customer", "orders", "lineitem", "events")}
    io.append_version_log(spark, sources, log)
    both = io.append_version_log(spark, sources, log)
    # A table may have several files: each is an entry of its own.
    files = both.groupBy("table_name", "file").agg(F.max("n_rows").alias("n_rows"), F.count(F.lit(1)).alias("n_entries"), (F.count_distinct("content_hash") == 1).alias("same"))
    return files.groupBy("table_name").agg(F.sum("n_rows").alias("n_rows"), F.max("n_entries").alias("n_entries"), F.every("same").alias("same_content"))


@query("load_baseline", "select count(*) n_rows, count(distinct o_custkey) n_keys from orders")
def _(spark, d):
    """Missing baseline: the first existing fallback is snapshotted and used."""
    b = io.load_baseline(spark, scratch(spark, "baseline"), [f"{d}/no_such_table.parquet", f"{d}/orders.parquet"])
    return b.agg(F.count(F.lit(1)).alias("n_rows"), F.count_distinct("o_custkey").alias("n_keys"))


# ---- quality ---------------------------------------------------------------------------------------------------

@query("check_types", """select 'props' column_name, 'numeric' check_kind, count(*) filter (props is not null and try_cast(props as double) is null) violations,
    count(*) filter (props is not null and try_cast(props as double) is null) = 0 passed from events
  union all select 'value', 'numeric', 0, true
  union all select 'user_id', 'binary_int', count(*) filter (user_id not in (0, 1)), count(*) filter (user_id not in (0, 1)) = 0 from events
  union all select 'event_type', 'date_parseable', count(event_type), count(event_type) = 0 from events
  union all select 'ts', 'date_parseable', 0, true""")
def _(spark, d):
    return quality.check_types(v.table(spark, d, "events"), {
        "props": "numeric", "value": "numeric", "user_id": "binary_int", "event_type": "date_parseable", "ts": "date_parseable"})


@query("key_profile", """select count(*) n_rows, count(distinct o_custkey) n_distinct, count(*) filter (o_custkey is null) n_null,
  count(o_custkey) - count(distinct o_custkey) n_duplicate from orders""")
def _(spark, d):
    return quality.key_profile(v.table(spark, d, "orders"), "o_custkey")


@query("null_summary", """select count(*) n_rows, 7 n_columns, (count(*) filter (tax is null) + count(*) filter (flag is null)) null_cells,
  round(100.0::double * (count(*) filter (tax is null) + count(*) filter (flag is null)) / (count(*) * 7), 6) null_pct,
  5 numeric_columns, 2 string_columns from holey""")
def _(spark, d):
    return quality.null_summary(v.holey(spark, d))


@query("type_histogram", """select dtype, count(*) n_columns from (select unnest([
  typeof(l_orderkey), typeof(l_partkey), typeof(l_suppkey), typeof(l_linenumber), typeof(l_quantity), typeof(l_extendedprice), typeof(l_discount), typeof(l_tax),
  typeof(l_returnflag), typeof(l_linestatus), typeof(l_shipdate)]) t from lineitem limit 11) join (values ('BIGINT', 'bigint'), ('INTEGER', 'int'), ('DOUBLE', 'double'),
  ('VARCHAR', 'string'), ('TIMESTAMP', 'timestamp_ntz'), ('DATE', 'date')) k(t, dtype) using (t) group by 1""")
def _(spark, d):
    return quality.type_histogram(v.table(spark, d, "lineitem"))


@query("outlier_columns", " union all ".join(["select count(*) n_columns, count(*) filter (n > 0) outliers_capped, sum(n)::bigint values_capped from (" + " union all ".join(f"""
  select count(*) filter ({c} < q[1] - 1.5 * (q[2] - q[1]) or {c} > q[2] + 1.5 * (q[2] - q[1])) n from {t},
    (select quantile_cont({c}, [0.25, 0.75]) q from {t})""" for t, c in (("lineitem", "l_quantity"), ("lineitem", "l_extendedprice"), ("lineitem", "l_discount"), ("lineitem", "l_partkey"))) + ")"]))
def _(spark, d):
    """Columns of the line items in which winsorizing caps something, counted from the report."""
    return quality.outlier_columns(clean.iqr_report(v.table(spark, d, "lineitem"), ["l_quantity", "l_extendedprice", "l_discount", "l_partkey"]))


@query("missing_report", """select column_name, missing_count, round(missing_count * 100::double / n, 6) missing_pct, dtype,
  missing_count * 100::double / n > 5 alert from (
  select unnest([{'column_name': 'l_orderkey', 'missing_count': 0, 'dtype': 'bigint'}, {'column_name': 'l_linenumber', 'missing_count': 0, 'dtype': 'int'},
    {'column_name': 'l_quantity', 'missing_count': 0, 'dtype': 'double'}, {'column_name': 'l_extendedprice', 'missing_count': 0, 'dtype': 'double'},
    {'column_name': 'tax', 'missing_count': count(*) filter (tax is null), 'dtype': 'double'},
    {'column_name': 'flag', 'missing_count': count(*) filter (flag is null), 'dtype': 'string'},
    {'column_name': 'l_linestatus', 'missing_count': 0, 'dtype': 'string'}], recursive := true), count(*) n from holey)""")
def _(spark, d):
    return quality.missing_report(v.holey(spark, d))


def _payload(spark, d):
    """A scoring payload per account, with some values out of bounds."""
    a = v.accounts(spark, d)
    k = F.col("account_id")
    return a.select(
        "account_id", (k % 40).cast("double").alias("tenure_months"), F.col("balance").alias("mrr"), (k % 50).alias("seats_purchased"),
        ((k * 37 % 120) / F.lit(100.0)).alias("feature_adoption_rate"), (k % 61).alias("days_since_last_activity"),
        (k % 13).alias("support_tickets_count"), (k % 7).cast("double").alias("avg_resolution_days"),
        F.when(k % 17 != 0, "pro").alias("plan_type"), F.col("industry").alias("customer_segment"), (k % 2).alias("near_renewal"),
        (k % 3).alias("has_discount"), F.lit("18-49").alias("age_group"), F.lit("EU").alias("region"))


PAYLOAD_CTE = """
  payload as (select account_id, (account_id % 40)::double tenure_months, balance mrr, account_id % 50 seats_purchased,
      (account_id * 37 % 120) / 100::double feature_adoption_rate, account_id % 61 days_since_last_activity,
      account_id % 13 support_tickets_count, (account_id % 7)::double avg_resolution_days,
      case when account_id % 17 <> 0 then 'pro' end plan_type, industry customer_segment, account_id % 2 near_renewal,
      account_id % 3 has_discount, '18-49' age_group, 'EU' region from accounts),
  valid_payload as (select * from payload where tenure_months >= 0 and mrr >= 0 and seats_purchased >= 1
      and feature_adoption_rate between 0 and 1 and has_discount <= 1 and plan_type is not null)"""


RULES_SQL = {
    "tenure_months_ge_0": "tenure_months >= 0", "mrr_ge_0": "mrr >= 0", "seats_purchased_ge_1": "seats_purchased >= 1", "feature_adoption_rate_ge_0": "feature_adoption_rate >= 0",
    "feature_adoption_rate_le_1": "feature_adoption_rate <= 1", "days_since_last_activity_ge_0": "days_since_last_activity >= 0",
    "support_tickets_count_ge_0": "support_tickets_count >= 0", "avg_resolution_days_ge_0": "avg_resolution_days >= 0", "near_renewal_ge_0": "near_renewal >= 0",
    "near_renewal_le_1": "near_renewal <= 1", "has_discount_ge_0": "has_discount >= 0", "has_discount_le_1": "has_discount <= 1", "plan_type_present": "plan_type is not null",
    "customer_segment_present": "customer_segment is not null", "age_group_present": "age_group is not null", "region_present": "region is not null"}


@query("validate_rows", " union all ".join(
    f"select '{rule}' rule, count(*) filter (not coalesce({how}, false)) violations from payload" for rule, how in RULES_SQL.items()), PAYLOAD_CTE)
def _(spark, d):
    """Every rule with its count, those that nobody breaks included."""
    return quality.validate_rows(_payload(spark, d), quality.bound_rules())[2]


@query("valid_rows", "select account_id, round(mrr, 6) mrr, seats_purchased from valid_payload", PAYLOAD_CTE)
def _(spark, d):
    return quality.validate_rows(_payload(spark, d), quality.bound_rules())[0].select("account_id", "mrr", "seats_purchased")


@query("quarantined_rows", """select account_id, (mrr < 0)::int + (seats_purchased < 1)::int + (feature_adoption_rate > 1)::int
  + (has_discount > 1)::int + (plan_type is null)::int n_violations from payload
  where account_id not in (select account_id from valid_payload)""", PAYLOAD_CTE)
def _(spark, d):
    return quality.validate_rows(_payload(spark, d), quality.bound_rules())[1].select("account_id", F.size("violations").alias("n_violations"))


def _cell_sql(c):
    return f"coalesce(length({c}::varchar) || ':' || {c}::varchar, '-')"


@query("table_fingerprint", f"""select count(*) n_rows, concat_ws('-', {", ".join(f"sum(('0x' || substr(h, {8 * i + 1}, 8))::bigint)::varchar" for i in range(4))}) fingerprint
  from (select md5({" || ".join(map(_cell_sql, ("l_orderkey", "l_linenumber", "l_partkey", "l_returnflag")))}) h from lineitem)""")
def _(spark, d):
    return quality.table_fingerprint(v.table(spark, d, "lineitem"), ["l_orderkey", "l_linenumber", "l_partkey", "l_returnflag"])


@query("table_summary", """select count(*) n_rows, 11 n_columns, round(avg(churn_flag), 6) label_rate, 7 numeric_columns, 2 string_columns, 1 capped_columns from accounts""")
def _(spark, d):
    return quality.table_summary(v.accounts(spark, d), "churn_flag", ["balance"])


@query("describe_numeric", """select 'l_quantity' column_name, count(l_quantity) n, round(avg(l_quantity), 4) mean, round(stddev_samp(l_quantity), 4) std,
    min(l_quantity) min, max(l_quantity) max from lineitem
  union all select 'l_extendedprice', count(*), round(avg(l_extendedprice), 4), round(stddev_samp(l_extendedprice), 4), min(l_extendedprice), max(l_extendedprice) from lineitem
  union all select 'l_discount', count(*), round(avg(l_discount), 4), round(stddev_samp(l_discount), 4), min(l_discount), max(l_discount) from lineitem""", digits=4)
def _(spark, d):
    return quality.describe_numeric(v.table(spark, d, "lineitem"), ["l_quantity", "l_extendedprice", "l_discount"])


@query("inspect_counts", """select sum(n)::bigint n_rows, round(sum(y * n)::double / sum(n), 6) label_rate, sum(n * (flag is null)::int)::bigint null_cells,
  (sum(n) - count(*))::bigint duplicate_rows from (
    select nullif(l_returnflag, 'A') flag, l_linestatus, l_discount, (l_quantity > 25)::int y, count(*) n from lineitem group by all)""")
def _(spark, d):
    li = v.table(spark, d, "lineitem").select(F.when(F.col("l_returnflag") != "A", F.col("l_returnflag")).alias("flag"), "l_linestatus",
                                              "l_discount", (F.col("l_quantity") > 25).cast("int").alias("y"))
    return quality.inspect_counts(li, "y")


SPLIT_CTE = """
  ranked as (select *, row_number() over (partition by churn_flag order by md5(account_id || ':42'), account_id) rk,
      count(*) over (partition by churn_flag) n from accounts),
  split3 as (select * exclude (rk, n), case when rk <= ceil(n::double * 0.2::double) then 'test'
      when rk <= ceil(n::double * 0.2::double) + ceil((n - ceil(n::double * 0.2::double))::double * 0.15::double) then 'val'
      else 'train' end split from ranked)"""


def three_way(spark, d):
    return sampling.stratified_split(v.accounts(spark, d), "account_id", "churn_flag", 0.2, 0.15)


@query("split_overlap", """select a.s split_a, b.s split_b, count(z.account_id) shared_keys
  from (values ('train', 1), ('val', 2), ('test', 3)) a(s, i) join (values ('train', 1), ('val', 2), ('test', 3)) b(s, i) on a.i < b.i
  left join (select x.split sa, y.split sb, x.account_id from split3 x join split3 y using (account_id)) z on z.sa = a.s and z.sb = b.s
  group by 1, 2""", SPLIT_CTE)
def _(spark, d):
    return quality.split_overlap(three_way(spark, d), "account_id")


@query("split_rates", """select split, count(*) n_rows, round(avg(churn_flag), 6) label_rate,
  abs(avg(churn_flag) - (select avg(churn_flag) from accounts)) < 0.025 within_tolerance from split3 group by 1""", SPLIT_CTE)
def _(spark, d):
    return quality.split_rates(three_way(spark, d), "churn_flag")


@query("protected_completeness", """select 'flag' attribute, count(*) n_rows, count(*) filter (flag is null) missing_count, count(*) filter (flag is null) = 0 complete from holey
  union all select 'l_linestatus', count(*), count(*) filter (l_linestatus is null), count(*) filter (l_linestatus is null) = 0 from holey""")
def _(spark, d):
    return quality.protected_completeness(v.holey(spark, d), ["flag", "l_linestatus"])


# ---- cleaning --------------------------------------------------------------------------------------------------

@query("drop_leakage", "select account_id, industry, country, balance, churn_flag from accounts")
def _(spark, d):
    a = v.accounts(spark, d).select("account_id", "industry", "country", "balance", "churn_flag", F.col("last_order").alias("end_date"))
    return clean.drop_leakage(a)


@query("rename_prefixed", "select subscription_id, account_id, plan_tier sub_plan_tier from subscriptions")
def _(spark, d):
    return clean.rename_prefixed(v.subscriptions(spark, d), ["plan_tier", "seats"]).select("subscription_id", "account_id", "sub_plan_tier")


@query("convert_types", """select event_id, strftime(ts, '%Y-%m-%d %H:%M:%S') created_at, case when event_id % 9 = 0 then null else 1 end good_date,
  try_cast(value as double)::int whole from (select event_id, ts, floor(value) value from events)""")
def _(spark, d):
    e = v.table(spark, d, "events")
    text = e.select("event_id", F.date_format("ts", "yyyy-MM-dd HH:mm:ss").alias("created_at"),
                    F.when(F.col("event_id") % 9 == 0, "not a date").otherwise(F.date_format("ts", "yyyy-MM-dd")).alias("seen_date"),
                    F.floor("value").cast("string").alias("whole"))
    out = clean.convert_types(text, ints=["whole"])
    return as_text(out, "created_at").select("event_id", "created_at", F.when(F.col("seen_date").isNotNull(), 1).alias("good_date"), "whole")


@query("drop_sparse", "select l_orderkey, l_linenumber, flag from (select * from holey)")
def _(spark, d):
    h = v.holey(spark, d).withColumn("rare", F.when(F.col("l_linenumber") == 7, F.col("tax"))).select("l_orderkey", "l_linenumber", "flag", "rare")
    return clean.drop_sparse(h)


@query("missing_indicators", """select l_orderkey, l_linenumber, (tax is null)::int is_missing_tax, (flag is null)::int is_missing_flag from holey""")
def _(spark, d):
    return clean.missing_indicators(v.holey(spark, d)).select("l_orderkey", "l_linenumber", "is_missing_tax", "is_missing_flag")


@query("impute_numeric", "select l_orderkey, l_linenumber, round(coalesce(tax, (select median(tax) from holey)), 6) tax from holey")
def _(spark, d):
    return clean.impute_numeric(v.holey(spark, d), ["tax"]).select("l_orderkey", "l_linenumber", "tax")


@query("impute_numeric_mean", "select l_orderkey, l_linenumber, round(coalesce(tax, (select avg(tax) from holey)), 6) tax from holey")
def _(spark, d):
    return clean.impute_numeric(v.holey(spark, d), ["tax"], "mean").select("l_orderkey", "l_linenumber", "tax")


@query("impute_categorical", """select l_orderkey, l_linenumber, coalesce(flag, (select flag from holey where flag is not null group by 1 order by count(*) desc, flag limit 1)) flag from holey""")
def _(spark, d):
    return clean.impute_categorical(v.holey(spark, d), ["flag"]).select("l_orderkey", "l_linenumber", "flag")


@query("imputation_log", """select 'tax' column_name, 'median' strategy, round(median(tax), 6) fill_number, null::varchar fill_text, count(*) filter (tax is null) rows_filled from holey
  union all select 'flag', 'mode', null, (select flag from holey where flag is not null group by 1 order by count(*) desc, flag limit 1), count(*) filter (flag is null) from holey""")
def _(spark, d):
    return clean.imputation_log(v.holey(spark, d), ["tax", "l_quantity"], ["flag", "l_linestatus"])


@query("fill_by_role", "select l_orderkey, l_linenumber, coalesce(tax::int, 0) tax, coalesce(flag, 'unknown') flag from holey")
def _(spark, d):
    return clean.fill_by_role(v.holey(spark, d), ["tax"], ["flag"]).select("l_orderkey", "l_linenumber", "tax", "flag")


@query("dedup_last", """select account_id, subscription_id, mrr_amount from (select *, row_number() over (partition by account_id
  order by start_date desc, subscription_id desc) rn from subscriptions) where rn = 1""")
def _(spark, d):
    return clean.dedup_last(v.subscriptions(spark, d), "account_id", ["start_date", "subscription_id"]).select("account_id", "subscription_id", "mrr_amount")


@query("remove_duplicates", "select distinct l_returnflag, l_linestatus, l_discount, l_quantity from lineitem")
def _(spark, d):
    return clean.remove_duplicates(v.table(spark, d, "lineitem").select("l_returnflag", "l_linestatus", "l_discount", "l_quantity"))


IQR_CTE = """
  q as (select quantile_cont(value, 0.25) q1, quantile_cont(value, 0.75) q3 from events),
  fence as (select q1, q3, q1 - 1.5::double * (q3 - q1) lo, q3 + 1.5::double * (q3 - q1) hi from q)"""


@query("iqr_winsorize", "select event_id, round(least(greatest(value, lo), hi), 6) value from events, fence", IQR_CTE)
def _(spark, d):
    return clean.iqr_winsorize(v.table(spark, d, "events"), ["value"]).select("event_id", "value")


@query("iqr_report", """select 'value' column_name, round(q1, 6) q1, round(q3, 6) q3, round(q3 - q1, 6) iqr, round(lo, 6) lower_bound, round(hi, 6) upper_bound,
  count(*) filter (value < lo) n_below, count(*) filter (value > hi) n_above,
  round(100::double * count(*) filter (value < lo or value > hi) / count(value), 6) pct_outside, round(min(value), 6) original_min, round(max(value), 6) original_max,
  round(greatest(min(value), lo), 6) capped_min, round(least(max(value), hi), 6) capped_max from events, fence group by q1, q3, lo, hi""", IQR_CTE)
def _(spark, d):
    return clean.iqr_report(v.table(spark, d, "events"), ["value"])


@query("percentile_clip", """select l_orderkey, l_linenumber, round(least(greatest(l_extendedprice, lo), hi), 6) l_extendedprice from lineitem,
  (select quantile_cont(l_extendedprice, 0.01) lo, quantile_cont(l_extendedprice, 0.99) hi from lineitem)""")
def _(spark, d):
    return clean.percentile_clip(v.table(spark, d, "lineitem"), ["l_extendedprice"]).select("l_orderkey", "l_linenumber", "l_extendedprice")


@query("align_features", "select account_id, balance, 0.0::double seats, country from accounts")
def _(spark, d):
    return clean.align_features(v.accounts(spark, d), ["balance", "seats", "country"], keep=["account_id"])


@query("feature_matrix", "select account_id, industry, country, balance, n_orders, round(avg_spend, 6) avg_spend, max_spend, churn_flag from accounts")
def _(spark, d):
    return clean.feature_matrix(v.accounts(spark, d), key="account_id").drop("last_order")


@query("split_protected", "select account_id, industry, country from accounts")
def _(spark, d):
    return clean.split_protected(v.accounts(spark, d), "account_id", ["industry", "country"])[1]


@query("membership_flag", "select c_custkey, (c_custkey in (select user_id from events where event_type = 'error'))::int has_error from customer")
def _(spark, d):
    errors = v.table(spark, d, "events").where(F.col("event_type") == "error").select(F.col("user_id").alias("c_custkey"))
    return clean.membership_flag(v.table(spark, d, "customer").select("c_custkey"), errors, "c_custkey", "has_error")


@query("filter_matching", "select o_orderkey, o_orderpriority from orders where regexp_matches(o_orderpriority, '(urgent|high)', 'i')")
def _(spark, d):
    return clean.filter_matching(v.table(spark, d, "orders"), "o_orderpriority", "(urgent|high)").select("o_orderkey", "o_orderpriority")
