"""Registered queries: profiling, comparison of datasets, drift."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import drift, evaluate, profile
from . import views as v
from .registry import query

LI = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]


def labelled(spark, d):
    """Line items with a 0/1 label (returned)."""
    return v.table(spark, d, "lineitem").select(*LI, "l_returnflag", "l_linestatus", (F.col("l_returnflag") == "R").cast("int").alias("y"),
                                                (F.col("l_quantity") > 25).cast("int").alias("big"), (F.col("l_discount") > 0.05).cast("int").alias("cheap"))


LAB = """
  lab as (select l_quantity, l_extendedprice, l_discount, l_tax, l_returnflag, l_linestatus, (l_returnflag = 'R')::int y,
      (l_quantity > 25)::int big, (l_discount > 0.05::double)::int cheap from lineitem)"""


def per_column(template: str, cols=LI) -> str:
    return " union all ".join(template.format(c=c) for c in cols)


@query("label_distribution", """select count(*) n_total, count(*) filter (churn_flag = 0) n_negative, count(*) filter (churn_flag = 1) n_positive,
  round(100::double * count(*) filter (churn_flag = 1) / count(*), 6) rate_pct, round(count(*) filter (churn_flag = 0)::double / greatest(count(*) filter (churn_flag = 1), 1), 6) imbalance_ratio,
  case when 100 * avg(churn_flag) < 10 then 'severe' when 100 * avg(churn_flag) < 25 then 'moderate' else 'balanced' end severity from accounts""")
def _(spark, d):
    return profile.label_distribution(v.accounts(spark, d), "churn_flag")


@query("category_frequency", """select 'o_orderpriority' feature, o_orderpriority as value, count(*) n_rows, round(100::double * count(*) / (select count(*) from orders), 6) pct from orders group by 2
  union all select 'o_orderstatus', o_orderstatus, count(*), round(100::double * count(*) / (select count(*) from orders), 6) from orders group by 2""")
def _(spark, d):
    return profile.category_frequency(v.table(spark, d, "orders"), ["o_orderpriority", "o_orderstatus"])


@query("top_category", """select 'o_orderpriority' feature, o_orderpriority as value, n n_rows from (select o_orderpriority, count(*) n from orders group by 1 order by 2 desc, 1 limit 1)
  union all (select 'o_orderstatus', o_orderstatus, count(*) from orders group by 2 order by 3 desc, 2 limit 1)""")
def _(spark, d):
    return profile.top_category(v.table(spark, d, "orders"), ["o_orderpriority", "o_orderstatus"])


RATES = """
  rates as (select 'industry' feature, industry as value, count(*) n_rows, avg(churn_flag) r from accounts group by 2
    union all select 'country', country::varchar, count(*), avg(churn_flag) from accounts group by 2)"""


@query("rate_by_category", """select feature, value, n_rows, round(r, 6) label_rate, round((select avg(churn_flag) from accounts), 6) overall_rate,
  case when r > 0.3::double then 'high' when r > 0.2::double then 'medium' else 'low' end band from rates""", RATES)
def _(spark, d):
    return profile.rate_by_category(v.accounts(spark, d), ["industry", "country"], "churn_flag")


@query("extreme_categories", """select feature, (array_agg(value order by r desc, value))[1] worst, round(max(r), 6) worst_rate,
  (array_agg(value order by r, value))[1] best, round(min(r), 6) best_rate from rates group by 1""", RATES)
def _(spark, d):
    return profile.extreme_categories(v.accounts(spark, d), ["industry", "country"], "churn_flag")


@query("rate_by_flags", """select 'big' flag, big as value, count(*) n_rows, round(avg(y), 6) label_rate from lab group by 2
  union all select 'cheap', cheap, count(*), round(avg(y), 6) from lab group by 2""", LAB)
def _(spark, d):
    return profile.rate_by_flags(labelled(spark, d), ["big", "cheap"], "y")


@query("univariate_profile", per_column("""select '{c}' feature, round(avg({c}), 4) mean, round(median({c}), 4) median, round(stddev_samp({c}), 4) std, round(skewness({c}), 4) skew,
  case when skewness({c}) > 0.5 then 'right-skewed' when skewness({c}) < -0.5 then 'left-skewed' else 'symmetric' end shape from lineitem""", LI)
  + """ union all select 'value', round(avg(value), 4), round(median(value), 4), round(stddev_samp(value), 4), round(skewness(value), 4),
  case when skewness(value) > 0.5 then 'right-skewed' when skewness(value) < -0.5 then 'left-skewed' else 'symmetric' end from events""", digits=4)
def _(spark, d):
    return profile.univariate_profile(v.table(spark, d, "lineitem"), LI).unionByName(profile.univariate_profile(v.table(spark, d, "events"), ["value"]))


HIST = """select '{c}' feature, least(floor(({c} - lo) / ((hi - lo) / 30)), 29)::bigint bin, round(lo + least(floor(({c} - lo) / ((hi - lo) / 30)), 29) * ((hi - lo) / 30), 6) bin_start, count(*) n_rows
  from lineitem, (select min({c}) lo, max({c}) hi from lineitem) group by 2, 3"""


@query("histogram", per_column(HIST, ["l_quantity", "l_extendedprice"]))
def _(spark, d):
    return profile.histogram(v.table(spark, d, "lineitem"), ["l_quantity", "l_extendedprice"], 30)


@query("density_by_group", """select industry, bin, 'balance' feature, round(lo + bin * w, 6) bin_start, count(*) n_rows, round(count(*)::double / n, 6) share from (
  select industry, lo, (hi - lo) / 25 w, least(floor((balance - lo) / ((hi - lo) / 25)), 24)::bigint bin, count(*) over (partition by industry) n
  from accounts, (select min(balance) lo, max(balance) hi from accounts)) group by industry, bin, lo, w, n""")
def _(spark, d):
    return profile.density_by_group(v.accounts(spark, d), "balance", "industry", 25)


@query("distribution_by_class", per_column("""select y, '{c}' feature, round(q[1], 4) q1, round(q[2], 4) median, round(q[3], 4) q3, round(min({c}) filter ({c} >= q[1] - (q[3] - q[1]) * 1.5), 4) whisker_low,
  round(max({c}) filter ({c} <= q[3] + (q[3] - q[1]) * 1.5), 4) whisker_high, count({c}) n_rows from lab join (select y, quantile_cont({c}, [0.25, 0.5, 0.75]) q from lab group by 1) using (y) group by y, q""",
  ["l_quantity", "l_extendedprice"]), LAB, digits=4)
def _(spark, d):
    return profile.distribution_by_class(labelled(spark, d), ["l_quantity", "l_extendedprice"], "y")


@query("class_shift", per_column("""select '{c}' feature, round(a, 4) median_0, round(b, 4) median_1, round((b - a) / a * 100, 4) diff_pct, case when b < a then 'lower' else 'higher' end direction
  from (select median({c}) filter (churn_flag = 0) a, median({c}) filter (churn_flag = 1) b from accounts)""", ["n_orders", "max_spend", "balance"]), digits=4)
def _(spark, d):
    return profile.class_shift(v.accounts(spark, d), ["n_orders", "max_spend", "balance"], "churn_flag")


NUM = ["balance", "n_orders", "max_spend", "country", "churn_flag"]
PAIRS = [(a, b) for i, a in enumerate(NUM) for b in NUM[:i]]
LI_PAIRS = [(a, b) for i, a in enumerate(LI) for b in LI[:i]]


@query("correlation_matrix", " union all ".join(f"select '{a}' feature_a, '{b}' feature_b, round(corr({a}, {b}), 6) r from lineitem" for a, b in LI_PAIRS))
def _(spark, d):
    return profile.correlation_matrix(v.table(spark, d, "lineitem"), LI)


@query("top_correlates", "select feature, round(r, 6) r, case when r > 0 then 'positive' else 'negative' end direction from ("
       + " union all ".join(f"select '{c}' feature, corr({c}, churn_flag) r from accounts" for c in NUM[:-1]) + ") order by abs(r) desc limit 3")
def _(spark, d):
    return profile.top_correlates(v.accounts(spark, d), NUM, "churn_flag", 3)


@query("collinear_pairs", "select * from (" + " union all ".join(
    f"select '{a}' feature_a, '{b}' feature_b, round(corr({a}, {b}), 6) r from accounts" for a, b in PAIRS if "churn_flag" not in (a, b)) + ") where abs(r) > 0.3")
def _(spark, d):
    return profile.collinear_pairs(v.accounts(spark, d), NUM, "churn_flag", 0.3)


@query("group_gap", """select count(*) n_groups, round(min(r), 6) min_rate, round(max(r), 6) max_rate, round(max(r) - min(r), 6) gap
  from (select industry, avg(churn_flag) r from accounts where industry is not null group by 1)""")
def _(spark, d):
    return profile.group_gap(v.accounts(spark, d), "industry", "churn_flag")


def _metrics_sql(table, label, tenure, revenue, group):
    return f"""select unnest(['label_rate_pct', 'positive_share_pct', 'avg_tenure', 'avg_revenue', 'group_gap_pct']) metric,
      unnest([100 * avg({label}), 100::double * count(*) filter ({label} = 1) / count({label}), avg({tenure}), avg({revenue}),
        (select 100 * (max(r) - min(r)) from (select avg({label}) r from {table} where {group} is not null group by {group}))]) as value from {table}"""


@query("compare_datasets", """select metric, round(a.value, 4) value_a, round(b.value, 4) value_b from ma a join mb b using (metric)""",
       "\n  doc as (select quality, n_chars, length(source) src_len, lang from labels join documents using (doc_id))",
       "\n  ma as (" + _metrics_sql("accounts", "churn_flag", "n_orders", "balance", "industry") + ")",
       "\n  mb as (" + _metrics_sql("doc", "quality", "src_len", "n_chars", "lang") + ")", digits=4)
def _(spark, d):
    """The accounts against a second labelled table."""
    doc = v.table(spark, d, "labels").select("doc_id", "quality").join(
        v.table(spark, d, "documents").select("doc_id", "n_chars", F.length("source").alias("src_len"), "lang"), "doc_id")
    return profile.compare_datasets(
        profile.comparison_metrics(v.accounts(spark, d), "churn_flag", "n_orders", "balance", "industry"),
        profile.comparison_metrics(doc, "quality", "src_len", "n_chars", "lang"))


@query("ks_two_sample", """select 'A' group_1, 'N' group_2, round(max(abs(f1 / n1 - f2 / n2)), 6) ks, max(n1)::bigint n1, max(n2)::bigint n2 from (
  select x, sum(c1) over (order by x) f1, sum(c2) over (order by x) f2, sum(c1) over () n1, sum(c2) over () n2 from (
    select l_extendedprice x, (count(*) filter (l_returnflag = 'A'))::double c1, (count(*) filter (l_returnflag = 'N'))::double c2 from lineitem where l_returnflag in ('A', 'N') group by 1))""")
def _(spark, d):
    return evaluate.ks_two_sample(v.table(spark, d, "lineitem"), "l_extendedprice", "l_returnflag").drop("p_value", "different")


@query("ks_p_value", """select round(ks, 6) ks, round(case when l2 < 0.04 then 1 else greatest(0, least(1, (select sum(case when k % 2 = 1 then 2 else -2 end * exp(-2 * k * k * l2)) from range(1, 101) t(k)))) end, 6) p_value from (
  select ks, ks * ks * (n1 * n2 / (n1 + n2)) l2 from (select max(abs(f1 / n1 - f2 / n2)) ks, max(n1) n1, max(n2) n2 from (
  select x, sum(c1) over (order by x) f1, sum(c2) over (order by x) f2, sum(c1) over () n1, sum(c2) over () n2 from (
    select balance x, (count(*) filter (churn_flag = 0))::double c1, (count(*) filter (churn_flag = 1))::double c2 from accounts group by 1))))""")
def _(spark, d):
    return evaluate.ks_two_sample(v.accounts(spark, d), "balance", "churn_flag", 0, 1).select("ks", "p_value")


# ---- drift -----------------------------------------------------------------------------------------------------

def psi_sql(col: str, open_ends: bool = False) -> str:
    """PSI of one column between the two halves, straight from its definition."""
    inside = "true" if open_ends else f"{col} between e[1] and e[len(e)]"
    raw = f"len(list_filter(e, lambda z: z <= {col}))"
    bin_expr = f"greatest(least({raw}, len(e) - 1), 1)"
    return f"""select '{col}' feature, sum((pc - pe) * ln(pc / pe)) psi, count(*) n_bins, max(outside)::double outside_share from (
      select (e1 + 1) / (sum(e1) over () + count(*) over ())::double pe, (a1 + 1) / (sum(a1) over () + count(*) over ())::double pc, outside from (
        select b, coalesce(e1, 0) e1, coalesce(a1, 0) a1, outside from (select unnest(range(1, len(e))) b from edges_{col}) g
        left join (select {bin_expr} b, count(*) e1 from base_half, edges_{col} group by 1) using (b)
        left join (select {bin_expr} b, count(*) a1 from cur_half, edges_{col} where {inside} group by 1) using (b)
        cross join (select (count(*) filter (not ({inside})))::double / count(*) outside from cur_half, edges_{col})))"""


def edge_cte(col: str) -> str:
    return f"""
  edges_{col} as (select list_sort(list_distinct(quantile_cont({col}, [0, 0.1, 0.2, 0.3, 0.4, 0.5, 0.6, 0.7, 0.8, 0.9, 1]))) e from base_half)"""


DRIFT = ["discount", "price", "quantity", "warped"]


@query("psi", "select feature, round(psi, 6) psi, n_bins, round(outside_share, 6) outside_share from (" + " union all ".join(psi_sql(c) for c in DRIFT) + ")",
       *[edge_cte(c) for c in DRIFT])
def _(spark, d):
    return drift.psi(*v.price_halves(spark, d))


@query("psi_open_ends", "select feature, round(psi, 6) psi, n_bins from (" + " union all ".join(psi_sql(c, True) for c in DRIFT) + ")",
       *[edge_cte(c) for c in DRIFT])
def _(spark, d):
    return drift.psi(*v.price_halves(spark, d), open_ends=True).drop("outside_share")


@query("drift_report", "select feature, round(psi, 6) psi, round(outside_share, 6) outside_share, case when psi > 0.2 then 'DRIFT' else 'OK' end status, count(*) filter (psi > 0.2) over () n_alerts from ("
       + " union all ".join(psi_sql(c) for c in DRIFT) + ")", *[edge_cte(c) for c in DRIFT])
def _(spark, d):
    return drift.drift_report(*v.price_halves(spark, d))


@query("drift_compare", " union all ".join(f"""select '{c}' feature, round(max(mb), 4) mean_base, round(max(mc), 4) mean_current, round(max(mc) - max(mb), 4) mean_shift,
  round(max(abs(f1 / n1 - f2 / n2)), 4) ks from (select x, sum(c1) over (order by x) f1, sum(c2) over (order by x) f2, sum(c1) over () n1, sum(c2) over () n2 from (
    select x, (count(*) filter (s = 1))::double c1, (count(*) filter (s = 2))::double c2 from (select {c} x, 1 s from base_half union all select {c}, 2 from cur_half) group by 1)),
  (select avg({c}) mb from base_half), (select avg({c}) mc from cur_half)""" for c in DRIFT), digits=4)
def _(spark, d):
    return drift.drift_compare(*v.price_halves(spark, d)).select("feature", "mean_base", "mean_current", "mean_shift", "ks")
