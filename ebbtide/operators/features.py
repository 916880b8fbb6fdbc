"""Derived features: tenure, usage, revenue, support, renewal, alerts.

Only scalar expressions and a few fitted constants; no operator here shuffles
the base table unless it aggregates events.
"""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import clip, col, cut, dbl, elapsed_days, floor_ratio, no_nan, ratio
from .ordering import quantile_values, rank_cut, small_side

INF = float("inf")

# Bins, labels and weights of the feature contract.
TENURE_EDGES = [0, 3, 6, 12, INF]
TENURE_LABELS = ["0-3", "3-6", "6-12", "12+"]
REVENUE_EDGES = [-INF, 500, 2000, 5000, INF]
REVENUE_LABELS = ["SMB", "Mid-Market", "Enterprise", "Strategic"]
MODULE_WEIGHTS = [0.1, 0.15, 0.25, 0.2, 0.3]
DAYS_PER_MONTH = 30.4
THIRDS = ["low", "medium", "high"]
QUARTERS = ["low", "mid", "high", "enterprise"]
RISK_EDGES = [-0.01, 0.25, 0.5, 0.75, 1.01]
RISK_LABELS = ["Low", "Medium", "High", "Critical"]
AUDIT_LEVELS = [(0.7, "HIGH"), (0.4, "MEDIUM")]
AUDIT_OTHERWISE = "LOW"
TIER_ACTIONS = {
    "Low": "none",
    "Medium": "monitor",
    "High": "outreach within 1 week",
    "Critical": "escalate",
}
DEFAULT_DESCRIPTION = "No description on file"


def tenure_features(df: DataFrame, start: str, ref: Column | str, days_per_month: float = DAYS_PER_MONTH,
                    floor: float = 0.1) -> DataFrame:
    """``tenure_months`` (never below ``floor``) and its right-closed bucket."""
    months = clip(elapsed_days(ref, start) / F.lit(days_per_month), lo=floor)
    return df.withColumn("tenure_months", months).withColumn(
        "tenure_bucket", cut(F.col("tenure_months"), TENURE_EDGES, TENURE_LABELS))


def signup_tenure(df: DataFrame, signup: str, days_per_month: float = 30.44, digits: int = 1) -> DataFrame:
    """Months between signup and the latest signup in the table, rounded."""
    latest = df.agg(F.max(signup).alias("m")).scalar()
    return df.withColumn("tenure_months", F.round(elapsed_days(latest, signup) / F.lit(days_per_month), digits))


def bucketize(df: DataFrame, column: str, edges: Sequence[float], labels: Sequence[str], name: str,
              lowest: bool = False) -> DataFrame:
    return df.withColumn(name, cut(dbl(column), edges, labels, lowest))


def recency_days(df: DataFrame, last: str, ref: Column | str, name: str = "days_since_last_activity") -> DataFrame:
    return df.withColumn(name, elapsed_days(ref, last))


def near_renewal(df: DataFrame, days: Column | str, within: int = 30, name: str = "near_renewal") -> DataFrame:
    """1 when renewal is less than ``within`` days away; overdue counts as near."""
    return df.withColumn(name, F.coalesce(dbl(days) < within, F.lit(False)).cast("int"))


def renewal_from_cycle(df: DataFrame, start: str, billing: str, ref: Column | str, within: int = 30,
                       annual_values: Sequence[str] = ("annual",), name: str = "near_renewal") -> DataFrame:
    """Renewal flag from start date and billing cycle (365 or 30 days) when no day count exists."""
    cycle = F.when(F.lower(F.col(billing)).isin(*[a.lower() for a in annual_values]), F.lit(365)).otherwise(F.lit(30))
    left = cycle - F.pmod(elapsed_days(ref, start), cycle)
    return near_renewal(df, left, within, name)


def usage_features(df: DataFrame, total: str, active_days: str, last30: str | None = None, prev30: str | None = None,
                   tenure: str = "tenure_months") -> DataFrame:
    """Intensity per month, share of active days in [0, 1] and, with both windows given, the 30-day trend."""
    out = df.withColumns({
        "usage_intensity": ratio(total, tenure),
        "active_day_ratio": clip(ratio(active_days, dbl(tenure) * DAYS_PER_MONTH), 0, 1),
    })
    if last30 and prev30:
        out = out.withColumn("usage_trend_30d", trend(last30, prev30))
    return out


def trend(last: Column | str, prev: Column | str) -> Column:
    return (dbl(last) - dbl(prev)) / (dbl(prev) + F.lit(1.0))


def usage_trend(events: DataFrame, key: str, ts: str, ref: Column, days: int = 30, amount: Column | None = None) -> DataFrame:
    """Amount in the last and the preceding ``days`` before ``ref`` per key, and the trend between them."""
    amount = F.lit(1.0) if amount is None else amount
    age = elapsed_days(ref, ts)
    per = events.where(F.col(key).isNotNull()).groupBy(key).agg(
        F.sum(F.when((age >= 0) & (age < days), amount).otherwise(0.0)).alias("usage_last"),
        F.sum(F.when((age >= days) & (age < 2 * days), amount).otherwise(0.0)).alias("usage_prev"))
    return per.withColumn("usage_trend", trend("usage_last", "usage_prev"))


def safe_ratio(df: DataFrame, a: str, b: str, name: str) -> DataFrame:
    """a / max(b, 1)."""
    return df.withColumn(name, floor_ratio(a, b, 1.0))


def weighted_flags(df: DataFrame, cols: Sequence[str], weights: Sequence[float] = MODULE_WEIGHTS,
                   name: str = "module_adoption_score") -> DataFrame:
    """Weighted sum of flags; a missing flag adds nothing."""
    if len(cols) != len(weights):
        raise ValueError("one weight per flag")
    score = F.lit(0.0)
    for c, w in zip(cols, weights):
        score = score + F.coalesce(dbl(c), F.lit(0.0)) * F.lit(float(w))
    return df.withColumn(name, score)


def support_rate(df: DataFrame, tickets: str, tenure: str = "tenure_months") -> DataFrame:
    return df.withColumn("support_ticket_rate", ratio(tickets, tenure))


def segment_edges(df: DataFrame, column: str, q: int) -> list[float]:
    """The q+1 quantile edges."""
    return quantile_values(df, [column], [i / q for i in range(q + 1)])[column]


def quantile_segment(df: DataFrame, column: str, labels: Sequence[str] = THIRDS, name: str = "mrr_segment",
                     key: str | None = None, edges: Sequence[float] | None = None) -> DataFrame:
    """Equal-count segments, right-closed with the lowest value included.

    Repeated edges (one value dominating the column) cannot be labelled; with a
    ``key`` the rows are then segmented by rank instead.
    """
    edges = list(edges) if edges is not None else segment_edges(df, column, len(labels))
    if any(e is None for e in edges):
        return df.withColumn(name, F.lit(None).cast("string"))
    if len(set(edges)) < len(edges):
        if key is None:
            raise ValueError("repeated quantile edges: pass a key to rank instead")
        return rank_segment(df, column, key, labels, name)
    return df.withColumn(name, cut(dbl(column), edges, labels, lowest=True))


def rank_segment(df: DataFrame, column: str, key: str, labels: Sequence[str] = THIRDS, name: str = "mrr_segment") -> DataFrame:
    """Segments on the rank over (value, key): equal counts whatever the ties, as long as a key has one row per value.

    Only the ranks at the borders are looked up, and rows compare themselves with them. NULL and NaN have no segment.
    """
    n, q = df.agg(F.count(no_nan(column)).alias("n")).first()["n"], len(labels)
    label = F.lit(labels[-1])
    for i in range(q - 2, -1, -1):
        last = math.floor(1 + (n - 1) * ((i + 1) / q))  # the highest rank in segment i
        if last >= 1:
            label = F.when(rank_cut(df, column, key, last).within(dbl(column), F.col(key)), F.lit(labels[i])).otherwise(label)
    return df.withColumn(name, F.when(no_nan(column).isNotNull(), label))


def revenue_segment(df: DataFrame, column: str, name: str = "revenue_segment") -> DataFrame:
    return bucketize(df, column, REVENUE_EDGES, REVENUE_LABELS, name)


def map_features(df: DataFrame, mapping: Mapping[str, Column]) -> DataFrame:
    """Add features that a second domain defines by simple proxies (name -> expression)."""
    return df.withColumns(dict(mapping))


# What a thin scoring payload implies for the fields it lacks.
PAYLOAD_SIZES, PAYLOAD_SIZE_LABELS = [-INF, 10, 30, INF], ["medium", "large", "enterprise"]
PAYLOAD_MRR = [(200, "low"), (1000, "medium")]
PAYLOAD_MRR_OTHERWISE = "high"
PAYLOAD_MONTH_EDGES, PAYLOAD_MONTH_LABELS = [-INF, 3, 6, 12, INF], ["0-3m", "3-6m", "6-12m", "12+m"]
PAYLOAD_MODULES = [0.2, 0.4, 0.6, 0.8, 0.9]
PAYLOAD = {"annual_above": 12, "seat_margin": 0.3, "day_margin": 0.2, "month_days": 22, "usage_last": 200, "usage_prev": 180, "features": 20, "open_share": 0.3,
           "sponsor_seats": 15, "idle_days": 30, "renewal_near": 30, "renewal_far": 180, "events_per_day": 8}


def payload_backfill(df: DataFrame) -> DataFrame:
    """The feature set a thin scoring payload implies, for a whole batch.

    Rules are per field: counts are truncated, floors keep denominators above zero.
    """
    seats, tenure, mrr = dbl("seats_purchased"), dbl("tenure_months"), dbl("mrr")
    adoption, tickets = dbl("feature_adoption_rate"), dbl("support_tickets_count")

    def whole(c: Column) -> Column:
        return F.greatest(c.cast("long"), F.lit(1).cast("long"))

    v = PAYLOAD
    segment = F.when(mrr < PAYLOAD_MRR[0][0], PAYLOAD_MRR[0][1])
    for limit, label in PAYLOAD_MRR[1:]:
        segment = segment.when(mrr < limit, label)
    first = df.withColumns({
        "company_size": F.coalesce(cut(seats, PAYLOAD_SIZES, PAYLOAD_SIZE_LABELS), F.lit(PAYLOAD_SIZE_LABELS[-1])),
        "contract_type": F.when(tenure > v["annual_above"], "annual").otherwise("monthly"),
        "arpu": floor_ratio(mrr, seats),
        "revenue_per_seat": floor_ratio(mrr, seats),
        "seats_active": whole(seats * F.least(adoption + v["seat_margin"], F.lit(1.0))),
        "active_days": whole(tenure * v["month_days"] * F.least(adoption + v["day_margin"], F.lit(1.0))),
        "usage_last_30d": whole(adoption * v["usage_last"]),
        "usage_prev_30d": whole(adoption * v["usage_prev"]),
        "features_available": F.lit(v["features"]).cast("long"),
        "features_used": whole(adoption * v["features"]),
        **{f"module_{i}_active": (adoption > t).cast("int") for i, t in enumerate(PAYLOAD_MODULES, 1)},
        "total_tickets": tickets.cast("long"),
        "open_tickets": (tickets * v["open_share"]).cast("long"),
        "executive_sponsor": (seats > v["sponsor_seats"]).cast("int"),
        "competitor_evaluation": (dbl("days_since_last_activity") > v["idle_days"]).cast("int"),
        "contract_renewal_days": F.when(F.col("near_renewal") == 1, v["renewal_near"]).otherwise(v["renewal_far"]),
        "tenure_bucket": cut(tenure, PAYLOAD_MONTH_EDGES, PAYLOAD_MONTH_LABELS),
        "mrr_segment": segment.otherwise(PAYLOAD_MRR_OTHERWISE),
    }).withColumn("total_events", F.greatest((F.col("active_days") * v["events_per_day"] * adoption).cast("long"), F.lit(1).cast("long")))
    modules = sum((F.col(f"module_{i}_active") for i in range(2, 6)), F.col("module_1_active"))
    return first.withColumns({
        "usage_intensity": floor_ratio("total_events", "active_days"),
        "active_day_ratio": F.least(floor_ratio("active_days", tenure * DAYS_PER_MONTH), F.lit(1.0)),
        "usage_trend_30d": floor_ratio(F.col("usage_last_30d") - F.col("usage_prev_30d"), "usage_prev_30d"),
        "seat_utilization": floor_ratio("seats_active", seats),
        "module_adoption_score": modules / F.lit(5.0),
        "support_ticket_rate": floor_ratio(tickets, tenure),
        "unresolved_ticket_ratio": floor_ratio("open_tickets", tickets),
    })


def risk_tier(df: DataFrame, p: str, edges: Sequence[float] = RISK_EDGES, labels: Sequence[str] = RISK_LABELS,
              name: str = "risk_tier") -> DataFrame:
    return df.withColumn(name, cut(dbl(p), edges, labels))


def audit_tier(p: Column | str, levels: Sequence[tuple[float, str]] = AUDIT_LEVELS, otherwise: str = AUDIT_OTHERWISE) -> Column:
    """The second, left-closed scale: the first level whose minimum the score reaches."""
    out = None
    for minimum, label in levels:
        hit = col(p) >= minimum
        out = F.when(hit, label) if out is None else out.when(hit, label)
    return F.when(col(p).isNotNull(), out.otherwise(otherwise))


def decide(df: DataFrame, p: str, threshold: float = 0.5, name: str = "prediction") -> DataFrame:
    return df.withColumn(name, (dbl(p) >= threshold).cast("int"))


def tier_actions(df: DataFrame, tier: str = "risk_tier", actions: Mapping[str, str] = TIER_ACTIONS,
                 name: str = "action") -> DataFrame:
    pairs = [F.lit(x) for kv in actions.items() for x in kv]
    return df.withColumn(name, F.element_at(F.create_map(*pairs), F.col(tier)))


def clean_feature_names(df: DataFrame, column: str, lookup: Mapping[str, str], default: str = DEFAULT_DESCRIPTION) -> DataFrame:
    """Text after the last ``__`` and its description."""
    short = F.substring_index(F.col(column), "__", -1)
    if lookup:
        pairs = F.create_map(*[F.lit(x) for kv in lookup.items() for x in kv])
        text = F.coalesce(F.element_at(pairs, short), F.lit(default))
    else:
        text = F.lit(default)
    return df.withColumn("label", short).withColumn("description", text)


def account_age(df: DataFrame, signup: str, plan_start: str, ref: Column | str, new_days: int = 30,
                observe_days: int = 14) -> DataFrame:
    """Account age, days on the current plan, newness flag, cohort and observation-window flag."""
    age = elapsed_days(ref, signup)
    return df.withColumns({
        "account_age_days": age,
        "subscription_tenure_days": elapsed_days(ref, plan_start),
        "is_new_account": (age < new_days).cast("int"),
        "cohort": F.when(age < 30, "<30").when(age <= 90, "30-90").when(age > 90, ">90"),
        "observable": (age >= observe_days).cast("int"),
    })


def engagement(df: DataFrame, means: Sequence[str], stds: Sequence[str], low: float = 0.25) -> DataFrame:
    """Sum of mean-usage columns, mean of spread columns, and a flag for the lowest quarter."""
    total = sum((F.coalesce(dbl(c), F.lit(0.0)) for c in means), F.lit(0.0))
    seen = sum((dbl(c).isNotNull().cast("int") for c in stds), F.lit(0))
    spread = sum((F.coalesce(dbl(c), F.lit(0.0)) for c in stds), F.lit(0.0))
    out = df.withColumns({"engagement_score": total, "usage_variability": F.try_divide(spread, seen.cast("double"))})
    cut_at = quantile_values(out, ["engagement_score"], [low])["engagement_score"][0]
    return out.withColumn("is_low_usage", (F.col("engagement_score") < F.lit(cut_at)).cast("int"))


def support_flags(df: DataFrame, tickets: str = "ticket_count", satisfaction: str = "avg_satisfaction") -> DataFrame:
    """Any tickets, above-median volume, bottom-quarter satisfaction."""
    q = quantile_values(df, [tickets, satisfaction], [0.25, 0.5])
    mid, low = q[tickets][1], q[satisfaction][0]

    def flag(c: Column) -> Column:
        return F.coalesce(c, F.lit(False)).cast("int")

    return df.withColumns({
        "has_support_tickets": flag(F.col(tickets) > 0),
        "is_high_ticket_volume": flag(F.col(tickets) > F.lit(mid)),
        "is_low_satisfaction": flag(F.col(satisfaction) < F.lit(low)),
    })


def value_flags(df: DataFrame, mrr: str = "mrr_amount", key: str | None = None) -> DataFrame:
    """Quartile revenue segment and a flag for the top quarter."""
    edges = segment_edges(df, mrr, 4)
    out = quantile_segment(df, mrr, QUARTERS, "revenue_band", key=key, edges=edges)
    return out.withColumn("is_high_value", F.coalesce(F.col(mrr) > F.lit(edges[3]), F.lit(False)).cast("int"))


def relative_usage(df: DataFrame, usage: str, industry: str, name: str = "relative_usage") -> DataFrame:
    """Usage over the industry's average.

    The averages are aggregated first (map-side combined), counted, and joined
    back without moving the accounts: one industry may hold a large share of
    them, and a window would gather it in one task.
    """
    means = df.groupBy(industry).agg(F.avg(dbl(usage)).alias("__mean"))
    return df.join(small_side(means), industry, "left").withColumn(name, ratio(usage, "__mean")).drop("__mean")


def interactions(df: DataFrame, pairs: Mapping[str, tuple[str, str]], ratios: Mapping[str, tuple[str, str]] = {}) -> DataFrame:
    """Products and quotients of feature pairs."""
    return df.withColumns({n: dbl(a) * dbl(b) for n, (a, b) in pairs.items()}
                          | {n: ratio(a, b) for n, (a, b) in ratios.items()})


def default_alerts() -> dict[str, Column]:
    """The documented alert triggers over the feature columns."""
    return {
        "usage_drop": F.col("usage_trend") < -0.3,
        "inactive": F.col("days_since_last_activity") > 14,
        "short_tenure": F.col("tenure_months") <= 3,
        "low_satisfaction": F.col("avg_satisfaction") < 3,
        "low_adoption": F.col("unique_features_used") < 3,
        "near_renewal": F.col("days_to_renewal") < 30,
    }


def alert_rules(df: DataFrame, key: str, rules: Mapping[str, Column] | None = None) -> DataFrame:
    """One row per account and triggered rule."""
    rules = rules or default_alerts()
    fired = F.array_compact(F.array(*[F.when(c, F.lit(n)) for n, c in rules.items()]))
    return df.select(key, F.explode(fired).alias("alert"))


def heuristic_baseline(df: DataFrame, tickets_30d: str, usage_drop: str, tickets: float = 3, drop: float = 0.5,
                       name: str = "prediction") -> DataFrame:
    """Business rule: many recent tickets and a large usage drop."""
    return df.withColumn(name, F.coalesce((F.col(tickets_30d) > tickets) & (F.col(usage_drop) > drop), F.lit(False)).cast("int"))


def monthly_trend(acc: DataFrame, events: DataFrame, key: str, signup: str, label: str, ts: str) -> DataFrame:
    """Per calendar month: signups, label rate of those signups, accounts active. Rows without the date belong to no month."""
    joined = acc.where(F.col(signup).isNotNull()).groupBy(F.date_trunc("month", F.col(signup)).cast("date").alias("month")).agg(
        F.count(F.lit(1)).alias("signups"), F.avg(dbl(label)).alias("label_rate"))
    active = events.where(F.col(ts).isNotNull()).groupBy(F.date_trunc("month", F.col(ts)).cast("date").alias("month")).agg(
        F.count_distinct(key).alias("active_accounts"))
    return joined.join(active, "month", "full").select(
        "month", F.coalesce("signups", F.lit(0)).alias("signups"),
        F.coalesce("active_accounts", F.lit(0)).alias("active_accounts"), "label_rate")
