"""Feature plans: config-driven engineering of a flat customer table and of the base table."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators import features as f

# Which raw column plays which role in the flat customer table.
FLAT_ROLES = {
    "tenure_start": "subscription_start_date",
    "tenure_ref": "reference_date",
    "last_activity": "last_activity_date",
    "usage_total": "total_events",
    "usage_days": "active_days",
    "usage_l30": "usage_last_30d",
    "usage_p30": "usage_prev_30d",
    "seats_purchased": "seats_purchased",
    "seats_active": "seats_active",
    "features_avail": "features_available",
    "features_used": "features_used",
    "tickets_total": "total_tickets",
    "tickets_open": "open_tickets",
    "mrr": "mrr",
    "near_renewal_days": "contract_renewal_days",
}
MODULE_FLAGS = ["module_1_active", "module_2_active", "module_3_active", "module_4_active", "module_5_active"]
MONTH_LABELS = ["0-3m", "3-6m", "6-12m", "12+m"]


def engineer_features(df: DataFrame, roles: Mapping[str, str] = FLAT_ROLES, modules: Sequence[str] = MODULE_FLAGS,
                      key: str | None = None, mrr_edges: Sequence[float] | None = None) -> DataFrame:
    """All derived features of a flat customer table; pass ``mrr_edges`` fitted on train to score other rows."""
    out = f.tenure_features(df, roles["tenure_start"], F.col(roles["tenure_ref"]))
    out = f.recency_days(out, roles["last_activity"], F.col(roles["tenure_ref"]))
    out = f.near_renewal(out, roles["near_renewal_days"])
    out = f.usage_features(out, roles["usage_total"], roles["usage_days"], roles["usage_l30"], roles["usage_p30"])
    out = f.safe_ratio(out, roles["seats_active"], roles["seats_purchased"], "seat_utilization")
    out = f.safe_ratio(out, roles["features_used"], roles["features_avail"], "feature_adoption_rate")
    out = f.weighted_flags(out, modules)
    out = f.support_rate(out, roles["tickets_total"])
    out = f.safe_ratio(out, roles["tickets_open"], roles["tickets_total"], "unresolved_ticket_ratio")
    out = f.safe_ratio(out, roles["mrr"], roles["seats_purchased"], "revenue_per_seat")
    return f.quantile_segment(out, roles["mrr"], key=key, edges=mrr_edges)


def engineer_bank(df: DataFrame, key: str, balance: str = "Balance", years: str = "Tenure", active: str = "IsActiveMember") -> DataFrame:
    """The second domain: years to months, an activity flag as usage, no renewals; zero balances force rank segments."""
    out = f.map_features(df, {"tenure_months": F.col(years) * 12, "usage_intensity": F.col(active), "near_renewal": F.lit(0)})
    return f.quantile_segment(out, balance, key=key)


def abt_features(abt: DataFrame, ref: Column | None = None, key: str = "account_id", annual_values: Sequence[str] = ("annual",)) -> DataFrame:
    """Features of the base table. The reference date defaults to the latest date seen in it."""
    if ref is None:
        ref = abt.agg(F.greatest(F.max("last_activity_date"), F.max("start_date"), F.max("signup_date")).alias("m")).scalar()
    out = f.tenure_features(abt, "signup_date", ref)
    out = f.bucketize(out, "tenure_months", f.TENURE_EDGES, MONTH_LABELS, "tenure_bucket")
    out = f.usage_features(out, "total_events", "active_days")
    out = f.recency_days(out, "last_activity_date", ref)
    out = f.renewal_from_cycle(out, "start_date", "billing_frequency", ref, annual_values=annual_values)
    return f.quantile_segment(out, "mrr_amount", key=key)
