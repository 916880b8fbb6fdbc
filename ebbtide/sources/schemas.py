"""Declared schemas of the five raw tables and of the scoring audit log."""

from __future__ import annotations

from pyspark.sql import types as T

_S, _I, _D = T.StringType(), T.IntegerType(), T.DoubleType()


def _schema(**fields: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(n, t) for n, t in fields.items()])


# Column names and types of the raw tables. Dates stay text until conversion.
ACCOUNTS = _schema(
    account_id=_S, account_name=_S, industry=_S, country=_S, signup_date=_S, referral_source=_S,
    plan_tier=_S, seats=_I, is_trial=_I, churn_flag=_I)
SUBSCRIPTIONS = _schema(
    subscription_id=_S, account_id=_S, start_date=_S, end_date=_S, plan_tier=_S, seats=_I,
    mrr_amount=_D, arr_amount=_D, is_trial=_I, upgrade_flag=_I, downgrade_flag=_I, churn_flag=_I,
    billing_frequency=_S, auto_renew_flag=_I)
FEATURE_USAGE = _schema(
    usage_id=_S, subscription_id=_S, usage_date=_S, feature_name=_S, usage_count=_I,
    usage_duration_secs=_D, error_count=_I, is_beta_feature=_I)
SUPPORT_TICKETS = _schema(
    ticket_id=_S, account_id=_S, submitted_at=_S, closed_at=_S, resolution_time_hours=_D, priority=_S,
    first_response_time_minutes=_D, satisfaction_score=_D, escalation_flag=_I)
CHURN_EVENTS = _schema(
    churn_event_id=_S, account_id=_S, churn_date=_S, reason_code=_S, refund_amount_usd=_D,
    preceding_upgrade_flag=_I, preceding_downgrade_flag=_I, is_reactivation=_I, feedback_text=_S)

TABLES = {
    "accounts": ACCOUNTS,
    "subscriptions": SUBSCRIPTIONS,
    "feature_usage": FEATURE_USAGE,
    "support_tickets": SUPPORT_TICKETS,
    "churn_events": CHURN_EVENTS,
}

# What each column must satisfy.
TYPE_RULES = {
    "accounts": {"seats": "numeric", "is_trial": "binary_int", "churn_flag": "binary_int", "signup_date": "date_parseable"},
    "subscriptions": {"mrr_amount": "numeric", "arr_amount": "numeric", "seats": "numeric", "is_trial": "binary_int",
                      "churn_flag": "binary_int", "start_date": "date_parseable"},
    "feature_usage": {"usage_count": "numeric", "usage_duration_secs": "numeric", "error_count": "numeric",
                      "usage_date": "date_parseable"},
    "support_tickets": {"resolution_time_hours": "numeric", "first_response_time_minutes": "numeric",
                        "satisfaction_score": "numeric", "submitted_at": "date_parseable"},
    "churn_events": {"refund_amount_usd": "numeric", "churn_date": "date_parseable"},
}

JOIN_KEYS = {
    "accounts": "account_id",
    "subscriptions": "account_id",
    "feature_usage": "subscription_id",
    "support_tickets": "account_id",
    "churn_events": "account_id",
}

AUDIT = T.StructType([
    T.StructField("timestamp", T.TimestampType()),
    T.StructField("customer_id", _S),
    T.StructField("probability", _D),
    T.StructField("protected_attributes", _schema(age_group=_S, region=_S)),
    T.StructField("risk_tier", _S),
])
