"""The analytical base table: one row per account, one label, one lazy plan."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import numeric_columns, string_columns
from ..operators.clean import (convert_types, drop_leakage, impute_categorical, impute_numeric, iqr_winsorize,
                               membership_flag, rename_prefixed)
from ..operators.rollups import attach, latest_per_key, ticket_rollup, usage_rollup
from ..session import staged

COLLIDING = ["plan_tier", "seats", "is_trial", "churn_flag"]


def build_abt(acc: DataFrame, sub: DataFrame, use: DataFrame, tic: DataFrame, churn_events: DataFrame | None = None,
              label: str = "churn_flag", stitch: bool = False) -> DataFrame:
    """Accounts with their latest subscription, usage and ticket measures.

    Facts are reduced to one row per account before any join, so no join fans
    out. With ``churn_events`` the label is membership in that table, otherwise
    the accounts' own flag (NULL counts as 0).
    """
    latest = rename_prefixed(latest_per_key(sub, "account_id", "start_date", "subscription_id", stitch), COLLIDING)
    usage = usage_rollup(use, "account_id", sub)
    abt = drop_leakage(attach(acc, latest, usage, ticket_rollup(tic)))
    if churn_events is not None:
        return membership_flag(abt.drop(label), churn_events, "account_id", label)
    return abt.withColumn(label, F.coalesce(F.col(label).cast("int"), F.lit(0)))


def clean_abt(abt: DataFrame, label: str = "churn_flag", ids: tuple[str, ...] = ("account_id", "subscription_id"),
              flags: tuple[str, ...] = (), m: float = 1.5, zero_fill: tuple[str, ...] = (), stage: bool = True) -> DataFrame:
    """Dates typed, NULLs imputed (median, mode), outliers capped.

    The base table is written once before the statistics passes: they then scan
    it instead of repeating the joins.
    """
    df = staged(abt) if stage else abt
    df = convert_types(df)
    if zero_fill:
        df = df.fillna(0, subset=list(zero_fill))
    skip = {label, *ids, *flags}
    numeric = numeric_columns(df, skip)
    df = impute_numeric(df, numeric)
    df = impute_categorical(df, [c for c in string_columns(df) if c not in ids])
    return iqr_winsorize(df, numeric, m)
