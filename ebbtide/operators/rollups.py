"""Latest rows, roll-ups and the joins of the analytical base table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import dbl, numeric_columns, ratio
from .ordering import small_side


def latest_per_key(df: DataFrame, key: str, order: str, tiebreak: str, stitch: bool = False) -> DataFrame:
    """The newest row of each key; undated rows lose, ties go to the highest ``tiebreak``.

    ``stitch=True`` takes the newest non-null value of every column instead,
    which may combine several rows. Both are map-side combined aggregates, not
    windows: a key with very many rows costs one partial row per task. Rows with
    a NULL key are left out.
    """
    rest = [c for c in df.columns if c != key]
    rank = F.struct(F.col(order), F.col(tiebreak))
    src = df.where(F.col(key).isNotNull())
    if stitch:
        return src.groupBy(key).agg(*[
            F.max_by(F.col(c), F.when(F.col(c).isNotNull(), rank)).alias(c) for c in rest])
    picked = src.groupBy(key).agg(F.max_by(F.struct(*rest), rank).alias("r"))
    return picked.select(key, *[F.col("r")[c].alias(c) for c in rest])


def two_hop(use: DataFrame, sub: DataFrame, via: str, key: str) -> DataFrame:
    """Give each fact row its account through the subscription map; unmatched facts stay with NULL."""
    return use.join(sub.select(via, key).distinct(), via, "left")


USAGE = ("usage_count", "usage_duration_secs", "error_count")


def usage_rollup(use: DataFrame, key: str = "account_id", sub: DataFrame | None = None, via: str = "subscription_id") -> DataFrame:
    """Eleven usage measures per account. Sums of nothing are 0, rows without a key are left out.

    With ``sub`` the facts reach their accounts through its map from ``via`` to ``key``. Distinct dates and features are counted from facts reduced to
    a row per ``via`` and value before they join, each a narrow scan of its own; no row is multiplied to count two columns' values.
    """
    first = key if sub is None else via
    facts = use.where(F.col(first).isNotNull())
    # The map is written once, so its size is known when the joins are planned.
    owner = None if sub is None else small_side(sub.where(F.col(via).isNotNull() & F.col(key).isNotNull()).select(via, key).distinct())

    def owned(df: DataFrame) -> DataFrame:
        return df if owner is None else df.join(owner, via)

    totals = owned(facts).groupBy(key).agg(
        *[x for c in USAGE for x in (F.sum(dbl(c)).alias(f"s_{c}"), F.count(dbl(c)).alias(f"n_{c}"))],
        F.max("usage_date").alias("hi"), F.min("usage_date").alias("lo"), F.sum(F.col("is_beta_feature").cast("long")).alias("beta"))
    days, features = (owned(facts.select(first, c).distinct()).select(key, c).distinct().groupBy(key).agg(F.count(c).alias(name))
                      for c, name in (("usage_date", "active_days"), ("feature_name", "unique_features_used")))
    total, mean = (lambda c: F.coalesce(f"s_{c}", F.lit(0.0))), (lambda c: ratio(f"s_{c}", f"n_{c}"))
    return totals.join(days, key).join(features, key).select(
        key,
        total("usage_count").alias("total_events"), mean("usage_count").alias("avg_daily_usage"),
        total("usage_duration_secs").alias("total_duration_secs"), mean("usage_duration_secs").alias("avg_duration_secs"),
        total("error_count").alias("total_errors"), mean("error_count").alias("avg_errors"),
        "active_days", F.col("hi").alias("last_activity_date"), F.col("lo").alias("first_activity_date"), "unique_features_used",
        F.coalesce("beta", F.lit(0)).alias("beta_feature_usage"))


def generic_rollup(df: DataFrame, key: str, stats: Sequence[str] = ("mean", "sum", "std"), prefix: str = "usage_",
                   cols: Sequence[str] | None = None, count_as: str | None = None) -> DataFrame:
    """Every numeric column by every statistic, named ``<prefix><column>_<stat>``."""
    fns = {
        "mean": lambda c: F.avg(dbl(c)),
        "sum": lambda c: F.coalesce(F.sum(dbl(c)), F.lit(0.0)),
        "std": lambda c: F.stddev_samp(dbl(c)),
        "min": lambda c: F.min(dbl(c)),
        "max": lambda c: F.max(dbl(c)),
    }
    cols = list(cols) if cols is not None else numeric_columns(df, exclude=[key])
    aggs = [fns[s](c).alias(f"{prefix}{c}_{s}") for c in cols for s in stats]
    if count_as:
        aggs.insert(0, F.count(F.lit(1)).alias(count_as))
    return df.where(F.col(key).isNotNull()).groupBy(key).agg(*aggs)


def ticket_rollup(tic: DataFrame, key: str = "account_id") -> DataFrame:
    """Ticket count, satisfaction, resolution, first response, escalations, last ticket per account."""
    first = F.avg(dbl("first_response_time_minutes")) if "first_response_time_minutes" in tic.columns else F.lit(None).cast("double")
    return tic.where(F.col(key).isNotNull()).groupBy(key).agg(
        F.count("ticket_id").alias("ticket_count"),
        F.avg(dbl("satisfaction_score")).alias("avg_satisfaction"),
        F.min(dbl("satisfaction_score")).alias("min_satisfaction"),
        F.avg(dbl("resolution_time_hours")).alias("avg_resolution_hours"),
        first.alias("avg_first_response_min"),
        F.coalesce(F.sum(F.col("escalation_flag").cast("long")), F.lit(0)).alias("escalation_count"),
        F.max("submitted_at").alias("last_ticket_date"))


def attach(base: DataFrame, *facts: DataFrame, key: str = "account_id") -> DataFrame:
    """Left-join tables that already have one row per key; unmatched accounts get NULL."""
    out = base
    for f in facts:
        out = out.join(f, key, "left")
    return out
