"""Cleaning: types, missing values, duplicates, outliers, column contracts.

Functions that learn something from the data split into ``*_fit`` (one or two
scans, a bounded set of numbers) and ``*_apply`` (plain expressions), so a fit
on the training rows can be applied to any other table.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import clip, dbl, numeric_columns, ratio, string_columns
from .ordering import quantile_values
from .quality import null_shares, wide_to_rows

# Columns known only after the outcome.
LEAKAGE_COLUMNS = [
    "end_date",
    "churn_date",
    "reason_code",
    "refund_amount_usd",
    "preceding_upgrade_flag",
    "preceding_downgrade_flag",
    "feedback_text",
    "churn_event_id",
    "closed_at",
]


def drop_leakage(df: DataFrame, cols: Sequence[str] = LEAKAGE_COLUMNS, extra: Sequence[str] = ()) -> DataFrame:
    """Drop the post-outcome columns that are present."""
    return df.drop(*[c for c in [*cols, *extra] if c in df.columns])


def rename_prefixed(df: DataFrame, cols: Sequence[str], prefix: str = "sub_") -> DataFrame:
    """Prefix colliding column names before a join."""
    return df.withColumnsRenamed({c: f"{prefix}{c}" for c in cols if c in df.columns})


def convert_types(df: DataFrame, dates: Sequence[str] | None = None, ints: Sequence[str] = (),
                  strings: Sequence[str] = ()) -> DataFrame:
    """Bad dates and bad numbers become NULL.

    Without an explicit list, every string column whose name contains ``_date``
    or ``_at`` is parsed as a timestamp.
    """
    if dates is None:
        dates = [f.name for f in df.schema.fields
                 if isinstance(f.dataType, T.StringType) and ("_date" in f.name or "_at" in f.name)]
    changes: dict[str, Column] = {c: F.try_to_timestamp(F.col(c).cast("string")) for c in dates if c in df.columns}
    changes |= {c: F.col(c).try_cast("double").try_cast("int") for c in ints if c in df.columns}
    changes |= {c: F.col(c).cast("string") for c in strings if c in df.columns}
    return df.withColumns(changes) if changes else df


def sparse_columns(df: DataFrame, max_null: float = 0.6, keep: Sequence[str] = ()) -> list[str]:
    """Columns whose NULL share exceeds ``max_null``."""
    return [c for c, share in null_shares(df).items() if share > max_null and c not in keep]


def drop_sparse(df: DataFrame, max_null: float = 0.6, keep: Sequence[str] = ()) -> DataFrame:
    return df.drop(*sparse_columns(df, max_null, keep))


def missing_indicators(df: DataFrame, min_null: float = 0.01, cols: Sequence[str] | None = None) -> DataFrame:
    """``is_missing_<c>`` for columns with a NULL share above ``min_null``; run before imputing."""
    marked = [c for c, share in null_shares(df, cols).items() if share > min_null]
    return df.withColumns({f"is_missing_{c}": F.col(c).isNull().cast("int") for c in marked}) if marked else df


def numeric_fill_fit(df: DataFrame, cols: Sequence[str], strategy: str = "median") -> dict[str, float | None]:
    """Fill value per column: exact median, mean or zero."""
    cols = list(cols)
    if strategy == "zero":
        return {c: 0.0 for c in cols}
    if strategy == "mean":
        row = df.agg(*[F.avg(dbl(c)).alias(c) for c in cols]).first()
        return {c: row[c] for c in cols}
    if strategy == "median":
        return {c: v[0] for c, v in quantile_values(df, cols, [0.5]).items()}
    raise ValueError(f"unknown strategy {strategy!r}")


def numeric_fill_apply(df: DataFrame, fills: Mapping[str, float | None]) -> DataFrame:
    return df.withColumns({c: F.coalesce(dbl(c), F.lit(v)) for c, v in fills.items() if v is not None})


def impute_numeric(df: DataFrame, cols: Sequence[str] | None = None, strategy: str = "median",
                   exclude: Sequence[str] = ()) -> DataFrame:
    """Fill numeric NULLs (integers turn into doubles, as fill values may be fractions)."""
    cols = list(cols) if cols is not None else numeric_columns(df, exclude)
    return numeric_fill_apply(df, numeric_fill_fit(df, cols, strategy))


def value_counts(df: DataFrame, cols: Sequence[str], name: str = "feature", value: str = "value") -> DataFrame:
    """(column, value, count) of the non-null values of several string columns, one shuffle."""
    cells = F.array(*[F.struct(F.lit(c).alias(name), F.col(c).cast("string").alias(value)) for c in cols])
    return (df.select(F.explode(cells).alias("e")).select("e.*").where(F.col(value).isNotNull())
            .groupBy(name, value).agg(F.count(F.lit(1)).alias("n")))


def categorical_fill_fit(df: DataFrame, cols: Sequence[str], strategy: str = "mode", unknown: str = "Unknown") -> dict[str, str]:
    """Most frequent value per column, ties to the smallest; ``unknown`` when there is none."""
    if strategy == "unknown" or not cols:
        return {c: unknown for c in cols}
    best = (value_counts(df, cols).groupBy("feature")
            .agg(F.min(F.struct((-F.col("n")).alias("k"), F.col("value"))).alias("m"))
            .select("feature", "m.value"))
    found = {r["feature"]: r["value"] for r in best.collect()}
    return {c: found.get(c, unknown) for c in cols}


def impute_categorical(df: DataFrame, cols: Sequence[str] | None = None, strategy: str = "mode",
                       unknown: str = "Unknown") -> DataFrame:
    cols = list(cols) if cols is not None else string_columns(df)
    fills = categorical_fill_fit(df, cols, strategy, unknown)
    return df.withColumns({c: F.coalesce(F.col(c), F.lit(v)) for c, v in fills.items()})


def imputation_log(df: DataFrame, numeric: Sequence[str], categorical: Sequence[str], strategy: str = "median",
                   cat_strategy: str = "mode", fitted: tuple[Mapping, Mapping] | None = None) -> DataFrame:
    """column, strategy, fill value and number of filled rows, for columns with NULLs; ``fitted`` are fill values found before (numeric, categorical)."""
    numbers, texts = fitted if fitted is not None else (numeric_fill_fit(df, numeric, strategy), categorical_fill_fit(df, categorical, cat_strategy))
    fills = [(c, strategy, v) for c, v in numbers.items()] + [(c, cat_strategy, v) for c, v in texts.items()]
    one = df.agg(*[F.count_if(F.col(c).isNull()).alias(f"m{i}") for i, (c, _, _) in enumerate(fills)])
    return wide_to_rows(one, [
        {"column_name": F.lit(c), "strategy": F.lit(s),
         "fill_number": F.lit(None if isinstance(v, str) else v).cast("double"),
         "fill_text": F.lit(v if isinstance(v, str) else None).cast("string"),
         "rows_filled": F.col(f"m{i}")} for i, (c, s, v) in enumerate(fills)]).where(F.col("rows_filled") > 0)


def fill_by_role(df: DataFrame, flags: Sequence[str] = (), cats: Sequence[str] = ()) -> DataFrame:
    """Flags: NULL to 0 as integer; categories: NULL to ``unknown`` as string."""
    return df.withColumns(
        {c: F.coalesce(F.col(c).cast("int"), F.lit(0)) for c in flags if c in df.columns}
        | {c: F.coalesce(F.col(c).cast("string"), F.lit("unknown")) for c in cats if c in df.columns})


def dedup_last(df: DataFrame, key: str | Sequence[str], order: Sequence[str]) -> DataFrame:
    """One row per key: the greatest by ``order`` (NULLs lose), the rest of the row decides ties.

    A max over row structs combines before the shuffle, so a key with a huge
    number of copies costs one row per task.
    """
    keys = [key] if isinstance(key, str) else list(key)
    rest = [c for c in df.columns if c not in keys]
    rank = F.struct(*order, *[c for c in rest if c not in order])
    return (df.groupBy(*keys).agg(F.max_by(F.struct(*rest), rank).alias("r"))
            .select(*keys, *[F.col("r")[c].alias(c) for c in rest]).select(*df.columns))


def remove_duplicates(df: DataFrame) -> DataFrame:
    """Fully identical rows collapse to one."""
    return df.dropDuplicates()


def iqr_fit(df: DataFrame, cols: Sequence[str], m: float = 1.5) -> dict[str, tuple[float, float, float, float]]:
    """(q1, q3, lower bound, upper bound) per column; columns without spread are left out."""
    out = {}
    for c, (q1, q3) in quantile_values(df, cols, [0.25, 0.75]).items():
        if q1 is not None and q3 > q1:
            out[c] = (q1, q3, q1 - m * (q3 - q1), q3 + m * (q3 - q1))
    return out


def iqr_winsorize(df: DataFrame, cols: Sequence[str], m: float = 1.5, fitted: Mapping | None = None) -> DataFrame:
    """Cap values at the IQR fences. The caller leaves flags, ids and the label out of ``cols``."""
    fences = fitted if fitted is not None else iqr_fit(df, cols, m)
    return df.withColumns({c: clip(dbl(c), lo, hi) for c, (_, _, lo, hi) in fences.items()})


def iqr_report(df: DataFrame, cols: Sequence[str], m: float = 1.5, fitted: Mapping | None = None) -> DataFrame:
    """Quartiles, fences, counts outside and the range before and after capping.

    A column without spread keeps its quartiles as fences and has nothing outside, as nothing is capped there; one
    without values has NULLs and zero counts.
    """
    fences = dict(fitted) if fitted is not None else iqr_fit(df, cols, m)
    flat = [c for c in cols if c not in fences]
    fences |= {c: (q1, q3, None, None) for c, (q1, q3) in quantile_values(df, flat, [0.25, 0.75]).items()}

    def number(v: float | None) -> Column:
        return F.lit(v).cast("double")

    aggs = []
    for i, (c, (_, _, lo, hi)) in enumerate(fences.items()):
        x = dbl(c)
        aggs += [F.count(x).alias(f"n{i}"), F.count_if(x < number(lo)).alias(f"b{i}"), F.count_if(x > number(hi)).alias(f"a{i}"),
                 F.min(x).alias(f"l{i}"), F.max(x).alias(f"h{i}")]
    return wide_to_rows(df.agg(*aggs), [
        {"column_name": F.lit(c), "q1": number(q1), "q3": number(q3), "iqr": number(q3) - number(q1),
         "lower_bound": F.coalesce(number(lo), number(q1)), "upper_bound": F.coalesce(number(hi), number(q3)), "n_below": F.col(f"b{i}"), "n_above": F.col(f"a{i}"),
         "pct_outside": ratio((F.col(f"a{i}") + F.col(f"b{i}")) * 100, F.col(f"n{i}")),
         "original_min": F.col(f"l{i}"), "original_max": F.col(f"h{i}"),
         "capped_min": F.col(f"l{i}") if lo is None else clip(F.col(f"l{i}"), lo, hi),
         "capped_max": F.col(f"h{i}") if lo is None else clip(F.col(f"h{i}"), lo, hi)}
        for i, (c, (q1, q3, lo, hi)) in enumerate(fences.items())])


def percentile_clip(df: DataFrame, cols: Sequence[str], lo: float = 0.01, hi: float = 0.99,
                    fitted: Mapping[str, Sequence[float]] | None = None) -> DataFrame:
    """Clip to the given percentiles, fitted here or taken from another table."""
    limits = fitted if fitted is not None else quantile_values(df, cols, [lo, hi])
    return df.withColumns({c: clip(dbl(c), a, b) for c, (a, b) in limits.items() if a is not None})


def align_features(df: DataFrame, expected: Sequence[str], keep: Sequence[str] = ()) -> DataFrame:
    """Exactly the contracted columns in order: absent ones are 0, surplus ones are dropped."""
    return df.select(*keep, *[F.col(c) if c in df.columns else F.lit(0.0).alias(c) for c in expected])


# Columns of the base table that never become features.
NON_FEATURES = [
    "account_id", "account_name", "subscription_id", "signup_date", "start_date", "end_date",
    "last_activity_date", "first_activity_date", "last_ticket_date",
    "sub_churn_flag", "sub_is_trial", "sub_plan_tier", "sub_seats", "arr_amount",
]


def feature_matrix(df: DataFrame, label: str = "churn_flag", exclude: Sequence[str] = NON_FEATURES,
                   key: str | None = None) -> DataFrame:
    """Features and label in one table (never aligned by position), optionally with the key.

    Ids, post-outcome columns and every date-typed or date-named column go.
    """
    gone = set(exclude) | {f.name for f in df.schema.fields
                           if isinstance(f.dataType, (T.DateType, T.TimestampType, T.TimestampNTZType))
                           or "date" in f.name.lower()}
    features = [c for c in df.columns if c not in gone and c not in (label, key)]
    return df.select(*([key] if key else []), *features, F.col(label).cast("int").alias(label))


def split_protected(df: DataFrame, key: str, cols: Sequence[str]) -> tuple[DataFrame, DataFrame]:
    """(table without the protected columns, key plus protected columns)."""
    present = [c for c in cols if c in df.columns]
    return df.drop(*present), df.select(key, *present)


def membership_flag(df: DataFrame, other: DataFrame, key: str, name: str) -> DataFrame:
    """1 where the key occurs in ``other``, else 0; row count is unchanged."""
    keys = other.select(F.col(key).alias("__k")).where(F.col("__k").isNotNull()).distinct()
    return df.join(keys, F.col(key) == F.col("__k"), "left").withColumn(
        name, F.col("__k").isNotNull().cast("int")).drop("__k")


def filter_matching(df: DataFrame, column: str, pattern: str) -> DataFrame:
    """Rows whose text contains a match, ignoring case."""
    return df.where(F.col(column).rlike(f"(?i){pattern}"))
