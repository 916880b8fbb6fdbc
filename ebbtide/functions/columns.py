"""Column-level building blocks. All of them stay inside the JVM."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

SECONDS_PER_DAY = 86400


def col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def dbl(c: Column | str) -> Column:
    return col(c).cast("double")


def no_nan(c: Column | str) -> Column:
    """NaN becomes NULL, everything else is unchanged."""
    c = dbl(c)
    return F.when(~F.isnan(c), c)


def elapsed_days(later: Column | str, earlier: Column | str) -> Column:
    """Whole 24-hour periods between two timestamps (floor, not calendar days)."""
    seconds = epoch_seconds(later) - epoch_seconds(earlier)
    return F.floor(seconds / F.lit(float(SECONDS_PER_DAY)))


def epoch_seconds(c: Column | str) -> Column:
    """Seconds since 1970 with the fraction kept, for any date or timestamp type."""
    return F.unix_micros(col(c).cast("timestamp")) / F.lit(1e6)


def ratio(a: Column | str, b: Column | str) -> Column:
    """a / b, NULL when b is zero (ANSI division would raise)."""
    return F.try_divide(dbl(a), dbl(b))


def ratio_or_zero(a: Column | str, b: Column | str) -> Column:
    return F.coalesce(ratio(a, b), F.lit(0.0))


def floor_ratio(a: Column | str, b: Column | str, at_least: float = 1.0) -> Column:
    """a / max(b, at_least); NULL stays NULL on both sides."""
    b = dbl(b)
    return dbl(a) / F.when(b.isNotNull(), F.greatest(b, F.lit(float(at_least))))


def clip(c: Column, lo: Column | float | None = None, hi: Column | float | None = None) -> Column:
    """Clamp to [lo, hi] while keeping NULL (greatest/least alone would skip it)."""
    out = c
    if lo is not None:
        out = F.greatest(out, lo if isinstance(lo, Column) else F.lit(float(lo)))
    if hi is not None:
        out = F.least(out, hi if isinstance(hi, Column) else F.lit(float(hi)))
    return F.when(c.isNotNull(), out)


def cut(c: Column, edges: Sequence[float], labels: Sequence, lowest: bool = False) -> Column:
    """Right-closed bins ``(e0, e1], (e1, e2], ...``; outside every bin gives NULL.

    ``edges`` has one entry more than ``labels``; use ``float('-inf')`` and
    ``float('inf')`` for open ends. ``lowest`` also admits the first edge itself.
    """
    if len(edges) != len(labels) + 1:
        raise ValueError("need one more edge than labels")
    lo, hi = float(edges[0]), float(edges[-1])
    inside = c.isNotNull()
    if lo != float("-inf"):
        inside = inside & ((c >= F.lit(lo)) if lowest else (c > F.lit(lo)))
    branch = F.when(~inside, F.lit(None))
    for upper, label in zip(edges[1:], labels):
        if float(upper) == float("inf"):
            return branch.otherwise(F.lit(label))
        branch = branch.when(c <= F.lit(float(upper)), F.lit(label))
    return branch


def pearson(x: Column | str, y: Column | str) -> Column:
    """Aggregate: Pearson r over complete pairs, NULL when a side is constant."""
    x, y = dbl(x), dbl(y)
    xs, ys = F.when(y.isNotNull(), x), F.when(x.isNotNull(), y)
    return F.try_divide(F.covar_pop(xs, ys), F.stddev_pop(xs) * F.stddev_pop(ys))


def sample_skewness(c: Column | str) -> Column:
    """Aggregate: bias-corrected skewness (NULL below three values or for a constant)."""
    c = dbl(c)
    n = F.count(c).cast("double")
    g1 = F.when(F.stddev_pop(c) > 0, F.skewness(c))
    return F.try_divide(g1 * F.sqrt(n * (n - 1)), F.when(n > 2, n - 2))


def is_numeric(t: T.DataType) -> bool:
    return isinstance(t, T.NumericType)


def numeric_columns(df: DataFrame, exclude: Sequence[str] = ()) -> list[str]:
    """Numeric columns by schema; booleans are not numeric here."""
    return [f.name for f in df.schema.fields if is_numeric(f.dataType) and f.name not in exclude]


def string_columns(df: DataFrame, exclude: Sequence[str] = ()) -> list[str]:
    return [f.name for f in df.schema.fields
            if isinstance(f.dataType, T.StringType) and f.name not in exclude]
