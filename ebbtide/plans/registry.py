"""Where the query modules put their queries and SQL counterparts."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .views import with_views

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def query(name: str, sql: str | None = None, *ctes: str, digits: int | None = 6):
    """Register a query; computed doubles are rounded to ``digits`` so both engines can be compared."""
    def put(fn):
        def run(spark: SparkSession, folder: str) -> DataFrame:
            out = fn(spark, folder)
            return rounded(out, digits) if digits is not None else out
        run.__name__ = name
        run.defined_in = fn.__module__
        run.__doc__ = fn.__doc__
        QUERIES[name] = run
        if sql is not None:
            ORACLE[name] = with_views(sql, *ctes)
        return fn
    return put


def rounded(df: DataFrame, digits: int = 6) -> DataFrame:
    doubles = {f.name for f in df.schema.fields if isinstance(f.dataType, (T.DoubleType, T.FloatType))}
    return df.select(*[F.round(F.col(f"`{c}`"), digits).alias(c) if c in doubles else F.col(f"`{c}`") for c in df.columns])


def as_text(df: DataFrame, *cols: str) -> DataFrame:
    """Timestamps as text, the same on both sides."""
    return df.withColumns({c: F.date_format(c, "yyyy-MM-dd HH:mm:ss") for c in cols})
