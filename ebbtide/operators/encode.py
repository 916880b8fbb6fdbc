"""Encodings and scaling. Fit and apply are separate: fit on train, apply anywhere."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.ml.feature import OneHotEncoder, VectorAssembler
from pyspark.ml.functions import array_to_vector
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import dbl
from ..session import staged
from .clean import value_counts
from .ordering import small_side, sorted_codes


def label_encode_fit(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """(feature, value, code): codes follow sorted value order, from 0, per column."""
    distinct = value_counts(df, cols).select("feature", "value")
    return sorted_codes(distinct, "value", by=["feature"]).select("feature", "value", "code")


def label_encode_apply(df: DataFrame, mapping: DataFrame, cols: Sequence[str], suffix: str = "_code") -> DataFrame:
    """Adds ``<c>_code``; a value unseen in the fit gets NULL.

    One left join per column: a mapping counted as small is broadcast, a larger
    one is joined by shuffle.
    """
    out = df
    for c in cols:
        side = mapping.where(F.col("feature") == c).select(F.col("value").alias(f"__v_{c}"), F.col("code").alias(f"{c}{suffix}"))
        out = out.join(small_side(side), F.col(c).cast("string") == F.col(f"__v_{c}"), "left").drop(f"__v_{c}")
    return out


#: Levels that a column may have to become columns.
MOST_LEVELS = 1000


def levels(df: DataFrame, cols: Sequence[str], most: int = MOST_LEVELS) -> dict[str, list[str]]:
    """Sorted distinct values per column; each becomes an output column. A column with more than ``most`` fails: ``one_hot_vector`` has no such limit."""
    line = Window.partitionBy("feature").orderBy("value")
    # Spark keeps no more than that many per column and task before it shuffles.
    first = value_counts(df, cols).select("feature", "value", F.row_number().over(line).alias("__at")).where(F.col("__at") <= most + 1)
    found: dict[str, list[str]] = {c: [] for c in cols}
    for r in first.collect():
        found[r["feature"]].append(r["value"])
    wide = [c for c, v in found.items() if len(v) > most]
    if wide:
        raise ValueError(f"more than {most} levels to make columns of: {wide}")
    return {c: sorted(v) for c, v in found.items()}


def one_hot_apply(df: DataFrame, fitted: Mapping[str, Sequence[str]], drop: bool = True) -> DataFrame:
    """One 0/1 column per level, no level dropped; an unseen value is all zeros."""
    new = {f"{c}_{v}": F.coalesce(F.col(c).cast("string") == F.lit(v), F.lit(False)).cast("int")
           for c, vs in fitted.items() for v in vs}
    out = df.withColumns(new) if new else df
    return out.drop(*fitted) if drop else out


def one_hot(df: DataFrame, cols: Sequence[str], drop: bool = True) -> DataFrame:
    return one_hot_apply(df, levels(df, cols), drop)


def one_hot_slots(df: DataFrame, cols: Sequence[str], name: str = "slots") -> DataFrame:
    """The sparse layout of the same encoding, for any number of levels: an array with the position of each column's 1.

    Columns take consecutive ranges of positions in the order of ``cols``, levels sorted within; a NULL has no
    position. The code table is a joined table, never columns or driver data.
    """
    codes = label_encode_fit(df, cols)
    sizes = {r["feature"]: r["n"] for r in codes.groupBy("feature").agg(F.count(F.lit(1)).alias("n")).collect()}
    out = label_encode_apply(df, codes, cols, suffix="__slot")
    slots, start = [], 0
    for c in cols:
        slots.append(F.col(f"{c}__slot") + F.lit(start))
        start += sizes.get(c, 0)
    return out.withColumn(name, F.array_compact(F.array(*slots))).drop(*[f"{c}__slot" for c in cols])


def one_hot_vector(df: DataFrame, cols: Sequence[str], codes: DataFrame | None = None, name: str = "one_hot") -> tuple[DataFrame, DataFrame]:
    """(``df`` plus one sparse vector of all columns' levels, the dictionary feature, value, code) for any number of levels.

    ``codes`` from an earlier fit are applied as they are. A value without a code, and NULL, leaves its column's part empty. The dictionary is a joined table;
    only each column's number of levels is known here, as the size of its part.
    """
    codes = staged(label_encode_fit(df, cols)) if codes is None else codes
    sizes = {r["feature"]: r["n"] for r in codes.groupBy("feature").agg(F.count(F.lit(1)).alias("n")).collect()}
    out = label_encode_apply(df, codes, cols, suffix="__at")
    known = [c for c in cols if sizes.get(c)]
    for c in known:
        # One category more, for what has no code: the encoder drops the last one. Its size is read off the column, not the rows.
        told = {"ml_attr": {"type": "nominal", "name": f"{c}__at", "num_vals": sizes[c] + 1}}
        out = out.withColumn(f"{c}__at", F.coalesce(f"{c}__at", F.lit(sizes[c])).cast("double").alias(f"{c}__at", metadata=told))
    if known:
        parts = [f"{c}__hot" for c in known]
        out = OneHotEncoder(inputCols=[f"{c}__at" for c in known], outputCols=parts, dropLast=True).fit(out).transform(out)
        out = VectorAssembler(inputCols=parts, outputCol=name).transform(out).drop(*parts)
    else:
        out = out.withColumn(name, array_to_vector(F.array().cast("array<double>")))
    return out.drop(*[f"{c}__at" for c in cols]), codes


def cardinality(df: DataFrame, cols: Sequence[str], approx: bool = False) -> dict[str, int]:
    count = F.approx_count_distinct if approx else F.count_distinct
    row = df.agg(*[count(F.col(c)).alias(c) for c in cols]).first()
    return {c: row[c] for c in cols}


def encode_by_cardinality(df: DataFrame, cols: Sequence[str], max_levels: int = 10) -> DataFrame:
    """Few levels become 0/1 columns, many become label codes."""
    counts = cardinality(df, cols)
    few = [c for c in cols if counts[c] <= max_levels]
    many = [c for c in cols if counts[c] > max_levels]
    out = one_hot(df, few) if few else df
    return label_encode_apply(out, label_encode_fit(df, many), many).drop(*many) if many else out


def standardize_fit(df: DataFrame, cols: Sequence[str]) -> dict[str, tuple[float, float]]:
    """(mean, population standard deviation) per column; a constant column keeps scale 1."""
    aggs = [a for i, c in enumerate(cols) for a in (F.avg(dbl(c)).alias(f"m{i}"), F.stddev_pop(dbl(c)).alias(f"s{i}"))]
    row = df.agg(*aggs).first()
    return {c: (row[f"m{i}"] or 0.0, row[f"s{i}"] or 1.0) for i, c in enumerate(cols)}


def standardize_apply(df: DataFrame, fitted: Mapping[str, tuple[float, float]], suffix: str = "") -> DataFrame:
    return df.withColumns({f"{c}{suffix}": (dbl(c) - F.lit(m)) / F.lit(s) for c, (m, s) in fitted.items()})


@dataclass
class ColumnTransform:
    """Numeric columns are scaled, categories one-hot encoded, flags passed, the rest dropped."""

    numeric: list[str]
    categorical: list[str]
    flags: list[str]
    scale: dict[str, tuple[float, float]] = field(default_factory=dict)
    levels: dict[str, list[str]] = field(default_factory=dict)

    def fit(self, df: DataFrame) -> "ColumnTransform":
        self.scale = standardize_fit(df, self.numeric) if self.numeric else {}
        self.levels = levels(df, self.categorical) if self.categorical else {}
        return self

    @property
    def features(self) -> list[str]:
        return [*self.numeric, *[f"{c}_{v}" for c, vs in self.levels.items() for v in vs], *self.flags]

    def apply(self, df: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
        out = one_hot_apply(standardize_apply(df, self.scale), self.levels, drop=False)
        kept = [F.col(k).alias(k) for k in keep]
        return out.select(*kept, *[F.coalesce(dbl(c), F.lit(0.0)).alias(c) for c in self.features])


def column_transform(df: DataFrame, numeric: Sequence[str], categorical: Sequence[str], flags: Sequence[str],
                     keep: Sequence[str] = (), train: DataFrame | None = None) -> DataFrame:
    """Fit on ``train`` (default: the same rows) and apply to ``df``."""
    t = ColumnTransform(list(numeric), list(categorical), list(flags)).fit(df if train is None else train)
    return t.apply(df, keep)


def encode_protected(column: str | Column, tokens: str) -> Column:
    """0 when any of the pipe-separated literal texts occurs in the value, else 1."""
    c = (F.col(column) if isinstance(column, str) else column).cast("string")
    hit = F.lit(False)
    for token in tokens.split("|"):
        hit = hit | F.coalesce(c.contains(F.lit(token)), F.lit(False))
    return F.when(hit, F.lit(0)).otherwise(F.lit(1))
