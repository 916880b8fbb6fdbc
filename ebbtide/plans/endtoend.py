"""Two plans in one call each: raw tables to a saved base table with all findings, and a flat table to training features."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import numeric_columns, string_columns
from ..operators import artifact, clean, quality
from ..operators.encode import ColumnTransform
from ..session import staged
from ..sources import schemas
from ..sources import tables as io
from .abt import build_abt


@dataclass(frozen=True)
class BaseTable:
    """The saved table, and what was found on the way (each written next to it): columns, types, keys, missing, imputed, outliers, versions, summary."""

    table: DataFrame
    findings: dict[str, DataFrame]


def _stacked(parts: Mapping[str, DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, [df.select(F.lit(n).alias("table_name"), "*") for n, df in parts.items()])


def build_base_table(spark: SparkSession, folder: str, out: str, label: str = "churn_flag", flags: Sequence[str] = ("is_trial", "sub_is_trial"),
                     ids: Sequence[str] = ("account_id", "subscription_id"), m: float = 1.5, fmt: str = "csv", key_rates: bool = False) -> BaseTable:
    """Read, check, log versions, merge, drop copies, fill, cap, save.

    Nothing stops at a finding but a missing input table: rows that break a rule are counted, and their cells become NULL where a type asks for it. The
    merged table is written once before the statistics; every fitted value (fills, fences) is found once, and both logged and applied.
    """
    t = io.read_table_set(spark, folder, schemas.TABLES, fmt)
    out = out.rstrip("/")
    columns = [(n, kind, c) for n, df in t.items() for kind, cs in quality.check_columns(df.columns, schemas.TABLES[n].fieldNames()).items() for c in cs]
    found = {
        "columns": spark.createDataFrame(columns, "table_name string, kind string, column_name string"),
        "types": _stacked({n: quality.check_types(df, schemas.TYPE_RULES[n]) for n, df in t.items()}),
        "keys": _stacked({n: quality.key_profile(df, schemas.JOIN_KEYS[n], approx=key_rates) for n, df in t.items()}),
    }
    versions = io.append_version_log(spark, {n: f"{folder.rstrip('/')}/{n}.{fmt}" for n in t}, f"{out}/versions")
    merged = clean.convert_types(build_abt(t["accounts"], t["subscriptions"], t["feature_usage"], t["support_tickets"], label=label))
    with_copies = staged(merged)
    abt = staged(clean.remove_duplicates(with_copies))
    skip = {label, *ids, *flags}
    numeric, texts = numeric_columns(abt, skip), [c for c in string_columns(abt) if c not in ids]
    found["missing"] = quality.missing_report(abt)
    fills = clean.numeric_fill_fit(abt, numeric), clean.categorical_fill_fit(abt, texts)
    found["imputed"] = clean.imputation_log(abt, numeric, texts, fitted=fills)
    full = clean.numeric_fill_apply(abt, fills[0]).withColumns({c: F.coalesce(F.col(c), F.lit(x)) for c, x in fills[1].items()})
    fences = clean.iqr_fit(full, numeric, m)
    found["outliers"] = clean.iqr_report(full, numeric, m, fences)
    io.write_table(clean.iqr_winsorize(full, numeric, m, fences), f"{out}/abt")
    for name, df in found.items():
        io.write_table(df, f"{out}/findings/{name}")
    found = {name: spark.read.parquet(f"{out}/findings/{name}") for name in found}
    table = spark.read.parquet(f"{out}/abt")
    capped = quality.outlier_columns(found["outliers"]).first()
    found["summary"] = quality.table_summary(table, label).drop("capped_columns").withColumns({
        "copies_dropped": F.lit(with_copies.count() - abt.count()).cast("long"), "outliers_capped": F.lit(capped["outliers_capped"]).cast("long")})
    io.write_table(found["summary"], f"{out}/findings/summary")
    return BaseTable(table, found | {"summary": spark.read.parquet(f"{out}/findings/summary"), "versions": versions})


@dataclass(frozen=True)
class TrainingFeatures:
    """``matrix``: key, label, split and the encoded features; ``protected``: key and protected columns, for audits only."""

    matrix: DataFrame
    protected: DataFrame
    features: list[str]
    transform: ColumnTransform

    def save(self, folder: str, name: str, version: str, **info) -> str:
        """The fitted preprocessing as an artifact without a model: raw engineered rows to the vector ``features``."""
        stages = artifact.preprocessing(self.transform, self.matrix.sparkSession.createDataFrame([], self._raw_schema()))
        return artifact.save_artifact(artifact.Artifact(artifact.PipelineModel(stages), self.features, dict(info)), folder, name, version)

    def _raw_schema(self) -> str:
        t = self.transform
        return ", ".join([*[f"`{c}` double" for c in (*t.numeric, *t.flags)], *[f"`{c}` string" for c in t.categorical]])


def training_features(df: DataFrame, key: str, label: str, split: str, numeric: Sequence[str], categorical: Sequence[str] = (), flags: Sequence[str] = (),
                      protected: Sequence[str] = (), engineer: Callable[[DataFrame], DataFrame] | None = None) -> TrainingFeatures:
    """Engineered, encoded and audited features of all rows; everything fitted learns from the rows whose split is ``train``.

    Fails if a protected column, a column that leaks the outcome, or a level of either is among the encoded names.
    """
    rows = staged(engineer(df) if engineer else df)
    t = ColumnTransform(list(numeric), list(categorical), list(flags)).fit(rows.where(F.col(split) == "train"))
    artifact.audit_names(t.features, [*protected, *clean.LEAKAGE_COLUMNS])
    return TrainingFeatures(t.apply(rows, [key, label, split]), rows.select(key, *protected), t.features, t)
