"""Additive attribution of a score to its features."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import dbl
from ..session import shared_dir
from .evaluate import highest_risk


def attribute_linear(df: DataFrame, key: str, coefficients: dict[str, float], means: dict[str, float] | None = None) -> DataFrame:
    """weight * (value - mean) per row and feature, as (key, feature, phi) rows; no shuffle."""
    if means is None:
        row = df.agg(*[F.avg(dbl(c)).alias(c) for c in coefficients]).first()
        means = {c: row[c] or 0.0 for c in coefficients}
    cells = F.array(*[F.struct(F.lit(c).alias("feature"), (F.lit(float(w)) * (dbl(c) - F.lit(float(means[c])))).alias("phi"))
                      for c, w in coefficients.items()])
    return df.select(key, F.explode(cells).alias("e")).select(key, "e.*")


@dataclass
class TreeArrays:
    """One tree as arrays: child positions (-1 for a leaf), split feature, threshold, node value."""

    left: np.ndarray
    right: np.ndarray
    feature: np.ndarray
    threshold: np.ndarray
    value: np.ndarray
    weight: float


def tree_arrays(model: PipelineModel, folder: str | None = None) -> list[TreeArrays]:
    """The fitted trees, read from the model's own saved node table. Its size is the model's, not the data's."""
    import uuid

    from pyspark.sql import SparkSession

    spark = SparkSession.getActiveSession()
    ensemble = model.stages[-1]
    path = f"{folder or shared_dir(spark)}/trees-{uuid.uuid4().hex}"
    ensemble.write().overwrite().save(path)
    nodes = spark.read.parquet(f"{path}/data")
    forest = hasattr(ensemble, "numClasses") and "Forest" in type(ensemble).__name__
    fields = nodes.schema["nodeData"].dataType.names
    stats = "n.impurityStats" if "impurityStats" in fields else "n.prediction"
    rows = nodes.select("treeID", F.col("nodeData").alias("n")).select(
        "treeID", "n.id", "n.prediction", F.col(stats).alias("stats"), "n.leftChild", "n.rightChild",
        F.col("n.split.featureIndex").alias("f"), F.col("n.split.leftCategoriesOrThreshold").alias("t")).collect()
    by_tree: dict[int, list] = {}
    for r in rows:
        by_tree.setdefault(r["treeID"], []).append(r)
    weights = [1.0 / len(by_tree)] * len(by_tree) if forest else list(ensemble.treeWeights)
    out = []
    for t in sorted(by_tree):
        part = sorted(by_tree[t], key=lambda r: r["id"])
        at = {r["id"]: i for i, r in enumerate(part)}
        value = [r["stats"][1] / sum(r["stats"]) if forest and sum(r["stats"]) else r["prediction"] for r in part]
        out.append(TreeArrays(
            np.array([at.get(r["leftChild"], -1) for r in part]), np.array([at.get(r["rightChild"], -1) for r in part]),
            np.array([r["f"] if r["leftChild"] >= 0 else 0 for r in part]),
            np.array([r["t"][0] if r["leftChild"] >= 0 else 0.0 for r in part]), np.array(value, dtype=float), weights[t]))
    return out


def attribute_trees(df: DataFrame, key: str, features: Sequence[str], trees: list[TreeArrays]) -> DataFrame:
    """Path attribution: each split passes the change of node value to its feature.

    (key, base, margin, contributions per feature) per row; base plus the contributions is the margin.
    The trees are shared once per executor; rows are walked in vectorised batches.
    """
    features = list(features)
    shared = df.sparkSession.sparkContext.broadcast(trees)

    def walk(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            x = pdf[features].to_numpy(dtype=float)
            phi, base, lines = np.zeros(x.shape), 0.0, np.arange(len(x))
            margin = np.zeros(len(x))
            for t in shared.value:
                at = np.zeros(len(x), dtype=int)
                base += t.weight * t.value[0]
                live = lines[t.left[at] >= 0]
                while len(live):
                    f = t.feature[at[live]]
                    goes_left = x[live, f] <= t.threshold[at[live]]
                    nxt = np.where(goes_left, t.left[at[live]], t.right[at[live]])
                    phi[live, f] += t.weight * (t.value[nxt] - t.value[at[live]])
                    at[live] = nxt
                    live = live[t.left[nxt] >= 0]
                margin += t.weight * t.value[at]
            yield pd.DataFrame({key: pdf[key], "base": base, "margin": margin, **{f: phi[:, i] for i, f in enumerate(features)}})

    kind = df.schema[key].dataType.simpleString()
    schema = f"`{key}` {kind}, base double, margin double, " + ", ".join(f"`{f}` double" for f in features)
    return df.select(key, *[F.coalesce(dbl(f), F.lit(0.0)).alias(f) for f in features]).mapInPandas(walk, schema)


def attribution_rows(wide: DataFrame, key: str, features: Sequence[str]) -> DataFrame:
    """(key, feature, phi) from the wide attribution table."""
    cells = F.array(*[F.struct(F.lit(f).alias("feature"), F.col(f).alias("phi")) for f in features])
    return wide.select(key, F.explode(cells).alias("e")).select(key, "e.*")


def mean_attribution(rows: DataFrame) -> DataFrame:
    """Features by mean absolute attribution, largest first."""
    return rows.groupBy("feature").agg(F.avg(F.abs("phi")).alias("importance")).orderBy(F.col("importance").desc(), "feature")


def explain_highest_risk(scored: DataFrame, rows: DataFrame, key: str, p: str) -> DataFrame:
    """All contributions of the riskiest row, strongest first."""
    top = highest_risk(scored.select(key, p), key, p)
    return rows.join(F.broadcast(top), key).orderBy(F.abs("phi").desc(), "feature")
