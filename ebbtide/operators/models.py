"""Training, calibration and scoring with ``pyspark.ml``."""

from __future__ import annotations

import random
from collections.abc import Mapping, Sequence

from pyspark.ml import Pipeline, PipelineModel, Transformer
from pyspark.ml.classification import GBTClassifier, LogisticRegression, RandomForestClassifier
from pyspark.ml.evaluation import BinaryClassificationEvaluator, Evaluator, MulticlassClassificationEvaluator
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.tuning import CrossValidator, CrossValidatorModel, ParamGridBuilder
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import dbl
from ..session import staged
from . import isotonic
from .clean import align_features
from .features import RISK_EDGES, RISK_LABELS, decide, risk_tier
from .sampling import stratified_folds


def assembler(features: Sequence[str]) -> VectorAssembler:
    return VectorAssembler(inputCols=list(features), outputCol="features", handleInvalid="keep")


def majority_baseline(train: DataFrame, df: DataFrame, label: str) -> DataFrame:
    """Constant prediction of the most frequent class, probability 0 or 1."""
    best = train.groupBy(label).agg(F.count(F.lit(1)).alias("n")).agg(
        F.min(F.struct((-F.col("n")).alias("k"), F.col(label).alias("y")))["y"].alias("y")).scalar()
    return df.withColumns({"probability": best.cast("double"), "prediction": best.cast("int")})


def logistic(train: DataFrame, label: str, weight: str | None = None, c: float = 1.0, max_iter: int = 1000) -> LogisticRegression:
    """Estimator with an L2 penalty of strength 1/C over the summed (not averaged) loss."""
    total = train.agg(F.sum(dbl(weight)) if weight else F.count(F.lit(1))).first()[0]
    est = LogisticRegression(featuresCol="features", labelCol=label, maxIter=max_iter, regParam=1.0 / (c * float(total)),
                             standardization=False)
    return est.setWeightCol(weight) if weight else est


def fit_logistic(train: DataFrame, features: Sequence[str], label: str, weight: str | None = None, c: float = 1.0,
                 max_iter: int = 1000) -> PipelineModel:
    """Expects scaled features."""
    return Pipeline(stages=[assembler(features), logistic(train, label, weight, c, max_iter)]).fit(train)


def forest(label: str, weight: str | None = None, trees: int = 200, depth: int = 15, leaf: int = 5, seed: int = 42) -> RandomForestClassifier:
    est = RandomForestClassifier(featuresCol="features", labelCol=label, numTrees=trees, maxDepth=min(depth, 30),
                                 minInstancesPerNode=leaf, seed=seed)
    return est.setWeightCol(weight) if weight else est


def fit_forest(train: DataFrame, features: Sequence[str], label: str, weight: str | None = None, **params) -> PipelineModel:
    return Pipeline(stages=[assembler(features), forest(label, weight, **params)]).fit(train)


def boosting(label: str, weight: str | None = None, rounds: int = 200, depth: int = 5, step: float = 0.1,
             subsample: float = 0.8, leaf: int = 5, seed: int = 42) -> GBTClassifier:
    est = GBTClassifier(featuresCol="features", labelCol=label, maxIter=rounds, maxDepth=depth, stepSize=step,
                        subsamplingRate=subsample, minInstancesPerNode=leaf, seed=seed)
    return est.setWeightCol(weight) if weight else est


def fit_boosting(train: DataFrame, features: Sequence[str], label: str, weight: str | None = None, **params) -> PipelineModel:
    return Pipeline(stages=[assembler(features), boosting(label, weight, **params)]).fit(train)


def fit_mitigated(train: DataFrame, features: Sequence[str], label: str, weight: str, kind: str = "boosting", **params) -> PipelineModel:
    """Training on fairness weights (see ``fairness.reweighing``)."""
    fit = {"boosting": fit_boosting, "forest": fit_forest, "logistic": fit_logistic}[kind]
    return fit(train, features, label, weight, **params)


def param_grid(est, values: Mapping[str, Sequence]) -> list:
    builder = ParamGridBuilder()
    for name, options in values.items():
        builder = builder.addGrid(est.getParam(name), list(options))
    return builder.build()


def evaluator(metric: str, label: str) -> Evaluator:
    if metric == "roc_auc":
        return BinaryClassificationEvaluator(labelCol=label, metricName="areaUnderROC", numBins=0)
    if metric in ("recall", "precision", "f1"):
        names = {"recall": "recallByLabel", "precision": "precisionByLabel", "f1": "fMeasureByLabel"}
        return MulticlassClassificationEvaluator(labelCol=label, metricName=names[metric], metricLabel=1.0)
    raise ValueError(f"unknown metric {metric!r}")


def search(train: DataFrame, est, features: Sequence[str], label: str, key: str, values: Mapping[str, Sequence],
           metric: str = "f1", folds: int = 5, draw: int | None = None, seed: int = 42, parallelism: int = 4) -> CrossValidatorModel:
    """Grid search, or with ``draw`` a seeded random subset of the grid, on stratified folds."""
    grid = param_grid(est, values)
    if draw is not None and draw < len(grid):
        grid = random.Random(seed).sample(grid, draw)
    data = assembler(features).transform(stratified_folds(train, key, label, folds, seed))
    cv = CrossValidator(estimator=est, estimatorParamMaps=grid, evaluator=evaluator(metric, label), numFolds=folds,
                        foldCol="fold", seed=seed, parallelism=parallelism)
    return cv.fit(data.select("features", "fold", label, *([est.getWeightCol()] if est.isDefined(est.weightCol) else [])))


def search_results(spark, model: CrossValidatorModel) -> DataFrame:
    """Mean validation metric of each tried parameter set (one row per set)."""
    rows = [(i, ", ".join(sorted(f"{p.name}={v}" for p, v in params.items())), float(m))
            for i, (params, m) in enumerate(zip(model.getEstimatorParamMaps(), model.avgMetrics))]
    return spark.createDataFrame(rows, "candidate int, params string, mean_metric double")


def cross_validate(train: DataFrame, est, features: Sequence[str], label: str, key: str,
                   metrics: Sequence[str] = ("recall", "f1", "roc_auc"), folds: int = 5, seed: int = 42) -> dict[str, float]:
    """Mean score over stratified folds per metric; every fold is fitted once for all metrics."""
    # Folds are dealt once and written; each fit then reads its rows from files.
    data = staged(assembler(features).transform(stratified_folds(train, key, label, folds, seed)))
    sums = dict.fromkeys(metrics, 0.0)
    for f in range(folds):
        scored = est.fit(data.where(F.col("fold") != f)).transform(data.where(F.col("fold") == f))
        for m in metrics:
            sums[m] += evaluator(m, label).evaluate(scored)
    return {m: s / folds for m, s in sums.items()}


def raw_score(df: DataFrame, model: Transformer, name: str = "probability") -> DataFrame:
    """Probability of class 1; vector columns and the model's own prediction are dropped."""
    out = model.transform(df)
    p = vector_to_array(F.col("probability"))[1]
    return out.withColumn("__p", p).drop("features", "rawPrediction", "probability", "prediction").withColumnRenamed("__p", name)


def score(df: DataFrame, model: Transformer, features: Sequence[str] | None = None, keep: Sequence[str] = (),
          threshold: float = 0.5, edges: Sequence[float] = RISK_EDGES, labels: Sequence[str] = RISK_LABELS) -> DataFrame:
    """Probability, prediction and tier for a batch or a stream; with ``features`` the row is aligned first.

    The key travels in the row (``keep``), never by position.
    """
    src = align_features(df, features, keep) if features is not None else df
    return risk_tier(decide(raw_score(src, model), "probability", threshold), "probability", edges, labels)


def out_of_fold(train: DataFrame, est, features: Sequence[str], label: str, key: str, folds: int = 3, seed: int = 42) -> DataFrame:
    """(key, label, probability): each row scored by a model that never saw it."""
    data = staged(assembler(features).transform(stratified_folds(train, key, label, folds, seed)))
    out = None
    for f in range(folds):
        part = est.fit(data.where(F.col("fold") != f)).transform(data.where(F.col("fold") == f))
        part = part.select(key, label, vector_to_array("probability")[1].alias("probability"))
        out = part if out is None else out.unionByName(part)
    return out


def calibrate_isotonic(scored: DataFrame, label: str, p: str = "probability") -> DataFrame:
    """Monotone map from score to observed rate, as a table of blocks (see ``isotonic.fit``)."""
    return isotonic.fit(scored, label, p)


def apply_isotonic(df: DataFrame, blocks: DataFrame, p: str = "probability", name: str = "calibrated") -> DataFrame:
    """Linear interpolation between the fitted blocks, constant outside them."""
    return isotonic.apply(df, blocks, p, name)


def importances(spark, model: PipelineModel, features: Sequence[str]) -> DataFrame:
    """(feature, importance) of a tree model."""
    values = model.stages[-1].featureImportances.toArray()
    return spark.createDataFrame([(f, float(v)) for f, v in zip(features, values)], "feature string, importance double")


def best_run(runs: DataFrame, name: str, metric: str = "roc_auc", run: str = "run_id", model: str = "model") -> DataFrame:
    """The best run of a model by a metric, ties to the smallest run id."""
    return runs.where(F.col(model) == name).orderBy(F.col(metric).desc_nulls_last(), run).limit(1)


def save_model(model, folder: str, name: str, version: str) -> str:
    path = f"{folder.rstrip('/')}/{name}_v{version}"
    model.write().overwrite().save(path)
    return path


def load_model(path: str) -> PipelineModel:
    return PipelineModel.load(path)


def vif(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Variance inflation factors: the diagonal of the inverse correlation matrix.

    Spark computes the correlations in one scan; only the k by k matrix is inverted here. Features that others
    determine have an infinite factor; constant features have none (NULL) and don't count for the rest.
    """
    import numpy as np

    from .profile import correlation_matrix

    spread = df.agg(*[(F.min(c) < F.max(c)).alias(f"s{i}") for i, c in enumerate(cols)]).first()
    live = [c for i, c in enumerate(cols) if spread[i]]
    at = {c: i for i, c in enumerate(live)}
    m = np.eye(len(live))
    for r in correlation_matrix(df, live).collect() if len(live) > 1 else []:
        m[at[r["feature_a"]], at[r["feature_b"]]] = m[at[r["feature_b"]], at[r["feature_a"]]] = r["r"] or 0.0
    values, vectors = np.linalg.eigh(m)
    gone = values < 1e-10
    # What a feature shares with the directions that vanish is determined by the others.
    tied = (vectors[:, gone] ** 2).sum(1) > 1e-10
    diag = (vectors[:, ~gone] ** 2 / values[~gone]).sum(1)
    factor = {c: float("inf") if tied[i] else float(diag[i]) for c, i in at.items()}
    return df.sparkSession.createDataFrame([(c, factor.get(c)) for c in cols], "feature string, vif double")
