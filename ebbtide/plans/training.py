"""Training and scoring plans over the operators."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.ml import PipelineModel, Transformer
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators import evaluate, fairness, models
from ..operators.features import audit_tier
from ..operators.quality import bound_rules, forbidden_columns, require_columns, validate_rows
from ..session import staged
from ..sources.tables import audit_rows


def fit_all(train: DataFrame, features: Sequence[str], label: str, forest: Mapping | None = None,
            boosting: Mapping | None = None, balanced: bool = True) -> dict[str, PipelineModel]:
    """Logistic regression, forest and boosting, with balanced class weights by default."""
    weight = "weight" if balanced else None
    data = staged(fairness.class_weights(train, label) if balanced else train)
    return {
        "logistic": models.fit_logistic(data, features, label, weight),
        "forest": models.fit_forest(data, features, label, weight, **dict(forest or {})),
        "boosting": models.fit_boosting(data, features, label, weight, **dict(boosting or {})),
    }


def scored_by_all(fitted: Mapping[str, Transformer], train: DataFrame, test: DataFrame, key: str, label: str) -> DataFrame:
    """Long table (model, key, label, probability, prediction) of every model and the majority baseline."""
    cols = [key, label, "probability", "prediction"]
    out = models.majority_baseline(train, test, label).select(F.lit("majority").alias("model"), *cols)
    for name, model in fitted.items():
        out = out.unionByName(models.score(test, model).select(F.lit(name).alias("model"), *cols))
    return out


def compare(fitted: Mapping[str, Transformer], train: DataFrame, test: DataFrame, key: str, label: str, sort: str = "recall") -> DataFrame:
    """One row of test metrics per model. The scored rows are written once, as the metrics read them twice."""
    return evaluate.compare_models(staged(scored_by_all(fitted, train, test, key, label)), "model", label, "prediction", "probability", sort)


def balancing_effect(train: DataFrame, test: DataFrame, features: Sequence[str], key: str, label: str, forest: Mapping | None = None,
                     boosting: Mapping | None = None) -> DataFrame:
    """Six fits (three models, with and without class weights) and what balancing adds to recall and F1."""
    out = None
    for variant, on in (("balanced", True), ("unbalanced", False)):
        for name, model in fit_all(train, features, label, forest, boosting, on).items():
            part = models.score(test, model).select(F.lit(name).alias("model"), F.lit(variant).alias("variant"), label, "prediction")
            out = part if out is None else out.unionByName(part)
    return evaluate.balancing_delta(evaluate.core_metrics(out, label, "prediction", by=["model", "variant"]))


def score_batch(payload: DataFrame, model: Transformer, features: Sequence[str], key: str, required: Sequence[str],
                protected: Sequence[str], rules: Mapping[str, Column] | None = None, prepare=None, timestamp=None,
                threshold: float = 0.5) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(scored rows, audit rows, quarantined rows) of a batch.

    A missing required column rejects the batch, broken rows are quarantined,
    protected columns stay out of the features and travel in the row for the audit,
    so ``prepare`` must keep them; rows without a key are scored like any other.
    """
    require_columns(payload.columns, required)
    leaked = forbidden_columns(features, protected)
    if leaked:
        raise ValueError(f"protected columns among the features: {leaked}")
    valid, quarantine, _ = validate_rows(payload, rules if rules is not None else bound_rules())
    ready = prepare(valid) if prepare else valid
    scored = models.score(ready, model, features, keep=[key, *protected], threshold=threshold).withColumn("risk_tier", audit_tier("probability"))
    return scored.drop(*protected), audit_rows(scored, key, "probability", protected, timestamp=timestamp), quarantine
