"""One saved object from raw rows to scores: scaling, levels, feature names and the model.

Everything fitted becomes a persistable ``pyspark.ml`` stage, so a reloaded ``PipelineModel`` takes raw rows and needs nothing else. Next to it lie the
feature names and the parameters that were chosen. A linear model can also be written as one SQL expression over the raw columns.
"""

from __future__ import annotations

import json
from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.ml import Estimator, PipelineModel, Transformer
from pyspark.ml.classification import LogisticRegressionModel
from pyspark.ml.feature import OneHotEncoder, SQLTransformer, StringIndexerModel, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .encode import ColumnTransform
from .quality import forbidden_columns


@dataclass(frozen=True)
class Artifact:
    """The fitted pipeline, the names of its features in order, and whatever should be known about it."""

    model: PipelineModel
    features: list[str]
    info: dict = field(default_factory=dict)


def _number(x: float) -> str:
    return f"cast('{float(x)!r}' as double)"


def _text(x: str) -> str:
    return "'" + x.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _scaled(t: ColumnTransform, c: str) -> str:
    """A numeric feature in SQL: scaled, and 0 (the mean) where it is missing."""
    mean, spread = t.scale[c]
    return f"coalesce((cast(`{c}` as double) - {_number(mean)}) / {_number(spread)}, {_number(0)})"


def _flag(c: str) -> str:
    return f"coalesce(cast(`{c}` as double), {_number(0)})"


def preprocessing(t: ColumnTransform, df: DataFrame) -> list[Transformer]:
    """Stages that give raw rows the vector ``features`` of a fitted column transform; unseen and missing levels are all zeros.

    The order is that of ``t.features``. Helper columns begin with two underscores.
    """
    made = {f"__num_{c}": _scaled(t, c) for c in t.numeric} | {f"__flag_{c}": _flag(c) for c in t.flags}
    known = {c: vs for c, vs in t.levels.items() if vs}
    made |= {f"__cat_{c}": f"cast(`{c}` as string)" for c in known}
    stages: list[Transformer] = [SQLTransformer(statement="SELECT *, " + ", ".join(f"{how} AS `{name}`" for name, how in made.items()) + " FROM __THIS__")]
    rows = stages[0].transform(df.limit(0))
    for c, values in known.items():
        indexer = StringIndexerModel.from_labels(values, f"__cat_{c}", f"__at_{c}", handleInvalid="keep")
        rows = indexer.transform(rows)
        # The last category holds what the fit didn't see; dropping it leaves zeros. Sizes come from the labels, so no row is read.
        encoder = OneHotEncoder(inputCol=f"__at_{c}", outputCol=f"__hot_{c}", dropLast=True).fit(rows)
        stages += [indexer, encoder]
    inputs = [*[f"__num_{c}" for c in t.numeric], *[f"__hot_{c}" for c in known], *[f"__flag_{c}" for c in t.flags]]
    return [*stages, VectorAssembler(inputCols=inputs, outputCol="features")]


def fit_artifact(train: DataFrame, numeric: Sequence[str], categorical: Sequence[str], flags: Sequence[str], estimator: Estimator,
                 protected: Sequence[str] = (), **info) -> Artifact:
    """Preprocessing and model fitted on the same rows; fails if a protected column, or a level of one, is among the encoded names."""
    t = ColumnTransform(list(numeric), list(categorical), list(flags)).fit(train)
    audit_names(t.features, protected)
    stages = preprocessing(t, train)
    fitted = estimator.fit(PipelineModel(stages).transform(train))
    return Artifact(PipelineModel([*stages, fitted]), t.features, dict(info))


def linear_artifact(t: ColumnTransform, weights: Mapping[str, float], intercept: float = 0.0, **info) -> Artifact:
    """A model whose weights are given (by feature name) rather than fitted."""
    expression = linear_sql(t, weights, intercept)
    return Artifact(PipelineModel([SQLTransformer(statement=f"SELECT *, {expression} AS `__p` FROM __THIS__")]), t.features, dict(info))


def linear_sql(t: ColumnTransform, weights: Mapping[str, float], intercept: float = 0.0) -> str:
    """The probability of class 1 as an expression over raw columns, with all numbers in it."""
    parts = [_number(intercept)]
    parts += [f"{_number(weights[c])} * {_scaled(t, c)}" for c in t.numeric if c in weights]
    parts += [f"case when cast(`{c}` as string) = {_text(x)} then {_number(weights[f'{c}_{x}'])} else {_number(0)} end"
              for c, xs in t.levels.items() for x in xs if f"{c}_{x}" in weights]
    parts += [f"{_number(weights[c])} * {_flag(c)}" for c in t.flags if c in weights]
    return f"1 / (1 + exp(-({' + '.join(parts)})))"


def weights_of(a: Artifact) -> tuple[dict[str, float], float]:
    """Weights by feature name, and the intercept, of an artifact with a logistic model."""
    model = a.model.stages[-1]
    if not isinstance(model, LogisticRegressionModel):
        raise ValueError("not a linear model")
    return dict(zip(a.features, (float(w) for w in model.coefficients))), float(model.intercept)


def audit_names(names: Sequence[str], protected: Sequence[str]) -> None:
    """Fails if a feature is a protected column or one of its levels."""
    found = sorted({*forbidden_columns(names, protected), *[n for n in names for p in protected if n.startswith(f"{p}_")]})
    if found:
        raise ValueError(f"protected columns among the features: {found}")


def save_artifact(a: Artifact, folder: str, name: str, version: str) -> str:
    """``folder``/``name``_v``version``: the pipeline, and a line of names and information. An older one of the same version is replaced."""
    path = f"{folder.rstrip('/')}/{name}_v{version}"
    a.model.write().overwrite().save(f"{path}/model")
    spark = SparkSession.active()
    line = json.dumps({"name": name, "version": version, "features": a.features, "info": a.info}, sort_keys=True)
    spark.createDataFrame([(line,)], "value string").coalesce(1).write.mode("overwrite").text(f"{path}/info")
    return path


def load_artifact(path: str) -> Artifact:
    told = json.loads(SparkSession.active().read.text(f"{path}/info").first()[0])
    return Artifact(PipelineModel.load(f"{path}/model"), told["features"], told["info"])


def score_raw(df: DataFrame, a: Artifact, keep: Sequence[str], name: str = "probability") -> DataFrame:
    """``keep`` columns of raw rows and the probability of class 1. Row by row, so a stream will do as well."""
    out = a.model.transform(df)
    p = F.col("__p") if "__p" in out.columns else vector_to_array("probability")[1]
    return out.select(*keep, p.alias(name))
