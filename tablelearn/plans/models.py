"""Spark ML model plans (M1-M9, X4, X5): assembler (+ label indexer) + estimator.

Training is Spark ML's own distributed code (tree aggregation of gradients,
binned level-wise trees, k-means||); this module only builds the stages with
an explicit seed and the reference's column contracts.
"""

from __future__ import annotations

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import (
    DecisionTreeClassifier,
    LogisticRegression,
    NaiveBayes,
    RandomForestClassifier,
)
from pyspark.ml.clustering import KMeans
from pyspark.ml.regression import DecisionTreeRegressor, LinearRegression, RandomForestRegressor
from pyspark.sql import DataFrame

from tablelearn.operators.features import assembler, label_indexer

CLASSIFIERS = {
    "decision_tree": DecisionTreeClassifier,
    "logistic": LogisticRegression,
    "naive_bayes": NaiveBayes,
    "random_forest": RandomForestClassifier,
}

REGRESSORS = {
    "linear": LinearRegression,
    "decision_tree": DecisionTreeRegressor,
    "random_forest": RandomForestRegressor,
}

# The parameters each reference program sets.
REFERENCE_PARAMS = {
    ("classifier", "logistic"): {"maxIter": 10},
    ("classifier", "random_forest"): {"numTrees": 4000},
    ("regressor", "random_forest"): {"numTrees": 4000},
    ("kmeans", "kmeans"): {"k": 5},
}

_SEEDED = {DecisionTreeClassifier, RandomForestClassifier, DecisionTreeRegressor, RandomForestRegressor, KMeans}


def _estimator(cls, seed: int | None, **params):
    if cls in _SEEDED:
        params.setdefault("seed", 0 if seed is None else seed)
    return cls(**params)


def classifier_stages(
    kind: str,
    features: list[str],
    label_col: str,
    *,
    seed: int = 0,
    handle_invalid: str = "error",
    index_label: bool = True,
    **params,
) -> list:
    """X1 + X2 + M2-M5. With ``index_label`` the raw label column is indexed to ``label``."""
    if kind not in CLASSIFIERS:
        raise ValueError(f"unknown classifier {kind!r}; choose from {sorted(CLASSIFIERS)}")
    stages = [assembler(features, "features")]
    target = label_col
    if index_label:
        stages.append(label_indexer(label_col, "label", handle_invalid))
        target = "label"
    stages.append(_estimator(CLASSIFIERS[kind], seed, labelCol=target, featuresCol="features", **params))
    return stages


def fit_classifier(df: DataFrame, kind: str, features: list[str], label_col: str, **kw) -> PipelineModel:
    """Fit the classification pipeline on ``df`` (the training part)."""
    return Pipeline(stages=classifier_stages(kind, features, label_col, **kw)).fit(df)


def regressor_stages(kind: str, features: list[str], label_col: str, *, seed: int = 0, prediction_col: str = "predict", **params) -> list:
    """X1 + M6-M9; the prediction column is ``predict`` as in the reference."""
    if kind not in REGRESSORS:
        raise ValueError(f"unknown regressor {kind!r}; choose from {sorted(REGRESSORS)}")
    est = _estimator(
        REGRESSORS[kind], seed, labelCol=label_col, featuresCol="features", predictionCol=prediction_col, **params
    )
    return [assembler(features, "features"), est]


def fit_regressor(df: DataFrame, kind: str, features: list[str], label_col: str, **kw) -> PipelineModel:
    return Pipeline(stages=regressor_stages(kind, features, label_col, **kw)).fit(df)


def fit_kmeans(df: DataFrame, features: list[str], k: int = 5, *, seed: int = 1, **params) -> PipelineModel:
    """M1: assembler + k-means (k-means|| init); the cluster id lands in ``prediction``."""
    return Pipeline(stages=[assembler(features, "features"), _estimator(KMeans, seed, k=k, featuresCol="features", **params)]).fit(df)


def score(model: PipelineModel, df: DataFrame) -> DataFrame:
    """Lazy scoring of a table."""
    return model.transform(df)


def last_stage(model: PipelineModel):
    return model.stages[-1]
