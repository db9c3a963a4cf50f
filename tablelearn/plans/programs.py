"""The reference's programs as reusable Spark jobs.

Each takes a session and input paths and returns DataFrames; nothing is
printed, plotted or collected. Column names and parameters default to the
reference's; the seeded random split is kept (``split="random"``) and a
reproducible key split is offered (``split="key"``).
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tablelearn.operators import evaluate, report, shaping, split
from tablelearn.plans import models
from tablelearn.plans.block_scoring import forecast_blocks
from tablelearn.plans.block_training import fit_blocks, prepare_blocks
from tablelearn.plans.sequence_model import REFERENCE_SERIES, SequenceConfig, SequenceModel, model_name
from tablelearn.session import materialize
from tablelearn.sources import read_csv, read_parquet
from tablelearn.sources.sinks import write_parquet

STOCK_COLS = ["Open", "Close", "Low", "High", "Volume"]


@dataclass
class ClassificationResult:
    model: object
    scored: DataFrame
    confusion: DataFrame
    metrics: DataFrame


def _read_once(spark: SparkSession, path: str, name: str, csv: dict | None) -> DataFrame:
    """Parse a CSV once into Parquet in the shared folder: the fit's several passes and the
    scoring then read columns, not text. ``csv`` goes to ``read_csv``: a ``schema`` spares
    the inference pass, ``null_value`` names the text that stands for NULL."""
    return materialize(read_csv(spark, path, **(csv or {})), name)


def _split(df: DataFrame, weights, seed: int, how: str, key: str | None):
    if how == "random":
        return split.random_split(df, list(weights), seed)
    if how == "key":
        if not key:
            raise ValueError("split='key' needs key=")
        return list(split.key_split(df, key, buckets=4, test_buckets=(0,)))
    raise ValueError("split must be 'random' or 'key'")


def segment_customers(
    spark: SparkSession,
    path: str,
    features=("Annual Income (k$)", "Spending Score (1-100)"),
    k: int = 5,
    seed: int = 1,
    csv: dict | None = None,
) -> DataFrame:
    """K-means on the whole table; the input columns + ``features`` + ``prediction``."""
    df = _read_once(spark, path, "segment-input", csv)
    return models.score(models.fit_kmeans(df, list(features), k=k, seed=seed), df)


def classify_purchases(
    spark: SparkSession,
    path: str,
    kind: str = "decision_tree",
    features=("Age", "EstimatedSalary"),
    label: str = "Purchased",
    *,
    weights=(0.75, 0.25),
    seed: int = 123,
    split_by: str = "random",
    key: str | None = None,
    handle_invalid: str = "error",
    csv: dict | None = None,
    **params,
) -> ClassificationResult:
    """Split, fit assembler + label indexer + classifier on the training
    part, score the test part, confusion matrix and metrics."""
    df = _read_once(spark, path, "classify-input", csv)
    train, test = _split(df, weights, seed, split_by, key)
    model = models.fit_classifier(train, kind, list(features), label, handle_invalid=handle_invalid, **params)
    # Written once: the metrics and the caller read the scored rows, the model runs once.
    scored = materialize(models.score(model, test), "classify-scored")
    return ClassificationResult(model, scored, evaluate.confusion_matrix(scored), evaluate.metrics_report(scored))


def regress_linear(
    spark: SparkSession,
    path: str,
    features=("YearsExperience",),
    label: str = "Salary",
    *,
    weights=(0.66, 0.34),
    seed: int = 123,
    split_by: str = "random",
    key: str | None = None,
    csv: dict | None = None,
) -> DataFrame:
    """Linear regression; the four series of the reference's plot, as rows.

    The x of each series is the first feature.
    """
    df = _read_once(spark, path, "regress-input", csv)
    train, test = _split(df, weights, seed, split_by, key)
    model = models.fit_regressor(train, "linear", list(features), label)
    both = train.withColumn("_part", F.lit("train")).unionByName(test.withColumn("_part", F.lit("test")))
    return report.scored_series(
        models.score(model, both),
        features[0],
        {
            "train": {"Training Set": label, "Linear Regression": "predict"},
            "test": {"Test Set": label, "Predictions": "predict"},
        },
        part="_part",
    )


def regress_levels(
    spark: SparkSession,
    train_path: str,
    test_path: str,
    kind: str = "decision_tree",
    feature: str = "Level",
    label: str = "Salary",
    *,
    grid_step: float = 0.01,
    seed: int = 0,
    csv: dict | None = None,
    **params,
) -> DataFrame:
    """Tree regressor on the training levels; training points, the model
    curve over a grid of the feature's range, and the test prediction."""
    train = _read_once(spark, train_path, "levels-train", csv)
    test = _read_once(spark, test_path, "levels-test", csv)
    model = models.fit_regressor(train, kind, [feature], label, seed=seed, **params)
    grid = report.grid_over(train, feature, grid_step)
    name = "Decision Tree Regression" if kind == "decision_tree" else "Random Forest Regression"
    return report.overlay_series(
        {
            "Training Set": (train, feature, label),
            name: (models.score(model, grid), feature, "predict"),
            "Prediction": (models.score(model, test), feature, "predict"),
        }
    )


def process_stock_csv(spark: SparkSession, path: str, out_path: str, csv: dict | None = None) -> DataFrame:
    """P10: daily stock CSV -> each day with the next calendar day's values, non-null,
    distinct -> Parquet (overwrite). Returns the written table."""
    df = read_csv(spark, path, **(csv or {}))
    joined = shaping.next_day_join(df, "Date", STOCK_COLS)
    write_parquet(joined, out_path)
    return read_parquet(spark, out_path)


def train_stock_model(
    spark: SparkSession,
    path: str,
    cfg: SequenceConfig | None = None,
    *,
    since: str | None = REFERENCE_SERIES["since"],
    model_path: str | None = None,
    mode: str = "frame",
) -> tuple[DataFrame, SequenceModel]:
    """The prepared series from ``since`` in frames, split, train, save, and
    the actual-vs-predicted NextClose of every frame (train then test). With a
    ``model_path`` every epoch is saved there, and a call that finds saved epochs
    goes on behind them. ``mode="carry"`` scores with the state carried on."""
    cfg = cfg or SequenceConfig.reference()
    rows = read_parquet(spark, path).withColumn("Date", F.to_date("Date"))
    blocks, stats = prepare_blocks(rows, cfg, order="Date", since=since)
    run_path = f"{model_path.rstrip('/')}/lstm_model_{model_name(cfg)}" if model_path else None
    model = fit_blocks(blocks, cfg, run_path=run_path)
    return forecast_blocks(blocks, model, stats, label="NextClose", mode=mode), model
