"""Classification metrics as DataFrames.

Semantics kept from the multiclass metrics the reference prints:

* the label set is the distinct TRUE labels of the scored rows (NULL is not a label);
* the confusion matrix has one row and one column per true label; rows
  predicted as a value outside that set are left out of the matrix,
* accuracy divides by ALL scored rows; a row whose label or prediction is NULL
  counts as wrong,
* precision of a label never predicted is 0.

The scored rows are read once: one grouped count per (label, prediction), with
map-side partial aggregation, is written to the shared folder, and every metric
is derived from that class-by-class table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablelearn.session import materialize


def cells(scored: DataFrame, label: str = "label", prediction: str = "prediction") -> DataFrame:
    """``(label, prediction, n)`` of all scored rows, NULLs included: one row per pair of classes."""
    pairs = scored.select(F.col(label).cast("double").alias("label"), F.col(prediction).cast("double").alias("prediction"))
    return materialize(pairs.groupBy("label", "prediction").agg(F.count(F.lit(1)).alias("n")), "metric-cells")


def _accuracy(counts: DataFrame) -> DataFrame:
    right = F.when(F.col("label") == F.col("prediction"), F.col("n")).otherwise(0)
    return counts.agg((F.sum(right) / F.sum("n")).alias("accuracy"), F.coalesce(F.sum("n"), F.lit(0)).alias("n"))


def _precision(counts: DataFrame) -> DataFrame:
    right = F.when(F.col("label") == F.col("prediction"), F.col("n")).otherwise(0)
    tp = counts.where("label is not null").groupBy("label").agg(F.sum(right).alias("tp"))
    predicted = counts.groupBy(F.col("prediction").alias("label")).agg(F.sum("n").alias("n_pred"))
    return tp.join(predicted, on="label", how="left").select(
        "label",
        F.when(F.coalesce(F.col("n_pred"), F.lit(0)) == 0, F.lit(0.0))
        .otherwise(F.col("tp") / F.col("n_pred"))
        .alias("precision"),
    )


def confusion_matrix(scored: DataFrame, label: str = "label", prediction: str = "prediction", wide: bool = False) -> DataFrame:
    """V1 + A3: ``(label, prediction, n)`` for every non-empty cell over the true-label set.

    ``wide=True`` returns the matrix form, one row per true label and one
    ``n_<class>`` column per true label (0 where empty).
    """
    counts = cells(scored, label, prediction)
    true_labels = counts.select(F.col("label").alias("prediction")).where("prediction is not null").distinct()
    long = counts.where("label is not null").join(true_labels, on="prediction", how="left_semi").select("label", "prediction", "n")
    if not wide:
        return long
    classes = sorted(r[0] for r in true_labels.collect())  # one value per class: bounded by the class count
    matrix = long.groupBy("label").pivot("prediction", classes).agg(F.first("n"))
    rows = true_labels.select(F.col("prediction").alias("label"))
    out = rows.join(matrix, on="label", how="left")
    return out.select(
        "label", *[F.coalesce(F.col(f"`{c}`"), F.lit(0)).cast("long").alias(f"n_{c:g}") for c in classes]
    )


def accuracy(scored: DataFrame, label: str = "label", prediction: str = "prediction") -> DataFrame:
    """V2: share of rows with ``prediction == label`` (over all rows), plus the row count."""
    return _accuracy(cells(scored, label, prediction))


def precision_by_label(scored: DataFrame, label: str = "label", prediction: str = "prediction") -> DataFrame:
    """V3 + V4: ``(label, precision)`` for each true label; TP / (TP + FP), 0 when never predicted."""
    return _precision(cells(scored, label, prediction))


def metrics_report(scored: DataFrame, label: str = "label", prediction: str = "prediction") -> DataFrame:
    """Long table ``(metric, label, value)`` — accuracy (label NULL) and precision per true label."""
    counts = cells(scored, label, prediction)
    acc = _accuracy(counts).select(
        F.lit("accuracy").alias("metric"), F.lit(None).cast("double").alias("label"), F.col("accuracy").alias("value")
    )
    prec = _precision(counts).select(
        F.lit("precision").alias("metric"), "label", F.col("precision").alias("value")
    )
    return acc.unionByName(prec)
