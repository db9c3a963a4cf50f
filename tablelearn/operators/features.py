"""Feature operators: assembling, label indexing, min-max statistics and scaling
(X1-X3, A1, A4, J2, C4, C5)."""

from __future__ import annotations

from pyspark.ml.feature import IndexToString, StringIndexer, VectorAssembler
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablelearn import functions as tf
from tablelearn.operators.joins import first_row, join_small
from tablelearn.operators.sequence import number_rows


def assembler(cols: list[str], output: str = "features", handle_invalid: str = "error") -> VectorAssembler:
    """X1 as a pipeline stage."""
    return VectorAssembler(inputCols=list(cols), outputCol=output, handleInvalid=handle_invalid)


def assemble(df: DataFrame, cols: list[str], output: str = "features", handle_invalid: str = "error") -> DataFrame:
    """Numeric columns into one ML vector column."""
    return assembler(cols, output, handle_invalid).transform(df)


def assemble_array(df: DataFrame, cols: list[str], output: str = "features") -> DataFrame:
    """X1 as a plain ``array<double>`` (comparable with SQL engines that lack a vector type)."""
    return df.withColumn(output, F.array(*[F.col(c).cast("double") for c in cols]))


def label_indexer(
    input_col: str, output: str = "label", handle_invalid: str = "error", order: str = "frequencyDesc"
) -> StringIndexer:
    """X2 as a pipeline stage: most frequent value -> 0.0; ties broken alphabetically."""
    return StringIndexer(inputCol=input_col, outputCol=output, handleInvalid=handle_invalid, stringOrderType=order)


def index_label(
    df: DataFrame,
    input_col: str,
    output: str = "label",
    handle_invalid: str = "error",
    order: str = "frequencyDesc",
    fit_on: DataFrame | None = None,
) -> DataFrame:
    """X2 + A4: fit the indexer on ``fit_on`` (default ``df``; the reference fits on the training part) and apply it."""
    model = label_indexer(input_col, output, handle_invalid, order).fit(fit_on if fit_on is not None else df)
    return model.transform(df)


def frequency_index(df: DataFrame, col: str, index_col: str = "label") -> DataFrame:
    """X2 + A4 as a table: ``col, index_col, n``, the values by frequency (most frequent 0.0, ties
    alphabetical, as ``index_label``) with their counts, for columns of any number of values.

    The counts are ranked by range partitions and nothing is collected; ``apply_index`` joins
    the index to rows. NULL gets no index."""
    counts = df.where(F.col(col).isNotNull()).groupBy(F.col(col).cast("string").alias(col)).agg(F.count(F.lit(1)).alias("n"))
    ranked = number_rows(counts.withColumn("_often", -F.col("n")), ["_often", col], idx_col="_rank", n_col="_values")
    return ranked.select(col, F.col("_rank").cast("double").alias(index_col), "n")


def apply_index(df: DataFrame, index: DataFrame, col: str, index_col: str = "label") -> DataFrame:
    """``df`` plus the index of ``col``; values without one (and NULL) get NULL. The index is
    broadcast only while it is small."""
    kind = df.schema[col].dataType
    return join_small(df, index.select(F.col(col).cast(kind).alias(col), index_col), on=[col], how="left")


def label_names(indexed_model, input_col: str = "prediction", output: str = "predicted_label") -> IndexToString:
    return IndexToString(inputCol=input_col, outputCol=output, labels=indexed_model.labels)


def minmax_stats(df: DataFrame, cols: list[str], key: str | None = None) -> DataFrame:
    """A1: min and max of every column in ONE aggregate pass (``min_c``, ``max_c``), per ``key`` if given."""
    aggs = [F.min(c).cast("double").alias(f"min_{c}") for c in cols] + [
        F.max(c).cast("double").alias(f"max_{c}") for c in cols
    ]
    return df.groupBy(key).agg(*aggs) if key else df.agg(*aggs)


def _apply_stats(df: DataFrame, stats: DataFrame, key: str | None, make) -> DataFrame:
    if key:
        return make(lambda c: F.col(f"min_{c}"), lambda c: F.col(f"max_{c}"), join_small(df, stats, on=[key]))
    # A global statistics row is two scalars per column: read once, folded into the projection.
    row = first_row(stats)
    return make(lambda c: F.lit(row[f"min_{c}"]).cast("double"), lambda c: F.lit(row[f"max_{c}"]).cast("double"), df)


def _replace_or_add(df: DataFrame, d: DataFrame, exprs: dict, suffix: str) -> DataFrame:
    if suffix:
        return d.select(*df.columns, *exprs.values())
    return d.select(*[exprs[c] if c in exprs else F.col(c) for c in df.columns])


def minmax_scale(
    df: DataFrame,
    cols: list[str],
    stats: DataFrame | None = None,
    *,
    key: str | None = None,
    constant: float | None = None,
    suffix: str = "",
) -> DataFrame:
    """X3 + C4 + J2: ``(v - min) / (max - min)`` per column with table-wide (or per-key) bounds.

    ``stats`` defaults to ``minmax_stats(df, cols, key)``; pass bounds computed
    on another table to scale with them (the reference takes them from all
    rows while training on a date range). A constant column gives NULL unless
    ``constant`` is set.
    """
    stats = stats if stats is not None else minmax_stats(df, cols, key)

    def make(lo, hi, d):
        exprs = {c: tf.minmax(F.col(c), lo(c), hi(c), constant).alias(c + suffix) for c in cols}
        return _replace_or_add(df, d, exprs, suffix)

    return _apply_stats(df, stats, key, make)


def minmax_unscale(
    df: DataFrame,
    cols: list[str],
    stats: DataFrame,
    *,
    stat_cols: list[str] | None = None,
    key: str | None = None,
    suffix: str = "",
) -> DataFrame:
    """``v * (max - min) + min``; ``stat_cols[i]`` names the bounds used for ``cols[i]``
    (e.g. a predicted close unscaled with the bounds of ``NextClose``)."""
    pairs = dict(zip(cols, stat_cols or cols))

    def make(lo, hi, d):
        exprs = {c: tf.unminmax(F.col(c), lo(pairs[c]), hi(pairs[c])).alias(c + suffix) for c in cols}
        return _replace_or_add(df, d, exprs, suffix)

    return _apply_stats(df, stats, key, make)
