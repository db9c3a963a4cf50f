"""Sinks (S6-S8): table writes, model save/load, preview."""

from __future__ import annotations

from pyspark.sql import DataFrame


def write_parquet(df: DataFrame, path: str, *, mode: str = "overwrite", partition_by: list[str] | None = None) -> str:
    """Parquet write, overwrite by default, optional directory partitioning."""
    writer = df.write.mode(mode)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)
    return path


def write_csv(df: DataFrame, path: str, *, mode: str = "overwrite", header: bool = True) -> str:
    df.write.mode(mode).option("header", str(header).lower()).csv(path)
    return path


def save_model(model, path: str) -> str:
    """S7 for Spark ML models (``PipelineModel`` and friends)."""
    model.write().overwrite().save(path)
    return path


def load_model(path: str):
    from pyspark.ml import PipelineModel

    return PipelineModel.load(path)


def preview(df: DataFrame, n: int = 20) -> DataFrame:
    """The first ``n`` rows, still a DataFrame (``df.show()`` prints the same)."""
    return df.limit(n)
