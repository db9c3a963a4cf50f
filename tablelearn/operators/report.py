"""Result tables in place of plots (O1, S9, P4s)."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def overlay_series(series: dict[str, tuple[DataFrame, str | Column, str | Column]]) -> DataFrame:
    """O1 + S9: several (x, y) series as one long table ``(series, x, y)``.

    Each x stays in the same row as its y (one projection per series), so no
    pairing by position between separate jobs is needed.
    """
    parts = [
        df.select(
            F.lit(name).alias("series"),
            (F.col(x) if isinstance(x, str) else x).cast("double").alias("x"),
            (F.col(y) if isinstance(y, str) else y).cast("double").alias("y"),
        )
        for name, (df, x, y) in series.items()
    ]
    return reduce(DataFrame.unionByName, parts)


def scored_series(scored: DataFrame, x: str, series: dict[str, dict[str, str]], part: str = "part") -> DataFrame:
    """O1 from one scored table: ``(series, x, y)`` for the series of each row's part.

    ``series`` maps a value of ``part`` to ``{series name: y column}``. The table is read (and
    scored) once; each row is expanded into its part's points.
    """
    points = F.lit(None)
    for value, own in series.items():
        point = [
            F.struct(F.lit(n).alias("series"), F.col(x).cast("double").alias("x"), F.col(y).cast("double").alias("y"))
            for n, y in own.items()
        ]
        points = F.when(F.col(part) == value, F.array(*point)).otherwise(points)
    return scored.select(F.explode(points).alias("p")).select("p.series", "p.x", "p.y")


def prediction_grid(spark: SparkSession, lo: float, hi: float, step: float, col: str = "x") -> DataFrame:
    """P4s: evenly spaced values ``lo, lo + step, ... <= hi`` (distributed ``range``)."""
    if step <= 0:
        raise ValueError("step must be > 0")
    n = int((hi - lo) / step + 1e-9) + 1
    return spark.range(n).select((F.lit(float(lo)) + F.col("id") * F.lit(float(step))).alias(col))


def grid_over(df: DataFrame, col: str, step: float, out_col: str | None = None) -> DataFrame:
    """P4s over a feature's observed range: bounds come from one aggregate of ``col``."""
    row = df.agg(F.min(col).cast("double").alias("lo"), F.max(col).cast("double").alias("hi")).first()
    if row is None or row["lo"] is None:
        return df.sparkSession.range(0).select(F.lit(None).cast("double").alias(out_col or col))
    return prediction_grid(df.sparkSession, row["lo"], row["hi"], step, out_col or col)
