"""Scans and named views.

Every reader returns a lazy DataFrame, so Catalyst can push filters and the
column list into the scan of whatever the caller does next.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()


def read_csv(
    spark: SparkSession,
    path: str,
    *,
    header: bool = True,
    infer_schema: bool = True,
    schema: StructType | str | None = None,
    null_value: str | None = None,
    **options: str,
) -> DataFrame:
    """CSV with a header row; types inferred unless a schema is given.

    Inference costs one extra pass over the file; pass ``schema`` on large
    inputs. ``null_value`` maps a text marker (e.g. ``"null"``) to NULL before
    the type is decided, so that ``IS NOT NULL`` filters work as meant.
    """
    reader = spark.read.option("header", str(header).lower())
    if schema is not None:
        reader = reader.schema(schema)
    else:
        reader = reader.option("inferSchema", str(infer_schema).lower())
    if null_value is not None:
        reader = reader.option("nullValue", null_value)
    for key, value in options.items():
        reader = reader.option(key, value)
    return reader.csv(path)


def read_parquet(spark: SparkSession, *paths: str) -> DataFrame:
    """Parquet scan (schema from the files, pushdown and pruning by Catalyst)."""
    return spark.read.parquet(*paths)


def load_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """S2 on the driver's test layout: ``{sf_dir}/{name}.parquet``."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def register(df: DataFrame, name: str) -> DataFrame:
    """S3: session-scoped view for SQL text."""
    df.createOrReplaceTempView(name)
    return df


def register_tables(spark: SparkSession, sf_dir: str, names: tuple[str, ...] | list[str] = tuple(TABLES)) -> None:
    for name in names:
        register(load_table(spark, sf_dir, name), name)


def sql(spark: SparkSession, text: str, **args) -> DataFrame:
    """SQL over registered views; values go in as named parameters, never spliced."""
    return spark.sql(text, args=args or None)
