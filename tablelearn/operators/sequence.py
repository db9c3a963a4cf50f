"""Ordered series: row numbering, sliding frames, mini-batches.

Scale design
------------
A plain ``row_number().over(Window.partitionBy(key).orderBy(t))`` puts every
row of a key into one task, and a series without a key into a single task.
Here no step needs that:

* ``number_rows`` range-partitions the rows by ``(key, order)`` (a hot key is
  spread over many partitions by its order column), numbers rows inside each
  partition after a deterministic sort, and turns those local numbers into a
  global position with a per-partition offset table. That table has one row
  per partition, so its broadcast has a fixed bound. The per-key index then
  needs the key's first position, a grouped aggregate joined back behind a
  size check.
* ``sliding_frames`` reads its frames from ``blocks.series_blocks``: after the one
  range shuffle only the first ``T-1`` rows of a range partition move to the
  blocks before it, and every frame lies wholly inside one block.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, MapType, StructType

from tablelearn import functions as tf
from tablelearn.operators.blocks import BLOCK_ROWS, series_blocks
from tablelearn.operators.joins import join_small
from tablelearn.session import materialize

_LOC_BITS = 33  # monotonically_increasing_id(): partition id in the upper 31 bits, row number in the lower 33


def _orderable(df: DataFrame, exclude: list[str]) -> list[str]:
    return [
        f.name
        for f in df.schema.fields
        if f.name not in exclude and not isinstance(f.dataType, (MapType, ArrayType, StructType))
    ]


def number_rows(
    df: DataFrame,
    order: str | list[str],
    key: str | None = None,
    *,
    num_partitions: int | None = None,
    pos_col: str = "_pos",
    idx_col: str = "idx",
    n_col: str = "n",
) -> DataFrame:
    """Add the global position in ``(key, order)`` order, the 0-based index within
    the key and the key's row count, without a one-partition window.

    Rows tied on ``(key, order)`` are ordered by their remaining columns, so a
    re-run task (lost executor) numbers them the same way.
    """
    spark = df.sparkSession
    order = [order] if isinstance(order, str) else list(order)
    keys = [key] if key else []
    ties = _orderable(df, keys + order)
    # Without an explicit count the range exchange follows the session's shuffle
    # settings and AQE merges small neighbouring ranges (which keeps them in order).
    # The tie columns are part of the range, so rows tied on (key, order) are spread too.
    total = [*keys, *order, *ties]
    by_range = df.repartitionByRange(num_partitions, *total) if num_partitions else df.repartitionByRange(*total)
    ranged = (
        by_range
        .sortWithinPartitions(*total)
        .withColumn("_mid", F.monotonically_increasing_id())
        .withColumn("_pid", F.shiftright("_mid", _LOC_BITS))
        .withColumn("_loc", F.col("_mid").bitwiseAND(F.lit((1 << _LOC_BITS) - 1)))
        .drop("_mid")
    )
    # Written once as Parquet to the shared checkpoint folder: the offsets, the
    # per-key starts and the rows below read the same numbered rows instead of
    # re-running the range shuffle three times, and a lost executor recovers
    # them from files.
    ranged = materialize(ranged, "numbered-rows")
    # One row per range partition: a broadcast bounded by the partition count.
    offsets = (
        ranged.groupBy("_pid")
        .agg(F.count(F.lit(1)).alias("_cnt"))
        .withColumn(
            "_off",
            F.coalesce(
                F.sum("_cnt").over(Window.orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)),
                F.lit(0),
            ),
        )
        .withColumn("_total", F.sum("_cnt").over(Window.partitionBy()))
        .drop("_cnt")
    )
    numbered = ranged.join(F.broadcast(offsets), on="_pid").withColumn(pos_col, F.col("_off") + F.col("_loc"))
    if not keys:
        return numbered.select(
            *df.columns, pos_col, F.col(pos_col).alias(idx_col), F.col("_total").alias(n_col)
        )
    per_key = numbered.groupBy(*keys).agg(F.min(pos_col).alias("_first"), F.count(F.lit(1)).alias(n_col))
    return join_small(numbered, per_key, on=keys).select(
        *df.columns, pos_col, (F.col(pos_col) - F.col("_first")).alias(idx_col), n_col
    )


def sliding_frames(
    df: DataFrame,
    order: str | list[str],
    features: list[str],
    size: int,
    *,
    key: str | None = None,
    labels: list[str] | None = None,
    drop_last: bool = True,
    bucket_rows: int | None = None,
    num_partitions: int | None = None,
) -> DataFrame:
    """W1 + W2: every run of ``size`` consecutive rows (stride 1) of each key as one row.

    Output: ``key?, frame_idx, n_frames, start, end, x[, y]`` where ``x`` and
    ``y`` are ``array<array<double>>`` shaped ``[size][len(features|labels)]``
    and ``start``/``end`` are the values of the (first) order column at the
    first and last step. Rows tied on ``(key, order)`` are ordered by their
    remaining columns.

    A key with N rows has N-T+1 full frames. ``drop_last=True`` keeps the
    reference count ``max(1, N-T)``: the frame ending on the key's last row is
    dropped unless it is the only one. N < T gives no frame.
    """
    if size < 1:
        raise ValueError("size must be >= 1")
    keys = [key] if key else []
    block = int(bucket_rows or max(64 * size, BLOCK_ROWS))
    blocks = series_blocks(
        df, order, features, overlap=size - 1, key=key, labels=labels, block_rows=block, num_partitions=num_partitions
    )
    return block_frames(blocks, size, key=key, drop_last=drop_last)


def frame_count(size: int, drop_last: bool = True, n: str = "_n"):
    """Frames of a series of ``n`` rows; the reference count unless ``drop_last`` is off."""
    rows = F.col(n)
    full = F.greatest(F.lit(1), rows - size) if drop_last else rows - size + 1
    return F.when(rows < size, F.lit(0)).otherwise(full).cast("long")


def block_frames(blocks: DataFrame, size: int, *, key: str | None = None, drop_last: bool = True) -> DataFrame:
    """The frames of ``series_blocks`` with an overlap of ``size - 1`` rows: every frame lies
    wholly inside the block of its first row."""
    framed = blocks.withColumn("n_frames", frame_count(size, drop_last))
    here = F.least(F.col("_own"), F.col("n_frames") - F.col("_first"))
    framed = framed.where(F.col("n_frames") > F.col("_first")).withColumn(
        "_i", F.explode(F.sequence(F.lit(0), (here - 1).cast("int")))
    )
    return framed.select(
        *([key] if key else []),
        (F.col("_first") + F.col("_i")).alias("frame_idx"),
        "n_frames",
        F.element_at("_at", F.col("_i") + 1).alias("start"),
        F.element_at("_at", F.col("_i") + size).alias("end"),
        *[F.slice(c, F.col("_i") + 1, size).alias(c) for c in ("x", "y") if c in blocks.columns],
    )


def next_row_join(
    df: DataFrame, order: str, cols: list[str], *, key: str | None = None, prefix: str = "Next"
) -> DataFrame:
    """Each row with the values of the next row of its key (``lead`` semantics), via numbering + equi-join."""
    keys = [key] if key else []
    numbered = number_rows(df.select(*keys, order, *cols), order, key).where(tf.all_not_null(keys + [order] + cols))
    right = numbered.select(*keys, (F.col("idx") - 1).alias("idx"), *[F.col(c).alias(prefix + c) for c in cols])
    return numbered.join(right, on=keys + ["idx"]).select(*keys, order, *cols, *[prefix + c for c in cols])


def minibatches(frames: DataFrame, batch_size: int, *, key: str | None = None, idx_col: str = "frame_idx") -> DataFrame:
    """L2: consecutive frames of a key in batches of ``batch_size``; the last batch is short."""
    return frames.withColumn("batch_id", F.floor(F.col(idx_col) / F.lit(batch_size)).cast("long"))


def last_step_values(frames: DataFrame, col: str, index: int, alias: str) -> DataFrame:
    """Value ``index`` of the last time step of an ``array<array<double>>`` frame column."""
    return frames.withColumn(alias, F.element_at(tf.last_step(col), index + 1))
