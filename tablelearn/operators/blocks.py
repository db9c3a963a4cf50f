"""Ordered series as blocks of consecutive rows with the rows that follow.

Sliding frames, the training of sequences and their step-by-step scoring all look at a row
together with the ``T-1`` rows behind it. ``series_blocks`` lays a table out for them in one
shuffle: the rows are range-partitioned by (key, order), which spreads a long series over
many partitions, sorted, and packed into rows that hold a block's values as arrays, with the
next ``overlap`` rows at the end. A block's own rows stand in exactly one block, so the
stored table has ``1 + overlap / block_rows`` times the rows of the input, whatever ``T`` is.

Only the blocks that reach the end of a range partition lack rows. They get them from the
first rows of the next partitions: a table of at most ``overlap`` rows per partition, joined
by position. The blocks themselves are not shuffled again.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, MapType, StructType

from tablelearn.operators.joins import join_small
from tablelearn.session import materialize

BLOCK_ROWS = 4096


def _tie_columns(df: DataFrame, exclude: list[str]) -> list[str]:
    unordered = (MapType, ArrayType, StructType)
    return [f.name for f in df.schema.fields if f.name not in exclude and not isinstance(f.dataType, unordered)]


def _steps(table: pa.Table, columns: list[str], rows: np.ndarray) -> pa.Array:
    """``columns`` of ``rows`` as one list of values per row, nulls kept."""
    chunks = [table.column(c).combine_chunks() for c in columns]
    values = np.column_stack([pc.fill_null(c, 0.0).to_numpy(zero_copy_only=False)[rows] for c in chunks])
    missing = None
    if any(c.null_count for c in chunks):
        missing = np.column_stack([c.is_null().to_numpy(zero_copy_only=False)[rows] for c in chunks]).ravel()
    flat = pa.array(values.ravel(), pa.float64(), mask=missing)
    return pa.ListArray.from_arrays(pa.array(np.arange(len(rows) + 1) * len(columns), pa.int32()), flat)


def _packer(key: str | None, x: list[str], y: list[str], overlap: int, block_rows: int):
    """Sorted rows ``key?, _at, x..., y...`` of one partition to blocks, a few at a time."""

    def spans(table: pa.Table, final: bool) -> tuple[list[tuple], int]:
        """``(start, own, tail, open)`` of the blocks that are complete, and where the rest begins."""
        n, ends = table.num_rows, []
        if key:
            codes = pc.dictionary_encode(table.column(key).combine_chunks(), null_encoding="encode").indices.to_numpy()
            ends = (np.flatnonzero(np.diff(codes)) + 1).tolist()
        found, start = [], 0
        for end in [*ends, n]:
            while start < end:
                left = end - start
                if end == n and not final and left < block_rows + overlap:
                    return found, start
                own = min(block_rows, left)
                tail = min(overlap, left - own)
                found.append((start, own, tail, end == n and final and tail < overlap))
                start += own
        return found, start

    def pack(batches):
        partition = TaskContext.get().partitionId()
        waiting: list[pa.RecordBatch] = []
        run = before = held = 0

        def cut(final: bool):
            nonlocal waiting, run, before, held
            table = pa.Table.from_batches(waiting)
            found, rest = spans(table, final)
            if found:
                rows = np.concatenate([np.arange(s, s + own + tail) for s, own, tail, _ in found])
                offsets = pa.array(np.cumsum([0, *[own + tail for _, own, tail, _ in found]]), pa.int32())
                starts = np.array([s for s, *_ in found])
                columns = {
                    "_pid": pa.array(np.full(len(found), partition), pa.int32()),
                    "_run": pa.array(np.arange(run, run + len(found)), pa.int32()),
                    "_loc": pa.array(before + starts, pa.int64()),
                    "_own": pa.array([own for _, own, _, _ in found], pa.int64()),
                    "_open": pa.array([o for *_, o in found], pa.bool_()),
                    "_at": pa.ListArray.from_arrays(offsets, table.column("_at").combine_chunks().take(pa.array(rows))),
                }
                if key:
                    columns[key] = table.column(key).combine_chunks().take(pa.array(starts))
                for name, cols in (("x", x), ("y", y)):
                    if cols:
                        columns[name] = pa.ListArray.from_arrays(offsets, _steps(table, cols, rows))
                yield pa.RecordBatch.from_arrays(list(columns.values()), names=list(columns))
                run += len(found)
            before += rest
            waiting = table.slice(rest).to_batches()
            held = table.num_rows - rest

        for batch in batches:
            if batch.num_rows:
                waiting.append(batch)
                held += batch.num_rows
                if held >= 2 * (block_rows + overlap):
                    yield from cut(False)
        if held:
            yield from cut(True)

    return pack


def series_blocks(
    df: DataFrame,
    order: str | list[str],
    features: list[str],
    *,
    overlap: int,
    key: str | None = None,
    labels: list[str] | None = None,
    block_rows: int = BLOCK_ROWS,
    num_partitions: int | None = None,
) -> DataFrame:
    """``key?, _first, _own, _n, _at, x[, y]``: per block the index of its first row within the
    key, the number of its own rows, the key's row count, and for its own rows and the (at most
    ``overlap``) rows that follow them in the key the order value and the feature and label
    values as ``array<array<double>>``.

    Rows tied on ``(key, order)`` are ordered by their remaining columns, so a task that runs
    again makes the same blocks. NULL keys form a series like any other."""
    if overlap < 0 or block_rows < 1:
        raise ValueError("overlap must be >= 0 and block_rows >= 1")
    keys = [key] if key else []
    order = [order] if isinstance(order, str) else list(order)
    labels = list(labels or [])
    values = [c for c in dict.fromkeys([*features, *labels]) if c not in order and c not in keys]
    rows = df.select(*keys, *order, *values)
    total = [*keys, *order, *_tie_columns(rows, keys + order)]
    ranged = rows.repartitionByRange(num_partitions, *total) if num_partitions else rows.repartitionByRange(*total)
    x, y = [f"_x{i}" for i in range(len(features))], [f"_y{i}" for i in range(len(labels))]
    sorted_rows = ranged.sortWithinPartitions(*total).select(
        *keys,
        F.col(order[0]).alias("_at"),
        *[F.col(c).cast("double").alias(a) for c, a in zip([*features, *labels], [*x, *y])],
    )
    kind = {f.name: f.dataType.simpleString() for f in rows.schema.fields}
    schema = f"_pid int, _run int, _loc long, _own long, _open boolean, _at array<{kind[order[0]]}>"
    schema += "".join(f", `{k}` {kind[k]}" for k in keys) + ", x array<array<double>>" + (", y array<array<double>>" if y else "")
    packed = materialize(sorted_rows.mapInArrow(_packer(key, x, y, overlap, block_rows), schema), "series-blocks")
    # One row per range partition: a broadcast bounded by the partition count.
    offsets = packed.groupBy("_pid").agg(F.sum("_own").alias("_rows"))
    before = Window.orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    offsets = offsets.select(
        "_pid",
        F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_off"),
        F.sum("_rows").over(Window.partitionBy()).alias("_total"),
    )
    placed = packed.join(F.broadcast(offsets), "_pid").withColumn("_pos", F.col("_off") + F.col("_loc"))
    if keys:
        per_key = placed.groupBy(*keys).agg(F.min("_pos").alias("_from"), F.sum("_own").alias("_n"))
        placed = join_small(placed, per_key, on=keys)
    else:
        placed = placed.withColumn("_from", F.lit(0).cast("long")).withColumn("_n", F.col("_total"))
    placed = placed.withColumn("_first", F.col("_pos") - F.col("_from"))
    arrays = ["_at", "x"] + (["y"] if y else [])
    if overlap:
        placed = join_small(placed, _rows_behind(placed, arrays, overlap), on=["_pid", "_run"], how="left")
        behind = {a: F.expr(f"transform(_behind, row -> row.{a})") for a in arrays}
        placed = placed.withColumns({a: F.when(F.col("_behind").isNull(), F.col(a)).otherwise(F.concat(a, behind[a])) for a in arrays})
    return placed.select(*keys, "_first", "_own", "_n", *arrays)


def _rows_behind(placed: DataFrame, arrays: list[str], overlap: int) -> DataFrame:
    """``_pid, _run, _behind``: the rows that blocks at the end of a range partition lack, from
    the first rows of the partitions behind it."""
    reach = F.col("_pos") + F.size("_at")
    lacking = F.least(F.col("_own") + overlap - F.size("_at"), F.col("_from") + F.col("_n") - reach)
    wanted = placed.where(F.col("_open") & (lacking > 0)).select(
        "_pid", "_run", F.explode(F.sequence(reach, reach + lacking - 1)).alias("_place")
    )
    heads = placed.where("_run = 0").select(
        "_pos", F.posexplode(F.slice(F.arrays_zip(*arrays), 1, overlap)).alias("_step", "_row")
    )
    heads = heads.select((F.col("_pos") + F.col("_step")).alias("_place"), "_row")
    rows = wanted.join(heads, "_place").groupBy("_pid", "_run").agg(F.array_sort(F.collect_list(F.struct("_place", "_row"))).alias("_behind"))
    return rows.select("_pid", "_run", F.transform("_behind", lambda s: s["_row"]).alias("_behind"))
