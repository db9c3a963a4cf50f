"""Join helper for small per-key tables (statistics, offsets).

Broadcasting is only done behind a measured size: the small side is written, its
bytes are added up (arrays and strings by their real lengths), and it is broadcast
only while they stay below ``max_broadcast_bytes``; above that the join stays a
shuffle join, where AQE's skew-join split handles hot keys of the big side.
"""

from __future__ import annotations

from functools import reduce
from operator import and_

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BinaryType, MapType, StringType, StructType

from tablelearn.session import materialize

DEFAULT_MAX_BROADCAST_BYTES = 64 * 1024 * 1024


def measured_bytes(df: DataFrame) -> int:
    """Bytes of a stored flat table in memory, from its rows: 16 per row and 8 per column,
    plus what strings and arrays of fixed-width values really hold. One aggregate pass."""
    fixed = 16 + 8 * len(df.columns)
    held = [F.lit(0).cast("long")]
    for f in df.schema.fields:
        if isinstance(f.dataType, (StringType, BinaryType)):
            held.append(F.coalesce(F.octet_length(f.name), F.lit(0)).cast("long"))
        elif isinstance(f.dataType, ArrayType):
            held.append(8 * F.greatest(F.size(f.name), F.lit(0)).cast("long"))
        elif isinstance(f.dataType, (MapType, StructType)):
            held.append(F.coalesce(F.octet_length(F.to_json(F.struct(f.name))), F.lit(0)).cast("long"))
    row = df.agg(F.count(F.lit(1)).alias("n"), F.sum(sum(held[1:], held[0])).alias("held")).first()
    return row["n"] * fixed + (row["held"] or 0)


def join_small(
    big: DataFrame,
    small: DataFrame,
    on: list[str],
    how: str = "inner",
    max_broadcast_bytes: int | None = None,
) -> DataFrame:
    """Equi-join ``big`` with a per-key table, broadcasting it only when its measured size is small.

    NULL keys match each other (as a window's ``PARTITION BY`` groups them), so rows whose
    key is NULL keep their place in per-key results."""
    if not on:
        raise ValueError("join_small needs join keys")
    # The small side is usually an aggregate over the big input: write it once to the
    # shared checkpoint folder so that counting it and joining it do not both re-run
    # that full pass.
    small = materialize(small, "join-small")
    limit = DEFAULT_MAX_BROADCAST_BYTES if max_broadcast_bytes is None else max_broadcast_bytes
    hinted = F.broadcast(small) if measured_bytes(small) <= limit else small
    right = hinted.select(*[F.col(c).alias(f"__on_{c}") if c in on else F.col(c) for c in small.columns])
    same = reduce(and_, [big[c].eqNullSafe(right[f"__on_{c}"]) for c in on])
    return big.join(right, on=same, how=how).drop(*[f"__on_{c}" for c in on])


def first_row(df: DataFrame) -> dict:
    """Scalars of a one-row aggregate (e.g. global min/max) as a dict."""
    row = df.first()
    return {} if row is None else row.asDict()
