"""Column expressions (C1-C6). All are built-in Spark expressions, so they stay
inside whole-stage codegen; nothing here runs Python per row."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F


def col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def as_date(c: str | Column) -> Column:
    """Calendar day of a date, timestamp or ISO string (session time zone)."""
    return F.to_date(col(c))


def day_shift(c: str | Column, days: int) -> Column:
    """``date_add(to_date(c), days)``."""
    return F.date_add(as_date(c), days)


def all_not_null(cols: list[str]) -> Column:
    """every listed column is non-null. NaN is a value here (unlike ``dropna``)."""
    return reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in cols])


def minmax(c: str | Column, lo: str | Column, hi: str | Column, constant: float | None = None) -> Column:
    """C4: ``(v - lo) / (hi - lo)``; a constant column (hi = lo) gives ``constant`` (NULL by default)."""
    scaled = F.try_divide(col(c) - col(lo), col(hi) - col(lo))
    if constant is None:
        return scaled
    return F.when(col(hi) == col(lo), F.lit(float(constant))).otherwise(scaled)


def unminmax(c: str | Column, lo: str | Column, hi: str | Column) -> Column:
    """``v * (hi - lo) + lo``."""
    return col(c) * (col(hi) - col(lo)) + col(lo)


def last_step(c: str | Column) -> Column:
    """Last element of an array column (a frame's last time step)."""
    return F.element_at(col(c), -1)


def floor_share(n: str | Column, ratio: float) -> Column:
    """Integer part of ``n * ratio``."""
    return F.floor(col(n).cast("double") * F.lit(float(ratio))).cast("long")


def non_letter_count(text: str | Column) -> Column:
    """Characters of a whole text that are not Unicode letters."""
    return F.length(F.regexp_replace(col(text), r"\p{L}", ""))
