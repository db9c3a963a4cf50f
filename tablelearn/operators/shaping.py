"""Table shaping: projections, filters, the next-day join, dedupe
and daily bars from time-stamped values (the stand-in for a daily price file)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tablelearn import functions as tf

PRICE_COLS = ["Open", "Close", "Low", "High", "Volume"]

# Days that are looked up together; a 1/DAY_BUCKET share of the rows is copied.
DAY_BUCKET = 64


def project(df: DataFrame, cols: list[str | Column]) -> DataFrame:
    """projection from a column list (no SQL text is built)."""
    return df.select(*cols)


def since(df: DataFrame, date_col: str, start: str) -> DataFrame:
    """rows on or after ``start`` (a ``yyyy-MM-dd`` day); pushed into the scan when it is a column."""
    return df.where(F.col(date_col) >= F.lit(start).cast("date"))


def drop_incomplete(df: DataFrame, cols: list[str] | None = None) -> DataFrame:
    """keep rows where all ``cols`` (default: all columns) are non-null."""
    return df.where(tf.all_not_null(cols or df.columns))


def dedupe(df: DataFrame, subset: list[str] | None = None) -> DataFrame:
    """A2: full-row distinct, or first row per ``subset``."""
    return df.dropDuplicates(subset) if subset else df.distinct()


def shift_columns(
    df: DataFrame, date_col: str, cols: list[str], *, prefix: str = "Next", days: int = -1, key: str | None = None
) -> DataFrame:
    """``date_add(date, days) AS date, c AS {prefix}c ...`` — each day re-labelled as its neighbour."""
    keep = [F.col(key)] if key else []
    return df.select(
        *keep,
        tf.day_shift(date_col, days).alias(date_col),
        *[F.col(c).alias(prefix + c) for c in cols],
    )


def next_day_join(
    df: DataFrame,
    date_col: str = "Date",
    cols: list[str] | None = None,
    *,
    key: str | None = None,
    prefix: str = "Next",
    by: str = "day",
    since_day: str | None = None,
    many_copies: bool = False,
) -> DataFrame:
    """J1 (+ C1, C2, F3, F5, F6, A2): each row gets the values of the following calendar day.

    Semantics: inner join of day ``d`` with day ``d + 1`` (same ``key``), both
    sides' columns non-null, distinct rows. Rows without a next calendar day
    (weekends, holidays, the last day) are dropped — this is not ``lead()``.
    Duplicate days multiply and the distinct removes exact copies.

    Plan: one exchange. Days are put into buckets of ``DAY_BUCKET`` days; the first day of a
    bucket also goes to the bucket before, so every day meets its next day inside its own
    bucket, where a window over the day number looks it up. The distinct runs on the same
    partitions. The input is read once, and ``since_day`` (rows on or after it) prunes both
    sides, as a day's next day is later still. ``many_copies`` drops exact copies map-side
    first, for an extra exchange; the rows are the same.

    ``by="row"`` pairs each row with the next row of its key instead (see
    ``sequence.next_row_join``).
    """
    cols = list(cols or [c for c in PRICE_COLS if c in df.columns])
    if by == "row":
        from tablelearn.operators.sequence import next_row_join

        return next_row_join(df if since_day is None else since(df, date_col, since_day), date_col, cols, key=key, prefix=prefix)
    if by != "day":
        raise ValueError("by must be 'day' or 'row'")
    keys = [key] if key else []
    days = df if since_day is None else since(df, date_col, since_day)
    days = days.select(*keys, date_col, *cols).where(tf.all_not_null(keys + [date_col] + cols))
    if many_copies:
        days = days.distinct()
    number = F.unix_date(tf.as_date(date_col))
    own = F.floor(number / F.lit(DAY_BUCKET))
    buckets = F.when(F.pmod(number, F.lit(DAY_BUCKET)) == 0, F.array(own, own - 1)).otherwise(F.array(own))
    spread = days.select("*", number.alias("_day"), F.explode(buckets).alias("_bucket"))
    spread = spread.repartition(*keys, "_bucket").distinct()
    tomorrow = Window.partitionBy(*keys, "_bucket").orderBy("_day").rangeBetween(1, 1)
    following = F.collect_list(F.struct(*[F.col(c).alias(prefix + c) for c in cols])).over(tomorrow)
    if days.schema[date_col].dataType.typeName() != "date":
        # Several times of one day may hold equal values.
        following = F.array_distinct(following)
    out = spread.withColumn("_next", following).where(own == F.col("_bucket"))
    return out.select(*keys, date_col, *cols, F.explode("_next").alias("_next")).select(*keys, date_col, *cols, "_next.*")


def daily_bars(
    df: DataFrame,
    ts_col: str,
    value_col: str,
    *,
    key: str | None = None,
    tie_col: str | None = None,
    volume: str = "count",
    volume_digits: int | None = None,
) -> DataFrame:
    """Daily open/close/low/high/volume of a time-stamped value, per ``key``.

    Open and Close are the values of the earliest and latest row of the day,
    ordered by ``(ts, tie_col)``; Volume is the row count (``volume="count"``)
    or the sum of the values (``"sum"``, rounded to ``volume_digits`` if set).
    One grouped aggregate with partial (map-side) aggregation, so a hot key or
    day is pre-reduced before the shuffle. With a ``tie_col`` the ordering is a
    struct, which Spark aggregates sort-based (still partial before the
    shuffle); without one it is a hash aggregate.
    """
    order = F.struct(F.col(ts_col), F.col(tie_col)) if tie_col else F.col(ts_col)
    keys = [F.col(key)] if key else []
    if volume == "count":
        vol = F.count(F.lit(1)).cast("double")
    elif volume == "sum":
        vol = F.sum(value_col) if volume_digits is None else F.round(F.sum(value_col), volume_digits)
    else:
        raise ValueError("volume must be 'count' or 'sum'")
    return (
        df.where(F.col(ts_col).isNotNull() & F.col(value_col).isNotNull())
        .groupBy(*keys, tf.as_date(ts_col).alias("Date"))
        .agg(
            F.min_by(value_col, order).alias("Open"),
            F.max_by(value_col, order).alias("Close"),
            F.min(value_col).alias("Low"),
            F.max(value_col).alias("High"),
            vol.alias("Volume"),
        )
    )
