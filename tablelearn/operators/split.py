"""Train/test splits (P1s-P3s)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tablelearn import functions as tf
from tablelearn.operators.joins import join_small


def random_split(df: DataFrame, weights: list[float], seed: int) -> list[DataFrame]:
    """P1s: seeded Bernoulli split. Row membership depends on the input partitioning;
    ``seeded_split`` gives the same parts on any partitioning."""
    return df.randomSplit(weights, seed)


def seeded_split(df: DataFrame, weights: list[float], seed: int, key: str | list[str]) -> list[DataFrame]:
    """P1s by key: each row's part follows from the seed and its key alone, so it is the same on
    any partitioning and in any other table with that key. A row takes the place in [0, 1)
    that the first 32 bits of the MD5 of ``seed:key`` stand for."""
    keys = [key] if isinstance(key, str) else list(key)
    text = F.concat_ws(":", F.lit(str(seed)), *[F.coalesce(F.col(k).cast("string"), F.lit("")) for k in keys])
    place = F.conv(F.substring(F.md5(text), 1, 8), 16, 10).cast("double") / F.lit(float(1 << 32))
    total, ends = sum(weights), [0.0]
    for w in weights:
        ends.append(ends[-1] + w / total)
    return [df.where((place >= a) & (place < b)) for a, b in zip(ends, [*ends[1:-1], 1.0])]


def key_bucket(key: str, buckets: int, method: str = "mod") -> Column:
    if method == "mod":
        return F.pmod(F.col(key), F.lit(buckets))
    if method == "hash":
        return F.pmod(F.xxhash64(F.col(key)), F.lit(buckets))
    raise ValueError("method must be 'mod' or 'hash'")


def key_split(
    df: DataFrame, key: str, *, buckets: int = 4, test_buckets: tuple[int, ...] = (0,), method: str = "mod"
) -> tuple[DataFrame, DataFrame]:
    """P3s: reproducible split by key; rows whose bucket is in ``test_buckets`` form the test part.

    A pure per-row predicate: no shuffle, and the same rows on any partitioning.
    """
    is_test = key_bucket(key, buckets, method).isin(list(test_buckets))
    return df.where(~is_test), df.where(is_test)


def with_key_split(
    df: DataFrame, key: str, *, buckets: int = 4, test_buckets: tuple[int, ...] = (0,), method: str = "mod", col: str = "part"
) -> DataFrame:
    is_test = key_bucket(key, buckets, method).isin(list(test_buckets))
    return df.withColumn(col, F.when(is_test, F.lit("test")).otherwise(F.lit("train")))


def chronological_split(
    frames: DataFrame,
    ratio: float,
    *,
    key: str | None = None,
    idx_col: str = "frame_idx",
    n_col: str = "n_frames",
    part_col: str = "part",
) -> DataFrame:
    """P2s: per key, the first ``floor(n * ratio)`` frames (by ``idx_col``) are ``train``, the rest ``test``.

    ``n`` comes from ``n_col`` when the frames carry it (``sliding_frames``
    does); otherwise it is counted per key and joined back behind a size check.
    """
    if n_col not in frames.columns:
        keys = [key] if key else []
        if keys:
            counts = frames.groupBy(*keys).agg(F.count(F.lit(1)).alias(n_col))
            frames = join_small(frames, counts, on=keys)
        else:
            frames = frames.withColumn(n_col, F.lit(frames.count()))
    cut = tf.floor_share(n_col, ratio)
    return frames.withColumn(part_col, F.when(F.col(idx_col) < cut, F.lit("train")).otherwise(F.lit("test")))
