"""Property tests: distributed numbering and frames against brute force on random inputs."""

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from tablelearn.operators import sequence

rows_strategy = st.lists(
    st.tuples(st.sampled_from(["a", "b", "c"]), st.integers(0, 30), st.integers(0, 5)),
    min_size=0,
    max_size=60,
)


def _brute(rows, size, drop_last=True):
    by_key = {}
    for k, t, v in rows:
        by_key.setdefault(k, []).append((t, float(v)))
    out = {}
    for k, items in by_key.items():
        items.sort()
        n = len(items)
        count = 0 if n < size else (max(1, n - size) if drop_last else n - size + 1)
        for i in range(count):
            out[(k, i)] = [v for _, v in items[i : i + size]]
    return out


@settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(rows=rows_strategy, size=st.integers(1, 6), bucket=st.integers(6, 20), parts=st.integers(1, 5), drop_last=st.booleans())
def test_frames_equal_brute_force(spark, rows, size, bucket, parts, drop_last):
    df = spark.createDataFrame(rows, "k string, t long, v long")
    fr = sequence.sliding_frames(
        df, "t", ["v"], size, key="k", bucket_rows=bucket, num_partitions=parts, drop_last=drop_last
    )
    got = {(r["k"], r["frame_idx"]): [s[0] for s in r["x"]] for r in fr.collect()}
    assert got == _brute(rows, size, drop_last)


day_rows = st.lists(
    st.tuples(
        st.sampled_from(["x", "y"]),
        st.integers(0, 12),
        st.one_of(st.none(), st.integers(0, 3)),
        st.integers(0, 2),
    ),
    min_size=0,
    max_size=40,
)


def _next_day_brute(rows):
    import datetime as dt

    base = dt.date(2024, 1, 1)
    out = set()
    for k1, d1, a1, b1 in rows:
        for k2, d2, a2, b2 in rows:
            if k1 == k2 and d2 == d1 + 1 and None not in (a1, b1, a2, b2):
                out.add((k1, base + dt.timedelta(days=d1), float(a1), float(b1), float(a2), float(b2)))
    return out


@settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(rows=day_rows)
def test_next_day_join_equals_brute_force(spark, rows):
    from pyspark.sql import functions as F

    from tablelearn.operators import shaping

    df = spark.createDataFrame(rows, "k string, d int, a int, b int").select(
        "k",
        F.date_add(F.lit("2024-01-01").cast("date"), F.col("d")).alias("Date"),
        F.col("a").cast("double").alias("a"),
        F.col("b").cast("double").alias("b"),
    )
    got = {tuple(r) for r in shaping.next_day_join(df, "Date", ["a", "b"], key="k").collect()}
    assert len(got) == shaping.next_day_join(df, "Date", ["a", "b"], key="k").count()  # distinct rows
    assert got == _next_day_brute(rows)
