import random
import re
from datetime import date

import pytest
from pyspark.sql import functions as F

from tablelearn.operators import sequence, split
from tablelearn.operators.blocks import series_blocks


def _series(spark, sizes, seed=0):
    rng = random.Random(seed)
    rows = []
    for k, n in sizes.items():
        for t in range(n):
            rows.append((k, t * 10 + rng.randint(0, 3), float(rng.random())))
    rng.shuffle(rows)
    return spark.createDataFrame(rows, "k string, t long, v double")


def _brute_numbers(rows):
    by_key = {}
    for k, t, v in rows:
        by_key.setdefault(k, []).append((t, v))
    out = {}
    for k, items in by_key.items():
        items.sort()
        for i, (t, v) in enumerate(items):
            out.setdefault((k, t, v), []).append((i, len(items)))
    return out


@pytest.mark.parametrize("parts", [1, 3, 7])
def test_number_rows_matches_brute_force_with_hot_key(spark, parts):
    df = _series(spark, {"hot": 300, "a": 5, "b": 1, "c": 40})
    got = sequence.number_rows(df, "t", "k", num_partitions=parts).collect()
    want = _brute_numbers([(r["k"], r["t"], r["v"]) for r in df.collect()])
    assert len(got) == sum(len(v) for v in want.values())
    for r in got:
        assert (r["idx"], r["n"]) in want[(r["k"], r["t"], r["v"])]
    pos = sorted(r["_pos"] for r in got)
    assert pos == list(range(len(got)))


def test_number_rows_without_key(spark):
    df = _series(spark, {"only": 57})
    got = sorted((r["t"], r["idx"], r["n"]) for r in sequence.number_rows(df, "t", num_partitions=4).collect())
    assert [g[1] for g in got] == list(range(57))
    assert {g[2] for g in got} == {57}


def _frames_brute(n, size, drop_last=True):
    if n < size:
        return 0
    return max(1, n - size) if drop_last else n - size + 1


@pytest.mark.parametrize("n", [3, 5, 6, 7, 40])
def test_short_series_frame_counts(spark, n):
    size = 5
    df = spark.createDataFrame([("s", i, float(i)) for i in range(n)], "k string, t long, v double")
    fr = sequence.sliding_frames(df, "t", ["v"], size, key="k", bucket_rows=8)
    assert fr.count() == _frames_brute(n, size)
    if n >= size:
        rows = sorted(fr.collect(), key=lambda r: r["frame_idx"])
        for r in rows:
            assert [s[0] for s in r["x"]] == [float(r["frame_idx"] + j) for j in range(size)]


def test_frames_across_buckets_match_brute_force(spark):
    sizes = {"hot": 230, "a": 9, "b": 4, "c": 31}
    df = _series(spark, sizes, seed=3)
    size = 6
    fr = sequence.sliding_frames(df, "t", ["v"], size, key="k", bucket_rows=16, num_partitions=5).collect()
    by_key = {}
    for r in df.collect():
        by_key.setdefault(r["k"], []).append((r["t"], r["v"]))
    want = {}
    for k, items in by_key.items():
        items.sort()
        for i in range(_frames_brute(len(items), size)):
            want[(k, i)] = [v for _, v in items[i : i + size]]
    got = {(r["k"], r["frame_idx"]): [s[0] for s in r["x"]] for r in fr}
    assert got == want


def test_frames_keep_all_when_drop_last_false(spark):
    df = spark.createDataFrame([("s", i, float(i)) for i in range(10)], "k string, t long, v double")
    assert sequence.sliding_frames(df, "t", ["v"], 4, key="k", drop_last=False).count() == 7


def test_small_split_goes_to_test(spark):
    df = spark.createDataFrame([(0,)], "frame_idx long")
    out = split.chronological_split(df, 0.98).collect()
    assert [r["part"] for r in out] == ["test"]


def test_last_batch_is_short(spark):
    frames = spark.range(1030).withColumnRenamed("id", "frame_idx")
    sizes = sorted(
        (r["batch_id"], r["count"]) for r in sequence.minibatches(frames, 512).groupBy("batch_id").count().collect()
    )
    assert [s for _, s in sizes] == [512, 512, 6]


def test_chronological_split_per_key_counts(spark):
    rows = [("a", i) for i in range(10)] + [("b", i) for i in range(3)]
    df = spark.createDataFrame(rows, "k string, frame_idx long")
    out = split.chronological_split(df, 0.5, key="k")
    got = {(r["k"], r["part"]): r["count"] for r in out.groupBy("k", "part").count().collect()}
    assert got == {("a", "train"): 5, ("a", "test"): 5, ("b", "train"): 1, ("b", "test"): 2}


def test_next_row_join(spark):
    df = spark.createDataFrame([("a", t, float(t)) for t in (1, 5, 9)], "k string, t long, v double")
    out = sorted((r["t"], r["Nextv"]) for r in sequence.next_row_join(df, "t", ["v"], key="k").collect())
    assert out == [(1, 5.0), (5, 9.0)]


def test_key_split_is_partition_independent(spark):
    df = spark.range(100).withColumnRenamed("id", "key")
    a_train, a_test = split.key_split(df.repartition(1), "key")
    b_train, b_test = split.key_split(df.repartition(7), "key")
    assert sorted(r[0] for r in a_test.collect()) == sorted(r[0] for r in b_test.collect())
    assert a_train.count() + a_test.count() == 100


def _rows_of_blocks(blocks):
    out = {}
    for r in blocks.collect():
        assert len(r["_at"]) == len(r["x"]) and r["_first"] + len(r["_at"]) <= r["_n"]
        for i, (at, x) in enumerate(zip(r["_at"], r["x"])):
            out.setdefault((r["k"], r["_first"] + i), set()).add((at, x[0], i < r["_own"]))
    return out


@pytest.mark.parametrize("parts,block,overlap", [(6, 32, 4), (40, 3, 9), (3, 1, 1), (2, 500, 0)])
def test_blocks_are_bounded_and_hold_the_rows_that_follow(spark, parts, block, overlap):
    sizes = {"hot": 400, "a": 40, "b": 3, None: 17}  # one key holds most rows
    df = _series(spark, sizes, seed=9)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        blocks = series_blocks(df, "t", ["v"], overlap=overlap, key="k", block_rows=block, num_partitions=parts).cache()
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    want = {}
    for k, t, v in sorted((tuple(r) for r in df.collect()), key=lambda r: (r[0] or "", r[1], r[2])):
        want.setdefault(k, []).append((t, v))
    got = _rows_of_blocks(blocks)
    assert {key: {(t, v) for t, v, _ in rows} for key, rows in got.items()} == {
        (k, i): {row} for k, rows in want.items() for i, row in enumerate(rows)
    }
    assert sum(own for rows in got.values() for _, _, own in rows) == len(got) == sum(sizes.values())
    for r in blocks.collect():
        assert r["_n"] == sizes[r["k"]] and 1 <= r["_own"] <= block
        assert len(r["_at"]) == min(r["_own"] + overlap, r["_n"] - r["_first"])
    assert blocks.where("k = 'hot'").count() >= 400 // block


def test_blocks_keep_nulls_and_types(spark):
    rows = [(date(2024, 1, 1 + t), None if t % 3 == 0 else t / 4, None if t == 5 else t) for t in range(12)]
    df = spark.createDataFrame(rows, "d date, v double, w int")
    r = series_blocks(df, "d", ["v", "w"], labels=["w", "v"], overlap=2, block_rows=100).first()
    assert [tuple(s) for s in r["x"]] == [(v, None if w is None else float(w)) for _, v, w in rows]
    assert [s[1] for s in r["y"]] == [v for _, v, _ in rows] and r["_at"] == [d for d, *_ in rows]
    assert series_blocks(df.where("d is null"), "d", ["v"], overlap=2).collect() == []


def test_frames_take_one_exchange_of_the_rows(spark, tmp_path):
    _series(spark, {"a": 300, "b": 20}).write.parquet(str(tmp_path / "s"))
    rows = spark.read.parquet(str(tmp_path / "s"))
    frames = sequence.sliding_frames(rows, "t", ["v"], 5, key="k", num_partitions=4)
    plan = frames._jdf.queryExecution().executedPlan().toString()
    # What is left to run reads the stored blocks; only the row counts of partitions are exchanged.
    assert set(re.findall(r"hashpartitioning\((\w+)", plan)) == {"_pid"} and "rangepartitioning" not in plan


def test_random_split_repeats_on_the_same_partitioning(spark):
    df = spark.range(500).repartition(4, "id")
    a_train, a_test = split.random_split(df, [0.75, 0.25], 123)
    b_train, b_test = split.random_split(df, [0.75, 0.25], 123)
    assert sorted(r[0] for r in a_test.collect()) == sorted(r[0] for r in b_test.collect())
    assert a_train.count() + a_test.count() == 500


def test_seeded_split_ignores_partitioning_and_covers_all_rows(spark):
    df = spark.range(2000).withColumnRenamed("id", "k")
    runs = []
    for parts in (1, 7):
        split_rows = split.seeded_split(df.repartition(parts), [0.5, 0.3, 0.2], 9, "k")
        runs.append([sorted(r[0] for r in part.collect()) for part in split_rows])
    assert runs[0] == runs[1] and sorted(sum(runs[0], [])) == list(range(2000))
    assert all(abs(len(part) / 2000 - w) < 0.05 for part, w in zip(runs[0], (0.5, 0.3, 0.2)))
    assert runs[0] != [sorted(r[0] for r in part.collect()) for part in split.seeded_split(df, [0.5, 0.3, 0.2], 10, "k")]


def test_numbering_ignores_input_partitioning_and_breaks_ties_by_values(spark):
    rows = [("a", t % 5, float(v)) for t in range(40) for v in (t % 3, 7 - t % 4)]  # many ties on (k, t)
    df = spark.createDataFrame(rows, "k string, t long, v double")
    runs = []
    for parts in (1, 3, 8):
        out = sequence.number_rows(df.repartition(parts), "t", "k", num_partitions=4)
        runs.append(sorted((r["idx"], r["t"], r["v"]) for r in out.collect()))
    assert runs[0] == runs[1] == runs[2]
    ordered = [(t, v) for _, t, v in runs[0]]
    assert ordered == sorted(ordered)  # idx follows (t, then v)


def test_rows_tied_on_the_order_are_spread(spark, monkeypatch):
    stored, write = [], sequence.materialize
    monkeypatch.setattr(sequence, "materialize", lambda df, name: stored.append(write(df, name)) or stored[-1])
    tied = spark.range(20_000).select(F.lit("k").alias("key"), F.lit(1).alias("t"), F.col("id").alias("v"))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        out = sequence.number_rows(tied, "t", "key", num_partitions=8)
        assert out.select("idx").distinct().count() == 20_000
        assert out.where("idx <> v").count() == 0
        assert stored[0].select("_pid").distinct().count() > 4
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")


def test_series_with_a_null_key_has_frames(spark):
    rows = [(k, t, float(t)) for k in ("a", None) for t in range(10)]
    df = spark.createDataFrame(rows, "k string, t int, v double")
    frames = sequence.sliding_frames(df, "t", ["v"], 3, key="k")
    assert {r["k"]: r["count"] for r in frames.groupBy("k").count().collect()} == {"a": 7, None: 7}


def test_unused_frame_arrays_are_pruned(spark, tmp_path):
    spark.range(100).select("id", F.col("id").cast("double").alias("v")).write.parquet(str(tmp_path / "s"))
    frames = sequence.sliding_frames(spark.read.parquet(str(tmp_path / "s")), "id", ["v"], 5)
    plan = frames.select("frame_idx", "n_frames")._jdf.queryExecution().executedPlan().toString()
    scanned = [line for line in plan.splitlines() if "Scan parquet" in line and "_own" in line]
    assert scanned and all("x:" not in line and "_at" not in line for line in scanned)
