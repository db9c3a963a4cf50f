from pyspark.sql import functions as F

from tablelearn.operators import joins


def _tables(spark):
    big = spark.range(200).select((F.col("id") % 7).alias("k"), F.col("id").alias("v"))
    small = spark.range(7).select(F.col("id").alias("k"), (F.col("id") * 10).alias("w"))
    return big, small


def test_join_small_broadcast_and_shuffle_paths_agree(spark):
    big, small = _tables(spark)
    a = sorted(tuple(r) for r in joins.join_small(big, small, on=["k"]).collect())
    b = sorted(tuple(r) for r in joins.join_small(big, small, on=["k"], max_broadcast_bytes=0).collect())
    assert a == b and len(a) == 200


def test_join_small_plan_choice(spark):
    big, small = _tables(spark)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        bc = joins.join_small(big, small, on=["k"])._jdf.queryExecution().executedPlan().toString()
        sh = joins.join_small(big, small, on=["k"], max_broadcast_bytes=0)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "Broadcast" in bc
    assert "BroadcastHashJoin" not in sh


def test_per_key_scaling_through_shuffle_join(spark, monkeypatch):
    from tablelearn.operators import features

    monkeypatch.setattr(joins, "DEFAULT_MAX_BROADCAST_BYTES", 0)
    df = spark.createDataFrame([("x", 0.0), ("x", 4.0), ("y", 1.0), ("y", 3.0)], "k string, v double")
    out = sorted((r["k"], r["v"]) for r in features.minmax_scale(df, ["v"], key="k").collect())
    assert out == [("x", 0.0), ("x", 1.0), ("y", 0.0), ("y", 1.0)]


def test_null_keys_meet_each_other(spark):
    big = spark.createDataFrame([("x", 1), (None, 2), (None, 3)], "k string, v int")
    small = spark.createDataFrame([("x", 10), (None, 20)], "k string, w int")
    for limit in (None, 0):
        out = joins.join_small(big, small, on=["k"], max_broadcast_bytes=limit)
        assert out.columns == ["k", "v", "w"]
        assert sorted((r["v"], r["w"]) for r in out.collect()) == [(1, 10), (2, 20), (3, 20)]


def test_measured_bytes_count_arrays_and_strings(spark):
    table = spark.range(100).select("id", F.array_repeat(F.lit(1.0), 1000).alias("a"), F.repeat(F.lit("x"), 50).alias("s"))
    assert joins.measured_bytes(table) >= 100 * (8 * 1000 + 50)
    assert joins.measured_bytes(table.limit(0)) == 0


def test_wide_state_is_not_broadcast(spark):
    big, _ = _tables(spark)
    wide = spark.range(7).select(F.col("id").alias("k"), F.array_repeat(F.lit(0.5), 2000).alias("h"))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = joins.join_small(big, wide, on=["k"], max_broadcast_bytes=50_000)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "BroadcastHashJoin" not in plan
