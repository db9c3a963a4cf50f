from tablelearn.operators import report


def test_grid_over_empty_and_regular(spark):
    empty = spark.createDataFrame([], "x double")
    assert report.grid_over(empty, "x", 0.5).count() == 0
    df = spark.createDataFrame([(1.0,), (3.0,)], "x double")
    assert [r["x"] for r in report.grid_over(df, "x", 0.5).orderBy("x").collect()] == [1.0, 1.5, 2.0, 2.5, 3.0]


def test_overlay_keeps_x_and_y_in_one_row(spark):
    df = spark.createDataFrame([(1.0, 10.0), (2.0, 20.0)], "a double, b double")
    out = report.overlay_series({"s1": (df, "a", "b"), "s2": (df, "b", "a")})
    assert sorted(tuple(r) for r in out.collect()) == [
        ("s1", 1.0, 10.0), ("s1", 2.0, 20.0), ("s2", 10.0, 1.0), ("s2", 20.0, 2.0)
    ]
