from tablelearn import sources
from tablelearn.session import scratch_path
from tablelearn.sources.sinks import preview, write_parquet


def test_csv_inference_and_null_marker(spark, tmp_path):
    path = tmp_path / "stocks.csv"
    path.write_text("Date,Open,Volume\n2024-01-02,1.5,10\n2024-01-03,null,11\n")
    raw = sources.read_csv(spark, str(path))
    assert dict(raw.dtypes)["Open"] == "string"
    clean = sources.read_csv(spark, str(path), null_value="null")
    assert dict(clean.dtypes)["Open"] == "double"
    assert dict(clean.dtypes)["Date"] == "date"
    assert clean.where("Open IS NOT NULL").count() == 1


def test_parquet_roundtrip_and_views(spark):
    df = spark.createDataFrame([(1, "a"), (2, "b")], "id int, s string")
    path = write_parquet(df, scratch_path(spark, "t"))
    back = sources.read_parquet(spark, path)
    sources.register(back, "tiny")
    assert sources.sql(spark, "SELECT count(*) AS n FROM tiny WHERE id >= :lo", lo=2).first()["n"] == 1
    assert preview(back, 1).count() == 1


def test_scratch_paths_live_under_one_root(spark):
    from tablelearn.session import scratch_root

    a, b = scratch_path(spark, "x"), scratch_path(spark, "x")
    assert a != b and a.startswith(scratch_root(spark) + "/") and b.startswith(scratch_root(spark) + "/")
