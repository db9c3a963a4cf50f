import pytest
from pyspark.ml.functions import vector_to_array

from tablelearn.operators import features


def test_minmax_scale_and_unscale_roundtrip(spark):
    df = spark.createDataFrame([(1.0, 5.0), (3.0, 5.0), (5.0, 5.0)], "a double, b double")
    scaled = features.minmax_scale(df, ["a", "b"]).collect()
    assert [r["a"] for r in scaled] == [0.0, 0.5, 1.0]
    assert all(r["b"] is None for r in scaled)  # constant column -> NULL by default
    filled = features.minmax_scale(df, ["b"], constant=0.5).collect()
    assert {r["b"] for r in filled} == {0.5}
    stats = features.minmax_stats(df, ["a"])
    back = features.minmax_unscale(features.minmax_scale(df, ["a"], stats), ["a"], stats).collect()
    assert [r["a"] for r in back] == [1.0, 3.0, 5.0]


def test_minmax_per_key(spark):
    df = spark.createDataFrame([("x", 0.0), ("x", 10.0), ("y", 5.0), ("y", 7.0)], "k string, v double")
    out = sorted((r["k"], r["v"]) for r in features.minmax_scale(df, ["v"], key="k").collect())
    assert out == [("x", 0.0), ("x", 1.0), ("y", 0.0), ("y", 1.0)]


def test_minmax_stats_one_pass(spark):
    df = spark.createDataFrame([(1.0, -2.0), (4.0, 8.0)], "a double, b double")
    row = features.minmax_stats(df, ["a", "b"]).first().asDict()
    assert row == {"min_a": 1.0, "min_b": -2.0, "max_a": 4.0, "max_b": 8.0}


def test_index_label_frequency_then_alphabetical(spark):
    df = spark.createDataFrame([("No",)] * 3 + [("Yes",)] * 2 + [("1",)] + [("Zz",)] * 2, "p string")
    out = {r["p"]: r["label"] for r in features.index_label(df, "p").collect()}
    assert out == {"No": 0.0, "Yes": 1.0, "Zz": 2.0, "1": 3.0}


def test_index_label_unseen_value(spark):
    train = spark.createDataFrame([("No",), ("Yes",)], "p string")
    score = spark.createDataFrame([("No",), ("1",)], "p string")
    with pytest.raises(Exception):
        features.index_label(score, "p", fit_on=train).collect()
    kept = features.index_label(score, "p", fit_on=train, handle_invalid="keep").collect()
    assert sorted(r["label"] for r in kept) == [0.0, 2.0]
    skipped = features.index_label(score, "p", fit_on=train, handle_invalid="skip").collect()
    assert len(skipped) == 1


def test_assemble_names_with_symbols(spark):
    df = spark.createDataFrame([(15, 39)], "`Annual Income (k$)` int, `Spending Score (1-100)` int")
    out = features.assemble(df, ["Annual Income (k$)", "Spending Score (1-100)"])
    assert out.select(vector_to_array("features")).first()[0] == [15.0, 39.0]


def test_label_names_back_to_strings(spark):
    from pyspark.ml.feature import StringIndexer

    df = spark.createDataFrame([("No",), ("No",), ("Yes",)], "p string")
    model = StringIndexer(inputCol="p", outputCol="prediction").fit(df)
    back = features.label_names(model).transform(model.transform(df))
    assert sorted(r["predicted_label"] for r in back.collect()) == ["No", "No", "Yes"]


def test_assemble_array(spark):
    df = spark.createDataFrame([(1, 2.5)], "a int, b double")
    assert features.assemble_array(df, ["a", "b"]).first()["features"] == [1.0, 2.5]


def test_frequency_index_equals_the_fitted_indexer(spark):
    rows = [(v, 1) for v, n in (("b", 3), ("a", 3), ("c", 5), ("é", 1), ("Z", 1)) for _ in range(n)] + [(None, 1)]
    df = spark.createDataFrame(rows, "v string, one int")
    index = features.frequency_index(df, "v")
    want = {r["v"]: r["label"] for r in features.index_label(df.where("v is not null"), "v").collect()}
    assert {r["v"]: r["label"] for r in index.collect()} == want
    back = features.apply_index(df, index, "v").collect()
    assert len(back) == len(rows) and all(r["label"] == want.get(r["v"]) for r in back)


def test_frequency_index_of_many_values(spark):
    df = spark.range(300_000).selectExpr("id % 150000 as v")
    index = features.frequency_index(df, "v")
    assert index.count() == 150_000
    stats = index.selectExpr("min(label) lo", "max(label) hi", "count(distinct label) n", "max(n) most").first()
    assert (stats["lo"], stats["hi"], stats["n"], stats["most"]) == (0.0, 149_999.0, 150_000, 2)
