"""Leaf boxes against the models they were made from."""

import math

from pyspark.sql import functions as F

from tablelearn.plans import models
from tablelearn.plans.tree_tables import leaf_boxes, score_boxes


def _rows(spark, n=400):
    return spark.range(n).select(
        "id", (F.col("id") % 37).cast("double").alias("a"), (F.col("id") * 7 % 53).cast("double").alias("b"), F.lit(1.0).alias("flat")
    ).withColumn("y", F.col("a") * 2 + F.when(F.col("b") > 20, 30).otherwise(0)).withColumn("c", (F.col("y") % 3).cast("double"))


def test_boxes_of_a_forest_tile_the_space_and_say_what_it_says(spark):
    df, names = _rows(spark), ["a", "b", "flat"]
    model = models.fit_regressor(df, "random_forest", names, "y", numTrees=7, maxDepth=5, seed=2)
    boxes = leaf_boxes(spark, model).cache()
    assert boxes.select("tree").distinct().count() == 7
    outside = spark.createDataFrame([(-1, -9.0, 1e9, 5.0, 0.0, 0.0), (-2, math.inf, -math.inf, 1.0, 0.0, 0.0)], df.schema)
    got = score_boxes(models.score(model, df.unionByName(outside)), boxes, names).collect()
    assert len(got) == 402 and all(r["box_trees"] == 7 and abs(r["box_prediction"] - r["predict"]) < 1e-9 for r in got)
    sides = [(r["lo"], r["hi"]) for r in boxes.where("tree = 0").collect()]
    for r in df.limit(50).collect():
        x = [r[c] for c in names]
        assert sum(all(a < v <= b for a, v, b in zip(lo, x, hi)) for lo, hi in sides) == 1


def test_boxes_of_classifiers_and_of_a_tree_without_splits(spark):
    df, names = _rows(spark), ["a", "b"]
    for kind, more in (("random_forest", {"numTrees": 5}), ("decision_tree", {})):
        model = models.fit_classifier(df, kind, names, "c", index_label=False, seed=3, **more)
        got = score_boxes(models.score(model, df), leaf_boxes(spark, model), names, classes=3)
        assert got.where("box_prediction <> prediction or box_prediction is null").count() == 0
    stump = models.fit_regressor(df.withColumn("y", F.lit(4.0)), "decision_tree", ["a"], "y")
    boxes = leaf_boxes(spark, stump)
    assert boxes.count() == 1
    assert {r["box_prediction"] for r in score_boxes(df, boxes, ["a"]).collect()} == {4.0}
