"""Fitted trees and forests as tables (M2, M5, M8, M9).

``leaf_boxes`` turns a model into one row per leaf: the box of feature values that ends there
(``lo < x <= hi`` for every feature) and what the leaf says. A table can be kept, looked at and
joined like any other, and scores rows without the model.

``score_boxes`` joins rows with the boxes they lie in. The thresholds of all leaves cut each
feature into cells, and all rows of the same cells get the same result, so the rows are
reduced to their distinct cells first (map-side, so frequent values weigh nothing). A cell
meets the boxes by an equality on one feature's cell and ranges on the others; no row is
compared with every box.
"""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tablelearn.operators.joins import join_small
from tablelearn.plans.models import last_stage
from tablelearn.session import materialize, scratch_path

_INF = float("inf")


def _nodes(spark: SparkSession, model) -> DataFrame:
    """``tree, id, value, votes, left, right, feature, threshold`` of a tree or forest model."""
    path = scratch_path(spark, "tree-model")
    model.write().save(path)
    data = spark.read.parquet(f"{path}/data")
    node = "nodeData." if "nodeData" in data.columns else ""
    tree = F.col("treeID") if "treeID" in data.columns else F.lit(0)
    split = f"{node}split"
    nodes = data.select(
        tree.alias("tree"),
        F.col(f"{node}id").alias("id"),
        F.col(f"{node}prediction").alias("value"),
        F.col(f"{node}impurityStats").alias("votes"),
        F.col(f"{node}leftChild").alias("left"),
        F.col(f"{node}rightChild").alias("right"),
        F.col(f"{split}.featureIndex").alias("feature"),
        F.when(F.col(f"{split}.numCategories") < 0, F.get(f"{split}.leftCategoriesOrThreshold", F.lit(0))).alias("threshold"),
    )
    return materialize(nodes, "tree-nodes")


def leaf_boxes(spark: SparkSession, model: PipelineModel) -> DataFrame:
    """``tree, leaf, lo, hi, value, votes`` of every leaf; ``votes`` are the training rows of each
    class (of a regressor: its sums). Splits are thresholds, as ``assembler`` gives them."""
    fitted = last_stage(model)
    nodes, n = _nodes(spark, fitted), fitted.numFeatures
    if nodes.where("left >= 0 and threshold is null").head(1):
        raise ValueError("a split by categories has no box")
    ends = lambda v: F.array(*[F.lit(v)] * n)
    level = nodes.where("id = 0").withColumn("lo", ends(-_INF)).withColumn("hi", ends(_INF))
    found = level.where("left < 0")
    inner = level.where("left >= 0")
    # One join for each level of the trees, at most ``maxDepth``.
    while inner.head(1):
        put = lambda c: F.transform(c, lambda x, i: F.when(i == F.col("feature"), F.col("threshold")).otherwise(x))
        left = inner.select("tree", F.col("left").alias("id"), "lo", put("hi").alias("hi"))
        right = inner.select("tree", F.col("right").alias("id"), put("lo").alias("lo"), "hi")
        level = materialize(join_small(left.unionByName(right), nodes, on=["tree", "id"]), "tree-level")
        found = found.unionByName(level.where("left < 0"))
        inner = level.where("left >= 0")
    return materialize(found.select("tree", F.col("id").alias("leaf"), "lo", "hi", "value", "votes"), "leaf-boxes")


def score_boxes(df: DataFrame, boxes: DataFrame, features: list[str], classes: int = 0) -> DataFrame:
    """``df`` plus ``box_prediction`` and ``box_trees``, the trees that have a leaf for the row.

    A regression is the mean of the trees' values; with ``classes`` each tree's leaf gives its
    shares of the classes and the class with the greatest sum wins (the first of equal ones)."""
    ends = boxes.select(F.explode(F.array("lo", "hi")).alias("ends")).select(F.posexplode("ends").alias("f", "at"))
    cuts = ends.where(F.abs("at") < _INF).groupBy("f").agg(F.array_sort(F.collect_set("at")).alias("cuts"))
    # Thresholds are a part of the model: at most one for each inner node.
    known = {r["f"]: r["cuts"] for r in cuts.collect()}
    at = [F.array(*[F.lit(v) for v in known.get(i, [])]).cast("array<double>") for i in range(len(features))]

    def below(cuts, x):
        return F.size(F.filter(cuts, lambda v: v < x))

    def upto(cuts, x):
        return F.size(F.filter(cuts, lambda v: v <= x))

    cells = [below(at[i], F.col(c).cast("double")).alias(f"_c{i}") for i, c in enumerate(features)]
    rows = df.select("*", *cells)
    names = [f"_c{i}" for i in range(len(features))]
    # A box lies over the cells from behind its lower end to its upper end.
    spans = [(upto(at[i], F.col("lo")[i]), below(at[i], F.col("hi")[i])) for i in range(len(features))]
    wide = boxes.select(
        "tree", "value", "votes", *[e.alias(n) for i, (a, b) in enumerate(spans) for e, n in ((a, f"_a{i}"), (b, f"_b{i}"))]
    )
    key = max(range(len(features)), key=lambda i: len(known.get(i, [])))
    wide = wide.withColumn("_key", F.explode(F.sequence(f"_a{key}", f"_b{key}")))
    distinct = materialize(rows.select(*names).distinct(), "cells")
    inside = distinct[f"_c{key}"] == wide["_key"]
    for i in range(len(features)):
        if i != key:
            inside &= distinct[f"_c{i}"].between(wide[f"_a{i}"], wide[f"_b{i}"])
    held = distinct.join(wide, inside)
    if classes:
        share = [F.sum(F.col("votes")[k] / F.aggregate("votes", F.lit(0.0), lambda a, v: a + v)) for k in range(classes)]
        scored = held.groupBy(*names).agg(F.array(*share).alias("_s"), F.count_distinct("tree").alias("box_trees"))
        scored = scored.select(*names, (F.array_position("_s", F.array_max("_s")) - 1).cast("double").alias("box_prediction"), "box_trees")
    else:
        scored = held.groupBy(*names).agg(F.avg("value").alias("box_prediction"), F.count_distinct("tree").alias("box_trees"))
    return join_small(rows, scored, on=names, how="left").drop(*names)

