import numpy as np
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from tablelearn.operators import evaluate, report, split
from tablelearn.plans import models


def _ads(spark, n=120, seed=5):
    rng = np.random.default_rng(seed)
    rows = []
    for i in range(n):
        age = int(rng.integers(18, 60))
        salary = int(rng.integers(15000, 150000))
        bought = "Yes" if age * 2000 + salary > 180000 else "No"
        rows.append((i, "Male" if i % 2 else "Female", age, salary, bought))
    return spark.createDataFrame(rows, "`User ID` int, Gender string, Age int, EstimatedSalary int, Purchased string")


def test_classifiers_fit_score_and_report(spark):
    df = _ads(spark)
    train, test = split.key_split(df, "User ID", buckets=4)
    for kind, params in [("decision_tree", {}), ("logistic", {"maxIter": 10}), ("random_forest", {"numTrees": 5})]:
        model = models.fit_classifier(train, kind, ["Age", "EstimatedSalary"], "Purchased", seed=3, **params)
        scored = models.score(model, test)
        assert {"features", "label", "rawPrediction", "probability", "prediction"} <= set(scored.columns)
        acc = evaluate.accuracy(scored).first()["accuracy"]
        assert acc > 0.6, (kind, acc)


def test_naive_bayes_needs_nonnegative_features(spark):
    df = _ads(spark)
    model = models.fit_classifier(df, "naive_bayes", ["Age", "EstimatedSalary"], "Purchased")
    assert models.score(model, df).count() == 120


def test_third_label_only_in_scoring_part(spark):
    df = _ads(spark, 40)
    odd = spark.createDataFrame([(999, "Male", 30, 50000, "1")], df.schema)
    model = models.fit_classifier(df, "decision_tree", ["Age", "EstimatedSalary"], "Purchased", handle_invalid="keep")
    scored = models.score(model, df.unionByName(odd))
    assert scored.where(F.col("label") == 2.0).count() == 1


def test_regressors_on_position_levels(spark):
    rows = [(f"p{i}", float(i), 45000.0 * (1.6 ** (i - 1))) for i in range(1, 11)]
    train = spark.createDataFrame(rows, "Position string, Level double, Salary double")
    test = spark.createDataFrame([("x", 3.25, 70000.0)], train.schema)
    for kind, params in [("linear", {}), ("decision_tree", {}), ("random_forest", {"numTrees": 10})]:
        model = models.fit_regressor(train, kind, ["Level"], "Salary", **params)
        pred = models.score(model, test).first()["predict"]
        assert min(r[2] for r in rows) < pred < max(r[2] for r in rows)
    tree = models.fit_regressor(train, "decision_tree", ["Level"], "Salary")
    grid = report.prediction_grid(spark, 1.0, 10.0, 0.1, "Level")
    assert grid.count() == 91
    series = report.overlay_series(
        {
            "Training Set": (train, "Level", "Salary"),
            "Decision Tree Regression": (models.score(tree, grid), "Level", "predict"),
        }
    )
    assert series.count() == 101 and series.columns == ["series", "x", "y"]


def test_kmeans_rows_sit_at_nearest_centre(spark):
    rng = np.random.default_rng(1)
    pts = [(int(i), float(x), float(y)) for i, (x, y) in enumerate(rng.normal(size=(200, 2)) * 30 + 50)]
    df = spark.createDataFrame(pts, "id int, `Annual Income (k$)` double, `Spending Score (1-100)` double")
    model = models.fit_kmeans(df, ["Annual Income (k$)", "Spending Score (1-100)"], k=5, seed=1)
    centres = np.array(models.last_stage(model).clusterCenters())
    for r in models.score(model, df).select(vector_to_array("features").alias("f"), "prediction").collect():
        d = ((centres - np.array(r["f"])) ** 2).sum(axis=1)
        assert int(np.argmin(d)) == r["prediction"]


def test_model_save_load(spark, tmp_path):
    from tablelearn.sources.sinks import load_model, save_model

    df = _ads(spark, 30)
    model = models.fit_classifier(df, "decision_tree", ["Age", "EstimatedSalary"], "Purchased")
    path = save_model(model, str(tmp_path / "m"))
    back = load_model(path)
    a = [r["prediction"] for r in models.score(model, df).orderBy("User ID").collect()]
    b = [r["prediction"] for r in models.score(back, df).orderBy("User ID").collect()]
    assert a == b
