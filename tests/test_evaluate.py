from tablelearn.operators import evaluate


def _pairs(spark, rows):
    return spark.createDataFrame(rows, "label double, prediction double")


def test_label_never_predicted_has_precision_zero(spark):
    df = _pairs(spark, [(0.0, 0.0), (1.0, 0.0)])
    prec = {r["label"]: r["precision"] for r in evaluate.precision_by_label(df).collect()}
    assert prec == {0.0: 0.5, 1.0: 0.0}


def test_prediction_outside_true_labels(spark):
    df = _pairs(spark, [(0.0, 2.0), (1.0, 1.0)])
    cells = {(r["label"], r["prediction"]): r["n"] for r in evaluate.confusion_matrix(df).collect()}
    assert cells == {(1.0, 1.0): 1}
    assert evaluate.accuracy(df).first()["accuracy"] == 0.5
    wide = {r["label"]: (r["n_0"], r["n_1"]) for r in evaluate.confusion_matrix(df, wide=True).collect()}
    assert wide == {0.0: (0, 0), 1.0: (0, 1)}


def test_metrics_report_long_form(spark):
    df = _pairs(spark, [(0.0, 0.0), (0.0, 1.0), (1.0, 1.0), (1.0, 1.0)])
    rep = {(r["metric"], r["label"]): r["value"] for r in evaluate.metrics_report(df).collect()}
    assert rep[("accuracy", None)] == 0.75
    assert rep[("precision", 0.0)] == 1.0
    assert abs(rep[("precision", 1.0)] - 2 / 3) < 1e-12


def test_null_rows_count_as_wrong(spark):
    df = _pairs(spark, [(0.0, 0.0), (1.0, None), (None, 1.0)])
    acc = evaluate.accuracy(df).first()
    assert (round(acc["accuracy"], 9), acc["n"]) == (round(1 / 3, 9), 3)
    assert {r["label"]: r["precision"] for r in evaluate.precision_by_label(df).collect()} == {0.0: 1.0, 1.0: 0.0}
    assert {(r["label"], r["prediction"]) for r in evaluate.confusion_matrix(df).collect()} == {(0.0, 0.0)}
    assert [r["label"] for r in evaluate.confusion_matrix(df, wide=True).orderBy("label").collect()] == [0.0, 1.0]


def test_metrics_read_the_scored_rows_once(spark, tmp_path):
    _pairs(spark, [(0.0, 0.0), (0.0, 1.0)]).write.parquet(str(tmp_path / "scored"))
    plan = evaluate.metrics_report(spark.read.parquet(str(tmp_path / "scored")))._jdf.queryExecution().executedPlan().toString()
    assert str(tmp_path) not in plan  # only the class-by-class table is read
