import datetime as dt

import numpy as np
from pyspark.sql import functions as F

from tablelearn.plans import programs
from tablelearn.plans.sequence_model import SequenceConfig


def _write(tmp_path, name, header, rows):
    p = tmp_path / name
    p.write_text(header + "\n" + "\n".join(",".join(str(v) for v in r) for r in rows) + "\n")
    return str(p)


def test_segment_customers(spark, tmp_path):
    rng = np.random.default_rng(2)
    rows = [
        (f"{i:04d}", "Female" if i % 3 else "Male", int(rng.integers(18, 70)), int(rng.integers(15, 140)), int(rng.integers(1, 100)))
        for i in range(1, 61)
    ]
    path = _write(tmp_path, "mall.csv", "CustomerID,Genre,Age,Annual Income (k$),Spending Score (1-100)", rows)
    out = programs.segment_customers(spark, path)
    assert out.count() == 60
    assert dict(out.dtypes)["CustomerID"] == "int"  # leading zeros lost by inference, as in the reference
    assert {r["prediction"] for r in out.collect()} <= set(range(5))


def test_classify_purchases_three_labels(spark, tmp_path):
    rng = np.random.default_rng(4)
    rows = []
    for i in range(80):
        age, sal = int(rng.integers(18, 60)), int(rng.integers(15000, 150000))
        rows.append((15600000 + i, "Male" if i % 2 else "Female", age, sal, "Yes" if age * 2000 + sal > 180000 else "No"))
    rows.append((15700000, "Male", 40, 90000, 1))  # the stray third label value
    path = _write(tmp_path, "ads.csv", "User ID,Gender,Age,EstimatedSalary,Purchased", rows)
    res = programs.classify_purchases(spark, path, "decision_tree", split_by="key", key="User ID", handle_invalid="keep")
    metrics = {(r["metric"], r["label"]): r["value"] for r in res.metrics.collect()}
    assert 0.0 <= metrics[("accuracy", None)] <= 1.0
    assert res.confusion.count() >= 1


def test_regress_linear_series(spark, tmp_path):
    rows = [(round(1.1 + 0.35 * i, 1), round(39000 + 9000 * (1.1 + 0.35 * i) + (i % 5) * 800, 1)) for i in range(30)]
    path = _write(tmp_path, "salary.csv", "YearsExperience,Salary", rows)
    out = programs.regress_linear(spark, path)
    by_series = {r["series"]: r["count"] for r in out.groupBy("series").count().collect()}
    assert by_series["Training Set"] == by_series["Linear Regression"]
    assert by_series["Test Set"] == by_series["Predictions"]
    assert by_series["Training Set"] + by_series["Test Set"] == 30


def test_regress_levels_tree_and_forest(spark, tmp_path):
    rows = [(f"Job{i}", float(i), 45000.0 * 1.6 ** (i - 1)) for i in range(1, 11)]
    train = _write(tmp_path, "pos_train.csv", "Position,Level,Salary", rows)
    test = _write(tmp_path, "pos_test.csv", "Position,Level,Salary", [("Between", 3.25, 70000.0)])
    out = programs.regress_levels(spark, train, test, grid_step=0.1)
    assert out.where(F.col("series") == "Decision Tree Regression").count() == 91
    forest = programs.regress_levels(spark, train, test, "random_forest", grid_step=0.5, numTrees=5)
    assert forest.where(F.col("series") == "Prediction").count() == 1


def _stock_rows(n_weeks=30):
    start = dt.date(2016, 11, 7)  # a Monday
    rows, price = [], 700.0
    for w in range(n_weeks):
        for d in range(5):
            day = start + dt.timedelta(days=7 * w + d)
            price += float(np.sin(w * 5 + d)) * 3.0
            rows.append((day.isoformat(), round(price, 2), round(price + 4, 2), round(price - 3, 2), round(price + 1, 2), round(price + 1, 2), 1000000 + w * 10 + d))
    return rows


def test_process_stock_csv_and_train(spark, tmp_path):
    rows = _stock_rows()
    path = _write(tmp_path, "daily_prices.csv", "Date,Open,High,Low,Close,Adj Close,Volume", rows)
    out = programs.process_stock_csv(spark, path, str(tmp_path / "daily_prices.parquet"))
    assert out.count() == 30 * 4  # no Friday has a next calendar day
    assert "Adj Close" not in out.columns
    cfg = SequenceConfig(
        features=["Open", "Close", "Low", "High"],
        labels=["NextOpen", "NextClose", "NextLow", "NextHigh"],
        frame_size=10,
        batch_size=16,
        epochs=1,
        hidden=4,
        dense=4,
    )
    table, model = programs.train_stock_model(spark, str(tmp_path / "daily_prices.parquet"), cfg, model_path=str(tmp_path / "models"))
    n = out.where(F.col("Date") >= F.lit("2017-01-01").cast("date")).count()
    assert table.count() == max(1, n - cfg.frame_size)
    assert model.history_df(spark).count() >= 1


def test_command_line_runs_programs(spark, tmp_path):
    from tablelearn.__main__ import main

    rows = [(15600000 + i, "Male", 20 + i % 40, 20000 + 1500 * i, "Yes" if i % 3 == 0 else "No") for i in range(60)]
    ads = _write(tmp_path, "ads.csv", "User ID,Gender,Age,EstimatedSalary,Purchased", rows)
    main(["classify", "--input", ads, "--kind", "naive_bayes", "--split", "key", "--key", "User ID", "--output", str(tmp_path / "c")])
    assert spark.read.parquet(str(tmp_path / "c" / "metrics")).where("metric = 'accuracy'").count() == 1
    prices = _write(tmp_path, "prices.csv", "Date,Open,High,Low,Close,Adj Close,Volume", _stock_rows(2))
    main(["stock-etl", "--input", prices, "--output", str(tmp_path / "p.parquet")])
    assert spark.read.parquet(str(tmp_path / "p.parquet")).count() == 8


def test_command_line_stock_training(spark, tmp_path):
    from tablelearn.__main__ import main

    prices = _write(tmp_path, "prices.csv", "Date,Open,High,Low,Close,Adj Close,Volume", _stock_rows(60))
    main(["stock-etl", "--input", prices, "--output", str(tmp_path / "p.parquet")])
    main(["stock-train", "--input", str(tmp_path / "p.parquet"), "--epochs", "1", "--hidden", "4", "--output", str(tmp_path / "t")])
    forecast = spark.read.parquet(str(tmp_path / "t" / "forecast"))
    kept = spark.read.parquet(str(tmp_path / "p.parquet")).where(F.col("Date") >= F.lit("2017-01-01").cast("date")).count()
    assert forecast.count() == max(1, kept - 50)
    assert spark.read.parquet(str(tmp_path / "t" / "history")).count() >= 1


def test_command_line_segment_regress_levels(spark, tmp_path):
    from tablelearn.__main__ import main

    mall = _write(
        tmp_path,
        "mall.csv",
        "CustomerID,Genre,Age,Annual Income (k$),Spending Score (1-100)",
        [(i, "Male", 20 + i % 30, 15 + (i * 7) % 120, 1 + (i * 13) % 99) for i in range(1, 41)],
    )
    main(["segment", "--input", mall, "-k", "3", "--output", str(tmp_path / "s")])
    assert spark.read.parquet(str(tmp_path / "s" / "segments")).count() == 40
    salary = _write(tmp_path, "salary.csv", "YearsExperience,Salary", [(1.0 + 0.5 * i, 30000.0 + 9000 * i) for i in range(20)])
    main(["regress", "--input", salary, "--output", str(tmp_path / "r")])
    assert spark.read.parquet(str(tmp_path / "r" / "series")).select("series").distinct().count() == 4
    rows = [(f"Job{i}", float(i), 45000.0 * 1.6 ** (i - 1)) for i in range(1, 11)]
    train = _write(tmp_path, "lv_train.csv", "Position,Level,Salary", rows)
    test = _write(tmp_path, "lv_test.csv", "Position,Level,Salary", [("x", 3.25, 70000.0)])
    main(["levels", "--train", train, "--test", test, "--grid-step", "0.5", "--output", str(tmp_path / "l")])
    assert spark.read.parquet(str(tmp_path / "l" / "series")).count() == 10 + 19 + 1


def test_classify_purchases_random_split_default(spark, tmp_path):
    rng = np.random.default_rng(8)
    rows = []
    for i in range(120):
        age, sal = int(rng.integers(18, 60)), int(rng.integers(15000, 150000))
        rows.append((15800000 + i, "Female", age, sal, "Yes" if age * 2000 + sal > 180000 else "No"))
    path = _write(tmp_path, "ads2.csv", "User ID,Gender,Age,EstimatedSalary,Purchased", rows)
    for kind, params in (("logistic", {"maxIter": 10}), ("naive_bayes", {})):
        res = programs.classify_purchases(spark, path, kind, **params)
        n_test = res.scored.count()
        assert 0 < n_test < 120
        acc = [r["value"] for r in res.metrics.collect() if r["metric"] == "accuracy"][0]
        assert 0.0 <= acc <= 1.0
