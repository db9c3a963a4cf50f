import datetime as dt
import math

from pyspark.sql import functions as F

from tablelearn.operators import shaping

COLS = ["Open", "Close", "Low", "High", "Volume"]


def _weekdays(spark, days, dup=None):
    rows = []
    for i, d in enumerate(days):
        rows.append((d, 10.0 + i, 11.0 + i, 9.0 + i, 12.0 + i, 100 + i))
        if d == dup:
            rows.append((d, 50.0, 51.0, 49.0, 52.0, 500))
    return spark.createDataFrame(rows, "Date date, Open double, Close double, Low double, High double, Volume int")


def _mon_fri(n_weeks=3):
    start = dt.date(2024, 1, 1)  # a Monday
    return [start + dt.timedelta(days=7 * w + d) for w in range(n_weeks) for d in range(5)]


def test_next_day_join_drops_days_without_next_calendar_day(spark):
    days = _mon_fri()
    out = shaping.next_day_join(_weekdays(spark, days), "Date", COLS).collect()
    assert len(out) == 12  # 3 weeks x Mon-Thu
    assert all(r["Date"].weekday() < 4 for r in out)
    for r in out:
        assert r["NextOpen"] == r["Open"] + 1.0


def test_next_day_join_duplicate_day_multiplies(spark):
    days = _mon_fri(1)
    dup = days[2]  # Wednesday twice
    out = shaping.next_day_join(_weekdays(spark, days, dup=dup), "Date", COLS).collect()
    # Mon-Tue, Tue with both Wednesdays, both Wednesdays with Thursday, Thu-Fri.
    assert len(out) == 6
    assert sum(1 for r in out if r["Date"] == dup) == 2


def test_next_day_join_exact_duplicate_rows_removed(spark):
    days = _mon_fri(1)
    df = _weekdays(spark, days)
    out = shaping.next_day_join(df.unionByName(df), "Date", COLS)
    assert out.count() == 4


def test_next_day_join_per_key(spark):
    days = _mon_fri(1)
    a = _weekdays(spark, days).withColumn("k", F.lit("a"))
    b = _weekdays(spark, days[:3]).withColumn("k", F.lit("b"))
    out = shaping.next_day_join(a.unionByName(b), "Date", COLS, key="k")
    got = {(r["k"], r["Date"]) for r in out.collect()}
    assert len([g for g in got if g[0] == "a"]) == 4
    assert len([g for g in got if g[0] == "b"]) == 2


def test_next_day_join_equals_pairs_across_buckets_with_one_exchange(spark, tmp_path):
    start = dt.datetime(1969, 11, 1)  # day numbers on both sides of 0
    rows = []
    for k, step in (("a", 1), ("b", 2), ("c", 1)):
        for i in range(0, 200, step):
            for hour in (0, 7) if i % 9 == 0 else (0,):
                rows.append((k, start + dt.timedelta(days=i, hours=hour), float(i % 7)))
    rows += rows[:40]
    spark.createDataFrame(rows, "k string, t timestamp, v double").write.parquet(str(tmp_path / "days"))
    df = spark.read.parquet(str(tmp_path / "days"))
    distinct = set(rows)
    want = {(k, t, v, w) for k, t, v in distinct for k2, u, w in distinct if k2 == k and u.date() == t.date() + dt.timedelta(days=1)}
    for more in ({}, {"many_copies": True}):
        got = [tuple(r) for r in shaping.next_day_join(df, "t", ["v"], key="k", **more).collect()]
        assert set(got) == want and len(got) == len(want)
    late = shaping.next_day_join(df, "t", ["v"], key="k", since_day="1970-01-04")
    plan = late._jdf.queryExecution().executedPlan().toString()
    assert {tuple(r) for r in late.collect()} == {r for r in want if r[1] >= dt.datetime(1970, 1, 4)}
    assert plan.count("Exchange ") == 1 and "Join" not in plan and "GreaterThanOrEqual(t," in plan


def test_drop_incomplete_keeps_nan_drops_null(spark):
    cols = ["Date", "Open", "Close", "Low", "High", "Volume", "NextOpen", "NextClose", "NextLow", "NextHigh", "NextVolume"]
    full = [dt.date(2024, 1, 1)] + [1.0] * 10
    rows = [tuple(full)]
    for i in range(len(cols)):
        r = list(full)
        r[i] = None
        rows.append(tuple(r))
    nan_row = list(full)
    nan_row[1] = math.nan
    rows.append(tuple(nan_row))
    schema = "Date date, " + ", ".join(f"{c} double" for c in cols[1:])
    df = spark.createDataFrame(rows, schema)
    assert shaping.drop_incomplete(df).count() == 2


def test_since_and_project(spark):
    df = _weekdays(spark, _mon_fri(2))
    out = shaping.project(shaping.since(df, "Date", "2024-01-08"), ["Date", "Open"])
    assert out.columns == ["Date", "Open"]
    assert out.count() == 5


def test_daily_bars_open_close_by_time_then_tiebreak(spark):
    rows = [
        (1, dt.datetime(2024, 1, 1, 9), "a", 5.0),
        (0, dt.datetime(2024, 1, 1, 9), "a", 7.0),  # same time, smaller id -> open
        (2, dt.datetime(2024, 1, 1, 17), "a", 3.0),
        (3, dt.datetime(2024, 1, 2, 10), "a", 4.0),
    ]
    df = spark.createDataFrame(rows, "id long, ts timestamp, k string, v double")
    out = {r["Date"]: r for r in shaping.daily_bars(df, "ts", "v", key="k", tie_col="id").collect()}
    d1 = out[dt.date(2024, 1, 1)]
    assert (d1["Open"], d1["Close"], d1["Low"], d1["High"], d1["Volume"]) == (7.0, 3.0, 3.0, 7.0, 3.0)


def test_dedupe_full_and_subset(spark):
    df = spark.createDataFrame([(1, "a"), (1, "a"), (1, "b")], "k int, v string")
    assert shaping.dedupe(df).count() == 2
    assert shaping.dedupe(df, ["k"]).count() == 1


def test_next_day_join_by_row_follows_rows_not_days(spark):
    days = _mon_fri(2)
    out = shaping.next_day_join(_weekdays(spark, days), "Date", COLS, by="row").collect()
    assert len(out) == len(days) - 1  # Friday pairs with the next Monday
    fri = [r for r in out if r["Date"].weekday() == 4]
    assert len(fri) == 1 and fri[0]["NextOpen"] == fri[0]["Open"] + 1.0
