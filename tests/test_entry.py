import duckdb
import pytest

import __spark_entry__ as entry
from tablelearn.sources import TABLES

SF = "/root/testdata/sf0.001"
FAST = ["daily_ohlcv", "next_day_join", "minmax_scale", "sliding_frames", "key_split", "index_label",
        "linear_regression", "naive_bayes", "decision_tree_regressor", "confusion_matrix", "precision_by_label",
        "event_next_days", "event_split", "prepare_event_series"]


def test_every_oracle_has_a_query():
    assert set(entry.oracle_sql()) <= set(entry.queries())


def _norm(rows):
    return sorted(tuple(round(v, 6) if isinstance(v, float) else v for v in r) for r in rows)


@pytest.mark.parametrize("name", FAST)
def test_query_matches_oracle_on_smallest_tables(spark, name):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    df = entry.queries()[name](spark, SF)
    cur = con.execute(entry.oracle_sql()[name])
    ocols = [d[0] for d in cur.description]
    orows = cur.fetchall()
    assert sorted(df.columns) == sorted(ocols)
    srows = [tuple(r[c] for c in ocols) for r in df.collect()]
    assert _norm(srows) == _norm(orows)


def test_python_workers_need_no_package_on_their_path(tmp_path):
    """Queries with NumPy tasks run when the driver imports the repo from elsewhere."""
    import os
    import subprocess
    import sys

    repo = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    code = (
        "import sys; sys.path.insert(0, %r)\n"
        "from pyspark.sql import SparkSession\n"
        "spark = SparkSession.builder.master('local[2]').config('spark.ui.enabled','false').getOrCreate()\n"
        "import __spark_entry__ as e\n"
        "print('ROWS', e.queries()['forecast_events_carry'](spark, %r).count())\n"
    ) % (repo, SF)
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    out = subprocess.run(
        [sys.executable, "-c", code], cwd=tmp_path, env=env, capture_output=True, text=True, timeout=600
    )
    assert "ROWS 125" in out.stdout, out.stderr[-2000:]
