"""Training from blocks: equal to the round-by-round loop over frames, one job an epoch, resumable."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from tablelearn.plans import block_training as bt
from tablelearn.plans.sequence_model import SequenceConfig, SequenceModel, fit_sequence_model, prepare_series


def _series(spark, n=90, keys=("a",)):
    rows = [(k, t, float(np.sin(t / 5 + j)), float(np.cos(t / 7 + j))) for j, k in enumerate(keys) for t in range(n + 11 * j)]
    return spark.createDataFrame(rows, "k string, t long, v double, w double")


def _cfg(**more):
    base = dict(
        features=["v", "w"], labels=["w"], frame_size=5, batch_size=8, epochs=2, hidden=3, dense=3, split_ratio=0.8,
        averaging_frequency=2, workers=3, chunk_size=16,
    )
    return SequenceConfig(**{**base, **more})


@pytest.mark.parametrize(
    "keys,more,block_rows",
    [(("a", "b", None), {"drop_prob": 0.3}, 7), (("a",), {"workers": 9, "averaging": "workers", "dtype": "float64"}, 20)],
)
def test_equal_parameters_to_the_loop_over_frames(spark, keys, more, block_rows):
    cfg, key = _cfg(**more), None if len(keys) == 1 else "k"
    frames, _ = prepare_series(_series(spark, keys=keys), cfg, order="t", key=key)
    loop = fit_sequence_model(frames, cfg, key=key)
    blocks, _ = bt.prepare_blocks(_series(spark, keys=keys).repartition(5), cfg, order="t", key=key, block_rows=block_rows)
    model = bt.fit_blocks(blocks, cfg, key=key)
    assert np.array_equal(model.params, loop.params) and np.array_equal(model.rms, loop.rms)
    got = {(r["epoch"], r["round"]): (r["loss"], r["n_frames"]) for r in model.history_df(spark).collect()}
    want = {(e, r): (pytest.approx(loss), n) for e, r, loss, n, _ in loop.history}
    assert got == want


def test_an_epoch_takes_the_same_jobs_whatever_its_rounds(spark):
    tracker, jobs, rounds = spark.sparkContext.statusTracker(), [], []
    for freq in (1, 4):
        cfg = _cfg(epochs=1, averaging_frequency=freq)
        blocks, _ = bt.prepare_blocks(_series(spark), cfg, order="t")
        spark.sparkContext.setJobGroup(f"epoch-{freq}", "one epoch")
        try:
            model = bt.fit_blocks(blocks, cfg)
            jobs.append(len(tracker.getJobIdsForGroup(f"epoch-{freq}")))
        finally:
            spark.sparkContext._jsc.clearJobGroup()
        rounds.append(model.history_df(spark).count())
    assert rounds[0] > rounds[1] and jobs[0] == jobs[1]


def test_training_that_was_ended_goes_on_to_the_same_parameters(spark, tmp_path):
    cfg = _cfg(epochs=4)
    blocks, _ = bt.prepare_blocks(_series(spark), cfg, order="t")
    whole = bt.fit_blocks(blocks, cfg)
    path = str(tmp_path / "run")
    bt.fit_blocks(blocks, _cfg(epochs=2), run_path=path)
    # An epoch whose tables were written but never committed, and a manifest cut short.
    store = bt.ModelStore(spark, path)
    store.stage({"weights": spark.range(3)})
    (tmp_path / "run" / "manifests" / "0000000002-torn.json").write_text('{"number": 2, "fold')
    assert store.newest()["number"] == 1 and len(store.versions()) == 2
    again = bt.fit_blocks(blocks, cfg, run_path=path)
    assert np.array_equal(again.params, whole.params) and np.array_equal(again.rms, whole.rms)
    assert sorted(r["epoch"] for r in again.history_df(spark).select("epoch").distinct().collect()) == [0, 1, 2, 3]
    back = SequenceModel.load(spark, path)
    assert np.array_equal(back.params, whole.params) and back.config == cfg


def test_stored_blocks_take_little_more_than_the_rows(spark, tmp_path):
    rows = spark.range(60_000).select(F.col("id").alias("t"), F.rand(1).alias("v"), F.rand(2).alias("w"))
    rows.write.parquet(str(tmp_path / "rows"))
    size = lambda p: sum(f.stat().st_size for f in p.rglob("*.parquet"))
    cfg = SequenceConfig(features=["v", "w"], labels=["w"], frame_size=50)
    blocks, _ = bt.prepare_blocks(spark.read.parquet(str(tmp_path / "rows")), cfg, order="t")
    blocks.select("_at", "x").write.parquet(str(tmp_path / "blocks"))
    assert size(tmp_path / "blocks") < 1.2 * size(tmp_path / "rows")


def test_missing_values_are_refused_and_no_training_frames_train_nothing(spark):
    flat = _series(spark).withColumn("v", F.lit(1.0))
    blocks, _ = bt.prepare_blocks(flat, _cfg(), order="t")
    with pytest.raises(Exception, match="NULL or NaN"):
        bt.fit_blocks(blocks, _cfg(epochs=1))
    few, _ = bt.prepare_blocks(_series(spark, 4), _cfg(), order="t")
    model = bt.fit_blocks(few, _cfg())
    assert np.array_equal(model.params, bt.rn.init_params(_cfg().shape, _cfg().seed))
    assert model.history_df(spark).collect() == []


def test_a_round_does_not_wait_for_the_barriers_second(spark):
    """Many rounds of little work: a barrier call for each would take a second each."""
    cfg = _cfg(epochs=1, batch_size=2, averaging_frequency=1, workers=2)
    blocks, _ = bt.prepare_blocks(_series(spark, 120), cfg, order="t")
    seconds = [r["seconds"] for r in bt.fit_blocks(blocks, cfg).history_df(spark).collect()]
    assert len(seconds) >= 20 and sorted(seconds)[len(seconds) // 2] < 0.5


class _Barrier:
    """A barrier of one task that counts its calls."""

    def __init__(self):
        self.calls = 0

    def taskAttemptId(self):
        return 7

    def allGather(self, text):
        self.calls += 1
        return [text]


def test_tasks_meet_through_the_barrier_where_the_folder_cannot_be_opened(tmp_path):
    for folder, calls in ((f"file:{tmp_path}/meet", 0), ("nosuch://host/meet", 6)):
        context = _Barrier()
        meet = bt._meeting(context, folder, 2)
        assert context.calls == 2
        for text in ("abc", "", "one two"):
            assert meet(text) == [text]
        assert context.calls == 2 + calls
