import numpy as np
import pytest
from pyspark.sql import functions as F

from tablelearn.plans import recurrent as rn
from tablelearn.plans.sequence_model import (
    SequenceConfig,
    SequenceModel,
    fit_sequence_model,
    forecast_table,
    prepare_series,
)


def test_gradient_matches_finite_differences():
    shape = rn.NetShape(3, 2, hidden=4, dense=3)
    p = rn.init_params(shape, 7)
    rng = np.random.default_rng(0)
    X, Y = rng.normal(size=(3, 5, 3)), rng.normal(size=(3, 5, 2))
    _, g = rn.loss_and_grad(shape, p, X, Y, l2=1e-3)
    eps = 1e-6
    num = np.empty_like(p)
    for k in range(p.size):
        d = np.zeros_like(p)
        d[k] = eps
        num[k] = (rn.loss_and_grad(shape, p + d, X, Y, l2=1e-3)[0] - rn.loss_and_grad(shape, p - d, X, Y, l2=1e-3)[0]) / (2 * eps)
    assert np.max(np.abs(num - g)) < 1e-6


def _series(spark, n=90, keys=("a",)):
    rows = []
    for k in keys:
        for t in range(n):
            base = float(10 + np.sin(t / 6.0) + (0.5 if k == "b" else 0.0))
            rows.append((k, t, base, base + 0.1, base - 0.2, base + 0.2, base + 0.05, base + 0.15, base - 0.15, base + 0.25))
    cols = "k string, t long, Open double, Close double, Low double, High double, NextOpen double, NextClose double, NextLow double, NextHigh double"
    return spark.createDataFrame(rows, cols)


def _cfg(**kw):
    base = dict(
        features=["Open", "Close", "Low", "High"],
        labels=["NextOpen", "NextClose", "NextLow", "NextHigh"],
        frame_size=6,
        batch_size=16,
        hidden=6,
        dense=5,
        epochs=4,
        learning_rate=0.01,
        split_ratio=0.9,
    )
    base.update(kw)
    return SequenceConfig(**base)


def test_loss_falls(spark):
    cfg = _cfg(epochs=6)
    frames, _ = prepare_series(_series(spark), cfg, order="t")
    model = fit_sequence_model(frames, cfg)
    losses = [h[2] for h in model.history]
    assert losses[-1] < losses[0]


def test_one_slot_equals_plain_training(spark):
    cfg = _cfg(epochs=2, workers=1, averaging_frequency=100, dtype="float64")
    frames, _ = prepare_series(_series(spark), cfg, order="t")
    model = fit_sequence_model(frames, cfg)
    shape = cfg.shape
    params, rms = rn.init_params(shape, cfg.seed), np.zeros(shape.size)
    train = sorted(
        frames.where(F.col("part") == "train").select("frame_idx", "batch_id", "x", "y").collect(),
        key=lambda r: r["frame_idx"],
    )
    for _ in range(cfg.epochs):
        for b in sorted({r["batch_id"] for r in train}):
            rows = [r for r in train if r["batch_id"] == b]
            X = np.array([r["x"] for r in rows], dtype=float)
            Y = np.array([r["y"] for r in rows], dtype=float)
            _, g = rn.loss_and_grad(shape, params, X, Y, l2=cfg.l2)
            params, rms = rn.rmsprop(params, rms, g, cfg.learning_rate, cfg.rms_decay, cfg.epsilon)
    assert np.allclose(model.params, params, atol=1e-10)
    assert np.allclose(model.rms, rms, atol=1e-12)


def test_frame_mode_and_save_load(spark, tmp_path):
    cfg = _cfg(epochs=1, dtype="float64")
    frames, stats = prepare_series(_series(spark), cfg, order="t")
    model = fit_sequence_model(frames, cfg)
    path = model.save(spark, str(tmp_path / "seq"))
    back = SequenceModel.load(spark, path)
    assert np.array_equal(back.params, model.params) and np.array_equal(back.rms, model.rms)
    assert back.config == cfg and [tuple(r) for r in back.history_df(spark).collect()] == model.history
    table = forecast_table(frames, model, stats).collect()
    assert len(table) == frames.count()
    assert {r["part"] for r in table} == {"train", "test"}
    x = np.array(frames.orderBy("frame_idx").first()["x"], dtype=float)[None]
    direct = rn.predict_last(cfg.shape, model.params, x)[0]
    first = sorted(table, key=lambda r: r["frame_idx"])[0]
    lo, hi = stats.first()["min_NextClose"], stats.first()["max_NextClose"]
    assert first["predicted"] == pytest.approx(direct[1] * (hi - lo) + lo)


def test_checkpoint_and_resume_equals_one_run(spark, tmp_path):
    cfg = _cfg(epochs=2, workers=1, averaging_frequency=100)
    frames, _ = prepare_series(_series(spark), cfg, order="t")
    full = fit_sequence_model(frames, cfg)
    half_cfg = _cfg(epochs=1, workers=1, averaging_frequency=100)
    fit_sequence_model(frames, half_cfg, checkpoint_every=1, checkpoint_path=str(tmp_path / "ck"))
    saved = SequenceModel.load(spark, str(tmp_path / "ck" / "epoch-1"), half_cfg)
    resumed = fit_sequence_model(frames, half_cfg, init=saved)
    assert np.allclose(resumed.params, full.params, atol=1e-10)


def test_dropout_training_is_repeatable(spark):
    frames, _ = prepare_series(_series(spark), _cfg(), order="t")
    a = fit_sequence_model(frames, _cfg(epochs=1, drop_prob=0.3))
    b = fit_sequence_model(frames, _cfg(epochs=1, drop_prob=0.3))
    plain = fit_sequence_model(frames, _cfg(epochs=1))
    assert np.array_equal(a.params, b.params)
    assert not np.allclose(a.params, plain.params)


def test_bounds_from_all_rows_or_training_rows(spark):
    cfg = _cfg()
    rows = _series(spark)
    _, all_stats = prepare_series(rows, cfg, order="t", since=None)
    _, kept_stats = prepare_series(
        rows.withColumn("t", F.col("t").cast("long")), cfg, order="t", stats_from="train"
    )
    assert all_stats.first()["max_Open"] == kept_stats.first()["max_Open"]  # no filter: same rows
    dated = rows.withColumn("Date", F.date_add(F.lit("2024-01-01").cast("date"), F.col("t").cast("int")))
    _, everything = prepare_series(dated, cfg, order="Date", since="2024-02-15")
    _, later = prepare_series(dated, cfg, order="Date", since="2024-02-15", stats_from="train")
    lo_all, lo_later = everything.first()["min_Open"], later.first()["min_Open"]
    assert lo_all <= lo_later
    assert lo_later == dated.where("Date >= '2024-02-15'").agg(F.min("Open")).first()[0]


def test_reference_presets():
    cfg = SequenceConfig.reference()
    assert (cfg.hidden, cfg.dense, cfg.frame_size, cfg.batch_size, cfg.epochs) == (512, 32, 50, 512, 3000)
    assert (cfg.learning_rate, cfg.drop_prob, cfg.averaging_frequency, cfg.split_ratio) == (0.05, 0.2, 4, 0.98)
    assert cfg.features == ["Open", "Close", "Low", "High"]
    assert cfg.labels == ["NextOpen", "NextClose", "NextLow", "NextHigh"]


def test_worker_averaging_is_a_plain_mean(spark):
    # 95 training frames: 12 batches, so the short last one shares its round with two full ones
    # now that batches go round the slots in order.
    frames, _ = prepare_series(_series(spark, 112), _cfg(batch_size=8), order="t")
    ex = fit_sequence_model(frames, _cfg(batch_size=8, epochs=1, workers=3, averaging_frequency=1, dtype="float64"))
    wk = fit_sequence_model(
        frames, _cfg(batch_size=8, epochs=1, workers=3, averaging_frequency=1, dtype="float64", averaging="workers")
    )
    assert ex.history[0][3] == wk.history[0][3]  # same frames seen
    assert np.all(np.isfinite(wk.params))
    assert not np.allclose(ex.params, wk.params)  # the short last batch weighs less by examples


def test_constant_column_is_named_in_the_error(spark):
    flat = _series(spark).withColumn("Open", F.lit(5.0))
    frames, _ = prepare_series(flat, _cfg(), order="t")
    with pytest.raises(Exception, match="constant="):
        fit_sequence_model(frames, _cfg(epochs=1))
    frames, _ = prepare_series(flat, _cfg(), order="t", constant=0.0)
    assert np.isfinite(fit_sequence_model(frames, _cfg(epochs=1)).params).all()


def test_model_does_not_depend_on_partitions(spark):
    frames, _ = prepare_series(_series(spark), _cfg(), order="t")
    a = fit_sequence_model(frames.repartition(1), _cfg(epochs=1))
    b = fit_sequence_model(frames.repartition(7), _cfg(epochs=1))
    assert np.array_equal(a.params, b.params)
