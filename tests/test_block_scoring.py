"""Scoring from blocks: frames from a zero state, and the carried state against one sequential pass."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from tablelearn.plans import block_scoring as bs
from tablelearn.plans import block_training as bt
from tablelearn.plans import recurrent as rn
from tablelearn.plans.sequence_model import SequenceConfig, SequenceModel, forecast_table, prepare_series


def _series(spark, sizes):
    rng = np.random.default_rng(1)
    rows = [(k, t, float(np.sin(t / 5) + rng.normal() / 9), float(rng.normal())) for k, n in sizes.items() for t in range(n)]
    return spark.createDataFrame(rows, "k string, t long, v double, w double").repartition(6)


def _cfg(**more):
    base = dict(features=["v", "w"], labels=["w", "v"], frame_size=4, hidden=3, dense=3, split_ratio=0.7, dtype="float64")
    return SequenceConfig(**{**base, **more})


def _model(cfg, forget=1.0):
    params = rn.init_params(cfg.shape, 5)
    cfg.shape.unpack(params)["b"][cfg.hidden : 2 * cfg.hidden] = forget
    return SequenceModel(cfg, params, np.zeros_like(params))


def _sequential(frames, model, key):
    out = {}
    for k in {r[key] for r in frames}:
        state = None
        for r in sorted((r for r in frames if r[key] == k), key=lambda r: r["frame_idx"]):
            x = np.array(r["x"][-1], dtype=float)[None, None, :]
            y, _, state = rn.forward(model.config.shape, model.params, x, state=state, keep=False)
            out[(k, r["frame_idx"])] = y[0, -1]
    return out


@pytest.mark.parametrize("forget,block_rows,tol,most", [(-1.0, 16, 1e-12, 8), (9.0, 80, 0.0, 8)])
def test_carried_state_equals_one_sequential_pass(spark, forget, block_rows, tol, most):
    cfg = _cfg()
    model = _model(cfg, forget)
    rows = _series(spark, {"hot": 300, "a": 31, None: 9, "short": 3})
    frames, _ = prepare_series(rows, cfg, order="t", key="k")
    blocks, _ = bt.prepare_blocks(rows, cfg, order="t", key="k", block_rows=block_rows)
    got = {(r["k"], r["frame_idx"]): np.array(r["pred"]) for r in bs.score_blocks(blocks, model, key="k", mode="carry", tol=tol).collect()}
    want = _sequential(frames.collect(), model, "k")
    assert got.keys() == want.keys()
    assert max(np.abs(got[k] - want[k]).max() for k in want) < 1e-9
    _, passes = bs.carry_states(blocks, model, key="k", tol=tol)
    assert passes[-1][1] == 0 and len(passes) <= most
    assert all(a >= b for (_, a), (_, b) in zip(passes, passes[1:]))


def test_a_network_that_never_forgets_takes_few_passes(spark):
    """Its cells add up what they see, so every block's first state depends on all blocks before it."""
    cfg = _cfg()
    model = _model(cfg, 9.0)
    rows = _series(spark, {"hot": 1500, None: 40})
    blocks, _ = bt.prepare_blocks(rows, cfg, order="t", key="k", block_rows=16)
    states, passes = bs.carry_states(blocks, model, key="k")
    assert passes[-1][1] == 0 and len(passes) <= 6  # one for each of the 94 blocks before
    got = {(r["k"], r["frame_idx"]): np.array(r["pred"]) for r in bs.score_blocks(blocks, model, key="k", mode="carry", states=states).collect()}
    want = _sequential(prepare_series(rows, cfg, order="t", key="k")[0].collect(), model, "k")
    assert got.keys() == want.keys() and max(np.abs(got[k] - want[k]).max() for k in want) < 1e-9


def test_the_plan_of_the_states_does_not_grow_with_the_passes(spark):
    cfg = _cfg()
    blocks, _ = bt.prepare_blocks(_series(spark, {"a": 200, "b": 90}), cfg, order="t", key="k", block_rows=8)
    states, _ = bs.carry_states(blocks, _model(cfg, 9.0), key="k")
    plan = states._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Relation") == 1 and "Union" not in plan and "Aggregate" not in plan


def test_states_that_are_no_numbers_settle_too(spark):
    cfg = _cfg()
    rows = _series(spark, {"a": 60}).withColumn("v", F.when(F.col("t") == 30, F.lit(float("nan"))).otherwise(F.col("v")))
    blocks, _ = bt.prepare_blocks(rows, cfg, order="t", key="k", block_rows=8)
    blocks = blocks.withColumn("x", F.transform("x", lambda r: F.transform(r, lambda v: F.coalesce(v, F.lit(float("nan"))))))
    _, passes = bs.carry_states(blocks, _model(cfg), key="k")
    assert passes[-1][1] == 0


def test_frame_mode_equals_scoring_of_stored_frames(spark):
    cfg = _cfg()
    model = _model(cfg)
    rows = _series(spark, {"only": 90})
    frames, stats = prepare_series(rows, cfg, order="t")
    blocks, _ = bt.prepare_blocks(rows, cfg, order="t", block_rows=11)
    want = {r["frame_idx"]: r for r in forecast_table(frames, model, stats, label="w").collect()}
    got = {r["frame_idx"]: r for r in bs.forecast_blocks(blocks, model, stats, label="w").collect()}
    assert got.keys() == want.keys()
    for i, r in got.items():
        assert (r["time"], r["part"]) == (want[i]["time"], want[i]["part"])
        assert r["actual"] == pytest.approx(want[i]["actual"]) and r["predicted"] == pytest.approx(want[i]["predicted"])


def test_too_short_series_give_no_rows(spark):
    cfg = _cfg()
    blocks, _ = bt.prepare_blocks(_series(spark, {"a": 3}), cfg, order="t")
    for mode in ("frame", "carry"):
        assert bs.score_blocks(blocks, _model(cfg), mode=mode).collect() == []


def test_events_whose_low_is_the_same_every_day_are_forecast(spark, tmp_path):
    """A day of many events has the least value there is as its Low, whatever the day."""
    from tablelearn.plans.queries import q_forecast_events_carry

    rows = []
    for d in range(12):
        day = f"2024-01-{d + 1:02d}"
        values = {"usual": (3.0 + d, 2.0 + d % 3, 9.0 + d % 4), "low": (5.0 + d % 5, 0.0, 7.0 + d), "flat": (4.0, 4.0, 4.0)}
        rows += [(len(rows) + i, f"{day} {i:02d}:00:00", kind, v) for kind, vs in values.items() for i, v in enumerate(vs)]
    events = spark.createDataFrame(rows, "event_id long, ts string, event_type string, value double")
    events.withColumn("ts", F.to_timestamp("ts")).write.parquet(f"{tmp_path}/events.parquet")
    got = q_forecast_events_carry(spark, str(tmp_path)).collect()
    per_type = {k: [r for r in got if r["event_type"] == k] for k in ("usual", "low", "flat")}
    assert len({len(v) for v in per_type.values()}) == 1 and len(got) == 3 * len(per_type["low"]) > 0
    assert all(np.isfinite([r["actual"], r["predicted"]]).all() for r in got)
    assert {r["actual"] for r in per_type["low"]} > {12.0} and all(r["actual"] == r["predicted"] == 4.0 for r in per_type["flat"])
