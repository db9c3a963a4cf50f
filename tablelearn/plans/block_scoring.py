"""Scoring and forecasts of the sequence model from series blocks.

``mode="frame"`` scores every frame from a zero state; a block is read through a sliding view.

``mode="carry"`` steps through a series' frames with the network's state carried on, as the
reference scores. The recurrence runs along the series, so it is solved as a fixed point over
blocks. Blocks that a task reads together and that follow one another form a run. In the first
pass all blocks of all series start from a zero state at once; inside the task, blocks whose
incoming state is not the one that the block before them ends with start again, until the run
agrees with itself. A change that goes into a block is taken on to the blocks behind it at once
by the part of it that the cells keep (the product of each cell's own slope over the block's
steps), so a network that adds up its past settles as fast as one that forgets. Between the
runs the same is done with a row for each: runs that begin with another state than the one
before them ends with go again in the next pass, until none does. What remains satisfies the
recurrence at every block border, so it is the sequential result (to ``tol`` of a state's size,
at least ``tol``, at each border; exactly with ``tol=0``). Slopes only choose the states that
are tried: the first block of a run that is not settled always starts from an exact state, so
no network takes more passes than there are runs, nor more steps than one for each block.

A task steps through all blocks of an Arrow batch together, one array operation for a step, in
double precision: how many blocks share an operation must not show in the states.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from tablelearn.operators import features as feat
from tablelearn.operators.joins import join_small
from tablelearn.plans import recurrent as rn
from tablelearn.plans.block_training import _matrices, frames_of
from tablelearn.plans.sequence_model import SequenceModel
from tablelearn.session import materialize

_FRAMES = 1024  # frames scored in one array operation
_VECTOR = pa.list_(pa.float64())


def _vectors(rows: np.ndarray) -> pa.Array:
    """A matrix as one list per row."""
    offsets = np.arange(len(rows) + 1) * rows.shape[1]
    return pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(rows.ravel(), pa.float64()))


def _scoreable(blocks: DataFrame, key: str | None) -> DataFrame:
    """Blocks in which frames begin, with the number of these frames."""
    frames = F.least(F.col("_own"), F.col("n_frames") - F.col("_first"))
    keys = [key] if key else []
    return blocks.where(F.col("n_frames") > F.col("_first")).select(*keys, "_first", "n_train", frames.alias("_frames"), "x", "y")


def _schema(blocks: DataFrame, key: str | None, columns: dict[str, str]) -> str:
    named = {key: blocks.schema[key].dataType.simpleString()} if key else {}
    return ", ".join(f"`{c}` {t}" for c, t in {**named, **columns}.items())


def _scored_batch(batch, key, frames: np.ndarray, preds: np.ndarray, actual: np.ndarray) -> pa.RecordBatch:
    """One row per frame from the blocks of a batch."""
    block = np.repeat(np.arange(len(frames)), frames)
    first = batch.column("_first").to_numpy()[block]
    idx = first + np.arange(len(block)) - np.repeat(np.cumsum(frames) - frames, frames)
    train = idx < batch.column("n_train").to_numpy()[block]
    columns = {key: batch.column(key).take(pa.array(block))} if key else {}
    columns |= {
        "frame_idx": pa.array(idx, pa.int64()),
        "part": pa.array(np.where(train, "train", "test"), pa.string()),
        "actual": _vectors(actual),
        "pred": _vectors(preds),
    }
    return pa.RecordBatch.from_arrays(list(columns.values()), names=list(columns))


def score_blocks(
    blocks: DataFrame,
    model: SequenceModel,
    *,
    key: str | None = None,
    mode: str = "frame",
    tol: float = 1e-12,
    states: DataFrame | None = None,
) -> DataFrame:
    """``key?, frame_idx, part, actual, pred`` with the scaled labels and predictions
    (``array<double>``) at the last step of every frame of ``prepare_blocks``. ``states`` are
    those of ``carry_states``, where they are known already."""
    if mode not in ("frame", "carry"):
        raise ValueError("mode must be 'frame' or 'carry'")
    cfg = model.config
    size, shape = cfg.frame_size, cfg.shape
    kind = np.dtype(cfg.dtype if mode == "frame" else "float64")
    params = blocks.sparkSession.sparkContext.broadcast(model.params.astype(kind))
    rows = _scoreable(blocks, key)
    schema = _schema(blocks, key, {"frame_idx": "long", "part": "string", "actual": "array<double>", "pred": "array<double>"})

    def last_labels(batch, frames):
        labels = _matrices(batch.column("y"), shape.n_out)
        return np.concatenate([y[size - 1 : size - 1 + n] for y, n in zip(labels, frames)])

    def each_frame(batches):
        for b in batches:
            frames = b.column("_frames").to_numpy()
            preds = []
            for x, n in zip(_matrices(b.column("x"), shape.n_in), frames):
                for i in range(0, n, _FRAMES):
                    some = x[i : min(i + _FRAMES, n) + size - 1]
                    preds.append(rn.predict_last(shape, params.value, frames_of(some, size, np.float64)))
            if preds:
                yield _scored_batch(b, key, frames, np.concatenate(preds), last_labels(b, frames))

    if mode == "frame":
        return rows.mapInArrow(each_frame, schema)

    if states is None:
        states, _ = carry_states(blocks, model, key=key, tol=tol)
    rows = join_small(rows, states, on=[*([key] if key else []), "_first"], how="left")

    def carried(batches):
        for b in batches:
            if b.num_rows:
                preds, _, _ = _walk(b, shape, params.value, size)
                frames = b.column("_frames").to_numpy()
                yield _scored_batch(b, key, frames, preds, last_labels(b, frames))

    return rows.mapInArrow(carried, schema)


def _walk(batch, shape: rn.NetShape, flat: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """All blocks of a batch step by step from their states ``h, c`` (null: zero): predictions
    one block after the other, and each block's last state."""
    frames = batch.column("_frames").to_numpy()
    x = np.concatenate([m[size - 1 : size - 1 + n] for m, n in zip(_matrices(batch.column("x"), shape.n_in), frames)])
    begin = np.cumsum(frames) - frames
    h, c = (np.zeros((len(frames), shape.hidden), flat.dtype) for _ in range(2))
    for name, state in (("h", h), ("c", c)):
        for i, v in enumerate(batch.column(name).to_pylist()):
            if v is not None:
                state[i] = v
    preds = np.empty((len(x), shape.n_out))
    longest = np.argsort(-frames, kind="stable")
    left = -frames[longest]
    for t in range(int(frames.max())):
        on = longest[: np.searchsorted(left, -t)]  # blocks of more than t frames
        y, _, (h[on], c[on]) = rn.forward(shape, flat, x[begin[on] + t][:, None, :], state=(h[on], c[on]), keep=False)
        preds[begin[on] + t] = y[:, -1, :]
    return preds, h, c


def _near(a: np.ndarray, b: np.ndarray, tol: float) -> bool:
    """Whether two states agree to ``tol`` of their size (missing values agree with each other)."""
    with np.errstate(invalid="ignore"):
        off = np.abs(a - b) <= tol * np.maximum(1.0, np.maximum(np.abs(a), np.abs(b)))
    return bool((off | (a == b) | (np.isnan(a) & np.isnan(b))).all())


def _taken_on(slope: np.ndarray, change: np.ndarray) -> np.ndarray:
    """What is left of a change of cells behind a block (nothing where that is no number)."""
    with np.errstate(over="ignore", invalid="ignore"):
        left = slope * change
    return np.where(np.isfinite(left), left, 0.0)


def _ends(shape: rn.NetShape, flat: np.ndarray, xs: list[np.ndarray], h: np.ndarray, c: np.ndarray):
    """Last states ``h, c`` of blocks from their first ones, and the slope of each cell's last value
    over its first one along the cell itself. The steps are those of ``recurrent.forward``."""
    p, size = shape.unpack(flat), shape.hidden
    lengths = np.array([len(x) for x in xs])
    order = np.argsort(-lengths, kind="stable")
    lengths = lengths[order]
    h, c, d = h[order], c[order], np.ones_like(c)
    steps = int(max(1, min(256, (1 << 22) // (len(xs) * 4 * size))))
    for begin in range(0, int(lengths[0]), steps):
        some = int(np.searchsorted(-lengths, -begin))  # blocks of more than ``begin`` frames
        x = np.zeros((steps, some, shape.n_in))
        for k in range(some):
            part = xs[order[k]][begin : begin + steps]
            x[: len(part), k] = part
        zx = x @ p["W"]
        for t in range(min(steps, int(lengths[0]) - begin)):
            on = int(np.searchsorted(-lengths, -(begin + t)))
            hv, cv = h[:on], c[:on]
            z = zx[t, :on] + hv @ p["R"] + p["b"]
            i = rn._hs(z[:, :size] + cv * p["pi"])
            f = rn._hs(z[:, size : 2 * size] + cv * p["pf"])
            g = np.tanh(z[:, 3 * size :])
            d[:on] *= f + 0.2 * (cv * p["pf"] * ((f > 0) & (f < 1)) + g * p["pi"] * ((i > 0) & (i < 1)))
            cv = f * cv + i * g
            c[:on] = cv
            o = rn._hs(z[:, 2 * size : 3 * size] + cv * p["po"])
            h[:on] = o * np.tanh(cv)
    back = np.empty_like(order)
    back[order] = np.arange(len(order))
    return h[back], c[back], d[back]


def _settled(batch, key: str | None, shape: rn.NetShape, flat: np.ndarray, size: int, tol: float) -> dict[str, list]:
    """The blocks of a batch with the state each begins with (``_first, _head, h, c``), and behind
    each run a row with the state it ends with, the state it began with, and its cells' slopes."""
    first, frames = (batch.column(name).to_numpy() for name in ("_first", "_frames"))
    codes = batch.column(key).dictionary_encode("encode").indices.to_numpy() if key else np.zeros(len(first), np.int64)
    order = np.lexsort((first, codes))
    first, frames, codes = first[order], frames[order], codes[order]
    linked = np.concatenate([[False], (codes[1:] == codes[:-1]) & (first[1:] == first[:-1] + frames[:-1])])
    matrices = _matrices(batch.column("x"), shape.n_in)
    xs = [matrices[k][size - 1 : size - 1 + n] for k, n in zip(order, frames)]
    h, c = (np.zeros((len(first), shape.hidden)) for _ in range(2))
    for name, state in (("h", h), ("c", c)):
        given = batch.column(name).to_pylist()
        for i, k in enumerate(order):
            if given[k] is not None:
                state[i] = given[k]
    last_h, last_c, slope = np.empty_like(h), np.empty_like(c), np.empty_like(c)
    again = np.arange(len(first))
    with np.errstate(over="ignore", invalid="ignore"):
        while len(again):
            last_h[again], last_c[again], slope[again] = _ends(shape, flat, [xs[k] for k in again], h[again], c[again])
            moved, change = [], np.zeros(shape.hidden)
            for j in range(int(again[0]) + 1, len(first)):
                if not linked[j]:
                    change = np.zeros(shape.hidden)
                    continue
                new_h, new_c = last_h[j - 1], last_c[j - 1] + change
                if _near(new_h, h[j], tol) and _near(new_c, c[j], tol):
                    change = np.zeros(shape.hidden)
                    continue
                change = _taken_on(slope[j], new_c - c[j])
                h[j], c[j] = new_h, new_c
                moved.append(j)
            again = np.array(moved, np.int64)
    out: dict[str, list] = {name: [] for name in ("_row", "_first", "_head", "h", "c", "h0", "c0", "d")}
    starts = np.flatnonzero(~linked)
    for start, end in zip(starts, np.append(starts[1:], len(first))):
        for j in range(start, end):
            for name, value in zip(out, (order[j], first[j], first[start], h[j], c[j], None, None, None)):
                out[name].append(value)
        with np.errstate(over="ignore", invalid="ignore"):
            kept = np.prod(slope[start:end], axis=0)
        behind = first[end - 1] + frames[end - 1]
        whole = (order[start], behind, first[start], last_h[end - 1], last_c[end - 1], h[start], c[start], kept)
        for name, value in zip(out, whole):
            out[name].append(value)
    return out


def carry_states(
    blocks: DataFrame, model: SequenceModel, *, key: str | None = None, tol: float = 1e-12
) -> tuple[DataFrame, list[tuple[int, int]]]:
    """The state each block begins with, ``key?, _first, h, c``, and ``(pass, runs of blocks that
    begin with another state than the one before them ends with)`` of every pass."""
    cfg = model.config
    size, shape = cfg.frame_size, cfg.shape
    keys = [key] if key else []
    at, run = [*keys, "_first"], [*keys, "_head"]
    params = blocks.sparkSession.sparkContext.broadcast(model.params.astype(np.float64))
    rows = _scoreable(blocks, key).drop("y", "n_train")
    vectors = ("h", "c", "h0", "c0", "d")
    kinds = {"_first": "long", "_head": "long", **{name: "array<double>" for name in vectors}}
    key_type = to_arrow_type(blocks.schema[key].dataType) if key else None

    def settle(batches):
        for b in batches:
            if b.num_rows:
                found = _settled(b, key, shape, params.value, size, tol)
                columns = {key: b.column(key).cast(key_type).take(pa.array(found["_row"], pa.int64()))} if key else {}
                columns |= {name: pa.array(found[name], pa.int64()) for name in ("_first", "_head")}
                columns |= {name: pa.array(found[name], _VECTOR) for name in vectors}
                yield pa.RecordBatch.from_arrays(list(columns.values()), names=list(columns))

    def sweep(frame: pd.DataFrame) -> pd.DataFrame:
        """The runs of a series that begin with another state than the one before them ends with."""
        frame = frame.sort_values("_head", ignore_index=True)
        moved, h, c = [], None, None
        for k, row in enumerate(frame.itertuples(index=False)):
            change = np.zeros(shape.hidden)
            if h is not None and not (_near(h, row.h0, tol) and _near(c, row.c0, tol)):
                moved.append((k, h, c))
                change = _taken_on(row.d, c - row.c0)
            h, c = row.h, row.c + change
        out = frame.loc[[k for k, _, _ in moved], run].reset_index(drop=True)
        return out.assign(h=pd.Series([list(v) for _, v, _ in moved], dtype=object), c=pd.Series([list(v) for *_, v in moved], dtype=object))

    zero = F.lit(None).cast("array<double>")
    todo = rows.withColumn("h", zero).withColumn("c", zero)
    known, passes = None, []
    while True:
        out = materialize(todo.mapInArrow(settle, _schema(blocks, key, kinds)), "carry-runs")
        if known is None:
            known = out
        else:
            # What the pass before knew of the runs that went again is replaced.
            gone = moved.select(*run, F.lit(True).alias("_again"))
            kept = join_small(known, gone, on=run, how="left").where("_again is null").drop("_again")
            known = materialize(kept.unionByName(out), "carry-known")
        # One row per run: a run is what a task reads together of a series, many blocks.
        runs = known.where("d is not null").select(*run, *vectors)
        moved = runs.groupBy(*keys).applyInPandas(sweep, _schema(blocks, key, {"_head": "long", "h": "array<double>", "c": "array<double>"}))
        moved = materialize(moved, "carry-moved")
        passes.append((len(passes) + 1, moved.count()))
        if not passes[-1][1]:
            break
        # Only the blocks of these runs go again, the first from its new state, the others from their last.
        fresh = moved.select(*run, F.col("h").alias("_h"), F.col("c").alias("_c"))
        states = join_small(known.where("d is null").select(*at, "_head", "h", "c"), fresh, on=run)
        leads = F.col("_first") == F.col("_head")
        states = states.select(*at, *[F.when(leads, F.col(f"_{v}")).otherwise(F.col(v)).alias(v) for v in ("h", "c")])
        todo = join_small(rows, states, on=at)
    params.destroy()
    return known.where("d is null").select(*at, "h", "c"), passes


def forecast_blocks(
    blocks: DataFrame,
    model: SequenceModel,
    stats: DataFrame,
    *,
    label: str = "NextClose",
    key: str | None = None,
    mode: str = "frame",
) -> DataFrame:
    """L9 (+ C5, C6, W2): ``key?, frame_idx, time, part, actual, predicted`` for one label, unscaled.

    ``time`` is the reference's counter (1-based over training then test frames)."""
    keys = [key] if key else []
    j = model.config.labels.index(label) + 1
    scored = score_blocks(blocks, model, key=key, mode=mode).select(
        *keys, "frame_idx", "part", F.element_at("actual", j).alias("actual"), F.element_at("pred", j).alias("predicted")
    )
    out = feat.minmax_unscale(scored, ["actual", "predicted"], stats, stat_cols=[label, label], key=key)
    return out.select(*keys, "frame_idx", (F.col("frame_idx") + 1).alias("time"), "part", "actual", "predicted")
