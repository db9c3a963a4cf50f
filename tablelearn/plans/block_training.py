"""Data-parallel training of the sequence model from series blocks.

* ``prepare_blocks`` (L1) stores the scaled rows once, in blocks that end with the next
  ``frame_size - 1`` rows. Frames are never stored: a trainer looks at a block through a
  sliding view.
* ``fit_blocks`` (L6, L7) runs an epoch as one Spark job. Mini-batches are cut from the blocks,
  dealt to ``workers`` slots by their number and sorted by averaging round inside the tasks of
  one barrier stage. After each round the tasks exchange their slots' parameters and optimiser
  state (small files in the shared scratch folder; ``allGather`` where tasks cannot open it) and
  every task takes the same ordered average, so nothing goes to the driver before the epoch ends
  and all tasks go on from equal parameters.
* The job's output is the epoch's state and its rounds. It is committed as a version of the
  run's ``ModelStore``: the history (L10) is a table that grows by epoch and can be read while
  training runs, and a run that was ended at any point goes on from its last whole epoch.

A slot is a place in the average, not a core: a task takes several slots where there are fewer
cores than slots, with the same result. If a task of the barrier stage is lost, Spark runs the
stage, and with it the epoch, again from the state the epoch began with.

A barrier stage needs all its tasks at once, which Spark does not offer under dynamic
allocation; ``sequence_model.fit_sequence_model`` trains without one, a job per round.
"""

from __future__ import annotations

import base64
import itertools
import json
import time
from dataclasses import asdict

import numpy as np
import pyarrow as pa
import pyarrow.fs as pafs
from pyspark import BarrierTaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tablelearn import functions as tf
from tablelearn.operators import features as feat
from tablelearn.operators import shaping
from tablelearn.operators.blocks import BLOCK_ROWS, series_blocks
from tablelearn.operators.joins import join_small
from tablelearn.operators.sequence import frame_count
from tablelearn.plans import recurrent as rn
from tablelearn.plans.model_store import ModelStore
from tablelearn.plans.sequence_model import SequenceConfig, SequenceModel
from tablelearn.session import default_parallelism, materialize, scratch_path

# Characters of one exchange between the tasks of a barrier stage, for all tasks together.
EXCHANGE_CHARS = 32 * 1024 * 1024

# --------------------------------------------------------------------------- L1


def prepare_blocks(
    rows: DataFrame,
    cfg: SequenceConfig,
    *,
    order: str | list[str] = "Date",
    key: str | None = None,
    since: str | None = None,
    stats_from: str = "all",
    constant: float | None = None,
    block_rows: int = BLOCK_ROWS,
) -> tuple[DataFrame, DataFrame]:
    """L1 without frames: ``(blocks, stats)``, where ``blocks`` are the ``series_blocks`` of the
    scaled rows with ``n_frames`` and ``n_train`` (the frames of the chronological split's first
    part). Bounds, ``since``, ``stats_from`` and ``constant`` as in ``prepare_series``."""
    cols = list(dict.fromkeys(cfg.features + cfg.labels))
    order = [order] if isinstance(order, str) else list(order)
    kept = shaping.since(rows, order[0], since) if since else rows
    stats = feat.minmax_stats(rows if stats_from == "all" else kept, cols, key)
    keys = [key] if key else []
    others = [c for c in order if c not in cols]
    scaled = feat.minmax_scale(kept.select(*keys, *others, *cols), cols, stats, key=key, constant=constant)
    blocks = series_blocks(
        scaled, order, cfg.features, overlap=cfg.frame_size - 1, key=key, labels=cfg.labels, block_rows=block_rows
    )
    blocks = blocks.withColumn("n_frames", frame_count(cfg.frame_size))
    return blocks.withColumn("n_train", tf.floor_share("n_frames", cfg.split_ratio).cast("long")), stats


def training_pieces(blocks: DataFrame, cfg: SequenceConfig, key: str | None = None) -> DataFrame:
    """``round, slot, number, begin, x, y``: the training rows of each mini-batch, one row per
    block that the batch lies in, each with the ``frame_size - 1`` rows behind its frames.

    Batches of several keys are numbered one key after the other; they go round the slots, and
    ``averaging_frequency`` turns make a round."""
    size, batch = cfg.frame_size, cfg.batch_size
    cut = blocks.where(F.col("n_train") > F.col("_first"))
    number = F.col("_batch")
    if key:
        per_key = cut.groupBy(key).agg(F.ceil(F.max("n_train") / batch).alias("_batches"))
        before = Window.orderBy(F.col(key).asc_nulls_first()).rowsBetween(Window.unboundedPreceding, -1)
        per_key = per_key.select(key, F.coalesce(F.sum("_batches").over(before), F.lit(0)).alias("_before"))
        cut = join_small(cut, per_key, on=[key])
        number = number + F.col("_before")
    last = F.least(F.col("_first") + F.col("_own"), F.col("n_train"))
    cut = cut.withColumn("_last", last).withColumn(
        "_batch",
        F.explode(F.sequence(F.floor(F.col("_first") / batch).cast("long"), F.floor((F.col("_last") - 1) / batch).cast("long"))),
    )
    begin = F.greatest(F.col("_first"), F.col("_batch") * batch)
    frames = F.least(F.col("_last"), (F.col("_batch") + 1) * batch) - begin
    at = (begin - F.col("_first") + 1).cast("int")
    length = (frames + size - 1).cast("int")
    return cut.select(
        F.floor(number / F.lit(cfg.workers * cfg.averaging_frequency)).cast("int").alias("round"),
        F.pmod(number, F.lit(cfg.workers)).cast("int").alias("slot"),
        number.cast("long").alias("number"),
        begin.alias("begin"),
        F.slice("x", at, length).alias("x"),
        F.slice("y", at, length).alias("y"),
    )


# --------------------------------------------------------------------------- in tasks


def _matrices(column: pa.ListArray, width: int):
    """Each row's list of steps as a ``[steps, width]`` matrix; missing values are NaN."""
    lengths = column.value_lengths().to_numpy(zero_copy_only=False)
    values = column.flatten().flatten().to_numpy(zero_copy_only=False).reshape(-1, width)
    ends = np.cumsum(lengths)
    return [values[e - n : e] for e, n in zip(ends, lengths)]


def frames_of(rows: np.ndarray, size: int, dtype) -> np.ndarray:
    """``[frames, size, width]`` from consecutive rows."""
    view = np.lib.stride_tricks.sliding_window_view(rows, size, axis=0)
    return np.ascontiguousarray(view.transpose(0, 2, 1), dtype=dtype)


def _meeting(context, folder: str, chunks: int):
    """How the tasks of a barrier stage tell each other a text: a function from a task's own text to
    the texts of all tasks, in their order.

    A barrier call of Spark takes a second, however little it carries. The texts go through small
    files in the shared scratch folder instead, where every task can open it; two barrier calls
    find that out. Where one cannot, each exchange is ``chunks`` barrier calls."""
    me, place = str(context.taskAttemptId()), None
    try:
        files, place = pafs.FileSystem.from_uri(folder)
        files.create_dir(place, recursive=True)
        with files.open_output_stream(f"{place}/{me}-ready") as f:
            f.write(b"1")
        told = context.allGather(me)
    except (OSError, ValueError, ImportError, NotImplementedError):
        told = context.allGather("")
    seen = "" not in told and all(
        i.type == pafs.FileType.File for i in files.get_file_info([f"{place}/{task}-ready" for task in told])
    )
    shared = set(context.allGather(str(seen))) == {"True"}

    def by_barrier(text: str) -> list[str]:
        step = -(-len(text) // chunks) if text else 1
        out = [""] * len(told)
        for c in range(chunks):
            for task, part in enumerate(context.allGather(text[c * step : (c + 1) * step])):
                out[task] += part
        return out

    turns = itertools.count()

    def by_files(text: str) -> list[str]:
        turn, out = next(turns), []
        with files.open_output_stream(f"{place}/{me}-{turn}-part") as f:
            f.write(text.encode())
        files.move(f"{place}/{me}-{turn}-part", f"{place}/{me}-{turn}")
        for task in told:
            pause = 0.0005
            while True:  # Spark ends all tasks of the stage if one of them fails
                try:
                    with files.open_input_stream(f"{place}/{task}-{turn}") as f:
                        out.append(f.read().decode())
                    break
                except FileNotFoundError:
                    time.sleep(pause)
                    pause = min(2 * pause, 0.02)
        if turn:  # everyone has written this turn's file, so everyone has read the one before
            files.delete_file(f"{place}/{me}-{turn - 1}")
        return out

    return by_files if shared else by_barrier


def _exchange(meet, mine: list[tuple]) -> list[tuple]:
    """All tasks' ``(slot, frames, loss, vector bytes)``, in order of the slots."""
    text = "\n".join(f"{slot} {n} {float(loss).hex()} {base64.b64encode(vec).decode()}" for slot, n, loss, vec in mine)
    lines = [line.split(" ") for t in meet(text) if t for line in t.split("\n")]
    found = [(int(s), int(n), float.fromhex(loss), base64.b64decode(vec)) for s, n, loss, vec in lines]
    return sorted(found, key=lambda r: r[0])


_EPOCH = pa.schema(
    [
        ("kind", pa.string()), ("epoch", pa.int32()), ("round", pa.int32()), ("loss", pa.float64()),
        ("n_frames", pa.int64()), ("seconds", pa.float64()), ("offset", pa.int64()),
        ("params", pa.list_(pa.float64())), ("rms", pa.list_(pa.float64())),
    ]
)
_EPOCH_SQL = (
    "kind string, epoch int, round int, loss double, n_frames long, seconds double, "
    "offset long, params array<double>, rms array<double>"
)


def _epoch_trainer(cfg: SequenceConfig, state, epoch: int, rounds: int, tasks: int, folder: str):
    """The function of one barrier task; ``state`` is the broadcast vector of parameters and
    optimiser state the epoch begins with, ``folder`` the shared one the tasks may meet in."""
    shape, dt = cfg.shape, np.dtype(cfg.dtype)
    if cfg.averaging not in ("examples", "workers"):
        raise ValueError("averaging must be 'examples' or 'workers'")
    slots_a_task = -(-cfg.workers // tasks)
    chars = slots_a_task * (2 * shape.size * dt.itemsize * 4 // 3 + 100) * tasks
    chunks = max(1, -(-chars // EXCHANGE_CHARS))

    def pieces(batches):
        for b in batches:
            fixed = zip(*[b.column(c).to_pylist() for c in ("round", "slot", "number")])
            yield from zip(fixed, _matrices(b.column("x"), shape.n_in), _matrices(b.column("y"), shape.n_out))

    def train_slot(params, rms, seed, batches):
        """Steps through one slot's mini-batches of a round."""
        params, rms = params.astype(dt), rms.astype(dt)
        rng = np.random.default_rng(seed)
        loss_sum, n = 0.0, 0
        for _, parts in itertools.groupby(batches, key=lambda p: p[0][2]):
            parts = list(parts)
            X = np.concatenate([frames_of(x, cfg.frame_size, dt) for _, x, _ in parts])
            Y = np.concatenate([frames_of(y, cfg.frame_size, dt) for _, _, y in parts])
            mask = rn.dropout_mask(rng, X.shape, cfg.drop_prob)
            if not (np.isfinite(X).all() and np.isfinite(Y).all()):
                raise ValueError(
                    "a training frame holds NULL or NaN: a column of one value scales to NULL unless "
                    "prepare_blocks gets constant=, and incomplete rows have to be dropped first"
                )
            loss, grad = rn.loss_and_grad(shape, params, X, Y, l2=cfg.l2, mask=mask)
            params, rms = rn.rmsprop(params, rms, grad, cfg.learning_rate, cfg.rms_decay, cfg.epsilon)
            loss_sum += loss * len(X)
            n += len(X)
        return n, loss_sum, np.concatenate([params, rms]).astype(dt).tobytes()

    def train(batches):
        context = BarrierTaskContext.get()
        meet = _meeting(context, folder, chunks)
        first = context.partitionId() == 0
        size = shape.size
        params, rms = state.value[:size], state.value[size:]
        by_round = itertools.groupby(pieces(batches), key=lambda p: p[0][0])
        waiting = next(by_round, None)
        for r in range(rounds):
            begun, mine = time.time(), []
            if waiting and waiting[0] == r:
                for slot, rows in itertools.groupby(waiting[1], key=lambda p: p[0][1]):
                    mine.append((slot, *train_slot(params, rms, [cfg.seed + epoch * 100003 + r, slot], rows)))
                waiting = next(by_round, None)
            total, weight, n, loss = None, 0.0, 0, 0.0
            for _, frames, slot_loss, vec in _exchange(meet, mine):
                w = float(frames) if cfg.averaging == "examples" else 1.0
                part = np.frombuffer(vec, dt).astype(np.float64) * w
                total = part if total is None else total + part
                weight, n, loss = weight + w, n + frames, loss + slot_loss
            if total is None:
                continue
            total /= weight
            params, rms = total[:size], total[size:]
            if first:
                row = {"kind": "round", "epoch": epoch, "round": r, "loss": loss / n, "n_frames": n, "seconds": time.time() - begun}
                yield pa.RecordBatch.from_pylist([row], _EPOCH)
        if first:
            step = cfg.chunk_size
            for i in range(0, size, step):
                row = {"kind": "state", "epoch": epoch, "offset": i, "params": params[i : i + step].tolist(), "rms": rms[i : i + step].tolist()}
                yield pa.RecordBatch.from_pylist([row], _EPOCH)

    return train


# --------------------------------------------------------------------------- L6, L7


def fit_blocks(
    blocks: DataFrame,
    cfg: SequenceConfig,
    *,
    key: str | None = None,
    init: SequenceModel | None = None,
    run_path: str | None = None,
) -> SequenceModel:
    """M10 from ``prepare_blocks``: ``cfg.epochs`` epochs in all, each one Spark job.

    Every epoch is a version of the run at ``run_path`` (default: a fresh scratch folder). A run
    that already has versions goes on behind the newest whole one, so training that was ended,
    and training that is asked for more epochs, come to the same parameters as one run.
    ``init`` gives the state a fresh run begins with."""
    spark = blocks.sparkSession
    store = ModelStore(spark, run_path or scratch_path(spark, "training-run"))
    newest = store.newest()
    if newest:
        begun = SequenceModel.load(spark, store.root)
        params, rms, start = begun.params, begun.rms, newest["number"] + 1
    elif init is not None:
        params, rms, start = init.params, init.rms, 0
    else:
        params, rms, start = rn.init_params(cfg.shape, cfg.seed), np.zeros(cfg.shape.size), 0
    if params.size != cfg.shape.size:
        raise ValueError("the run's parameters do not fit the network")
    pieces = training_pieces(blocks, cfg, key)
    last = pieces.agg(F.max("round")).first()[0]
    rounds = 0 if last is None else int(last) + 1
    tasks = max(1, min(cfg.workers, default_parallelism(spark)))
    dealt = pieces.repartitionById(tasks, F.pmod("slot", F.lit(tasks)).cast("int")).sortWithinPartitions(
        "round", "slot", "number", "begin"
    )
    for epoch in range(start, cfg.epochs if rounds else 0):
        state = spark.sparkContext.broadcast(np.concatenate([params, rms]))
        out = materialize(
            dealt.mapInArrow(
                _epoch_trainer(cfg, state, epoch, rounds, tasks, scratch_path(spark, "training-exchange")), _EPOCH_SQL, barrier=True
            ),
            "training-epoch",
        )
        state.destroy()
        weights = out.where("kind = 'state'").select("offset", "params", "rms")
        history = out.where("kind = 'round'").select("epoch", "round", "loss", "n_frames", "seconds")
        store.save({"weights": weights.coalesce(1), "history": history.coalesce(1)}, epoch, config=json.dumps(asdict(cfg)))
        trained = SequenceModel.load(spark, store.root)
        params, rms = trained.params, trained.rms
    return SequenceModel(cfg, params, rms, run=store.root)
