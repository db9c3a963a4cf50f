"""The data-parallel sequence regressor (M10, L1-L3, L6-L10) as Spark jobs.

* ``prepare_series`` (L1): min-max bounds (from all rows by default), the
  since-filter, scaling, sliding frames, the chronological split and
  mini-batch numbers, all distributed (no rows go to the driver).
* ``fit_sequence_model`` (L6, L7, L10) trains from stored frames, one Spark job per
  averaging round: ``groupBy(slot).applyInPandas`` trains from the broadcast
  parameters and RMSProp state, each slot emits its result in chunks, and a
  ``groupBy(chunk)`` sum gives the example-weighted average. It needs no barrier
  stage; ``block_training.fit_blocks`` comes to the same parameters from the rows
  themselves with one job per epoch and is what the programs use.
* ``predict_sequence`` (L8) scores every frame from a zero state; scoring with a
  carried state is in ``block_scoring``.
* ``forecast_table`` (L9): actual and predicted value of one label at each
  frame's last step, unscaled with that label's bounds.
"""

from __future__ import annotations

import json
import time
from dataclasses import asdict, dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType, LongType, StructField, StructType

from tablelearn.operators import features as feat
from tablelearn.operators import report, sequence, shaping, split
from tablelearn.operators.joins import join_small
from tablelearn.plans import recurrent as rn
from tablelearn.plans.model_store import ModelStore
from tablelearn.session import scratch_path
from tablelearn.sources.sinks import write_parquet

# The reference's series and training settings.
REFERENCE_SERIES = {
    "features": ["Open", "Close", "Low", "High"],
    "labels": ["NextOpen", "NextClose", "NextLow", "NextHigh"],
    "epochs": 3000,
    "batch_size": 512,
    "frame_size": 50,
    "split_ratio": 0.98,
    "averaging_frequency": 4,
    "since": "2017-01-01",
}


@dataclass
class SequenceConfig:
    features: list[str]
    labels: list[str]
    frame_size: int = 50
    batch_size: int = 512
    epochs: int = 2
    hidden: int = 32
    dense: int = 32
    learning_rate: float = 0.01  # the reference preset keeps 0.05
    l2: float = 1e-4
    drop_prob: float = 0.0
    rms_decay: float = 0.95
    epsilon: float = 1e-8
    seed: int = 12345
    averaging_frequency: int = 4
    workers: int = 4  # averaging slots: part of the model, whatever the number of cores
    chunk_size: int = 4096
    split_ratio: float = 0.98
    dtype: str = "float32"  # compute precision inside tasks; averaging and storage stay float64
    averaging: str = "examples"  # or "workers": a plain mean over the slots of a round

    @property
    def shape(self) -> rn.NetShape:
        return rn.NetShape(len(self.features), len(self.labels), self.hidden, self.dense)

    @classmethod
    def reference(cls, **overrides) -> SequenceConfig:
        base = dict(
            features=REFERENCE_SERIES["features"],
            labels=REFERENCE_SERIES["labels"],
            frame_size=REFERENCE_SERIES["frame_size"],
            batch_size=REFERENCE_SERIES["batch_size"],
            epochs=REFERENCE_SERIES["epochs"],
            split_ratio=REFERENCE_SERIES["split_ratio"],
            averaging_frequency=REFERENCE_SERIES["averaging_frequency"],
            hidden=rn.REFERENCE_NET["hidden"],
            dense=rn.REFERENCE_NET["dense"],
            learning_rate=rn.REFERENCE_NET["learning_rate"],
            l2=rn.REFERENCE_NET["l2"],
            drop_prob=rn.REFERENCE_NET["drop_prob"],
            seed=rn.REFERENCE_NET["seed"],
        )
        base.update(overrides)
        return cls(**base)


@dataclass
class SequenceModel:
    """Parameters and optimiser state; ``history`` holds the rounds of a model trained from
    frames, ``run`` the folder of one trained from blocks or loaded, whose history is a table."""

    config: SequenceConfig
    params: np.ndarray
    rms: np.ndarray
    history: list[tuple] = field(default_factory=list)
    run: str | None = None

    HISTORY = "epoch int, round int, loss double, n_frames long, seconds double"

    def history_df(self, spark: SparkSession) -> DataFrame:
        """``(epoch, round, loss, n_frames, seconds)`` per averaging round."""
        rows = ModelStore(spark, self.run).table("history") if self.run else None
        return rows if rows is not None else spark.createDataFrame(self.history, self.HISTORY)

    def save(self, spark: SparkSession, path: str) -> str:
        """A new version under ``path`` (see ``ModelStore``) with weights and RMSProp state,
        one row per chunk, settings and history, so training can resume from it."""
        cfg = self.config
        rows = [
            (i, self.params[i : i + cfg.chunk_size].tolist(), self.rms[i : i + cfg.chunk_size].tolist())
            for i in range(0, self.params.size, cfg.chunk_size)
        ]
        weights = spark.createDataFrame(rows, "offset long, params array<double>, rms array<double>")
        store = ModelStore(spark, path)
        tables = {"weights": weights.coalesce(1)}
        if store.newest() is None:  # a later version's history goes on from the earlier ones
            tables["history"] = self.history_df(spark)
        store.save(tables, config=json.dumps(asdict(cfg)))
        return path

    @classmethod
    def load(cls, spark: SparkSession, path: str, config: SequenceConfig | None = None) -> SequenceModel:
        """The newest complete version under ``path``."""
        store = ModelStore(spark, path)
        newest = store.newest()
        if newest is None:
            raise FileNotFoundError(f"no complete model version under {path}")
        rows = store.read(newest, "weights").orderBy("offset").collect()  # one row per chunk
        params = np.concatenate([np.asarray(r["params"], dtype=float) for r in rows])
        rms = np.concatenate([np.asarray(r["rms"], dtype=float) for r in rows])
        cfg = config or SequenceConfig(**json.loads(newest["config"]))
        return cls(cfg, params, rms, run=store.root)


def model_name(cfg: SequenceConfig) -> str:
    """The reference's file name pattern: epochs_batch_frame_features_labels."""
    return f"{cfg.epochs}_{cfg.batch_size}_{cfg.frame_size}_{'.'.join(cfg.features)}_{'.'.join(cfg.labels)}"


# --------------------------------------------------------------------------- L1


def prepare_series(
    rows: DataFrame,
    cfg: SequenceConfig,
    *,
    order: str = "Date",
    key: str | None = None,
    since: str | None = None,
    stats_from: str = "all",
    bucket_rows: int | None = None,
    constant: float | None = None,
) -> tuple[DataFrame, DataFrame]:
    """L1: scaled frames with ``part`` (train/test) and ``batch_id``; returns ``(frames, stats)``.

    Bounds come from all rows (``stats_from="all"``, as the reference) or only
    from the rows kept by ``since`` (``"train"``). They are per key when
    ``key`` is given. A column of one value scales to ``constant``; without it
    such a column is NULL, which training refuses.
    """
    cols = list(dict.fromkeys(cfg.features + cfg.labels))
    kept = shaping.since(rows, order, since) if since else rows
    stats = feat.minmax_stats(rows if stats_from == "all" else kept, cols, key)
    scaled = feat.minmax_scale(kept.select(*([key] if key else []), order, *cols), cols, stats, key=key, constant=constant)
    frames = sequence.sliding_frames(
        scaled, order, cfg.features, cfg.frame_size, key=key, labels=cfg.labels, bucket_rows=bucket_rows
    )
    frames = split.chronological_split(frames, cfg.split_ratio, key=key)
    frames = sequence.minibatches(frames, cfg.batch_size, key=key)
    return frames, stats


# --------------------------------------------------------------------------- L6, L7


def _deal_batches(train: DataFrame, key: str | None, workers: int, freq: int) -> DataFrame:
    """Give each training batch a slot (worker) and a round by its number: batches go round
    the slots, and ``freq`` turns make a round. Batches of several keys are numbered one
    key after the other."""
    number = F.col("batch_id")
    if key:
        # One row per key: how many batches the keys before it have.
        per_key = train.groupBy(key).agg((F.max("batch_id") + 1).alias("_batches"))
        before = Window.orderBy(F.col(key).asc_nulls_first()).rowsBetween(Window.unboundedPreceding, -1)
        per_key = per_key.select(key, F.coalesce(F.sum("_batches").over(before), F.lit(0)).alias("_before"))
        train = join_small(train, per_key, on=[key])
        number = number + F.col("_before")
    dealt = train.withColumn("number", number).withColumn("slot", F.pmod("number", F.lit(workers)).cast("long"))
    return dealt.withColumn("round", F.floor(F.col("number") / F.lit(workers * freq)).cast("int")).drop("_before")


_RESULT_SCHEMA = StructType(
    [
        StructField("chunk", LongType()),
        StructField("slot", LongType()),
        StructField("n", LongType()),
        StructField("w", DoubleType()),
        StructField("loss", DoubleType()),
        StructField("vals", ArrayType(DoubleType())),
    ]
)


def _slot_trainer(shape: rn.NetShape, cfg: SequenceConfig, bc, round_seed: int):
    lr, decay, eps, l2, drop = cfg.learning_rate, cfg.rms_decay, cfg.epsilon, cfg.l2, cfg.drop_prob
    chunk = cfg.chunk_size
    dt = np.dtype(cfg.dtype)
    by_examples = cfg.averaging == "examples"
    if cfg.averaging not in ("examples", "workers"):
        raise ValueError("averaging must be 'examples' or 'workers'")

    def train(pdf: pd.DataFrame) -> pd.DataFrame:
        state = bc.value
        size = shape.size
        params, rms = state[:size].astype(dt), state[size:].astype(dt)
        pdf = pdf.sort_values(["number", "frame_idx"])
        slot = int(pdf["slot"].iloc[0])
        rng = np.random.default_rng([round_seed, slot])
        loss_sum, n = 0.0, 0
        for _, b in pdf.groupby("number", sort=False):
            X = np.stack([np.stack(v) for v in b["x"].to_numpy()]).astype(dt)
            Y = np.stack([np.stack(v) for v in b["y"].to_numpy()]).astype(dt)
            mask = rn.dropout_mask(rng, X.shape, drop)
            if not (np.isfinite(X).all() and np.isfinite(Y).all()):
                raise ValueError(
                    "a training frame holds NULL or NaN: a column of one value scales to NULL unless "
                    "prepare_series gets constant=, and incomplete rows have to be dropped first"
                )
            loss, grad = rn.loss_and_grad(shape, params, X, Y, l2=l2, mask=mask)
            params, rms = rn.rmsprop(params, rms, grad, lr, decay, eps)
            loss_sum += loss * len(b)
            n += len(b)
        w = float(n) if by_examples else 1.0
        both = np.concatenate([params, rms]).astype(np.float64) * w
        out = [
            (i // chunk, slot, n, w, loss_sum if i == 0 else 0.0, both[i : i + chunk].tolist())
            for i in range(0, both.size, chunk)
        ]
        return pd.DataFrame(out, columns=["chunk", "slot", "n", "w", "loss", "vals"])

    return train


def _average(results: DataFrame) -> tuple[np.ndarray, int, float]:
    """Weighted mean of the slots' vectors, chunk by chunk (a grouped sum, not a driver loop).

    The slots are added in their order, so the sum is the same bit for bit in every run; a
    group holds one chunk of each slot, a fixed number."""
    summed = results.groupBy("chunk").agg(
        F.sum("n").alias("n"),
        F.sum("w").alias("w"),
        F.sum("loss").alias("loss"),
        F.transform(F.array_sort(F.collect_list(F.struct("slot", "vals"))), lambda s: s["vals"]).alias("vs"),
    )
    summed = summed.select(
        "chunk",
        "n",
        "w",
        "loss",
        F.aggregate(
            F.slice("vs", 2, F.greatest(F.size("vs") - 1, F.lit(0))),
            F.element_at("vs", 1),
            lambda acc, v: F.zip_with(acc, v, lambda a, b: a + b),
        ).alias("total"),
    )
    rows = sorted(summed.collect(), key=lambda r: r["chunk"])  # one row per chunk of the parameter vector
    n = int(rows[0]["n"]) if rows else 0
    weight = float(rows[0]["w"]) if rows else 1.0
    vec = np.concatenate([np.asarray(r["total"], dtype=float) for r in rows]) / (weight or 1.0)
    return vec, n, float(rows[0]["loss"]) if rows else 0.0


def fit_sequence_model(
    frames: DataFrame,
    cfg: SequenceConfig,
    *,
    key: str | None = None,
    init: SequenceModel | None = None,
    checkpoint_every: int = 0,
    checkpoint_path: str | None = None,
) -> SequenceModel:
    """Train on the ``part == 'train'`` frames with parameter averaging every
    ``averaging_frequency`` mini-batches; optimiser state is averaged too.

    With ``checkpoint_every = k`` the parameters and optimiser state are saved
    every k epochs under ``checkpoint_path`` (default: the shared checkpoint
    folder); ``SequenceModel.load`` + ``init=`` resumes from there.
    """
    spark = frames.sparkSession
    shape = cfg.shape
    workers = cfg.workers
    keys = [key] if key else []
    train = frames.where(F.col("part") == "train").select(*keys, "frame_idx", "batch_id", "x", "y")
    dealt = _deal_batches(train, key, workers, cfg.averaging_frequency)
    # A slot's frames of a round are one task's rows and one file.
    dealt = dealt.repartition("round", "slot")
    path = write_parquet(dealt, scratch_path(spark, "sequence-batches"), partition_by=["round"])
    stored = spark.read.parquet(path)
    last_round = stored.agg(F.max("round")).first()[0]
    n_rounds = 0 if last_round is None else int(last_round) + 1
    if init is not None:
        params, rms = init.params.copy(), init.rms.copy()
        history = [tuple(r) for r in init.history_df(spark).orderBy("epoch", "round").collect()] if init.run else list(init.history)
    else:
        params, rms = rn.init_params(shape, cfg.seed), np.zeros(shape.size)
        history = []
    sc = spark.sparkContext
    for epoch in range(cfg.epochs):
        for r in range(n_rounds):
            t0 = time.time()
            bc = sc.broadcast(np.concatenate([params, rms]))
            trainer = _slot_trainer(shape, cfg, bc, cfg.seed + epoch * 100003 + r)
            results = stored.where(F.col("round") == r).groupBy("slot").applyInPandas(trainer, _RESULT_SCHEMA)
            vec, n, loss_sum = _average(results)
            bc.destroy()  # also removes the driver's file
            if n == 0:
                continue
            params, rms = vec[: shape.size], vec[shape.size :]
            history.append((epoch, r, loss_sum / n, n, time.time() - t0))
        if checkpoint_every and (epoch + 1) % checkpoint_every == 0:
            target = checkpoint_path or scratch_path(spark, "sequence-model")
            SequenceModel(cfg, params, rms, history).save(spark, f"{target.rstrip('/')}/epoch-{epoch + 1}")
    return SequenceModel(cfg, params, rms, history)


# --------------------------------------------------------------------------- L8, L9


def predict_sequence(
    frames: DataFrame, model: SequenceModel, *, key: str | None = None, extra: list[str] | None = None
) -> DataFrame:
    """Scaled predictions at each frame's last step, every frame from a zero state:
    ``key?, frame_idx, part, extra..., pred`` (array<double>).

    ``extra`` columns of ``frames`` are carried through unchanged, so callers
    never need to join predictions back to their frames. Scoring with the state
    carried from frame to frame reads blocks (``block_scoring.score_blocks``)."""
    shape = model.config.shape
    bc = frames.sparkSession.sparkContext.broadcast(model.params.astype(np.dtype(model.config.dtype)))
    passed = ([key] if key else []) + ["frame_idx", "part", *(extra or [])]
    out_schema = StructType(
        [f for f in frames.select(*passed).schema.fields] + [StructField("pred", ArrayType(DoubleType()))]
    )

    def score(it):
        flat = bc.value
        for pdf in it:
            if pdf.empty:
                continue
            X = np.stack([np.stack(v) for v in pdf["x"].to_numpy()]).astype(float)
            pred = rn.predict_last(shape, flat, X)
            yield pd.DataFrame({**{c: pdf[c] for c in passed}, "pred": list(pred)})

    return frames.select(*passed, "x").mapInPandas(score, out_schema)


def forecast_table(
    frames: DataFrame,
    model: SequenceModel,
    stats: DataFrame,
    *,
    label: str = "NextClose",
    key: str | None = None,
) -> DataFrame:
    """L9 (+ C5, C6, W2): ``key?, frame_idx, time, part, actual, predicted`` for one label, unscaled.

    ``time`` is the reference's counter (1-based over training then test frames).
    """
    keys = [key] if key else []
    j = model.config.labels.index(label)
    with_actual = frames.withColumn("actual", F.element_at(F.element_at("y", -1), j + 1))
    pred = predict_sequence(with_actual, model, key=key, extra=["actual"])
    scored = pred.select(*keys, "frame_idx", "part", "actual", F.element_at("pred", j + 1).alias("predicted"))
    out = feat.minmax_unscale(scored, ["actual", "predicted"], stats, stat_cols=[label, label], key=key)
    return out.select(*keys, "frame_idx", (F.col("frame_idx") + 1).alias("time"), "part", "actual", "predicted")


def forecast_overlay(table: DataFrame) -> DataFrame:
    """O1 on a forecast table: the four series ``(series, x, y)`` over the frame counter."""
    return report.scored_series(
        table,
        "time",
        {
            "train": {"Training Set": "actual", "Training Predictions": "predicted"},
            "test": {"Test Set": "actual", "Test Predictions": "predicted"},
        },
    )
