"""Quality classifier: random-indexing word vectors, a two-layer network, calibrated scores.

Every word has a sparse random index vector (a few +1 and -1 at places given by its hash). A
word's vector is the sum of the index vectors of its neighbours over the training sample,
scaled to length 1. The vocabulary is the ``VOCABULARY`` words of the sample found in most
documents; any other word falls back to its shape (runs of capitals, small letters and digits
written as one ``A``, ``a`` or ``0``, everything else as it is), so unseen words have vectors
too. A document's features are the mean of its word vectors, and how far neighbouring words'
own index vectors agree (repetition). The network is trained in NumPy on the features of a
bounded sample (about ``PER_CLASS`` labelled documents of each class); its temperature is
fitted on a fifth of them.

Scoring reads every whole text. Null and empty texts have all-zero features and get a score
like any other row. Repeated rows get equal scores. Without labels, or with one class only,
the score is the share of label 1 (0.5 without any). Other columns are ignored.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablelearn.llm.common import WordCache, id_bucket, worker_cache
from tablelearn.llm.nets import TwoLayer, fit_two_layer
from tablelearn.llm.samples import labelled_sample

DIM = 48
NONZERO = 6
VOCABULARY = 8192
WINDOW = 2
PER_CLASS = 3000
THRESHOLD = 0.3
_FOLDS = (5, 0)  # held out: crc32(doc_id) mod 5 = 0

_SHAPES = ((re.compile(r"[^\W\d_a-zß-öø-ÿ]+"), "A"), (re.compile(r"[^\W\dA_]+"), "a"), (re.compile(r"\d+"), "0"))


def shape(word: str) -> str:
    for pattern, sign in _SHAPES:
        word = pattern.sub(sign, word)
    return "\x01" + word[:12]


def index_table(size: int = 4096) -> np.ndarray:
    """Index vectors of ``size`` hash places."""
    rng = np.random.default_rng(4711)
    out = np.zeros((size, DIM), np.float32)
    for row in out:
        at = rng.choice(DIM, NONZERO, replace=False)
        row[at] = rng.choice([-1.0, 1.0], NONZERO)
    return out / np.sqrt(NONZERO)


def _places(words: list[str], known: dict[str, int], tag: str) -> tuple[np.ndarray, np.ndarray]:
    """Vocabulary id (-1: none) and hash place of every word."""

    def look(word: str) -> int:
        k = known.get(word)
        if k is None:
            k = known.get(shape(word), -1)
        return (k << 12) | (xxhash.xxh3_64_intdigest(word) & 4095)

    cache = worker_cache("quality_" + tag, lambda: WordCache(look))
    both = np.fromiter(map(cache.__getitem__, words), np.int64, len(words))
    return both >> 12, both & 4095


def _features(text: str | None, known: dict[str, int], vectors: np.ndarray, tag: str) -> np.ndarray:
    out = np.zeros(DIM + 3, np.float32)
    words = (text or "").split()
    if not words:
        return out
    ids, at = _places(words, known, tag)
    index = worker_cache("quality_index", index_table)
    counts = np.bincount(ids[ids >= 0], minlength=len(vectors)).astype(np.float32)
    used = np.flatnonzero(counts)
    out[:DIM] = counts[used] @ vectors[used] / len(words)
    for k in (1, 2):
        if len(at) > k:
            out[DIM + k - 1] = float(np.einsum("ij,ij->", index[at[k:]], index[at[:-k]])) / (len(at) - k)
    out[DIM + 2] = len(used) / len(words)
    return out


@dataclass
class QualityModel:
    known: dict[str, int]
    vectors: np.ndarray
    net: TwoLayer
    tag: str

    def features(self, texts) -> np.ndarray:
        return np.stack([_features(t, self.known, self.vectors, self.tag) for t in texts]) if len(texts) else np.zeros((0, DIM + 3))


def _vocabulary(sample: DataFrame) -> dict[str, int]:
    """Words and shapes found in most documents of the sample, in a fixed order."""

    def run(frames):
        for frame in frames:
            terms = [w for t in frame["text"] for w in {x for u in (t or "").split() for x in (u, shape(u))}]
            yield pd.Series(terms, dtype=object).value_counts().rename_axis("term").reset_index(name="n")

    counts = sample.select("text").mapInPandas(run, "term string, n long").groupBy("term").agg(F.sum("n").alias("n"))
    top = counts.filter("n > 1").orderBy(F.desc("n"), "term").limit(VOCABULARY).collect()
    return {r["term"]: k for k, r in enumerate(top)}


def _word_vectors(sample: DataFrame, known: dict[str, int], tag: str) -> np.ndarray:
    """Sums of the neighbours' index vectors per vocabulary word, scaled to length 1."""

    def run(frames):
        index = index_table()
        total = np.zeros((len(known) + 1, DIM), np.float32)
        for frame in frames:
            for text in frame["text"]:
                ids, at = _places((text or "").split(), known, tag)
                near = index[at]
                for k in range(1, WINDOW + 1):
                    np.add.at(total, ids[k:], near[:-k])
                    np.add.at(total, ids[:-k], near[k:])
        used = np.flatnonzero(np.abs(total[:-1]).sum(1))
        yield pd.DataFrame({"id": used, "v": pd.Series(list(total[used]), dtype=object)})

    parts = sample.select("text").mapInPandas(run, "id long, v array<float>")
    sums = parts.groupBy("id").agg(*[F.sum(F.col("v")[k]).alias(f"c{k}") for k in range(DIM)]).collect()
    out = np.zeros((len(known), DIM), np.float32)
    for row in sums:
        out[row[0]] = row[1:]
    return out / (np.linalg.norm(out, axis=1, keepdims=True) + 1e-9)


def fit_quality(docs: DataFrame, labels: DataFrame, per_class: int = PER_CLASS) -> QualityModel:
    """Learn from labelled rows outside the held-out fold."""
    eligible = id_bucket(F.col("doc_id"), _FOLDS[0]) != _FOLDS[1]
    sample, totals = labelled_sample(docs, labels.select("doc_id", "quality"), "quality", eligible, per_class)
    known = _vocabulary(sample)
    tag = xxhash.xxh3_64_hexdigest("\n".join(known))
    model = QualityModel(known, _word_vectors(sample, known, tag), None, tag)

    def run(frames):
        for frame in frames:
            yield pd.DataFrame({"doc_id": frame["doc_id"], "label": frame["label"], "x": pd.Series(list(model.features(frame["text"])), dtype=object, index=frame.index)})

    rows = sample.select("doc_id", "text", F.col("label").cast("double")).mapInPandas(
        run, "doc_id long, label double, x array<float>"
    ).orderBy("doc_id").toPandas()
    y = rows["label"].to_numpy(float)
    x = np.stack(rows["x"]) if len(rows) else np.zeros((0, DIM + 3))
    # Each class weighs what it weighs among all labelled rows, not in the sample.
    share = {float(k): n / sum(totals.values()) for k, n in totals.items()}
    in_sample = {k: max(1, (y == k).sum()) / max(1, len(y)) for k in share}
    weight = np.array([share[k] / in_sample[k] for k in y])
    model.net = fit_two_layer(x.astype(float), y, weight)
    return model


def score_quality(docs: DataFrame, model: QualityModel) -> DataFrame:
    """``doc_id, score`` of every row."""

    def run(frames):
        for frame in frames:
            for at in range(0, len(frame), 1000):
                part = frame.iloc[at : at + 1000]
                yield pd.DataFrame({"doc_id": part["doc_id"], "score": model.net.score(model.features(part["text"]).astype(float))})

    return docs.select("doc_id", "text").mapInPandas(run, "doc_id long, score double")


def drop_low_quality(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """``docs`` without the rows whose score is below ``threshold``; all columns stay. Rows are
    filtered where they are read, nothing is shuffled."""
    model = fit_quality(docs, labels)
    at = docs.columns.index("text")

    def run(batches):
        for batch in batches:
            for k in range(0, len(batch), 1000):
                part = batch.slice(k, 1000)
                score = model.net.score(model.features(part.column(at).to_pylist()).astype(float))
                yield part.filter(pa.array(score >= threshold))

    return docs.mapInArrow(run, docs.schema)


def classify_quality(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """``doc_id, held_out, score, predicted`` of every row."""
    scored = score_quality(docs, fit_quality(docs, labels))
    return scored.select(
        "doc_id",
        F.coalesce(id_bucket(F.col("doc_id"), _FOLDS[0]) == _FOLDS[1], F.lit(False)).alias("held_out"),
        "score",
        (F.col("score") >= threshold).cast("int").alias("predicted"),
    )
