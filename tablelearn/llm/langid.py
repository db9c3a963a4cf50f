"""Language identification by a byte convolutional network trained in NumPy.

A text's UTF-8 bytes (A-Z lower-cased) are cut into windows of ``WINDOW`` bytes, the last one
padded. Every byte is looked up in a small embedding; filters of several widths slide over a
window, each filter keeps its largest response (max pooling), and a softmax layer gives the
window's class probabilities. A document's probabilities are the softmax of its windows' mean
log-probabilities, each window weighted by its number of bytes. All windows of a text count.

The network is trained on a bounded sample (about ``PER_CLASS`` documents of each language,
``WINDOWS_PER_DOC`` windows spread over each). Ties go to the language first in sorted order.

Edge cases: a null text, or one without any letter, is ``und`` with score 0; repeated rows get
equal results; if nothing is labelled every document is ``und``. Other columns are ignored.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablelearn.llm.common import id_bucket
from tablelearn.llm.samples import labelled_sample

WINDOW = 256
WIDTHS = (2, 3, 4)
FILTERS = 16  # of each width
EMBED = 8
PER_CLASS = 600
WINDOWS_PER_DOC = 4
UNKNOWN = "und"
_FOLDS = (4, 2)  # held out: crc32(doc_id) mod 4 = 2
_MAX = max(WIDTHS)


def _bytes(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-8", "surrogatepass").lower(), np.uint8)


def windows(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Fixed-length windows (padded with 0) and the number of bytes in each."""
    n = max(1, -(-len(data) // WINDOW))
    out = np.zeros(n * WINDOW, np.uint8)
    out[: len(data)] = data
    sizes = np.full(n, WINDOW, np.float32)
    sizes[-1] = max(1, len(data) - (n - 1) * WINDOW)
    return out.reshape(n, WINDOW), sizes


@dataclass
class ByteNet:
    classes: list[str]
    embed: np.ndarray  # 256 x EMBED
    conv: np.ndarray  # (max width * EMBED) x filters, zero beyond a filter's width
    conv_bias: np.ndarray
    dense: np.ndarray
    dense_bias: np.ndarray

    def _columns(self, x: np.ndarray) -> np.ndarray:
        """windows x places x (max width * EMBED): the bytes under every filter place."""
        e = self.embed[x].reshape(len(x), -1)
        places = WINDOW - _MAX + 1
        view = np.lib.stride_tricks.as_strided(
            e, (len(x), places, _MAX * EMBED), (e.strides[0], e.strides[1] * EMBED, e.strides[1])
        )
        return np.ascontiguousarray(view)

    def pooled(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        cols = self._columns(x)
        z = (cols.reshape(-1, cols.shape[2]) @ self.conv).reshape(len(x), cols.shape[1], -1)
        at = z.argmax(1)
        top = np.take_along_axis(z, at[:, None, :], 1)[:, 0, :] + self.conv_bias
        return np.maximum(top, 0), at, cols

    def log_probs(self, x: np.ndarray) -> np.ndarray:
        """Class log-probabilities of windows, a bounded number at a time."""
        out = []
        for k in range(0, len(x), 64):
            cols = self._columns(x[k : k + 64])
            z = (cols.reshape(-1, cols.shape[2]) @ self.conv).reshape(len(cols), cols.shape[1], -1)
            pooled = np.maximum(z.max(1) + self.conv_bias, 0)
            logits = pooled @ self.dense + self.dense_bias
            logits -= logits.max(1, keepdims=True)
            out.append(logits - np.log(np.exp(logits).sum(1, keepdims=True)))
        return np.concatenate(out)


def _mask() -> np.ndarray:
    m = np.zeros((_MAX * EMBED, FILTERS * len(WIDTHS)), np.float32)
    for k, width in enumerate(WIDTHS):
        m[: width * EMBED, k * FILTERS : (k + 1) * FILTERS] = 1
    return m


def fit_byte_net(x: np.ndarray, y: np.ndarray, classes: list[str], epochs: int = 8, batch: int = 64, rate: float = 0.01, seed: int = 3) -> ByteNet:
    """Cross entropy with Adam on windows ``x`` (rows of bytes) and class numbers ``y``; the
    step size falls linearly to zero."""
    rng = np.random.default_rng(seed)
    mask, filters, k = _mask(), FILTERS * len(WIDTHS), len(classes)
    net = ByteNet(
        classes,
        rng.normal(0, 0.5, (256, EMBED)).astype(np.float32),
        (rng.normal(0, 0.25, mask.shape) * mask).astype(np.float32),
        np.zeros(filters, np.float32),
        rng.normal(0, 0.1, (filters, k)).astype(np.float32),
        np.zeros(k, np.float32),
    )
    names = ("embed", "conv", "conv_bias", "dense", "dense_bias")
    m = {n: np.zeros_like(getattr(net, n)) for n in names}
    v = {n: np.zeros_like(getattr(net, n)) for n in names}
    step, steps = 0, epochs * -(-len(y) // batch) + 1
    for _ in range(epochs if k > 1 else 0):
        order = rng.permutation(len(y))
        for start in range(0, len(y), batch):
            rows = order[start : start + batch]
            xb, n = x[rows], len(rows)
            pooled, at, cols = net.pooled(xb)
            logits = pooled @ net.dense + net.dense_bias
            p = np.exp(logits - logits.max(1, keepdims=True))
            p /= p.sum(1, keepdims=True)
            p[np.arange(n), y[rows]] -= 1
            p /= n
            d_pool = (p @ net.dense.T) * (pooled > 0)
            # Only the place that won the pooling passes a gradient back.
            won = cols[np.arange(n)[:, None], at]  # n x filters x columns
            g = {
                "dense": pooled.T @ p,
                "dense_bias": p.sum(0),
                "conv": np.einsum("nfc,nf->cf", won, d_pool) * mask,
                "conv_bias": d_pool.sum(0),
                "embed": np.zeros_like(net.embed),
            }
            d_cols = d_pool[:, :, None] * net.conv.T[None]
            for j in range(_MAX):
                under = xb[np.arange(n)[:, None], at + j]
                np.add.at(g["embed"], under.ravel(), d_cols[:, :, j * EMBED : (j + 1) * EMBED].reshape(-1, EMBED))
            step += 1
            for name in names:
                m[name] = 0.9 * m[name] + 0.1 * g[name]
                v[name] = 0.999 * v[name] + 0.001 * g[name] ** 2
                move = rate * (1 - step / steps) * (m[name] / (1 - 0.9**step)) / (np.sqrt(v[name] / (1 - 0.999**step)) + 1e-8)
                setattr(net, name, (getattr(net, name) - move).astype(np.float32))
    return net


def fit_language_model(docs: DataFrame, eligible=None, per_class: int = PER_CLASS) -> ByteNet | None:
    """Train on labelled documents outside the held-out fold; None if there are none."""
    if eligible is None:
        eligible = id_bucket(F.col("doc_id"), _FOLDS[0]) != _FOLDS[1]
    sample, totals = labelled_sample(docs, docs.select("doc_id", "lang"), "lang", eligible, per_class)
    if not totals:
        return None

    def run(frames):
        for frame in frames:
            rows = []
            for doc_id, text, label in zip(frame["doc_id"], frame["text"], frame["label"], strict=True):
                found, _ = windows(_bytes(text or ""))
                picks = np.unique(np.linspace(0, len(found) - 1, WINDOWS_PER_DOC).astype(int))
                rows += [(doc_id, int(k), label, found[k].tobytes()) for k in picks]
            yield pd.DataFrame(rows, columns=["doc_id", "k", "label", "x"])

    rows = (
        sample.select("doc_id", "text", "label")
        .mapInPandas(run, "doc_id long, k int, label string, x binary")
        .orderBy("doc_id", "k", F.xxhash64("x"))
        .toPandas()
    )
    classes = sorted(totals)
    number = {c: k for k, c in enumerate(classes)}
    x = np.frombuffer(b"".join(rows["x"]), np.uint8).reshape(len(rows), WINDOW)
    return fit_byte_net(x, rows["label"].map(number).to_numpy(int), classes)


def _has_letter(text: str | None) -> bool:
    return bool(text) and any(map(str.isalpha, text))


def predict_languages(docs: DataFrame, net: ByteNet | None) -> DataFrame:
    """``doc_id, lang_pred, score`` of every row."""

    def run(frames):
        for frame in frames:
            for start in range(0, len(frame), 200):
                part = frame.iloc[start : start + 200]
                names, scores = [UNKNOWN] * len(part), [0.0] * len(part)
                if net is not None:
                    use = [k for k, t in enumerate(part["text"]) if _has_letter(t)]
                    cut = [windows(_bytes(part["text"].iloc[k])) for k in use]
                    if use:
                        logs = net.log_probs(np.concatenate([c[0] for c in cut]))
                        sizes = np.concatenate([c[1] for c in cut])
                        starts = np.cumsum([0] + [len(c[0]) for c in cut])[:-1]
                        mean = np.add.reduceat(logs * sizes[:, None], starts) / np.add.reduceat(sizes, starts)[:, None]
                        p = np.exp(mean - mean.max(1, keepdims=True))
                        p /= p.sum(1, keepdims=True)
                        for k, row in zip(use, p, strict=True):
                            names[k], scores[k] = net.classes[int(row.argmax())], float(row.max())
                yield pd.DataFrame({"doc_id": part["doc_id"], "lang_pred": names, "score": scores})

    return docs.select("doc_id", "text").mapInPandas(run, "doc_id long, lang_pred string, score double")


def identify_languages(docs: DataFrame) -> DataFrame:
    """``doc_id, held_out, lang_pred, score`` of every row."""
    out = predict_languages(docs, fit_language_model(docs))
    held = F.coalesce(id_bucket(F.col("doc_id"), _FOLDS[0]) == _FOLDS[1], F.lit(False))
    return out.select("doc_id", held.alias("held_out"), "lang_pred", "score")
