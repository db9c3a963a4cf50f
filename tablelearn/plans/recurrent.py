"""NumPy step functions of the sequence network (L4, L5), run inside Spark tasks.

Network: one LSTM layer with peephole connections (tanh cell, hard-sigmoid
gates), a dense ReLU layer and an identity output, applied at every time
step; loss is the squared error summed over time steps, averaged over
outputs and over the mini-batch; L2 on the weight matrices; RMSProp update.
Parameters travel as one flat float64 vector so that Spark can average them.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

# The reference network and optimiser settings.
REFERENCE_NET = {
    "hidden": 512,
    "dense": 32,
    "learning_rate": 0.05,
    "l2": 1e-4,
    "seed": 12345,
    "drop_prob": 0.2,
    "rms_decay": 0.95,
    "epsilon": 1e-8,
}


@dataclass(frozen=True)
class NetShape:
    n_in: int
    n_out: int
    hidden: int = 32
    dense: int = 32

    def layout(self) -> list[tuple[str, tuple[int, ...]]]:
        h = self.hidden
        return [
            ("W", (self.n_in, 4 * h)),
            ("R", (h, 4 * h)),
            ("b", (4 * h,)),
            ("pi", (h,)),
            ("pf", (h,)),
            ("po", (h,)),
            ("W2", (h, self.dense)),
            ("b2", (self.dense,)),
            ("W3", (self.dense, self.n_out)),
            ("b3", (self.n_out,)),
        ]

    @property
    def size(self) -> int:
        return int(sum(np.prod(s) for _, s in self.layout()))

    def unpack(self, flat: np.ndarray) -> dict[str, np.ndarray]:
        out, pos = {}, 0
        for name, shape in self.layout():
            n = int(np.prod(shape))
            out[name] = flat[pos : pos + n].reshape(shape)
            pos += n
        return out

    def pack(self, parts: dict[str, np.ndarray]) -> np.ndarray:
        return np.concatenate([parts[name].ravel() for name, _ in self.layout()])


_REGULARISED = ("W", "R", "W2", "W3")


def init_params(shape: NetShape, seed: int) -> np.ndarray:
    """Xavier-normal weights (std sqrt(2 / (fan_in + fan_out))), zero biases, forget-gate bias 1."""
    rng = np.random.default_rng(seed)
    h = shape.hidden
    p = {}
    for name, s in shape.layout():
        if name in ("W", "R", "W2", "W3"):
            p[name] = rng.normal(0.0, np.sqrt(2.0 / (s[0] + s[1])), size=s)
        elif name in ("pi", "pf", "po"):
            p[name] = rng.normal(0.0, np.sqrt(2.0 / (2 * h)), size=s)
        else:
            p[name] = np.zeros(s)
    p["b"][h : 2 * h] = 1.0
    return shape.pack(p)


def _hs(x):
    return np.clip(0.2 * x + 0.5, 0.0, 1.0)


def _hs_grad_from_value(a):
    """Derivative of the hard sigmoid, read off its output: 0.2 strictly inside (0, 1), else 0."""
    return np.where((a > 0.0) & (a < 1.0), 0.2, 0.0).astype(a.dtype)


def forward(shape: NetShape, flat: np.ndarray, X: np.ndarray, state=None, mask=None, keep=True):
    """X: [B, T, n_in] -> outputs [B, T, n_out], cache (for ``backward``), final (h, c).

    Computes in ``flat``'s dtype. The cache keeps only the four gate
    activations per step plus the hidden and cell sequences; everything else
    the backward pass needs is derived from them.
    """
    dt = flat.dtype
    p = shape.unpack(flat)
    B, T, _ = X.shape
    H = shape.hidden
    X = X.astype(dt, copy=False)
    h = np.zeros((B, H), dt) if state is None else state[0].astype(dt, copy=False)
    c = np.zeros((B, H), dt) if state is None else state[1].astype(dt, copy=False)
    Xin = X if mask is None else X * mask.astype(dt, copy=False)
    hs_all = np.empty((B, T, H), dt)
    cs_all = np.empty((B, T, H), dt) if keep else None
    gates = [] if keep else None
    for t in range(T):
        z = Xin[:, t, :] @ p["W"] + h @ p["R"] + p["b"]
        i = _hs(z[:, :H] + c * p["pi"])
        f = _hs(z[:, H : 2 * H] + c * p["pf"])
        g = np.tanh(z[:, 3 * H :])
        c = f * c + i * g
        o = _hs(z[:, 2 * H : 3 * H] + c * p["po"])
        h = o * np.tanh(c)
        hs_all[:, t, :] = h
        if keep:
            cs_all[:, t, :] = c
            gates.append((i, f, g, o))
    a = hs_all @ p["W2"] + p["b2"]
    r = np.maximum(a, 0.0)
    y = r @ p["W3"] + p["b3"]
    cache = (Xin, gates, hs_all, cs_all, a, r, state) if keep else None
    return y, cache, (h, c)


def loss_and_grad(shape: NetShape, flat: np.ndarray, X: np.ndarray, Y: np.ndarray, l2: float = 0.0, mask=None):
    """Loss and flat gradient of one mini-batch (full back-propagation through the frame)."""
    dt = flat.dtype
    p = shape.unpack(flat)
    B, T, _ = X.shape
    H = shape.hidden
    out, (Xin, gates, hs_all, cs_all, a, r, _), _ = forward(shape, flat, X, mask=mask)
    diff = out - Y.astype(dt, copy=False)
    scale = 1.0 / (B * shape.n_out)
    loss = float(np.sum(diff * diff, dtype=np.float64) * scale)
    g = {name: np.zeros(sz, dt) for name, sz in shape.layout()}
    dy = (2.0 * scale) * diff
    g["W3"] = np.einsum("btd,bto->do", r, dy)
    g["b3"] = dy.sum(axis=(0, 1))
    da = (dy @ p["W3"].T) * (a > 0)
    g["W2"] = np.einsum("bth,btd->hd", hs_all, da)
    g["b2"] = da.sum(axis=(0, 1))
    dhs = da @ p["W2"].T
    dh_next = np.zeros((B, H), dt)
    dc_next = np.zeros((B, H), dt)
    zeros = np.zeros((B, H), dt)
    for t in range(T - 1, -1, -1):
        i, f, gg, o = gates[t]
        c_new = cs_all[:, t, :]
        c_prev = cs_all[:, t - 1, :] if t > 0 else zeros
        h_prev = hs_all[:, t - 1, :] if t > 0 else zeros
        tc = np.tanh(c_new)
        dh = dhs[:, t, :] + dh_next
        dzo = dh * tc * _hs_grad_from_value(o)
        dc = dc_next + dh * o * (1.0 - tc * tc) + dzo * p["po"]
        g["po"] += np.sum(dzo * c_new, axis=0)
        dzi = dc * gg * _hs_grad_from_value(i)
        dzf = dc * c_prev * _hs_grad_from_value(f)
        dzg = dc * i * (1.0 - gg * gg)
        g["pi"] += np.sum(dzi * c_prev, axis=0)
        g["pf"] += np.sum(dzf * c_prev, axis=0)
        dz = np.concatenate([dzi, dzf, dzo, dzg], axis=1)
        g["W"] += Xin[:, t, :].T @ dz
        g["b"] += dz.sum(axis=0)
        g["R"] += h_prev.T @ dz
        dh_next = dz @ p["R"].T
        dc_next = dc * f + dzi * p["pi"] + dzf * p["pf"]
    if l2:
        for name in _REGULARISED:
            loss += 0.5 * l2 * float(np.sum(p[name] * p[name], dtype=np.float64))
            g[name] += l2 * p[name]
    return loss, shape.pack(g)


def rmsprop(flat: np.ndarray, cache: np.ndarray, grad: np.ndarray, lr: float, decay: float, eps: float):
    cache = decay * cache + (1.0 - decay) * grad * grad
    return flat - lr * grad / (np.sqrt(cache) + eps), cache


def dropout_mask(rng: np.random.Generator, shape: tuple[int, ...], drop_prob: float):
    if drop_prob <= 0.0:
        return None
    keep = 1.0 - drop_prob
    return (rng.random(shape) < keep) / keep


def predict_last(shape: NetShape, flat: np.ndarray, X: np.ndarray) -> np.ndarray:
    """Stateless scoring: each frame from a zero state, output at the last step ([B, n_out])."""
    y, _, _ = forward(shape, flat, X, keep=False)
    return y[:, -1, :]
