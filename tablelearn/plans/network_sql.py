"""The sequence network in SQL: a second statement of the network (L4), its optimiser (L5), the
averaging (L6) and the stateful pass (L8) for one hidden and one dense unit.

Parameters are a list in the order of ``recurrent.NetShape.layout``; a time step is written
out, so training is stated for frames of two steps. Each recursion step takes the averaged
state of the round before, makes one optimiser step per slot and averages the slots.
"""

from __future__ import annotations

from tablelearn.plans import recurrent as rn

# Places (from 1) of the parameters of one hidden and one dense unit.
_GATES = "ifog"
_PLACE = {f"{m}{g}": 4 * k + j + 1 for k, m in enumerate("WRb") for j, g in enumerate(_GATES)}
_PLACE |= {"pi": 13, "pf": 14, "po": 15, "W2": 16, "b2": 17, "W3": 18, "b3": 19}
N_PARAMS = 19
_SHRUNK = [*range(1, 9), 16, 18]  # weights that the L2 term holds down


def _p(name: str) -> str:
    return f"p[{_PLACE[name]}]"


def _hard(x: str) -> str:
    return f"greatest(0.0, least(1.0, CAST(0.2 AS DOUBLE) * ({x}) + 0.5))"


def _slope(x: str) -> str:
    return f"CASE WHEN {x} > 0 AND {x} < 1 THEN CAST(0.2 AS DOUBLE) ELSE 0 END"


def _literal(values) -> str:
    return "[" + ", ".join(f"CAST({float(v)!r} AS DOUBLE)" for v in values) + "]"


def forward_layers(x: str, h: str, c: str, t: str) -> list[dict[str, str]]:
    """Columns of one time step from input ``x`` and state ``h, c``, each dict on top of the last;
    names end in ``t``."""
    z = {f"z{g}{t}": f"{_p('W' + g)} * {x} + {_p('R' + g)} * {h} + {_p('b' + g)}" for g in _GATES}
    gates = {
        f"i{t}": _hard(f"zi{t} + {c} * {_p('pi')}"),
        f"f{t}": _hard(f"zf{t} + {c} * {_p('pf')}"),
        f"g{t}": f"tanh(zg{t})",
    }
    cell = {f"c{t}": f"f{t} * {c} + i{t} * g{t}"}
    out = {f"o{t}": _hard(f"zo{t} + c{t} * {_p('po')}")}
    hidden = {f"h{t}": f"o{t} * tanh(c{t})"}
    dense = {f"a{t}": f"h{t} * {_p('W2')} + {_p('b2')}"}
    value = {f"v{t}": f"greatest(a{t}, 0.0) * {_p('W3')} + {_p('b3')}"}
    return [z, gates, cell, out, hidden, dense, value]


def _nest(source: str, layers: list[dict[str, str]]) -> str:
    for layer in layers:
        source = f"SELECT *, {', '.join(f'{e} AS {n}' for n, e in layer.items())} FROM ({source})"
    return source


def _backward_layers() -> list[dict[str, str]]:
    """Gradient columns of one frame of two steps, last step first."""
    up = {f"dv{t}": f"2.0 / batch_frames * (v{t} - y{t})" for t in "12"}
    da = {f"da{t}": f"CASE WHEN a{t} > 0 THEN dv{t} * {_p('W3')} ELSE 0 END" for t in "12"}
    layers = [up, da]
    for t, c_before, later_h, later_c in (("2", "c1", "0.0", "0.0"), ("1", "0.0", "back_h", "back_c")):
        layers += [
            {f"dh{t}": f"da{t} * {_p('W2')} + {later_h}"},
            {f"dzo{t}": f"dh{t} * tanh(c{t}) * ({_slope('o' + t)})"},
            {f"dc{t}": f"{later_c} + dh{t} * o{t} * (1 - tanh(c{t}) * tanh(c{t})) + dzo{t} * {_p('po')}"},
            {
                f"dzi{t}": f"dc{t} * g{t} * ({_slope('i' + t)})",
                f"dzf{t}": f"dc{t} * {c_before} * ({_slope('f' + t)})",
                f"dzg{t}": f"dc{t} * i{t} * (1 - g{t} * g{t})",
            },
        ]
        if t == "2":
            layers.append(
                {
                    "back_h": " + ".join(f"dz{g}2 * {_p('R' + g)}" for g in _GATES),
                    "back_c": f"dc2 * f2 + dzi2 * {_p('pi')} + dzf2 * {_p('pf')}",
                }
            )
    return layers


def _gradient_sums() -> list[str]:
    w = [f"sum(x1 * dz{g}1 + x2 * dz{g}2)" for g in _GATES]
    r = [f"sum(h1 * dz{g}2)" for g in _GATES]
    b = [f"sum(dz{g}1 + dz{g}2)" for g in _GATES]
    peep = ["sum(c1 * dzi2)", "sum(c1 * dzf2)", "sum(c1 * dzo1 + c2 * dzo2)"]
    dense = ["sum(h1 * da1 + h2 * da2)", "sum(da1 + da2)"]
    out = ["sum(greatest(a1, 0.0) * dv1 + greatest(a2, 0.0) * dv2)", "sum(dv1 + dv2)"]
    sums = [*w, *r, *b, *peep, *dense, *out]
    return [f"{s} + CAST({{l2}} AS DOUBLE) * any_value(p)[{k}]" if k in _SHRUNK else s for k, s in enumerate(sums, 1)]


def training_sql(frames_sql: str, cfg) -> str:
    """Parameters and optimiser state after training: ``position, value, rms``.

    ``frames_sql`` gives the training frames ``idx, x1, x2, y1, y2`` of one series; every slot
    takes one mini-batch a round (``averaging_frequency = 1``)."""
    gradient = [s.format(l2=repr(cfg.l2)) for s in _gradient_sums()]
    ks = range(1, N_PARAMS + 1)
    decay, lr, eps = (f"CAST({v!r} AS DOUBLE)" for v in (cfg.rms_decay, cfg.learning_rate, cfg.epsilon))
    start = rn.init_params(cfg.shape, cfg.seed)
    columns = _nest(
        "SELECT * FROM state JOIN frames ON frames.round = state.step % (SELECT rounds FROM size) WHERE state.step < (SELECT rounds FROM size) * "
        + str(cfg.epochs),
        [*forward_layers("x1", "0.0", "0.0", "1"), *forward_layers("x2", "h1", "c1", "2"), *_backward_layers()],
    )
    return f"""
WITH RECURSIVE numbered AS (SELECT *, idx // {cfg.batch_size} AS batch FROM ({frames_sql})),
frames AS MATERIALIZED (
  SELECT *, batch // {cfg.workers} AS round, batch % {cfg.workers} AS slot, count(*) OVER (PARTITION BY batch) AS batch_frames FROM numbered),
size AS MATERIALIZED (SELECT max(round) + 1 AS rounds FROM frames),
state AS (
  SELECT CAST(0 AS BIGINT) AS step, {_literal(start)} AS p, {_literal([0.0] * N_PARAMS)} AS s
  UNION ALL
  SELECT any_value(step) + 1,
         [{', '.join(f'sum(n * (p[{k}] - {lr} * g[{k}] / (sqrt(t[{k}]) + {eps}))) / sum(n)' for k in ks)}],
         [{', '.join(f'sum(n * t[{k}]) / sum(n)' for k in ks)}]
  FROM (
    SELECT step, p, n, g, [{', '.join(f'{decay} * s[{k}] + (1 - {decay}) * g[{k}] * g[{k}]' for k in ks)}] AS t
    FROM (
      SELECT any_value(step) AS step, any_value(p) AS p, any_value(s) AS s, count(*) AS n, [{', '.join(gradient)}] AS g
      FROM ({columns}) GROUP BY slot))
  HAVING count(*) > 0)
SELECT CAST(position AS INTEGER) AS position, round(p[position], 9) AS value, round(s[position], 9) AS rms
FROM state, range(1, {N_PARAMS + 1}) AS r(position) WHERE step = (SELECT max(step) FROM state)"""


def carry_sql(steps_sql: str, params) -> str:
    """Predictions of one stateful pass: ``idx, pred`` from the inputs ``idx, x`` of one series."""
    layers = forward_layers("x", "h", "c", "9")
    columns = _nest(
        f"SELECT inputs.idx, inputs.x, state.h, state.c, {_literal(params)} AS p FROM state JOIN inputs ON inputs.idx = state.idx + 1", layers
    )
    return f"""
WITH RECURSIVE inputs AS MATERIALIZED ({steps_sql}),
state AS (
  SELECT CAST(-1 AS BIGINT) AS idx, CAST(0 AS DOUBLE) AS h, CAST(0 AS DOUBLE) AS c, CAST(0 AS DOUBLE) AS pred
  UNION ALL
  SELECT idx, h9, c9, v9 FROM ({columns}))
SELECT idx, pred FROM state WHERE idx >= 0"""
