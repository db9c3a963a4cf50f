"""Vector codes against a plain whole-number version of the contract."""

import hashlib
import math
import random

import numpy as np

from tablelearn.llm import vectorcodes as vc

SCHEMA = "vec_id long, embedding array<float>, label int, v string, code string, error string"


def nearest(book, q):
    away = [sum((int(a) - int(b)) ** 2 for a, b in zip(q, e)) for e in book]
    return away.index(min(away)), min(away)


def brute(rows, entries=256, rounds=4):
    kept = [(i, e, lab) for i, e, lab in rows if e is not None and all(x is not None and math.isfinite(x) for x in e)]
    grid = [[math.floor(1024 * float(np.float32(x))) for x in e] for _, e, _ in kept]
    length = max(4, -(-max((len(g) for g in grid), default=0) // 4) * 4)
    grid = [g + [0] * (length - len(g)) for g in grid]
    size = length // 4
    order = sorted(range(len(kept)), key=lambda k: (kept[k][0] is None, kept[k][0] or 0, grid[k]))
    books = [[grid[k][p * size : (p + 1) * size] for k in order[:entries]] for p in range(4)]
    for _ in range(rounds):
        for p in range(4):
            mine = {}
            for g in grid:
                q = g[p * size : (p + 1) * size]
                mine.setdefault(nearest(books[p], q)[0], []).append(q)
            books[p] = [[sum(c) // len(mine[e]) for c in zip(*mine[e])] if e in mine else b for e, b in enumerate(books[p])]
    out, by_label = [], {}
    for (i, _, lab), g in zip(kept, grid):
        found = [nearest(books[p], g[p * size : (p + 1) * size]) for p in range(4)]
        out.append((i, "".join(f"{e:02x}" for e, _ in found), sum(d for _, d in found), lab))
        by_label[lab] = by_label.get(lab, 0) + out[-1][2]
    digest = hashlib.sha256(",".join(str(x) for b in books for e in b for x in e).encode()).hexdigest()
    return sorted([(i, c, e, by_label[lab], digest) for i, c, e, lab in out], key=repr)


def frame(spark, rows):
    return spark.createDataFrame([(*r, "x", "y", "z") for r in rows], SCHEMA)


def run(df):
    return sorted((tuple(r) for r in vc.compress(df).collect()), key=repr)


def test_orchard_finds_the_nearest_and_the_lowest_of_ties():
    rng = np.random.default_rng(1)
    for k, d, high in ((1, 3, 5), (7, 2, 3), (60, 4, 4), (256, 16, 2000), (40, 5, vc.LIMIT)):
        book, q = (rng.integers(-high, high + 1, (n, d)) for n in (k, 300))
        book[k // 2] = book[0]
        entry, away = vc.Orchard(book).nearest(q)
        for j in range(len(q)):
            assert (entry[j], away[j]) == nearest(book.tolist(), q[j].tolist())


def test_compress_equals_brute_force(spark):
    rng = random.Random(4)
    rows = [(i, [rng.choice([0.0, 0.25, -0.5, rng.gauss(0, 1)]) for _ in range(8)], rng.choice([0, 1, 2, None])) for i in rng.sample(range(900), 420)]
    rows += [rows[3]] * 3 + [(rows[4][0], [0.5] * 8, 1), (None, [0.125] * 8, None)]
    rows += [(1000, None, 1), (1001, [None] + [0.0] * 7, 1), (1002, [math.nan] * 8, 2), (1003, [math.inf] + [1.0] * 7, 2)]
    assert run(frame(spark, rows)) == brute(rows)


def test_few_and_uneven_vectors(spark):
    rows = [(5, [0.1, 0.2, 0.3], 1), (6, [], 2), (7, [1e30, -1.0, 2.0, 3.0, 4.0], None)]
    limited = [(i, [max(-131072.0, min(131072.0, x)) for x in e], lab) for i, e, lab in rows]
    assert run(frame(spark, rows)) == brute(limited)
    assert run(frame(spark, [])) == [] and run(frame(spark, [(1, None, 2)])) == []


def test_decoded_codes_have_the_stated_error(spark):
    rng = random.Random(9)
    grid = vc.whole_numbers(frame(spark, [(i, [rng.random() for _ in range(8)], 0) for i in range(60)]))
    books = vc.fit_codebooks(grid, entries=16, rounds=2)
    truth = {r["vec_id"]: r["v"] for r in grid.collect()}
    for r in vc.decode(vc.encode(grid, books), books).collect():
        assert r["error"] == sum((a - b) ** 2 for a, b in zip(truth[r["vec_id"]], r["v"]))
