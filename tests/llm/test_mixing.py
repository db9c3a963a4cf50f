"""Apportionment and mixing against plain Python."""

import hashlib
import random
from collections import Counter, defaultdict

import pytest
from helpers import edge_docs, no_docs

from tablelearn.llm import mixing

SCHEMA = "doc_id long, text string, source string, rank string, size string, quota string"


def seats(weights, n):
    """Highest quotients one seat at a time; ties to the first."""
    won = [0] * len(weights)
    for _ in range(n):
        best = max(range(len(weights)), key=lambda i: (weights[i] / (2 * won[i] + 1), -i))
        won[best] += 1
    return won


def number(*parts):
    text = ":".join(" " if p is None else str(p) for p in parts)
    return int(hashlib.md5(text.encode()).hexdigest()[:15], 16)


def brute(rows, block, shard_words, most=3):
    """``(doc_id, size, source_size, target, taken)`` word by word."""
    sized = [(i, s, len([w for w in (t or "").split() if w])) for i, t, s in rows]
    total = Counter()
    for _, s, n in sized:
        total[s] += n
    names = sorted(total, key=lambda s: (s is None, s or ""))
    weight = {s: 1 + k % 3 for k, s in enumerate(names)}
    target, open_names = {}, set(names)
    while open_names:
        share = (sum(total.values()) - sum(most * total[s] for s in names if s not in open_names)) / sum(weight[s] for s in open_names)
        over = {s for s in open_names if most * total[s] <= share * weight[s]}
        open_names -= over
        if not over:
            break
    target = {s: share * weight[s] if s in open_names else float(most * total[s]) for s in names}
    n = max(1, int(sum(total.values()) / block + 0.5))
    quota = dict(zip(names, seats([target[s] for s in names], n) if sum(target.values()) else [0] * len(names)))
    out = []
    for rank, s in enumerate(names):
        count = max(1, -(-total[s] // shard_words))
        shards = defaultdict(list)
        for i, src, size in sized:
            if src == s:
                shards[number("11:shard", i) % count].append((i, size))
        order = sorted(k for k in shards if sum(x[1] for x in shards[k]))
        shares = dict(zip(order, seats([sum(x[1] for x in shards[k]) for k in order], quota[s]) if order else []))
        for k, docs in shards.items():
            docs.sort(key=lambda d: (number("11:order", d[0]), -1 if d[0] is None else d[0], d[1]))
            words = [j for j, d in enumerate(docs) for _ in range(d[1])]
            taken = Counter()
            if words:
                start = number("11:start", rank, k) % len(words)
                for step in range(min(shares[k] * block, most * len(words))):
                    taken[words[(start + step) % len(words)]] += 1
            out += [(i, size, total[s], target[s], taken[j]) for j, (i, size) in enumerate(docs)]
    return sorted(out, key=repr)


def run(df, **params):
    cols = ("doc_id", "size", "source_size", "target", "taken")
    return sorted((tuple(r[c] for c in cols) for r in mixing.mix(df, **params).collect()), key=repr)


def sample(n=250):
    rng = random.Random(5)
    sources = ["a", "b", "ä", "Z", None, "hot", "hot", "hot", "hot"]
    words = [None, 0, 1, 3, 30, 200]
    rows = []
    for i in range(n):
        k = rng.choice(words)
        rows.append((None if i % 41 == 0 else i, None if k is None else " ".join("wé" for _ in range(k)), rng.choice(sources)))
    return rows + [(3, "one row of seven words many times", "hot")] * 60


@pytest.mark.parametrize("block,shard_words", [(16, 2_000_000), (3, 300)])
def test_mix_equals_brute_force(spark, block, shard_words):
    rows = sample()
    df = spark.createDataFrame([(*r, "x", "y", "z") for r in rows], SCHEMA)
    assert run(df, block=block, shard_words=shard_words) == brute(rows, block, shard_words)


def test_taken_words_come_near_targets_and_limits(spark):
    got = mixing.mix(spark.createDataFrame([(*r, "x", "y", "z") for r in sample()], SCHEMA), block=4, shard_words=500).collect()
    taken, target, size = Counter(), {}, {}
    for r in got:
        assert 0 <= r["taken"] <= 3 * r["size"]
        assert r["taken"] == r["passes"] * r["size"] + sum(p["length"] for p in r["pieces"])
        assert all(0 <= p["first"] and p["first"] + p["length"] <= r["size"] for p in r["pieces"])
        taken[r["source"]] += r["taken"]
        target[r["source"]], size[r["source"]] = r["target"], r["source_size"]
    assert sum(target.values()) == pytest.approx(sum(size.values()))
    for s in target:
        shards = -(-size[s] // 500)
        assert target[s] <= 3 * size[s] and abs(taken[s] - target[s]) <= 4 * (1 + shards)


def test_sainte_lague_equals_one_seat_at_a_time(spark):
    cases = [([5.0, 3.0, 1.0], 7), ([1.0] * 9, 4), ([1e6, 1.0, 1.0, 0.0], 50), ([3.0, 3.0, 2.0], 1), ([2.0, 1.0], 0)]
    rows = [(g, i, w, n) for g, (weights, n) in enumerate(cases) for i, w in enumerate(weights)]
    df = spark.createDataFrame(rows, "g long, p long, w double, n long")
    got = {(r["g"], r["p"]): r["quota"] for r in mixing.sainte_lague(df, "p", "w", "n", group="g").collect()}
    for g, (weights, n) in enumerate(cases):
        assert [got.get((g, i), 0) for i in range(len(weights))] == seats(weights, n)
    one = {r["p"]: r["quota"] for r in mixing.sainte_lague(df.where("g = 2"), "p", "w", "n").collect()}
    assert [one.get(i, 0) for i in range(4)] == seats(*cases[2])


def test_mix_takes_awkward_rows(spark):
    got = mixing.mix(edge_docs(spark)).collect()
    assert len(got) == edge_docs(spark).count()
    assert {r["doc_id"]: r["taken"] for r in got if r["size"] == 0}.keys() >= {1, 2, 3}
    assert mixing.mix(no_docs(spark)).collect() == []
