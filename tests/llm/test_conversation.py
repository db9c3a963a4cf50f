"""Conversation repair against an exhaustive search and a plain rewriting of the rules."""

import hashlib
import itertools
import random
import re
import zlib

from tablelearn.llm import conversation as cv

SCHEMA = "conv_id long, turn long, role string, text string, idx string, h string, chunk string, gone string"
PATTERN = re.compile(r"(s?(ua)+)?")
NEXT = {"": "u", "s": "u", "u": "a", "a": "u"}


def search(rows):
    """All edit sequences of ``(initial, fault)`` rows with at most two insertions at a place."""
    best = None

    def go(i, roles, cost, letters):
        nonlocal best
        if best is not None and cost > best[0]:
            return
        if i == len(rows):
            for n in range(3):
                got = roles
                for _ in range(n):
                    got += NEXT[got[-1:]]
                if PATTERN.fullmatch(got) and (best is None or (cost + 2 * n, letters + "I" * n) < best):
                    best = (cost + 2 * n, letters + "I" * n)
            return
        initial, fault = rows[i]
        for n in range(3):
            got = roles
            for _ in range(n):
                got += NEXT[got[-1:]]
            go(i + 1, got, cost + 2 * n + 3, letters + "I" * n + "D")
            if fault not in ("blank", "duplicate"):
                extra = 2 * n + (fault == "truncated")
                go(i + 1, got + NEXT[got[-1:]], cost + extra + 2, letters + "I" * n + "R")
                if initial == "s" and not got or initial == NEXT[got[-1:]]:
                    go(i + 1, got + initial, cost + extra, letters + "I" * n + "K")

    go(0, "", 0, "")
    return best


def test_best_path_equals_exhaustive_search():
    rng = random.Random(2)
    for n in range(5):
        for _ in range(2 if n == 0 else 60):
            rows = [(rng.choice("suaux"), rng.choice(["", "", "truncated", "blank", "duplicate"])) for _ in range(n)]
            assert cv.best_paths(rows, cv.ENDS)[cv.BEGIN] == search(rows), rows


def test_joined_chunks_equal_one_pass():
    rng = random.Random(3)
    for _ in range(80):
        rows = [(rng.choice("suaax"), rng.choice(["", "", "truncated", "blank", "duplicate"])) for _ in range(rng.randrange(2, 30))]
        cuts = sorted(rng.sample(range(1, len(rows)), min(len(rows) - 1, rng.randrange(1, 6))))
        parts = []
        for a, b in itertools.pairwise([0, *cuts, len(rows)]):
            table = [cv.best_paths(rows[a:b], (end,)) for end in range(4)]
            parts.append([table[end][s] for s in range(4) for end in range(4)])
        whole = cv.join_paths([cv.join_paths(parts[:2]), *parts[2:]])
        ends = [whole[e] for e in cv.ENDS if whole[e] is not None]
        assert min(ends) == cv.best_paths(rows, cv.ENDS)[cv.BEGIN]


def brute(rows):
    """The contract, row by row; paths by a forward table of costs and letters."""
    out, by_id = {}, {}
    for conv, turn, role, text in rows:
        group = by_id.setdefault(conv, [])
        sp = lambda v: " " if v is None else v
        role, text = sp(role), sp(text)
        fate = zlib.crc32(f"{sp(conv)}:{sp(turn)}".encode()) % 20
        text = "" if fate == 1 else re.sub("[.!?]", "", text) if fate == 2 else text
        role = "user" if fate == 4 else role
        group += [(turn, role, text)] * (0 if fate == 0 else 2 if fate == 3 else 1)
    for conv, group in by_id.items():
        group.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1], r[2]))
        turns = [t for t, _, _ in group if t is not None]
        faults, seen = [], set()
        for _, role, text in group:
            bare = text.strip(" \t\n\x0b\f\r")
            faults.append("blank" if not bare else "duplicate" if (role, text) in seen else "" if bare[-1] in ".!?" else "truncated")
            seen.add((role, text))
        table = {"": (0, "", ())}  # last role -> cost, letters, rows so far
        def offer(t, state, cost, letters, made):
            if state not in t or (cost, letters) < t[state][:2]:
                t[state] = (cost, letters, made)
        def inserted(t):
            for state in ("", "s", "u", "a", "u", "a"):
                if state in t:
                    c, l, m = t[state]
                    new = NEXT[state]
                    offer(t, new, c + 2, l + "I", (*m, ("user:" if new == "u" else "assistant:")))
        inserted(table)
        for (_, role, text), fault in zip(group, faults):
            after = {}
            for state, (c, l, m) in table.items():
                offer(after, state, c + 3, l + "D", m)
                if fault in ("", "truncated"):
                    extra = fault == "truncated"
                    new = NEXT[state]
                    offer(after, new, c + 2 + extra, l + "R", (*m, f"{'user' if new == 'u' else 'assistant'}:{text}"))
                    if role[:1] == "s" and state == "" or role[:1] == new:
                        offer(after, role[:1], c + extra, l + "K", (*m, f"{role}:{text}"))
            inserted(after)
            table = after
        cost, letters, made = min(table[s] for s in ("", "a") if s in table)
        initials = [r[1][:1] for r in group]
        out[conv] = (
            max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0,
            faults.count("blank"), faults.count("duplicate"), faults.count("truncated"),
            sum(a + b not in ("su", "ua", "au") for a, b in itertools.pairwise(initials)),
            cost, letters, hashlib.sha256("\n".join(made).encode()).hexdigest(),
        )
    return out


def run(df, **params):
    got = cv.repair_damaged(df, **params).collect()
    cols = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256")
    assert len({r["conv_id"] for r in got}) == len(got)
    return {r["conv_id"]: tuple(r[c] for c in cols) for r in got}


def sample():
    rng = random.Random(7)
    roles = ["user", "assistant", "system", "user", "assistant", "tool", "", None, "sys"]
    texts = ["Yes.", "No", "", " \t", None, "a longer text, without end", "ß?\n", "Ünï!", "what is it?", "x" * 5000]
    rows = []
    for conv in range(120):
        for t in range(rng.randrange(1, 12)):
            rows.append((conv if conv else None, rng.choice([t, t, t, t + 3, None, 2]), rng.choice(roles), rng.choice(texts)))
    for t in range(150):  # long ones, with repeated turns and rows
        rows.append((500, t // 2, rng.choice(roles), f"{rng.choice(texts)}{t % 60}"))
        rows.append((501, t, ("user", "assistant")[t % 2], f"turn {t}."))
    rows += [(502, None, "user", "same.")] * 40 + [(503, 9, "user", "one."), (2**40, 2**50, "user", "far?")]
    return rows


def frame(spark, rows):
    return spark.createDataFrame([(*r, "x", "y", "z", "w") for r in rows], SCHEMA)


def test_repair_equals_brute_force(spark):
    rows = sample()
    assert run(frame(spark, rows)) == brute(rows)


def test_long_conversations_in_chunks_equal_brute_force(spark):
    rows = sample()
    assert run(frame(spark, rows), chunk=5, fan=3) == brute(rows)


def test_query_on_given_table(spark):
    from helpers import SF, pandas

    from tablelearn.llm.queries import QUERIES

    rows = [tuple(r) for r in pandas("conversations").astype(object).itertuples(index=False)]
    got = QUERIES["op13_conversation_repair"](spark, SF).collect()
    assert {r["conv_id"]: tuple(r)[1:] for r in got} == brute(rows)


def test_empty_and_dropped_conversations(spark):
    assert run(frame(spark, [])) == {}
    gone = [(c, t, "user", "a.") for c in range(40) for t in range(3) if zlib.crc32(f"{c}:{t}".encode()) % 20 == 0]
    assert gone
    want = (0, 0, 0, 0, 0, 0, "", hashlib.sha256().hexdigest())
    assert run(frame(spark, gone)) == {c: want for c, *_ in gone}
