"""Packing documents into sequences of bounded length by linear grouping and best fit.

Documents become token ids plus an end id; longer ones are cut into full pieces and a rest.
Only the histogram of piece lengths (at most ``capacity`` rows, whatever the input) reaches
the driver, which plans there:

1. Lengths above ``capacity / 8`` are large. Sorted downwards they are cut into ``groups``
   groups of equal cardinality, and every length is rounded up to its group's largest.
2. Configurations of the few rounded sizes are chosen one after the other: the largest size
   left plus the multiset of sizes left that fills the rest best, used as often as the
   groups allow.
3. Actual lengths take the places of the rounded ones, in order, which can only leave room.
4. Small lengths go, largest first, to the sequence with the least room that holds them, and
   open new sequences when none does.

The plan is run-length coded: equal sequences are one entry, so its size depends on
``capacity`` and ``groups`` only. It is sent to the tasks, where each piece finds its place
by its length and its rank among the pieces of that length. Ranks come from counts per
partition and length; the pieces of the tokenizing pass are written once, so ranks hold when
tasks run again.

Edge cases: a null or empty text is the end id alone; repeated rows and null ids are packed
like any others; an empty table gives an empty result. Extra columns are ignored.
"""

from __future__ import annotations

import zlib
from collections import defaultdict

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tablelearn.llm.tokens import token_bytes, vocabulary_path
from tablelearn.session import materialize

CAPACITY = 2048
GROUPS = 256
_END = (0).to_bytes(4, "little")


def pieces(docs: DataFrame, capacity: int = CAPACITY, path: str | None = None) -> DataFrame:
    """``doc_id, piece, start, length, ids_crc32`` of every piece, with the writing partition
    ``part`` and the piece's rank ``nth`` among its partition's pieces of that length."""
    path = path or vocabulary_path()

    def run(frames):
        part, seen = TaskContext.get().partitionId(), defaultdict(int)
        for frame in frames:
            rows = []
            for k in range(0, len(frame), 500):
                some = frame.iloc[k : k + 500]
                for doc_id, ids in zip(some["doc_id"], token_bytes(list(some["text"]), path), strict=True):
                    ids += _END
                    for piece, at in enumerate(range(0, len(ids), 4 * capacity)):
                        own = ids[at : at + 4 * capacity]
                        length = len(own) // 4
                        rows.append((doc_id, piece, at // 4, length, zlib.crc32(own), part, seen[length]))
                        seen[length] += 1
            out = pd.DataFrame(rows, columns=["doc_id", "piece", "start", "length", "ids_crc32", "part", "nth"])
            yield out.astype({"doc_id": "Int64"})

    schema = "doc_id long, piece int, start long, length long, ids_crc32 long, part int, nth long"
    return docs.select(F.col("doc_id").cast("long"), "text").mapInPandas(run, schema)


def _best_fill(room: int, sizes: list[int], left: list[int]) -> dict[int, int]:
    """How often to take each size (at most ``left`` times) so that their sum comes closest to
    ``room`` from below. Sums are bits of an integer."""
    masks, sums, full = [], 1, (1 << (room + 1)) - 1
    for k, size in enumerate(sizes):
        if size > room:
            continue
        for _ in range(min(left[k], room // size)):
            more = (sums | (sums << size)) & full
            if more == sums:
                break
            masks.append((k, sums))
            sums = more
        if sums >> room & 1:
            break
    at, taken = sums.bit_length() - 1, defaultdict(int)
    for k, before in reversed(masks):
        if not before >> at & 1:
            taken[k] += 1
            at -= sizes[k]
    return taken


def _linear_groups(lengths: list[tuple[int, int]], groups: int) -> list[list[tuple[int, int]]]:
    """Cut (length, count) runs, longest first, into groups of equal cardinality."""
    total = sum(n for _, n in lengths)
    size = max(1, -(-total // groups))
    out: list[list[tuple[int, int]]] = [[]]
    room = size
    for length, n in lengths:
        while n:
            if not room:
                out.append([])
                room = size
            take = min(n, room)
            out[-1].append((length, take))
            n, room = n - take, room - take
    return out


def _take(runs: list[tuple[int, int]], n: int) -> list[tuple[int, int]]:
    """Remove and return the first ``n`` items of run-length coded ``runs``."""
    out = []
    while n:
        length, have = runs[0]
        use = min(have, n)
        out.append((length, use))
        if use == have:
            runs.pop(0)
        else:
            runs[0] = (length, have - use)
        n -= use
    return out


def plan(histogram: dict[int, int], capacity: int = CAPACITY, groups: int = GROUPS) -> list[tuple[int, list[int]]]:
    """``(number of equal sequences, their lengths in order)`` for a histogram of lengths."""
    ordered = sorted(((k, n) for k, n in histogram.items() if n > 0), reverse=True)
    large = [(k, n) for k, n in ordered if 8 * k > capacity]
    runs = _linear_groups(large, groups) if large else []
    sizes = [g[0][0] for g in runs]
    left = [sum(n for _, n in g) for g in runs]
    classes: list[tuple[int, list[int]]] = []
    first = 0
    while first < len(sizes):
        if not left[first]:
            first += 1
            continue
        rest = left.copy()
        rest[first] -= 1
        use = _best_fill(capacity - sizes[first], sizes[first:], rest[first:])
        config = defaultdict(int, {first + k: n for k, n in use.items()})
        config[first] += 1
        times = min(left[k] // n for k, n in config.items())
        slots = []
        for k, n in sorted(config.items()):
            left[k] -= n * times
            slots += [_take(runs[k], times) for _ in range(n)]
        # Where an actual length changes in any slot, another class of equal sequences begins.
        while slots[0]:
            n = min(s[0][1] for s in slots)
            classes.append((n, [_take(s, n)[0][0] for s in slots]))
    rooms: dict[int, list[tuple[int, list[int]]]] = defaultdict(list)
    for n, own in classes:
        rooms[capacity - sum(own)].append((n, own))
    for length, n in ordered[len(large) :]:
        for room in range(length, capacity + 1):
            while rooms[room] and n:
                have, own = rooms[room].pop()
                use = min(have, n)
                if have > use:
                    rooms[room].append((have - use, own))
                rooms[room - length].append((use, own + [length]))
                n -= use
            if not n:
                break
            if room == capacity:
                each = capacity // length
                for count, many in ((n // each, each), (1, n % each)):
                    if count and many:
                        rooms[capacity - many * length].append((count, [length] * many))
    return [c for room in sorted(rooms) for c in rooms[room]]


def _places(classes: list[tuple[int, list[int]]]) -> dict[str, np.ndarray]:
    """For runs of pieces of one length: first rank, first sequence and offset, by (length, rank)."""
    rows, used, sequence = [], defaultdict(int), 0
    for n, own in classes:
        offset = 0
        for length in own:
            rows.append((length, used[length], sequence, offset))
            used[length] += n
            offset += length
        sequence += n
    table = np.array(sorted(rows), np.int64).reshape(-1, 4)
    return {"key": (table[:, 0] << 44) + table[:, 1], "rank": table[:, 1], "sequence": table[:, 2], "offset": table[:, 3]}


def pack(docs: DataFrame, capacity: int = CAPACITY, groups: int = GROUPS, path: str | None = None) -> DataFrame:
    """``doc_id, piece, start, length, ids_crc32, sequence_id, offset`` of every piece."""
    items = materialize(pieces(docs, capacity, path), "pieces")
    counts = materialize(items.groupBy("part", "length").agg(F.count(F.lit(1)).alias("n")), "piece-counts")
    histogram = {r["length"]: r["n"] for r in counts.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    where = _places(plan(histogram, capacity, groups))
    before = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    base = counts.select("part", "length", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))
    ranked = items.join(materialize(base, "piece-ranks"), ["part", "length"])
    ranked = ranked.select("doc_id", "piece", "start", "length", "ids_crc32", (F.col("base") + F.col("nth")).alias("rank"))

    def run(frames):
        for frame in frames:
            length, rank = frame["length"].to_numpy(np.int64), frame["rank"].to_numpy(np.int64)
            at = np.searchsorted(where["key"], (length << 44) + rank, side="right") - 1
            out = frame[["doc_id", "piece", "start", "length", "ids_crc32"]].astype({"doc_id": "Int64"})
            yield out.assign(sequence_id=where["sequence"][at] + rank - where["rank"][at], offset=where["offset"][at])

    schema = "doc_id long, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long"
    return ranked.mapInPandas(run, schema)
