"""Cheapest repair of conversation structure by one integer-minimum dynamic program.

A conversation's rows stand in order of turn (nulls first; equal turns by role and text).
Each row is kept (``K``), given another role (``R``), or deleted (``D``), and rows without
text may be inserted (``I``), so that the role initials read ``(s?(ua)+)?``. Nodes of the
graph are (row, state of that pattern). The weight of a path is one whole number: its high
digits are the cost, below them stand the letters of the edits, one digit of three bits per
letter from the highest place on, and zeros to the end. So the smaller number is the cheaper
path, and of equally cheap ones the path whose letters come first. ``_step`` goes from the
last row to the first: putting an edit before a path adds its cost above and moves the
letters down by a digit. The letters alone determine the repaired rows, since the pattern
leaves no choice of role.

Conversations of at most ``CHUNK`` rows are read from sorted partitions one after the other.
A longer one (which may hold any share of the table) is numbered by range partitions and cut
into chunks; each chunk gives the best path from each state to each state. Paths over the
same rows with equal cost are never beginnings of each other, so best paths of neighbouring
chunks can be joined in any grouping, and ``FAN`` chunks at a time become one until a
conversation is whole. The last pass streams a long conversation's rows through its hash,
which has to be one pass; it holds the letters and one batch of rows.

Edge cases: null roles and texts are one space, null ids form one conversation of their own,
null turns sort first and count in no gap; roles that begin with none of ``s u a`` can only
be given a role or deleted; repeated rows are duplicates; a conversation without rows has
zeros, no letters and the hash of the empty text; an empty table gives an empty result.
Columns other than ``conv_id, turn, role, text`` are not looked at.
"""

from __future__ import annotations

import hashlib
import itertools
import re

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tablelearn.operators.joins import join_small
from tablelearn.operators.sequence import number_rows
from tablelearn.session import materialize

CHUNK = 512
FAN = 64

# Costs and letters of the edits; digits in the order of the letters.
LETTERS = " DIKR"
DELETE, INSERT, KEEP, REROLE = 1, 2, 3, 4
COST = {DELETE: 3, INSERT: 2, KEEP: 0, REROLE: 2}
TRUNCATED_COST = 1

# States of the pattern: nothing yet, system, user, assistant; it may end in the first and last.
BEGIN, SYSTEM, USER, ASSISTANT = range(4)
ENDS = (BEGIN, ASSISTANT)
FOLLOW = ({"s": SYSTEM, "u": USER}, {"u": USER}, {"a": ASSISTANT}, {"u": USER})
FREE = (USER, USER, ASSISTANT, USER)  # the state after a role of the program's choice
ROLE = {USER: "user", ASSISTANT: "assistant"}
LEGAL = {"su", "ua", "au"}

_BLANK = re.compile(r"[^\x20\x09-\x0D]")
_SPACE = " \t\n\x0b\f\r"

# --------------------------------------------------------------------------- the program


class Weights:
    """Numbers for paths of at most ``letters`` edits."""

    def __init__(self, letters: int):
        self.bits = 3 * letters
        self.low = (1 << self.bits) - 1
        self.never = 1 << (self.bits + 48)  # the cost of what cannot be

    def before(self, path: int, cost: int, letter: int) -> int:
        letters = path & self.low
        return path - letters + (cost << self.bits) + (letter << (self.bits - 3)) + (letters >> 3)

    def run_before(self, path: int, cost: int, run: int, length: int) -> int:
        """``length`` letters (as a number) before a path."""
        letters = path & self.low
        return path - letters + (cost << self.bits) + (run << (self.bits - 3 * length)) + (letters >> (3 * length))

    def read(self, path: int) -> tuple[int, str] | None:
        if path >= self.never:
            return None
        digits = oct((path & self.low) | 1 << self.bits)[3:].rstrip("0")
        return path >> self.bits, "".join(LETTERS[int(d)] for d in digits)


def _insert(w: Weights, paths: list[int]) -> list[int]:
    """Inserted rows before the present place: at most a user and an assistant."""
    put = lambda state: w.before(paths[state], COST[INSERT], INSERT)
    user = min(paths[USER], put(ASSISTANT))
    then = w.before(user, COST[INSERT], INSERT)
    return [min(paths[BEGIN], then), min(paths[SYSTEM], then), user, min(paths[ASSISTANT], put(USER))]


def _step(w: Weights, after: list[int], initial: str, fault: str) -> list[int]:
    """Best path from each state before a row, given those behind it."""
    extra = TRUNCATED_COST if fault == "truncated" else 0
    now = []
    for state in range(4):
        best = w.before(after[state], COST[DELETE], DELETE)
        if fault not in ("blank", "duplicate"):
            following = FOLLOW[state].get(initial)
            if following is not None:
                best = min(best, w.before(after[following], COST[KEEP] + extra, KEEP))
            best = min(best, w.before(after[FREE[state]], COST[REROLE] + extra, REROLE))
        now.append(best)
    return _insert(w, now)


def best_paths(rows: list[tuple[str, str]], ends: tuple[int, ...]) -> list[tuple[int, str] | None]:
    """Cost and letters of the best path from each state through ``(initial, fault)`` rows to
    one of the states ``ends``."""
    w = Weights(3 * len(rows) + 4)  # never more than two insertions at a place
    paths = _insert(w, [0 if s in ends else w.never for s in range(4)])
    for initial, fault in reversed(rows):
        paths = _step(w, paths, initial, fault)
    return [w.read(p) for p in paths]


def join_paths(parts: list[list[tuple[int, str] | None]]) -> list[tuple[int, str] | None]:
    """The 4 x 4 best paths of neighbouring chunks as those of one: the same program, with a
    chunk's path as one edge."""
    digit = {c: i for i, c in enumerate(LETTERS)}
    edges = [
        [None if e is None else (e[0], int("".join(str(digit[c]) for c in e[1]) or "0", 8), len(e[1])) for e in part] for part in parts
    ]
    w = Weights(sum(max((e[2] for e in part if e), default=0) for part in edges))
    out = []
    for end in range(4):
        paths = [0 if s == end else w.never for s in range(4)]
        for part in reversed(edges):
            paths = [
                min([w.run_before(paths[t], *part[4 * s + t]) for t in range(4) if part[4 * s + t]], default=w.never) for s in range(4)
            ]
        out.append([w.read(p) for p in paths])
    return [out[end][s] for s in range(4) for end in range(4)]


def fault_of(text: str, seen: bool) -> str:
    if not _BLANK.search(text):
        return "blank"
    if seen:
        return "duplicate"
    return "" if text.rstrip(_SPACE)[-1] in ".!?" else "truncated"


class Repaired:
    """The repaired rows of a conversation as a hash, fed row by row."""

    def __init__(self, letters: str):
        self.letters, self.place, self.state = letters, 0, BEGIN
        self.hash, self.first = hashlib.sha256(), True

    def _add(self, role: str, text: str) -> None:
        self.hash.update(("" if self.first else "\n").encode() + f"{role}:{text}".encode("utf-8", "surrogatepass"))
        self.first = False

    def _inserted(self) -> None:
        while self.letters[self.place : self.place + 1] == "I":
            self.state, self.place = FREE[self.state], self.place + 1
            self._add(ROLE[self.state], "")

    def row(self, role: str, text: str) -> None:
        self._inserted()
        letter = self.letters[self.place]
        self.place += 1
        if letter == "K":
            self.state = FOLLOW[self.state][role[:1]]
            self._add(role, text)
        elif letter == "R":
            self.state = FREE[self.state]
            self._add(ROLE[self.state], text)

    def digest(self) -> str:
        self._inserted()
        return self.hash.hexdigest()


# --------------------------------------------------------------------------- in tasks

_STATS = [
    ("blank", pa.int64()), ("duplicate", pa.int64()), ("truncated", pa.int64()), ("illegal", pa.int64()),
    ("first", pa.string()), ("last", pa.string()), ("low", pa.int64()), ("high", pa.int64()), ("turns", pa.int64()),
]
_STATS_SQL = "blank long, duplicate long, truncated long, illegal long, first string, last string, low long, high long, turns long"


def _stats(turns: list, initials: list[str], faults: list[str]) -> dict:
    known = [t for t in turns if t is not None]
    return {
        **{f: faults.count(f) for f in ("blank", "duplicate", "truncated")},
        "illegal": sum(a + b not in LEGAL for a, b in itertools.pairwise(initials)),
        "first": initials[0], "last": initials[-1],
        "low": known[0] if known else None, "high": known[-1] if known else None, "turns": len(set(known)),
    }


def _join_stats(a: dict, b: dict) -> dict:
    out = {f: a[f] + b[f] for f in ("blank", "duplicate", "truncated")}
    out["illegal"] = a["illegal"] + b["illegal"] + (a["last"] + b["first"] not in LEGAL)
    out["first"], out["last"] = a["first"], b["last"]
    out["low"] = b["low"] if a["low"] is None else a["low"]
    out["high"] = a["high"] if b["high"] is None else b["high"]
    out["turns"] = a["turns"] + b["turns"] - (a["high"] is not None and a["high"] == b["low"])
    return out


def _gaps(low, high, turns: int) -> int:
    return 0 if low is None else min(high - low + 1 - turns, 2**63 - 1)


def _rows(batches):
    for b in batches:
        yield from zip(*[c.to_pylist() for c in b.columns])


def _groups(batches, keys: int):
    """Consecutive rows with equal first ``keys`` columns."""
    for key, rows in itertools.groupby(_rows(batches), key=lambda r: r[:keys]):
        yield key, list(rows)


def _emit(records, schema: pa.Schema, size: int = 2000):
    for part in iter(lambda it=iter(records): list(itertools.islice(it, size)), []):
        yield pa.RecordBatch.from_pylist(part, schema)


_RESULT = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost"]
_RESULT_SQL = ", ".join(f"{c} long" for c in _RESULT) + ", audit string, repaired_sha256 string"


def _repair_short(id_type: pa.DataType):
    schema = pa.schema([("conv_id", id_type), *[(c, pa.int64()) for c in _RESULT], ("audit", pa.string()), ("repaired_sha256", pa.string())])

    def one(conv_id, rows: list[tuple]) -> dict:
        rows = [r for r in rows if r[2] is not None]  # a null role only says that the conversation is there
        out = {"conv_id": conv_id, **dict.fromkeys(_RESULT, 0), "audit": "", "repaired_sha256": hashlib.sha256().hexdigest()}
        if not rows:
            return out
        seen, faults = set(), []
        for _, _, role, text in rows:
            faults.append(fault_of(text, (role, text) in seen))
            seen.add((role, text))
        initials = [r[2][:1] for r in rows]
        cost, letters = best_paths(list(zip(initials, faults)), ENDS)[BEGIN]
        after = Repaired(letters)
        for _, _, role, text in rows:
            after.row(role, text)
        stats = _stats([r[1] for r in rows], initials, faults)
        out |= {c: stats[c] for c in ("blank", "duplicate", "truncated", "illegal")}
        out |= {"gaps": _gaps(stats["low"], stats["high"], stats["turns"]), "cost": cost, "audit": letters, "repaired_sha256": after.digest()}
        return out

    def run(batches):
        yield from _emit((one(key[0], rows) for key, rows in _groups(batches, 1)), schema)

    return run


_PATHS = pa.list_(pa.struct([("cost", pa.int64()), ("letters", pa.string())]))
_PATHS_SQL = "paths array<struct<cost: long, letters: string>>"


def _chunk_schema(id_type: pa.DataType) -> pa.Schema:
    return pa.schema([("conv_id", id_type), ("chunk", pa.int64()), *_STATS, ("paths", _PATHS)])


def _as_structs(paths):
    return [None if p is None else {"cost": p[0], "letters": p[1]} for p in paths]


def _read_chunks(id_type: pa.DataType):
    def one(key, rows: list[tuple]) -> dict:
        faults = [fault_of(text, bool(seen)) for *_, text, seen in rows]
        initials = [r[4][:1] for r in rows]
        table = [best_paths(list(zip(initials, faults)), (end,)) for end in range(4)]
        paths = [table[end][s] for s in range(4) for end in range(4)]
        return {"conv_id": key[0], "chunk": key[1], **_stats([r[3] for r in rows], initials, faults), "paths": _as_structs(paths)}

    def run(batches):
        yield from _emit((one(k, rows) for k, rows in _groups(batches, 2)), _chunk_schema(id_type), 16)

    return run


def _join_chunks(id_type: pa.DataType):
    schema = _chunk_schema(id_type)

    def one(key, rows: list[tuple]) -> dict:
        parts = [dict(zip(schema.names, r)) for r in rows]
        stats = parts[0]
        for p in parts[1:]:
            stats = _join_stats(stats, p)
        paths = join_paths([[None if e is None else (e["cost"], e["letters"]) for e in p["paths"]] for p in parts])
        return {"conv_id": key[0], "chunk": key[1], **{n: stats[n] for n, _ in _STATS}, "paths": _as_structs(paths)}

    def run(batches):
        yield from _emit((one(k, rows) for k, rows in _groups(batches, 2)), schema, 1)

    return run


def _hash_long(id_type: pa.DataType):
    schema = pa.schema([("conv_id", id_type), ("repaired_sha256", pa.string())])

    def records(batches):
        for key, rows in itertools.groupby(_rows(batches), key=lambda r: r[0]):
            after = Repaired(next(rows)[3])  # the letters come first
            for _, _, role, text in rows:
                after.row(role, text)
            yield {"conv_id": key, "repaired_sha256": after.digest()}

    def run(batches):
        yield from _emit(records(batches), schema, 100)

    return run


# --------------------------------------------------------------------------- as Spark jobs


def damaged(conversations: DataFrame) -> DataFrame:
    """``conv_id, turn, role, text, gone`` after the damage that a row's id and turn decide."""
    text_of = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    fate = F.crc32(F.concat(text_of("conv_id"), F.lit(":"), text_of("turn"))) % 20
    text = F.when(F.col("fate") == 1, "").when(F.col("fate") == 2, F.translate("text", ".!?", "")).otherwise(F.col("text"))
    role = F.when(F.col("fate") == 4, "user").otherwise(F.col("role"))
    copies = F.when(F.col("fate") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    rows = conversations.select("conv_id", "turn", text_of("role").alias("role"), text_of("text").alias("text"), fate.alias("fate"))
    rows = rows.select("conv_id", "turn", role.alias("role"), text.alias("text"), (F.col("fate") == 0).alias("gone"), copies.alias("copies"))
    return rows.withColumn("copy", F.explode("copies")).drop("copies", "copy")


def _id_type(rows: DataFrame, column: str = "conv_id") -> pa.DataType:
    from pyspark.sql.pandas.types import to_arrow_type

    return to_arrow_type(rows.schema[column].dataType)


def repair(rows: DataFrame, chunk: int = CHUNK, fan: int = FAN) -> DataFrame:
    """``conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256`` of
    every conversation of ``conv_id, turn, role, text, gone`` rows (as ``damaged`` makes)."""
    id_sql, id_type = rows.schema["conv_id"].dataType.simpleString(), _id_type(rows)
    kept = rows.where("not gone").drop("gone")
    bare = rows.where("gone").select("conv_id").distinct()
    long = materialize(kept.groupBy("conv_id").agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") > chunk), "long-conversations")
    some_long = not long.isEmpty()
    short = kept
    if some_long:
        short = join_small(kept, long, on=["conv_id"], how="left").where("_n is null").drop("_n")
        bare = join_small(bare, long, on=["conv_id"], how="left").where("_n is null").drop("_n")
    empty = bare.select("conv_id", *[F.lit(None).cast(rows.schema[c].dataType).alias(c) for c in ("turn", "role", "text")])
    stream = short.unionByName(empty).repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "text")
    out = stream.mapInArrow(_repair_short(id_type), f"conv_id {id_sql}, {_RESULT_SQL}")
    if not some_long:
        return out
    return out.unionByName(_repair_long(join_small(kept, long, on=["conv_id"]).drop("_n"), id_sql, id_type, chunk, fan))


def _repair_long(rows: DataFrame, id_sql: str, id_type: pa.DataType, chunk: int, fan: int) -> DataFrame:
    numbered = number_rows(rows, ["turn", "role", "text"], "conv_id").select("conv_id", "turn", "role", "text", "idx")
    numbered = materialize(numbered.withColumn("h", F.sha2(F.concat_ws(":", "role", "text"), 256)), "long-rows")
    once = numbered.groupBy("conv_id", "h").agg(F.min("idx").alias("_first"), F.count(F.lit(1)).alias("_n")).where("_n > 1").drop("_n")
    again = join_small(numbered.select("conv_id", "h", "idx"), once, on=["conv_id", "h"]).where("idx > _first").select("conv_id", "idx", F.lit(True).alias("_seen"))
    chunks = join_small(numbered, again, on=["conv_id", "idx"], how="left").select(
        "conv_id", F.floor(F.col("idx") / chunk).cast("long").alias("chunk"), "idx", "turn", "role", "text", "_seen"
    )
    schema = f"conv_id {id_sql}, chunk long, {_STATS_SQL}, {_PATHS_SQL}"
    stream = chunks.repartition("conv_id", "chunk").sortWithinPartitions("conv_id", "chunk", "idx")
    parts = materialize(stream.mapInArrow(_read_chunks(id_type), schema), "conversation-chunks")
    while parts.agg(F.max("chunk")).first()[0] > 0:
        wider = parts.select("conv_id", F.floor(F.col("chunk") / fan).cast("long").alias("_to"), *parts.columns[1:])
        stream = wider.repartition("conv_id", "_to").sortWithinPartitions("conv_id", "_to", "chunk").drop("chunk")
        parts = materialize(stream.mapInArrow(_join_chunks(id_type), schema), "conversation-chunks")
    # From the first state, to a state in which the pattern may end; equal costs by letters.
    ends: list[Column] = [F.element_at("paths", 4 * BEGIN + e + 1) for e in ENDS]
    best = F.array_min(F.filter(F.array(*ends), lambda p: p.isNotNull()))
    gaps = F.coalesce(F.col("high") - F.col("low") + 1 - F.col("turns"), F.lit(0))
    found = materialize(
        parts.select("conv_id", gaps.alias("gaps"), "blank", "duplicate", "truncated", "illegal", best["cost"].alias("cost"), best["letters"].alias("audit")),
        "long-audits",
    )
    letters = found.select("conv_id", F.lit(-1).cast("long").alias("idx"), F.lit("").alias("role"), F.col("audit").alias("text"))
    stream = numbered.select("conv_id", "idx", "role", "text").unionByName(letters).repartition("conv_id").sortWithinPartitions("conv_id", "idx")
    hashes = stream.mapInArrow(_hash_long(id_type), f"conv_id {id_sql}, repaired_sha256 string")
    return join_small(found, hashes, on=["conv_id"])


def repair_damaged(conversations: DataFrame, chunk: int = CHUNK, fan: int = FAN) -> DataFrame:
    """The repair of every conversation of the table after damage."""
    return repair(damaged(conversations.select("conv_id", "turn", "role", "text")), chunk, fan)
