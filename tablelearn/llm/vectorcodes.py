"""Vector code compression: four codebooks of at most 256 entries, searched by Orchard's method.

A vector becomes integers, ``floor(scale * x)``, and is cut into ``PARTS`` equal parts; each
part is replaced by the number of its codebook's nearest entry, so a vector is stored in
``PARTS`` bytes. Codebooks start as the parts of the vectors with the smallest ids and take
``rounds`` rounds of assignment and averaging, all in whole numbers.

Nearest entries are found by Orchard's search. For every entry there is a list of the other
entries by their distance from it. A part walks along the list of its best entry so far;
as soon as an entry is nearer, it goes on in that entry's list. Entries seen are marked and
not measured again, and the walk ends where the list is beyond twice the present distance:
whatever follows is farther away than the best entry. An entry at exactly twice the distance
may tie, so it is still looked at; ties go to the lower number. All parts of a batch walk in
step, so a step is a few array operations.

Each round is one Spark job over the stored integers. A task adds up its parts by entry, so
what is shuffled and comes back is a row for each part and entry, whatever the number of
vectors. A lost executor costs the tasks it ran; the codebooks are in the driver.

Edge cases: vectors that are null or hold null or non-finite components are dropped; all
others stay, repeated rows and null or repeated ids included (null ids come last, equal ids
in order of their components). Where lengths differ or are no multiple of ``PARTS``, missing
components count as 0. Components beyond ``LIMIT`` (in whole numbers) are set to it, so
that squared distances fit 64 bits. Fewer vectors than entries make a smaller codebook; an
empty table gives an empty result. Extra columns are ignored.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tablelearn.operators.joins import join_small
from tablelearn.session import materialize

PARTS = 4
ENTRIES = 256
ROUNDS = 4
SCALE = 1024
LIMIT = 2**27
_BATCH = 4096


def _finite(x: Column) -> Column:
    return x.isNotNull() & ~F.isnan(x) & (F.abs(x) != F.lit(float("inf")))


def whole_numbers(vectors: DataFrame, vec_id: str = "vec_id", vec: str = "embedding", label: str = "label", scale: int = SCALE) -> DataFrame:
    """``vec_id, label, v array<long>`` of the vectors that are kept, all of one length; written once."""
    kept = vectors.where(F.col(vec).isNotNull() & F.forall(vec, _finite))
    grid = F.transform(vec, lambda x: F.greatest(F.lit(-LIMIT), F.least(F.lit(LIMIT), F.floor(x.cast("double") * scale))).cast("long"))
    kept = materialize(kept.select(F.col(vec_id).alias("vec_id"), F.col(label).alias("label"), grid.alias("v")), "vector-grid")
    longest, shortest = kept.agg(F.max(F.size("v")), F.min(F.size("v"))).first()
    length = max(PARTS, -(-(longest or 0) // PARTS) * PARTS)
    if shortest is None or shortest == length:
        return kept
    zeros = F.array_repeat(F.lit(0).cast("long"), length - F.size("v"))
    return materialize(kept.withColumn("v", F.concat("v", zeros)), "vector-grid")


class Orchard:
    """Nearest entries of one codebook (``[k, d]`` whole numbers)."""

    def __init__(self, book: np.ndarray):
        self.book = book
        k = len(book)
        apart = np.stack([_square(book, np.broadcast_to(b, book.shape)) for b in book])
        apart[np.arange(k), np.arange(k)] = -1  # an entry heads its own list and is cut off
        self.list = np.argsort(apart, axis=1, kind="stable")[:, 1:]
        ends = np.full((k, 1), np.iinfo(np.int64).max, np.int64)
        self.apart = np.hstack([np.take_along_axis(apart, self.list, 1), ends])
        self.list = np.hstack([self.list, np.zeros((k, 1), self.list.dtype)])
        self.heights = book.sum(axis=1)
        self.by_height = np.argsort(self.heights, kind="stable")

    def nearest(self, q: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Entry and squared distance for each row of ``q``."""
        n, k = len(q), len(self.book)
        # A start of about the same sum; any start gives the same result.
        place = np.searchsorted(self.heights[self.by_height], q.sum(axis=1))
        cur = self.by_height[np.minimum(place, k - 1)]
        best = _square(q, self.book[cur])
        seen = np.zeros((n, k), bool)
        seen[np.arange(n), cur] = True
        at = np.zeros(n, np.int64)
        rows = np.arange(n)
        while rows.size:
            c, p = cur[rows], at[rows]
            on = self.apart[c, p] // 4 <= best[rows]  # beyond twice the distance the walk ends
            on &= p < k - 1
            rows, c, p = rows[on], c[on], p[on]
            entry = self.list[c, p]
            at[rows] = p + 1
            fresh = ~seen[rows, entry]
            new, entry = rows[fresh], entry[fresh]
            seen[new, entry] = True
            d = _square(q[new], self.book[entry])
            better = (d < best[new]) | ((d == best[new]) & (entry < cur[new]))
            new, entry = new[better], entry[better]
            cur[new], best[new], at[new] = entry, d[better], 0
        return cur, best


def _square(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    away = a - b
    return np.einsum("ij,ij->i", away, away)


def _grids(batches):
    """``(batch, [n, length] whole numbers)`` in pieces of a bounded number of rows."""
    for whole in batches:
        for begin in range(0, whole.num_rows, _BATCH):
            b = whole.slice(begin, _BATCH)
            yield b, b.column("v").flatten().to_numpy(zero_copy_only=False).reshape(b.num_rows, -1)


def _split(grid: np.ndarray, part: int) -> np.ndarray:
    size = grid.shape[1] // PARTS
    return np.ascontiguousarray(grid[:, part * size : (part + 1) * size])


def _next_books(grid: DataFrame, books: list[np.ndarray]) -> list[np.ndarray]:
    """One round: assign all parts, replace every used entry by the floor of its parts' mean."""
    size = books[0].shape[1]

    def add_up(batches):
        search = [Orchard(b) for b in books]
        counts = [np.zeros(len(b), np.int64) for b in books]
        sums = [np.zeros(b.shape, np.int64) for b in books]
        for _, numbers in _grids(batches):
            for p in range(PARTS):
                q = _split(numbers, p)
                entry, _ = search[p].nearest(q)
                counts[p] += np.bincount(entry, minlength=len(counts[p]))
                np.add.at(sums[p], entry, q)
        rows = [(p, e, int(counts[p][e]), sums[p][e].tolist()) for p in range(PARTS) for e in np.flatnonzero(counts[p]).tolist()]
        yield pa.RecordBatch.from_pylist(
            [dict(zip(("part", "entry", "n", "total"), r)) for r in rows],
            pa.schema([("part", pa.int32()), ("entry", pa.int32()), ("n", pa.int64()), ("total", pa.list_(pa.int64()))]),
        )

    added = grid.select("v").mapInArrow(add_up, "part int, entry int, n long, total array<long>")
    sums = [F.sum(F.col("total")[i]).alias(f"s{i}") for i in range(size)]
    out = [b.copy() for b in books]
    # At most one row for each part and entry.
    for r in added.groupBy("part", "entry").agg(F.sum("n").alias("n"), *sums).collect():
        out[r["part"]][r["entry"]] = [r[f"s{i}"] // r["n"] for i in range(size)]
    return out


def fit_codebooks(grid: DataFrame, entries: int = ENTRIES, rounds: int = ROUNDS) -> list[np.ndarray]:
    """The codebooks of ``whole_numbers`` rows: for each part ``[entries, length / PARTS]``."""
    first = grid.orderBy(F.col("vec_id").asc_nulls_last(), "v").limit(entries).select("v").collect()
    if not first:
        return []
    start = np.array([r["v"] for r in first], np.int64)
    books = [_split(start, p) for p in range(PARTS)]
    for _ in range(rounds):
        books = _next_books(grid, books)
    return books


def encode(grid: DataFrame, books: list[np.ndarray]) -> DataFrame:
    """``vec_id, label, code, error`` of ``whole_numbers`` rows."""
    fields = {f.name: f.dataType.simpleString() for f in grid.schema.fields}
    schema = f"vec_id {fields['vec_id']}, label {fields['label']}, code string, error long"

    def run(batches):
        search = None
        for b, numbers in _grids(batches):
            search = search or [Orchard(x) for x in books]
            found = [search[p].nearest(_split(numbers, p)) for p in range(PARTS)]
            entry = np.stack([e for e, _ in found], axis=1)
            error = np.sum([d for _, d in found], axis=0)
            code = ["".join(f"{e:02x}" for e in row) for row in entry.tolist()]
            yield pa.RecordBatch.from_arrays(
                [b.column("vec_id"), b.column("label"), pa.array(code, pa.string()), pa.array(error, pa.int64())],
                ["vec_id", "label", "code", "error"],
            )

    return grid.mapInArrow(run, schema)


def decode(codes: DataFrame, books: list[np.ndarray]) -> DataFrame:
    """``codes`` plus ``v``: the whole numbers that the codes stand for."""
    parts = []
    for p, book in enumerate(books):
        table = F.array(*[F.array(*[F.lit(int(x)) for x in e]) for e in book])
        number = F.conv(F.substring("code", 2 * p + 1, 2), 16, 10).cast("int")
        parts.append(F.element_at(table, number + 1))
    return codes.withColumn("v", F.concat(*parts))


def books_digest(books: list[np.ndarray]) -> str:
    """SHA-256 of all components by part, entry and position."""
    return hashlib.sha256(",".join(str(x) for b in books for x in b.ravel().tolist()).encode()).hexdigest()


def compress(vectors: DataFrame) -> DataFrame:
    """``vec_id, code, error, label_error, codebooks_sha256`` of every vector that is kept."""
    grid = whole_numbers(vectors)
    books = fit_codebooks(grid)
    codes = materialize(encode(grid, books), "vector-codes")
    by_label = codes.groupBy("label").agg(F.sum("error").alias("label_error"))
    return join_small(codes, by_label, on=["label"]).select(
        "vec_id", "code", "error", "label_error", F.lit(books_digest(books)).alias("codebooks_sha256")
    )
