"""Near-duplicate documents by circulant MinHash, banding and exact Jaccard verification.

A document's set is its distinct ``shingle``-word runs. Every shingle gets a place in a
circle of ``UNIVERSE`` places by a first permutation; a second permutation ranks the places.
Signature coordinate ``k`` is the smallest rank after shifting the second permutation by
``k`` places, so two permutations make all coordinates. Bands of coordinates are hashed to
buckets. The default bands miss a pair at similarity 0.8 with probability
(1 - 0.8^8)^64, below 1e-5, and one at 0.85 with 1e-9.

Inside a bucket nothing is paired with everything. Members are first compared with two leads,
the member of the smallest id and that of the smallest hash of an id: near copies that share
many buckets share the same few leads, so a pair is compared once however many buckets hold
it. What is still apart after that is compared in full, in one pass over the buckets that hold
more than one component, never two members of one component: pair by pair in small buckets; in
larger ones blocks of the members outside the smallest component meet chunks of all members in
bounded tasks, which return at most one link for each component that joins another there.
Before that a pair is dropped unread when the sizes rule the threshold out, or when the sketches
(one bit of each of 256 coordinates) differ in more places than a pair at the threshold does
with probability 1 - 1e-9. Every link is confirmed on the full sets:
``100 * intersection >= 80 * union``. No bucket, partner or candidate is capped.

Equal sets form one class and are linked without comparison. Components are found by
alternating large-star / small-star rounds on written tables.

Edge cases: null and wordless texts have an empty set and are linked with nothing; a text
with fewer words than a shingle has one shingle, the whole sequence; rows that repeat a
``doc_id`` are linked each by its own text; a row without ``doc_id`` is its own component,
``component_id`` null, and is kept.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from numpy.lib.stride_tricks import sliding_window_view
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablelearn.llm.common import worker_cache
from tablelearn.llm.wordsets import mix, shingle_set
from tablelearn.operators.joins import join_small
from tablelearn.session import materialize

UNIVERSE = 1 << 18
BANDS, ROWS = 64, 8
THRESHOLD = 80  # per cent
SMALL_BUCKET = 16  # members up to which what is apart is compared pair by pair
BLOCK, CHUNK = 256, 512  # rows that meet in one task in larger buckets
FOREST = 1_000_000  # nodes of which a task keeps the edges at a time
SKETCH = 256  # coordinates that give a bit to the sketch


def _permutations(width: int) -> tuple[np.ndarray, np.ndarray]:
    rng = np.random.default_rng(20240229)
    place = rng.permutation(UNIVERSE).astype(np.int64)
    rank = rng.permutation(UNIVERSE).astype(np.int32)
    return place, sliding_window_view(np.concatenate([rank, rank[:width]]), width)


def circulant_signature(items: np.ndarray, width: int) -> np.ndarray:
    """Smallest shifted rank per coordinate of a non-empty set of 64-bit items."""
    place, shifted = worker_cache(f"circulant_{width}", lambda: _permutations(width))
    at = np.unique(place[(items & np.uint64(UNIVERSE - 1)).astype(np.int64)])
    out = shifted[at[:1024]].min(axis=0)
    for k in range(1024, len(at), 1024):
        out = np.minimum(out, shifted[at[k : k + 1024]].min(axis=0))
    return out


def band_buckets(signature: np.ndarray, bands: int, rows: int) -> np.ndarray:
    parts = signature.astype(np.uint64).reshape(bands, rows)
    out = np.arange(bands, dtype=np.uint64)
    with np.errstate(over="ignore"):
        for k in range(rows):
            out = mix(out * np.uint64(0x9E3779B97F4A7C15) + parts[:, k] + np.uint64(1))
    return out.view(np.int64)


def sketch(signature: np.ndarray) -> np.ndarray:
    """The lowest bits of the first ``SKETCH`` coordinates in four 64-bit words (fewer
    coordinates repeat)."""
    return np.packbits(np.resize(signature, SKETCH) & 1).view(np.int64)


def sketch_limit(threshold: int, coordinates: int) -> int:
    """Differing sketch bits that a pair at the threshold exceeds with probability 1e-9 or less
    (mean and six deviations; repeated coordinates count once)."""
    own = min(SKETCH, coordinates)
    p = (1 - threshold / 100) / 2
    return int(np.ceil(SKETCH * (p + 6 * np.sqrt(p * (1 - p) / own))))


_SIGNATURE = "doc_id long, n_shingles long, k1 long, k2 long, s0 long, s1 long, s2 long, s3 long, buckets array<long>"


def signatures(docs: DataFrame, shingle: int, bands: int = BANDS, rows: int = ROWS) -> DataFrame:
    """``doc_id, n_shingles, k1, k2 (hash of the set), s0 .. s3 (sketch), buckets`` of every row."""
    names = [c.split()[0] for c in _SIGNATURE.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, texts = batch.column(0), batch.column(1)
            for start in range(0, len(batch), 2000):
                part = texts.slice(start, 2000)
                numbers = np.zeros((7, len(part)), np.int64)
                buckets = []
                for k, text in enumerate(part):
                    items = shingle_set(text.as_py(), shingle)
                    numbers[0, k] = len(items)
                    numbers[1:3, k] = np.frombuffer(xxhash.xxh3_128_digest(items.tobytes()), np.int64)
                    if len(items):
                        signature = circulant_signature(items, bands * rows)
                        numbers[3:, k] = sketch(signature)
                        buckets.append(band_buckets(signature, bands, rows))
                    else:
                        buckets.append(None)
                columns = [ids.slice(start, 2000).cast(pa.int64()), *map(pa.array, numbers), pa.array(buckets, pa.list_(pa.int64()))]
                yield pa.RecordBatch.from_arrays(columns, names=names)

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(run, _SIGNATURE)


def shingle_sets(docs: DataFrame, ids: DataFrame, shingle: int) -> DataFrame:
    """``id, items (sorted 64-bit hashes as bytes)`` of the documents named by ``ids``, written
    once. The ids are broadcast while they are small, so texts are not shuffled then."""

    def run(batches):
        for batch in batches:
            for start in range(0, len(batch), 1000):
                part = batch.slice(start, 1000)
                items = [shingle_set(t.as_py(), shingle).tobytes() for t in part.column(1)]
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(items, pa.binary())], names=["id", "items"])

    texts = docs.filter(F.col("doc_id").isNotNull()).select(F.col("doc_id").cast("long").alias("id"), "text")
    wanted = join_small(texts, ids, on=["id"]).select("id", "text")
    return materialize(wanted.mapInArrow(run, "id long, items binary"), "shingle-sets")


def verify(pairs: DataFrame, sets: DataFrame, threshold: int = THRESHOLD) -> DataFrame:
    """The distinct pairs ``a, b`` whose full sets are similar enough."""

    def run(batches):
        for batch in batches:
            keep = []
            left, right = batch.column(2), batch.column(3)
            for k in range(len(batch)):
                x = np.frombuffer(left[k].as_buffer(), np.uint64)
                y = np.frombuffer(right[k].as_buffer(), np.uint64)
                both = len(np.intersect1d(x, y, assume_unique=True))
                keep.append(100 * both >= threshold * (len(x) + len(y) - both) and both > 0)
            yield batch.select([0, 1]).filter(pa.array(keep, pa.bool_()))

    left = sets.select(F.col("id").alias("a"), F.col("items").alias("x"))
    right = sets.select(F.col("id").alias("b"), F.col("items").alias("y"))
    joined = pairs.join(left, "a").join(right, "b").select("a", "b", "x", "y")
    return joined.mapInArrow(run, "a long, b long").distinct()


def _forest(batches: Iterator[pa.RecordBatch], limit: int) -> Iterator[pa.RecordBatch]:
    """Edges ``hi, lo`` to one edge from each node to the smallest one that they join it with, for
    about ``limit`` nodes at a time."""
    root: dict[int, int] = {}

    def find(x: int) -> int:
        top = x
        while (up := root.setdefault(top, top)) != top:
            top = up
        while root[x] != top:
            root[x], x = top, root[x]
        return top

    def edges() -> pa.RecordBatch:
        rows = [(x, top) for x in root if (top := find(x)) != x]
        return pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], pa.int64()) for k in (0, 1)], names=["hi", "lo"])

    for batch in batches:
        for x, y in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            x, y = find(x), find(y)
            root[max(x, y)] = min(x, y)
        if len(root) > limit:
            yield edges()
            root.clear()
    if root:
        yield edges()


def components(edges: DataFrame, limit: int = FOREST) -> DataFrame:
    """``node, component`` (smallest reachable node) for every node of ``edges (a, b)``; a smallest
    node itself may be left out.

    Each round first thins what a task reads to stars; it ends as soon as no node has two edges
    up and none is both an end and a centre, so a round is not run only to see that nothing moves."""
    e = edges.filter(F.col("a") != F.col("b")).select(F.greatest("a", "b").alias("hi"), F.least("a", "b").alias("lo"))
    while True:
        e = materialize(e.mapInArrow(partial(_forest, limit=limit), "hi long, lo long"), "forest")
        up, down = F.struct(F.col("hi").alias("u"), F.lit(1).alias("up")), F.struct(F.col("lo").alias("u"), F.lit(0).alias("up"))
        ends = e.select(F.explode(F.array(up, down)).alias("p")).select("p.*")
        ends = ends.groupBy("u").agg(F.sum("up").alias("n"), F.min("up").alias("centre"))
        if not ends.filter("n > 1 or n = 1 and centre = 0").take(1):
            return e.select(F.col("hi").alias("node"), F.col("lo").alias("component"))
        both = e.select(F.explode(F.array(F.struct(F.col("hi").alias("u"), F.col("lo").alias("v")), F.struct(F.col("lo").alias("u"), F.col("hi").alias("v")))).alias("p")).select("p.*")
        low = materialize(both.groupBy("u").agg(F.min("v").alias("v0")).select("u", F.least("u", "v0").alias("m")), "star")
        # Copies stay until the next thinning; no step has more rows than it has edges.
        large = both.filter("v > u").join(low, "u").select(F.col("v").alias("hi"), F.col("m").alias("lo"))
        large = materialize(large, "large-star")
        low = materialize(large.groupBy("hi").agg(F.min("lo").alias("m")), "star")
        moved = large.join(low, "hi").filter("lo <> m").select(F.col("lo").alias("hi"), F.col("m").alias("lo"))
        e = materialize(moved.unionByName(low.select("hi", F.col("m").alias("lo"))), "small-star")


def _apart(members: DataFrame, comps: DataFrame) -> DataFrame:
    """The ``members`` of buckets of more than two that hold more than one component, with their
    ``component``, the smallest component ``c0`` of the bucket, its members ``m`` and those
    outside ``c0``, ``o``."""
    c = comps.select(F.col("node").alias("rep"), "component")
    m = members.join(c, "rep", "left").withColumn("component", F.coalesce("component", "rep"))
    m = materialize(m, "labelled-members")
    held = m.groupBy("bucket", "component").agg(F.count(F.lit(1)).alias("n")).groupBy("bucket").agg(
        F.min(F.struct("component", "n")).alias("first"), F.sum("n").alias("m")
    )
    held = held.select("bucket", F.col("first.component").alias("c0"), "m", (F.col("m") - F.col("first.n")).alias("o"))
    return materialize(m.join(materialize(held.filter("m > 2 and o > 0"), "apart-buckets"), "bucket"), "apart")


def _alike(pairs: DataFrame, sizes: DataFrame, threshold: int, limit: int) -> DataFrame:
    """Pairs that sizes and sketches do not rule out."""
    x = sizes.select(F.col("id").alias("a"), F.col("n").alias("n0"), *[F.col(f"s{k}").alias(f"x{k}") for k in range(4)])
    y = sizes.select(F.col("id").alias("b"), F.col("n").alias("n1"), *[F.col(f"s{k}").alias(f"y{k}") for k in range(4)])
    differ = sum((F.bit_count(F.col(f"x{k}").bitwiseXOR(F.col(f"y{k}"))) for k in range(4)), F.lit(0))
    near = F.expr(f"100 * least(n0, n1) >= {threshold} * greatest(n0, n1)") & (differ <= limit)
    return pairs.join(x, "a").join(y, "b").filter(near).select("a", "b")


def _block_links(members: DataFrame, sets: DataFrame, threshold: int) -> DataFrame:
    """Components ``a, b`` that members of the same bucket link.

    ``members``: ``bucket, rep, component, c0, m (members), o (members outside c0)``. The
    outsiders are dealt to blocks of about ``BLOCK`` and all members to chunks of about
    ``CHUNK``; every block of a bucket meets every chunk of it in a task of its own. Components
    that a task has linked are one from then on, so it returns fewer rows than it has members."""
    one = members.withColumn("blocks", F.ceil(F.col("o") / BLOCK).cast("int")).withColumn("chunks", F.ceil(F.col("m") / CHUNK).cast("int"))
    dealt = lambda n: F.pmod(F.xxhash64("rep", F.lit(5)), F.col(n)).cast("int")
    every = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    outside = one.filter("component <> c0").select("bucket", "rep", "component", F.lit(True).alias("ask"), dealt("blocks").alias("block"), every("chunks").alias("chunk"))
    inside = one.select("bucket", "rep", "component", F.lit(False).alias("ask"), every("blocks").alias("block"), dealt("chunks").alias("chunk"))
    rows = outside.unionByName(inside).join(sets.withColumnRenamed("id", "rep"), "rep")

    def run(frame: pd.DataFrame) -> pd.DataFrame:
        items = [np.frombuffer(v, np.uint64) for v in frame["items"]]
        label = frame["component"].to_numpy(np.int64, copy=True)
        ask = np.flatnonzero(frame["ask"].to_numpy(bool))
        others = np.flatnonzero(~frame["ask"].to_numpy(bool))
        sizes = np.array([len(v) for v in items])
        found: list[tuple[int, int]] = []
        # As many askers at a time as keep the incidence table below 32 MB.
        step = max(1, min(BLOCK, (1 << 25) // max(1, int(sizes[ask].sum()) if len(ask) else 1)))
        for start in range(0, len(ask), step):
            some = ask[start : start + step]
            known = np.unique(np.concatenate([items[k] for k in some]))
            has = np.zeros((len(known), len(some)), np.uint8)
            for column, k in enumerate(some):
                has[np.searchsorted(known, items[k]), column] = 1
            for y in others:
                at = np.searchsorted(known, items[y])
                at = at[(at < len(known)) & (known[np.minimum(at, len(known) - 1)] == items[y])]
                both = has[at].sum(0, dtype=np.int64)
                near = 100 * both >= threshold * (sizes[some] + sizes[y] - both)
                for other in np.unique(label[some[near & (label[some] != label[y])]]):
                    lo, hi = sorted((int(other), int(label[y])))
                    found.append((lo, hi))
                    label[label == hi] = lo
        return pd.DataFrame(found, columns=["a", "b"], dtype="int64")

    return rows.groupBy("bucket", "block", "chunk").applyInPandas(run, "a long, b long").distinct()


def near_duplicates(
    docs: DataFrame, shingle: int = 5, threshold: int = THRESHOLD, bands: int = BANDS, rows: int = ROWS
) -> DataFrame:
    """``doc_id, n_shingles, component_id, kept`` of every row (see the module text)."""
    docs = docs.select("doc_id", "text")
    base = materialize(signatures(docs, shingle, bands, rows), "signatures")
    filled = base.filter("n_shingles > 0 and doc_id is not null")
    classes = filled.groupBy("k1", "k2").agg(F.min("doc_id").alias("rep"))
    classes = materialize(classes, "set-classes")
    reps = filled.join(classes.select(F.col("rep").alias("doc_id"), "k1", "k2"), ["doc_id", "k1", "k2"])
    entries = materialize(reps.select(F.col("doc_id").alias("rep"), F.explode("buckets").alias("bucket")), "bucket-entries")
    other = F.min(F.struct(F.xxhash64("rep").alias("h"), F.col("rep"))).alias("other")
    leads = entries.groupBy("bucket").agg(F.min("rep").alias("lo"), F.max("rep").alias("hi"), other).filter("lo <> hi")
    leads = materialize(leads.select("bucket", "lo", F.col("other.rep").alias("other")), "bucket-leads")
    members = materialize(entries.join(leads, "bucket"), "members")
    ids = materialize(members.select(F.col("rep").alias("id")).distinct(), "candidates")
    described = filled.select(F.col("doc_id").alias("id"), F.col("n_shingles").alias("n"), *[f"s{k}" for k in range(4)])
    sizes = materialize(described.join(ids, "id", "left_semi").dropDuplicates(["id"]), "candidate-sketches")
    sets = shingle_sets(docs, ids, shingle)
    limit = sketch_limit(threshold, bands * rows)

    # Every document with the leads of each of its buckets.
    star = members.select(F.explode(F.array("lo", "other")).alias("lead"), "rep").filter("lead <> rep")
    star = star.select(F.least("lead", "rep").alias("a"), F.greatest("lead", "rep").alias("b")).distinct()
    links = materialize(verify(materialize(_alike(star, sizes, threshold, limit), "pairs"), sets, threshold), "links")
    comps = components(links)

    # What is still apart inside a bucket is compared in full; pairs with a lead are done.
    apart = _apart(members, comps)
    small = apart.filter((F.col("m") <= SMALL_BUCKET) & (F.col("rep") != F.col("lo")) & (F.col("rep") != F.col("other")))
    x = small.select("bucket", F.col("rep").alias("a"), F.col("component").alias("ca"))
    y = small.select("bucket", F.col("rep").alias("b"), F.col("component").alias("cb"))
    pairs = x.join(y, "bucket").filter("a < b and ca <> cb").select("a", "b").distinct()
    found = verify(materialize(_alike(pairs, sizes, threshold, limit), "pairs"), sets, threshold)
    more = _block_links(apart.filter(F.col("m") > SMALL_BUCKET), sets, threshold)
    more = materialize(found.unionByName(more), "links")
    if more.take(1):
        # A component stands for its members: its smallest one is a document like any other.
        comps = components(more.unionByName(comps.select(F.col("node").alias("a"), F.col("component").alias("b"))))

    c = comps.select(F.col("node").alias("rep"), "component")
    # A rep's row count is that of its class, so the small class table is labelled first.
    named = materialize(classes.join(c, "rep", "left").select("k1", "k2", F.coalesce("component", "rep").alias("component")), "classes")
    out = base.select("doc_id", "n_shingles", "k1", "k2").join(named, ["k1", "k2"], "left")
    comp = F.when(F.col("n_shingles") > 0, F.col("component")).otherwise(F.col("doc_id"))
    out = out.select("doc_id", "n_shingles", F.when(F.col("doc_id").isNotNull(), comp).alias("component_id"))
    return out.withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))


def drop_near_duplicates(docs: DataFrame, shingle: int = 5, threshold: int = THRESHOLD) -> DataFrame:
    """``docs`` reduced to the kept document of each component; all columns stay. Of rows that
    repeat a kept ``doc_id`` one stays; rows without ``doc_id`` all stay."""
    kept = near_duplicates(docs, shingle, threshold).filter("kept and doc_id is not null")
    kept = materialize(kept.select(F.col("doc_id").alias("__kept_id")).distinct(), "kept-ids")
    named = docs.filter(F.col("doc_id").isNotNull())
    named = named.join(kept, named["doc_id"] == kept["__kept_id"], "left_semi").dropDuplicates(["doc_id"])
    return named.unionByName(docs.filter(F.col("doc_id").isNull()))
