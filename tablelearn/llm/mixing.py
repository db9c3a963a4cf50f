"""Mixing sources to target weights by Sainte-Laguë apportionment, in DataFrame operations only.

1. Sizes. A document's size is its number of words. Sources take the weights in turn, in
   code-point order (null last). Targets share the total by weight; a target stops at
   ``most`` times its source's size and the excess is shared again by weight.
2. Quotas. The total is cut into equal blocks of ``block`` words. Blocks go to sources by the
   highest quotients ``target / (2k - 1)``, then each source's blocks to its shards in the
   same way by their words (``sainte_lague``). A shard holds about ``shard_words`` words of
   one source, so a source of any size is spread over as many shards as it needs.
3. Selection. A shard's documents stand in a seeded order, one after the other on a circle.
   Its quota of blocks is read from a seeded word on, round and round; a quota above the
   shard's words repeats them, never more than ``most`` times.

Equal rows (same id, source and size) are one row with a count until the end, so a row that
is repeated very often weighs nothing. The text is read once; everything after that moves
ids and numbers. All tables are written to the shared folder and read again.

Edge cases: null and empty texts have size 0 and nothing is taken of them; null is a source
of its own; null ids are ids like any other; repeated rows each keep their own place on the
circle; an empty table gives an empty result. Ties between quotients go to the earlier
source or shard. Columns other than ``doc_id, text, source`` are not looked at.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tablelearn.operators.joins import join_small
from tablelearn.operators.sequence import number_rows
from tablelearn.session import materialize

WEIGHTS = (1, 2, 3)
MOST = 3
BLOCK = 16
SHARD_WORDS = 2_000_000
SEED = 11
WORD = "[^\\x20\\x09-\\x0D]+"
_COPIES = 4096


def _hash(what: str, seed: int, *parts: Column) -> Column:
    """A seeded number of 60 bits."""
    text = F.concat_ws(":", F.lit(f"{seed}:{what}"), *[F.coalesce(p.cast("string"), F.lit(" ")) for p in parts])
    return F.conv(F.substring(F.md5(text), 1, 15), 16, 10).cast("long")


def sized(docs: DataFrame) -> DataFrame:
    """``doc_id, source, size, copies``: the distinct rows and how often each stands there."""
    size = F.coalesce(F.regexp_count(F.col("text"), F.lit(WORD)), F.lit(0)).cast("long")
    return docs.select("doc_id", "source", size.alias("size")).groupBy("doc_id", "source", "size").agg(F.count(F.lit(1)).alias("copies"))


def targets(rows: DataFrame, weights: tuple[int, ...] = WEIGHTS, most: int = MOST) -> DataFrame:
    """``source, rank, source_size, target`` of every source of ``sized`` rows."""
    total = rows.groupBy("source").agg(F.sum(F.col("size") * F.col("copies")).alias("source_size"))
    total = total.withColumn("absent", F.col("source").isNull())
    ranked = number_rows(total, ["absent", "source"], idx_col="rank")
    turn = F.pmod("rank", F.lit(len(weights))).cast("int") + 1
    weight = F.element_at(F.array(*[F.lit(int(w)) for w in weights]), turn).cast("long")
    ranked = materialize(
        ranked.select("source", "rank", "source_size", weight.alias("weight"), (most * F.col("source_size")).alias("cap")),
        "mix-sources",
    )
    # Share out, stop targets at their caps, share the rest again: each round stops at least
    # one more source or is the last.
    whole, held, open_weight = ranked.agg(F.sum("source_size"), F.lit(0).cast("long"), F.sum("weight")).first()
    while True:
        if not open_weight:
            share, stopped = F.lit(0.0), F.lit(True)
            break
        share = F.lit(int(whole - held)) * F.col("weight") / F.lit(int(open_weight))
        stopped = F.col("cap") <= share
        now = ranked.agg(F.sum(F.when(stopped, F.col("cap")).otherwise(0)), F.sum(F.when(stopped, 0).otherwise(F.col("weight")))).first()
        if tuple(now) == (held, open_weight):
            break
        held, open_weight = now
    target = F.when(stopped, F.col("cap").cast("double")).otherwise(share)
    return ranked.select("source", "rank", "source_size", target.alias("target"))


def sainte_lague(parties: DataFrame, party: str, weight: str, seats: str, group: str | None = None) -> DataFrame:
    """``group?, party, quota``: the seats of each group given to its parties by the highest
    quotients ``weight / (2k - 1)``, ties to the lower party.

    ``seats`` is the same in all rows of a group. With ``n`` parties, a divisor of
    ``total / (seats - n/2)`` never gives away too many seats and ``total / (seats + n/2)``
    never too few. Seats won under the first need no ranking, those lost under the second
    cannot be won, so at most about four quotients a party are ranked, whatever the number
    of seats."""
    keys = [group] if group else []
    live = parties.where((F.col(weight) > 0) & (F.col(seats) > 0)).select(*keys, party, F.col(weight).cast("double").alias("_w"), F.col(seats).alias("_seats"))
    live = materialize(live, "mix-parties")
    sums = [F.count(F.lit(1)).alias("_n"), F.coalesce(F.sum("_w"), F.lit(0.0)).alias("_total")]
    if keys:
        live = join_small(live, live.groupBy(*keys).agg(*sums), on=keys)
    else:
        live = live.withColumns({c: F.lit(v) for c, v in live.agg(*sums).first().asDict().items()})
    most, least = (F.col("_seats") + F.col("_n") / 2), (F.col("_seats") - F.col("_n") / 2)
    base = F.greatest(F.lit(0.0), F.floor(F.col("_w") * least / F.col("_total") - 0.5)).cast("long")
    top = F.floor(F.col("_w") * most / F.col("_total") + 1.5).cast("long")
    live = materialize(live.select(*keys, party, "_w", "_seats", base.alias("_base"), top.alias("_top")), "mix-bounds")
    open_seats = (F.max("_seats") - F.sum("_base")).alias("_open")
    ranked = live.where("_top > _base").select(
        *keys, party, "_w", F.explode(F.sequence(F.col("_base") + 1, F.col("_top"))).alias("_k")
    )
    ranked = ranked.select(*keys, party, (-F.col("_w") / (2 * F.col("_k") - 1)).alias("_quotient"))
    ranked = number_rows(ranked, ["_quotient", party], group, idx_col="_place")
    if keys:
        ranked = join_small(ranked, live.groupBy(*keys).agg(open_seats), on=keys)
    else:
        ranked = ranked.withColumn("_open", F.lit(live.agg(open_seats).first()[0]).cast("long"))
    won = ranked.where(F.col("_place") < F.col("_open")).groupBy(*keys, party).agg(F.count(F.lit(1)).alias("_won"))
    out = live.join(won, on=[*keys, party], how="left")
    return out.select(*keys, party, (F.col("_base") + F.coalesce("_won", F.lit(0))).alias("quota"))


def mix(
    docs: DataFrame,
    weights: tuple[int, ...] = WEIGHTS,
    most: int = MOST,
    block: int = BLOCK,
    shard_words: int = SHARD_WORDS,
    seed: int = SEED,
) -> DataFrame:
    """One row per document: ``doc_id, source, size, source_size, target, shard, passes, pieces,
    taken``. The mix takes all its words ``passes`` times and, once more, the words
    ``first .. first + length - 1`` (from 0) of each piece; ``taken`` counts them all."""
    rows = materialize(sized(docs), "mix-sizes")
    sources = targets(rows, weights, most)
    whole = sources.agg(F.sum("source_size")).first()[0] or 0
    sources = materialize(sources.withColumn("blocks", F.lit(max(1, int(whole / block + 0.5))).cast("long")), "mix-targets")
    quota = sainte_lague(sources, "rank", "target", "blocks").withColumnRenamed("quota", "source_blocks")
    sources = sources.join(quota, on="rank", how="left").select(
        "source", "rank", "source_size", "target", F.coalesce("source_blocks", F.lit(0)).alias("source_blocks"),
        F.greatest(F.lit(1), F.ceil(F.col("source_size") / shard_words)).cast("long").alias("shards"),
    )
    placed = join_small(rows, sources, on=["source"]).withColumn("shard", F.pmod(_hash("shard", seed, F.col("doc_id")), F.col("shards")))
    words = F.col("size") * F.col("copies")
    in_shards = placed.groupBy("rank", "shard").agg(F.sum(words).alias("shard_size"), F.max("source_blocks").alias("source_blocks"))
    in_shards = materialize(in_shards, "mix-shards")
    quota = sainte_lague(in_shards, "shard", "shard_size", "source_blocks", group="rank")
    run = F.least(F.coalesce("quota", F.lit(0)) * block, most * F.col("shard_size"))
    in_shards = in_shards.join(quota, on=["rank", "shard"], how="left").where("shard_size > 0").select(
        "rank", "shard", "shard_size",
        F.floor(run / F.col("shard_size")).cast("long").alias("passes"),
        F.pmod(run, F.col("shard_size")).alias("rest"),
        F.pmod(_hash("start", seed, F.col("rank"), F.col("shard")), F.col("shard_size")).alias("start"),
    )
    # Only documents with words stand on a circle, so a shard has no more rows than words.
    place = Window.partitionBy("rank", "shard").orderBy(_hash("order", seed, F.col("doc_id")), F.col("doc_id"), "size")
    circle = placed.where("size > 0").withColumn("_at", F.coalesce(F.sum(words).over(place.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    circle = join_small(circle, in_shards, on=["rank", "shard"])
    one_by_one = circle.withColumn("_c", F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.col("copies") - 1) / _COPIES).cast("long"))))
    last = F.least(F.lit(_COPIES).cast("long"), F.col("copies") - F.col("_c") * _COPIES) - 1
    one_by_one = one_by_one.withColumn("_j", F.explode(F.sequence(F.lit(0).cast("long"), last)))
    begin = F.col("_at") + (F.col("_c") * _COPIES + F.col("_j")) * F.col("size")
    end = begin + F.col("size")

    def part(low: Column, high: Column) -> Column:
        first = F.greatest(begin, low)
        return F.struct((first - begin).alias("first"), (F.least(end, high) - first).alias("length"))

    stop = F.col("start") + F.col("rest")
    pieces = F.filter(
        F.array(part(F.lit(0).cast("long"), stop - F.col("shard_size")), part(F.col("start"), stop)), lambda p: p["length"] > 0
    )
    chosen = one_by_one.select("doc_id", "source", "size", "source_size", "target", "shard", "passes", pieces.alias("pieces"))
    empty = placed.where("size = 0").withColumn("_c", F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.col("copies") - 1) / _COPIES).cast("long"))))
    empty = empty.withColumn("_j", F.explode(F.sequence(F.lit(0).cast("long"), last))).select(
        "doc_id", "source", "size", "source_size", "target", "shard", F.lit(0).cast("long").alias("passes"),
        F.array().cast("array<struct<first:bigint,length:bigint>>").alias("pieces"),
    )
    extra = F.aggregate("pieces", F.lit(0).cast("long"), lambda s, p: s + p["length"])
    return chosen.unionByName(empty).withColumn("taken", F.col("passes") * F.col("size") + extra)
