"""Document fingerprints by consistent weighted sampling, in DataFrame operations only.

A document is the weighted set of its words (split at ASCII white space), each
weighted by its count. For sample ``i`` a word with weight ``w`` draws
``r, c ~ Gamma(2, 1)`` and ``b ~ U(0, 1)`` from a hash of (word, ``i``) and gets

    t = floor(ln w / r + b)        ln a = ln c - r * (t + 1 - b)

The word with the smallest ``ln a`` is the sample. ``(word, t)`` decides
``ln a``, so coordinate ``i`` of the signature stores a 32-bit hash of the
smallest ``ln a``. Two documents agree in a coordinate with probability
``sum min(w, w') / sum max(w, w')``, the generalised Jaccard similarity.

Edge cases: a null text is empty; texts without words share the all-zero
fingerprint, whose likeness to itself is 1 and to others 0; equal texts have
equal fingerprints; rows are never merged, so a repeated ``doc_id`` or row gets
one result row each (ordered by ``doc_id``, then text hash); a null ``doc_id``
sorts first. Other columns are ignored, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tablelearn.llm.common import SPACE_CLASS

SAMPLES = 32
_WIDTH = 8  # hex digits of a coordinate
_MASK = (1 << 21) - 1


def _uniform(bits: Column, shift: int) -> Column:
    """21 bits of a hash as a number strictly between 0 and 1."""
    return (F.shiftrightunsigned(bits, shift).bitwiseAND(_MASK).cast("double") + 0.5) * (2.0**-21)


def log_rank(term_hash: Column, log_weight: Column, sample: int) -> Column:
    """``ln a`` of one weighted term in one sample (see the module text)."""
    h1 = F.xxhash64(term_hash, F.lit(sample))
    h2 = F.xxhash64(h1)
    r = -F.ln(_uniform(h1, 0) * _uniform(h1, 21))
    c = -F.ln(_uniform(h2, 21) * _uniform(h2, 42))
    b = _uniform(h2, 0)
    return F.ln(c) - r * (F.floor(log_weight / r + b).cast("double") + (1.0 - b))


def words(text: Column) -> Column:
    return F.split(text, SPACE_CLASS + "+")


def weighted_terms(tokens: DataFrame, keys: list[str], term: str = "term") -> DataFrame:
    """Count each word of each key: ``keys, term, weight``."""
    return tokens.groupBy(*keys, term).agg(F.count(F.lit(1)).alias("weight"))


def _coordinate(lowest: Column) -> Column:
    code = F.hash(lowest).cast("long").bitwiseAND(0xFFFFFFFF)
    return F.when(lowest.isNull(), F.lit("0" * _WIDTH)).otherwise(F.lower(F.lpad(F.hex(code), _WIDTH, "0")))


def signatures(terms: DataFrame, keys: list[str], samples: int = SAMPLES, extra: dict[str, Column] | None = None):
    """``keys, fingerprint`` (and ``extra`` aggregates) of weighted terms; terms that are
    empty or hold white space carry no sample (callers use those to pass values along)."""
    real = (F.col("term") != "") & ~F.startswith(F.col("term"), F.lit(" "))
    prepared = terms.select(
        *keys,
        "term",
        F.when(real, F.xxhash64("term")).alias("th"),
        F.ln(F.col("weight").cast("double")).alias("lw"),
    )
    lows = [
        F.min(F.when(F.col("th").isNotNull(), log_rank(F.col("th"), F.col("lw"), i))).alias(f"m{i}")
        for i in range(samples)
    ]
    more = {k: v.alias(k) for k, v in (extra or {}).items()}
    agg = prepared.groupBy(*keys).agg(*lows, *more.values())
    return agg.select(*keys, F.concat(*[_coordinate(F.col(f"m{i}")) for i in range(samples)]).alias("fingerprint"), *more)


def likeness(a: Column, b: Column, samples: int = SAMPLES) -> Column:
    """Share of equal coordinates of two fingerprints."""
    same = [
        (F.substring(a, i * _WIDTH + 1, _WIDTH) == F.substring(b, i * _WIDTH + 1, _WIDTH)).cast("int")
        for i in range(samples)
    ]
    total = same[0]
    for s in same[1:]:
        total = total + s
    return total / F.lit(float(samples))


def fingerprint_documents(docs: DataFrame, samples: int = SAMPLES) -> DataFrame:
    """``doc_id, text_hash, fingerprint`` of every distinct (doc_id, text)."""
    d = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    keys = ["doc_id", "text_hash"]
    # A repeated row adds the same words again: one row per (doc_id, text) keeps weights right.
    once = d.dropDuplicates()
    tokens = once.select("doc_id", F.xxhash64("text").alias("text_hash"), F.explode(words(F.col("text"))).alias("term"))
    return signatures(weighted_terms(tokens, keys), keys, samples)


def _in_order(docs: DataFrame, chars_per_bucket: int, max_buckets: int) -> tuple[DataFrame, int]:
    """Rows in buckets of equal width of ``doc_id``, each bucket ending with a copy of the row
    that follows it (the last one with the very first row). Texts move once.

    One pass over the ids finds the first id of every bucket; at most ``max_buckets`` rows of
    three numbers, so they are broadcast to pick the copies."""
    span = docs.agg(
        F.min("doc_id").alias("lo"), F.max("doc_id").alias("hi"), F.sum(F.length("text")).alias("chars")
    ).first()
    lo, hi = (span["lo"] or 0), (span["hi"] or 0)
    buckets = max(1, min(max_buckets, (span["chars"] or 0) // chars_per_bucket + 1))
    width = (hi - lo) // buckets + 1
    bucket = F.coalesce(F.expr(f"cast((doc_id - {lo}) div {width} as int)"), F.lit(-1))
    rows = docs.select(bucket.alias("bucket"), "doc_id", F.coalesce("text", F.lit("")).alias("text"))
    # One row per bucket: the bucket in front of it, and for the very first one the last.
    whole = Window.orderBy("at_bucket")
    link = (
        docs.select(bucket.alias("at_bucket"), "doc_id")
        .groupBy("at_bucket")
        .agg(F.min("doc_id").alias("first_id"))
        .select(
            "at_bucket",
            "first_id",
            F.coalesce(
                F.lag("at_bucket").over(whole),
                F.max("at_bucket").over(whole.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)),
            ).alias("to_bucket"),
        )
    )
    copies = rows.join(
        F.broadcast(link),
        (F.col("bucket") == F.col("at_bucket")) & F.col("doc_id").eqNullSafe(F.col("first_id")),
    ).select(F.col("to_bucket").alias("bucket"), "doc_id", "text", F.lit(1).alias("copy"))
    both = rows.withColumn("copy", F.lit(0)).unionByName(copies)
    return both.repartition(max(1, (buckets + 1) // 2), "bucket"), buckets


def edited_fingerprints(
    docs: DataFrame, samples: int = SAMPLES, chars_per_bucket: int = 1_500_000, max_buckets: int = 200_000
) -> DataFrame:
    """One row per document: ``doc_id, n_chars, edited_sha256, fingerprint,
    edited_fingerprint, near_edited, near_next``.

    The edited text replaces the last floor(n/2) code points by the first as many of the next
    document (ascending ``doc_id``, after the last the first). Everything after the one
    shuffle by bucket (window, word counts, signatures, comparison with the next row) keeps
    that partitioning. ``max_buckets`` bounds the number of buckets, never the rows: beyond
    it buckets grow and spill."""
    d = docs.select("doc_id", "text")
    rows, _ = _in_order(d, chars_per_bucket, max_buckets)
    by_id = Window.partitionBy("bucket").orderBy("copy", F.col("doc_id").asc_nulls_first(), F.xxhash64("text"))
    rows = rows.select(
        "bucket", "copy", "doc_id", "text", F.row_number().over(by_id).alias("place"), F.lead("text").over(by_id).alias("next")
    )
    # The first copy follows the bucket's last row; further copies (ties) are not needed.
    half = F.floor(F.char_length("text") / 2).cast("int")
    edited = F.concat(
        F.substring(F.col("text"), F.lit(1), F.char_length("text") - half),
        F.substring(F.coalesce("next", F.lit("")), F.lit(1), half),
    )
    # The first "word" of a version starts with a space, which no word does: it carries the
    # document's values past the word count.
    head = F.concat_ws(" ", F.lit(""), F.coalesce(F.col("doc_id").cast("string"), F.lit("null")), F.char_length("text"), "copy")
    rows = rows.select("bucket", "place", "copy", "text", edited.alias("edited"), head.alias("head"))
    version = lambda n, text, head: F.struct(F.lit(n).alias("ver"), text.alias("t"), head.alias("head"))
    plain = version(0, F.col("text"), F.col("head"))
    changed = version(1, F.col("edited"), F.concat(F.lit(" "), F.sha2("edited", 256)))
    both = F.when(F.col("copy") == 0, F.array(plain, changed)).otherwise(F.array(plain))
    versions = rows.select("bucket", "place", F.explode(both).alias("v")).select("bucket", "place", "v.*")
    tokens = versions.select("bucket", "place", "ver", F.explode(F.concat(F.array("head"), words(F.col("t")))).alias("term"))
    keys = ["bucket", "place", "ver"]
    head_of = F.when(F.startswith(F.col("term"), F.lit(" ")), F.col("term"))
    part = lambda k: F.split_part(head_of, F.lit(" "), F.lit(k))
    sha_part = lambda k: F.when(
        F.col("ver") == 1, F.conv(F.substring(head_of, 2 + 16 * k, 16), 16, -10).cast("long")
    )
    extra = {
        "doc": F.max(F.when((F.col("ver") == 0) & (part(2) != "null"), part(2).cast("long"))),
        "n_chars": F.max(F.when(F.col("ver") == 0, part(3).cast("long"))),
        "copy": F.max(F.when(F.col("ver") == 0, part(4).cast("int"))),
        **{f"sha{k}": F.max(sha_part(k)) for k in range(4)},
    }
    sig = signatures(weighted_terms(tokens, keys), keys, samples, extra)
    sha = F.lower(F.concat(*[F.lpad(F.hex(F.col(f"sha{k}")), 16, "0") for k in range(4)]))
    own = lambda ver, c: F.max(F.when(F.col("ver") == ver, c))
    doc = sig.groupBy("bucket", "place").agg(
        F.max("doc").alias("doc_id"),
        F.max("n_chars").alias("n_chars"),
        F.max("copy").alias("copy"),
        own(1, sha).alias("edited_sha256"),
        own(0, F.col("fingerprint")).alias("fingerprint"),
        own(1, F.col("fingerprint")).alias("edited_fingerprint"),
    )
    by_place = Window.partitionBy("bucket").orderBy("place")
    doc = doc.withColumn("next_fingerprint", F.lead("fingerprint").over(by_place)).filter(F.col("copy") == 0)
    return doc.select(
        "doc_id",
        "n_chars",
        "edited_sha256",
        "fingerprint",
        "edited_fingerprint",
        likeness(F.col("fingerprint"), F.col("edited_fingerprint"), samples).alias("near_edited"),
        likeness(F.col("fingerprint"), F.col("next_fingerprint"), samples).alias("near_next"),
    )
