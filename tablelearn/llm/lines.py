"""Line deduplication that returns keep bitmaps instead of text, in DataFrame operations only.

A line's key is the line without ASCII white space at both ends and with A-Z
lower-cased. Keys of at least ``min_chars`` code points are hashed (two 64-bit
hashes), range-partitioned by (hash, document) and sorted by hash, then document
(largest first), then position, so a hash shared by any number of documents is
spread over as many ranges as it needs. Each range is then streamed once per
hash: its first occurrence names the largest document, its distinct documents
are counted. The ranges' summaries, not the lines, are combined per hash.

A document's keep bitmap is compressed: ``(word, bits)`` pairs of 64 lines each,
for words that lose a line; bit ``k`` of ``bits`` set means line ``64 * word + k``
stays, and words that are not listed stay whole.

Edge cases: a null or empty text is one empty line; documents are identified by
(doc_id, text), so repeated rows count as one document and get the same bitmap;
among lines of the largest ``doc_id`` holding a key all stay, repeats included;
a null ``doc_id`` sorts before all others. Extra columns pass through untouched.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tablelearn.llm.common import ASCII_SPACE, lower_ascii
from tablelearn.session import materialize

MIN_CHARS = 40
MIN_DOCS = 5


def line_key(line: Column) -> Column:
    return lower_ascii(F.btrim(line, F.lit(ASCII_SPACE)))


def _split(text: Column) -> Column:
    return F.split(F.coalesce(text, F.lit("")), "\n", -1)


def keyed_lines(docs: DataFrame, min_chars: int = MIN_CHARS) -> DataFrame:
    """``doc_id, th (text hash), pos, h1, h2`` of every line whose key is long enough."""
    d = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    lines = d.select("doc_id", F.xxhash64("text").alias("th"), F.posexplode(_split(F.col("text"))).alias("pos", "line"))
    # Trimming never lengthens a line, so short ones go before any key is made.
    lines = lines.filter(F.char_length("line") >= min_chars).withColumn("key", line_key(F.col("line")))
    return lines.filter(F.char_length("key") >= min_chars).select(
        "doc_id", "th", "pos", F.xxhash64("key").alias("h1"), F.xxhash64(F.lit(7), F.col("key")).alias("h2")
    )


def keep_bitmaps(docs: DataFrame, min_chars: int = MIN_CHARS, min_docs: int = MIN_DOCS) -> DataFrame:
    """``doc_id, th, n_dropped, bitmap array<struct<word, bits>>`` of the documents that lose lines."""
    keyed = keyed_lines(docs, min_chars)
    order = [F.col("h1"), F.col("h2"), F.col("doc_id").desc_nulls_last(), F.col("th"), F.col("pos")]
    ranged = (
        keyed.repartitionByRange(F.col("h1"), F.col("h2"), F.col("doc_id").desc_nulls_last())
        .sortWithinPartitions(*order)
        .withColumn("slice", F.spark_partition_id())
    )
    ranged = materialize(ranged, "line-hashes")
    per_doc = ranged.groupBy("slice", "h1", "h2", "doc_id").agg(F.count(F.lit(1)).alias("lines"))
    in_slice = per_doc.groupBy("slice", "h1", "h2").agg(F.count(F.lit(1)).alias("docs"), F.max("doc_id").alias("lead"))
    in_slice = materialize(in_slice, "line-slices")
    shared = (
        in_slice.groupBy("h1", "h2")
        .agg(F.sum("docs").alias("docs"), F.max("lead").alias("lead"))
        .filter(F.col("docs") >= min_docs)
        .select("h1", "h2", "lead")
    )
    # The decision goes back to the slices, and from there to their lines: a slice holds a
    # bounded number of lines, so no join key is hot.
    todo = in_slice.select("slice", "h1", "h2").join(shared, ["h1", "h2"])
    dropped = (
        ranged.join(todo, ["slice", "h1", "h2"])
        .filter(~F.col("doc_id").eqNullSafe(F.col("lead")))
        .select("doc_id", "th", "pos")
        .distinct()
    )
    bit = F.expr("shiftleft(1L, cast(pos % 64 as int))")
    by_word = dropped.groupBy("doc_id", "th", F.expr("cast(pos div 64 as int)").alias("word")).agg(
        F.bit_or(bit).alias("gone"), F.count(F.lit(1)).alias("n")
    )
    return by_word.groupBy("doc_id", "th").agg(
        F.sum("n").alias("n_dropped"),
        F.array_sort(F.collect_list(F.struct("word", F.bitwise_not("gone").alias("bits")))).alias("bitmap"),
    )


def apply_bitmaps(docs: DataFrame, bitmaps: DataFrame, text_col: str = "text") -> DataFrame:
    """``docs`` plus ``__n_lines, __n_dropped, __kept`` (the text of the lines that stay)."""
    b = bitmaps.select(
        F.col("doc_id").alias("__b_id"),
        F.col("th").alias("__b_th"),
        F.col("n_dropped").alias("__b_n"),
        F.map_from_entries("bitmap").alias("__b_map"),
    )
    text = F.coalesce(F.col(text_col), F.lit(""))
    joined = docs.join(
        b, docs["doc_id"].eqNullSafe(b["__b_id"]) & (F.xxhash64(text) == b["__b_th"]), "left"
    )
    stays = lambda line, pos: F.coalesce(
        F.expr("1L").bitwiseAND(F.call_function("shiftrightunsigned", F.element_at("__b_map", F.floor(pos / 64).cast("int")), (pos % 64).cast("int"))) == 1,
        F.lit(True),
    )
    kept = F.when(F.col("__b_n").isNull(), text).otherwise(F.array_join(F.filter(_split(text), stays), "\n"))
    return joined.select(
        *docs.columns,
        F.size(_split(text)).cast("long").alias("__n_lines"),
        F.coalesce("__b_n", F.lit(0)).cast("long").alias("__n_dropped"),
        kept.alias("__kept"),
    )


def dedup_lines(docs: DataFrame, min_chars: int = MIN_CHARS, min_docs: int = MIN_DOCS) -> DataFrame:
    """``docs`` with ``text`` reduced to the lines that stay; all columns and rows remain.
    ``n_chars``, where present, follows the new text; a null text stays null."""
    out = apply_bitmaps(docs, keep_bitmaps(docs, min_chars, min_docs))
    cols = []
    for c in docs.columns:
        if c == "text":
            cols.append(F.when(F.col("text").isNotNull(), F.col("__kept")).alias("text"))
        elif c == "n_chars":
            cols.append(F.when(F.col("__n_dropped") > 0, F.char_length("__kept").cast(docs.schema[c].dataType)).otherwise(F.col(c)).alias(c))
        else:
            cols.append(F.col(c))
    return out.select(*cols)
