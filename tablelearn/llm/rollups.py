"""Token totals kept up to date by signed deltas.

A batch is a table of events, ``op, doc_id, source, lang, tokenizer, tokens`` and, for a
revision, the old values ``old_source, old_lang, old_tokenizer, old_tokens``:

* ``insert`` adds a document and its tokens to its group,
* ``delete`` subtracts them,
* ``revise`` subtracts the old values from the old group and adds the new ones to the new.

A group is (source, language, tokenizer version). ``commit`` turns a batch into one signed
delta per group (aggregated map-side, so a hot source costs nothing) and writes it under the
batch's name. A batch that is already complete is not written again, so a repeated commit has
no effect; a batch that was left unfinished has no success mark, is not read and is
replaced. ``totals`` adds up all complete batches, in any order. ``compact`` writes their
sum as one new base and names the batches it holds, so reading stays cheap.

Edge cases: null source, language or tokenizer form groups of their own; null token counts
count as 0 tokens of one document; unknown ops raise; a group whose documents and tokens are
both 0 is not reported; an empty batch commits and changes nothing. Extra columns are ignored.
"""

from __future__ import annotations

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tablelearn.llm.tokens import VOCABULARY_FILE, token_bytes, vocabulary_path
from tablelearn.session import materialize, scratch_path

GROUP = ["source", "lang", "tokenizer"]
DELTA = "source string, lang string, tokenizer string, documents long, tokens long"


def signed(events: DataFrame) -> DataFrame:
    """Events as signed rows ``source, lang, tokenizer, documents, tokens``."""
    row = lambda sign, prefix="": F.struct(
        *[F.col(prefix + c).cast("string").alias(c) for c in GROUP],
        F.lit(sign).cast("long").alias("documents"),
        (F.lit(sign) * F.coalesce(F.col(prefix + "tokens"), F.lit(0))).cast("long").alias("tokens"),
    )
    parts = (
        F.when(F.col("op") == "insert", F.array(row(1)))
        .when(F.col("op") == "delete", F.array(row(-1)))
        .when(F.col("op") == "revise", F.array(row(-1, "old_"), row(1)))
        .otherwise(F.raise_error(F.concat(F.lit("unknown op "), F.coalesce("op", F.lit("null")))))
    )
    return events.select(F.explode(parts).alias("r")).select("r.*")


class Rollup:
    """A folder of committed deltas on storage that all executors share."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")

    def _path(self, name: str):
        return self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.root}/{name}")

    def _exists(self, name: str) -> bool:
        path = self._path(name)
        return path.getFileSystem(self.spark._jsc.hadoopConfiguration()).exists(path)

    def _names(self, kind: str) -> list[str]:
        """Complete folders of a kind, in order of their names."""
        root = self._path("")
        files = root.getFileSystem(self.spark._jsc.hadoopConfiguration())
        names = [s.getPath().getName() for s in files.listStatus(root)] if files.exists(root) else []
        return sorted(n for n in names if n.startswith(kind + "=") and self._exists(f"{n}/_SUCCESS"))

    def commit(self, batch: str, events: DataFrame) -> bool:
        """Write a batch's delta once; False if it is already there."""
        if not batch or "/" in batch:
            raise ValueError(f"not a batch name: {batch!r}")
        if self._exists(f"batch={batch}/_SUCCESS"):
            return False
        delta = signed(events).groupBy(*GROUP).agg(F.sum("documents").alias("documents"), F.sum("tokens").alias("tokens"))
        delta.write.mode("overwrite").parquet(f"{self.root}/batch={batch}")
        return True

    def _live(self) -> tuple[list[str], set[str]]:
        """Folders to add up, and the batches they hold."""
        bases, batches = self._names("base"), self._names("batch")
        held: set[str] = set()
        if bases:
            held = {r[0] for r in self.spark.read.parquet(f"{self.root}/{bases[-1]}/batches").collect()}
        rest = [b for b in batches if b not in held]
        return ([f"{bases[-1]}/delta"] if bases else []) + rest, held | set(batches)

    def totals(self) -> DataFrame:
        """``source, lang, tokenizer, documents, tokens`` of the groups that are not empty."""
        folders, _ = self._live()
        rows = self.spark.createDataFrame([], DELTA)
        if folders:
            rows = self.spark.read.schema(DELTA).parquet(*[f"{self.root}/{n}" for n in folders])
        sums = rows.groupBy(*GROUP).agg(F.sum("documents").alias("documents"), F.sum("tokens").alias("tokens"))
        return sums.filter("documents <> 0 or tokens <> 0")

    def compact(self) -> None:
        """Write the sum of all complete batches as a new base; old folders are left to the
        storage's own clean-up."""
        _, held = self._live()
        name = f"base={len(self._names('base')):08d}"
        self.totals().write.mode("overwrite").parquet(f"{self.root}/{name}/delta")
        self.spark.createDataFrame([(h,) for h in sorted(held)], "batch string").write.mode("overwrite").parquet(f"{self.root}/{name}/batches")
        path = self._path(f"{name}/_SUCCESS")
        path.getFileSystem(self.spark._jsc.hadoopConfiguration()).create(path, True).close()


def count_tokens(docs: DataFrame, path: str | None = None) -> DataFrame:
    """``doc_id, source, lang, text_hash, tokens`` of every row, over the whole text."""
    path = path or vocabulary_path()

    def run(frames):
        for frame in frames:
            for k in range(0, len(frame), 500):
                part = frame.iloc[k : k + 500]
                counts = [len(ids) // 4 for ids in token_bytes(list(part["text"]), path)]
                yield pd.DataFrame({"doc_id": part["doc_id"], "source": part["source"], "lang": part["lang"], "text_hash": part["text_hash"], "tokens": counts}).astype({"doc_id": "Int64"})

    rows = docs.select(F.col("doc_id").cast("long"), "source", "lang", F.md5(F.coalesce("text", F.lit(""))).alias("text_hash"), "text")
    return rows.mapInPandas(run, "doc_id long, source string, lang string, text_hash string, tokens long")


def corpus_rollup(docs: DataFrame, root: str | None = None) -> DataFrame:
    """Totals of a corpus after three batches: ``load`` inserts every document,
    ``end-of-text`` revises every count to the next tokenizer version (the same vocabulary
    and one end id per document), ``copies`` deletes all but the smallest ``doc_id`` of every
    exactly equal text. The first batch is committed twice, as a retry would."""
    spark = docs.sparkSession
    name = VOCABULARY_FILE.rpartition(".")[0]
    old, new = f"{name}/1", f"{name}/2"
    counted = materialize(count_tokens(docs), "token-counts")
    load = counted.select(F.lit("insert").alias("op"), "source", "lang", F.lit(old).alias("tokenizer"), "tokens", *[F.lit(None).cast("string").alias(f"old_{c}") for c in GROUP], F.lit(None).cast("long").alias("old_tokens"))
    revise = counted.select(
        F.lit("revise").alias("op"), "source", "lang", F.lit(new).alias("tokenizer"), (F.col("tokens") + 1).alias("tokens"),
        F.col("source").alias("old_source"), F.col("lang").alias("old_lang"), F.lit(old).alias("old_tokenizer"), F.col("tokens").alias("old_tokens"),
    )
    first = materialize(counted.groupBy("text_hash").agg(F.min("doc_id").alias("first_id"), F.count(F.lit(1)).alias("n")).filter("n > 1"), "copies")
    copies = counted.join(first, "text_hash").filter("doc_id <> first_id")
    copies = copies.select(F.lit("delete").alias("op"), "source", "lang", F.lit(new).alias("tokenizer"), (F.col("tokens") + 1).alias("tokens"), *[F.lit(None).cast("string").alias(f"old_{c}") for c in GROUP], F.lit(None).cast("long").alias("old_tokens"))
    rollup = Rollup(spark, root or scratch_path(spark, "token-rollup"))
    for batch, events in (("load", load), ("end-of-text", revise), ("load", load), ("copies", copies)):
        rollup.commit(batch, events)
    rollup.compact()
    return rollup.totals()
