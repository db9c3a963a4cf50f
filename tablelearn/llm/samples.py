"""Bounded training samples of labelled documents."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tablelearn.session import materialize


def labelled_sample(
    docs: DataFrame, labels: DataFrame, label: str, eligible: Column, per_class: int
) -> tuple[DataFrame, dict]:
    """About ``per_class`` documents of each class, chosen by a hash of ``doc_id``, written once:
    ``doc_id, text, label``; and the number of eligible labelled rows of each class.

    ``labels`` has ``doc_id`` and ``label``; null labels and ids are left out, and of several
    labels of one document the largest counts. The sample holds whole texts and stays on the
    cluster; only the class counts come to the driver."""
    marked = labels.filter(F.col("doc_id").isNotNull() & F.col(label).isNotNull() & eligible)
    marked = marked.groupBy("doc_id").agg(F.max(label).alias("label"))
    totals = {r["label"]: r["count"] for r in marked.groupBy("label").count().collect()}
    share = F.lit(0.0)
    for value, n in totals.items():
        share = F.when(F.col("label") == F.lit(value), F.lit(min(1.0, per_class / n))).otherwise(share)
    u = F.xxhash64(F.lit(11), F.col("doc_id")).bitwiseAND((1 << 40) - 1) / F.lit(float(1 << 40))
    chosen = marked.filter(u < share)
    # About per_class rows of two values for each class: small by construction.
    joined = docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id")
    return materialize(joined, "labelled-sample"), totals
