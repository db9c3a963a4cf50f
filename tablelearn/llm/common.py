"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

import sys
import types

from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Text whitespace of the word and line rules: space and U+0009 to U+000D.
ASCII_SPACE = " \t\n\x0b\f\r"
SPACE_CLASS = "[\\x20\\x09-\\x0D]"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def id_bucket(doc_id: Column, buckets: int) -> Column:
    """``crc32(doc_id as text) mod buckets``, the train / held-out rule of the labelled operators."""
    return F.crc32(doc_id.cast("string")) % buckets


def lower_ascii(text: Column) -> Column:
    """Lower-case A-Z only. Pure ASCII text takes the fast ``lower``; the rest is translated."""
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    return F.when(F.octet_length(text) == F.char_length(text), F.lower(text)).otherwise(
        F.translate(text, upper, upper.lower())
    )


def worker_cache(name: str, make):
    """A value kept between the tasks of a Python worker. Library functions travel inside task
    closures, so their module globals are new in every task; this is not. When a value is
    made, those that the running task has not used are dropped, so what earlier operators or
    models left does not add up."""
    state = sys.modules.setdefault("_tablelearn_worker_state", types.ModuleType("_tablelearn_worker_state"))
    held = state.__dict__.setdefault("held", {})
    context = TaskContext.get()
    task = context.taskAttemptId() if context else None
    if name not in held:
        for other in [k for k, (used, _) in held.items() if used != task]:
            del held[other]
        held[name] = (task, make())
    value = held[name][1]
    held[name] = (task, value)
    return value


class WordCache(dict):
    """``word -> compute(word)``, emptied when it reaches ``limit`` entries."""

    def __init__(self, compute, limit: int = 400_000):
        super().__init__()
        self.compute = compute
        self.limit = limit

    def __missing__(self, word):
        if len(self) >= self.limit:
            self.clear()
        value = self[word] = self.compute(word)
        return value
