"""Versions of a model on storage that all executors share.

A version is written in two steps. Its tables go to a folder of their own that nobody reads
yet; then a manifest, a small file in ``manifests/``, names the folder and says how many rows
each table has. The manifest is written last and its name holds the version's number, so the
newest complete version is the one with the greatest manifest, a save that was torn at any
point has none (or an unfinished one) and is not seen, and a reader never meets a
half-written version. Nothing is overwritten or deleted.

Tables that grow with training, like the history, are appended to: every version holds its
own rows only, and ``table`` reads those of all versions, also while training goes on.
"""

from __future__ import annotations

import json
import uuid

from pyspark.sql import DataFrame, SparkSession


class ModelStore:
    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")

    def _files(self, path: str):
        path = self.spark._jvm.org.apache.hadoop.fs.Path(path)
        return path.getFileSystem(self.spark._jsc.hadoopConfiguration()), path

    def _names(self) -> list[str]:
        files, path = self._files(f"{self.root}/manifests")
        return sorted(s.getPath().getName() for s in files.listStatus(path)) if files.exists(path) else []

    def _read(self, name: str) -> dict | None:
        """A manifest, or None if it is not whole."""
        text = "\n".join(r[0] for r in self.spark.read.text(f"{self.root}/manifests/{name}", wholetext=True).collect())
        try:
            found = json.loads(text)
        except ValueError:
            return None
        return found if found.get("whole") else None

    def versions(self) -> list[dict]:
        """Manifests of the complete versions, oldest first."""
        found = [self._read(n) for n in self._names()]
        return [m for m in found if m]

    def newest(self) -> dict | None:
        for name in reversed(self._names()):
            if found := self._read(name):
                return found
        return None

    def stage(self, tables: dict[str, DataFrame]) -> dict:
        """Write a version's tables to a new folder; not visible before ``commit``."""
        folder = f"version-{uuid.uuid4().hex}"
        rows = {}
        for name, df in tables.items():
            df.write.parquet(f"{self.root}/{folder}/{name}")
            rows[name] = self.spark.read.parquet(f"{self.root}/{folder}/{name}").count()
        return {"folder": folder, "rows": rows}

    def commit(self, staged: dict, number: int, **facts) -> dict:
        """Make a staged version the one with ``number``."""
        manifest = {**facts, **staged, "number": number, "whole": True}
        files, path = self._files(f"{self.root}/manifests/{number:010d}-{staged['folder']}.json")
        out = files.create(path, False)
        out.write(bytearray(json.dumps(manifest).encode()))
        out.close()
        return manifest

    def save(self, tables: dict[str, DataFrame], number: int | None = None, **facts) -> dict:
        if number is None:
            newest = self.newest()
            number = newest["number"] + 1 if newest else 0
        return self.commit(self.stage(tables), number, **facts)

    def read(self, manifest: dict, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.root}/{manifest['folder']}/{name}")

    def table(self, name: str) -> DataFrame | None:
        """The rows of a table in all complete versions."""
        paths = [f"{self.root}/{m['folder']}/{name}" for m in self.versions() if name in m["rows"]]
        return self.spark.read.parquet(*paths) if paths else None
