"""Stored tables in key-hashed buckets: a load writes the buckets of its keys alone, and readers see whole versions.

A version is a small file that names a folder for each bucket. A load writes new folders first and
the version last, under a temporary name that it renames: a load that dies before that changes
nothing, and of two loads at a time one fails. Old versions can be read until ``vacuum``.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tracewell.operators import merge


class Conflict(RuntimeError):
    """Another load made the version that this one was to make."""


class StoredTable:
    """A table under ``path`` with the given schema (its keys included), dealt to a fixed number of buckets by its keys."""

    def __init__(self, spark: SparkSession, path: str, schema: str, keys: list[str], buckets: int = 64):
        self.spark, self.path, self.schema, self.keys, self.buckets = spark, path.rstrip("/"), schema, keys, buckets

    def _at(self, name: str):
        place = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.path}/{name}")
        return place, place.getFileSystem(self.spark._jsc.hadoopConfiguration())

    def versions(self) -> list[int]:
        place, store = self._at("versions")
        if not store.exists(place):
            return []
        names = [f.getPath().getName() for f in store.listStatus(place)]
        return sorted(int(n.removesuffix(".json")) for n in names if n.endswith(".json") and not n.startswith("."))

    def folders(self, version: int | None = None) -> dict[int, str]:
        """The folder of each bucket that has rows, in the version given or the last one."""
        known = self.versions()
        if not known and version is None:
            return {}
        place, _ = self._at(f"versions/{known[-1] if version is None else version}.json")
        text = "\n".join(r["value"] for r in self.spark.read.text(place.toString()).collect())  # a line; as many names as there are buckets
        return {int(k): v for k, v in json.loads(text).items()}

    def _rows(self, folders: list[str]) -> DataFrame:
        if not folders:
            return self.spark.createDataFrame([], self.schema)
        return self.spark.read.schema(self.schema).parquet(*(f"{self.path}/{f}" for f in folders))

    def read(self, version: int | None = None) -> DataFrame:
        """All rows of a version; later loads don't change what is read."""
        return self._rows(sorted(self.folders(version).values()))

    def bucket(self):
        return F.pmod(F.xxhash64(*(F.col(c).cast("string") for c in self.keys)), F.lit(self.buckets)).cast("int")

    def load(self, scope: DataFrame, merged: Callable[[DataFrame], DataFrame]) -> int:
        """Make a version in which the buckets of the scope's keys hold what ``merged`` makes of their rows. Returns its number.

        merged gets all rows of these buckets, those of other keys too, and must not move a row to another bucket's keys.
        """
        known, now = self.versions(), self.folders()
        touched = sorted(r["b"] for r in scope.select(self.bucket().alias("b")).distinct().collect())  # bucket numbers
        old = self._rows([now[b] for b in touched if b in now])
        folder = f"rows/{uuid.uuid4().hex}"
        rows = merged(old).withColumn("_bucket", self.bucket()).where(F.col("_bucket").isin(touched)) if touched else None
        if rows is not None:
            rows.repartition(max(1, len(touched)), "_bucket").write.partitionBy("_bucket").parquet(f"{self.path}/{folder}")
            place, store = self._at(folder)
            made = {int(f.getPath().getName().removeprefix("_bucket=")): f"{folder}/{f.getPath().getName()}" for f in store.listStatus(place) if f.isDirectory()}
            now = {**{b: f for b, f in now.items() if b not in touched}, **made}
        return self._commit((known[-1] if known else 0) + 1, now)

    def _commit(self, version: int, folders: dict[int, str]) -> int:
        temporary, store = self._at(f"versions/.{uuid.uuid4().hex}")
        out = store.create(temporary, False)
        out.write(bytearray(json.dumps(folders).encode()))
        out.close()
        place, _ = self._at(f"versions/{version}.json")
        if store.exists(place) or not store.rename(temporary, place):
            store.delete(temporary, False)
            raise Conflict(f"version {version} of {self.path} exists")
        return version

    def vacuum(self, keep: int = 1) -> None:
        """Delete all but the last versions and what only they, or loads that died, have written. Not while a load runs."""
        held = self.versions()
        used = {f for v in held[-keep:] for f in self.folders(v).values()}
        for v in held[:-keep]:
            place, store = self._at(f"versions/{v}.json")
            store.delete(place, False)
        place, store = self._at("rows")
        if store.exists(place):
            for load in store.listStatus(place):
                inside = [(b.getPath(), f"rows/{load.getPath().getName()}/{b.getPath().getName()}") for b in store.listStatus(load.getPath())]
                gone = [at for at, name in inside if name not in used and "/_bucket=" in name]
                whole = not any(name in used for _, name in inside)
                for at in [load.getPath()] if whole else gone:
                    store.delete(at, True)

    def upsert_replace(self, new: DataFrame, ordinal: str | None = None) -> int:
        return self.load(new, lambda old: merge.upsert_replace(old, new, self.keys, ordinal))

    def upsert_update(self, new: DataFrame, set_cols: list[str], coalesce_cols: list[str] = ()) -> int:
        return self.load(new, lambda old: merge.upsert_update(old, new, self.keys, set_cols, coalesce_cols))

    def insert_if_absent(self, new: DataFrame) -> int:
        return self.load(new, lambda old: merge.insert_if_absent(old, new, self.keys))

    def replace_scope(self, new: DataFrame, scopes: DataFrame) -> int:
        """New rows outside the scopes are refused: they would be added each time."""
        if not new.join(scopes.select(self.keys), self.keys, "left_anti").isEmpty():
            raise ValueError("a new row is in none of the scopes")
        return self.load(scopes, lambda old: merge.replace_scope(old, new, scopes, self.keys))
