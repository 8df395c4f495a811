"""Keyed rows in parquet that are written in place: a write reads and rewrites only the buckets of its rows.

Rows lie in buckets by a hash of their key. A write puts the new content of the buckets that it touches in a folder
of its own; a small table, written last, then says in which folder each bucket lies. A write that dies before that
leaves what was there, and files of other buckets are neither read nor moved. Readers keep the state that they began
with. One writer at a time: a write that finds another's state in place of the one it began with is an error.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import relational
from .tables import settled


class Store:
    """A store below a folder: key columns, a schema as DDL, and into how many buckets its rows are dealt; all as it was made with."""

    def __init__(self, spark: SparkSession, path: str, key: list[str], schema: str, buckets: int = 64):
        self.spark, self.path, self.key, self.buckets = spark, path.rstrip("/"), key, buckets
        self.schema = T.StructType.fromDDL(schema)

    def _files(self, path: str):
        path = self.spark._jvm.org.apache.hadoop.fs.Path(path)
        return path.getFileSystem(self.spark._jsc.hadoopConfiguration()), path

    def _names(self, folder: str) -> list[str]:
        files, path = self._files(f"{self.path}/{folder}")
        return sorted(s.getPath().getName() for s in files.listStatus(path)) if files.exists(path) else []

    def version(self) -> int:
        """The number of the last write that was finished; 0 before the first."""
        done = (n for n in reversed(self._names("writes")) if self._exists(f"writes/{n}/_SUCCESS"))
        return int(next(done, "0"))

    def _exists(self, name: str) -> bool:
        files, path = self._files(f"{self.path}/{name}")
        return files.exists(path)

    def folders(self, version: int | None = None) -> dict[int, str]:
        """The folder of each bucket that has rows."""
        version = self.version() if version is None else version
        if not version:
            return {}
        return {r.bucket: r.folder for r in self.spark.read.schema("bucket int, folder string").parquet(f"{self.path}/writes/{version:012d}").collect()}

    def read(self, buckets: list[int] | None = None, version: int | None = None) -> DataFrame:
        """All rows, or those of some buckets."""
        folders = self.folders(version)
        paths = [f"{self.path}/{f}/bucket={b}" for b, f in sorted(folders.items()) if buckets is None or b in buckets]
        return self.spark.read.schema(self.schema).parquet(*paths) if paths else self.spark.createDataFrame([], self.schema)

    def _dealt(self, rows: DataFrame) -> DataFrame:
        """rows with the key columns as the store has them, and their bucket."""
        rows = rows.select(*[F.col(f.name).cast(f.dataType).alias(f.name) if f.name in self.key else F.col(f.name) for f in self.schema if f.name in rows.columns], *[c for c in rows.columns if c not in self.schema.names])
        return rows.withColumn("bucket", F.pmod(F.xxhash64(*self.key), F.lit(self.buckets)).cast("int"))

    def rewrite(self, batch: DataFrame, change: Callable[[DataFrame, DataFrame], DataFrame]) -> list[int]:
        """Put change(rows there, batch) in place of the rows of the batch's buckets; returns those buckets.

        change must keep to keys of these buckets. Keys aren't null.
        """
        began = self.version()
        folders = self.folders(began)
        batch = settled(self._dealt(batch))
        touched = sorted(r.bucket for r in batch.select("bucket").distinct().collect())  # as many as there are buckets, at most
        if not touched:
            return []
        after = change(self.read(touched, began), batch.drop("bucket"))
        after = self._dealt(after.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in self.schema]))
        folder = f"rows/{uuid.uuid4().hex}"
        # Buckets are put together or split by their size, so that one task writes neither many small files nor a whole large bucket.
        after.hint("rebalance", "bucket").write.partitionBy("bucket").parquet(f"{self.path}/{folder}")
        there = {int(n.split("=")[1]) for n in self._names(folder) if n.startswith("bucket=")}
        state = {b: f for b, f in folders.items() if b not in touched} | dict.fromkeys(there, folder)
        if self.version() != began:
            raise RuntimeError(f"another write to {self.path} was finished meanwhile")
        self._commit(state)
        return touched

    def _commit(self, state: dict[int, str]) -> None:
        number = 1 + max(map(int, self._names("writes")), default=0)  # also past writes that died
        self.spark.createDataFrame(sorted(state.items()), "bucket int, folder string").coalesce(1).write.parquet(f"{self.path}/writes/{number:012d}")

    def matching(self, keys: DataFrame) -> DataFrame:
        """The rows of the buckets in which keys lie: all rows of those keys, and some others."""
        return self.read(sorted(r.bucket for r in self._dealt(keys).select("bucket").distinct().collect()))

    def upsert(self, batch: DataFrame, ordinal: str = "_batch") -> list[int]:
        """Rows of the batch in place of those with their key; of repeated ones the last by `ordinal`. Columns that the batch lacks become null."""
        return self.rewrite(batch, lambda rows, new: relational.upsert(rows, new, self.key, ordinal))

    def patch(self, changes: DataFrame) -> list[int]:
        """The changed columns of rows that are there; null is a legal new value."""
        return self.rewrite(changes, lambda rows, new: relational.patch(rows, new, self.key))

    def delete(self, keys: DataFrame) -> list[int]:
        return self.rewrite(keys.select(*self.key), lambda rows, gone: rows.join(gone.distinct(), self.key, "left_anti"))

    def replace(self, keys: DataFrame, rows: DataFrame) -> list[int]:
        """All rows of the keys (a scope's ranges, say) by those that rows has for them; a key may have several rows, or none from now on."""
        new = rows.join(keys.select(*self.key).distinct(), self.key, "left_semi").withColumn("_new", F.lit(True))
        both = new.unionByName(keys.select(*self.key).distinct(), allowMissingColumns=True)
        return self.rewrite(both, lambda old, b: old.join(b.select(*self.key).distinct(), self.key, "left_anti").unionByName(b.where("_new").select(*old.columns)))

    def vacuum(self, keep: int = 1) -> int:
        """Remove what none of the last `keep` finished writes needs; returns how many folders went."""
        numbers = self._names("writes")
        kept = [n for n in numbers if self._exists(f"writes/{n}/_SUCCESS")][-keep:]
        needed = {f for n in kept for f in self.folders(int(n)).values()}
        gone = [f"rows/{n}" for n in self._names("rows") if f"rows/{n}" not in needed] + [f"writes/{n}" for n in numbers if n not in kept]
        for name in gone:
            files, path = self._files(f"{self.path}/{name}")
            files.delete(path, True)
        return len(gone)
