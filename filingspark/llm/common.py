"""Shared pieces of the training-data operators: work tables in the cluster's
shared folder, bounded broadcasts with a way beyond the bound, Arrow buffers."""

from __future__ import annotations

import atexit
import pickle
import tempfile
import uuid

import numpy as np
import pyarrow as pa
from pyspark import Broadcast, cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Rows up to which a slim table (a key of at most 40 bytes and a few numbers) may be broadcast.
BROADCAST_ROWS = 100_000
#: Rows and bytes of an Arrow batch at most: what a Python worker holds at once.
BATCH = {"spark.sql.execution.arrow.maxRecordsPerBatch": 1000, "spark.sql.execution.arrow.maxBytesPerBatch": 8 << 20}
#: A key is hot when it has more than this share of all rows; there are at most HOT_SHARE such keys.
HOT_SHARE = 1_000

_made: list[tuple[SparkSession, str]] = []


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors share: spark.checkpoint.dir, or a folder of our own where that is unset in local mode."""
    found = spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if found:
        return found.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    found = tempfile.mkdtemp(prefix="filingspark-")
    spark.sparkContext._conf.set("spark.checkpoint.dir", found)
    return found


def small_batches(spark: SparkSession) -> None:
    """Lower the session's Arrow batch sizes to BATCH, so that workers stay small with long texts."""
    for name, most in BATCH.items():
        now = int(spark.conf.get(name).rstrip("bB"))
        if not 0 < now <= most:
            spark.conf.set(name, str(most))


def work_path(spark: SparkSession, label: str) -> str:
    """A new path under the shared folder; removed when the driver ends."""
    path = f"{shared_dir(spark)}/work-{spark.sparkContext.applicationId}/{label}-{uuid.uuid4().hex}"
    if not _made:
        atexit.register(clean)
    _made.append((spark, path))
    return path


def tables() -> int:
    """How many work tables there are; those made later can be removed from there on."""
    return len(_made)


def clean(first: int = 0, last: int | None = None) -> None:
    """Remove the work tables of this driver, or those from the first to before the last, once nothing reads them any more."""
    gone = _made[first:last]
    del _made[first:last]
    for spark, path in reversed(gone):
        try:
            hadoop = spark._jvm.org.apache.hadoop.fs.Path(path)
            hadoop.getFileSystem(spark._jsc.hadoopConfiguration()).delete(hadoop, True)
        except Exception:  # the session may be gone; the folder's owner cleans up then
            return


def cut(df: DataFrame, label: str) -> DataFrame:
    """Write df as a table in the shared folder and read it back, so that what follows survives lost executors."""
    path = work_path(df.sparkSession, label)
    small_batches(df.sparkSession)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def attach_groups(rows: DataFrame, groups: DataFrame, key: str, how: str = "inner", limit: int = BROADCAST_ROWS) -> DataFrame:
    """Join rows with groups, which has one row per key and its number of rows as n_rows.

    Groups of at most `limit` rows are broadcast. Beyond that only hot groups are (at most
    HOT_SHARE of them have over 1/HOT_SHARE of the rows), and the others meet in a shuffle join,
    in which no key has more than that share. Keys are not null.
    """
    if groups.count() <= limit:
        return rows.join(F.broadcast(groups), key, how)
    total = groups.agg(F.sum("n_rows")).first()[0]
    hot = F.broadcast(groups.where(F.col("n_rows") * HOT_SHARE > F.lit(total)))
    cold = groups.where(F.col("n_rows") * HOT_SHARE <= F.lit(total))
    return rows.join(hot, key, "inner").unionByName(rows.join(hot.select(key), key, "left_anti").join(cold, key, how))


def without(docs: DataFrame, key: dict[str, Column], dropped: DataFrame, repeated: DataFrame) -> DataFrame:
    """The rows of docs, all columns kept, whose key isn't in dropped; of each key in repeated, one row.

    key: columns that tell rows apart, by the names that they have in dropped and repeated. Nulls are equal.
    """
    same = lambda other: F.expr(" and ".join(f"k.{c} <=> {other}.{c}" for c in key))
    small = lambda d: F.broadcast(d) if d.count() <= BROADCAST_ROWS else d
    rows = docs.select(F.struct("*").alias("row"), F.struct(*[c.alias(n) for n, c in key.items()]).alias("k"))
    rows = rows.join(small(dropped).alias("d"), same("d"), "left_anti")
    if repeated.limit(1).count():
        some = small(repeated).alias("r")
        rows = rows.join(some, same("r"), "left_anti").unionByName(rows.join(some, same("r"), "left_semi").dropDuplicates(["k"]))
    return rows.select("row.*")


def own_columns(df: DataFrame, **columns: Column) -> DataFrame:
    """Only the named columns, so that extra columns of the input can't clash with ours."""
    return df.select(*[c.alias(name) for name, c in columns.items()])


def utf8(arr: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Offsets and bytes of a string or binary array, nulls as empty; no copy of the text."""
    if isinstance(arr, pa.ChunkedArray):
        arr = arr.combine_chunks()
    if arr.null_count:
        arr = arr.fill_null(b"" if pa.types.is_binary(arr.type) or pa.types.is_large_binary(arr.type) else "")
    wide = pa.types.is_large_string(arr.type) or pa.types.is_large_binary(arr.type)
    _, offsets, data = arr.buffers()
    ends = np.frombuffer(offsets, np.int64 if wide else np.int32)[arr.offset : arr.offset + len(arr) + 1]
    return ends, np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)


def texts(arr: pa.Array) -> list[bytes]:
    """The UTF-8 bytes of each text, nulls as empty."""
    ends, data = utf8(arr)
    raw = memoryview(data)
    return [bytes(raw[a:b]) for a, b in zip(ends[:-1].tolist(), ends[1:].tolist(), strict=True)]


def hash_mod(doc_id: str, modulus: int) -> Column:
    """crc32 of the id as text, modulo; null ids count as the empty text."""
    return F.crc32(F.coalesce(F.col(doc_id).cast("string"), F.lit("")).cast("binary")) % modulus


def ship(spark: SparkSession, value: object) -> Broadcast:
    """Broadcast an object of our own classes by value; the executors need no copy of this package."""
    small_batches(spark)
    return spark.sparkContext.broadcast(cloudpickle.dumps(value))


def shipped(value: Broadcast) -> object:
    return pickle.loads(value.value)
