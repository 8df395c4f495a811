"""Streams: idempotent re-reads, guarded coverage commits, event tails."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery


def read_events(spark: SparkSession, path: str, schema: str) -> DataFrame:
    return spark.readStream.schema(schema).parquet(path)


def dedupe_stream(events: DataFrame, key: str, at: str, overlap: str = "6 hours") -> DataFrame:
    """Each key once, though sources read overlapping windows again; state is dropped after the overlap."""
    return events.withColumn(at, F.col(at).cast("timestamp")).withWatermark(at, overlap).dropDuplicatesWithinWatermark([key])


def windowed_counts(events: DataFrame, at: str, key: str, width: str = "1 hour", late: str = "10 minutes") -> DataFrame:
    """(key, start, n) by event time; rows later than `late` are left out."""
    rows = events.withColumn(at, F.col(at).cast("timestamp")).withWatermark(at, late)
    return rows.groupBy(F.window(at, width), key).agg(F.count(F.lit(1)).alias("n")).select(key, F.col("window.start").alias("start"), "n")


def commit_batches(stream: DataFrame, target: str, checkpoint: str, whole: Callable[[DataFrame], bool] | None = None) -> StreamingQuery:
    """Write each whole batch to a folder named by its number, so that a repeated batch replaces itself; others commit nothing."""

    def commit(batch: DataFrame, number: int) -> None:
        if whole is None or whole(batch):
            batch.write.mode("overwrite").parquet(f"{target}/batch={number}")
        else:
            batch.write.format("noop").mode("overwrite").save()  # the stream's own state still moves on

    return stream.writeStream.foreachBatch(commit).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def tail(events: DataFrame, cursor: int, seq: str = "seq") -> DataFrame:
    """Events after a cursor."""
    return events.where(F.col(seq) > cursor)


def shared_folder(spark: SparkSession, name: str) -> str:
    """A new folder below the one that the driver and all executors share."""
    context = spark.sparkContext
    folder = context.getConf().get("spark.checkpoint.dir")
    if not folder and not context.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    return f"{(folder or tempfile.mkdtemp(prefix='filingspark-')).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def run_to_table(stream: DataFrame, name: str) -> DataFrame:
    """Run a stream over what is there into files of the shared folder, with its state beside them, and read them back."""
    folder = shared_folder(stream.sparkSession, name)
    query = stream.writeStream.format("parquet").option("path", f"{folder}/rows").option("checkpointLocation", f"{folder}/state").outputMode("append").trigger(availableNow=True).start()
    query.awaitTermination()
    return stream.sparkSession.read.schema(stream.schema).parquet(f"{folder}/rows")
