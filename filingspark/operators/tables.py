"""Tables in the folder that the driver and all executors share."""

from __future__ import annotations

import atexit
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Rows of a slim table that is broadcast at most; larger ones meet others in a shuffle. A number and a row's place take some 60 bytes.
SMALL = 4_000_000

_made: list[tuple[SparkSession, str]] = []


def _shared(df: DataFrame) -> str:
    """The folder, which is set if it isn't yet."""
    context = df.sparkSession.sparkContext
    if not context._jsc.sc().getCheckpointDir().isDefined():
        folder = context.getConf().get("spark.checkpoint.dir")
        if not folder and not context.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        context.setCheckpointDir(folder or tempfile.mkdtemp(prefix="filingspark-"))
    return context._jsc.sc().getCheckpointDir().get()


def settled(df: DataFrame) -> DataFrame:
    """df in a table of its own, so that what follows reads it and never runs it again, whatever executors are lost."""
    _shared(df)
    return df.checkpoint()


def stored(df: DataFrame) -> DataFrame:
    """As settled(), by columns: what follows reads those that it needs. Removed when the driver ends."""
    path = f"{_shared(df)}/stored-{uuid.uuid4().hex}"
    if not _made:
        atexit.register(_clean)
    _made.append((df.sparkSession, path))
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _clean() -> None:
    for spark, path in _made:
        try:
            at = spark._jvm.org.apache.hadoop.fs.Path(path)
            at.getFileSystem(spark._jsc.hadoopConfiguration()).delete(at, True)
        except Exception:  # the session may be gone; the folder's owner cleans up then
            return


def slim(df: DataFrame) -> DataFrame:
    """df, of few and narrow columns, in a table that joins broadcast while it is small, so that wide rows needn't move to meet it."""
    df = settled(df)
    return F.broadcast(df) if df.count() <= SMALL else df
