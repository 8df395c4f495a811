"""Sinks: JSON lines by company, share bundles, append-only logs, batches."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .audit import share_blocks, share_header


def export_companies(rows: DataFrame, path: str, key: str = "ticker") -> None:
    """JSON lines in a folder for each company; nulls are written."""
    rows.write.mode("overwrite").option("ignoreNullFields", "false").partitionBy(key).json(path)


def export_share(companies: DataFrame, path: str, start: str, end: str, sections: list[str]) -> None:
    """A bundle as text files whose names keep the order: its header, then one Markdown block a company by ticker."""
    blocks = share_blocks(companies, sections)
    head = blocks.agg(share_header(start, end, F.count(F.lit(1))).alias("block")).select(F.lit("").alias("ticker"), "block")
    head.unionByName(blocks).orderBy("ticker").select("block").write.mode("overwrite").option("lineSep", "\n").text(path)


def append_log(rows: DataFrame, path: str) -> None:
    rows.write.mode("append").parquet(path)


def batches(rows: DataFrame, key: list[str], order: list[str], size: int) -> DataFrame:
    """batch: the number of the group of `size` rows that a row is in, within its key."""
    n = F.row_number().over(Window.partitionBy(*key).orderBy(*order))
    return rows.withColumn("batch", F.floor((n - 1) / size).cast("int"))


def migrate(old: DataFrame, schema: str) -> DataFrame:
    """old with the schema's missing columns as nulls."""
    empty = old.sparkSession.createDataFrame([], schema)
    return empty.unionByName(old, allowMissingColumns=True)
