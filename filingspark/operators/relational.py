"""Joins, nesting, latest rows, funnels, upserts and top picks over disclosure tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .scans import Scan, numbered
from .tables import settled


def latest(df: DataFrame, key: list[str], *order: Column) -> DataFrame:
    """The first row of each key in the given order."""
    return df.withColumn("_n", F.row_number().over(Window.partitionBy(*key).orderBy(*order))).where("_n = 1").drop("_n")


def first_wins(df: DataFrame, key: list[str], ordinal: str) -> DataFrame:
    """Distinct by key, the row that came first."""
    return latest(df, key, F.col(ordinal))


def last_value(df: DataFrame, key: list[str], ordinal: str) -> DataFrame:
    """Distinct by key: the values of the last row, at the place of the first."""
    values = [c for c in df.columns if c not in (*key, ordinal)]
    out = df.groupBy(*key).agg(F.min(ordinal).alias(ordinal), F.max_by(F.struct(*values), ordinal).alias("_v"))
    return out.select(*key, ordinal, *[F.col(f"_v.{c}").alias(c) for c in values])


def upsert(base: DataFrame, batch: DataFrame, key: list[str], ordinal: str = "_batch") -> DataFrame:
    """base with batch's rows in place of those with the same key; of repeated batch rows the last by `ordinal`, or, without
    that column, the one whose values come last in order."""
    if ordinal in batch.columns:
        batch = last_value(batch, key, ordinal).drop(ordinal)
    else:
        values = [c for c in batch.columns if c not in key]
        batch = batch.groupBy(*key).agg(F.max(F.struct(*values)).alias("_v")).select(*key, *[F.col(f"_v.{c}").alias(c) for c in values]) if values else batch.distinct()
    return base.join(batch.select(*key), key, "left_anti").unionByName(batch, allowMissingColumns=True)


def patch(base: DataFrame, changes: DataFrame, key: list[str]) -> DataFrame:
    """base with the changed columns of rows that changes has; null is a legal new value."""
    new = [c for c in changes.columns if c not in key]
    changes = changes.select(*key, *[F.col(c).alias(f"_{c}") for c in new], F.lit(True).alias("_there"))
    rows = base.join(changes, key, "left")
    return rows.select(*[F.when(F.col("_there"), F.col(f"_{c}")).otherwise(F.col(c)).alias(c) if c in new else F.col(c) for c in base.columns])


def append_ids(log: DataFrame, new: DataFrame, id_name: str, *order: Column) -> DataFrame:
    """new with ids that follow the log's largest, without gaps.

    Rows are ranked inside ranges of the order, whose sizes then shift them: no task sees all rows.
    """
    start = log.agg(F.coalesce(F.max(id_name), F.lit(0))).first()[0]
    # The ranges are kept in a table: both uses see the same ones, even if an executor is lost between them.
    rows = settled(new.repartitionByRange(*order).withColumn("_p", F.spark_partition_id()))
    rows = rows.withColumn("_r", F.row_number().over(Window.partitionBy("_p").orderBy(*order)))
    sizes = rows.groupBy("_p").count()
    before = sizes.withColumn("_b", F.coalesce(F.sum("count").over(Window.orderBy("_p").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))).select("_p", "_b")
    return rows.join(F.broadcast(before), "_p").withColumn(id_name, F.col("_r") + F.col("_b") + start).drop("_p", "_r", "_b")


def versioned_left_join(left: DataFrame, right: DataFrame, key: str, **version: str) -> DataFrame:
    """Left join with the right rows of one version only: a stale row gives null, not a lost row."""
    for column, value in version.items():
        right = right.where(F.col(column) == value)
    return left.join(right.drop(*version), key, "left")


def either(df: DataFrame, condition: Column, key: str, wanted: DataFrame) -> DataFrame:
    """Rows where the condition holds or whose key is wanted, each once."""
    flags = wanted.select(key).distinct().withColumn("_w", F.lit(True))
    return df.join(flags, key, "left").where(F.coalesce(condition, F.lit(False)) | F.coalesce("_w", F.lit(False))).drop("_w")


def lanes(rows: DataFrame, key: list[str], at: str, tie: str, newest: int = 6, oldest: int = 10) -> DataFrame:
    """place: the newest few, then some of the oldest, oldest first, then the rest, newest first."""
    down = F.row_number().over(Window.partitionBy(*key).orderBy(F.col(at).desc(), F.col(tie)))
    rows = rows.withColumn("_d", down).withColumn("_n", F.count(F.lit(1)).over(Window.partitionBy(*key)))
    up = F.col("_n") - F.col("_d") + 1
    back = F.least(F.lit(oldest), F.greatest(F.col("_n") - newest, F.lit(0)))
    place = F.when(F.col("_d") <= newest, F.col("_d")).when(up <= back, newest + up).otherwise(F.col("_d") + back)
    return rows.withColumn("place", place.cast("int")).drop("_d", "_n")


def top_two(scores: DataFrame, key: list[str], score: str, item: str, least: float = 0.20, margin: float = 0.08) -> DataFrame:
    """The best item of each key from `least` up, and the second if it is that good and within the margin; ties by item, descending."""
    order = Window.partitionBy(*key).orderBy(F.col(score).desc(), F.col(item).desc())
    rows = scores.withColumn("rank", F.row_number().over(order)).where("rank <= 2").withColumn("_best", F.max(score).over(Window.partitionBy(*key)))
    second = F.col(score) >= F.greatest(F.lit(least), F.col("_best") - margin)
    return rows.where((F.col("_best") >= least) & ((F.col("rank") == 1) | second)).drop("_best")


def running_cap(rows: DataFrame, key: list[str], order: list[str], amount: str, cap: int) -> DataFrame:
    """status of each row against a budget: done until the first row that would exceed it, that one over, all later deferred."""
    scan = Scan(rows, key, order).running("_sum", F.col(amount)).settle().running("_over", (F.col("_sum") > cap).cast("int"))
    return scan.done().withColumn("status", F.when(F.col("_over") == 0, "done").when(F.col("_over") == 1, "over").otherwise("deferred")).drop("_sum", "_over")


def breaker(rows: DataFrame, key: list[str], order: list[str], failed: Column) -> DataFrame:
    """status: done before the first failure, failed at it, deferred after."""
    rows = Scan(rows, key, order).running("_f", failed.cast("int")).done()
    return rows.withColumn("status", F.when(F.col("_f") == 0, "done").when(failed & (F.col("_f") == 1), "failed").otherwise("deferred")).drop("_f")


def round_robin(rows: DataFrame, key: str, order: list[str]) -> DataFrame:
    """turn: each key's first row, then each key's second, and so on."""
    rows = numbered(rows, [key], order, "turn")
    return rows.withColumn("turn", F.col("turn").cast("int"))


def weighted_order(rows: DataFrame, stage: str, weights: dict[str, int], order: list[str]) -> DataFrame:
    """place: stages take turns by weight, in the order of weights, each with its own rows in order; a stage that has run out is passed over."""
    turn = F.row_number().over(Window.partitionBy(stage).orderBy(*order)) - 1
    cycle, offset = sum(weights.values()), 0
    place = F.lit(None).cast("bigint")
    for name, weight in weights.items():
        place = F.when(F.col(stage) == name, F.floor(turn / weight) * cycle + offset + turn % weight).otherwise(place)
        offset += weight
    return rows.withColumn("place", place.cast("bigint"))
