"""Gates that rows, runs and settings pass or not: allow-lists, isolation, policy, health, checkpoint checks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

#: Fixed value: a checkpoint's ids at most.
SEEN = 1000
#: What the daily policy refuses, first one first.
POLICY = (
    "transport isn't http",
    "historical backfill isn't allowed",
    "fan-out by ticker isn't allowed",
    "request delay is under half a second",
)


def listed(rows: DataFrame, ticker: str, master: DataFrame | None) -> DataFrame:
    """Rows whose ticker is blank or in master (ticker); without a master, or with an empty one, all rows."""
    if master is None or not master.limit(1).count():
        return rows
    known = master.select(F.upper(F.trim("ticker")).alias("_t")).distinct()
    own = F.upper(F.trim(F.coalesce(F.col(ticker), F.lit(""))))
    found = rows.withColumn("_own", own).join(known.withColumn("_in", F.lit(True)), F.col("_own") == F.col("_t"), "left")
    return found.where((F.col("_own") == "") | F.col("_in")).drop("_own", "_t", "_in")


def foreign_tickers(records: DataFrame, group: str, ticker: str) -> DataFrame:
    """(group, foreign): groups, named by their ticker, whose records name other tickers; blank ones are of any."""
    own, named = F.upper(F.trim(group)), F.upper(F.trim(F.coalesce(F.col(ticker), F.lit(""))))
    return records.where((named != "") & (named != own)).groupBy(group).agg(F.array_sort(F.collect_set(named)).alias("foreign"))


def isolated(records: DataFrame, group: str, ticker: str) -> DataFrame:
    """records; an error if a group's records name another ticker."""
    named = F.upper(F.trim(F.coalesce(F.col(ticker), F.lit(""))))
    bad = (named != "") & (named != F.upper(F.trim(group)))
    return records.withColumn(ticker, F.when(bad, F.raise_error(F.concat(F.lit("company isolation violation for "), F.col(group), F.lit(": "), named)).cast("string")).otherwise(F.col(ticker)))


def policy_problem(transport: Column, backfill: Column, fanout: Column, delay: Column) -> Column:
    """Why settings break the daily policy, the first reason, or null."""
    tests = (F.lower(F.trim(transport)) != "http", backfill, fanout, delay < 0.5)
    out = F.lit(None).cast("string")
    for test, why in reversed(list(zip(tests, POLICY, strict=True))):
        out = F.when(F.coalesce(test, F.lit(True)), why).otherwise(out)
    return out


def healthy(latest_status: Column, processing_ok: Column, checkpoint: Column) -> Column:
    """Whether a source is well: its last run wasn't failed or blocked, processing isn't known to be bad, and there is a checkpoint."""
    return ~F.coalesce(latest_status.isin("FAILED", "BLOCKED"), F.lit(False)) & F.coalesce(processing_ok, F.lit(True)) & checkpoint.isNotNull()


def checkpoint_problem(schema: Column, ids: Column, latest: Column, expected: str) -> Column:
    """Why a stored checkpoint can't be used, or null; one that isn't there (all null) is an empty one."""
    absent = schema.isNull() & ids.isNull() & latest.isNull()
    own = F.coalesce(ids, F.array().cast("array<string>"))
    return F.when(absent, None).when(~schema.eqNullSafe(F.lit(expected)), "schema").when(F.size(own) > SEEN, "seenIds").when(F.exists(own, lambda x: F.coalesce(x, F.lit("")) == ""), "id")


def limited(rows: DataFrame, n: int, *order: Column) -> DataFrame:
    """The first n rows of an order, at least one."""
    return rows.orderBy(*order).limit(max(1, n))


def prefix(rows: DataFrame, key: str, ordinal: str, n: int | None) -> DataFrame:
    """The first n rows of each key as the source gave them; all if there is no cap."""
    return rows if n is None else rows.withColumn("_n", F.row_number().over(Window.partitionBy(key).orderBy(ordinal))).where(F.col("_n") <= n).drop("_n")


def newest_first(rows: DataFrame, key: str, at: str, tie: str) -> DataFrame:
    """place: each key's rows by their raw text timestamp, newest first; a missing one is last."""
    return rows.withColumn("place", F.row_number().over(Window.partitionBy(key).orderBy(F.coalesce(F.col(at), F.lit("")).desc(), tie)))


def attachment_order(rows: DataFrame, group: str) -> DataFrame:
    """place: a group's attachments, main documents first, then by file name and url."""
    return rows.withColumn("place", F.row_number().over(Window.partitionBy(group).orderBy(F.col("is_attachment").cast("int"), "filename", "url")))
