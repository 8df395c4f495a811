"""Time windows and coverage arithmetic: closed intervals that merge, subtract and contain."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .scans import Scan

#: The zone that boundaries without one are read in.
ZONE = "Asia/Jakarta"


def in_window(df: DataFrame, at: str, start: str, end: str) -> DataFrame:
    """Rows with start <= at <= end; both are ISO timestamps."""
    kind = dict(df.dtypes)[at]
    return df.where(F.col(at).between(F.lit(start).cast(kind), F.lit(end).cast(kind)))


def merge_intervals(ranges: DataFrame, key: str, start: str = "s", end: str = "e") -> DataFrame:
    """Islands of each key: ranges that overlap or touch become one. Ranges that end before they start are an error."""
    ranges = ranges.select(key, start, F.when(F.col(end) < F.col(start), F.raise_error(F.lit("a range ends before it starts"))).otherwise(F.col(end)).alias(end))
    scan = Scan(ranges, [key], [start, end]).running("_reached", F.col(end), F.max, before=True).settle()
    fresh = F.col("_reached").isNull() | (F.col(start) > F.col("_reached"))
    # An island is known by its first start, the largest one so far that nothing before reaches.
    rows = scan.running("_island", F.when(fresh, F.col(start)), F.max).done("_reached")
    return rows.groupBy(key, "_island").agg(F.min(start).alias(start), F.max(end).alias(end)).drop("_island")


def subtract_intervals(requests: DataFrame, merged: DataFrame, key: str) -> DataFrame:
    """(key, lo, hi): the parts of each request (key, a, b) that merged ranges (key, s, e) leave, boundaries shared.

    A request of one instant stays if nothing touches it. One request a key.
    """
    o = requests.join(merged, key).where("e >= a and s <= b").select(key, "a", "b", "s", "e")
    before = F.lag("e").over(Window.partitionBy(key).orderBy("s"))
    middle = o.select(key, F.greatest("a", F.coalesce(before, "a")).alias("lo"), F.least("s", "b").alias("hi")).where("hi > lo")
    met = o.groupBy(key).agg(F.max("e").alias("last"), F.count(F.lit(1)).alias("c"))
    tail = requests.join(met, key, "left").select(key, F.greatest("a", F.coalesce("last", "a")).alias("lo"), F.col("b").alias("hi"), F.coalesce("c", F.lit(0)).alias("c"))
    return middle.unionByName(tail.where("lo < hi or (lo = hi and c = 0)").drop("c"))


def contained(rows: DataFrame, at: str, ranges: DataFrame, keys: list[str], how: str) -> DataFrame:
    """Semi or anti join of rows with the ranges (keys, s, e) that hold their instant, both ends included.

    One sweep over points and starts in order: a point is held if the furthest end of the ranges that have started
    is not before it. A range is one row however long it is. A null key or instant is in no range.
    """
    names = rows.columns
    kind = dict(rows.dtypes)[at]
    points = rows.select(F.struct(*names).alias("_row"), *[F.col(k).alias(f"_key{i}") for i, k in enumerate(keys)], F.col(at).alias("_at"), F.lit(1).alias("_kind"), F.lit(None).cast(kind).alias("_end"))
    none = F.lit(None).cast(points.schema["_row"].dataType)
    starts = ranges.select(none.alias("_row"), *[F.col(k).alias(f"_key{i}") for i, k in enumerate(keys)], F.col("s").cast(kind).alias("_at"), F.lit(0).alias("_kind"), F.col("e").cast(kind).alias("_end"))
    own = [f"_key{i}" for i in range(len(keys))]
    scan = Scan(starts.unionByName(points), own, ["_at", "_kind"]).running("_reached", F.col("_end"), F.max)
    held = F.coalesce(F.col("_reached") >= F.col("_at"), F.lit(False))
    for k in own:
        held = held & F.col(k).isNotNull()
    return scan.done().where((F.col("_kind") == 1) & (held if how == "left_semi" else ~held)).select("_row.*")


def range_counts(points: DataFrame, at: str, ranges: DataFrame, range_id: str) -> DataFrame:
    """(range_id, n): how many points each range (range_id, s, e) holds, both ends included.

    Points and both ends of each range are put in order hour by hour; the points up to an end, less those
    before a start, are the range's. No range meets its points, so many long ranges cost no more than short ones.
    """
    none = F.lit(None).cast(dict(ranges.dtypes)[range_id])
    sums = points.groupBy(F.col(at).alias("_at")).agg(F.count(F.lit(1)).alias("_n")).select("_at", "_n", F.lit(1).alias("_kind"), none.alias(range_id))
    end = lambda c, kind: ranges.select(F.col(c).alias("_at"), F.lit(0).cast("bigint").alias("_n"), F.lit(kind).alias("_kind"), range_id)
    rows = sums.unionByName(end("s", 0)).unionByName(end("e", 2)).withColumn("_hour", F.date_trunc("hour", "_at"))
    hours = rows.groupBy("_hour").agg(F.sum("_n").alias("_n"))  # one row an hour of the whole time
    past = Window.orderBy("_hour").rowsBetween(Window.unboundedPreceding, -1)
    hours = hours.select("_hour", F.coalesce(F.sum("_n").over(past), F.lit(0)).alias("_before"))
    inside = Window.partitionBy("_hour").orderBy("_at", "_kind").rowsBetween(Window.unboundedPreceding, 0)
    rows = rows.withColumn("_sum", F.sum("_n").over(inside)).where("_kind <> 1").join(hours, "_hour")
    reached = F.col("_before") + F.col("_sum")
    return rows.groupBy(range_id).agg(F.sum(F.when(F.col("_kind") == 2, reached).otherwise(-reached)).alias("n"))


def boundary(text: Column, is_end: bool = False, zone: str = ZONE) -> Column:
    """A boundary as UTC: a date alone is its first instant, or its last as an end; a time without a zone is in `zone`."""
    day = text.rlike(r"^\s*\d{4}-\d{2}-\d{2}\s*$")
    local = F.try_to_timestamp(F.trim(text)).cast("timestamp_ntz")
    whole = F.try_to_timestamp(F.concat(F.trim(text), F.lit(" 00:00:00"))).cast("timestamp_ntz")
    last = F.expr("interval 1 day") - F.expr("interval 1 microsecond")
    local = F.when(day, whole + last if is_end else whole).otherwise(local)
    zoned = text.rlike(r"(?i)(z|[+-]\d{2}:?\d{2})\s*$") & ~day
    return F.when(zoned, F.try_to_timestamp(F.trim(text))).otherwise(F.to_utc_timestamp(local.cast("timestamp"), zone))


def daily_window(now: Column, checkpoint: Column, overlap_hours: int = 24) -> Column:
    """The start of a daily window: 30 hours back, further to the checkpoint less the overlap, 48 hours at most.

    A checkpoint over five minutes ahead is an error.
    """
    hours = lambda n: F.expr(f"interval {n} hours")
    start = F.least(now - hours(30), F.coalesce(checkpoint - hours(overlap_hours), now - hours(30)))
    ahead = checkpoint > now + F.expr("interval 5 minutes")
    return F.when(ahead, F.raise_error(F.lit("the checkpoint is ahead of the clock"))).otherwise(F.greatest(start, now - hours(48)))


def poll_split(start: Column, end: Column, snapshot: Column) -> tuple[Column, Column]:
    """(end of the part that can be polled, start of the part put off or null)."""
    return F.least(end, snapshot), F.when(end > snapshot, F.greatest(start, snapshot))
