"""Running sums, maxima and numbers over the ordered rows of each key, whatever share of all rows a key has.

While no key has more than HOT rows, this is one window per key. Otherwise rows are dealt by ranges of (key,
order), so that a large key lies in many tasks; each task scans its own part, and what the parts of a key before
it come to is carried over. Sums and maxima are associative, so the results are the same. Of the keys in a range
only the first can have begun in an earlier one: there is at most one carried row a range, which is broadcast.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .tables import settled

#: Rows of a key that one task scans at most.
HOT = 1_000_000


class Scan:
    """Rows with running values as further columns: Scan(...).running(...).rows. Its own columns begin with _scan, as no caller's do."""

    def __init__(self, rows: DataFrame, key: list[str], order: list[Column | str], keys: DataFrame | None = None):
        """keys (key, times): where it is cheaper to count than in rows; each stands for `times` of them at most."""
        self.key, self.order = key, [F.col(c) if isinstance(c, str) else c for c in order]
        n = F.count(F.lit(1)) if keys is None else F.sum("times")
        self.spread = not (rows if keys is None else keys).groupBy(*key).agg(n.alias("_scan_n")).where(F.col("_scan_n") > HOT).isEmpty()
        self.rows = rows
        if self.spread:
            self.rows = settled(rows.repartitionByRange(*map(F.col, key), *self.order).withColumn("_scan_part", F.spark_partition_id()))

    def running(self, name: str, value: Column, how: Callable[[Column], Column] = F.sum, before: bool = False) -> Scan:
        """name: F.sum or F.max of value over the key's rows up to this one, or, with before, those ahead of it; null where there is none."""
        last = -1 if before else 0
        rows = self.rows.withColumn("_scan_value", value)
        if not self.spread:
            self.rows = rows.withColumn(name, how(F.col("_scan_value")).over(Window.partitionBy(*self.key).orderBy(*self.order).rowsBetween(Window.unboundedPreceding, last))).drop("_scan_value")
            return self
        rows = rows.withColumn(name, how(F.col("_scan_value")).over(Window.partitionBy("_scan_part", *self.key).orderBy(*self.order).rowsBetween(Window.unboundedPreceding, last)))
        parts = rows.groupBy("_scan_part", *self.key).agg(how(F.col("_scan_value")).alias("_scan_whole"))
        past = Window.partitionBy(*self.key).orderBy("_scan_part").rowsBetween(Window.unboundedPreceding, -1)
        parts = parts.select(F.col("_scan_part").alias("_scan_p"), *[F.col(k).alias(f"_scan_k{i}") for i, k in enumerate(self.key)], how(F.col("_scan_whole")).over(past).alias("_scan_carry")).where(F.col("_scan_carry").isNotNull())
        on = F.col("_scan_part") == F.col("_scan_p")
        for i, k in enumerate(self.key):
            on = on & F.col(k).eqNullSafe(F.col(f"_scan_k{i}"))
        both = F.greatest(F.col(name), F.col("_scan_carry")) if how is F.max else F.col(name) + F.col("_scan_carry")
        rows = rows.join(F.broadcast(parts), on, "left").withColumn(name, F.coalesce(both, F.col(name), F.col("_scan_carry")))
        self.rows = rows.drop("_scan_value", "_scan_p", "_scan_carry", *[f"_scan_k{i}" for i in range(len(self.key))])
        return self

    def settle(self) -> Scan:
        """So far in a table: what follows reads it more than once."""
        if self.spread:
            self.rows = settled(self.rows)
        return self

    def done(self, *names: str) -> DataFrame:
        """The rows without the named columns."""
        return self.rows.drop("_scan_part", *names)


def numbered(rows: DataFrame, key: list[str], order: list[Column | str], name: str, keys: DataFrame | None = None) -> DataFrame:
    """name: the row's number within its key, from 1; keys as in Scan."""
    return Scan(rows, key, order, keys).running(name, F.lit(1)).done()
