"""Pairs of like sets within groups, and of texts that lie within others, found by what they share, not by trying all.

Both searches lose no pair and give candidates that their caller verifies. An element's rarity is counted over its
whole group, and what identifies a row is rare, so rows that share only what all of a group share do not meet.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

#: Against what division leaves over: a product that is whole must not be rounded up.
EPS = 1e-9


def _rarity(elements: DataFrame, group: list[str], name: str) -> DataFrame:
    """elements (group, ..., name) with n, in how many rows of its group an element is; rows hold an element once."""
    return elements.withColumn("n", F.count(F.lit(1)).over(Window.partitionBy(name, *group)))


def _begins(batch: pa.RecordBatch, before: pa.RecordBatch | None, names: list[str]) -> np.ndarray:
    """Which rows differ in the named columns from the one before; before: what ends with the row before the batch's first."""
    new = np.zeros(batch.num_rows, bool)
    new[0] = before is None or any(batch.column(c)[0] != before.column(c)[-1] for c in names)
    for c in names:
        own = batch.column(c)
        new[1:] |= pc.fill_null(pc.not_equal(own[1:], own[:-1]), True).to_numpy(zero_copy_only=False)
    return new


def _shared(elements: DataFrame, name: str) -> DataFrame:
    """elements with n, in how many rows an element (a hash that tells groups apart) is, of those in more than one.

    They are read in order of that number alone, which sorts by its digits.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []  # the rows so far of the last element
        for batch in batches:
            if not batch.num_rows:
                continue
            at = np.flatnonzero(_begins(batch, held[-1] if held else None, [name]))
            if not len(at):
                held.append(batch)
                continue
            held.append(batch.slice(0, at[0]))
            n = sum(b.num_rows for b in held)
            if n > 1:
                yield from (counted(b, np.full(b.num_rows, n)) for b in held if b.num_rows)
            sizes = np.diff(at)
            n = np.repeat(sizes, sizes)
            yield counted(batch.slice(at[0], len(n)).filter(pa.array(n > 1)), n[n > 1])
            held = [batch.slice(at[-1])]
        n = sum(b.num_rows for b in held)
        if n > 1:
            yield from (counted(b, np.full(b.num_rows, n)) for b in held)

    def counted(batch: pa.RecordBatch, n: np.ndarray) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([*batch.columns, pa.array(n, pa.int64())], names=[*batch.schema.names, "n"])

    dealt = elements.repartition(name).sortWithinPartitions(name)
    return dealt.mapInArrow(run, T.StructType([*elements.schema.fields, T.StructField("n", T.LongType())]))


def prefixes(rows: DataFrame, group: list[str], key: str, elements: str, least: float) -> DataFrame:
    """(group, key, size, e, place): of each set the (hashes of the) rarest elements first, as many as two sets of that Jaccard similarity can't both do without; those that no other set has are only counted.

    Sets with a similarity of `least` share least * size elements or more of either, so one of the
    size - ceil(least * size) + 1 that come first in an order that all sets follow.
    """
    each = rows.select(*group, key, F.size(elements).alias("size"), F.explode(elements).alias("e")).withColumn("e", F.xxhash64("e", *group))
    names = [*group, key, "size", "e"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        before, n = None, 0  # the row before, and how many rows its set has had
        for batch in batches:
            if not batch.num_rows:
                continue
            at = np.arange(batch.num_rows)
            start = np.maximum.accumulate(np.where(_begins(batch, before, [key, *group]), at, -n))
            after = at - start
            before, n = batch.slice(batch.num_rows - 1), int(after[-1]) + 1
            size = batch.column("size").to_numpy()
            first = after >= np.ceil(size * least - EPS) - 1
            place = pa.array((size - 1 - after)[first], pa.int32())
            yield pa.RecordBatch.from_arrays([*(batch.column(c).filter(pa.array(first)) for c in names), place], names=[*names, "place"])

    # The most frequent first: how many come after an element also tells its place among those that aren't moved on.
    dealt = _shared(each, "e").repartition(*group, key).sortWithinPartitions(key, *group, F.desc("n"), F.desc("e")).select(*names)
    return dealt.mapInArrow(run, T.StructType([*dealt.schema.fields, T.StructField("place", T.IntegerType())]))


def alike(rows: DataFrame, group: list[str], key: str, elements: str, least: float) -> DataFrame:
    """(group, later, earlier), key of the one above that of the other: among them all pairs of sets (arrays without repeats) with a Jaccard similarity of `least` (above 0) or more.

    Sizes must allow the similarity, and so must what the two have left behind the first element in common.
    """
    p = prefixes(rows, group, key, elements, least)
    a = p.withColumnRenamed(key, "later")
    b = p.select(*group, "e", F.col(key).alias("earlier"), F.col("size").alias("size_b"), F.col("place").alias("place_b"))
    pairs = a.join(b, [*group, "e"]).where(F.col("later") > F.col("earlier"))
    pairs = pairs.where(F.least("size", "size_b") >= F.greatest("size", "size_b") * least - EPS)
    shared = F.least(F.col("size") - F.col("place"), F.col("size_b") - F.col("place_b"))
    pairs = pairs.where(shared >= (F.col("size") + F.col("size_b")) * (least / (1 + least)) - EPS)
    return pairs.select(*group, "later", "earlier").distinct()


def within(rows: DataFrame, group: list[str], key: str, length: str, whole: str, inner: str) -> DataFrame:
    """(group, inside, around): keys of rows; among them all whose text lies in the other's.

    length: characters of the text; whole, inner: its anchors (wordruns.read). Texts are words parted by one space, at
    least SPAN + width + 1 of them; the first and the last may lie in the other text as a part of a word. Apart from runs that hold those two, what lies within has its anchors in
    common with what is around it, so the rarest of them is enough to meet by.
    """
    order = "_length"
    found = rows.withColumnRenamed(length, order)
    index = _rarity(found.select(*group, key, order, F.explode(whole).alias("e")), group, "e")
    probes = found.select(*group, key, order, F.explode(inner).alias("e")).join(index.select(*group, "e", "n").distinct(), [*group, "e"], "left")
    probes = probes.groupBy(*group, key).agg(F.min(F.struct(F.coalesce("n", F.lit(1)).alias("n"), "e")).alias("x"), F.first(order).alias("o"))
    probes = probes.select(*group, F.col(key).alias("inside"), F.col("x.e").alias("e"), "o")
    around = index.select(*group, "e", F.col(key).alias("around"), F.col(order).alias("size"))
    return probes.join(around, [*group, "e"]).where((F.col("o") <= F.col("size")) & (F.col("inside") != F.col("around"))).select(*group, "inside", "around").distinct()
