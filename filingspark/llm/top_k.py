"""Exact top-k search by integer inner product, by MaxScore over postings.

The dimensions are the terms. A task cuts its rows into shards; a shard keeps a posting list for each
dimension (rows that aren't zero there, with their values) and the dimension's largest and smallest value,
from which a query gets the most that each term can add. Terms whose bounds together stay below the least
score that still counts are non-essential: only the lists of the others, the essential terms, are traversed.
What they find is probed in the remaining dimensions, the largest bound first, as long as it may still
compete. The least score is carried from shard to shard; tasks and blocks of queries are merged at the end.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import cut, own_columns, ship, shipped

#: Rows, and components, of a shard at most.
SHARD_ROWS, SHARD_SIZE = 4096, 1 << 20
#: Queries of a block: a block is broadcast, so its size is bounded by this many vectors.
BLOCK = 2048
#: Rows of the sample whose k-th best score is each query's first least score, and how many times as many rows a table must have for that.
SAMPLE, SAMPLE_RATIO = 8192, 16
LOWEST, HIGHEST = -(1 << 63), (1 << 63) - 1


def quantized(values: np.ndarray, scale: int = 1024) -> np.ndarray:
    """floor(scale * x), exactly: as 64-bit integers, or as Python's where those don't suffice."""
    wide = np.asarray(values, np.float64)
    with np.errstate(over="ignore"):
        out = np.floor(wide * scale)
    if not len(out) or np.abs(out).max() < 2.0**53:
        return out.astype(np.int64)
    return np.array([math.floor(Fraction(float(x)) * scale) for x in wide], object)


def matrix(arr: pa.Array) -> np.ndarray:
    """Quantized rows of a list array without nulls; shorter rows end in zeros."""
    if isinstance(arr, pa.ChunkedArray):
        arr = arr.combine_chunks()
    ends = np.asarray(arr.offsets, np.int64)
    lengths = np.diff(ends)
    flat = quantized(arr.values.to_numpy(zero_copy_only=False)[ends[0] : ends[-1]])
    n, width = len(lengths), int(lengths.max(initial=0))
    if len(flat) == n * width:
        return flat.reshape(n, width)
    out = np.zeros((n, width), flat.dtype)
    out[np.repeat(np.arange(n), lengths), np.arange(len(flat)) - np.repeat(ends[:-1] - ends[0], lengths)] = flat
    return out


def stacked(parts: list[np.ndarray]) -> np.ndarray:
    """Matrices one below the other, narrower ones filled with zeros."""
    width = max(p.shape[1] for p in parts)
    return np.concatenate([p if p.shape[1] == width else np.pad(p, ((0, 0), (0, width - p.shape[1]))) for p in parts])


def merged(scores: np.ndarray, ids: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """The k highest scores, ties to smaller ids."""
    if len(scores) > 4 * k:  # all that may be among them, before sorting
        least = np.partition(scores, len(scores) - k)[len(scores) - k]
        some = np.flatnonzero(scores >= least)
        scores, ids = scores[some], ids[some]
    order = sorted(range(len(ids)), key=lambda i: (-scores[i], ids[i]))[:k] if scores.dtype == object else np.lexsort((ids, -scores))[:k]
    return scores[order], ids[order]


class Shard:
    """Postings of some rows: for each dimension the rows that aren't zero there, in order, and their values."""

    def __init__(self, ids: np.ndarray, rows: np.ndarray):
        self.ids, self.rows = ids, rows
        self.postings = [(at, rows[at, d]) for d in range(rows.shape[1]) for at in [np.flatnonzero(rows[:, d])]]
        self.high, self.low = rows.max(0, initial=0), rows.min(0, initial=0)
        self.largest = max([0, *(abs(int(x)) for x in (*self.high, *self.low))])

    def wide(self) -> Shard:
        """The same with Python's integers, for scores beyond 64 bits."""
        return Shard(self.ids, self.rows.astype(object))

    def search(self, query: np.ndarray, least: int | None) -> tuple[np.ndarray, np.ndarray]:
        """(rows, scores) of all rows whose score is at least `least`; of all rows if that is None."""
        n, width = len(self.ids), min(len(query), self.rows.shape[1])
        query, dtype = query[:width], np.result_type(query, self.rows)
        bounds = np.maximum(query * self.high[:width], query * self.low[:width])
        order = np.argsort(bounds, kind="stable")
        below = np.concatenate([np.zeros(1, dtype), np.cumsum(bounds[order])])  # of the first e terms together
        outside = [] if least is None else np.flatnonzero(below < least)
        first = int(outside[-1]) if len(outside) else 0  # the first essential term; those before can't reach the least score alone
        score = np.zeros(n, dtype)
        found = np.full(n, not len(outside))
        for d in order[first:][::-1]:
            at, values = self.postings[d]
            if not query[d] or not len(at):
                continue
            if len(at) == n:
                score += values * query[d]
                found[:] = True
            else:
                score[at] += values * query[d]
                found[at] = True
        if least is None:
            return np.arange(n), score
        rows = np.flatnonzero(found & (score + below[first] >= least))
        score = score[rows]
        for e in range(first - 1, -1, -1):
            if not len(rows):
                break
            d = order[e]
            score = score + self.rows[rows, d] * query[d]
            keep = score + below[e] >= least
            if not keep.all():
                rows, score = rows[keep], score[keep]
        return rows, score


def shards(batches: Iterator[pa.RecordBatch]) -> Iterator[Shard]:
    """The rows (id, vector) of a task as shards."""
    ids, rows, held = [], [], 0

    def flush() -> Shard:
        shard = Shard(np.concatenate(ids), stacked(rows))
        ids.clear()
        rows.clear()
        return shard

    for b in batches:
        n = b.num_rows
        width = max(1, max((len(x) for x in b.column(1)), default=1))
        step = max(1, min(SHARD_ROWS, SHARD_SIZE // width))
        for at in range(0, n, step):
            part = b.slice(at, step)
            if ids and (held + part.num_rows > SHARD_ROWS or (held + part.num_rows) * max(width, *(r.shape[1] for r in rows)) > SHARD_SIZE):
                yield flush()
                held = 0
            ids.append(part.column(0).to_numpy(zero_copy_only=False).astype(np.int64))
            rows.append(matrix(part.column(1)))
            held += part.num_rows
    if ids:
        yield flush()


def searcher(block, k: int):
    """A function for mapInArrow: each query's k best rows of a task, as (q, query_id, vec_id, score)."""

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names, queries, least = shipped(block)
        best = [(np.zeros(0, np.int64), np.zeros(0, np.int64)) for _ in names]
        largest = max([0, *(abs(int(x)) for x in queries.ravel())]) if queries.dtype == object else int(np.abs(queries).max(initial=0))
        for shard in shards(batches):
            if shard.largest * largest * max(1, queries.shape[1]) >= 1 << 62 and shard.rows.dtype != object:
                shard = shard.wide()
            for q, name in enumerate(names):
                scores, ids = best[q]
                bar = max([x for x in (least[q], int(scores[-1]) if len(scores) == k else None) if x is not None], default=None)
                rows, new = shard.search(queries[q], bar)
                other = shard.ids[rows] != name
                if other.any():
                    best[q] = merged(np.concatenate([scores, new[other]]), np.concatenate([ids, shard.ids[rows[other]]]), k)
        for q, name in enumerate(names):
            scores, ids = best[q]
            if len(ids):
                clipped = [min(max(int(s), LOWEST), HIGHEST) for s in scores]
                yield pa.RecordBatch.from_arrays([pa.array([q] * len(ids), pa.int32()), pa.array([int(name)] * len(ids), pa.int64()), pa.array(ids, pa.int64()), pa.array(clipped, pa.int64())], ["q", "query_id", "vec_id", "score"])

    return search


def usable(vectors: DataFrame, key: str, vector: str) -> DataFrame:
    """(id, v) of the rows that take part."""
    finite = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))
    rows = own_columns(vectors, id=F.col(key).cast("long"), v=F.col(vector).cast("array<double>"))
    return rows.where(F.col("id").isNotNull() & F.coalesce(F.forall("v", finite), F.lit(False)))


def top_k(vectors: DataFrame, is_query: Column, k: int = 10, key: str = "vec_id", vector: str = "embedding", block: int = BLOCK, sample: int = SAMPLE) -> DataFrame:
    """query_id, rank (from 1), vec_id, score: for each row of vectors where is_query holds, the k other rows of the highest scores.

    A score is the inner product of floor(1024 * x), exactly; ties go to the smaller id. Vectors that are null or
    hold null or non-finite components, and rows without an id, take no part; a shorter vector counts as filled
    with zeros. A row is no candidate for a query of its own id. Rows that repeat a query's id each give a list;
    rows that repeat a candidate's id are each a candidate. Scores beyond 64 bits are compared exactly and shown
    as the nearest long. Fewer than k candidates give fewer rows, an empty table none; other columns aren't read.

    Queries are searched in blocks of at most `block`, each broadcast and searched in one pass over the rows. The
    k-th best score in a bounded sample is a lower bound for the whole table, so a task returns little more than
    what belongs to the result.
    """
    spark = vectors.sparkSession
    rows = usable(vectors, key, vector)
    chosen = usable(vectors.where(is_query), key, vector)
    n = chosen.count()
    if not n:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score long")
    blocks = -(-n // block)
    dealt = cut(chosen.repartition(blocks).withColumn("part", F.spark_partition_id()), "queries")
    seeds = None
    if rows.count() >= SAMPLE_RATIO * sample:
        seeds = cut(rows.orderBy(F.xxhash64("id"), "id").limit(sample).repartition(8), "sample")
    parts = []
    for b in range(blocks):
        own = dealt.where(F.col("part") == b).select("id", "v").toArrow()
        if not own.num_rows:
            continue
        names, queries = own.column("id").to_numpy(), matrix(own.column("v"))
        least: list[int | None] = [None] * len(names)
        if seeds is not None:
            found = seeds.mapInArrow(searcher(ship(spark, (names, queries, least)), k), SCHEMA)
            for r in ranked(found, k).where(F.col("rank") == k).select("q", "score").collect():
                least[r.q] = r.score if LOWEST < r.score < HIGHEST else None
        found = ranked(rows.mapInArrow(searcher(ship(spark, (names, queries, least)), k), SCHEMA), k)
        parts.append(found if blocks == 1 else cut(found, "found"))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out.select("query_id", "rank", "vec_id", "score")


SCHEMA = "q int, query_id long, vec_id long, score long"


def ranked(found: DataFrame, k: int) -> DataFrame:
    """Shards merged: each query's k best; each task keeps only k rows of a query before they are shuffled."""
    order = Window.partitionBy("q").orderBy(F.col("score").desc(), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


ORACLE = """
with x as (select vec_id, list_transform(embedding, lambda e: floor(1024 * e::double)::bigint) as v from embeddings
  where vec_id is not null and embedding is not null and len(list_filter(embedding, lambda e: e is null or not isfinite(e))) = 0),
c as (select vec_id, unnest(v) as value, unnest(range(1, len(v) + 1)) as place from x),
q as (select * from c where vec_id % 100 = 0),
s as (select q.vec_id as query_id, c.vec_id, sum(q.value * c.value)::bigint as score from q join c on q.place = c.place and q.vec_id <> c.vec_id group by all),
r as (select *, row_number() over (partition by query_id order by score desc, vec_id)::integer as rank from s)
select query_id, rank, vec_id, score from r where rank <= 10
"""
