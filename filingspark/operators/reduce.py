"""Chunks, keyed reduction with a replaceable reducer, fingerprints, promotion and cache checks."""

from __future__ import annotations

import hashlib
import re
from bisect import bisect_left
from collections.abc import Callable, Iterator
from itertools import pairwise

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .scans import numbered
from .tables import settled

CHUNK = 45_000
#: Texts that a reducer is given at once.
FAN_IN = 500


def split_chunks(text: str, size: int = CHUNK) -> list[str]:
    """Parts of at most `size` characters that join to the text.

    A part ends before the last line end that leaves it over half the size, which then begins the next one;
    without such a line end it is as long as it may be.
    """
    ends = [m.start() for m in re.finditer("\n", text)]
    bounds = [0]
    while len(text) - bounds[-1] > size:
        low, high = bounds[-1] + size // 2 + 1, bounds[-1] + size
        k = bisect_left(ends, high)
        bounds.append(ends[k - 1] if k and ends[k - 1] >= low else high)
    return [text[a:b] for a, b in pairwise([*bounds, len(text)])]


def chunks(docs: DataFrame, key: str, text: str, size: int = CHUNK) -> DataFrame:
    """(key, chunk_index, chunk_count, chunk) of every document; a null text is empty."""

    @F.arrow_udf("array<string>")
    def cut(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for arr in batches:
            yield pa.array([split_chunks(t or "", size) for t in arr.to_pylist()], pa.list_(pa.string()))

    rows = docs.select(key, cut(F.coalesce(F.col(text), F.lit(""))).alias("_parts"))
    return rows.select(key, F.size("_parts").alias("chunk_count"), F.posexplode("_parts").alias("chunk_index", "chunk"))


def stub(texts: list[str]) -> str:
    """A deterministic stand-in for a language model: the first sentence of each part."""
    return " ".join(t.strip().split(". ")[0][:80] for t in texts if t and t.strip())


def joined(texts: list[str]) -> str:
    """What stub() gives for a run of texts, from what it gave for parts of the run."""
    return " ".join(t for t in texts if t)


#: How a reducer's results for the runs of a group become the group's, where that is known; others are given them as texts.
MERGES: dict[Callable, Callable[[list[str]], str]] = {stub: joined}


def reduce_groups(rows: DataFrame, key: str, order: str, text: str, reducer: Callable[[list[str]], str] = stub, fan_in: int = FAN_IN, check: Callable[[str], str | None] | None = None, merge: Callable[[list[str]], str] | None = None) -> DataFrame:
    """(key, n, summary): the reducer over each key's texts in order, at most `fan_in` at a time; with check, also what it finds wrong with the summary, or null.

    Of a key with more texts, each run of fan_in texts gives one; these are merged in turn, run by run, until they
    are one. merge is the one of MERGES unless given; without any the reducer reads its own results as texts. Runs of
    one key lie in many tasks, so no task holds a whole group; what a key has other keys' sizes don't change.
    """
    merge = merge or MERGES.get(reducer, reducer)

    def one(texts: list[str], again: bool) -> str:
        return reducer(texts) if not again else texts[0] if len(texts) == 1 else merge(texts)

    def run(again: bool) -> Callable[[Column], Column]:
        @F.arrow_udf("string")
        def f(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
            for arr in batches:
                yield pa.array([one(v, again) for v in arr.to_pylist()], pa.string())

        return f

    @F.arrow_udf("string")
    def found(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for arr in batches:
            yield pa.array([check(v) for v in arr.to_pylist()], pa.string())

    def level(rows: DataFrame, again: bool, *by: str) -> DataFrame:
        groups = rows.groupBy(*by).agg(F.array_sort(F.collect_list(F.struct("_o", "_t"))).alias("_g"), F.sum("_n").alias("_n"))
        return groups.select(*by, "_n", run(again)(F.transform("_g", lambda x: x["_t"])).alias("_t"))

    rows, again = rows.select(key, F.col(order).alias("_o"), F.col(text).alias("_t"), F.lit(1).alias("_n")), False
    while (rows.groupBy(key).agg(F.count(F.lit(1)).alias("n")).agg(F.max("n")).first()[0] or 0) > fan_in:
        placed = numbered(rows, [key], ["_o", "_t"], "_p").withColumn("_p", F.floor((F.col("_p") - 1) / fan_in))
        rows, again = settled(level(placed, again, key, "_p").select(key, F.col("_p").alias("_o"), "_t", "_n")), True
    out = level(rows, again, key).select(key, F.col("_n").cast("int").alias("n"), F.col("_t").alias("summary"))
    return out.withColumn("problem", found("summary")) if check else out


def three_levels(chunk_rows: DataFrame, documents: DataFrame, announcements: DataFrame, reducer: Callable[[list[str]], str] = stub, fan_in: int = FAN_IN, merge: Callable[[list[str]], str] | None = None) -> DataFrame:
    """(ticker, n, summary) from chunks (url, chunk_index, chunk), documents (url, announcement_id) and announcements (announcement_id, ticker, announced_at); each level is a table before the next reads it."""
    docs = settled(reduce_groups(chunk_rows, "url", "chunk_index", "chunk", reducer, fan_in, merge=merge).drop("n").join(documents, "url"))
    anns = settled(reduce_groups(docs.withColumn("o", F.col("url")), "announcement_id", "o", "summary", reducer, fan_in, merge=merge).drop("n").join(announcements, "announcement_id"))
    return reduce_groups(anns.withColumn("o", F.struct("announced_at", "announcement_id")), "ticker", "o", "summary", reducer, fan_in, merge=merge)


def fingerprint(rows: DataFrame, key: list[str], order: list[str], fields: list[str]) -> DataFrame:
    """(key, fingerprint): SHA-256 of canonical JSON of each key's rows in order; fields sorted by name, nulls kept.

    Rows stream through in order, one at a time, with only the digest's state kept: no group is ever held as a whole.
    """
    json = lambda names: F.to_json(F.struct(*names), {"ignoreNullFields": "false"})
    wide = rows.select(*key, *[F.col(c).alias(f"_o{i}") for i, c in enumerate(order)], F.struct(*sorted(fields)).alias("_f"), json(key).alias("_k"), json(sorted(fields)).alias("_b"))
    names = [f.name for f in rows.select(*key).schema]
    schema = rows.select(*key).withColumn("fingerprint", F.lit("")).schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, first, sha = None, None, None
        for batch in batches:
            done: list[tuple] = []
            for i, (k, body) in enumerate(zip(batch.column("_k").to_pylist(), batch.column("_b").to_pylist(), strict=True)):
                if k == now:
                    sha.update(b",")
                else:
                    if sha is not None:
                        sha.update(b"]")
                        done.append((*first, sha.hexdigest()))
                    now, first, sha = k, [batch.column(n)[i].as_py() for n in names], hashlib.sha256(b"[")
                sha.update(body.encode())
            types = [batch.schema.field(n).type for n in names] + [pa.string()]
            yield pa.RecordBatch.from_arrays([pa.array([r[c] for r in done], t) for c, t in enumerate(types)], names=[*names, "fingerprint"])
        if sha is not None:
            sha.update(b"]")
            yield pa.RecordBatch.from_arrays([pa.array([x], t) for x, t in zip([*first, sha.hexdigest()], types, strict=True)], names=[*names, "fingerprint"])

    dealt = wide.repartition(*key).sortWithinPartitions("_k", *[f"_o{i}" for i in range(len(order))], "_f")
    return dealt.select(*key, "_k", "_b").mapInArrow(run, schema)


def cache_decision(rows: DataFrame, stored: DataFrame, key: list[str], n: str) -> DataFrame:
    """rows (key, fingerprint, n) with decision: hit, promoted for a single announcement, skipped for none, rebuild."""
    known = stored.select(*key, F.col("fingerprint").alias("_s"))
    return rows.join(known, key, "left").withColumn("decision", F.when(F.col(n) == 0, "skipped").when(F.col("_s").eqNullSafe(F.col("fingerprint")), "hit").when(F.col(n) == 1, "promoted").otherwise("rebuild")).drop("_s")


def usable(*fields: Column, lists: tuple[Column, ...] = ()) -> Column:
    """Whether any text isn't blank or any list isn't empty."""
    out = F.lit(False)
    for f in fields:
        out = out | (F.coalesce(F.trim(f), F.lit("")) != "")
    for v in lists:
        out = out | F.coalesce(F.size(v) > 0, F.lit(False))
    return out
