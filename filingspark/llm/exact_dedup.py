"""Exact duplicates by composable polynomial fingerprints.

A text's fingerprint is its bytes read as a polynomial at two fixed points, each modulo a prime.
Fingerprints of neighbouring chunks combine by length-shifted arithmetic, H(ab) = H(a) * r**len(b) + H(b),
so the chunks of a huge document are hashed in parallel tasks. Texts with equal fingerprints are then
compared chunk by chunk with one of them, so a collision never makes two texts equal.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import BROADCAST_ROWS, attach_groups, cut, own_columns, utf8, without

#: Bytes of a chunk hashed by one dot product: 4096 * 255 * 2**31 fits a signed 64-bit integer.
CHUNK = 4096
PRIMES = (2147483647, 2147483629)
POINTS = (911382323, 972663749)
#: Texts over so many bytes are split over tasks, in blocks of BLOCK bytes.
HUGE = 32 << 20
BLOCK = 1 << 20
#: Rows of a group of equal fingerprints that one task compares.
SLICE = 2000

FP = "struct<a:bigint,b:bigint,n:bigint>"
#: With sa and sb, by which a fingerprint before this one is multiplied.
FP_SHIFTS = "struct<a:bigint,b:bigint,n:bigint,sa:bigint,sb:bigint>"


def combine(left: tuple[int, int], right: tuple[int, int], length: int, primes=PRIMES) -> tuple[int, int]:
    """The fingerprint of a text and one of `length` bytes after it."""
    return tuple((x * pow(r, length, p) + y) % p for x, y, r, p in zip(left, right, POINTS, primes, strict=True))


def _powers(primes) -> list[np.ndarray]:
    out = []
    for r, p in zip(POINTS, primes, strict=True):
        column = [1]
        for _ in range(CHUNK - 1):
            column.append(column[-1] * r % p)
        out.append(np.array(column[::-1], np.int64))
    return out


def polynomial(data: np.ndarray, primes=PRIMES, powers=None) -> tuple[int, int]:
    """The fingerprint of some bytes: chunks by dot products, then combined."""
    powers = powers or _powers(primes)
    n = len(data)
    if n <= CHUNK:
        wide = data.astype(np.int64)
        return tuple(int(wide @ pw[CHUNK - n :]) % p for pw, p in zip(powers, primes, strict=True))
    head = n % CHUNK
    out = list(polynomial(data[:head], primes, powers))
    for at in range(head, n, CHUNK << 8):
        wide = data[at : at + (CHUNK << 8)].reshape(-1, CHUNK).astype(np.int64)
        for k, (pw, p, r) in enumerate(zip(powers, primes, POINTS, strict=True)):
            shift = pow(r, CHUNK, p)
            for h in (wide @ pw % p).tolist():
                out[k] = (out[k] * shift + h) % p
    return tuple(out)


def fingerprint_udf(primes=PRIMES, shifts: bool = False):
    """An Arrow function: text or bytes to (a, b, n), n the number of bytes."""

    @F.arrow_udf(FP_SHIFTS if shifts else FP)
    def fingerprint(arr: pa.Array) -> pa.Array:
        powers = _powers(primes)
        ends, data = utf8(arr)
        sizes = np.diff(ends)
        both = [polynomial(data[s:e], primes, powers) for s, e in zip(ends[:-1].tolist(), ends[1:].tolist(), strict=True)]
        columns = [[x for x, _ in both], [x for _, x in both], sizes]
        if shifts:
            columns += [[pow(r, n, p) for n in sizes.tolist()] for r, p in zip(POINTS, primes, strict=True)]
        return pa.StructArray.from_arrays([pa.array(c, pa.int64()) for c in columns], ["a", "b", "n", "sa", "sb"][: len(columns)])

    return fingerprint


def normalised(text: Column) -> Column:
    """Null as empty; each run of ASCII white space as one space."""
    return F.regexp_replace(F.coalesce(text, F.lit("")), r"[\t-\r][ \t-\r]*| [ \t-\r]+", " ")


def fingerprints(docs: DataFrame, primes=PRIMES, huge: int = HUGE, block: int = BLOCK) -> DataFrame:
    """(doc_id, rid, fp, text_sha256) of each row of (doc_id, text); rid tells equal rows apart.

    Huge texts become blocks that are dealt over all tasks; an ordered fold combines their fingerprints.
    """
    docs = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"), F.monotonically_increasing_id().alias("rid"))
    udf = fingerprint_udf(primes)
    size = F.octet_length("text")
    form = lambda d: d.select("doc_id", "rid", normalised(F.col("text")).alias("norm")).withColumn("raw", F.col("norm").cast("binary")).withColumn("text_sha256", F.sha2("raw", 256))
    small = form(docs.where(size <= huge)).select("doc_id", "rid", udf("norm").alias("fp"), "text_sha256")
    blocks = form(docs.where(size > huge)).select("doc_id", "rid", "text_sha256", F.posexplode(F.expr(f"transform(sequence(0, (octet_length(raw) - 1) div {block}), i -> substring(raw, cast(i * {block} + 1 as int), {block}))")).alias("i", "bytes"))
    hashed = blocks.repartition("rid", "i").select("doc_id", "rid", "text_sha256", "i", fingerprint_udf(primes, True)("bytes").alias("h"))
    parts = hashed.groupBy("doc_id", "rid", "text_sha256").agg(F.array_sort(F.collect_list(F.struct("i", "h"))).alias("parts"))
    fold = [f"aggregate(parts, 0L, (acc, x) -> (acc * x.h.s{x} + x.h.{x}) % {p}L) as {x}" for x, p in zip("ab", primes, strict=True)]
    whole = parts.selectExpr("doc_id", "rid", "text_sha256", *fold, "aggregate(parts, 0L, (acc, x) -> acc + x.h.n) as n")
    return small.unionByName(whole.select("doc_id", "rid", F.struct("a", "b", "n").alias("fp"), "text_sha256"))


def chunks_equal(left: str, right: str, chunk: int = 65536) -> Column:
    """Whether two binary columns are equal, compared chunk by chunk up to the first difference."""
    step = f"substring({left}, cast(i * {chunk} + 1 as int), {chunk}) = substring({right}, cast(i * {chunk} + 1 as int), {chunk})"
    return F.expr(f"octet_length({left}) = octet_length({right}) and forall(sequence(0, octet_length({left}) div {chunk}), i -> {step})")


def exact_dedup(docs: DataFrame, primes=PRIMES, huge: int = HUGE, block: int = BLOCK) -> DataFrame:
    """doc_id, keep_id, group_size, kept, text_sha256 for every row of docs (doc_id, text).

    Texts are equal when their normalised forms are. The row with the smallest doc_id stays; of
    repeated rows with that id, one. Null texts count as empty, a null doc_id comes after all others.
    An empty table gives no rows; columns other than doc_id and text aren't read.
    """
    rows = own_columns(docs, doc_id=F.col("doc_id"), text=F.col("text"))
    slim = cut(fingerprints(rows, primes, huge, block), "fingerprints")
    first = F.min(F.struct(F.col("doc_id").isNull().alias("z"), "doc_id", "rid")).alias("first")
    groups = cut(slim.groupBy("fp").agg(first, F.count(F.lit(1)).alias("n_rows")), "groups")
    bad = cut(_collisions(rows, slim, groups.where("n_rows > 1"), primes), "collisions")
    if bad.limit(1).count():
        norms = rows.select("doc_id", normalised(F.col("text")).alias("norm"))
        collided = cut(norms.select("doc_id", "norm", fingerprint_udf(primes)("norm").alias("fp")).join(bad, "fp", "left_semi").withColumn("rid", F.monotonically_increasing_id()), "collided")
        classes = collided.groupBy("norm").agg(first, F.count(F.lit(1)).alias("n_rows"))
        apart = collided.join(classes, "norm").select("doc_id", "rid", "first", "n_rows", F.sha2(F.col("norm").cast("binary"), 256).alias("text_sha256"))
        slim, groups = slim.join(bad, "fp", "left_anti"), groups.join(bad, "fp", "left_anti")
    whole = attach_groups(slim, groups, "fp").select("doc_id", "rid", "first", "n_rows", "text_sha256")
    if bad.limit(1).count():
        whole = whole.unionByName(apart)
    return whole.select(
        "doc_id",
        F.col("first.doc_id").alias("keep_id"),
        F.col("n_rows").alias("group_size"),
        (F.col("rid") == F.col("first.rid")).alias("kept"),
        "text_sha256",
    )


def drop_copies(docs: DataFrame) -> DataFrame:
    """The rows of docs that stay, with all their columns."""
    found = cut(exact_dedup(docs), "copies")
    keys = found.groupBy("doc_id", "text_sha256").agg(F.max("kept").alias("kept"), F.count(F.lit(1)).alias("n"))
    keys = cut(keys.where("not kept or n > 1"), "copied")
    key = {"doc_id": F.col("doc_id"), "text_sha256": F.sha2(normalised(F.col("text")).cast("binary"), 256)}
    return without(docs, key, keys.where("not kept"), keys.where("kept and n > 1"))


def _collisions(rows: DataFrame, slim: DataFrame, many: DataFrame, primes) -> DataFrame:
    """Fingerprints that two different texts share: each text of a group of many against the one that stays.

    Only rows whose ids such groups have are read again, once, into a table. The text that stays is copied for
    each SLICE rows of its group, so that no task gets a whole large group.
    """
    ids = cut(attach_groups(slim, many, "fp").where("doc_id is not null").select("doc_id").distinct(), "copied_ids")
    ids = F.broadcast(ids) if ids.count() <= BROADCAST_ROWS else ids
    again = rows.join(ids, "doc_id", "left_semi").unionByName(rows.where("doc_id is null"))
    texts = again.select("doc_id", normalised(F.col("text")).alias("norm"))
    texts = texts.select("doc_id", F.col("norm").cast("binary").alias("raw"), fingerprint_udf(primes)("norm").alias("fp"))
    found = attach_groups(texts, many, "fp").withColumn("slices", F.expr(f"cast(ceil(n_rows / {SLICE}) as int)"))
    slice_ = F.pmod(F.xxhash64(F.monotonically_increasing_id()), F.col("slices")).cast("int")
    found = cut(found.select("fp", "raw", "slices", slice_.alias("slice"), F.col("doc_id").eqNullSafe(F.col("first.doc_id")).alias("stays")), "copies")
    keep = found.where("stays").groupBy("fp").agg(F.min("raw").alias("keep"), F.max("slices").alias("slices"))
    keep = keep.select("fp", "keep", F.explode(F.sequence(F.lit(0), F.col("slices") - 1)).alias("slice"))
    return found.join(keep, ["fp", "slice"]).where(~chunks_equal("raw", "keep")).select("fp").distinct()
