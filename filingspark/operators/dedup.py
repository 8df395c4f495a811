"""Exact and near duplicates of attachments within a group."""

from __future__ import annotations

import unicodedata
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import setjoin, tables, wordruns
from .scans import numbered
from .tables import settled, slim, stored

#: Texts with fewer tokens are never near duplicates; lengths must be alike; tokens in a shingle.
MIN_TOKENS, LENGTH_RATIO, NEAR, WIDTH = 120, 0.94, 0.985, 5


def _compatible(text: Column) -> Column:
    @F.arrow_udf("string")
    def fold(arr: pa.Array) -> pa.Array:
        return pa.array([None if t is None else unicodedata.normalize("NFKC", t).lower() for t in arr.to_pylist()], pa.string())

    return fold(text)


def tokens(text: Column) -> Column:
    """Runs of ASCII letters and digits in lower case, after compatibility forms (full width, ligatures) are resolved.

    Only texts with other than ASCII characters leave the JVM for that.
    """
    text = F.coalesce(text, F.lit(""))
    plain = F.octet_length(text) == F.length(text)
    folded = F.when(plain, F.lower(text)).otherwise(_compatible(F.when(~plain, text)))
    return F.regexp_extract_all(folded, F.lit("[a-z0-9]+"), F.lit(0))


def features(items: DataFrame, cap: int | None = None) -> DataFrame:
    """items (announcement_id, url, filename, text, sha256, is_attachment, ordinal) with tokens, digests, shingles, anchors (cap and the latter as in wordruns.read), a number and rank.

    Rank is the order in which representatives are chosen: main documents first, then longer texts, then names. It is
    found without the texts, so that those of a large group stay in many tasks. Texts and shingles are stored once, by columns.
    """
    rows = items.withColumn("_read", wordruns.read(F.col("text"), WIDTH, MIN_TOKENS, cap)).select(
        "announcement_id", "url", "filename", "sha256", "is_attachment", "ordinal",
        F.lower(F.regexp_extract("filename", r"[^./](\.[^./]+)$", 1)).alias("suffix"), "_read.*",
    )
    rows = stored(rows.withColumn("digest", F.sha2(F.col("normalized").cast("binary"), 256)).withColumn("size", F.length("normalized")).withColumn("_row", F.monotonically_increasing_id()))
    narrow = rows.select("announcement_id", "_row", F.col("is_attachment").cast("int").alias("_last"), (-F.col("n_tokens")).alias("_size"), F.lower("filename").alias("_name"), "ordinal")
    ranks = settled(numbered(narrow, ["announcement_id"], ["_last", "_size", "_name", "ordinal"], "rank").select("_row", F.col("rank").cast("int").alias("rank")))
    small = ranks.count() <= tables.SMALL
    rows = rows.join(F.broadcast(ranks) if small else ranks, "_row")
    return rows if small else stored(rows)


def jaccard(left: Column, right: Column) -> Column:
    """Shared over joint of arrays without repeats; 0 if either is empty."""
    shared = F.array(F.size(F.array_intersect(left, right)))
    return F.when((F.size(left) > 0) & (F.size(right) > 0), F.transform(shared, lambda n: n / (F.size(left) + F.size(right) - n))[0]).otherwise(0.0)


def similarity(a: str, b: str) -> Column:
    """1 for equal token sequences, else the larger of containment and Jaccard."""
    x, y = F.col(f"{a}.normalized"), F.col(f"{b}.normalized")
    short, long = F.when(F.length(x) <= F.length(y), x).otherwise(y), F.when(F.length(x) <= F.length(y), y).otherwise(x)
    inside = F.when(F.contains(long, short) & (F.length(long) > 0), F.length(short) / F.length(long)).otherwise(0.0)
    return F.when(F.col(f"{a}.digest") == F.col(f"{b}.digest"), 1.0).otherwise(F.greatest(inside, jaccard(F.col(f"{a}.shingles"), F.col(f"{b}.shingles"))))


def duplicate_pairs(rows: DataFrame, near: float = NEAR) -> DataFrame:
    """(announcement_id, later, earlier, category, similarity): pairs of features (a table) in which the later could give way.

    Of files with equal digests each pairs with the first of them, which is kept if any of them is. Near ones
    meet by group, suffix and what they share; texts and shingles join the pairs afterwards.
    """
    key = ["announcement_id", "sha256"]
    exact = rows.where("sha256 <> ''").select(*key, "rank")
    firsts = exact.groupBy(*key).agg(F.min("rank").alias("earlier"))
    exact = exact.join(firsts, key).where("rank > earlier").select("announcement_id", F.col("rank").alias("later"), "earlier", F.lit("exact_duplicate").alias("category"), F.lit(1.0).alias("similarity"))
    return exact.unionByName(near_pairs(rows, near))


def near_pairs(rows: DataFrame, near: float = NEAR) -> DataFrame:
    """The near pairs of duplicate_pairs().

    Shingle sets that are alike meet by the rarest of their shingles, texts within other texts by the rarest of their
    anchors; only such pairs are compared. Of rows with equal tokens the first stands for all; the others join the pairs
    afterwards. Until then rows are known by their numbers, and no text moves before its pair is found.
    """
    group, text = ["announcement_id", "suffix"], ["announcement_id", "suffix", "digest"]
    long = rows.where(F.col("n_tokens") >= MIN_TOKENS)
    narrow = long.select(*text, "_row", "rank", "sha256")
    firsts = narrow.groupBy(*text).agg(F.min("rank").alias("first"), F.count(F.lit(1)).alias("n"), F.min("sha256").alias("low"), F.max("sha256").alias("high"))
    members = settled(narrow.join(firsts, text).drop(*text[1:]))
    others = slim(members.where("rank > first").select("_row"))
    long = long.withColumn("_group", F.xxhash64(*group)).join(others, "_row", "left_anti")
    like = setjoin.alike(long.select("_group", "_row", "shingles"), ["_group"], "_row", "shingles", near)
    held = setjoin.within(long.select("_group", "_row", "size", "whole", "inner"), ["_group"], "_row", "size", "whole", "inner")
    held = held.select("_group", F.greatest("inside", "around").alias("later"), F.least("inside", "around").alias("earlier"))
    pairs = like.unionByName(held).select("later", "earlier").distinct()
    end = lambda key, name: long.select(F.col("_row").alias(key), F.struct(*group, "rank", "n_tokens").alias(name))
    pairs = pairs.join(end("later", "x"), "later").join(end("earlier", "y"), "earlier")
    same = (F.col("x.announcement_id") == F.col("y.announcement_id")) & (F.col("x.suffix") == F.col("y.suffix"))
    pairs = pairs.where(same & (F.least("x.n_tokens", "y.n_tokens") / F.greatest("x.n_tokens", "y.n_tokens") >= LENGTH_RATIO))
    pairs = settled(pairs.select("later", "earlier", F.greatest("x.rank", "y.rank").alias("_later"), F.least("x.rank", "y.rank").alias("_earlier"), "x.announcement_id"))
    ends = pairs.select(F.explode(F.array("later", "earlier")).alias("_row")).distinct()
    long = long.join(slim(ends), "_row", "left_semi")
    side = lambda end, name: long.select(F.col("_row").alias(end), F.struct("normalized", "digest", "shingles").alias(name))
    found = pairs.join(side("later", "a"), "later").join(side("earlier", "b"), "earlier")
    found = found.withColumn("similarity", similarity("a", "b")).where(F.col("similarity") >= near)
    found = found.select("announcement_id", F.col("_later").alias("later"), F.col("_earlier").alias("earlier"), "similarity")
    other = members.where("n > 1 and (low <> high or low = '')").select("announcement_id", F.col("first").alias("later"), F.col("first").alias("earlier")).distinct()
    found = found.unionByName(other.withColumn("similarity", F.lit(1.0)))
    member = lambda first, name: members.select("announcement_id", F.col("first").alias(first), F.struct("rank", "sha256").alias(name))
    found = found.join(member("later", "a"), ["announcement_id", "later"]).join(member("earlier", "b"), ["announcement_id", "earlier"])
    found = found.where(((F.col("a.sha256") != F.col("b.sha256")) | (F.col("a.sha256") == "")) & ((F.col("later") != F.col("earlier")) | (F.col("a.rank") > F.col("b.rank"))))
    return found.select("announcement_id", F.greatest("a.rank", "b.rank").alias("later"), F.least("a.rank", "b.rank").alias("earlier"), F.lit("near_duplicate").alias("category"), "similarity")


def copies(rows: DataFrame) -> DataFrame:
    """(announcement_id, later, digest) of the features whose file another row of their group has too."""
    exact = rows.where("sha256 <> ''").select("announcement_id", F.col("rank").alias("later"), F.col("sha256").alias("digest"))
    many = exact.groupBy("announcement_id", "digest").agg(F.count(F.lit(1)).alias("n")).where("n > 1").drop("n")
    return exact.join(many, ["announcement_id", "digest"], "left_semi")


def resolve(pairs: DataFrame, same: DataFrame | None = None) -> DataFrame:
    """(announcement_id, later, earlier, category, similarity): the pairs that take effect.

    A row gives way to the first kept row that it pairs with, or that is a copy of it (same: what copies() gives),
    in order of rank; a row whose partners all gave way is kept. Rows are read in that order, group by group; a
    task remembers which ranks of its group gave way and the first kept row of each file.
    """
    rows = pairs.withColumn("digest", F.lit(None).cast("string"))
    if same is not None:
        rows = rows.unionByName(same.select("announcement_id", "later", F.lit(None).cast("int").alias("earlier"), F.lit("exact_duplicate").alias("category"), F.lit(1.0).alias("similarity"), "digest"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        group, now, digest = None, None, None
        gone: set[int] = set()
        kept: dict[str, int] = {}
        hits: list[tuple[int, str, float]] = []
        out: list[tuple] = []

        def settle() -> None:
            nonlocal hits, digest
            if digest in kept:
                hits.append((kept[digest], "exact_duplicate", 1.0))
            if hits:
                gone.add(now)
                out.append((group, now, *min(hits)))
            elif digest is not None:
                kept[digest] = now
            hits, digest = [], None

        def flushed() -> pa.RecordBatch:
            columns = [pa.array([r[k] for r in out], names.field(k).type) for k in range(5)]
            out.clear()
            return pa.RecordBatch.from_arrays(columns, names=names.names[:5])

        names = None
        for batch in batches:
            names = batch.schema
            for own, later, earlier, category, alike, file in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if now is not None and (own != group or later != now):
                    settle()
                if own != group:
                    gone, kept = set(), {}
                group, now = own, later
                if earlier is None:
                    digest = file
                elif earlier not in gone:
                    hits.append((earlier, category, alike))
            yield flushed()
        if now is not None:
            settle()
            yield flushed()

    dealt = rows.repartition("announcement_id").sortWithinPartitions("announcement_id", "later", "earlier")
    return dealt.mapInArrow(run, pairs.schema)


def deduplicate(items: DataFrame, near: float = NEAR) -> DataFrame:
    """announcement_id, url, keep, category, duplicate_of_url, similarity for every item.

    An item is compared with kept items only, first hit wins: one that is like a suppressed item only is kept.
    """
    rows = features(items)
    chosen = resolve(near_pairs(rows, near), copies(rows))
    names = rows.select("announcement_id", F.col("rank").alias("earlier"), F.col("url").alias("duplicate_of_url"))
    chosen = chosen.join(names, ["announcement_id", "earlier"]).select("announcement_id", F.col("later").alias("rank"), "category", "duplicate_of_url", "similarity")
    return rows.join(chosen, ["announcement_id", "rank"], "left").select(
        "announcement_id",
        "url",
        F.col("duplicate_of_url").isNull().alias("keep"),
        F.coalesce("category", F.lit("analysis_source")).alias("category"),
        "duplicate_of_url",
        "similarity",
    )
