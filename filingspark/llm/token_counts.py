"""Token counts behind a digest cache.

A text's content digest and its tokenizer's version digest name a stored count. Rows whose digest has no
count are misses; one row of each distinct miss is encoded and its count appended to the cache.
"""

from __future__ import annotations

import hashlib
import json
import sys
from collections.abc import Iterator
from types import ModuleType

import numpy as np
import pyarrow as pa
import tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import BROADCAST_ROWS, attach_groups, cut, own_columns, texts, work_path

#: Bytes of pieces, with what Python needs to hold them, whose counts a worker remembers; and bytes encoded at once.
MEMO, SLICE = 48 << 20, 1 << 16
ENTRY = 120
CACHE = "version string, digest binary, n_tokens bigint"

#: Patterns of pre-tokenizers whose matches hold no white space.
PATTERNS = (r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+",)


class Whole:
    """Counts tokens of whole texts, for any tokenizer."""

    def __init__(self, source: str):
        self.encoder = tokenizers.Tokenizer.from_str(source)
        self.encoder.no_truncation()
        self.encoder.no_padding()

    def count(self, text: bytes) -> int:
        """Bytes that aren't UTF-8 are read as replacement characters."""
        return len(self.encoder.encode(text.decode("utf-8", "replace"), add_special_tokens=False))


class Piecewise(Whole):
    """Counts tokens with a tokenizer whose counts add up over pieces parted by ASCII white space.

    Each piece is encoded once and its count remembered. New pieces are encoded together, joined by spaces;
    where a token begins tells which piece it is of.
    """

    def __init__(self, source: str, memo: int = MEMO):
        super().__init__(source)
        self.seen: dict[bytes, int] = {}
        self.held, self.memo = 0, memo

    def count(self, text: bytes) -> int:
        pieces, seen = text.split(), self.seen
        new = [p for p in set(pieces) if p not in seen]
        if new:
            size = sum(map(len, new)) + ENTRY * len(new)
            if self.held + size > self.memo:
                seen.clear()
                self.held, new = 0, list(set(pieces))
                size = sum(map(len, new)) + ENTRY * len(new)
            self.held += size
            self._learn(new)
        return sum(map(seen.__getitem__, pieces))

    def _learn(self, pieces: list[bytes]) -> None:
        part, size = [], 0
        for p in pieces:
            part.append(p)
            size += len(p) + 1
            if size >= SLICE:
                self._encode(part)
                part, size = [], 0
        if part:
            self._encode(part)

    def _encode(self, pieces: list[bytes]) -> None:
        words = [p.decode("utf-8", "replace") for p in pieces]
        starts = np.cumsum([0, *(len(w) + 1 for w in words[:-1])])
        found = self.encoder.encode(" ".join(words), add_special_tokens=False).offsets
        places = np.searchsorted(starts, np.fromiter((a for a, _ in found), np.int64, len(found)), "right") - 1
        self.seen.update(zip(pieces, np.bincount(places, minlength=len(words)).tolist(), strict=True))


def splits_at_white_space(source: str) -> bool:
    """Whether a tokenizer drops white space and encodes what it parts on its own, as its JSON tells.

    True if the first pre-tokenizer keeps only matches without white space, normalizers change no more than
    single characters, and no added token holds or looks beyond white space. Otherwise texts are encoded whole.
    """
    spec = json.loads(source)
    steps = lambda s, name: [] if s is None else s[name] if s["type"] == "Sequence" else [s]
    for n in steps(spec.get("normalizer"), "normalizers"):
        blank = n["type"] == "Replace" and n["pattern"] == {"Regex": r"\s+"} and n["content"] == " "
        if n["type"] not in ("NFC", "NFD", "NFKC", "NFKD", "Lowercase") and not blank:
            return False
    first = next(iter(steps(spec.get("pre_tokenizer"), "pretokenizers")), {"type": None})
    kept = first["type"] == "Split" and first["behavior"] == "Removed" and first["invert"] and first["pattern"].get("Regex") in PATTERNS
    if not kept and first["type"] not in ("Whitespace", "WhitespaceSplit", "BertPreTokenizer"):
        return False
    return not any(t["lstrip"] or t["rstrip"] or t["single_word"] or t["content"].split() != [t["content"]] for t in spec.get("added_tokens", []))


def count_udf(source, version: str, piecewise: bool):
    """source: a broadcast of the tokenizer's JSON. Python workers serve many tasks; what they have read and counted stays with them."""

    @F.arrow_udf("bigint")
    def count(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        held = sys.modules.setdefault("_token_counters", ModuleType("_token_counters"))
        if (counter := held.__dict__.get(version)) is None:
            held.__dict__.clear()
            counter = held.__dict__[version] = (Piecewise if piecewise else Whole)(source.value)
        for arr in batches:
            yield pa.array([counter.count(t) for t in texts(arr)], pa.int64())

    return count


def version_digest(source: str) -> str:
    return hashlib.sha256(f"{tokenizers.__version__}\n{source}".encode()).hexdigest()


def read_cache(spark: SparkSession, path: str | None, version: str) -> DataFrame | None:
    """The stored counts of a version, one row a digest, or None if nothing has been stored yet."""
    if path is None:
        return None
    hadoop = spark._jvm.org.apache.hadoop.fs.Path(path)
    if not hadoop.getFileSystem(spark._jsc.hadoopConfiguration()).exists(hadoop):
        return None
    rows = spark.read.schema(CACHE).parquet(path).where(F.col("version") == version)
    return rows.groupBy("digest").agg(F.max("n_tokens").alias("n_tokens"))


def content(text: Column, piecewise: bool) -> Column:
    """What the digest is taken of: null as empty, and white-space runs as one space if they don't count."""
    text = F.coalesce(text, F.lit(""))
    return F.regexp_replace(text, r"[\t-\r][ \t-\r]*| [ \t-\r]+", " ") if piecewise else text


def token_counts(docs: DataFrame, tokenizer: str, cache: str | None = None, limit: int = 2048) -> DataFrame:
    """doc_id, n_bytes, n_tokens, over_limit for every row of docs (doc_id, text).

    tokenizer: the path of a tokenizers JSON file on the driver. cache: a path all executors share;
    without one, a table of this run. Null texts count as empty: 0 bytes, 0 tokens; bytes that aren't
    UTF-8 as replacement characters. Repeated rows are each returned, ids may be null, and an empty
    table gives no rows. Other columns aren't read.
    """
    spark = docs.sparkSession
    with open(tokenizer, encoding="utf-8") as f:
        text = f.read()
    version, piecewise = version_digest(text), splits_at_white_space(text)
    source = spark.sparkContext.broadcast(text)
    rows = own_columns(docs, doc_id=F.col("doc_id"), text=F.coalesce(F.col("text"), F.lit("")))
    digest = F.unhex(F.sha2(content(F.col("text"), piecewise).cast("binary"), 256))
    slim = cut(rows.select("doc_id", F.octet_length("text").cast("bigint").alias("n_bytes"), digest.alias("digest")), "digests")
    each = slim.groupBy("digest", "doc_id").agg(F.count(F.lit(1)).alias("n"))
    first = F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "n"))
    groups = cut(each.groupBy("digest").agg(first.alias("f"), F.sum("n").alias("n_rows")).select("digest", F.col("f.doc_id").alias("low"), F.col("f.n").alias("n_low"), "n_rows"), "contents")
    stored, path = read_cache(spark, cache, version), cache or work_path(spark, "counts")
    misses = groups if stored is None else cut(groups.join(stored, "digest", "left_anti"), "misses")
    todo = _distinct_misses(rows.withColumn("digest", digest), groups, misses, stored).select("digest", "text")
    repeated = misses.where("n_low > 1").select("digest")  # equal rows with equal ids
    if (n := repeated.count()) > 0:
        repeated = F.broadcast(repeated) if n <= BROADCAST_ROWS else repeated
        todo = todo.join(repeated, "digest", "left_anti").unionByName(todo.join(repeated, "digest", "left_semi").dropDuplicates(["digest"]))
    fresh = todo.select(F.lit(version).alias("version"), "digest", count_udf(source, version, piecewise)("text").alias("n_tokens"))
    fresh.write.mode("append").parquet(path)
    counts = read_cache(spark, path, version)
    known = cut(groups.select("digest", "n_rows").join(counts, "digest"), "known")
    return attach_groups(slim, known, "digest").select("doc_id", "n_bytes", "n_tokens", (F.col("n_tokens") > limit).alias("over_limit"))


def _distinct_misses(rows: DataFrame, groups: DataFrame, misses: DataFrame, stored: DataFrame | None) -> DataFrame:
    """The rows to encode: of each missing digest, those with its smallest id (texts travel only if both tables are large)."""
    own = F.col("low").eqNullSafe(F.col("doc_id"))
    if misses.count() <= BROADCAST_ROWS:
        return rows.join(F.broadcast(misses), "digest").where(own)
    skip = groups.where("n_rows > 1").withColumn("stored", F.lit(False))
    if stored is not None:
        found = stored.select("digest", F.lit(True).alias("stored"))
        skip = cut(groups.join(found, "digest", "left").withColumn("stored", F.coalesce("stored", F.lit(False))).where("stored or n_rows > 1"), "skip")
    if skip.count() <= BROADCAST_ROWS:
        rows = rows.join(F.broadcast(skip), "digest", "left")
        return rows.where(F.col("n_rows").isNull() | (~F.col("stored") & own))
    return attach_groups(rows, misses, "digest").where(own)
