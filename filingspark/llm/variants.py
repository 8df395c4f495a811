"""Spelling variants without pairs.

Two words of like length are near when they share a wildcard group: a position, the prefix before it and the
suffix after it. Two words share at most one such group, so the sizes of a word's groups give the number of
its near words by replacement, and each group's two largest words give the largest one other than the word
itself. A word with one code point taken out meets the vocabulary under that key: from there a deletion finds
its word, and a word the number and the largest of the words that it can be made from. A group holds at most
as many words as there are letters at a place, so no pair is ever a row and no group is large.

Words are named by their place in the order (count descending, word), so the largest of several words is
the smallest number, and groups carry numbers only.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import cut, own_columns

RUN = "([a-zÀ-ÿ]+)"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: A run is damaged when this divides its hash.
DAMAGE = 97
LEAST_LENGTH, LEAST_COUNT, RATIO = 5, 3, 2
#: Words of more code points have keys of fixed size, as theirs would together be as long as their square.
LONG = 64
#: Primes and points of the keys of long words: 124 bits.
PRIMES = (2147483647, 2147483629, 2147483587, 2147483579)
POINTS = (911382323, 972663749, 1303456789, 1650378921)
#: Keys in a batch of a long word's.
KEYS = 50_000


def runs(docs: DataFrame) -> DataFrame:
    """word: each run of letters of docs (doc_id, text), those that the hash picks without one code point."""
    rows = own_columns(docs, id=F.coalesce(F.col("doc_id").cast("string"), F.lit("")), t=F.translate("text", UPPER, LOWER))
    rows = rows.select("id", F.explode(F.regexp_extract_all("t", F.lit(RUN), 1)).alias("run")).withColumn("h", F.crc32(F.concat("id", F.lit(":"), "run").cast("binary")))
    at = F.expr("cast(h % char_length(run) as int)")
    shorter = F.concat(F.expr("substring(run, 1, cast(h % char_length(run) as int))"), F.substring("run", at + 2, F.lit(2147483647)))
    return rows.select(F.when(F.col("h") % DAMAGE == 0, shorter).otherwise(F.col("run")).alias("word"))


def vocabulary(words: DataFrame, least_length: int, least_count: int) -> DataFrame:
    """place, word, n: distinct words in order of count descending and word; places grow in that order, with gaps."""
    counted = words.where(F.char_length("word") >= least_length).groupBy("word").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= least_count)
    return cut(cut(counted, "counts").orderBy(F.col("n").desc(), "word").select(F.monotonically_increasing_id().alias("place"), "word", "n"), "words")


def residues(values: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, list[int]]:
    """Prefix sums of values[i] * r**i for each prime, the single terms, the inverse points."""
    terms, sums, inverses = [], [], []
    for p, r in zip(PRIMES, POINTS, strict=True):
        power = np.ones(1, np.int64)
        while len(power) < len(values):
            power = np.concatenate([power, power * pow(r, len(power), p) % p])
        term = values * power[: len(values)] % p
        terms.append(term)
        sums.append(np.concatenate([np.zeros(1, np.int64), np.cumsum(term)]) % p)
        inverses.append(pow(r, -1, p))
    return np.array(terms), np.array(sums), inverses


def long_keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(place, kind, key) of long words, in time and space that grow with their length.

    A key is the length and the word as a polynomial: with nothing at the wildcard's place, or with the code
    points after a deleted one moved down. Words of LONG code points only get their own key here.
    """
    digits = lambda cols: ["-".join(map(str, x)) for x in zip(*(c.tolist() for c in cols), strict=True)]
    for b in batches:
        for place, word in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
            values = np.frombuffer(word.encode("utf-32-le"), np.uint32).astype(np.int64)
            n = len(values)
            terms, sums, inverses = residues(values)
            whole = sums[:, -1]
            yield batch([place], ["self"], [f"{n}:{digits(whole[:, None])[0]}"])
            if n <= LONG:
                continue
            for at in range(0, n, KEYS):
                i = np.arange(at, min(n, at + KEYS))
                masked = [(w - t[i]) % p for w, t, p in zip(whole, terms, PRIMES, strict=True)]
                yield batch([place] * len(i), ["masked"] * len(i), [f"{n}*{x}:{k}" for x, k in zip(i.tolist(), digits(masked), strict=True)])
                i = i[(i == 0) | (values[i] != values[i - 1])]  # the same letter again gives the same word
                less = [(s[i] + (w - s[i + 1]) % p * v) % p for w, s, p, v in zip(whole, sums, PRIMES, inverses, strict=True)]
                yield batch([place] * len(i), ["less"] * len(i), [f"{n - 1}:{k}" for k in digits(less)])


def batch(places: list[int], kinds: list[str], keys: list[str]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(places, pa.int64()), pa.array(kinds, pa.string()), pa.array(keys, pa.string())], ["place", "kind", "key"])


def keyed(words: DataFrame) -> DataFrame:
    """place, kind, key of each word: itself, with a wildcard at each place, and without each code point."""
    key = "struct('{}' as kind, {} as key)"
    masked = key.format("masked", "concat(substring(word, 1, i - 1), '*', substring(word, i + 1))")
    less = key.format("less", "concat(substring(word, 1, i - 1), substring(word, i + 1))")
    places = "sequence(1, char_length(word))"
    keys = F.expr(f"concat(array({key.format('self', 'word')}), transform({places}, i -> {masked}), array_distinct(transform({places}, i -> {less})))")
    short = words.where(F.char_length("word") <= LONG).select("place", F.explode(keys).alias("k")).select("place", "k.kind", "k.key")
    return short.unionByName(words.where(F.char_length("word") >= LONG).select("place", "word").mapInArrow(long_keys, "place long, kind string, key string"))


def nearest(words: DataFrame) -> DataFrame:
    """place, n_near, best: how many near words a word has, and the largest; only words that have any."""
    group = Window.partitionBy("key")
    order = group.orderBy("place").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    of = lambda kind, value: F.when(F.col("kind") == kind, value)
    groups = keyed(words).select(
        "place",
        "kind",
        F.count(F.lit(1)).over(order).alias("size"),
        F.first("place").over(order).alias("one"),
        F.nth_value("place", 2).over(order).alias("two"),
        F.max(of("self", F.col("place"))).over(order).alias("whole"),
        F.count(of("less", F.lit(1))).over(order).alias("made"),
        F.min(of("less", F.col("place"))).over(order).alias("longer"),
    )
    # A masked key has a star, so it meets no other kind.
    n = F.when(F.col("kind") == "masked", F.col("size") - 1).when(F.col("kind") == "less", F.col("whole").isNotNull().cast("long")).otherwise(F.col("made"))
    best = F.when(F.col("kind") == "masked", F.when(F.col("one") == F.col("place"), F.col("two")).otherwise(F.col("one"))).when(F.col("kind") == "less", F.col("whole")).otherwise(F.col("longer"))
    found = groups.select("place", n.alias("n"), best.alias("best")).where("n > 0")
    return found.groupBy("place").agg(F.sum("n").alias("n_near"), F.min("best").alias("best"))


def roots(steps: DataFrame) -> DataFrame:
    """place, root: where following steps (place, up) ends. Counts at least double at each step, so paths have
    fewer than 64 of them, and each round doubles how far every row has come."""
    now = cut(steps.select("place", F.col("up").alias("root")), "roots")
    while True:
        far = now.alias("b").select(F.col("place").alias("at"), F.col("root").alias("further"))
        now = cut(now.select("place", "root").join(far, F.col("root") == F.col("at"), "left").select("place", F.coalesce("further", "root").alias("root"), F.col("further").isNotNull().alias("moved")), "roots")
        if now.where("moved").isEmpty():
            return now.select("place", "root")


def variants(docs: DataFrame, least_length: int = LEAST_LENGTH, least_count: int = LEAST_COUNT, ratio: int = RATIO) -> DataFrame:
    """word, form, root, n, n_near, form_n for each word of docs (doc_id, text).

    Words are runs of letters (A to Z in lower case, others as they are), some of which lose a code point by a
    hash of doc_id and run (a null doc_id counts as the empty text), of at least least_length code points and
    least_count occurrences. Near words differ by one inserted, deleted or replaced code point. form: the near word
    of the largest n (ties: the smaller word), if that n is at least ratio times the word's; root: the last word
    that forms lead to. Null and empty texts have no words; repeated rows count each; an empty table gives no
    rows; other columns aren't read. Words of any length are compared whole: above LONG code points by 124-bit
    fingerprints.
    """
    words = vocabulary(runs(docs), least_length, least_count)
    near = nearest(words)
    named = words.join(near, "place", "left").select("place", "word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"), "best")
    other = words.select(F.col("place").alias("best"), F.col("word").alias("form"), F.col("n").alias("form_n"))
    formed = named.join(other.withColumnRenamed("best", "at"), (F.col("best") == F.col("at")) & (F.col("form_n") >= ratio * F.col("n")), "left")
    formed = cut(formed.select("place", "word", "n", "n_near", "form", "form_n", F.when(F.col("form").isNotNull(), F.col("best")).alias("up")), "forms")
    ends = roots(formed.where(F.col("up").isNotNull()).select("place", "up"))
    ends = ends.join(words.select(F.col("place").alias("root"), F.col("word").alias("last")), "root").select("place", "last")
    return formed.join(ends, "place", "left").select("word", "form", F.coalesce("last", "word").alias("root"), "n", "n_near", "form_n")
